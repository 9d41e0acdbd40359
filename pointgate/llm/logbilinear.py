"""A log-bilinear model of classes, fitted by noise-contrastive estimation.

The score of class w after classes u, v is ``R[w] . (P[u] + Q[v]) + b[w]``.  Noise-contrastive estimation tells counted
triples from noise after the class frequencies, so fitting needs no normalisation.  Nothing is drawn: every step takes
the gradient over all counted triples, each weighted by its count, and the expected gradient over the noise.
``log_table`` then normalises over all classes with batched matrix products.
"""

from __future__ import annotations

import numpy as np


class LogBilinear:
    def __init__(self, classes: int, width: int, seed: int = 5):
        random = np.random.default_rng(seed)
        self.parts = {
            "P": random.normal(0, 0.1, (classes, width)).astype(np.float32),
            "Q": random.normal(0, 0.1, (classes, width)).astype(np.float32),
            "R": random.normal(0, 0.1, (classes, width)).astype(np.float32),
            "b": np.zeros(classes, np.float32),
        }
        self.classes = classes
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.parts.items()}
        self.steps = 0

    def step(self, gradients: dict[str, np.ndarray], rate: float) -> None:
        """Adam."""
        self.steps += 1
        for name, g in gradients.items():
            first, second = self.moments[name]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            mean = first / (1 - 0.9**self.steps)
            size = np.sqrt(second / (1 - 0.99**self.steps))
            self.parts[name] -= (rate * mean / (size + 1e-12)).astype(np.float32)

    def fit(
        self, triples: np.ndarray, counts: np.ndarray, steps: int = 500, batch: int = 4096, noise: int = 64,
        rate: float = 0.02, prior: float = 10.0,
    ) -> LogBilinear:
        """``triples``: rows (u, v, w); each counts as often as it was seen, in every step.

        ``noise``: noise per counted triple.  ``batch``: contexts (u, v) held at once; the result does not depend on it.
        ``prior``: so many triples' worth of pull towards zero, which fades as counts grow.
        """
        if len(triples) == 0:
            return self
        share = np.bincount(triples[:, 2], counts.astype(np.float64), self.classes)
        share = (share + 0.5 * (share > 0)) / (share + 0.5 * (share > 0)).sum()
        log_noise = np.log(np.maximum(share, 1e-12) * noise).astype(np.float32)
        self.parts["b"] = np.log(np.maximum(share, 1e-9)).astype(np.float32)
        seen = np.zeros((self.classes, self.classes, self.classes), np.float32)
        np.add.at(seen, tuple(triples.T), (counts / counts.sum(dtype=np.float64)).astype(np.float32))
        fade = prior / float(counts.sum(dtype=np.float64))
        drawn = (noise * share).astype(np.float32)
        firsts = np.flatnonzero(seen.any(axis=(1, 2)))
        width = max(1, batch // self.classes)
        for turn in range(steps):
            p = self.parts
            gradients = {name: np.zeros_like(v) if name == "b" else np.float32(fade) * v for name, v in p.items()}
            for begin in range(0, len(firsts), width):
                u = firsts[begin : begin + width]
                context = (p["P"][u][:, None] + p["Q"][None]).reshape(-1, p["P"].shape[1])
                counted = seen[u].reshape(-1, self.classes)
                noisy = counted.sum(axis=1)[:, None] * drawn
                alike = 1 / (1 + np.exp(-np.clip(context @ p["R"].T + (p["b"] - log_noise), -30, 30)))
                wrong = (counted + noisy) * alike - counted  # noise taken for counted, less counted taken for noise
                back = (wrong @ p["R"]).reshape(len(u), self.classes, -1)
                gradients["P"][u] = back.sum(axis=1)
                gradients["Q"] += back.sum(axis=0)
                gradients["R"] += wrong.T @ context
                gradients["b"] += wrong.sum(axis=0)
            self.step(gradients, rate * (1 - turn / steps) + 1e-4)
        return self

    def log_table(self, allowed: np.ndarray) -> np.ndarray:
        """log10 of the probability of each class after each pair of classes; classes not allowed get none."""
        p = self.parts
        bias = np.where(allowed, p["b"], -np.inf).astype(np.float32)
        table = np.empty((self.classes, self.classes, self.classes), np.float32)
        for u in range(self.classes):
            scores = (p["P"][u] + p["Q"]) @ p["R"].T + bias
            scores -= scores.max(axis=1, keepdims=True)
            table[u] = (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)
        return table
