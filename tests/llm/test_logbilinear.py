"""The fit of the log-bilinear model covers every counted triple."""

import numpy as np

from pointgate.llm import logbilinear

ALLOWED = np.arange(7) < 6


def test_rare_triples_are_learned():
    """Contexts with some hundred-thousandths of the counts each, which a fixed number of draws hardly meets."""
    triples = np.array([(0, 0, 0), (0, 0, 1), (2, 3, 4), (3, 2, 5), (4, 5, 2), (5, 4, 3)])
    counts = np.array([6 * 10**7, 4 * 10**7, 2000, 2000, 2000, 2000])
    table = 10 ** logbilinear.LogBilinear(7, 8).fit(triples, counts).log_table(ALLOWED)
    for u, v, w in triples[2:]:
        assert table[u, v].argmax() == w and table[u, v, w] > 0.4
    assert abs(table[0, 0, 0] - 0.6) < 0.02 and abs(table[0, 0, 1] - 0.4) < 0.02


def test_the_fit_depends_on_counts_alone():
    random = np.random.default_rng(1)
    triples = np.array([(u, v, w) for u in range(6) for v in range(6) for w in range(6)])
    counts = random.integers(1, 10**6, len(triples))
    tables = [
        logbilinear.LogBilinear(7, 8).fit(triples, counts * k, steps=100, batch=b).log_table(ALLOWED)[:6, :6, :6]
        for k, b in ((1, 10_000), (1, 7), (1000, 10_000))
    ]
    order = random.permutation(len(triples))
    tables.append(
        logbilinear.LogBilinear(7, 8).fit(triples[order], counts[order], steps=100).log_table(ALLOWED)[:6, :6, :6]
    )
    assert all(np.allclose(tables[0], t, atol=1e-3) for t in tables[1:])
