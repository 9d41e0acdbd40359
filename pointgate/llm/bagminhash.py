"""BagMinHash: signatures whose agreement is an unbiased estimate of the weighted Jaccard similarity of multisets.

The weight axis is cut into blocks [0,1), [1,2), [2,4), [4,8), ...  For each element and block a Poisson process emits
points in the order of time, at a rate of ``size * block length``; a point has a place in the block and belongs to one
of ``size`` components.  It counts for every multiset in which the element's weight reaches beyond the place, so
larger blocks are split by their places into what counts and what does not.  A component keeps the earliest point
that counts.  Points come in order, so a process ends as soon as its time is past the latest component: a text takes
about ``elements + size * log(size)`` points, whatever the weights.
"""

from __future__ import annotations

import numpy as np

from pointgate.llm.text import mix

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def unit(values: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1] from 64-bit hashes."""
    return ((values >> np.uint64(11)).astype(np.float64) + 1.0) / float(1 << 53)


def streams(elements: np.ndarray, weights: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """One process per element and block that its weight reaches: seed, block length, part that counts, owner."""
    seeds, lengths, parts, owned = [mix(elements)], [np.ones(len(elements))], [np.ones(len(elements))], [owners]
    block, start = 1, 1
    while True:
        reach = np.flatnonzero(weights > start)
        if not len(reach):
            break
        length = start
        with np.errstate(over="ignore"):
            seeds.append(mix(elements[reach] + np.uint64(block) * _GOLDEN))
        lengths.append(np.full(len(reach), float(length)))
        parts.append(np.minimum(weights[reach] - start, length) / length)
        owned.append(owners[reach])
        start += length
        block += 1
    return np.concatenate(seeds), np.concatenate(lengths), np.concatenate(parts), np.concatenate(owned)


def signatures(
    elements: np.ndarray, weights: np.ndarray, owners: np.ndarray, count: int, size: int
) -> np.ndarray:
    """``count`` rows of ``size`` 32-bit components; a multiset without elements has a row of all ones."""
    best = np.full(count * size, _LAST, np.uint64)
    seeds, lengths, parts, owners = streams(elements, weights.astype(np.int64), owners.astype(np.int64))
    times = np.zeros(len(seeds))
    state = seeds.copy()
    turn = 0
    latest = np.full(count, _LAST, np.uint64)
    while len(state):
        turn += 1
        with np.errstate(over="ignore"):
            draw = mix(state + np.uint64(turn) * _GOLDEN)
            where = mix(draw ^ _GOLDEN)
        times = times - np.log(unit(draw)) / (lengths * size)
        component = ((where >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64)
        # time (as an ordered 32-bit float) above, the point's name below: one minimum finds both
        packed = (times.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (
            draw & np.uint64(0xFFFFFFFF)
        )
        counts = parts >= 1
        if not counts.all():
            place = (where & np.uint64(0xFFFFFFFF)).astype(np.float64) / float(1 << 32)
            counts = place < parts
            np.minimum.at(best, (owners * size + component)[counts], packed[counts])
        else:
            np.minimum.at(best, owners * size + component, packed)
        if turn < 8 or turn % 8 == 0:
            alive = np.unique(owners) if len(owners) < count else np.arange(count)
            latest[alive] = best.reshape(count, size)[alive].max(axis=1)
        keep = packed < latest[owners]
        if not keep.all():
            state, times, lengths, parts, owners = (x[keep] for x in (state, times, lengths, parts, owners))
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(count, size)
