"""Hashes of all runs of an array from prefix sums: polynomials modulo 2**64, the same wherever a run stands."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of an odd base and of its inverse modulo 2**64."""
    if base not in _tables or len(_tables[base][0]) <= n:
        size, tables = 1 << max(16, int(n).bit_length()), []
        for x in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, x, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _tables[base] = tables[0], tables[1]
    return _tables[base]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def run_hashes(values: np.ndarray, base: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hashes of runs ``values[a:b]`` from their prefix sums; the same wherever the run stands."""
    up, down = powers(base, len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return lambda a, b: mixed((sums[b] - sums[a]) * down[a])
