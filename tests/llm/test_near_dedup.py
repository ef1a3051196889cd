"""Sketches of small sets against the sets' similarity."""

import numpy as np
import pytest
from sunledger.llm import near_dedup


@pytest.mark.parametrize("size", range(1, 9))
def test_equal_coordinates_of_small_sets(size):
    rng = np.random.default_rng(size)
    trials = 1500
    for other in {size, max(1, size - 1)}:
        # the first elements are shared; a set of equal size differs in one element, if it has two or more
        sets = []
        for _ in range(trials):
            x = rng.integers(0, 1 << 48, size + 1, dtype=np.uint64)
            a, b = x[:size], x[:other] if other < size or size == 1 else np.append(x[: size - 1], x[size])
            sets += [np.sort(a), np.sort(b)]
        shared = len(np.intersect1d(a, b))
        sketch = near_dedup.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
        equal = (sketch[::2] == sketch[1::2]).mean()
        assert abs(equal - shared / (len(a) + len(b) - shared)) < 0.02
