from __future__ import annotations

import random

import numpy as np
import pytest

from lethe.llm import induced


def brute(t, cap):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and a + k < len(t) and b + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        common.append(k)
    return order, common


def texts():
    rng = random.Random(9)
    yield [0]
    yield [5, 0]
    yield [1] * 60 + [0]
    yield list(range(40, -1, -1))
    yield [*range(1, 40), 0]
    for size in (2, 3, 10, 50, 400):
        for sigma in (1, 2, 4, 250):
            for _ in range(4):
                t = [rng.randint(1, sigma) for _ in range(size)]
                if size > 20:
                    t = t + t[3 : size // 2] * 2 + [1] * 9 + t[5:15]
                yield t + [0]


@pytest.mark.parametrize("settings", [{}, {"base_items": 2}, {"base_items": 2, "queue_bytes": 64}, {"queue_bytes": 1}])
def test_order_and_common_prefixes(settings):
    for t in texts():
        order, common = induced.suffixes(np.array(t, np.uint16), 255, **settings)
        expected, shared = brute(t, 255)
        assert order.tolist() == expected
        assert common.tolist() == shared


def test_a_small_cap_keeps_equal_prefixes_together():
    for t in texts():
        order, common = induced.suffixes(np.array(t, np.uint16), 6)
        prefixes = [t[i : i + 6] for i in order.tolist()]
        assert prefixes == sorted(prefixes)
        for k in range(1, len(t)):
            a, b = prefixes[k - 1], prefixes[k]
            same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert common[k] == same
