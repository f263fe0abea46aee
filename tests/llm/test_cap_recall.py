"""Operator 4: recall of pairs at the threshold stays level while the directions grow."""
import math

import numpy as np
import pytest

from peerscope.llm import capfilters


@pytest.mark.parametrize("words,n", [(225, 6000), (1000, 6000), (2500, 3000)])
def test_recall_stays_level(words, n):
    rng = np.random.default_rng(3)
    a = capfilters.unit_rows(rng.normal(size=(n, 64)))
    e = rng.normal(size=a.shape)
    e = capfilters.unit_rows(e - (e * a).sum(axis=1, keepdims=True) * a)
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * e
    caps = capfilters.level_caps(64, words**2, 0.95)
    met = np.zeros(n, bool)
    for number in range(capfilters.CODES):
        code = capfilters.ProductCode(64, words, caps, number)
        for lo in range(0, n, 250):
            ends = [r * words**2 + c for r, c in (code.decode(x[lo : lo + 250]) for x in (a, b))]
            met[lo + np.intersect1d(*ends) // words**2] = True
    assert met.mean() > 0.993


def test_caps_grow_with_directions_and_distance():
    level = [capfilters.level_caps(64, d, 0.95) for d in (16, 225**2, 10**6, 25 * 10**6)]
    assert level[0] == 12 and abs(level[1] - 12) < 0.01 and 13 < level[2] < 15 < level[3] < 18
    assert capfilters.level_caps(64, 10**6, 0.9) > level[2] > capfilters.level_caps(64, 10**6, 0.99)
    assert capfilters.level_caps(3, 10**4, 0.95) == 10**4
