"""How many links at the threshold are lost, from the binomial of the signatures."""

from __future__ import annotations

from math import comb

import pytest

from tidewatch.llm import minhash


@pytest.mark.parametrize("share", [0.85, 0.8])
def test_bands_and_signatures_lose_less_than_stated(share):
    rows, bands = minhash.BAND_ROWS, minhash._bands(share)
    unseen = (1 - share**rows) ** bands
    slots = bands * rows + minhash.EXTRA
    least, free = minhash._least(slots, share), slots - rows
    # One band is shared; the other slots are equal with the probability of the threshold.
    short = sum(
        comb(free, k) * share**k * (1 - share) ** (free - k)
        for k in range(free + 1)
        if k + rows < least
    )
    assert unseen + short < minhash.MISS
