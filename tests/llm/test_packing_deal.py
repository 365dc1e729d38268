"""Keys by which packing deals documents: their rarest shared terms, found without a sort."""

import numpy as np

from strobe.llm import packing


def test_rarest_terms_are_those_of_a_sort():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 100, packing.SLOTS)
    doc = np.sort(rng.integers(0, 300, 4000))
    slot = rng.integers(0, packing.SLOTS, 4000)
    doc, slot = np.append(doc, [301, 301]), np.append(slot, [np.argmin(counts)] * 2)
    order, place, least = packing.by_rarity(counts)
    got = packing.rarest(doc, place[slot], order, least, 303)
    for bound, key in zip(packing.SHARED, got, strict=True):
        for d in range(303):
            own = [(counts[s], s) for s in slot[doc == d] if counts[s] >= bound]
            assert key[d] == (min(own)[1] if own else -1)
    none = packing.rarest(doc[:0], doc[:0], order, least, 2)
    assert [k.tolist() for k in none] == [[-1, -1]] * 3
