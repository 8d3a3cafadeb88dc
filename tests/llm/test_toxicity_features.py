"""Subsequence features and units of the toxicity operator against a plain enumeration; the room that values take."""

import tracemalloc

import numpy as np
from pumpline.llm import toxicity


def plain_features(kernel, unit):
    """{feature: weight} of one unit between its edges, by enumeration."""
    sym = [1, *(0 if not s else s for s in kernel.table[[ord(c) for c in unit]].tolist()), 1]
    out = {}
    for offsets, weight in zip(toxicity.OFFSETS, toxicity._WEIGHTS):
        for at in range(len(sym) - offsets[-1]):
            part = [sym[at + o] for o in offsets]
            if part[0] and part[-1] and min(part[1:-1]) > 1:
                code = 0
                for s in part:
                    code = code * toxicity.SYMBOLS + s
                feature = (code * 0x9E3779B1 >> 7) & (toxicity._FEATURES - 1) if len(part) == 4 else code
                out[feature] = out.get(feature, 0) + weight
    size = np.sqrt(sum(w * w for w in out.values()))
    return {f: w / size for f, w in out.items()}


def test_features_equal_enumeration():
    kernel = toxicity.Kernel()
    units = ["idiot", "id.iot", "a", "ab", "x--y", "...", "čau9", "weiß-nicht", "z" * toxicity.WINDOW]
    got = [{} for _ in units]
    for u, f, w in zip(*kernel.features(units)):
        got[u][int(f)] = w
    for unit, have in zip(units, got):
        want = plain_features(kernel, unit)
        assert have.keys() == want.keys()
        assert np.allclose([have[f] for f in want], list(want.values()))


def test_single_characters_and_long_words():
    w = "b" * (toxicity.WINDOW + 6)
    assert toxicity.units_of("A b c  de f g") == {"a", "b", "c", "de", "f", "g", "a b c", "abc"}
    assert {"a b c", "abc", w[:toxicity.WINDOW]} <= toxicity.units_of(f"a b c {w}") and w not in toxicity.units_of(w)
    assert "abd" not in toxicity.units_of(f"a b {w} d") and toxicity.units_of("") == set()


def test_values_take_little_room():
    kernel, table = toxicity.Kernel(), np.ones(toxicity._FEATURES)
    units = [f"unit{i}word" for i in range(40_000)]
    tracemalloc.start()
    kernel.values(units, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20  # 272 MB in chunks of 200,000 characters
