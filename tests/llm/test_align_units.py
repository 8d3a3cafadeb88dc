"""Units of the tokenizer alignment: how texts are cut, and which answers a task keeps."""

import itertools

from pumpline.llm import align
from tests.llm.test_search import A_PATH, B_PATH


def test_units_are_cut_at_the_breaks():
    for text in map("".join, itertools.chain(*(itertools.product("a \n ", repeat=n) for n in range(1, 8)))):
        assert align._units(text) == align._BREAK.split(text)


def test_units_met_again_are_not_tokenised_again(monkeypatch):
    monkeypatch.setattr(align, "KNOWN_UNITS", 8)
    both, known = align._loaded(A_PATH, B_PATH), align._Known()
    often, long, asked = ["o,", "a.", "e"], "x" * (align.KNOWN_CHARS + 1), []
    for i in range(6):
        units = {*often, long, *(f"u{i}v{j}" for j in range(5))}
        fresh = known.learn(both, units)
        assert [known.new[u] for u in sorted(units)] == align.align(both, sorted(units))
        known.trim(fresh)
        asked += fresh
        assert len(known.old) <= 8 + 4 and len(known.new) <= 4 and long not in known.new
    assert all(asked.count(u) == 1 for u in often) and asked.count(long) == 6
