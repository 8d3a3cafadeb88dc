"""Toxicity by a string-kernel support vector machine with Nystrom landmarks.

The kernel is the gap-weighted subsequence kernel of lengths 3 and 4: two
strings share a feature for every three or four characters that occur in order
in both, weighted by DECAY to the length of the span they take, gaps included
(spans up to ``SPAN``; a subsequence is known by a hash of 20 bits).  Inserted characters only stretch spans, and only letters,
digits and the edges of a word are characters of a subsequence, so ``id.iot`` stays close to
``idiot``.  Kernels are normalised.

A text's sentences are bags of units: their words, runs of single characters
read as one word, both without the marks between their letters, and the
phrases of two and three neighbouring words of one sentence, over whose spaces
the kernel runs like over any inserted character.  Only the
best unit counts, so a document's sentences are taken together.  Training sees whether a document is toxic, not which of
its units makes it so: it starts from the unit most over-represented in toxic
documents as each toxic document's witness, trains the machine on witnesses
against units of other documents, picks the witnesses anew by the machine, adds the
units of other documents that score highest, and repeats.  Units whose share
of toxic documents cannot be chance (a binomial tail bound, corrected for the
number of units) are positive examples throughout, also with a character
inserted.

A phrase whose share of toxic documents cannot be chance and is clearly above
that of each of its parts is a positive example too; words that prove nothing
outside the documents of such phrases are not, and clean phrases that hold a
word of theirs are negative examples.  Only phrases around a word whose own
value reaches the model's ``gate`` are valued (the gate is below the best word
of every phrase found in training; without such phrases there is no gate and
words alone are valued).

Landmarks K(z, z) give the Nystrom features K(z, z)^(-1/2) k(z, u), on which a
linear machine is trained by sub-gradient descent.  Its value for a unit is
linear in the unit's subsequence features, so scoring sums one number per
feature and divides by the unit's length in the kernel's space.  A text's
value is its highest unit's.  A logistic curve, its slope fitted and its middle
put where it splits best on documents that the machine has not seen, turns the
value into a score.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.llm.common import stored

DECAY = 0.8
SPAN = 6
SYMBOLS = 64
LANDMARKS = 256
MAX_PER_LABEL = 2000
MAX_TRAIN_UNITS = 3_000_000
MAX_TRAIN_WORDS = 3_000_000  # words in order, of which training counts phrases
PHRASE_GAIN = 0.7  # by how much a phrase's log odds exceed those of its parts
GATE_SLACK = 0.3
ROUNDS = 4
MISS_COST = 2.0
KNOWN_UNITS = 250_000
ROWS = 128  # units whose features are held as dense rows at once
WINDOW, OVERLAP = 64, 8  # longest unit, and what neighbouring windows of a longer word share
_MARKS = regex.compile(r"[^\p{L}\p{N}]+")
_ENDS = frozenset(".!?;\u2026\u3002\uff01\uff1f")
_FEATURES = 1 << 20
OFFSETS = [(0, *inner, far) for far in range(2, SPAN) for k in (1, 2) for inner in combinations(range(1, far), k)]
_WEIGHTS = np.array([DECAY ** (o[-1] - len(o) + 1) for o in OFFSETS])


def _symbol_table() -> np.ndarray:
    """By code point: 0 for what is no letter or digit, else 2 to 63."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x30000):
        if chr(c).isalnum():
            table[c] = 2 + c % (SYMBOLS - 2)
    return table


class Kernel:
    """Subsequence features of units."""

    def __init__(self):
        self.table = _symbol_table()

    def features(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, feature, weight) of all units; a unit's weights have length 1."""
        text = " " + " ".join([u.replace(" ", "​") for u in units]) + " "
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sym = self.table[code].astype(np.int64)
        edge = code == 32
        sym[edge] = 1
        edges = np.cumsum(edge)
        keys = []
        for far in range(2, SPAN):
            n = len(sym) - far
            if n <= 0:
                continue
            at = np.flatnonzero((edges[far - 1:-1] == edges[:n]) & (sym[:n] > 0) & (sym[far:] > 0))
            unit = (edges[at] - 1) * _FEATURES  # no edge lies within a span, so all of it is of the unit after ``at``
            taken = {o: sym[at + o] for o in range(far + 1)}
            inner = {o: taken[o] > 1 for o in range(1, far)}
            for which, offsets in enumerate(OFFSETS):
                if offsets[-1] != far:
                    continue
                code = taken[0]
                for o in offsets[1:]:
                    code = code * SYMBOLS + taken[o]
                if len(offsets) == 4:
                    code = (code * 0x9E3779B1 >> 7) & (_FEATURES - 1)
                ok = inner[offsets[1]] & inner[offsets[-2]]
                key = (unit + code) * 32 + which
                keys.append(key if ok.all() else key[ok])
        key = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        del keys
        key.sort()
        if not len(key):
            return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)
        same = key >> 5
        first = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
        w = np.add.reduceat(_WEIGHTS[key & 31], first)
        same = same[first]
        unit = same // _FEATURES
        size = np.sqrt(np.bincount(unit, weights=w * w, minlength=len(units)))
        return unit, same % _FEATURES, w / size[unit]

    def values(self, units: list[str], table: np.ndarray, chunk: int = 50_000) -> np.ndarray:
        """Per unit the sum of its features' table entries, in chunks of so many characters."""
        out = np.zeros(len(units))
        piece = np.cumsum([len(u) + 1 for u in units], dtype=np.int64) // chunk
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(units)]
        for i, j in zip(edges, edges[1:]):
            unit, feature, w = self.features(units[i:j])
            out[i:j] = np.bincount(unit, weights=w * table[feature], minlength=j - i)
        return out

    def dense(self, units: list[str], columns: np.ndarray) -> np.ndarray:
        """Rows of features (only those in ``columns``, ascending)."""
        unit, feature, w = self.features(units)
        at = np.minimum(np.searchsorted(columns, feature), len(columns) - 1)
        ok = columns[at] == feature
        out = np.zeros((len(units), len(columns)), dtype=np.float32)
        out[unit[ok], at[ok]] = w[ok]
        return out

    def mapped(self, units: list[str], columns: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """``dense`` rows times ``matrix``, dense for ``ROWS`` units at a time."""
        return np.concatenate([self.dense(units[i:i + ROWS], columns) @ matrix for i in range(0, len(units), ROWS)])


def units_of(text: str) -> set[str]:
    """The units of a text: its lower-cased words, three or more single
    characters in a row joined (by spaces, which are inserted characters, and
    without), and every word without the marks in it.  A unit has at most
    ``WINDOW`` characters: longer words (texts without spaces too) come in
    windows that overlap by more than a subsequence spans."""
    words = text.lower().split()
    sizes = list(map(len, words))
    out = set(words)
    if max(sizes, default=0) > WINDOW:
        long = {w for w in out if len(w) > WINDOW}
        words = [w if w not in long else "" for w in words]
        out = {w[i:i + WINDOW] for w in long for i in range(0, len(w) - OVERLAP, WINDOW - OVERLAP)} | out - long
    # Three or more single characters in a row, looked for in one pass.
    if sizes.count(1) > 2 and b"\x01\x01\x01" in bytes(map((1).__eq__, sizes)):
        start = None
        for i, w in enumerate([*words, ""]):
            if len(w) == 1:
                start = i if start is None else start
            elif start is not None:
                for at in range(start, i, WINDOW // 2 - OVERLAP // 2) if i - start > 2 else ():
                    part = words[at:min(i, at + WINDOW // 2)]
                    out |= {" ".join(part), "".join(part)}
                    if at + WINDOW // 2 >= i:
                        break
                start = None
    out |= {b for w in out if not w.isalnum() and len(b := _MARKS.sub("", w)) > 2}
    return out


def sentence_words(text: str) -> list[str]:
    """The lower-cased words of a text in order, without marks, an empty string
    after each sentence (a line ends one too) and for a word over ``WINDOW``."""
    out = []
    for line in text.lower().splitlines():
        for w in line.split():
            bare = w if w.isalnum() else _MARKS.sub("", w)
            if bare:
                out.append(bare if len(bare) <= WINDOW else "")
            if w[-1] in _ENDS:
                out.append("")
        out.append("")
    return out


def phrases_around(words: list[str], is_gate) -> set[str]:
    """The phrases of two and three words that hold a word ``is_gate`` accepts."""
    out = set()
    for i, w in enumerate(words):
        if not w or not is_gate(w):
            continue
        for n in (2, 3):
            for at in range(max(0, i - n + 1), min(i, len(words) - n) + 1):
                part = words[at:at + n]
                if all(part):
                    out.add(" ".join(part))
    return out


def _odds(bad, good, bads: int, goods: int):
    return np.log((bad + 0.5) / (bads + 1)) - np.log((good + 0.5) / (goods + 1))


def _is_sure(bad, good, share: float, tried: int):
    """Whether a share of toxic documents cannot be chance: a binomial tail
    bound, corrected for the number of units ``tried``."""
    bad, good = np.asarray(bad, dtype=float), np.asarray(good, dtype=float)
    q = bad / np.maximum(bad + good, 1)
    rest = np.where(q < 1, (1 - q) * np.log(np.maximum(1 - q, 1e-12) / max(1 - share, 1e-12)), 0.0)
    gain = q * np.log(np.maximum(q, 1e-12) / share) + rest
    return (q > share) & ((bad + good) * gain > np.log(20 * max(tried, 1)))


class _Phrases:
    """Phrases of coded word sequences (code -1 between sentences), each
    counted once a document."""

    def __init__(self, code: np.ndarray, doc: np.ndarray, n_words: int, toxic: np.ndarray):
        n, self.toxic = len(toxic), toxic
        some = code >= 0
        self.levels = [self._count(code[some], doc[some], n_words, n)]
        at = np.flatnonzero(some)
        prefix = code[at]
        for far in (1, 2):
            ok = at + far < len(code)
            ok[ok] = (code[at[ok] + far] >= 0) & (doc[at[ok] + far] == doc[at[ok]])
            at, prefix = at[ok], prefix[ok]
            last = code[at + far]
            key, phrase = np.unique(prefix * n_words + last, return_inverse=True)
            # parts: the phrase without its last and without its first word
            first = np.unique(phrase, return_index=True)[1]
            parts = (prefix[first], last[first] if far == 1 else self._tail(key, n_words))
            self.levels.append((*self._count(phrase, doc[at], len(key), n), parts, code[at[first][:, None] + np.arange(far + 1)]))
            if far == 1:
                self.pairs = key
            prefix = phrase

    def _tail(self, key: np.ndarray, n_words: int) -> np.ndarray:
        pair, last = key // n_words, key % n_words
        return np.searchsorted(self.pairs, self.pairs[pair] % n_words * n_words + last)

    def _count(self, unit, doc, n_units: int, n_docs: int):
        once = np.unique(unit.astype(np.int64) * n_docs + doc)
        unit, doc = once // n_docs, once % n_docs
        bad = np.bincount(unit, weights=self.toxic[doc], minlength=n_units)
        return bad, np.bincount(unit, minlength=n_units) - bad, unit, doc

    def telling(self, bads: int, goods: int) -> list[tuple[np.ndarray, float, np.ndarray]]:
        """(word codes, toxic documents, documents) of the phrases that tell
        toxic documents and tell clearly more than each of their parts."""
        out, tried = [], sum(len(level[0]) for level in self.levels)
        below = _odds(*self.levels[0][:2], bads, goods)
        for bad, good, unit, doc, parts, words in self.levels[1:]:
            own = _odds(bad, good, bads, goods)
            best = np.maximum(below[parts[0]], below[parts[1]])
            tells = (bad >= 5) & (own > 1.5) & (own > best + PHRASE_GAIN) & _is_sure(bad, good, bads / (bads + goods), tried)
            for i in np.flatnonzero(tells):
                out.append((words[i], float(bad[i]), doc[unit == i]))
            below = np.maximum(own, best)
        return out

    def clean_around(self, codes: np.ndarray, limit: int) -> list[np.ndarray]:
        """The phrases most frequent in clean documents that hold one of ``codes``."""
        found = []
        for bad, good, _, _, _, words in self.levels[1:]:
            at = np.flatnonzero((good > 0) & np.isin(words, codes).any(axis=1))
            at = at[np.argsort(-good[at], kind="stable")[:limit]]
            found += [words[i] for i in at]
        return found


@dataclass
class ToxicityModel:
    table: np.ndarray  # by feature: its part of the machine's value
    bias: float
    slope: float
    offset: float
    empty: float  # the probability of a text without units
    gate: float = np.inf  # phrases around a word of at least this value are valued

    def probability(self, value: np.ndarray) -> np.ndarray:
        p = 1.0 / (1.0 + np.exp(-np.clip(self.slope * value + self.offset, -500, 500)))
        return np.where(np.isfinite(value), p, self.empty)


def _train_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 3000, penalty: float = 1e-4, seed: int = 0):
    """Hinge loss by averaged stochastic sub-gradient steps on batches drawn by weight."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, kept = np.zeros_like(w), 0.0, 0
    pos, neg = np.flatnonzero(y > 0), np.flatnonzero(y < 0)
    chance = [weight[g] / weight[g].sum() for g in (pos, neg)]
    for step in range(steps):
        at = np.concatenate([rng.choice(pos, 64, p=chance[0]), rng.choice(neg, 192, p=chance[1])])
        off = y[at] * (x[at] @ w + b) < 1
        rate = 2.0 / (1 + step / 200)
        w *= 1 - rate * penalty
        some = at[off]
        w += rate / len(at) * (y[some] @ x[some])
        b += 0.1 * rate / len(at) * y[some].sum()
        if step >= steps // 2:
            kept += 1
            mean_w += (w - mean_w) / kept
            mean_b += (b - mean_b) / kept
    return mean_w, mean_b


def _logistic(value: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (kept positive) and offset by Newton steps with a small penalty."""
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * value + b, -50, 50)))
        g = np.array([(weight * (p - y) * value).sum() + 1e-2 * (a - 1), (weight * (p - y)).sum()])
        s = weight * p * (1 - p) + 1e-6
        h = np.array([[(s * value * value).sum() + 1e-2, (s * value).sum()], [(s * value).sum(), s.sum()]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = max(1e-3, a - step[0]), b - step[1]
    return float(a), float(b)


def _threshold(value: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The value that splits the documents best; a missed toxic document
    counts ``MISS_COST`` times a clean one that is hit."""
    order = np.argsort(value, kind="stable")
    v, w = value[order], np.where(toxic[order], MISS_COST, 1.0) * weight[order]
    missed = np.concatenate([[0.0], np.cumsum(w * toxic[order])])
    hit = (w * ~toxic[order]).sum() - np.concatenate([[0.0], np.cumsum(w * ~toxic[order])])
    edges = np.concatenate([[v[0] - 1], (v[1:] + v[:-1]) / 2, [v[-1] + 1]])
    can = np.concatenate([[True], v[1:] > v[:-1], [True]])
    cost = np.where(can, missed + hit, np.inf)
    return float(np.median(edges[cost <= cost.min() + 1e-9]))


def train(bags: list[list[str]], toxic: np.ndarray, weight: np.ndarray, seed: int = 0,
          sequences: tuple[np.ndarray, np.ndarray, list[str]] | None = None) -> ToxicityModel:
    """``bags``: the distinct units of each labelled document; ``sequences``:
    its words in order, as codes (-1 between sentences), the documents they are
    of and the words by code."""
    kernel, rng = Kernel(), np.random.default_rng(seed)
    aside = np.zeros(len(bags), dtype=bool)
    for label in (True, False):
        own = np.flatnonzero(toxic == label)
        if len(own) >= 4:
            aside[rng.permutation(own)[:len(own) // 4]] = True
    fit = np.flatnonzero(~aside)
    bad_at = [i for i in fit if toxic[i] and bags[i]]
    bad = [bags[i] for i in bad_at]
    n_bad, n_good = Counter(u for b in bad for u in b), Counter(u for i in fit if not toxic[i] for u in bags[i])
    if not n_bad or not n_good:
        p = float(np.clip(weight[toxic].sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3))
        return ToxicityModel(np.zeros(_FEATURES), 0.0, 1.0, float(np.log(p / (1 - p))), p)
    goods = sum(not toxic[i] for i in fit)
    share, tried = len(bad) / (len(bad) + goods), len(n_bad) + len(n_good)
    surprise = {u: float(_odds(n_bad[u], n_good[u], len(bad), goods)) for u in n_bad}
    ranked = sorted(surprise, key=lambda u: (-surprise[u], u))
    proven = [u for u in ranked if surprise[u] > 1.5 and _is_sure(n_bad[u], n_good[u], share, tried)]

    # Phrases: word lists with the documents that hold them.
    phrases, told, near_phrases = {}, set(), []
    if sequences is not None:
        code, doc, names = sequences
        use = ~aside[doc]
        counted = _Phrases(code[use], doc[use], len(names), toxic.astype(float))
        found = [(" ".join(names[c] for c in words), n, set(docs.tolist())) for words, n, docs in counted.telling(len(bad), goods)]
        # A pair that proves nothing outside the documents of its telling triples is none itself.
        triples = [(f" {p} ", docs) for p, _, docs in found if p.count(" ") == 2]
        kept = []
        for p, n, docs in found:
            longer = set().union(*(d for q, d in triples if f" {p} " in q)) if p.count(" ") == 1 else set()
            rest = docs - longer
            if not longer or _is_sure(sum(toxic[i] for i in rest), sum(not toxic[i] for i in rest), share, tried):
                kept.append((p, n, docs))
        found, holds = kept, {}
        for phrase, _, docs in found:
            for w in phrase.split():
                holds.setdefault(w, set()).update(docs)
        # Words that prove nothing outside their phrases' documents.
        of = {u: holds[w] for u in proven if (w := _MARKS.sub("", u)) in holds}
        outside = {u: [0, 0] for u in of}
        for i in fit if of else ():
            for u in bags[i]:
                if u in of and i not in of[u]:
                    outside[u][0 if toxic[i] else 1] += 1
        proven = [u for u in proven if u not in outside or _is_sure(*outside[u], share, tried)]
        covered = {i for i in bad_at if not set(proven).isdisjoint(bags[i])}
        phrases = {p: n for p, n, docs in found if len([i for i in docs if toxic[i] and i not in covered]) >= 5}
        told = {i for p, _, docs in found if p in phrases for i in docs}
        place = {w: c for c, w in enumerate(names)}
        inside = np.array(sorted({place[w] for p in phrases for w in p.split()}), dtype=np.int64)
        near_phrases = [" ".join(names[c] for c in words) for words in counted.clean_around(inside, 1000)] if phrases else []
        near_phrases = [p for p in near_phrases if not any(f" {q} " in f" {p} " for q in phrases)]
        near_phrases += sorted({w for p in phrases for w in p.split()} & set(n_good))
        del counted, found

    known = set(proven)
    unsure = [b for i, b in zip(bad_at, bad) if i not in told and known.isdisjoint(b)]
    clean = sorted(n_good)
    count = np.array([n_good[u] for u in clean], dtype=float)
    picked = rng.choice(len(clean), min(len(clean), LANDMARKS // 2), replace=False)
    marks = list(dict.fromkeys([*proven[:LANDMARKS], *list(phrases)[:LANDMARKS], *near_phrases[:LANDMARKS // 2],
                                *ranked[:LANDMARKS // 2], *(clean[i] for i in picked)]))
    padded = {u[:i] + "aeiourstnlxz"[rng.integers(12)] + u[i:]: n / 4
              for u, n in [*((u, n_bad[u]) for u in proven), *phrases.items()] if len(u) > 3
              for i in rng.integers(1, len(u), 3).tolist()}
    columns = np.unique(kernel.features(marks)[1])
    z = kernel.dense(marks, columns).astype(np.float64)
    values, vectors = np.linalg.eigh(z @ z.T)
    some = values > 1e-6 * values.max()
    whiten = z.T @ (vectors[:, some] / np.sqrt(values[some]))  # features -> Nystrom features
    del z, vectors
    negative = set(rng.choice(len(clean), min(len(clean), 4000), replace=False, p=count / count.sum()).tolist())
    witness = [max(b, key=lambda u: (surprise[u], u)) for b in unsure]
    units_bad = sorted({u for b in unsure for u in b})
    place = {u: i for i, u in enumerate(units_bad)}
    for _ in range(ROUNDS):
        pos = Counter({u: n_bad[u] for u in proven})
        pos.update(phrases)
        pos.update(witness)
        pos.update({u: n for u, n in padded.items() if u not in n_good})
        neg = list(dict.fromkeys([u for u in near_phrases if u not in pos] + [clean[i] for i in sorted(negative) if clean[i] not in pos]))
        names = [*pos, *neg]
        x = kernel.mapped(names, columns, whiten)
        y = np.array([1.0] * len(pos) + [-1.0] * len(neg))
        draw = np.ones(len(neg)) + np.isin(neg, near_phrases) * (len(neg) / (4 * max(len(near_phrases), 1)))
        w, bias = _train_linear(x, y, np.concatenate([np.sqrt(list(pos.values())), draw]))
        table = np.zeros(_FEATURES)
        table[columns] = whiten @ w
        got = kernel.values(units_bad, table) + bias
        # Being more frequent in toxic documents speaks for a unit beside its value.
        witness = [max(b, key=lambda u: (got[place[u]] + 0.5 * min(surprise[u], 4.0), u)) for b in unsure]
        hard = kernel.values(clean, table) + bias
        negative |= set(np.argsort(-hard, kind="stable")[:1000].tolist())
    model = ToxicityModel(table, float(bias), 1.0, 0.0, 0.0)
    if phrases:
        model.gate = min(max(kernel.values(p.split(), table)) for p in phrases) + float(bias) - GATE_SLACK
    top, values = np.empty(len(bags)), {}
    for i, b in enumerate(bags):
        words = []
        if phrases:
            own = code[np.searchsorted(doc, i):np.searchsorted(doc, i, side="right")]
            words = [sequences[2][c] if c >= 0 else "" for c in own.tolist()]
        top[i] = unit_values([b], [words], model, kernel, values)[0]
    use = (aside if aside.any() and len(set(toxic[aside])) == 2 else ~aside) & np.isfinite(top)
    model.slope, _ = _logistic(top[use], toxic[use].astype(float), weight[use])
    model.offset = -model.slope * _threshold(top[use], toxic[use], weight[use])
    model.empty = float(1 / (1 + np.exp(-np.clip(model.slope * min(top[np.isfinite(top)].min(), -1.0) + model.offset, -500, 500))))
    return model


@F.arrow_udf(T.ArrayType(T.StringType()))
def _bag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([sorted(units_of(t.as_py())) for t in texts], pa.list_(pa.string()))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _in_order(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([sentence_words(t.as_py()) for t in texts], pa.list_(pa.string()))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
                 max_per_label: int = MAX_PER_LABEL, max_units: int = MAX_TRAIN_UNITS, max_words: int = MAX_TRAIN_WORDS) -> ToxicityModel | None:
    """Train on labelled rows: of each label the ``max_per_label`` with the
    smallest hash of ``key``, while their units stay under ``max_units``; phrases
    are counted in the first of them with at most ``max_words`` words together.
    Labels other than 0 and 1 are not used; an id labelled twice counts as
    toxic if one label says so, an id with several rows once, with the text of
    the smallest hash.  None if nothing is labelled."""
    rank = F.xxhash64(F.col("k").cast("string"))
    marked = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)") \
        .groupBy("k").agg(F.max("y").alias("y"))
    size = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not size:
        return None
    chosen = None
    for y in sorted(size):
        part = marked.where(F.col("y") == y).orderBy(rank, "k").limit(max_per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * max_per_label ids: small whatever the input.
    found = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(chosen), "k")
    # One row per id, of the smallest text hash: copies neither fill the sample nor meet in one task.
    found = found.groupBy("k", "y").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("one")).select("k", "y", F.col("one.t").alias("t"))
    found = stored(found.select("k", "y", rank.alias("r"), _bag("t").alias("bag"), _in_order("t").alias("words")), "toxicity-sample")
    lengths = found.select("r", "k", F.size("bag").alias("n"), F.size("words").alias("m")).orderBy("r", "k").limit(2 * max_per_label).collect()
    fits = np.cumsum([x.n for x in lengths]) <= max_units
    if not fits.any():
        return None

    in_words = int(np.sum(np.cumsum([x.m for x in lengths]) <= max_words))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by([("r", "ascending"), ("k", "ascending")])
        y = rows.column("y").to_numpy().astype(np.int64)
        weight = np.array([size.get(c, 0) for c in (0, 1)]) / np.maximum(np.bincount(y, minlength=2), 1)
        bags, sequences = shared_lists(rows.column("bag")), coded(rows.column("words").slice(0, in_words))
        del rows
        m = train(bags, y == 1, weight[y], sequences=sequences)
        at = np.flatnonzero(m.table)
        yield pa.record_batch([pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([m.table[at]], pa.list_(pa.float64())),
                               *[pa.array([x]) for x in (m.bias, m.slope, m.offset, m.empty, m.gate)]],
                              names=["at", "table", "bias", "slope", "offset", "empty", "gate"])

    # One task trains on the bounded sample; only the model comes to the driver.
    last = lengths[int(np.flatnonzero(fits)[-1])].r
    learned = found.where(F.col("r") <= last).repartition(1).mapInArrow(
        learn, "at array<int>, table array<double>, bias double, slope double, offset double, empty double, gate double").first()
    table = np.zeros(_FEATURES)
    table[learned["at"]] = learned.table
    return ToxicityModel(table, learned.bias, learned.slope, learned.offset, learned.empty, learned.gate)


def shared_lists(column: pa.ChunkedArray) -> list[list[str]]:
    """String lists in which equal strings are one object."""
    lists = column.combine_chunks()
    flat = lists.flatten().dictionary_encode()
    texts = np.array(flat.dictionary.to_pylist(), dtype=object)[flat.indices.to_numpy(zero_copy_only=False)]
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    return [texts[i:j].tolist() for i, j in zip([0, *ends[:-1]], ends)]


def coded(words: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Word lists as codes (-1 for the empty string), the list each word is of,
    and the words by code."""
    words = words.combine_chunks()
    doc = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy(zero_copy_only=False))
    flat = words.flatten().dictionary_encode()
    names = flat.dictionary.to_pylist()
    code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in names:
        code[code == names.index("")] = -1
    return code, doc, names


def unit_values(bags: list, sequences: list[list[str]], model: ToxicityModel, kernel: Kernel, known: dict[str, float]) -> np.ndarray:
    """Each text's highest unit's value (-inf without units): of its bag, and
    with a gate of the phrases in its word sequence too.  ``known`` keeps values."""
    def learn(units: set[str]) -> None:
        fresh = list(units.difference(known))
        known.update(zip(fresh, (kernel.values(fresh, model.table) + model.bias).tolist()))

    if len(known) > KNOWN_UNITS:
        known.clear()
    learn(set().union(*bags))
    gated = [()] * len(bags)
    if np.isfinite(model.gate):
        learn({w for words in sequences for w in words if w})
        gated = [phrases_around(words, lambda w: known[w] >= model.gate) for words in sequences]
        learn({p for found in gated for p in found})
    value = known.__getitem__
    return np.array([max(map(value, (*b, *more) if more else b)) if b else -np.inf for b, more in zip(bags, gated)])


def text_values(texts: list[str], model: ToxicityModel, kernel: Kernel, known: dict[str, float]) -> np.ndarray:
    """Each text's highest unit's value (-inf without units)."""
    sequences = [sentence_words(t) for t in texts] if np.isfinite(model.gate) else [[]] * len(texts)
    return unit_values([units_of(t) for t in texts], sequences, model, kernel, known)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` (a column of the name ``out`` is replaced) with the probability of label 1 in ``out``.  Null and empty
    texts get the lowest value met in training; without a model all get 0."""
    if model is None:
        return docs.withColumn(out, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m, kernel, known = shared.value, Kernel(), {}
        for texts in batches:
            value = np.concatenate([np.zeros(0), *(text_values(texts.slice(i, 500).to_pylist(), m, kernel, known) for i in range(0, len(texts), 500))])
            yield pa.array(m.probability(value))

    return docs.withColumn(out, scored(F.coalesce(F.col(text), F.lit(""))))
