"""Alignment of two tokenizers by pointer jumping.

Token A is a byte-level BPE over space + text, token B a piece BPE over the
text (it adds the space itself).  Both cut the same bytes, so tokens of the
two overlap, and the byte offsets where both end a token cut the text into
groups: the connected components of the overlaps.  Every token points to the
farthest-right token of the other side that it overlaps; following pointers
ends at the token that ends with its group.  Doubling all pointers at once
(next = next[next]) reaches these terminals in a logarithm of the longest
chain, for all tokens of a block together; the terminal labels the group.

Neither tokenizer joins characters over a space between two other characters,
so texts are cut at such spaces into units, and each distinct unit that a task
does not know yet is tokenised and aligned once; both sides end a token before
such a space.  A document's figures are sums over its units.

How often each pair of ids overlaps is counted over the corpus with a grouped
sum.  Documents keep their distinct pairs; the counts come back to them as a
broadcast table while it has at most ``LOOKUP`` pairs, and by a join beyond.
"""

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpline.llm.common import stored

LOOKUP = 4_000_000     # pairs of a table that is broadcast: 64 MB
KNOWN_UNITS = 250_000  # aligned units that a task keeps, but for those of the last block
KNOWN_CHARS = 64       # longest unit that is kept
BLOCK_CHARS = 1 << 18  # text that is aligned at a time

# A space between two characters neither of which is white space, and a space beside white space.
_BREAK = re.compile(r"(?<=\S) (?=\S)")
_NO_BREAK = re.compile(r" \s|\s ")


@lru_cache(maxsize=4)
def _loaded(a_path: str, b_path: str):
    return Tokenizers(a_path, b_path)


def _byte_level() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others
    as the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = _byte_level()
        with open(a_path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(chars[c] for c in entry) if all(c in chars for c in entry) else entry.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.a_size, self.b_size = (np.array([len(x) for x in y], dtype=np.int64) for y in (self.a_bytes, self.b_bytes))
        # Every id as text with "," after it, and with the mark that ends its side of a group.
        self.a_text, self.b_text = (np.array([b"%d%s" % (t, mark) for mark in (b",", end) for t in range(len(x))], dtype=object)
                                    for x, end in ((self.a_bytes, b"|"), (self.b_bytes, b";")))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for space + text; None where a side's bytes differ from that."""
        # The fast form leaves out the offsets of tokens.
        a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
        whole = b" " + text.encode("utf-8", "surrogatepass")
        if not text or b"".join([self.a_bytes[t] for t in a]) != whole or b"".join([self.b_bytes[t] for t in b]) != whole:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def groups_of(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers (from 0, ascending) of both sides' tokens, given the
    ascending ends of tokens that cover the same bytes."""
    na = len(a_end)
    last_b = np.searchsorted(b_end, a_end)  # the B token that holds A's last byte
    last_a = np.searchsorted(a_end, b_end)
    # Tokens are numbered A first; one that ends where its farthest partner ends is last of
    # its group: the A token is the terminal, the B token points to it.
    a_next = np.where(b_end[last_b] > a_end, na + last_b, np.arange(na))
    step = np.concatenate([a_next, last_a])
    while True:
        twice = step[step]
        if np.array_equal(twice, step):
            break
        step = twice
    _, label = np.unique(step, return_inverse=True)
    return label[:na], label[na:]


# A unit's answer: how many tokens of A and B and how many groups it has; its
# groups as text; its overlapping pairs, as bytes.
Aligned = tuple[int, int, int, bytes, bytes]


def align(both: Tokenizers, units: list[str]) -> list[Aligned | None]:
    """Aligns ``units``; None where a side's bytes are not space + unit.
    Units without white space at their ends are tokenised in one text, which
    both sides cut between them; if that is not given back, each by itself."""
    out: list[Aligned | None] = [None] * len(units)
    plain = [i for i, u in enumerate(units) if u and u == u.strip()]
    ids = both.encode(" ".join([units[i] for i in plain])) if len(plain) > 1 else None
    if ids is not None:
        for i, x in zip(plain, _aligned(both, *ids, [len(units[i].encode()) + 1 for i in plain])):
            out[i] = x
        plain = set(plain)
    else:
        plain = ()
    for i, u in enumerate(units):
        if i not in plain and (ids := both.encode(u)) is not None:
            out[i] = _aligned(both, *ids, [len(u.encode()) + 1])[0]
    return out


def _aligned(both: Tokenizers, a: np.ndarray, b: np.ndarray, sizes: list[int]) -> list[Aligned]:
    """Answers of units of these sizes in bytes, whose tokens follow each other."""
    a_end, b_end, unit_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b]), np.cumsum(sizes)
    a_group, b_group = groups_of(a_end, b_end)
    first = np.searchsorted(b_end, a_end - both.a_size[a], side="right")
    wide = np.searchsorted(b_end, a_end) - first + 1  # B tokens that each A token overlaps
    begin = np.concatenate([[0], np.cumsum(wide)])
    partner = np.repeat(first - begin[:-1], wide) + np.arange(begin[-1])
    pairs = (np.repeat(a, wide) * len(both.b_bytes) + b[partner]).tobytes()
    # Text: within a group the A ids, then the B ids; "," between, "|" after A's, ";" after B's.
    a_last, b_last = np.append(a_group[1:] != a_group[:-1], True), np.append(b_group[1:] != b_group[:-1], True)
    words = np.empty(len(a) + len(b), dtype=object)
    words[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = both.a_text[a + a_last * len(both.a_bytes)]
    words[np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")] = both.b_text[b + b_last * len(both.b_bytes)]
    words = words.tolist()
    to_a, to_b = np.searchsorted(a_end, unit_end) + 1, np.searchsorted(b_end, unit_end) + 1
    groups = a_group[to_a - 1] + 1
    ends = zip(to_a.tolist(), to_b.tolist(), groups.tolist(), begin[to_a].tolist())
    out, s, t, g, p = [], 0, 0, 0, 0
    for e, f, h, q in ends:
        out.append((e - s, f - t, h - g, b"".join(words[s + t:e + f])[:-1], pairs[8 * p:8 * q]))
        s, t, g, p = e, f, h, q
    return out


class _Sums:
    """What a document's units add up to; a unit that is not given back leaves it without tokens."""

    def __init__(self):
        self.n_a, self.n_b, self.groups, self.links, self.pairs, self.digest, self.ok = 0, 0, 0, 0, [], hashlib.sha256(), True

    def add(self, units: list[Aligned | None]) -> None:
        self.ok = self.ok and None not in units
        if self.ok:
            n_a, n_b, groups, text, pairs = zip(*units)
            if self.pairs:
                self.digest.update(b";")
            self.digest.update(b";".join(text))
            pairs = np.frombuffer(b"".join(pairs), dtype=np.int64)
            self.n_a, self.n_b, self.groups = self.n_a + sum(n_a), self.n_b + sum(n_b), self.groups + sum(groups)
            self.links += len(pairs)
            self.pairs.append(np.unique(pairs, return_counts=True))

    def row(self) -> tuple:
        if not self.ok or not self.pairs:
            return 0, 0, 0, 0, "", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        kinds, times = self.pairs[0]
        if len(self.pairs) > 1:
            kinds, at = np.unique(np.concatenate([k for k, _ in self.pairs]), return_inverse=True)
            times = np.bincount(at, weights=np.concatenate([t for _, t in self.pairs]))
        return self.n_a, self.n_b, self.groups, self.links, self.digest.hexdigest(), kinds, times.astype(np.int32)


def _units(text: str) -> list[str]:
    """``text`` cut at its breaks."""
    return text.split(" ") if text[0] != " " != text[-1] and not _NO_BREAK.search(text) else _BREAK.split(text)


class _Known:
    """Answers of units, in a newer and an older part.  When the newer is full
    the older one goes, but for what has been met again since."""

    def __init__(self):
        self.new: dict[str, Aligned | None] = {}
        self.old: dict[str, Aligned | None] = {}

    def learn(self, both: Tokenizers, units: set[str]) -> list[str]:
        """Puts the answers of all ``units`` into ``new``; returns those tokenised now."""
        missing = units.difference(self.new)
        again = [u for u in missing if u in self.old]
        self.new.update((u, self.old[u]) for u in again)
        fresh = list(missing.difference(again))
        self.new.update(zip(fresh, align(both, fresh)))
        return fresh

    def trim(self, fresh: list[str]) -> None:
        """Lets go of what is not kept: long units, and those that are not given back."""
        for u in fresh:
            if len(u) > KNOWN_CHARS or not self.new[u]:
                del self.new[u]
        if len(self.new) > KNOWN_UNITS // 2:
            self.old, self.new = self.new, {}


def _blocks(texts: pa.Array) -> Iterator[list[tuple[int, list[str]]]]:
    """Lists of (row, units), about ``BLOCK_CHARS`` characters a list; a
    longer text goes over several."""
    block, size = [], 0
    for row, text in enumerate(texts.to_pylist()):
        at = 0
        while text and at < len(text):
            cut = _BREAK.search(text, at + BLOCK_CHARS)
            piece = text[at:cut.start()] if cut else text[at:]
            at = cut.end() if cut else len(text)
            block.append((row, _units(piece)))
            size += len(piece)
            if size >= BLOCK_CHARS:
                yield block
                block, size = [], 0
    if block:
        yield block


_RESULT = "doc_id {key}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"


def aligned_documents(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of
    each row: its distinct overlapping pairs (id A * B's vocabulary + id B)
    and how often each occurs.  Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, known = _loaded(a_path, b_path), _Known()
        for batch in batches:
            rows = [_Sums() for _ in range(len(batch))]
            for block in _blocks(batch.column("t")):
                fresh = known.learn(both, set().union(*(units for _, units in block)))
                for row, units in block:
                    rows[row].add([known.new[u] for u in units])
                known.trim(fresh)
            cols = list(zip(*(r.row() for r in rows))) or [()] * 7
            yield pa.record_batch([batch.column("k"), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                                   pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int32()))],
                                  names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return stored(rows.mapInArrow(run, _RESULT.format(key=dict(rows.dtypes)["k"])), "align-documents")


def pair_counts(aligned: DataFrame, b_ids: int) -> DataFrame:
    """(pair, n, best) over all documents: overlaps that hold the pair, and
    whether no pair with the same B id has more.  At most as many rows as the
    vocabularies have pairs, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            kinds, at = np.unique(pairs, return_inverse=True)
            yield pa.record_batch([pa.array(kinds, pa.int64()), pa.array(np.bincount(at, weights=times, minlength=len(kinds)).astype(np.int64))],
                                  names=["pair", "n"])

    counts = aligned.select("pairs", "times").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(counts, "align-counts").withColumn("b", F.col("pair") % b_ids)
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return stored(counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "align-pairs")


def _looked_up(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum from a broadcast table."""
    table = counts.toArrow().sort_by("pair")
    shared = aligned.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    @F.arrow_udf("n_best bigint, count_sum bigint")
    def sums(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pair, n, best = shared.value
        for pairs, times in batches:
            off = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())]).astype(np.int64)
            at, m = np.searchsorted(pair, pairs.flatten().to_numpy()), times.flatten().to_numpy().astype(np.int64)
            out = [np.concatenate([[0], np.cumsum(m * x[at])]) for x in (best, n)]
            yield pa.StructArray.from_arrays([pa.array(x[off[1:]] - x[off[:-1]], pa.int64()) for x in out], ["n_best", "count_sum"])

    return aligned.withColumn("x", sums("pairs", "times")).select("*", "x.n_best", "x.count_sum").drop("x", "pairs", "times")


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum by a join: rows carry a number fixed by writing,
    since ids may repeat or be null."""
    numbered = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "align-numbered")
    wide = numbered.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
    sums = wide.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("n_best"),
                                                        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return numbered.drop("pairs", "times").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"]).drop("row")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", lookup: int = LOOKUP) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256).

    Null and empty texts, and texts that a tokenizer does not give back byte
    by byte, have no tokens: zeros and '' for the digest.  Repeated rows count
    each, here and in the corpus.  Other columns are not read.  A unit without
    a usable space is tokenised whole, however long it is."""
    aligned = aligned_documents(docs, a_path, b_path, key, text)
    counts = pair_counts(aligned, len(_loaded(a_path, b_path).b_bytes))
    done = _looked_up(aligned, counts) if counts.count() <= lookup else _joined(aligned, counts)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
