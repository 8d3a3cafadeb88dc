"""BPE encoding and decoding with a pair occurrence index.

The vocabulary file is a public one in the JSON form of the tokenizers
library, of the kind with an end-of-word suffix: NFC, runs of white space to
one space, lower case, a split by pattern, bytes written as printable
characters, then merges.  A merge never crosses a split piece, so each
distinct piece of a batch is encoded once.

All distinct pieces lie in one array of symbols with links to the neighbours.
The index maps each active pair to all its positions.  Pairs are applied in
ascending rank: every occurrence is merged (from left to right where they
overlap), and the lists of the pairs that arise at the merged symbols are
extended; positions whose symbols have changed since are skipped.  This is the
order in which each piece by itself would be merged.
"""

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Regex, Tokenizer, pre_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KNOWN_PIECES = 250_000  # pieces that a task remembers from batch to batch
NEW_PIECES = 100_000    # pieces that are encoded together


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, the others from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _lower(text: str) -> str:
    """Lower case character by character: a capital sigma gives the same small
    one wherever it stands."""
    return text.replace("\u03a3", "\u03c3").lower()


@dataclass
class Vocabulary:
    pattern: regex.Pattern
    special: dict[str, int]
    first: np.ndarray      # by byte: the id of its character inside a piece
    last: np.ndarray       # ... at the end of a piece
    keys: np.ndarray       # pairs (left << 32 | right), ascending
    ranks: np.ndarray
    merged: np.ndarray     # by rank: the id that replaces the pair
    left: np.ndarray       # by rank
    right: np.ndarray
    plain: dict[int, str]  # by id: what decoding gives


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, suffix = model["vocab"], model["end_of_word_suffix"]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None or model["unk_token"] is not None:
        raise ValueError(f"{path}: not a vocabulary of the supported form")
    split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
    right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
    merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
    keys = left << 32 | right
    order = np.argsort(keys, kind="stable")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    chars = byte_characters()
    return Vocabulary(regex.compile(split), special, np.array([vocab[c] for c in chars]), np.array([vocab[c + suffix] for c in chars]),
                      keys[order], order, merged, left, right, {i: t for t, i in [*vocab.items(), *special.items()]})


def encode_pieces(pieces: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces (UTF-8, not empty), all merged together, in one
    array, and where in it each piece ends."""
    if not pieces:
        return np.array([], dtype=np.int64), np.array([], dtype=np.int64)
    size = np.array([len(p) for p in pieces])
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    sym = v.first[data].astype(np.int64)
    sym[ends - 1] = v.last[data[ends - 1]]
    n = len(sym)
    after = np.arange(1, n + 1)
    after[ends - 1] = -1
    before = np.arange(-1, n - 1)
    before[ends - size] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def extend(places: np.ndarray) -> None:
        """Enter the pairs that begin at ``places``."""
        key = sym[places] << 32 | sym[after[places]]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        known = v.keys[at] == key
        rank, places = v.ranks[at[known]], places[known]
        order = np.argsort(rank, kind="stable")
        rank, places = rank[order], places[order]
        cuts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)] if len(rank) else [0]
        for r, i, j in zip(rank[cuts[:-1]].tolist(), cuts, cuts[1:]):
            if r not in index:
                index[r] = []
                heapq.heappush(active, r)
            index[r].append(places[i:j])

    if len(v.keys):
        extend(np.flatnonzero(after >= 0))
    while active:
        rank = heapq.heappop(active)
        found = index.pop(rank)
        at = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
        a, b = v.left[rank], v.right[rank]
        nxt = after[at]
        good = (sym[at] == a) & (nxt >= 0)
        good &= sym[nxt] == b  # where nxt is -1, good is false already
        at = at[good]
        if a == b and len(at) > 1:
            follows = after[at[:-1]] == at[1:]
            if follows.any():  # in a run of equal symbols every other one begins a pair
                start = np.concatenate([[True], ~follows])
                begin = np.flatnonzero(start)
                at = at[(np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        sym[at] = v.merged[rank]
        sym[gone] = -1
        nn = after[gone]
        after[at] = nn
        tail = nn >= 0
        before[nn[tail]] = at[tail]
        prev = before[at]
        extend(np.unique(np.concatenate([prev[prev >= 0], at[tail]])))
    alive = np.flatnonzero(sym >= 0)
    return sym[alive], np.searchsorted(alive, ends)


class Encoder:
    """Encodes texts; remembers distinct pieces between batches."""

    def __init__(self, path: str):
        self.v = load(path)
        self.ids: dict[str, str] = {}    # by known piece: its ids, joined by a space
        self.plain: dict[str, str] = {}  # ... and what decoding gives for it
        self.marks = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.v.special, key=len, reverse=True)) + ")") if self.v.special else None
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.letter, self.digit = [pre_tokenizers.Split(Regex(c), "removed") for c in (r"\p{L}", r"\p{N}")]
        self.seen: set[str] = set()      # characters met so far
        self.later: dict[int, str] = {}  # those without a category in Python's version of Unicode, with one that stands for their class
        self.odd: set[str] = set()       # these, and marks that combine

    def pieces(self, text: str) -> list[str]:
        """The split pieces of a text; special tokens come as they are."""
        if not any(s in text for s in self.v.special):
            return self.split(text)
        out = []
        for part in self.marks.split(text):
            if part in self.v.special:
                out.append(part)
            elif part:
                out += self.split(part)
        return out

    def split(self, text: str) -> list[str]:
        """The matches of the split pattern in the normalised text.  No match
        holds white space, so its runs need not be replaced before.

        The tokenizers library follows other versions of Unicode than Python
        and the regex package.  A text that composing could change, or with
        characters that Python does not know, is normalised by the library's
        own normaliser; such characters match as what the library takes them
        for.
        """
        if text.isascii():
            return self.v.pattern.findall(text.lower())
        self.meet(text)
        if self.odd.isdisjoint(text) and unicodedata.is_normalized("NFC", text):
            return self.v.pattern.findall(_lower(text))
        text = self.normalizer.normalize_str(text)
        self.meet(text)
        if self.odd.isdisjoint(text):
            return self.v.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.v.pattern.finditer(text.translate(self.later))]

    def meet(self, text: str) -> None:
        fresh = set(text) - self.seen
        self.seen |= fresh
        self.odd |= {c for c in fresh if unicodedata.category(c) == "Cn" or unicodedata.combining(c)}
        for c in fresh:
            if unicodedata.category(c) == "Cn":
                self.later[ord(c)] = "\u4e00" if not self.letter.pre_tokenize_str(c) else "\u0663" if not self.digit.pre_tokenize_str(c) else "\ue000"

    def learn(self, pieces: set[str]) -> None:
        fresh = list(pieces - self.ids.keys())
        if len(self.ids) + len(fresh) > KNOWN_PIECES:
            kept = pieces & self.ids.keys()
            self.ids, self.plain = [{p: known[p] for p in kept} for known in (self.ids, self.plain)]
        for special in self.v.special.keys() & fresh:
            self.ids[special], self.plain[special] = str(self.v.special[special]), special
        fresh = [p for p in fresh if p not in self.v.special]
        for i in range(0, len(fresh), NEW_PIECES):
            some = fresh[i:i + NEW_PIECES]
            ids, ends = encode_pieces([p.encode() for p in some], self.v)
            ids, ends = ids.tolist(), ends.tolist()
            listed, plain = list(map(str, ids)), [self.v.plain[x] for x in ids]
            for piece, b, e in zip(some, [0, *ends], ends):
                self.ids[piece], self.plain[piece] = " ".join(listed[b:e]), " ".join(plain[b:e])

    def encode(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Per text the number of ids, the ids as text, and the decoded text."""
        split = [self.pieces(t) for t in texts]
        self.learn(set().union(*split))
        ids = [" ".join(map(self.ids.__getitem__, one)) for one in split]
        plain = [" ".join(map(self.plain.__getitem__, one)) for one in split]
        return [x.count(" ") + 1 if x else 0 for x in ids], ids, plain


def _chunks(texts: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about ``limit`` characters together."""
    start, size, out = 0, 0, []
    for i, t in enumerate(texts):
        t = t.as_py() or ""
        out.append(t)
        size += len(t)
        if size >= limit:
            yield start, out
            start, size, out = i + 1, 0, []
    if out:
        yield start, out


def encode_documents(docs: DataFrame, path: str, text: str = "text", out: str = "bpe", with_ids: bool = True) -> DataFrame:
    """``docs`` (a column of the name ``out`` is replaced) with a struct column ``out``: n_tokens, ids_sha256 (of the
    decimal ids joined by one space), decoded_sha256 and, with ``with_ids``,
    ids (array<int>).  A null text counts as empty: no ids."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    @F.arrow_udf(T.StructType(fields))
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = Encoder(path)
        for texts in batches:
            columns: list[list] = [[] for _ in fields]
            for _, some in _chunks(texts):
                n, ids, plain = enc.encode(some)
                columns[0] += n
                columns[1] += [hashlib.sha256(x.encode()).hexdigest() for x in ids]
                columns[2] += [hashlib.sha256(x.encode()).hexdigest() for x in plain]
                if with_ids:
                    columns[3] += [np.array(x.split(), dtype=np.int32) for x in ids]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.name for f in fields])

    return docs.withColumn(out, encoded(F.coalesce(F.col(text), F.lit(""))))
