"""Ranked lexical search with the roles of queries and documents reversed.

The items to search for are few and known beforehand; the documents are many.
So the inverted index is built over the items' terms and broadcast, and the
documents stream through it once: a document's term counts are looked up, its
score for every item is added up, and each task keeps a bounded heap of the
best documents per item.  The heaps are merged per item at the end.

Two passes read the texts: the first takes the corpus figures (documents,
terms, document frequency of the items' terms), the second scores.  All of it
is integer arithmetic but the logarithm of a weight; scores stay below 2**53, so
the float64 matrix product that adds up a block of documents is exact (items
of over ``EXACT_TERMS`` terms are added up in integers).

Items are taken in blocks whose table of terms by items has at most
``BLOCK_CELLS`` cells, so the index that is sent has a fixed size; more items
mean more passes.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pumpline.llm.common import KeyIndex, WordHash, segments, utf8

TOP = 20
BLOCK_CELLS = 1 << 23
EXACT_TERMS = 400_000   # term occurrences of an item whose score stays below 2**53
SCORED_DOCS = 512       # documents whose scores are held at once

TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IS_TERM = np.ones(256, dtype=bool)
for _first, _last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    IS_TERM[_first:_last + 1] = False


def term_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end places of the terms in a byte array."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = IS_TERM[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def text_terms(texts: pa.Array, hashes: WordHash) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per block of texts (row, hash) of every term occurrence, rows ascending.
    Texts are cut at white space only, which is never inside a term."""
    data, off = utf8(texts)
    for block in segments(data, off):
        size = np.array([e - s for _, s, e in block])
        ends = np.cumsum(size + 1)
        buf = np.frombuffer(b" ".join(data[s:e] for _, s, e in block).lower() + b" ", dtype=np.uint8)
        first, last = term_spans(buf)
        yield np.array([r for r, _, _ in block])[np.searchsorted(ends, first, side="right")], hashes.spans(buf, first, last)


@dataclass
class Items:
    """The inverted index over a block of items: ``counts[t, i]`` is how often
    item i holds term t."""
    ids: np.ndarray
    keys: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list) -> "Items":
        row, term = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for r, h in text_terms(pa.array(texts, pa.string()), WordHash()):
            row.append(r)
            term.append(h)
        keys, at = np.unique(np.concatenate(term), return_inverse=True)
        counts = np.zeros((len(keys), len(ids)), dtype=np.float32)
        np.add.at(counts, (at, np.concatenate(row)), 1)
        return cls(np.array(ids, dtype=np.int64), keys, counts)


def _hits(texts: pa.Array, hashes: WordHash, index: KeyIndex, width: int):
    """(n, row, term, tf): the terms of every row, and how often each row
    holds each known term, by ascending row."""
    n = np.zeros(len(texts), dtype=np.int64)
    cells = []
    for rows, terms in text_terms(texts, hashes):
        n += np.bincount(rows, minlength=len(n))
        at = index.find(terms)
        some = at >= 0
        cells.append(np.unique(rows[some] * np.int64(width) + at[some], return_counts=True))
    if not cells:
        return n, *(np.zeros(0, dtype=np.int64),) * 3
    cell = np.concatenate([c for c, _ in cells])
    tf = np.concatenate([c for _, c in cells])
    cell, back = np.unique(cell, return_inverse=True)  # a long text goes over several blocks
    return n, cell // width, cell % width, np.bincount(back, weights=tf, minlength=len(cell)).astype(np.int64)


def corpus_figures(docs: DataFrame, items: Items, text: str = "text") -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of each term of ``items``."""
    shared = docs.sparkSession.sparkContext.broadcast(items.keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, index = WordHash(), KeyIndex(shared.value)
        width = len(shared.value) + 2
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            n, _, term, _ = _hits(batch.column(0), hashes, index, width)
            total += np.bincount(term, minlength=width)
            total[-2:] += (n > 0).sum(), n.sum()
        yield pa.record_batch([pa.array(np.arange(width)), pa.array(total)], names=["term", "n"])

    found = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(run, "term bigint, n bigint") \
        .where("n > 0").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(items.keys) + 2, dtype=np.int64)
    total[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return int(total[-2]), int(total[-1]), total[:-2]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


class Heaps:
    """The ``k`` best (score, id) of each item; equal scores by smaller id,
    null ids (the largest number) last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, dtype=np.int64)
        self.best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in range(items)]

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        """``score``: documents by items."""
        good = score >= self.floor
        for i in np.flatnonzero(good.any(0)):
            at = np.flatnonzero(good[:, i])
            s, d = np.concatenate([self.best[i][0], score[at, i]]), np.concatenate([self.best[i][1], ids[at]])
            top = np.lexsort((d, -s))[:self.k]
            self.best[i] = s[top], d[top]
            if len(top) == self.k:
                self.floor[i] = s[top[-1]]


_NO_ID = np.iinfo(np.int64).max


def _best_of_block(docs: DataFrame, items: Items, key: str, text: str, k: int) -> DataFrame:
    """(item_id, doc_id, score): the k best documents of each task and item."""
    n_docs, n_terms, df = corpus_figures(docs, items, text)
    shared = docs.sparkSession.sparkContext.broadcast((items, weights(n_docs, df)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        hashes, index, heaps = WordHash(), KeyIndex(items.keys), Heaps(len(items.ids), k)
        width = len(items.keys)
        exact = np.float64 if items.counts.sum(0).max(initial=0) <= EXACT_TERMS else np.int64
        for batch in batches:
            ids = batch.column("k").fill_null(_NO_ID).to_numpy()
            n, row, term, tf = _hits(batch.column("t"), hashes, index, width)
            m = 75 + (25 * n * n_docs) // max(n_terms, 1)
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
            for start in range(0, len(ids), SCORED_DOCS):
                lo, hi = np.searchsorted(row, [start, start + SCORED_DOCS])
                if lo == hi:
                    continue
                used, at = np.unique(term[lo:hi], return_inverse=True)
                docs_here, place = np.unique(row[lo:hi], return_inverse=True)
                cells = np.zeros((len(docs_here), len(used)))
                cells[place, at] = part[lo:hi]
                heaps.add((cells.astype(exact) @ items.counts[used].astype(exact)).astype(np.int64), ids[docs_here])
        out = [(i, s, d) for i, (s, d) in enumerate(heaps.best) if len(s)]
        if out:
            score, found = np.concatenate([s for _, s, _ in out]), np.concatenate([d for _, _, d in out])
            item = np.repeat(items.ids[[i for i, _, _ in out]], [len(s) for _, s, _ in out])
            yield pa.record_batch([pa.array(item), pa.array(found, mask=found == _NO_ID), pa.array(score)], names=["item_id", key, "score"])

    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"item_id bigint, {key} bigint, score bigint")


def item_blocks(items: DataFrame, item: str, text: str, most: int = BLOCK_CELLS) -> Iterator[tuple[list, list]]:
    """Items in blocks of bounded size, by ascending id; an item larger than
    a block is a block of its own.  Rows come to the driver one after another."""
    ids, texts, size = [], [], 0
    for r in items.select(F.col(item).cast("bigint").alias("i"), F.col(text).alias("t")).where("i is not null").orderBy("i", "t").toLocalIterator():
        terms = len(r.t or "") // 2 + 1  # at most
        if ids and (len(ids) + 1) * (size + terms) > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.i)
        texts.append(r.t or "")
        size += terms
    if ids:
        yield ids, texts


def ranked_search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", k: int = TOP, most_cells: int = BLOCK_CELLS) -> DataFrame:
    """(item_id, rank, ``key``, score): the ``k`` documents of each item that
    score highest, above 0; equal scores by ascending ``key``, null keys last.

    Null and empty texts hold no term: such documents are found by no item and
    count only where the figures say so, such items find nothing.  Every row
    of ``docs`` is a document of its own, also under a repeated or null key;
    rows of ``items`` with one id and the same text are one item, with several
    texts each is searched and ranked under the id together.  Items without an
    id are left out.  Other columns are not read.
    """
    found = None
    for ids, texts in item_blocks(items.dropDuplicates([item, item_text]), item, item_text, most_cells):
        part = _best_of_block(docs, Items.of(ids, texts), key, text, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"item_id bigint, rank int, {key} bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col(key).asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", key, "score")


OP13_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{TERM_PATTERN}') AS terms FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '{TERM_PATTERN}')) AS term FROM benchmark),
c AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS terms FROM d),
m AS (SELECT doc_id, 100 - 25 + (25 * len(d.terms) * c.docs) // c.terms AS m FROM d, c WHERE len(d.terms) > 0),
f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * c.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, c WHERE term IN (SELECT term FROM i) GROUP BY term, c.docs),
s AS (SELECT item_id, f.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {TOP}"""
