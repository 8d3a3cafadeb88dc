"""Quality classifier on supervised subword embeddings.

A document's features are its words, neighbouring word pairs, a mark for every
word that repeats the one before it, and all byte n-grams of lengths 3 to 5;
each is hashed to one of ``BUCKETS`` learned vectors.  The mean vector of the
features goes through a linear layer and a softmax over the two labels.  Numpy
stochastic gradient descent trains vectors and layer on a bounded sample of
labelled rows.

With two labels the softmax depends on the difference of the layer's columns
only, so scoring looks up one number per bucket (vector times difference) and
averages these: the same value as averaging the vectors first.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.llm.common import WordHash, mix, segments, stored, utf8, word_spans

BUCKETS = 1 << 15
DIM = 16
GRAMS = (3, 4, 5)
KEEP_SCORE = 0.7
MAX_PER_LABEL = 2000       # documents of each label that training uses
MAX_TRAIN_ENTRIES = 16_000_000  # their (bucket, count) pairs

_BUCKET, _TOP = np.uint64(BUCKETS - 1), np.uint64(65 - BUCKETS.bit_length())
_PAIR, _REPEAT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)


def _blocks(texts: pa.Array, hashes: WordHash):
    """Per block of segments: their rows, and a list of (starts, ends, buckets)
    where buckets[start:end] are the features of a segment."""
    data, off = utf8(texts)
    for block in segments(data, off):
        rows = np.array([b[0] for b in block])
        size = np.array([e - s for _, s, e in block])
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        buf = np.frombuffer(b" ".join(data[s:e] for _, s, e in block) + b" ", dtype=np.uint8)
        first, last = word_spans(buf)
        h = hashes.spans(buf, first, last)
        lo, hi = np.searchsorted(first, starts), np.searchsorted(first, ends)
        pair = mix(h[:-1] * _PAIR + h[1:])
        pair[h[:-1] == h[1:]] = _REPEAT
        found = [(lo, hi, (h & _BUCKET).astype(np.int32)), (lo, np.maximum(hi - 1, lo), (pair & _BUCKET).astype(np.int32))]
        roll = buf.astype(np.uint64)
        for n in range(2, max(GRAMS) + 1):
            roll = (roll[:-1] << np.uint64(8)) | buf[n - 1:]
            if n in GRAMS:
                found.append((starts, np.maximum(ends - n + 1, starts), ((roll * _PAIR) >> _TOP).astype(np.int32)))
        # A segment shorter than a feature has none; its places may lie beyond the list.
        yield rows, [(np.minimum(s, len(b)), np.minimum(e, len(b)), b) for s, e, b in found]


@F.arrow_udf(T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]))
def _features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    hashes = WordHash()
    for texts in batches:
        ids = [np.zeros(0, dtype=np.int32)] * len(texts)
        counts = list(ids)
        row, open_counts = -1, None  # the last row of a block may go on in the next
        for rows, found in _blocks(texts, hashes):
            for i, at in enumerate(rows.tolist()):
                one = np.bincount(np.concatenate([bucket[s[i]:e[i]] for s, e, bucket in found]), minlength=BUCKETS)
                open_counts = open_counts + one if at == row else one
                row = at
                ids[at] = np.flatnonzero(open_counts).astype(np.int32)
                counts[at] = open_counts[ids[at]].astype(np.int32)
        yield pa.StructArray.from_arrays([pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], ["ids", "counts"])


@dataclass
class QualityModel:
    weights: np.ndarray  # per bucket: its vector times the difference of the layer's columns
    bias: float

    def score(self, texts: pa.Array, hashes: WordHash) -> np.ndarray:
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        for rows, found in _blocks(texts, hashes):
            for starts, ends, bucket in found:
                run = np.concatenate([[0.0], np.cumsum(self.weights[bucket], dtype=np.float64)])
                np.add.at(total, rows, run[ends] - run[starts])
                np.add.at(n, rows, ends - starts)
        return 1.0 / (1.0 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -500, 500)))


def train(ids: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, dim: int = DIM,
          epochs: int = 6, rate: float = 0.25, seed: int = 1) -> QualityModel:
    """Stochastic gradient descent, a document a step.  The step on the
    vectors is divided by the squared length of the document's feature shares,
    so long and short documents move the score alike."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    layer = rng.normal(0, 1 / np.sqrt(dim), (dim, 2)).astype(np.float32)
    p = np.clip(weights[labels == 1].sum() / max(weights.sum(), 1e-9), 0.01, 0.99)
    bias = np.array([np.log(1 - p), np.log(p)])
    shares = [c.astype(np.float32) / max(1, c.sum()) for c in counts]
    total = epochs * len(ids)
    for step, i in enumerate(np.concatenate([rng.permutation(len(ids)) for _ in range(epochs)]) if total else []):
        lr = rate * (1 - step / total)
        share, at = shares[i], ids[i]
        mean = share @ vectors[at] if len(at) else np.zeros(dim, dtype=np.float32)
        z = mean @ layer + bias
        out = np.exp(z - z.max())
        out /= out.sum()
        out[labels[i]] -= 1.0
        out = (out * weights[i]).astype(np.float32)
        back = layer @ out
        layer -= lr * np.outer(mean, out)
        bias -= 0.1 * lr * out
        if len(at):
            vectors[at] -= np.outer(share * (lr / float(share @ share)), back)
    return QualityModel((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
                max_per_label: int = MAX_PER_LABEL, max_entries: int = MAX_TRAIN_ENTRIES) -> QualityModel | None:
    """Train on labelled rows: of each label the ``max_per_label`` with the
    smallest hash of ``key``, while their features stay under ``max_entries``.
    Weights restore the labels' shares.  Labels other than 0 and 1 are not
    used; an id labelled twice counts with its largest label, an id with several
    rows once, with the text of the smallest hash.  None if there
    is nothing to learn from."""
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
    found = stored(found.withColumn("f", _features("t")).select("k", "y", rank.alias("r"), F.col("f.ids").alias("ids"),
                                                                  F.col("f.counts").alias("counts")), "quality-sample")
    lengths = found.select("r", "k", F.size("ids").alias("n")).orderBy("r", "k").limit(2 * max_per_label).collect()
    fits = np.cumsum([x.n for x in lengths]) <= max_entries
    if not fits.any():
        return None
    last = lengths[int(np.flatnonzero(fits)[-1])].r

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by([("r", "ascending"), ("k", "ascending")])
        y = rows.column("y").to_numpy().astype(np.int64)
        used = np.bincount(y, minlength=2)
        weight = np.array([size.get(c, 0) / max(1, used[c]) for c in (0, 1)])
        weight *= len(y) / max(1e-9, (weight * used).sum())
        model = train([x.values.to_numpy() for x in rows.column("ids")], [x.values.to_numpy() for x in rows.column("counts")], y, weight[y])
        yield pa.record_batch([pa.array([model.weights], pa.list_(pa.float32())), pa.array([model.bias])], names=["weights", "bias"])

    # One task trains on the bounded sample; only the model comes to the driver.
    learned = found.where(F.col("r") <= last).repartition(1).mapInArrow(learn, "weights array<float>, bias double").first()
    return QualityModel(np.array(learned.weights, dtype=np.float32), learned.bias)


def score_quality(docs: DataFrame, model: QualityModel | None, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` (a column of the name ``out`` is replaced) with the probability of label 1 in ``out``.  Null and empty
    texts have no feature and get the learned bias alone; without a model
    every score is 0.5."""
    if model is None:
        return docs.withColumn(out, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHash()
        for texts in batches:
            yield pa.array(shared.value.score(texts, hashes))

    return docs.withColumn(out, scored(F.coalesce(F.col(text), F.lit(""))))
