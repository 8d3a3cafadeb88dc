"""Language-model scoring with a log-bilinear model trained by noise contrast.

Tokens are lower-cased (A-Z) words and one end per text.  The model predicts a
token's class from the class of the token before it (the end before a first
word): the ``WORDS`` most frequent training words, the end, and ``BUCKETS``
buckets of all other words by their last three bytes are the classes.  Class j after class i
scores r_i C . q_j + b_j, a product of learned vectors through a matrix.

Training gathers, over all training texts, how often every class follows every
other (a table of fixed size, summed by Spark), which is all that the model's
noise-contrastive objective needs: real successors against successors drawn
from the class frequencies.  With the whole noise distribution at hand its
expectation is summed exactly instead of sampled.  Numpy takes
gradient steps on batches of contexts.  One batched matrix product gives the
scores of all successors of all contexts, and a log-sum-exp their normalised
log-probabilities.

A word of a bucket has, within it, the probability (c + 1) / (N + V + 1) of
its count c among the bucket's N tokens and V distinct words, so the model
covers any word.  Counts of rare words are joined by Spark: every text leaves
the hashes of its rare words, the others are looked up in a table of the
``LOOKUP`` most frequent words.  Words are known by 64-bit hashes.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.llm.common import KeyIndex, WordHash, mix, segments, stored, sums, utf8, word_spans

WORDS = 768
BUCKETS = 255
CLASSES = WORDS + BUCKETS + 1
END = WORDS + BUCKETS
LOOKUP = 1 << 18
DIM = 32
NOISE = 16
EPOCHS = 150


def _blocks(texts: pa.Array, hashes: WordHash):
    """Per block: the rows of its segments, where each one's words lie, and
    the words' hashes and buckets."""
    data, off = utf8(texts)
    for block in segments(data, off):
        size = np.array([e - s for _, s, e in block])
        ends = np.cumsum(size + 1) - 1
        buf = np.frombuffer((b" ".join(data[s:e] for _, s, e in block) + b" ").lower(), dtype=np.uint8)
        first, last = word_spans(buf)
        h = hashes.spans(buf, first, last)
        rows = np.array([r for r, _, _ in block])
        # What precedes a word shorter than three bytes doesn't count.
        long = last - first > 2
        tail = buf[last - 1].astype(np.uint64) << np.uint64(16) | buf[last - 2].astype(np.uint64) << np.uint64(8) | np.where(long, buf[last - 3], 0).astype(np.uint64)
        tail[last - first == 1] &= np.uint64(0xFF0000)
        yield rows, np.searchsorted(first, ends - size), np.searchsorted(first, ends), h, (mix(tail) % np.uint64(BUCKETS)).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, b, c): how often each word, of bucket b, occurs in the column ``t``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            found = []
            for _, _, _, h, bucket in _blocks(batch.column("t"), hashes):
                keys, first, n = np.unique(h, return_index=True, return_counts=True)
                found.append((keys, bucket[first], n))
            if found:
                keys, first, where = np.unique(np.concatenate([f[0] for f in found]), return_index=True, return_inverse=True)
                bucket = np.concatenate([f[1] for f in found])[first]
                n = np.bincount(where, weights=np.concatenate([f[2] for f in found]), minlength=len(keys)).astype(np.int64)
                for at in range(0, len(keys), 100_000):
                    cut = slice(at, at + 100_000)
                    yield pa.record_batch([pa.array(keys[cut].view(np.int64)), pa.array(bucket[cut].astype(np.int32)), pa.array(n[cut])], names=["h", "b", "c"])

    return texts.select("t").mapInArrow(count, "h bigint, b int, c bigint").groupBy("h", "b").agg(F.sum("c").alias("c"))


def _classes(h: np.ndarray, bucket: np.ndarray, top: KeyIndex) -> np.ndarray:
    at = top.find(h)
    return np.where(at >= 0, at, WORDS + bucket)


def _before(classes: np.ndarray, rows: np.ndarray, lo: np.ndarray, carry: dict[int, int]) -> np.ndarray:
    """The class before each word of a block: the end at the start of a text,
    or the last word of the text's segment in the block before."""
    out = np.empty_like(classes)
    out[1:] = classes[:-1]
    for row, at in zip(rows.tolist(), lo.tolist()):
        if at < len(out):
            out[at] = carry.get(row, END)
    return out


def successor_counts(texts: DataFrame, top: np.ndarray) -> np.ndarray:
    """CLASSES x CLASSES counts of a class after a class, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, index = WordHash(), KeyIndex(top)
        total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for batch in batches:
            last = np.full(len(batch), END)
            carry: dict[int, int] = {}
            for rows, lo, hi, h, bucket in _blocks(batch.column("t"), hashes):
                c = _classes(h, bucket, index)
                prev = _before(c, rows, lo, carry)
                total += np.bincount(prev * CLASSES + c, minlength=len(total))
                some = hi > lo
                last[rows[some]] = c[hi[some] - 1]
                carry = {int(rows[-1]): int(last[rows[-1]])}
            total += np.bincount(last * CLASSES + END, minlength=len(total))
        at = np.flatnonzero(total)
        for i in range(0, len(at), 100_000):
            yield pa.record_batch([pa.array(at[i:i + 100_000]), pa.array(total[at[i:i + 100_000]])], names=["k", "n"])

    found = texts.select("t").mapInArrow(count, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES * CLASSES)
    out[found.column("k").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(CLASSES, CLASSES)


def train(counts: np.ndarray, dim: int = DIM, noise: int = NOISE, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.05, seed: int = 3) -> np.ndarray:
    """Log-probabilities (natural) of every class after every class.

    Each pair (i, j) counts as data n_ij times and as noise noise * n_i * p_j
    times, p the classes' shares; the machine tells them apart by
    score - log(noise * p_j).  Adaptive gradient steps (Adagrad)."""
    rng = np.random.default_rng(seed)
    n = len(counts)
    total = counts.sum()
    share = (counts.sum(0) + 0.5) / (total + 0.5 * n)
    r, q = (rng.normal(0, 0.1, (n, dim)).astype(np.float32) for _ in range(2))
    c, b = np.eye(dim, dtype=np.float32), np.log(share).astype(np.float32)
    log_noise = np.log(noise * share).astype(np.float32)
    context = counts.sum(1)
    sight = [np.full(x.shape, 1e-4, dtype=np.float32) for x in (r, q, c, b)]
    live = np.flatnonzero(context > 0)
    for _ in range(epochs if total else 0):
        rng.shuffle(live)
        for at in np.array_split(live, max(1, len(live) // batch)):
            # Contexts weigh by the square root of their frequency: rare ones learn too.
            real = (counts[at] / context[at, None]).astype(np.float32)
            scale = np.sqrt(context[at] / context[live].mean()).astype(np.float32)[:, None]
            hidden = r[at] @ c
            guess = 1 / (1 + np.exp(-np.clip(hidden @ q.T + b - log_noise, -30, 30)))
            error = scale * (real * (1 - guess) - noise * share.astype(np.float32) * guess)
            back = error @ q
            steps = ((r, at, back @ c.T), (q, slice(None), error.T @ hidden), (c, slice(None), r[at].T @ back), (b, slice(None), error.sum(0)))
            for (x, where, g), s in zip(steps, sight):
                s[where] += g * g
                x[where] += rate * g / np.sqrt(s[where])
    out = (r @ c @ q.T + b).astype(np.float64)
    high = out.max(1, keepdims=True)
    return out - high - np.log(np.exp(out - high).sum(1, keepdims=True))


@dataclass
class LanguageModel:
    top: np.ndarray         # hashes of the words that are classes
    logp: np.ndarray        # CLASSES x CLASSES, base 10, float32
    bucket_log: np.ndarray  # log10(N + V + 1) by bucket
    known: np.ndarray       # hashes and counts of the most frequent words
    known_counts: np.ndarray
    tokens: int             # N
    types: int              # V
    end_count: int


def fit_language_model(docs: DataFrame, text: str = "text", epochs: int = EPOCHS) -> tuple[LanguageModel, DataFrame]:
    """The model of all texts of ``docs``, and the stored counts (h, c) of all
    words.  Null and empty texts are texts of one end."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    counts = stored(word_counts(texts), "lm-counts")
    ends = texts.count()
    sizes = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # The most frequent words by steps of their count's logarithm: at most LOOKUP, without a global sort.
    step = F.floor(8 * F.log2("c"))
    n, least = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):
        n += row.n
        if n > LOOKUP:
            break
        least = row.step
    most = counts.where(step >= least if least is not None else F.lit(False)).toArrow().sort_by([("c", "descending"), ("h", "ascending")])
    known, known_counts = most.column("h").to_numpy().view(np.uint64), most.column("c").to_numpy()
    top = known[:WORDS]
    rare = counts.join(F.broadcast(docs.sparkSession.createDataFrame([(int(x),) for x in top.view(np.int64)], "h bigint")), "h", "left_anti")
    log = np.zeros(BUCKETS)
    for row in rare.groupBy("b").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        log[row.b] = np.log10(row.n + row.v + 1)
    logp = (train(successor_counts(texts, top), epochs=epochs) / np.log(10)).astype(np.float32)
    return LanguageModel(top, logp, log, known, known_counts, int(sizes.n) + ends, int(sizes.v) + (ends > 0), ends), counts


def score_texts(docs: DataFrame, model: LanguageModel, counts: DataFrame, columns: dict[str, Column], text: str = "text") -> DataFrame:
    """One row per row of ``docs`` with ``columns`` and n_tokens, n_known (tokens met
    in training), train_tokens, base_score (add-one unigrams) and score (the
    model), both log10 of the text's probability.  A null text is empty: one
    end.  Without training texts all classes are alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("n", T.LongType()), T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()),
              T.StructField("model", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType()))]

    @F.arrow_udf(T.StructType(fields))
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m, hashes = shared.value, WordHash()
        top, index = KeyIndex(m.top), KeyIndex(m.known)
        log_count = np.append(np.log10(m.known_counts + 1.0), 0.0)  # -1: not in the table
        for texts in batches:
            size = len(texts)
            n, known, base, total = np.ones(size, dtype=np.int64), np.zeros(size, dtype=np.int64), np.zeros(size), np.zeros(size)
            last, rare, carry = np.full(size, END), [[] for _ in range(size)], {}
            for rows, lo, hi, h, bucket in _blocks(texts, hashes):
                c, at = _classes(h, bucket, top), index.find(h)
                prev = _before(c, rows, lo, carry)
                own = log_count[at]
                within = np.where(c >= WORDS, own - m.bucket_log[bucket], 0.0)
                np.add.at(n, rows, hi - lo)
                np.add.at(known, rows, sums((at >= 0).astype(np.float64), lo, hi).astype(np.int64))
                np.add.at(base, rows, sums(own, lo, hi))
                np.add.at(total, rows, sums(m.logp[prev, c] + within, lo, hi))
                some = hi > lo
                last[rows[some]] = c[hi[some] - 1]
                carry = {int(rows[-1]): int(last[rows[-1]])}
                signed = h.view(np.int64)
                out = np.flatnonzero(at < 0)
                cut = np.searchsorted(out, np.stack([lo, hi]))
                for row, a, b in zip(rows.tolist(), *cut.tolist()):
                    if b > a:
                        rare[row].append(signed[out[a:b]])
            total += m.logp[last, END]
            base += np.log10(m.end_count + 1.0)
            known += m.end_count > 0
            lists = pa.array([np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in rare], pa.list_(pa.int64()))
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(known), pa.array(base), pa.array(total), lists], [f.name for f in fields])

    rows = docs.select(*[c.alias(f"_{name}") for name, c in columns.items()], F.coalesce(F.col(text), F.lit("")).alias("t")) \
        .withColumn("s", scored("t")).select(*[f"_{name}" for name in columns], "s.*").withColumn("id", F.monotonically_increasing_id())
    rows = stored(rows, "lm-rows")  # from here on the ids are fixed
    # Of the words in the lookup table all is known already; the others' counts are joined.
    rare = rows.select("id", F.explode("rare").alias("h")).join(counts.select("h", "c"), "h").groupBy("id") \
        .agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("log"))
    rows = rows.drop("rare").join(rare, "id", "left")
    more = F.coalesce("log", F.lit(0.0))
    return rows.select(*[F.col(f"_{name}").alias(name) for name in columns], F.col("n").alias("n_tokens"),
                       (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("bigint").alias("train_tokens"),
                       (F.col("base") + more - F.col("n") * F.lit(float(np.log10(model.tokens + model.types + 1)))).alias("base_score"),
                       (F.col("model") + more).alias("score"))
