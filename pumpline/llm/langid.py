"""Language identification by prediction by partial matching (PPM).

Training counts, per language, every byte after the ``order`` bytes before it;
the counts of shorter contexts are marginals of these.  A context seen ``T``
times with ``q`` distinct next bytes gives a byte seen ``c`` times the
probability c / (T + q) and escapes to the next shorter context with
q / (T + q) (method C); the empty context escapes to 1 / 256.  Statistics are
frozen after training, so the code length of a text under a language is a sum
of table entries: one row of costs (a language each) for the longest known
context, plus escapes for the positions that need a shorter one.

Contexts seen once are not kept (variable order).  Texts are read as UTF-8
with A-Z lowered and are preceded by ``order`` spaces.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pumpline.llm.common import KeyIndex, segments, stored, sums, utf8

ORDER = 4
TRAIN_BYTES_PER_LANG = 1_500_000
HASHES = 1 << 62
UNDETERMINED = "und"


def _grams(buf: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes at each place as one number (missing ones: 0)."""
    out = buf.astype(np.uint64)
    for j in range(1, n):
        out[j:] |= buf[:-j].astype(np.uint64) << np.uint64(8 * j)
    return out


def _with_context(data: memoryview, off: np.ndarray, block, order: int):
    """The block's bytes, each segment after its ``order`` preceding bytes, and
    where the segments lie in them."""
    parts, starts, ends, at = [], [], [], 0
    for row, s, e in block:
        before = bytes(data[max(int(off[row]), s - order):s]).rjust(order, b" ")
        parts += (before, data[s:e])
        starts.append(at + order)
        at += order + e - s
        ends.append(at)
    buf = np.frombuffer(b"".join(parts).lower(), dtype=np.uint8)
    return buf, np.array(starts), np.array(ends)


@dataclass
class PpmModel:
    langs: list[str]
    order: int
    grams: list[KeyIndex]     # by length - 1: known contexts with their next byte
    costs: list[np.ndarray]   # bits, a row per gram and a column per language
    contexts: list[KeyIndex]  # by length: known contexts
    escapes: list[np.ndarray]

    def bits(self, buf: np.ndarray) -> np.ndarray:
        """Code length of each byte given the bytes before it, per language."""
        out = np.zeros((len(buf), len(self.langs)), dtype=np.float32)
        grams = _grams(buf, self.order + 1)
        todo = None
        for n in range(self.order + 1, 0, -1):
            here = grams if todo is None else grams[todo]
            key = here & np.uint64((1 << (8 * n)) - 1)
            row = self.grams[n - 1].find(key)
            hit = row >= 0
            if todo is None:
                np.take(self.costs[n - 1], np.maximum(row, 0), axis=0, out=out)
                todo = np.flatnonzero(~hit)
                out[todo] = 0
            else:
                out[todo[hit]] += self.costs[n - 1][row[hit]]
                todo = todo[~hit]
            if not len(todo):
                break
            ctx = self.contexts[n - 1].find((grams[todo] & np.uint64((1 << (8 * n)) - 1)) >> np.uint64(8))
            seen = ctx >= 0
            out[todo[seen]] += self.escapes[n - 1][ctx[seen]]
        return out


def build_model(langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> PpmModel:
    """From each language's (order + 1)-grams and their counts."""
    known, costs, contexts, escapes = [], [], [], []
    previous = previous_index = None
    for n in range(1, order + 2):
        mask = np.uint64((1 << (8 * n)) - 1)
        per = []
        for lang in langs:
            g, c = counts[lang]
            keys, where = np.unique(g & mask, return_inverse=True)
            c = np.bincount(where, weights=c, minlength=len(keys))
            ctx, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(of, weights=c), np.bincount(of)
            keep = total >= (2 if n > 1 else 0)
            per.append((keys[keep[of]], c[keep[of]], of[keep[of]], ctx, total, distinct, keep))
        keys = np.arange(256, dtype=np.uint64) if n == 1 else np.unique(np.concatenate([p[0] for p in per]))
        all_ctx = np.unique(np.concatenate([p[3][p[6]] for p in per]))
        cost = np.full((len(keys), len(langs)), np.nan)
        esc = np.zeros((len(all_ctx), len(langs)))
        for i, (k, c, of, ctx, total, distinct, keep) in enumerate(per):
            cost[np.searchsorted(keys, k), i] = np.log2((total + distinct)[of] / c)
            esc[np.searchsorted(all_ctx, ctx[keep]), i] = np.log2((total + distinct) / distinct)[keep]
        ctx_index = KeyIndex(all_ctx)
        at = ctx_index.find(keys >> np.uint64(8))
        back = np.where((at >= 0)[:, None], esc[np.maximum(at, 0)], 0.0)
        if n == 1:
            back = back + 8.0
        else:
            back = back + previous[previous_index.find(keys & np.uint64((1 << (8 * (n - 1))) - 1))]
        cost = np.where(np.isnan(cost), back, cost)
        previous, previous_index = cost, KeyIndex(keys)
        known.append(previous_index)
        costs.append(cost.astype(np.float32))
        contexts.append(ctx_index)
        escapes.append(esc.astype(np.float32))
    return PpmModel(langs, order, known, costs, contexts, escapes)


def _chosen_blocks(rows: DataFrame, train_bytes: int, size: int) -> dict[str, int]:
    """Per language the largest block hash to train on: the distinct texts'
    blocks with the smallest hashes, until they hold ``train_bytes``; the first
    one is always among them."""
    texts = stored(rows.groupBy("l", "h").agg(F.max(F.octet_length("t")).alias("b")), "language-texts")
    total = texts.groupBy("l").agg(F.sum("b").alias("total"))
    blocks = texts.select("l", "h", "b", F.explode(F.sequence(F.lit(0), F.floor((F.col("b") - 1) / size).cast("int"))).alias("i")) \
        .select("l", _block_hash(F.col("h"), F.col("i")).alias("u"), F.least(F.lit(size), F.col("b") - F.col("i") * size).alias("b"))
    # Four times the share is certain to hold enough: a bounded number of rows a language is put in order.
    some = blocks.join(F.broadcast(total), "l").where(F.col("u") < 4.0 * train_bytes / F.col("total") * float(HASHES)).drop("total")
    before = Window.partitionBy("l").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    used = some.withColumn("before", F.coalesce(F.sum("b").over(before), F.lit(0))).where(F.col("before") < train_bytes)
    return {r.l: r.u for r in used.groupBy("l").agg(F.max("u").alias("u")).collect()}


def _block_hash(text_hash: Column, block: Column) -> Column:
    return F.pmod(F.xxhash64(text_hash, block), F.lit(HASHES))


def fit_language_model(docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER,
                       train_bytes: int = TRAIN_BYTES_PER_LANG) -> PpmModel | None:
    """Train on ``train_bytes`` of text per language, or all if there is less.
    Texts are sampled in blocks of ``train_bytes`` / 24 by a hash of text and
    block number, so a language of a few long texts is learned too, and the
    sample exceeds the bound by less than a block.  Equal texts of a language
    teach once; keys play no part.  Rows without text or language teach
    nothing; None if no row is left."""
    size = max(1, train_bytes // 24)
    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(text).alias("h")) \
        .where("t is not null and l is not null and t != ''")
    upto = _chosen_blocks(rows, train_bytes, size)
    if not upto:
        return None
    last = F.create_map(*[x for lang_, u in sorted(upto.items()) for x in (F.lit(lang_), F.lit(u))])
    numbers = F.sequence(F.lit(0), F.floor((F.octet_length("t") - 1) / size).cast("int"))
    taken = F.filter(numbers, lambda i: _block_hash(F.col("h"), i) <= last[F.col("l")])
    begin, data = F.col("i") * size, F.col("t").cast("binary")
    lead = F.least(begin, F.lit(order))
    sample = rows.withColumn("taken", taken).where(F.size("taken") > 0).withColumn("i", F.explode("taken")) \
        .select("l", "h", "i", lead.alias("lead"), F.substring(data, begin - lead + 1, lead + size).alias("piece")).dropDuplicates(["l", "h", "i"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("l").to_pylist(), dtype=object)
            for one in sorted(set(langs)):
                part = batch.filter(pa.array(langs == one))
                before = part.column("lead").to_numpy()
                # The bytes before a block are context only; a text's first block has spaces there.
                texts = [b" " * (order - n) + p for n, p in zip(before.tolist(), part.column("piece").to_pylist())]
                length = np.array([len(x) for x in texts])
                starts = np.cumsum(length) - length
                inside = np.ones(length.sum(), dtype=bool)
                inside[(starts[:, None] + np.arange(order)).ravel()] = False
                grams, n = np.unique(_grams(np.frombuffer(b"".join(texts).lower(), dtype=np.uint8), order + 1)[inside], return_counts=True)
                yield pa.record_batch([pa.array([one] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                                      names=["l", "g", "n"])

    found = sample.select("l", "lead", "piece").mapInArrow(count, "l string, g bigint, n bigint") \
        .groupBy("l", "g").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(found.column("l").unique().to_pylist())
    parts = {x: found.filter(pc.equal(found.column("l"), x)) for x in langs}
    counts = {x: (t.column("g").to_numpy().astype(np.uint64), t.column("n").to_numpy().astype(np.float64)) for x, t in parts.items()}
    return build_model(langs, counts, order) if langs else None


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("bits_per_byte", T.DoubleType())])


def score_batch(model: PpmModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the best language's number, its posterior, its bits per byte."""
    data, off = utf8(texts)
    total = np.zeros((len(texts), len(model.langs)))
    for block in segments(data, off):
        buf, starts, ends = _with_context(data, off, block, model.order)
        np.add.at(total, [row for row, _, _ in block], sums(model.bits(buf), starts, ends))
    best = total.argmin(1)
    least = total[np.arange(len(total)), best]
    posterior = 1.0 / np.exp2(np.maximum(least[:, None] - total, -1000.0)).sum(1)
    return best, posterior, least / np.maximum(np.diff(off), 1)


def predict_language(docs: DataFrame, model: PpmModel | None, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` (a column of the name ``out`` is replaced) with a struct column ``out`` (lang_pred, score, bits_per_byte).

    score is the posterior of the language under equal priors.  A text that is
    null or has no letter (``\\p{L}``), or any text when nothing could be
    learned, gets ``und`` with score 0 and null bits.
    """
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    none = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    if model is None:
        return docs.withColumn(out, none)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        names = pa.array(m.langs)
        for texts in batches:
            best, posterior, rate = score_batch(m, texts)
            yield pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(posterior), pa.array(rate)],
                                             ["lang_pred", "score", "bits_per_byte"])

    return docs.withColumn(out, judged(F.col(text))).withColumn(out, F.when(letters, F.col(out)).otherwise(none))


def accepted(language: str = "language", min_score: float = 0.5) -> Column:
    """Whether a document has a language: letters, and one clearly best fit."""
    return (F.col(f"{language}.lang_pred") != UNDETERMINED) & (F.col(f"{language}.score") >= min_score)
