"""SimHash near duplicates by the generalised pigeonhole principle.

Fingerprints have 64 bits from the XXH64 hashes (seed 42) of a text's word
shingles.  To find all pairs within ``bits`` differing bits, the bit positions
are grouped into partitions, correlated ones together.  For every fingerprint
a dynamic program gives each partition i a threshold t_i >= -1 with
sum(t_i + 1) = bits + 1; any fingerprint within ``bits`` of it then lies
within t_i of it in some partition i, so probing each partition's values up to
t_i and checking the whole fingerprints misses nothing.  The program minimises
the estimated number of candidates plus probes; the estimates come from
histograms of the partitions' halves, taken as independent.

Only distinct fingerprints are joined.  A value that more than ``HOT_BUCKET``
fingerprints share is not joined with itself: its members, and whatever probes
it, are linked through the values at most one bit away from them.  Two
fingerprints differ in at most two bits exactly if they share such a value, so
this part is exact too and costs 65 rows a fingerprint.  (It serves
``bits`` <= 2; for more bits buckets are always joined.)
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.llm.common import _cut, free_name, stored, utf8
from pumpline.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
PARTITIONS = 3
HOT_BUCKET = 64
PIECE_BYTES = 1 << 20


def fingerprint(data: memoryview, shingle: int = SHINGLE_WORDS) -> int:
    """The SimHash of one UTF-8 text (A-Z lowered), as a signed 64-bit number:
    a bit is set if it is set in over half of the shingles' hashes.  Fewer
    words than a shingle: the whole sequence is one; no word: 0."""
    digest = xxhash.xxh64_digest
    ones, n, carry, at = np.zeros(64, dtype=np.int64), 0, [], 0
    while at < len(data):
        stop = _cut(data, min(at + PIECE_BYTES, len(data)), len(data))
        words = carry + bytes(data[at:stop]).lower().split()
        at = stop
        if at == len(data) and not n and 0 < len(words) < shingle:
            pieces = digest(b" ".join(words), SEED)
        else:
            joined = b" ".join(words)
            size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(size + 1) - 1
            firsts = (ends - size)[:len(words) - shingle + 1] if len(words) >= shingle else ends[:0]
            pieces = b"".join([digest(joined[s:e], SEED) for s, e in zip(firsts.tolist(), ends[shingle - 1:].tolist())])
        if pieces:
            bits = np.unpackbits(np.frombuffer(pieces, dtype=np.uint8)).reshape(-1, 64)
            ones += bits.sum(0, dtype=np.int32)
            n += len(bits)
        carry = words[len(words) - shingle + 1:] if shingle > 1 and len(words) >= shingle else words if shingle > 1 else []
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` (a column of the name ``out`` is replaced) with the fingerprint (bigint) in ``out``; null texts count as empty."""

    @F.arrow_udf(T.LongType())
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, off = utf8(texts)
            yield pa.array([fingerprint(data[int(s):int(e)], shingle) for s, e in zip(off[:-1], off[1:])], pa.int64())

    return docs.withColumn(out, made(F.coalesce(F.col(text), F.lit(""))))


def group_bits(joint: np.ndarray, n: int, parts: int = PARTITIONS) -> list[list[int]]:
    """Bit positions in ``parts`` groups, correlated ones together: each group
    starts with the free bit most correlated with the other free ones and
    takes the bit most correlated with its members until it is full.
    ``joint``: how often each two bits are both set among ``n`` values."""
    p = np.diag(joint) / max(n, 1)
    cov = joint / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for i in range(parts):
        room = -(-len(free) // (parts - i))
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < room:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def extract(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group``, packed in its order into the low bits."""
    out = np.zeros(len(fps), dtype=np.int64)
    for j, b in enumerate(group):
        out |= ((fps >> np.int64(b)) & np.int64(1)) << np.int64(j)
    return out


@dataclass
class Plan:
    """Partitions, and of each half of them the number of fingerprints at each
    distance (up to ``bits``) from each value."""
    groups: list[list[int]]
    near: list[tuple[np.ndarray, np.ndarray]]
    n: int
    bits: int

    def candidates(self, values: np.ndarray, i: int) -> np.ndarray:
        """Estimated fingerprints within 0..bits of each value in partition i."""
        half = len(self.groups[i]) // 2
        low, high = self.near[i][0][values & ((1 << half) - 1)], self.near[i][1][values >> half]
        exact = [sum(low[:, a] * high[:, d - a] for a in range(d + 1)) / max(self.n, 1) for d in range(self.bits + 1)]
        return np.cumsum(np.stack(exact, 1), axis=1)

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        """Per fingerprint and partition the threshold, by dynamic programming
        over the partitions and the units t_i + 1 given out so far."""
        units = self.bits + 1
        best = np.full((len(fps), units + 1), np.inf)
        best[:, 0] = 0
        picks = []
        for i, group in enumerate(self.groups):
            found = self.candidates(extract(fps, group), i)
            probes = np.cumsum([comb(len(group), d) for d in range(units)])
            cost = np.concatenate([np.zeros((len(fps), 1)), found + probes], axis=1)
            step = np.full_like(best, np.inf)
            pick = np.zeros(best.shape, dtype=np.int64)
            for have in range(units + 1):
                for u in range(units + 1 - have):
                    c = best[:, have] + cost[:, u]
                    better = c < step[:, have + u]
                    step[better, have + u] = c[better]
                    pick[better, have + u] = u
            best = step
            picks.append(pick)
        out = np.zeros((len(fps), len(self.groups)), dtype=np.int64)
        left = np.full(len(fps), units)
        for i in range(len(self.groups) - 1, -1, -1):
            u = picks[i][np.arange(len(fps)), left]
            out[:, i] = u - 1
            left = left - u
        return out


def _flips(width: int, upto: int) -> list[int]:
    """Masks over ``width`` bits with at most ``upto`` bits set."""
    out = level = [0]
    for _ in range(upto):
        level = sorted({m | 1 << b for m in level for b in range(width) if not m >> b & 1})
        out = out + level
    return out


def _summed(df: DataFrame, fn) -> dict[tuple, float]:
    """Sums by (k, v) of the arrays k, v, x that ``fn`` makes of each batch of
    fingerprints; the number of keys is fixed by ``fn``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            k, v, x = fn(batch.column("fp").to_numpy())
            total = x if total is None else total + x
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.record_batch([pa.array(k[some]), pa.array(v[some]), pa.array(total[some])], names=["k", "v", "x"])

    rows = df.select("fp").mapInArrow(run, "k bigint, v bigint, x double").groupBy("k", "v").agg(F.sum("x").alias("x")).collect()
    return {(r.k, r.v): r.x for r in rows}


def make_plan(fps: DataFrame, bits: int = MAX_BITS, parts: int = PARTITIONS) -> Plan:
    """Bit groups from the 64 x 64 joint counts, then histograms of the
    groups' halves (2**11 values each): both of fixed size, over all rows."""
    def joint(values):
        b = np.unpackbits(values.astype(">i8").view(np.uint8)).reshape(-1, 64)[:, ::-1].astype(np.float32)
        i, j = np.divmod(np.arange(64 * 64), 64)
        return i, j, (b.T @ b).astype(np.float64).ravel()

    found = _summed(fps, joint)
    matrix = np.zeros((64, 64))
    for (i, j), x in found.items():
        matrix[i, j] = x
    n = fps.count()
    groups = group_bits(matrix, n, parts)
    halves = [h for g in groups for h in (g[:len(g) // 2], g[len(g) // 2:])]

    def counts(values):
        k = np.concatenate([np.full(1 << len(h), i) for i, h in enumerate(halves)])
        v = np.concatenate([np.arange(1 << len(h)) for h in halves])
        return k, v, np.concatenate([np.bincount(extract(values, h), minlength=1 << len(h)) for h in halves]).astype(np.float64)

    found = _summed(fps, counts)
    near = []
    for i, h in enumerate(halves):
        histogram = np.array([found.get((i, v), 0.0) for v in range(1 << len(h))])
        places = np.arange(len(histogram))
        at = np.zeros((len(histogram), bits + 1))
        for mask in _flips(len(h), min(bits, len(h))):
            at[:, mask.bit_count()] += histogram[places ^ mask]
        near.append(at)
    return Plan(groups, list(zip(near[::2], near[1::2])), n, bits)


def _rows(part: int, value: np.ndarray, fp: np.ndarray, t: np.ndarray, probe: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.full(len(fp), part, dtype=np.int32)), pa.array(value), pa.array(fp), pa.array(t.astype(np.int32)),
                            pa.array(probe)], names=["part", "value", "fp", "t", "probe"])


def near_links(fps: DataFrame, plan: Plan, hot: int = HOT_BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints of ``fps`` (column fp) whose
    components are those of all pairs within ``plan.bits`` differing bits."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            given = plan.thresholds(values)
            for i, group in enumerate(plan.groups):
                part = extract(values, group)
                t = given[:, i]
                yield _rows(i, part, values, t, np.zeros(len(values), dtype=bool))
                for mask in _flips(len(group), max(0, int(t.max(initial=0)))):
                    some = t >= mask.bit_count()
                    if mask and some.any():
                        yield _rows(i, part[some] ^ mask, values[some], t[some], np.ones(some.sum(), dtype=bool))

    dealt = stored(fps.select("fp").mapInArrow(deal, "part int, value bigint, fp bigint, t int, probe boolean"), "simhash-probes")
    # A row that is no probe is the index entry; it probes its own value too if t >= 0.
    index = dealt.where("not probe")
    busy = index.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > (hot if plan.bits <= 2 else (1 << 62)))
    keys = ["part", "value"]
    left = dealt.where("probe or t >= 0").join(busy, keys, "left_anti").select(*keys, F.col("fp").alias("a"), "probe")
    right = index.join(busy, keys, "left_anti").select(*keys, F.col("fp").alias("b"), "t")
    pairs = left.join(right, keys).where("a <> b and (a < b or probe or t < 0)") \
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= plan.bits).select("a", "b")
    crowd = dealt.join(busy, keys, "left_semi").select("fp").distinct()
    ball = crowd.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m).cast("bigint")) for m in
                                                  [0] + [1 << b for b in range(63)] + [-(1 << 63)]])).alias("z"))
    centre = ball.groupBy("z").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b <> top").select("z", "b")
    shared = ball.join(centre, "z").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(shared)


def _rooted(marked: DataFrame, bits: int, hot: int) -> DataFrame:
    """(fp, root: its component's smallest fingerprint) of the distinct ``fp`` of ``marked``."""
    fps = stored(marked.select("fp").distinct(), "simhash-distinct")
    found = connected_components(near_links(fps, make_plan(fps, bits), hot), "simhash-components")
    return fps.join(found, fps.fp == found.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                    bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """One row per row of ``docs``: (``key``, fingerprint as 16 hex digits,
    component_id: the smallest ``key`` reachable over fingerprints that differ
    in at most ``bits`` bits).

    Null and empty texts have fingerprint zero and link like any other.  Rows
    repeated under one key are all returned; a null key is never chosen as
    component_id, which is null only where no key is left.
    """
    marked = stored(with_fingerprint(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), "t", "fp", shingle).select("k", "fp"),
                    "simhash-fingerprints")
    fps = marked.groupBy("fp").agg(F.min("k").alias("least"))
    rooted = stored(fps.join(_rooted(marked, bits, hot), "fp"), "simhash-rooted")
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(first, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                        bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """One row of each component: of the smallest ``key``, then of the smallest
    hashes of the text and of the whole row, so rows that share a key but not
    their text are decided each in its own component.

    Rows without a key are not named as copies of rows that have one: of these
    each component keeps one too, by the same hashes.
    """
    at, a, b = (free_name(docs, x) for x in ("_text", "_row", "_back"))
    marks = {at: F.xxhash64(text), a: F.xxhash64(*docs.columns), b: F.xxhash64(*reversed(docs.columns))}
    hashed = docs.withColumns(marks)
    marked = stored(with_fingerprint(hashed.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(at).alias("h"), F.col(a).alias("a"),
                                                   F.col(b).alias("b")), "t", "fp", shingle).select("k", "fp", "h", "a", "b"), "simhash-fingerprints")
    # The first row of every fingerprint, then of every component: both grouped minima.
    least = marked.groupBy("fp", F.isnull("k").alias("unnamed")).agg(F.min(F.struct("k", "h", "a", "b")).alias("least"))
    stay = least.join(_rooted(marked, bits, hot), "fp").groupBy("root", "unnamed").agg(F.min("least").alias("least")) \
        .select(F.col("least.a").alias(a), F.col("least.b").alias(b))
    return hashed.join(stay.hint("shuffle_hash"), [a, b], "left_semi").dropDuplicates([a, b]).select(*docs.columns)
