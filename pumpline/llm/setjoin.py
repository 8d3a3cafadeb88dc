"""N-gram Jaccard self-join that skips by relations between sets.

A document's set holds the 64-bit hashes of its distinct word 4-grams.  Two
sets link when their Jaccard similarity is at least ``PERCENT`` percent.

1. Documents with equal sets form a class (128-bit digest); only classes are
   joined.
2. Two linked sets share at least l of their first (not shared) + l tokens in
   hash order.  A set of which fewer of these first tokens occur in another
   class links with nothing; this needs one grouped aggregation of a quarter
   of the tokens and leaves the families of similar texts.
3. The tokens of those families are ordered by document frequency.  A linked
   pair shares a token within both sets' prefixes; from the token's place i
   in a set of n at most n - i can be shared, which bounds the size of a
   partner (``cap``).  Index lists are kept in blocks of similar sizes with
   the largest cap of the block: a probe skips whole blocks by position.
4. Answers come from highly similar sets.  Sets with an equal min-hash are
   checked against one leader of theirs (the set with the fewest tokens of
   its own); who links follows the leader.  Lists keep one entry per leader,
   and only leaders are compared.  If leaders link, so do their followers'
   components.  If not, and the followers' few tokens beyond their leaders
   could make up for it, x is compared with the followers w of the smaller
   side, and a follower z's answer for w is derived from x's: z can only gain
   the tokens beyond x that it shares with w.  What this leaves is compared.

Every link between different components is thus found or ruled out, and a
family of near copies costs rows in proportion to its size.  The 64-bit hashes
are compared within pairs, so a wrong count needs a collision inside one pair.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pumpline.llm.common import WORD_PATTERN, WordHash, mix, segments, stored, utf8, word_spans
from pumpline.llm.components import connected_components

WORDS = 4
PERCENT = 85
EXTRA = 10            # of a hundred tokens, how many more than the prefix the first filter takes
KEYS = 4              # min-hashes by which sets look for a leader
CHUNK = 256           # sets compared with one copy of another
BLOOM_WORDS = 1 << 20  # 64-bit words of the Bloom filter: 8 MB at any size

_STEP = np.uint64(0x9E3779B97F4A7C15)


def text_sets(texts: pa.Array, hashes: WordHash, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its sorted distinct n-gram hashes) for every row of ``texts``.
    Fewer words than ``words``: the whole sequence is one; no word: none."""
    data, off = utf8(texts)
    parts: dict[int, list[np.ndarray]] = {}

    def made(row: int) -> np.ndarray:
        h = np.concatenate(parts.pop(row, [np.zeros(0, dtype=np.uint64)]))
        if not len(h):
            return h
        width = min(words, len(h))
        gram = h[:len(h) - width + 1] + np.uint64(width)
        for k in range(1, width):
            gram = mix(gram * _STEP + h[k:len(h) - width + 1 + k])
        return np.unique(gram)

    done = 0
    for block in segments(data, off):
        size = np.array([e - s for _, s, e in block])
        ends = np.cumsum(size + 1) - 1
        buf = np.frombuffer(b" ".join(data[s:e] for _, s, e in block).lower() + b" ", dtype=np.uint8)
        first, last = word_spans(buf)
        h = hashes.spans(buf, first, last)
        lo, hi = np.searchsorted(first, ends - size), np.searchsorted(first, ends)
        for (row, _, _), a, b in zip(block, lo.tolist(), hi.tolist()):
            while done < row:
                yield done, made(done)
                done += 1
            parts.setdefault(row, []).append(h[a:b])
    while done < len(off) - 1:
        yield done, made(done)
        done += 1


def _heads(n: Column, percent: int) -> tuple[Column, Column]:
    """How many first tokens the first filter takes, and how many of them a
    linked set shares at least."""
    taken = F.least(n, F.floor(n * (100 - percent) / 100) + F.floor(n * EXTRA / 100) + 1)
    return taken, F.floor(F.ceil(n * percent / 100) * EXTRA / 100) + 1


def _digests(docs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """(k, n, d1, d2, th, head): size and digest of each row's set, a hash of
    the text, and the set's first tokens in hash order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            n, marks, heads = [], [], []
            for _, found in text_sets(batch.column("t"), hashes, words):
                n.append(len(found))
                marks.append(xxhash.xxh3_128_digest(found.tobytes()))
                taken = min(len(found), len(found) * (100 - percent) // 100 + len(found) * EXTRA // 100 + 1)
                heads.append(found[:taken].tobytes())
            both = np.frombuffer(b"".join(marks), dtype=np.int64).reshape(-1, 2)
            yield pa.record_batch([batch.column("k"), pa.array(n, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                                   batch.column("th"), pa.array(heads, pa.binary())], names=["k", "n", "d1", "d2", "th", "head"])

    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("th", F.xxhash64("t"))
    kind = dict(rows.dtypes)["k"]
    return rows.mapInArrow(run, f"k {kind}, n bigint, d1 bigint, d2 bigint, th bigint, head binary")


def _tokens(df: DataFrame, blob: str, keep: list[str]) -> DataFrame:
    """A row (token, *keep) for every 64-bit token of the column ``blob``."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("_blob").to_pylist()
            size = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
            token = np.frombuffer(b"".join(blobs), dtype=np.int64)
            row = np.repeat(np.arange(len(blobs)), size)
            for i in range(0, len(token), 1 << 18):
                part = pa.array(row[i:i + (1 << 18)])
                yield pa.record_batch([pa.array(token[i:i + (1 << 18)]), *[batch.column(c).take(part) for c in keep]], names=["token", *keep])

    return df.select(*keep, F.col(blob).alias("_blob")).mapInArrow(run, ", ".join(["token bigint", *[f"{c} {kinds[c]}" for c in keep]]))


def _bloom_places(values: np.ndarray) -> np.ndarray:
    """Four bit places of each value."""
    h = mix(values.astype(np.uint64))
    return np.stack([(h >> np.uint64(s)) % np.uint64(BLOOM_WORDS * 64) for s in (0, 12, 24, 37)])


def _bloom(df: DataFrame, col: str) -> np.ndarray:
    """A Bloom filter of fixed size over the bigint column ``col``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bloom_places(batch.column(0).to_numpy()))
            yield pa.record_batch([pa.array((at >> np.uint64(6)).astype(np.int32)),
                                   pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["word", "bits"])

    found = df.select(col).mapInArrow(run, "word int, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BLOOM_WORDS, dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _maybe_in(values: Column, spark, bloom: np.ndarray) -> Column:
    """True for every member of the filter, and by chance for few others."""
    shared = spark.sparkContext.broadcast(bloom)

    @F.arrow_udf("boolean")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            at = _bloom_places(batch.to_numpy())
            yield pa.array(((shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(0))

    return found(values)


def _family_sets(docs: DataFrame, text: str, words: int, bloom: np.ndarray) -> DataFrame:
    """(sid, d1, d2, n, h: sorted hashes, keys: min-hashes), a row for each
    class that has a text in the filter.  ``sid`` is fixed by writing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seeds = WordHash(), mix(np.arange(1, KEYS + 1, dtype=np.uint64))
        for batch in batches:
            rows = [found for _, found in text_sets(batch.column("t"), hashes, words) if len(found)]
            marks = np.frombuffer(b"".join(xxhash.xxh3_128_digest(r.tobytes()) for r in rows), dtype=np.int64).reshape(-1, 2)
            keys = [[int(mix(r ^ s).min().view(np.int64)) for s in seeds] for r in rows]
            yield pa.record_batch([pa.array(marks[:, 0].copy()), pa.array(marks[:, 1].copy()), pa.array([len(r) for r in rows], pa.int64()),
                                   pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                                  names=["d1", "d2", "n", "h", "keys"])

    some = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")).where(_maybe_in(F.xxhash64("t"), docs.sparkSession, bloom))
    made = some.mapInArrow(run, "d1 bigint, d2 bigint, n bigint, h binary, keys array<bigint>").dropDuplicates(["d1", "d2"])
    return stored(made.withColumn("sid", F.monotonically_increasing_id()), "setjoin-sets")


def _overlaps(pairs: DataFrame, sets: DataFrame, name: str, rest_from: int = 101) -> DataFrame:
    """(a, b, na, nb, o, rest): sizes and exact overlap of pairs of sids, and
    from a similarity of ``rest_from`` percent on the tokens of b that a lacks.
    Each set ``a`` is sent once for every ``CHUNK`` partners, in front of them."""
    many = pairs.groupBy("a").agg(F.count("*").alias("m"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / CHUNK)).alias("part"))
    dealt = stored(dealt, name + "-dealt")
    own = sets.select("sid", "h")
    front = dealt.select("a", "part").distinct().join(own, F.col("a") == F.col("sid")).select("a", "part", F.lit(None).cast("bigint").alias("b"), "h")
    back = dealt.join(own, F.col("b") == F.col("sid")).select("a", "part", "b", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            out, rest = [], []
            for a, b, h in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "h")]):
                tokens = np.frombuffer(h, dtype=np.uint64)
                if b is None:
                    here, held = a, tokens
                else:
                    assert here == a
                    both = held[np.minimum(np.searchsorted(held, tokens), len(held) - 1)] == tokens
                    o = int(both.sum())
                    out.append((a, b, len(held), len(tokens), o))
                    rest.append(tokens[~both].tobytes() if 100 * o >= rest_from * (len(held) + len(tokens) - o) else b"")
            if out:
                yield pa.record_batch([*[pa.array(c, pa.int64()) for c in zip(*out)], pa.array(rest, pa.binary())],
                                      names=["a", "b", "na", "nb", "o", "rest"])

    sent = front.unionByName(back).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return stored(sent.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, o bigint, rest binary"), name)


def _links(o, na, nb, percent: int) -> Column:
    return 100 * o >= percent * (na + nb - o)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(token, sid, n, own, cap): the tokens of each set's prefix in order of
    frequency that another set has too; ``own`` counts the set's other tokens,
    ``cap`` is the largest partner that the token's place leaves possible."""
    tokens = _tokens(sets, "h", ["sid", "n"])
    often = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = tokens.join(often, "token")
    in_set = F.count("*").over(_by_sid())
    place = F.col("own") + F.row_number().over(_by_sid().orderBy("df", "token")) - 1
    ranked = shared.withColumn("own", F.col("n") - in_set).withColumn("left", F.col("n") - place)
    ranked = ranked.where(F.col("n") - F.col("left") <= F.floor(F.col("n") * (100 - percent) / 100))
    cap = F.floor(F.col("left") * (100 + percent) / percent) - F.col("n")
    return stored(ranked.select("token", "sid", "n", "own", cap.alias("cap")), "setjoin-prefixes")


def _by_sid():
    from pyspark.sql import Window
    return Window.partitionBy("sid")


def _members(entries: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sid, n, lead, extra, rest) of every set with entries: the leader that
    it links with, or itself, and its tokens that the leader lacks; and these
    links (a, b)."""
    live = entries.groupBy("sid").agg(F.first("n").alias("n"), F.first("own").alias("own"))
    live = stored(live, "setjoin-live")
    keyed = live.join(sets.select("sid", "keys"), "sid").select("sid", F.floor(F.col("own") * 1000 / F.col("n")).alias("rank"),
                                                                F.posexplode("keys").alias("which", "value"))
    keyed = stored(keyed, "setjoin-keys")
    leader = keyed.groupBy("which", "value").agg(F.min(F.struct("rank", "sid")).alias("best"), F.count("*").alias("m")).where("m > 1")
    pairs = keyed.join(leader, ["which", "value"]).select(F.col("best.sid").alias("a"), F.col("sid").alias("b")).where("a <> b").distinct()
    found = _overlaps(pairs, sets, "setjoin-leaders", percent).where(_links(F.col("o"), F.col("na"), F.col("nb"), percent))
    best = found.groupBy(F.col("b").alias("sid")).agg(F.min(F.struct((F.col("nb") - F.col("o")).alias("extra"), "a")).alias("x")) \
        .select("sid", F.col("x.a").alias("lead"), F.col("x.extra").alias("extra"))
    best = best.join(found.select(F.col("b").alias("sid"), F.col("a").alias("lead"), "rest"), ["sid", "lead"])
    members = live.select("sid", "n").join(best, "sid", "left").select(
        "sid", "n", F.coalesce("lead", "sid").alias("lead"), F.coalesce("extra", F.lit(0)).alias("extra"), F.coalesce("rest", F.lit(b"")).alias("rest"))
    return stored(members, "setjoin-members"), found.select("a", "b")


def _fits(x: str, y: str) -> Column:
    """Both sides' places leave room for a partner as large as the other's smallest."""
    return (F.col(f"{x}.low") <= F.col(f"{y}.cap")) & (F.col(f"{y}.low") <= F.col(f"{x}.cap"))


def _leader_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of leaders that share an index list and are not
    ruled out by size and position.  Lists are cut in blocks by size; a probe
    reads the summaries first and skips blocks."""
    band = F.floor(F.log(F.col("low").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    lists = entries.groupBy("token", "lead").agg(F.min("n").alias("low"), F.max("cap").alias("cap"))
    shared = lists.groupBy("token").agg(F.min("lead").alias("x"), F.max("lead").alias("y")).where("x <> y").select("token")
    lists = stored(lists.join(shared, "token", "left_semi").withColumn("band", band), "setjoin-lists")
    blocks = lists.groupBy("token", "band").agg(F.min("low").alias("low"), F.max("cap").alias("cap"))
    # Each pair is found from the side of the smaller (low, lead).
    probes = lists.alias("p").join(blocks.alias("q"), F.expr("p.token = q.token")).where(F.expr("q.band >= p.band") & _fits("p", "q")) \
        .select("p.token", "q.band", "p.lead", "p.low", "p.cap")
    pairs = probes.alias("p").join(lists.alias("q"), ["token", "band"]).where(_fits("p", "q") & F.expr("(p.low, p.lead) < (q.low, q.lead) and p.lead <> q.lead"))
    return pairs.select(F.least("p.lead", "q.lead").alias("a"), F.greatest("p.lead", "q.lead").alias("b")).distinct()


def _open_links(compared: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of leaders that don't link.

    ``compared``: these leaders' pairs with their overlap.  Members' overlap
    is at most that plus the tokens that each has beyond its leader, which
    settles most pairs.  In the others the leader x of more members is compared
    with every member w of the other; |z and w| is |x and w|, less what z lacks
    of it, plus what z and w share beyond x.  So a member z of x may link with
    w only if it shares enough tokens beyond x, or is smaller than x."""
    def enough(o, *sizes):
        return o * (100 + percent) >= percent * sum(sizes)

    widest = members.groupBy("lead").agg(F.max("extra").alias("most"), F.min("n").alias("low"), F.count("*").alias("size"))
    left, right = (widest.select(*[F.col(c).alias(f"{c}_{side}") for c in widest.columns]) for side in "xy")
    turned = compared.select(F.col("a").alias("lead_x"), F.col("b").alias("lead_y"), "o") \
        .unionByName(compared.select(F.col("b").alias("lead_x"), F.col("a").alias("lead_y"), "o"))
    room = turned.join(left, "lead_x").join(right, "lead_y").where("(size_x, lead_x) > (size_y, lead_y)") \
        .where(enough(F.col("o") + F.col("most_x") + F.col("most_y"), F.col("low_x"), F.col("low_y")))
    tries = room.join(members.select(F.col("lead").alias("lead_y"), "sid", "n", "extra"), "lead_y") \
        .where(enough(F.col("o") + F.col("extra") + F.col("most_x"), F.col("n"), F.col("low_x")))
    found = _overlaps(tries.select(F.col("lead_x").alias("a"), F.col("sid").alias("b")).distinct(), sets, "setjoin-open", 0)
    linked = _links(F.col("o"), F.col("na"), F.col("nb"), percent)
    near = found.where(~linked)
    follow = members.where("extra > 0 or sid <> lead").withColumnRenamed("lead", "a")
    beyond = _tokens(near, "rest", ["a", "b", "nb", "o"]).join(_tokens(follow, "rest", ["a", "sid", "n"]), ["a", "token"])
    gained = beyond.groupBy("sid", "b").agg(F.count("*").alias("c"), F.first("o").alias("o"), F.first("n").alias("n"), F.first("nb").alias("nb")) \
        .where(enough(F.col("o") + F.col("c"), F.col("n"), F.col("nb"))).select("sid", "b")
    smaller = near.join(follow, "a").where(enough(F.col("o"), F.col("n"), F.col("nb"))).select("sid", "b")
    last = _overlaps(gained.unionByName(smaller).distinct().select(F.col("sid").alias("a"), "b"), sets, "setjoin-rest")
    return found.where(linked).select("a", "b").unionByName(last.where(linked).select("a", "b"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: (``key``, n_shingles: its set's size,
    component_id: the smallest ``key`` reachable over links, itself included).

    Null and empty texts and texts without a word have the empty set, link
    with nothing and keep their own key.  Rows repeated under one key are all
    returned, each in its own text's component; a null key is never chosen as
    component_id, which is null only where no key is reached.  Other columns
    of ``docs`` are not read.
    """
    marked = stored(_digests(docs, key, text, words, percent), "setjoin-digests")
    taken, least = _heads(F.col("n"), percent)
    alone = _tokens(marked, "head", ["d1"]).groupBy("token").agg(F.min("d1").alias("d1"), F.max("d1").alias("other")) \
        .where("d1 = other").groupBy("d1").agg(F.count("*").alias("alone"))
    classes = marked.where("n > 0").groupBy("d1", "d2").agg(F.first("n").alias("n"), F.min("th").alias("th"))
    family = classes.join(alone, "d1", "left").where(taken - F.coalesce("alone", F.lit(0)) >= least)
    sets = _family_sets(docs, text, words, _bloom(family, "th"))

    entries = _prefixes(sets, percent)
    members, star = _members(entries, sets, percent)
    lists = stored(entries.join(members.select("sid", "lead"), "sid").select("token", "n", "cap", "lead"), "setjoin-entries")
    compared = _overlaps(_leader_pairs(lists, percent), sets, "setjoin-compared")
    linked = _links(F.col("o"), F.col("na"), F.col("nb"), percent)
    links = star.unionByName(compared.where(linked).select("a", "b")).unionByName(_open_links(compared.where(~linked), members, sets, percent))

    rooted = sets.join(connected_components(links, "setjoin-components"), F.col("sid") == F.col("node"), "left") \
        .select("d1", "d2", F.coalesce("root", "sid").alias("root"))
    lowest = marked.where("n > 0").groupBy("d1", "d2").agg(F.min("k").alias("lowest")).join(rooted, ["d1", "d2"], "left")
    lowest = stored(lowest, "setjoin-classes")
    top = lowest.where("root is not null").groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = lowest.where("root is not null").join(top, "root").select("d1", "d2", "component_id") \
        .unionByName(lowest.where("root is null").select("d1", "d2", F.col("lowest").alias("component_id")))
    out = marked.select("k", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("k")).alias("component_id"))


OP11_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{WORD_PATTERN}') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
                      WHEN len(words) < {WORDS} THEN [array_to_string(words, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(words) - {WORDS} + 2),
                                                        lambda i: array_to_string(words[i:i + {WORDS - 1}], ' '))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
t AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM t x JOIN t y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= {PERCENT} * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY ALL"""
