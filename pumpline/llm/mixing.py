"""Mixing sources to target weights by weighted fair queueing.

DataFrame operations only.  Documents of a source queue in the order of a hash
of their key, size and number among rows equal in both, as often as ``cap``
times.  A copy's virtual finish time is the
source's words up to and with it, divided by the source's target; all copies
are range-sorted by that time, and the queue ends where the total budget is
used up.  A source's words thus grow in proportion to its target.

Running sums never put a source, or the whole queue, into one task: they are
taken within ranges (three hex digits of the hash; Spark's range partitions)
and shifted by the sums of the ranges before.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pumpline.llm.common import WORD_PATTERN, free_name, stored

WEIGHTS = (5, 2, 1)
CAP = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """From (sn, sv, source_size), a row per source, the target of each.

    Sources in code point order (null last) weigh ``weights``, repeating.  The
    targets share the sum of all sizes by weight but stop at ``cap`` times a
    source's size; what is left over goes to the others by weight.  In the
    order of cap * size / weight the stopped sources come first, so one pass
    with running sums finds the common level of the others.
    """
    rank = F.row_number().over(Window.orderBy("sn", "sv")) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (rank % len(weights) + 1).cast("int")).cast("double")
    limit = (F.col("source_size") * cap).cast("double")
    order = Window.orderBy(F.col("limit") / F.col("w"), "sn", "sv")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (F.sum(F.col("source_size").cast("double")).over(everything) - before) / rest
    return (sizes.withColumn("w", w).withColumn("limit", limit).withColumn("level", level)
            .withColumn("stopped", F.col("level") * F.col("w") >= F.col("limit"))
            .withColumn("common", F.max(F.when(~F.col("stopped"), F.col("level"))).over(everything))
            .select("sn", "sv", "source_size", F.when(F.col("stopped"), F.col("limit")).otherwise(F.col("common") * F.col("w")).alias("target")))


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
                cap: int = CAP) -> DataFrame:
    """One row per row of ``docs``: (``key``, ``source``, size, source_size,
    target, taken).  size counts words; taken is size times the copies of the
    document that the mix holds (0 to ``cap``).

    A document without words is never taken.  Repeated rows queue one by one;
    the order among rows equal in key, source and size is of no consequence.
    They are numbered by the stored table's read tasks and, within a task, in
    it; the number goes into the hash, so that rows without a key, or with one
    that repeats, spread over all ranges.  The order depends on nothing but
    keys, sizes and how often they occur, so reruns agree.
    """
    kn, sn = F.col(key).isNull(), F.col(source).isNull()
    sized = stored(docs.select(F.col(key).alias("k"), kn.cast("int").alias("kn"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("kv"),
                               sn.cast("int").alias("sn"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("sv"),
                               word_count(F.col(text)).alias("size"), F.spark_partition_id().alias("task")), "mix-sizes")
    equal = ["kn", "kv", "sn", "sv", "size"]
    earlier = Window.partitionBy(*equal).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    groups = sized.groupBy(*equal, "task").agg(F.count("*").alias("n")).withColumn("others", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    number = F.col("others") + F.row_number().over(Window.partitionBy(*equal, "task").orderBy("k"))
    sized = sized.join(groups, [*equal, "task"]).withColumn("h", F.md5(F.concat_ws(":", "kv", "size", number).cast("binary")))
    sized = stored(sized.select("k", "sn", "sv", "h", "size", F.substring("h", 1, 3).alias("r")), "mix-hashed")
    who = ["sn", "sv"]
    ranges = sized.groupBy(*who, "r").agg(F.sum("size").alias("words"))
    targets = source_targets(ranges.groupBy(*who).agg(F.sum("words").alias("source_size")), weights, cap)
    ahead = Window.partitionBy(*who).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
    here = Window.partitionBy(*who, "r").orderBy("h", "k", "size")
    queue = (sized.join(ranges, [*who, "r"])
             .withColumn("place", F.row_number().over(here))
             .withColumn("words", F.col("ahead") + F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, 0)))
             .join(targets, who))
    queue = stored(queue.select("k", *who, "r", "place", "size", "source_size", "target", "words"), "mix-queue")

    copies = queue.where("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))) \
        .withColumn("finish", (F.col("copy") * F.col("source_size") + F.col("words")).cast("double") / F.col("target"))
    line = ["finish", *who, "r", "place", "copy"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = stored(copies.select(*line, "size").repartitionByRange(parts, *line).withColumn("part", F.spark_partition_id()), "mix-copies")
    done = copies.groupBy("part").agg(F.sum("size").alias("words"))
    done = done.withColumn("ahead", F.coalesce(F.sum("words").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    budget = queue.agg(F.sum("size").alias("budget"))
    whole = done.withColumn("budget", F.lit(budget.first().budget).cast("bigint"))
    within = Window.partitionBy("part").orderBy(*line).rowsBetween(Window.unboundedPreceding, 0)
    taken = copies.join(whole.drop("words"), "part").withColumn("sofar", F.col("ahead") + F.sum("size").over(within)).where("sofar <= budget")
    counted = taken.groupBy(*who, "r", "place").agg(F.sum("size").alias("taken"))
    return (queue.join(counted, [*who, "r", "place"], "left")
            .select(F.col("k").alias(key), F.when(F.col("sn") == 0, F.col("sv")).alias(source), "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
                    cap: int = CAP) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the
    columns of ``docs``.  Rows equal in key, source and size share their copies
    evenly.  Such rows meet in one task only if their texts are equal too."""
    kn, kv, sn, sv, size, copies, rows, ahead, part, row, mine, copy = [
        free_name(docs, f"_{c}") for c in ("kn", "kv", "sn", "sv", "size", "copies", "rows", "ahead", "part", "row", "mine", "copy")]

    def keyed(df: DataFrame, words: Column) -> DataFrame:
        return df.withColumns({kn: F.col(key).isNull().cast("int"), kv: F.coalesce(F.col(key).cast("string"), F.lit("")),
                               sn: F.col(source).isNull().cast("int"), sv: F.coalesce(F.col(source).cast("string"), F.lit("")), size: words})

    same = [kn, kv, sn, sv, size]
    share = keyed(mix_sources(docs, key, text, source, weights, cap).where("taken > 0"), F.col("size")).groupBy(*same) \
        .agg(F.sum(F.col("taken") / F.col("size")).cast("bigint").alias(copies))
    # Each part (rows of one text) of a group of equal rows: its rows, those of the parts before and the group's copies.
    split = keyed(docs, word_count(F.col(text))).withColumn(part, F.xxhash64(F.col(text)))
    group = Window.partitionBy(*same)
    parts = split.groupBy(*same, part).agg(F.count("*").alias(row)) \
        .withColumn(rows, F.sum(row).over(group)) \
        .withColumn(ahead, F.coalesce(F.sum(row).over(group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop(row)
    numbered = split.withColumn(row, F.row_number().over(Window.partitionBy(*same, part).orderBy(*same))) \
        .join(parts.join(share, same), [*same, part]).withColumn(row, F.col(ahead) + F.col(row))
    given = F.floor(F.col(copies) * F.col(row) / F.col(rows)) - F.floor(F.col(copies) * (F.col(row) - 1) / F.col(rows))
    return (numbered.withColumn(mine, given).where(F.col(mine) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(mine).cast("int")))).select(*docs.columns))


OP8_SQL = rf"""
WITH sized AS (
  SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size || ':'
                || row_number() OVER (PARTITION BY doc_id, source, size)) AS h
  FROM (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0) AS BIGINT) AS size
        FROM documents)),
placed AS (
  SELECT *, row_number() OVER q AS place,
         CAST(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS words
  FROM sized WINDOW q AS (PARTITION BY source ORDER BY h, doc_id, size)),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS lim,
         (CAST(sum(source_size) OVER () AS DOUBLE)
          - coalesce(sum(CAST(3 * source_size AS DOUBLE)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM sources WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source IS NULL, source)),
targets AS (
  SELECT source, source_size,
         CASE WHEN lvl * w >= lim THEN lim
              ELSE max(CASE WHEN lvl * w < lim THEN lvl END) OVER () * w END AS target
  FROM levels),
copies AS (
  SELECT p.source, place, size, copy, CAST(copy * source_size + words AS DOUBLE) / target AS finish
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1), (2)) c(copy)
  WHERE size > 0),
line AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, source, place, copy ROWS UNBOUNDED PRECEDING) AS sofar
  FROM copies),
counted AS (
  SELECT source, place, sum(size) AS taken FROM line
  WHERE sofar <= (SELECT sum(size) FROM sized) GROUP BY source, place)
SELECT p.doc_id, p.size, t.source_size, t.target, CAST(coalesce(c.taken, 0) AS BIGINT) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
LEFT JOIN counted c ON p.source IS NOT DISTINCT FROM c.source AND p.place = c.place
"""
