"""Chat formatting by rotating the perspective of a many-party dialogue.

For every participant the dialogue is rendered with that speaker as the
assistant and all others as named users; the loss mask covers what the
assistant says.  Turns marked ``system`` belong to every perspective and are
never a participant.

A rendered dialogue is returned in parts of ``PART_TURNS`` turn numbers, so a
conversation of many numbers does not have to fit one row: a part knows where
it begins in the whole, and the parts joined in order are the whole.  A part
is as large as its turns: all that repeat its numbers, or have none, are in one
row, as in the SQL twin.
DataFrame operations only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PART_TURNS = 64
BEGIN, STOP = "<|im_start|>", "<|im_end|>\n"


def _plain(text: Column) -> Column:
    """Text in which no marker of the format can be read: ``<|`` is spread."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
           part_turns: int = PART_TURNS) -> DataFrame:
    """(``conversation``, assistant, part, first_turn, n_turns, begins_at,
    rendered, spans): one row per participant and part.

    Each turn is ``<|im_start|>assistant``, ``user name=...`` or ``system``, a line feed, the
    text and ``<|im_end|>``.  spans holds the masked stretches (start, end) in
    characters of ``rendered``: the assistant's texts with their end mark.
    begins_at is the part's place in the whole dialogue.

    Parts are cut by turn number (turn // part_turns).  Turns equal in number
    come in the order of speaker and text; repeated turns are all rendered.  A
    null speaker speaks as ``unknown``, a null text is empty, and a null turn
    number comes first.  A conversation of system turns alone has no
    perspective and no row; rows with a null conversation form one.
    """
    name = F.when(F.trim(F.coalesce(F.col(speaker), F.lit(""))) == "", "unknown").otherwise(F.regexp_replace(_plain(F.col(speaker)), r"\s+", " "))
    said = turns.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), name.alias("who"), _plain(F.col(text)).alias("said")) \
        .withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("bigint"))
    parts = said.groupBy("conv", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), "who", "said"))).alias("turns"))
    # Where each part begins, from lengths summed by speaker: no text goes through the window.
    fixed = F.length(F.lit(BEGIN)) + 1 + F.length(F.lit(STOP))
    other = F.when(F.col("who") == "system", 6).otherwise(F.length(F.lit("user name=")) + F.length("who"))
    spoken = said.groupBy("conv", "part", "who").agg(F.count("*").alias("n"), F.sum(F.length("said").cast("bigint")).alias("chars")) \
        .select("conv", "part", "who", (F.col("n") * (fixed + other) + F.col("chars")).alias("length"),
                (F.col("n") * (F.length(F.lit("assistant")) - other)).alias("change"))
    whole = spoken.groupBy("conv", "part").agg(F.sum("length").alias("length"))
    people = spoken.where("who <> 'system'").select(F.col("conv").alias("c"), F.col("who").alias("assistant")).distinct()
    own = spoken.where("who <> 'system'").select(F.col("conv").alias("c"), F.col("part").alias("p"), F.col("who").alias("w"), "change")
    sizes = whole.join(people, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    sizes = sizes.join(own, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("assistant") == F.col("w")), "left")
    before = Window.partitionBy("conv", "assistant").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select(F.col("conv").alias("c"), F.col("part").alias("p"), "assistant",
                          F.coalesce(F.sum(F.col("length") + F.coalesce("change", F.lit(0))).over(before), F.lit(0)).alias("begins_at"))
    seen = parts.join(places, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("c", "p")

    def head(t: Column) -> Column:
        return F.concat(F.lit(BEGIN), F.when(t["who"] == "system", "system").when(t["who"] == F.col("assistant"), "assistant")
                        .otherwise(F.concat(F.lit("user name="), t["who"])), F.lit("\n"))

    pieces = F.transform("turns", lambda t: F.struct(head(t).alias("head"), F.concat(t["said"], F.lit(STOP)).alias("body"),
                                                     ((t["who"] == F.col("assistant")) & (t["who"] != "system")).alias("mine")))
    seen = seen.withColumn("pieces", pieces)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), (end - 1).alias("end")))
        return F.struct(end.alias("at"), F.when(p["mine"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    seen = seen.withColumn("walk", F.aggregate("pieces", start, step)).withColumn(
        "rendered", F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["head"], p["body"]))))
    return seen.select(F.col("conv").alias(conversation), "assistant", "part", F.col("turns")[0]["turn"].alias("first_turn"), F.size("turns").alias("n_turns"),
                       "begins_at", "rendered",
                       F.col("walk.spans").alias("spans"))


OP10_SQL = """
WITH said AS (
  SELECT conv_id AS conv, turn, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown'
           ELSE regexp_replace(replace(role, '<|', '< |'), '\\s+', ' ', 'g') END AS who,
         replace(coalesce(text, ''), '<|', '< |') AS said,
         coalesce(CAST(floor(turn / 64) AS BIGINT), -1) AS part
  FROM conversations),
people AS (SELECT DISTINCT conv, who AS assistant FROM said WHERE who <> 'system'),
pieces AS (
  SELECT s.conv, assistant, part, coalesce(turn, -1) AS turn, who, said, who = assistant AS mine,
         '<|im_start|>' || CASE WHEN who = 'system' THEN 'system' WHEN who = assistant THEN 'assistant'
                                ELSE 'user name=' || who END || chr(10) AS head,
         said || '<|im_end|>' || chr(10) AS body
  FROM said s JOIN people p ON s.conv IS NOT DISTINCT FROM p.conv),
placed AS (
  SELECT *, CAST(coalesce(sum(length(head) + length(body)) OVER (
      PARTITION BY conv, assistant, part ORDER BY turn, who, said ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS begins
  FROM pieces),
parts AS (
  SELECT conv, assistant, part, min(turn) AS first_turn, CAST(count(*) AS INT) AS n_turns,
         string_agg(head || body, '' ORDER BY turn, who, said) AS rendered,
         coalesce(string_agg(CASE WHEN mine THEN (begins + length(head)) || '-' || (begins + length(head) + length(body) - 1) END, ',' ORDER BY begins), '') AS mask
  FROM placed GROUP BY conv, assistant, part)
SELECT conv AS conv_id, assistant, part, first_turn, n_turns,
       CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY conv, assistant ORDER BY part
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begins_at, rendered, mask
FROM parts
"""
