"""Steps of the merge into the stored layers."""

import itertools

from pyspark.sql import functions as F

from pumpline.operators import gold, silver
from pumpline.schema import SILVER_COLUMNS


def test_latest_of_copies_is_latest_of_deduplicated_rows_in_one_shuffle(spark):
    from datetime import datetime

    times = [None, datetime(2024, 1, 1), datetime(2024, 1, 2)]
    rows = [(c, p, t, k, r) for c, p, t, k, r in itertools.product([1, 2, None], ["a", None], times, times, ["r1", "r2", None])
            if not (c == 2 and t == times[2])]
    some = spark.createDataFrame(rows, "cnpj bigint, product_code string, price_ts timestamp_ntz, collected_at timestamp_ntz, run_id string")
    copies = some.select(*[F.col(c) if c in some.columns else F.lit(None).cast("string").alias(c) for c in SILVER_COLUMNS])
    got = gold.gold_latest_of_copies(copies)
    want = gold.gold_latest(silver.silver_dedup(copies))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 2


def test_merge_stages_no_second_copy_of_new_observations(spark, sf_small):
    import os

    from pumpline.plans import raw_registry
    lay = raw_registry.incremental_layers(spark, sf_small)
    assert os.path.isdir(lay.stage("new")) and not os.path.isdir(lay.stage("fresh"))
