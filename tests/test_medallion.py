"""Incremental ingestion equals the full build and is idempotent."""

from pyspark.sql import functions as F

from pumpline.plans import medallion, raw_registry
from pumpline.schema import SILVER_COLUMNS
from pumpline.sources import raw as rawsrc


def _rows(spark, path):
    return sorted(rawsrc.scan_table(spark, path).select(*SILVER_COLUMNS).collect())


def test_incremental_equals_full_and_is_idempotent(spark, sf_small):
    full = raw_registry.layers(spark, sf_small)
    inc = raw_registry.incremental_layers(spark, sf_small)
    assert _rows(spark, inc.silver) == _rows(spark, full.silver)
    assert _rows(spark, inc.gold) == _rows(spark, full.gold)
    assert sorted(rawsrc.scan_table(spark, inc.labels).collect()) == sorted(rawsrc.scan_table(spark, full.labels).collect())
    before = (_rows(spark, inc.silver), _rows(spark, inc.gold), rawsrc.scan_table(spark, inc.bronze).count())
    medallion.ingest_runs(spark, raw_registry.tree(spark, sf_small).data_root, inc,
                          F.col("run_id").startswith("run-0000-"))
    after = (_rows(spark, inc.silver), _rows(spark, inc.gold), rawsrc.scan_table(spark, inc.bronze).count())
    assert before == after


def test_out_of_order_run_keeps_earliest_collection(spark, sf_small):
    """A middle collection ingested last holds earlier copies of stored
    observations: the merge must rewrite those partitions (earliest copy
    wins) and end equal to the full build."""
    from pumpline.session import scratch_path
    full = raw_registry.layers(spark, sf_small)
    root = raw_registry.tree(spark, sf_small).data_root
    middle = F.col("run_id").startswith("run-0001-")
    lay = medallion.layer_paths(scratch_path(spark, "layers-out-of-order"))
    from pumpline.sinks import raw as rawsink
    rawsink.write_bronze(rawsrc.scan_raw(spark, root).filter(~middle), lay.bronze)
    medallion.build_silver(spark, lay)
    medallion.build_gold(spark, lay)
    medallion.ingest_runs(spark, root, lay, middle)
    assert _rows(spark, lay.silver) == _rows(spark, full.silver)
    assert _rows(spark, lay.gold) == _rows(spark, full.gold)
    assert _base(spark, lay) == _base(spark, full)


def _base(spark, lay):
    cols = ["fuel_type", "uf", "city", "cnpj", "day", "n_price_unit", "samples", "min_price_unit", "max_price_unit"]
    return sorted(rawsrc.scan_table(spark, lay.daily_base).select(*cols).collect(), key=str)


def test_lost_gold_and_killed_writes(spark, sf_small):
    """A merge that finds gold missing rebuilds it from silver; an incomplete
    version is not read; missing silver beside gold is an error."""
    import pytest

    from pumpline.session import scratch_path
    from pumpline.sinks import versions
    full = raw_registry.layers(spark, sf_small)
    root = raw_registry.tree(spark, sf_small).data_root
    last = F.col("run_id").startswith("run-0000-")
    lay = medallion.layer_paths(scratch_path(spark, "layers-lost"))
    medallion.ingest_runs(spark, root, lay, ~last)
    gold_rows = rawsrc.scan_table(spark, lay.gold).count()
    # A killed write: files, but no mark of completion.
    spark.range(5).withColumn("bucket", F.lit(0)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .partitionBy("bucket").parquet(lay.gold + "/version=0000000099")
    assert rawsrc.scan_table(spark, lay.gold).count() == gold_rows
    lost = medallion.Layers(lay.bronze, lay.silver, lay.gold + "-lost", lay.daily_base, lay.staging, lay.labels)
    medallion.ingest_runs(spark, root, lost, last)
    assert _rows(spark, lost.gold) == _rows(spark, full.gold) and _rows(spark, lost.silver) == _rows(spark, full.silver)
    assert _base(spark, lost) == _base(spark, full)
    assert len(versions.current_paths(spark, lost.gold)) <= versions.BUCKETS
    gone = medallion.Layers(lay.bronze, lay.silver + "-lost", lay.gold, lay.daily_base, lay.staging, lay.labels)
    with pytest.raises(FileNotFoundError):
        medallion.ingest_runs(spark, root, gone, last)


def test_bronze_of_batch_and_stream_rebuilds_silver(spark, sf_small):
    from pumpline.session import scratch_path
    from pumpline.streaming import jobs
    full = raw_registry.layers(spark, sf_small)
    root = raw_registry.tree(spark, sf_small).data_root
    lay = medallion.layer_paths(scratch_path(spark, "layers-mixed"))
    medallion.ingest_runs(spark, root, lay, F.col("run_id").startswith("run-0001-"))
    jobs.stream_into_layers(spark, root, lay, max_files_per_trigger=40)
    again = medallion.Layers(lay.bronze, lay.silver + "-again", lay.gold, lay.daily_base, lay.staging, lay.labels)
    medallion.build_silver(spark, again)
    assert _rows(spark, again.silver) == _rows(spark, full.silver) == _rows(spark, lay.silver)
    assert not [c for c in rawsrc.scan_table(spark, lay.bronze).inputFiles() if "run_id=" in c]
