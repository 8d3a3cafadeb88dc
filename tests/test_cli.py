"""The spark-submit entry point: build, ingest, stream."""

from pumpline.__main__ import main
from pumpline.plans import medallion, snapshots
from pumpline.schema import SILVER_COLUMNS
from pumpline.session import scratch_path
from pumpline.sources import raw as rawsrc, testdata


def test_cli_build_ingest_stream(spark, sf_small):
    tree = snapshots.write_raw_tree(spark, testdata.silver(spark, sf_small, with_obs_id=True))
    out = scratch_path(spark, "cli-layers")
    assert main(["build", "--raw", tree.data_root, "--out", out]) == 0
    layers = medallion.layer_paths(out)
    gold = sorted(rawsrc.scan_table(spark, layers.gold).select(*SILVER_COLUMNS).collect())
    assert len(gold) == testdata.gold(spark, sf_small).count()
    assert main(["ingest", "--raw", tree.data_root, "--out", out, "--run", "run-0000-click"]) == 0
    assert sorted(rawsrc.scan_table(spark, layers.gold).select(*SILVER_COLUMNS).collect()) == gold
    s_out = scratch_path(spark, "cli-stream")
    assert main(["stream", "--raw", tree.data_root, "--out", s_out]) == 0
    assert spark.read.parquet(s_out + "/dedup").count() == testdata.silver(spark, sf_small).count()
