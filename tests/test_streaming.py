"""Streaming = batch on the derived raw tree; late data against the watermark."""

import datetime as dt

from pyspark.sql import functions as F

from pumpline.operators import gold, silver
from pumpline.plans import snapshots
from pumpline.session import scratch_path
from pumpline.sources import raw as rawsrc, testdata
from pumpline.streaming import jobs
from tests.helpers import obs, silver_df


LINEAGE = ["cnpj", "product_code", "price_ts", "price_unit", "run_id", "collected_at"]


def test_stream_chain_equals_batch(spark, sf_small):
    """Gold equals batch at once, the deduplicated rows as far as they are final."""
    t = snapshots.write_raw_tree(spark, testdata.silver(spark, sf_small, with_obs_id=True))
    sv = jobs.stream_bronze_silver(spark, t.data_root, max_files_per_trigger=50).output
    dd = jobs.stream_dedup(spark, sv).output
    batch = silver.silver_dedup(silver.silver_typed(silver.silver_flatten(rawsrc.scan_raw(spark, t.data_root))))
    end = batch.agg(F.max("price_ts")).first()[0] - dt.timedelta(hours=72)
    final = [r for r in batch.select(*LINEAGE).collect() if r.price_ts <= end]
    assert sorted(spark.read.parquet(dd).select(*LINEAGE).collect()) == sorted(final) and len(final) > 100
    g = jobs.read_gold(spark, jobs.stream_gold_latest(spark, sv, max_files_per_trigger=1).output)
    assert sorted(g.select(*LINEAGE).collect()) == sorted(gold.gold_latest(batch).select(*LINEAGE).collect())
    daily = jobs.read_daily(spark, jobs.stream_daily(spark, dd).output)
    assert daily.agg(F.sum("samples")).first()[0] == len(final)


def _write_silver_batch(spark, rows, path):
    silver_df(spark, rows).write.mode("append").parquet(path)


def test_late_data_against_watermark(spark):
    """An observation first collected 60 h after it happened is kept; one
    collected 80 h late (past the 72 h watermark) is dropped.  Rows come out
    when they are final."""
    path, out = scratch_path(spark, "late-src"), scratch_path(spark, "late-dedup")

    def after(rows):
        _write_silver_batch(spark, rows, path)
        run = jobs.stream_dedup(spark, path, out=out)
        return run, {r.cnpj for r in spark.read.schema("cnpj bigint").parquet(out).collect()}

    after([obs(1, 5.0, 0)])                                          # event at T0
    assert after([obs(2, 5.0, -100)])[1] == {1}                      # the watermark comes to T0 + 28 h
    run, got = after([obs(3, 5.0, -40), obs(4, 5.0, -20)])           # 60 h and 80 h behind
    assert got == {1} and jobs.watermark_drops(run) == 1
    assert after([obs(5, 5.0, -300)])[1] == {1, 2, 3}


def test_stream_dedup_keeps_the_earliest_copy(spark):
    """Whatever order the copies arrive in, within a batch and across."""
    path, out = scratch_path(spark, "copies-src"), scratch_path(spark, "copies-dedup")
    _write_silver_batch(spark, [obs(1, 5.0, 10, run="r5", collected_hours_ago=1)] * 50 + [obs(1, 5.0, 10, run="r3", collected_hours_ago=3)], path)
    jobs.stream_dedup(spark, path, out=out)
    _write_silver_batch(spark, [obs(1, 5.0, 10, run="r2", collected_hours_ago=5), obs(1, 5.0, 10, run="r1", collected_hours_ago=5)], path)
    jobs.stream_dedup(spark, path, out=out)
    _write_silver_batch(spark, [obs(9, 5.0, -200)], path)
    jobs.stream_dedup(spark, path, out=out)
    assert [(r.cnpj, r.run_id) for r in spark.read.parquet(out).collect()] == [(1, "r1")]


def test_stream_gold_rewrites_touched_buckets_only(spark):
    from pumpline.sinks import versions
    src, out = scratch_path(spark, "gold-src"), scratch_path(spark, "gold-out")
    _write_silver_batch(spark, [obs(i, 5.0, 3) for i in range(200)], src)
    jobs.stream_gold_latest(spark, src, out=out)
    before = set(versions.current_paths(spark, out))
    _write_silver_batch(spark, [obs(7, 6.0, 2), obs(8, 4.0, 9)], src)  # 8 is older than what is stored
    jobs.stream_gold_latest(spark, src, out=out)
    assert len(before - set(versions.current_paths(spark, out))) <= 2
    got = {r.cnpj: r.price_unit for r in jobs.read_gold(spark, out).collect()}
    assert got == {i: 6.0 if i == 7 else 5.0 for i in range(200)}


def test_stream_price_drop_emits_per_epoch_and_forgets(spark):
    """Alerts leave when their window is final; the state does not keep windows that are."""
    src, out = scratch_path(spark, "drop-src"), scratch_path(spark, "drop-out")
    counts = []
    for day in range(0, 40, 5):  # T0 is noon of a day; prices fall by 10 % every second day
        _write_silver_batch(spark, [obs(c, 10.0 if (day + d) % 2 else 9.0, -24 * (day + d)) for d in range(5) for c in (1, 2, 3)], src)
        run = jobs.stream_price_drop(spark, src, out=out, hours=24, pct_drop=5.0)
        counts.append(spark.read.schema("cnpj bigint").parquet(out).count())
        state = [op.numRowsTotal for op in run.query.lastProgress.stateOperators]
    assert counts == sorted(counts) and counts[0] < counts[3] < counts[-1]
    rows = spark.read.parquet(out).collect()
    end = dt.datetime(2024, 1, 10, 12) + dt.timedelta(days=39) - dt.timedelta(hours=72)
    want = {(c, dt.datetime(2024, 1, 10) + dt.timedelta(days=d)) for c in (1, 2, 3) for d in range(2, 40, 2)
            if dt.datetime(2024, 1, 11) + dt.timedelta(days=d) <= end}
    assert {(r.cnpj, r.window_start) for r in rows} == want and len(rows) == len(want)
    assert all(abs(r.pct_drop - 10.0) < 1e-9 for r in rows)
    assert sum(state) < 120


def test_late_data_report(spark):
    rows = [obs(1, 5.0, 10, collected_hours_ago=0), obs(2, 5.0, 80, collected_hours_ago=0)]
    r = jobs.late_data_report(silver_df(spark, rows)).collect()[0]
    assert r.rows == 2 and r.max_lag_h == 80.0 and r.later_than_72h == 1


def test_stream_into_layers_equals_batch_and_replays_safely(spark, sf_small):
    from pumpline.plans import medallion, raw_registry
    from pumpline.schema import SILVER_COLUMNS
    t = raw_registry.tree(spark, sf_small)
    lay = medallion.layer_paths(scratch_path(spark, "stream-layers-test"))
    jobs.stream_into_layers(spark, t.data_root, lay, max_files_per_trigger=20)
    full = raw_registry.layers(spark, sf_small)

    def rows(path):
        return sorted(rawsrc.scan_table(spark, path).select(*SILVER_COLUMNS).collect())
    assert rows(lay.silver) == rows(full.silver)
    assert rows(lay.gold) == rows(full.gold)
    # replaying an epoch (a retried batch) leaves the same tables
    some = rawsrc.scan_raw(spark, t.data_root).filter(F.col("run_id").startswith("run-0001-"))
    medallion.merge_new_rows(spark, medallion.add_to_bronze(spark, some, lay), lay)
    assert rows(lay.silver) == rows(full.silver)
    assert rows(lay.gold) == rows(full.gold)


def test_stream_into_layers_continuous_mode(spark, sf_small):
    import time

    from pumpline.plans import medallion, raw_registry
    t = raw_registry.tree(spark, sf_small)
    lay = medallion.layer_paths(scratch_path(spark, "stream-layers-continuous"))
    run = jobs.stream_into_layers(spark, t.data_root, lay, available_now=False)
    try:
        deadline = time.time() + 180
        while time.time() < deadline and run.query.lastProgress is None:
            time.sleep(2)
        run.query.processAllAvailable()
    finally:
        run.query.stop()
    assert spark.read.parquet(lay.gold).count() == testdata.gold(spark, sf_small).count()


def test_daily_and_drops_hold_what_is_not_final_too(spark):
    """All days and windows come out, whatever the watermark still holds back; also after a drain that makes nothing final."""
    src, out = scratch_path(spark, "open-src"), scratch_path(spark, "open-out")
    rows = []

    def drain(hours):
        new = [obs(c, 10.0 if h // 24 % 2 else 9.0, 12 - h) for h in hours for c in (1, 2)]  # h hours after midnight before T0
        rows.extend((r[4], r[15], r[16]) for r in new)
        _write_silver_batch(spark, new * 2, src)
        run = jobs.stream_dedup(spark, src, out=f"{out}/state=final", checkpoint=f"{out}/ckpt")
        jobs.write_open(spark, run, src, f"{out}/state=open")
        daily = jobs.stream_daily(spark, f"{out}/state=final", out=f"{out}/daily").output
        drops = jobs.stream_price_drop(spark, f"{out}/state=final", out=f"{out}/drops", hours=24, pct_drop=5.0).output
        days = {r.day: (r.samples, r.avg_price_unit) for r in jobs.read_daily(spark, daily, f"{out}/state=open").collect()}
        got = jobs.read_drops(spark, drops, f"{out}/state=final", f"{out}/state=open", hours=24, pct_drop=5.0).collect()
        assert sum(n for n, _ in days.values()) == len(rows)
        prices = {}
        for cnpj, ts, price in rows:
            prices.setdefault((cnpj, dt.datetime(ts.year, ts.month, ts.day)), []).append(price)
        assert {d for _, d in prices} == set(days)
        mean = {k: sum(p) / len(p) for k, p in prices.items()}
        want = {k for k, m in mean.items() if (before := mean.get((k[0], k[1] - dt.timedelta(days=1)))) and m <= 0.95 * before}
        assert {(r.cnpj, r.window_start) for r in got} == want and len(got) == len(want)
        return days, got

    first, _ = drain(range(0, 30, 5))             # nothing is final yet
    days, got = drain(range(33, 240, 7))
    again, more = drain([175])                    # changes a day that is open, makes nothing final
    assert len(first) == 2 and len(days) == 10 and len(got) == 8 and days != again


def test_state_partitions_do_not_follow_the_session(spark):
    """Tasks report figures of every state partition, so their number is bounded; a checkpoint keeps its own."""
    path, out = scratch_path(spark, "parts-src"), scratch_path(spark, "parts-dedup")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "300")
        _write_silver_batch(spark, [obs(1, 5.0, 0)], path)
        run = jobs.stream_dedup(spark, path, out=out)
        assert {op.numShufflePartitions for op in run.query.lastProgress.stateOperators} == {jobs.STATE_PARTITIONS}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "300"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sliding_drops_keep_their_state_on_disk(spark, tmp_path):
    """Sliding windows over a long history outgrow the heap; same alerts, state in RocksDB."""
    rows = [obs(c, p, h) for c in range(6) for p, h in ((5.0, 160), (4.0 + c / 5, 136), (4.0, 112), (4.0, 2))]
    src = str(tmp_path / "dedup")
    silver_df(spark, rows).write.parquet(src)
    run = jobs.stream_price_drop(spark, src, slide_hours=12, out=str(tmp_path / "drops"))
    assert "RocksDBStateStoreProvider" in (tmp_path / "drops-ckpt" / "offsets" / "0").read_text()
    got = {(r.cnpj, str(r.window_start)) for r in spark.read.parquet(run.output).collect()}
    batch = jobs._drop_alerts(lambda later: jobs._timed(spark.read.parquet(src)).withColumn("event_time", jobs._moved(later)), 24, 3.0, 12)
    passed = max(r[15] for r in rows) - dt.timedelta(hours=72)
    want = {(r.cnpj, str(r.window_start)) for r in batch.collect() if r.window_start + dt.timedelta(hours=24) <= passed}
    assert got == want and got
