"""Job entry point.

  python -m pumpline build  --raw RAW_ROOT --out LAYERS_ROOT
  python -m pumpline ingest --raw RAW_ROOT --out LAYERS_ROOT --dt 2026-01-16 [--run RUN_ID ...]
  python -m pumpline stream --raw RAW_ROOT --out STREAM_ROOT [--continuous] [--into-layers]

On a cluster the same commands go through ``scripts/pumpline_job.py``:
``spark-submit --py-files pumpline.zip scripts/pumpline_job.py build ...``.  ``build`` runs the
full medallion job; ``ingest`` adds the runs of one collection day (or the
named runs) incrementally; ``stream`` runs the Structured Streaming chain.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import medallion
from .session import configure
from .streaming import jobs


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="pumpline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("build", "ingest", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--raw", required=True, help="root of the raw snapshot tree")
        p.add_argument("--out", required=True, help="root of the output tables")
        if name == "ingest":
            p.add_argument("--dt", help="collection day (dt=) whose runs to ingest")
            p.add_argument("--run", action="append", default=[], help="run_id to ingest (repeatable)")
        if name == "stream":
            p.add_argument("--continuous", action="store_true", help="keep running instead of draining once")
            p.add_argument("--into-layers", action="store_true",
                           help="merge each micro-batch into the stored layers instead of the stateful chain")
    args = ap.parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"pumpline-{args.cmd}").getOrCreate())
    if args.cmd == "build":
        medallion.run(spark, args.raw, args.out)
    elif args.cmd == "ingest":
        if not args.dt and not args.run:
            ap.error("ingest needs --dt or --run")
        pred = F.lit(True)
        if args.dt:
            pred = pred & (F.col("dt") == F.lit(args.dt).cast("date"))
        if args.run:
            pred = pred & F.col("run_id").isin(*args.run)
        medallion.ingest_runs(spark, args.raw, medallion.layer_paths(args.out), pred)
    elif args.into_layers:
        jobs.stream_into_layers(spark, args.raw, medallion.layer_paths(args.out),
                                checkpoint=args.out.rstrip("/") + "/_checkpoint", available_now=not args.continuous)
        if args.continuous:
            spark.streams.awaitAnyTermination()
    else:
        chain = jobs.run_chain(spark, args.raw, args.out, available_now=not args.continuous, with_open=not args.continuous)
        if args.continuous:
            spark.streams.awaitAnyTermination()
        print(chain)
    return 0


if __name__ == "__main__":
    sys.exit(main())
