"""Run one catalogue query from the command line.

    python -m metrolens list
    python -m metrolens run share_by_bucket --sf-dir /root/testdata/sf0.01 --show 20
    python -m metrolens run nearest_per_event --out /shared/results/c4 --explain

``--out`` writes Parquet (no data passes through the driver); ``--show``
prints the first rows; ``--explain`` prints the physical plan after the run.
"""

from __future__ import annotations

import argparse
import sys
import time

from metrolens.catalog import QUERIES


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="metrolens")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="list query keys")
    run = sub.add_parser("run", help="run a query")
    run.add_argument("key", choices=sorted(QUERIES))
    run.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    run.add_argument("--master", default=None, help="Spark master; default: the one spark-submit provides")
    run.add_argument("--out", default=None, help="write the result as Parquet here")
    run.add_argument("--show", type=int, default=0, help="print this many rows")
    run.add_argument("--explain", action="store_true")
    run.add_argument("--shuffle-gb", type=float, default=None, help="expected size of the largest shuffle, to size partitions")
    run.add_argument("--cores", type=int, default=8, help="cores of the cluster (with --shuffle-gb)")
    run.add_argument("--keep-staged", action="store_true", help="do not delete staged data after the run")
    args = parser.parse_args(argv)

    if args.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0

    from metrolens.plans import plan_text
    from metrolens.session import build_session, clear_staging, cluster_conf

    sized = cluster_conf(args.shuffle_gb * 1e9, args.cores) if args.shuffle_gb else None
    spark = build_session(args.master, f"metrolens-{args.key}", extra_conf=sized)
    start = time.perf_counter()
    df = QUERIES[args.key](spark, args.sf_dir)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    elif args.show:
        df.show(args.show, truncate=False)
    else:
        df.write.format("noop").mode("overwrite").save()
    print(f"{args.key}: {time.perf_counter() - start:.2f}s", file=sys.stderr)
    if args.explain:
        print(plan_text(df))
    if not args.keep_staged:
        clear_staging(spark)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
