"""Command-line jobs, one per layer.

    spark-submit --py-files strata.zip strata/jobs.py --root s3a://lake/traffic --env prod setup
    ... bronze | silver [--dedup-horizon "7 days"] | gold | all | monitor
    ... recover --table raw_traffic --rule "[Count_date] expect_..." [--repair "Count_date=..."] [--purge]

Locally: ``python -m strata.jobs <same arguments>``.  ``--root`` defaults to
``<spark.checkpoint.dir>/strata/<env>``.  Every stream job is an available-now
run: it processes what has landed since its last checkpoint, waits until
done, and exits (schedule it as often as needed).
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import LayerConfig, shared_dir
from strata.operators.monitor import batch_quality, table_quality
from strata.operators.rules import suite_from_spec
from strata.plans import medallion
from strata.session import get_session
from strata.sinks.tables import layer_exists
from strata.streaming.ingest import run_together

def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata.jobs", description=__doc__.split("\n\n")[0])
    p.add_argument("--root", help="storage root of the environment (shared storage)")
    p.add_argument("--env", default="dev", choices=["dev", "uat", "prod"])
    p.add_argument("--database", default=None, help="catalog database (default traffic_<env>_db)")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("setup", help="create the database, bronze and quarantine tables")
    bronze = sub.add_parser("bronze", help="landing CSV -> validated bronze + quarantine")
    bronze.add_argument("--on-error", default="raise", choices=["raise", "pass_through"])
    silver = sub.add_parser("silver", help="bronze -> silver (dedup, nulls, counts, names)")
    silver.add_argument("--no-dedup", action="store_true")
    silver.add_argument("--dedup-horizon", default=None, help='bound dedup state, e.g. "7 days"')
    sub.add_parser("gold", help="silver -> gold")
    run_all = sub.add_parser("all", help="bronze, silver and gold in order")
    run_all.add_argument("--dedup-horizon", default=None)
    run_all.add_argument("--on-error", default="raise", choices=["raise", "pass_through"])
    sub.add_parser("monitor", help="row counts of every layer table")
    rec = sub.add_parser("recover", help="re-validate and re-insert quarantined rows")
    rec.add_argument("--table", required=True, choices=sorted(medallion.FEEDS))
    rec.add_argument("--rule", default=None, help="only rows that broke this rule label")
    rec.add_argument("--batch-id", default=None, help="a new label (default: made from the recovered rows)")
    rec.add_argument(
        "--repair",
        action="append",
        default=[],
        metavar="COLUMN=SQL",
        help="set a column to a SQL expression before revalidation (may be repeated)",
    )
    rec.add_argument("--purge", action="store_true", help="remove re-inserted rows from the quarantine")
    rec.add_argument(
        "--suite-spec",
        default=None,
        help="JSON file with a corrected rule list ({type, kwargs} entries) to revalidate against",
    )
    return p


def _repair(assignments: list[str]) -> Callable[[DataFrame], DataFrame] | None:
    """``COLUMN=SQL`` assignments as one step over the quarantined rows."""
    if not assignments:
        return None
    columns = dict(a.split("=", 1) for a in assignments)
    return lambda rows: rows.withColumns({c: F.expr(sql) for c, sql in columns.items()})


def config(spark: SparkSession, args: argparse.Namespace) -> LayerConfig:
    root = args.root or shared_dir(spark, "strata", args.env)
    # One metastore may serve every environment: keep their tables apart.
    database = args.database or f"traffic_{args.env}_db"
    return LayerConfig(root=root.rstrip("/"), environment=args.env, database=database)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or get_session(app_name=f"strata-{args.command}")
    cfg = config(spark, args)
    medallion.setup_tables(spark, cfg)
    if args.command == "bronze":
        run_together(medallion.start_bronze_streams(spark, cfg, on_error=args.on_error))
    elif args.command == "silver":
        run_together(
            medallion.start_silver_streams(spark, cfg, dedup=not args.no_dedup, dedup_horizon=args.dedup_horizon)
        )
    elif args.command == "gold":
        run_together(medallion.start_gold_streams(spark, cfg))
        medallion.refresh_gold_reports(spark, cfg)
    elif args.command == "all":
        medallion.run_streams(spark, cfg, dedup_horizon=args.dedup_horizon, on_error=args.on_error)
    elif args.command == "monitor":
        counts = medallion.monitor_tables(spark, cfg)
        counts.show(counts.count(), truncate=False)  # one row a layer
        # Every batch is in the written report; the console gets one row a table.
        report = cfg.report("batch_quality")
        targets = {t: spark.table(cfg.table(t)) for t in medallion.FEEDS}
        quarantine = spark.table(cfg.table(cfg.quarantine_table))
        batch_quality(targets, quarantine).write.mode("overwrite").parquet(report)
        table_quality(spark.read.parquet(report)).show(len(medallion.FEEDS), truncate=False)
        print(f"rates of all batches: {report}")
    elif args.command == "recover":
        if not layer_exists(spark, cfg.quarantine()):
            return 0  # nothing has been quarantined yet
        suite = None
        if args.suite_spec:
            # Through Spark, so it may lie on the shared storage.
            spec = spark.read.text(args.suite_spec, wholetext=True).first()[0]
            suite = suite_from_spec(args.table, json.loads(spec))
        qtable = cfg.table(cfg.quarantine_table)
        medallion.refresh_partitions(spark, qtable)
        medallion.recover_layers(
            spark, cfg, args.table, args.rule, suite, args.purge, batch_id=args.batch_id, repair=_repair(args.repair), quarantine_table=qtable
        )
    return 0


if __name__ == "__main__":
    sys.exit(main())
