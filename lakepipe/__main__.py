"""Command line: ``python -m lakepipe {seed,ingest,silver,gold} ...``.

Meant for ``spark-submit``: the session (master, resources, the shared
``spark.checkpoint.dir``) comes from the submit configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import SparkSession


def _args(argv):
    ap = argparse.ArgumentParser(prog="lakepipe")
    sub = ap.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="source DB -> bronze (incremental by watermark)")
    ing.add_argument("--root", required=True)
    ing.add_argument("--host", default=os.environ.get("LAKEPIPE_DB_HOST"))
    ing.add_argument("--port", default=os.environ.get("LAKEPIPE_DB_PORT", "5432"))
    ing.add_argument("--database", default=os.environ.get("LAKEPIPE_DB_NAME"))
    ing.add_argument("--user", default=os.environ.get("LAKEPIPE_DB_USER"))
    ing.add_argument("--schedule", choices=["hourly", "daily", "weekly"])
    ing.add_argument("--table", action="append", help="only these tables (repeatable)")
    ing.add_argument("--full", action="store_true", help="backfill: full reload")
    ing.add_argument("--since")
    ing.add_argument("--until")
    ing.add_argument("--parallelism", type=int, default=1)
    ing.add_argument("--overlap-seconds", type=int, default=0)
    ing.add_argument("--partition-column", action="append", default=[], metavar="TABLE=COLUMN",
                     help="read TABLE in ranges of COLUMN instead of its change column (repeatable)")
    ing.add_argument("--jdbc-partitions", type=int, default=16,
                     help="ranges each table is read in; 1: one connection a table")
    ing.add_argument("--run-date", default=dt.date.today().isoformat())

    sd = sub.add_parser("seed", help="seed CSV / zipped CSV files -> source database tables (append)")
    sd.add_argument("--data-dir", required=True)
    sd.add_argument("--host", default=os.environ.get("LAKEPIPE_DB_HOST"))
    sd.add_argument("--port", default=os.environ.get("LAKEPIPE_DB_PORT", "5432"))
    sd.add_argument("--database", default=os.environ.get("LAKEPIPE_DB_NAME"))
    sd.add_argument("--user", default=os.environ.get("LAKEPIPE_DB_USER"))
    sd.add_argument("--skip-failed", action="store_true", help="report a failed table and go on")
    sd.add_argument("--translation", action="store_true",
                    help="load only the category translation file (key generated by the database)")

    sil = sub.add_parser("silver", help="bronze -> silver (stream, availableNow)")
    sil.add_argument("--root", required=True)
    sil.add_argument("--entity", action="append", help="only these entities (repeatable)")
    sil.add_argument("--buckets", type=int, default=256,
                     help="buckets of a silver table (a batch rewrites the buckets it touches); 0: a snapshot a batch")
    sil.add_argument("--range", action="append", default=[], metavar="ENTITY=WIDTH",
                     help="range layout for an entity whose id grows with time (repeatable)")
    sil.add_argument("--guard-stale", action="store_true")
    sil.add_argument("--max-files-per-trigger", type=int, help="split a large backlog into micro-batches")
    sil.add_argument("--keep-versions", type=int, default=3,
                     help="snapshots kept by unbucketed (versioned) silver tables")

    gld = sub.add_parser("gold", help="silver -> gold KPI tables")
    gld.add_argument("--root", required=True)
    gld.add_argument("--table", action="append", help="only these gold tables (repeatable)")
    gld.add_argument("--as-of", help="pin 'now' (YYYY-MM-DD[ HH:MM:SS])")
    gld.add_argument("--snapshots", action="store_true", help="commit each table as a new snapshot")
    gld.add_argument("--publish-schema", help="with --snapshots: point <schema>.<table> views at them")
    return ap.parse_args(argv)


def main(argv=None) -> int:
    a = _args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"lakepipe-{a.cmd}").getOrCreate()
    from lakepipe.clock import Clock
    from lakepipe.sources.layout import LakeLayout

    if a.cmd == "seed":
        from lakepipe.sources.jdbc import JdbcOptions
        from lakepipe.sources.seed import SEED_SCHEMAS, TRANSLATION_SEED, jdbc_sink, jdbc_stored, load_seeds

        opts = JdbcOptions(a.host, a.port, a.database, a.user, os.environ.get("LAKEPIPE_DB_PASSWORD", ""))
        tables = TRANSLATION_SEED if a.translation else None
        # The translation's key comes from the database, so its contract has no key column here.
        schemas = None if a.translation else SEED_SCHEMAS
        res = load_seeds(spark, a.data_dir, jdbc_sink(opts), tables=tables, schemas=schemas, stored=jdbc_stored(spark, opts),
                         on_error="skip" if a.skip_failed else "raise")
        if a.translation and res[0].status == "missing":
            raise SystemExit(f"seed file not found: {res[0].file}")
        print(json.dumps([{"table": r.table, "status": r.status, "rows": r.rows, "error": r.error} for r in res]))
        return 0
    lake = LakeLayout(a.root)
    if a.cmd == "ingest":
        from lakepipe.plans.ingest import TABLE_SPECS, WatermarkStore, backfill, ingest_all, jdbc_source
        from lakepipe.sources.jdbc import JdbcOptions

        opts = JdbcOptions(a.host, a.port, a.database, a.user, os.environ.get("LAKEPIPE_DB_PASSWORD", ""))
        specs = [s for s in TABLE_SPECS.values() if not a.table or s.name in a.table]
        store = WatermarkStore(spark, lake.watermarks())
        part_cols = dict(pc.split("=", 1) for pc in a.partition_column)
        src = jdbc_source(spark, opts, part_cols, a.jdbc_partitions)
        if a.full:
            res = backfill(spark, specs, src, lake, store, a.run_date, a.since, a.until, a.parallelism)
        else:
            res = ingest_all(spark, specs, src, lake, store, a.run_date, a.schedule,
                             parallelism=a.parallelism, overlap_seconds=a.overlap_seconds)
        print(json.dumps([{"table": r.table, "mode": r.mode, "rows": r.rows, "watermark": str(r.watermark)}
                          for r in res]))
    elif a.cmd == "silver":
        from lakepipe.plans.silver import SILVER_SPECS
        from lakepipe.sinks.tables import BucketedTable, VersionedTable, open_table
        from lakepipe.streaming.silver_stream import run_silver_tables

        specs = [s for s in SILVER_SPECS.values() if not a.entity or s.entity in a.entity]

        ranges = {e: int(w) for e, w in (r.split("=", 1) for r in a.range)}

        def table_for(spec):
            root = lake.silver(spec.entity)
            if spec.entity in ranges:
                return BucketedTable(spark, root, [spec.pk], range_width=ranges[spec.entity])
            stored = open_table(spark, root)
            if isinstance(stored, BucketedTable) or stored.exists():
                return stored if isinstance(stored, BucketedTable) else VersionedTable(spark, root, keep=a.keep_versions)
            if a.buckets:
                return BucketedTable(spark, root, [spec.pk], a.buckets)
            return VersionedTable(spark, root, keep=a.keep_versions)

        run_silver_tables(spark, lake, specs, table_for, guard_stale=a.guard_stale,
                          max_files_per_trigger=a.max_files_per_trigger)
        print(json.dumps({"silver": [s.entity for s in specs]}))
    else:
        from lakepipe.plans.gold import run_gold
        from lakepipe.sinks.tables import open_table

        from lakepipe.sources.catalog import Layer

        publish = Layer(a.publish_schema) if a.publish_schema else None
        if publish is not None and not a.snapshots:
            raise SystemExit("--publish-schema needs --snapshots")
        reports = run_gold(spark, lambda e: open_table(spark, lake.silver(e)).read(), lake.gold,
                           Clock(a.as_of), names=a.table, snapshots=a.snapshots, publish=publish)
        print(json.dumps({k: v.action for k, v in reports.items()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
