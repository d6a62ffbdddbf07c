"""Command line: the four stages, the batch runner and the views.

    python -m viewlog bronze --source ROOT --file 20220403 --rows 1000
    python -m viewlog silver [--run-date 2024-04-03]
    python -m viewlog gold   [--run-date 2024-04-03]
    python -m viewlog export
    python -m viewlog run --source ROOT --batch 20220403:10 --batch 20220404:10
    python -m viewlog views [--show 20]

Common options: ``--database`` (catalog namespace), ``--root`` (shared
storage for table data; default: the catalog warehouse), ``--master`` (only
for local runs; under spark-submit the cluster settings apply).
Arguments replace the original's interactive prompts. The exit status is
non-zero when any stage failed.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession

from .plans import pipeline as P
from .sinks.jdbc import DIALECTS, JdbcTarget
from .session import DEFAULT_CONF, apply_sql_conf


def _session(master: str | None) -> SparkSession:
    b = SparkSession.builder.appName("viewlog")
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_sql_conf(spark)
    return spark


def _batch(text: str, default_day: str) -> tuple[str, int | None, str]:
    parts = text.split(":")
    if not 1 <= len(parts) <= 3:
        raise argparse.ArgumentTypeError("batch is FILE[:ROWS[:RUN_DATE]]")
    rows = int(parts[1]) if len(parts) > 1 and parts[1] else None
    return parts[0], rows, parts[2] if len(parts) == 3 else default_day


def _target(a: argparse.Namespace) -> JdbcTarget | None:
    if a.jdbc_url is None:
        return None
    props = dict(p.partition("=")[::2] for p in a.jdbc_prop)
    return JdbcTarget(a.jdbc_url, a.jdbc_table, props, a.jdbc_dialect)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="viewlog", description=__doc__.split("\n")[0])
    ap.add_argument("--database", default="viewlog")
    ap.add_argument("--root", default=None)
    ap.add_argument("--master", default=None)
    ap.add_argument("--preview", type=int, default=0,
                    help="show the first N rows a stage wrote (the original shows 5)")
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="bronze size; sizes shuffle partitions etc. (session.scale_conf)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    today = _dt.date.today().isoformat()

    b = sub.add_parser("bronze", help="ingest the next rows of source files")
    b.add_argument("--source", required=True, help="root holding source_file=<name>/ directories")
    b.add_argument("--file", action="append", help="source file name(s); default: all")
    b.add_argument("--rows", type=int, default=None,
                   help="lines per file; default: the file's last batch size, else all the rest")
    b.add_argument("--run-date", default=today)
    for name in ("silver", "gold"):
        s = sub.add_parser(name)
        s.add_argument("--run-date", default=today)
        s.add_argument("--incremental", action="store_true",
                       help="silver: fold only new bronze rows; gold: carry day counts forward")
    e = sub.add_parser("export")
    r = sub.add_parser("run", help="bronze -> silver -> gold -> export per batch")
    r.add_argument("--source", required=True)
    r.add_argument("--batch", action="append", required=True, help="FILE[:ROWS[:RUN_DATE]]; empty ROWS: default batch size")
    r.add_argument("--incremental", action="store_true", help="incremental silver and gold")
    for target in (e, r):
        target.add_argument("--jdbc-url", default=None, help="export to a relational table instead of the serving table")
        target.add_argument("--jdbc-table", default="serving_summary")
        target.add_argument("--jdbc-prop", action="append", default=[], metavar="KEY=VALUE", help="driver, user, password, ...")
        target.add_argument("--jdbc-dialect", default="ansi", choices=DIALECTS)
    v = sub.add_parser("views")
    v.add_argument("--show", type=int, default=20)
    a = ap.parse_args(argv)

    spark = _session(a.master)
    if a.input_bytes:
        from .session import apply_scale_conf

        apply_scale_conf(spark, a.input_bytes)
    layout = P.Layout(database=a.database, root=a.root)
    def preview(table: str, col: str, value: str | None) -> None:
        if a.preview > 0 and value is not None:
            from pyspark.sql import functions as F

            from .sinks.tables import preview as head

            head(spark.table(layout.table(table)).filter(F.col(col) == value), a.preview).show(truncate=False)

    if a.cmd == "bronze":
        info = P.ingest_batch(spark, layout, a.source, a.rows, a.run_date, files=a.file)
        print(info)
        preview(layout.bronze, "execution_date", a.run_date)
    elif a.cmd == "silver":
        print({"rows": P.silver_stage(spark, layout, a.run_date, incremental=a.incremental)})
        preview(layout.silver, "execution_day", a.run_date)
    elif a.cmd == "gold":
        print({"rows": P.gold_stage(spark, layout, a.run_date, incremental=a.incremental)})
        preview(layout.gold, "execution_day", a.run_date)
    elif a.cmd == "export":
        day = P.export_stage(spark, layout, jdbc=_target(a))
        print({"day": day})
        if a.jdbc_url is None:
            preview(layout.serving, "execution_day", day)
    elif a.cmd == "run":
        status = P.run_batches(spark, layout, a.source, [_batch(x, today) for x in a.batch],
                               incremental=a.incremental, jdbc=_target(a))
        rows = status.collect()
        for row in rows:
            print(f"{row.source_file} {row.run_date} {row.stage:7s} {row.status:8s} {row.detail or ''}")
        return 0 if all(row.status == "ok" for row in rows) else 1
    elif a.cmd == "views":
        from .operators.views import register_views

        P.attach(spark, layout)
        serving = spark.table(layout.table(layout.serving))
        for name, df in register_views(spark, serving).items():
            print(f"-- {name}")
            df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
