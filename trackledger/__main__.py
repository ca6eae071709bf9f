"""Run one job: ``python -m trackledger <job> --sheets ... --out ...``.

Also usable with spark-submit. Tables are Parquet unless ``--sheets-format`` or
``--refresh-format`` says otherwise: ``documents`` (one JSON document per sheet),
``lines`` (what the job ``land`` makes of them), ``csv`` or ``us_csv`` (cells as
text, which take the sheet's types). The registry is JSON.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trackledger.plans import extracts, sheets, summaries
from trackledger.session import SETTINGS, drop_scratch
from trackledger.sinks.publish import folder_counts
from trackledger.sources.files import UNIT_SEPARATOR, read_extracts, read_text_cells
from trackledger.sources.ledger import list_files, require_files
from trackledger.sources.registry import read_registry
from trackledger.sources.sheets import land_documents, read_landed, read_sheets

FORMATS = {
    "parquet": lambda spark, path: read_extracts(spark, path),
    "documents": lambda spark, path: read_sheets(spark, path),
    "lines": lambda spark, path: read_landed(spark, path),
    "csv": lambda spark, path: read_text_cells(spark, path),
    "us_csv": lambda spark, path: read_text_cells(spark, path, UNIT_SEPARATOR),
}


def _sheets(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return FORMATS[a.sheets_format](spark, a.sheets)


def _refresh(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return FORMATS[a.refresh_format](spark, a.refresh)


def _write(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def _keep(outcome: sheets.Outcome, out: str) -> None:
    _write(outcome.sheets, f"{out}/sheets")
    _write(outcome.changes, f"{out}/changes")
    outcome.counts.show(truncate=False)


def _feedback(spark: SparkSession, a: argparse.Namespace, run) -> None:
    _keep(run(_sheets(spark, a), _refresh(spark, a), _registry(spark, a), null_safe=a.null_safe), a.out)


def _dedupe(spark: SparkSession, a: argparse.Namespace, run) -> None:
    _keep(run(_sheets(spark, a), _registry(spark, a)), a.out)


def _refresh_summary(spark: SparkSession, a: argparse.Namespace) -> None:
    _keep(sheets.refresh_summaries(_sheets(spark, a), _refresh(spark, a)), a.out)


def _publish(spark: SparkSession, a: argparse.Namespace, run) -> None:
    done = run(_sheets(spark, a), read_registry(spark, a.registry), f"{a.out}/sheets", a.run_date)
    done.registry.write.json(f"{a.out}/registry")
    _write(done.left_out, f"{a.out}/left_out")
    done.account.show(truncate=False)


def _update(spark: SparkSession, a: argparse.Namespace) -> None:
    clean, rejects = sheets.update_sheets(_sheets(spark, a))
    _write(clean, f"{a.out}/sheets")
    _write(rejects, f"{a.out}/rejects")


def _summaries(spark: SparkSession, a: argparse.Namespace, run) -> None:
    require_files(list_files(spark, a.sheets), exactly=1 if a.single_input else None)
    summaries.export_reports(run(_sheets(spark, a)), a.out)


def _pack(spark: SparkSession, a: argparse.Namespace) -> None:
    rejects = extracts.pack_job(_sheets(spark, a), f"{a.out}/sheets", a.run_date)
    _write(rejects, f"{a.out}/rejects")


def _registry(spark: SparkSession, a: argparse.Namespace) -> DataFrame | None:
    return read_registry(spark, a.registry) if a.registry else None


JOBS = {
    "get": lambda s, a: sheets.get_sheets(_sheets(s, a), a.out),
    "set": lambda s, a: _publish(s, a, sheets.set_sheets),
    "update": _update,
    "reformat": lambda s, a: _publish(s, a, sheets.reformat_sheets),
    "dedupe": lambda s, a: _dedupe(s, a, sheets.dedupe),
    "dedupe_engine": lambda s, a: _dedupe(s, a, sheets.dedupe_engine),
    "feedback": lambda s, a: _feedback(s, a, sheets.feedback),
    "feedback_engine": lambda s, a: _feedback(s, a, sheets.feedback_engine),
    "refresh_summary": _refresh_summary,
    "fleet_summaries": lambda s, a: _summaries(s, a, summaries.fleet_summaries),
    "category_summaries": lambda s, a: _summaries(s, a, summaries.fleet_category_summaries),
    "engine_summaries": lambda s, a: _summaries(s, a, summaries.engine_summaries),
    "pack": _pack,
    "seed": lambda s, a: _write(extracts.seed_job(_sheets(s, a), a.run_date), a.out),
    "split": lambda s, a: extracts.split_job(_sheets(s, a), a.out, worksheet=a.worksheet),
    "land": lambda s, a: land_documents(s, a.sheets, a.out),
    "count_rows": lambda s, a: folder_counts(s, a.sheets).show(truncate=False),
}


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="trackledger")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--sheets", required=True, help="table or folder to work on")
    parser.add_argument("--refresh", help="new extract")
    parser.add_argument("--registry", help="registry of sheets")
    parser.add_argument("--out", help="folder for results")
    parser.add_argument("--sheets-format", choices=FORMATS, default="parquet")
    parser.add_argument("--refresh-format", choices=FORMATS, default="parquet")
    parser.add_argument("--worksheet", help="column that numbers the worksheets of a base; the last one is split")
    parser.add_argument("--single-input", action="store_true", help="a summary takes exactly one input file")
    parser.add_argument("--run-date", help="date to stamp, today by default")
    parser.add_argument("--null-safe", action="store_true", help="null key parts match each other")
    args = parser.parse_args(argv)
    JOBS[args.job](spark, args)


def main() -> None:
    builder = SparkSession.builder.appName("trackledger")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        run(spark)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main()
