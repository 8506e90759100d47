"""Run a spec over a table and write the results (the demo drivers, as a job).

    python -m rowlint --spec checks.yaml --input data/customers.csv \\
        --format csv --output out/ --keys id name

Writes ``out/annotated`` (input columns, cleansed, plus ``_dq_results``),
``out/flat`` (keys plus one PASS/FAIL column per rule) and ``out/summary``
(one row per rule).  Nothing is printed row by row and nothing is capped.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="rowlint", description=__doc__.splitlines()[0])
    ap.add_argument("--spec", required=True, help="YAML spec (local path or any Hadoop file system)")
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="parquet", help="input format: csv (header, all text), parquet, orc, json ...")
    ap.add_argument("--output", required=True)
    ap.add_argument("--output-format", default="parquet")
    ap.add_argument("--keys", nargs="*", default=None, help="columns kept in the flat report (default: all)")
    ap.add_argument("--on-unknown", default="warn", choices=["warn", "error", "ignore"])
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans.pipeline import Pipeline
    from .sources import read_csv, read_table, write_reports

    spark = spark or SparkSession.builder.appName("rowlint").getOrCreate()
    pipeline = Pipeline.load(args.spec, spark=spark, on_unknown=args.on_unknown)
    df = read_csv(spark, args.input) if args.format == "csv" else read_table(spark, args.input, args.format)
    run = pipeline.compile(df)
    keys = args.keys if args.keys is not None else [c for c in df.columns if c != run.results_col]
    write_reports(run, args.output, keys, format=args.output_format)
    return 0


if __name__ == "__main__":
    sys.exit(main())
