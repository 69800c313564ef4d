"""Monthly batch run: ``python -m arrivo --sf-dir DIR --out OUT [--run-date YYYY-MM-DD] [--csv]``.

Writes, under ``OUT``: the standardised rows by entry point (S15), the monthly
quote and interest tables, the final table sorted by month, origin and entry
point (S16), and the run's counters and the validation report as JSON (S17), each inside a
``run_date=...`` folder so a re-run replaces only its own date (S18).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F


def run(spark, sf_dir: str, out: str, run_date: str, csv: bool = False) -> dict:
    from arrivo.operators import quality
    from arrivo.operators.counters import RunCounters
    from arrivo.plans import pipeline as pl
    from arrivo.plans.queries_sources import CATEGORY_OF
    from arrivo.sources import catalog
    from arrivo.sources import fixtures as fx

    fmt = "csv" if csv else "parquet"
    base = f"{out.rstrip('/')}/run_date={run_date}"
    watch = RunCounters()
    std = pl.standardised(spark, sf_dir, watch=watch)
    catalog.write_partitioned(std.withColumn("category", F.lit("turismo")).withColumnRenamed("src", "source"),
                              f"{base}/curated", partition_cols=("category", "source"), fmt=fmt)
    catalog.write_json_doc(watch.table(spark), f"{base}/reports/counters")
    pl.quotes_monthly(spark, sf_dir).write.mode("overwrite").format(fmt).save(f"{base}/processed/quotes_monthly")
    pl.interest_monthly(spark, sf_dir).write.mode("overwrite").format(fmt).save(f"{base}/processed/interest_monthly")
    catalog.write_sorted(pl.final(spark, sf_dir), f"{base}/processed/final", fmt=fmt)
    checks = quality.file_checks(catalog.file_sizes(spark, sf_dir),
                                 {n: fx.table(spark, sf_dir, n) for n in fx.TABLES}, CATEGORY_OF)
    ready = quality.readiness(checks, quality.issues(checks))
    report = quality.run_report(ready, quality.category_rollup(checks), run_date, len(fx.TABLES))
    catalog.write_json_doc(report, f"{base}/reports/run_report")
    return {"out": base, "final_rows": spark.read.format(fmt).option("header", True).option("sep", ";")
            .load(f"{base}/processed/final").count()}


def main() -> None:
    ap = argparse.ArgumentParser(prog="arrivo", description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-date", default=dt.date.today().isoformat())
    ap.add_argument("--csv", action="store_true", help="write CSV (';' for the final table) instead of parquet")
    args = ap.parse_args()
    from arrivo import get_spark
    from arrivo.session import remove_scratch

    spark = get_spark()
    print(run(spark, args.sf_dir, args.out, args.run_date, args.csv))
    remove_scratch(spark)


if __name__ == "__main__":
    main()
