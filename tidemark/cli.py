"""Command lines: the surplus screen, and reports from a folder of filings."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.control import screen_arguments
from tidemark.plans import filing_report, net_current_assets
from tidemark.session import build_session
from tidemark.sources import files, reports


def summary_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a summary, a JSON array, in its order."""
    return spark.read.schema(net_current_assets.INPUT_SCHEMA).json(path, multiLine=True).withColumn("ord", F.monotonically_increasing_id())


def screen(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Rank a summary's companies, write the report, and return the counts at each gate."""
    args = screen_arguments(argv)
    spark = spark or build_session("surplus-screen")
    prices = files.prices(spark, args.prices)
    quotes = spark.read.csv(args.rates, header=True).select(
        F.upper("currency").alias("currency"), F.col("per_usd").cast("double").alias("per_usd")
    ) if args.rates else spark.createDataFrame([], "currency string, per_usd double")
    as_of = F.to_date(F.lit(args.as_of)) if args.as_of else F.current_date()
    records = net_current_assets.deduplicated(net_current_assets.normalised(summary_records(spark, args.summary)))
    dated = net_current_assets.latest(records) if not args.all_records else net_current_assets.dated(records)
    found = net_current_assets.gated(net_current_assets.fresh(dated, as_of, args.stale_days), prices, files.exchange_rates(quotes))
    # What passes is a report, so one task numbers it.
    ranked = found.where("gate = 'passed'").drop("ord").withColumn("ord", F.row_number().over(Window.orderBy(F.col("surplus_pct_of_mcap").desc(), "ticker")))
    reports.write_text(reports.screen_report(ranked, reports.report_format(args.output, args.format)), args.output)
    return net_current_assets.screen_funnel(found)


def report(folder: str, output: str, spark: SparkSession | None = None, latest: bool = False) -> None:
    """Write the reports of all filings below a folder as one JSON array, by ticker and form."""
    spark = spark or build_session("filing-reports")
    found = filing_report.reports(files.filings(spark, folder)).withColumn("file_path", F.col("filing_id"))
    found = filing_report.latest_reports(found) if latest else found
    ordered = found.withColumn("ord", F.struct("ticker", "form_type", "file_path"))
    whole = reports.with_fields(ordered, (*reports.OUTPUT_FIELDS, "ord"))
    reports.write_text(reports.json_array(whole, list(reports.OUTPUT_FIELDS)).withColumn("ord", F.lit(0)), output)


if __name__ == "__main__":
    screen(sys.argv[1:]).show(truncate=False)
