"""Reading and writing the layers.

A day is read and written by its own folder, so that only that folder is listed:
finding the day in the table's root would list every day there is.  Every run
writes folders of its own and releases them when they are whole (``releases``): a job
that is run again leaves neither rows twice nor rows of the run before, also when it
writes no rows, and one that fails leaves the day as it was.  A day without a release
is read from its plain folder.

``stage_…`` writes without a release, for runs of several tables.
"""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerfall.operators.gold import arrange, with_run_date
from ledgerfall.schemas import BRONZE, GOLD, REPORT
from ledgerfall.sources import footers, releases
from ledgerfall.sources.layout import Lakehouse

SILVER, CHECKS = "silver", "report"


def read_bronze(spark: SparkSession, lake: Lakehouse, run_date: date) -> DataFrame:
    """One day of raw newline-delimited JSON.

    The layout is given, so the files are not read to infer it, and fields a
    query does not use are not parsed into rows.  A line that is not JSON is a
    row of nulls, which validation reports.
    """
    return spark.read.schema(BRONZE).json(lake.bronze_day(run_date))


def _folders(spark: SparkSession, lake: Lakehouse, table: str, run_date: date, folder: Callable[..., str], run: str | None) -> list[str]:
    """Folders of a table's day: those of a run, or of the runs released, or the plain one."""
    runs = [run] if run else releases.current(spark, lake, run_date).get(table, [None])
    return [folder(run_date, run) for run in runs]


def stage_silver(silver: DataFrame, lake: Lakehouse, run_date: date, run: str) -> None:
    silver.write.parquet(lake.silver_day(run_date, run))


def write_silver(silver: DataFrame, lake: Lakehouse, run_date: date, mode: str = "overwrite") -> None:
    """One day of Silver.  ``mode="append"`` adds to the day instead of replacing it."""
    run = releases.new_run()
    stage_silver(silver, lake, run_date, run)
    releases.publish(silver.sparkSession, lake, run_date, run, [SILVER], adds=mode == "append")


def read_silver(
    spark: SparkSession, lake: Lakehouse, run_date: date, all_columns: bool = False, run: str | None = None
) -> DataFrame:
    """One day of Silver as released, or of a run, without partition columns.

    The columns are those of one of the files, or, with ``all_columns``, those that
    any file has: an added file with a further column is only seen so, and every
    file's footer is read for it.  Columns that files have in different types are
    then read as Silver's type, where a value cannot be, null; ``schemas.mixed`` tells
    them.
    """
    folders = _folders(spark, lake, SILVER, run_date, lake.silver_day, run)
    return footers.read_all(spark, folders) if all_columns else spark.read.parquet(*folders)


def stage_gold(table: DataFrame, lake: Lakehouse, name: str, run_date: date, run: str) -> int:
    """One Gold table for one day; the number of rows written.

    Rows are counted while they are written.
    """
    written = Observation(name)
    counted = arrange(name, table).observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.parquet(lake.gold_day(name, run_date, run))
    return written.get["rows"]


def write_gold(table: DataFrame, lake: Lakehouse, name: str, run_date: date) -> int:
    """One Gold table for one day, released; the number of rows written."""
    run = releases.new_run()
    rows = stage_gold(table, lake, name, run_date, run)
    releases.publish(table.sparkSession, lake, run_date, run, [name])
    return rows


def read_gold(spark: SparkSession, lake: Lakehouse, name: str, run_date: date) -> DataFrame:
    """One Gold table of one day."""
    folders = _folders(spark, lake, name, run_date, lambda day, run: lake.gold_day(name, day, run), None)
    return with_run_date(spark.read.schema(GOLD[name]).parquet(*folders), run_date)


def stored(rows: DataFrame, folder: str) -> DataFrame:
    """Rows that several tables are made of, written once and read back."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def stage_report(report: DataFrame, lake: Lakehouse, run_date: date, run: str) -> None:
    report.write.option("ignoreNullFields", "false").json(lake.report_day(run_date, run))


def write_report(report: DataFrame, lake: Lakehouse, run_date: date) -> None:
    """The one-row validation report as a JSON document."""
    run = releases.new_run()
    stage_report(report, lake, run_date, run)
    releases.publish(report.sparkSession, lake, run_date, run, [CHECKS])


def read_report(spark: SparkSession, lake: Lakehouse, run_date: date, run: str | None = None) -> DataFrame:
    """A day's validation report, one row, whether written on one line or indented."""
    folders = _folders(spark, lake, CHECKS, run_date, lake.report_day, run)
    return spark.read.schema(REPORT).json(folders, multiLine=True)
