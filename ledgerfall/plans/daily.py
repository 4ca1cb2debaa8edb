"""One day, from raw files to Gold tables."""

from concurrent.futures import Future, ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ledgerfall.operators import facts as X
from ledgerfall.operators import gold, minimise, validation
from ledgerfall.sources import releases, tables
from ledgerfall.sources.layout import Lakehouse


def _silver(spark: SparkSession, lake: Lakehouse, salt: DataFrame, run_date: date) -> DataFrame:
    return minimise.to_silver(tables.read_bronze(spark, lake, run_date), salt, run_date)


def load_silver(spark: SparkSession, lake: Lakehouse, salt: DataFrame, run_date: date, mode: str = "overwrite") -> None:
    """Bronze to Silver, released by itself."""
    tables.write_silver(_silver(spark, lake, salt, run_date), lake, run_date, mode)


def validate_silver(spark: SparkSession, lake: Lakehouse, run_date: date, run: str | None = None) -> DataFrame:
    """Check a day of Silver, store the report, and return it as stored.

    What decides afterwards is the stored row, so the checks run once.  With a run,
    its Silver is checked and its report is not released.
    """
    silver = tables.read_silver(spark, lake, run_date, all_columns=True, run=run)
    report = validation.report(silver, run_date, lake.silver_day(run_date))
    if run is None:
        tables.write_report(report, lake, run_date)
    else:
        tables.stage_report(report, lake, run_date, run)
    return tables.read_report(spark, lake, run_date, run)


def _stage_gold(spark: SparkSession, lake: Lakehouse, silver: DataFrame, run_date: date, tz: str | None, run: str) -> dict[str, int]:
    """All Gold tables of a run; rows written per table.

    Three tables are made of one small grouping that is stored first, so they cost one
    scan.  The others scan the columns they need of Silver: keeping the rows of a day in
    memory or on executor disks for them would cost more than reading a few columns
    again, and would be lost with an executor.  The tables do not depend on each
    other, so their jobs are submitted together and fill the cluster while the last
    tasks of others run.
    """
    rows = X.facts(silver, tz)
    shared: Future[DataFrame] = Future()

    @inheritable_thread_target(spark)
    def store(name: str) -> int:
        source = shared.result() if name in gold.FROM_CUBE else rows
        return tables.stage_gold(gold.build(name, source), lake, name, run_date, run)

    @inheritable_thread_target(spark)
    def share() -> None:
        try:
            shared.set_result(tables.stored(gold.cube(rows), lake.gold_day("_cube", run_date, run)))
        except BaseException as error:  # noqa: BLE001 - for the tables that wait for it
            shared.set_exception(error)

    with ThreadPoolExecutor(len(gold.TABLES) + 1) as pool:
        pool.submit(share)
        return dict(zip(gold.TABLES, pool.map(store, gold.TABLES)))


def load_gold(spark: SparkSession, lake: Lakehouse, run_date: date, tz: str | None = None) -> dict[str, int]:
    """All Gold tables of a day's released Silver, released together; rows written per table."""
    run = releases.new_run()
    written = _stage_gold(spark, lake, tables.read_silver(spark, lake, run_date), run_date, tz, run)
    releases.publish(spark, lake, run_date, run, gold.TABLES)
    return written


def run_day(
    spark: SparkSession,
    lake: Lakehouse,
    salt: DataFrame,
    run_date: date,
    tz: str | None = None,
) -> dict[str, int]:
    """Bronze to Silver, validation, and, if all checks pass, Gold.

    Silver, report and Gold are released together at the end, so whatever fails on
    the way leaves the day as it was, of one run.  If checks fail, that is a result
    and no accident: Silver and its report are released, Gold is left as it was,
    and ``ValidationFailed`` is raised.  Running a day again replaces it, also by no
    rows: then the report says so and nothing is built.
    """
    run = releases.new_run()
    tables.stage_silver(_silver(spark, lake, salt, run_date), lake, run_date, run)
    try:
        validation.enforce(validate_silver(spark, lake, run_date, run))
    except validation.ValidationFailed:
        releases.publish(spark, lake, run_date, run, [tables.SILVER, tables.CHECKS])
        raise
    written = _stage_gold(spark, lake, tables.read_silver(spark, lake, run_date, run=run), run_date, tz, run)
    releases.publish(spark, lake, run_date, run, [tables.SILVER, tables.CHECKS, *gold.TABLES])
    return written
