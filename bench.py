"""Time a day's work: Bronze to Silver, validation, each Gold table, each analysis.

Transactions come from all of ``events`` under $BENCH_SF_DIR and are stored as
NDJSON first, untimed; the layers are then read from and written to files, as in
production.  Every step runs twice and the better time counts, the first run of a
step in a new session being mostly compilation.  Prints one line of JSON.
"""

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerfall import fixture
from ledgerfall.operators import facts, gold, insights, validation
from ledgerfall.plans import daily
from ledgerfall.sources import tables
from ledgerfall.sources.layout import Lakehouse
from ledgerfall.sources.scratch import scratch_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DAY = fixture.RUN_DATE
RUNS = 2

ANALYSES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    work.__name__: (table, work)
    for table, work in (
        ("spend_by_age_band", insights.spend_by_band),
        ("spend_by_age_band", insights.average_spend_by_band),
        ("channel_adoption", insights.volume_by_channel),
        ("channel_adoption", insights.failure_rate_by_channel),
        ("client_financial_activity", insights.net_movement_histogram),
        ("client_financial_activity", insights.reversal_exposure),
        ("client_financial_activity", insights.client_summary),
        ("reversal_rates", insights.status_mix),
        ("reversal_rates", insights.failure_and_reversal_rates),
        ("time_of_day", insights.volume_by_hour),
        ("time_of_day", insights.spend_by_hour),
        ("provincial_flow", insights.provinces_by_amount),
        ("mcc_spend", insights.top_by_total_spend),
        ("mcc_spend", insights.top_by_average_spend),
        ("currency_by_age", insights.amount_by_band_and_currency),
        ("currency_by_age", insights.accounts_by_currency),
    )
}
CHECK_ANALYSES = (insights.checks_by_category, insights.checks_by_outcome, validation.failed)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgerfall-bench")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def steps(spark: SparkSession, lake: Lakehouse) -> dict[str, Callable[[], object]]:
    """What is timed, by name, in an order in which inputs exist."""
    salt = fixture.salt(spark)

    def silver_facts() -> DataFrame:
        return facts.facts(tables.read_silver(spark, lake, DAY), "UTC")

    def store(name: str) -> Callable[[], object]:
        return lambda: tables.write_gold(gold.build(name, silver_facts()), lake, name, DAY)

    def analyse(table: str, work: Callable[[DataFrame], DataFrame]) -> Callable[[], object]:
        return lambda: work(tables.read_gold(spark, lake, table, DAY)).collect()

    def checks(work: Callable[[DataFrame], DataFrame]) -> Callable[[], object]:
        return lambda: work(validation.results(tables.read_report(spark, lake, DAY))).collect()

    return {
        "bronze_to_silver": lambda: daily.load_silver(spark, lake, salt, DAY),
        "validation": lambda: daily.validate_silver(spark, lake, DAY),
        **{name: store(name) for name in gold.TABLES},
        **{name: analyse(*analysis) for name, analysis in ANALYSES.items()},
        **{work.__name__: checks(work) for work in CHECK_ANALYSES},
        "daily_run": lambda: daily.run_day(spark, lake, salt, DAY, "UTC"),
    }


def main() -> None:
    spark = session()
    base = scratch_folder(spark)
    lake = Lakehouse(f"{base}/bronze", f"{base}/silver", f"{base}/gold")
    transactions = fixture.identified_bronze(spark, SF_DIR).repartition(int(CPUS))
    transactions.write.option("ignoreNullFields", "false").json(lake.bronze_day(DAY))
    seconds: dict[str, float] = {}
    for name, work in steps(spark, lake).items():
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            work()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    rows = tables.read_silver(spark, lake, DAY).count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": rows,
                "rows_per_second_daily_run": round(rows / seconds["daily_run"]),
            }
        )
    )


if __name__ == "__main__":
    main()
