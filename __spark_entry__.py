"""

Every query works on the whole ``events`` table, read as transactions
(``ledgerfall.fixture``).
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerfall import fixture  # noqa: E402
from ledgerfall import vocabulary as V  # noqa: E402
from ledgerfall.functions import banding, identity, money  # noqa: E402
from ledgerfall.operators import account_sets as sets  # noqa: E402
from ledgerfall.operators import facts as X  # noqa: E402
from ledgerfall.operators import gold, insights, minimise, rules, validation  # noqa: E402
from ledgerfall.plans import daily  # noqa: E402
from ledgerfall.sources import footers, releases, tables  # noqa: E402
from ledgerfall.sources.layout import Lakehouse  # noqa: E402
from ledgerfall.sources.scratch import scratch_folder  # noqa: E402
from oracle_queries import ORACLE  # noqa: E402

try:  # the text operators and their pipeline are an optional part
    import corpus_pipeline
    from ledgerfall.llm import queries as text_queries
except ModuleNotFoundError as missing:  # the part itself, or a library that only it needs
    print(f"without text operators: {missing}", file=sys.stderr)
    corpus_pipeline = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]
DAY = fixture.RUN_DATE
SILVER_PATH = "silver"


UTC = "UTC"


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimise.to_silver(_bronze(spark, sf_dir), fixture.salt(spark), DAY)


def _to_silver(bronze: DataFrame) -> DataFrame:
    return minimise.to_silver(bronze, fixture.salt(bronze.sparkSession), DAY)


def _subcent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with amounts that have many digits."""
    return _silver(spark, sf_dir).withColumn("amount", F.col("amount") / 3)


def _large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with amounts of up to 10**16, of the size that the gate lets pass."""
    return _silver(spark, sf_dir).withColumn("amount", F.rint(F.col("amount") * 1e13))


def _unreal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of Bronze in which failed transactions have amounts that are no numbers or no money."""
    kinds = F.array(*map(F.lit, ("NaN", "Infinity", "-Infinity", "1e400", "1e30")))
    pick = F.pmod(F.crc32("transaction_id"), F.lit(5)).cast("int")
    amount = F.when(F.col("status") == "FAILED", kinds[pick]).otherwise(F.col("amount").cast("string"))
    return _to_silver(_bronze(spark, sf_dir).withColumn("amount", amount))


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with a column too many and one too few."""
    return _silver(spark, sf_dir).withColumn("novelty", F.lit(1)).drop("atm_city")


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.damaged(_silver(spark, sf_dir))


def _on_silver(work: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: work(_silver(spark, sf_dir))


def _on_facts(work: Callable[[DataFrame], DataFrame], tz: str = UTC, source: Query | None = None) -> Query:
    return lambda spark, sf_dir: work(X.facts((source or _silver)(spark, sf_dir), tz))


def _gold(name: str, tz: str = UTC, source: Query | None = None) -> Query:
    return _on_facts(lambda rows: _stored_form(name, rows), tz, source)


def _stored_form(name: str, rows: DataFrame) -> DataFrame:
    return gold.with_run_date(gold.arrange(name, gold.build(name, rows)), DAY)


def _on_gold(name: str, work: Callable[[DataFrame], DataFrame], source: Query | None = None) -> Query:
    return _on_facts(lambda rows: work(gold.build(name, rows)), source=source)


def _in_order(rows: DataFrame) -> DataFrame:
    """A short sorted table with each row's position, so that its order can be compared."""
    return rows.withColumn("position", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


def _on_dated_gold(name: str, work: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_facts(lambda rows: _in_order(work(gold.with_run_date(gold.build(name, rows), DAY))))


def _arranged(name: str) -> Query:
    return _on_facts(lambda rows: _in_order(_stored_form(name, rows)))


def _roughly(mcc: DataFrame) -> DataFrame:
    """Spend to the next thousand, average to the next fifty: many codes are level."""
    return mcc.withColumns({"total_spend": F.round("total_spend", -3), "avg_spend": F.round(F.col("avg_spend") / 50) * 50})


def _report(silver: DataFrame, checks: tuple[rules.Rule, ...] = rules.ALL) -> DataFrame:
    return validation.report(silver, DAY, SILVER_PATH, checks)


def _on_checks(work: Callable[[DataFrame], DataFrame], source: Query = _silver) -> Query:
    return lambda spark, sf_dir: work(validation.results(_report(source(spark, sf_dir))))


def _damaged_category(category: str) -> Query:
    return lambda spark, sf_dir: validation.results(_report(_damaged(spark, sf_dir), rules.of_category(category)))


# Queries that store and read back


def _lake(spark: SparkSession) -> Lakehouse:
    base = scratch_folder(spark)
    return Lakehouse(f"{base}/bronze", f"{base}/silver", f"{base}/gold")


def _store_bronze(bronze: DataFrame, lake: Lakehouse) -> None:
    bronze.write.option("ignoreNullFields", "false").json(lake.bronze_day(DAY))


def bronze_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    _store_bronze(fixture.bronze(spark, sf_dir, spread=True), lake)
    return minimise.normalise_amounts(tables.read_bronze(spark, lake, DAY))


def amounts_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that come as text, some of it not a number."""
    text = F.concat(F.col("amount").cast("string"), F.when(F.col("status") == "FAILED", " ZAR").otherwise(""))
    rows = _bronze(spark, sf_dir).withColumns(
        {"amount": text, "running_balance": F.col("running_balance").cast("string")}
    )
    return minimise.normalise_amounts(rows).select("transaction_id", "amount", "running_balance")


def silver_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of Silver written twice, as after a retry, and read."""
    lake = _lake(spark)
    for _ in range(2):
        tables.write_silver(_silver(spark, sf_dir), lake, DAY)
    return tables.read_silver(spark, lake, DAY)


def _gold_round_trip(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _lake(spark)
        tables.write_gold(gold.build(name, X.facts(_silver(spark, sf_dir), UTC)), lake, name, DAY)
        return tables.read_gold(spark, lake, name, DAY)

    return run


def silver_rerun_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day written with rows, then again with none."""
    lake = _lake(spark)
    for rows in (_silver(spark, sf_dir), _silver(spark, sf_dir).where("transaction_id IS NULL")):
        tables.write_silver(rows, lake, DAY)
    return tables.read_silver(spark, lake, DAY)


def gold_rerun_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, name = _lake(spark), "provincial_flow"
    for scope in ("true", "transaction_type IS NULL"):
        rows = X.facts(_silver(spark, sf_dir), UTC).where(scope)
        tables.write_gold(gold.build(name, rows), lake, name, DAY)
    return tables.read_gold(spark, lake, name, DAY)


def _breaking(rows: DataFrame) -> DataFrame:
    """Rows of which some cannot be written: a task that meets one fails."""
    broken = F.raise_error(F.lit("a row that cannot be written"))
    return rows.withColumn("amount", F.when(F.crc32("transaction_id") % 100 == 0, broken.cast("double")).otherwise(F.col("amount")))


def _fails(work: Callable[[], object]) -> None:
    try:
        work()
    except PySparkException:
        return
    raise AssertionError("the run was meant to fail")


def silver_failed_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of Silver after a second run of it failed on the way."""
    lake = _lake(spark)
    tables.write_silver(_silver(spark, sf_dir), lake, DAY)
    _fails(lambda: tables.write_silver(_breaking(_silver(spark, sf_dir)), lake, DAY))
    return tables.read_silver(spark, lake, DAY)


def gold_failed_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Gold table after a second run of it failed on the way."""
    lake, name = _lake(spark), "mcc_spend"
    tables.write_gold(gold.build(name, X.facts(_silver(spark, sf_dir), UTC)), lake, name, DAY)
    _fails(lambda: tables.write_gold(gold.build(name, X.facts(_breaking(_silver(spark, sf_dir)), UTC)), lake, name, DAY))
    return tables.read_gold(spark, lake, name, DAY)


def _failed_day(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """A day that was run, then run again with half the rows: its Silver passes, one Gold table fails."""
    lake, _ = _run_day(spark, sf_dir)
    half = fixture.identified_bronze(spark, sf_dir).where(F.crc32("transaction_id") % 2 == 0)
    half.write.mode("overwrite").option("ignoreNullFields", "false").json(lake.bronze_day(DAY))
    _fails(lambda: daily.run_day(spark, lake, fixture.salt(spark), DAY, "No/Such_Zone"))
    return lake


def daily_failed_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of Silver and of each Gold table after a second run of the day failed."""
    lake = _failed_day(spark, sf_dir)
    stored = {"silver": tables.read_silver(spark, lake, DAY)}
    stored |= {name: tables.read_gold(spark, lake, name, DAY) for name in gold.TABLES}
    counts = [rows.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, rows in stored.items()]
    return reduce(DataFrame.unionByName, counts)


def daily_failed_rerun_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Gold table that the failed second run had already written."""
    return tables.read_gold(spark, _failed_day(spark, sf_dir), "channel_adoption", DAY)


def type_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a day in which some files have ages, and flags, as text."""
    lake, rows = _lake(spark), _silver(spark, sf_dir)
    other = F.crc32("transaction_id") % 3 == 0
    tables.write_silver(rows.where(~other), lake, DAY)
    as_text = {name: F.col(name).cast("string") for name in ("age", "reversal_flag")}
    tables.write_silver(rows.where(other).withColumns(as_text), lake, DAY, mode="append")
    return validation.results(daily.validate_silver(spark, lake, DAY))


def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files of such a day say of their columns: files' kinds per column and type."""
    lake, rows = _lake(spark), _silver(spark, sf_dir)
    tables.write_silver(rows, lake, DAY)
    tables.write_silver(rows.withColumn("age", F.col("age").cast("string")).drop("atm_city"), lake, DAY, mode="append")
    folders = [lake.silver_day(DAY, run) for run in releases.current(spark, lake, DAY)["silver"]]
    return footers.catalogue(spark, folders).select("column", "type").distinct()


def empty_day_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a day whose delivery, after one with rows, has none."""
    lake = _lake(spark)
    for rows in (_bronze(spark, sf_dir), _bronze(spark, sf_dir).where("transaction_id IS NULL")):
        rows.write.mode("overwrite").option("ignoreNullFields", "false").json(lake.bronze_day(DAY))
        daily.load_silver(spark, lake, fixture.salt(spark), DAY)
    return validation.results(daily.validate_silver(spark, lake, DAY))


def bronze_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered lines of which some are broken, quote their amounts or have unknown fields."""
    lake = _lake(spark)
    rows = _bronze(spark, sf_dir)
    kind = F.round(F.col("amount") * 100).cast("bigint") % 4
    quoted = F.to_json(F.struct(*(F.col(c).cast("string").alias(c) if c == "amount" else F.col(c) for c in rows.columns)))
    unknown = F.to_json(F.struct("*", F.lit(1).alias("unknown_field")))
    line = F.when(kind == 0, quoted).when(kind == 1, unknown).when(kind == 2, "{broken").otherwise(F.to_json(F.struct("*")))
    rows.select(line.alias("value")).write.text(lake.bronze_day(DAY))
    return minimise.normalise_amounts(tables.read_bronze(spark, lake, DAY)).select(
        "transaction_id", "status", "amount", "running_balance", "reversal_flag"
    )


def _counts(spark: SparkSession, written: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(written.items()), "table_name string, rows_written bigint")


def gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    tables.write_silver(_silver(spark, sf_dir), lake, DAY)
    return _counts(spark, daily.load_gold(spark, lake, DAY, UTC))


def report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    tables.write_report(_report(_damaged(spark, sf_dir)), lake, DAY)
    return validation.results(tables.read_report(spark, lake, DAY))


def _run_day(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, dict[str, int]]:
    lake = _lake(spark)
    _store_bronze(fixture.identified_bronze(spark, sf_dir), lake)
    return lake, daily.run_day(spark, lake, fixture.salt(spark), DAY, UTC)


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole day from NDJSON files; rows written per Gold table."""
    return _counts(spark, _run_day(spark, sf_dir)[1])


def daily_run_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole day from NDJSON files; one of its Gold tables as stored."""
    lake, _ = _run_day(spark, sf_dir)
    return tables.read_gold(spark, lake, "client_financial_activity", DAY)


# Sets of accounts


def _store(rows: DataFrame) -> DataFrame:
    return tables.stored(rows, f"{scratch_folder(rows.sparkSession)}/rows")


def _two_days(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    silver = _silver(spark, sf_dir)
    second = F.crc32("transaction_id") % 2 == 1
    return [silver.where(~second), silver.where(second)]


def _sets_of_days(days: list[DataFrame], *keys: str) -> list[DataFrame]:
    """Each day's sets as stored; the dictionary grows by the day's new accounts first."""
    dictionary, stored = None, []
    for day in days:
        dictionary = sets.extended(dictionary, day, _store)
        stored.append(_store(sets.account_sets(day, dictionary, *keys)))
    return stored


def channel_accounts_from_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts per channel and category of one day, from its bitmaps."""
    keys = ("channel", "transaction_category")
    return sets.counted(*_sets_of_days([_silver(spark, sf_dir)], *keys), *keys)


def channel_accounts_of_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts per channel over both days and all categories, from each day's bitmaps by channel and category."""
    days = _sets_of_days(_two_days(spark, sf_dir), "channel", "transaction_category")
    return sets.counted(sets.united(days, "channel"), "channel")


def currency_accounts_of_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts per currency over both days and all age bands, none counted twice."""
    days = [X.facts(gold.settled(day), UTC).where("transaction_category = 'SWIFT'") for day in _two_days(spark, sf_dir)]
    return sets.counted(sets.united(_sets_of_days(days, "age_band", "currency"), "currency"), "currency")


# Queries of one operator


def _select(*columns, source: Query = _silver) -> Query:
    return lambda spark, sf_dir: source(spark, sf_dir).select("transaction_id", *(c() for c in columns))


def _hour(tz: str):
    return lambda: banding.hour_of_day(F.col("transaction_datetime"), tz).alias("hour_of_day")


def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimise.pseudonymise(_bronze(spark, sf_dir), fixture.salt(spark)).select("transaction_id", *V.PSEUDONYMISED)


def holder_age_and_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimise.derive_holder(_bronze(spark, sf_dir), DAY).select("transaction_id", "age", "gender")


def _conditional_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("channel").agg(
        X.count_where(F.col("reversal_flag")).alias("reversed"),
        X.count_where(F.col("age_band").isin("18-24", "25-34")).alias("under_35"),
    )


def _conditional_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("channel").agg(
        money.rounded(X.amount_where(F.col("transaction_type") == "DEBIT")).alias("debited"),
        money.rounded(X.amount_where(F.col("transaction_type") == "CREDIT")).alias("credited"),
    )


def _distinct_accounts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("status").agg(
        F.count_distinct("account_number").alias("accounts"),
        F.count_distinct("beneficiary_account_number").alias("beneficiaries"),
    )


def _rounded_ratios(rows: DataFrame) -> DataFrame:
    failed = X.count_where(F.col("status") == "FAILED")
    return rows.groupBy("age_band").agg(
        X.mean().alias("avg_amount"), money.share(failed, X.row_count()).alias("failed_share")
    )


def report_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(_damaged(spark, sf_dir)).withColumn("results", F.size("results").cast("bigint"))


def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.verdict(_report(_damaged(spark, sf_dir)))


def gate_verdict_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.verdict(_report(_to_silver(fixture.identified_bronze(spark, sf_dir))))


def entry(spark: SparkSession) -> DataFrame:
    """Settled debit spend by age band and category, from raw transactions."""
    return _gold("spend_by_age_band")(spark, "/root/testdata/sf0.001")


def _text_queries() -> dict[str, Query]:
    if text_queries is None:
        return {}
    return {**text_queries.QUERIES, "pipeline": corpus_pipeline.run}


def queries() -> dict[str, Query]:
    return {
        **_text_queries(),
        # sources and sinks
        "bronze_round_trip": bronze_round_trip,
        "amounts_from_text": amounts_from_text,
        "silver_round_trip": silver_round_trip,
        "bronze_raw_lines": bronze_raw_lines,
        "silver_rerun_empty": silver_rerun_empty,
        "silver_failed_rerun": silver_failed_rerun,
        "gold_failed_rerun": gold_failed_rerun,
        "column_types": column_types,
        "gold_round_trip": _gold_round_trip("channel_adoption"),
        **{f"stored_{name}": _gold_round_trip(name) for name in gold.TABLES if name != "channel_adoption"},
        "gold_rerun_empty": gold_rerun_empty,
        "gold_row_counts": gold_row_counts,
        "report_round_trip": report_round_trip,
        # Bronze to Silver
        "without_pii": lambda spark, sf_dir: minimise.drop_pii(_bronze(spark, sf_dir)),
        "pseudonyms": pseudonyms,
        "holder_age_and_gender": holder_age_and_gender,
        "silver": _silver,
        "settled_transactions": _on_silver(gold.settled),
        "age_bands": _select(lambda: banding.age_band(F.col("age")).alias("age_band")),
        "hours_utc": _select(_hour(UTC)),
        "hours_sast": _select(_hour(V.SAST)),
        # validation
        "check_results": _on_checks(lambda checks: checks),
        "damaged_check_results": _on_checks(lambda checks: checks, _damaged),
        "damaged_completeness_checks": _damaged_category(rules.COMPLETENESS),
        "damaged_allowed_values_checks": _damaged_category(rules.ALLOWED_VALUES),
        "damaged_format_checks": _damaged_category(rules.FORMAT),
        "damaged_business_rules_checks": _damaged_category(rules.BUSINESS_RULES),
        "damaged_conditional_nullability_checks": _damaged_category(rules.CONDITIONAL_NULLABILITY),
        "drifted_check_results": _on_checks(lambda checks: checks, _drifted),
        "unreal_amounts": lambda spark, sf_dir: _unreal(spark, sf_dir).select("transaction_id", "amount"),
        "unreal_check_results": _on_checks(lambda checks: checks, _unreal),
        "empty_day_report": empty_day_report,
        "type_drift_report": type_drift_report,
        "check_summary": _on_checks(validation.summary, _damaged),
        "report_header": report_header,
        "gate_verdict": gate_verdict,
        "gate_verdict_clean": gate_verdict_clean,
        # Silver to Gold
        **{name: _gold(name) for name in gold.TABLES},
        "time_of_day_sast": _gold("time_of_day", V.SAST),
        **{f"subcent_{name}": _gold(name, source=_subcent) for name in ("spend_by_age_band", "client_financial_activity", "mcc_spend")},
        "unreal_reversal_rates": _gold("reversal_rates", source=_unreal),
        **{f"arranged_{name}": _arranged(name) for name in gold.TABLES if name != "client_financial_activity"},
        "conditional_counts": _on_facts(_conditional_counts),
        "conditional_sums": _on_facts(_conditional_sums),
        "distinct_accounts": _on_silver(_distinct_accounts),
        "rounded_ratios": _on_facts(_rounded_ratios),
        "status_share_of_category": _on_gold(
            "reversal_rates", lambda table: table.select("transaction_category", "status", "rate")
        ),
        # analyses of Gold
        "spend_by_band": _on_gold("spend_by_age_band", insights.spend_by_band),
        "average_spend_by_band": _on_gold("spend_by_age_band", insights.average_spend_by_band),
        "volume_by_channel": _on_gold("channel_adoption", insights.volume_by_channel),
        "failure_rate_by_channel": _on_gold("channel_adoption", insights.failure_rate_by_channel),
        "net_movement_histogram": _on_gold("client_financial_activity", insights.net_movement_histogram),
        "reversal_exposure": _on_gold("client_financial_activity", insights.reversal_exposure),
        "client_summary": _on_gold("client_financial_activity", insights.client_summary),
        "large_amount_activity": _on_gold(
            "client_financial_activity",
            lambda clients: clients.select(
                "account_number", *(F.round(F.col(c) / 1e6).cast("bigint").alias(c) for c in ("total_debited", "total_credited", "net_movement"))
            ),
            _large,
        ),
        "large_amount_histogram": _on_gold("client_financial_activity", insights.net_movement_histogram, _large),
        "large_amount_summary": _on_gold("client_financial_activity", insights.client_summary, _large),
        "status_mix": _on_gold("reversal_rates", insights.status_mix),
        "failure_and_reversal_rates": _on_gold("reversal_rates", insights.failure_and_reversal_rates),
        "volume_by_hour": _on_gold("time_of_day", insights.volume_by_hour),
        "spend_by_hour": _on_gold("time_of_day", insights.spend_by_hour),
        "provinces_by_amount": _on_dated_gold("provincial_flow", insights.provinces_by_amount),
        "top_merchant_categories_by_total": _on_dated_gold("mcc_spend", insights.top_by_total_spend),
        "top_merchant_categories_by_average": _on_dated_gold("mcc_spend", insights.top_by_average_spend),
        "level_merchant_categories_by_total": _on_dated_gold("mcc_spend", lambda mcc: insights.top_by_total_spend(_roughly(mcc))),
        "level_merchant_categories_by_average": _on_dated_gold("mcc_spend", lambda mcc: insights.top_by_average_spend(_roughly(mcc))),
        "amount_by_band_and_currency": _on_gold("currency_by_age", insights.amount_by_band_and_currency),
        "accounts_by_currency": _on_gold("currency_by_age", insights.accounts_by_currency),
        # sets of accounts that merge
        "channel_accounts_from_sets": channel_accounts_from_sets,
        "channel_accounts_of_two_days": channel_accounts_of_two_days,
        "currency_accounts_of_two_days": currency_accounts_of_two_days,
        # analyses of the report
        "checks_by_category": _on_checks(insights.checks_by_category),
        "checks_by_outcome": _on_checks(insights.checks_by_outcome),
        "failed_checks": _on_checks(validation.failed, _damaged),
        # the day as a whole
        "daily_run": daily_run,
        "daily_run_gold": daily_run_gold,
        "daily_failed_rerun": daily_failed_rerun,
        "daily_failed_rerun_gold": daily_failed_rerun_gold,
    }


def oracle_sql() -> dict[str, str]:
    if text_queries is None:
        return dict(ORACLE)
    found = {**ORACLE, **text_queries.ORACLE}
    return {**found, "pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else found
