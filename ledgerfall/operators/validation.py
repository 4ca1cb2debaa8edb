"""Running the rules over Silver.

Two passes, whatever the number of rules.  The row rules are counters in one
global aggregate: each task sends one row, nothing else is shuffled.  Exact
uniqueness has to bring equal ids together; it does so in an aggregate of its own
that reads and shuffles the id column only.  In one aggregate, every id would
drag all the counters through the shuffle.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfall.operators import rules as R
from ledgerfall.operators.minimise import normalise_amounts
from ledgerfall.schemas import SILVER_COLUMNS, mixed


class ValidationFailed(Exception):
    """Silver did not pass; Gold must not be built from it."""


def _missing(rule: R.Rule, present: set[str]) -> list[str]:
    needed = {R.RowRule: lambda r: r.columns, R.UniqueRule: lambda r: (r.column,)}
    return sorted(set(needed.get(type(rule), lambda r: ())(rule)) - present)


def tally(silver: DataFrame, rules: tuple[R.Rule, ...] = R.ALL) -> DataFrame:
    """One row: ``total_rows`` and the violations of rule i in ``v<i>``.

    A rule that needs a column Silver does not have gets no counter.
    """
    runnable = {i: rule for i, rule in enumerate(rules) if not _missing(rule, set(silver.columns))}
    counted = normalise_amounts(silver).agg(
        F.count("*").alias("total_rows"),
        *(
            F.expr(f"count_if({rule.violated_when}) AS v{i}")
            for i, rule in runnable.items()
            if isinstance(rule, R.RowRule)
        ),
    )
    repeats = {
        f"v{i}": F.col("total_rows") - _distinct_values(silver, rule.column)
        for i, rule in runnable.items()
        if isinstance(rule, R.UniqueRule)
    }
    return counted.withColumns(repeats)


def _distinct_values(silver: DataFrame, column: str) -> Column:
    """Number of different values, null being one."""
    return silver.select(column).distinct().agg(F.count("*")).scalar()


def _schema_difference(columns: list[str], mixed: dict[str, list[str]]) -> str | None:
    extra = sorted(set(columns) - set(SILVER_COLUMNS))
    missing = sorted(set(SILVER_COLUMNS) - set(columns))
    several = [f"{name}: {', '.join(types)}" for name, types in sorted(mixed.items())]
    parts = (f"extra: {extra} " if extra else "") + (f"missing: {missing}" if missing else "")
    parts += (" " if missing and several else "") + (f"several types: {several}" if several else "")
    return parts or None


def _literal(text: str | None) -> str:
    """SQL literal of a text."""
    if text is None:
        return "CAST(NULL AS STRING)"
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _outcome(i: int, rule: R.Rule, columns: list[str], mixed: dict[str, list[str]]) -> str:
    """SQL of the result of one rule over a tally row."""
    absent = _missing(rule, set(columns))
    if absent:
        passed, detail = "false", _literal(f"missing column {', '.join(absent)}")
    elif isinstance(rule, R.SchemaRule):
        difference = _schema_difference(columns, mixed)
        passed, detail = str(difference is None).lower(), _literal(difference)
    elif isinstance(rule, R.NotEmptyRule):
        passed, detail = "total_rows > 0", "concat(total_rows, ' rows')"
    else:
        passed, detail = f"v{i} = 0", f"CASE WHEN v{i} > 0 THEN concat(v{i}, {_literal(' ' + rule.noun)}) END"
    return (
        f"named_struct('category', {_literal(rule.category)}, 'check', {_literal(rule.check)}, "
        f"'passed', {passed}, 'detail', {detail})"
    )


def report(silver: DataFrame, run_date: date, silver_path: str, rules: tuple[R.Rule, ...] = R.ALL) -> DataFrame:
    """One row: the validation report, with the results in the order of the rules.

    A column that the files behind ``silver`` have in several types is reported with the schema.
    """
    drift = mixed(silver)
    outcomes = ", ".join(_outcome(i, rule, silver.columns, drift) for i, rule in enumerate(rules))
    return (
        tally(silver, rules)
        .selectExpr("total_rows", f"array({outcomes}) AS results")
        .selectExpr("*", "CAST(size(filter(results, r -> NOT r.passed)) AS BIGINT) AS checks_failed")
        .select(
            F.lit(run_date.isoformat()).alias("run_date"),
            F.lit(silver_path).alias("silver_path"),
            "total_rows",
            (F.lit(len(rules)).cast("bigint") - F.col("checks_failed")).alias("checks_passed"),
            "checks_failed",
            F.when(F.col("checks_failed") == 0, "PASS").otherwise("FAIL").alias("overall"),
            "results",
        )
    )


def results(report: DataFrame) -> DataFrame:
    """One row per check: category, check, passed, detail."""
    return report.selectExpr("inline(results)")


def summary(results: DataFrame) -> DataFrame:
    """One row: numbers of checks, and the overall verdict."""
    failed = F.count_if(~F.col("passed"))
    return results.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        failed.alias("failed_checks"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("overall"),
    )


def failed(results: DataFrame) -> DataFrame:
    """The checks that did not pass."""
    return results.where("NOT passed").select("category", "check", "detail")


def verdict(report: DataFrame) -> DataFrame:
    """One row: the verdict, and the message of a failed validation."""
    total = F.col("checks_passed") + F.col("checks_failed")
    message = F.concat(
        F.lit("Silver validation failed: "),
        F.col("checks_failed"),
        F.lit("/"),
        total,
        F.lit(" checks did not pass."),
    )
    return report.select("overall", F.when(F.col("checks_failed") > 0, message).alias("message"))


def enforce(report: DataFrame) -> None:
    """Raise if any check failed.  Reads one row."""
    message = verdict(report).first()["message"]
    if message is not None:
        raise ValidationFailed(message)
