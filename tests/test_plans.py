"""What the plans look like: scans, pruning, shuffles, no Python."""

import re

import pytest

import __spark_entry__ as entry
from ledgerfall import fixture
from ledgerfall.operators import facts, gold, validation
from ledgerfall.sources import tables
from ledgerfall.sources.layout import Lakehouse
from tests.conftest import SF_DIR
from tests.test_oracle import CORE


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    lake = Lakehouse(*(str(base / layer) for layer in ("bronze", "silver", "gold")))
    tables.write_silver(entry._silver(spark, SF_DIR), lake, fixture.RUN_DATE)
    return tables.read_silver(spark, lake, fixture.RUN_DATE)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def read_columns(text: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>\n", text)]


def test_validation_reads_silver_once_and_ids_once_more(stored):
    text = plan(validation.tally(stored))
    assert sorted(len(c) for c in read_columns(text)) == [1, 21]
    assert {"transaction_id"} in read_columns(text)
    assert len(re.findall(r"hashpartitioning\(transaction_id", text)) == 1


NEEDED = {
    "spend_by_age_band": {"age", "amount", "status", "transaction_category", "transaction_type"},
    "time_of_day": {"amount", "status", "transaction_category", "transaction_datetime", "transaction_type"},
    "reversal_rates": {"amount", "status", "transaction_category"},
    "provincial_flow": {"account_number", "amount", "atm_province", "status", "transaction_category", "transaction_type"},
    "mcc_spend": {"account_number", "amount", "merchant_category_code", "status"},
}


@pytest.mark.parametrize("name", NEEDED)
def test_gold_reads_only_what_it_needs(stored, name):
    text = plan(gold.build(name, facts.facts(stored)))
    assert read_columns(text) == [NEEDED[name]]
    if name != "reversal_rates":
        assert "EqualTo(status,SETTLED)" in text


@pytest.mark.parametrize("name", gold.TABLES)
def test_partial_aggregation_before_the_shuffle(stored, name):
    text = plan(gold.build(name, facts.facts(stored)))
    assert "Join" not in text and "Cartesian" not in text and "SinglePartition" not in text
    summed = exchanges(text)
    assert summed and all("partial" in below and "partial" not in above for above, below in summed)


def exchanges(text: str) -> list[tuple[str, str]]:
    """For each exchange that aggregates need, the functions of the aggregate above it and below it."""
    tree = [line for line in text.split("\n\n")[0].splitlines() if re.search(r"\(\d+\)", line)]
    functions = dict(re.findall(r"\((\d+)\) HashAggregate.*?\nFunctions \[\d*\]: \[?(.*?)\]?\n", text, re.S))
    names = [(re.search(r"([A-Z]\w+) \(", line) or [None, ""])[1] for line in tree]
    numbers = [re.search(r"\((\d+)\)", line)[1] for line in tree]
    found = []
    for i, name in enumerate(names):
        if name != "Exchange":
            continue
        sides = [next((numbers[j] for j in steps if names[j].endswith("HashAggregate")), None)
                 for steps in (range(i - 1, -1, -1), range(i + 1, len(names)))]
        if None not in sides and "WindowExec" not in names[i - 1]:
            found.append(tuple(functions.get(side, "") for side in sides))
    return found


WRITES = ("round_trip", "rerun_empty", "raw_lines", "day_report", "row_counts", "daily_run")
BANNED = ("PythonUDF", "BatchEvalPython", "ArrowEval", "MapInPandas", "MapInArrow", "CartesianProduct", "NestedLoop")


@pytest.mark.parametrize("name", [name for name in CORE if name != "column_types"])
def test_no_python_and_no_cross_join(spark, name):
    """Of queries that store, this is the plan of the reading; the next tests see the writing.

    Only footers, which Spark hands out to nobody, are read in Python.
    """
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert not [word for word in BANNED if word in text]


def test_silver_is_written_without_shuffle_or_sort(spark):
    text = plan(entry._silver(spark, SF_DIR))
    assert not [word for word in ("Exchange", "Sort ", "Join", *BANNED) if word in text]


def test_bronze_fields_that_are_dropped_are_not_parsed(spark, tmp_path):
    lake = Lakehouse(*(str(tmp_path / layer) for layer in ("bronze", "silver", "gold")))
    fixture.bronze(spark, SF_DIR).write.json(lake.bronze_day(fixture.RUN_DATE))
    bronze = tables.read_bronze(spark, lake, fixture.RUN_DATE)
    (read,) = read_columns(plan(entry._to_silver(bronze)))
    assert "id_number" in read and not read & {"email_address", "cellphone_number", "gps_latitude", "branch_code"}


@pytest.mark.parametrize("name", gold.TABLES)
def test_plans_that_are_written(stored, name):
    text = plan(gold.arrange(name, gold.build(name, facts.facts(stored))))
    assert not [word for word in BANNED if word in text]
    assert text.count("rangepartitioning") == (name != "client_financial_activity")


def test_events_are_spread_before_they_become_wide_raw_rows(spark):
    """Few files of narrow events make many times their size of raw text: not by as few tasks, and not shuffled wide."""
    text = plan(fixture.identified_bronze(spark, SF_DIR))
    spread = re.search(r"\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(event_id", text)
    assert set(re.findall(r"(\w+)#", spread[1])) == {"event_id", "user_id", "value", "ts"}
    assert read_columns(text) == [{"event_id", "user_id", "value", "ts"}]
    assert sorted(fixture.bronze(spark, SF_DIR, spread=True).collect()) == sorted(fixture.bronze(spark, SF_DIR).collect())
