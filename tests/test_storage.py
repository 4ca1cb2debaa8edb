"""Reading, writing, and the day as a whole."""

import json
from datetime import date
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerfall import fixture
from ledgerfall.operators import facts, gold, minimise, validation
from ledgerfall.plans import daily
from ledgerfall.schemas import GOLD, SILVER_COLUMNS
from ledgerfall.sources import footers, releases, tables
from ledgerfall.sources.layout import Lakehouse
from ledgerfall.sources.scratch import scratch_folder
from tests.conftest import SF_DIR
from tests.rows import atm, eft, pos, silver

DAY, NEXT_DAY = date(2026, 3, 5), date(2026, 3, 6)


@pytest.fixture
def lake(tmp_path):
    return Lakehouse(*(str(tmp_path / layer) for layer in ("bronze", "silver", "gold")))


def store_lines(lake, day, *lines):
    folder = Path(lake.bronze_day(day))
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("\n".join(lines) + "\n")


def test_bronze_edge_lines(spark, lake):
    store_lines(
        lake,
        DAY,
        '{"transaction_id": "a", "amount": 12.5, "reversal_flag": false, "running_balance": 1e3}',
        '{"transaction_id": "b", "amount": "12345.67", "unknown_field": 1}',
        "{bad",
        '{"transaction_id": "c", "amount": null}',
    )
    df = tables.read_bronze(spark, lake, DAY)
    assert len(df.columns) == 30
    rows = minimise.normalise_amounts(df).select("transaction_id", "amount", "running_balance", "reversal_flag").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 12.5, 1000.0, False),
        ("b", 12345.67, None, None),
        (None, None, None, None),
        ("c", None, None, None),
    ]


def test_silver_day_is_replaced(spark, lake):
    tables.write_silver(silver(spark, pos(), eft()), lake, DAY)
    tables.write_silver(silver(spark, pos(), eft(), atm()), lake, NEXT_DAY)
    tables.write_silver(silver(spark, pos(), eft()), lake, DAY)
    assert Path(lake.silver_day(DAY)).name == "day=05"
    assert tables.read_silver(spark, lake, DAY).count() == 2
    assert tables.read_silver(spark, lake, NEXT_DAY).count() == 3
    assert tables.read_silver(spark, lake, DAY).columns == list(SILVER_COLUMNS)
    tables.write_silver(silver(spark, pos()), lake, DAY, mode="append")
    assert tables.read_silver(spark, lake, DAY).count() == 3


def test_to_silver_tolerates_absent_and_keeps_unknown_columns(spark):
    bronze = fixture.bronze(spark, SF_DIR).drop("gps_latitude", "email_address").selectExpr("*", "1 AS novelty")
    df = minimise.to_silver(bronze, fixture.salt(spark), DAY)
    assert df.columns == [*SILVER_COLUMNS, "novelty"]


def test_gold_is_in_order_and_dated_by_path(spark, lake):
    rows = facts.facts(silver(spark, *(pos(i, merchant_category_code=f"MCC {i}", amount=float(i % 7)) for i in range(50))))
    written = tables.write_gold(gold.build("mcc_spend", rows), lake, "mcc_spend", DAY)
    assert written == 50
    files = sorted(Path(lake.gold_table("mcc_spend")).rglob("*.parquet"))
    stored = [r for f in files for r in pq.ParquetFile(f).read().to_pylist()]
    assert "run_date" not in stored[0]
    assert [r["total_spend"] for r in stored] == sorted((r["total_spend"] for r in stored), reverse=True)
    assert tables.read_gold(spark, lake, "mcc_spend", DAY).select("run_date").distinct().collect()[0][0] == "2026-03-05"


def test_gold_days_are_independent(spark, lake):
    table = gold.build("reversal_rates", facts.facts(silver(spark, pos(), eft())))
    for day in (DAY, NEXT_DAY, DAY):
        tables.write_gold(table, lake, "reversal_rates", day)
    assert [tables.read_gold(spark, lake, "reversal_rates", d).count() for d in (DAY, NEXT_DAY)] == [2, 2]


def test_report_round_trip(spark, lake):
    report = validation.report(silver(spark, pos(age=17), eft()), DAY, "p")
    tables.write_report(report, lake, DAY)
    (part,) = Path(lake.gold).rglob("part-*.json")
    document = json.loads(part.read_text())
    assert len(document["results"]) == 48 and document["results"][0]["detail"] is None
    back = tables.read_report(spark, lake, DAY)
    assert validation.results(back).collect() == validation.results(report).collect()


def test_indented_report_is_read(spark, lake):
    document = {
        "run_date": "2026-03-05",
        "silver_path": "p",
        "total_rows": 1,
        "checks_passed": 0,
        "checks_failed": 1,
        "overall": "FAIL",
        "results": [{"category": "Format", "check": "c", "passed": False, "detail": None}],
    }
    path = Path(lake.report_day(DAY))
    path.parent.mkdir(parents=True)
    path.write_text(json.dumps(document, indent=2))
    rows = validation.results(tables.read_report(spark, lake, DAY)).collect()
    assert [tuple(r) for r in rows] == [("Format", "c", False, None)]


def store_fixture(spark, lake, bronze=fixture.bronze):
    bronze(spark, SF_DIR).write.json(lake.bronze_day(DAY))


def test_whole_day_and_again(spark, lake):
    store_fixture(spark, lake, fixture.identified_bronze)
    first = daily.run_day(spark, lake, fixture.salt(spark), DAY)
    again = daily.run_day(spark, lake, fixture.salt(spark), DAY)
    assert first == again and list(first) == list(GOLD) and all(n > 0 for n in first.values())
    assert {name: tables.read_gold(spark, lake, name, DAY).count() for name in GOLD} == first
    assert tables.read_report(spark, lake, DAY).first()["overall"] == "PASS"


def test_gate_stops_before_gold(spark, lake):
    store_fixture(spark, lake)
    with pytest.raises(validation.ValidationFailed, match="2/48"):
        daily.run_day(spark, lake, fixture.salt(spark), DAY)
    report = tables.read_report(spark, lake, DAY).first()
    assert (report["overall"], report["checks_failed"], report["silver_path"]) == ("FAIL", 2, lake.silver_day(DAY))
    assert not Path(lake.gold, "aggregations").exists()


def test_empty_rerun_replaces_the_day_and_stops(spark, lake):
    store_fixture(spark, lake, fixture.identified_bronze)
    daily.run_day(spark, lake, fixture.salt(spark), DAY)
    for file in Path(lake.bronze_day(DAY)).glob("part-*"):
        file.write_text("")
    with pytest.raises(validation.ValidationFailed, match="1/48"):
        daily.run_day(spark, lake, fixture.salt(spark), DAY)
    report = tables.read_report(spark, lake, DAY).first()
    failed = [r["detail"] for r in report["results"] if not r["passed"]]
    assert (report["total_rows"], failed) == (0, ["0 rows"])
    assert tables.read_silver(spark, lake, DAY).count() == 0


def test_empty_day_builds_no_gold(spark, lake):
    store_lines(lake, DAY, "")
    with pytest.raises(validation.ValidationFailed, match="1/48"):
        daily.run_day(spark, lake, fixture.salt(spark), DAY)
    assert not Path(lake.gold, "aggregations").exists()


def test_unreal_amount_stops_at_the_gate(spark, lake):
    store_fixture(spark, lake, fixture.identified_bronze)
    first = Path(lake.bronze_day(DAY)).glob("part-*.json").__next__()
    lines = first.read_text().splitlines()
    lines[0] = json.dumps({**json.loads(lines[0]), "amount": "NaN"})
    first.write_text("\n".join(lines) + "\n")
    (first.parent / f".{first.name}.crc").unlink()
    with pytest.raises(validation.ValidationFailed, match="1/48"):
        daily.run_day(spark, lake, fixture.salt(spark), DAY)
    failed = [r for r in tables.read_report(spark, lake, DAY).first()["results"] if not r["passed"]]
    assert [(r["check"], r["detail"]) for r in failed] == [("amount is never null", "1 null rows")]


def test_a_column_of_an_added_file_is_seen(spark, lake):
    tables.write_silver(silver(spark, pos(1)), lake, DAY)
    tables.write_silver(silver(spark, pos(2)).selectExpr("*", "1 AS zz"), lake, DAY, mode="append")
    results = validation.results(daily.validate_silver(spark, lake, DAY)).where("NOT passed").collect()
    assert [(r["check"], r["detail"].strip()) for r in results] == [("column set matches expected schema", "extra: ['zz']")]


class Session:
    """What scratch_folder asks of a session."""

    def __init__(self, master, shared=None):
        self.sparkContext, self.conf = self, self
        self.master, self.shared = master, shared

    def get(self, key, default):
        return self.shared or default


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session(master))
    assert scratch_folder(Session(master, "hdfs://name/shared/")).startswith("hdfs://name/shared/ledgerfall-")


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]"])
def test_scratch_folders_have_a_scheme(master):
    assert scratch_folder(Session(master)).startswith("file:///")
    assert scratch_folder(Session(master, "/shared")).startswith("file:///shared/ledgerfall-")


def broken(rows):
    """The last transaction cannot be written."""
    return rows.withColumn("currency", F.when(F.col("transaction_id") == rows.agg({"transaction_id": "max"}).first()[0], F.raise_error(F.lit("broken"))).otherwise(F.col("currency")))


def test_a_failed_rerun_leaves_silver(spark, lake):
    tables.write_silver(silver(spark, *(pos(i) for i in range(1000))), lake, DAY)
    for mode in ("overwrite", "append"):
        with pytest.raises(PySparkException):
            tables.write_silver(broken(silver(spark, *(pos(i) for i in range(500)))), lake, DAY, mode)
        assert tables.read_silver(spark, lake, DAY).count() == 1000
    tables.write_silver(silver(spark, pos(1)), lake, DAY)
    assert tables.read_silver(spark, lake, DAY).count() == 1


@pytest.mark.parametrize("at", ["silver", "report", *GOLD, "publish"])
def test_a_run_that_fails_anywhere_leaves_the_day(spark, lake, at, monkeypatch):
    """All tables are of the first run, wherever the second one, of other rows, ends."""
    store_fixture(spark, lake, fixture.identified_bronze)
    daily.run_day(spark, lake, fixture.salt(spark), DAY)
    state = lambda: {
        "silver": tables.read_silver(spark, lake, DAY).count(), "report": tables.read_report(spark, lake, DAY).first()["total_rows"],
        **{name: sorted(map(tuple, tables.read_gold(spark, lake, name, DAY).collect()), key=str) for name in ("channel_adoption", "mcc_spend")},
        **{f"n {name}": tables.read_gold(spark, lake, name, DAY).count() for name in GOLD},
    }
    before = state()
    fixture.identified_bronze(spark, SF_DIR).limit(40).write.mode("overwrite").json(lake.bronze_day(DAY))

    def fail(name, work):
        def failing(*args, **kwargs):
            if at in (name, *args):
                raise OSError(at)
            return work(*args, **kwargs)

        return failing

    for name, function in (("silver", "stage_silver"), ("report", "stage_report"), ("gold", "stage_gold")):
        monkeypatch.setattr(tables, function, fail(name, getattr(tables, function)))
    monkeypatch.setattr(releases, "publish", fail("publish", releases.publish))
    with pytest.raises(OSError, match=at):
        daily.run_day(spark, lake, fixture.salt(spark), DAY)
    assert state() == before
    monkeypatch.undo()
    daily.run_day(spark, lake, fixture.salt(spark), DAY)
    assert state()["silver"] == state()["report"] == 40


def test_releases_add_up(spark, lake):
    for run, of, adds in (("a", ["silver", "report"], False), ("b", ["silver"], True), ("c", ["report"], False)):
        releases.publish(spark, lake, DAY, run, of, adds)
    assert releases.current(spark, lake, DAY) == {"silver": ["a", "b"], "report": ["c"]}
    assert releases.current(spark, lake, NEXT_DAY) == {}
    releases.publish(spark, lake, DAY, "d", ["silver"])
    assert releases.current(spark, lake, DAY)["silver"] == ["d"]
    assert releases.superseded(spark, lake, DAY) == {"silver": ["a", "b"], "report": ["a"]}


def test_other_files_are_no_releases(spark, lake):
    releases.publish(spark, lake, DAY, "a", ["silver"])
    (Path(lake.releases_day(DAY)) / "_notes.txt").write_text("b")
    assert releases.current(spark, lake, DAY) == {"silver": ["a"]}


def test_a_lake_without_releases_is_read(spark, lake):
    silver(spark, pos(1), pos(2)).write.parquet(lake.silver_day(DAY))
    assert tables.read_silver(spark, lake, DAY).count() == 2
    tables.write_silver(silver(spark, pos(1)), lake, DAY)
    assert tables.read_silver(spark, lake, DAY).count() == 1


def test_files_that_disagree_on_a_type(spark, lake):
    """A file that another writer has put into the day, with ages as text, one of them no number."""
    silver(spark, pos(1), pos(2, age=30)).write.parquet(lake.silver_day(DAY))
    text = silver(spark, pos(3), pos(4)).withColumn("age", F.when(F.col("transaction_id") == pos(4)["transaction_id"], "x").otherwise("41"))
    text.withColumn("extra", F.lit(1.5)).write.mode("append").parquet(lake.silver_day(DAY))
    failed = validation.results(daily.validate_silver(spark, lake, DAY)).where("NOT passed").collect()
    assert [(r["check"], r["detail"]) for r in failed] == [
        ("age is never null", "1 null rows"),
        ("column set matches expected schema", "extra: ['extra'] several types: ['age: int, string']"),
    ]
    whole = footers.read_all(spark, [lake.silver_day(DAY)])
    assert whole.columns == [*SILVER_COLUMNS, "extra"] and whole.count() == 4
    assert sorted(str(r["age"]) for r in whole.collect()) == sorted(["30", "41", "None", str(pos(1)["age"])])


def test_catalogue_of_other_writers(spark, tmp_path):
    table = pa.table({"a b": pa.array([1], pa.int32()), "d": pa.array([None], pa.decimal128(9, 2)), "t": pa.array(["x"])})
    pq.write_table(table, tmp_path / "one file.parquet")
    rows = footers.catalogue(spark, [str(tmp_path)]).collect()
    assert {(r["column"], r["type"]) for r in rows} == {("a b", "int"), ("d", "decimal(9, 2)"), ("t", "string")}
