"""Every rule fails for its own violation, and for nothing else."""

import json
from datetime import date

import pytest

from ledgerfall.operators import rules as R
from ledgerfall.operators import validation
from ledgerfall.schemas import SILVER_COLUMNS
from tests.rows import HASH, atm, eft, pos, silver

DAY = date(2026, 3, 30)
GOOD = (pos(), eft(), atm())


def failures(df) -> dict[str, str]:
    rows = validation.failed(validation.results(validation.report(df, DAY, "path"))).collect()
    return {r["check"]: r["detail"] for r in rows}


def test_there_are_48_rules():
    assert len(R.ALL) == len({r.check for r in R.ALL}) == 48
    assert [len(R.of_category(c)) for c in R.CATEGORIES] == [13, 6, 4, 7, 18]


def test_good_rows_pass(spark):
    report = validation.report(silver(spark, *GOOD), DAY, "path").first()
    assert report["overall"] == "PASS" and report["checks_passed"] == 48 and report["checks_failed"] == 0
    assert [r["check"] for r in report["results"]] == [r.check for r in R.ALL]
    details = {r["check"]: r["detail"] for r in report["results"] if r["detail"] is not None}
    assert details == {"partition has at least 1 row": "3 rows"}


NULLS = {c: pos(9, **{c: None}) for c in R.V.REQUIRED_COLUMNS}
BAD_ROWS = [
    *(
        pytest.param(row, {f"{c} is never null": "1 null rows"}, id=f"null {c}")
        for c, row in NULLS.items()
        if c != "transaction_category"
    ),
    pytest.param(
        eft(9, transaction_category=None), {"transaction_category is never null": "1 null rows"}, id="null category"
    ),
    pytest.param(
        pos(9, transaction_type="??"), {"transaction_type within allowed set": "1 unexpected values"}, id="bad type"
    ),
    pytest.param(
        eft(9, transaction_category="??"), {"transaction_category within allowed set": "1 unexpected values"}, id="bad category"
    ),
    pytest.param(pos(9, channel="??"), {"channel within allowed set": "1 unexpected values"}, id="bad channel"),
    pytest.param(pos(9, status="??"), {"status within allowed set": "1 unexpected values"}, id="bad status"),
    pytest.param(
        eft(9, transaction_category="SWIFT", currency="??"),
        {"currency within allowed set": "1 unexpected values"},
        id="bad currency",
    ),
    pytest.param(pos(9, gender="??"), {"gender within allowed set": "1 unexpected values"}, id="bad gender"),
    pytest.param(
        pos(9, transaction_id="TXN-20260330-00000000000a"),
        {"transaction_id matches TXN-YYYYMMDD-<HEX12>": "1 malformed IDs"},
        id="lower-case id",
    ),
    *(
        pytest.param(pos(9, account_number=bad), {"account_number is SHA-256 hex": "1 malformed values"}, id=f"account {name}")
        for name, bad in (("short", HASH[:63]), ("not hex", HASH[:63] + "g"), ("upper", HASH.upper()), ("empty", ""))
    ),
    pytest.param(
        pos(9, beneficiary_account_number=HASH + "0"),
        {"beneficiary_account_number is SHA-256 hex when not null": "1 malformed values"},
        id="long beneficiary",
    ),
    pytest.param(pos(9, age=17), {"age >= 18": "1 underage rows"}, id="underage"),
    pytest.param(pos(1), {"transaction_id is unique": "1 duplicates"}, id="duplicate"),
    pytest.param(pos(9, amount=-0.01), {"amount >= 0": "1 negative rows"}, id="negative amount"),
    pytest.param(pos(9, running_balance=-1.0), {"running_balance >= 0": "1 negative rows"}, id="overdraft"),
    pytest.param(
        atm(9, transaction_type="CREDIT"), {"ATM transactions are always DEBIT": "1 ATM CREDIT rows"}, id="ATM credit"
    ),
    pytest.param(pos(9, currency="USD"), {"non-SWIFT transactions use ZAR": "1 violations"}, id="POS in USD"),
    *(
        pytest.param(pos(9, **{c: None}), {f"{c} populated for POS": f"1 POS rows missing {c}"}, id=f"POS without {c}")
        for c in R.V.MERCHANT_COLUMNS
    ),
    *(
        pytest.param(eft(9, **{c: "x"}), {f"{c} null for EFT/SWIFT/DebiCheck/RTC": "1 unexpected rows"}, id=f"EFT with {c}")
        for c in R.V.MERCHANT_COLUMNS
    ),
    pytest.param(
        atm(9, beneficiary_account_number=HASH),
        {"beneficiary_account_number null for ATM": "1 unexpected rows"},
        id="ATM with beneficiary",
    ),
    pytest.param(
        eft(9, beneficiary_account_number=None),
        {"beneficiary_account_number populated for non-ATM": "1 missing rows"},
        id="EFT without beneficiary",
    ),
    *(
        pytest.param(
            pos(9, status=status, reversal_flag=True, reversal_reference="r"),
            {f"reversal_flag is False when status={status}": "1 violations"},
            id=f"{status} reversed",
        )
        for status in ("PENDING", "FAILED")
    ),
    pytest.param(
        pos(9, reversal_flag=True),
        {"reversal_reference populated when reversal_flag=True": "1 rows missing reference"},
        id="no reference",
    ),
    pytest.param(
        pos(9, reversal_reference="r"),
        {"reversal_reference null when reversal_flag=False": "1 rows with unexpected reference"},
        id="reference without reversal",
    ),
    *(
        pytest.param(atm(9, **{c: None}), {f"{c} populated for ATM": f"1 ATM rows missing {c}"}, id=f"ATM without {c}")
        for c in R.V.TERMINAL_COLUMNS
    ),
    *(
        pytest.param(pos(9, **{c: "x"}), {f"{c} null for non-ATM": "1 unexpected rows"}, id=f"POS with {c}")
        for c in R.V.TERMINAL_COLUMNS
    ),
]


@pytest.mark.parametrize(("row", "expected"), BAD_ROWS)
def test_violation(spark, row, expected):
    assert failures(silver(spark, *GOOD, row)) == expected


def test_each_rule_has_a_violation_test():
    covered = {check for p in BAD_ROWS for check in p.values[1]}
    rest = {r.check for r in R.ALL} - covered
    assert rest == {"column set matches expected schema", "partition has at least 1 row"}


def test_null_ids_are_one_value(spark):
    rows = [pos(9, transaction_id=None), pos(9, transaction_id=None), pos(9, transaction_id=None)]
    assert failures(silver(spark, *GOOD, *rows)) == {
        "transaction_id is never null": "3 null rows",
        "transaction_id is unique": "2 duplicates",
    }


def test_empty_silver(spark):
    assert failures(silver(spark)) == {"partition has at least 1 row": "0 rows"}


def test_columns_are_compared_first(spark):
    df = silver(spark, *GOOD).drop("gender", "transaction_id").selectExpr("*", "1 AS zz", "2 AS extra")
    assert failures(df) == {
        "column set matches expected schema": "extra: ['extra', 'zz'] missing: ['gender', 'transaction_id']",
        "gender is never null": "missing column gender",
        "gender within allowed set": "missing column gender",
        "transaction_id is never null": "missing column transaction_id",
        "transaction_id matches TXN-YYYYMMDD-<HEX12>": "missing column transaction_id",
        "transaction_id is unique": "missing column transaction_id",
    }


def test_amounts_may_be_text(spark):
    df = silver(spark, *GOOD).selectExpr(*(f"CAST({c} AS STRING) AS {c}" if c == "amount" else c for c in SILVER_COLUMNS))
    assert failures(df) == {}
    assert failures(df.selectExpr(*("'much' AS amount" if c == "amount" else c for c in SILVER_COLUMNS))) == {
        "amount is never null": "3 null rows"
    }


def test_gate_raises_with_counts(spark):
    bad = validation.report(silver(spark, *GOOD, pos(9, age=17, currency="USD")), DAY, "path")
    with pytest.raises(validation.ValidationFailed, match="^Silver validation failed: 2/48 checks did not pass.$"):
        validation.enforce(bad)
    validation.enforce(validation.report(silver(spark, *GOOD), DAY, "path"))


def test_summary(spark):
    results = validation.results(validation.report(silver(spark, pos(9, age=17)), DAY, "path"))
    assert tuple(validation.summary(results).first()) == (48, 47, 1, "FAIL")


def test_report_as_json(spark):
    report = json.loads(validation.report(silver(spark, *GOOD), DAY, "path").toJSON().first())
    assert list(report) == [
        "run_date",
        "silver_path",
        "total_rows",
        "checks_passed",
        "checks_failed",
        "overall",
        "results",
    ]
    assert report["run_date"] == "2026-03-30" and report["total_rows"] == 3
