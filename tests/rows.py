"""Hand-made Silver rows."""

from pyspark.sql import DataFrame, SparkSession

SILVER = """
    transaction_id string, transaction_datetime string, transaction_type string, transaction_category string,
    channel string, status string, amount double, currency string, running_balance double, reversal_flag boolean,
    reversal_reference string, account_number string, beneficiary_account_number string, age int, gender string,
    merchant_name string, merchant_category_code string, merchant_city string, atm_terminal_id string,
    atm_province string, atm_city string
"""
HASH = "0123456789abcdef" * 4
COLUMNS = [c.split()[0] for c in SILVER.replace("\n", " ").split(",")]


def _base(n: int) -> dict:
    return {
        "transaction_id": f"TXN-20260330-{n:012X}",
        "transaction_datetime": "2026-03-30 12:00:00+02:00",
        "transaction_type": "DEBIT",
        "channel": "MOBILE",
        "status": "SETTLED",
        "amount": 10.0,
        "currency": "ZAR",
        "running_balance": 100.0,
        "reversal_flag": False,
        "account_number": HASH,
        "beneficiary_account_number": HASH,
        "age": 30,
        "gender": "F",
    }


def pos(n: int = 1, **changes) -> dict:
    shop = {"merchant_name": "Shop", "merchant_category_code": "MCC 5411", "merchant_city": "Town"}
    return {**_base(n), "transaction_category": "POS", **shop, **changes}


def eft(n: int = 2, **changes) -> dict:
    return {**_base(n), "transaction_category": "EFT", **changes}


def atm(n: int = 3, **changes) -> dict:
    machine = {"atm_terminal_id": "ATM-1", "atm_province": "Gauteng", "atm_city": "City"}
    return {
        **_base(n),
        "transaction_category": "ATM",
        "channel": "ATM",
        "beneficiary_account_number": None,
        **machine,
        **changes,
    }


def silver(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], SILVER)
