"""Column layouts of the three layers and of the validation report, as DDL."""

from pyspark.sql import DataFrame

#: Key of a column's metadata that has the types which the files behind it give the column, if several.
FILE_TYPES = "file_types"


def mixed(df: DataFrame) -> dict[str, list[str]]:
    """Columns that the files behind ``df`` have in several types, with these types."""
    return {f.name: list(f.metadata[FILE_TYPES]) for f in df.schema if f.metadata and FILE_TYPES in f.metadata}


# --- Fixed values: column layouts

# Amounts are text in Bronze: writers emit them as JSON numbers or as quoted
# decimals, and text takes both.  Silver holds them as double.
BRONZE = """
    transaction_id string, transaction_datetime string, transaction_type string,
    transaction_category string, channel string, status string, amount string,
    currency string, running_balance string, reversal_flag boolean,
    reversal_reference string, account_number string, account_holder_name string,
    beneficiary_account_number string, beneficiary_name string, id_number string,
    cellphone_number string, email_address string, physical_address string,
    branch_code string, ip_address string, device_fingerprint string,
    gps_latitude double, gps_longitude double, merchant_name string,
    merchant_category_code string, merchant_city string, atm_terminal_id string,
    atm_province string, atm_city string
"""

SILVER_COLUMNS = (
    "transaction_id",
    "transaction_datetime",
    "transaction_type",
    "transaction_category",
    "channel",
    "status",
    "amount",
    "currency",
    "running_balance",
    "reversal_flag",
    "reversal_reference",
    "account_number",
    "beneficiary_account_number",
    "age",
    "gender",
    "merchant_name",
    "merchant_category_code",
    "merchant_city",
    "atm_terminal_id",
    "atm_province",
    "atm_city",
)

#: Types of Silver columns that are no text.
SILVER_TYPES = {"amount": "double", "running_balance": "double", "reversal_flag": "boolean", "age": "int"}


def silver_type(column: str) -> str:
    return SILVER_TYPES.get(column, "string")


# run_date is the partition column of every Gold table: it is in the path only.
GOLD = {
    "spend_by_age_band": """
        age_band string, transaction_category string, transaction_count bigint,
        total_spend double, avg_spend double, max_spend double
    """,
    "client_financial_activity": """
        account_number string, total_transactions bigint, debit_count bigint,
        credit_count bigint, total_debited double, total_credited double,
        net_movement double, avg_transaction_amount double,
        closing_balance double, reversal_count bigint,
        distinct_categories_used bigint, distinct_channels_used bigint
    """,
    "channel_adoption": """
        channel string, transaction_category string, total_transactions bigint,
        settled_count bigint, failed_count bigint, reversed_count bigint,
        pending_count bigint, total_amount double, avg_amount double,
        unique_accounts bigint, failure_rate double
    """,
    "provincial_flow": """
        atm_province string, transaction_type string, transaction_count bigint,
        total_amount double, avg_amount double, unique_accounts bigint
    """,
    "reversal_rates": """
        transaction_category string, status string, transaction_count bigint,
        total_amount double, rate double
    """,
    "time_of_day": """
        hour_of_day int, transaction_category string, transaction_count bigint,
        total_spend double, avg_spend double
    """,
    "currency_by_age": """
        age_band string, currency string, transaction_count bigint,
        total_amount double, unique_accounts bigint
    """,
    "mcc_spend": """
        merchant_category_code string, transaction_count bigint,
        total_spend double, avg_spend double, max_spend double,
        unique_accounts bigint
    """,
}

REPORT = """
    run_date string, silver_path string, total_rows bigint,
    checks_passed bigint, checks_failed bigint, overall string,
    results array<struct<category: string, `check`: string, passed: boolean, detail: string>>
"""
