"""The registered queries once more, as SQL for a second engine.

Written for DuckDB on the same parquet tables.  Nothing here uses the package but
the text that derives transactions from ``events``, which both engines share.
"""

from ledgerfall.fixture import BRONZE_SQL, DAMAGED_SQL, IDENTIFIED_SQL

RUN_DATE = "2026-03-30"
SILVER_PATH = "silver"

SILVER = """
SELECT transaction_id, transaction_datetime, transaction_type, transaction_category, channel, status,
  CAST(amount AS DOUBLE) AS amount, currency, CAST(running_balance AS DOUBLE) AS running_balance,
  reversal_flag, reversal_reference,
  sha256('salt' || account_number) AS account_number,
  sha256('salt' || beneficiary_account_number) AS beneficiary_account_number,
  CAST(2026 - year(birth) - CASE WHEN month(birth)*100 + day(birth) > 330 THEN 1 ELSE 0 END AS INTEGER) AS age,
  CASE WHEN birth IS NULL THEN NULL WHEN substr(id_number,7,4) >= '5000' THEN 'M' ELSE 'F' END AS gender,
  merchant_name, merchant_category_code, merchant_city, atm_terminal_id, atm_province, atm_city
FROM (SELECT *, CASE WHEN length(id_number) = 13 AND regexp_matches(id_number, '^[0-9]{10}') THEN
        TRY_CAST((CASE WHEN substr(id_number,1,2) >= '25' THEN '19' ELSE '20' END) || substr(id_number,1,2)
          || '-' || substr(id_number,3,2) || '-' || substr(id_number,5,2) AS DATE) END AS birth
      FROM bronze)
"""

AGE_BAND = """CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
  WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END"""
# DuckDB drops the offset when it casts such text, so it is taken off here.
HOUR_UTC = "CAST(hour(CAST(substr(transaction_datetime,1,19) AS TIMESTAMP) - INTERVAL 2 HOUR) AS INTEGER)"
HOUR_SAST = "CAST(hour(CAST(substr(transaction_datetime,1,19) AS TIMESTAMP)) AS INTEGER)"

PRICED = f"""
SELECT *, CAST(amount AS DECIMAL(24,6)) AS c, CAST(running_balance AS DECIMAL(24,6)) AS b,
  {AGE_BAND} AS age_band, {HOUR_UTC} AS hour_of_day
FROM silver
"""

N = "count(*)"
SUM = "CAST(round(sum(c), 2) AS DOUBLE)"
# Amounts are not negative; 20000 halves of a cent's ten thousandth make a cent.
AVG = "((2*CAST(sum(c)*1000000 AS HUGEINT)+10000*count(c))//(20000*count(c)))/100.0"
MAX = "CAST(round(max(c), 2) AS DOUBLE)"
ACCOUNTS = "count(DISTINCT account_number)"
SETTLED = "status = 'SETTLED'"


def _part(condition: str, measure: str = "1") -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN {measure} ELSE 0 END) AS BIGINT)"


def _exact(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN c ELSE 0 END)"


def _amount(exact: str) -> str:
    return f"CAST(round({exact}, 2) AS DOUBLE)"


GOLD = {
    "spend_by_age_band": f"""
SELECT age_band, transaction_category, {N} AS transaction_count, {SUM} AS total_spend, {AVG} AS avg_spend, {MAX} AS max_spend
FROM priced WHERE {SETTLED} AND transaction_type = 'DEBIT' GROUP BY ALL""",
    "client_financial_activity": f"""
SELECT account_number, {N} AS total_transactions,
  {_part("transaction_type='DEBIT'", "1")} AS debit_count, {_part("transaction_type='CREDIT'", "1")} AS credit_count,
  {_amount(_exact("transaction_type='DEBIT'"))} AS total_debited, {_amount(_exact("transaction_type='CREDIT'"))} AS total_credited,
  {_amount(_exact("transaction_type='CREDIT'") + " - " + _exact("transaction_type='DEBIT'"))} AS net_movement,
  {AVG} AS avg_transaction_amount, {_amount("max(b)")} AS closing_balance, {_part("reversal_flag", "1")} AS reversal_count,
  count(DISTINCT transaction_category) AS distinct_categories_used, count(DISTINCT channel) AS distinct_channels_used
FROM priced WHERE {SETTLED} GROUP BY account_number""",
    "channel_adoption": f"""
SELECT channel, transaction_category, {N} AS total_transactions,
  {_part("status='SETTLED'", "1")} AS settled_count, {_part("status='FAILED'", "1")} AS failed_count,
  {_part("status='REVERSED'", "1")} AS reversed_count, {_part("status='PENDING'", "1")} AS pending_count,
  {SUM} AS total_amount, {AVG} AS avg_amount, {ACCOUNTS} AS unique_accounts,
  ((20000*{_part("status='FAILED'", "1")}+count(*))//(2*count(*)))/10000.0 AS failure_rate
FROM priced GROUP BY channel, transaction_category""",
    "provincial_flow": f"""
SELECT atm_province, transaction_type, {N} AS transaction_count, {SUM} AS total_amount, {AVG} AS avg_amount,
  {ACCOUNTS} AS unique_accounts
FROM priced WHERE {SETTLED} AND transaction_category = 'ATM' GROUP BY atm_province, transaction_type""",
    "reversal_rates": f"""
SELECT transaction_category, status, n AS transaction_count, total_amount,
  ((20000*n + t)//(2*t))/10000.0 AS rate
FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY transaction_category) AS BIGINT) AS t FROM
  (SELECT transaction_category, status, {N} AS n, {SUM} AS total_amount FROM priced GROUP BY transaction_category, status))""",
    "time_of_day": f"""
SELECT hour_of_day, transaction_category, {N} AS transaction_count, {SUM} AS total_spend, {AVG} AS avg_spend
FROM priced WHERE {SETTLED} AND transaction_type = 'DEBIT' GROUP BY hour_of_day, transaction_category""",
    "currency_by_age": f"""
SELECT age_band, currency, {N} AS transaction_count, {SUM} AS total_amount, {ACCOUNTS} AS unique_accounts
FROM priced WHERE {SETTLED} AND transaction_category = 'SWIFT' GROUP BY age_band, currency""",
    "mcc_spend": f"""
SELECT merchant_category_code, {N} AS transaction_count, {SUM} AS total_spend, {AVG} AS avg_spend, {MAX} AS max_spend,
  {ACCOUNTS} AS unique_accounts
FROM priced WHERE {SETTLED} AND merchant_category_code IS NOT NULL GROUP BY merchant_category_code""",
}

# --- Fixed values: required columns, categories, statuses and currencies, and the checks' names
REQUIRED = (
    "transaction_id", "transaction_datetime", "transaction_type", "transaction_category", "channel", "status", "amount",
    "currency", "running_balance", "reversal_flag", "account_number", "age", "gender",
)
CATEGORIES = ("ATM", "POS", "EFT", "SWIFT", "DebiCheck", "RTC")
STATUSES = ("SETTLED", "PENDING", "REVERSED", "FAILED")
CURRENCIES = ("ZAR", "USD", "EUR", "GBP", "CHF", "JPY", "AUD")

# (category, check, violation, what follows the number)
CHECKS = [
    *(("Completeness", f"{c} is never null", f"{c} IS NULL", "null rows") for c in REQUIRED),
    *(
        ("Allowed Values", f"{c} within allowed set", f"NOT ({c} IN ({values}))", "unexpected values")
        for c, values in (
            ("transaction_type", "'DEBIT','CREDIT'"),
            ("transaction_category", "'ATM','POS','EFT','SWIFT','DebiCheck','RTC'"),
            ("channel", "'MOBILE','INTERNET','BRANCH','ATM'"),
            ("status", "'SETTLED','PENDING','REVERSED','FAILED'"),
            ("currency", "'ZAR','USD','EUR','GBP','CHF','JPY','AUD'"),
            ("gender", "'M','F'"),
        )
    ),
    ("Format", "transaction_id matches TXN-YYYYMMDD-<HEX12>",
     "NOT regexp_full_match(transaction_id, 'TXN-[0-9]{8}-[0-9A-F]{12}')", "malformed IDs"),
    ("Format", "account_number is SHA-256 hex", "NOT regexp_full_match(account_number, '[0-9a-f]{64}')", "malformed values"),
    ("Format", "beneficiary_account_number is SHA-256 hex when not null",
     "NOT regexp_full_match(beneficiary_account_number, '[0-9a-f]{64}')", "malformed values"),
    ("Format", "age >= 18", "age < 18", "underage rows"),
    ("Business Rules", "amount >= 0", "amount < 0", "negative rows"),
    ("Business Rules", "running_balance >= 0", "running_balance < 0", "negative rows"),
    ("Business Rules", "ATM transactions are always DEBIT",
     "transaction_category = 'ATM' AND transaction_type = 'CREDIT'", "ATM CREDIT rows"),
    ("Business Rules", "non-SWIFT transactions use ZAR", "transaction_category <> 'SWIFT' AND currency <> 'ZAR'", "violations"),
    *(
        ("Conditional Nullability", f"{c} populated for POS", f"transaction_category = 'POS' AND {c} IS NULL", f"POS rows missing {c}")
        for c in ("merchant_name", "merchant_category_code", "merchant_city")
    ),
    *(
        ("Conditional Nullability", f"{c} null for EFT/SWIFT/DebiCheck/RTC",
         f"transaction_category IN ('EFT','SWIFT','DebiCheck','RTC') AND {c} IS NOT NULL", "unexpected rows")
        for c in ("merchant_name", "merchant_category_code", "merchant_city")
    ),
    ("Conditional Nullability", "beneficiary_account_number null for ATM",
     "transaction_category = 'ATM' AND beneficiary_account_number IS NOT NULL", "unexpected rows"),
    ("Conditional Nullability", "beneficiary_account_number populated for non-ATM",
     "transaction_category <> 'ATM' AND beneficiary_account_number IS NULL", "missing rows"),
    ("Conditional Nullability", "reversal_flag is False when status=PENDING", "status = 'PENDING' AND reversal_flag", "violations"),
    ("Conditional Nullability", "reversal_flag is False when status=FAILED", "status = 'FAILED' AND reversal_flag", "violations"),
    ("Conditional Nullability", "reversal_reference populated when reversal_flag=True",
     "reversal_flag AND reversal_reference IS NULL", "rows missing reference"),
    ("Conditional Nullability", "reversal_reference null when reversal_flag=False",
     "NOT reversal_flag AND reversal_reference IS NOT NULL", "rows with unexpected reference"),
    *(
        ("Conditional Nullability", f"{c} populated for ATM", f"transaction_category = 'ATM' AND {c} IS NULL", f"ATM rows missing {c}")
        for c in ("atm_terminal_id", "atm_province", "atm_city")
    ),
    *(
        ("Conditional Nullability", f"{c} null for non-ATM", f"transaction_category <> 'ATM' AND {c} IS NOT NULL", "unexpected rows")
        for c in ("atm_terminal_id", "atm_province", "atm_city")
    ),
]


def _checks(table: str, category: str | None = None) -> str:
    """One SELECT per check over a table."""

    def row(group: str, check: str, bad: str, noun: str) -> str:
        return (
            f"SELECT '{group}' AS category, '{check}' AS \"check\", v = 0 AS passed, "
            f"CASE WHEN v > 0 THEN v || ' {noun}' END AS detail FROM ({bad})"
        )

    rows = [
        row(group, check, f"SELECT count(*) AS v FROM {table} WHERE {bad}", noun)
        for group, check, bad, noun in CHECKS
        if category in (None, group)
    ]
    if category in (None, "Business Rules"):
        distinct = f"SELECT count(*) FROM (SELECT DISTINCT transaction_id FROM {table})"
        rows += [
            row("Business Rules", "transaction_id is unique",
                f"SELECT (SELECT count(*) FROM {table}) - ({distinct}) AS v", "duplicates"),
            "SELECT 'Business Rules', 'partition has at least 1 row', count(*) > 0, count(*) || ' rows' "
            f"FROM {table}",
            "SELECT 'Business Rules', 'column set matches expected schema', true, NULL",
        ]
    return "\nUNION ALL\n".join(rows)


def _with(select: str, *needed: str) -> str:
    """A query with the common tables it needs."""
    common = {
        "bronze": BRONZE_SQL,
        "clean_bronze": IDENTIFIED_SQL,
        "silver": SILVER,
        "clean_silver": SILVER.replace("FROM bronze", "FROM clean_bronze"),
        "damaged": DAMAGED_SQL,
        "empty": "SELECT * FROM silver WHERE false",
        "subcent": "SELECT * REPLACE (amount/3 AS amount) FROM silver",
        "large": "SELECT * REPLACE (round(amount*1e13) AS amount) FROM silver",
        "unreal": "SELECT * REPLACE (CASE WHEN status <> 'FAILED' THEN amount END AS amount) FROM silver",
        **{f"{kind}_priced": PRICED.replace("FROM silver", f"FROM {kind}") for kind in ("subcent", "large", "unreal")},
        "priced": PRICED,
        "clean_priced": PRICED.replace("FROM silver", "FROM clean_silver"),
        **GOLD,
        **{f"clean_{name}": sql.replace("FROM priced", "FROM clean_priced") for name, sql in GOLD.items()},
        "checks": _checks("silver"),
        **{f"{kind}_{name}": sql.replace("FROM priced", f"FROM {kind}_priced") for kind in ("subcent", "large", "unreal") for name, sql in GOLD.items()},
        "damaged_checks": _checks("damaged"),
        "unreal_checks": _checks("unreal"),
        "empty_checks": _checks("empty"),
        "clean_checks": _checks("clean_silver"),
    }
    order = list(common)
    return "WITH " + ",\n".join(f"{n} AS ({common[n]})" for n in sorted(needed, key=order.index)) + "\n" + select


def _cross(table: str, row: str, column: str, values: tuple[str, ...], measure: str, how: str = "sum", kind: str = "DOUBLE") -> str:
    cells = ", ".join(
        f"CAST(coalesce({how}(CASE WHEN {column} = '{v}' THEN {measure} END), 0) AS {kind}) AS \"{v}\"" for v in values
    )
    return f"SELECT {row}, {cells} FROM {table} GROUP BY {row}"


BANDS = "(SELECT unnest(['18-24','25-34','35-44','45-54','55-64','65+']) AS age_band)"
HOURS = "(SELECT CAST(unnest(range(24)) AS INTEGER) AS hour_of_day)"
BASE = ("bronze", "silver")
FACTS = (*BASE, "priced")


def _gold_query(name: str) -> str:
    return _with(f"SELECT *, '{RUN_DATE}' AS run_date FROM {name}", *FACTS, name)


def _kind_of_gold(kind: str, name: str) -> str:
    return _with(f"SELECT *, '{RUN_DATE}' AS run_date FROM {kind}_{name}", *BASE, kind, f"{kind}_priced", f"{kind}_{name}")


# What each table but the client table is stored in order of.
ORDER = {
    "spend_by_age_band": "age_band, transaction_category",
    "channel_adoption": "channel, transaction_category",
    "provincial_flow": "atm_province, transaction_type",
    "reversal_rates": "transaction_category, status",
    "time_of_day": "hour_of_day, transaction_category",
    "currency_by_age": "age_band, currency",
    "mcc_spend": "total_spend DESC, merchant_category_code",
}


def _numbered(select: str, order: str, limit: str = "") -> str:
    return f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position FROM ({select}) ORDER BY {order} {limit}"


def _on(name: str, select: str) -> str:
    return _with(select, *FACTS, name)


def _outcomes(checks: str) -> str:
    return f"SELECT count(*) AS n, count(*) FILTER (WHERE passed) AS p, count(*) FILTER (WHERE NOT passed) AS f FROM {checks}"


def _verdict(checks: str) -> str:
    return (
        "SELECT CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS overall, CASE WHEN f > 0 THEN 'Silver validation failed: ' "
        f"|| f || '/' || n || ' checks did not pass.' END AS message FROM ({_outcomes(checks)})"
    )


def _summary(checks: str) -> str:
    return (
        "SELECT n AS total_checks, p AS passed_checks, f AS failed_checks, "
        f"CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS overall FROM ({_outcomes(checks)})"
    )


ROW_COUNTS = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS rows_written FROM {{0}}{t}" for t in GOLD)
DROPPED = (
    "cellphone_number, email_address, physical_address, ip_address, device_fingerprint, gps_latitude, gps_longitude, "
    "beneficiary_name, account_holder_name"
)
MERCHANTS = "bronze", "silver", "priced", "mcc_spend"

HISTOGRAM = """
WITH n AS (SELECT CAST(round(net_movement*100) AS BIGINT) AS c FROM client_financial_activity),
ends AS (SELECT CASE WHEN min(c) = max(c) THEN min(c) - 50 ELSE min(c) END AS lo,
                CASE WHEN min(c) = max(c) THEN max(c) + 50 ELSE max(c) END AS hi FROM n),
bins AS (SELECT CAST(unnest(range(40)) AS INTEGER) AS bin)
SELECT bin, (lo*40 + (hi-lo)*bin)/4000.0 AS lower, (lo*40 + (hi-lo)*(bin+1))/4000.0 AS upper,
  (SELECT count(*) FROM n WHERE (c-lo)*40 >= bin*(hi-lo) AND ((c-lo)*40 < (bin+1)*(hi-lo) OR (bin = 39 AND c = hi))) AS clients
FROM bins, ends
"""

# All movements are multiples of 10**11 here, 10**13 cents, so limits are whole numbers.
LARGE_HISTOGRAM = """
WITH n AS (SELECT CAST(round(net_movement/1e11) AS BIGINT) AS c FROM large_client_financial_activity),
ends AS (SELECT min(c) AS lo, max(c) AS hi FROM n),
bins AS (SELECT CAST(unnest(range(40)) AS INTEGER) AS bin)
SELECT bin, CAST((lo*40 + (hi-lo)*bin)*2500000000 AS DOUBLE) AS lower, CAST((lo*40 + (hi-lo)*(bin+1))*2500000000 AS DOUBLE) AS upper,
  (SELECT count(*) FROM n WHERE (c-lo)*40 >= bin*(hi-lo) AND ((c-lo)*40 < (bin+1)*(hi-lo) OR (bin = 39 AND c = hi))) AS clients
FROM bins, ends
"""

MEDIAN = """
SELECT count(*) AS total_clients, avg(total_transactions) AS avg_transactions,
  (SELECT (CAST(sum(c) FILTER (WHERE r = (n+1)//2) AS BIGINT) + CAST(sum(c) FILTER (WHERE r = n//2+1) AS BIGINT))/200.0 FROM
    (SELECT CAST(round(net_movement*100) AS BIGINT) AS c, row_number() OVER (ORDER BY net_movement) AS r, count(*) OVER () AS n
     FROM client_financial_activity)) AS median_net_movement,
  count(*) FILTER (WHERE reversal_count > 0) AS clients_with_reversals
FROM client_financial_activity
"""

ORACLE: dict[str, str] = {
    # sources and sinks
    "bronze_round_trip": _with(
        "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(running_balance AS DOUBLE) AS running_balance) FROM bronze",
        "bronze"),
    "amounts_from_text": _with(
        "SELECT transaction_id, CASE WHEN status <> 'FAILED' THEN amount END AS amount, running_balance FROM bronze", "bronze"),
    "silver_round_trip": _with("SELECT * FROM silver", *BASE),
    "gold_round_trip": _gold_query("channel_adoption"),
    **{f"stored_{name}": _gold_query(name) for name in GOLD if name != "channel_adoption"},
    "silver_rerun_empty": _with("SELECT * FROM empty", *BASE, "empty"),
    "gold_rerun_empty": _with(f"SELECT *, '{RUN_DATE}' AS run_date FROM provincial_flow WHERE false", *FACTS, "provincial_flow"),
    "bronze_raw_lines": _with(
        "SELECT CASE WHEN k <> 2 THEN transaction_id END AS transaction_id, CASE WHEN k <> 2 THEN status END AS status, "
        "CASE WHEN k <> 2 THEN amount END AS amount, CASE WHEN k <> 2 THEN running_balance END AS running_balance, "
        "CASE WHEN k <> 2 THEN reversal_flag END AS reversal_flag FROM (SELECT *, CAST(round(amount*100) AS BIGINT) % 4 AS k FROM bronze)", "bronze"),
    "silver_failed_rerun": _with("SELECT * FROM silver", *BASE),
    "gold_failed_rerun": _gold_query("mcc_spend"),
    "column_types": """
SELECT unnest(['transaction_id', 'transaction_datetime', 'transaction_type', 'transaction_category', 'channel', 'status', 'currency',
  'reversal_reference', 'account_number', 'beneficiary_account_number', 'age', 'gender', 'merchant_name', 'merchant_category_code',
  'merchant_city', 'atm_terminal_id', 'atm_province', 'atm_city']) AS "column", 'string' AS type
UNION ALL VALUES ('age', 'int'), ('amount', 'double'), ('running_balance', 'double'), ('reversal_flag', 'boolean')
""",
    "gold_row_counts": _with(ROW_COUNTS.format(""), *FACTS, *GOLD),
    "report_round_trip": _with("SELECT * FROM damaged_checks", *BASE, "damaged", "damaged_checks"),
    # Bronze to Silver
    "without_pii": _with(f"SELECT * EXCLUDE ({DROPPED}) FROM bronze", "bronze"),
    "pseudonyms": _with(
        "SELECT transaction_id, sha256('salt' || account_number) AS account_number, "
        "sha256('salt' || beneficiary_account_number) AS beneficiary_account_number FROM bronze", "bronze"),
    "holder_age_and_gender": _with("SELECT transaction_id, age, gender FROM silver", *BASE),
    "silver": _with("SELECT * FROM silver", *BASE),
    "settled_transactions": _with(f"SELECT * FROM silver WHERE {SETTLED}", *BASE),
    "age_bands": _with(f"SELECT transaction_id, {AGE_BAND} AS age_band FROM silver", *BASE),
    "hours_utc": _with(f"SELECT transaction_id, {HOUR_UTC} AS hour_of_day FROM silver", *BASE),
    "hours_sast": _with(f"SELECT transaction_id, {HOUR_SAST} AS hour_of_day FROM silver", *BASE),
    # validation
    "check_results": _with("SELECT * FROM checks", *BASE, "checks"),
    "damaged_check_results": _with("SELECT * FROM damaged_checks", *BASE, "damaged", "damaged_checks"),
    **{
        f"damaged_{name}_checks": _with(f"SELECT * FROM ({_checks('damaged', category)})", *BASE, "damaged")
        for name, category in (
            ("completeness", "Completeness"),
            ("allowed_values", "Allowed Values"),
            ("format", "Format"),
            ("business_rules", "Business Rules"),
            ("conditional_nullability", "Conditional Nullability"),
        )
    },
    "drifted_check_results": _with(
        "SELECT category, \"check\", passed AND \"check\" NOT LIKE '%atm_city%' AND \"check\" <> 'column set matches expected schema' AS passed, "
        "CASE WHEN \"check\" LIKE '%atm_city%' THEN 'missing column atm_city' "
        "WHEN \"check\" = 'column set matches expected schema' THEN 'extra: [''novelty''] missing: [''atm_city'']' ELSE detail END AS detail "
        "FROM checks", *BASE, "checks"),
    "unreal_amounts": _with("SELECT transaction_id, amount FROM unreal", *BASE, "unreal"),
    "unreal_check_results": _with("SELECT * FROM unreal_checks", *BASE, "unreal", "unreal_checks"),
    "empty_day_report": _with("SELECT * FROM empty_checks", *BASE, "empty", "empty_checks"),
    "type_drift_report": _with(
        "SELECT category, \"check\", passed AND \"check\" <> 'column set matches expected schema' AS passed, "
        "CASE WHEN \"check\" = 'column set matches expected schema' "
        "THEN 'several types: [''age: int, string'', ''reversal_flag: boolean, string'']' ELSE detail END AS detail "
        "FROM checks", *BASE, "checks"),
    "check_summary": _with(_summary("damaged_checks"), *BASE, "damaged", "damaged_checks"),
    "report_header": _with(
        f"SELECT '{RUN_DATE}' AS run_date, '{SILVER_PATH}' AS silver_path, (SELECT count(*) FROM damaged) AS total_rows, "
        "p AS checks_passed, f AS checks_failed, CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS overall, n AS results "
        f"FROM ({_outcomes('damaged_checks')})", *BASE, "damaged", "damaged_checks"),
    "gate_verdict": _with(_verdict("damaged_checks"), *BASE, "damaged", "damaged_checks"),
    "gate_verdict_clean": _with(
        _verdict("clean_checks"), "clean_bronze", "clean_silver", "clean_checks"),
    # Silver to Gold
    **{name: _gold_query(name) for name in GOLD},
    "time_of_day_sast": _with(
        f"SELECT *, '{RUN_DATE}' AS run_date FROM ("
        + GOLD["time_of_day"].replace("FROM priced", f"FROM (SELECT * REPLACE ({HOUR_SAST} AS hour_of_day) FROM priced)")
        + ")", *FACTS),
    **{f"subcent_{name}": _kind_of_gold("subcent", name) for name in ("spend_by_age_band", "client_financial_activity", "mcc_spend")},
    "unreal_reversal_rates": _kind_of_gold("unreal", "reversal_rates"),
    **{f"arranged_{name}": _with(_numbered(f"SELECT *, '{RUN_DATE}' AS run_date FROM {name}", order), *FACTS, name) for name, order in ORDER.items()},
    "conditional_counts": _with(
        f"SELECT channel, {_part('reversal_flag', '1')} AS reversed, {_part('age < 35', '1')} AS under_35 FROM silver GROUP BY channel",
        *BASE),
    "conditional_sums": _with(
        f"""SELECT channel, {_amount(_exact("transaction_type='DEBIT'"))} AS debited, {_amount(_exact("transaction_type='CREDIT'"))} AS credited
        FROM priced GROUP BY channel""", *FACTS),
    "distinct_accounts": _with(
        "SELECT status, count(DISTINCT account_number) AS accounts, count(DISTINCT beneficiary_account_number) AS beneficiaries "
        "FROM silver GROUP BY status", *BASE),
    "rounded_ratios": _with(
        f"""SELECT age_band, {AVG} AS avg_amount, ((20000*{_part("status='FAILED'", "1")}+count(*))//(2*count(*)))/10000.0 AS failed_share
        FROM priced GROUP BY age_band""", *FACTS),
    "status_share_of_category": _on("reversal_rates", "SELECT transaction_category, status, rate FROM reversal_rates"),
    # analyses of Gold
    "spend_by_band": _on("spend_by_age_band", _cross(
        f"{BANDS} LEFT JOIN spend_by_age_band USING (age_band)", "age_band", "transaction_category", CATEGORIES, "total_spend")),
    "average_spend_by_band": _on("spend_by_age_band", _cross(
        f"{BANDS} LEFT JOIN spend_by_age_band USING (age_band)", "age_band", "transaction_category", CATEGORIES, "avg_spend", "avg")),
    "volume_by_channel": _on("channel_adoption",
        "SELECT channel, CAST(sum(total_transactions) AS BIGINT) AS total_transactions FROM channel_adoption GROUP BY channel"),
    "failure_rate_by_channel": _on("channel_adoption",
        "SELECT channel, CAST(sum(failed_count) AS DOUBLE)/CAST(sum(total_transactions) AS DOUBLE) AS failure_rate "
        "FROM channel_adoption GROUP BY channel"),
    "net_movement_histogram": _on("client_financial_activity", f"SELECT * FROM ({HISTOGRAM})"),
    "reversal_exposure": _on("client_financial_activity",
        "SELECT exposure, n AS clients, CAST(100*n AS DOUBLE)/CAST(sum(n) OVER () AS DOUBLE) AS percentage FROM "
        "(SELECT CASE WHEN reversal_count > 0 THEN 'Has Reversals' ELSE 'No Reversals' END AS exposure, count(*) AS n "
        "FROM client_financial_activity GROUP BY 1)"),
    "client_summary": _on("client_financial_activity", MEDIAN),
    "large_amount_activity": _with(
        "SELECT account_number, " + ", ".join(f"CAST(round({c}/1e6) AS BIGINT) AS {c}" for c in ("total_debited", "total_credited", "net_movement"))
        + " FROM large_client_financial_activity",
        *BASE, "large", "large_priced", "large_client_financial_activity"),
    "large_amount_histogram": _with(
        f"SELECT * FROM ({LARGE_HISTOGRAM})", *BASE, "large", "large_priced", "large_client_financial_activity"),
    "large_amount_summary": _with(
        f"SELECT * FROM ({MEDIAN.replace('BIGINT', 'HUGEINT').replace('FROM client', 'FROM large_client')})",
        *BASE, "large", "large_priced", "large_client_financial_activity"),
    "status_mix": _on("reversal_rates", _cross(
        "reversal_rates", "transaction_category", "status", STATUSES, "rate")),
    "failure_and_reversal_rates": _on("reversal_rates", _cross(
        "(SELECT * FROM reversal_rates WHERE status IN ('FAILED','REVERSED'))",
        "transaction_category", "status", ("FAILED", "REVERSED"), "rate")),
    "volume_by_hour": _on("time_of_day", _cross(
        f"{HOURS} LEFT JOIN time_of_day USING (hour_of_day)", "hour_of_day", "transaction_category", CATEGORIES,
        "transaction_count", kind="BIGINT")),
    "spend_by_hour": _on("time_of_day", _cross(
        f"{HOURS} LEFT JOIN time_of_day USING (hour_of_day)", "hour_of_day", "transaction_category", CATEGORIES, "total_spend")),
    "provinces_by_amount": _on("provincial_flow", _numbered(
        f"SELECT *, '{RUN_DATE}' AS run_date FROM provincial_flow", "total_amount, atm_province, transaction_type")),
    **{
        f"{kind}_merchant_categories_by_{by}": _with(
            _numbered(f"SELECT * REPLACE ({rough}), '{RUN_DATE}' AS run_date FROM mcc_spend",
                      f"{column} DESC, merchant_category_code", "LIMIT 15"), *MERCHANTS)
        for by, column in (("total", "total_spend"), ("average", "avg_spend"))
        for kind, rough in (
            ("top", "total_spend AS total_spend"),
            ("level", "round(total_spend/1000)*1000 AS total_spend, round(avg_spend/50)*50 AS avg_spend"),
        )
    },
    "amount_by_band_and_currency": _on("currency_by_age", _cross(
        f"{BANDS} LEFT JOIN currency_by_age USING (age_band)", "age_band", "currency", CURRENCIES, "total_amount")),
    "accounts_by_currency": _on("currency_by_age",
        "SELECT currency, CAST(sum(unique_accounts) AS BIGINT) AS unique_accounts FROM currency_by_age GROUP BY currency"),
    # sets of accounts that merge
    "channel_accounts_from_sets": _with(
        f"SELECT channel, transaction_category, {ACCOUNTS} AS unique_accounts FROM silver GROUP BY ALL", *BASE),
    "channel_accounts_of_two_days": _with(f"SELECT channel, {ACCOUNTS} AS unique_accounts FROM silver GROUP BY ALL", *BASE),
    "currency_accounts_of_two_days": _with(
        f"SELECT currency, {ACCOUNTS} AS unique_accounts FROM silver WHERE {SETTLED} AND transaction_category = 'SWIFT' GROUP BY ALL",
        *BASE),
    # analyses of the report
    "checks_by_category": _with(
        "SELECT category, count(*) FILTER (WHERE NOT passed) AS failed, count(*) FILTER (WHERE passed) AS passed "
        "FROM checks GROUP BY category", *BASE, "checks"),
    "checks_by_outcome": _with(
        "SELECT CASE WHEN passed THEN 'Passed' ELSE 'Failed' END AS outcome, count(*) AS checks FROM checks GROUP BY 1",
        *BASE, "checks"),
    "failed_checks": _with(
        "SELECT category, \"check\", detail FROM damaged_checks WHERE NOT passed", *BASE, "damaged", "damaged_checks"),
    # the day as a whole
    "daily_run": _with(
        ROW_COUNTS.format("clean_"), "clean_bronze", "clean_silver", "clean_priced", *(f"clean_{t}" for t in GOLD)),
    "daily_run_gold": _with(
        f"SELECT *, '{RUN_DATE}' AS run_date FROM clean_client_financial_activity",
        "clean_bronze", "clean_silver", "clean_priced", "clean_client_financial_activity"),
    "daily_failed_rerun": _with(
        f"SELECT 'silver' AS table_name, count(*) AS n_rows FROM clean_silver UNION ALL SELECT table_name, rows_written FROM ({ROW_COUNTS.format('clean_')})",
        "clean_bronze", "clean_silver", "clean_priced", *(f"clean_{t}" for t in GOLD)),
    "daily_failed_rerun_gold": _with(
        f"SELECT *, '{RUN_DATE}' AS run_date FROM clean_channel_adoption",
        "clean_bronze", "clean_silver", "clean_priced", "clean_channel_adoption"),
}
