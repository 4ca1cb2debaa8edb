"""Bronze-shaped transactions derived from the ``events`` table.

For tests, benchmarks and checked queries.  The text is valid in Spark SQL and in
DuckDB, so both engines start from the same rows.  Every event is one
transaction.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = date(2026, 3, 30)
SALT = "salt"

# Stages are nested, not WITH clauses: Spark 4.1 inlines a WITH clause that a query
# reads twice, and mixes up its columns when scalar subqueries are involved.
_NUMBERS = """
SELECT event_id, user_id, value, ts,
   (event_id*7919 + user_id*31) % 89 AS m1, (event_id*104729 + 17) % 97 AS m2, (event_id*15485863 + 3) % 101 AS m3,
   ((event_id % 9973)*3571 + user_id) % 103 AS m4, user_id % 37 AS u FROM events
"""
# Every channel, status, and category that a channel allows is equally frequent.
_CHANNELS = f"""
SELECT *, CASE m1 % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'INTERNET' WHEN 2 THEN 'BRANCH' ELSE 'ATM' END AS channel,
   CASE WHEN m4 % 8 < 5 THEN 'SETTLED' WHEN m4 % 8 = 5 THEN 'PENDING' WHEN m4 % 8 = 6 THEN 'REVERSED' ELSE 'FAILED' END AS status
FROM ({_NUMBERS}) e0
"""
_CATEGORIES = f"""
SELECT *, CASE
   WHEN channel='MOBILE' THEN CASE m2 % 4 WHEN 0 THEN 'POS' WHEN 1 THEN 'EFT' WHEN 2 THEN 'DebiCheck' ELSE 'RTC' END
   WHEN channel='INTERNET' THEN CASE m2 % 5 WHEN 0 THEN 'POS' WHEN 1 THEN 'EFT' WHEN 2 THEN 'SWIFT' WHEN 3 THEN 'DebiCheck' ELSE 'RTC' END
   WHEN channel='BRANCH' THEN CASE m2 % 6 WHEN 0 THEN 'POS' WHEN 1 THEN 'EFT' WHEN 2 THEN 'SWIFT' WHEN 3 THEN 'DebiCheck' WHEN 4 THEN 'RTC' ELSE 'ATM' END
   ELSE 'ATM' END AS transaction_category, (status='REVERSED' OR (status='SETTLED' AND m3 % 10 = 0)) AS reversal_flag FROM ({_CHANNELS}) e1
"""
_TYPES = f"""
SELECT *, CASE WHEN transaction_category='ATM' OR m3 % 3 > 0 THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type,
   CAST(year(ts)*10000+month(ts)*100+day(ts) AS STRING) AS ymd FROM ({_CATEGORIES}) e2
"""
BRONZE_SQL = f"""
SELECT concat('TXN-', ymd, '-', lpad(hex(event_id),12,'0')) AS transaction_id,
  concat(CAST(date_trunc('second', ts) AS STRING), '+02:00') AS transaction_datetime,
  transaction_type, transaction_category, channel, status, value AS amount,
  CASE WHEN transaction_category<>'SWIFT' THEN 'ZAR' WHEN event_id % 7 = 1 THEN 'USD' WHEN event_id % 7 = 2 THEN 'EUR' WHEN event_id % 7 = 3 THEN 'GBP' WHEN event_id % 7 = 4 THEN 'CHF' WHEN event_id % 7 = 5 THEN 'JPY' WHEN event_id % 7 = 6 THEN 'AUD' ELSE 'ZAR' END AS currency,
  CASE WHEN transaction_type='DEBIT' THEN 5000-value ELSE 5000+value END AS running_balance, reversal_flag,
  CASE WHEN reversal_flag THEN concat('TXN-', ymd, '-', lpad(hex(event_id+1),12,'0')) END AS reversal_reference,
  CAST(1000000000+user_id AS STRING) AS account_number,
  CASE WHEN transaction_category<>'ATM' THEN CAST(2000000000+(event_id*7)%997 AS STRING) END AS beneficiary_account_number,
  CASE WHEN u=5 THEN NULL WHEN u=6 THEN '12345' WHEN u=7 THEN '8013015009087' ELSE
    concat(lpad(CAST((46+user_id%60)%100 AS STRING),2,'0'), lpad(CAST(1+user_id%12 AS STRING),2,'0'), lpad(CAST(1+user_id%28 AS STRING),2,'0'), lpad(CAST((user_id*577)%10000 AS STRING),4,'0'), '008') END AS id_number,
  concat('Holder ', CAST(user_id AS STRING)) AS account_holder_name,
  CASE WHEN transaction_category<>'ATM' THEN concat('Payee ', CAST(event_id%997 AS STRING)) END AS beneficiary_name,
  concat('+2782', lpad(CAST(user_id AS STRING),7,'0')) AS cellphone_number, concat('u', CAST(user_id AS STRING), '@example.com') AS email_address,
  concat(CAST(user_id AS STRING), ' Main Rd') AS physical_address, CAST(100000+user_id%7 AS STRING) AS branch_code,
  CASE WHEN channel IN ('MOBILE','INTERNET') THEN concat('41.0.0.', CAST(1+user_id%254 AS STRING)) END AS ip_address,
  CASE WHEN channel IN ('MOBILE','INTERNET') THEN lpad(hex(event_id),32,'0') END AS device_fingerprint,
  CASE WHEN channel IN ('MOBILE','INTERNET') THEN CAST(-34 AS DOUBLE) + CAST(user_id%12 AS DOUBLE) END AS gps_latitude,
  CASE WHEN channel IN ('MOBILE','INTERNET') THEN CAST(17 AS DOUBLE) + CAST(user_id%15 AS DOUBLE) END AS gps_longitude,
  CASE WHEN transaction_category='POS' THEN concat('Shop ', CAST(event_id%37 AS STRING)) END AS merchant_name,
  CASE WHEN transaction_category='POS' THEN concat('Town ', CAST(event_id%6 AS STRING)) END AS merchant_city,
  CASE WHEN transaction_category='ATM' THEN concat('ATM-GP-', lpad(CAST(event_id%9999 AS STRING),5,'0')) END AS atm_terminal_id,
  CASE WHEN transaction_category='ATM' THEN concat('City ', CAST(event_id%11 AS STRING)) END AS atm_city,
  CASE WHEN transaction_category='POS' THEN concat('MCC ', CAST(5411+(event_id%41)*7 AS STRING)) END AS merchant_category_code,
  CASE WHEN transaction_category='ATM' THEN CASE WHEN event_id%9<4 THEN 'Gauteng' WHEN event_id%9<6 THEN 'Western Cape' ELSE 'KwaZulu-Natal' END END AS atm_province
FROM ({_TYPES}) e3
"""

# Some holders' ID numbers are absent, short or have month 13: no age, no gender.
# The same rows with every holder's number in order pass all checks.
_UNIDENTIFIED = "WHEN u=5 THEN NULL WHEN u=6 THEN '12345' WHEN u=7 THEN '8013015009087' ELSE"
IDENTIFIED_SQL = BRONZE_SQL.replace(_UNIDENTIFIED, "WHEN true THEN")


def _of_events(spark: SparkSession, sf_dir: str, sql: str, spread: bool = False) -> DataFrame:
    """Bronze rows of all events, by tasks of their own if ``spread``.

    A transaction is some fifty times the size of its event, and an event's work is
    its transaction: the table's files, made for a scan, would be too few tasks for it.
    So the events are spread by their unique key, before they become wide.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if spread:
        events = events.repartition("event_id")
    return spark.sql(sql.replace("FROM events", "FROM {events}"), events=events)


def bronze(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The whole ``events`` table as Bronze rows."""
    return _of_events(spark, sf_dir, BRONZE_SQL, spread)


def identified_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``events`` table as Bronze rows of holders with valid ID numbers, spread: they are stored as raw files."""
    return _of_events(spark, sf_dir, IDENTIFIED_SQL, spread=True)


def salt(spark: SparkSession) -> DataFrame:
    """One-row salt frame that keeps the value out of plans."""
    return spark.createDataFrame([(SALT,)], "salt string")


# Silver with rows damaged so that every row rule and uniqueness fail: one kind of
# damage per value of k, all rows kept.
DAMAGED_SQL = """
SELECT
  CASE WHEN k=0 THEN NULL WHEN k=19 THEN lower(transaction_id) WHEN k=23 THEN 'TXN-20240101-000000000001' ELSE transaction_id END AS transaction_id,
  CASE WHEN k=1 THEN NULL ELSE transaction_datetime END AS transaction_datetime,
  CASE WHEN k=2 THEN NULL WHEN k=13 THEN '??' WHEN k=26 THEN 'CREDIT' ELSE transaction_type END AS transaction_type,
  CASE WHEN k=3 THEN NULL WHEN k=14 THEN '??' ELSE transaction_category END AS transaction_category,
  CASE WHEN k=4 THEN NULL WHEN k=15 THEN '??' ELSE channel END AS channel,
  CASE WHEN k=5 THEN NULL WHEN k=16 THEN '??' WHEN k=32 THEN 'PENDING' WHEN k=33 THEN 'FAILED' ELSE status END AS status,
  CASE WHEN k=6 THEN NULL WHEN k=24 THEN -amount ELSE amount END AS amount,
  CASE WHEN k=7 THEN NULL WHEN k=17 THEN '??' WHEN k=27 THEN 'USD' ELSE currency END AS currency,
  CASE WHEN k=8 THEN NULL WHEN k=25 THEN -running_balance ELSE running_balance END AS running_balance,
  CASE WHEN k=9 THEN NULL WHEN k IN (32,33) THEN true ELSE reversal_flag END AS reversal_flag,
  CASE WHEN k<>34 THEN reversal_reference WHEN reversal_flag THEN NULL ELSE transaction_id END AS reversal_reference,
  CASE WHEN k=10 THEN NULL WHEN k=20 THEN substr(account_number,1,63) ELSE account_number END AS account_number,
  CASE WHEN k=21 THEN substr(beneficiary_account_number,1,63) WHEN k<>31 THEN beneficiary_account_number WHEN transaction_category='ATM' THEN account_number END AS beneficiary_account_number,
  CASE WHEN k=11 THEN NULL WHEN k=22 THEN 17 ELSE age END AS age,
  CASE WHEN k=12 THEN NULL WHEN k=18 THEN '??' ELSE gender END AS gender,
  CASE WHEN k<>28 THEN merchant_name WHEN transaction_category<>'POS' THEN 'Shop' END AS merchant_name,
  CASE WHEN k<>29 THEN merchant_category_code WHEN transaction_category<>'POS' THEN 'MCC 0' END AS merchant_category_code,
  CASE WHEN k<>30 THEN merchant_city WHEN transaction_category<>'POS' THEN 'Town' END AS merchant_city,
  CASE WHEN k<>35 THEN atm_terminal_id WHEN transaction_category<>'ATM' THEN 'ATM-0' END AS atm_terminal_id,
  CASE WHEN k<>36 THEN atm_province WHEN transaction_category<>'ATM' THEN 'Gauteng' END AS atm_province,
  CASE WHEN k<>37 THEN atm_city WHEN transaction_category<>'ATM' THEN 'City' END AS atm_city
FROM (SELECT *, CAST(round(amount*100) AS BIGINT) % 97 AS k FROM silver) keyed
"""


def damaged(silver: DataFrame) -> DataFrame:
    """Silver rows, some of them violating each rule."""
    return silver.sparkSession.sql(DAMAGED_SQL.replace("FROM silver", "FROM {silver}"), silver=silver)
