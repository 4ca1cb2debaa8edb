"""Fixed values of the transactions domain.

Everything here is a value that results depend on: names, code lists, patterns
and orders that stored tables and reports have to agree with.  No logic.
"""

# --- Fixed values: code lists -------------------------------------------------

TRANSACTION_TYPES = ("DEBIT", "CREDIT")
CATEGORIES = ("ATM", "POS", "EFT", "SWIFT", "DebiCheck", "RTC")
CHANNELS = ("MOBILE", "INTERNET", "BRANCH", "ATM")
STATUSES = ("SETTLED", "PENDING", "REVERSED", "FAILED")
CURRENCIES = ("ZAR", "USD", "EUR", "GBP", "CHF", "JPY", "AUD")
GENDERS = ("M", "F")
AGE_BANDS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")

# --- Fixed values: age bands, as exclusive upper bounds -----------------------
# Ages at or past the last bound, and unknown ages, are in the last band.

AGE_BAND_BOUNDS = (25, 35, 45, 55, 65)

# --- Fixed values: national identity number -----------------------------------

ID_LENGTH = 13
ID_CENTURY_PIVOT = 25  # two-digit years from here on are 19yy, below are 20yy
ID_MALE_FROM = 5000  # digits 7 to 10

# --- Fixed values: personal data ----------------------------------------------

DROPPED_PII = (
    "cellphone_number",
    "email_address",
    "physical_address",
    "ip_address",
    "device_fingerprint",
    "gps_latitude",
    "gps_longitude",
    "beneficiary_name",
    "account_holder_name",
)
PSEUDONYMISED = ("account_number", "beneficiary_account_number")
SPENT_AFTER_DERIVATION = ("id_number", "branch_code")

# --- Fixed values: validation -------------------------------------------------

REQUIRED_COLUMNS = (
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
    "account_number",
    "age",
    "gender",
)
ALLOWED_VALUES = {
    "transaction_type": TRANSACTION_TYPES,
    "transaction_category": CATEGORIES,
    "channel": CHANNELS,
    "status": STATUSES,
    "currency": CURRENCIES,
    "gender": GENDERS,
}
TRANSACTION_ID_PATTERN = "^TXN-[0-9]{8}-[0-9A-F]{12}$"
SHA256_PATTERN = "^[0-9a-f]{64}$"
ADULT_AGE = 18
HOME_CURRENCY = "ZAR"
MERCHANT_COLUMNS = ("merchant_name", "merchant_category_code", "merchant_city")
TERMINAL_COLUMNS = ("atm_terminal_id", "atm_province", "atm_city")
MERCHANTLESS_CATEGORIES = ("EFT", "SWIFT", "DebiCheck", "RTC")
NEVER_REVERSED_STATUSES = ("PENDING", "FAILED")

# --- Fixed values: storage layout ---------------------------------------------

SILVER_TABLE = "transactions"
GOLD_FOLDER = "aggregations"
REPORT_FOLDER = "validation-reports"
REPORT_NAME = "silver_validation.json"

# --- Fixed values: analyses ---------------------------------------------------

HISTOGRAM_BINS = 40
TOP_MERCHANT_CATEGORIES = 15
HAS_REVERSALS = "Has Reversals"
NO_REVERSALS = "No Reversals"
SAST = "Africa/Johannesburg"
