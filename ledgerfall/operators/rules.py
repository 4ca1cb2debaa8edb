"""The 48 data quality rules of Silver, as data.

A row rule is a category, a name, a SQL condition that holds for violating rows,
and the words that follow the number of violations.  A condition that is unknown
for a row (a null operand) does not count as a violation, so each missing value
is reported once, by completeness.
"""

from collections.abc import Iterator
from dataclasses import dataclass

from ledgerfall import vocabulary as V


@dataclass(frozen=True)
class RowRule:
    """Passes when no row meets the condition."""

    category: str
    check: str
    columns: tuple[str, ...]
    violated_when: str
    noun: str


@dataclass(frozen=True)
class SchemaRule:
    """Passes when the columns are the expected ones."""

    category: str
    check: str


@dataclass(frozen=True)
class UniqueRule:
    """Passes when no value of the column occurs twice; null is one value."""

    category: str
    check: str
    column: str
    noun: str


@dataclass(frozen=True)
class NotEmptyRule:
    """Passes when there are rows; always says how many."""

    category: str
    check: str


Rule = RowRule | SchemaRule | UniqueRule | NotEmptyRule

# --- Fixed values: categories of checks ---------------------------------------

COMPLETENESS = "Completeness"
ALLOWED_VALUES = "Allowed Values"
FORMAT = "Format"
BUSINESS_RULES = "Business Rules"
CONDITIONAL_NULLABILITY = "Conditional Nullability"
CATEGORIES = (COMPLETENESS, ALLOWED_VALUES, FORMAT, BUSINESS_RULES, CONDITIONAL_NULLABILITY)

# --- Fixed values: names of checks and what follows the number of violations, as
# stored reports have them; they stand in the rules below.


def _any_of(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _completeness() -> Iterator[Rule]:
    for c in V.REQUIRED_COLUMNS:
        yield RowRule(COMPLETENESS, f"{c} is never null", (c,), f"{c} IS NULL", "null rows")


def _allowed_values() -> Iterator[Rule]:
    for c, values in V.ALLOWED_VALUES.items():
        yield RowRule(
            ALLOWED_VALUES, f"{c} within allowed set", (c,), f"{c} NOT IN {_any_of(values)}", "unexpected values"
        )


def _not_sha256(column: str) -> str:
    """Not 64 lower-case hexadecimal digits.

    Decoding is several times faster than the pattern and settles every
    well-formed value; only what is left is matched against the pattern.
    """
    decodes = f"length({column}) = 64 AND coalesce(length(unhex({column})), 0) = 32 AND lower({column}) = {column}"
    return f"NOT ({decodes}) AND NOT {column} RLIKE '{V.SHA256_PATTERN}'"


def _format() -> Iterator[Rule]:
    yield RowRule(
        FORMAT,
        "transaction_id matches TXN-YYYYMMDD-<HEX12>",
        ("transaction_id",),
        f"NOT transaction_id RLIKE '{V.TRANSACTION_ID_PATTERN}'",
        "malformed IDs",
    )
    for c, when in (("account_number", ""), ("beneficiary_account_number", " when not null")):
        yield RowRule(FORMAT, f"{c} is SHA-256 hex{when}", (c,), _not_sha256(c), "malformed values")
    yield RowRule(FORMAT, f"age >= {V.ADULT_AGE}", ("age",), f"age < {V.ADULT_AGE}", "underage rows")


def _business_rules() -> Iterator[Rule]:
    yield SchemaRule(BUSINESS_RULES, "column set matches expected schema")
    yield UniqueRule(BUSINESS_RULES, "transaction_id is unique", "transaction_id", "duplicates")
    for c in ("amount", "running_balance"):
        yield RowRule(BUSINESS_RULES, f"{c} >= 0", (c,), f"{c} < 0", "negative rows")
    yield NotEmptyRule(BUSINESS_RULES, "partition has at least 1 row")
    yield RowRule(
        BUSINESS_RULES,
        "ATM transactions are always DEBIT",
        ("transaction_category", "transaction_type"),
        "transaction_category = 'ATM' AND transaction_type = 'CREDIT'",
        "ATM CREDIT rows",
    )
    yield RowRule(
        BUSINESS_RULES,
        f"non-SWIFT transactions use {V.HOME_CURRENCY}",
        ("transaction_category", "currency"),
        f"transaction_category <> 'SWIFT' AND currency <> '{V.HOME_CURRENCY}'",
        "violations",
    )


def _present_or_absent(column: str, present: tuple[str, str, str], absent: tuple[str, str, str]) -> Iterator[Rule]:
    """A column that must have a value in one scope and none in another.

    Each scope is (condition, name, noun).
    """
    for (scope, name, noun), state, violation in ((present, "populated", "IS NULL"), (absent, "null", "IS NOT NULL")):
        yield RowRule(
            CONDITIONAL_NULLABILITY,
            f"{column} {state} {name}",
            ("transaction_category", column),
            f"{scope} AND {column} {violation}",
            noun,
        )


def _conditional_nullability() -> Iterator[Rule]:
    atm, not_atm = "transaction_category = 'ATM'", "transaction_category <> 'ATM'"
    merchantless = f"transaction_category IN {_any_of(V.MERCHANTLESS_CATEGORIES)}"
    for c in V.MERCHANT_COLUMNS:
        yield from _present_or_absent(
            c,
            ("transaction_category = 'POS'", "for POS", f"POS rows missing {c}"),
            (merchantless, "for " + "/".join(V.MERCHANTLESS_CATEGORIES), "unexpected rows"),
        )
    populated, absent = _present_or_absent(
        "beneficiary_account_number",
        (not_atm, "for non-ATM", "missing rows"),
        (atm, "for ATM", "unexpected rows"),
    )
    yield absent
    yield populated
    for status in V.NEVER_REVERSED_STATUSES:
        yield RowRule(
            CONDITIONAL_NULLABILITY,
            f"reversal_flag is False when status={status}",
            ("status", "reversal_flag"),
            f"status = '{status}' AND reversal_flag",
            "violations",
        )
    for check, flag, violation, noun in (
        ("reversal_reference populated when reversal_flag=True", "reversal_flag", "IS NULL", "rows missing reference"),
        (
            "reversal_reference null when reversal_flag=False",
            "NOT reversal_flag",
            "IS NOT NULL",
            "rows with unexpected reference",
        ),
    ):
        yield RowRule(
            CONDITIONAL_NULLABILITY,
            check,
            ("reversal_flag", "reversal_reference"),
            f"{flag} AND reversal_reference {violation}",
            noun,
        )
    for c in V.TERMINAL_COLUMNS:
        yield from _present_or_absent(
            c, (atm, "for ATM", f"ATM rows missing {c}"), (not_atm, "for non-ATM", "unexpected rows")
        )


ALL: tuple[Rule, ...] = (
    *_completeness(),
    *_allowed_values(),
    *_format(),
    *_business_rules(),
    *_conditional_nullability(),
)


def of_category(category: str) -> tuple[Rule, ...]:
    return tuple(rule for rule in ALL if rule.category == category)
