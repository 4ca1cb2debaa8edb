"""Bronze to Silver: less personal data, same rows.

One narrow projection: no shuffle, no join, no Python worker.
"""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfall import vocabulary as V
from ledgerfall.functions import identity, money
from ledgerfall.schemas import SILVER_COLUMNS


def drop_pii(df: DataFrame, columns: Iterable[str] = V.DROPPED_PII) -> DataFrame:
    """Without high-risk personal columns; absent ones are no error."""
    return df.drop(*columns)


def pseudonymise(df: DataFrame, salt: DataFrame, columns: Iterable[str] = V.PSEUDONYMISED) -> DataFrame:
    """Columns replaced by their salted hashes."""
    salted = df.withColumn("_salt", identity.salt_value(salt))
    return salted.withColumns({c: identity.pseudonym(F.col(c), F.col("_salt")) for c in columns}).drop("_salt")


def derive_holder(df: DataFrame, run_date: date, id_column: str = "id_number") -> DataFrame:
    """With age and gender of the holder, both null for an invalid ID number."""
    birth = F.col("_birth")
    return (
        df.withColumn("_birth", identity.date_of_birth(F.col(id_column)))
        .withColumns(
            {
                "age": identity.age_on(birth, run_date),
                "gender": identity.gender(F.col(id_column), birth),
            }
        )
        .drop("_birth")
    )


def normalise_amounts(df: DataFrame) -> DataFrame:
    """Amount and balance as double, null where the text is no finite number that fits money."""
    return df.withColumns(
        {c: money.finite(F.col(c).try_cast("double")) for c in ("amount", "running_balance") if c in df.columns}
    )


def to_silver(bronze: DataFrame, salt: DataFrame, run_date: date) -> DataFrame:
    """Silver rows of Bronze rows.

    Columns Bronze has beyond its layout come last, for validation to report.
    """
    minimised = pseudonymise(drop_pii(bronze), salt)
    derived = derive_holder(normalise_amounts(minimised), run_date).drop(*V.SPENT_AFTER_DERIVATION)
    known = [c for c in SILVER_COLUMNS if c in derived.columns]
    return derived.select(*known, *(c for c in derived.columns if c not in SILVER_COLUMNS))
