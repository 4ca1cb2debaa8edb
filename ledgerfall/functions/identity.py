"""Pseudonyms, and what a national identity number tells about its holder."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfall import vocabulary as V


def salt_from_secret(secret: Column) -> Column:
    """Salt from a stored secret: the password of a JSON object, else the text."""
    return F.coalesce(F.get_json_object(secret, "$.password"), secret)


def salt_value(salt: DataFrame) -> Column:
    """The salt in a one-row, one-column frame that holds the stored secret, as a scalar subquery.

    Spark evaluates it once per query and hands the value to the tasks: no join
    and no literal, so the salt does not show up in plans or in the event log as
    long as the frame itself does not hold it as a literal.  Two rows are an error in
    Spark; an empty or null secret is one here.
    """
    missing = F.raise_error(F.lit("the salt frame must hold one non-null value"))
    return F.coalesce(salt_from_secret(salt.scalar()), missing)


def pseudonym(value: Column, salt: Column) -> Column:
    """Hex SHA-256 of salt followed by value; null stays null."""
    return F.sha2(F.concat(salt, value), 256)


def date_of_birth(id_number: Column) -> Column:
    """Date in the first six digits of an ID number, null if it is not valid.

    The first ten characters must be digits and the length must be right; the
    last three characters are not looked at.
    """
    yy = F.substring(id_number, 1, 2)
    century = F.when(yy >= f"{V.ID_CENTURY_PIVOT:02d}", "19").otherwise("20")
    iso = F.concat(
        century, yy, F.lit("-"), F.substring(id_number, 3, 2), F.lit("-"), F.substring(id_number, 5, 2)
    )
    well_formed = (F.length(id_number) == V.ID_LENGTH) & id_number.rlike("^[0-9]{10}")
    return F.when(well_formed, iso).try_cast("date")


def age_on(birth: Column, day: date) -> Column:
    """Completed years on a day, by calendar month and day."""
    birthday = F.month(birth) * 100 + F.dayofmonth(birth)
    not_yet = (birthday > day.month * 100 + day.day).cast("int")
    return (F.lit(day.year) - F.year(birth) - not_yet).cast("int")


def gender(id_number: Column, birth: Column) -> Column:
    """M or F from digits 7 to 10, null when the date of birth is not valid."""
    male = F.substring(id_number, 7, 4) >= f"{V.ID_MALE_FROM:04d}"
    return F.when(birth.isNotNull(), F.when(male, "M").otherwise("F"))
