"""City names, names and role masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that stand for another city name.
CITY_ALIASES = {"Bengaluru": "Bangalore", "New Delhi": "Delhi"}


def clean_city(col) -> Column:
    """Trim, capitalise, and map aliases; an expression, so no lookup join."""
    name = F.initcap(F.trim(col))
    result = name
    for alias, city in CITY_ALIASES.items():
        result = F.when(name == alias, F.lit(city)).otherwise(result)
    return result


def full_name(first="first_name", last="last_name") -> Column:
    """NULL when either part is NULL, as with ||."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def initial(col) -> Column:
    return F.concat(F.substring(col, 1, 1), F.lit("***"))


def phone_last4(col) -> Column:
    return F.concat(F.lit("***-***-"), F.right(F.regexp_replace(col, r"\D", ""), F.lit(4)))


def email_partial(col) -> Column:
    return F.regexp_replace(col, r"(^.).*(@.*$)", "$1***$2")


def license_tail(col) -> Column:
    return F.concat(F.lit("***"), F.right(col, F.lit(4)))
