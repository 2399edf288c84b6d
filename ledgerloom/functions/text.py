"""String helpers: column names, currencies, titles, ticket prefixes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of the two currencies that keep their own class.
CURRENCY_CLASSES = {
    "euro": "Euro",
    "eur": "Euro",
    "€": "Euro",
    "uk pounds": "UK pounds",
    "gbp": "UK pounds",
    "british pound": "UK pounds",
    "pound sterling": "UK pounds",
    "uk pound": "UK pounds",
    "£": "UK pounds",
}
OTHER_CURRENCY = "Other"

# Titles recognised in a name, and the group each belongs to.
TITLE_GROUPS = {
    "Mr": "Mr",
    "Mrs": "Mrs",
    "Miss": "Miss",
    "Master": "Master",
    "Don": "Royalty",
    "Lady": "Royalty",
    "Sir": "Royalty",
    "Dr": "Officer",
    "Rev": "Officer",
    "Capt": "Officer",
    "Jonkheer": "Royalty",
    "Major": "Officer",
    "Mlle": "Miss",
    "Countess": "Royalty",
    "Mme": "Mrs",
    "Ms": "Miss",
    "Col": "Officer",
}

# Fixed value: what counts as the alphabetic part of a ticket.
TICKET_PREFIX = r"([A-Za-z./]+)"


def snake_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_") or "column"


def snake_names(names: Sequence[str]) -> list[str]:
    """snake_case names; a repeated name gets the suffix _2, _3, ..."""
    taken: set[str] = set()
    result = []
    for base in map(snake_name, names):
        candidate, turn = base, 1
        while candidate in taken:
            turn += 1
            candidate = f"{base}_{turn}"
        taken.add(candidate)
        result.append(candidate)
    return result


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))


def currency_class(column: str) -> Column:
    """Class of a currency by its spelling, whatever the case and the blanks around it."""
    return F.coalesce(lookup(F.trim(F.lower(column)), CURRENCY_CLASSES), F.lit(OTHER_CURRENCY))


def title(column: str) -> Column:
    """First known title followed by a dot, or NULL."""
    pattern = r"\b(" + "|".join(TITLE_GROUPS) + r")\."
    return F.nullif(F.regexp_extract(F.col(column), pattern, 1), F.lit(""))


def title_group(column: str) -> Column:
    return lookup(title(column), TITLE_GROUPS)


def ticket_prefix(column: str) -> Column:
    found = F.regexp_extract(F.col(column), TICKET_PREFIX, 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("NONE"))


def first_letter(column: str, missing: str = "Unknown") -> Column:
    return F.coalesce(F.nullif(F.left(F.col(column), F.lit(1)), F.lit("")), F.lit(missing))


def lookup(column: Column, mapping: dict) -> Column:
    """Dictionary mapping; a key that is not listed gives NULL."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), column)
