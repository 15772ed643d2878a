"""Named default values used when a key, text or date is unknown."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Results depend on them.
UNKNOWN_KEY = -1
UNKNOWN_TEXT = "[Unknown]"
MIN_DATE = "1900-01-01"
MAX_DATE = "9999-12-31"


@dataclass(frozen=True)
class Defaults:
    unknown_number: int = UNKNOWN_KEY
    default_number: int = 0
    unknown_text: str = UNKNOWN_TEXT
    not_available_text: str = "[Not Available]"
    not_applicable_text: str = "[Not Applicable]"
    min_date: str = MIN_DATE
    max_date: str = MAX_DATE
    default_money: str = "0.00"

    @classmethod
    def from_table(cls, table: DataFrame, name: str = "name", value: str = "value") -> Defaults:
        """Overlay the defaults with a (name, value) table.

        Only the names declared here are read, so at most one row per field reaches the driver.
        """
        wanted = {f.name: f.type for f in fields(cls)}
        rows = (
            table.filter(F.col(name).isin(*wanted))
            .groupBy(name)
            .agg(F.max(value).alias(value))
            .collect()
        )
        found = {r[name]: int(r[value]) if wanted[r[name]] == "int" else r[value] for r in rows}
        return cls(**found)


def max_date():
    return F.lit(MAX_DATE).cast("date")


def min_date():
    return F.lit(MIN_DATE).cast("date")
