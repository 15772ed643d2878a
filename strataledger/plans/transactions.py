"""Transaction fact: incremental flows with cancellations as reversed rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY
from ..functions.dates import date_key
from ..functions.text import last_chars
from ..operators.asof import recurring_lag
from ..operators.joins import fx_convert, lookup_by_labels, missing
from ..operators.project import count_sign, signed_amount
from ..operators.temporal import looked_up, valid_versions
from ..sources.incremental import incremental_and_late
from .people import PEOPLE_KEYS, People, with_people


def new_and_cancelled(flows: DataFrame, cancelled_on: str, record: str = "record_type") -> DataFrame:
    """Every transaction once as new, and once more if it is cancelled.

    One pass: the second copy is exploded, the input is not read twice.
    """
    copies = F.when(F.col(cancelled_on).isNotNull(), F.array(F.lit("New Record"), F.lit("Cancelled Record")))
    rows = flows.withColumn(record, F.explode(copies.otherwise(F.array(F.lit("New Record")))))
    return rows.withColumn(cancelled_on, F.when(F.col(record) == "Cancelled Record", F.col(cancelled_on)))


def transaction_fact(
    flows: DataFrame, stored: DataFrame, owners: DataFrame, rates: DataFrame, flow_types: DataFrame,
    account: str, keys: Sequence[str], in_codes: Sequence[str], size: Column, people: People | None = None,
    stage: Callable[[DataFrame, str], DataFrame] = lambda rows, name: rows, drop: Callable[[str], None] = lambda name: None,
) -> DataFrame:
    """Rows to append to the fact.

    ``flows`` are the movements after the cutover between systems: ``keys``, system, ``account``, code, amount, currency,
    trade_date, cancelled_on and updated. ``stored`` is the fact so far (keys, updated, flow_count, system), ``owners`` the
    account's owner over time, ``flow_types`` the combination dimension over direction, asset
    and size. With ``people`` rows also have the keys of the people behind the account at the trade date.

    ``stage`` writes rows under a name and reads them back, ``drop`` deletes what was written under a name, also ``flows`` and ``rates`` if
    the caller staged them so. Every step that shuffles whole rows ends in one, so that the disk holds the shuffles of one step at a time and no
    step is done again for a second reader. What is returned reads ``stored`` and the last of these tables.
    """
    stored = stored.hint("merge")  # as many rows as the fact, however small its compressed keys look: not for the driver
    match = [account, "amount", "code_class", "currency"]
    classed = {"code_class": last_chars(F.col("code"), 2)}
    batch = stage(incremental_and_late(flows, stored, "updated", [*keys, "system"]).drop("updated"), "batch")
    lagged = recurring_lag(
        batch.withColumns(classed), flows.withColumns(classed), match, "trade_date", stage=lambda days: stage(days, "days")
    )
    lagged = stage(lagged, "lagged")
    for name in ("flows", "batch", "days"):
        drop(name)

    def owner(asked: DataFrame) -> DataFrame:
        return stage(valid_versions(asked, owners, [account], "trade_date", how="left").drop("start_date", "end_date"), "owned")

    # both copies of a cancelled transaction have its account and date, so these are looked up before it is copied
    if people is None:
        staff, found = [], looked_up(lagged, [account, "trade_date"], [owner])
    else:
        staff, found = PEOPLE_KEYS, with_people(lagged, account, "trade_date", people, [owner])
    found = stage(found, "found")
    for name in ("lagged", "owned"):
        drop(name)
    rows = new_and_cancelled(found, "cancelled_on")
    cancelled = F.col("cancelled_on").isNotNull()
    signed = rows.withColumns(
        {
            "flow_amount_original": signed_amount(F.col("amount"), F.col("code"), in_codes, cancelled),
            "flow_count": F.when(cancelled, -1).otherwise(1),
        }
    )
    priced = fx_convert(
        signed, rates, ["currency", "trade_date"], "flow_amount_original", "rate", F.lit(1), "flow_amount"
    )
    typed = lookup_by_labels(
        priced, flow_types,
        {"direction": count_sign(F.col("code"), in_codes, F.lit(False)), "asset": F.left("code_class", F.lit(1)), "size": size},
        "flow_type_key",
    )
    fact = typed.select(
        *keys, "system", date_key(F.col("trade_date")).alias("trade_date_key"),
        F.coalesce(date_key(F.col("cancelled_on")), F.lit(UNKNOWN_KEY)).alias("cancelled_date_key"),
        F.coalesce("owner_key", F.lit(UNKNOWN_KEY)).alias("owner_key"), "flow_type_key",
        "flow_amount", "flow_amount_original", "flow_count", F.col("days_lag").alias("recurring_days_lag"), "record_type", *staff,
    )
    fact = stage(fact, "rows")
    for name in ("found", "rates"):
        drop(name)
    return missing(fact, stored, [*keys, "flow_count", "system"])
