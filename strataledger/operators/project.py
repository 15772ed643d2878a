"""Projections, mappings and row generators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import money


def project_alias(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select ``old -> new`` names in the given order."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def case_map(branches: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered searched CASE: the first true branch wins."""
    out = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(default) if out is not None else default


def waterfall(cols: Sequence[Column | str], default: object) -> Column:
    """First non-NULL in priority order, else the default."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols], F.lit(default))


def fill_unknown(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL per column, keeping the column's type."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()}
    )


def replace_if_match(df: DataFrame, fix: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Take the repaired values where a repair row exists (even when they are NULL)."""
    mend = fix.select(*keys, *[F.col(c).alias(f"_fix_{c}") for c in cols], F.lit(1).alias("_hit"))
    joined = df.join(mend, [*keys], "left")
    repaired = {c: F.when(F.col("_hit") == 1, F.col(f"_fix_{c}")).otherwise(F.col(c)) for c in cols}
    return joined.withColumns(repaired).select(*df.columns)


def signed_amount(amount: Column, code: Column, in_codes: Sequence[str], cancelled: Column) -> Column:
    """Inflows positive, outflows negative; a cancellation reverses the sign."""
    return (money(amount) * count_sign(code, in_codes, cancelled)).cast("decimal(18,2)")


def count_sign(code: Column, in_codes: Sequence[str], cancelled: Column) -> Column:
    sign = F.when(code.isin(*in_codes), 1).otherwise(-1)
    return F.when(cancelled, -sign).otherwise(sign)


def json_to_rows(df: DataFrame, json_col: str, element: str, out: Mapping[str, str]) -> DataFrame:
    """JSON array text to one row per element; a row without elements is kept.

    ``element`` is the DDL of one element, ``out`` maps element fields to column names.
    """
    parsed = F.from_json(F.col(json_col), f"array<struct<{element}>>")
    rows = df.withColumn("_item", F.explode_outer(parsed))
    return rows.withColumns({new: F.col(f"_item.{f}") for f, new in out.items()}).drop("_item")


def unpivot_columns(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], ordinal: str = "ordinal", value: str = "value"
) -> DataFrame:
    """Repeated columns to rows, numbered from 1, NULLs left out."""
    items = F.array(
        *[F.struct(F.lit(i).alias(ordinal), F.col(c).cast("string").alias(value)) for i, c in enumerate(cols, 1)]
    )
    rows = df.select(*ids, F.explode(items).alias("_item")).select(*ids, "_item.*")
    return rows.filter(F.col(value).isNotNull())


def split_to_rows(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    """Delimited text to one row per part (the separator is a literal)."""
    quoted = "\\Q" + sep + "\\E"
    return df.withColumn(out, F.explode(F.split(F.col(col), quoted))).drop(col)


def derive_dimension(src: DataFrame, label: Column, key: Column, key_name: str, label_name: str) -> DataFrame:
    """Distinct parsed labels with a key computed from the label itself."""
    labels = src.select(label.alias(label_name)).distinct()
    return labels.select(key.cast("int").alias(key_name), label_name)
