"""Small text and column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the dated folder layout of landed files.
DATED_PATH = r"year=(\d{4})/month=(\d{2})/day=(\d{2})/"


def date_from_path(path: Column) -> Column:
    """Date of a path in the dated layout; NULL when the path does not follow it."""
    digits = F.regexp_extract(path, DATED_PATH, 0)
    return F.try_to_date(F.regexp_replace(digits, r"[^\d]", ""), "yyyyMMdd")


def optional_column(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or a typed NULL when the frame was written before it existed or a value is malformed."""
    return F.col(name).try_cast(dtype) if name in df.columns else F.lit(None).cast(dtype)


def first_present(df: DataFrame, names: Sequence[str], dtype: str = "string") -> Column:
    """First non-NULL value among the accepted spellings of one field."""
    return F.coalesce(*(optional_column(df, name, dtype) for name in names))


def id_list(raw: Column) -> Column:
    """Ids from a JSON array or a comma-separated text; blanks are dropped."""
    from_array = F.from_json(F.when(F.trim(raw).startswith("["), raw), "array<string>")
    items = F.coalesce(from_array, F.split(raw, ","))
    return F.filter(F.transform(items, lambda item: F.trim(item)), lambda item: item != "")
