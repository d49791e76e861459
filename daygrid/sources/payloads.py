"""JSON responses: contract checks and explosion into records.

A payload is one JSON text. It is accepted only as a whole: one bad record sends the payload
to quarantine with its first reason. The checks read the JSON types (a number where a string
is promised is a violation), which is why payloads are parsed as VARIANT and not into a struct.
Everything stays within the row; there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.schemas import (
    API_TIMESTAMP,
    ASSET_FIELDS,
    MARKET_CAP_ALIASES,
    OPTIONAL_ASSET_FIELDS,
    REQUIRED_ASSET_FIELDS,
    TOTAL_MARKET_CAP_ALIASES,
)

INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
NUMBER_KINDS = r"^(STRING|BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$"


@dataclass(frozen=True)
class Contract:
    """Fields a record must or may carry.

    ``measures`` maps a field to its accepted spellings; values are text or numbers.
    """

    strings: tuple[str, ...] = ()
    optional_strings: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    measures: dict[str, tuple[str, ...]] = field(default_factory=dict)
    optional_measures: dict[str, tuple[str, ...]] = field(default_factory=dict)
    output: tuple[str, ...] = ()
    timestamp_required: bool = False
    bare_list_allowed: bool = False

    @property
    def checked(self) -> tuple[str, ...]:
        return (
            *self.strings, *self.optional_strings, *self.integers, *self.measures, *self.optional_measures,
        )

    def spellings(self, name: str) -> tuple[str, ...]:
        return {**self.measures, **self.optional_measures}.get(name, (name,))


ASSETS = Contract(
    strings=REQUIRED_ASSET_FIELDS,
    optional_strings=OPTIONAL_ASSET_FIELDS,
    output=ASSET_FIELDS,
    timestamp_required=True,
)
ASSET_HISTORY = Contract(
    integers=("time",),
    optional_strings=("date",),
    measures={"priceUsd": ("priceUsd",)},
    optional_measures={"volumeUsd24Hr": ("volumeUsd24Hr",)},
    output=("time", "date", "priceUsd", "volumeUsd24Hr"),
    bare_list_allowed=True,
)
ASSET_MARKET_CAP_HISTORY = Contract(
    integers=("time",),
    optional_strings=("date",),
    measures={"marketCapUsd": MARKET_CAP_ALIASES},
    output=("time", "date", "marketCapUsd"),
    bare_list_allowed=True,
)
TOTAL_MARKET_CAP_HISTORY = Contract(
    integers=("time",),
    optional_strings=("date",),
    measures={"totalMarketCapUsd": TOTAL_MARKET_CAP_ALIASES},
    output=("time", "date", "totalMarketCapUsd"),
    bare_list_allowed=True,
)


def _kind(record: Column, name: str) -> Column:
    """JSON type of a member; NULL when it is absent or null."""
    kind = F.schema_of_variant(F.try_variant_get(record, f"$.{name}", "variant"))
    return F.nullif(kind, F.lit("VOID"))


def _text(record: Column, name: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", "string")


def _is_integer(kind: Column, text: Column) -> Column:
    return (kind == "BIGINT") | ((kind == "STRING") & text.rlike(INTEGER_TEXT))


def _member(record: Column, contract: Contract, name: str) -> Column:
    return F.coalesce(*(_text(record, s) for s in contract.spellings(name)))


def _kinds(record: Column, contract: Contract) -> Column:
    """JSON types of the checked members, and the text of integers, read once per record."""
    kinds = [
        F.coalesce(*(_kind(record, s) for s in contract.spellings(name))).alias(name)
        for name in contract.checked
    ]
    return F.struct(*kinds, *(_text(record, name).alias(f"{name} text") for name in contract.integers))


def _violation(kinds: Column, contract: Contract) -> Column:
    """First broken rule of a record, or NULL."""
    rules = []
    for name in contract.checked:
        kind = kinds[name]
        if name in contract.strings or name in contract.optional_strings:
            fits, label = kind == "STRING", "not a string"
        elif name in contract.integers:
            fits, label = _is_integer(kind, kinds[f"{name} text"]), "not an integer"
        else:
            fits, label = kind.rlike(NUMBER_KINDS), "not a number"
        if name not in contract.optional_strings and name not in contract.optional_measures:
            rules.append(F.when(kind.isNull(), F.lit(f"missing {name}")))
        rules.append(F.when(kind.isNotNull() & ~fits, F.lit(f"{label}: {name}")))
    return F.coalesce(*rules)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A filter on a plain column is pushed below it, where the whole expression (here, parsing
    the JSON) would run again for every use. Filters do not pass a generator.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select("*", F.inline(F.array(row)))


def _checked(payloads: DataFrame, column: str, contract: Contract) -> DataFrame:
    parsed = _once(payloads, _body=F.try_parse_json(column))
    data = F.try_variant_get("_body", "$.data", "array<variant>")
    if contract.bare_list_allowed:
        data = F.coalesce(data, F.try_variant_get("_body", "$", "array<variant>"))
    body = F.col("_body")
    split = _once(parsed, _data=data, _stamp_kind=_kind(body, "timestamp"), _stamp=_text(body, "timestamp"))
    stamp_ok = _is_integer(F.col("_stamp_kind"), F.col("_stamp"))
    if not contract.timestamp_required:
        stamp_ok = stamp_ok | F.col("_stamp_kind").isNull()
    kinds = F.transform("_data", lambda record: _kinds(record, contract))
    violations = F.transform(kinds, lambda k: _violation(k, contract))
    broken = F.filter(violations, lambda v: v.isNotNull())
    reason = (
        F.when(body.isNull(), F.lit("not JSON"))
        .when(F.col("_data").isNull(), F.lit("no record list"))
        .when(~F.coalesce(stamp_ok, F.lit(False)), F.lit("no integer timestamp"))
        .otherwise(F.try_element_at(broken, F.lit(1)))
    )
    return _once(split, reason=reason)


def quarantined(payloads: DataFrame, column: str, contract: Contract) -> DataFrame:
    """Rejected payloads with ``reason``."""
    bad = _checked(payloads, column, contract).where(F.col("reason").isNotNull())
    return bad.select(*payloads.columns, "reason")


def accepted(payloads: DataFrame, column: str, contract: Contract) -> DataFrame:
    """Records of accepted payloads as strings, next to the payload's other columns."""
    good = _checked(payloads, column, contract).where(F.col("reason").isNull())
    keep = [c for c in payloads.columns if c != column]
    records = F.transform(
        "_data", lambda r: F.struct(*(_member(r, contract, n).alias(n) for n in contract.output))
    )
    return good.select(*keep, F.col("_stamp").try_cast("long").alias(API_TIMESTAMP), F.inline(records))


def validate_contract(payloads: DataFrame, column: str, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(accepted records, quarantined payloads)."""
    return accepted(payloads, column, contract), quarantined(payloads, column, contract)
