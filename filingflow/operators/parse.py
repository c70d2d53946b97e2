"""Listed items to typed filings; items that break the contract go to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import computed_once
from ..functions.text import empty_to_null
from ..schema import FILING_FIELDS, OPTIONAL_FIELDS, REQUIRED_FIELDS, VIEWER_URL


_FIELDS = REQUIRED_FIELDS + OPTIONAL_FIELDS
_OBJECT = "struct<" + ", ".join(f"{name}: variant" for name in _FIELDS) + ">"


def _field(name: str) -> Column:
    return F.try_variant_get(F.col(f"_fields.{name}"), "$", "string")


def _reject_reason(name: str) -> Column:
    # Reading the field as text would turn 12 into "12"; the type must be asked for.
    kind = F.schema_of_variant(F.col(f"_fields.{name}"))
    return (
        F.when(kind.isNull(), F.lit(f"Required key '{name}' is missing."))
        .when(kind != "STRING", F.lit(f"Field '{name}' must be a string."))
    )


def viewer_url(rcept_no: Column) -> Column:
    return F.concat(F.lit(VIEWER_URL), rcept_no)


def parse_items(items: DataFrame) -> DataFrame:
    """Filing fields, viewer URL and ``reject_reason`` for every ``item``.

    The reason names the first required field that is absent or no string, and
    ``item_json`` holds the item then.  Other columns pass through.
    """
    # the item is taken apart once; its fields stay typed VARIANT
    opened = computed_once(items, items.columns, _fields=F.try_variant_get("item", "$", _OBJECT))
    columns = {name: _field(name) for name in REQUIRED_FIELDS}
    columns |= {name: empty_to_null(_field(name)) for name in OPTIONAL_FIELDS}
    columns["url"] = viewer_url(_field("rcept_no"))
    columns["reject_reason"] = F.coalesce(*[_reject_reason(name) for name in REQUIRED_FIELDS])
    parsed = computed_once(opened, items.columns, **columns)
    rejected = F.col("reject_reason").isNotNull()
    return parsed.withColumn("item_json", F.when(rejected, F.to_json("item"))).drop("item")


def accepted(parsed: DataFrame) -> DataFrame:
    place = [c for c in ("date", "page_no", "pos") if c in parsed.columns]
    return parsed.where(F.col("reject_reason").isNull()).select(*place, *FILING_FIELDS)


def quarantined(parsed: DataFrame) -> DataFrame:
    place = [c for c in ("date", "page_no", "pos") if c in parsed.columns]
    return parsed.where(F.col("reject_reason").isNotNull()).select(*place, "item_json", "reject_reason")
