"""Decode, normalise and validate raw JSON events (batch or streaming DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.functions.rules import SUPPORTED_CATEGORIES, normalize_category
from playpulse.schema import RAW_EVENT_SCHEMA, REQUIRED_FIELDS


def decode_events(raw: DataFrame, value_column: str = "value") -> DataFrame:
    """``from_json(value)`` flattened to the 25 envelope fields, category normalised.

    Malformed JSON gives a row of nulls (dropped by :func:`validate_events`); a field of
    the wrong type becomes null on its own; unknown fields are ignored.
    """
    return parse_json_fields(raw, value_column, RAW_EVENT_SCHEMA).withColumn(
        "category", normalize_category("category")
    )


def parse_json_fields(raw: DataFrame, value_column: str, schema) -> DataFrame:
    """``from_json`` flattened to one column per field, parsed exactly once per row.

    The parse runs inside a generator (``inline`` of a one-element array). Filters
    on the fields then stay above it: with a plain projection Catalyst pushes each
    filter below the projection and inlines a separate ``from_json`` per referenced
    field, parsing every message once per field. A malformed message gives a row of
    nulls.
    """
    parsed = F.from_json(F.col(value_column).cast("string"), schema)
    return raw.select(F.inline(F.array(parsed)))


def validate_events(parsed: DataFrame, with_ingest_time: bool = True) -> DataFrame:
    """Keep events with every required field and a supported category; add
    ``event_date`` (UTC day of ``event_time``) and ``ingested_at``."""
    cond = F.col("category").isin(*SUPPORTED_CATEGORIES)
    for c in REQUIRED_FIELDS:
        cond = cond & F.col(c).isNotNull()
    out = parsed.filter(cond).withColumn("event_date", F.to_date("event_time"))
    ingest_time = F.current_timestamp() if with_ingest_time else F.lit(None).cast("timestamp")
    return out.withColumn("ingested_at", ingest_time)


def canonicalize_events(
    vendor: DataFrame,
    fields: dict[str, "str | F.Column"],
    category_map: dict[str, str] | None = None,
) -> DataFrame:
    """Map a vendor export onto the canonical envelope ahead of ingest.

    ``fields`` gives, per envelope field, a source column name or a Column
    expression; envelope fields not given are null. ``category_map`` translates the
    (lower-cased, trimmed) source category values; unmapped values pass through and
    are then rejected by validation as unsupported. Output: the 25 envelope fields
    with their declared types.
    """
    unknown = set(fields) - {f.name for f in RAW_EVENT_SCHEMA.fields}
    if unknown:
        raise ValueError(f"not envelope fields: {sorted(unknown)}")
    cols = []
    for f in RAW_EVENT_SCHEMA.fields:
        src = fields.get(f.name)
        c = F.lit(None) if src is None else (F.col(src) if isinstance(src, str) else src)
        if f.name == "category" and category_map and src is not None:
            key = normalize_category(c)
            mapped = None
            for k, v in category_map.items():
                mapped = (F.when if mapped is None else mapped.when)(key == k.strip().lower(), F.lit(v))
            c = mapped.otherwise(key)
        cols.append(c.cast(f.dataType).alias(f.name))
    return vendor.select(*cols)
