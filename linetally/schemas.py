"""Declared schemas. Nothing in the engine infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(text: str) -> T.StructType:
    """``name type, ...`` as a schema; unlike DDL parsing it needs no session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CORRUPT = "_corrupt_record"

# One landed order line. Dates stay text until conversion.
LANDED_ORDER = _struct(
    "invoice_no string, stock_code string, description string, quantity int, "
    "invoice_date string, unit_price double, customer_id string, country string, "
    "source_system string, ingested_at string"
)

# The same line with a slot for the text of lines that do not parse.
LANDED_ORDER_OR_CORRUPT = T.StructType(LANDED_ORDER.fields + [T.StructField(CORRUPT, T.StringType())])

# Body of a staged Parquet file; year and month live in the path.
STAGED_ORDER = _struct(
    "invoice_no string, stock_code string, description string, quantity int, "
    "invoice_date timestamp_ntz, unit_price double, customer_id string, country string, "
    "source_system string, ingested_at timestamp"
)

RAW_ORDER = T.StructType(
    STAGED_ORDER.fields
    + _struct("source_file string, loaded_at timestamp, partition_year int, partition_month int").fields
)

STG_ORDER = _struct(
    "invoice_no string, stock_code string, description string, quantity int, "
    "invoice_date timestamp_ntz, unit_price double, customer_id string, country string, "
    "source_system string, ingested_at timestamp, loaded_at timestamp, source_file string, "
    "invoice_date_only date, is_cancellation boolean, line_type string, "
    "line_amount double, duplicate_occurrence int, period string"
)

LANDED_COUNTRY = _struct(
    "country_id string, iso2_code string, country_name string, region_id string, "
    "region_name string, admin_region_id string, income_level_id string, "
    "income_level_name string, lending_type_id string, capital_city string, "
    "longitude string, latitude string, source_system string, ingested_at timestamp"
)

LANDED_INDICATOR = _struct(
    "country_id string, country_name string, indicator_id string, indicator_name string, "
    "year string, value double, source_system string, ingested_at timestamp"
)

COUNTRY_MAPPING = _struct(
    "retail_country string, worldbank_country_id string, mapping_type string, note string"
)
