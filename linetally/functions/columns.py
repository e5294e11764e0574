"""Column expressions shared by the models. All of them run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linetally.schemas import LANDED_ORDER


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_key(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM``. NULL when either part is NULL, unlike ``concat_ws``."""
    return F.concat(
        F.lpad(col(year).cast("string"), 4, "0"), F.lit("-"), F.lpad(col(month).cast("string"), 2, "0")
    )


def wall_clock(text: Column | str) -> Column:
    """Text to a zone-free timestamp; what does not parse becomes NULL."""
    return col(text).try_cast("timestamp_ntz")


# Years an order can be of; a date beyond them is a misread field.
FIRST_YEAR, LAST_YEAR = 1900, 2100


def order_time(text: Column | str) -> Column:
    """Text of the source CSV to a zone-free timestamp: ISO, or month/day/year with or without a time.

    Month first, as the source writes it. What fits neither, or lies outside
    the years ``FIRST_YEAR`` to ``LAST_YEAR``, becomes NULL.
    """
    iso = F.regexp_replace(F.trim(col(text)), r"^(\d{1,2})/(\d{1,2})/(\d{4})(?: +(\d{1,2}:.*))?$", "$3-$1-$2 $4")
    iso = F.regexp_replace(F.trim(iso), r"^(\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2})$", "$1:00")
    found = wall_clock(iso)
    return F.when(F.year(found).between(FIRST_YEAR, LAST_YEAR), found)


def instant(text: Column | str) -> Column:
    """Text to a point in time; what does not parse becomes NULL."""
    return col(text).try_cast("timestamp")


def whole_number_text(text: Column | str) -> Column:
    """``17850.0`` to ``17850``; NULL and unreadable text become NULL."""
    return col(text).try_cast("double").try_cast("bigint").cast("string")


def is_cancellation(invoice_no: Column | str) -> Column:
    return F.coalesce(F.startswith(col(invoice_no), F.lit("C")), F.lit(False))


def line_type(invoice_no: Column | str, quantity: Column | str, unit_price: Column | str) -> Column:
    return (
        F.when(is_cancellation(invoice_no), "cancellation")
        .when(col(quantity) < 0, "negative_adjustment")
        .when(col(unit_price) <= 0, "zero_or_negative_price")
        .otherwise("normal")
    )


# Amounts are added as whole ten-thousandths, unit prices as hundred-millionths.
MONEY_UNITS = 10_000.0
PRICE_UNITS = 100_000_000.0


def money(amount: Column | str) -> Column:
    """An amount in whole ten-thousandths, as BIGINT.

    Double addition depends on the order of the rows, which a shuffle does not
    fix; whole numbers give the same total in any order. They also add much
    faster than decimals. An overflow raises. :func:`money_out` turns a total
    back into a double.
    """
    return F.rint(col(amount) * F.lit(MONEY_UNITS)).cast("bigint")


def wide(units: Column | str) -> Column:
    """Whole units for totals over folded rows, which may outgrow a BIGINT."""
    return col(units).cast("decimal(20,0)")


# Totals are kept as two sums, of multiples of this and of the rest, so that no
# group outgrows a BIGINT and nothing is added as a decimal.
SPLIT = 1 << 20


def unit_sums(units: Column, name: str) -> list[Column]:
    """Two sums that :func:`folded_units` adds up, for rows that are folded again."""
    units = units.cast("bigint")
    low = units.bitwiseAND(F.lit(SPLIT - 1))
    return [F.sum(F.shiftright(units, 20)).alias(f"{name}_high"), F.sum(low).alias(f"{name}_low")]


def folded_units(name: str) -> Column:
    """The total of folded rows, from their two sums."""
    return _joined(F.sum(F.col(f"{name}_high")), F.sum(F.col(f"{name}_low")))


def total_units(units: Column) -> Column:
    """The total of whole units in any number of rows."""
    high, low = unit_sums(units, "units")
    return _joined(high, low)


def _joined(high: Column, low: Column) -> Column:
    return high.cast("decimal(29,0)") * F.lit(SPLIT).cast("decimal(8,0)") + low.cast("decimal(29,0)")


def money_out(total: Column) -> Column:
    return total.cast("double") / F.lit(MONEY_UNITS)


def average_price(prices: Column) -> Column:
    """The mean of unit prices, free of drift in the same way."""
    units = F.rint(prices * F.lit(PRICE_UNITS)).cast("bigint")
    return ratio(F.sum(wide(units)).cast("double") / F.lit(PRICE_UNITS), F.count(prices))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL over a zero or NULL denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def masked(value: Column | str, salt: str) -> Column:
    """Salted SHA-256: equal ids stay equal, NULL stays NULL, ids are hidden."""
    return F.sha2(F.concat(F.lit(salt), col(value)), 256)


def path_number(path: Column | str, key: str) -> Column:
    """The number after ``key=`` in a path; NULL when it is not there."""
    return F.regexp_extract(col(path), f"{key}=([0-9]+)", 1).try_cast("int")


def raw_order_quality() -> list[Column]:
    """Seven observed (never enforced) counts over landed lines."""
    return [
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col("invoice_no").isNull()).alias("null_invoice_no"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_id"),
        F.count_if(F.col("quantity") < 0).alias("negative_quantity"),
        F.count_if(F.col("unit_price") <= 0).alias("non_positive_price"),
        F.count_if(F.startswith("invoice_no", F.lit("C"))).alias("cancellations"),
        F.count_if(F.col("invoice_date").isNull()).alias("unparseable_date"),
    ]


QUALITY_FIELDS = (
    "rows_total",
    "null_invoice_no",
    "null_customer_id",
    "negative_quantity",
    "non_positive_price",
    "cancellations",
    "unparseable_date",
)

ORDER_COLUMNS = tuple(LANDED_ORDER.fieldNames())
