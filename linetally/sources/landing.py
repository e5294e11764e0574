"""Reading the landing zone: newline-delimited JSON, one line per order line."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.functions.columns import instant, wall_clock
from linetally.schemas import CORRUPT, LANDED_ORDER, LANDED_ORDER_OR_CORRUPT
from linetally.sources.files import existing

# plain or gzipped; folder markers and other objects do not match
LANDED_FILES = "*.{json,txt,json.gz,txt.gz}"


def read_lines(spark: SparkSession, root: str, periods: Iterable[str] | None = None) -> DataFrame:
    """Every text line with the period its folder claims.

    Lines are read as text, so counting them does not depend on any parsing.
    With periods given, only their day folders are listed and read.
    """
    schema = "value string, event_date string"
    reader = spark.read.schema(schema).option("pathGlobFilter", LANDED_FILES)
    if periods is None:
        lines = reader.text(root)
    else:
        folders = existing(spark, [f"{root}/event_date={p}-*" for p in dict.fromkeys(periods)])
        lines = reader.option("basePath", root).text(folders) if folders else spark.createDataFrame([], schema)
    return lines.withColumn("path_period", F.substring("event_date", 1, 7))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Parse the ``value`` column, keeping one output row per input line.

    A line is exactly one of blank, corrupt (its text is kept), undated, or
    good. Wrong types, and NaN or infinite numbers, make the whole line corrupt. One pass therefore yields
    the line count and the parsed rows, so the landing zone is read once.
    """
    record = F.from_json(
        "value", LANDED_ORDER_OR_CORRUPT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowNonNumericNumbers": "false"}
    )
    parsed = lines.withColumn("r", record)
    is_blank = F.col("r").isNull()
    corrupt = F.col(f"r.{CORRUPT}")
    dated = wall_clock("r.invoice_date")

    def field(name: str) -> Column:
        return {"invoice_date": dated, "ingested_at": instant("r.ingested_at")}.get(name, F.col(f"r.{name}"))

    keep = [c for c in lines.columns if c not in ("value", "r")]
    return parsed.select(
        *keep,
        is_blank.alias("is_blank"),
        corrupt.isNotNull().alias("is_corrupt"),
        *[field(f).alias(f) for f in LANDED_ORDER.fieldNames()],
        F.year(dated).alias("year"),
        F.month(dated).alias("month"),
        # the text itself is only carried for lines that will be set aside
        F.when(corrupt.isNotNull() | (~is_blank & dated.isNull()), F.col("value")).alias("line"),
    )


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("is_blank") & ~F.col("is_corrupt"))


def corrupt_sample(parsed: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` corrupt lines in text order, for diagnosis."""
    return parsed.where("is_corrupt").select("path_period", "line").orderBy("line", "path_period").limit(n)


def stray(parsed: DataFrame) -> DataFrame:
    """Good, dated lines filed under a period that is not their own."""
    own = F.date_format("invoice_date", "yyyy-MM")
    return good(parsed).where(F.col("invoice_date").isNotNull() & (own != F.col("path_period")))
