"""CSV records with quoted line breaks, read by as many tasks as the file has ranges.

Where a range begins, inside quotes or outside, depends on all that stands before it. So every line is taken as a step from
either state to the state after it; steps are put together along a range, ranges along a file (one small row each), and only
then is it known which lines begin a record. A step keeps or replaces the state, or turns it around, so a run of steps is the
last replacement and the number of turns since: aggregates along a range, windows along a file.

Lines move only where they have to. In a range that begins outside and has no line that could open a quote, each line is a
record. Only the lines of other ranges are shuffled, once, by range; records that go on in a later range get the rest of
their text from there, which is the beginning of these ranges.

A quote opens a field only at the field's beginning; a doubled quote inside a field is one quote. Lines end with ``\\n``
or ``\\r\\n``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linetally.env import written

# states along a line: in an unquoted field, inside quotes, right after a closing quote, at the beginning of the line
UNQUOTED, INSIDE, CLOSED, BEGINNING = 0, 1, 2, 3


def _after(text: Column, begin: int) -> Column:
    """Whether a line that begins in the given state ends inside quotes."""

    def at_quote(state: Column, before: Column) -> Column:
        """The state after a quote, from the state and the text since the last quote."""
        new_field = F.endswith(before, F.lit(","))
        at_begin = state.isin(CLOSED, BEGINNING) & (before == "")
        return F.when(state == INSIDE, CLOSED).when(new_field | at_begin, INSIDE).otherwise(UNQUOTED)

    pieces = F.split(text, '"', -1)
    end = F.aggregate(F.slice(pieces, F.lit(1), F.size(pieces) - 1), F.lit(begin), at_quote)
    return F.when(F.contains(text, F.lit('"')), end == INSIDE).otherwise(begin == INSIDE)


RANGE = ("file", "part", "length")


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines with their file, range and order, and the state after them, begun outside (``o``) and inside (``i``) quotes."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("at"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )
    return lines.withColumns({"o": _after(F.col("line"), BEGINNING), "i": _after(F.col("line"), INSIDE)})


def _composed(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """``rows`` with the state before each, if the first of its group begins outside (``from_o``) and inside (``from_i``)."""
    window = Window.partitionBy(*keys).orderBy(order)
    turn = (F.col("o") & ~F.col("i")).cast("int")
    rows = rows.withColumn("turns", F.sum(turn).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    sets = F.when(F.col("o") == F.col("i"), F.struct(F.col("o").alias("state"), F.col("turns")))
    rows = rows.withColumn("told", F.last(sets, True).over(window.rowsBetween(Window.unboundedPreceding, -1)))
    since = F.coalesce(F.lag("turns").over(window), F.lit(0)) - F.coalesce(F.col("told.turns"), F.lit(0))
    rows = rows.withColumn("turned", since % 2 == 1)
    for name, start in (("from_o", False), ("from_i", True)):
        rows = rows.withColumn(name, F.coalesce(F.col("told.state"), F.lit(start)) != F.col("turned"))
    return rows.drop("turns", "told", "turned")


def _ranges(lines: DataFrame) -> DataFrame:
    """One row per range: the state it begins in, and what becomes of the records that cross its ends.

    ``r`` is its first line, which names it; ``ended`` the line that ends the record it begins in, and ``begun`` the range
    that record began in. ``never`` says that this record is never closed, ``open_end`` that the last one begun here may not
    be, and ``plain`` that each line is a record.
    """
    at, o, i = F.col("at"), F.col("o"), F.col("i")
    found = lines.groupBy(*RANGE).agg(
        F.min("at").alias("r"), F.max("at").alias("last"), F.bool_or("o").alias("opens"), F.min_by("o", "at").alias("header_opens"),
        F.max(F.when(o == i, F.struct("at", o.alias("state")))).alias("told"), F.min(F.when(~i, at)).alias("ended"),
    )
    found = written(found, "csv-ranges")
    if found.where("part > 0").isEmpty() or found.where("opens").isEmpty():
        # where files have one range, how it ends is seen when its lines are put in order
        found = found.withColumns({"turned": F.lit(False), "header_ended": F.lit(None).cast("bigint"), "sure": ~F.col("opens")})
    else:  # a second look: turns after the last replacement, and the line that ends a header of several lines
        known = F.broadcast(found.select(*RANGE, "r", "told"))
        later = lines.join(known, list(RANGE)).groupBy(*RANGE).agg(
            (F.count_if(o & ~i & (at > F.coalesce("told.at", F.lit(-1)))) % 2 == 1).alias("turned"),
            F.min(F.when(~i & (at > F.col("r")), at)).alias("header_ended"),
        )
        found = found.join(F.broadcast(later), list(RANGE)).withColumn("sure", F.lit(True))
    ends = {name: F.coalesce("told.state", F.lit(begun)) != F.col("turned") for name, begun in (("o", False), ("i", True))}
    found = _composed(found.withColumns(ends), ("file",), "part")

    inside, first = F.col("from_o"), F.col("part") == 0  # a file begins outside
    found = found.withColumns(
        {
            "begins": F.when(~inside | (F.col("ended") < F.col("last")), F.col("r")),
            "end": F.when(inside, i).otherwise(o) | ~F.col("sure"),
            "whole_header": F.when(first & F.col("header_opens") & (F.coalesce("header_ended", "last") == F.col("last")), F.col("r")),
        }
    )
    file = Window.partitionBy("file").orderBy("part")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    whole = file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = found.select(
        *RANGE, "r", "begins", inside.alias("inside"), F.when(first, F.col("r")).alias("header"),
        F.when(inside, F.coalesce("ended", "last")).alias("ended"),
        F.last("begins", True).over(earlier).alias("begun"),
        F.last("begins", True).over(whole).alias("last_begin"),
        F.last("end").over(whole).alias("unclosed"),
        F.first("whole_header").over(whole).alias("whole_header"),
        (~inside & ~F.col("opens")).alias("plain"),
    )
    never = F.col("unclosed") & F.col("begins").isNull() & (F.col("begun") == F.col("last_begin"))
    return written(
        found.select(
            *RANGE, "r", "inside", "header", "ended", "begun", "plain", never.alias("never"),
            (F.col("unclosed") & (F.col("r") == F.col("last_begin"))).alias("open_end"),
            (never & F.col("begun").eqNullSafe(F.col("whole_header"))).alias("of_header"),
        ),
        "csv-ranges",
    )


def _joined(*order: str) -> Column:
    """The texts of a group as lines, in order."""
    texts = F.sort_array(F.collect_list(F.struct(*order, "line")))
    return F.array_join(F.transform(texts, lambda x: x["line"]), "\n")


def records(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``record``: the text of each record of the files, without header records; ``whole``: whether its quotes are closed.

    What an unclosed quote at the end of a file takes in is given line by line and not as one record, which could be as
    long as the file. The ranges are found first: the files have to be read in the same ranges then (see
    :func:`same_ranges`), and other ones are refused.
    """
    lines = _lines(spark, path, encoding)
    ranges = _ranges(lines)
    placed = lines.join(F.broadcast(ranges), list(RANGE), "left")
    refused = F.raise_error(F.lit("the CSV files are read in other ranges than before")).cast("boolean")
    placed = placed.withColumn("plain", F.coalesce("plain", refused))

    alone = placed.where("(plain AND (header IS NULL OR at <> header)) OR (never AND NOT of_header)")
    alone = alone.select(F.col("line").alias("record"), F.col("plain").alias("whole"))
    if ranges.where("NOT plain AND NOT never").isEmpty():
        return _without_ends(alone)

    # without the lines of records begun earlier, each range begins outside
    own = placed.where("NOT plain AND NOT never AND (NOT inside OR at > ended)").select("r", "at", "line", "o", "i", "header", "open_end")
    own = _composed(own, ("r",), "at").withColumn("after", F.when(F.col("from_o"), F.col("i")).otherwise(F.col("o")))
    range_ = Window.partitionBy("r").orderBy("at")
    own = own.withColumn("begin", F.last(F.when(~F.col("from_o"), F.col("at")), True).over(range_))
    is_open = F.lit(False)
    if not ranges.where("open_end").isEmpty():
        end = F.last(F.struct("begin", "after")).over(range_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        own = own.withColumn("end", end)
        is_open = F.col("open_end") & F.col("end.after") & (F.col("begin") == F.col("end.begin"))
    # the window's layout by range serves the groups
    own = own.where("header IS NULL OR begin <> header").withColumn("is_open", is_open)
    own = own.groupBy("r", F.when(F.col("is_open"), F.col("at")).otherwise(F.col("begin")).alias("begin")).agg(
        _joined("at").alias("record"), (~F.bool_or("is_open")).alias("whole"), F.max_by("after", "at").alias("goes_on")
    )
    if not ranges.where("inside AND NOT never").isEmpty():
        # one row per range that begins inside a record, then one per record that goes on
        rest = placed.where("inside AND NOT never AND at <= ended").groupBy("begun", "part").agg(_joined("at").alias("line"))
        rest = rest.groupBy("begun").agg(_joined("part").alias("rest"))
        own = own.join(F.broadcast(rest), F.col("goes_on") & F.col("whole") & (F.col("r") == F.col("begun")), "left")
        own = own.withColumn("record", F.concat("record", F.when(F.col("rest").isNull(), "").otherwise(F.concat(F.lit("\n"), "rest"))))
    return _without_ends(alone.unionByName(own.select("record", "whole")))


def _without_ends(records: DataFrame) -> DataFrame:
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")


@contextmanager
def same_ranges(spark: SparkSession) -> Iterator[None]:
    """Files are read in the same ranges each time, also where executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
