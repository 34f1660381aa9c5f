"""Records of landed text files that span lines, found without reading a file as a whole.

Files are read in splits. What a line means depends on the lines before it only through a small running state (inside
quotes or not for CSV, depth of brackets for JSON), and whether something opened is ever closed only through a small state of the lines
after it. Both are computed by windows over each split and carried from split to split by one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.session import stage, unstage

FILE = "_file"
SPLIT = [FILE, "start"]


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value, _file, start, at``: lines with their file, their split's place in it and their order within the split."""
    return spark.read.text(paths).select(
        F.regexp_replace("value", "^﻿", "").alias("value"), F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
    )


def _within(order: list[str], first: int, last: int):
    return Window.partitionBy(*SPLIT).orderBy(*order).rowsBetween(first, last)


def _splits(first: int, last: int):
    return Window.partitionBy(FILE).orderBy("start").rowsBetween(first, last)


# What lies ahead is taken from the last line backwards: Spark evaluates a frame that ends unbounded anew for every row.


def _ahead(order: list[str], last: int):
    """From the end of the split back to ``last`` lines before the current one in that order; the nearest line is the last of the frame."""
    return Window.partitionBy(*SPLIT).orderBy(*[F.desc(c) for c in order]).rowsBetween(START, last)


def _splits_ahead():
    return Window.partitionBy(FILE).orderBy(F.desc("start")).rowsBetween(START, -1)


START = Window.unboundedPreceding


# --- csv ----------------------------------------------------------------------------------------

_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:\s*+"{_QUOTED}"[^,]*+|(?!\s*+")[^,]*+)'
_OPENS = rf'(?:{_FIELD},)*+\s*+"{_QUOTED}$'
#: A line that begins outside of quotes ends inside.
OPENS = rf"^{_OPENS}"
#: A line that begins inside of quotes: has no closing one; closes them before a comma or the end; does so and opens others.
STAYS, CLOSES, REOPENS = rf"^{_QUOTED}$", rf'^{_QUOTED}"\s*+(?:,|$)', rf'^{_QUOTED}"\s*+,{_OPENS}'


def opens_quotes(value: Column) -> Column:
    """A quoted field begins in this line and goes on in the next one, if the line begins outside of quotes."""
    return value.contains('"') & value.rlike(OPENS)


def csv_records(lines: DataFrame) -> DataFrame:
    """``text, broken, head, _file``, staged: one row per record, its lines joined by line breaks.

    A quoted field that opens in a line goes on over lines without quotes, or with doubled ones, to a line that closes it before a
    comma or its end. If a line with any other quote comes first, or the end of the file, the field was never
    closed: the record that opened it is ``broken``, and the lines after it are records of their own. ``head`` marks the
    record that has the file's first line that is not blank.
    """
    order = ["at"]
    value = F.col("value")
    inside = F.when(~value.contains('"') | value.rlike(STAYS), "S").when(value.rlike(REOPENS), "R").when(value.rlike(CLOSES), "C").otherwise("X")
    landed = stage(lines.withColumn("opens", opens_quotes(value)).withColumn("inside", inside).withColumn("blank", ~value.rlike(r"\S")), "lines")
    coded = landed.drop("value")
    # From inside or outside, a line leads to one fixed state, to the state before it, or to the other one.
    opened = F.col("opens").cast("int")
    coded = coded.withColumns({
        "fixed": F.when(F.col("inside") == "X", opened).when((F.col("inside") == "C") & ~F.col("opens"), 0).when((F.col("inside") == "R") & F.col("opens"), 1),
        "flip": F.when((F.col("inside") == "C") & F.col("opens"), 1).otherwise(0),
    })
    so_far = _within(order, START, Window.currentRow)
    coded = coded.withColumn("flips", F.sum("flip").over(so_far))
    mark = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "flips")), ignorenulls=True).over(so_far)
    coded = coded.withColumn("mark", mark).withColumn("known", (F.col("mark.fixed") + F.col("flips") - F.col("mark.flips")) % 2)
    ends = coded.groupBy(*SPLIT).agg(
        F.max_by("known", "at").alias("end"), F.max_by("flips", "at").alias("turns"), F.min(F.when(~F.col("blank"), F.col("at"))).alias("head_at")
    )
    ends = ends.withColumn("turned", F.sum(F.when(F.col("end").isNull(), F.col("turns")).otherwise(0)).over(_splits(START, 0)))
    last_known = F.last(F.when(F.col("end").isNotNull(), F.struct("end", "turned")), ignorenulls=True).over(_splits(START, 0))
    ends = ends.withColumn("fix", last_known).withColumn("state", F.coalesce((F.col("fix.end") + F.col("turned") - F.col("fix.turned")) % 2, F.col("turned") % 2))
    ends = ends.withColumn("begin", F.coalesce(F.lag("state").over(Window.partitionBy(FILE).orderBy("start")), F.lit(0)))
    # A byte order mark or blank lines may precede the header, which lies in the first split.
    known = coded.join(ends.select(*SPLIT, "begin", F.when(F.col("start") == 0, F.col("head_at")).alias("head_at")), SPLIT)
    known = known.withColumn("after", F.coalesce("known", (F.col("begin") + F.col("flips")) % 2))
    known = known.withColumn("before", F.coalesce(F.lag("after").over(Window.partitionBy(*SPLIT).orderBy(*order)), F.col("begin")))
    told = F.when((F.col("before") == 1) & (F.col("inside") != "S"), F.col("inside") != "X")
    known = known.withColumn("told", told)
    known = known.withColumns({
        "next": F.last("told", ignorenulls=True).over(_ahead(order, 0)), "later": F.last("told", ignorenulls=True).over(_ahead(order, -1)),
    })
    stated = known = stage(known.select(*SPLIT, "at", "opens", "inside", "before", "told", "next", "later", "head_at"), "lines")
    firsts = known.groupBy(*SPLIT).agg(F.min_by("told", F.when(F.col("told").isNotNull(), F.col("at"))).alias("told"))
    beyond = firsts.select(*SPLIT, F.last("told", ignorenulls=True).over(_splits_ahead()).alias("beyond"))
    known = known.join(beyond, SPLIT)
    goes_on = (F.col("before") == 1) & F.coalesce("next", "beyond", F.lit(False))
    known = known.withColumn("goes_on", goes_on)
    never = ~F.coalesce("later", "beyond", F.lit(False))
    broken = never & F.when(F.col("goes_on"), F.col("inside") == "R").otherwise(F.col("opens"))
    marked = known.withColumn("broken", broken).withColumn("head", F.coalesce(F.col("at") == F.col("head_at"), F.lit(False)))
    records = stage(_joined(marked.select(*SPLIT, "at", "broken", "head", (~F.col("goes_on")).alias("begins")), landed, order), "records")
    unstage(lines.sparkSession, landed.staged_at, stated.staged_at)
    return records


def _joined(lines: DataFrame, landed: DataFrame, order: list[str]) -> DataFrame:
    """Lines from one that ``begins`` a record up to the next such line as one row; their text is that of ``landed``."""
    begins = F.col("begins")
    place = F.struct("start", *order)
    lines = lines.withColumn("place", place).withColumn("own", F.last(F.when(begins, place), ignorenulls=True).over(_within(order, START, 0)))
    lasts = lines.groupBy(*SPLIT).agg(F.max("own").alias("own"))
    before = lasts.select(*SPLIT, F.last("own", ignorenulls=True).over(_splits(START, -1)).alias("carried"))
    lines = lines.join(before, SPLIT).withColumn("record", F.coalesce("own", "carried"))
    lines = lines.join(landed.select(*SPLIT, *order, "value"), [*SPLIT, *order])
    listed = F.sort_array(F.collect_list(F.struct("place", "value")))
    return lines.groupBy(FILE, "record").agg(
        F.array_join(F.transform(listed, lambda x: x["value"]), "\n").alias("text"), F.bool_or("broken").alias("broken"), F.bool_or("head").alias("head"),
    ).drop("record")


# --- json ---------------------------------------------------------------------------------------

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_CUT = "\u0001"


def brackets(value: Column) -> Column:
    """The brackets of a line that stand outside of strings."""
    return F.regexp_replace(F.regexp_replace(value, _STRING, ""), r"[^\[\]{}]++", "")


def depths(value: Column) -> Column:
    """``rise, dip`` of a line: the change of depth over it, and its lowest depth relative to its beginning."""
    step = lambda at, bracket: F.struct(
        (at["rise"] + F.when(bracket.isin("{", "["), 1).otherwise(-1)).alias("rise"),
        F.least(at["dip"], at["rise"] + F.when(bracket.isin("{", "["), 1).otherwise(-1)).alias("dip"),
    )
    found = brackets(value)
    none = F.struct(F.lit(0).alias("rise"), F.lit(0).alias("dip"))
    return F.when(found.isin("", "{}", "[]"), none).otherwise(F.aggregate(F.filter(F.split(found, ""), lambda b: b != ""), none, step))


def json_records(lines: DataFrame) -> DataFrame:
    """``text, lines, _file``, staged: one row per top-level value, or per text that is none.

    Depth is that of brackets outside of strings; a bracket that is closed without being open, or never closed, doesn't
    count. A value begins at a line that opens an object while nothing is open, and takes the lines to the next such. A file's
    outer array is taken off. Text that belongs to no value, such as a line that isn't JSON, is a record of its own.
    """
    # What follows an object's end in a line is a line of its own, so that objects on one line come apart.
    marked = F.regexp_replace("value", rf"({_STRING})|(\}}\s*,?\s*)(?=\{{)", f"$1$2{_CUT}")
    marked = F.replace(marked, F.lit(f'"{_CUT}'), F.lit('"'))
    cut = lines.select(FILE, "start", "at", F.posexplode(F.split(marked, _CUT)).alias("piece", "value")).filter(F.col("value").rlike(r"\S"))
    order = ["at", "piece"]
    cut = cut.withColumn("place", F.struct("at", "piece")).withColumn("shape", depths(F.col("value")))
    edges = cut.groupBy(*SPLIT).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    whole = Window.partitionBy(FILE)
    edges = edges.select(*SPLIT, F.when(F.col("start") == F.min("start").over(whole), F.col("first")).alias("first"), F.when(F.col("start") == F.max("start").over(whole), F.col("last")).alias("last"))
    cut = cut.join(edges, SPLIT)
    opening = F.coalesce((F.col("place") == F.col("first")) & F.col("value").rlike(r"^\s*\[") & (F.col("shape.rise") > 0), F.lit(False))
    closing = F.coalesce((F.col("place") == F.col("last")) & F.col("value").rlike(r"\]\s*$") & (F.col("shape.rise") < 0), F.lit(False))
    value = F.when(opening, F.regexp_replace("value", r"^\s*\[", "")).otherwise(F.col("value"))
    cut = cut.withColumn("edge", opening | closing).withColumn("value", F.when(closing, F.regexp_replace("value", r"\]\s*$", "")).otherwise(value))
    cut = cut.withColumn("shape", F.when(F.col("edge"), depths(F.col("value"))).otherwise(F.col("shape")))
    brace = F.col("value").rlike(r"^[\[,\s]*\{")
    landed = stage(cut.select(*SPLIT, *order, "value", F.col("shape.rise").alias("rise"), F.col("shape.dip").alias("dip"), brace.alias("brace")), "lines")
    cut = landed.drop("value")
    cut = cut.withColumn("level", F.sum("rise").over(_within(order, START, 0)))
    cut = cut.withColumn("lowest", F.min(F.col("level") - F.col("rise") + F.col("dip")).over(_within(order, START, 0)))
    totals = cut.groupBy(*SPLIT).agg(F.sum("rise").alias("rise"), F.min("lowest").alias("lowest"))
    totals = totals.withColumn("base", F.coalesce(F.sum("rise").over(_splits(START, -1)), F.lit(0)))
    totals = totals.withColumn("floor", F.least(F.lit(0), F.min(F.col("base") + F.col("lowest")).over(_splits(START, -1))))
    cut = cut.join(totals.select(*SPLIT, "base", "floor"), SPLIT)
    # Depth without brackets that close nothing: before a line, and the lowest one within it.
    floor = F.least("floor", F.col("base") + F.col("lowest"))
    before = F.coalesce(F.lag(F.col("base") + F.col("level") - floor).over(Window.partitionBy(*SPLIT).orderBy(*order)), F.col("base") - F.col("floor"))
    cut = cut.withColumn("before", before).withColumn("low", F.col("base") + F.col("level") - F.col("rise") + F.col("dip") - floor)
    cut = cut.withColumn("ahead", F.min("low").over(_ahead(order, 0)))
    lowest = cut = stage(cut.select(*SPLIT, *order, "brace", "before", "low", "ahead"), "lines")
    lows = cut.groupBy(*SPLIT).agg(F.min("low").alias("low"))
    cut = cut.join(lows.select(*SPLIT, F.min("low").over(_splits_ahead()).alias("beyond")), SPLIT)
    cut = cut.withColumn("top", F.col("before") <= F.least("ahead", "beyond"))
    # Text outside of any value begins a record unless the one before it still has an open bracket.
    begun = F.when(F.col("top") & F.col("brace"), F.col("before"))
    cut = cut.withColumn("begun", begun).withColumn("since", F.last("begun", ignorenulls=True).over(_within(order, START, -1)))
    topped = cut = stage(cut.select(*SPLIT, *order, "brace", "before", "top", "begun", "since"), "lines")
    lasts = cut.groupBy(*SPLIT).agg(F.max_by("begun", F.when(F.col("begun").isNotNull(), F.struct(*order))).alias("begun"))
    cut = cut.join(lasts.select(*SPLIT, F.last("begun", ignorenulls=True).over(_splits(START, -1)).alias("earlier")), SPLIT)
    since = F.coalesce("since", "earlier")
    begins = F.col("top") & (F.col("brace") | since.isNull() | (F.col("before") <= since))
    told = cut.select(*SPLIT, *order, F.lit(False).alias("broken"), F.lit(False).alias("head"), begins.alias("begins"))
    records = _joined(told, landed, order).filter(F.col("text").rlike(r"[^\[\],\s]"))
    records = stage(records.select("text", F.split("text", "\n").alias("lines"), FILE), "records")
    unstage(lines.sparkSession, landed.staged_at, lowest.staged_at, topped.staged_at)
    return records
