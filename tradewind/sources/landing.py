"""Files landed per entity, read as rows to be matched by column name."""

from __future__ import annotations

import csv
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.casts import null_tokens, quoted
from tradewind.session import stage, unstage
from tradewind.sources.framing import FILE, csv_records, depths, json_records, lines_of, opens_quotes

PAYLOAD = "raw_payload"
#: True for what was landed where a JSON object should be; its payload holds the text.
UNREADABLE = "_unreadable"


@dataclass(frozen=True)
class EntitySource:
    """Where the files of one entity land, and in which format (csv, json or parquet)."""

    name: str
    path: str
    file_format: str = "csv"


def entity_sources(root: str, formats: dict[str, str]) -> dict[str, EntitySource]:
    """One folder per entity under a common root."""
    return {n: EntitySource(n, f"{root.rstrip('/')}/{n}", f) for n, f in formats.items()}


def list_files(spark: SparkSession, source: EntitySource) -> DataFrame:
    """Files under the entity's folder; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source.path)
    return found.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_last_modified"),
        F.col("path").alias("load_path"),
    )


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumn(FILE, F.col("_metadata.file_path"))


# --- layouts ------------------------------------------------------------------------------------

CSV, JSON, PARQUET = "csv", "json", "parquet"


@dataclass(frozen=True)
class Layout:
    """What one look at a set of files found out; rows are then read in a single pass.

    ``groups`` holds (header, files, where their records are staged if these span lines) for CSV. JSON payloads are staged
    at ``staged`` and have the top-level ``keys``. :func:`forget` removes what is staged.
    """

    file_format: str
    paths: dict[str, str]
    groups: tuple = ()
    keys: tuple = ()
    staged: str | None = None


def forget(spark: SparkSession, layout: Layout) -> None:
    unstage(spark, *[at for at in (layout.staged, *[g[2] for g in layout.groups]) if at])


def look_at(spark: SparkSession, file_format: str, paths: dict[str, str]) -> Layout:
    """Layout of landed files; ``paths`` maps the reported path of a file to the path to load."""
    if file_format == CSV:
        found = _csv_headers(spark, list(paths.values()))
        framed = lambda files: csv_records(lines_of(spark, [paths[f] for f in files])).staged_at
        return Layout(CSV, paths, tuple((header, files, framed(files) if spans else None) for header, files, spans in found))
    if file_format == JSON:
        return _json_layout(spark, paths)
    if file_format == PARQUET:
        return Layout(PARQUET, paths)
    raise ValueError(f"unknown format {file_format}")


def rows_of(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows with their file path: columns in lower case, as text (typed, for Parquet)."""
    return {CSV: _csv_rows, JSON: _json_rows, PARQUET: _parquet_rows}[layout.file_format](spark, layout)


def scan(spark: SparkSession, file_format: str, paths: dict[str, str]) -> DataFrame:
    return rows_of(spark, look_at(spark, file_format, paths))


# --- csv ----------------------------------------------------------------------------------------


def _csv_headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, tuple[str, ...], bool]]:
    """Files by header line and layout, found by one scan that keeps one line per file.

    The header is the first line that is not blank. Where a quoted field opens in a line and doesn't end there, records
    may span lines and are framed over the lines of all splits. Repeated names, or none, raise an error.
    """
    lines = lines_of(spark, paths)
    head = F.min_by("value", F.when((F.col("start") == 0) & F.col("value").rlike(r"\S"), F.col("at")))
    first = lines.groupBy(FILE).agg(head.alias("header"), F.bool_or(opens_quotes(F.col("value"))).alias("spans"))
    groups = defaultdict(list)
    for row in first.filter("header is not null").collect():
        groups[row["header"], row["spans"]].append(row[FILE])
    found = [(header, tuple(sorted(files)), spans) for (header, spans), files in sorted(groups.items())]
    for header, files, _ in found:
        names = [n for n in _names(header) if n]
        if not names:
            raise ValueError(f"no column has a name in the header of {', '.join(files)}")
        if len(set(names)) < len(names):
            raise ValueError(f"a column name stands twice in the header of {', '.join(files)}: {header}")
    if not found:
        raise ValueError("no columns inferred: no file has a header line")
    return found


def _names(header: str) -> list[str]:
    return [n.strip().lower() for n in next(csv.reader([header]))]


def _read_csv(spark: SparkSession, header: str, paths: list[str], staged: str | None) -> DataFrame:
    names = _names(header)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    options = {
        "sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
    }
    columns = [null_tokens(f"c{i}").alias(n) for i, n in enumerate(names) if n]
    if not staged:
        rows = _with_file(spark.read.schema(schema).csv(paths, header=True, enforceSchema=True, **options))
        return rows.select(*columns, F.lit(False).alias(UNREADABLE), FILE)
    records = spark.read.parquet(staged).filter(~F.col("head") & F.col("text").rlike(r"\S"))
    parsed = F.when(~F.col("broken"), F.from_csv("text", schema.simpleString()[len("struct<"):-1].replace(":", " "), options))
    return records.select(parsed.alias("row"), F.col("broken").alias(UNREADABLE), FILE).select("row.*", UNREADABLE, FILE).select(*columns, UNREADABLE, FILE)


def _csv_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """Trimmed text columns by name, whatever header a file has; short and long rows are accepted.

    A record whose quoted field never ends is one unreadable row.
    """
    parts = [_read_csv(spark, h, [layout.paths[f] for f in files], staged) for h, files, staged in layout.groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# --- json ---------------------------------------------------------------------------------------

def _elements(text: Column) -> Column:
    """Every value in a text of values between commas, those of arrays one by one; null where anything else stands in it."""
    parsed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    values = F.try_variant_get(parsed, "$", "array<variant>")
    return F.flatten(F.transform(values, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))))


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def _as_payloads(found: DataFrame) -> DataFrame:
    """One row per value of ``values``; what is no object, or a ``text`` without values, is kept as unreadable."""
    rows = found.select(F.explode_outer("values").alias("value"), "text", FILE)
    bad = ~F.coalesce(_is_object(F.col("value")), F.lit(False))
    kept = F.parse_json(F.to_json(F.struct(F.coalesce(F.to_json("value"), "text").alias("unreadable"))))
    return rows.select(F.when(bad, kept).otherwise(F.col("value")).alias("payload"), bad.alias(UNREADABLE), FILE)


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s,]+|[\s,]+$", "")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines that hold more than the brackets and commas of an array around them."""
    lines = lines_of(spark, paths).select(_trimmed(F.col("value")).alias("text"), FILE)
    return lines.filter(~F.col("text").isin("", "[", "]"))


def _line_values(text: Column) -> Column:
    """The values of a text, which may be the first or last one of an array that goes on over other lines."""
    opened = F.regexp_replace(text, r"^\[\s*(?=\{)", "")
    closed = F.regexp_replace(text, r"(?<=\})\s*\]$", "")
    return F.coalesce(_elements(text), _elements(opened), _elements(closed))


def _line_payloads(spark: SparkSession, paths: list[str]) -> DataFrame:
    return _as_payloads(_lines(spark, paths).select(_line_values(F.col("text")).alias("values"), "text", FILE))


def _framed_payloads(records: DataFrame) -> DataFrame:
    """Values that span lines. Of a text that is none, the lines that are objects count, and all others together as one."""
    records = records.select(_trimmed(F.col("text")).alias("text"), "lines", FILE)
    values = _line_values(F.col("text"))
    none = F.array(F.lit(None).cast("variant"))

    def objects(line: Column) -> Column:
        found = _line_values(_trimmed(line))
        return F.when(F.forall(found, _is_object), found).otherwise(F.array().cast("array<variant>"))

    rescued = F.flatten(F.transform("lines", lambda line: F.coalesce(objects(line), F.array().cast("array<variant>"))))
    return _as_payloads(records.select(F.coalesce(values, F.concat(rescued, none)).alias("values"), "text", FILE))


def _json_layout(spark: SparkSession, paths: dict[str, str]) -> Layout:
    """Files whose every line closes what it opens are read line by line, others by records framed over lines.

    Either way a file is split over tasks, and what cannot be read is a rejected row. A file without any
    object raises an error.
    """
    shape = depths(F.col("text"))
    own = (shape["rise"] == 0) & (shape["dip"] == 0)
    told = {r[FILE]: r["own"] for r in _lines(spark, list(paths.values())).groupBy(FILE).agg(F.bool_and(own).alias("own")).collect()}
    lines = tuple(f for f in paths if told.get(f))
    framed = tuple(f for f in paths if f in told and not told[f])
    parts = [_line_payloads(spark, [paths[f] for f in lines])] if lines else []
    if framed:
        records = json_records(lines_of(spark, [paths[f] for f in framed]))
        parts.append(_framed_payloads(records))
    if not parts:
        raise ValueError("no columns inferred: no objects found")
    held = stage(reduce(DataFrame.unionByName, parts), "payloads")
    if framed:
        unstage(spark, records.staged_at)
    payloads = held.select(
        F.explode_outer(F.when(~F.col(UNREADABLE), F.json_object_keys(F.to_json("payload")))).alias("key"), F.col(UNREADABLE).alias("bad"), FILE
    )
    found = payloads.groupBy(FILE).agg(F.collect_set("key").alias("keys"), F.bool_and("bad").alias("bad")).collect()
    for row in found:
        if row["bad"]:
            unstage(spark, held.staged_at)
            raise ValueError(f"no object can be read from {row[FILE]}")
    keys = {key for row in found for key in row["keys"]}
    if not keys:
        raise ValueError("no columns inferred: no objects found")
    return Layout(JSON, paths, (), tuple(sorted(keys)), held.staged_at)


def json_payloads(spark: SparkSession, layout: Layout) -> DataFrame:
    """One variant per JSON object, and one per text that should have been one."""
    return spark.read.schema(f"payload variant, {UNREADABLE} boolean, {FILE} string").parquet(layout.staged)


def _json_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """Text columns per top-level key, whatever characters it has, next to the whole payload; keys that differ in case are one column."""
    spellings = defaultdict(list)
    for key in layout.keys:
        spellings[key.lower()].append(key)
    texts = F.when(~F.col(UNREADABLE), F.from_json(F.to_json("payload"), "map<string,string>"))
    rows = json_payloads(spark, layout).withColumn("_texts", texts)
    columns = [F.coalesce(*[F.try_element_at("_texts", F.lit(k)) for k in keys]).alias(name) for name, keys in sorted(spellings.items())]
    return rows.select(*columns, F.col("payload").alias(PAYLOAD), UNREADABLE, FILE)


# --- parquet ------------------------------------------------------------------------------------


def _parquet_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """The union of the files' schemas."""
    rows = spark.read.option("mergeSchema", True).parquet(*layout.paths.values())
    names = rows.columns
    return _with_file(rows).select(*[F.col(quoted(n)).alias(n.lower()) for n in names], FILE)


# --- types --------------------------------------------------------------------------------------

# Types tried on text in this order; the first that fits every value is taken.
TEXT_TYPES = ["bigint", "decimal(38,0)", "decimal(38,10)", "double", "date", "timestamp_ntz", "boolean"]


# Shape a text must have on top of casting. Leading zeros mark a code, not a number. A double
# must not lose digits: it has an exponent, or at most 15 digits.
_SHAPES = {
    "bigint": "^[+-]?(0|[1-9][0-9]*)$",
    "decimal(38,0)": "^[+-]?(0|[1-9][0-9]{0,37})$",
    "decimal(38,10)": r"^[+-]?(0|[1-9][0-9]{0,27})?(\.[0-9]{0,10})?$",
    "double": r"^[+-]?((?=.*[eE])|(?=([^0-9]*[0-9]){1,15}[^0-9]*$))(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][+-]?[0-9]+)?$",
    "date": "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "timestamp_ntz": "^[0-9]{4}-",
    "boolean": "(?i)^(true|false)$",
}


def _fits(column: Column, datatype: str) -> Column:
    return column.rlike(_SHAPES[datatype]) & column.try_cast(datatype).isNotNull()


@dataclass(frozen=True)
class Columns:
    """New columns with the type they fit, and held ones none of whose values fits theirs."""

    added: list[T.StructField]
    changed: list[T.StructField]


def compare_columns(rows: DataFrame, held: list[T.StructField]) -> Columns:
    """Types of columns not ``held`` and misfits of the held ones, over all rows in one pass.

    A new text column gets the first type that fits every non-null value.
    """
    known = {f.name.lower(): f for f in held}
    fresh = [c for c in rows.columns if c not in known and c not in (FILE, PAYLOAD, UNREADABLE)]
    texts = [c for c in fresh if isinstance(rows.schema[c].dataType, T.StringType)]
    typed = [
        f for name, f in known.items()
        if name in rows.columns and not isinstance(f.dataType, (T.StringType, T.VariantType))
    ]
    measures = []
    for i, name in enumerate(texts):
        column = F.col(quoted(name))
        measures.append(F.count(column).alias(f"n{i}"))
        for j, datatype in enumerate(TEXT_TYPES):
            measures.append(F.count_if(column.isNotNull() & ~_fits(column, datatype)).alias(f"n{i}_{j}"))
    for i, field in enumerate(typed):
        column = F.col(quoted(field.name.lower()))
        measures.append(F.count(column).alias(f"held{i}"))
        measures.append(F.count(column.try_cast(field.dataType)).alias(f"fit{i}"))
    found = rows.agg(*measures).first() if measures else None
    added = []
    for name in fresh:
        datatype = safe_type(rows.schema[name].dataType)
        if name in texts:
            i = texts.index(name)
            fitting = [t for j, t in enumerate(TEXT_TYPES) if found[f"n{i}"] and not found[f"n{i}_{j}"]]
            datatype = T.DataType.fromDDL(fitting[0]) if fitting else T.StringType()
        added.append(T.StructField(name, datatype))
    changed = [f for i, f in enumerate(typed) if found[f"held{i}"] and not found[f"fit{i}"]]
    return Columns(added, changed)


_KEPT = (
    T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType, T.TimestampType, T.BinaryType,
    T.DecimalType, T.LongType, T.DoubleType, T.VariantType,
)


def safe_type(datatype: T.DataType) -> T.DataType:
    """Type a new column is stored as; text for anything unknown, so no column is refused."""
    if isinstance(datatype, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(datatype, T.FloatType):
        return T.DoubleType()
    if isinstance(datatype, (T.StructType, T.ArrayType, T.MapType)):
        return T.VariantType()
    return datatype if isinstance(datatype, _KEPT) else T.StringType()
