"""Readers for text layouts: column ranges, regex, delimited, nested
delimiters, key/value lines, byte offsets, N-line batches, whole files,
path globs and path filters, sequence files, CSV imports.

All readers return DataFrames; parsing is Column expressions over
``spark.read.text`` so it runs inside the scan's codegen stage.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import quoted

# --- column ranges -------------------------------------------------------------

_RANGE = re.compile(r"^\s*(\d+)\s*(?:-\s*(\d+))?\s*$")


def parse_ranges(spec: str) -> list[tuple[int, int]]:
    """'16-19,88-92,93-93' -> [(16, 19), (88, 92), (93, 93)] (1-based, inclusive).

    A single column may be written alone ('93').  Malformed specs raise.
    """
    out = []
    for part in spec.split(","):
        m = _RANGE.match(part)
        if not m:
            raise ValueError(f"bad column range {part!r} in {spec!r}")
        start = int(m.group(1))
        end = int(m.group(2) or start)
        if start < 1 or end < start:
            raise ValueError(f"bad column range {part!r} in {spec!r}")
        out.append((start, end))
    return out


def cut_columns(line: Column, spec: str, schema: T.StructType) -> list[Column]:
    """One typed column per range; a range past the line end is null."""
    ranges = parse_ranges(spec)
    if len(ranges) != len(schema.fields):
        raise ValueError("spec and schema have different widths")
    cols = []
    for (start, end), f in zip(ranges, schema.fields):
        raw = F.when(F.length(line) >= end, F.substring(line, start, end - start + 1))
        val = raw if isinstance(f.dataType, T.StringType) else F.trim(raw).try_cast(f.dataType)
        cols.append(val.alias(f.name))
    return cols


def load_cut(spark: SparkSession, path: str, spec: str, schema: T.StructType) -> DataFrame:
    """Fixed column-range loader."""
    lines = spark.read.text(path)
    return lines.select(*cut_columns(F.col("value"), spec, schema))


# --- regex ------------------------------------------------------------------

def regex_columns(line: Column, regex: str, schema: T.StructType) -> list[Column]:
    """Capture group i -> field i; a non-matching line gives all nulls."""
    full = f"^(?:{regex})\\z"
    hit = line.rlike(full)
    cols = []
    for i, f in enumerate(schema.fields, start=1):
        raw = F.when(hit, F.regexp_extract(line, full, i))
        val = raw if isinstance(f.dataType, T.StringType) else raw.try_cast(f.dataType)
        cols.append(val.alias(f.name))
    return cols


def load_regex(spark: SparkSession, path: str, regex: str, schema: T.StructType) -> DataFrame:
    return spark.read.text(path).select(*regex_columns(F.col("value"), regex, schema))


# --- delimited -----------------------------------------------------------------

def load_delimited(spark: SparkSession, path: str, sep: str = "\t",
                   schema: T.StructType | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Delimited text without quoting: a quote is a character like any other
    and an empty string stays one.  With a schema, a value that does not cast
    is null and a short row is padded with nulls (the row stays).  Without
    one, fields are strings named ``_c0, _c1, ...`` (or ``names``), as many as
    the first line has."""
    lines = spark.read.text(path)
    parts = F.split("value", quoted(sep), -1)
    if schema is None:
        first = lines.select(F.size(parts).alias("n")).first()
        names = [*(names or [])]
        names += [f"_c{i}" for i in range(len(names), first.n if first else 0)]
        return lines.select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)])
    return lines.select(*[_typed(F.get(parts, i), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def _typed(raw: Column, to: T.DataType) -> Column:
    return raw if isinstance(to, T.StringType) else raw.try_cast(to)


def nested_columns(line: Column, spec: Sequence[tuple[str, str, str]]) -> list[Column]:
    """Parse ``\\x01`` fields with ``\\x02`` items and ``\\x03`` map keys.

    ``spec`` lists (name, kind, element type) with kind one of 'scalar',
    'array', 'map', 'struct:<f1>,<f2>,...' (struct field names).
    """
    fields = F.split(line, "\x01")
    out = []
    for i, (name, kind, etype) in enumerate(spec):
        raw = F.get(fields, i)
        if kind == "scalar":
            col = raw.try_cast(etype) if etype != "string" else raw
        elif kind == "array":
            col = F.transform(F.split(raw, "\x02"), lambda x: x.try_cast(etype))
        elif kind == "map":
            col = F.transform_values(F.str_to_map(raw, F.lit("\x02"), F.lit("\x03")),
                                     lambda k, v: v.try_cast(etype))
        elif kind.startswith("struct:"):
            names = kind.split(":", 1)[1].split(",")
            types = etype.split(",")
            items = F.split(raw, "\x02")
            col = F.struct(*[(F.get(items, j).try_cast(t) if t != "string" else F.get(items, j))
                             .alias(n) for j, (n, t) in enumerate(zip(names, types))])
        else:
            raise ValueError(f"unknown kind {kind}")
        out.append(col.alias(name))
    return out


def render_nested(cols: Sequence[Column]) -> Column:
    """Inverse of :func:`nested_columns` for array/map/struct/scalar values."""
    return F.concat_ws("\x01", *cols)


# --- line-oriented Hadoop formats -------------------------------------------------

def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split and place; a carriage return before the line feed is in ``raw`` only."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").alias("raw"), F.monotonically_increasing_id().alias("place"))
            .withColumn("line", F.regexp_replace("raw", r"\r$", "")))


def _before_in_file(lines: DataFrame, amount: Column, name: str) -> DataFrame:
    """``name``: the sum of ``amount`` over all earlier lines of the file, in two levels.

    Splits of a file follow each other and each is read by one task, so a
    running sum inside the split and one total for each split are enough; a
    file's lines are never sorted as a whole.
    """
    inner = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (lines.groupBy("file", "block").agg(F.sum(amount).alias("_total"))
              .select("file", "block", F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_start")))
    return (lines.withColumn("_inner", F.coalesce(F.sum(amount).over(inner), F.lit(0))).join(totals, ["file", "block"])
            .withColumn(name, (F.col("_start") + F.col("_inner")).cast("long")).drop("_start", "_inner"))


def lines_with_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(offset, line): byte offset of each line within its file."""
    lines = _placed_lines(spark, path)
    return _before_in_file(lines, F.octet_length("raw") + 1, "offset").select("offset", "line")


def key_value_lines(lines: DataFrame, col: str = "value", sep: str = "\t") -> DataFrame:
    """Split each line at the first separator: (key, value); no separator ->
    the whole line is the key and the value is empty."""
    parts = F.split(F.col(col), quoted(sep), 2)
    return lines.select(F.get(parts, 0).alias("key"),
                        F.coalesce(F.get(parts, 1), F.lit("")).alias("value"))


def n_line_batches(spark: SparkSession, path: str, n: int) -> DataFrame:
    """(file, batch, line_no, line): consecutive groups of ``n`` lines of one file.

    Lines and batches are numbered from 0 in each file; rows are then
    hash-partitioned by file and batch, so each batch is one unit of work.
    """
    lines = _before_in_file(_placed_lines(spark, path), F.lit(1), "line_no")
    return (lines.withColumn("batch", F.floor(F.col("line_no") / n).cast("long"))
            .repartition("file", "batch").select("file", "batch", "line_no", "line"))


def whole_files(spark: SparkSession, path: str, as_text: bool = True) -> DataFrame:
    """(path, content): one record per file, never split."""
    df = spark.read.format("binaryFile").load(path)
    content = F.col("content").cast("string") if as_text else F.col("content")
    return df.select("path", content.alias("content"), "length")


def path_filter(df: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Keep rows whose file path matches ``include`` and not ``exclude``."""
    p = F.col("_metadata.file_path")
    cond = F.lit(True)
    if include:
        cond = cond & p.rlike(include)
    if exclude:
        cond = cond & ~p.rlike(exclude)
    return df.where(cond)


def date_in_path(pattern: str = r"(\d{4})/(\d{2})/(\d{2})") -> Column:
    """Date encoded in the file path as yyyy/MM/dd (null if absent)."""
    p = F.col("_metadata.file_path")
    return F.try_to_date(F.concat_ws("-", F.regexp_extract(p, pattern, 1),
                                     F.regexp_extract(p, pattern, 2),
                                     F.regexp_extract(p, pattern, 3)), "yyyy-MM-dd")


def date_range_filter(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of files whose path date lies in [start, end] (both inclusive)."""
    d = date_in_path()
    return df.where(d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def partition_date_range(df: DataFrame, start: str, end: str, year: str = "y", month: str = "m",
                         day: str = "d") -> DataFrame:
    """Rows dated in [start, end] under year and month folders.

    The folder columns get a predicate of their own (year * 100 + month), so
    folders outside the range are pruned at planning; the day is compared in
    the files that are left.
    """
    (y1, m1, _), (y2, m2, _) = (map(int, s.split("-")) for s in (start, end))
    folder = F.col(year) * 100 + F.col(month)
    date = F.make_date(F.col(year).cast("int"), F.col(month).cast("int"), F.col(day).cast("int"))
    return df.where(folder.between(y1 * 100 + m1, y2 * 100 + m2)).where(
        date.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def sequence_file(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """(key, value) pairs of a SequenceFile as a DataFrame."""
    rdd = spark.sparkContext.sequenceFile(path)
    return rdd.toDF([key, value])


# --- imported CSV ------------------------------------------------------------

def parse_import_csv(spark: SparkSession, path: str, schema: T.StructType,
                     sep: str = ",") -> DataFrame:
    """Text written by a table import, without quoting.

    The literal ``null`` means null for strings, and an empty string stays
    empty; an empty field means null for non-strings; a row with a value that
    does not cast is skipped.
    """
    parts = F.split("value", quoted(sep), -1)
    cols, ok = [], F.lit(True)
    for i, f in enumerate(schema.fields):
        c = F.get(parts, i)
        if isinstance(f.dataType, T.StringType):
            cols.append(F.when(c != "null", c).alias(f.name))
            continue
        v = F.when((c != "") & (c != "null"), c)
        typed = v.try_cast(f.dataType)
        ok = ok & (v.isNull() | typed.isNotNull())
        cols.append(typed.alias(f.name))
    return spark.read.text(path).where(ok).select(*cols)
