"""File readers. Schemas are explicit, CSV columns are found by name, and a
missing column fails early."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from ..columns import DATE
from ..functions.cleaning import parse_mixed_date, parse_mixed_timestamp

PANEL_SCHEMA = (f"`{DATE}` date, `WHSEID` string, `CATEGORY` string, `BRAND` string, "
                "`Total QTY` double, `Total CBM` double, `Week` string, `Day` int")
LINE_SCHEMA = f"`{DATE}` timestamp_ntz, `WHSEID` string, `SKU` string, `CATEGORY` string, `QTY` double, `CUBE_OUT` double"
FORECAST_SCHEMA = ("`date` date, `CATEGORY` string, `BRAND` string, `predicted` double, `actual` double, "
                   "`error` double, `abs_error` double")

# Patterns of dated file names, tried in this order.
REPORT_RANGE = r"Outboundreports_(\d{8})_(\d{8})"
REPORT_YEAR = r"Outboundreports_(\d{4})\d{4}_\d{8}"
DATA_YEAR = r"data_(\d{4})\.csv"
ANY_YEAR = r"(\d{4})"
ANY_YEAR_BOUNDS = (2000, 2100)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder through the Hadoop file system (local, HDFS or object store): a
    driver-side listing of names only, never of content."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def file_heads(spark: SparkSession, paths: Sequence[str], every_line: bool = False) -> DataFrame:
    """`path, head` (bytes of the first line) of each file that is not empty, from one job whatever the number of
    files. Large files are read in splits, and only those that begin a file give a row. With `every_line`, `is_utf8`
    tells whether all lines are valid UTF-8."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_block_start").alias("start"),
                                                F.monotonically_increasing_id().alias("at"))
    if not every_line:
        lines = lines.where("start = 0")
    first = F.min_by(F.when(F.col("start") == 0, F.col("value").cast("binary")), F.when(F.col("start") == 0, F.col("at"))).alias("head")
    return lines.groupBy("path").agg(first, *([F.bool_and(F.is_valid_utf8("value")).alias("is_utf8")] if every_line else []))


def _columns(head: bytes, encoding: str, sep: str, quote: str) -> tuple[str, ...]:
    text = head.decode(encoding, "replace").removeprefix("\ufeff")
    return tuple(next(csv.reader([text], delimiter=sep, quotechar=quote or None), []))


def _by_header(heads: Iterable, options: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names of their header line; one small row per file reaches the driver."""
    sep, quote = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')
    encoding = options.get("encoding", options.get("charset", "utf-8"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(heads, key=lambda r: r["path"]):
        groups.setdefault(_columns(bytes(row["head"]), encoding, sep, quote), []).append(unquote(row["path"]))
    return groups


def _typed(field: StructField, text: bool = False) -> Column:
    """A column of a CSV file; dates and times are read as text, in mixed layouts."""
    if isinstance(field.dataType, DateType):
        return parse_mixed_date(field.name).alias(field.name)
    if isinstance(field.dataType, (TimestampNTZType, TimestampType)):
        return parse_mixed_timestamp(field.name).cast(field.dataType).alias(field.name)
    value = F.col(f"`{field.name}`")
    return F.trim(value).try_cast(field.dataType).alias(field.name) if text and not isinstance(field.dataType, StringType) else value


def _unreadable(texts: dict[str, str]) -> Column:
    """Names of the columns whose text (by column of the value) is there but gave no value, comma-joined; null if none."""
    bad = F.array_compact(F.array(*[F.when((F.trim(F.col(text)) != "") & F.col(f"`{name}`").isNull(), F.lit(name)) for name, text in texts.items()]))
    return F.when(F.size(bad) > 0, F.concat_ws(",", bad))


def _read(spark: SparkSession, paths: Sequence[str], schema: str, fmt: str, path_column: str | None = None,
          unreadable: str | None = None, heads: Iterable | None = None, **options: str) -> DataFrame:
    """The columns of `schema`, for CSV by header name: files may order them differently and have
    others beside them. `path_column` adds the file of each row, `unreadable` the names of the columns of a CSV row
    that hold text which is not of their type (they are null)."""
    own = [] if path_column is None else [F.col("_metadata.file_path").alias(path_column)]
    if fmt != "csv":
        plain = spark.read.schema(schema).options(**options).format(fmt).load(list(paths)).select("*", *own)
        return plain if unreadable is None else plain.withColumn(unreadable, F.lit(None).cast("string"))
    wanted = StructType.fromDDL(schema)
    as_text = (DateType, TimestampNTZType, TimestampType)
    kinds = {f.name: StringType() if unreadable or isinstance(f.dataType, as_text) else f.dataType for f in wanted}
    if heads is None:
        heads = file_heads(spark, paths).collect()
    parts = []
    for header, files in _by_header(heads, options).items():
        missing = sorted(set(kinds) - set(header))
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {', '.join(files[:10])}")
        layout = StructType([StructField(c, kinds.get(c, StringType())) for c in header])
        rows = spark.read.schema(layout).options(**options).option("header", True).csv(files)
        if unreadable is None:
            parts.append(rows.select(*[_typed(f) for f in wanted], *own))
            continue
        # values first, then what their texts gave: each text is read once
        texts = {f.name: f"_text{k}" for k, f in enumerate(wanted) if not isinstance(f.dataType, StringType)}
        values = rows.select(*[_typed(f, True) for f in wanted], *own, *[F.col(f"`{name}`").alias(text) for name, text in texts.items()])
        parts.append(values.withColumn(unreadable, _unreadable(texts)).drop(*texts.values()))
    if not parts:
        raise FileNotFoundError(f"only empty files in {list(paths)[:10]}")
    return reduce(DataFrame.unionByName, parts)


def read_years(spark: SparkSession, folder: str, years: Iterable[int], pattern: str = "data_{year}.csv",
               schema: str = PANEL_SCHEMA, fmt: str = "csv", **options: str) -> DataFrame:
    """S1. One scan over the wanted years. A missing year is a warning, no year at all an error."""
    names = set(list_names(spark, folder))
    paths = []
    for year in years:
        name = pattern.format(year=year)
        if name in names:
            paths.append(f"{folder}/{name}")
        else:
            warnings.warn(f"no file {name} in {folder}", stacklevel=2)
    if not paths:
        raise FileNotFoundError(f"none of the wanted years in {folder}")
    return _read(spark, paths, schema, fmt, **options)


def year_of_name(name: str) -> int | None:
    """Year in a file name: report range, then yearly file, then any year in bounds."""
    import re

    for rule in (REPORT_YEAR, DATA_YEAR):
        hit = re.search(rule, name)
        if hit:
            return int(hit.group(1))
    hit = re.search(ANY_YEAR, name)
    if hit and ANY_YEAR_BOUNDS[0] <= int(hit.group(1)) <= ANY_YEAR_BOUNDS[1]:
        return int(hit.group(1))
    return None


def read_by_prefix(spark: SparkSession, folder: str, prefix: str, years: Iterable[int],
                   schema: str = LINE_SCHEMA, fmt: str = "csv", source_column: str | None = "source_file",
                   **options: str) -> DataFrame:
    """S2. Files whose name has the prefix and yields a wanted year, with the file as lineage."""
    wanted = set(years)
    paths = [f"{folder}/{n}" for n in list_names(spark, folder)
             if n.startswith(prefix) and year_of_name(n) in wanted]
    if not paths:
        raise FileNotFoundError(f"no file {prefix}* for {sorted(wanted)} in {folder}")
    return _read(spark, paths, schema, fmt, source_column, **options)


def prune_files_by_range(files: DataFrame, start: str, end: str, name: str = "name") -> DataFrame:
    """S3. Keep names whose range overlaps [start, end]; names without a readable range are
    kept if they hold the start year."""
    def part(i: int):
        return F.to_date(F.try_to_timestamp(F.regexp_extract(name, REPORT_RANGE, i), F.lit("yyyyMMdd")))

    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    dated = part(1).isNotNull() & part(2).isNotNull()
    keep = F.when(dated, (part(2) >= lo) & (part(1) <= hi)).otherwise(
        F.contains(F.col(name), F.date_format(lo, "yyyy")))
    return files.filter(keep)


def read_date_range(spark: SparkSession, folder: str, start: str, end: str, prefix: str = "Outboundreports",
                    schema: str = LINE_SCHEMA, date: str = DATE, fmt: str = "csv", **options: str) -> DataFrame:
    """S4. Only files whose name can hold the range are read; rows are filtered by day."""
    names = [n for n in list_names(spark, folder) if n.startswith(prefix)]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    kept = sorted(r["name"] for r in prune_files_by_range(table, start, end).collect())
    if not kept:
        raise FileNotFoundError(f"no {prefix}* file for {start}..{end} in {folder}")
    rows = _read(spark, [f"{folder}/{n}" for n in kept], schema, fmt, **options)
    return rows_in_range(rows, start, end, date)


def rows_in_range(df: DataFrame, start: str, end: str, ts: str = DATE) -> DataFrame:
    """S4. Inclusive range of days on a timestamp column as a half-open comparison, which
    the file scan can use."""
    lo = F.lit(start).cast("date").cast("timestamp_ntz")
    hi = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


# Encodings in the order they are tried.
ENCODINGS = ("utf-8", "latin-1", "cp1252")
SINGLE_BYTE = {"latin-1": "ISO-8859-1", "cp1252": "windows-1252"}


def detect_encodings(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S5. `path, is_utf8` per file that is not empty, found by Spark line by line: the text source hands over
    the bytes of a line as they are, and each line is tested for valid UTF-8."""
    return file_heads(spark, paths, every_line=True).select("path", "is_utf8")


def read_csv_with_encoding(spark: SparkSession, paths: Sequence[str], schema: str,
                           encodings: Sequence[str] = ENCODINGS, **options: str) -> DataFrame:
    """S5. Files that are valid UTF-8 are read as such, the others with the next encoding of
    the list. Single-byte encodings accept every byte, so a third one is never reached. Encodings and
    headers come from one job; an encoding shows only in the whole file, which is why it is read through."""
    others = [e for e in encodings if e.lower().replace("_", "-") not in ("utf-8", "utf8")]
    found = file_heads(spark, paths, every_line=True).collect()  # one small row per file
    if not others and any(not r["is_utf8"] for r in found):
        raise ValueError("some files are not valid UTF-8 and no other encoding is allowed")
    groups = {"UTF-8": [r for r in found if r["is_utf8"]]}
    if others:
        groups[SINGLE_BYTE.get(others[0], others[0])] = [r for r in found if not r["is_utf8"]]
    parts = [_read(spark, [], schema, "csv", heads=heads, encoding=encoding, **options) for encoding, heads in groups.items() if heads]
    if not parts:
        raise FileNotFoundError(f"nothing to read in {list(paths)}")
    return reduce(DataFrame.unionByName, parts)


# Run folders and the file of each mode.
RUN_FOLDER = r"run_(\d{8}_\d{6})"
MODE_PREFIX = "predictions_"


def read_runs(spark: SparkSession, base: str, schema: str, fmt: str = "csv",
              pattern: str = f"run_*/{MODE_PREFIX}*", **options: str) -> DataFrame:
    """S12. Stored forecast rows of every run, tagged with run id, run time and mode taken from
    the path `run_YYYYMMDD_HHMMSS/predictions_<mode>…`."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{pattern}")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    paths = sorted(s.getPath().toString() for s in found)
    if not paths:
        raise FileNotFoundError(f"no runs in {base}")
    rows = _read(spark, paths, schema, fmt, "_path", **options)
    path = F.col("_path")
    stamp = F.regexp_extract(path, RUN_FOLDER, 1)
    return rows.select("*", *[c.alias(name) for name, c in {
        "run_id": F.concat(F.lit("run_"), stamp),
        "run_time": F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz"),
        "mode": F.regexp_extract(path, MODE_PREFIX + r"([a-z_]+?)(?:\.csv|\.parquet|/)", 1)}.items()]).drop("_path")
