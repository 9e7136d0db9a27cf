"""Landing files: discovery, layout detection, delimited and Parquet readers.

Files are read where they are, many per job. Nothing is downloaded to the driver; the driver only sees one
short row per file (its path and header), which it needs to build the read.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierline.operators.shape import coalesce_aliases, normalized_names, remap_columns

# Candidate delimiters in tie-break order, accepted extensions, folders already dealt with.
DELIMITERS = ("~", ",", ";", "|", "\t")
EXTENSIONS = ("csv", "parquet")
DONE_FOLDERS = ("processed", "failed", "invalid", "original")
OTHER_DOMAINS = ("settlement", "agreement", "rating", "activation", "traffic", "forecast")

SOURCE_PATH = "_source_path"
# The columns of a row's own file, as ``|a|b|``; and the text of a delimited row that its header does not fit.
SOURCE_COLUMNS, SOURCE_TEXT = "_source_columns", "_source_text"
SOURCE = (SOURCE_PATH, SOURCE_COLUMNS, SOURCE_TEXT)
# Why a row of a typed read is not taken: the columns that cannot be read, ``cells`` for too many or too few; NULL for a good row.
SOURCE_REASON = "_source_reason"
#: Files whose headers are read by one job.
HEADERS_AT_ONCE = 64


def tenant_of(path: Column) -> Column:
    return F.regexp_extract(F.lower(path), r"/tenant/([^/]+)/", 1)


def landing_filter(path: Column, domain: str, layer: str) -> Column:
    """True for data files of the domain and layer that have not been processed yet."""
    low = F.lower(path)
    others = "|".join(d for d in OTHER_DOMAINS if d != domain)
    return (
        low.rlike(rf"/tenant/[^/]+/{layer}/{domain}/")
        & low.rlike(rf"\.({'|'.join(EXTENSIONS)})$")
        & ~low.rlike(rf"/({'|'.join(DONE_FOLDERS)})/")
        & ~low.rlike(rf"/({others})/")
    )


def discover_files(spark: SparkSession, root: str, domain: str, layer: str) -> DataFrame:
    """One row per landed file: path, tenant, size. Names are matched case-insensitively.

    The content column is never selected, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.filter(landing_filter(F.col("path"), domain.lower(), layer.lower())).select(
        "path", tenant_of(F.col("path")).alias("tenant"), F.col("length").alias("size")
    )


def _readable(path: str) -> str:
    """A path as readers take it: they list their files URL-encoded, and take some characters of a path for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def _files_of(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files under some paths; listed, not read."""
    return sorted(_readable(f) for f in spark.read.text(list(paths)).inputFiles()) if paths else []


def _first_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """path and first non-blank line of some files.

    One task per file with a limit of its own, which stops the reader after that line, so the cost is a few kilobytes per file however
    large the files are; a Python function that returns early would not stop it. The plan has a branch for each file. The
    settings live in a session of their own and leave the caller's untouched.
    """
    if not files:
        return spark.createDataFrame([], "path string, header string")
    probe = spark.newSession()
    one_file_per_task = str(1 << 40)
    probe.conf.set("spark.sql.files.maxPartitionBytes", one_file_per_task)
    frames = []
    for path in files:
        # One split already: said again, so that the limit needs no shuffle.
        lines = probe.read.text(path).select("value", F.col("_metadata.file_path").alias("path")).coalesce(1)
        frames.append(lines.filter(F.btrim("value", F.lit("\ufeff \t\r")) != "").limit(1))
    return reduce(DataFrame.union, frames).select("path", F.regexp_replace("value", "^\ufeff", "").alias("header"))


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """First non-blank line of every file under some paths."""
    return _first_lines(spark, _files_of(spark, paths))


def delimiter_of(header: Column) -> Column:
    """The delimiter that occurs most often; on a tie the earlier in :data:`DELIMITERS`; ``,`` for none."""
    scores = [
        F.struct(
            F.coalesce(F.length(header) - F.length(F.translate(header, d, "")), F.lit(0)).alias("hits"),
            F.lit(-rank).alias("rank"),
            F.lit(d).alias("delimiter"),
        )
        for rank, d in enumerate(DELIMITERS)
    ]
    best = F.greatest(*scores)
    return F.when(F.trim(F.coalesce(header, F.lit(""))) == "", ",").otherwise(best["delimiter"])


def detect_layouts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, header, delimiter per file."""
    return _with_delimiter(header_lines(spark, paths))


def _with_delimiter(lines: DataFrame) -> DataFrame:
    return lines.withColumn("delimiter", delimiter_of(F.col("header")))


def files_by_layout(spark: SparkSession, paths: Sequence[str]) -> list[tuple[tuple[str, str], list[str]]]:
    """((delimiter, header), files) in order: a job for every ``HEADERS_AT_ONCE`` files, of which the driver sees a short row each."""
    by_layout = defaultdict(list)
    files = _files_of(spark, paths)
    for start in range(0, len(files), HEADERS_AT_ONCE):
        for row in _with_delimiter(_first_lines(spark, files[start : start + HEADERS_AT_ONCE])).collect():
            by_layout[row["delimiter"], row["header"]].append(_readable(row["path"]))
    return sorted(by_layout.items())


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    renames: Mapping[str, str] | None = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
    multi_line: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Delimited files as text columns named by their normalised headers, plus the columns of :data:`SOURCE`.

    Files sharing delimiter and header are read together, so a drop of any size is a handful of scans.
    ``renames`` maps exact source headers. ``aliases`` gives every layout its target names before layouts are united, so
    what a file's columns become does not depend on the files beside it. Values stay text: inference would lose leading
    zeros. A row with more or fewer cells than its header keeps its text in :data:`SOURCE_TEXT`, else NULL.
    """
    frames = [
        _read_layout(spark, files, header, delimiter, renames or {}, aliases, multi_line, mode)
        for (delimiter, header), files in files_by_layout(spark, paths)
    ]
    return _union(spark, frames)


def _read_layout(spark, files, header, delimiter, renames, aliases, multi_line, mode) -> DataFrame:
    titles = next(csv.reader([header], delimiter=delimiter))
    names = normalized_names([renames.get(t, t) for t in titles])
    schema = StructType([StructField(n, StringType()) for n in [*names, SOURCE_TEXT]])
    reader = spark.read.schema(schema).options(
        header=True, sep=delimiter, quote='"', escape='"', multiLine=multi_line, mode=mode,
        columnNameOfCorruptRecord=SOURCE_TEXT, columnPruning=False,
    )
    rows = reader.csv(files).select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))
    return _with_layout(rows, aliases, remap_columns)


def _with_layout(rows: DataFrame, aliases, rename) -> DataFrame:
    own = [c for c in rows.columns if c not in SOURCE]
    named = rename(rows, aliases) if aliases else rows
    offered = [c for c in named.columns if c not in SOURCE] if aliases else own
    return named.withColumn(SOURCE_COLUMNS, F.lit("|" + "|".join(offered) + "|"))


def read_parquet(
    spark: SparkSession, paths: Sequence[str], aliases: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Parquet files, columns merged by name, plus the columns of :data:`SOURCE`.

    A column that a file lacks is NULL in its rows, so ``aliases`` take the first that is filled, row by row.
    """
    frame = spark.read.option("mergeSchema", True).parquet(*paths)
    names = normalized_names(frame.columns)
    rows = frame.select("*", F.col("_metadata.file_path")).toDF(*names, SOURCE_PATH)
    return _with_layout(rows.withColumn(SOURCE_TEXT, F.lit(None).cast("string")), aliases, coalesce_aliases)


def read_files(spark: SparkSession, paths: Iterable[str], **options) -> DataFrame:
    """A mixed drop. Everything becomes text, which is what bronze stores."""
    paths = list(paths)
    aliases = options.get("aliases")
    delimited = [p for p in paths if p.lower().endswith(".csv")]
    columnar = [p for p in paths if p.lower().endswith(".parquet")]
    frames = []
    if delimited:
        frames.append(read_delimited(spark, delimited, **options))
    if columnar:
        frame = read_parquet(spark, columnar, aliases)
        frames.append(frame.select([F.col(c).cast("string").alias(c) for c in frame.columns]))
    return _union(spark, frames)


def read_typed(spark: SparkSession, paths: Sequence[str], schema: StructType, delimiter: str = ",") -> DataFrame:
    """Delimited files of a fixed layout: the first value that does not fit its type fails the read."""
    reader = spark.read.schema(schema).options(header=True, sep=delimiter, nullValue="", mode="FAILFAST")
    return reader.csv(list(paths))


def read_rescued(
    spark: SparkSession, paths: Sequence[str], types: Mapping[str, str], *, multi_line: bool = False
) -> DataFrame:
    """Delimited files parsed once, straight into types; a row that does not fit keeps its text and gets a reason.

    Columns are the normalised headers of each layout, text where ``types`` does not name them, beside the path, the text of a
    row that cannot be read (:data:`SOURCE_TEXT`) and :data:`SOURCE_REASON`. An empty cell is NULL. The text of a bad row is
    taken apart again to name its columns; good rows, nearly all, are parsed by the reader alone.
    """
    frames = [
        _rescued_layout(spark, files, header, delimiter, types, multi_line) for (delimiter, header), files in files_by_layout(spark, paths)
    ]
    if frames:
        return _union(spark, frames)
    none = ", ".join(f"{c} {t}" for c, t in types.items())
    return spark.createDataFrame([], f"{none}, {SOURCE_TEXT} string, {SOURCE_PATH} string, {SOURCE_REASON} string")


def _rescued_layout(spark, files, header, delimiter, types, multi_line) -> DataFrame:
    names = normalized_names(next(csv.reader([header], delimiter=delimiter)))
    schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
    options = {"sep": delimiter, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": SOURCE_TEXT}
    reader = spark.read.schema(f"{schema}, {SOURCE_TEXT} string").options(
        header=True, multiLine=multi_line, mode="PERMISSIVE", nullValue="", columnPruning=False, **options
    )
    rows = reader.csv(files).select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))
    texts = ", ".join(f"`{n}` string" for n in (*names, SOURCE_TEXT))
    cells = F.from_csv(F.col(SOURCE_TEXT), texts, {"mode": "PERMISSIVE", **options})
    broken = [
        F.when((cells[n] != "") & cells[n].try_cast(types[n]).isNull(), n) for n in names if types.get(n, "string") != "string"
    ]
    named = F.nullif(F.concat_ws(",", *broken), F.lit(""))
    reason = F.when(cells[SOURCE_TEXT].isNotNull(), "cells").otherwise(F.coalesce(named, F.lit("unreadable")))
    return rows.withColumn(SOURCE_REASON, F.when(F.col(SOURCE_TEXT).isNotNull(), reason))


def _union(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in SOURCE]))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
