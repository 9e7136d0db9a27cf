"""Continuous ingestion: every landed file is loaded exactly once, into the tables of its own tenant.

The stream watches file names, not contents. Its checkpoint records which files belong to which batch, and
the batch handler writes under an id of that checkpoint and batch, so a batch repeated after a failure replaces itself and
streams with checkpoints of their own never share an id. A file that cannot be read is set aside with its reason; the
others of its batch are loaded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline.sources.files import SOURCE, SOURCE_PATH, SOURCE_TEXT, landing_filter, read_delimited, read_files, tenant_of

# Fixed value: the columns of Spark's binary file source.
FILE_DDL = "path string, modificationTime timestamp, length bigint, content binary"
#: Characters of the reason that is kept for a file that failed.
REASON_LENGTH = 500

# Fixed value: the first and last bytes of a columnar file.
_MARK = b"PAR1"

#: (tenant, rows, batch id, load time); rows have the columns of ``sources.files.SOURCE``.
Handler = Callable[[str, DataFrame, str, str], None]


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def landing_glob(root: str, domain: str, layer: str) -> str:
    """Folders of one domain and layer, of any tenant and in any spelling of case."""
    return f"{root.rstrip('/')}/{_any_case('tenant')}/*/{_any_case(layer)}/{_any_case(domain)}"


def landed_files(
    spark: SparkSession, root: str, domain: str, layer: str, *, files_per_batch: int = 1000, archive: str | None = None
) -> DataFrame:
    """Stream of new files (path, modificationTime, tenant) of one domain and layer under ``root``.

    With ``archive`` set, Spark moves files there some time after their batch has finished. That is
    housekeeping only: what was loaded is decided by the checkpoint. The source's own path names the domain, so files of
    other domains are neither listed nor moved.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_DDL).option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.option("recursiveFileLookup", True).load(landing_glob(root, domain, layer))
    chosen = files.filter(landing_filter(F.col("path"), domain, layer))
    return chosen.select("path", "modificationTime", tenant_of(F.col("path")).alias("tenant"))


def batch_name(checkpoint: str, batch_id: int) -> str:
    """Id of a stream's batch: no other checkpoint has it."""
    return f"{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:16]}-{batch_id}"


def _plain(path: str) -> str:
    """One spelling of a path: readers give ``file:///a%20b`` where listings give ``file:/a b`` or ``/a b``."""
    return re.sub(r"^file:/+", "/", unquote(path))


def _missing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files that are gone; a look at the directory each, no job."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = [(p, jvm.org.apache.hadoop.fs.Path(p)) for p in paths]
    return [p for p, place in found if not place.getFileSystem(conf).exists(place)]


def row_counts(frame: DataFrame, *, decoded: bool) -> DataFrame:
    """(path, promised, read) by file: rows as the file's footer has them, or rows of which every cell was decoded."""
    path = F.col("_metadata.file_path").alias("path")
    if not decoded:
        return frame.select(path).groupBy("path").agg(F.count("*").alias("promised"), F.lit(0).cast("long").alias("read"))
    odd = frame.select(path, (F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]) % 2 != 0).alias("odd"))
    # Counted in two parts: the optimizer would turn a count of all into one that needs no cell.
    read = F.count_if("odd") + F.count_if(~F.col("odd"))
    return odd.groupBy("path").agg(F.lit(0).cast("long").alias("promised"), read.alias("read"))


def unreadable(spark: SparkSession, paths: list[str], **read_options) -> dict[str, str]:
    """Files that cannot be read, with the reason; only a failed batch asks.

    The number of jobs does not depend on the number of files. All columnar files are read at once, corrupt ones skipped, and
    the rows that came of each are held against the rows its footer promises; a delimited file is text that cannot be
    corrupt, only gone, or broken by a strict ``mode``. Files of which nothing came are probed together for the marks of
    their format, which an empty table has too.
    """
    found = dict.fromkeys(_missing(spark, paths), "the file is gone")
    there = [p for p in paths if p not in found]
    columnar = [p for p in there if p.lower().endswith(".parquet")]
    if columnar:
        found |= _unreadable_columnar(spark, columnar)
    delimited = [p for p in there if p not in columnar]
    if delimited and read_options.get("mode", "PERMISSIVE") != "PERMISSIVE":
        rows = read_delimited(spark, delimited, **{**read_options, "mode": "PERMISSIVE"})
        # With a cell beside it: Spark refuses queries on the text alone.
        row = F.struct(F.col(SOURCE_TEXT).alias("text"), *[c for c in rows.columns if c not in SOURCE][:1])
        broken = rows.filter(F.col(SOURCE_TEXT).isNotNull()).groupBy(SOURCE_PATH).agg(F.min(row).alias("row"))
        texts = {_plain(r[SOURCE_PATH]): r["row"]["text"] for r in broken.collect()}
        found |= {p: f"a row does not fit its header: {texts[_plain(p)]}"[:REASON_LENGTH] for p in delimited if _plain(p) in texts}
    return found


def _unreadable_columnar(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    lenient = spark.read.option("ignoreCorruptFiles", True).option("mergeSchema", True)
    try:
        frame = lenient.parquet(*paths)
        both = row_counts(frame, decoded=False).unionByName(row_counts(frame, decoded=True))
        counts = both.groupBy("path").agg(F.sum("promised").alias("promised"), F.sum("read").alias("read"))
        # One short row for each file of the batch.
        seen = {_plain(r["path"]): (r["promised"], r["read"]) for r in counts.collect()}
    except Exception as error:  # noqa: BLE001  an analysis error or the JVM's own, by version
        if "UNABLE_TO_INFER_SCHEMA" not in str(error):
            # The files contradict each other; none of them is at fault by itself.
            return {}
        seen = {}
    found = {}
    for path in paths:
        promised, read = seen.get(_plain(path), (0, 0))
        if read < promised:
            found[path] = f"{read} of {promised} rows can be read"
    silent = [p for p in paths if _plain(p) not in seen]
    if silent:
        content = F.col("content")
        size = F.octet_length(content)
        marked = (F.substring(content, 1, 4) == F.lit(_MARK)) & (F.substring(content, -4, 4) == F.lit(_MARK)) & (size >= 12)
        probes = spark.read.format("binaryFile").load(silent).select("path", F.coalesce(marked, F.lit(False)).alias("marked"))
        whole = {_plain(r["path"]) for r in probes.collect() if r["marked"]}
        found |= {p: "not a columnar file, or cut off" for p in silent if _plain(p) not in whole}
    return found


def ingest_stream(
    spark: SparkSession,
    root: str,
    domain: str,
    layer: str,
    checkpoint: str,
    handler: Handler,
    *,
    failed: str | None = None,
    files_per_batch: int = 1000,
    archive: str | None = None,
    **read_options,
) -> StreamingQuery:
    """Load all files landed so far, then stop; the next run continues after them.

    ``handler(tenant, raw, batch, loaded_at)`` gets the rows of one tenant's files of the batch, as text with their file
    path. The load time is that of the newest file, so a repeated batch produces the same rows. If a tenant's load fails
    and some of its files cannot be read, these are listed under ``failed`` (path, tenant, batch, reason) and the load is
    run again without them; any other failure ends the stream, and the next run repeats the batch.
    """

    def load_tenant(tenant: str, paths: list[str], batch: str, loaded_at: str) -> None:
        try:
            handler(tenant, read_files(spark, paths, **read_options), batch, loaded_at)
            return
        except Exception:
            bad = unreadable(spark, paths, **read_options) if failed else {}
            if not bad:
                raise
        rows = [(path, tenant, batch, reason) for path, reason in sorted(bad.items())]
        listed = spark.createDataFrame(rows, "path string, tenant string, batch string, reason string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{failed}/_tenant={tenant}/_batch={batch}")
        good = [p for p in paths if p not in bad]
        if good:
            handler(tenant, read_files(spark, good, **read_options), batch, loaded_at)

    def load(batch_files: DataFrame, batch_id: int) -> None:
        # At most files_per_batch short rows.
        files = batch_files.toPandas()
        if files.empty:
            return
        loaded_at = files["modificationTime"].max().strftime("%Y-%m-%d %H:%M:%S")
        for tenant, own in files.groupby("tenant"):
            load_tenant(tenant, sorted(own["path"]), batch_name(checkpoint, batch_id), loaded_at)

    files = landed_files(spark, root, domain, layer, files_per_batch=files_per_batch, archive=archive)
    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
