"""Writers, digests and staged publishing."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator, Mapping
from urllib.parse import quote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}
VALUE_BYTES = 64 << 20
BUFFER_BYTES = 8 << 20
ROWS_PER_FILE = 1_000_000


def write_csv(df: DataFrame, path: str, single_file: bool = False, compression: str = "none") -> None:
    """CSV with header; dates and timestamps without fraction. ``single_file`` is for small reports only.

    Spark reads a compressed file in one task, so those are cut by rows.
    """
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite").options(**CSV_OPTIONS, compression=compression)
    (writer if compression == "none" else writer.option("maxRecordsPerFile", ROWS_PER_FILE)).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Parquet in the codec that takes least disk."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, file_format: str = "parquet") -> None:
    """Every table to its own folder, ``<name>`` as Parquet or ``<name>.csv`` as CSV."""
    for name, df in tables.items():
        if file_format == "csv":
            write_csv(df, f"{folder}/{name}.csv")
        else:
            df.write.mode("overwrite").format(file_format).save(f"{folder}/{name}")


def write_json(spark: SparkSession, payload: dict, path: str) -> None:
    """A small manifest as one JSON text."""
    text = json.dumps(payload, indent=2, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option(
        "lineSep", "\n"
    ).text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def file_digests(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, length, sha256) of every non-empty file at or below the paths; files are spread over tasks.

    Spark's binary source gives a file as one value, which can hold 2 GB. So files of up to ``VALUE_BYTES`` are digested
    in the JVM, and larger ones are read in buffers by the task that gets them; any size takes the same memory there.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    small = files.load(list(paths)).where(F.col("length") <= VALUE_BYTES)
    found = small.select("path", "length", F.sha2("content", 256).alias("sha256"))
    # Only names and lengths: the content column is pruned, so no large file becomes a value.
    large = files.load(list(paths)).where(F.col("length") > VALUE_BYTES).select("path", "length")
    return found.unionByName(large.repartition("path").mapInArrow(_streamed_digests, "path string, length bigint, sha256 string"))


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            # Spark gives local files as file:/path; names are not encoded.
            local = re.match(r"^file:/+", path)
            system, place = (LocalFileSystem(), f"/{path[local.end() :]}") if local else FileSystem.from_uri(quote(path, safe=":/@?=&"))
            digest = hashlib.sha256()
            with system.open_input_stream(place) as stream:
                while buffer := stream.read(BUFFER_BYTES):
                    digest.update(buffer)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], ["path", "length", "sha256"])


def table_digests(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per table of ``{name: path}``: (table_name, files, bytes, sha256).

    The digest of a single file is that file's SHA-256. For a folder it is the SHA-256 over the sorted file
    digests, built in two steps so that no task holds the digests of all files.
    """
    table = F.lit(None).cast("string")
    for name, path in paths.items():
        place = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "", path).rstrip("/")
        inside = F.col("path").endswith(place) | F.col("path").contains(f"{place}/")
        table = F.when(inside, name).otherwise(table)
    files = file_digests(spark, *paths.values()).withColumn("table_name", table)
    groups = files.groupBy("table_name", F.substring("sha256", 1, 3).alias("part")).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("sha256").alias("one"),
        F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), "\n"), 256).alias("digest"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("part", "digest")))
    joined = F.array_join(F.transform(ordered, lambda group: group["digest"]), "\n")
    return groups.groupBy("table_name").agg(
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.when(F.sum("files") == 1, F.max("one")).otherwise(F.sha2(joined, 256)).alias("sha256"),
    )


POINTER = "CURRENT"
CLAIMS = "claims"
FIRST = "first"


class PublishConflict(RuntimeError):
    """Another run has published, or is publishing, over the version this run started from."""


def version_folder(target: str) -> str:
    """A new folder for a whole set of tables below the target; readers do not see it before the switch."""
    return f"{target.rstrip('/')}/versions/{uuid.uuid4().hex}"


def _version_name(version: str | None) -> str | None:
    return version.rsplit("/", 1)[-1] if version else None


def _claim_path(target: str, basis: str | None) -> str:
    return f"{target.rstrip('/')}/{CLAIMS}/{_version_name(basis) or FIRST}"


def claim_switch(spark: SparkSession, version: str, target: str, basis: str | None) -> None:
    """Take the right to replace ``basis``, the version current when the run started; only one run gets it.

    The claim is a file named after the basis, created exclusively: of several runs with one basis the first creates it and
    the others fail. It stays, so a run with an old basis fails as well. A run that dies between its
    claim and its switch leaves the claim behind; ``release_claim`` removes that one.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_claim_path(target, basis))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    try:
        claim = files.create(path, False)
    except Py4JJavaError as error:
        if not files.exists(path):
            raise
        raise PublishConflict(f"{target}: another run publishes over version {_version_name(basis) or FIRST}; this one was based on it as well.") from error
    claim.write(bytearray(_version_name(version).encode()))
    claim.close()
    if _version_name(current_version(spark, target)) != _version_name(basis):
        files.delete(path, False)
        raise PublishConflict(f"{target}: version {_version_name(basis) or FIRST} is no longer the current one.")


def release_claim(spark: SparkSession, target: str) -> bool:
    """Remove the claim on the current version that a dead run left behind; whether there was one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_claim_path(target, current_version(spark, target)))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


def switch_version(spark: SparkSession, version: str, target: str, basis: str | None) -> None:
    """Make a complete version the current one by one rename of the pointer file, then remove older versions.

    Readers get the old set or the new one, never a mixture. The switch is conditional on ``basis``, the version that was
    current when the run started (None for the first one). The version before stays for readers that have it open.
    """
    claim_switch(spark, version, target, basis)
    jvm = spark.sparkContext._jvm
    fs, path = jvm.org.apache.hadoop.fs, jvm.org.apache.hadoop.fs.Path
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    files = path(target).getFileSystem(configuration)
    draft = path(f"{version}.pointer")
    with_name = files.create(draft, True)
    with_name.write(bytearray(_version_name(version).encode()))
    with_name.close()
    overwrite = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(overwrite, 1)
    options[0] = overwrite.OVERWRITE
    context = fs.FileContext.getFileContext(files.getUri(), configuration)
    context.rename(files.makeQualified(draft), files.makeQualified(path(f"{target}/{POINTER}")), options)
    # A run may still work on a version of its own, so only what this run replaced before is removed.
    keep = {_version_name(version), _version_name(basis)}
    for status in files.listStatus(path(f"{target}/{CLAIMS}")):
        name = _small_text(spark, status.getPath().toString())
        if name and name not in keep:
            files.delete(path(f"{target}/versions/{name}"), True)


def _small_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file of any file system that Spark reads; None if it is absent."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current_version(spark: SparkSession, target: str) -> str | None:
    """Folder of the current version, or None where nothing was published."""
    name = _small_text(spark, f"{target.rstrip('/')}/{POINTER}")
    return f"{target.rstrip('/')}/versions/{name}" if name else None


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a run wrote for itself."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
