"""Archive listing, header tags and the calibration sheet."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomgrid import schemas
from fathomgrid.functions import names
from fathomgrid.session import stored
from fathomgrid.sources import stores


def list_objects(spark: SparkSession, root: str, pattern: str = "*", strip: str | None = None) -> DataFrame:
    """Key, size and modification time of all files below `root`; contents are not read.

    Keys are relative to `strip` (default `root`).
    """
    base = (strip or root).rstrip("/") + "/"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    # The listing gives URIs; the key is what follows the base folder.
    return files.select(
        F.regexp_replace(F.substring_index("path", base, -1), "^/+", "").alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


_LEVEL = "folder string, is_folder boolean, key string, size bigint, modified timestamp"


def _unseen(name: str) -> bool:
    """Names that Spark's own listing passes over."""
    return name.startswith((".", "_")) and not ("=" in name and name.startswith("_"))


def list_by_folder(
    spark: SparkSession, root: str, pattern: str = "*", levels: int = 2, tasks: int | None = None
) -> DataFrame:
    """Key, size and modification time of all files below `root`, listed by tasks.

    The folders of the first `levels` levels (ships, cruises) become rows, one store request each; what lies below the
    last of them is walked folder by folder in the task that has it. So the driver sees no key, however many there are,
    and a task holds the entries of one folder. Keys are relative to `root` and the same as
    `list_objects` gives, which passes over empty files however.
    """
    place = stores.address_in(spark, root)
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism

    def children(store, folder: str) -> Iterator[tuple]:
        from pyarrow import fs

        base = f"{place.folder}/{folder}".rstrip("/")
        for entry in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            if _unseen(entry.base_name):
                continue
            key = f"{folder}/{entry.base_name}".lstrip("/")
            if entry.type == fs.FileType.Directory:
                yield key, True, None, None, None
            elif fnmatch.fnmatchcase(entry.base_name, pattern):
                # Whole milliseconds, as Spark has them.
                yield None, False, key, entry.size, entry.mtime_ns // 1_000_000 * 1000

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"))
        columns = zip(*rows, strict=True) if rows else ([] for _ in kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(columns, kinds, strict=True)],
            names=["folder", "is_folder", "key", "size", "modified"],
        )

    def one_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = place.open()
        for rows in batches:
            for folder in rows.column("folder").to_pylist():
                yield batch(list(children(store, folder)))

    def all_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = place.open()
        for rows in batches:
            for folder in rows.column("folder").to_pylist():
                waiting = [folder]
                while waiting:
                    entries = list(children(store, waiting.pop()))
                    waiting += [e[0] for e in entries if e[1]]
                    yield batch([e for e in entries if not e[1]])

    folders = spark.createDataFrame([("",)], "folder string")
    found = []
    for level in range(levels):
        # A number of tasks given is a number kept: folders are few bytes and much waiting.
        listed = stored(folders.repartition(tasks, "folder").mapInArrow(one_level, _LEVEL), f"level{level}")
        found.append(listed.filter("not is_folder"))
        folders = listed.filter("is_folder").select("folder")
    found.append(folders.repartition(tasks, "folder").mapInArrow(all_below, _LEVEL))
    return reduce(DataFrame.unionByName, found).select("key", "size", "modified")


HEADER_BYTES = 8


def header_tags(representatives: DataFrame, root: str) -> DataFrame:
    """Header tag of one file per cruise: cruise, key, datagram.

    Executors open the chosen files and read their first bytes only; nothing passes through the driver. A
    file that cannot be found has a null tag. `root` is a path or an address as Spark writes it (`s3a://`, `hdfs://`,
    `file:`, ...).
    """
    place = stores.address_in(representatives.sparkSession, root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = place.open()

        def head(key: str | None) -> bytes | None:
            try:
                with store.open_input_file(f"{place.folder}/{key}") as f:
                    return f.read_at(HEADER_BYTES, 0)
            except FileNotFoundError:
                return None

        for batch in batches:
            heads = pa.array([head(k) for k in batch.column("key").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("cruise"), batch.column("key"), heads], ["cruise", "key", "head"])

    opened = representatives.select("cruise", "key").mapInArrow(read, "cruise string, key string, head binary")
    return opened.select("cruise", "key", names.header_tag(F.col("head")).alias("datagram"))


def read_calibration(spark: SparkSession, path: str) -> DataFrame:
    """Calibration sheet as written; an absent file gives no rows."""
    reader = spark.read.option("header", "true").schema(schemas.CALIBRATION)
    try:
        return reader.csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.CALIBRATION)
