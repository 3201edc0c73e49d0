"""Stored tables: file status log, soundings, cruise index, cube."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fathomgrid import schemas
from fathomgrid.functions import times
from fathomgrid.operators import cube, status
from fathomgrid.session import few_listing_tasks, stored
from fathomgrid.sources.folders import exists, folder_columns, parquet_file, write_folders


def as_status(rows: DataFrame) -> DataFrame:
    """Rows with the columns of the status log; absent attributes are null."""
    have = set(rows.columns)
    return rows.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.FILE_STATUS.fields
        ]
    )


def append_status(rows: DataFrame, path: str) -> None:
    """Append to the file status log; nothing is overwritten."""
    as_status(rows).write.mode("append").parquet(path)


def status_rows(files: DataFrame, status: str, event_seq: int = 0) -> DataFrame:
    """Status rows of the given files, stamped with the processing time."""
    marked = files.withColumns(
        {"pipeline_status": F.lit(status), "event_seq": F.lit(event_seq).cast("long")}
    )
    return times.stamped(marked)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FILE_STATUS).parquet(path)


def write_soundings(soundings: DataFrame, path: str) -> None:
    """Soundings below cruise=/file_name= folders, so one file is read by its path alone.

    Rows are gathered by block of pings first: few output files per sound file, and none of them
    depends on one task taking all of it.
    """
    gathered = soundings.repartition("cruise", "file_name", cube.ping_block(F.col("ping_idx")))
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "cruise", "file_name"
    ).parquet(path)


def save_soundings_bucketed(soundings: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Soundings as a table bucketed by block of pings, which is returned: the later join leaves them in place.

    Rows are brought to their buckets first, so a bucket is one file, and the one time that samples move is on
    their way into the store. `path` puts the files there instead of the warehouse.
    """
    keys = ("cruise", "file_name", "ping_block")
    writer = (
        soundings.withColumn("ping_block", cube.ping_block(F.col("ping_idx")))
        .repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return soundings.sparkSession.table(table)


def read_soundings(spark: SparkSession, path: str, cruise: str | None = None, file_name: str | None = None) -> DataFrame:
    """Soundings, narrowed by partition folders when cruise or file are given."""
    df = spark.read.schema(schemas.SOUNDINGS).parquet(path)
    if cruise is not None:
        df = df.filter(F.col("cruise") == cruise)
    if file_name is not None:
        df = df.filter(F.col("file_name") == file_name)
    return df


def write_index(index: DataFrame, path: str) -> None:
    """The cruise index is rebuilt by every run."""
    index.write.mode("overwrite").parquet(path)


def write_cube(rows: DataFrame, path: str) -> None:
    """Write cube slices; only the files present in `rows` are replaced."""
    (
        rows.sortWithinPartitions("cruise", "file_name", "time_tile", "frequency", "time_idx")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("cruise", "file_name")
        .parquet(path)
    )


def drop_stale_slices(spark: SparkSession, path: str, current: DataFrame) -> int:
    """Remove stored slices of files that left their cruise; returns how many.

    `current` names the files (cruise, file_name) of every cruise just written. Only folder names are
    compared, and only those of stale files reach the driver.
    """
    keys = ["cruise", "file_name"]
    stored = read_cube(spark, path).select(*keys).distinct()
    renewed = stored.join(current.select("cruise").distinct(), "cruise", "left_semi")
    stale = renewed.join(current.select(*keys), keys, "left_anti")
    return _drop_folders(spark, path, stale, keys)


def _drop_folders(spark: SparkSession, path: str, stale: DataFrame, columns: Sequence[str]) -> int:
    """Remove the partition folders that `stale` names; only those names reach the driver, one by one."""
    jvm = spark._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    gone = 0
    for row in stale.select(*columns).toLocalIterator():
        below = "/".join(f"{c}={escape(str(row[c]))}" for c in columns)
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{below}")
        gone += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone


def read_cube(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CRUISE_CUBE).parquet(path)


# --- the cube as chunks --------------------------------------------------------------------------

CHUNK = ("cruise", "time_tile", "depth_tile", "file_name")
_CHUNK_BYTES = 4 << 20
"""A chunk of 1,024 x 1,024 floats: rows of one frequency fill about one group of a stored file."""


def write_chunks(
    rows: DataFrame, path: str, time_tile: int = cube.TILE, depth_tile: int = cube.TILE
) -> None:
    """Store cube rows as chunks of depth x time: one folder per time tile, depth tile and sound file.

    A reader of one chunk lists and opens its folder alone, and within it skips other frequencies by their groups of
    rows. A sound file's slice is replaced by itself: the border tiles it shares with its neighbours hold a folder per
    file, and folders that the new slice does not reach any more are dropped. Positions are not repeated here; they
    are on the axes. Rows stay in the task that made them.
    """
    spark = rows.sparkSession
    renewed = exists(spark, path)
    pieces = cube.tiled(rows, depth_tile).withColumn("time_tile", cube.time_tile(F.col("time_idx"), time_tile))
    sent = pieces.select(*CHUNK, "frequency", "time_idx", "sv").sortWithinPartitions(*CHUNK, "frequency", "time_idx")
    write_folders(sent.withColumns(folder_columns(CHUNK)), CHUNK, path, parquet_file(spark, _CHUNK_BYTES), ".parquet")
    if not renewed:
        return
    # What the slices reach now, from their narrow columns.
    reached = rows.groupBy("cruise", "file_name").agg(
        F.min("time_idx").alias("low"), F.max("time_idx").alias("high"), F.max(F.size("sv")).alias("deep")
    )
    folders = _chunk_folders(spark, path)
    stale = folders.join(reached, ["cruise", "file_name"]).filter(
        (F.col("time_tile") < F.floor(F.col("low") / time_tile))
        | (F.col("time_tile") > F.floor(F.col("high") / time_tile))
        | (F.col("depth_tile") * depth_tile >= F.greatest(F.col("deep"), F.lit(1)))
    )
    _drop_folders(spark, path, stale, CHUNK)


def _chunk_folders(spark: SparkSession, path: str) -> DataFrame:
    """Folders of the stored chunks, by their names: no file is opened."""
    named = schemas.FILE_CONTENT.fields + [schemas.CUBE_CHUNK[c] for c in CHUNK]
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").schema(StructType(named)).option("pathGlobFilter", "part-*").load(path)
    return files.select(*CHUNK).distinct()


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    with few_listing_tasks(spark):
        return spark.read.schema(schemas.CUBE_CHUNK).parquet(path)


def read_chunk(
    spark: SparkSession, path: str, cruise: str, time_tile: int, depth_tile: int, frequency: float | None = None
) -> DataFrame:
    """The rows of one chunk; no other tile's folder is opened."""
    rows = read_chunks(spark, path).filter(
        (F.col("cruise") == cruise) & (F.col("time_tile") == time_tile) & (F.col("depth_tile") == depth_tile)
    )
    return rows if frequency is None else rows.filter(F.col("frequency") == F.lit(frequency).cast("float"))


def write_axes(placed: DataFrame, depths: DataFrame, path: str) -> None:
    """The cube's axes, each value once: `time` with its positions by sound file, and `depth` by cruise.

    `placed`: cruise, file_name, time_idx, epoch_seconds, latitude, longitude; `depths`: cruise, depth_idx, depth.
    """
    single = [F.col(c).cast("float").alias(c) for c in ("latitude", "longitude")]
    times_ = placed.select("cruise", "file_name", "time_idx", F.col("epoch_seconds").alias("ts"), *single)
    for name, axis, folders in (("time", times_, ["cruise", "file_name"]), ("depth", depths, ["cruise"])):
        (
            axis.sortWithinPartitions(*folders, "time_idx" if name == "time" else "depth_idx")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(f"{path}/{name}")
        )


def read_axis(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The `time` or the `depth` axis."""
    with few_listing_tasks(spark):
        return spark.read.schema(schemas.TIME_AXIS if name == "time" else schemas.DEPTH_AXIS).parquet(f"{path}/{name}")


# --- map tiles -----------------------------------------------------------------------------------

TILE_FOLDERS = ("z", "x_range", "cruise_part")
X_RANGES = 4
CRUISE_PARTS = 4


def _tile_folders(rows: DataFrame) -> DataFrame:
    """Rows with the folder they are stored in: zoom, quarter of the map from west to east, part of the cruises."""
    across = F.greatest(F.lit(1), F.expr(f"int(shiftleft(1, z) div {X_RANGES})"))
    return rows.withColumns(
        {
            "x_range": F.floor(F.col("x") / across).cast("int"),
            "cruise_part": F.pmod(F.xxhash64("cruise"), F.lit(CRUISE_PARTS)).cast("int"),
        }
    )


def publish_tiles(spark: SparkSession, path: str, fresh: DataFrame, cruises: DataFrame | None = None) -> int:
    """Put the tile rows of some cruises in the place of their earlier ones; returns how many folders that touched.

    Only folders that hold or will hold rows of these cruises are read and written again, all others keep their
    files. Which folders a cruise is in is noted in a narrow table beside the tiles, so none is searched for it.
    `cruises` names the published cruises, so that one without fresh rows loses its old ones.
    """
    rows = stored(_tile_folders(fresh), "fresh-tiles")
    names = stored((fresh if cruises is None else cruises).select("cruise").distinct(), "published")
    noted = _read_or_none(spark, f"{path}/where", "cruise string, z int, x_range int, cruise_part int")
    now = rows.select("cruise", *TILE_FOLDERS).distinct()
    found = now if noted is None else now.unionByName(noted.join(names, "cruise", "left_semi"))
    # No more of these than folders: zooms times quarters times parts.
    touched = sorted(tuple(r) for r in found.select(*TILE_FOLDERS).distinct().collect())
    if not touched:
        return 0
    # Notes are only added, and before the rows: one too many costs a look into a folder, one too few would lose rows.
    now.write.mode("append").parquet(f"{path}/where")
    kept = None if noted is None else _read_or_none(spark, f"{path}/rows", rows.schema)
    if kept is not None:
        others = in_folders(kept, touched).join(names, "cruise", "left_anti")
        rows = stored(rows.unionByName(others.select(*rows.columns)), "merged-tiles")
    order = [*TILE_FOLDERS, "x", "y", "cruise"]
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*TILE_FOLDERS)
        .parquet(f"{path}/rows")
    )
    gone = spark.createDataFrame(touched, "z int, x_range int, cruise_part int").join(
        rows.select(*TILE_FOLDERS).distinct(), list(TILE_FOLDERS), "left_anti"
    )
    _drop_folders(spark, f"{path}/rows", gone, TILE_FOLDERS)
    return len(touched)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """The published tile rows."""
    return spark.read.parquet(f"{path}/rows").drop("x_range", "cruise_part")


def in_folders(rows: DataFrame, folders: Sequence[tuple]) -> DataFrame:
    """Stored tile rows of the given folders; no other is listed or opened."""
    chosen = reduce(or_, [reduce(and_, [F.col(c) == v for c, v in zip(TILE_FOLDERS, f, strict=True)]) for f in folders])
    return rows.filter(chosen)


def _read_or_none(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# --- snapshot of the status log ------------------------------------------------------------------


def compact_status(spark: SparkSession, log: str, snapshot: str) -> int:
    """Fold what the log has beyond the last snapshot into a new one; returns its number.

    A snapshot holds the latest row per file and cruise, and the names of the log files it covers. It is written whole
    under a number of its own before it counts, the log is left as it is, and rows appended meanwhile are in files
    that the snapshot does not name. So readers and writers go on while it is made.
    """
    number, tail, before = _status_parts(spark, log, snapshot)
    if not tail and before is not None:
        return number
    rows = spark.read.schema(schemas.FILE_STATUS).parquet(*tail) if tail else read_status(spark, log).limit(0)
    whole = rows if before is None else rows.unionByName(before.select(*rows.columns))
    base = f"{snapshot.rstrip('/')}/{number + 1:09d}"
    status.latest_status(whole).select(*rows.columns).write.mode("overwrite").parquet(f"{base}/rows")
    covered = spark.createDataFrame([(f,) for f in tail], "file string")
    if before is not None:
        covered = covered.unionByName(spark.read.parquet(f"{snapshot}/{number:09d}/covered"))
    covered.write.mode("overwrite").parquet(f"{base}/covered")
    return number + 1


def _status_parts(spark: SparkSession, log: str, snapshot: str) -> tuple[int, list[str], DataFrame | None]:
    """Number and rows of the last whole snapshot, and the log files beyond it.

    File names are what Spark's own listing of the log holds in the driver.
    """
    files = spark.read.schema(schemas.FILE_STATUS).parquet(log).inputFiles()
    path = spark._jvm.org.apache.hadoop.fs.Path(snapshot)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = []
    if store.exists(path):
        for entry in store.listStatus(path):
            done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "covered/_SUCCESS")
            if store.exists(done):
                numbers.append(int(entry.getPath().getName()))
    if not numbers:
        return 0, list(files), None
    base = f"{snapshot.rstrip('/')}/{max(numbers):09d}"
    covered = {r["file"] for r in spark.read.parquet(f"{base}/covered").collect()}
    rows = spark.read.schema(schemas.FILE_STATUS).parquet(f"{base}/rows")
    return max(numbers), [f for f in files if f not in covered], rows


def read_latest_status(spark: SparkSession, log: str, snapshot: str) -> DataFrame:
    """Latest row per file and cruise: the last snapshot and the log files it does not cover."""
    _, tail, before = _status_parts(spark, log, snapshot)
    if before is None:
        return status.latest_status(read_status(spark, log))
    if not tail:
        return before
    newer = spark.read.schema(schemas.FILE_STATUS).parquet(*tail)
    return status.latest_status(newer.unionByName(before.select(*newer.columns)))
