"""Session settings and places that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and interim tables that every executor can read.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests on one machine) a temporary folder is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    named = tempfile.mkdtemp(prefix="lodestrata-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


#: Frees the shuffle files of a query when it ends, not when the driver collects its garbage.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Names of the bucketed tables, by their path.
_names: dict[str, str] = {}


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, as the JVM knows them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def interim_path(spark: SparkSession, label: str) -> str:
    """A new folder for an interim table; it is deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    fs, p = _folder(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def _takes_tables(spark: SparkSession) -> bool:
    """False where the catalog's own folder can't be made, as in a working directory that is read-only."""
    try:
        return spark.catalog.databaseExists(spark.catalog.currentDatabase())
    except Exception:  # noqa: BLE001
        return False


def stage_table(df: DataFrame, label: str, replaces: DataFrame | None = None, **write) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage.

    The table survives the loss of executors; ``write`` may hold
    ``partitionBy``, or ``bucketBy``: a number and columns, on which it then joins
    without a shuffle; it has a name in the catalog until it is deleted, and where
    the catalog takes none it isn't bucketed. The staged table ``replaces`` is deleted once this one is
    written; nothing may read it afterwards. All others are deleted with the session.
    """
    spark = df.sparkSession
    path = interim_path(spark, label)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if write.get("partitionBy"):
        writer = writer.partitionBy(*write["partitionBy"])
    if write.get("bucketBy") and _takes_tables(spark):
        number, columns = write["bucketBy"]
        writer = writer.bucketBy(number, *columns).option("path", path).format("parquet")
        _names[path] = path.rpartition("/")[2].replace("-", "_")
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        writer.saveAsTable(_names[path]) if path in _names else writer.parquet(path)
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
    if replaces is not None:
        drop_table(replaces)
    out = spark.table(_names[path]) if path in _names else spark.read.schema(df.schema).parquet(path)
    _places[out] = path
    return out


def drop_table(staged: DataFrame) -> None:
    """Deletes a table written by ``stage_table``; others are left alone."""
    path = _places.pop(staged, None)
    if path is not None:
        if path in _names:
            staged.sparkSession.sql(f"DROP TABLE IF EXISTS {_names.pop(path)}")
        fs, p = _folder(staged.sparkSession, path)
        fs.delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, limit_rows: int) -> bool:
    """True if ``df`` has at most ``limit_rows`` rows; reads no more than that."""
    return df.limit(limit_rows + 1).count() <= limit_rows
