"""Writers; each gives back what was written, read again."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import interim_path


def _path(df: DataFrame, label: str) -> str:
    return interim_path(df.sparkSession, label) + "/out"


def raw_blobs(df: DataFrame, body: str) -> DataFrame:
    """Content-addressed blobs: (raw_hash, body), each distinct body once."""
    path = _path(df, "raw")
    df.filter(F.col(body).isNotNull()).select(F.sha2(body, 256).alias("raw_hash"), F.col(body).alias("body")).dropDuplicates(["raw_hash"]).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def raw_files(df: DataFrame, body: str) -> DataFrame:
    """(raw_hash, n_bytes): each distinct body as a file named by its hash, written under another name and then renamed.

    A file that is there is left alone, so a task that runs again changes
    nothing. Nulls and empty bodies have no file.
    """
    path = _path(df, "raw")
    blobs = df.filter(F.octet_length(body) > 0).select(F.sha2(F.col(body).cast("binary"), 256).alias("raw_hash"), F.col(body).cast("binary").alias("body")).dropDuplicates(["raw_hash"])

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for h, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder = f"{base}/{h[:2]}"
                if fs.get_file_info(f"{folder}/{h}").type == pafs.FileType.NotFound:
                    fs.create_dir(folder, recursive=True)
                    name = f"{folder}/.{h}.{uuid.uuid4().hex}"
                    with fs.open_output_stream(name) as f:
                        f.write(b)
                    fs.move(name, f"{folder}/{h}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    blobs.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    spark = df.sparkSession
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select(F.substring_index("path", "/", -1).alias("raw_hash"), F.col("length").alias("n_bytes"))


def csv(df: DataFrame) -> DataFrame:
    """CSV with a header, quoted so that line breaks in values survive."""
    path = _path(df, "csv")
    df.write.option("header", True).option("escape", '"').option("quoteAll", True).option("nullValue", "\u0000").csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).option("escape", '"').option("multiLine", True).option("nullValue", "\u0000").csv(path)


def parquet(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    path = _path(df, "table")
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def json(df: DataFrame) -> DataFrame:
    path = _path(df, "json")
    df.write.json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def markdown(df: DataFrame, most: int = 50) -> str:
    """Table of the first rows; the cap is the report's."""
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    rows = df.limit(most).select(F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("r")).collect()
    return "\n".join([head, *(f"| {r.r} |" for r in rows)])


def highlighted(df: DataFrame, text: str, pattern: str, out: str = "preview") -> DataFrame:
    """Adds the text with every match of a pattern in brackets."""
    return df.withColumn(out, F.regexp_replace(text, f"({pattern})", "[$1]"))
