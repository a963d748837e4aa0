"""Leases of jobs over a stream of events, as keyed state and as batch twins.

A job is pending until a worker claims it; the claim holds while heartbeats of
that worker come, and another may take the job over when the last sign of life
is older than ``STALE``. Heartbeats and results count only from the worker that
holds the job; a finished job stays finished.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import interim_path

#: Seconds without a sign of life after which a claim may be taken over.
STALE = 900
#: Days for which the stream remembers a finished job, by event time; later events of it begin a new one.
REMEMBERED = 90
#: Kinds of events by the names they have in the log.
KINDS = {"signup": "claim", "view": "heartbeat", "click": "heartbeat", "purchase": "done", "error": "failed"}

STATE = "status string, owner string, attempts int, claimed_at double, seen_at double, ended_at double, beats int"
START = ("pending", "", 0, 0.0, 0.0, 0.0, 0)
FINISHED = ("done", "failed")


def step(state: tuple, kind: str, worker: str, t: float) -> tuple:
    """State of a job after an event."""
    status, owner, attempts, claimed, seen, ended, beats = state
    if kind == "claim":
        if status == "pending" or (status == "claimed" and t - seen > STALE):
            return "claimed", worker, attempts + 1, t, t, ended, beats
    elif status == "claimed" and owner == worker:
        if kind == "heartbeat":
            return status, owner, attempts, claimed, t, ended, beats + 1
        return kind, owner, attempts, claimed, t, t, beats
    return state


def job_events(df: DataFrame) -> DataFrame:
    """(job, ts, kind, worker, id) of an event log; the worker is part of the event's properties."""
    kind = F.lit(None).cast("string")
    for name, k in KINDS.items():
        kind = F.when(F.col("event_type") == name, k).otherwise(kind)
    worker = F.concat(F.lit("w"), F.expr("cast(get_json_object(props, '$.k') as int) div 50"))
    return df.select(F.col("user_id").alias("job"), "ts", kind.alias("kind"), worker.alias("worker"), F.col("event_id").alias("id")).filter("kind is not null and worker is not null")


def final_states(events: DataFrame, until: Column | None = None) -> DataFrame:
    """Batch: last state of each job, its events up to a time replayed in order; (job, STATE).

    Only a job's own events come together, sorted by time; they are folded in
    the engine, without a Python worker.
    """
    own = F.collect_list(F.struct("ts", "id", "kind", "worker"))
    if until is not None:
        own = F.collect_list(F.when(F.col("ts") <= until, F.struct("ts", "id", "kind", "worker")))
    ordered = events.groupBy("job").agg(F.sort_array(own).alias("e"))
    names = [x.split() for x in STATE.split(", ")]
    zero = F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(START, names)])

    def fold(acc, e):
        t = e["ts"].cast("timestamp").cast("double")
        claim = (e["kind"] == "claim") & ((acc["status"] == "pending") | ((acc["status"] == "claimed") & (t - acc["seen_at"] > STALE)))
        held = (acc["status"] == "claimed") & (acc["owner"] == e["worker"]) & (e["kind"] != "claim")
        beat = held & (e["kind"] == "heartbeat")
        end = held & (e["kind"] != "heartbeat")
        return F.struct(
            F.when(claim, F.lit("claimed")).when(end, e["kind"]).otherwise(acc["status"]).alias("status"),
            F.when(claim, e["worker"]).otherwise(acc["owner"]).alias("owner"),
            (acc["attempts"] + F.when(claim, 1).otherwise(0)).alias("attempts"),
            F.when(claim, t).otherwise(acc["claimed_at"]).alias("claimed_at"),
            F.when(claim | held, t).otherwise(acc["seen_at"]).alias("seen_at"),
            F.when(end, t).otherwise(acc["ended_at"]).alias("ended_at"),
            (acc["beats"] + F.when(beat, 1).otherwise(0)).alias("beats"),
        )

    return ordered.select("job", F.aggregate("e", zero, fold).alias("s")).select("job", "s.*")


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    now = state.get if state.exists else START
    # a key's rows may come in several chunks; only together can they be put in order
    rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "id"])
    for kind, worker, t in zip(rows["kind"], rows["worker"], rows["ts"]):
        now = step(now, kind, worker, t.timestamp())
    state.update(now)
    if now[0] in FINISHED:
        state.setTimeoutTimestamp(max(int((now[5] + REMEMBERED * 86_400) * 1000), state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame([[key[0], *now]], columns=["job", *(x.split()[0] for x in STATE.split(", "))])


def run_available(stream: DataFrame, label: str, mode: str = "append", key: str | None = None) -> DataFrame:
    """Runs a stream over all that is there and gives back what it wrote to the shared folder; in update mode the last row of each key."""
    spark = stream.sparkSession
    base = interim_path(spark, label)
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{base}/out")

    def write(df: DataFrame, n: int) -> None:  # every batch overwrites what the same batch wrote before, so a repeated batch changes nothing
        df.write.mode("overwrite").parquet(f"{base}/out/batch={n}")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start()
    q.awaitTermination()
    rest = [c for c in stream.columns if c != key]
    written = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", IntegerType())])).parquet(f"{base}/out")
    return written.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("last")).select(key, "last.*")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)


def lease_stream(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """(job, STATE) of each job whose state changed, from keyed state."""
    events = job_events(stream).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return events.groupBy("job").applyInPandasWithState(_fold, f"job long, {STATE}", STATE, "update", GroupStateTimeout.EventTimeTimeout)
