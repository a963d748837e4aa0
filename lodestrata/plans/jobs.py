"""Queries over job leases and incremental processing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import joins, passages
from ..session import table
from ..streaming import jobs
from .catalog import query
from .store import CHUNK_SQL, DOCS_SQL, SEG_SQL, chunks, docs, segments

EVENT_SQL = """j AS (SELECT * FROM (SELECT user_id AS job, ts, event_id AS id, CASE event_type WHEN 'signup' THEN 'claim' WHEN 'view' THEN 'heartbeat' WHEN 'click' THEN 'heartbeat' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' END AS kind,
 'w' || CAST(json_extract_string(props, '$.k') AS INTEGER) // 50 AS worker FROM events) WHERE kind IS NOT NULL AND worker IS NOT NULL)"""
_CLAIM = "e.kind = 'claim' AND (s.status = 'pending' OR (s.status = 'claimed' AND e.t - s.seen_at > 900))"
_HELD = "s.status = 'claimed' AND s.owner = e.worker AND e.kind <> 'claim'"
#: Every job's state after each of its events, as a recursion; ``e`` are the events and ``s`` the states.
_STATE_SQL = f"""e AS (SELECT job, row_number() OVER (PARTITION BY job ORDER BY ts, id) AS rn, kind, worker, epoch_us(ts) / 1e6 AS t FROM j WHERE ts <= (SELECT moment FROM until)),
s AS (SELECT DISTINCT job, CAST(0 AS BIGINT) AS rn, 'pending' AS status, '' AS owner, 0 AS attempts, 0.0::DOUBLE AS claimed_at, 0.0::DOUBLE AS seen_at, 0.0::DOUBLE AS ended_at, 0 AS beats FROM j
 UNION ALL SELECT e.job, e.rn, CASE WHEN {_CLAIM} THEN 'claimed' WHEN {_HELD} AND e.kind <> 'heartbeat' THEN e.kind ELSE s.status END, CASE WHEN {_CLAIM} THEN e.worker ELSE s.owner END,
  s.attempts + CAST({_CLAIM} AS INTEGER), CASE WHEN {_CLAIM} THEN e.t ELSE s.claimed_at END, CASE WHEN ({_CLAIM}) OR ({_HELD}) THEN e.t ELSE s.seen_at END,
  CASE WHEN {_HELD} AND e.kind <> 'heartbeat' THEN e.t ELSE s.ended_at END, s.beats + CAST({_HELD} AND e.kind = 'heartbeat' AS INTEGER) FROM s JOIN e ON e.job = s.job AND e.rn = s.rn + 1),
last AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY job ORDER BY rn DESC) = 1)"""
_ALL = f"WITH RECURSIVE {EVENT_SQL}, until AS (SELECT max(ts) AS moment FROM j), {_STATE_SQL}"
_EARLY = f"WITH RECURSIVE {EVENT_SQL}, until AS (SELECT min(ts) + INTERVAL 6 HOUR AS moment FROM j), {_STATE_SQL}"


def _events(spark, sf):
    return jobs.job_events(table(spark, sf, "events"))


def _early(spark, sf):
    """(states of all jobs six hours into the log, that time in seconds)."""
    e = _events(spark, sf)
    at = e.agg((F.min("ts") + F.expr("interval 6 hours")).alias("at")).first()["at"]
    at = F.lit(at)
    return jobs.final_states(e, at), at.cast("timestamp").cast("double")


_LEASE = ["job", "status", "owner", "attempts"]


@query("st_job_claim", f"{_ALL} SELECT job, status, owner, attempts FROM last")
def st_job_claim(spark, sf):
    """State of every job by keyed streaming state, with take-overs of stale claims."""
    return jobs.run_available(jobs.lease_stream(jobs.event_stream(spark, sf)), "leases", "update", "job").select(*_LEASE)


@query("st_job_claim_replay", f"{_ALL} SELECT job, status, owner, attempts FROM last")
def st_job_claim_replay(spark, sf):
    """The same by replaying each job's events in a batch."""
    return jobs.final_states(_events(spark, sf)).select(*_LEASE)


@query("st_job_claim_batch", f"{_EARLY} SELECT job FROM last WHERE status = 'pending' ORDER BY job LIMIT 20")
def st_job_claim_batch(spark, sf):
    """The first twenty jobs that were pending six hours into the log."""
    return _early(spark, sf)[0].filter("status = 'pending'").select("job").orderBy("job").limit(20)


@query("st_job_claim_next", f"{_EARLY} SELECT job, status FROM last, until WHERE status = 'pending' OR (status = 'claimed' AND seen_at < epoch_us(moment) / 1e6 - 900) ORDER BY status = 'claimed', claimed_at, job LIMIT 2000")
def st_job_claim_next(spark, sf):
    """Order in which jobs are claimed six hours into the log: pending ones, then stale ones by their claims."""
    s, at = _early(spark, sf)
    free = s.filter((F.col("status") == "pending") | ((F.col("status") == "claimed") & (F.col("seen_at") < at - jobs.STALE)))
    return free.orderBy(F.col("status") == "claimed", "claimed_at", "job").limit(2000).select("job", "status")


@query("st_heartbeat", f"{_ALL} SELECT job, beats, round(seen_at, 3) AS seen_at FROM last WHERE beats > 0")
def st_heartbeat(spark, sf):
    """Heartbeats of each job that came from the worker that held it, and its last sign of life."""
    return jobs.final_states(_events(spark, sf)).filter("beats > 0").select("job", "beats", F.round("seen_at", 3).alias("seen_at"))


@query("st_finish", f"{_ALL} SELECT job, status AS outcome, owner, round(ended_at, 3) AS ended_at FROM last WHERE status IN ('done', 'failed')")
def st_finish(spark, sf):
    """How and when each job was ended by the worker that held it."""
    return jobs.final_states(_events(spark, sf)).filter("status in ('done', 'failed')").select("job", F.col("status").alias("outcome"), "owner", F.round("ended_at", 3).alias("ended_at"))


@query("st_event_log", f"WITH {EVENT_SQL} SELECT kind, count(*) AS n FROM j GROUP BY 1")
def st_event_log(spark, sf):
    """Events by kind, counted over the stream."""
    found = jobs.run_available(jobs.job_events(jobs.event_stream(spark, sf)), "log")
    return found.groupBy("kind").agg(F.count("*").alias("n"))


@query("st_windowed", "SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def st_windowed(spark, sf):
    """Events of each day, by event time."""
    w = table(spark, sf, "events").groupBy("event_type", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select("event_type", F.col("w.start").alias("day"), "n", "total")


@query("st_incremental", f"WITH {SEG_SQL} SELECT segment_id FROM seg WHERE coalesce(impact_score, 0) >= 20 AND segment_id NOT IN (SELECT segment_id FROM chunks WHERE segment_id IS NOT NULL)")
def st_incremental(spark, sf):
    return joins.not_yet(segments(spark, sf, where=F.coalesce("impact_score", F.lit(0)) >= 20), table(spark, sf, "chunks"), "segment_id")


@query("st_embed_poll", f"WITH {CHUNK_SQL} SELECT chunk_id, (row_number() OVER (ORDER BY chunk_id) - 1) // 64 AS batch FROM ch WHERE embedded_at IS NULL")
def st_embed_poll(spark, sf):
    """Chunks without a vector, in batches of 64."""
    n = passages.numbered(chunks(spark, sf, where="embedded_at is null"), "chunk_id")
    return n.select("chunk_id", F.expr("(rn - 1) div 64").alias("batch"))


@query("st_visited", "SELECT url_canonical, max(fetched_at) AS last_fetch FROM documents_raw GROUP BY 1 HAVING max_by(coalesce(status_code, 0), (fetched_at, coalesce(status_code, 0))) = 200")
def st_visited(spark, sf):
    """URLs whose last fetch went well; all others are tried again."""
    code = F.coalesce("status_code", F.lit(0))
    v = table(spark, sf, "documents_raw").groupBy("url_canonical").agg(F.max("fetched_at").alias("last_fetch"), F.max_by(code, F.struct("fetched_at", code)).alias("code"))
    return v.filter("code = 200").select("url_canonical", "last_fetch")


@query("st_budget", f"""WITH {DOCS_SQL}, r AS (SELECT document_id, coalesce(sum(CAST(status_code = 200 AS INTEGER)) OVER (PARTITION BY municipality_id ORDER BY first_fetch, document_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pages FROM docs), b AS (SELECT unnest([10, 300]) AS budget)
SELECT budget, document_id, CAST(pages AS BIGINT) AS pages, pages < budget AS allowed FROM r, b""")
def st_budget(spark, sf):
    """Pages that a site had given before each fetch, failed ones not counted, and whether its budget allowed one more: of 300, and of 10."""
    before = Window.partitionBy("municipality_id").orderBy("first_fetch", "document_id").rowsBetween(Window.unboundedPreceding, -1)
    pages = F.coalesce(F.sum((F.col("status_code") == 200).cast("int")).over(before), F.lit(0)).alias("pages")
    r = docs(spark, sf, "municipality_id", "status_code", "first_fetch").select("document_id", pages)
    return r.select(F.explode(F.array(F.lit(10), F.lit(300))).alias("budget"), "document_id", "pages").withColumn("allowed", F.col("pages") < F.col("budget"))


@query("st_rate_limit", f"""WITH RECURSIVE {DOCS_SQL}, a AS (SELECT document_id, municipality_id, row_number() OVER (PARTITION BY municipality_id ORDER BY first_fetch, document_id) AS rn, epoch_us(first_fetch) // 60000000 AS minute FROM docs WHERE municipality_id IS NOT NULL),
s AS (SELECT document_id, municipality_id, rn, minute, minute AS start FROM a WHERE rn = 1 UNION ALL SELECT a.document_id, a.municipality_id, a.rn, a.minute, greatest(a.minute, s.start + 5) FROM s JOIN a ON a.municipality_id = s.municipality_id AND a.rn = s.rn + 1)
SELECT document_id, start - minute AS wait FROM s""")
def st_rate_limit(spark, sf):
    """Minutes that each fetch of a site has to wait so that two are five minutes apart."""
    d = docs(spark, sf, "municipality_id", "first_fetch").filter("municipality_id is not null")
    d = d.withColumn("minute", F.expr("unix_micros(cast(first_fetch as timestamp)) div 60000000"))
    return passages.spaced(d, ["municipality_id"], ["first_fetch", "document_id"], "minute", 5).select("document_id", (F.col("start") - F.col("minute")).alias("wait"))


@query("sort_job_priority", f"WITH {EVENT_SQL}, s AS (SELECT job, max_by(kind, (ts, id)) AS last_kind, max(ts) AS last_ts FROM j GROUP BY 1) SELECT job, last_kind FROM s ORDER BY CASE last_kind WHEN 'failed' THEN 0 WHEN 'claim' THEN 1 ELSE 2 END, last_ts, job LIMIT 30")
def sort_job_priority(spark, sf):
    s = _events(spark, sf).groupBy("job").agg(F.max_by("kind", F.struct("ts", "id")).alias("last_kind"), F.max("ts").alias("last_ts"))
    return s.orderBy(F.when(F.col("last_kind") == "failed", 0).when(F.col("last_kind") == "claim", 1).otherwise(2), "last_ts", "job").limit(30).select("job", "last_kind")


@query("join_job_claimed", f"WITH {EVENT_SQL}, o AS (SELECT job FROM j WHERE kind = 'claim' GROUP BY 1 ORDER BY job LIMIT 10) SELECT job, count(*) AS n FROM j WHERE job IN (SELECT job FROM o) GROUP BY 1")
def join_job_claimed(spark, sf):
    e = _events(spark, sf)
    own = e.filter("kind = 'claim'").select("job").distinct().orderBy("job").limit(10)
    return e.join(own, "job", "left_semi").groupBy("job").agg(F.count("*").alias("n"))
