"""Registered staging / run-report (A) and windowed-count (T5) queries over ``events``.

Binding: an event is a staged entry (entry_number = event_id, arrival = ts); its outcome is
'failed' for error events, 'skipped' for view events and 'success' otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import readers as RD
from ..sources import staging as ST
from ..sources import status as STS
from ..streaming import incremental as INC
from . import bindings as B
from .catalog import register, with_ctes

EVENTS_STATUS_CTE = """
st AS (
  SELECT 'events' AS dataset, event_id AS entry_number, CAST(floor((event_id - 1) / 1000.0) AS BIGINT) AS chunk,
         CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN 'skipped' ELSE 'success' END
           AS status, ts, user_id
  FROM events)"""


def _status(spark, d):
    e = B.table(spark, d, "events")
    s = e.select(F.lit("events").alias("dataset"), F.col("event_id").alias("entry_number"), "ts", "user_id", "event_type")
    s = RD.with_chunk(s, 1000)
    return s.withColumn("status", F.when(F.col("event_type") == "error", "failed")
                                   .when(F.col("event_type") == "view", "skipped").otherwise("success"))


@register("entry_chunks", """
SELECT CAST(floor((event_id - 1) / 1000.0) AS BIGINT) AS chunk, count(*) AS entries, min(event_id) AS first_entry,
       max(event_id) AS last_entry FROM events GROUP BY 1""")
def entry_chunks(spark, d):
    e = RD.with_chunk(B.table(spark, d, "events").withColumnRenamed("event_id", "entry_number"), 1000)
    return e.groupBy("chunk").agg(F.count(F.lit(1)).alias("entries"), F.min("entry_number").alias("first_entry"),
                                  F.max("entry_number").alias("last_entry"))


@register("resume_from_chunk", """
SELECT event_id AS entry_number FROM events WHERE floor((event_id - 1) / 1000.0) >= 3""")
def resume_from_chunk(spark, d):
    e = B.table(spark, d, "events").withColumnRenamed("event_id", "entry_number")
    return RD.from_chunk(e, 3, 1000).select("entry_number")


@register("select_entry_range", """
SELECT event_id AS entry_number, ts FROM events WHERE event_id BETWEEN 100 AND 250""")
def select_entry_range(spark, d):
    e = B.table(spark, d, "events").withColumnRenamed("event_id", "entry_number")
    return RD.select_entries(e, 100, 250).select("entry_number", "ts")


@register("skip_staged_entries", """
SELECT event_id AS entry_number FROM events
WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'click')""")
def skip_staged_entries(spark, d):
    e = B.table(spark, d, "events").select(F.lit("events").alias("dataset"), F.col("event_id").alias("entry_number"),
                                           "event_type")
    staged = e.filter(F.col("event_type") == "click").select("dataset", F.col("entry_number").alias("entryNumber"))
    return ST.skip_existing(e, staged).select("entry_number")


@register("staged_counts", """
SELECT 'events' AS dataset, count(*) AS staged, min(event_id) AS first_entry, max(event_id) AS last_entry
FROM events WHERE event_type <> 'error'""")
def staged_counts(spark, d):
    e = B.table(spark, d, "events").filter(F.col("event_type") != "error").select(
        F.lit("events").alias("dataset"), F.col("event_id").alias("entryNumber"))
    return ST.staged_entries(e)


@register("missing_entries", """
WITH staged AS (SELECT 'user ' || CAST(user_id % 3 AS VARCHAR) AS dataset, event_id FROM events WHERE event_type <> 'error'),
ends AS (SELECT dataset, max(event_id) AS hi FROM staged GROUP BY dataset)
SELECT dataset, CAST(r AS BIGINT) AS entry_number
FROM range(1, (SELECT max(event_id) FROM events) + 1) t(r) JOIN ends ON r <= hi
WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.dataset = ends.dataset AND s.event_id = r)""")
def missing_entries(spark, d):
    e = B.table(spark, d, "events").filter(F.col("event_type") != "error")
    dataset = F.concat(F.lit("user "), (F.col("user_id") % 3).cast("string"))
    return ST.missing_entries(e.select(dataset.alias("dataset"), F.col("event_id").alias("entryNumber")), 1)


@register("stage_entry_range", """
SELECT event_id AS entryNumber FROM events WHERE event_id BETWEEN 500 AND 1500""")
def stage_entry_range(spark, d):
    e = B.table(spark, d, "events").select(F.col("event_id").alias("entryNumber"))
    return ST.stage_range(e, 500, 1500)


@register("run_summary", with_ctes(EVENTS_STATUS_CTE) + """
SELECT count(*) AS processed, count(*) FILTER (WHERE status = 'success') AS successful,
       count(*) FILTER (WHERE status IN ('skipped', 'existing')) AS skipped,
       count(*) FILTER (WHERE status = 'failed') AS failed FROM st""")
def run_summary(spark, d):
    return STS.summarise_run(_status(spark, d))


@register("failed_entries", with_ctes(EVENTS_STATUS_CTE) + """
SELECT entry_number FROM st WHERE status = 'failed'""")
def failed_entries(spark, d):
    return STS.failed_rows(_status(spark, d)).select("entry_number")


@register("sample_successes", with_ctes(EVENTS_STATUS_CTE) + """
SELECT entry_number FROM st WHERE status = 'success' ORDER BY dataset, entry_number LIMIT 5""")
def sample_successes(spark, d):
    return STS.sample_rows(_status(spark, d), 5).select("entry_number")


@register("chunk_report", with_ctes(EVENTS_STATUS_CTE, """
per AS (SELECT dataset, chunk, count(*) AS entries, count(*) FILTER (WHERE status = 'success') AS successful,
               count(*) FILTER (WHERE status = 'failed') AS failed, min(ts) AS started, max(ts) AS ended
        FROM st GROUP BY dataset, chunk)""") + """
SELECT dataset, chunk, entries, successful, failed, started, ended,
       sum(entries) OVER (PARTITION BY dataset ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS processed_so_far,
       round(successful / entries, 6) AS success_rate
FROM per""")
def chunk_report(spark, d):
    return STS.chunk_report(_status(spark, d)).select("dataset", "chunk", "entries", "successful", "failed", "started",
                                                      "ended", "processed_so_far", "success_rate")


@register("retry_entries", with_ctes(EVENTS_STATUS_CTE, """
last AS (SELECT user_id, (max({'t': ts, 's': status})).s AS last_status FROM st GROUP BY user_id)""") + """
SELECT DISTINCT c_custkey AS user_id FROM customer
WHERE c_custkey IN (SELECT user_id FROM last WHERE last_status = 'failed')""")
def retry_entries(spark, d):
    # Entries keyed by user: the raw set is customers, the outcome log is their events.
    raw = B.table(spark, d, "customer").select(F.lit("events").alias("dataset"), F.col("c_custkey").alias("user_id"))
    out = STS.retry_set(raw, _status(spark, d), keys=("dataset", "user_id"))
    return out.select("user_id").distinct()


@register("hourly_event_counts", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS count FROM events GROUP BY 1, 2""")
def hourly_event_counts(spark, d):
    return INC.recent_counts(B.table(spark, d, "events"), "ts", "1 hour")


_LAST_HOUR = """
b AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS b FROM events),
w AS (SELECT b + INTERVAL 15 MINUTE * k AS until FROM b, (SELECT unnest(range(1, 5)) AS k))"""


@register("events_last_hour", with_ctes(_LAST_HOUR) + """
SELECT until, count(*) AS count FROM w GROUP BY until""")
def events_last_hour(spark, d):
    """T5 in its batch form: the events of the hour before each quarter."""
    return INC.last_interval_counts(B.table(spark, d, "events"))


@register("events_last_hour_live", with_ctes(_LAST_HOUR) + """
SELECT until, count(*) AS count FROM w WHERE until <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events) GROUP BY until""")
def events_last_hour_live(spark, d):
    """The same as a stream over the table's files with a file sink: each point that the watermark has passed."""
    base = f"{ensure_checkpoint_dir(spark)}/live-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{d}/events.parquet").schema
    # A stream takes a folder or a pattern; the table may be a file.
    INC.stream_last_interval(spark, f"{d}/[e]vents.parquet", events, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out")
