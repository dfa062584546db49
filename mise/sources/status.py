"""Per-entry outcomes and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import running_sum


def with_status(df: DataFrame, ok: Column, error: Column | None = None, corrupt: str = "_corrupt_record") -> DataFrame:
    """A ``status`` ('success' / 'failed') and ``error`` column per row; a bad row is an
    outcome, the job goes on.  Rows flagged by a PERMISSIVE read (``_corrupt_record``) fail."""
    bad = ~F.coalesce(ok, F.lit(False))
    if corrupt in df.columns:
        bad = bad | F.col(corrupt).isNotNull()
    err = error if error is not None else F.lit("record rejected")
    return df.withColumn("status", F.when(bad, F.lit("failed")).otherwise(F.lit("success"))) \
             .withColumn("error", F.when(bad, err))


def summarise_run(status: DataFrame) -> DataFrame:
    """Processed, successful, skipped (already present) and failed, in one aggregate."""
    s = F.col("status")
    return status.agg(F.count(F.lit(1)).alias("processed"), F.count_if(s == "success").alias("successful"),
                      F.count_if(s.isin("skipped", "existing")).alias("skipped"),
                      F.count_if(s == "failed").alias("failed"))


def failed_rows(status: DataFrame) -> DataFrame:
    """Every failed entry with its error."""
    return status.filter(F.col("status") == "failed")


def sample_rows(status: DataFrame, n: int = 5, order=("dataset", "entry_number")) -> DataFrame:
    """The first ``n`` successes in a fixed order (a top-k, not a sample of the driver)."""
    return status.filter(F.col("status") == "success").orderBy(*order).limit(n)


def chunk_report(status: DataFrame, ts: str = "ts") -> DataFrame:
    """Per (dataset, chunk): entries, successes, failures, time span, rate, and the running
    number of processed entries.  The running sum is over the per-chunk aggregate only."""
    per = status.groupBy("dataset", "chunk").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"), F.min(ts).alias("started"), F.max(ts).alias("ended"))
    secs = F.unix_timestamp("ended") - F.unix_timestamp("started")
    per = running_sum(per, ["dataset"], ["chunk"], "entries", "processed_so_far")
    return (per.withColumn("success_rate", F.round(F.col("successful") / F.col("entries"), 6))
               .withColumn("seconds", secs)
               .withColumn("entries_per_second", F.when(secs > 0, F.round(F.col("entries") / secs, 6))))


def retry_set(raw: DataFrame, status: DataFrame, keys=("dataset", "entry_number"), ts: str = "ts") -> DataFrame:
    """Raw entries whose most recent outcome is 'failed' (the greatest pair
    of time and status per entry, then semi join), so of outcomes at one time the last by name counts."""
    keys = list(keys)
    last = status.groupBy(*keys).agg(F.max(F.struct(ts, "status")).alias("_last"))
    return raw.join(last.filter(F.col("_last.status") == "failed").select(*keys), keys, "left_semi")
