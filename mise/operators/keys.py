"""Key helpers: dense surrogate ids without a single-partition window, size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


#: Rows of a table for each task, on average, where :func:`tasks_for` says how many parts to deal it into.
ROWS_PER_TASK = 250_000


def tasks_for(df: DataFrame, rows: int | None = None) -> int:
    """Parts to deal ``df`` into so that a task's share, of ROWS_PER_TASK or ``rows``, doesn't grow with the table.

    For a join that groupings with its keys follow: they all run in the tasks of the join, where
    each holds its rows in memory, and adaptive coalescing goes by compressed bytes alone.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // (rows or ROWS_PER_TASK)))


def dense_ids(df: DataFrame, order_cols: Sequence[str], start: Column | int = 0, id_col: str = "id",
              partitions: int | None = None) -> DataFrame:
    """Number rows 1..n (plus ``start``) in ``order_cols`` order, like a global ``row_number``.

    The rows are range-partitioned on the order, numbered inside each partition, and offset by
    the row counts of the earlier partitions; only the per-partition counts (one row per
    partition) pass through a single task.  The range-partitioned frame is checkpointed to the
    shared checkpoint folder so that partition ids and positions are fixed before they are used
    twice.  ``order_cols`` should be a total order (e.g. distinct names).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = list(order_cols)
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                .withColumn("_b", F.spark_partition_id())
                .withColumn("_i", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    stats = ranged.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_i0"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    start_col = start if isinstance(start, Column) else F.lit(start)
    # ``stats`` has one row per partition: its size is bounded by ``n``, so broadcasting it is safe.
    return (ranged.join(F.broadcast(stats), "_b")
                  .withColumn(id_col, (start_col + F.col("_off") + (F.col("_i") - F.col("_i0")) + 1).cast("bigint"))
                  .drop("_b", "_i", "_n", "_i0", "_off"))


def max_id(df: DataFrame, id_col: str = "id") -> Column:
    """Scalar-subquery column with the current max id (0 for an empty table)."""
    return df.select(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str,
                partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` up to and including each row, in ``order`` within ``by``.

    Like :func:`dense_ids`: rows are range-partitioned on the order, summed inside each partition,
    and offset by the sums of the earlier partitions, so that no task gets a whole group.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by, order = list(by), list(order)
    ranged = df.repartitionByRange(n, *by, *order).withColumn("_b", F.spark_partition_id()).checkpoint(eager=True)
    inside = Window.partitionBy("_b", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per partition and group that it holds.
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*by, "_b").agg(F.sum(value).alias("_part"))
    offsets = offsets.select(*by, "_b", F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_off"))
    return (ranged.withColumn("_in", F.sum(value).over(inside)).join(offsets, [*by, "_b"])
                  .withColumn(out, F.col("_off") + F.col("_in")).drop("_b", "_in", "_off"))
