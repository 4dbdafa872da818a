"""First-wins, last-wins and global positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A position bucket spans 2**20 order values, so it never holds more than ~1M rows.
_BUCKET_BITS = 20
_ORDER_LIMIT_BITS = 60


def _columns(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _ranked_first(df: DataFrame, key, order: list[Column], keep: int = 1) -> DataFrame:
    window = Window.partitionBy(*_columns(key)).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= keep).drop("_rank")
    )


def first_wins(df: DataFrame, key, order) -> DataFrame:
    """Earliest row per key. Map tasks drop all but one row per key before the shuffle."""
    return _ranked_first(df, key, [F.col(c).asc() for c in _columns(order)])


def last_wins(df: DataFrame, key, order) -> DataFrame:
    """Latest row per key, with the same early drop."""
    return _ranked_first(df, key, [F.col(c).desc() for c in _columns(order)])


def first_n(df: DataFrame, key, order, n: int) -> DataFrame:
    """The first n rows per key (a result limit of the service, not a sample)."""
    return _ranked_first(df, key, [F.col(c).asc() for c in _columns(order)], n)


def replace_rows(current: DataFrame, changes: DataFrame, key, order) -> DataFrame:
    """current with the latest change of each key put in.

    The anti join needs the changed keys only. Where these are few, AQE sees their size and
    broadcasts them, so the large table is neither shuffled nor sorted.
    """
    changed = changes.select(*_columns(key)).distinct()
    untouched = current.join(changed, _columns(key), "left_anti")
    return untouched.unionByName(last_wins(changes, key, order).select(*current.columns))


def with_position(df: DataFrame, order: str, name: str = "position") -> DataFrame:
    """0-based position of each row by a unique, non-negative BIGINT order column.

    Rows are counted per bucket of 2**20 order values, bucket counts are summed level by
    level, and only the last step ranks rows, inside their bucket. No window sees more than
    2**20 rows and nothing passes through the driver.
    """
    value = F.col(order)
    guarded = F.assert_true(
        (value >= 0) & (value < F.lit(1 << _ORDER_LIMIT_BITS)), "order column out of range"
    )
    bucketed = df.withColumn("_bucket", F.shiftright(value, _BUCKET_BITS))

    counts = (
        df.filter(guarded.isNull())
        .groupBy(F.shiftright(value, _BUCKET_BITS).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    blocks = counts.groupBy(F.shiftright("_bucket", _BUCKET_BITS).alias("_block")).agg(
        F.sum("_n").alias("_n")
    )

    def running_start(table: DataFrame, group: Column, step: str) -> Column:
        before = (
            Window.partitionBy(group)
            .orderBy(step)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return F.coalesce(F.sum("_n").over(before), F.lit(0))

    block_start = blocks.select(
        "_block",
        running_start(blocks, F.shiftright("_block", _BUCKET_BITS), "_block").alias("_block_start"),
    )
    bucket_start = (
        counts.withColumn("_block", F.shiftright("_bucket", _BUCKET_BITS))
        .withColumn("_within", running_start(counts, F.col("_block"), "_bucket"))
        .join(block_start, "_block")
        .select("_bucket", (F.col("_block_start") + F.col("_within")).alias("_start"))
    )
    in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    return (
        bucketed.withColumn("_row", in_bucket)
        .join(bucket_start, "_bucket")
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_bucket", "_row", "_start")
    )
