"""Top-k and positions with a total order, so that reruns give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.session import materialize


def with_position(df: DataFrame, order: list[Column]) -> DataFrame:
    """Number a result of ``limit`` rows 1..n; ``order`` must end in a unique key."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def numbered(df: DataFrame, order: list[Column], kind: str = "int") -> DataFrame:
    """The same for a result of any size: sorted by ranges, written with each row's range and place
    in it, and numbered by adding the sizes of the ranges before. ``order`` must end in a unique
    key; no task sees more than a range, and the list of ranges has a row per task. ``kind`` is the
    type of the position: ``long`` where there may be more than 2**31 rows."""
    place = F.monotonically_increasing_id()
    ranges = materialize(df.orderBy(*order).withColumn("place", place), "numbered")
    of = F.shiftright("place", 33)
    sizes = ranges.groupBy(of.alias("range")).agg(F.count("*").alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("range", before.alias("before"))
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    joined = ranges.join(F.broadcast(offsets), of == F.col("range"))
    return joined.select(*df.columns, (F.col("before") + within + 1).cast(kind).alias("position"))


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows, numbered. Each task keeps ``n`` rows and only those are merged."""
    return with_position(df.orderBy(*order).limit(n), order)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group, numbered.

    Spark cuts each group to ``n`` rows in every task before the shuffle (WindowGroupLimit), so
    a hot group never arrives whole in one task.
    """
    numbered = df.withColumn(
        "position", F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    )
    return numbered.filter(F.col("position") <= n)
