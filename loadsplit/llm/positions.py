"""Row numbers in a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage


def number_rows(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: how many rows stand before each in the order ``by``.

    Rows are dealt into range parts, sorted there and written once with their part
    and place, so that counts and numbers see the same parts; a part's offset
    comes from one count per part. Rows that are equal in ``by`` are told apart by
    input position and so can fill several parts. Columns ``_tie`` and ``_at``
    must not be in ``df``."""
    order = [*by, F.col("_tie")]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()) \
        .repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    # the id holds the part above its 33rd bit and the place in the part below
    rows = stage(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "row-parts")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")) \
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"))  # one row a part
    place = F.col("_at") - F.shiftleft("_part", 33)
    return rows.withColumn("_part", part).join(F.broadcast(totals), "_part").select(*df.columns, (F.col("_rows0") + place).cast("long").alias(name))
