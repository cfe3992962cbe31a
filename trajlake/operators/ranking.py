"""Places in one order over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.storage import materialize


def places(rows: DataFrame, order: list[str | Column], name: str = "place") -> DataFrame:
    """The rows with their place from 1 in a total order. Ranges of the order are sorted apart and written once, as their bounds are drawn
    anew in each run; a range starts after the counted rows of those before it, so the driver and one task see a number per range only."""
    at = F.monotonically_increasing_id()  # the partition above 33 bits of the row's number in it
    s = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "places")
    s = s.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = s.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return s.join(F.broadcast(starts), "_range").select(*rows.columns, place.alias(name))
