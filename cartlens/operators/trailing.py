"""Exact distinct counts over sliding ranges of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trailing_distinct(df: DataFrame, entity: str, date: str, days: dict[str, int]) -> DataFrame:
    """Per date with rows: how many entities occurred on it or in the days before it.

    ``days`` maps an output name to the length of its range, the date itself included.

    An entity counts from the date it occurs on for as many days as the range is long. Where its
    next occurrence comes before that ends, the two stretches are one. So each stretch adds 1 on
    its first date and takes 1 away after its last, and a running sum over dates counts them. A row
    per entity and date is shuffled once however long the ranges are; the sum runs over a row per
    date. Rows without an entity or a date are left out.
    """
    active = df.select(F.col(entity).alias("_entity"), F.col(date).alias("_date")).dropna().distinct()
    own = Window.partitionBy("_entity").orderBy("_date")
    between = active.withColumns(
        {
            "_since": F.datediff("_date", F.lag("_date").over(own)),
            "_until": F.datediff(F.lead("_date").over(own), "_date"),
        }
    )

    def change(length: int, apart: str, sign: int) -> Column:
        # stretches that touch cancel out on the day they meet
        return F.when(F.col(apart).isNull() | (F.col(apart) >= length), sign).otherwise(0)

    def changes(at: Column, rows: int, own: dict[str, Column]) -> Column:
        values = [own.get(name, F.lit(0)).alias(name) for name in days]
        return F.struct(at.alias("_at"), F.lit(rows).alias("_rows"), *values)

    starts = changes(F.col("_date"), 1, {name: change(length, "_since", 1) for name, length in days.items()})
    ends = [
        changes(F.date_add("_date", length), 0, {name: change(length, "_until", -1)}) for name, length in days.items()
    ]
    by_date = (
        between.select(F.inline(F.array(starts, *ends)))
        .groupBy("_at")
        .agg(F.sum("_rows").alias("_rows"), *[F.sum(name).alias(name) for name in days])
    )
    running = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        by_date.select("_at", "_rows", *[F.sum(name).over(running).alias(name) for name in days])
        .filter(F.col("_rows") > 0)
        .select(F.col("_at").alias(date), *days)
    )
