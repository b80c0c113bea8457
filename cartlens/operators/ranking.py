"""Exact order statistics and NTILE without a single-task window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from cartlens.session import kept

# monotonically_increasing_id: partition number above, row number below this bit
_ROW_BITS = 33
#: One over the error of the first look, as a share of the rows.
ACCURACY = 10_000


def continuous_percentiles(
    df: DataFrame, value: str, fractions: list[float], accuracy: int = ACCURACY
) -> Column:
    """PERCENTILE_CONT of the non-null values, linear between neighbours: an array, as a scalar of the plan.

    Nothing runs until a plan that uses it does, and nothing is sorted. A sketch that is off by
    at most one ``accuracy``-th of the rows gives an interval around each percentile. One
    aggregation then counts the rows before each interval and makes a histogram of the values
    inside, in which the rank is looked up. So some n / 1,000 different values per fraction meet at
    the end, however often they occur. Nulls where there are no values.
    """
    values = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    margin = 4 / accuracy
    edges = [edge for f in fractions for edge in (max(0.0, f - margin), min(1.0, f + margin))]
    numbers = range(len(fractions))
    # the subquery stands in the plan once
    edged = values.withColumn("edges", values.agg(F.percentile_approx("v", edges, accuracy)).scalar())
    v, low, high = F.col("v"), *([F.get("edges", F.lit(2 * i + k)) for i in numbers] for k in (0, 1))
    inside = reduce(lambda a, b: a | b, [v.between(low[i], high[i]) for i in numbers])
    around = [
        part
        for i in numbers
        for part in (
            F.count_if(v < low[i]).alias(f"before{i}"),
            F.max(F.when(v < low[i], v)).alias(f"last{i}"),
            F.min(F.when(v > high[i], v)).alias(f"next{i}"),
            F.min(low[i]).alias(f"low{i}"),
            F.min(high[i]).alias(f"high{i}"),
        )
    ]
    counted = edged.groupBy(F.when(inside, v).alias("k")).agg(F.count(F.lit(1)).alias("n"), *around)
    histogram = F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "n")))
    folds = {"before": F.sum, "last": F.max, "next": F.min, "low": F.min, "high": F.min}
    known = counted.agg(
        F.sum("n").alias("n"),
        F.sort_array(histogram).alias("histogram"),
        *[fold(f"{name}{i}").alias(f"{name}{i}") for i in numbers for name, fold in folds.items()],
    )

    def at(rank: Column, i: int) -> Column:
        """The value at a rank from 0, among those of interval ``i`` and the two beside it."""
        own = F.filter("histogram", lambda x: x["k"].between(F.col(f"low{i}"), F.col(f"high{i}")))
        start = F.struct(F.col(f"before{i}").alias("seen"), F.lit(None).cast("double").alias("found"))

        def step(state: Column, x: Column) -> Column:
            seen = state["seen"] + x["n"]
            found = F.coalesce(state["found"], F.when(seen > rank, x["k"]))
            return F.struct(seen.alias("seen"), found.alias("found"))

        end = F.aggregate(own, start, step)
        # the sketch's rank may lie one row beside that of the interpolation
        missed = F.raise_error(F.lit("a percentile lies outside the interval of its sketch")).cast("double")
        return (
            F.when(rank == F.col(f"before{i}") - 1, F.col(f"last{i}"))
            .when(rank < F.col(f"before{i}") - 1, missed)
            .when(rank < end["seen"], end["found"])
            .when(rank == end["seen"], F.col(f"next{i}"))
            .otherwise(missed)
        )

    def percentile(i: int) -> Column:
        place = F.lit(fractions[i]) * (F.col("n") - 1)
        below = at(F.floor(place), i)
        return F.when(F.col("n") > 0, below + (at(F.ceil(place), i) - below) * (place - F.floor(place)))

    return known.select(F.array(*[percentile(i) for i in numbers])).scalar()


def rows_at_ranks(
    df: DataFrame, orders: list[str], unique: str, ranks: list[list[int]]
) -> list[dict[int, Row]]:
    """For each column of ``orders``, its rows at 0-based positions of the order (column, ``unique``).

    One sort serves all columns: a row of ``df`` becomes a row per column, and the column's number
    leads the order. The unique column keeps the ranges even when one value is very frequent. The
    sorted rows are kept as Parquet in the shared folder, so that positions belong to one run of the
    sort even if executors are lost, and a lookup reads the few row groups that hold its rows. The
    driver sees a size per partition and column, and the rows looked up.
    """
    names = [f"_v{i}" for i in range(len(orders))]

    def own(i: int) -> Column:
        values = [
            F.when(F.lit(i == j), F.col(column)).alias(name) for j, (name, column) in enumerate(zip(names, orders, strict=True))
        ]
        return F.struct(F.lit(i).alias("_order"), *values, F.col(unique).alias("_unique"))

    tall = df.select(F.inline(F.array(*[own(i) for i in range(len(orders))])))
    slots = kept(
        tall.orderBy("_order", *names, "_unique").withColumn("_slot", F.monotonically_increasing_id())
    )
    runs = (
        slots.groupBy("_order", F.shiftright("_slot", _ROW_BITS).alias("part"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("_slot").alias("first"))
        .orderBy("_order", "part")
        .collect()
    )
    wanted: dict[int, tuple[int, int]] = {}
    for i, own_ranks in enumerate(ranks):
        before = 0
        for run in (x for x in runs if x["_order"] == i):
            for rank in own_ranks:
                if before <= rank < before + run["n"]:
                    wanted[run["first"] + rank - before] = (i, rank)
            before += run["n"]
    found: list[dict[int, Row]] = [{} for _ in orders]
    if wanted:
        for row in slots.filter(F.col("_slot").isin(list(wanted))).collect():
            i, rank = wanted[row["_slot"]]
            found[i][rank] = row
    return found


def with_ntiles(df: DataFrame, buckets: int, values: dict[str, str], unique: str) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY value, unique)`` columns, one per entry of ``values``.

    ``values`` maps the new column to the one it ranks. Only the first row of each bucket has to be
    known: a row's bucket is 1 plus the number of bucket starts that do not come after it. ``df`` is
    read three times and should be cheap to read (a table or a ``kept`` result); the last pass is a
    plain projection.
    """
    size, longer = divmod(df.count(), buckets)
    total = size * buckets + longer
    firsts = [b * size + min(b, longer) for b in range(1, buckets)]
    starts = sorted({first for first in firsts if first < total})
    found = rows_at_ranks(df, list(values.values()), unique, [starts] * len(values))

    def reached(value: str, name: str, row: Row) -> Column:
        # nulls come first, as in the sort
        edge = F.lit(row[name]).cast(df.schema[value].dataType)
        key = F.lit(row["_unique"]).cast(df.schema[unique].dataType)
        tied = F.col(value).eqNullSafe(edge) & (F.col(unique) >= key)
        if row[name] is None:
            return tied | F.col(value).isNotNull()
        return F.coalesce(F.col(value) > edge, F.lit(False)) | tied

    tiles = {}
    for i, (name, value) in enumerate(values.items()):
        steps = [reached(value, f"_v{i}", row).cast("int") for row in found[i].values()]
        tiles[name] = reduce(lambda a, b: a + b, steps, F.lit(1))
    return df.withColumns(tiles)


def with_ntile(df: DataFrame, buckets: int, value: str, unique: str, name: str) -> DataFrame:
    """``with_ntiles`` for one column."""
    return with_ntiles(df, buckets, {name: value}, unique)
