"""Window calculations. Windows without partitions only ever run on aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cabrank.operators import aggregates as a


def lag_growth(df: DataFrame, order: list[str], column: str, previous: str, growth: str, by: list[str]) -> DataFrame:
    """Previous period's value and the growth against it, per partition."""
    periods = Window.partitionBy(*by).orderBy(*order)
    with_previous = df.withColumn(previous, F.lag(column).over(periods))
    return with_previous.withColumn(growth, a.growth_percent(F.col(column), F.col(previous)))


def row_number_rank(df: DataFrame, rankings: dict[str, list], by: list[str] | None = None) -> DataFrame:
    """Several rankings at once: result name -> sort order (end it with a unique key)."""
    return df.withColumns(
        {name: F.row_number().over(Window.partitionBy(*(by or [])).orderBy(*order)) for name, order in rankings.items()}
    )


def moving_average(df: DataFrame, order: str, column: str, sizes: dict[str, int], by: list[str] | None = None) -> DataFrame:
    """Means over the last n rows, fewer at the start: result name -> n."""
    base = Window.partitionBy(*(by or [])).orderBy(order)
    return df.withColumns({name: F.avg(column).over(base.rowsBetween(-(n - 1), 0)) for name, n in sizes.items()})


def running_count(df: DataFrame, order: str, by: list[str], name: str = "running_trips") -> DataFrame:
    """Rows up to and including the current moment, as an ordered window with its default frame gives it.

    Peers (rows of the same moment) share the value. It is computed from one
    row per moment, so a busy partition is reduced before it is put in order.
    """
    moments = df.groupBy(*by, order).agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy(*by).orderBy(order)
    return moments.select(*by, order, F.col("_rows").alias("rows_now"), F.sum("_rows").over(upto).alias(name))


def last_n_vs_prev_n(df: DataFrame, order: str, column: str, n: int = 7) -> DataFrame:
    """Mean of the last n rows against the n rows before, with the change in percent."""
    recent = df.withColumn("_back", F.row_number().over(Window.orderBy(F.desc(order))))
    last = F.avg(F.when(F.col("_back") <= n, F.col(column)))
    previous = F.avg(F.when(F.col("_back").between(n + 1, 2 * n), F.col(column)))
    means = recent.agg(last.alias("last_avg"), previous.alias("previous_avg"))
    change = F.try_divide(F.col("last_avg") - F.col("previous_avg"), F.col("previous_avg")) * 100
    return means.withColumn("trend_pct", change)
