"""Rolling sums over the previous rows of a key, cut by day so that no key sits in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_rows(
    df: DataFrame,
    keys: list[str],
    date: str,
    ties: list[str],
    measures: dict[str, tuple[str, str]],
    previous: int = 6,
) -> DataFrame:
    """Aggregate each row with its `previous` predecessors in (date, ties) order inside `keys`.

    `measures` maps the output name to (function, column), function being sum or avg.

    The frame never reaches further back than `previous` rows, and every day present has at least one
    row, so the last `previous` rows of each of the `previous` days before a day are all it can need.
    Those few rows are carried into the day, and the window runs per key and day. The only window over
    a whole key sees one row per day.
    """
    inputs = sorted({source for _, source in measures.values()})
    order = [F.col(c).asc_nulls_first() for c in ties]
    day_key = [*keys, date]
    tail_window = Window.partitionBy(*day_key).orderBy(*[F.col(c).desc_nulls_last() for c in ties])
    carried = F.struct(*[F.col(c) for c in ties], *[F.col(c).alias(f"_m_{c}") for c in inputs])
    # A day contributes its last rows; row_number <= k is applied per task before the shuffle.
    tails = (
        df.withColumn("_back", F.row_number().over(tail_window))
        .where(F.col("_back") <= previous)
        .groupBy(*day_key)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("_o"), carried.alias("_r")))).alias("_tail"))
    )
    earlier = Window.partitionBy(*keys).orderBy(date).rowsBetween(-previous, -1)
    context = (
        tails.withColumn("_all", F.flatten(F.collect_list("_tail").over(earlier)))
        .where(F.size("_all") > 0)
        .select(*day_key, F.posexplode(F.slice("_all", -F.least(F.size("_all"), F.lit(previous)), F.lit(previous))))
        .select(*day_key, (F.col("pos") - previous).alias("_seq"), F.col("col._r").alias("_r"))
    )
    context = context.select(
        *[F.col(c) for c in day_key],
        F.lit(True).alias("_context"),
        F.col("_seq"),
        *[F.col(f"_r._m_{c}").alias(f"_m_{c}") for c in inputs],
    )
    rows = df.withColumn("_context", F.lit(False)).withColumn("_seq", F.lit(0)).select(
        "*", *[F.col(c).alias(f"_m_{c}") for c in inputs]
    )
    both = rows.unionByName(context, allowMissingColumns=True)
    frame = (
        Window.partitionBy(*day_key)
        .orderBy(F.col("_context").desc(), "_seq", *order)
        .rowsBetween(-previous, 0)
    )
    apply = {"sum": F.sum, "avg": F.avg}
    out: dict[str, Column] = {
        name: apply[function](f"_m_{source}").over(frame) for name, (function, source) in measures.items()
    }
    return (
        both.withColumns(out)
        .where(~F.col("_context"))
        .drop("_context", "_seq", *[f"_m_{c}" for c in inputs])
    )


def rolling_days(
    df: DataFrame, keys: list[str], date: str, measures: dict[str, tuple[str, str]], previous: int = 6
) -> DataFrame:
    """Calendar variant: totals of the current and the `previous` days, whatever rows they have.

    Expects at most a few rows per key and day (a mart), whose day totals are taken first.
    """
    inputs = sorted({source for _, source in measures.values()})
    totals = df.groupBy(*keys, date).agg(
        *[F.sum(c).alias(f"_s_{c}") for c in inputs], *[F.count(c).alias(f"_n_{c}") for c in inputs]
    )
    frame = (
        Window.partitionBy(*keys).orderBy(F.unix_date(F.col(date))).rangeBetween(-previous, Window.currentRow)
    )
    out = {}
    for name, (function, source) in measures.items():
        total = F.sum(f"_s_{source}").over(frame)
        out[name] = total if function == "sum" else F.try_divide(total, F.sum(f"_n_{source}").over(frame))
    rolled = totals.withColumns(out).select(
        *[F.col(c).alias(f"_{c}") for c in [*keys, date]], *measures.keys()
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*keys, date]]
    return df.join(rolled, same, "left").drop(*[f"_{c}" for c in [*keys, date]])
