"""Cross-section primitives for a universe so large that a trade date must not be one task.

Equal values of a date are counted before anything is shuffled, so a value that a third of the tickers share is one row a
task. A date's distinct values are cut into slices at approximate quantiles; a window within a slice and the sums of the slices
before it give every value its exact place, whatever the cuts are. Medians sort the values around a date's middle alone. What is joined by date
alone is one row, or SLICES rows, for each date of the calendar, which is small by its nature; what is joined by date and value
has one row for each value on one side, so that adaptive execution can split the other. The panel, and the facts of its dates,
are written to the shared folder before they are used several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .scalar import col, div, significant
from .xs import TIME

SLICES = 64
CLIP = 3 * 1.4826  # median absolute deviations


def places(df: DataFrame, value, slices: int = SLICES) -> DataFrame:
    """A row per date and distinct value that is not NULL: ``v``, how many rows have it (``n``), how many have less (``below``)
    and how many have any (``total``)."""
    counts = df.select(TIME, col(value).cast("double").alias("v")).where("v is not null").groupBy(TIME, "v").agg(
        F.count(F.lit(1)).alias("n"))
    shares = [i / slices for i in range(1, slices)] or [0.5]
    cuts = counts.groupBy(TIME).agg(F.percentile_approx("v", shares, 10_000).alias("cuts"))
    sliced = counts.join(F.broadcast(cuts), TIME).withColumn(
        "slice", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")
    within = Window.partitionBy(TIME, "slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    date = Window.partitionBy(TIME)  # a row per slice
    sums = sliced.groupBy(TIME, "slice").agg(F.sum("n").alias("held")).select(
        TIME, "slice", (F.sum("held").over(date.orderBy("slice")) - F.col("held")).alias("before"), F.sum("held").over(date).alias("total"))
    return (sliced.withColumn("upto", F.sum("n").over(within)).join(F.broadcast(sums), [TIME, "slice"])
            .select(TIME, "v", "n", (F.col("before") + F.col("upto") - F.col("n")).alias("below"), "total"))


def rank_pct(df: DataFrame, x, out: str, slices: int = SLICES) -> DataFrame:
    """Add the percent rank of ``x`` within its date, average rank for ties; NULL for NULL. As ``xs.rank_pct``."""
    df = written(df, "panel")
    ranks = places(df, significant(x), slices).select(
        F.col(TIME).alias("_date"), F.col("v").alias("_value"), ((F.col("below") + (F.col("n") + 1) / 2) / F.col("total")).alias(out))
    df = df.withColumn("_key", significant(x))
    return df.join(ranks, (df[TIME] == ranks["_date"]) & (df["_key"] == ranks["_value"]), "left").drop("_date", "_value", "_key")


def _middle(total):
    return F.floor((total - 1) / 2), F.floor(total / 2)


def middle(df: DataFrame, x, slices: int = SLICES) -> DataFrame:
    """The rows of ``places`` around each date's middle, among them those that hold its two middle places.

    Approximate quantiles on both sides of the middle cut a date in three, and counts say which parts hold the middle places,
    whatever the quantiles are. So only a part of the values, about one in ``slices``, is exchanged.
    """
    values = df.select(TIME, col(x).cast("double").alias("v")).where("v is not null")
    shares = [0.5 - 0.5 / slices, 0.5 + 0.5 / slices]
    cuts = values.groupBy(TIME).agg(F.percentile_approx("v", shares, 4 * slices).alias("cuts"))
    part = F.when(F.col("v") < F.col("cuts")[0], 0).when(F.col("v") <= F.col("cuts")[1], 1).otherwise(2)
    parted = values.join(F.broadcast(written(cuts, "cuts")), TIME).select(TIME, "v", part.alias("part"))
    date = Window.partitionBy(TIME)  # a row per part
    low, high = _middle(F.col("total"))
    end = F.col("before") + F.col("held")
    holding = (parted.groupBy(TIME, "part").agg(F.count(F.lit(1)).alias("held"))
               .select(TIME, "part", "held", (F.sum("held").over(date.orderBy("part")) - F.col("held")).alias("before"),
                       F.sum("held").over(date).alias("total"))
               .where(((F.col("before") <= low) & (low < end)) | ((F.col("before") <= high) & (high < end))))
    within = Window.partitionBy(TIME, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (parted.join(F.broadcast(written(holding, "parts")), [TIME, "part"])
            .groupBy(TIME, "part", "v", "before", "total").agg(F.count(F.lit(1)).alias("n"))
            .select(TIME, "v", "n", (F.col("before") + F.sum("n").over(within) - F.col("n")).alias("below"), "total"))


def median(df: DataFrame, x, out: str, slices: int = SLICES) -> DataFrame:
    """(date, median of ``x``) for every date that has a value: the mean of the two middle values."""
    low, high = _middle(F.col("total"))
    end = F.col("below") + F.col("n")

    def holds(place):
        return (F.col("below") <= place) & (place < end)

    picked = middle(df, x, slices).where(holds(low) | holds(high))
    return picked.groupBy(TIME).agg(
        ((F.max(F.when(holds(low), F.col("v"))) + F.max(F.when(holds(high), F.col("v")))) / 2).alias(out))


def _by_date(df: DataFrame, facts: DataFrame) -> DataFrame:
    return df.join(F.broadcast(written(facts, "facts")), TIME, "left")


def winsorize(df: DataFrame, x: str, out: str, market_value: str | None = None, slices: int = SLICES) -> DataFrame:
    """Clip at median +- 3 * 1.4826 * MAD per date; a date with a missing value becomes NULL. As ``xs.winsorize``."""
    return _winsorized(written(df, "panel"), x, out, market_value, slices)


def _winsorized(df, x, out, market_value, slices):
    gap = F.col(x).isNull() if market_value is None else F.col(x).isNull() | F.col(market_value).isNull()
    whole = df.groupBy(TIME).agg((F.count_if(gap) == 0).alias("_whole"))
    df = _by_date(_by_date(df, whole), median(df, x, "_med", slices)).withColumn("_med", F.when(F.col("_whole"), F.col("_med")))
    df = _by_date(df, median(df, F.abs(F.col(x) - F.col("_med")), "_mad", slices))
    band = F.col("_mad") * CLIP
    clipped = F.greatest(F.least(F.col(x), F.col("_med") + band), F.col("_med") - band)
    return df.withColumn(out, F.when(F.col("_med").isNotNull(), clipped)).drop("_whole", "_med", "_mad")


def standardize(df: DataFrame, x: str, out: str, market_value: str | None = None, slices: int = SLICES) -> DataFrame:
    return _standardized(written(df, "panel"), x, out, market_value, slices)


def _standardized(df, x, out, market_value, slices):
    df = _winsorized(df, x, "_clip", market_value, slices)
    facts = df.groupBy(TIME).agg(F.avg("_clip").alias("_avg"), F.stddev_pop("_clip").alias("_dev"))
    return _by_date(df, facts).withColumn(out, div(F.col("_clip") - F.col("_avg"), "_dev")).drop("_clip", "_avg", "_dev")


def neutralize(df: DataFrame, x: str, out: str, market_value: str = "neg_market_value", slices: int = SLICES) -> DataFrame:
    """Size-neutral residual: winsorize, standardize, subtract the fit on market value. As ``xs.neutralize``."""
    df = _standardized(written(df, "panel"), x, "_z", market_value, slices)
    facts = df.groupBy(TIME).agg(
        F.avg("_z").alias("_az"), F.avg(market_value).alias("_am"),
        F.coalesce(div(F.covar_pop(F.col(market_value), F.col("_z")), F.var_pop(market_value)), F.lit(0.0)).alias("_beta"))
    fit = F.col("_az") + F.col("_beta") * (F.col(market_value) - F.col("_am"))
    return _by_date(df, facts).withColumn(out, F.col("_z") - fit).drop("_z", "_az", "_am", "_beta")
