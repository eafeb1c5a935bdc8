"""Monthly series features, forecasting and allocation.

All windows here run over monthly counts (type x month), which stay small
however large the event table is: aggregate first, window second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazardspark.functions import dates as D

FEATURES = [
    "month", "anos_desde_2000", "trimestre", "estacao_chuvosa", "estacao_seca", "sin_month",
    "cos_month", "seasonal_risk", "lag_12", "rolling_mean_6", "rolling_std_6",
]


def _series() -> W:
    return W.partitionBy("type").orderBy("year", "month")


def with_lag(monthly: DataFrame, n: int = 12) -> DataFrame:
    """Value n rows earlier in the type's series (rows, not calendar months)."""
    return monthly.withColumn(f"lag_{n}", F.lag("ocorrencias", n).over(_series()))


def with_rolling(monthly: DataFrame, n: int = 6) -> DataFrame:
    """Mean and sample deviation of the last n rows; a single row deviates by 0."""
    frame = _series().rowsBetween(-(n - 1), 0)
    return monthly.withColumns(
        {
            f"rolling_mean_{n}": F.avg("ocorrencias").over(frame),
            f"rolling_std_{n}": F.coalesce(F.stddev_samp("ocorrencias").over(frame), F.lit(0.0)),
        }
    )


def last_rows(monthly: DataFrame, n: int = 12) -> DataFrame:
    """The latest n rows of each type."""
    rank = F.row_number().over(W.partitionBy("type").orderBy(F.desc("year"), F.desc("month")))
    return monthly.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def with_calendar(df: DataFrame) -> DataFrame:
    out = df.withColumns(D.calendar_features(F.col("year"), F.col("month")))
    return out.withColumn(
        "seasonal_risk",
        F.when(F.col("type") == "Flood", F.col("flood_seasonal_risk")).otherwise(
            F.col("landslide_seasonal_risk")
        ),
    )


def model_frame(monthly: DataFrame) -> DataFrame:
    """All features; rows with a missing one (the first twelve lags) are dropped."""
    return with_calendar(with_rolling(with_lag(monthly))).dropna(subset=[*FEATURES, "ocorrencias"])


def same_month_profile(monthly: DataFrame) -> DataFrame:
    """Mean and deviation per (type, month) beside those of the whole type."""
    by_month = monthly.groupBy("type", "month").agg(
        F.avg("ocorrencias").alias("month_mean"),
        F.coalesce(F.stddev_samp("ocorrencias"), F.lit(0.0)).alias("month_std"),
    )
    by_type = monthly.groupBy("type").agg(
        F.avg("ocorrencias").alias("type_mean"), F.stddev_samp("ocorrencias").alias("type_std")
    )
    return by_type.join(by_month, "type", "left")


def split_by_time(frame: DataFrame, holdout_years: int = 2) -> DataFrame:
    """``part``: train up to the type's last year minus the holdout, test after it."""
    last = frame.groupBy("type").agg(F.max("year").alias("_last"))
    return (
        frame.join(last, "type")
        .withColumn(
            "part", F.when(F.col("year") <= F.col("_last") - holdout_years, "train").otherwise("test")
        )
        .drop("_last")
    )


def errors(predicted: DataFrame, truth: str = "ocorrencias", guess: str = "prediction") -> DataFrame:
    """Mean absolute error and coefficient of determination per type, from sums."""
    y, p = F.col(truth).cast("double"), F.col(guess).cast("double")
    means = predicted.groupBy("type").agg(F.avg(y).alias("_mean"))
    return (
        predicted.join(means, "type")
        .groupBy("type")
        .agg(
            F.avg(F.abs(y - p)).alias("mae"),
            (F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.sum((y - F.col("_mean")) * (y - F.col("_mean"))))).alias("r2"),
        )
    )


def forecast_grid(monthly: DataFrame, year: int) -> DataFrame:
    """Twelve months x type with calendar features; lag and rolling inputs from the profile."""
    months = F.explode(F.sequence(F.lit(1), F.lit(12)))
    grid = monthly.select("type").distinct().select("type", months.alias("month"))
    profile = same_month_profile(monthly)
    types = profile.select("type", "type_mean", "type_std").distinct()
    by_month = profile.select("type", "month", "month_mean", "month_std").where("month IS NOT NULL")
    rows = (
        grid.join(types, "type")
        .join(by_month, ["type", "month"], "left")
        .withColumns({"year": F.lit(year), "data": D.month_start(F.lit(year), F.col("month"))})
    )
    mean = F.coalesce("month_mean", "type_mean")
    return with_calendar(
        rows.withColumns(
            {
                "lag_12": mean,
                "rolling_mean_6": mean,
                "rolling_std_6": F.coalesce("month_std", "type_std", F.lit(0.0)),
            }
        ).drop("month_mean", "month_std", "type_mean", "type_std")
    )


def interval(prediction: Column, mae: Column) -> dict[str, Column]:
    """Point and bounds, rounded half-even: at least 1, at least 0, mean error times 1.5."""
    slack = mae * F.lit(1.5)
    whole = lambda c: F.bround(c, 0).cast("bigint")
    return {
        "ocorrencias": F.greatest(F.lit(1).cast("bigint"), whole(prediction)),
        "confidence_lower": F.greatest(F.lit(0).cast("bigint"), whole(F.greatest(F.lit(0.0), prediction - slack))),
        "confidence_upper": whole(prediction + slack),
    }


def share_of_total(df: DataFrame, group: str, value: str, total: Column, out: str) -> DataFrame:
    """``total`` split by the row's share of its group's value, rounded half-even.

    The group sum is an aggregate joined back: no group meets in one task.
    """
    sums = df.groupBy(group).agg(F.sum(value).alias("_sum"))
    return df.join(sums, group).withColumn(
        out, F.bround(total * F.col(value) / F.col("_sum"), 0).cast("bigint")
    ).drop("_sum")


def allocate(forecast: DataFrame, history: DataFrame) -> DataFrame:
    """Yearly forecast per type spread over districts by their share of past events.

    ``history``: district, type, latitude, longitude per event.
    """
    yearly = forecast.groupBy("type").agg(F.sum("ocorrencias").alias("ocorrencias"))
    named = history.where(F.col("district").isNotNull() & (F.col("district") != ""))
    counts = named.groupBy("district", "type").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("latitude").alias("latitude"),
        F.avg("longitude").alias("longitude"),
    )
    joined = counts.join(yearly, "type", "left")
    return share_of_total(
        joined, "type", "count", F.coalesce("ocorrencias", F.lit(0)), "predicted_occurrences"
    ).dropna(subset=["latitude", "longitude"])


# --- models ----------------------------------------------------------------------------------

def fit_forecast(
    monthly: DataFrame, year: int, trees: int = 200, seed: int = 42, min_rows: int = 20, min_train: int = 10, min_test: int = 5
) -> DataFrame:
    """Random forest per type and its forecast of one year with error bounds.

    A type with fewer than ``min_rows`` months is not forecast (``too_short`` lists
    them); below ``min_train`` or ``min_test`` months a random fifth is the test.

    ``monthly`` is the aggregated series (a few hundred rows per type); the
    loop runs over hazard types, each fit is a Spark ML job.
    """
    from functools import reduce

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    frame = split_by_time(model_frame(monthly)).repartition("type").cache()
    sizes = {
        r["type"]: r
        for r in frame.groupBy("type").agg(
            F.count_if(F.col("part") == "train").alias("train"),
            F.count_if(F.col("part") == "test").alias("test"),
        ).collect()
    }
    future = forecast_grid(monthly, year)
    parts = []
    for kind, size in sorted(sizes.items()):
        if size["train"] + size["test"] < min_rows:
            continue
        rows = assembler.transform(frame.where(F.col("type") == kind))
        if size["train"] < min_train or size["test"] < min_test:
            train, test = rows.randomSplit([0.8, 0.2], seed)
        else:
            train, test = rows.where("part = 'train'"), rows.where("part = 'test'")
        model = RandomForestRegressor(
            featuresCol="features", labelCol="ocorrencias", numTrees=trees, maxDepth=10,
            minInstancesPerNode=2, seed=seed,
        ).fit(train)
        quality = errors(model.transform(test)).select(
            "type", F.col("r2").alias("model_r2"), F.col("mae").alias("model_mae")
        )
        ahead = model.transform(assembler.transform(future.where(F.col("type") == kind)))
        parts.append(
            ahead.join(quality, "type").select(
                "data", "year", "month", "type", "model_r2", "model_mae", "prediction"
            )
        )
    if not parts:
        from hazardspark.schemas import FORECAST

        return monthly.sparkSession.createDataFrame([], FORECAST)
    out = reduce(DataFrame.unionByName, parts)
    return out.select(
        "data", "year", "month", "type",
        *[c.alias(n) for n, c in interval(F.col("prediction"), F.col("model_mae")).items()],
        "model_r2", "model_mae",
    )


def too_short(monthly: DataFrame, min_rows: int = 20) -> DataFrame:
    """Types that ``fit_forecast`` leaves out, with the months they have."""
    months = model_frame(monthly).groupBy("type").agg(F.count(F.lit(1)).alias("months"))
    return months.where(F.col("months") < min_rows).select("type", "months", F.lit("too few months").alias("status"))
