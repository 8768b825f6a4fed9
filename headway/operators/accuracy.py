"""Prediction accuracy: predictions joined to the first observed arrival of the same service day, trip and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.config import Accuracy
from headway.functions.time import lead_bucket, service_day

KEY = ["service_day", "trip_id", "stop_id"]


def parse_predictions(updates: DataFrame) -> DataFrame:
    """Rows that can join: trip, stop, readable start date, predicted arrival and issue time."""
    day = service_day(F.col("start_date"))
    kept = updates.select(day.alias("service_day"), "trip_id", "stop_id", "issued_at", "predicted_arrival")
    return kept.dropna()


def parse_observations(positions: DataFrame) -> DataFrame:
    """Vehicles standing at a stop."""
    stopped = positions.filter("current_status = 'STOPPED_AT'")
    day = service_day(F.col("start_date"))
    return stopped.select(day.alias("service_day"), "trip_id", "stop_id", "route_id", "route_short_name", "observed_at").dropna(subset=[*KEY, "observed_at"])


def newest(predictions: DataFrame, config: Accuracy = Accuracy()) -> DataFrame:
    """The newest cap predictions of each key."""
    w = Window.partitionBy(*KEY).orderBy(F.desc("issued_at"), F.desc("predicted_arrival"))
    return predictions.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= config.cap).drop("_n")


def first_arrivals(observations: DataFrame) -> DataFrame:
    rest = ["route_id", "route_short_name", "observed_at"]
    first = observations.groupBy(*KEY).agg(F.min_by(F.struct(*rest), F.struct("observed_at", "route_id")).alias("_o"))
    return first.select(*KEY, *[F.col("_o")[c].alias(c) for c in rest])


def join_arrivals(predictions: DataFrame, observations: DataFrame, config: Accuracy = Accuracy()) -> DataFrame:
    """Times are epoch seconds. A forecast is issued before the arrival it forecasts, at most window_s ahead of it.

    The cap counts only predictions issued before the arrival.
    """
    pairs = newest(predictions.join(first_arrivals(observations), KEY).filter("issued_at < observed_at"), config)
    lead, error = F.col("predicted_arrival") - F.col("issued_at"), F.col("predicted_arrival") - F.col("observed_at")
    kept = pairs.withColumn("lead_time_s", lead).withColumn("error_s", error).filter(F.col("lead_time_s") <= config.window_s)
    if not config.keep_negative_lead:
        kept = kept.filter("lead_time_s >= 0")
    return kept.select("lead_time_s", "error_s", F.abs("error_s").alias("abs_error_s"), lead_bucket(F.col("lead_time_s"), config).alias("lead_bucket"), *KEY, "route_id", "route_short_name", "issued_at", "predicted_arrival", "observed_at")
