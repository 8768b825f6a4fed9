"""The published files: six small results of a window of closed local days, each with its window and the same bytes every time."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import LOCAL_ZONE, Warehouse
from headway.functions.rounding import numeric
from headway.plans import calendar, marts
from headway.sources import store

FILES = ("bunching_by_hour.json", "routes.json", "hotspots.geojson", "prediction_curve.json", "feed_health.json", "kpis.json")


def between(df: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows whose day is in the window, both ends included."""
    return df.filter(F.col(column).cast("date").between(F.lit(first), F.lit(last)))


def body(name: str, payload, first: dt.date, last: dt.date) -> str:
    window = {"first": first.isoformat(), "last": last.isoformat()}
    whole = {**payload, "window": window} if name.endswith(".geojson") else {"window": window, "data": payload}
    return json.dumps(whole, indent=1, sort_keys=True, default=str) + "\n"


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]  # results of a few hundred rows


def whole(value) -> int | None:
    """Half away from zero, as the marts round."""
    return None if value is None else int(abs(float(value)) + 0.5) * (1 if float(value) >= 0 else -1)


def hours(alerts: DataFrame, days: DataFrame) -> dict:
    out = {"weekday": [0.0] * 24, "weekend": [0.0] * 24}
    for r in _rows(marts.alerts_by_hour(alerts, days)):
        out[r["kind"]][r["local_hour"]] = r["alerts_per_day"]
    return out


def routes(alerts: DataFrame, n_days: int) -> list[dict]:
    return [{"route" if k == "route_short_name" else k: v for k, v in r.items()} for r in _rows(marts.route_ranking(alerts, n_days))]


def hotspots(alerts: DataFrame, top: int = 3, peak: tuple[int, ...] = Warehouse().peak_hours) -> dict:
    """A point for each stop that has located alerts, most alerts first."""
    located = alerts.filter("latitude is not null and longitude is not null")
    each = located.groupBy("stop_id", "route_short_name").agg(F.count("*").alias("n"), F.sum("longitude").alias("x"), F.sum("latitude").alias("y"), F.count_if(F.col("local_hour").isin(*peak)).alias("pm"), F.min("stop_name").alias("stop_name"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("route_short_name").isNull().alias("u"), F.col("route_short_name").alias("r"), "n")))
    stops = each.groupBy("stop_id").agg(F.sum("n").alias("alerts"), F.round(F.sum("x") / F.sum("n"), 5).alias("x"), F.round(F.sum("y") / F.sum("n"), 5).alias("y"), F.sum("pm").alias("pm"), F.min("stop_name").alias("stop_name"), F.slice(order, 1, top).alias("routes"))
    found = _rows(stops.orderBy(F.desc("alerts"), F.asc_nulls_last("stop_id")))
    features = [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [r["x"], r["y"]]},
         "properties": {"stop_id": r["stop_id"], "stop_name": r["stop_name"], "alerts": r["alerts"], "pm_peak_alerts": r["pm"], "routes": [[q["r"], q["n"]] for q in r["routes"]]}}
        for r in found
    ]
    return {"type": "FeatureCollection", "features": features}


def curve(histogram: DataFrame, daily: DataFrame) -> list[dict]:
    """The error by lead bucket, shortest lead first, rounded half away from zero."""
    at = lambda p: numeric(F.percentile("abs_error_s", F.lit(p), F.col("predictions")), 0).cast("long")
    shape = histogram.groupBy("lead_bucket").agg(F.sum("predictions").alias("predictions"), at(0.5).alias("median_abs_error_s"), at(0.9).alias("p90_abs_error_s"))
    totals = daily.groupBy("lead_bucket").agg(F.sum("sum_error_s").alias("e"), F.min("min_lead_time_s").alias("lead"))
    joined = shape.join(totals, "lead_bucket", "left").orderBy("lead")
    return _rows(joined.select("lead_bucket", "predictions", "median_abs_error_s", "p90_abs_error_s", numeric(F.col("e") / F.col("predictions"), 0).cast("long").alias("mean_error_s")))


def health_days(health: DataFrame) -> list[dict]:
    """By local day: health has minute_local."""
    lag = F.when(~F.col("is_silent"), F.col("median_lag_s"))
    rows = health.groupBy(F.to_date("minute_local").alias("date")).agg(
        F.count("*").alias("minutes"), F.count_if("is_silent").alias("silent_minutes"), F.round(1 - F.count_if("is_silent") / F.count("*"), 4).alias("live_share"),
        F.sum("positions").alias("positions"), numeric(F.percentile(lag, F.lit(0.5)), 0).cast("long").alias("median_ingest_lag_s"),
    )
    return _rows(rows.orderBy("date"))


def kpis(alerts: DataFrame, days: list[dict], points: list[dict], first: dt.date, last: dt.date, peak: tuple[int, ...] = Warehouse().peak_hours) -> dict:
    n, located, at_peak = alerts.agg(F.count("*"), F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()), F.count_if(F.col("local_hour").isin(*peak))).first()
    minutes, silent, length = sum(d["minutes"] for d in days), sum(d["silent_minutes"] for d in days), (last - first).days + 1
    forward = [p for p in points if p["lead_bucket"] != "past"] or points
    share = lambda a, b, k: round(a / b, k) if b else 0.0
    return {
        "first": first.isoformat(), "last": last.isoformat(), "days": length, "positions": sum(d["positions"] or 0 for d in days), "live_share": share(minutes - silent, minutes, 3), "alerts": n,
        "alerts_per_day": share(n, length, 1), "located_share": share(located, n, 3), "pm_peak_share": share(at_peak, n, 3), "predictions": sum(p["predictions"] for p in points),
        "median_abs_error_short_s": forward[0]["median_abs_error_s"] if forward else None, "median_abs_error_long_s": forward[-1]["median_abs_error_s"] if forward else None,
    }


def cut(spark: SparkSession, alerts: DataFrame, health: DataFrame, histogram: DataFrame, daily: DataFrame, first: dt.date, last: dt.date) -> dict[str, str]:
    """The six files of a window by name. alerts has local_date, health minute_local, the intermediates observed_day (UTC)."""
    a = between(alerts, "local_date", first, last)
    days = calendar.window_days(spark, first, last)
    seen = health_days(between(health, "minute_local", first, last))
    points = curve(between(histogram, "observed_day", first, last), between(daily, "observed_day", first, last))
    payloads = (hours(a, days), routes(a, (last - first).days + 1), hotspots(a), points, seen, kpis(a, seen, points, first, last))
    return {n: body(n, p, first, last) for n, p in zip(FILES, payloads)}


def publish(spark: SparkSession, out: str, tables: dict[str, DataFrame], first: dt.date, last: dt.date, now: dt.datetime | None = None, zone: str = LOCAL_ZONE) -> tuple[dt.date, dt.date]:
    """Write the six files for the closed part of a window; the window that was cut."""
    first, last = calendar.closed_window(first, last, now or dt.datetime.now(dt.timezone.utc), zone)
    for name, text in cut(spark, tables["alerts"], tables["health"], tables["histogram"], tables["daily"], first, last).items():
        store.put(spark, f"{out}/{name}", text.encode())
    return first, last
