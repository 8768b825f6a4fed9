"""Structured Streaming forms of detection, cooldown, accuracy and dedupe.

They share their steps with the batch forms. A bounded replay runs in batch: availableNow doesn't push the watermark past the
end of the input, so the last windows would stay open. On a live stream keep micro-batches small and in event-time order, and
watch numRowsDroppedByWatermark: the watermark is one for all partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState

from headway.config import Accuracy, Bunching
from headway.functions.geo import haversine_ft
from headway.functions.text import pair_key
from headway.operators.detect import cooldown_run, cooldown_step, parse_records
from headway.sources.enriched import decode_enriched
from headway.sources.sinks import exists

STATE = "pair string, n int, last bigint, alert bigint"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def tumbling_counts(positions: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    """route_id, direction_id, window_end, vehicles, positions of each closed window."""
    timed = positions.withWatermark("position_timestamp", f"{config.lateness_s} seconds")
    grouped = timed.groupBy(F.window("position_timestamp", f"{config.window_s} seconds"), "route_id", "direction_id")
    return grouped.agg(F.size(F.collect_set("vehicle_id")).cast("long").alias("vehicles"), F.count("*").alias("positions")).select(F.unix_seconds("window.end").alias("window_end"), "route_id", "direction_id", "vehicles", "positions")


def windowed_pairs(positions: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    """Neighbours of each closed window, as the batch form finds them; window_end is carried as a long, one event-time column only."""
    fields = F.struct("shape_dist_traveled", "vehicle_id", "trip_id", "position_timestamp", "latitude", "longitude", "current_stop_sequence", "schedule_deviation_seconds", "route_short_name")
    timed = parse_records(positions).withWatermark("position_timestamp", f"{config.lateness_s} seconds")
    window = F.window("position_timestamp", f"{config.window_s} seconds")
    closed = timed.groupBy(window, "route_id", "direction_id").agg(F.collect_list(fields).alias("all"))  # a window of one route and direction
    end = F.unix_seconds("window.end")
    moving = lambda v: (v["shape_dist_traveled"] >= config.min_progress_ft) & (F.coalesce(v["current_stop_sequence"], F.lit(0)) >= config.min_stop_sequence) & (F.col("window_end") - F.unix_seconds(v["position_timestamp"]) <= config.max_age_s)
    # each vehicle's latest position, of equal times that of the least trip: the first of the vehicle's in this order
    rank = lambda v: F.struct(v["vehicle_id"].alias("v"), (-F.unix_micros(v["position_timestamp"])).alias("t"), v["trip_id"].isNull().alias("n"), v["trip_id"].alias("trip"), v.alias("row"))
    ordered = closed.select(end.alias("window_end"), "route_id", "direction_id", F.array_sort(F.transform("all", rank)).alias("o"))
    latest = F.transform(F.filter("o", lambda x, i: (i == 0) | (F.get("o", i - 1)["v"] != x["v"])), lambda x: x["row"])
    kept = ordered.select("window_end", "route_id", "direction_id", F.array_sort(F.filter(latest, lambda v: moving(v))).alias("v"))
    pairs = F.zip_with(F.slice("v", F.lit(1), F.greatest(F.size("v") - 1, F.lit(0))), F.slice("v", F.lit(2), F.greatest(F.size("v") - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = kept.select("window_end", "route_id", "direction_id", F.explode(pairs).alias("p")).select("window_end", "route_id", "direction_id", "p.*")
    gap = F.col("b.shape_dist_traveled") - F.col("a.shape_dist_traveled")
    near = haversine_ft(F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude")) <= F.greatest(gap, F.lit(config.gap_ft)) * config.proximity_margin
    return rows.filter((gap < config.gap_ft) & near).select(
        "route_id", "direction_id", F.col("a.route_short_name").alias("route_short_name"), F.col("a.vehicle_id").alias("vehicle_id_a"), F.col("b.vehicle_id").alias("vehicle_id_b"),
        F.col("a.trip_id").alias("trip_id_a"), F.col("b.trip_id").alias("trip_id_b"), gap.alias("gap_ft"), "window_end",
        F.col("a.schedule_deviation_seconds").alias("deviation_a"), F.col("b.schedule_deviation_seconds").alias("deviation_b"), pair_key(F.col("a.vehicle_id"), F.col("b.vehicle_id")).alias("pair"),
    )


class Cooldown(StatefulProcessor):
    """Keeps a pair's run, last window and last alert; emits the windows that alert."""

    def __init__(self, config: Bunching):
        self.config = config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "n int, last bigint, alert bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        n, last, alert = self.state.get() if self.state.exists() else (0, None, None)
        for r in sorted(rows, key=lambda r: r.window_end):
            fires, n, last, alert = cooldown_step(n, last, alert, r.window_end, self.config)
            if fires:
                yield Row(**{c: r[c] for c in r.asDict()})
        self.state.update((n, last, alert))

    def close(self) -> None:
        pass


def cooled(pairs: DataFrame, config: Bunching = Bunching()) -> DataFrame:
    """The rows of pairs (with pair and window_end) that alert, all their columns."""
    return pairs.groupBy("pair").transformWithState(Cooldown(config), pairs.schema, "Append", "None")


def bunching_job(messages: DataFrame, alerts_path: str, config: Bunching = Bunching(), trigger: dict | None = None):
    """Framed enriched records (column value) to alerts: decode, windows and pairs in one query, the cooldown as each batch closes.

    The windows are stateful, so the cooldown's state is kept beside the alerts and joined batch by batch: a pair's run, last
    window and last alert. A batch that is run again finds the state it began with and gives the same alerts.
    """
    spark = messages.sparkSession
    decoded = decode_enriched(messages).filter("decoded").withColumn("position_timestamp", F.timestamp_seconds("position_timestamp"))
    pairs = windowed_pairs(decoded, config)

    def step(batch: DataFrame, n: int) -> None:
        before = f"{alerts_path}/state/{n - 1}"
        old = spark.read.schema(STATE).parquet(before) if n and exists(spark, before) else spark.createDataFrame([], STATE)
        new = batch.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("window_end", F.struct(*[c for c in batch.columns if c != "pair"]).alias("row")))).alias("rows"))
        fold = new.join(old, "pair", "full_outer").withColumn("f", cooldown_run(F.coalesce("rows", F.array().cast(new.schema["rows"].dataType)), F.col("n"), F.col("last"), F.col("alert"), config))
        fold.select("pair", "f.n", "f.last", "f.alert").write.mode("overwrite").parquet(f"{alerts_path}/state/{n}")
        fold.select("pair", F.explode("f.out").alias("row")).select("row.*", "pair").write.mode("overwrite").parquet(f"{alerts_path}/alerts/batch={n}")

    return pairs.writeStream.outputMode("append").option("checkpointLocation", f"{alerts_path}/checkpoint").trigger(**(trigger or {"availableNow": True})).foreachBatch(step).start()


def arrivals_step(key, rows: list[tuple], observed: int | None, waiting: list[tuple], config: Accuracy):
    """One batch of a key's rows in order of time: (joined rows, first arrival, predictions that still wait, the newest cap of them)."""
    out = []

    def emit(issued: int, predicted: int) -> None:
        if issued < observed and predicted - issued <= config.window_s and (config.keep_negative_lead or predicted >= issued):
            out.append((*key, issued, predicted, observed))

    for _, issued, predicted, seen in sorted(rows, key=lambda r: (r[0], r[3] is not None)):
        if seen is None:
            if observed is None:
                waiting = sorted([*waiting, (issued, predicted)])[-config.cap :]
            else:
                emit(issued, predicted)
        elif observed is None:  # the first wins
            observed = seen
            for w in waiting:
                emit(*w)
            waiting = []
    return out, observed, waiting


def join_arrivals(tagged: DataFrame, config: Accuracy = Accuracy(), bounded: bool = False) -> DataFrame:
    """tagged: service_day, trip_id, stop_id, at, issued_at and predicted_arrival, or observed_at.

    State expires after the TTL, by processing time; a bounded run has no TTL, as one with timers never runs out of batches.
    """
    names = ["service_day", "trip_id", "stop_id", "issued_at", "predicted_arrival", "observed_at"]
    columns = "service_day string, trip_id string, stop_id string, issued_at bigint, predicted_arrival bigint, observed_at bigint"

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        observed, issued, predicted = state.get if state.exists else (None, [], [])
        rows = []
        for f in frames:
            plain = [[None if pd.isna(v) else int(v) for v in f[c]] for c in ("at", "issued_at", "predicted_arrival", "observed_at")]
            rows += zip(*plain)
        out, observed, waiting = arrivals_step(key, rows, observed, list(zip(issued, predicted)), config)
        state.update((observed, [w[0] for w in waiting], [w[1] for w in waiting]))
        if not bounded:
            state.setTimeoutDuration(config.ttl_s * 1000)
        if out:
            yield pd.DataFrame(out, columns=names)

    keyed = tagged.groupBy("service_day", "trip_id", "stop_id")
    return keyed.applyInPandasWithState(step, columns, "observed_at bigint, issued array<bigint>, predicted array<bigint>", "append", "NoTimeout" if bounded else "ProcessingTimeTimeout")


class LastValue(StatefulProcessor):
    """Passes a row whose value differs from its key's last one; state expires instead of being evicted."""

    def __init__(self, ttl_s: int | None):
        self.ttl_s = ttl_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value string", ttlDurationMs=self.ttl_s * 1000 if self.ttl_s else None)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        seen = self.last.exists()
        value = self.last.get()[0] if seen else None
        for r in sorted(rows, key=lambda r: (r.at, r.id)):
            if not seen or r.value != value:
                seen, value = True, r.value
                yield Row(key=key[0], id=r.id, value=r.value)
        if seen:
            self.last.update((value,))

    def close(self) -> None:
        pass


def value_dedupe(rows: DataFrame, ttl_s: int | None = 86_400) -> DataFrame:
    """rows: key, id, at, value; A, A, B, A passes A, B, A. A bounded run takes no TTL."""
    return rows.groupBy("key").transformWithState(LastValue(ttl_s), "key string, id bigint, value string", "Append", "ProcessingTime" if ttl_s else "None")


def run_available(stream: DataFrame, path: str) -> DataFrame:
    """Run a stream over what is there, into a Parquet table at path, and read it."""
    return _run(stream, path)[0]


def _run(stream: DataFrame, path: str) -> tuple[DataFrame, str]:
    """The stream's table, and the last watermark as text (the epoch where there is none)."""
    spark = stream.sparkSession
    q = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).outputMode("append").start()
    q.awaitTermination()
    marks = [p["eventTime"]["watermark"] for p in q.recentProgress if "watermark" in p["eventTime"]]
    return spark.read.schema(stream.schema).parquet(f"{path}/out"), max(marks, default="1970-01-01T00:00:00.000Z")


def with_open_windows(stream: DataFrame, batch: DataFrame, path: str) -> DataFrame:
    """The windows that a stream closes, and those that its last watermark leaves open from the batch form; what it dropped as late stays out."""
    closed, watermark = _run(stream, path)
    still_open = F.timestamp_seconds("window_end") > F.lit(watermark).cast("timestamp")
    return closed.unionByName(batch.filter(still_open))
