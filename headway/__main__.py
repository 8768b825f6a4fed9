"""python -m headway: ingest, replay, static versions, comparison of runs, published files, retention, census and cadence."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import RunSettings, Warehouse
from headway.ingest import FEEDS, process
from headway.operators import census, keyed, messages
from headway.plans import exports, report
from headway.ship import ship
from headway.sources import archive, sinks, versions


def session() -> SparkSession:
    spark = SparkSession.builder.appName("headway").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    return spark


def epoch(text: str) -> int:
    return int(dt.datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp())


def said(value) -> None:
    print(json.dumps(value, sort_keys=True, default=str))


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]  # reports of a few rows


def run_ingest(spark: SparkSession, a) -> int:
    if a.command == "replay":
        RunSettings(mode="baseline", source="replay.archive", target=a.out.rsplit("/", 1)[-1], min_stop_sequence=0)
    records, letters = process(spark, a.root, a.feed, a.start, a.end)
    if a.dry_run:
        said({"records": records.count(), "dead_letters": letters.count()})
    else:
        records.write.mode("append").parquet(f"{a.out}/{a.feed}")
        letters.write.mode("append").parquet(f"{a.out}/dlq")
    return 0


def run_diff(spark: SparkSession, a) -> int:
    keys = a.keys.split(",")
    live, replay = spark.read.parquet(a.live), spark.read.parquet(a.replay)
    sides = {r["side"]: r["count"] for r in keyed.diff_keys(live, replay, keys).groupBy("side").count().collect()}
    fields = {r["field"]: r["mismatches"] for r in keyed.field_mismatches(live, replay, keys, tuple(a.ignore.split(","))).collect()}
    said({"keys": sides, "fields": fields})
    return 0


def run_static(spark: SparkSession, a) -> int:
    if a.status:
        for r in _rows(versions.status(spark, a.path)):
            said(r)
        return 0
    if a.retire is not None:
        done = versions.retire(spark, a.path, a.retire)
        said({"retired": a.retire if done else None})
        return 0 if done else 1
    version = versions.load(spark, a.load, a.path, a.etag, a.force)
    said({"loaded": version})
    return 0


def run_compare(spark: SparkSession, a) -> int:
    """fidelity: keys and fields of two runs that should agree; experiment: what a changed rule does to alerts."""
    one, two = (report.in_window(spark.read.parquet(p), "window_end", a.start, a.end) for p in (a.live, a.replay))
    if a.mode == "fidelity":
        keys = a.keys.split(",")
        sides = {r["side"]: r["count"] for r in keyed.diff_keys(one, two, keys).groupBy("side").count().collect()}
        said({"keys": sides, "fields": {r["field"]: r["mismatches"] for r in keyed.field_mismatches(one, two, keys).collect()}})
    else:
        said({"routes": _rows(report.by_route(one, two).limit(12)), "baseline": _rows(report.peak_share(one))[0], "variant": _rows(report.peak_share(two))[0]})
    return 0


def run_export(spark: SparkSession, a) -> int:
    tables = {n: spark.read.parquet(f"{a.tables}/{n}") for n in ("alerts", "health", "histogram", "daily")}
    first, last = exports.publish(spark, a.out, tables, a.first, a.last)
    said({"first": first, "last": last, "asked": a.last})
    return 0


def run_drop(spark: SparkSession, a) -> int:
    cutoff = a.as_of - dt.timedelta(days=Warehouse().retention_days if a.days is None else a.days)
    said({"dropped": sinks.drop_partitions(spark, a.table, cutoff.isoformat(), a.day)})
    return 0


def run_census(spark: SparkSession, a) -> int:
    rows = spark.read.json(a.table) if a.json else spark.read.parquet(a.table)
    for r in _rows(census.field_census(rows).orderBy("path")):
        said(r)
    return 0


def run_cadence(spark: SparkSession, a) -> int:
    """Seconds between the payloads of a feed in the archive."""
    seen = archive.scan(spark, a.root, a.feed, a.start, a.end).select(F.lit(a.feed).alias("feed"), "fetched_s", "feed_etag")
    for r in _rows(messages.cadence(seen, ["feed"], "fetched_s", ["feed_etag"])):
        said(r)
    return 0


def window(p: argparse.ArgumentParser) -> None:
    p.add_argument("--start", type=epoch, required=True)
    p.add_argument("--end", type=epoch, required=True)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="headway", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("ingest", "replay"):
        p = sub.add_parser(name, help="archived payloads to records")
        p.add_argument("--feed", choices=sorted(FEEDS), required=True)
        p.add_argument("--root", required=True)
        window(p)
        p.add_argument("--out", required=True)
        p.add_argument("--dry-run", action="store_true")
        p.set_defaults(run=run_ingest)
    p = sub.add_parser("diff", help="two tables of records by key")
    p.add_argument("live")
    p.add_argument("replay")
    p.add_argument("--keys", required=True)
    p.add_argument("--ignore", default="enriched_at")
    p.set_defaults(run=run_diff)
    p = sub.add_parser("static", help="versions of the schedule")
    p.add_argument("path")
    what = p.add_mutually_exclusive_group(required=True)
    what.add_argument("--status", action="store_true")
    what.add_argument("--load", metavar="ZIP")
    what.add_argument("--retire", type=int, metavar="VERSION")
    p.add_argument("--etag", default="no-etag")
    p.add_argument("--force", action="store_true")
    p.set_defaults(run=run_static)
    p = sub.add_parser("compare", help="alerts of two runs")
    p.add_argument("mode", choices=("fidelity", "experiment"))
    p.add_argument("live")
    p.add_argument("replay")
    p.add_argument("--keys", default="vehicle_id_a,vehicle_id_b,window_end")
    window(p)
    p.set_defaults(run=run_compare)
    p = sub.add_parser("export", help="the published files of a window of closed days")
    p.add_argument("tables")
    p.add_argument("out")
    p.add_argument("--first", type=dt.date.fromisoformat, required=True)
    p.add_argument("--last", type=dt.date.fromisoformat, required=True)
    p.set_defaults(run=run_export)
    p = sub.add_parser("drop", help="day partitions past their retention")
    p.add_argument("table")
    p.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    p.add_argument("--days", type=int)
    p.add_argument("--day", default="event_date")
    p.set_defaults(run=run_drop)
    p = sub.add_parser("census", help="fields of a table or of JSON")
    p.add_argument("table")
    p.add_argument("--json", action="store_true")
    p.set_defaults(run=run_census)
    p = sub.add_parser("cadence", help="seconds between payloads in the archive")
    p.add_argument("--feed", choices=sorted(FEEDS), required=True)
    p.add_argument("--root", required=True)
    window(p)
    p.set_defaults(run=run_cadence)
    a = parser.parse_args(argv)
    return a.run(session(), a)


if __name__ == "__main__":
    raise SystemExit(main())
