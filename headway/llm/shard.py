"""Sharding by histogram sort: near equal bytes in every shard, one exchange.

Rows are ordered by a hash of their text, then by a hash of their id, so equal texts lie together. Splitters are found by
probing: each round counts the exact bytes below evenly spaced probes inside the intervals that splitters may still lie in,
and keeps the interval that holds the wanted count, until a probe is within the tolerance. A splitter that would cut a group
of equal texts goes to the nearer end of the group; only a group larger than a shard is cut inside, at the nearest row. Cells
part shards further, so that a task gets a share of a shard; their splitters are found in the same rounds, and may cut groups
larger than a cell, as that leaves them in one shard. Rows go to the task that their cell names, in one exchange, and are
numbered there; no shard has to fit in a task.

Defined cases: null texts have no bytes and the crc32 of an empty text; rows with equal id and text stay in one shard
(their slots differ); fewer rows than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import written

PROBES = 64
TOP = 1 << 62
#: Cells in all at most: what a round of probes brings to the driver grows with them.
CELLS = 4096


def hash62(*columns) -> Column:
    """A hash from 0 to TOP - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def _after(n: int, texts: Column, ids: Column) -> Column:
    """How many of n sorted pairs (text_key, id_key) are not above the row's, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, n).bit_length()))])

    def step(p: Column, s: Column) -> Column:
        text, i = F.get(texts, p + s - 1), F.get(ids, p + s - 1)
        inside = (text < F.col("text_key")) | ((text == F.col("text_key")) & (i <= F.col("id_key")))
        return F.when((p + s <= n) & inside, p + s).otherwise(p)

    return F.aggregate(steps, F.lit(0), step)


@dataclass(frozen=True, order=True)
class Interval:
    """Keys from low to high - 1 of one level: of text_key, or of id_key in the group of one text_key; and the bytes before them."""

    group: int
    low: int
    high: int
    before: int


def _probe(rows: DataFrame, inside: bool, intervals: list[Interval]) -> list[list[tuple[Interval, int]]]:
    """For each interval the parts, PROBES at most, that have rows, as intervals of their own with their bytes."""
    key = "id_key" if inside else "text_key"
    texts = [x.group if inside else x.low for x in intervals]
    table = rows.sparkSession.createDataFrame(
        [(texts, [x.low if inside else 0 for x in intervals], [x.low for x in intervals], [x.high for x in intervals])], "t array<long>, i array<long>, low array<long>, high array<long>"
    )
    given = rows.select("size", "text_key", "id_key", *[table.select(c).scalar().alias(c) for c in table.columns])
    which = given.withColumn("which", _after(len(intervals), F.col("t"), F.col("i")) - 1).filter("which >= 0")
    low, high = F.get("low", F.col("which")), F.get("high", F.col("which"))
    held = which.select("which", "size", F.col(key).alias("key"), low.alias("low"), high.alias("high"), *([(F.get("t", F.col("which")) == F.col("text_key")).alias("mine")] if inside else [F.lit(True).alias("mine")]))
    step = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low")) / PROBES)).cast("long")
    parted = held.filter("mine and key < high").withColumn("step", step).withColumn("part", F.expr("(key - low) div step"))
    found = parted.groupBy("which", "part").agg(F.sum("size"), F.min("key"), F.max("key")).collect()  # PROBES for each interval at most
    out: list = [[] for _ in intervals]
    before = [x.before for x in intervals]
    for w, _, size, least, most in sorted(found):
        out[w].append((Interval(intervals[w].group, least, most + 1, before[w]), size))
        before[w] += size
    return out


def _search(rows: DataFrame, inside: bool, wanted: dict[float, tuple[Interval, float]]) -> dict[float, tuple[int | None, Interval, int]]:
    """For each target, with an interval and a slack: (key below which lie the wanted bytes, the last interval, its bytes).

    A target that even one key's bytes step over has no such key.
    """
    where, done, size_of = {t: x for t, (x, _) in wanted.items()}, {}, {}
    while len(done) < len(where):
        active = sorted({where[t] for t in where if t not in done})
        parts = dict(zip(active, _probe(rows, inside, active)))
        for t in sorted(where):
            if t in done:
                continue
            mine, slack = parts[where[t]], wanted[t][1]
            x, size = mine[min(bisect_right([p.before for p, _ in mine], t), len(mine)) - 1]
            where[t], size_of[t] = x, size
            if abs(x.before - t) <= slack:
                done[t] = x.low
            elif abs(x.before + size - t) <= slack:
                done[t] = x.high
            elif x.high - x.low == 1:
                done[t] = None
    return {t: (done[t], where[t], size_of[t]) for t in where}


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.01, cells: int = 1) -> list[tuple[tuple[int, int], bool]]:
    """((text_key, id_key) of the first row after a splitter, whether it parts shards), sorted; a shard has about that many cells.

    rows has size, text_key and id_key, keys from 0 to TOP - 1.
    """
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return []
    shard, cell = total / shards, total / (shards * cells)
    limit = {total * i / (shards * cells): (shard if i % cells == 0 else cell) for i in range(1, shards * cells)}
    slack = {t: tolerance * shard if limit[t] == shard else 0.1 * cell for t in limit}
    start = Interval(0, 0, TOP, 0)
    out: dict = {}
    cut: dict = {}
    nearer = lambda t, x, size: x.low if t - x.before <= x.before + size - t else x.high
    for t, (key, x, size) in _search(rows, False, {t: (start, slack[t]) for t in limit}).items():
        if key is not None or size <= limit[t]:
            out[t] = (nearer(t, x, size) if key is None else key, 0)
        else:
            cut[t] = (Interval(x.low, 0, TOP, x.before), slack[t])
    if cut:
        groups = rows.join(F.broadcast(rows.sparkSession.createDataFrame([(g,) for g in sorted({x.group for x, _ in cut.values()})], "text_key long")), "text_key")
        for t, (key, x, size) in _search(groups, True, cut).items():
            out[t] = (x.group, nearer(t, x, size) if key is None else key)
    return sorted((out[t], limit[t] == shard) for t in limit)


def histogram_sort(rows: DataFrame, shards: int, tolerance: float = 0.01) -> DataFrame:
    """rows with size, text_key and id_key gain shard and slot; all other columns are carried through the one exchange."""
    spark = rows.sparkSession
    rows = written(rows)
    cells = max(1, min(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards), CELLS // shards))
    found = splitters(rows.select("size", "text_key", "id_key"), shards, tolerance, cells)
    places = sorted({p for p, _ in found})
    before = [p for p, parts in found if parts]
    shard_of = [0, *[bisect_right(before, p) for p in places]]  # of each cell
    table = spark.createDataFrame([([p[0] for p in places], [p[1] for p in places], shard_of)], "t array<long>, i array<long>, s array<int>")
    given = rows.select("*", *[table.select(c).scalar().alias(f"_{c}") for c in table.columns])
    celled = given.withColumn("_cell", _after(len(places), F.col("_t"), F.col("_i"))).withColumn("shard", F.get("_s", F.col("_cell"))).drop("_t", "_i", "_s")
    sent = celled.repartitionById(len(places) + 1, "_cell").sortWithinPartitions("_cell", "text_key", "id_key").drop("_cell")
    placed = written(sent.withColumn("place", F.monotonically_increasing_id()))
    runs = placed.groupBy("shard", F.shiftright("place", 33).alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    # a row for each cell: CELLS at most
    return (
        placed.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(runs), ["shard", "part"])
        .withColumn("slot", F.col("place") + F.col("shift")).drop("part", "place", "shift")
    )


def shard_documents(documents: DataFrame, shards: int = 40, tolerance: float = 0.01, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: only the law by key has it), and the columns to carry."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        hash62(text).alias("text_key"), hash62(F.col("doc_id").cast("string")).alias("id_key"), *carry,
    )
    return histogram_sort(rows, shards, tolerance).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), *carry)
