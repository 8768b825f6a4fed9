"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are lower-cased words of letters and digits. Runs of MIN_MATCH words of an item are its seeds,
known by a rolling Karp-Rabin hash; a document's words outside the benchmark's vocabulary end a run at once, and the
remaining runs are looked up among all seeds. A document and an item that share a seed are tiled: the hash, run over both,
gives the places that match, checked word by word; the longest match whose words are unmarked on both sides becomes a tile
and is marked, what is left of overlapping ones is tried again, until no match of MIN_MATCH words remains. An item's coverage
is the share of its words under tiles, so passages in another order count in full.

A benchmark of up to BLOCK_CHARS characters goes to the executors, and its seeds are joined there, so documents are never
shuffled and no group of copies meets in one task. Beyond that size nothing of it is broadcast but a filter of its seeds, of
FILTER_BITS at most: the documents' runs that pass are joined to the seeds, and each pair of a document and an item that
share one is tiled from their texts. Both ways give the same rows.

Defined cases: null and empty texts match nothing; an item under MIN_MATCH words is a seed and a tile as a whole, so it counts
where all its words stand in a row, and only there; items without words match nothing; equal items each get their rows; repeated rows come back repeated; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import TextSizes, shared_join, slices, written

MIN_MATCH = 5
THRESHOLD = 0.5
BLOCK_CHARS = 8_000_000
FILTER_BITS = 1 << 26
WORD = re.compile(r"[^\W_]+")
RADIX = np.uint64(0x9E3779B97F4A7C15)


def rolling(ids: np.ndarray, m: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2 ** 64, of all runs of m ids."""
    n = max(0, len(ids) - m + 1)
    h = np.zeros(n, np.uint64)
    for k in range(m):
        h = h * RADIX + ids[k : k + n].astype(np.uint64)
    return h


def tiles(item: np.ndarray, text: np.ndarray, m: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in item, start in text, words): longest first, then leftmost in the item, then in the text.

    Ids of 0 match nothing. Memory is linear in the words: where the places that match are few, they are joined to longer
    matches along diagonals; in repetitive texts, where they are many, lengths are tried from the longest down.
    """
    a, b = rolling(item, m), rolling(text, m)
    order = np.argsort(a, kind="stable")
    lo, hi = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    if (hi - lo).sum() > 8 * (len(item) + len(text)):
        return _tiles_by_length(item, text, m)
    at = np.flatnonzero(hi > lo)
    j = np.repeat(at, (hi - lo)[at])
    i = order[np.repeat(lo[at] - np.cumsum((hi - lo)[at]) + (hi - lo)[at], (hi - lo)[at]) + np.arange(len(j))]
    true = np.ones(len(i), bool)
    for k in range(m):
        true &= (item[i + k] == text[j + k]) & (item[i + k] > 0)
    i, j = i[true], j[true]
    if not len(i):
        return []
    order = np.lexsort((i, j - i))  # along diagonals: neighbours are one longer match
    i, j = i[order], j[order]
    cut = np.flatnonzero(np.r_[True, (np.diff(j - i) != 0) | (np.diff(i) != 1)])
    heap = [(-(n + m - 1), x, y) for n, x, y in zip(np.diff(np.r_[cut, len(i)]).tolist(), i[cut].tolist(), j[cut].tolist())]
    heapq.heapify(heap)
    used_item, used_text, out = np.zeros(len(item), bool), np.zeros(len(text), bool), []
    while heap:
        n, x, y = heapq.heappop(heap)
        n = -n
        used = used_item[x : x + n] | used_text[y : y + n]
        if not used.any():
            out.append((x, y, n))
            used_item[x : x + n] = used_text[y : y + n] = True
            continue
        free = np.flatnonzero(np.diff(np.r_[True, used, True].astype(np.int8)))  # starts and ends of free runs
        for s, e in zip(free[::2].tolist(), free[1::2].tolist()):
            if e - s >= m:
                heapq.heappush(heap, (s - e, x + s, y + s))
    return out


class _Free:
    """The words of one side that no tile has, and hashes of their runs of any length."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.used = ids, ids == 0
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), RADIX)])
        inverse = np.uint64(pow(int(RADIX), -1, 1 << 64))
        down = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), inverse)])[:-1]
        self.upto = np.r_[np.uint64(0), np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * RADIX * down)]

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts of free runs of n words, their hashes)."""
        before = np.r_[0, np.cumsum(self.used)]
        at = np.flatnonzero(before[n:] == before[: len(before) - n])
        return at, (self.upto[at + n] - self.upto[at]) * self.power[at]


def _tiles_by_length(item: np.ndarray, text: np.ndarray, m: int) -> list[tuple[int, int, int]]:
    """The same tiles: the longest free match is found by bisection over its length, then all of that length are taken.

    Marked words stay marked, so each text place is looked at once for a length; a tile of n words takes n of the item, so
    there are no more lengths than the root of twice its words.
    """
    one, two, out = _Free(item), _Free(text), []
    most = min(len(item), len(text))
    while most >= m:
        least, longest = m, most  # the longest match has this range of lengths, if there is one of m
        while least < longest:
            n = (least + longest + 1) // 2
            if np.isin(one.runs(n)[1], two.runs(n)[1]).any():
                least = n
            else:
                longest = n - 1
        n = least
        (x, h), (y, g) = one.runs(n), two.runs(n)
        order = np.argsort(g, kind="stable")
        y, g = y[order], g[order]
        lo, hi = np.searchsorted(g, h, "left"), np.searchsorted(g, h, "right")
        hit = hi > lo
        place: dict = {}
        for s, a, b in zip(x[hit].tolist(), lo[hit].tolist(), hi[hit].tolist()):
            if one.used[s : s + n].any():
                continue
            p = place.get(a, a)
            while p < b:
                t = int(y[p])
                if two.used[t : t + n].any():
                    p += 1  # never free again
                    continue
                if (item[s : s + n] == text[t : t + n]).all():
                    out.append((s, t, n))
                    one.used[s : s + n] = two.used[t : t + n] = True
                    p += 1
                break
            place[a] = p
        most = n - 1
    return out


class Benchmark:
    """Items as ids of their words, and which items have each seed."""

    def __init__(self, items: list[tuple[int, str | None]], m: int = MIN_MATCH):
        self.m, self.vocabulary = m, {}
        split = [(i, WORD.findall((t or "").lower())) for i, t in items]
        give = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        every = [(i, np.array([give(w) for w in words], np.int64)) for i, words in split if words]
        self.items = [x for x in every if len(x[1]) >= m]
        self.short: dict = {}  # by their words
        for i, ids in every:
            if len(ids) < m:
                self.short.setdefault(len(ids), {}).setdefault(tuple(ids.tolist()), []).append(i)
        hashes = [rolling(ids, m) for _, ids in self.items]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        order = np.argsort(flat, kind="stable")
        self.seeds, self.owners = flat[order], owner[order]

    def matches(self, text: str | None) -> list[tuple]:
        """(item_id, words of the item, its words under tiles, tiles) of items that share a seed with the text."""
        get = self.vocabulary.get
        words = WORD.findall(text.lower()) if text else []
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        return self._short(ids) + self._long(ids)

    def _short(self, ids: np.ndarray) -> list[tuple]:
        out = []
        for n, items in self.short.items():
            run, found = ids.tolist(), {}
            for p, words in enumerate(zip(*(run[k:] for k in range(n)))):
                if words in items:
                    found.setdefault(words, p)
            out += [(i, n, n, [(0, p, n)]) for words, p in found.items() for i in items[words]]
        return out

    def _long(self, ids: np.ndarray) -> list[tuple]:
        if len(ids) < self.m or not len(self.seeds):
            return []
        gaps = np.cumsum(ids == 0)
        whole = np.flatnonzero(gaps[self.m - 1 :] == np.r_[0, gaps[: -self.m]])
        if not len(whole):
            return []
        h = rolling(ids, self.m)[whole]
        lo, hi = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
        hit = hi > lo
        if not hit.any():
            return []
        near = np.zeros(len(ids) + 1, np.int64)  # words in a run that is a seed; others can't be in a tile
        np.add.at(near, whole[hit], 1)
        np.add.at(near, whole[hit] + self.m, -1)
        kept = np.flatnonzero(np.cumsum(near)[:-1] > 0)
        jump = np.flatnonzero(np.diff(kept) > 1) + 1
        place = np.insert(kept, jump, -1)  # a gap stays a gap
        part = np.where(place >= 0, ids[place], 0)
        owners = set()
        for a, b in set(zip(lo[hit].tolist(), hi[hit].tolist())):
            owners.update(self.owners[a:b].tolist())
        out = []
        for o in sorted(owners):
            item_id, item = self.items[o]
            if found := tiles(item, part, self.m):
                out.append((item_id, len(item), sum(n for _, _, n in found), [(x, int(place[y]), n) for x, y, n in found]))
        return out


TILES = "array<struct<item_word: int, doc_word: int, words: int>>"


def _shared(benchmark: DataFrame, block_chars: int):
    """The items, broadcast; None if they are too large for that."""
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > block_chars:
        return None
    return benchmark.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in benchmark.select(F.col("item_id").cast("long"), "text").collect()])


def seeds_of(text: str | None, m: int, lengths: frozenset = frozenset()) -> np.ndarray:
    """Hashes of the different runs of m words and of the shorter lengths; of a text under m words, of lengths, its own only."""
    import xxhash

    words = WORD.findall((text or "").lower())
    ids = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    runs = [rolling(ids, n) ^ np.uint64(n) for n in (lengths | {m} if lengths else {m if len(ids) >= m else max(1, len(ids))})]
    return np.unique(np.concatenate(runs))


def _seeded(rows: DataFrame, m: int, lengths: frozenset = frozenset(), passing=None) -> DataFrame:
    """rows with a column text gain seeds: the different seeds of a text, of which passing says which to keep; rows without one go."""
    names = rows.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            for i, j in slices(TextSizes(batch.column(at)), 2_000_000):
                part = batch.slice(i, j - i)
                found = [seeds_of(t, m, lengths) for t in part.column(at).to_pylist()]
                if passing is not None:
                    found = [f[(passing.value[(f & np.uint64(8 * len(passing.value) - 1)) >> np.uint64(3)] >> (f & np.uint64(7)).astype(np.uint8)) & 1 == 1] for f in found]
                keep = pa.array([len(f) > 0 for f in found], pa.bool_())
                seeds = pa.array([f.view(np.int64) for f in found if len(f)], pa.list_(pa.int64()))
                kept = part.filter(keep)
                yield pa.record_batch([*kept.columns, seeds], names=[*names, "seeds"])

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, seeds array<long>")


def _word_counts(items: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([len(WORD.findall((t or "").lower())) for t in batch.column(0).to_pylist()], pa.int64())], names=["n"])

    return items.select("text").mapInArrow(run, "n long")


def _joined(documents: DataFrame, benchmark: DataFrame, m: int) -> DataFrame:
    """The overlaps by a join of seeds."""
    spark, kind = documents.sparkSession, dict(documents.dtypes)["doc_id"]
    items = written(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), "text"))
    seeds = written(_seeded(items, m).select("item", F.explode("seeds").alias("seed")))
    lengths = frozenset(r[0] for r in _word_counts(items).filter(F.col("n").between(1, m - 1)).distinct().collect())  # fewer than m
    count = seeds.count()
    bits = min(FILTER_BITS, 1 << max(12, (16 * count).bit_length()))
    cell = F.col("seed").bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1), cell.bitwiseAND(F.lit(7)).cast("int"))
    filled = np.zeros(bits // 8, np.uint8)
    for r in seeds.groupBy(F.shiftright(cell, 3).alias("byte")).agg(F.bit_or(bit).alias("bits")).toLocalIterator():  # bits / 8 rows at most
        filled[r["byte"]] = r["bits"]
    passing = spark.sparkContext.broadcast(filled)  # FILTER_BITS / 8 bytes at most
    hits = written(_seeded(documents.select("doc_id", "text"), m, lengths | {m}, passing).withColumn("place", F.monotonically_increasing_id()))
    asked = hits.select("place", F.explode("seeds").alias("seed"))
    met = shared_join(asked, seeds.groupBy("seed").agg(F.collect_list("item").alias("items")), "seed")
    pairs = written(met.select("place", F.explode("items").alias("item")).distinct())
    sided = shared_join(pairs, items.withColumnRenamed("text", "item_text"), "item").select("place", "item_id", "item_text")
    both = shared_join(sided, hits.select("place", "doc_id", "text"), "place").sortWithinPartitions("place")

    def run(batches):
        for batch in batches:
            ids, rows = batch.column("doc_id"), []
            for d, i, item, text in zip(range(batch.num_rows), *(batch.column(c) for c in ("item_id", "item_text", "text"))):
                for _, n, matched, found in Benchmark([(i.as_py(), item.as_py())], m).matches(text.as_py()):
                    rows.append((d, i.as_py(), n, matched, matched / n, [dict(zip(("item_word", "doc_word", "words"), t)) for t in found]))
            yield _batch(ids.take(pa.array([r[0] for r in rows], pa.int64())), [list(c) for c in zip(*(r[1:] for r in rows))] or [[] for _ in range(5)])

    return both.select("doc_id", "item_id", "item_text", "text").mapInArrow(run, f"doc_id {kind}, {OVERLAP}")


OVERLAP = f"item_id long, item_words int, matched int, coverage double, tiles {TILES}"


def _batch(ids: pa.Array, columns: list) -> pa.RecordBatch:
    tiles_type = pa.list_(pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())]))
    types = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), tiles_type)
    return pa.record_batch([ids, *(pa.array(c, t) for c, t in zip(columns, types))], names=["doc_id", "item_id", "item_words", "matched", "coverage", "tiles"])


def overlaps(documents: DataFrame, benchmark: DataFrame, m: int = MIN_MATCH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, item_words, matched, coverage, tiles of all documents and items that share a tile."""
    shared, kind = _shared(benchmark, block_chars), dict(documents.dtypes)["doc_id"]
    if shared is None:
        return _joined(documents, benchmark, m)

    def run(batches):
        known = Benchmark(shared.value, m)
        for batch in batches:
            rows: list = [[] for _ in range(6)]
            texts = batch.column(1)
            for i, j in slices(TextSizes(texts), 2_000_000):
                for d, text in zip(range(i, j), texts.slice(i, j - i).to_pylist()):
                    for item, n, matched, found in known.matches(text):
                        for column, v in zip(rows, (d, item, n, matched, matched / n, [dict(zip(("item_word", "doc_word", "words"), t)) for t in found])):
                            column.append(v)
            yield _batch(batch.column(0).take(pa.array(rows[0], pa.int64())), rows[1:])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {OVERLAP}")


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The overlaps that cover at least the threshold of an item."""
    return overlaps(documents, benchmark).filter(F.col("coverage") >= threshold)


def keep_clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, m: int = MIN_MATCH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of documents that cover the threshold of no item, with all their columns."""
    at, shared = documents.columns.index("text"), _shared(benchmark, block_chars)
    if shared is None:  # texts by a hash: what holds for a text holds for all its copies
        keys = documents.select(F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")).alias("doc_id"), "text")
        different = keys.groupBy("doc_id").agg(F.any_value("text").alias("text"))
        dirty = _joined(different, benchmark, m).filter(F.col("coverage") >= threshold).select("doc_id").distinct()
        judged = written(different.select("doc_id").join(dirty.withColumn("dirty", F.lit(True)), "doc_id", "left").filter("dirty is null").select("doc_id"))
        packed = documents.select(F.struct("*").alias("row"), F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")).alias("doc_id"))
        return shared_join(packed, judged, "doc_id").select("row.*")

    def run(batches):
        known = Benchmark(shared.value, m)
        clean = lambda text: all(matched < threshold * n for _, n, matched, _ in known.matches(text))
        for batch in batches:
            for i, j in slices(TextSizes(batch.column(at)), 2_000_000):
                part = batch.slice(i, j - i)
                yield part.filter(pa.array([clean(t) for t in part.column(at).to_pylist()], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
