"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are dealt into tiles by the population counts of their parts: four quarters of 16 bits, or, where the radius is
wide, the whole in steps of more than the radius, and the size of the text's set. Two fingerprints within the radius have counts that differ by no more than the radius in all, so only such
tiles are paired; within a pair of tiles every pair is compared, by numpy exclusive-or and bit counts. Tiles are cut into
chunks, so a pair of chunks has bounded memory however large a tile grows. Equal fingerprints are one from the start.

``near_duplicates`` links fingerprints within a radius: each pair of chunks returns a spanning forest of its links, never all
of them. ``keep_first`` links texts whose sets of K-word shingles have a Jaccard similarity of SIMILARITY or more: the tiles
propose pairs whose fingerprints differ by WIDE bits or fewer, a second fingerprint and the sizes of the sets drop those that
are near by chance, and the texts decide each. Texts are dealt into blocks by a neighbour that they share, and blocks that
hold a proposed pair meet in a task, which returns links that join what is similar; pairs themselves are never written. What
is linked is exact; a pair of similarity 0.8 is proposed with a probability of 0.997.

Defined cases: null and empty texts and texts of white space only have fingerprint zero, which links like any other, and are
one group by shingles; texts under k words are one shingle; repeated rows are rows of one group; rows with a null doc_id link
like others, but a null never names a component while another id is there; an empty table gives no rows. Other columns are
ignored by near_duplicates and carried by keep_first.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import TextSizes, checkpointed, forget, hot_join, slices, written
from headway.llm.components import connected_components

CHUNK = 2048
#: Of keep_first: words of a shingle, least similarity, bits that the fingerprint and both fingerprints together may differ by.
K, SIMILARITY, WIDE, BOTH = 5, 0.8, 18, 33
WIDE_CHUNK = 16_384
#: Texts of a block; a task compares the texts of two.
BLOCK = 64


def shingle_hashes(text: bytes, k: int, seed: int = 42) -> np.ndarray:
    """Hashes of the shingles of k words in order; none where there is no word, one where there are fewer than k."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, and white space is x20, x09 to x0D
    if not words:
        return np.zeros(0, "<u8")
    n = max(1, len(words) - k + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    joined, starts = b" ".join(words), [0, *ends[: n - 1].tolist()]
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], seed) for a, b in zip(starts, (ends[min(k, len(words)) - 1 :] - 1).tolist())], dtype="<u8")


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits that are set in over half the hashes."""
    n = len(hashes)
    if not n:
        return np.uint64(0)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        part = hashes[i : i + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]


def fingerprint(text: bytes, k: int = 3, seed: int = 42) -> np.uint64:
    return majority(shingle_hashes(text, k, seed))


def shingle_set(text: bytes, k: int = K) -> np.ndarray:
    return np.unique(shingle_hashes(text, k))


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Other hashes of the same shingles."""
    h = (hashes ^ hashes >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def fingerprints(documents: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp: the fingerprint's bits as a long; one row for each input row."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for i, j in slices(TextSizes(texts), 4_000_000):
                found = np.array([fingerprint(t.as_py() or b"", k) for t in texts.slice(i, j - i)], dtype="<u8")
                yield pa.record_batch([ids.slice(i, j - i), pa.array(found.view("<i8"))], names=["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node to the least node of its component, for nodes below n."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            at = np.flatnonzero(label != np.arange(n))
            return at, label[at]
        label = new


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between a and b (or within a): nodes 0.. are a's, len(a).. are b's."""
    rows, n = [], len(a) + (0 if same else len(b))
    for k in range(0, len(a), 256):
        near = np.bitwise_count(a[k : k + 256, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        i += k
        if same:
            i, j = i[i < j], j[i < j]
        else:
            j = j + len(a)
        rows.append((i, j) if len(i) < 4 * n else _forest(i, j, n))
    return _forest(np.concatenate([x[0] for x in rows]), np.concatenate([x[1] for x in rows]), n)


def _part(fp: Column, p: int, width: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, width * p).bitwiseAND(F.lit((1 << width) - 1)))


def _digits(radius: int, sized: bool, similarity: float) -> list[tuple[Column, int, int]]:
    """What a tile is: (value, how many values, by how much two fingerprints within the radius can differ in it).

    A narrow radius takes the population counts of four quarters; a wide one that of the whole in steps of over the radius,
    and, where rows have a size, the sizes in steps of over the ratio that the similarity allows.
    """
    if radius <= 3:
        return [(_part(F.col("fp"), p, 16), 17, radius) for p in range(4)]
    out = [(F.floor(F.bit_count("fp") / (radius + 1)).cast("int"), 64 // (radius + 1) + 1, 1)]
    if sized:
        step = F.floor(F.log(F.greatest(F.col("size"), F.lit(1)).cast("double")) / F.log(F.lit(1.0001 / similarity)))
        out.append((F.least(step, F.lit(254)).cast("int"), 255, 1))
    return out


def _tile_pairs(prints: DataFrame, radius: int, chunk: int, similarity: float = SIMILARITY) -> DataFrame:
    """(fp, other columns) -> same, a, b: each pair of chunks whose tiles may hold fingerprints within the radius.

    a and b are structs of lists, one for each column. Chunks hold about chunk rows each.
    """
    columns, narrow = prints.columns, radius <= 3
    digits = _digits(radius, "size" in columns, similarity)
    place = [math.prod(n for _, n, _ in digits[:k]) for k in range(len(digits))]
    tiled = prints.withColumn("tile", sum(value * p for (value, _, _), p in zip(digits, place)).cast("long"))
    # as many rows as there are tiles at most: 83,521
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    dealt = tiled.join(F.broadcast(sizes), "tile").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    packed = checkpointed(dealt.groupBy("tile", "chunk").agg(F.collect_list(F.struct(*columns)).alias("rows")).select("tile", "chunk", F.struct(*[F.col(f"rows.{c}").alias(c) for c in columns]).alias("b")))
    steps = [d for d in itertools.product(*[range(-reach, reach + 1) for _, _, reach in digits]) if not narrow or sum(map(abs, d)) <= radius]
    near = []
    for d in steps:
        offset = sum(x * p for x, p in zip(d, place))
        if offset > 0 or not any(d):  # each pair of tiles from its smaller one
            fits = F.lit(True)
            for x, p, (_, n, _) in zip(d, place, digits):
                fits = fits & (F.floor(F.col("tile") / p) % n + x).between(0, n - 1) if x else fits
            near.append(F.when(fits, F.col("tile") + offset))
    other = sizes.select(F.col("tile").alias("to_tile"), F.col("chunks").alias("to_chunks"))
    probes = packed.select("tile", "chunk", F.col("b").alias("a"), F.explode(F.array_compact(F.array(*near))).alias("to_tile")).join(F.broadcast(other), "to_tile")
    first = F.when(F.col("tile") == F.col("to_tile"), F.col("chunk")).otherwise(0)
    probes = probes.select("tile", "chunk", "a", "to_tile", F.explode(F.sequence(first, F.col("to_chunks") - 1)).alias("to_chunk"))
    targets = packed.withColumnsRenamed({"tile": "to_tile", "chunk": "to_chunk"})
    same = (F.col("tile") == F.col("to_tile")) & (F.col("chunk") == F.col("to_chunk"))
    return probes.join(targets, ["to_tile", "to_chunk"]).select(same.alias("same"), "a", "b")


def _arrays(batch: pa.RecordBatch, r: int) -> tuple[bool, dict, dict]:
    """Row r of _tile_pairs."""
    side = lambda c: {f.name: batch.column(c).field(f.name)[r].values.to_numpy(zero_copy_only=False) for f in batch.column(c).type}
    return batch.column(0)[r].as_py(), side(1), side(2)


def link(distinct: DataFrame, radius: int = 2, chunk: int = CHUNK) -> DataFrame:
    """fp, each once -> (a, b): links of fingerprints that join all which are within the radius."""

    def run(batches):
        for batch in batches:
            found = []
            for r in range(batch.num_rows):
                same, x, y = _arrays(batch, r)
                a, b = x["fp"], y["fp"]
                i, j = tile_links(a.view(np.uint64), b.view(np.uint64), radius, same)
                if len(i):
                    both = a if same else np.concatenate([a, b])
                    found.append((both[i], both[j]))
            if found:
                yield pa.record_batch([pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)], names=["a", "b"])

    return _tile_pairs(distinct.select("fp"), radius, chunk).mapInArrow(run, "a long, b long")


def near_duplicates(documents: DataFrame, radius: int = 2, k: int = 3, chunk: int = CHUNK) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (least doc_id that links reach)."""
    marked = checkpointed(fingerprints(documents, k))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    joined = checkpointed(connected_components(link(distinct, radius, chunk)))
    parts = checkpointed(distinct.join(joined, distinct["fp"] == joined["node"], "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("part")))
    named = checkpointed(parts.groupBy("part").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    groups = checkpointed(hot_join(parts, named, "part").select("fp", "component_id", "n"))
    return hot_join(marked, groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_places(a: dict, b: dict, same: bool, similarity: float = SIMILARITY, wide: int = WIDE, both: int = BOTH):
    """Places in a and in b, in arrays by rows of a, whose fingerprints and sizes allow the similarity."""
    x, y, u, v = (c.view(np.uint64) for c in (a["fp"], b["fp"], a["other"], b["other"]))
    for k in range(0, len(x), 16):
        rows = []
        for o in range(0, len(y), 4096):
            i, j = np.divmod(np.flatnonzero(np.bitwise_count(x[k : k + 16, None] ^ y[None, o : o + 4096]) <= wide), len(y[o : o + 4096]))
            rows.append((i + k, j + o))
        i, j = (np.concatenate([r[c] for r in rows]) for c in (0, 1))
        keep = np.bitwise_count(x[i] ^ y[j]) + np.bitwise_count(u[i] ^ v[j]) <= both
        keep &= np.minimum(a["size"][i], b["size"][j]) >= similarity * np.maximum(a["size"][i], b["size"][j])
        if same:
            keep &= i < j
        if keep.any():
            order = np.lexsort((j[keep], i[keep]))
            yield i[keep][order], j[keep][order]


def first_neighbours(nodes: DataFrame, chunk: int = WIDE_CHUNK) -> DataFrame:
    """(fp, other, size, node) -> (node, mate): of nodes that may have a similar one, the least of these in each chunk."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                same, x, y = _arrays(batch, r)
                of_x, of_y = (np.full(len(c["node"]), np.iinfo(np.int64).max) for c in (x, y))
                for i, j in near_places(x, y, same):
                    np.minimum.at(of_x, i, y["node"][j])
                    np.minimum.at(of_y, j, x["node"][i])
                for side, mate in ((x, of_x), (y, of_y)):
                    met = np.flatnonzero(mate < np.iinfo(np.int64).max)
                    yield pa.record_batch([pa.array(side["node"][met]), pa.array(mate[met])], names=["node", "mate"])

    return _tile_pairs(nodes.select("fp", "other", "size", "node"), WIDE, chunk).mapInArrow(run, "node long, mate long")


def blocks_of(first: DataFrame, size: int = BLOCK) -> DataFrame:
    """(node, mate) -> node, block: blocks hold about size nodes that have their least neighbour in common."""
    near = checkpointed(first.groupBy("node").agg(F.least("node", F.min("mate")).alias("lead")))
    sizes = checkpointed(near.groupBy("lead").agg(F.count("*").alias("n")).withColumn("of", F.ceil(F.col("n") / size).cast("int")))
    return hot_join(near, sizes, "lead").select("node", F.xxhash64("lead", F.pmod(F.xxhash64("node"), "of")).alias("block"))


def block_pairs(nodes: DataFrame, chunk: int = WIDE_CHUNK) -> DataFrame:
    """(fp, other, size, block) -> (x, y), x <= y: the pairs of blocks that hold two texts which may be similar."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                same, x, y = _arrays(batch, r)
                found = [np.zeros((0, 2), np.int64)]
                for i, j in near_places(x, y, same):
                    found.append(np.unique(np.sort(np.stack([x["block"][i], y["block"][j]], 1), axis=1), axis=0))
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.record_batch([pa.array(pairs[:, c]) for c in (0, 1)], names=["x", "y"])

    return _tile_pairs(nodes.select("fp", "other", "size", "block"), WIDE, chunk).mapInArrow(run, "x long, y long").distinct()


def similar_links(a: dict, b: dict, texts_a: list, texts_b: list, same: bool, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between the texts of a and of b (or within a): places 0.. are a's, len(a).. are b's.

    Texts that are connected already are not compared, so a group of copies takes one comparison for each.
    """
    n = len(texts_a)
    label, sets = np.arange(n + (0 if same else len(texts_b))), {}

    def set_of(p: int) -> np.ndarray:
        if p not in sets:
            text = texts_a[p] if p < n else texts_b[p - n]
            sets[p] = shingle_set(text.as_py() or b"")
        return sets[p]

    for rows, columns in near_places(a, b, same, similarity):
        others = columns if same else columns + n
        for i in np.unique(rows).tolist():
            j = others[rows == i]
            j = j[label[j] != label[i]]
            if not len(j):
                continue
            mine, theirs = set_of(i), [set_of(p) for p in j.tolist()]
            size, flat = np.array([len(s) for s in theirs]), np.concatenate(theirs)
            if not len(mine) or not len(flat):
                continue
            hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
            shared = np.bincount(np.repeat(np.arange(len(j)), size), hit, len(j))
            linked = (shared >= 1) & (shared >= similarity * (len(mine) + size - shared))
            if linked.any():
                joined = np.isin(label, label[np.r_[i, j[linked]]])
                label[joined] = label[joined].min()
    at = np.flatnonzero(label != np.arange(len(label)))
    return at, label[at]


def similar_groups(nodes: DataFrame, texts_of, similarity: float = SIMILARITY, chunk: int = WIDE_CHUNK) -> DataFrame:
    """(node, fp, other, size) -> (node, component) of the nodes that have a similar one; texts_of gives (node, text) of some nodes.

    Texts are compared where two blocks meet, and a task emits links that join what is similar, never pairs that may be.
    """
    blocks = checkpointed(blocks_of(first_neighbours(nodes, chunk)))
    mine = checkpointed(nodes.join(blocks, "node"))
    units = checkpointed(block_pairs(mine, chunk))
    held = mine.join(texts_of(blocks.select("node")), "node")
    packed = written(held.groupBy("block").agg(F.collect_list(F.struct("node", "fp", "other", "size", "text")).alias("rows")))
    side = lambda c: packed.select(F.col("block").alias(c), F.col("rows").alias(f"of_{c}"))

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                same = batch.column(0)[r].as_py()
                rows = [batch.column(c)[r].values for c in ((1, 1) if same else (1, 2))]
                a, b = ({c: x.field(c).to_numpy(zero_copy_only=False) for c in ("node", "fp", "other", "size")} for x in rows)
                texts_a, texts_b = (x.field("text").cast(pa.binary()) for x in rows)
                i, j = similar_links(a, b, texts_a, texts_b, same, similarity)
                both = a["node"] if same else np.concatenate([a["node"], b["node"]])
                yield pa.record_batch([pa.array(both[i]), pa.array(both[j])], names=["a", "b"])

    same = F.col("x") == F.col("y")
    met = units.join(side("x"), "x").join(side("y"), "y").select(same.alias("same"), "of_x", F.when(~same, F.col("of_y")).alias("of_y"))
    out = checkpointed(connected_components(met.mapInArrow(run, "a long, b long")))
    forget(packed)
    return out


def _marked(keyed: DataFrame, k: int) -> DataFrame:
    """(doc_id, h1, h2, row with a text) -> the first three, and the set of shingles: two hashes, size, two fingerprints."""

    def run(batches):
        import xxhash

        h = xxhash.xxh64_intdigest
        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            for i, j in slices(TextSizes(texts), 4_000_000):
                found = np.zeros((5, j - i), "<u8")
                for n, t in enumerate(texts.slice(i, j - i)):
                    s = shingle_set(t.as_py() or b"", k)
                    raw = s.tobytes()
                    found[:, n] = h(raw), h(raw, 1), len(s), majority(s), majority(mixed(s))
                yield pa.record_batch([*(batch.column(c).slice(i, j - i) for c in range(3)), *(pa.array(f.view("<i8")) for f in found)], names=["doc_id", "h1", "h2", "s1", "s2", "size", "fp", "other"])

    rows = keyed.select("doc_id", "h1", "h2", F.col("row.text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, h1 long, h2 long, s1 long, s2 long, size long, fp long, other long")


def keep_first(documents: DataFrame, similarity: float = SIMILARITY, k: int = K, chunk: int = WIDE_CHUNK) -> DataFrame:
    """One document of each group of texts linked by the similarity, with all its columns.

    The row of the least doc_id stays, then of the least hash, and one with a null doc_id only where a group has no other.
    Rows that repeat id and text are one row; rows that repeat an id with different texts are different documents. The radius
    is set for similarities of SIMILARITY or more; a lesser one is an error.
    """
    if similarity < SIMILARITY:
        raise ValueError(f"a similarity of {SIMILARITY} or more is needed")
    doc_id = F.col("doc_id").cast("long")
    packed = F.struct("*").alias("row")  # so that no column's name can clash
    keyed = documents.select(packed, doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("h1"), F.xxhash64("text", doc_id, F.lit(1)).alias("h2"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "h1", "h2")).alias("first")
    marked = _marked(keyed, k).groupBy("s1", "s2").agg(first, *[F.any_value(c).alias(c) for c in ("size", "fp", "other")])
    nodes = written(marked.select(F.monotonically_increasing_id().alias("node"), "first", "size", "fp", "other"))

    def texts_of(some: DataFrame) -> DataFrame:
        wanted = some.join(nodes, "node").select("node", "first.h1", "first.h2")
        return keyed.select("h1", "h2", F.col("row.text").alias("text")).join(wanted, ["h1", "h2"]).dropDuplicates(["node"]).select("node", "text")

    groups = nodes.join(similar_groups(nodes.select("node", "fp", "other", "size"), texts_of, similarity, chunk), "node", "left")
    kept = checkpointed(groups.groupBy(F.coalesce("component", "node").alias("group")).agg(F.min("first").alias("first")).select("first.h1", "first.h2"))
    forget(nodes)
    rows = keyed.groupBy("h1", "h2").agg(F.any_value("row").alias("row"))  # combined before they move
    return rows.join(kept, ["h1", "h2"], "left_semi").select("row.*")
