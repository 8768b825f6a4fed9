"""Exact substring duplicates by prefix-partitioned suffix trees.

A window is WINDOW consecutive words of one text; a window is repeated if its words also start anywhere else. The suffixes
that enter the trees are those at anchors: in each window, the place of the least hash of GRAM words. Equal windows have
equal anchors at equal offsets, so anchors are all that need to be compared, and an anchor whose gram occurs once is dropped
before any text moves. The suffixes that are left are partitioned by a prefix of variable length: their first GRAM words,
or, where more than HOT suffixes share those, the whole window. A task builds the subtrees of its prefixes in memory-sized
lots: it sorts the suffixes, finds common prefix lengths of neighbours, and reads the internal nodes off as intervals. A node
of depth d together with the o words that its suffixes share to the left is a repeat of d + o words; nodes with d + o of at
least WINDOW give the repeated windows. Of a hot prefix, equal windows are one node, and nodes are counted with a map-side
combine, so no task gathers them. Grams, nodes and texts that many rows share are joined where those rows are (hot_join).

Equal texts are one text with a count, and text moves once: both joins with texts reuse one exchange.

Defined cases: a gram is as long as the window needs (MASK offsets at most, and no longer than the window); null texts have no words; texts under WINDOW words keep all; repeated rows are copies of each other; doc_id is
only carried; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import TextSizes, forget, hot_join, shared_join, slices, written
from headway.llm.words import WordTable

WINDOW = 35
GRAM = 8
#: Suffixes of one prefix that a task holds in memory at most, and suffixes of one lot.
HOT = 200_000
LOT = 40_000
#: A mask has a bit for each offset of a window's start before its anchor.
MASK = 62
RADIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    h = xxhash.xxh64_intdigest
    return np.array([h(w) for w in words], np.uint64).reshape(-1, 1)


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of width values the place of its least one, the leftmost of equal ones."""
    place, have = np.arange(len(values)), 1
    better = lambda a, b: np.where(values[a] <= values[b], a, b)
    while have < width:
        step = min(have, width - have)
        place = better(place[:-step], place[step:])
        have += step
    return place


def anchors_of(table: WordTable, texts: list[bytes | None], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place of the anchor's first word, gram hash) of all anchors."""
    split = [t.split() if t else [] for t in texts]  # of bytes: white space is x20, x09 to x0D
    sizes = np.array([len(w) for w in split])
    if sizes.sum() < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = table([w for words in split for w in words])[:, 0]
    n = len(h) - gram + 1
    g = np.zeros(n, np.uint64)
    for k in range(gram):
        g = g * RADIX + h[k : k + n]
    g = (g ^ g >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(29)
    text = np.repeat(np.arange(len(texts)), sizes)
    place = least_places(g, window - gram + 1)
    inside = text[: len(h) - window + 1] == text[window - 1 :]
    chosen = np.zeros(n, bool)
    chosen[place[inside]] = True
    at = np.flatnonzero(chosen)
    return text[at], at - (np.cumsum(sizes) - sizes)[text[at]], g[at]


def repeated_windows(left: np.ndarray, right: np.ndarray, window: int, gram: int) -> np.ndarray:
    """A bit mask for each suffix: bit o says that the window which starts o words to its left is repeated.

    right has the suffixes' words, left the words before them, nearest first; ids below zero equal nothing.
    """
    n, reach = len(right), window - gram
    mask = np.zeros(n, np.int64)
    if n < 2:
        return mask
    raw = [r.tobytes() for r in np.ascontiguousarray(right)]
    order = np.array(sorted(range(n), key=raw.__getitem__))
    right, left = right[order], left[order]
    same = (right[1:] == right[:-1]) & (right[1:] >= 0)
    common = np.where(same.all(axis=1), window, same.argmin(axis=1))  # of each suffix and the one before
    rows = np.arange(n)  # suffixes that have company in a node deep enough, with equal words to the left
    before = np.zeros(n, np.int64)
    for o in range(reach + 1):
        if o:
            word = left[rows, o - 1].astype(np.int64)
            _, before = np.unique(before * (word.max() - word.min() + 1) + word - word.min(), return_inverse=True)
        node = np.r_[0, np.cumsum(common < window - o)][rows]
        key = node * (len(rows) + 1) + before
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        mask[rows[count[inverse] > 1]] |= 1 << o
        wide = np.r_[0, np.cumsum(common < gram)][rows] * (len(rows) + 1) + before  # company at the least depth that later steps use
        _, inverse, count = np.unique(wide, return_inverse=True, return_counts=True)
        keep = count[inverse] > 1
        rows, before = rows[keep], before[keep]
        if not len(rows):
            break
    out = np.zeros(n, np.int64)
    out[order] = mask
    return out


def _ids(lefts: list[bytes], rights: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of contexts; where words end, ids that equal nothing."""
    known: dict = {}
    give = lambda w: known.setdefault(w, len(known))
    out = []
    for texts, width, back in ((lefts, window - gram, True), (rights, window, False)):
        m = np.repeat(-1 - np.arange(len(texts), dtype=np.int32)[:, None], width, axis=1)
        for i, t in enumerate(texts):
            words = t.split()
            if back:
                words.reverse()
            m[i, : len(words)] = [give(w) for w in words]
        out.append(m)
    return out[0], out[1]


def subtree_masks(before: list[bytes], after: list[bytes], window: int, gram: int) -> np.ndarray:
    """The masks of suffixes from the texts on both sides; equal contexts enter the tree once."""
    index: dict = {}
    of = np.array([index.setdefault(c, len(index)) for c in zip(before, after)], np.int64)
    left, right = _ids([b for b, _ in index], [a for _, a in index], window, gram)
    mask = repeated_windows(left, right, window, gram)
    several = np.bincount(of, minlength=len(index)) > 1  # then all windows inside the context are repeated
    words = (right >= 0).sum(axis=1)
    first, last = np.maximum(0, window - words), (left >= 0).sum(axis=1)
    inside = np.where(last >= first, (1 << (last + 1)) - (1 << first), 0)
    return np.where(several, mask | inside, mask)[of]


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))


def anchors(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(h1, h2, text) -> h1, h2, pos, gram."""

    def run(batches):
        table = WordTable(word_hashes)
        for batch in batches:
            raw = batch.column(2).cast(pa.binary())
            for i, j in slices(TextSizes(raw), 1_000_000):
                owner, pos, grams = anchors_of(table, raw.slice(i, j - i).to_pylist(), window, gram)
                take = pa.array(owner + i)
                yield pa.record_batch([batch.column(0).take(take), batch.column(1).take(take), pa.array(pos.astype(np.int32)), pa.array(grams.view(np.int64))], names=["h1", "h2", "pos", "gram"])

    return texts.mapInArrow(run, "h1 long, h2 long, pos int, gram long")


def _contexts(candidates: DataFrame, window: int, gram: int) -> DataFrame:
    """(h1, h2, text, found) -> the words around each anchor, and a hash of its first ones to part them by."""

    def run(batches):
        import xxhash

        h = xxhash.xxh64_digest
        for batch in batches:
            raw, found = batch.column(2).cast(pa.binary()), batch.column(3)
            for i, j in slices(TextSizes(raw), 200_000):
                rows: list = [[] for _ in range(6)]
                for r in range(i, j):
                    words = raw[r].as_py().split()
                    h1, h2 = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                    for p in found[r].as_py():
                        prefix = int.from_bytes(h(b" ".join(words[p : p + gram])), "big", signed=True)
                        row = (h1, h2, p, prefix, b" ".join(words[max(0, p - window + gram) : p]), b" ".join(words[p : p + window]))
                        for column, v in zip(rows, row):
                            column.append(v)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, types)], names=["h1", "h2", "pos", "gram", "before", "after"])

    return candidates.mapInArrow(run, "h1 long, h2 long, pos int, gram long, before binary, after binary")


def _subtrees(contexts: DataFrame, window: int, gram: int) -> DataFrame:
    """Masks from contexts that lie together by gram."""

    def lots(batches):
        """Record batches of whole grams."""
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size < LOT:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            grams = table.column("gram").to_numpy()
            cut = int(np.searchsorted(grams, grams[-1], "left"))  # grams are sorted; the last may go on
            if cut:
                yield table.slice(0, cut)
                waiting, size = table.slice(cut).to_batches(), len(grams) - cut
        if waiting:
            yield pa.Table.from_batches(waiting).combine_chunks()

    def run(batches):
        for table in lots(batches):
            mask = subtree_masks(table.column("before").to_pylist(), table.column("after").to_pylist(), window, gram)
            hit = pa.array(np.flatnonzero(mask))
            out = table.select(["h1", "h2", "pos"]).take(hit).append_column("mask", pa.array(mask[mask != 0]))
            yield from out.combine_chunks().to_batches()

    sorted_contexts = contexts.repartition("gram").sortWithinPartitions("gram")
    return sorted_contexts.mapInArrow(run, "h1 long, h2 long, pos int, mask long")


def _hot_windows(candidates: DataFrame, window: int, gram: int) -> DataFrame:
    """Masks for anchors of hot grams: windows partitioned by all their words."""

    def run(batches):
        import xxhash

        for batch in batches:
            raw, found = batch.column(2).cast(pa.binary()), batch.column(3)
            for r in range(batch.num_rows):
                words = raw[r].as_py().split()
                starts = sorted({s for p in found[r].as_py() for s in range(max(0, p - window + gram), min(p, len(words) - window) + 1)})
                digests = [xxhash.xxh3_128_digest(b" ".join(words[s : s + window])) for s in starts]
                h1, h2 = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                yield pa.record_batch([pa.array([h1] * len(starts), pa.int64()), pa.array([h2] * len(starts), pa.int64()), pa.array(starts, pa.int32()), pa.array(digests, pa.binary())], names=["h1", "h2", "pos", "node"])

    windows = candidates.mapInArrow(run, "h1 long, h2 long, pos int, node binary")
    nodes = written(windows.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1"))
    return hot_join(windows, nodes, "node").select("h1", "h2", "pos", F.lit(1).cast("long").alias("mask"))


def _cut(marked: DataFrame, window: int, verbatim: bool) -> DataFrame:
    """(h1, h2, text, copies, found) -> h1, h2, copies, n_words, n_removed, kept; verbatim: texts that keep all words as they were."""

    def run(batches):
        for batch in batches:
            raw = batch.column(2).cast(pa.binary())
            for i, j in slices(TextSizes(raw), 2_000_000):
                rows: list = [[] for _ in range(3)]
                for r in range(i, j):
                    words = raw[r].as_py().split()
                    n = len(words)
                    gone = np.zeros(n + 1, np.int64)
                    if batch.column(3)[r].as_py() > 1 and n >= window:
                        gone[0], gone[n] = 1, -1
                    for f in batch.column(4)[r].as_py() or []:
                        o = np.flatnonzero(f["mask"] >> np.arange(window) & 1)
                        np.add.at(gone, f["pos"] - o, 1)
                        np.add.at(gone, f["pos"] - o + window, -1)
                    kept = np.flatnonzero(np.cumsum(gone)[:n] == 0)
                    whole = len(kept) == n
                    text = raw[r].as_py() if whole and verbatim else b" ".join(words if whole else [words[k] for k in kept.tolist()])
                    for column, v in zip(rows, (n, n - len(kept), text)):
                        column.append(v)
                kept_texts = pa.array(rows[2], pa.binary()).cast(pa.string())
                yield pa.record_batch([*(batch.column(c).slice(i, j - i) for c in (0, 1, 3)), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), kept_texts], names=["h1", "h2", "copies", "n_words", "n_removed", "kept"])

    return marked.mapInArrow(run, "h1 long, h2 long, copies long, n_words long, n_removed long, kept string")


def _cleaned(keyed: DataFrame, window: int, gram: int, hot: int, verbatim: bool = False) -> DataFrame:
    """h1, h2, copies, n_words, n_removed, kept of each different text."""
    keyed, gram = keyed.select("h1", "h2", "text"), min(window, max(gram, window - MASK))
    found = written(anchors(keyed, window, gram))
    grams = written(found.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").withColumn("hot", F.col("n") > hot))
    candidates = written(hot_join(found, grams, "gram").drop("gram"))
    forget(found)
    forget(grams)
    texts = keyed.groupBy("h1", "h2").agg(F.any_value("text").alias("text"), F.count("*").alias("copies"))

    def with_text(hot: bool) -> DataFrame:
        mine = candidates.filter(F.col("hot") == hot).groupBy("h1", "h2").agg(F.collect_set("pos").alias("found"))
        return texts.join(mine, ["h1", "h2"]).select("h1", "h2", "text", "found")

    masks = _subtrees(_contexts(with_text(False), window, gram), window, gram)
    if candidates.filter("hot").limit(1).count():
        masks = masks.unionByName(_hot_windows(with_text(True), window, gram))
    marks = masks.groupBy("h1", "h2").agg(F.collect_list(F.struct("pos", "mask")).alias("found"))
    marked = texts.join(marks, ["h1", "h2"], "left").select("h1", "h2", "text", "copies", "found")
    return _cut(marked, window, verbatim)


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words outside repeated windows, joined by a space), or its SHA-256 if digest.

    With digest no text moves but in the one exchange of texts.
    """
    keyed, key = _keyed(documents), F.struct("h1", "h2").alias("key")
    done = _cleaned(keyed, window, gram, hot)
    if not digest:
        return shared_join(keyed.select("doc_id", key), done.select(key, "n_words", "n_removed", "kept"), "key").drop("key")
    done = written(done.select(key, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.col("copies").alias("n")))
    return hot_join(keyed.select("doc_id", key), done, "key").drop("key")


def clean(documents: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """documents without repeated windows: same columns, n_chars anew where the text changed.

    Texts that keep all words stay as they are, null ones too; documents of which no word is left go.
    """
    text, key = F.coalesce("text", F.lit("")), F.struct("h1", "h2").alias("key")
    rest = documents.select(  # packed, so that no column's name can clash
        F.struct(*[c for c in documents.columns if c != "text"]).alias("row"), F.col("text").isNull().alias("absent"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")
    )
    done = _cleaned(_keyed(documents), window, gram, hot, verbatim=True).select(key, "n_words", "n_removed", "kept")
    kept = shared_join(rest.select(key, "row", "absent"), done, "key").filter("n_removed < n_words or n_removed = 0")
    new = {"text": F.when(~F.col("absent"), F.col("kept"))}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row")["n_chars"])
    return kept.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in documents.columns])
