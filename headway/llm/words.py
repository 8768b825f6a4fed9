"""Per-word numbers that a worker computes once for each distinct word, and bounded samples of labelled rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import held_out


#: Characters of a row of a sample at most; with the number of rows, this bounds what a sample brings to the driver.
SAMPLE_CHARS = 100_000
#: Characters of the words that a WordTable remembers at most.
KNOWN_CHARS = 20_000_000


class WordTable:
    """Rows of numbers for words, remembered for about cap distinct words."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], cap: int = 150_000):
        self.compute, self.cap, self.known, self.rows, self.chars = compute, cap, {}, None, 0

    def __call__(self, words: list[str]) -> np.ndarray:
        """One row for each word."""
        new = list(set(words) - self.known.keys())
        if self.known and (len(self.known) + len(new) > self.cap or self.chars > KNOWN_CHARS):
            self.known, self.rows, self.chars = {}, None, 0
            new = list(set(words))
        if new:
            self.chars += sum(map(len, new))
            rows = self.compute(new)
            start = len(self.known)
            self.known.update(zip(new, range(start, start + len(new))))
            if self.rows is None or start + len(new) > len(self.rows):  # grow by doubling
                grown = np.empty((2 * (start + len(new)), rows.shape[1]), rows.dtype)
                grown[:start] = self.rows[:start] if start else 0
                self.rows = grown
            self.rows[start : start + len(new)] = rows
        if not words:
            return self.compute([])
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]


def fraction(doc_id: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    return F.shiftrightunsigned(F.xxhash64(doc_id.cast("string"), F.lit("sample")), 11) / float(1 << 53)


def labelled_sample(rows: DataFrame, label: str, per_label: int) -> tuple[DataFrame, dict]:
    """About per_label rows of each label, never more than 1.5 times as many in all; and how many rows each label has.

    From rows with doc_id and a label that isn't null, without those held out. Which rows depends on their ids alone. Every
    label is learned, however rare.
    """
    usable = rows.filter(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in usable.groupBy(label).count().collect()}  # a row for each label, as a model has
    shares = rows.sparkSession.createDataFrame([(y, 1.2 * per_label / n) for y, n in counts.items()], f"{label} {dict(rows.dtypes)[label]}, _share double")
    chosen = usable.join(F.broadcast(shares), label).filter(fraction(F.col("doc_id")) < F.col("_share")).select(*rows.columns)
    return chosen.limit(int(1.5 * per_label * max(1, len(counts)))), counts


def collected(sample: DataFrame, label: str) -> list[tuple[str, object]]:
    """The (text, label) rows of a bounded sample, in an order that doesn't depend on how it was computed.

    Rows of over SAMPLE_CHARS characters aren't learned from.
    """
    rows = sample.filter(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text", label).collect()
    return [(r[1], r[2]) for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))]
