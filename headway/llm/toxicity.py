"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words and word beginnings that labelled toxic documents use far more often than others. Each
document's dense features are the density of lexicon words, their summed and largest weight, the densest stretch of WINDOW
words, lexicon words near a word of the second person, and the rates of second-person words, capitals, exclamation and
question marks, and obfuscated words (letters mixed with digits or marks), also of lexicon words so written. Trees are fitted
to features from lexicons that did not see the document (FOLDS folds), and the scores of trees that did not see it either
calibrate the final ones.

Training takes a bounded sample: about PER_LABEL rows of each label, weighted to the shares of all labelled rows. Scores
cover whole texts of all rows.

Defined cases: null and empty texts have all features zero and the score that goes with them; if only one label or none may
be learned from, every score is the weighted share of toxic rows (0.0 without rows); labels other than 0 and 1 are none; a
document with several label rows is learned from each; words over LONGEST characters are read in pieces of that many; repeated rows come back repeated; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import held_out, slices
from headway.llm.words import WordTable, collected, labelled_sample

PER_LABEL = 2500
FOLDS = 4
WINDOW = 50
NEAR = 3
#: Words of the second person, and characters that stand for letters.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti tus usted ustedes".split())
LETTERS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, ".": None, "-": None, "_": None, "+": None, "#": None})
MARKS = ".,;:!?|\"'()[]{}<>*#$%&_-+=/\\~`"
FEATURES = 12
LONGEST = 40


def keys_of(core: str) -> list[str]:
    return [f"={core}"] + [core[:k] for k in range(3, min(9, len(core)))] if core else []


def tokens_of(text: str | None) -> list[str]:
    """All of a text, in words of LONGEST characters at most: longer ones are several."""
    words = (text or "").split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def core_of(token: str) -> tuple[str, bool]:
    """A token's letters in lower case, and whether they were mixed with other characters."""
    core = token.strip(MARKS).lower()
    if not core or core.isalpha():
        return core, False
    plain = core.translate(LETTERS)
    return plain, plain.isalpha() and sum(map(str.isalpha, core)) > 0 and len(plain) > 2


@dataclass
class Lexicon:
    weights: dict = field(default_factory=dict)

    def rows(self, tokens: list[str]) -> np.ndarray:
        """weight of a token, second person, capitals, exclamation and question marks, obfuscated."""
        out = np.zeros((len(tokens), 5), np.float32)
        for i, t in enumerate(tokens):
            core, mixed = core_of(t)
            out[i, 0] = max((self.weights.get(k, 0.0) for k in keys_of(core)), default=0.0)
            out[i, 1] = core in SECOND_PERSON
            out[i, 2] = len(core) > 1 and t.isupper()
            out[i, 3] = t.count("!") + t.count("?")
            out[i, 4] = mixed
        return out


def learn_lexicon(toxic: Counter, clean: Counter, n_toxic: float, n_clean: float) -> Lexicon:
    """From the numbers of toxic and clean documents that have each key."""
    weights = {}
    for k, a in toxic.items():
        b = clean.get(k, 0)
        if a >= 3 and a * n_clean > 3 * b * n_toxic:
            odds = math.log((a + 0.5) / (n_toxic - a + 0.5)) - math.log((b + 0.5) / (n_clean - b + 0.5))
            if odds > 1.5 and odds > 3.5 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)):
                weights[k] = min(odds, 10.0)
    return Lexicon(weights)


def features(table: WordTable, texts: list[str | None]) -> np.ndarray:
    split = [tokens_of(t) for t in texts]
    size = np.array([len(w) for w in split], np.int64)
    out = np.zeros((len(texts), FEATURES))
    full = np.flatnonzero(size)
    if not len(full):
        return out
    rows = table([w for words in split for w in words]).astype(np.float64)
    begin, n = (np.cumsum(size) - size)[full], size[full]
    doc = np.repeat(np.arange(len(full)), n)
    weight, hit, second = rows[:, 0], (rows[:, 0] > 0).astype(np.float64), rows[:, 1]
    close = second.copy()
    for k in range(1, NEAR + 1):
        same = doc[k:] == doc[:-k]
        close[k:] = np.maximum(close[k:], second[:-k] * same)
        close[:-k] = np.maximum(close[:-k], second[k:] * same)
    total = lambda x: np.add.reduceat(x, begin)
    hits = total(hit)
    upto = np.cumsum(hit)
    last = np.minimum(np.arange(len(hit)) + WINDOW, np.repeat(begin + n, n)) - 1
    out[full] = np.stack(
        [hits / n, np.log1p(hits), total(weight) / n, np.maximum.reduceat(weight, begin), np.maximum.reduceat(upto[last] - upto + hit, begin),
         total(hit * close) / n, total(second) / n, total(rows[:, 2]) / n, total(rows[:, 3]) / n, total(rows[:, 4]) / n, total(rows[:, 4] * hit) / n, np.log1p(n)], 1
    )
    return out


@dataclass
class Trees:
    """Boosted regression trees for the log odds, all of one depth."""

    base: float
    depth: int
    split: np.ndarray  # trees x inner nodes: feature
    at: np.ndarray  # trees x inner nodes: threshold; greater values go right
    leaf: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, at, leaf in zip(self.split, self.at, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > at[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48) -> Trees:
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)))[:-1] for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)  # bin > k iff x > edge k
    w = w / w.mean()
    mean = np.clip((y * w).sum() / w.sum(), 1e-3, 1 - 1e-3)
    out = Trees(float(np.log(mean / (1 - mean))), depth, np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)))
    raw = np.full(len(x), out.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (y - p), w * p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            for f in range(x.shape[1]):
                if not len(edges[f]):
                    continue
                cells = width * (bins + 1)
                at = local * (bins + 1) + binned[:, f]
                gs = np.cumsum(np.bincount(at, g, cells).reshape(width, -1), 1)
                hs = np.cumsum(np.bincount(at, h, cells).reshape(width, -1), 1)
                gl, hl, gt, ht = gs[:, : len(edges[f])], hs[:, : len(edges[f])], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < 0.5) | (ht - hl < 0.5)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best
                best[better] = gain[np.arange(width), k][better]
                out.split[t, first : first + width][better] = f
                out.at[t, first : first + width][better] = edges[f][k[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), out.split[t, node]] > out.at[t, node])
        local = node - (2**depth - 1)
        out.leaf[t] = rate * np.bincount(local, g, 2**depth) / (np.bincount(local, h, 2**depth) + 1)
        raw += out.leaf[t, local]
    return out


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (mean score, share) that rise in both."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # weight, weighted score, weighted label
    for s, v, u in zip(score[order].tolist(), y[order].tolist(), w[order].tolist()):
        blocks.append([u, u * s, u * v])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[1] / b[0] for b in blocks]), np.array([b[2] / b[0] for b in blocks])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.share)
        raw = self.trees.raw(x)
        calibrated = np.interp(raw, *self.knots)
        return np.clip(0.999 * calibrated + 0.001 / (1 + np.exp(-raw)), 0, 1)  # the last part only orders equal shares


def train(sample: list[tuple[str, int]], counts: dict) -> Model:
    """From (text, 0 or 1) rows and how many rows there were of each label."""
    labels = np.array([int(y) for _, y in sample])
    total = sum(counts.values())
    share = sum(n for y, n in counts.items() if y == 1) / total if total else 0.0
    if len(set(labels.tolist())) < 2:  # labels without texts count too
        return Model(Lexicon(), None, (), share)
    kept = {y: int((labels == y).sum()) for y in (0, 1)}
    w = np.array([counts[y] / kept[y] for y in labels.tolist()])
    fold = np.zeros(len(labels), np.int64)
    for y in (0, 1):
        fold[labels == y] = np.arange(kept[y]) % FOLDS
    found = {(y, k): Counter() for y in (0, 1) for k in range(FOLDS)}
    cache: dict = {}
    for (text, _), y, k in zip(sample, labels.tolist(), fold.tolist()):
        keys: set = set()
        for t in set(tokens_of(text)):
            if t not in cache:
                cache[t] = keys_of(core_of(t)[0])
            keys.update(cache[t])
        found[y, k].update(keys)

    def lexicon_without(out: int) -> Lexicon:
        of = lambda y: sum((found[y, k] for k in range(FOLDS) if k != out), Counter())
        n = lambda y: int(((labels == y) & (fold != out)).sum())
        return learn_lexicon(of(1), of(0), n(1), n(0))

    texts = [t for t, _ in sample]
    x = np.zeros((len(texts), FEATURES))
    for k in range(FOLDS):
        table, mine = WordTable(lexicon_without(k).rows), np.flatnonzero(fold == k)
        part = [texts[i] for i in mine]
        for i, j in slices(part, 500_000):
            x[mine[i:j]] = features(table, part[i:j])
    y = labels.astype(np.float64)
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        raw[fold == k] = fit_trees(x[fold != k], y[fold != k], w[fold != k]).raw(x[fold == k])
    return Model(lexicon_without(-1), fit_trees(x, y, w), isotonic(raw, y, w), share)


def learn(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """From labels.toxic of documents that aren't held out."""
    known = labels.filter("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen, counts = labelled_sample(known, "toxic", per_label)
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # a bounded sample: texts don't move for it
    return train(collected(sample, "toxic"), counts)


def _scored(model: Model, table: WordTable, batch: pa.RecordBatch, text: int):
    """(slice of the batch, scores) for all of a batch."""
    texts = batch.column(text).to_pylist()
    for i, j in slices(texts, 500_000):
        yield batch.slice(i, j - i), model.scores(features(table, texts[i:j]))


def score(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of documents."""
    shared = documents.sparkSession.sparkContext.broadcast(learn(documents, labels, per_label))  # grows with the bounded sample only

    def run(batches):
        table = WordTable(shared.value.lexicon.rows)
        for batch in batches:
            for part, s in _scored(shared.value, table, batch, 2):
                yield pa.record_batch([part.column(0), part.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {dict(documents.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def keep_clean(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """The rows of documents that aren't predicted toxic, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(learn(documents, labels, per_label))
    text = documents.columns.index("text")

    def run(batches):
        table = WordTable(shared.value.lexicon.rows)
        for batch in batches:
            for part, s in _scored(shared.value, table, batch, text):
                yield part.filter(pa.array(s < 0.5))

    return documents.mapInArrow(run, documents.schema)
