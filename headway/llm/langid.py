"""Language identification by a linear-chain conditional random field over words.

A word's emission scores are sums of learned weights of its affixes, its character n-grams and its lexicon entry (the word
itself), hashed into BUCKETS; transitions between the labels of neighbouring words are learned with them, by stochastic
gradient ascent on the chains' likelihood. Training chains are cut from labelled documents, and further chains splice pieces
of documents of different labels, so that switches inside a text are learned too. Words are labelled by forward-backward over
the whole text; long texts are taken in blocks of CHAIN words, whose products of transitions and emissions join them exactly.
A document's language is the one with the most posterior mass over its words with letters.

Training takes a bounded sample: about PER_LABEL rows of each label, in chains of at most CHAIN words. Prediction covers whole
texts of all rows and all characters of every word, so a text without spaces is one word with many n-grams.

Defined cases: null texts and texts without a letter are ``und`` with score 0; if no row may be learned from, all are ``und``;
repeated rows come back repeated; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import held_out, slices
from headway.llm.words import WordTable, collected, labelled_sample

BITS = 16
BUCKETS = 1 << BITS
CHAIN = 64
PER_LABEL = 250
UNDETERMINED = "und"


STRIP = ".,;:!?|\"'()[]{}<>*#$%&_-+=/\\~`0123456789"


def packed_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat buckets of all words in order, and how many each word has.

    A word's features are its lexicon entry, its affixes of 1 to 4 letters and its n-grams of 2 and 3 characters, ends
    marked; all without outer punctuation and digits. A word without a letter has none.
    """
    cores = [w.strip(STRIP).lower() for w in words]
    at = np.array([i for i, c in enumerate(cores) if c.isalpha() or any(map(str.isalpha, c))], np.int64)
    sizes = np.zeros(len(words), np.int64)
    if not len(at):
        return at, sizes
    text = "".join([f"^{cores[i]}$" for i in at.tolist()])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(cores[i]) for i in at.tolist()])
    begin = np.cumsum(length + 2) - length - 2
    owner = np.repeat(np.arange(len(at)), length + 2)
    prime = np.uint64(0x100000001B3)

    def bucket(h, kind):
        h = (h + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)

    found = []
    for k in (2, 3):
        inside = np.flatnonzero(owner[: 1 - k] == owner[k - 1 :])
        h = np.zeros(len(inside), np.uint64)
        for j in range(k):
            h = h * prime + codes[inside + j]
        found.append((bucket(h, k), owner[inside]))
    for k in range(1, 5):
        has = np.flatnonzero(length >= k)
        for kind, first in ((10 + k, begin[has] + 1), (20 + k, begin[has] + 1 + length[has] - k)):
            h = np.zeros(len(has), np.uint64)
            for j in range(k):
                h = h * prime + codes[first + j]
            found.append((bucket(h, kind), has))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(length.max() + 1, prime)])
    place = np.arange(len(codes)) - np.repeat(begin, length + 2)
    found.append((bucket(np.add.reduceat(codes * powers[place], begin), 30), np.arange(len(at))))
    owners = np.concatenate([o for _, o in found])
    order = np.argsort(owners, kind="stable")
    sizes[at] = np.bincount(owners, minlength=len(at))
    return np.concatenate([f for f, _ in found])[order], sizes


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    switch: np.ndarray  # labels x labels: from, to

    def emissions(self, words: list[str]) -> np.ndarray:
        """A row for each word: its scores, then 1 if it has a letter."""
        flat, sizes = packed_features(words)
        out = np.zeros((len(words), len(self.labels) + 1), np.float32)
        if len(flat):
            has = sizes > 0
            out[has, :-1] = np.add.reduceat(self.weights[flat], np.r_[0, np.cumsum(sizes[has])[:-1]]) / np.sqrt(sizes[has])[:, None]
            out[has, -1] = 1
        return out


def forward_backward(scores: np.ndarray, start: np.ndarray, size: np.ndarray, switch: np.ndarray, enter=None, leave=None) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of each word's labels, and the expected count of each switch inside chains (start, size).

    enter has a row for each chain: the forward message of the word before it, zeros where there is none; leave the backward
    message of what comes after its last word.
    """
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    labels, move = scores.shape[1], np.exp(switch - switch.max())
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    alpha, post, pairs = np.empty_like(emit), np.empty_like(emit), np.zeros((labels, labels))
    steps = int(size[0]) if len(size) else 0
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(steps + 1)]  # chains longer than t
    for t in range(steps):
        at = start[: active[t]] + t
        if t:
            a = (alpha[at - 1] @ move) * emit[at]
        elif enter is None:
            a = emit[at]
        else:
            before = enter[order][: active[t]]
            a = np.where(before.sum(axis=1, keepdims=True) > 0, before @ move, 1) * emit[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    beta = np.empty((0, labels))
    for t in reversed(range(steps)):
        n = active[t]
        at = start[:n] + t
        here = np.ones((n, labels)) if leave is None else leave[order][:n].copy()
        if len(beta):
            after = beta * emit[at[: len(beta)] + 1]
            if leave is None:
                joint = alpha[at[: len(beta)]][:, :, None] * move * after[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            here[: len(beta)] = after @ move.T
        here /= here.sum(axis=1, keepdims=True)
        p = alpha[at] * here
        post[at] = p / p.sum(axis=1, keepdims=True)
        beta = here
    return post, pairs


def posteriors(scores: np.ndarray, lengths: np.ndarray, switch: np.ndarray, chain: int = CHAIN) -> np.ndarray:
    """Posteriors of each word's labels, every text of lengths one chain.

    Texts over chain words are cut into blocks. The product of a block's transitions and emissions carries forward messages
    across it one way and backward messages the other, so blocks know what lies around them, and run side by side.
    """
    lengths = lengths[lengths > 0]
    blocks = -(-lengths // chain)
    nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * chain
    size = np.minimum(chain, np.repeat(lengths, blocks) - nth * chain)
    if not len(blocks) or blocks.max() == 1:
        return forward_backward(scores, start, size, switch)[0]
    labels, move = scores.shape[1], np.exp(switch - switch.max())
    across = np.repeat(np.eye(labels)[None], len(size), 0)
    part_of_long = np.repeat(blocks, blocks) > 1
    for t in range(chain):
        at = np.flatnonzero(part_of_long & (size > t))
        word = scores[start[at] + t]
        m = across[at] @ move
        if t == 0:
            m[nth[at] == 0] = np.eye(labels)
        m *= np.exp(word - word.max(axis=1, keepdims=True))[:, None, :]
        across[at] = m / m.max(axis=(1, 2), keepdims=True)
    enter, leave = np.zeros((len(size), labels)), np.ones((len(size), labels))
    first = np.cumsum(blocks) - blocks
    for b in range(1, int(blocks.max())):
        at = (first + b)[blocks > b]
        message = np.where(nth[at - 1, None] > 0, enter[at - 1], 1)[:, None, :] @ across[at - 1]
        enter[at] = message[:, 0] / message[:, 0].sum(axis=1, keepdims=True)
    for b in range(int(blocks.max()) - 1, 0, -1):
        at = (first + b)[blocks > b]
        message = (across[at] @ leave[at][:, :, None])[:, :, 0]
        leave[at - 1] = message / message.sum(axis=1, keepdims=True)
    return forward_backward(scores, start, size, switch, enter, leave)[0]


def train(sample: list[tuple[str, str]], epochs: int = 3, rate: float = 0.4, seed: int = 7) -> Model | None:
    """Learn from (text, label) rows; None if there are none with words."""
    rows = [(t.split(), y) for t, y in sample]
    labels = sorted({y for w, y in rows if w})
    if not labels:
        return None
    rng = random.Random(seed)
    of = {y: i for i, y in enumerate(labels)}
    pieces = [(w[i : i + CHAIN], of[y]) for w, y in rows for i in range(0, len(w), CHAIN)]
    texts = [(w, [y] * len(w)) for w, y in pieces]
    for _ in range(len(pieces) // 3 if len(labels) > 1 else 0):
        words, marks = [], []
        while len(words) < CHAIN:
            w, y = rng.choice(pieces)
            i, n = rng.randrange(len(w)), rng.randint(3, 20)
            words += w[i : i + n]
            marks += [y] * len(w[i : i + n])
        texts.append((words[:CHAIN], marks[:CHAIN]))
    vocabulary = sorted({w for words, _ in texts for w in words})
    index = {w: i for i, w in enumerate(vocabulary)}
    flat, sizes = packed_features(vocabulary)
    begin = np.cumsum(sizes) - sizes
    weights, switch = np.zeros((BUCKETS, len(labels))), np.zeros((len(labels), len(labels)))
    grown, switched = np.full_like(weights, 1e-3), np.full_like(switch, 1e-3)
    for _ in range(epochs):
        rng.shuffle(texts)
        for k in range(0, len(texts), 256):
            part = texts[k : k + 256]
            ids = np.array([index[w] for words, _ in part for w in words])
            gold = np.array([m for _, marks in part for m in marks])
            lengths = np.array([len(w) for w, _ in part])
            used, inverse = np.unique(ids, return_inverse=True)
            n = sizes[used]
            feats = flat[np.repeat(begin[used] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            owner = np.repeat(np.arange(len(used)), n)
            scale = 1 / np.sqrt(np.maximum(n, 1))
            score = np.stack([np.bincount(owner, weights[feats, y], len(used)) for y in range(len(labels))], 1) * scale[:, None]
            start, size = np.cumsum(lengths) - lengths, lengths
            post, pairs = forward_backward(score[inverse], start, size, switch)
            error = -post
            error[np.arange(len(gold)), gold] += 1
            by_word = np.stack([np.bincount(inverse, error[:, y], len(used)) for y in range(len(labels))], 1) * scale[:, None]
            touched, where = np.unique(feats, return_inverse=True)
            step = np.stack([np.bincount(where, by_word[owner, y], len(touched)) for y in range(len(labels))], 1) / len(part)
            grown[touched] += step**2
            weights[touched] += rate * step / np.sqrt(grown[touched])
            inner = np.ones(len(gold), bool)
            inner[start] = False
            seen = np.zeros_like(switch)
            np.add.at(seen, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
            step = (seen - pairs) / len(part)
            switched += step**2
            switch += rate * step / np.sqrt(switched)
    return Model(labels, weights.astype(np.float32), switch)


def label_texts(model: Model, table: WordTable, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, its share of the posterior, runs of (first word, words, language)) of each text."""
    split = [(t or "").split() for t in texts]
    lengths = np.array([len(w) for w in split])
    rows = table([w for words in split for w in words])
    post = posteriors(rows[:, :-1].astype(np.float64), lengths, model.switch)
    lettered = rows[:, -1] > 0
    mass = np.zeros((len(texts), len(model.labels)))
    full = np.flatnonzero(lengths)
    if len(full):
        begin = (np.cumsum(lengths) - lengths)[full]
        mass[full] = np.add.reduceat(post * lettered[:, None], begin)
    best, total = mass.argmax(axis=1), mass.sum(axis=1)
    tag = post.argmax(axis=1)
    out, at = [], 0
    for d, n in enumerate(lengths.tolist()):
        mine = tag[at : at + n]
        cut = np.flatnonzero(np.diff(mine)) + 1
        edges = [0, *cut.tolist(), n] if n else []
        runs = [(a, b - a, model.labels[mine[a]]) for a, b in zip(edges, edges[1:])]
        known = total[d] > 0
        out.append((model.labels[best[d]] if known else UNDETERMINED, float(min(1.0, mass[d, best[d]] / total[d])) if known else 0.0, runs))
        at += n
    return out


def identify(documents: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, lang_pred, score, runs: learned from the rows' lang where it isn't held out, predicted from text alone."""
    model = train(collected(labelled_sample(documents.select("doc_id", "text", "lang"), "lang", per_label)[0], "lang"))
    kind = dict(documents.dtypes)["doc_id"]
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    runs = "array<struct<first_word: int, words: int, lang: string>>"
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast(runs).alias("runs"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows at any size

    def run(batches):
        table = WordTable(shared.value.emissions)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in slices(texts, 400_000):
                found = label_texts(shared.value, table, texts[i:j])
                kinds = pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array([x[0] for x in found]), pa.array([x[1] for x in found], pa.float64()),
                     pa.array([[dict(zip(("first_word", "words", "lang"), r)) for r in x[2]] for x in found], kinds)],
                    names=["doc_id", "held_out", "lang_pred", "score", "runs"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, runs {runs}")
