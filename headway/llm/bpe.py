"""BPE encoding and decoding in batched numpy merge rounds.

Texts are looked up by their runs without white space, which a worker remembers. The words of a batch that aren't known yet
lie in one flat array of symbols. A round looks up every adjacent pair by binary search over the sorted pair keys, and merges
all places of each word's lowest-rank pair, from the left; a word is done when no pair has a rank. As a merge only ever makes
pairs of a later rank (checked when a vocabulary is loaded), these are the merges that one pair at a time, lowest rank first,
would make. A word of over LONG characters takes its rounds alone, each over the places of one rank.

Defined cases: null text is empty and has no ids; special tokens in a text are their ids; repeated rows come back repeated;
an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import slices

NONE = np.iinfo(np.int64).max
#: Runs without white space that a worker remembers.
KNOWN = 200_000
#: Characters from which a word is merged by itself.
LONG = 256
OTHER_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else the next one from U+0100."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of flat that begin there and have those sizes, one after the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class WordBpe:
    """A vocabulary file of the tokenizers library: BPE with word ends, lower case, white space dropped."""

    def __init__(self, spec: str):
        import regex

        data = json.loads(spec)
        model = data["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = dict(sorted((i, t) for t, i in (vocab | self.special).items()))
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols])
        self.last = np.array([vocab[s + end] for s in symbols])
        pairs = [(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        left, right, made = (np.array(x) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)))
        rank_of = np.full(max(self.tokens) + 1, -1)
        rank_of[made[::-1]] = np.arange(len(made))[::-1]  # where two merges make a token, the first
        if (np.maximum(rank_of[left], rank_of[right]) >= np.arange(len(made))).any():
            raise ValueError("a merge comes before a merge that makes one of its parts")
        keys = left << 32 | right
        self.ranks = np.argsort(keys, kind="stable")
        self.keys, self.made, self.made_by_rank = keys[self.ranks], made[self.ranks], made
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.named = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.string())
        self._forget()

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, none of them empty, and how many each has."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list = [(word[:0], sym[:0])]
        while len(sym):
            key = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], NONE)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, NONE], first)
            size = np.diff(np.r_[first, len(sym)])
            over = lowest == NONE
            if over.any():  # words without a pair leave
                gone = np.repeat(over, size)
                done.append((word[gone], sym[gone]))
                keep = np.repeat(~over, size)
                sym, word, at, rank = sym[keep], word[keep], np.r_[at, 0][keep], np.r_[rank, NONE][keep]
                lowest, size = lowest[~over], size[~over]
                if not len(sym):
                    break
            else:
                at, rank = np.r_[at, 0], np.r_[rank, NONE]
            low = rank == np.repeat(lowest, size)
            start = np.maximum.accumulate(np.where(low & ~np.r_[False, low[:-1]], np.arange(len(low)), 0))
            hit = np.flatnonzero(low & ((np.arange(len(low)) - start) % 2 == 0))
            sym[hit] = self.made[at[hit]]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            sym, word = sym[stay], word[stay]
        owner, ids = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def merge_long(self, word: str) -> tuple:
        """The ids of one long word: places wait under their pair's rank, so a round looks only at those of the lowest one.

        As new pairs have a later rank, a rank comes up once, and the time is near linear in the word.
        """
        raw = np.frombuffer(word.encode(), np.uint8)
        sym = self.inner[raw]
        sym[-1] = self.last[raw[-1]]
        n = len(sym)
        after, before, ranks = np.arange(1, n + 1), np.arange(-1, n - 1), np.full(n, NONE)
        waiting: dict = {}
        heap: list = []

        def look(at: np.ndarray) -> None:
            """Note the pairs that now start at these places."""
            at = at[after[at] < n]
            key = sym[at] << 32 | sym[after[at]]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ranks[at] = np.where(self.keys[found] == key, self.ranks[found], NONE)
            for p, r in zip(at.tolist(), ranks[at].tolist()):
                if r != NONE:
                    if r not in waiting:
                        waiting[r] = []
                        heapq.heappush(heap, r)
                    waiting[r].append(p)

        look(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(waiting.pop(r))
            at = at[ranks[at] == r]
            if not len(at):
                continue
            start = np.maximum.accumulate(np.where(np.r_[True, after[at[:-1]] != at[1:]], np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]  # of pairs that overlap, from the left
            gone = after[at]
            sym[at] = self.made_by_rank[r]
            after[at] = after[gone]
            ranks[gone], ranks[at], before[gone] = NONE, NONE, -2
            inside = after[at] < n
            before[after[at][inside]] = at[inside]
            left = before[at]
            look(np.unique(np.r_[left[left >= 0], at]))
        return tuple(sym[before > -2].tolist())

    def words(self, text: str) -> list[str]:
        """The pieces that merges don't cross; special tokens are pieces of their own."""
        if not self._has_special(text):
            return self.pattern.findall(self._plain(text))
        out = []
        for part in self.split.split(text):
            out += [part] if part in self.special else self.pattern.findall(self._plain(part))
        return out

    def _has_special(self, text: str) -> bool:
        return self.split is not None and self.split.search(text) is not None

    def _plain(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case by character: no final sigma
        return text.lower()

    def _chunks(self, text: str | None) -> list:
        """What is looked up in one step: runs without white space, or a tuple of pieces where that would not do."""
        if not text:
            return []
        if self._has_special(text) or OTHER_SPACE.search(text):  # Python's white space is more than the pattern's
            return [tuple(self.words(text))]
        return self._plain(text).split()

    def _learn(self, chunks: list) -> None:
        """Remember the ids of chunks that aren't known yet."""
        pieces = [c if isinstance(c, tuple) else (c,) if c.isalpha() else self.pattern.findall(c) for c in chunks]
        of = {p: n for n, p in enumerate(dict.fromkeys(chain.from_iterable(pieces)))}
        alone = {p: (self.special[p],) if p in self.special else self.merge_long(p) for p in of if len(p) > LONG or p in self.special}
        words, size, found = [p for p in of if p not in alone], np.zeros(len(of), np.int64), []
        place = np.fromiter((of[w] for w in words), np.int64, len(words))
        for i, j in slices(words, 2_000_000):
            ids, size[place[i:j]] = self.merge(words[i:j])
            found.append(ids)
        for p, ids in alone.items():
            size[of[p]] = len(ids)
            found.append(np.array(ids, np.int64))
        begin = np.empty(len(of), np.int64)
        order = np.r_[place, np.fromiter((of[p] for p in alone), np.int64, len(alone))]
        begin[order] = np.cumsum(size[order]) - size[order]
        which = np.fromiter(map(of.__getitem__, chain.from_iterable(pieces)), np.int64, sum(map(len, pieces)))
        flat = gathered(np.concatenate(found) if found else np.zeros(0, np.int64), begin[which], size[which])
        upto = np.r_[0, np.cumsum(size[which])][np.cumsum([0, *map(len, pieces)])]
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.size = np.r_[self.size, np.diff(upto)]
        self.flat = np.r_[self.flat, flat.astype(np.int32)]
        self.begin = np.cumsum(self.size) - self.size

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's begin and end."""
        split = [self._chunks(t) for t in texts]
        every = list(chain.from_iterable(split))
        if len(self.known) > KNOWN or len(self.flat) > 10 * KNOWN:
            self._forget()
        if new := list(set(every) - self.known.keys()):
            self._learn(new)
        which = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        size = self.size[which]
        return gathered(self.flat, self.begin[which], size), np.r_[0, np.cumsum(size)][np.cumsum([0, *map(len, split)])]

    def _forget(self) -> None:
        self.known, self.size, self.begin, self.flat = {}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        ids, offsets = self.encode_flat(texts)
        return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: the tokens with spaces between; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)

    def decode_flat(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The same for many lists of ids, all of them known."""
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), self.named.take(pa.array(ids))), " ")


def encode_decode(documents: DataFrame, spec: str) -> DataFrame:
    """doc_id, ids (array of int), decoded; spec is the text of the vocabulary file, which goes out with the task."""
    shared = documents.sparkSession.sparkContext.broadcast(spec)  # one file of a few MB

    def run(batches):
        bpe = WordBpe(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in slices(texts, 500_000):
                ids, offsets = bpe.encode_flat(texts[i:j])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([batch.column(0).slice(i, j - i), lists, bpe.decode_flat(ids, offsets)], names=["doc_id", "ids", "decoded"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(documents.dtypes)['doc_id']}, ids array<int>, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
