import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from headway.llm import substring


def brute(rows, window):
    split = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(rng, window):
    word = lambda: rng.choice("a b c dd E é x the of".split()) + str(rng.randrange(40))
    fresh = lambda n: [word() for _ in range(n)]
    passages = [fresh(n) for n in (window - 1, window, window + 1, 3 * window, 10 * window)]
    rows = [(1, None), (2, ""), (3, "one"), (4, "x " * (window - 1)), (5, "y " * window), (6, "z " * (window + 1)), (7, "ab cd " * window), (8, "w \t" * 4000)]
    for i in range(60):
        text = fresh(rng.randrange(0, 2 * window))
        for _ in range(rng.randrange(3)):
            text += rng.choice(passages)[rng.randrange(3) :] + fresh(rng.randrange(0, window))
        rows.append((100 + i, " \n"[i % 2].join(text)))
    rows += [(300 + i, rows[10][1]) for i in range(5)] + [(100, rows[8][1]), (100, rows[8][1]), (100, "another text of the same id")]
    near = fresh(4 * window)
    for i in range(30):
        copy = list(near)
        copy[rng.randrange(len(copy))] = f"new{i}"
        rows.append((400 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("window, gram, hot", [(35, 8, 200_000), (35, 8, 3), (6, 2, 200_000), (6, 2, 4), (100, 8, 200_000), (5, 8, 200_000)])
def test_against_brute_force(documents, window, gram, hot, monkeypatch):
    monkeypatch.setattr(substring, "LOT", 50)
    rows = corpus(random.Random(window + hot), window)
    found = substring.remove_repeats(documents(rows).withColumnRenamed("source", "h1"), window, gram, hot, digest=True)
    assert sorted(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == brute(rows, window)


def test_hot_grams_nodes_and_texts(documents, monkeypatch):
    """With a key hot from its third row on; most rows are one text, and a line stands in every other."""
    from headway.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    rng = random.Random(12)
    line = [f"l{i}" for i in range(12)]
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows = [(i, " ".join(fresh(9) + line + fresh(9))) for i in range(40)] + [(100 + i, " ".join(line + ["copy"] * 20)) for i in range(60)] + [(900 + i, None) for i in range(20)]
    for hot in (5, 200_000):
        found = substring.remove_repeats(documents(rows), 10, 4, hot, digest=True)
        assert sorted(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == brute(rows, 10)
    kept = {(r.doc_id, r.text) for r in substring.clean(documents(rows), 10, 4, 5).collect()}
    assert kept == {(i, " ".join(w for w in t.split() if w not in line)) for i, t in rows[:40]} | {(900 + i, None) for i in range(20)}


def test_texts_and_empty_table(documents):
    kept = substring.remove_repeats(documents([(1, "a b  c"), (2, "x " * 40)])).collect()
    assert sorted((r.doc_id, r.n_removed, r.kept) for r in kept) == [(1, 0, "a b c"), (2, 40, "")]
    assert substring.remove_repeats(documents([]), digest=True).count() == 0


def test_least_places():
    rng = np.random.default_rng(0)
    for width in (1, 2, 5, 28):
        v = rng.integers(0, 6, 200).astype(np.uint64)
        assert substring.least_places(v, width).tolist() == [i + int(np.argmin(v[i : i + width])) for i in range(200 - width + 1)]
