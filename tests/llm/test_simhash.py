import random

import numpy as np
import xxhash

from headway.llm import simhash
from headway.llm.components import connected_components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(pairs):
    """(id, fingerprint) -> {id: least id reached}"""
    group = {i: i for i, _ in pairs}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, f in pairs:
        for j, g in pairs:
            if (f ^ g).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i: root(i) for i in group}


def test_texts(documents):
    random.seed(3)
    words = ["Alpha", "beta", "ÄGamma", "delta", "eps", "zeta\x0b", "eta", "\x1ctheta"]
    rows = [(100, None), (7, ""), (8, " \n "), (9, "one"), (12, "one two"), (13, "ONE TWO"), (14, "One  two\tthree"), (5, "one two three")]
    for i in range(60):
        text = " ".join(random.choice(words) for _ in range(random.randrange(1, 60)))
        rows += [(200 + 3 * i, text), (201 + 3 * i, text + " beta"), (202 + 3 * i, text.upper() if i % 2 else text)]
    found = {r.doc_id: (int(r.fingerprint, 16), r.component_id, r.fingerprint) for r in simhash.near_duplicates(documents(rows), chunk=8).collect()}
    assert {i: f for i, (f, _, _) in found.items()} == {i: brute_fingerprint(t) for i, t in rows}
    assert {i: c for i, (_, c, _) in found.items()} == brute_groups([(i, f) for i, (f, _, _) in found.items()])
    assert all(len(h) == 16 and h == h.lower() for _, _, h in found.values())
    assert simhash.near_duplicates(documents([])).count() == 0
    again = simhash.near_duplicates(documents([(4, "a b c d"), (4, "a b c d"), (2, "a b c d")])).collect()
    assert [r.component_id for r in again] == [2, 2, 2]


def test_links_across_tiles_and_chunks(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set(base.tolist()) | {0, 2**64 - 1, 1, 2**64 - 2}
    for x in base.tolist():
        for _ in range(10):
            for _ in range(rng.integers(0, 3)):
                x ^= 1 << int(rng.integers(0, 64))
            prints.add(x)
    pairs = list(enumerate(sorted(prints)))
    signed = {f - 2**64 if f >= 2**63 else f: i for i, f in pairs}
    links = simhash.link(spark.createDataFrame([(f,) for f in signed], "fp long"), chunk=16)
    found = {r.node: r.component for r in connected_components(links).collect()}
    least: dict = {}
    for f, i in signed.items():
        part = found.get(f, f)
        least[part] = min(i, least.get(part, i))
    assert {i: least[found.get(f, f)] for f, i in signed.items()} == brute_groups(pairs)


def test_rows_without_an_id_link(spark, documents, monkeypatch):
    """Fingerprints 0, 3 (of a null id only) and 15 are one component; an id's rows may have different texts."""
    prints = spark.createDataFrame([(1, 0), (None, 3), (2, 15), (None, 0xFFF << 40), (9, 255)], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda documents, k: prints)
    found = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(prints).collect()), key=str)
    assert found == sorted([(1, 0, 1), (None, 3, 1), (2, 15, 1), (None, 0xFFF << 40, None), (9, 255, 9)], key=str)


def test_hot_keys_are_joined_whole(spark, monkeypatch):
    from headway.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 5)
    left = spark.createDataFrame([(i % 7 if i > 40 else 0, i) for i in range(100)], "k int, v int")
    right = spark.createDataFrame([(0, "a", 50), (1, "b", 5), (2, "c", 9)], "k int, w string, n long")
    found = sorted(tuple(r) for r in common.hot_join(left, right, "k").collect())
    assert found == sorted((k, i, "abc"[k]) for i in range(100) if (k := i % 7 if i > 40 else 0) < 3)


def brute_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(rows):
    """The least id of each group of texts whose 5-word shingles have a Jaccard similarity of 0.8 or more."""
    sets, group = {i: brute_set(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return {root(i) for i in group}


def near_copies(rng):
    word = lambda: f"w{rng.randrange(5000)}"
    rows = [(1, None), (2, ""), (3, "a b c"), (4, "A  b c"), (5, "a b d")]
    for i in range(60):
        base = [word() for _ in range(rng.randrange(60, 200))]
        rows.append((100 * i + 100, " ".join(base)))
        for j in range(4):  # about 0.65 to 1
            new = list(base)
            for _ in range(rng.randrange(0, 6)):
                new[rng.randrange(len(new))] = word()
            rows.append((100 * i + 101 + j, " ".join(new)))
    return rows


def test_stage_finds_pairs_of_similarity(spark, documents):
    import corpus_pipeline

    rows = near_copies(random.Random(5))
    found = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, documents(rows), "").collect()]
    assert sorted(found) == sorted(brute_kept(rows))


def test_proposed_pairs_have_the_recall_that_is_claimed():
    """Of random sets of similarity 0.8 to 0.82; and the places are those of all pairs, whatever the blocks."""
    rng = np.random.default_rng(4)
    caught = n = 0
    for _ in range(3000):
        a = rng.integers(0, 2**64, 90, dtype=np.uint64)
        b = np.r_[a[:80], rng.integers(0, 2**64, 10, dtype=np.uint64)]
        x, y = ([simhash.majority(s), simhash.majority(simhash.mixed(s))] for s in (a, b))
        near, other = (int(p ^ q).bit_count() for p, q in zip(x, y))
        caught += near <= simhash.WIDE and near + other <= simhash.BOTH
        n += 1
    assert caught / n > 0.995
    cells = lambda n: {"fp": rng.integers(0, 1 << 12, n), "other": rng.integers(0, 1 << 40, n), "size": rng.integers(50, 70, n)}
    a, b = cells(100), cells(5000)
    apart = lambda i, j, c: int(a[c][i] ^ b[c][j]).bit_count()
    fits = lambda i, j: apart(i, j, "fp") <= 3 and apart(i, j, "fp") + apart(i, j, "other") <= 20 and min(a["size"][i], b["size"][j]) >= 0.8 * max(a["size"][i], b["size"][j])
    want = {(i, j) for i in range(100) for j in range(5000) if fits(i, j)}
    assert {(int(p), int(q)) for i, j in simhash.near_places(a, b, False, wide=3, both=20) for p, q in zip(i, j)} == want and len(want) > 1000


def test_large_groups_of_near_copies(spark, documents, monkeypatch):
    """Copies of one text with words changed here and there, more than blocks hold, in small chunks."""
    rng = random.Random(13)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        new = list(base)
        for _ in range(rng.randrange(0, 8)):
            new[rng.randrange(len(new))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(new)))
    monkeypatch.setattr(simhash, "BLOCK", 10)
    monkeypatch.setattr(simhash.blocks_of, "__defaults__", (10,))
    found = {r.doc_id for r in simhash.keep_first(documents(rows), chunk=40).collect()}
    assert found == brute_kept(rows) and 1 < len(found) < 100


def test_rows_that_share_an_id_with_different_texts_stay(documents):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (1, b), (1, b), (2, b), (3, a + " more"), (None, a), (None, "only this")]
    found = [(r.doc_id, r.text) for r in simhash.keep_first(documents(rows)).collect()]
    assert sorted(found, key=str) == sorted([(1, a), (1, b), (None, "only this")], key=str)


def test_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5), (7, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
