import random

import numpy as np

from headway.llm import decontam


def brute_tiles(item, text, m):
    """Greedy string tiling by the definition."""
    used_i, used_t, out = set(), set(), []
    while True:
        best = (m - 1, 0, 0)
        for x in range(len(item)):
            for y in range(len(text)):
                n = 0
                while x + n < len(item) and y + n < len(text) and item[x + n] == text[y + n] > 0 and x + n not in used_i and y + n not in used_t:
                    n += 1
                if n > best[0]:
                    best = (n, x, y)
        n, x, y = best
        if n < m:
            return out
        out.append((x, y, n))
        used_i.update(range(x, x + n))
        used_t.update(range(y, y + n))


def test_tiles_against_the_definition():
    rng = random.Random(4)
    for _ in range(300):
        size = rng.choice([2, 3, 6])
        item = np.array([rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 25))])
        text = np.array([rng.randrange(0, size + 1) for _ in range(rng.randrange(1, 40))])
        m = rng.choice([2, 3])
        assert decontam.tiles(item, text, m) == decontam._tiles_by_length(item, text, m) == brute_tiles(item.tolist(), text.tolist(), m)


def test_repetitive_texts_take_linear_memory():
    import tracemalloc

    ones = lambda n: np.ones(n, np.int64)
    tracemalloc.start()
    assert decontam.tiles(ones(1500), ones(20000)) == [(0, 0, 1500)]
    period = np.tile(np.arange(1, 8), 300)
    broken = np.insert(np.tile(np.arange(1, 8), 3000), np.arange(50, 21000, 61), 0)
    found = decontam.tiles(period, broken)
    assert all((period[x : x + n] == broken[y : y + n]).all() for x, y, n in found) and sum(n for *_, n in found) > 2000
    assert tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()


def brute_coverage(item, text):
    """The share of an item's words under tiles of 5 words."""
    split = lambda t: decontam.WORD.findall((t or "").lower())
    known: dict = {}
    a, b = ([known.setdefault(w, len(known) + 1) for w in split(t)] for t in (item, text))
    return sum(n for *_, n in brute_tiles(a, b, 5)) / len(a)


def test_coverage_and_keep_clean_against_brute_force(spark, documents):
    rng = random.Random(9)
    items = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(6, 16))) for _ in range(6)]
    rows = []
    for i in range(40):
        cut = [t.split()[rng.randrange(4) :][: rng.randrange(3, 14)] for t in rng.sample(items, 2)]
        rows.append((i, " ".join(sum(cut, [rng.choice("xyz")]) + [rng.choice("abcxyz") for _ in range(8)])))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(i, k): c for i, t in rows for k, item in enumerate(items) if (c := brute_coverage(item, t)) > 0}
    assert {(r.doc_id, r.item_id): r.coverage for r in decontam.overlaps(documents(rows), bench).collect()} == want
    joined = decontam.overlaps(documents(rows), bench, block_chars=1)
    assert {(r.doc_id, r.item_id): r.coverage for r in joined.collect()} == want
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, decontam.overlaps(documents(rows), bench).collect()))
    dirty = {i for (i, _), c in want.items() if c >= 0.5}
    twice = documents(rows + rows[:9] + [(99, None)])
    assert sorted(r.doc_id for r in decontam.keep_clean(twice, bench, block_chars=1).collect()) == sorted(r.doc_id for r in decontam.keep_clean(twice, bench).collect())
    assert {r.doc_id for r in decontam.keep_clean(documents(rows), bench).collect()} == set(range(40)) - dirty and 0 < len(dirty) < 40


def test_documents(spark, documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passages = [[word() for _ in range(n)] for n in (12, 40, 25)]
    items = [(i, " ".join(p)) for i, p in enumerate(passages)] + [(7, None), (8, "too short"), (9, " ".join(passages[1]))]
    fill = lambda n: " ".join(word() for _ in range(n))
    moved = passages[1][20:] + passages[1][:20]
    rows = [
        (1, fill(50)), (2, f"{fill(20)} {' '.join(passages[0])} {fill(20000)}"), (3, f"{fill(9)}\n{' '.join(moved).upper()}!"), (4, None), (5, ""),
        (6, " ".join(passages[2][:9])), (3, " ".join(moved)), (10, ", ".join(passages[2][:15]) + " " + fill(3) + " " + " ".join(passages[2][16:])),
    ]
    bench = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, tiles int, coverage int")
    found = sorted((r.doc_id, r.item_id, r.matched, r.item_words) for r in decontam.contaminated(documents(rows), bench).collect())
    assert found == [(2, 0, 12, 12), (3, 1, 40, 40), (3, 1, 40, 40), (3, 9, 40, 40), (3, 9, 40, 40), (10, 2, 24, 25)]
    weak = [r for r in decontam.overlaps(documents(rows), bench).collect() if r.doc_id == 6]
    assert [(r.item_id, r.matched, r.tiles[0].asDict()) for r in weak] == [(2, 9, {"item_word": 0, "doc_word": 0, "words": 9})]
    blocks = decontam.overlaps(documents(rows), bench, block_chars=100).filter("coverage >= 0.5")
    assert sorted((r.doc_id, r.item_id, r.matched, r.item_words) for r in blocks.collect()) == found
    tiny = spark.createDataFrame([(1, "Quite so"), (2, "so"), (3, "so"), (4, "..."), (5, "not here")], "item_id long, text string")
    texts = documents([(1, "It is quite, so; quite so."), (2, "so quite"), (3, "quiteso"), (4, "quite so")])
    assert sorted((r.doc_id, r.item_id, r.coverage, r.tiles[0].doc_word) for r in decontam.contaminated(texts, tiny).collect()) == [
        (1, 1, 1.0, 2), (1, 2, 1.0, 3), (1, 3, 1.0, 3), (2, 2, 1.0, 0), (2, 3, 1.0, 0), (4, 1, 1.0, 0), (4, 2, 1.0, 1), (4, 3, 1.0, 1)]
    assert [r.doc_id for r in decontam.keep_clean(texts, tiny).collect()] == [3]
    assert sorted(map(repr, decontam.overlaps(texts, tiny, block_chars=1).collect())) == sorted(map(repr, decontam.overlaps(texts, tiny).collect()))
    assert decontam.overlaps(documents([]), bench).count() == 0
    assert decontam.overlaps(documents(rows), bench.limit(0)).count() == 0
