import random
import zlib
from collections import Counter, defaultdict

from headway.llm import shard


def check(rows, found, shards):
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in found) == Counter((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in rows)
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def assert_balanced(rows, found, shards, tolerance=0.01):
    """Every edge between shards is as near to its wanted place as groups and the tolerance let any edge be."""
    total, where, size = sum(r.size for r in found), defaultdict(set), Counter()
    for r in found:
        where[r.text_crc32].add(r.shard)
        size[r.text_crc32] += r.size
    for text, shard in where.items():
        assert len(shard) == 1 or size[text] > total / shards  # only groups larger than a shard are cut
    rank = {(r.text_crc32, r.doc_id): (r.shard, r.slot) for r in found}
    ordered = sorted(found, key=lambda r: (r.shard, r.slot))
    assert len(rank) == len({(r.text_crc32, r.doc_id) for r in found})
    whole = [r.text_crc32 for r in ordered]
    assert sum(a != b for a, b in zip(whole, whole[1:])) == len(where) - 1  # equal texts lie together
    edges, before = [0], 0  # places where an edge may be
    for a, b in zip(ordered, ordered[1:] + [None]):
        before += a.size
        if b is None or a.text_crc32 != b.text_crc32 or size[a.text_crc32] > total / shards:
            edges.append(before)
    held = Counter()
    for r in found:
        held[r.shard] += r.size
    upto = 0
    for s in range(shards - 1):
        upto += held[s]
        want = total * (s + 1) / shards
        assert abs(upto - want) <= max(tolerance * total / shards, min(abs(e - want) for e in edges)) + 1e-6, (s, upto, want)


def test_balance_against_all_edges(spark, documents):
    """Small groups around every edge, a group of half a shard, one of three shards, and one id many times over."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        rows += [(4 * i + k, f"{i} " * rng.randrange(1, 60)) for k in range(rng.choice([1, 1, 2, 3]))]
    total = sum(len(t) + 16 for _, t in rows)
    rows += [(10_000 + i, "half") for i in range(total // 20 // 40)] + [(20_000 + i, "three shards") for i in range(total // 70)]
    for partitions in ("4", "60"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found = shard.shard_documents(documents(rows), 20).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        check(rows, found, 20)
        assert_balanced(rows, found, 20)


def test_sizes_slots_and_groups(documents):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randrange(200) if i % 50 else None) for i in range(3000)] + [(5000 + i, "a copy of many " * 5) for i in range(1500)] + [(9, ""), (9, "")]
    found = shard.shard_documents(documents(rows), 10).collect()
    sizes = check(rows, found, 10)
    assert_balanced(rows, found, 10)
    again = shard.shard_documents(documents(rows[::-1]), 10).collect()
    key = lambda r: (r.doc_id, r.text_crc32, r.shard)
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_few_rows_long_rows_and_no_rows(documents):
    rows = [(1, "x" * 100000), (2, None), (None, "y"), (3, "z")]
    found = shard.shard_documents(documents(rows), 40, carry=("text",)).collect()
    check(rows, found, 40)
    assert {r.doc_id: r.text for r in found}[3] == "z"
    assert shard.shard_documents(documents([]), 40).count() == 0
    same = [(4, "same")] * 50
    check(same, shard.shard_documents(documents(same), 5).collect(), 5)
