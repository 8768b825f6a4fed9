import hashlib
import random
from collections import Counter

import regex
import xxhash

from headway.llm import imatch


def rows_of(rng):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 120)))) for i in range(200)]
    return rows + [(500, None), (501, ""), (502, "é😀x"), (-7, "Only"), (900, rows[3][1]), (901, rows[3][1]), (902, "Z z " * 20000), (10**12, "far away")]


def test_edits_and_likeness(documents):
    rows = rows_of(random.Random(2))
    found = {r.doc_id: r for r in imatch.fingerprint_edits(documents(rows).withColumnRenamed("source", "bucket")).collect()}
    assert len(found) == len(rows)
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    for (i, t), (j, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half, r = len(t) // 2, found[i]
        edited = t[: len(t) - half] + after[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), i
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == t:
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
        if after == t:
            assert r.near_next == 1
    assert found[3].fingerprint == found[900].fingerprint == found[901].fingerprint
    assert found[500].fingerprint == found[501].fingerprint and found[502].fingerprint != found[-7].fingerprint
    mean = lambda f: sum(map(f, found.values())) / len(found)
    assert mean(lambda r: r.near_edited) > 2 * mean(lambda r: r.near_next)


def test_small_tables_and_repeated_rows(documents):
    assert imatch.fingerprint_edits(documents([])).count() == 0
    (one,) = imatch.fingerprint_edits(documents([(5, "abcd")])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1
    twice = imatch.fingerprint_edits(documents([(5, "abcd"), (5, "abcd"), (None, "xyz")])).collect()
    assert Counter(r.doc_id for r in twice) == Counter({5: 2, None: 1})


def test_lexicon_is_bounded_and_in_the_band(spark, documents):
    rows = [(i, f"common a{i % 5} b{i % 25} c{i % 25} unique{i}") for i in range(500)]
    (slots,) = imatch.lexicon(documents(rows)).first()
    kept = {t for s in slots for t in s}
    hashes = {w: spark.sql(f"select xxhash64('{w}')").first()[0] for w in ("common", "a0", "unique7")}
    assert len(slots) == imatch.SLOTS and kept == {spark.sql(f"select xxhash64('{w}{i}')").first()[0] for i in range(25) for w in "bc"}
    assert not kept & set(hashes.values())


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_lexicon(texts):
    each = [set(regex.findall(r"[\p{L}\p{N}]+", t.lower())) for t in texts]
    count = Counter(w for s in each for w in s)
    least, most = max(2, sum(map(len, each)) / imatch.LEXICON), max(2, imatch.COMMON * len(texts))
    return {w for w, n in count.items() if least <= n <= most}


def brute_parts(text, lexicon):
    """(first scale, {(scale or 0, cell): hash}) of a text, subset by subset."""
    words = set(regex.findall(r"[\p{L}\p{N}]+", text.lower()))
    known = sorted(signed(xxhash.xxh64_intdigest(w, 42)) for w in words & lexicon or words)

    def digest(terms):
        h = 42
        for t in terms:
            h = xxhash.xxh64_intdigest(t.to_bytes(8, "little", signed=True), h)
        return h >> 64 - imatch.HASH_BITS

    out, at = {(0, 0): digest(known)} if known else {}, 0
    first = sum(len(known) > imatch.DENSE * 2**bits for bits in imatch.SCALES)
    for s, bits in enumerate(imatch.SCALES):
        for cell in range(min(imatch.CELLS, 2**bits)) if s >= first else []:
            mine = [t for t in known if (t % 2**64 >> at) % 2**bits == cell]
            if mine:
                out[s + 1, cell] = digest(mine)
        at += bits
    return first, out


def brute_likeness(a, b):
    first = max(a[0], b[0])
    mine = [{k: v for k, v in x[1].items() if k[0] == 0 or k[0] > first} for x in (a, b)]
    said = mine[0].keys() | mine[1].keys()
    return sum(mine[0].get(k) == mine[1].get(k) for k in said) / len(said) if said else 1.0


def test_fingerprints_against_brute_force(documents):
    rows = rows_of(random.Random(8))
    found = {r.doc_id: r for r in imatch.fingerprint_edits(documents(rows)).collect()}
    lexicon = brute_lexicon([t or "" for _, t in rows])
    ordered = sorted(((i, t or "") for i, t in rows), reverse=True)
    show = lambda f: f"{f[0]}:" + ".".join(sorted(f"{(s << 14 | cell) << imatch.HASH_BITS | h:x}" for (s, cell), h in f[1].items()))
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half, r = len(t) // 2, found[i]
        mine, edited, other = (brute_parts(x, lexicon) for x in (t, t[: len(t) - half] + after[:half], after))
        plain = lambda f: f.split(":")[0] + ":" + ".".join(sorted(filter(None, f.split(":")[1].split("."))))
        assert plain(r.fingerprint) == show(mine) and plain(r.edited_fingerprint) == show(edited)
        assert abs(r.near_edited - brute_likeness(mine, edited)) < 1e-12 and abs(r.near_next - brute_likeness(mine, other)) < 1e-12


def test_skewed_ids_are_dealt_evenly(spark):
    """An id far out, an id that a third of the rows repeat, and rows without one."""
    rows = [(i, f"t{i}") for i in range(3000)] + [(2**60, "far")] + [(77, f"r{i}") for i in range(2000)] + [(None, f"n{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) as tie")
    found = imatch.with_next(df, ["text"])
    sizes = found.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    assert max(r[1] for r in sizes) < 0.6 * len(rows) and len(sizes) == 4
    seen = {(r.doc_id, r.text): r.next_text for r in found.collect()}
    tie = {(r.doc_id, r.text): r.tie for r in df.collect()}
    ordered = sorted(tie, key=lambda k: (k[0] is not None, k[0] or 0, tie[k]), reverse=True)
    assert len(seen) == len(rows) and all(seen[a] == b[1] for a, b in zip(ordered, ordered[1:] + ordered[:1]))
