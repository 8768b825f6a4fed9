import random

from headway.llm import decontam, substring

import corpus_pipeline
from test_simhash import brute_kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = [a + b + c for a in "bdfgk" for b in "aeiou" for c in ("lo", "mi", "nu", "ra", "st")]


def words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def tables(spark, folder):
    rng = random.Random(11)
    docs = {i: words(rng, rng.randrange(40, 120)) for i in range(300)}
    for i in range(0, 300, 5):
        for _ in range(5):
            docs[i].insert(rng.randrange(len(docs[i])), rng.choice(["idiot", "scum", "moron"]))
    passage, item = words(rng, 60), words(rng, 30)
    docs |= {400: words(rng, 30) + passage + words(rng, 30), 401: words(rng, 40) + passage, 402: words(rng, 50) + item, 403: docs[1], 404: docs[1], 405: docs[2][:-1] + ["new"]}
    rows = [(i, " ".join(w), "en", "s", len(" ".join(w))) for i, w in docs.items()] + [(500, None, None, None, None), (501, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, " ".join(item)), (1, " ".join(words(rng, 20)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {i: t for i, t, *_ in rows}, passage


def test_stages(spark, tmp_path):
    texts, passage = tables(spark, str(tmp_path))
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{len(seen)}")
        docs = spark.read.parquet(f"{tmp_path}/{len(seen)}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert len(seen) == 5 or docs.columns == COLUMNS
    clean, first, cut, rest, last = seen.values()
    assert set(clean) == {i for i in texts if i >= 300 or i % 5}
    assert all(r.text == texts[i] for i, r in clean.items())
    assert set(first) == brute_kept([(i, texts[i]) for i in clean]) and {403, 404, 405, 501} & set(first) == set() and {1, 2, 500} <= set(first)
    kept = {r.doc_id: r for r in substring.remove_repeats(spark.createDataFrame([(i, texts[i]) for i in first], "doc_id long, text string")).collect()}
    assert set(cut) == {i for i, r in kept.items() if r.n_removed < r.n_words or not r.n_removed}
    for i, r in cut.items():
        assert r.text == (kept[i].kept if kept[i].n_removed else texts[i]) and r.n_chars == (len(r.text) if kept[i].n_removed else first[i].n_chars)
    assert " ".join(passage) not in cut[400].text and cut[401].n_chars < len(texts[401])
    assert set(cut) - set(rest) == {402} and all(rest[i].text == cut[i].text for i in rest)
    assert set(last) == set(rest) and all(len(r.ids) == r.n_tokens for r in last.values())
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).orderBy("doc_id").collect()] == sorted(last)


def test_stages_on_no_rows_and_odd_rows(spark, tmp_path):
    tables(spark, str(tmp_path))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, "a b c", None, None, None), (1, "a b c", None, None, None), (None, None, None, None, None), (None, "x y z w", "en", "s", 7)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs.write.mode("overwrite").parquet(f"{tmp_path}/odd{len(rows)}{len(docs.columns)}{stage.__name__}")
            docs = spark.read.parquet(f"{tmp_path}/odd{len(rows)}{len(docs.columns)}{stage.__name__}")
        assert docs.count() == (3 if rows else 0)


def test_decontamination_keeps_what_overlaps_leave(spark):
    rng = random.Random(1)
    item = words(rng, 40)
    rows = [(1, " ".join(item[:19])), (2, " ".join(item[:20])), (3, None), (4, " ".join(item[25:] + item[:25]))]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, tiles int")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.keep_clean(docs, bench).collect()) == [1, 3]


def test_stages_carry_columns_of_any_name(spark, tmp_path):
    tables(spark, str(tmp_path))
    names = ["h1", "h2", "row", "kept", "n_removed", "copies", "nth", "component_id", "fp", "score", "toxic", "tiles", "absent"]
    docs = spark.createDataFrame([(i, t, 3, *range(13)) for i, t in enumerate(["one two three", "four five six seven", "x " * 50])], f"doc_id int, text string, n_chars long, {', '.join(f'{n} int' for n in names)}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "n_chars", *names], name
    rows = sorted(docs.collect())
    assert [r.doc_id for r in rows] == [0, 1] and all(tuple(r)[3:] == tuple(range(13)) and r.n_chars == 3 for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 2
