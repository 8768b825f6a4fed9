import random
import zlib

import numpy as np

from headway.llm import langid, toxicity

VOCABULARY = {"en": "the thing with that wheat this".split(), "de": "der sich nicht schön über zeit".split(), "fr": "le été queux dans pour être".split()}


def text(lang, n, rng):
    return " ".join(rng.choice(VOCABULARY[lang]) for _ in range(n))


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def language_rows(spark):
    rng = random.Random(1)
    rows = [(i, text(lang, rng.randrange(1, 150), rng), lang) for i in range(200) for lang in [rng.choice(list(VOCABULARY))]]
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 -- 7", None), (903, text("de", 5000, rng), None), (903, text("de", 5000, rng), None), (904, text("en", 30, rng), "en")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages(spark):
    rows, df = language_rows(spark)
    found = langid.identify(df.selectExpr("*", "1 as held_out", "2 as score", "'x' as source")).collect()
    assert len(found) == len(rows)
    want = {i: y or "de" for i, _, y in rows}
    for r in found:
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1
        assert r.lang_pred == ("und" if r.doc_id in (900, 901, 902) else want[r.doc_id])
    assert langid.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(df.filter("lang is null")).collect()} == {"und"}


def test_prediction_ignores_the_other_columns(spark):
    rows, df = language_rows(spark)
    learn = df.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    rest = df.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    a = langid.identify(learn.unionByName(rest))
    b = langid.identify(learn.unionByName(rest.selectExpr("doc_id", "text", "'fr' as lang")))
    key = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in df.collect())
    assert key(a) == key(b)


def test_words_of_mixed_text_are_labelled_in_runs(spark):
    rng = random.Random(2)
    model = langid.train([(text(y, 80, rng), y) for y in VOCABULARY for _ in range(40)])
    mixed = [text("en", 20, rng) + " " + text("de", 30, rng) + " " + text("fr", 10, rng)]
    (best, score, runs), = langid.label_texts(model, langid.WordTable(model.emissions), mixed)
    assert best == "de" and 0.3 < score < 0.8
    assert [r[2] for r in runs] == ["en", "de", "fr"] and all(abs(a - b) <= 1 for a, b in zip([r[1] for r in runs], [20, 30, 10]))


def test_forward_backward_against_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    switch, sizes = rng.normal(size=(3, 3)), [1, 4, 2]
    scores = rng.normal(size=(sum(sizes), 3))
    start = np.cumsum(sizes) - sizes
    post, pairs = langid.forward_backward(scores, start, np.array(sizes), switch)
    want_post, want_pairs = np.zeros_like(scores), np.zeros((3, 3))
    for s, n in zip(start, sizes):
        paths = list(itertools.product(range(3), repeat=n))
        w = np.array([np.exp(sum(scores[s + t, y] for t, y in enumerate(p)) + sum(switch[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        for p, u in zip(paths, w / w.sum()):
            for t, y in enumerate(p):
                want_post[s + t, y] += u
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += u
    assert np.allclose(post, want_post) and np.allclose(pairs, want_pairs)


def test_blocks_of_a_long_text_are_one_chain():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 0, 200, 7, 64, 33, 20, 8])
    scores, switch = 2 * rng.normal(size=(lengths.sum(), 4)), rng.normal(size=(4, 4))
    start = np.cumsum(lengths) - lengths
    whole, _ = langid.forward_backward(scores, start[lengths > 0], lengths[lengths > 0], switch)
    for chain in (1, 2, 7, 8, 64, 500):
        assert np.allclose(langid.posteriors(scores, lengths, switch, chain), whole)
    assert not np.allclose(langid.forward_backward(scores, np.arange(0, lengths.sum(), 8), np.minimum(8, lengths.sum() - np.arange(0, lengths.sum(), 8)), switch)[0], whole)


def test_every_character_of_a_word_counts():
    """Words that agree in their first 100 characters, a text without spaces, and letters only at the far end."""
    a, b = "x" * 100 + "der" * 500, "x" * 100 + "the" * 500
    (flat, sizes), (flat_a, _), (flat_b, _) = langid.packed_features([a, b, "1" * 60 + "a" + "1" * 60, "12"]), langid.packed_features([a]), langid.packed_features([b])
    assert flat_a.tolist() != flat_b.tolist() and flat.tolist()[: len(flat_a)] == flat_a.tolist()
    assert sizes[2] > 0 and sizes[3] == 0
    rng = random.Random(5)
    model = langid.train([(text(y, 80, rng), y) for y in VOCABULARY for _ in range(40)])
    unspaced = ["und" * 15 + "".join(rng.choice(VOCABULARY["de"]) for _ in range(400)), "und" * 15 + "".join(rng.choice(VOCABULARY["en"]) for _ in range(400))]
    assert [r[0] for r in langid.label_texts(model, langid.WordTable(model.emissions), unspaced)] == ["de", "en"]
    assert [toxicity.tokens_of(t) for t in (None, "a b", "c" * 90)] == [[], ["a", "b"], ["c" * 40, "c" * 40, "c" * 10]]


def test_rare_labels_are_learned(spark):
    words = {f"l{i}": " ".join(f"w{i}x{j}" for j in range(5)) for i in range(300)}
    rows = [(10 * i + j, words[y], y) for i, y in enumerate(words) for j in range(3)]
    from headway.llm import words as samples

    sample, counts = samples.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "lang", 5)
    learned = {y for i, _, y in rows if not held_out(i)}
    assert {r.lang for r in sample.collect()} == learned and set(counts) == learned and len(learned) > 256


def toxic_rows(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [rng.choice(VOCABULARY["en"] + VOCABULARY["de"]) for _ in range(rng.randrange(10, 80))]
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "Moron!", "you"]))
        words += ["idiot"] * bad
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs += [(2000, None), (2001, ""), (2002, "the 1d1ot and $cum and m0ron with you idiot"), (2003, "fine " * 30000)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (2001, 0, None), (2999, 0, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_rows(spark)
    found = {r.doc_id: r for r in toxicity.score(docs.selectExpr("*", "0 as toxic", "1 as held_out"), labels).collect()}
    assert len(found) == 604
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == held_out(i) for i, r in found.items())
    right = [found[i].predicted == (i % 4 == 0) for i in range(600) if held_out(i)]
    assert sum(right) / len(right) > 0.97
    assert found[2002].predicted == 1 and not found[2000].predicted and not found[2001].predicted and not found[2003].predicted
    assert {r.score for r in toxicity.score(docs, labels.filter("toxic = 1")).collect()} == {1.0}
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def plain_features(lexicon, text):
    """The features of one text, word by word."""
    tokens = toxicity.tokens_of(text)
    if not tokens:
        return [0.0] * toxicity.FEATURES
    cores = [toxicity.core_of(t) for t in tokens]
    weight = [max((lexicon.weights.get(k, 0.0) for k in toxicity.keys_of(c)), default=0.0) for c, _ in cores]
    hit, n = [w > 0 for w in weight], len(tokens)
    second = [c in toxicity.SECOND_PERSON for c, _ in cores]
    close = [any(second[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i in range(n)]
    capital = [len(c) > 1 and t.isupper() for t, (c, _) in zip(tokens, cores)]
    marks = sum(t.count("!") + t.count("?") for t in tokens)
    mixed = [m for _, m in cores]
    densest = max(sum(hit[i : i + toxicity.WINDOW]) for i in range(n))
    return [sum(hit) / n, np.log1p(sum(hit)), sum(weight) / n, max(weight), densest, sum(h and c for h, c in zip(hit, close)) / n, sum(second) / n, sum(capital) / n, marks / n,
            sum(mixed) / n, sum(m and h for m, h in zip(mixed, hit)) / n, np.log1p(n)]


def plain_score(model, text):
    x, raw = plain_features(model.lexicon, text), model.trees.base
    for split, at, leaf in zip(model.trees.split, model.trees.at, model.trees.leaf):
        node = 0
        while node < len(split):
            node = 2 * node + (2 if x[split[node]] > at[node] else 1)
        raw += leaf[node - len(split)]
    score, share = model.knots
    k = next((i for i, s in enumerate(score) if s >= raw), len(score))
    if k in (0, len(score)):
        calibrated = share[min(k, len(score) - 1)]
    else:
        calibrated = share[k - 1] + (share[k] - share[k - 1]) * (raw - score[k - 1]) / (score[k] - score[k - 1])
    return 0.999 * calibrated + 0.001 / (1 + np.exp(-raw))


def test_toxicity_against_brute_force(spark):
    docs, labels = toxic_rows(spark)
    labels = labels.unionByName(spark.createDataFrame([(7, 0, 2), (8, 0, -1)], "doc_id long, quality int, toxic int"))  # no labels
    model, texts = toxicity.learn(docs, labels), {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert found.keys() == texts.keys() and np.allclose([found[i] for i in texts], [plain_score(model, t) for t in texts.values()], atol=1e-5)


def test_held_out_labels_are_not_used(spark):
    docs, labels = toxic_rows(spark)
    flipped = labels.selectExpr("doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    key = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert key(toxicity.score(docs, labels)) == key(toxicity.score(docs, flipped))


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    s = rng.normal(size=400)
    y, w = (rng.random(400) < 1 / (1 + np.exp(-2 * s))).astype(float), rng.random(400)
    x, p = toxicity.isotonic(s, y, w)
    assert (np.diff(x) > 0).all() and (np.diff(p) > 0).all() and 0 <= p.min() and p.max() <= 1


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    table = toxicity.WordTable(toxicity.Lexicon({"=bad": 3.0}).rows)
    texts = ["you", "bad", "a bad you", "", "x " * 60 + "bad"]
    together = toxicity.features(table, texts)
    alone = np.concatenate([toxicity.features(table, [t]) for t in texts])
    assert np.allclose(together, alone)
