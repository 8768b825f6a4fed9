import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from headway.llm.bpe import WordBpe, digest, encode_decode  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SPEC = open(PATH, encoding="utf-8").read()
TEXTS = [
    "", " \n\t", "Hello,  World's 123 <|endoftext|> naïve ÉÀ́ <|startoftext|>x", "it's I'LL 12ab ΣΑΣ 日本語 \x00 á İ", "aaaa aaaaa aaaaaaaaab baaaaaaa caaaaac",
    "<|endoftext|><|endoftext|", "é́ ẞﬁ \U0001f600\U0001f601 ��", "x" * 3000, "the " * 500, "...!!!??? <b>&amp;</b>", "it''s 'tis 'S  \x1c\x85y",
]


def test_like_the_library():
    theirs, ours = Tokenizer.from_file(PATH), WordBpe(SPEC)
    random.seed(5)
    texts = TEXTS + ["".join(random.choice("abcdeé ñ'tsTH123ß.,\n日") for _ in range(random.randrange(300))) for _ in range(500)]
    for text, ids in zip(texts, ours.encode(texts)):
        assert ids == theirs.encode(text, add_special_tokens=False).ids, text
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_long_words_like_the_library():
    import time

    theirs, ours = Tokenizer.from_file(PATH), WordBpe(SPEC)
    rng = random.Random(6)
    words = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "etaoinshrdlu", "abcdefghijklmnopqrstuvwxyzé", ".!?", "a") for n in (257, 1000, 20_000)]
    began = time.perf_counter()
    found = ours.encode([*words, " ".join(words[:6])])
    assert time.perf_counter() - began < 20  # 5.2 s for 80,000 letters before
    for word, ids in zip(words, found):
        assert ids == theirs.encode(word, add_special_tokens=False).ids == list(ours.merge_long(word))
    for word in ("a", "ab", "hello", "aaaa", "aaaaa"):
        assert list(ours.merge_long(word)) == theirs.encode(word, add_special_tokens=False).ids


def test_query_columns(spark, documents):
    rows = [(i, t) for i, t in enumerate([None, *TEXTS])] + [(3, TEXTS[2])]
    theirs = Tokenizer.from_file(PATH)
    expected = []
    for i, t in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(theirs.decode(ids, skip_special_tokens=False))))
    found = [tuple(r) for r in digest(encode_decode(documents(rows), SPEC)).collect()]
    assert sorted(found) == sorted(expected)
    assert digest(encode_decode(documents([]), SPEC)).count() == 0
