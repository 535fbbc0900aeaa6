import base64
import hashlib
import time
from functools import lru_cache

import messy
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gridledger.llm import bpe

PATH, PATTERN = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
SHA = lambda b: hashlib.sha256(b).hexdigest()


@lru_cache
def tokenizer():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def oracle():
    return tokenizer()


HARD = [
    "", " ", "  ", "a  b", " a b ", "it's we'll 'tis don' t", "a\n b\n\n c \n", "x\x1c y\x1f\x1f z", "tab\t\tend \t",
    "ab cd　 ef g", "1234567 89 ¼ Ⅷ", "日本語テキスト", "é 🙂👩‍👩‍👧 ​", "<|endoftext|> a", "a" * 3000, "ab" * 2000,
    "abcabcab" * 500, "=" * 5000, "\n" * 2000, "The theThe" * 300, "\x00\x01 \x7f",
]


def test_hard_texts(oracle):
    codec = bpe.codec(PATH, PATTERN)
    for text in HARD:
        ids = codec.encode(text)
        assert ids == oracle.encode_ordinary(text), text[:40]
        assert codec.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'stlved.,1aAbBéß"), st.characters(codec="utf-8"))))
def test_any_text(text):
    codec = bpe.codec(PATH, PATTERN)
    ids = codec.encode(text)
    assert ids == tokenizer().encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_long_pre_token_takes_time_in_proportion():
    codec = bpe.codec(PATH, PATTERN)
    took = []
    for n in (20_000, 160_000):
        start = time.process_time()
        codec.merge([b"qzxkvjw" * (n // 7)])
        took.append(time.process_time() - start)
    assert took[1] < 8 * 4 * max(took[0], 0.01)


def test_pre_tokens_that_share_a_queue(oracle):
    codec = bpe.Codec(PATH, PATTERN)
    tokens = [t.encode() for text in HARD for t in codec.pattern.findall(text)]
    tokens = [t for t in tokens if t not in codec.ranks] * 3
    assert codec.merge(tokens) == [oracle.encode_ordinary(t.decode()) for t in tokens]
    assert codec.merge([]) == []


def test_forgetting(monkeypatch, oracle):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    codec = bpe.Codec(PATH, PATTERN)
    text = " ".join(f"w{i % 9}" for i in range(200))
    assert codec.encode(text) == oracle.encode_ordinary(text)
    assert codec.encode("w1 w2") == oracle.encode_ordinary("w1 w2") and len(codec.fresh) <= 4


def test_patterns_that_span_spaces(oracle):
    pattern = r"\w+ \w+|\s?\w+|\s|[^\s\w]+"
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(PATH, pattern)
    for text in ("of the people by the people", "one two  three, four\n five"):
        assert codec.encode(text) == other.encode_ordinary(text)


def test_merges_clear_the_bitmaps():
    codec = bpe.Codec(PATH, PATTERN)
    for text in HARD:
        codec.merge([text.encode() or b"x"])
    assert not any(codec.words)


def test_digests_and_round_trip(spark, oracle):
    docs = messy.documents(spark)
    want = sorted(
        (str(r.doc_id), len(ids := oracle.encode_ordinary(r.text or "")), SHA(" ".join(map(str, ids)).encode()), SHA((r.text or "").encode()))
        for r in docs.collect())
    got = bpe.digests(docs, PATH, PATTERN).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    got = bpe.digests(docs, PATH, PATTERN, lasting=False).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    ids = bpe.encode(docs.withColumnRenamed("words", "ids"), PATH, PATTERN)
    assert ids.columns[-1] == "ids" and ids.count() == docs.count()
    back = bpe.decode(ids, PATH, PATTERN)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())


def test_empty(spark):
    assert bpe.digests(messy.empty(spark), PATH, PATTERN).collect() == []
    assert bpe.encode(messy.empty(spark), PATH, PATTERN).collect() == []
