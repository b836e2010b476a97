import random

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from fettle.llm.tokencount import TextCounter, disagreements, token_counts, whole_tokens

NAME = path("byte_bpe_50k.json")
ODD = ["", "a<|endoftext|>b <|endoftext|> c", "<|endoftext|>", "  \n\n  x's  ÀÉ 12 ١٢ ",
       "\u0000​ x", "a" * 5_000, "   ", "\r\n\t ", "we'll WE'LL don't", "日本語 テスト",
       "x" * 100_000 + " y " * 50_000, "\U0001f600 ꟒՘"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(NAME)


def test_counts_are_the_librarys(library):
    with open(NAME, encoding="utf-8") as file:
        definition = file.read()
    count = TextCounter(definition, whole_tokens(definition), disagreements(definition))
    rng = random.Random(7)
    points = [p for p in range(0x40000) if not 0xD800 <= p < 0xE000]
    texts = ODD + ["".join(chr(rng.choice(points)) if rng.random() < 0.3
                           else rng.choice("ab 1!'\n sé") for _ in range(40)) for _ in range(1_500)]
    assert [count(t) for t in texts] == [
        len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_whole_tokens_are_one_token(library):
    with open(NAME, encoding="utf-8") as file:
        whole = whole_tokens(file.read())
    assert len(whole) > 40_000
    for text in random.Random(1).sample(sorted(whole), 300):
        assert len(library.encode(text, add_special_tokens=False).ids) == 1


def test_rows(spark, library):
    data = [(k, t) for k, t in enumerate(ODD)] + [(None, "a b"), (99, None), (99, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "1 AS id", "2 AS n_tokens")
    found = token_counts(df, NAME).collect()
    want = [(k, len((t or "").encode()),
             len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in data]
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens) for r in found))) == sorted(
        map(repr, want))
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)
    assert token_counts(df.limit(0), NAME).collect() == []


def test_other_tokenizers(spark):
    import sentencepiece

    df = spark.createDataFrame([(k, t[:300]) for k, t in enumerate(ODD)], "doc_id bigint, text string")
    words, pieces = path("word_bpe_49k.json"), path("piece_bpe_32k.model")
    library = Tokenizer.from_file(words)
    found = {r.doc_id: r.n_tokens for r in token_counts(df, words).collect()}
    assert found == {k: len(library.encode(t[:300], add_special_tokens=False).ids)
                     for k, t in enumerate(ODD)}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces)
    found = {r.doc_id: r.n_tokens for r in token_counts(df, pieces).collect()}
    assert found == {k: len(library.encode(t[:300])) for k, t in enumerate(ODD)}
