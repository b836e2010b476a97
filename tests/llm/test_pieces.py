import random

import pytest
import sentencepiece
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

from fettle.llm import pieces
from fettle.llm.queries import op11_sentencepiece

MODEL = tokenizer_path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
SCHEMA = "doc_id bigint, text string"


def odd_texts():
    rng = random.Random(1)
    parts = [*" \t\n\r\0\x7f▁abcdeABCxyz.,!?0189é中文的日本😀✓ñßĀ​", "the ", "ation", "\n\n", "   ",
             "▁▁", "<s>", "</s>", "<0x41>", "<unk>", "한국", "é", " ", "\U0010ffff"]
    texts = [None, "", " ", "  ", "▁", "\n", " \n ", "a\n b", "x 1", "1x", "a" * 3_000, "ab" * 2_000,
             "\n" * 2_000, "的" * 400, "wordwithoutanyspace" * 300, "a " * 20_000]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randrange(60)))
                    for _ in range(2_000)]


@pytest.mark.parametrize("remembered, short", [(500_000, 48), (50, 48), (500_000, 1)])
def test_ids_equal_the_library(spark, monkeypatch, remembered, short):
    monkeypatch.setattr(pieces, "REMEMBERED", remembered)
    monkeypatch.setattr(pieces, "SHORT", short)  # 1: every stretch by its own agenda
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    found = pieces.decode_pieces(pieces.encode_pieces(docs, MODEL), MODEL).collect()
    assert len(found) == len(texts) and not any(r.unlike for r in found)
    for r in found:
        want = LIBRARY.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.ids == want and r.decoded == LIBRARY.decode(want), repr(texts[r.doc_id])


def test_any_ids_decode_as_the_library_does(spark):
    rng = random.Random(2)
    some = [0, 1, 2, *range(3, 259), LIBRARY.piece_to_id("▁"), LIBRARY.piece_to_id("▁the")]
    lists = [[], [2], [1, 2], *([rng.choice(some) if rng.random() < .7 else rng.randrange(32_000)
                                 for _ in range(rng.randrange(12))] for _ in range(3_000))]
    df = spark.createDataFrame([(k, ids) for k, ids in enumerate([*lists, None])],
                               "id bigint, ids array<int>")
    found = {r.id: r.decoded for r in pieces.decode_pieces(df, MODEL).collect()}
    assert found.pop(len(lists)) is None
    for key, text in found.items():
        assert text == LIBRARY.decode(lists[key]), lists[key]


def test_agenda_takes_the_best_score_and_the_leftmost_of_equals():
    vocabulary = pieces.Vocabulary(open(MODEL, "rb").read())
    vocabulary.rank = {"ab": 1, "bc": 0, "aa": 2, "aab": 2}
    assert vocabulary.merged("abc") == ["a", "bc"]
    assert vocabulary.merged("aaa") == ["aa", "a"]
    assert vocabulary.merged("aaab") == ["aa", "ab"]
    vocabulary.ids = {name: k for k, name in enumerate(["a", "b", "c", *vocabulary.rank])}
    together = pieces.SideBySide(vocabulary)
    rng = random.Random(3)
    for size in (1, 2, 5, 9):
        words = ["".join(rng.choice("abcd") for _ in range(size)) for _ in range(200)]
        for word, ids in together(words):
            assert ids == pieces.array("i", vocabulary.encoded(word)).tobytes()


def test_disagreement_is_counted_and_the_library_wins(spark, monkeypatch):
    monkeypatch.setattr(pieces.SideBySide, "__call__", lambda self, same: (
        (s, pieces.array("i", [5, 5]).tobytes()) for s in same))
    docs = spark.createDataFrame([(0, "some words"), (1, "")], SCHEMA)
    found = sorted(pieces.encode_pieces(docs, MODEL, end=False).collect())
    assert [(r.ids, r.unlike) for r in found] == [(LIBRARY.encode("some words"), 2), ([], 0)]


def test_odd_rows_and_models(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, None)], SCHEMA).withColumn(
        "ids", F.lit("x"))
    found = pieces.encode_pieces(docs, MODEL)
    assert found.columns == ["doc_id", "ids", "unlike"] and found.count() == 3
    assert pieces.encode_pieces(docs.limit(0), MODEL).collect() == []
    with pytest.raises(ValueError, match="exists"):
        pieces.decode_pieces(found.withColumn("Decoded", F.lit(1)), MODEL)
    data = open(MODEL, "rb").read()
    for change in (b"\x1a\x02\x18\x00", b"\x12\x02\x18\x01"):  # no space in front; not merges
        other = tmp_path / f"{change.hex()}.model"
        other.write_bytes(data + change)
        with pytest.raises(ValueError):
            pieces.encode_pieces(docs, str(other))


def test_query(spark, tmp_path):
    import hashlib

    texts = odd_texts()[:60]
    spark.createDataFrame(list(enumerate(texts)), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: tuple(r)[1:4] for r in op11_sentencepiece(spark, str(tmp_path)).collect()}
    for key, text in enumerate(texts):
        ids = LIBRARY.encode(text or "", add_eos=True)
        assert found[key] == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())
