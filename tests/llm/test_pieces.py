"""Encoding and decoding against the sentencepiece library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from ledgerloom.llm import queries
from ledgerloom.llm.pieces import PieceModel, encode_texts

SF = "/root/testdata/sf0.001"
PATH = queries.piece_model()


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return PieceModel(f.read())


def test_odd_texts(model):
    rnd = random.Random(1)
    some = "".join(map(chr, range(32, 127))) + "\n\t▁éßñ日本​²"
    texts = ["", " ", "  a  b", "\0a", "▁x ▁▁", "<s>x</s>", "日本語 テスト 𝒳 é é", "a" * 3000, "x" + "ab" * 60 + ".,", "\r\n\r\n;\r",
             "﻿a", "1234 5", "a    b     c", "▁▁▁▁", " \n \n"]
    texts += ["".join(rnd.choice(some) for _ in range(rnd.randint(1, 80))) for _ in range(3000)]
    texts += ["".join(rnd.choice(["  ", " ", "ab", "the", ".", ",", "\n", "1", "▁", "é"]) for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        ids = model.library.encode(t, add_eos=True)
        assert [*model.encode(t), 2] == ids, t
        assert model.decode(ids) == model.library.decode(ids), t


def test_decoding_any_ids(model):
    rnd = random.Random(2)
    for _ in range(3000):
        ids = [rnd.randrange(0, 600) for _ in range(12)]
        assert model.decode(ids) == model.library.decode(ids), ids


def test_the_check_notices_a_wrong_merge(model):
    with pytest.raises(ValueError):
        model.check(["▁the"], [[*model.merge("▁t"), *model.merge("he")]])


def test_query_over_the_whole_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in queries.op5_pieces(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = sp.encode(r.text or "", add_eos=True)
        want = len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        assert tuple(got[r.doc_id])[1:] == want


def test_edges_of_the_input(spark):
    docs = spark.createDataFrame([(1, None, 7), (1, "", 7), (None, "a b", 7), (None, "a b", 7)], "doc_id long, text string, ids long")
    got = sorted((r.doc_id or 0, r.ids, r.decoded) for r in encode_texts(docs, PATH, ["doc_id"]).collect())
    ab = sentencepiece.SentencePieceProcessor(model_file=PATH).encode("a b", add_eos=True)
    assert got == [(0, ab, "a b"), (0, ab, "a b"), (1, [2], ""), (1, [2], "")]
    assert encode_texts(docs.limit(0), PATH, ["doc_id"]).count() == 0


def test_whole_texts_are_checked_where_characters_first_meet(spark, model):
    from ledgerloom.llm.pieces import _Table

    table = _Table(model)
    assert table.meets(model.words("one two")) and not table.meets(model.words("none the")) is None
    assert not table.meets(model.words("one two")) and table.meets(model.words("one! two"))
    assert _Table(model).meets(model.words("alone")) and not _Table(model).meets([])
    with pytest.raises(ValueError, match="whole|text of"):
        model.check_whole([("one two", [*model.encode("one"), *model.merge("two")], "one two")])
    model.check_whole([("one  two", model.encode("one  two"), model.library.decode(model.encode("one  two")))])


def test_parts_merged_together_are_merged_alike(model):
    rnd = random.Random(4)
    some = "".join(map(chr, range(33, 127))) + "\n\t▁▁éßñ日本​²𝒳"
    parts = ["", "▁", "▁▁▁", "a" * 48, "a" * 49, "\n" * 30, "日", "▁the"]
    parts += ["".join(rnd.choice(some) for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    parts += ["▁" + "".join(rnd.choice(["the", "in", "er", "t", "▁", "1", "é"]) for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    got = [np.frombuffer(b, np.int32).tolist() for b in model.merge_all(parts)]
    assert got == [model.merge(p) for p in parts]
    assert model.merge_all([]) == []


def test_a_batch_of_new_words_is_merged_at_once(model, monkeypatch):
    from ledgerloom.llm.pieces import _Table

    alone = []
    monkeypatch.setattr(PieceModel, "merge", lambda self, part: alone.append(part))
    words = model.words("some words, and (others) do not repeat the words:")
    table = _Table(model)
    table.learn(words)
    assert alone == []
    monkeypatch.undo()
    for w in words:
        assert np.frombuffer(table[w], np.int32).tolist() == [i for p in model.parts(w) for i in model.merge(p)]
        assert not model.whole(w) or model.parts(w) == ["▁" + w]
