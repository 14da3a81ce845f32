"""Every id and every decoded text against the library whose models these are."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from outcomelab.llm import catalog, pieces

ODD = ["", " ", "  ", "a", " a", "a ", "\n", "\n\n a", "<s>", "</s> <0x0A>", "▁", "▁▁a", "�", "😀 é́", "x" * 500,
       " " * 1000, "ab" * 3000, "\x00a", "日本語のテキスト", "a" * 35 + "b", "tab\tand\r\nlines", "  two  spaces  "]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.read_model(catalog.PIECES))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=catalog.PIECES)


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def same(model, library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert ids_of(model.encode(text)) == ids
    assert model.decode(model.encode(text)) == library.decode(ids)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(model, library, text):
    same(model, library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(model, library, text):
    same(model, library, text)


def test_texts_made_of_pieces_need_backtracking(model, library):
    rng = random.Random(2)
    known = list(model.ids)
    for _ in range(3000):
        same(model, library, "".join(rng.choice(known) for _ in range(rng.randrange(9))).replace("▁", " "))


def test_one_very_long_run(model, library):
    rng = random.Random(3)
    same(model, library, "".join(rng.choice("abcdefghij0123456789+/") for _ in range(200_000)))


def test_decoding_any_ids(model, library):
    rng = random.Random(4)
    for _ in range(1500):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000), model.ids["▁"]])
               for _ in range(rng.randrange(9))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)
    with pytest.raises(ValueError):
        model.decode(np.array([32000], "<u4").tobytes())


def test_forgetting_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    same(model, library, "several words of which few are remembered, several words")


def test_other_kinds_of_models_are_refused():
    raw = pieces.read_model(catalog.PIECES)
    with pytest.raises(ValueError):
        pieces.PieceModel(raw.replace(bytes([0x18, 2, 0x20, 0x80, 0xFA, 1]), bytes([0x18, 1, 0x20, 0x80, 0xFA, 1])))


def test_query_over_the_whole_table(spark, folder, library):
    got = {r["doc_id"]: r for r in catalog.op13_backtracking_pieces(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = library.encode(row["text"], add_bos=True, add_eos=True)
        r = got[row["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nulls_empties_repeats_and_clashing_names(spark, docs_of, library):
    raw = pieces.read_model(catalog.PIECES)
    docs = docs_of([(1, None), (2, ""), (3, "one text"), (3, "one text"), (None, "é " * 5)], ["'own' AS ids"])
    rows = pieces.decode(pieces.encode(docs, raw), raw).collect()
    assert len(rows) == 5 and all(r["ids_in"] == "own" for r in rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert ids_of(r["ids"]) == ids and r["decoded"] == library.decode(ids)
    assert pieces.encode(docs.limit(0), raw).count() == 0
    bare = pieces.encode(docs.where("doc_id = 2"), raw, ends=False).first()
    assert bytes(bare["ids"]) == b""
    gone = spark.createDataFrame([(None,)], "ids binary")
    assert pieces.decode(gone, raw).first()["decoded"] is None
