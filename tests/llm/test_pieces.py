"""SentencePiece ids and texts against the library."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from tillsight.llm import pieces as operator
from tillsight.llm.queries import PIECES, QUERIES

PATH = public_tokenizers.path(PIECES)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def agrees(library, own, text):
    expected = library.encode(text, add_bos=True, add_eos=True)
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert own.decode(ids) == library.decode(expected)


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from("aeth  \n\t19_.,-²é😀中\x00　▁<>"), st.characters(codec="utf-8")), max_size=60))
def test_any_text_as_the_library(library, text):
    agrees(library, operator.pieces(PATH), text)


@settings(max_examples=300, deadline=None)
@given(some=st.lists(st.integers(259, 31_999), max_size=8), blanks=st.sampled_from([" ", "▁", "   "]))
def test_pieces_side_by_side_as_the_library(library, some, blanks):
    agrees(library, operator.pieces(PATH), "".join(map(library.id_to_piece, some)).replace("▁", blanks))


def test_runs_of_spaces_and_long_parts_as_the_library(library):
    own = operator.pieces(PATH)
    for n in range(120):
        for text in (" " * n, " " * n + "word", "x" + " " * n + "_(", "ab" * n + "漢" * n):
            agrees(library, own, text)
    agrees(library, own, "".join(chr(97 + i * i % 23) for i in range(300_000)))


@settings(max_examples=300, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 258), st.sampled_from([259, 28705, 261, 229, 148, 163]), st.integers(0, 31_999)), max_size=10))
def test_any_ids_decode_as_the_library(library, ids):
    assert operator.pieces(PATH).decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids)


def test_sections_and_a_store_that_starts_anew_change_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(operator, "AT_ONCE", 50)
    monkeypatch.setattr(operator, "KEPT", 300)
    monkeypatch.setattr(operator, "PAIRS", 50)
    own = operator.Pieces(PATH)
    for text in list(texts.values())[:60]:
        agrees(library, own, text)


def test_query_holds_the_librarys_digests_for_every_document(spark, texts, library):
    rows = {r.doc_id: r for r in QUERIES["op11_pieces"](spark, "/root/testdata/sf0.001").collect()}
    assert rows.keys() == texts.keys()
    for doc, text in texts.items():
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert tuple(rows[doc]) == (
            doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_odd_rows_and_both_ways_one_by_one(odd, library):
    rows = operator.round_trip(odd, PATH).collect()
    assert len(rows) == odd.count()
    assert sorted(r.n_tokens for r in rows if r.decoded == "") == [2, 2, 2]  # two nulls and an empty text
    back = operator.decode(operator.encode(odd, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((r.doc_id or 0, r.text or "") for r in odd.collect())
    assert operator.round_trip(odd.limit(0), PATH).count() == 0
