"""Token ids, packing, token files and token counts against the libraries and brute force."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillsight.llm import packing, token_counts, token_files
from tillsight.llm.queries import BYTE_BPE, PIECES, QUERIES, WORD_BPE, packed
from tillsight.llm.tokens import Encoder, encoder, sections

KINDS = {WORD_BPE: "words", BYTE_BPE: "spaced"}


@pytest.fixture(scope="module", params=list(KINDS))
def both(request):
    library = Tokenizer.from_file(public_tokenizers.path(request.param))
    library.encode_special_tokens = True
    return library, Encoder(public_tokenizers.path(request.param), KINDS[request.param])


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(st.one_of(st.sampled_from("aZé²ß '\n\t\x85\xa0　!1\x1c\x00́"), st.characters(
    codec="utf-8")), max_size=40), max_size=6))
def test_ids_are_the_librarys(both, texts):
    library, own = both
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.many(texts)] == expected


def test_every_code_point_beside_others(both):
    library, own = both
    points = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}!{c}1 {c}{c}\n{c} x" for c in points]
    expected = library.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in own.many(texts)] == [e.ids for e in expected]


def test_special_tokens_are_text_and_the_store_may_start_anew(both):
    library, own = both
    texts = ["a <|endoftext|> b", "It's <|startoftext|>"] * 3
    own.kept = 1
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for t in texts for x in own.many([t])] == expected
    own.kept = 10_000


@pytest.mark.parametrize("name", list(KINDS))
def test_added_tokens_get_the_ids_of_the_unmodified_library(name):
    library, own = Tokenizer.from_file(public_tokenizers.path(name)), encoder(public_tokenizers.path(name), KINDS[name])
    texts = ["a <|endoftext|> b", "It's <|startoftext|>", "x<|ENDOFTEXT|>é", "<|endoftext|><|endoftext|>", "plain <| text"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.many(texts)] == expected
    assert library.token_to_id("<|endoftext|>") in expected[0]


def test_packing_and_files_of_added_tokens(frame):
    text, (words, spaced) = "a <|endoftext|> b", (Tokenizer.from_file(public_tokenizers.path(n)) for n in (WORD_BPE, BYTE_BPE))
    docs = frame((1, text))
    for rows, library, end in ((packed(docs), words, 1), (token_files.through_files(
            docs, public_tokenizers.path(BYTE_BPE)).withColumn("ids_crc32", F.crc32("ids")), spaced, 2)):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [end], dtype="<u4")
        assert [r.ids_crc32 for r in rows.collect()] == [zlib.crc32(ids.tobytes())]


def test_sections_join_to_the_text():
    text = "word " * 50 + "x" * 100 + "\n\n" + "a b" * 40
    parts = list(sections(text, 30))
    assert "".join(parts) == text and len(parts) > 5 and list(sections("")) == [""]


def _ids(name, text, end):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def _check_packing(rows, texts_by_id):
    ids = {i: _ids(WORD_BPE, t, 1) for i, t in texts_by_id.items()}
    for r in rows:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == 4096 * r.piece and r.ids_crc32 == zlib.crc32(own.tobytes())
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences), sum(map(len, ids.values())) / 4096


def test_packing_of_documents(spark, texts):
    rows = QUERIES["op1_packing"](spark, "/root/testdata/sf0.001").collect()
    used, least = _check_packing(rows, texts)
    assert used <= 1.05 * least + 1


def test_packing_of_odd_rows(frame, odd):
    rows = packed(odd).collect()
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert max(r.piece for r in rows if r.doc_id == 4) > 5
    assert packed(odd.where("false")).count() == 0
    assert {r.length for r in packed(frame((1, None), (2, ""))).collect()} == {1}


def test_pack_gives_the_ids(spark, frame):
    docs = frame((1, "one two three"), (2, "four"), (3, "five " * 30))
    rows = packing.pack(docs, public_tokenizers.path(WORD_BPE), capacity=16).collect()
    joined = {}
    for r in sorted(rows, key=lambda r: r.piece):
        joined.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4"))
    assert np.concatenate(joined[3]).tolist() == _ids(WORD_BPE, "five " * 30, 1).tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_sum_of_squares_is_the_smallest(lengths):
    """Replays every choice with the sum itself."""
    capacity = 20
    number, offset = packing.sum_of_squares(np.array(lengths, dtype=np.int64), capacity)
    fill = {}
    for s, n, o in zip(lengths, number.tolist(), offset.tolist()):
        def squares(gaps):
            counts = np.bincount([g for g in gaps if g], minlength=1)
            return int((counts ** 2).sum())
        gaps = [capacity - f for f in fill.values()]
        choices = [squares([*gaps, capacity - s])]
        choices += [squares([*gaps[:k], g - s, *gaps[k + 1:]]) for k, g in enumerate(gaps) if g >= s]
        assert fill.get(n, 0) == o
        fill[n] = o + s
        assert fill[n] <= capacity and squares([capacity - f for f in fill.values()]) == min(choices)


def test_packing_in_several_shards(frame):
    docs = frame(*((i, "word " * (i % 300)) for i in range(400)))
    cut = packing.pieces(docs, public_tokenizers.path(WORD_BPE), 1, 256)
    placed = packing.place(cut.select("part", "row", "piece", "length"), 256,
                           [F.col("part"), F.col("row"), F.col("piece")], shard=60)
    fill = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("all"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fill.where("all <> end OR all > 256").count() == 0
    assert placed.count() == cut.count()


# --- files --------------------------------------------------------------------

def test_token_files_against_the_library(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for doc in sorted(texts):
        ids = _ids(BYTE_BPE, texts[doc], 2)
        assert (rows[doc].start, rows[doc].n_tokens, rows[doc].ids_crc32) == (
            start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(rows) == len(texts)


def test_token_files_of_odd_rows(odd):
    path = public_tokenizers.path(BYTE_BPE)
    rows = sorted(token_files.through_files(odd, path).collect(), key=lambda r: r.start)
    assert len(rows) == odd.count()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    assert token_files.through_files(odd.where("false"), path).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 10_000))
def test_elias_fano_selects(steps, beyond):
    numbers = np.cumsum(steps) if steps else np.zeros(0, np.int64)
    universe = (int(numbers[-1]) if steps else 0) + beyond
    made = token_files.EliasFano.of(numbers, universe)
    again, end = token_files.EliasFano.load(memoryview(made.dump()), 0)
    assert end == len(made.dump())
    assert again.select_many(np.arange(len(numbers))).tolist() == numbers.tolist()
    assert [again.select(i) for i in range(len(numbers))] == numbers.tolist()


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    bits = 8 * len(token_files.EliasFano.of(ends, int(ends[-1])).dump()) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 1.5


def test_segment_reads_single_documents():
    documents = [np.arange(n, dtype=np.uint32) for n in (3, 1, 7)]
    found = token_files.Segment(token_files.segment_blob([None, -5, 9], documents, 2))
    assert [found.doc_id(i) for i in range(3)] == [None, -5, 9]
    assert [found.document(i).tolist() for i in range(3)] == [d.tolist() for d in documents]
    with pytest.raises(ValueError):
        token_files.Segment(b"x" * 40)


# --- counts -------------------------------------------------------------------

@pytest.fixture(scope="module")
def unigram():
    return token_counts.Unigram.of_file(public_tokenizers.path(PIECES))


def _brute(model, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = [(best[s][0] + model.pieces[word[s:end]], best[s][1] - 1)
                 for s in range(end) if word[s:end] in model.pieces]
        if word[end - 1] not in model.pieces:
            n = len(word[end - 1].encode())
            found.append((best[end - 1][0] + n * model.byte, best[end - 1][1] - n))
        best.append(max(found))
    return -best[-1][1]


def test_token_counts_of_documents(spark, texts, unigram):
    rows = QUERIES["op8_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows[:60]:
        own = texts[r.doc_id].split()
        assert (r.n_pretokens, r.n_tokens) == (len(own), sum(_brute(unigram, "▁" + w) for w in own))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_trie_counts_equal_each_words_own(unigram, word):
    assert unigram.count("▁" + word) == _brute(unigram, "▁" + word)


def test_trie_may_start_anew_and_long_words_pass_it(unigram):
    small = token_counts.Unigram(unigram.pieces, nodes=5)
    words = ["▁hello", "▁help", "▁hello", "▁" + "ab" * 300]
    assert [small.count(w) for w in words] == [_brute(unigram, w) for w in words]


def test_token_counts_of_odd_rows(odd):
    path = public_tokenizers.path(PIECES)
    rows = values(token_counts.count(odd, path))
    assert len(rows) == odd.count() and (1, 0, 0) in rows and (3, 0, 0) in rows
    assert token_counts.count(odd.where("false"), path).count() == 0


def test_ids_over_the_whole_range_of_longs_are_read_back(spark, frame):
    ends = [-2**63, -2**63 + 1, -5, 0, 7, 2**62, 2**63 - 2, 2**63 - 1, None, None]
    docs = frame(*[(i, f"text number {k}") for k, i in enumerate(ends)])
    path = public_tokenizers.path(BYTE_BPE)
    rows = token_files.through_files(docs.coalesce(1), path).collect()
    library = Tokenizer.from_file(path)
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == sorted((i is not None, i or 0) for i in ends)
    for r in rows:
        if r.doc_id is not None:
            expected = [*library.encode(f"text number {ends.index(r.doc_id)}", add_special_tokens=False).ids, 2]
            assert np.frombuffer(r.ids, "<u4").tolist() == expected and r.n_tokens == len(expected)
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


@settings(max_examples=100, deadline=None)
@given(values=st.lists(st.integers(0, 2**64 - 1), max_size=40), few=st.booleans())
def test_select_of_many_is_select_of_each(values, few):
    numbers = np.sort(np.array([v % 50 if few else v for v in values], dtype=np.uint64))
    own = token_files.EliasFano.of(numbers, int(numbers[-1]) if len(numbers) else 0)
    again, _ = token_files.EliasFano.load(memoryview(own.dump()), 0)
    assert again.select_many(np.arange(len(numbers))).tolist() == numbers.tolist() == [again.select(k) for k in range(len(numbers))]
