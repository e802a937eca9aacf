from __future__ import annotations

import re

import pytest

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, "
           "key string, _near int, _spans int, n_words int, length int, sketch string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def frame(spark):
    """frame((doc_id, text), ...): documents with extra columns whose names clash."""
    def make(*rows, lang="en", source="s"):
        return spark.createDataFrame(
            [(i, t, lang, source, len(t or ""), "k", 1, 2, 3, 4, "x") for i, t in rows], COLUMNS)
    return make


@pytest.fixture(scope="session")
def odd(frame):
    """Nulls, empty and very long texts, repeated rows and equal ids."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    return frame((1, None), (2, ""), (None, "some words without an id"), (None, None), (3, " \n\t "),
                 (4, long), (5, "repeated row"), (5, "repeated row"), (5, "another text of that id"),
                 (6, "ünï cödé 　 ' it's " + "é" * 300))


def words(text):
    """Lower-cased (A-Z) runs of digits, letters and characters beyond ASCII."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
