"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Texts are lower-cased (A-Z) and reduced to words, runs of digits, letters and
characters beyond ASCII. Every window of ``window`` consecutive words of an item,
or the whole of a shorter item, is a pattern " w1 w2 ... "; a document becomes
" w1 w2 ... wn " and runs through the automaton once. Spaces at both ends keep a
pattern from starting or ending inside a word. Matches are mapped back to words
and, for documents that have any, to code points of the original text.

The distinct patterns are made and written by Spark, and their size with the ids of their
items is measured. Up to ``AUTOMATON_BYTES`` they go to all tasks as one automaton. Beyond
that, they are dealt by a hash of the pattern to as many groups as keep the bound; the driver
and the tasks hold one group at a time, the documents pass once through each, every
pass is written, and items are joined to the patterns that were found.

Defined results: a null or empty text has no words and no hits. An item without a
word has no pattern. Items with equal windows all count. Items without an id mark
words but are not listed. Rows with equal ``doc_id`` are judged one by one; no
benchmark rows hit nothing. Other columns are not read, or kept as they are where
documents are filtered.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written
from .workers import column_of, mapped

#: Words of a window, and bytes of pattern text that one automaton may hold.
WINDOW, AUTOMATON_BYTES = 10, 32 << 20

_WORD = rb"[0-9a-z\x80-\xff]+"
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32
                for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


class Pattern(NamedTuple):
    pattern: str  # bytes as Latin-1
    size: int  # in words
    items: list[str]


def windows(text: str | None, window: int) -> Iterator[tuple[bytes, int]]:
    """(pattern, words) of every window of an item."""
    own = words(text)
    size = min(window, len(own))
    for k in range(len(own) - size + 1 if own else 0):
        yield b" %s " % b" ".join(own[k:k + size]), size


class Automaton:
    """Windows of benchmark items, ready to scan documents."""

    def __init__(self, patterns: list[Pattern]):
        import ahocorasick

        self.search = ahocorasick.Automaton()
        self.patterns = patterns
        for number, p in enumerate(patterns):
            self.search.add_word(p.pattern, (number, len(p.pattern), p.size))
        if patterns:
            self.search.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and (first word, words, pattern) of every match."""
        own = words(text)
        if not own or not self.patterns:
            return len(own), []
        line = b" %s " % b" ".join(own)
        found = list(self.search.iter(line.decode("latin-1")))
        if not found:
            return len(own), []
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        begins = np.searchsorted(spaces, [end - length + 1 for end, (_, length, _) in found])
        return len(own), [(int(b), size, number)
                          for b, (_, (number, _, size)) in zip(begins, found)]

    def items(self, numbers: Iterable[int]) -> list[str]:
        """Ids of the items that own the patterns, sorted as strings."""
        return sorted({i for n in set(numbers) for i in self.patterns[n].items})


def code_points(text: str, first: int, last: int) -> tuple[int, int]:
    """Where words first to last, both included, stand in the original text."""
    raw = text.encode()
    places = [m.span() for m in re.finditer(_WORD, raw.translate(_NORMAL))]
    start, end = places[first][0], places[last][1]
    before = len(raw[:start].decode())
    return before, before + len(raw[start:end].decode())


def _merged(matches: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs (first word, word behind the last) that the matches cover."""
    runs: list[list[int]] = []
    for begin, size, _ in sorted(matches):
        if runs and begin <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], begin + size)
        else:
            runs.append([begin, begin + size])
    return [(a, b) for a, b in runs]


class Patterns:
    """The distinct patterns of a benchmark in a written table, dealt to groups within a limit."""

    def __init__(self, benchmark: DataFrame, window: int, limit: int):
        schema = pa.schema([("pattern", pa.binary()), ("size", pa.int32()), ("item", pa.string())])

        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                    own = sorted(set(windows(text, window)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p for p, _ in own], pa.binary()), pa.array([n for _, n in own], pa.int32()),
                        pa.array([item] * len(own), pa.string())], schema=schema)

        items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text IS NOT NULL")
        self.owners = written(mapped(items, cut, "pattern binary, size int, item string").distinct(), "benchmark-windows")
        size = self.owners.agg(F.sum(F.octet_length("pattern") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16)).first()[0]
        self.groups = max(1, -(-(size or 0) // limit))
        if self.groups > 1:
            # Patterns alone, so that one of very many items is still one; half full, as hashes are uneven.
            self.groups *= 2
            self.dealt = written(self.owners.select("pattern", "size").distinct().withColumn(
                "group", F.pmod(F.xxhash64("pattern"), F.lit(self.groups))), "benchmark-groups")

    def group(self, number: int) -> list[Pattern]:
        """A group's patterns, within the limit; with their items where there is one group."""
        if self.groups == 1:
            rows = self.owners.groupBy("pattern", "size").agg(F.collect_set("item").alias("items")).collect()
        else:
            rows = self.dealt.where(F.col("group") == number).select("pattern", "size", F.array().alias("items")).collect()
        return sorted(Pattern(bytes(r["pattern"]).decode("latin-1"), r["size"], list(r["items"])) for r in rows)

    def sent(self, number: int):
        """A group's broadcast, and a function for tasks that gives its automaton, built once in each task."""
        sent, built = self.owners.sparkSession.sparkContext.broadcast(self.group(number)), {}

        def automaton() -> Automaton:
            if "own" not in built:
                built["own"] = Automaton(sent.value)
            return built["own"]
        return sent, automaton


FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
    ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         limit: int = AUTOMATON_BYTES) -> DataFrame:
    """Words, hit words, items and hit spans (code points) of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    patterns = Patterns(benchmark, window, limit)
    if patterns.groups > 1:
        return _scan_in_groups(rows, patterns)
    _, automaton = patterns.sent(0)

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton()
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                n, matches = own.scan(text)
                runs = _merged(matches)
                spans = [dict(zip(("start", "end"), code_points(text, a, b - 1))) for a, b in runs]
                out.append((doc, n, sum(b - a for a, b in runs),
                            own.items(m[2] for m in matches), spans))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)

    return mapped(rows, found, FOUND)


def _scan_in_groups(rows: DataFrame, patterns: Patterns) -> DataFrame:
    """One written pass over the documents for each group; the hit words of a row are the union."""
    kept = written(rows.withColumn("_row", F.monotonically_increasing_id()), "scanned")
    schema = pa.schema([("_row", pa.int64()), ("n_words", pa.int64()), ("patterns", pa.list_(pa.binary())),
                        ("hit", pa.list_(pa.int64()))])
    ddl = "_row long, n_words long, patterns array<binary>, hit array<long>"
    passes = []
    for number in range(patterns.groups):
        sent, automaton = patterns.sent(number)

        def found(batches, automaton=automaton, first=number == 0):
            own = automaton()
            for batch in batches:
                out = []
                for row, text in zip(batch["_row"].to_pylist(), batch["text"].to_pylist()):
                    n, matches = own.scan(text)
                    if first or matches:  # the first pass has a row of every document
                        hit = sorted({w for b, size, _ in matches for w in range(b, b + size)})
                        names = sorted({own.patterns[m[2]].pattern for m in matches})
                        out.append((row, n, [p.encode("latin-1") for p in names], hit))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        passes.append(written(mapped(kept.select("_row", "text"), found, ddl), f"pass-{number}"))
        sent.unpersist()
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    hits = every.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hit"))
    items = (every.select("_row", F.explode("patterns").alias("pattern"))
             .join(patterns.owners.where("item IS NOT NULL").select("pattern", "item"), "pattern")
             .select("_row", "item").distinct().groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    joined = kept.join(hits, "_row").join(items, "_row", "left").select(
        "doc_id", "n_words", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hit",
        F.when(F.size("hit") > 0, F.col("text")).alias("text"))

    def spans(batches):
        for batch in batches:
            out = []
            for doc, n, own, hit, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "n_words", "items", "hit", "text"))):
                runs = _merged([(w, 1, 0) for w in hit])
                out.append((doc, n, len(hit), own, [
                    dict(zip(("start", "end"), code_points(text, a, b - 1))) for a, b in runs]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)

    return mapped(joined, spans, FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          limit: int = AUTOMATON_BYTES) -> DataFrame:
    """The documents that hold no benchmark window, unchanged."""
    patterns = Patterns(benchmark, window, limit)
    for number in range(patterns.groups):
        sent, automaton = patterns.sent(number)

        def free(texts: Iterable[pa.Array], automaton=automaton) -> Iterator[pa.Array]:
            own = automaton()
            for some in texts:
                yield pa.array([not own.scan(t.as_py())[1] for t in some], pa.bool_())

        docs = docs.where(column_of("boolean", free, "text"))
        if patterns.groups > 1:
            docs = written(docs, f"free-of-{number}")
            sent.unpersist()
    return docs
