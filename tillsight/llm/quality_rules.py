"""Quality rules whose thresholds follow each language and source.

A first pass measures every text. Documents that fail the base rules are out. From the others, a
quantile sketch is kept for each language, source and measure: counts in buckets whose bounds grow by
``GROWTH``, so a quantile is right within that ratio. Buckets are the same everywhere, so sketches
merge by adding counts, from tasks to sources, to languages, to the corpus, in any order and without
any draw: two runs give the same fences.

A group's quartiles are blended with those of its language, and these with the corpus's, by a
weight n² / (n² + ``HALF``²) that grows smoothly with the group's documents; no number of documents is
a switch. Its fences are these quartiles, widened by three times their distance. The
measures are joined with the fences, and a document outside any fence goes.

Defined results: a null or empty text has no words and fails the base rules.
Null languages and sources are groups of their own. Rows with equal ``doc_id``
are judged one by one. No rows give no rows. Only ``doc_id``, ``text``, ``lang``
and ``source`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import written

#: Documents at which a group's own quartiles count half, and the growth of a sketch's buckets.
HALF, GROWTH = 100, 1.02
#: Times the quartile distance that a fence lies outside the quartiles.
REACH = 3.0
#: Measure: its formula, the least quartile distance, and whether small values are odd too.
#: ``REACH`` times a least distance stays well below the base rules, so that each fence can reject.
MEASURES = {
    "symbol_rate": ("n_symbols / n_words", 0.04, False),
    "dup_line_rate": ("n_dup_lines / n_lines", 0.05, False),
    "repeat_rate": ("n_repeat_words / n_words", 0.03, False),
    "word_length": ("word_chars / n_words", 1.0, True),
}

_ZERO = -(1 << 30)
_SYMBOLS = b"#*$%&|<>"
_OUT = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()),
                  *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_lines",
                                              "n_dup_lines", "n_repeat_words"))])
_OUT_DDL = ("doc_id long, lang string, source string, n_words long, word_chars long, "
            "n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words inside a window of so many words that occurs twice or more."""
    if len(words) < window + 1:
        return 0
    # Number each word, then each run of 2, 4 and 8 words by the numbers of its halves.
    numbers: dict[bytes, int] = {}
    runs = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    width = 1
    while width < window:
        pairs = runs[:-width] * (int(runs.max()) + 1) + runs[width:]
        _, runs, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
        width *= 2
    starts = np.flatnonzero(counts[runs] > 1)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    raw = (text or "").encode()
    words = raw.split()  # at ASCII white space
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (len(words), len(b"".join(words).decode()),
            len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(words))


def measure(docs: DataFrame) -> DataFrame:
    """The measures of every document, written below the shared folder."""
    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure_text(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["lang"], batch["source"],
                 *(pa.array([f[k] for f in found], pa.int64()) for k in range(6))], schema=_OUT)

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"),
                       F.col("source").cast("string")).mapInArrow(measured, _OUT_DDL)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return written(rows.withColumn("base_failed", failed), "measures")


def _rates(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.expr(f"double({formula.replace(' / ', ') / nullif(')}, 0)")
                             for name, (formula, _, _) in MEASURES.items()})


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, name, bucket, n): the sketches of every group as rows, written.

    Bucket b holds values from GROWTH^b to GROWTH^(b + 1); zeros have one of their own, below all. A sketch
    has some hundred buckets, however many documents it counts.
    """
    pairs = F.array(*(F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in MEASURES))
    bucket = F.when(F.col("value") > 0, F.floor(F.log(F.col("value")) / math.log(GROWTH)).cast("int")).otherwise(_ZERO)
    return written(_rates(measures.where("NOT base_failed")).select("lang", "source", F.inline(pairs))
                   .where("value IS NOT NULL").groupBy("lang", "source", "name", bucket.alias("bucket"))
                   .agg(F.count("*").alias("n")), "sketches")


def quartiles(sketch: DataFrame, *by: str) -> DataFrame:
    """(by..., name, n, q1, q3) of the sketches merged to ``by``."""
    merged = sketch.groupBy(*by, "name", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "name")
    value = F.when(F.col("bucket") == _ZERO, 0.0).otherwise(F.pow(F.lit(GROWTH), F.col("bucket") + 0.5))
    ranked = merged.select(*by, "name", "n", value.alias("value"), F.sum("n").over(group).alias("all"),
                           F.sum("n").over(group.orderBy("bucket")).alias("until"))
    return ranked.groupBy(*by, "name").agg(
        F.sum("n").alias("n"), *(F.min(F.when(F.col("until") >= F.col("all") * rank, F.col("value"))).alias(part)
                                 for part, rank in (("q1", 0.25), ("q3", 0.75))))


def fences(measures: DataFrame, half: float = HALF) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high), written below the shared folder."""
    sketch = sketches(measures)

    def blended(own: DataFrame, above: DataFrame, *same: str) -> DataFrame:
        """Own quartiles weighed against those of the level above, which ``same`` columns lead to."""
        above = above.select(*(F.col(c).alias(f"_{c}") for c in (*same, "name")), F.col("q1").alias("_q1"), F.col("q3").alias("_q3"))
        meets = F.col("name") == F.col("_name")
        for c in same:
            meets &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        n = F.col("n").cast("double")
        weight = n * n / (n * n + half * half)
        return own.join(above, meets).select(*(c for c in own.columns if c not in ("q1", "q3")), *(
            (weight * F.col(q) + (1 - weight) * F.col(f"_{q}")).alias(q) for q in ("q1", "q3")))

    tongues = written(blended(quartiles(sketch, "lang"), quartiles(sketch)), "tongues")
    groups = blended(quartiles(sketch, "lang", "source"), tongues, "lang")
    bounds = []
    for name, (_, least, two_sided) in MEASURES.items():
        q1, q3 = (F.max(F.when(F.col("name") == name, F.col(q))) for q in ("q1", "q3"))
        reach = REACH * F.greatest(q3 - q1, F.lit(least))
        bounds += [(q1 - reach if two_sided else F.lit(None).cast("double")).alias(f"{name}_low"),
                   (q3 + reach).alias(f"{name}_high")]
    return written(groups.groupBy("lang", "source").agg(*bounds), "fences")


def judge(docs: DataFrame, half: float = HALF) -> DataFrame:
    """The measures of every document, ``base_failed``, and whether it is kept."""
    measures = measure(docs)
    limits = fences(measures, half)
    rows = _rates(measures).alias("m").join(
        limits.alias("f"), F.col("m.lang").eqNullSafe(F.col("f.lang"))
        & F.col("m.source").eqNullSafe(F.col("f.source")), "left")
    inside = ~F.col("base_failed")
    for name in MEASURES:
        inside &= (F.coalesce(F.col(name) <= F.col(f"{name}_high"), F.lit(True))
                   & F.coalesce(F.col(name) >= F.col(f"{name}_low"), F.lit(True)))
    return rows.select("m.*", inside.alias("kept"))
