"""Secrets in texts: fixed patterns, and a battery of randomness tests.

Three patterns give the base spans. Beyond them, every run of 20 or more
characters that encodings use is a candidate, and so is every part of 20 or more letters
and digits between the separators of a run: a secret may stand in a path. Its
encoding is inferred from its characters (hexadecimal, base32, letters, base62, base64) and
gives the alphabet. Three tests ask how likely ordinary text looks as random:

* chi-squared against a uniform alphabet: text repeats its letters, so its statistic
  is large and grows with the length; a random string's stays near its mean;
* runs: text changes the class of its characters (lower, upper, digit) seldom;
* serial correlation: neighbours in text are alike, in a random string they are not.

The three p-values are combined by Fisher's method. Long candidates give much
smaller ones than short ones, so the false discovery rate is controlled within
classes of length (Benjamini-Hochberg over all candidates of the corpus, on a
histogram of p-values that has a fixed number of rows). What remains also must
not be rejected as random by the chi-squared test itself.

Everything is Spark's own functions. A text is read once for its spans, which are written.
Positions are code points, ends exclusive. Running sums and maxima over the spans of a
document are taken in blocks of blocks (``_running``), and the tests walk a candidate a fixed
number of times, so neither very many spans nor very long ones cost quadratic work.

A part inside a run that is reported, or any candidate inside a base span, is not reported again.

Defined results: a null or empty text has no spans. Rows with equal ``doc_id`` are
scanned one by one. Other columns are not read, or kept as they are by ``redact``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written

#: Kind, pattern, and what a match has to be, in the order of the report.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
RUN, PART = r"[A-Za-z0-9+/_=-]{20,}+", r"[A-Za-z0-9]{20,}+"

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encoding: what all its characters are, and its alphabet; the first that fits counts.
ENCODINGS = {
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    "base32": ("^[A-Z2-7]+=*$", _UPPER + "234567"),
    "letters": ("^[A-Za-z]+$", _UPPER + _LOWER),
    "base62": ("^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    "base64": ("", _UPPER + _LOWER + _DIGITS + "+/"),
}
#: Ordinary text: chance that two of its letters are equal, change of class from one
#: character to the next, and correlation of neighbours.
COINCIDENCE, CHANGE, LIKENESS = 0.065, 0.3, 0.4
#: False discovery rate; bound of the chi-squared test's own rejection.
RATE, Z_RANDOM = 0.001, 5.0
#: Lengths at which a new class begins, and bins of -10 log10 p.
CLASSES, BINS = (20, 28, 40, 64), 120
_BLOCK = 64


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, zero: Column, add, levels: int = 2) -> Column:
    """For each value, ``add`` over all values before it, starting from zero.

    Blocks are added up, the blocks' results are run over in the same way, and then the
    values within each block; an array grows by one block at most.
    """
    def plain(some: Column, start: Column) -> Column:
        return F.aggregate(
            some, F.struct(start.alias("at"), F.slice(F.array(zero), 1, 0).alias("out")),
            lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    if not levels:
        return plain(values, zero)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(values) - 1) / _BLOCK).cast("int"), F.lit(0))),
                         lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
    return _let(blocks, lambda own: F.flatten(F.zip_with(
        own, _running(F.transform(own, lambda block: F.aggregate(block, zero, add)), zero, add, levels - 1), plain)))


def _found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of a pattern's matches.

    split() gives the gaps between the matches; positions are sums of lengths.
    """
    pairs = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).alias("g"), match.alias("match"),
                                    F.coalesce(F.length(match), F.lit(0)).alias("m")))
    spans = _let(pairs, lambda own: F.zip_with(
        own, _running(F.transform(own, lambda x: x["g"] + x["m"]), F.lit(0), lambda a, x: a + x),
        lambda x, at: F.struct((at + x["g"]).alias("start"), (at + x["g"] + x["m"]).alias("end"), x["match"].alias("match"))))
    return F.filter(spans, lambda s: s["match"].isNotNull())


def _guarded(text: Column, pattern: str, keep=None) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    spans = _found(text, pattern)
    return F.when(text.rlike(pattern), F.filter(spans, keep) if keep else spans).otherwise(none)


def _upper_tail(z: Column) -> Column:
    """Chance that a standard normal variable exceeds z (Zelen and Severo's formula)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _total(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + of(x))


def _tested(token: Column) -> Column:
    """struct<p, fits>: p-value against ordinary text, and whether the string passes as random."""
    alphabet = reduce(lambda rest, e: F.when(token.rlike(e[0]), F.lit(e[1])).otherwise(rest),
                      reversed(list(ENCODINGS.values())[:-1]), F.lit(ENCODINGS["base64"][1]))
    text = F.when(token.rlike("^[0-9A-F]+$"), F.lower(token)).otherwise(
        F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/"))

    def statistics(t: Column) -> Column:
        size, n = F.length(t["alphabet"]).cast("double"), F.length(t["text"]).cast("double")
        squares = _total(F.split(t["alphabet"], ""), lambda c: F.pow(
            n - F.length(F.replace(t["text"], c, F.lit(""))), F.lit(2.0)))
        # Runs of one class become one character each.
        changes = F.length(F.regexp_replace(t["classes"], r"(.)\1*+", "x")) - 1
        codes = F.transform(F.split(t["text"], ""), lambda c: F.position(c, t["alphabet"]).cast("double"))
        centred = _let(codes, lambda x: _let(_total(x, lambda y: y) / n, lambda mean: F.transform(x, lambda y: y - mean)))
        correlation = _let(centred, lambda x: F.try_divide(
            _total(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda a, b: a * b), lambda y: y),
            _total(x, lambda y: y * y)))
        return F.struct(size.alias("size"), n.alias("n"), (squares * size / n - n).alias("chi"),
                        changes.cast("double").alias("changes"), F.coalesce(correlation, F.lit(1.0)).alias("correlation"))

    def verdict(s: Column) -> Column:
        n, size = s["n"], s["size"]
        # Against text, chi-squared is noncentral: symbols coincide more often than by chance.
        excess = (n - 1) * F.greatest(size * COINCIDENCE - 1, F.lit(1.0))
        repeats = (size - 1 + excess - s["chi"]) / F.sqrt(2 * (size - 1) + 4 * excess)
        runs = (s["changes"] - 0.5 - (n - 1) * CHANGE) / F.sqrt((n - 1) * CHANGE * (1 - CHANGE))
        serial = (LIKENESS - F.abs(s["correlation"])) * F.sqrt(n) / (1 - LIKENESS ** 2) ** 0.5
        half = -reduce(lambda a, b: a + b, (
            F.log(F.greatest(_upper_tail(z), F.lit(1e-30))) for z in (repeats, runs, serial)))
        fisher = F.exp(-half) * (1 + half + half * half / 2)
        own = (s["chi"] - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
        return F.struct(F.greatest(fisher, F.lit(10.0 ** (-BINS / 10))).alias("p"),
                        (own <= Z_RANDOM).alias("fits"))

    classes = F.translate(text, _LOWER + _UPPER + _DIGITS, "l" * 26 + "u" * 26 + "d" * 10)
    return _let(F.struct(text.alias("text"), alphabet.alias("alphabet"), classes.alias("classes")),
                lambda t: _let(statistics(t), verdict))


def spans(text: Column) -> dict[str, Column]:
    """Base spans by kind, and ``tested``: candidates with class, bin of p and whether they fit."""
    text = F.coalesce(text, F.lit(""))
    found = {"assign": _guarded(text, ASSIGN, lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 12),
             **{kind: _guarded(text, BASE[kind]) for kind in ("access", "hex")}}
    runs, parts = _guarded(text, RUN), _guarded(text, PART)

    def tested(span: Column) -> Column:
        length = span["end"] - span["start"]
        size = reduce(lambda a, b: a + b, (F.when(length >= c, 1).otherwise(0) for c in CLASSES[1:]))
        return _let(_tested(span["match"]), lambda t: F.struct(
            span["start"].alias("start"), span["end"].alias("end"), size.alias("size"),
            F.floor(-10 * F.log10(t["p"])).cast("int").alias("bin"), t["fits"].alias("fits")))

    # A run without separators is its own part.
    candidates = F.array_distinct(F.concat(runs, parts))
    return {**{kind: F.transform(s, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
               for kind, s in found.items()},
            "tested": F.transform(F.filter(candidates, lambda s: F.length(F.regexp_replace(s["match"], "[=+/_-]+", "")) >= 2),
                                  tested)}


def limits(found: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each class of lengths the lowest bin of discoveries, over all candidates of ``found``.

    Benjamini and Hochberg's rule on binned p-values, each taken at its bin's upper end.
    """
    rows = (found.select(F.explode("tested").alias("t")).groupBy("t.size", "t.bin").count()
            .collect())  # len(CLASSES) * (BINS + 1) rows at most
    lowest = {}
    for size in {r["size"] for r in rows}:
        counts = {r["bin"]: r["count"] for r in rows if r["size"] == size}
        total, above = sum(counts.values()), 0
        for level in sorted(counts, reverse=True):
            above += counts[level]
            if 10 ** (-level / 10) * total <= rate * above:
                lowest[size] = level
    return lowest


def _ordered(found: dict[str, Column], lowest: dict[int, int]) -> Column:
    """All spans, array<struct<start, rank, end, kind>> by start and kind."""
    def ranked(kind: str, rank: int, column: Column) -> Column:
        return F.transform(column, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
            F.lit(kind).alias("kind")))

    base = F.concat(*(ranked(kind, rank, found[kind]) for rank, kind in enumerate(BASE)))
    none = F.slice(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), 1, 0)

    def is_secret(t: Column) -> Column:
        low = reduce(lambda rest, item: F.when(t["size"] == item[0], t["bin"] >= item[1]).otherwise(rest),
                     lowest.items(), F.lit(False))
        return low & t["fits"]

    def uncovered(secrets: Column) -> Column:
        """Those that lie in no base span and in no longer one of themselves: sorted by start, the
        larger first, the furthest end so far is behind the own one."""
        every = F.array_sort(F.concat(
            F.transform(base, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(False).alias("own"))),
            F.transform(secrets, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(True).alias("own")))))
        ahead = _let(every, lambda e: F.zip_with(
            e, _running(F.transform(e, lambda x: -x["back"]), F.lit(-1), lambda a, x: F.greatest(a, x)),
            lambda x, far: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"),
                                    (x["own"] & (far < -x["back"])).alias("own"))))
        return F.transform(F.filter(ahead, lambda x: x["own"]),
                           lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    random = _let(F.filter(found["tested"], is_secret), lambda t: F.when(F.size(t) > 0, uncovered(t)).otherwise(none))
    return F.array_sort(F.concat(base, ranked("random", len(BASE), random)))


def listed(column: str | Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, spans): every span of every document, in order of start and kind."""
    found = written(docs.select(F.col("doc_id").cast("long"), *(
        c.alias(name) for name, c in spans(F.col("text")).items())), "spans")
    columns = {name: F.col(name) for name in (*BASE, "tested")}
    return found.select("doc_id", _ordered(columns, limits(found, rate)).alias("spans"))


def redact(docs: DataFrame, mask: str = "[secret]", rate: float = RATE) -> DataFrame:
    """The documents with every secret replaced by the mask; ``n_chars`` follows the text.

    Overlapping spans become one mask. Other documents stay as they are.
    """
    own = "_spans"
    while own in docs.columns:
        own += "_"
    # Written with their spans, which the limits and the masks both need.
    kept = written(docs.withColumn(own, F.struct(*(c.alias(name) for name, c in spans(F.col("text")).items()))), "spans")
    lowest = limits(kept.select(F.col(f"{own}.tested").alias("tested")), rate)
    marked = kept.withColumn(own, _ordered({name: F.col(own)[name] for name in (*BASE, "tested")}, lowest))
    text = F.col("text")
    masked = F.aggregate(
        own, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    mended = marked.withColumn(own, F.when(F.size(own) > 0, masked))
    changed = {"text": F.coalesce(own, text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length(own).cast(docs.schema["n_chars"].dataType), "n_chars")
    return mended.select(*(changed.get(c, F.col(c)).alias(c) for c in docs.columns))
