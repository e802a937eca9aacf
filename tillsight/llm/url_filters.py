"""Verdicts on page addresses: rules first, then words found in host and path.

A rule is a host and the beginning of a path; it fits the host and its subdomains,
and the longest fitting rule decides. Other addresses are judged by their words.
Names like "freecasinobets" are split by Viterbi under a unigram model of words,
and a multinomial naive Bayes model scores the words of host and path.

Both models come from all pages, and all their counts are kept. The unigram counts
are those of the words in the pages' text and of names that hyphens already split.
The naive Bayes model learns from weak labels: an address counts as blocked if a
seed word stands alone in its host, split by dots, hyphens and digits. A seed is no evidence
for the label it made, so where it stands alone it is left out of the counts; each seed has
``PRIOR`` blocked hosts of its own instead. All other tokens are learnt: what stands next to
seeds blocks a host without one, and names that only contain a seed are judged by all their words.

Host and path are cut into runs of letters or of digits. Each distinct run is split
once: its parts that can be words are joined to the word counts, and the words found
in it to the token counts. Parts have ``SHORT`` + 1 to ``STEM`` letters; a longer word is found by its
first ``STEM`` and then looked for, so a run makes so many parts a letter, however long it is and
whatever words there are. Only words of at most ``SHORT`` letters, 18,278 of them,
are sent to tasks; the other joins move tables that are written before.

Defined results: a null address, or one without "://", has empty host and path, no
rule and no words, and is judged by the models' prior alone; without pages there
is nothing to judge. Repeated rows are judged one by one. ``page_id``, ``url`` and
``html`` are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import attach
from ..sources.workspace import written
from .workers import mapped

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]
RULES: list[Rule] = [("allow", "org", "/"), ("block", "example.org", "/es/"),
                     ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
                     ("block", "com", "/de/")]
#: Words that mark a host as unwanted where they stand alone in it.
SEEDS = ["adult", "ads", "bet", "bets", "betting", "bitcoin", "casino", "clickbait", "crack", "escort",
         "gambling", "jackpot", "keygen", "lottery", "malware", "nude", "payday", "phishing", "pills",
         "poker", "porn", "replica", "sex", "slots", "spam", "torrent", "tracker", "viagra", "warez", "xxx"]
#: Letters of words that every task gets, and of the parts that find longer ones.
SHORT, STEM = 3, 12
#: Candidate parts of runs in one batch; blocked hosts that a seed counts for.
BATCH, PRIOR = 50_000, 10

_SEPARATE = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The deciding rule, written host and path, and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


class Words:
    """Splits names into words by the most likely path; ``total`` is the sum of all counts."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = total or sum(counts.values()) or 1
        self.scores = {w: math.log(n / self.total) for w, n in counts.items()}
        self.lengths = sorted({len(w) for w in counts}, reverse=True)
        # An unknown word: ten of them, a tenth as likely with each further letter.
        self.first, self.step = math.log(10 / self.total), math.log(10)

    def split(self, name: str, counts: dict[str, int] | None = None) -> list[str]:
        """The words of a name; ``counts`` are those of further words in it, looked up beside the own ones."""
        own, more = self.scores, {w: math.log(n / self.total) for w, n in (counts or {}).items()}
        lengths = sorted({*self.lengths, *map(len, more)}, reverse=True) if more else self.lengths
        best, last = [0.0], [0]
        # An unknown word costs the same for each letter, so one start is the best for all ends after it.
        gain, begin = 0.0, 0
        for end in range(1, len(name) + 1):
            if best[end - 1] + (end - 1) * self.step >= gain:
                gain, begin = best[end - 1] + (end - 1) * self.step, end - 1
            score, start = best[begin] + self.first - (end - begin) * self.step, begin
            for n in lengths:
                if n <= end:
                    part = name[end - n:end]
                    found = own.get(part)
                    if found is None:
                        found = more.get(part)
                    if found is not None:
                        score, start = max((score, start), (best[end - n] + found, end - n))
            best.append(score)
            last.append(start)
        out, end = [], len(name)
        while end:
            out.append(name[last[end]:end])
            end = last[end]
        return out[::-1]


def runs(host: str, path: str) -> list[str]:
    """Runs of host and path, marked by where they stand; numbers are one run."""
    return [mark + ("0" if run[0].isdigit() else run)
            for mark, text in (("h:", host), ("p:", path.lower())) for run in _SEPARATE.findall(text)]


def _stands_alone(host: str, seeds: set[str]) -> bool:
    return not seeds.isdisjoint(re.findall("[a-z]+", host))


def word_counts(pages: DataFrame, seeds: list[str]) -> DataFrame:
    """(word, n) of all words of all pages, of names split by hyphens, and of the seeds, written."""
    text = F.split(F.translate(F.regexp_replace("html", "<[^>]*>", " "), UPPER, LOWER), "[^a-z]+")
    host, _ = host_and_path(F.col("url"))
    names = F.split(F.regexp_replace(host, r"(?<![^.])[^.-]+(?![^.])", ""), "[^a-z]+")
    words = pages.select(F.explode(F.concat(
        F.coalesce(text, F.array()), F.coalesce(names, F.array()))).alias("word")).where("word <> ''")
    marks = pages.sparkSession.createDataFrame([(s,) for s in seeds], "word string")
    return written(words.unionByName(marks).groupBy("word").agg(F.count("*").alias("n")), "words")


def address_runs(pages: DataFrame, seeds: list[str]) -> DataFrame:
    """(row, page_id, host, path, blocked, runs) of every page, written, so that ``row`` stays."""
    marks = set(seeds)
    schema = pa.schema([("row", pa.int64()), ("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("blocked", pa.bool_()), ("runs", pa.list_(pa.string()))])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_stands_alone(h, marks) for h in hosts], pa.bool_()),
                 pa.array([runs(h, p) for h, p in zip(hosts, paths)], pa.list_(pa.string()))], schema=schema)

    host, path = host_and_path(F.col("url"))
    return written(mapped(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long"), host.alias("host"), path.alias("path")),
        cut, "row long, page_id long, host string, path string, blocked boolean, runs array<string>"), "addresses")


def splits(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words) of distinct names, written; words: (word, n)."""
    spark = names.sparkSession
    total = words.agg(F.sum("n").alias("total")).first()["total"]
    short = {r["word"]: r["n"] for r in words.where(F.length("word") <= SHORT).collect()}
    sent = spark.sparkContext.broadcast((short, total))
    named = written(names.select(F.monotonically_increasing_id().alias("id"), "name"), "names")
    part_schema = pa.schema([("id", pa.int64()), ("part", pa.string())])
    split_schema = pa.schema([("name", pa.string()), ("words", pa.list_(pa.string()))])

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[tuple[int, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found), part_schema)], schema=part_schema)

        found: list[tuple[int, str]] = []
        for batch in batches:
            for number, name in zip(batch["id"].to_pylist(), batch["name"].to_pylist()):
                for n in range(SHORT + 1, STEM + 1) if name.isascii() else ():
                    # In blocks, so that a very long name holds no set of all its parts.
                    for at in range(0, len(name) - n + 1, BATCH):
                        found += [(number, part) for part in {
                            name[k:k + n] for k in range(at, min(at + BATCH, len(name) - n + 1))}]
                        if len(found) >= BATCH:
                            yield batch_of(found)
                            found = []
        if found:
            yield batch_of(found)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Words(*sent.value)
        for batch in batches:
            out = [model.split(name, {f["word"]: f["n"] for f in found or [] if f["word"] in name})
                   for name, found in zip(batch["name"].to_pylist(), batch["found"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["name"], pa.array(out, pa.list_(pa.string()))],
                                             schema=split_schema)

    stems = words.where(F.length("word") > SHORT).select(F.substring("word", 1, STEM).alias("part"), "word", "n")
    found = mapped(named, parts, "id long, part string").join(stems, "part").groupBy("id").agg(
        F.collect_set(F.struct("word", "n")).alias("found"))
    return written(mapped(named.join(found, "id", "left").select("name", "found"),
                          split, "name string, words array<string>"), "splits")


def run_weights(addresses: DataFrame, words: DataFrame, seeds: list[str]) -> DataFrame:
    """(run, n, weight): how often a run occurs, and its tokens' log odds of blocked to allowed."""
    counted = written(addresses.select(F.explode("runs").alias("run"), "blocked").groupBy("run").agg(
        F.count_if("blocked").alias("bad"), F.count_if(~F.col("blocked")).alias("good"))
        .withColumn("name", F.expr("substring(run, 3)")), "runs")
    cut = splits(counted.select("name").distinct(), words)
    placed = written(counted.join(cut, "name").select("run", "name", "bad", "good", F.posexplode("words").alias("at", "word"))
                     .withColumn("token", F.concat(F.substring("run", 1, 2), "word")).drop("word"), "placed")
    # A seed that stands alone made the label it would be counted with.
    marks = addresses.sparkSession.createDataFrame([(f"h:{s}", s) for s in sorted(set(seeds))], "own string, mark string")
    learnt = placed.join(F.broadcast(marks), F.col("run") == F.col("own"), "left_anti").select("token", "bad", "good")
    # Seeds that occur nowhere would only make all other words of blocked hosts less likely.
    given = placed.select("token").distinct().join(F.broadcast(marks), F.col("token") == F.col("own"), "left_semi").select(
        "token", F.lit(PRIOR).cast("long").alias("bad"), F.lit(0).cast("long").alias("good"))
    every = learnt.unionByName(given).unionByName(placed.select("token", F.lit(0).cast("long").alias("bad"),
                                                                F.lit(0).cast("long").alias("good")).distinct())
    tokens = written(every.groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "tokens")
    of_all = tokens.agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    bad, good = ((of_all[c] or 0) + of_all["n"] for c in ("bad", "good"))
    odds = tokens.select("token", (F.log((F.col("bad") + 1) / bad) - F.log((F.col("good") + 1) / good)).alias("odds"))
    return placed.join(odds, "token").groupBy("run").agg(
        F.first(F.col("bad") + F.col("good")).alias("n"), _in_order("at", "odds").alias("weight"))


def _in_order(at: str, value: str) -> Column:
    """The sum of a group's values, added in one order on every run."""
    listed = F.array_sort(F.collect_list(F.struct(at, value)))
    return F.aggregate(listed, F.lit(0.0), lambda total, x: total + x[value])


def judge(pages: DataFrame, rules: list[Rule] = RULES, seeds: list[str] = SEEDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page; the score is the log odds of blocking."""
    addresses = address_runs(pages, seeds)
    weights = run_weights(addresses, word_counts(pages, seeds), seeds)
    of_all = addresses.agg(F.count_if("blocked").alias("bad"), F.count_if(~F.col("blocked")).alias("good")).first()
    prior = math.log((of_all["bad"] + 1) / (of_all["good"] + 1))
    weighed = attach(addresses.select("row", F.posexplode("runs").alias("at", "run")), weights,
                     "run", "weight", "n", F.struct("row", "at"))
    scores = weighed.groupBy("row").agg(_in_order("at", "weight").alias("sum"))
    rows = addresses.join(scores, "row", "left").withColumn("score", F.lit(prior) + F.coalesce("sum", F.lit(0.0)))
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    by_words = F.when(F.col("score") >= 0, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, by_words).alias("verdict"), "score")
