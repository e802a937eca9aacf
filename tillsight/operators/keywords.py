"""Topics of texts from a table of keywords.

A keyword counts where the lower-cased text contains it. Up to ``FEW`` keywords a text is searched for
the guard words that they share, and for a keyword only where its guard occurs; it does not move and is
not multiplied. Of more keywords, each is indexed under one of its
trigrams, the one that fewest keywords have; keywords of one or two characters under
themselves. A text looks up the trigrams it has, which finds all keywords it may contain, and
only these are searched for. The cost of a text grows with its length and the keywords that
nearly occur, not with the number of keywords, and the plan stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.questions import _guards as guards
from ..sources.workspace import written

GRAM = 3
#: Keywords whose index is sent to all tasks; beyond that it is joined by a shuffle.
BROADCAST = 200_000
#: Pairs of topic and keyword whose guards are searched for one by one, which takes less than a text's trigrams do.
FEW = 1_000


def _grams(characters: Column, size: int) -> Column:
    """All strings of so many characters, in order."""
    places = F.sequence(F.lit(0), F.size(characters) - size)
    parts = [lambda i, k=k: F.get(characters, i + k) for k in range(size)]
    return F.when(F.size(characters) >= size, F.transform(
        places, lambda i: F.concat(*[p(i) for p in parts]))).otherwise(F.array().cast("array<string>"))


def _distinct(keywords: DataFrame) -> DataFrame:
    return keywords.where("keyword IS NOT NULL AND keyword <> ''").select("topic", F.lower("keyword").alias("keyword")).distinct()


def index(keywords: DataFrame) -> DataFrame:
    """(gram, topic, keyword), written: every distinct keyword of (topic, keyword) under its rarest gram."""
    own = _distinct(keywords)
    characters = F.split("keyword", "")
    held = own.select("keyword").distinct().select("keyword", F.explode(F.array_distinct(
        F.when(F.length("keyword") >= GRAM, _grams(characters, GRAM)).otherwise(F.array("keyword")))).alias("gram"))
    rarity = held.groupBy("gram").agg(F.count("*").alias("n"))
    chosen = held.join(rarity, "gram").groupBy("keyword").agg(F.min(F.struct("n", "gram")).alias("best")).select(
        "keyword", F.col("best.gram").alias("gram"))
    return written(own.join(chosen, "keyword").select("gram", "topic", "keyword"), "keyword-index")


def _searched(texts: DataFrame, key: str, few: list[tuple], kind: T.DataType, text: str) -> DataFrame:
    """``scores`` by searching every text for the guards of a few (topic, keyword)."""
    topics: dict[str, list] = {}
    for topic, keyword in few:
        topics.setdefault(keyword, []).append(topic)
    guarded: dict[str, list] = {}
    for keyword, guard in guards({"": list(topics)}).items():
        guarded.setdefault(guard, []).append((keyword, topics[keyword]))
    member = T.StructType().add("keyword", "string").add("topics", T.ArrayType(kind))
    schema = T.StructType().add("groups", T.ArrayType(T.StructType().add("guard", "string").add("members", T.ArrayType(member))))
    groups = texts.sparkSession.createDataFrame([(sorted(guarded.items(), key=lambda g: g[0]),)], schema).scalar()
    lowered = F.col("_lowered")
    held = F.flatten(F.transform(
        F.filter("_groups", lambda g: lowered.contains(g["guard"])),
        lambda g: F.flatten(F.transform(F.filter(g["members"], lambda m: lowered.contains(m["keyword"])), lambda m: m["topics"]))))
    found = texts.select(F.col(key), F.lower(F.col(text)).alias("_lowered"), groups.alias("_groups")).where(
        "_lowered IS NOT NULL").select(key, held.alias("_held"))
    counted = F.transform(F.array_distinct("_held"), lambda t: F.struct(
        t.alias("intent"), F.size(F.filter("_held", lambda h: h.eqNullSafe(t))).alias("score")))
    return found.select(key, F.inline(counted))


def scores(texts: DataFrame, key: str, keywords: DataFrame, text: str = "text", broadcast: int = BROADCAST,
           few: int = FEW) -> DataFrame:
    """(key, intent, score) for every topic with a keyword in the text: as many as it contains.

    Rows of one key are texts of their own. Texts are looked up where they are; of more than ``few`` keywords
    only the topics found in them are dealt out.
    """
    listed = _distinct(keywords).limit(few + 1).collect()  # few
    if len(listed) <= few:
        return _searched(texts, key, [tuple(r) for r in listed], keywords.schema["topic"].dataType, text)
    found = index(keywords)
    many = found.count()
    sizes = sorted(r[0] for r in found.select(F.length("gram")).distinct().collect())  # 1 to GRAM
    characters = F.split("_lowered", "")
    lowered = texts.select(F.col(key), F.lower(F.col(text)).alias("_lowered")).where("_lowered IS NOT NULL").withColumns({
        "_row": F.monotonically_increasing_id(), "_characters": characters})
    grams = F.array_distinct(F.concat(*[_grams(F.col("_characters"), n) for n in sizes])) if sizes else F.array().cast("array<string>")
    had = lowered.select(key, "_row", "_lowered", grams.alias("_grams"))
    if many <= broadcast:
        # The grams of the index: a text keeps those it shares before it is multiplied.
        known = found.agg(F.coalesce(F.collect_set("gram"), F.array().cast("array<string>"))).scalar()
        had = had.withColumn("_grams", F.array_intersect("_grams", known))
        found = F.broadcast(found)
    near = had.select(key, "_row", "_lowered", F.explode("_grams").alias("gram")).join(found, "gram")
    hits = near.where(F.col("_lowered").contains(F.col("keyword")))
    return hits.groupBy("_row", key, "topic").agg(F.count("*").cast("int").alias("score")).select(
        key, F.col("topic").alias("intent"), "score")


def tagged(texts: DataFrame, key: str, keywords: DataFrame, priority: DataFrame, text: str = "text",
           unknown: str = "unknown") -> DataFrame:
    """(key, intent): the topic of the highest score, of equal ones the first by (topic, place); keys are distinct."""
    best = scores(texts, key, keywords, text).join(priority, F.col("intent") == F.col("topic")).groupBy(key).agg(
        F.min(F.struct(-F.col("score"), "place", "intent")).alias("best")).select(
        F.col(key).alias("_key"), F.col("best.intent").alias("intent"))
    return texts.select(key).join(best, F.col(key) == F.col("_key"), "left").select(
        key, F.coalesce("intent", F.lit(unknown)).alias("intent"))
