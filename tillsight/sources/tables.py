"""Orders derived from the supplied order-line tables.

Line items are joined to their orders, customers, nations, regions and parts;
each row is one order of the sales model. Orders meet customers before the
four times larger line items, and these meet their parts first, so the wide side moves once per large key
and its first move is narrow; lines of an order then lie together, which keeps what is made of them small. The
names of nation and region, a handful of rows, come last, so no row carries
them through a shuffle. No broadcast is forced: table sizes are known from the files and the optimizer
broadcasts what is below its limit.

Amounts are computed as whole hundredths, which is exact and stays in
generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import half_up
from ..functions.questions import TOPICS

# Share of sales kept as profit before discount, in percent, by part type.
BASE_MARGIN = {"ECONOMY": 20, "STANDARD": 30, "SMALL": 35,
               "MEDIUM": 40, "LARGE": 45, "PROMO": 50}


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; its schema is read from the files once per application."""
    path = f"{folder}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def sales_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The 17 raw order columns."""
    places = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    buyers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("ordered"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    )
    lines = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                (F.rint(F.col("l_discount") * 100).cast("long") * 4).alias("disc_u"),
                F.rint(F.col("l_tax") * 100).cast("long").alias("tax_u"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    margin = F.create_map(*[F.lit(x) for pair in BASE_MARGIN.items() for x in pair])
    sized = lines.select(
        "*",
        F.rint(F.col("l_extendedprice") * 100).cast("long").alias("list_u"),
        margin[F.col("p_type")].alias("base_u"),
    )
    sized = sized.withColumn("sales_u", half_up("list_u * (100 - disc_u)", "100"))
    # hundredths x percent x thousandths = 1e-7; list price x tax is 1e-4.
    sized = sized.withColumn("profit_u", half_up(
        "sales_u * base_u * (1000 - 18 * disc_u) - list_u * tax_u * 1000", "100000"))
    shared_name = F.when((F.col("c_custkey") % 7 == 0) & (F.col("c_custkey") > 0), 1).otherwise(0)
    return sized.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("ordered").alias("order_date"),
        F.date_add("ordered", F.col("l_linenumber")).alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("Customer#"), (F.col("c_custkey") - shared_name).cast("string"))
        .alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string"))
        .alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("disc_u") / 100).alias("discount"),
        (F.col("sales_u") / 100).alias("sales"),
        (F.col("profit_u") / 100).alias("profit"),
        (F.when(F.col("sales_u") > 0, half_up("profit_u * 10000", "sales_u"))
         .otherwise(0) / 100).alias("profit_margin"),
    )


#: Child table and key, parent table and key: the joins of ``sales_raw``.
PARENTS = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
           ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
           ("nation", "n_regionkey", "region", "r_regionkey")]


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    """(child, parent, missing): rows without their parent, which ``sales_raw`` leaves out.

    Keys are counted before they are looked up, so a hot or missing key is one row.
    """
    found = None
    for child, key, parent, own in PARENTS:
        keys = table(spark, folder, child).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
        lost = keys.join(table(spark, folder, parent).select(F.col(own).alias("k")), "k", "left_anti").agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("missing")).select(
            F.lit(child).alias("child"), F.lit(parent).alias("parent"), "missing")
        found = lost if found is None else found.unionByName(lost)
    return found


#: The words a made question asks about.
WORDS = [w for words in TOPICS.values() for w in words]


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """(id, text): a question from the number, segment and nation of every customer.

    One in three asks for a number of customers and two years; the others ask about one or two
    keywords that the number picks, so that all topics occur, and ties between them.
    """
    number, nation = F.col("c_custkey").cast("string"), (2000 + F.col("c_nationkey")).cast("string")
    words = F.array(*[F.lit(w) for w in WORDS])

    def word(step: int) -> Column:
        return F.get(words, (F.col("c_custkey") * step % len(WORDS)).cast("int"))

    top = F.concat(F.lit("Top "), number, F.lit(" customers of "), F.col("c_mktsegment"),
                   F.lit(" by profit in "), nation, F.lit(" and 2024"))
    one = F.concat(F.lit("Show me "), word(1), F.lit(" of "), F.col("c_mktsegment"))
    two = F.concat(F.initcap(word(1)), F.lit(" or "), word(7), F.lit(", top "), number)
    text = F.when(F.col("c_custkey") % 3 == 0, top).when(F.col("c_custkey") % 3 == 1, one).otherwise(two)
    return table(spark, folder, "customer").select(
        F.concat(F.lit("q"), number).alias("id"), text.alias("text"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(id, text) of every document and every conversation turn, in full."""
    documents = table(spark, folder, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    turns = table(spark, folder, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"),
                 F.col("turn").cast("string")).alias("id"), "text")
    return documents.unionByName(turns)
