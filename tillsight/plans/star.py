"""The star schema: four dimensions and the order facts.

Dimensions are written before the facts are built. The lookups of the fact
table then join against files of known size: the optimizer broadcasts a small
dimension and shuffles a large one, where adaptive execution splits a product
or place that holds a large share of the orders.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.exact import amount, sum_units0
from ..operators.ranking import numbered
from ..sources.files import write_csv
from ..sources.workspace import COMPRESSION

# Surrogate id formats and the festive quarter.
PRODUCT_ID = "PROD-%03d"
GEO_ID = "GEO-%03d"
FESTIVE_QUARTER = 4
# What the star needs of the clean table.
INPUT_COLUMNS = (
    "order_id", "order_date", "ship_mode", "customer_id", "customer_name", "segment", "region",
    "city", "category", "product_name", "quantity", "unit_price", "discount", "sales", "profit",
    "profit_margin", "days_to_ship", "customer_ltv", "customer_tier")
# Of the written facts, which may have no file to take it from.
FACT_SCHEMA = ("order_id string, date_key int, customer_id string, product_id string, geo_id string, ship_mode string, "
               "quantity int, unit_price double, discount double, sales double, profit double, profit_margin double, "
               "days_to_ship int, order_year int")
# Rows of one file of the facts.
FILE_ROWS = 20_000_000
FACT_COLUMNS = ("order_id", "date_key", "customer_id", "product_id", "geo_id", "ship_mode",
                "quantity", "unit_price", "discount", "sales", "profit", "profit_margin",
                "days_to_ship")
# What a line may get of its product besides the number.
PRODUCT_ATTRIBUTES = ("product_name", "category")
# Columns of the orders that a column of the facts is made of, where it is not one of them, that a table is made of, and
# that an attribute is made of which a line can have without its table.
FACTS_MADE_OF = {"date_key": ("order_date",), "product_id": ("product_name",), "geo_id": ("region", "city"),
                 "days_to_ship": ("order_date", "ship_date")}
TABLES_MADE_OF = {
    "dim_customer": ("customer_id", "customer_name", "segment", "region", "city", "order_date", "order_id", "sales"),
    "dim_product": ("product_name", "category", "order_date", "unit_price"),
    "dim_geography": ("region", "city"), "dim_date": ("order_date",)}
DAY_ATTRIBUTES = ("date", "year", "quarter", "quarter_name", "month", "month_name", "month_short", "year_month", "week", "day",
                  "day_name", "is_weekend", "is_festive_q")
ATTRIBUTES_MADE_OF = {
    "product_name": ("product_name",), "category": ("product_name", "category", "order_date"),
    "region": ("region", "city"), "city": ("region", "city"), **dict.fromkeys(DAY_ATTRIBUTES, ("order_date",))}


def _earliest(name: str) -> Column:
    """The earliest value present; of values first seen on one day, the smallest."""
    return F.min_by(name, F.when(F.col(name).isNotNull(), F.struct("_seen", name)))


def dim_customer(sales: DataFrame) -> DataFrame:
    """One row per customer, with its earliest attributes.

    Orders are first reduced to the distinct attribute sets of each customer
    (usually one), so the choice of the earliest never sees single orders.
    """
    attributes = ("customer_name", "segment", "customer_tier", "customer_ltv", "region", "city")
    seen = (
        sales.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", *attributes)
        .agg(F.min("order_date").alias("_seen"), F.count("order_id").alias("_orders"))
    )
    return (
        seen.groupBy("customer_id")
        .agg(*[_earliest(a).alias(a) for a in attributes],
             F.sum("_orders").alias("total_orders"))
        .withColumnsRenamed({"region": "home_region", "city": "home_city"})
        .select("customer_id", "customer_name", "segment", "customer_tier", "customer_ltv",
                "home_region", "home_city", "total_orders")
    )


def dim_customer_of_orders(orders: DataFrame, tier_limits: Sequence[float | None] = bands.TIER_LIMITS) -> DataFrame:
    """``dim_customer`` from orders that do not carry their customer's value.

    A customer has one value, and it is the sum of those of its attribute sets. So orders are reduced to
    these before anything is added up by customer, and no order is given a value or moves for it.
    """
    sets = orders.where(F.col("customer_id").isNotNull()).groupBy(
        "customer_id", "customer_name", "segment", "region", "city").agg(
        F.min("order_date").alias("_seen"), F.count("order_id").alias("_orders"), sum_units0("sales").alias("_u"))
    customers = sets.groupBy("customer_id").agg(
        *[_earliest(a).alias(a) for a in ("customer_name", "segment", "region", "city")],
        amount(F.sum("_u")).alias("customer_ltv"), F.sum("_orders").alias("total_orders"))
    return customers.withColumn("customer_tier", bands.customer_tier(limits=tier_limits)).select(
        "customer_id", "customer_name", "segment", "customer_tier", "customer_ltv",
        F.col("region").alias("home_region"), F.col("city").alias("home_city"), "total_orders")


def dim_product(sales: DataFrame) -> DataFrame:
    """One row per product, numbered by name."""
    seen = (
        sales.where(F.col("product_name").isNotNull())
        .groupBy("product_name", "category")
        .agg(F.min("order_date").alias("_seen"), F.sum(F.col("unit_price").cast("decimal(28,10)")).alias("_price"),
             F.count("unit_price").alias("_n"))
    )
    products = seen.groupBy("product_name").agg(
        _earliest("category").alias("category"),
        F.round(F.try_divide(F.sum("_price").cast("double"), F.sum("_n").cast("double")), 2).alias("avg_unit_price"))
    return numbered(products, "product_name", into="_no").select(
        F.format_string(PRODUCT_ID, "_no").alias("product_id"), "product_name", "category",
        "avg_unit_price")


def dim_geography(sales: DataFrame) -> DataFrame:
    """One row per region and city, numbered in that order."""
    places = (sales.dropna(subset=["region", "city"]).groupBy("region", "city")
              .agg(F.count("*").alias("order_count")))
    return numbered(places, "region", "city", into="_no").select(
        F.format_string(GEO_ID, "_no").alias("geo_id"), "region", "city", "order_count")


def dim_date(sales: DataFrame) -> DataFrame:
    """Every calendar day from the first order to the last."""
    span = sales.agg(F.min("order_date").alias("_from"), F.max("order_date").alias("_to"))
    days = span.where(F.col("_from").isNotNull()).select(
        F.explode(F.sequence("_from", "_to", F.expr("interval 1 day"))).alias("date"))
    of_day = _of_day("date")
    return days.select(
        "date", F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        *[of_day[a].alias(a) for a in DAY_ATTRIBUTES if a != "date"])


def _of_day(day: str) -> dict[str, Column]:
    """The attributes of a day."""
    quarter = F.quarter(day)
    return {
        "date": F.col(day),
        "year": F.year(day),
        "quarter": quarter,
        "quarter_name": F.concat(F.lit("Q"), quarter.cast("string")),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_short": F.date_format(day, "MMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "week": F.weekofyear(day),
        "day": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.weekday(day) >= 5,
        "is_festive_q": quarter == FESTIVE_QUARTER,
    }


def mixed_products(orders: DataFrame) -> DataFrame:
    """(_mixed, _category): products whose orders name more than one category, none counted as one, and that of ``dim_product``."""
    seen = orders.where(F.col("product_name").isNotNull()).groupBy("product_name", "category").agg(
        F.min("order_date").alias("_seen"))
    return seen.groupBy("product_name").agg(
        _earliest("category").alias("_category"), F.count("*").alias("_categories")).where("_categories > 1").select(
        F.col("product_name").alias("_mixed"), "_category")


def with_attributes(orders: DataFrame, named: Collection[str], mixed: DataFrame | None = None) -> DataFrame:
    """Orders with these attributes of their product, place and day, as the tables of the star made of them give them.

    Names of products and places and the parts of a day are an order's own; an order that lacks the region or the city
    has no place. The category of a product is that of any order of it, but for the ``mixed`` products, which are looked
    up. So an order moves only where there are more of these than can be broadcast.
    """
    placed = F.col("region").isNotNull() & F.col("city").isNotNull()
    found = {**{c: F.when(placed, F.col(c)) for c in ("region", "city")}, **_of_day("order_date"),
             "category": F.when(F.col("product_name").isNotNull(), F.col("category"))}
    if mixed is not None and "category" in named:
        orders = orders.join(mixed, F.col("product_name") == F.col("_mixed"), "left")
        found["category"] = F.when(F.col("_mixed").isNotNull(), F.col("_category")).otherwise(found["category"])
    return orders.withColumns({c: found[c] for c in named if c in found})


def fact_sales(sales: DataFrame, products: DataFrame | None, places: DataFrame | None,
               wanted: Collection[str] = FACT_COLUMNS, own: Sequence[str] = ()) -> DataFrame:
    """Orders with surrogate keys; an unknown product or place gets NULL.

    Places are few, so theirs are looked up first: the rows that move to a large table of
    products hold a place's id and a day's number instead of names and dates. Without one of the
    tables its key is not looked up, and the facts lack that column. They have the ``wanted`` columns only,
    and ``sales`` needs no more than these are made of. Attributes of products that are wanted come from the
    same lookup as their number, but for the ``own`` attributes, which ``sales`` holds and the facts keep.
    """
    facts = sales
    if "date_key" in wanted:
        facts = facts.withColumn("date_key", F.date_format("order_date", "yyyyMMdd").cast("int"))
    columns = [c for c in FACT_COLUMNS
               if c in wanted and not (c == "product_id" and products is None or c == "geo_id" and places is None)]
    columns += own
    if places is not None:
        facts = facts.join(places.select("region", "city", "geo_id"), ["region", "city"], "left")
    if products is not None:
        attributes = [c for c in PRODUCT_ATTRIBUTES if c in wanted and c not in own]
        found = products.select(F.col("product_name").alias("_name"), "product_id", *attributes)
        facts = facts.select(F.col("product_name").alias("_sold"), *[c for c in columns if c != "product_id"]).join(
            found, F.col("_sold") == F.col("_name"), "left")
        columns += attributes
    return facts.select(*columns)


@dataclass(frozen=True)
class Star:
    fact_sales: DataFrame  # with order_year, the column it is partitioned by, where it was written
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_geography: DataFrame
    dim_date: DataFrame

    attributes = ()  # that facts with a choice of columns hold without their key

    def facts(self, keys: Collection[str], columns: Collection[str] | None = None) -> DataFrame:
        """The facts, with these foreign keys and other columns (without: all) at least.

        Columns may be among ``attributes``. They may be others of products; the facts hold these or not.
        """
        return self.fact_sales

    def with_facts(self, facts: DataFrame) -> Star:
        return replace(self, fact_sales=facts)


TABLES = ("fact_sales", "dim_customer", "dim_product", "dim_geography", "dim_date")


@dataclass(frozen=True)
class StarOnDemand:
    """A star whose tables are made when they are first asked for.

    A report that names no attribute of customers makes no table of customers, nor the customer
    value that it needs. ``lines``, if given, gives the facts with the foreign keys and columns it is given: a
    report that reads them once looks up only the keys it names, and moves only its own columns. The columns may be
    ``attributes``, whose tables are then not looked up.
    ``fact_sales`` is the whole table, for those who read it more than once.
    """

    table: Callable[[str], DataFrame]
    lines: Callable[[Collection[str], Collection[str] | None], DataFrame] | None = field(default=None, kw_only=True)
    attributes: Collection[str] = field(default=(), kw_only=True)

    @property
    def fact_sales(self) -> DataFrame:
        return self.table("fact_sales")

    @property
    def dim_customer(self) -> DataFrame:
        return self.table("dim_customer")

    @property
    def dim_product(self) -> DataFrame:
        return self.table("dim_product")

    @property
    def dim_geography(self) -> DataFrame:
        return self.table("dim_geography")

    @property
    def dim_date(self) -> DataFrame:
        return self.table("dim_date")

    def facts(self, keys: Collection[str], columns: Collection[str] | None = None) -> DataFrame:
        return self.fact_sales if self.lines is None else self.lines(keys, columns)

    def with_facts(self, facts: DataFrame) -> StarOnDemand:
        return replace(self, table=lambda name: facts if name == "fact_sales" else self.table(name), lines=None,
                       attributes=())


def with_order_year(facts: DataFrame) -> DataFrame:
    return facts.withColumn("order_year", F.floor(F.col("date_key") / 10_000).cast("int"))


def write_table(name: str, rows: DataFrame, path: str) -> DataFrame:
    """Write one table of the star."""
    writer = rows.write
    if name == "fact_sales":
        # By year, so that a filter on dates, also one found while the query runs, reads the
        # folders of its years, and by date in each file, so that it reads parts of them. Rows
        # stay in the tasks that the lookups left them in: they do not move for the layout.
        writer = (with_order_year(rows).sortWithinPartitions("order_year", "date_key")
                  .write.partitionBy("order_year").option("maxRecordsPerFile", FILE_ROWS))
    writer.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(path) if name == "fact_sales" else spark.read.parquet(path)


def write_star(sales: DataFrame, folder: str, flat: bool = True) -> Star:
    """Write the five star tables, and the flat copy if wanted, as Parquet.

    Each table is a pass over ``sales`` with the columns it needs, so give the
    written clean table rather than a long plan.
    """
    def put(name: str, rows: DataFrame) -> DataFrame:
        return write_table(name, rows, f"{folder}/{name}")

    put("dim_customer", dim_customer(sales))
    products = put("dim_product", dim_product(sales))
    places = put("dim_geography", dim_geography(sales))
    put("dim_date", dim_date(sales))
    put("fact_sales", fact_sales(sales, products, places))
    if flat:
        put("flat_sales", sales)
    return read_star(sales.sparkSession, folder)


def read_star(spark: SparkSession, folder: str) -> Star:
    return Star(*[read_table(spark, name, f"{folder}/{name}") for name in TABLES])


def write_star_csv(star: Star, folder: str, compression: str = "none") -> None:
    """The five tables as CSV with a header, each in a folder of its name."""
    for name in TABLES:
        rows = getattr(star, name)
        write_csv(rows.select(*FACT_COLUMNS) if name == "fact_sales" else rows, f"{folder}/{name}", compression=compression)

