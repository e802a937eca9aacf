"""Prepared totals for pages with filters: a lattice of cells beside the star.

A level holds, for every combination of its attributes, what adds up (sums, lines) and what
merges: HyperLogLog sketches of the orders and of the customers. Cells of finer levels give
those of coarser ones, so the facts are read once for each of the finest. ``with_cells`` gives a star
that ``measures.evaluate`` answers from the smallest level that covers the attributes of ``by`` and
``where``, and from the facts if none does; every report over the star profits.

Sums are those of the facts. Distinct counts stay exact unless sketches are asked for: a
cell counts the orders that lie in it alone, and the others, which cross cells, are kept by
id in a table of their own; so the orders of any choice of cells are a sum and the distinct
crossing ones. Customers are counted over the cells of the level that holds their ids.
With ``approximate`` both come from the union of sketches, within ``ERROR`` of the exact count
in about two of three cases.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.workspace import COMPRESSION, written
from . import measures as M
from .star import Star, StarOnDemand

#: Bits of a sketch's bucket number, and its relative standard error.
BITS = 12
ERROR = 1.04 / (1 << BITS) ** 0.5

#: Level: its attributes; the page filters are in each of them.
FILTERS = ("year", "region", "category")
LEVELS: dict[str, tuple[str, ...]] = {
    "by_customer": (*FILTERS, "customer_id", "customer_name", "segment", "customer_tier"),
    "by_product": (*FILTERS, "product_name"),
    "by_city": (*FILTERS, "city"),
    "by_month": (*FILTERS, "quarter", "month", "year_month"),
    "by_band": (*FILTERS, "discount_band"),
    "by_segment": (*FILTERS, "segment"),
    "by_tier": (*FILTERS, "customer_tier"),
}
#: Levels made of another one's cells; the others are made of the facts.
MADE_OF = {"by_segment": "by_customer", "by_tier": "by_customer"}
#: All levels, those first that are the least work to make by themselves: without customers, then with few cells.
COARSEST = ("by_band", "by_city", "by_month", "by_segment", "by_tier", "by_product", "by_customer")

_SUMS = tuple(M._SUMS)
_ORDERS, _HIGH = "_n_orders", "_n_high_orders"
_AMOUNTS = ("sales", "profit", "quantity", "discount")


def _able(level: str, attributes: Sequence[str], counts: Sequence[str], approximate: bool) -> bool:
    """Whether the level can answer."""
    keys = LEVELS[level]
    return set(attributes) <= set(keys) and (approximate or "customers" not in counts or "customer_id" in keys)


@dataclass(frozen=True)
class Cells:
    """Written levels, the crossing orders of each, and their numbers of cells."""

    levels: dict[str, DataFrame]
    crossing: dict[str, DataFrame]
    sizes: dict[str, int]

    def covering(self, attributes: Sequence[str], counts: Sequence[str], approximate: bool) -> str | None:
        """The smallest level that can answer, or none."""
        found = [name for name in self.levels if _able(name, attributes, counts, approximate)]
        return min(found, key=lambda n: (self.sizes[n], n)) if found else None

    def evaluate(self, level: str, measures: Sequence[str], by: Sequence[str], where: M.Where,
                 approximate: bool = False) -> DataFrame:
        """As ``measures.evaluate``, from one level. Orders with a high discount have no sketch and stay exact."""
        chosen = [M.MEASURES[m] for m in measures]
        parts = list(dict.fromkeys(p for needs, _, _ in chosen for p in needs))
        counts = list(dict.fromkeys(c for _, needs, _ in chosen for c in needs))
        condition = M._condition(where)

        def picked(rows: DataFrame) -> DataFrame:
            return rows if condition is None else rows.where(condition)

        def sketched(name: str) -> bool:
            return approximate and f"_{name}_sketch" in self.levels[level].columns

        def count(name: str) -> Column:
            if sketched(name):
                return F.hll_sketch_estimate(F.hll_union_agg(f"_{name}_sketch"))
            return F.countDistinct("customer_id") if name == "customers" else F.sum(f"_n_{name}")

        found = picked(self.levels[level]).groupBy(*by).agg(
            F.count("*").alias("_cells"), *[F.sum(p).alias(p) for p in parts], *[count(c).alias(f"_n_{c}") for c in counts])
        if crossing := [c for c in counts if c != "customers" and not sketched(c)]:
            # Crossing orders are distinct per group; they have no cells and no sums of their own.
            each = picked(self.crossing[level]).groupBy(*by, "order_id").agg(F.max("_high").alias("_high"))
            test = {"orders": F.lit(True), "high_orders": F.col("_high") == 1}
            more = each.groupBy(*by).agg(*[F.count_if(test[c]).alias(f"_n_{c}") for c in crossing])
            found = found.unionByName(more, allowMissingColumns=True).groupBy(*by).agg(
                *[F.sum(c).alias(c) for c in found.columns if c not in by])
        found = found.withColumns({f"_n_{c}": F.coalesce(f"_n_{c}", F.lit(0).cast("long")) for c in counts})
        return found.select(*by, *[e().alias(m) for m, (_, _, e) in zip(measures, chosen)])


@dataclass(frozen=True)
class PreparedStar(Star):
    """A star that is answered from cells where they suffice."""

    cells: Cells
    approximate: bool = False

    def answered(self, measures: Sequence[str], by: Sequence[str], where: M.Where) -> DataFrame | None:
        counts = [c for m in measures for c in M.MEASURES[m][1]]
        level = self.cells.covering([*by, *where], counts, self.approximate)
        return None if level is None else self.cells.evaluate(level, measures, by, where, self.approximate)


#: What a level adds up, and what it counts.
_COUNTED = (*_SUMS, "orders", "high_orders", "customers")


def _attributed(star: Star, level: str, facts: DataFrame | None = None, of: Sequence[str] = _COUNTED) -> DataFrame:
    keys = [k for k in LEVELS[level] if k != "customer_id"]
    star = star if facts is None else star.with_facts(facts)
    return M._attributed(star, M._facts(star, keys, {}, of, each=True), keys, {})


def repeated_lines(star: Star) -> DataFrame:
    """What cells need of the lines of orders that have more than one. No other order can lie in several cells."""
    keys = [k for k, _ in M.DIMENSIONS.values() if k != "customer_id"]
    return _repeated(star.fact_sales, *keys, "order_id", "customer_id", "discount")


def _repeated(lines: DataFrame, *columns: str) -> DataFrame:
    """The columns of those lines whose order has another line."""
    ids = lines.where("order_id IS NOT NULL").groupBy("order_id").agg(F.count("*").alias("_lines"))
    ids = written(ids.where("_lines > 1").select(F.col("order_id").alias("_repeated")), "repeated-orders")
    return lines.select(*columns).join(ids, F.col("order_id") == F.col("_repeated"), "left_semi")


def _cells(star: Star, level: str, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of one level, and the orders that lie in several: one row a cell and order."""
    star = star.with_facts(star.fact_sales)  # read several times, so from the table
    return _counted(level, _attributed(star, level), _attributed(star, level, repeated))


def _counted(level: str, lines: DataFrame, repeated: DataFrame, sketches: bool = True) -> tuple[DataFrame, DataFrame]:
    """Cells and crossing orders from lines with their attributes.

    Lines go straight into partial sums and sketches, so a hot cell is a few rows when it moves, and each
    counts as an order. Only ``repeated`` lines are reduced to one row a cell and order, which takes
    its lines off again and, if the order lies in that cell alone, counts it there once.
    """
    keys = LEVELS[level]
    is_high = F.when(M._DISTINCT["high_orders"][1](), 1).otherwise(0)
    per_order = repeated.groupBy(*keys, "order_id").agg(
        F.count("*").alias("_lines"), F.sum(is_high).alias("_high_lines"), F.max(is_high).alias("_high"))
    # The lines lie by order where they met the repeated ids, so the cells of an order are counted there.
    marked = written(per_order.withColumn("_in", F.count("*").over(W.partitionBy("order_id"))), "marked-orders", COMPRESSION)
    crosses = F.col("_in") > 1
    ids = ["order_id", "customer_id"] if sketches else ["order_id"]
    lines = lines.select(
        *dict.fromkeys([*keys, *ids]), *_AMOUNTS, F.col("order_id").isNotNull().cast("long").alias(_ORDERS),
        F.when(F.col("order_id").isNotNull(), is_high).otherwise(0).cast("long").alias(_HIGH))
    corrected = marked.select(
        *keys, (F.when(crosses, 0).otherwise(1) - F.col("_lines")).cast("long").alias(_ORDERS),
        (F.when(crosses, 0).otherwise(F.col("_high")) - F.col("_high_lines")).cast("long").alias(_HIGH))
    cells = lines.unionByName(corrected, allowMissingColumns=True).groupBy(*keys).agg(
        *[M._SUMS[p]().alias(p) for p in _SUMS], F.sum(_ORDERS).alias(_ORDERS), F.sum(_HIGH).alias(_HIGH),
        *([F.hll_sketch_agg(f"{c[:-1]}_id", BITS).alias(f"_{c}_sketch") for c in ("orders", "customers")] if sketches else []))
    return cells, marked.where(crosses).select(*keys, "order_id", "_high")


def _coarser(cells: DataFrame, level: str) -> DataFrame:
    added = [*_SUMS, _ORDERS, _HIGH]
    return cells.groupBy(*LEVELS[level]).agg(
        *[F.sum(c).alias(c) for c in added],
        *[F.hll_union_agg(c).alias(c) for c in ("_orders_sketch", "_customers_sketch")])


def _put(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return rows.sparkSession.read.parquet(path)


def write_cells(star: Star, folder: str) -> Cells:
    """Write all levels; the finest read the facts, the others the cells they are made of."""
    spark = star.fact_sales.sparkSession
    repeated = written(repeated_lines(star), "repeated-lines")
    made: dict[str, DataFrame] = {}
    for name in LEVELS:
        source = MADE_OF.get(name)
        if source is None:
            cells, crossing = _cells(star, name, repeated)
            _put(crossing, f"{folder}/{name}_crossing")
        else:
            cells = _coarser(made[source], name)
        made[name] = _put(cells, f"{folder}/{name}")
    _put(spark.createDataFrame([(n, table.count()) for n, table in made.items()], "level string, cells long"),
         f"{folder}/levels")
    return read_cells(spark, folder)


def write_level(star: Star, level: str, folder: str, sketches: bool = True,
                keep: Callable[[], bool] = lambda: True) -> None:
    """Write one level, with its crossing orders, from the facts; without ``sketches`` its counts are exact only.

    Lines are read three times. To ``keep`` them, which is asked when they are planned, they get the level's attributes once and
    are written with them. That is not needed where they lie in a file with all that their attributes are made of.
    """
    keys = LEVELS[level]
    ids = ["order_id", "customer_id"] if sketches else ["order_id"]
    lines = _attributed(star, level, of=[c for c in _COUNTED if sketches or c != "customers" or "customer_id" in keys])
    lines = lines.select(*dict.fromkeys([*keys, *ids]), *_AMOUNTS)
    if keep():
        lines = written(lines, "lines-of-cells", COMPRESSION)
    cells, crossing = _counted(level, lines, _repeated(lines, *keys, "order_id", "discount"), sketches)
    _put(crossing, f"{folder}/{level}_crossing")
    _put(cells, f"{folder}/{level}")


def write_sums(star: Star, level: str, folder: str) -> None:
    """Write one level without its counts: what a page needs that names none. The facts are read once."""
    keys = LEVELS[level]
    _put(_attributed(star, level, of=_SUMS).groupBy(*keys).agg(*[M._SUMS[p]().alias(p) for p in _SUMS]), f"{folder}/{level}")


def read_cells(spark: SparkSession, folder: str) -> Cells:
    sizes = {r["level"]: r["cells"] for r in spark.read.parquet(f"{folder}/levels").collect()}  # one a level
    return Cells({n: spark.read.parquet(f"{folder}/{n}") for n in sizes},
                 {n: spark.read.parquet(f"{folder}/{MADE_OF.get(n, n)}_crossing") for n in sizes}, sizes)


@dataclass(frozen=True)
class CellsOnDemand(Cells):
    """Levels that are written when the first page asks for them: ``make`` gives a level's folder.

    ``make_sums``, if given, does so for pages without a distinct count; such a level holds the sums alone. ``make_exact``,
    if given, does so for pages whose counts are to be exact; such a level holds no sketches.

    Which level answers is decided before its size is known: the first that covers in the order of
    ``COARSEST``. Cells of any covering level give the same figures.
    """

    make: Callable[[str], str]
    make_sums: Callable[[str], str] | None = None
    make_exact: Callable[[str], str] | None = None

    def covering(self, attributes: Sequence[str], counts: Sequence[str], approximate: bool) -> str | None:
        return next((n for n in COARSEST if _able(n, attributes, counts, approximate)), None)

    def evaluate(self, level: str, measures: Sequence[str], by: Sequence[str], where: M.Where,
                 approximate: bool = False) -> DataFrame:
        spark = SparkSession.active()
        if self.make_sums and not any(M.MEASURES[m][1] for m in measures):
            folder, crossing = self.make_sums(level), {}
        else:
            folder = (self.make if approximate or not self.make_exact else self.make_exact)(level)
            crossing = {level: spark.read.parquet(f"{folder}/{level}_crossing")}
        own = Cells({level: spark.read.parquet(f"{folder}/{level}")}, crossing, {})
        return own.evaluate(level, measures, by, where, approximate)


def on_demand(make: Callable[[str], str], make_sums: Callable[[str], str] | None = None,
              make_exact: Callable[[str], str] | None = None) -> CellsOnDemand:
    return CellsOnDemand({}, {}, {}, make, make_sums, make_exact)


@dataclass(frozen=True)
class PreparedOnDemand(StarOnDemand):
    """A star on demand that is answered from cells where they suffice."""

    cells: Cells
    approximate: bool = False

    answered = PreparedStar.answered


def with_cells(star: Star, cells: Cells, approximate: bool = False) -> PreparedStar:
    if isinstance(star, StarOnDemand):
        return PreparedOnDemand(star.table, cells, approximate, lines=star.lines, attributes=star.attributes)
    return PreparedStar(*[getattr(star, f.name) for f in fields(Star)], cells=cells, approximate=approximate)


def distinct_by_day(star: Star) -> DataFrame:
    """(date_key, geo_id, orders, customers): sketches per day and place, written.

    There are as many states as days times places, however many orders there are. Any choice of days
    and places is a union of them.
    """
    return written(star.facts(["date_key", "geo_id"], ["order_id", "customer_id"]).groupBy("date_key", "geo_id").agg(
        F.hll_sketch_agg("order_id", BITS).alias("orders"), F.hll_sketch_agg("customer_id", BITS).alias("customers")),
        "day-sketches")


def approximate_counts(star: Star, states: DataFrame, by: Sequence[str] = (), where: M.Where | None = None) -> DataFrame:
    """(by..., total_orders, total_customers) from the states of ``distinct_by_day``.

    Attributes are those of dates and places; others are not in the states and raise.
    """
    where = dict(where or {})
    for d in M._needed([*by, *where]):
        if d not in ("dim_date", "dim_geography"):
            raise ValueError(f"the states are not by {d}")
    if own := [c for c in (*by, *where) if c in M.FACT_ATTRIBUTES]:
        raise ValueError(f"the states are not by {own}")
    lines = M._attributed(star, states, by, where)
    return lines.groupBy(*by).agg(*[
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("long")).alias(f"total_{c}")
        for c in ("orders", "customers")])
