"""Audit and cleaning of a raw table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import amount, sum_units0
from ..sources.schema import DATES
from ..sources.workspace import COMPRESSION, new_path, written

_FLOATS = (T.DoubleType, T.FloatType)


def _missing(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, _FLOATS):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def shape(rows: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return rows.agg(F.count("*").alias("rows"),
                    F.lit(len(rows.columns)).alias("columns"))


def sample_rows(rows: DataFrame, n: int = 5) -> DataFrame:
    return rows.limit(n)


def null_counts(rows: DataFrame) -> DataFrame:
    """(column, nulls) in one pass; NaN counts as missing."""
    counted = rows.agg(*[F.count_if(_missing(f)).alias(f.name) for f in rows.schema.fields])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"))
                      for c in rows.columns])
    return counted.select(F.inline(pairs))


#: Bits that say which digests occur twice: so many for each of these, the least (one map) and the most (32 MB) in all.
_ROOM, _LEAST, _MOST = 16, 1 << 15, 1 << 28


def _digest(rows: DataFrame, bits: int = 64) -> Column:
    """64 bits of a row, or fewer in tests: a hash of all columns and of which are missing."""
    missing = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in rows.columns])
    found = F.xxhash64(missing, *[F.col(f"`{c}`") for c in rows.columns])
    return found if bits == 64 else F.pmod(found, F.lit(1 << bits))


def _repeated(rows: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their digest, and the digests that occur twice or more, written.

    Only digests are dealt out. Copies meet before, in each task, so a hot row is one line a task.
    """
    keyed = rows.withColumn("_digest", _digest(rows, bits))
    counts = keyed.groupBy("_digest").agg(F.count("*").alias("_n")).where("_n > 1")
    return keyed, written(counts.select(F.col("_digest").alias("_twice")), "digests")


def _suspects(keyed: DataFrame, twice: DataFrame) -> DataFrame:
    """The rows whose digest's bit is set by a digest that occurs twice: all copies, and few others.

    The bits are sent to the tasks, so that the other rows stay where they are. There are at most ``_MOST``; beyond a
    sixteenth of them in digests more rows pass that need not.
    """
    size = _LEAST
    many = twice.count()
    while size < min(_ROOM * many, _MOST):
        size *= 2

    def place(digest: str) -> Column:
        return F.pmod(F.col(digest), F.lit(size)) + 1

    maps = twice.select(place("_twice").alias("_at")).groupBy(F.bitmap_bucket_number("_at").alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))
    at = F.bitmap_bit_position(place("_digest"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return keyed.join(F.broadcast(written(maps, "bits")), F.bitmap_bucket_number(place("_digest")) == F.col("_map")).where(
        F.getbit(byte, (at % 8).cast("int")) == 1).select(*keyed.columns)


def duplicate_count(rows: DataFrame, digest_bits: int = 64) -> DataFrame:
    """One row: how many rows repeat an earlier one in every column.

    Rows are compared as a whole where their digest may occur twice, so unequal rows of one digest
    are told apart and the others hardly ever move. ``rows`` are read twice.
    """
    suspects = _suspects(*_repeated(rows, digest_bits))
    copies = suspects.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count("*").alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0).cast("long")).alias("duplicate_rows"))


def drop_duplicates(rows: DataFrame, digest_bits: int = 64) -> DataFrame:
    """One of each group of equal rows.

    Whole rows are compared, so ``digest_bits``, which ``duplicate_count`` takes too, changes nothing here.
    Each row moves once and nothing is written on the way. Copies meet before, in each task, so a hot
    row is one line a task.
    """
    return rows.dropDuplicates()


def column_types(rows: DataFrame) -> DataFrame:
    """(column, type, present) of every column; ``present`` counts its values in one pass."""
    counted = rows.agg(*[F.count_if(~_missing(f)).alias(f.name) for f in rows.schema.fields])
    lines = F.array(*[F.struct(
        F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
        F.col(f"`{f.name}`").alias("present")) for f in rows.schema.fields])
    return counted.select(F.inline(lines))


def column_profile(rows: DataFrame) -> DataFrame:
    """(column_name, present, lowest, highest, total) of every column in one pass.

    Numbers are taken as whole ten-thousandths; texts, dates and truth values have no total.
    """
    def values(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.NumericType):
            return F.floor(F.col(f"`{field.name}`").cast("double") * 10_000 + 0.5).cast("long")
        return F.col(f"`{field.name}`").cast("string")

    names = [f"c{k}" for k in range(len(rows.columns))]
    cells = rows.select(*[values(f).alias(n) for f, n in zip(rows.schema.fields, names)])
    found = cells.agg(*[part for n, f in zip(names, rows.schema.fields) for part in (
        F.count(n).alias(f"{n}_n"), F.min(n).cast("string").alias(f"{n}_lo"), F.max(n).cast("string").alias(f"{n}_hi"),
        (F.sum(F.col(n).cast("decimal(38,0)")).cast("string") if isinstance(f.dataType, T.NumericType)
         else F.lit(None).cast("string")).alias(f"{n}_sum"))])
    return found.select(F.inline(F.array(*[F.struct(
        F.lit(f.name).alias("column_name"), F.col(f"{n}_n").alias("present"), F.col(f"{n}_lo").alias("lowest"),
        F.col(f"{n}_hi").alias("highest"), F.col(f"{n}_sum").alias("total")) for n, f in zip(names, rows.schema.fields)])))


def cast_dates(rows: DataFrame, columns: tuple[str, ...] = DATES) -> DataFrame:
    """ISO text to dates; bad text raises under ANSI mode."""
    return rows.withColumns({c: F.to_date(c, "yyyy-MM-dd") for c in columns})


def bad_dates(rows: DataFrame, columns: tuple[str, ...] = DATES) -> DataFrame:
    """Rows whose date text cannot be read, to look at before ``cast_dates``."""
    broken = [F.col(c).isNotNull() & F.try_to_date(F.col(c), "yyyy-MM-dd").isNull()
              for c in columns]
    return rows.where(reduce(lambda a, b: a | b, broken))


def split_dates(rows: DataFrame, columns: tuple[str, ...] = DATES, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows whose date texts can all be read, with dates, and the others as they came.

    ``reasons`` names what is wrong with each failing column: "missing" where a text is null or
    blank and ``"no date"`` or ``"no such day"`` otherwise. One pass tags every row, and one write
    puts both kinds in folders of their own, so that nothing is parsed twice and accepted plus
    rejected are all rows, whatever happens to the tasks.
    """
    def reason(c: str) -> Column:
        text = F.col(f"`{c}`")
        what = (F.when(text.isNull() | (F.trim(text) == ""), "missing")
                .when(~text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "no date")
                .when(F.try_to_date(text, "yyyy-MM-dd").isNull(), "no such day"))
        return F.when(what.isNotNull(), F.struct(F.lit(c).alias("column"), what.alias("reason")))

    path = path or new_path(rows.sparkSession, "split")
    tagged = rows.withColumn("reasons", F.filter(F.array(*map(reason, columns)), lambda r: r.isNotNull()))
    tagged.withColumn("accepted", F.size("reasons") == 0).write.partitionBy("accepted").option(
        "compression", COMPRESSION).parquet(path)
    schema = T.StructType([*tagged.schema.fields, T.StructField("accepted", T.BooleanType())])
    stored = rows.sparkSession.read.schema(schema).parquet(path)
    good = stored.where("accepted").select(*[F.col(f"`{c}`") for c in rows.columns])
    return cast_dates(good, columns), stored.where("NOT accepted").drop("accepted")


def nan_to_null(rows: DataFrame) -> DataFrame:
    """NaN is a missing value; NULL is how Spark skips one."""
    return rows.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, _FLOATS) else F.col(f.name)
        for f in rows.schema.fields])


def clean(rows: DataFrame) -> DataFrame:
    """Typed, without NaN and without repeated rows."""
    text_dates = tuple(f.name for f in rows.schema.fields
                       if f.name in DATES and isinstance(f.dataType, T.StringType))
    return drop_duplicates(nan_to_null(cast_dates(rows, text_dates)))


def summary(sales: DataFrame) -> DataFrame:
    """One row: size, period, totals and number of customers and products."""
    facts = sales.agg(
        F.count("*").alias("total_rows"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        sum_units0("sales").alias("_s"),
        sum_units0("profit").alias("_p"),
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("product_name").alias("products"),
    )
    return facts.select(
        "total_rows", F.lit(len(sales.columns)).alias("total_columns"),
        "first_date", "last_date", amount("_s", 0).alias("total_sales"),
        amount("_p", 0).alias("total_profit"), "customers", "products")


def category_totals(sales: DataFrame) -> DataFrame:
    return (
        sales.where(F.col("category").isNotNull()).groupBy("category")
        .agg(sum_units0("sales").alias("_s"), sum_units0("profit").alias("_p"))
        .select("category", amount("_s").alias("sales"), amount("_p").alias("profit"))
        .orderBy("category")
    )
