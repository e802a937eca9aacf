"""Reading and writing order tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schema as S
from .workspace import COMPRESSION, new_path


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by the names in the header, in any order; others are left out.

    A missing column, a file with another header and a value that does not fit its
    type stop the load. A quoted value may hold quotes and commas, not line breaks.
    """
    # Quotes inside a quoted value are doubled (Laptop Air 13""), hence escape='"'.
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST"))
    header = reader.csv(path).columns
    missing = [n for n in schema.fieldNames() if n not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    kinds = {f.name: f for f in schema.fields}
    in_file = T.StructType([kinds.get(n, T.StructField(n, T.StringType())) for n in header])
    return reader.option("enforceSchema", False).schema(in_file).csv(path).select(*schema.fieldNames())


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, S.RAW)


def read_raw_csv_text_dates(spark: SparkSession, path: str) -> DataFrame:
    """Raw orders with the dates as written, for ``quality.cast_dates``."""
    return _csv(spark, path, S.with_text_dates(S.RAW))


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, S.CLEAN)


def read_clean_csv_text_dates(spark: SparkSession, path: str) -> DataFrame:
    """Clean orders with dates left as ISO text, which sorts like the dates."""
    return _csv(spark, path, S.with_text_dates(S.CLEAN))


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """CSV files with a header; with ``gzip`` each is compressed, which readers of folders undo by themselves."""
    (rows.write.mode(mode).option("header", True).option("escape", '"').option("compression", compression)
     .option("dateFormat", "yyyy-MM-dd").csv(path))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    # The schema is given: a table without orders has no file to take it from.
    return spark.read.schema(S.CLEAN).parquet(path)


def write_clean(sales: DataFrame, path: str, mode: str = "overwrite", dealt: bool = True) -> None:
    """Write the clean table by year, so a report on one year reads one folder.

    Rows are dealt by year and date first, so a task writes the files of a year or
    two and not one for every year; unless ``dealt``, they stay in their tasks, which moves no
    whole row and leaves as many files a year as there are tasks. The year moves to the end of the column list on
    reading, as with any partition column.
    """
    if dealt:
        sales = sales.repartitionByRange("order_year", "order_date")
    sales.sortWithinPartitions("order_year", "order_date").write.mode(mode).option(
        "compression", COMPRESSION).partitionBy("order_year").parquet(path)


def publish(sales: DataFrame, name: str = "sales", path: str | None = None) -> DataFrame:
    """Replace the catalog table ``name`` in one step.

    Every version is written aside, in a folder of its own below ``path`` or the run folder. When
    it is complete the catalog's location is switched to it. A reader has the old rows or the new
    ones, never none or some, and a write that fails changes nothing. Files of earlier versions
    stay for those who read them; ``drop_versions`` removes them. Columns have to stay as they are.
    """
    spark = sales.sparkSession
    folder = path or new_path(spark, name)
    version = f"{folder}/version-{uuid.uuid4().hex}"
    if spark.catalog.tableExists(name) and [(f.name, f.dataType) for f in spark.table(name).schema] != [
            (f.name, f.dataType) for f in sales.schema]:
        raise ValueError(f"{name} has other columns; publish under another name")
    sales.write.option("compression", COMPRESSION).parquet(version)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, version, source="parquet", schema=sales.schema)
    return spark.table(name)


def drop_versions(spark: SparkSession, name: str, path: str) -> int:
    """Remove the versions below ``path`` that the table no longer points to; how many there were."""
    current = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    old = [f.getPath() for f in system.listStatus(root)
           if f.getPath().getName().startswith("version-") and not current.rstrip("/").endswith(f.getPath().getName())]
    for one in old:
        system.delete(one, True)
    return len(old)


def run_sql(sales: DataFrame, text: str, name: str = "sales") -> DataFrame:
    """Run SQL text over the orders, visible to it as table ``name``.

    The name is taken while the text is read only; a view of that name in the session stays as it was.
    """
    spark = sales.sparkSession
    taken = spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary
    before = spark.table(name) if taken else None
    sales.createOrReplaceTempView(name)
    try:
        return spark.sql(text)
    finally:
        if before is not None:
            before.createOrReplaceTempView(name)
        else:
            spark.catalog.dropTempView(name)


def with_iso_dates(rows: DataFrame) -> DataFrame:
    """Dates as ISO text."""
    return rows.select(*[
        F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in rows.schema.fields])
