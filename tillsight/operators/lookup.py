"""Attaching one value per key to a large table with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import written

HEAVY_KEYS = 10_000


def attach(rows: DataFrame, per_key: DataFrame, key: str, value: str, count: str,
           spread_by: Column, heavy_keys: int = HEAVY_KEYS) -> DataFrame:
    """Left join ``value`` onto ``rows`` by ``key``, however uneven the key.

    ``per_key`` has one row per key and ``count``, the key's number of rows.
    It is written first, so its size is known when the join is planned: below
    the session's broadcast limit the large side does not move at all.

    Beyond that limit the join shuffles, and must not send a hot key to one
    task. The ``heavy_keys`` largest keys go to a broadcast table of at most
    that many rows; each other key holds less than 1/``heavy_keys`` of all
    rows. Rows of a heavy or missing key still pass through the shuffle, but
    under a salt made from ``spread_by``, so they land on all tasks and match
    nothing there. All rows are kept.
    """
    known = written(per_key.where(F.col(key).isNotNull()), "per_key")
    heavy = (known.orderBy(F.desc(count), key).limit(heavy_keys)
             .select(key, F.col(value).alias("_heavy_value"), F.lit(True).alias("_heavy")))
    light = known.select(key, F.col(value).alias("_light_value"),
                         F.lit(0).cast("long").alias("_salt"))
    salt = F.when(F.col("_heavy") | F.col(key).isNull(),
                  F.pmod(F.xxhash64(spread_by), F.lit(1 << 30)) + 1).otherwise(0)
    return (
        rows.join(F.broadcast(heavy), key, "left")
        .withColumn("_salt", salt.cast("long"))
        .join(light, [key, "_salt"], "left")
        .select(*rows.columns,
                F.coalesce("_heavy_value", "_light_value").alias(value))
    )
