"""From raw orders to everything the reports read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.bands import TIER_LIMITS
from ..operators.features import with_features
from ..operators.quality import clean
from ..sources import files
from ..sources.schema import CLEAN
from ..sources.workspace import written
from .star import Star, read_star, write_star


@dataclass(frozen=True)
class Built:
    sales: DataFrame   # the clean table: 28 columns
    star: Star


def build(raw: DataFrame, folder: str,
          tier_limits: Sequence[float | None] = TIER_LIMITS) -> Built:
    """Clean raw orders, derive all columns, and write clean table and star.

    Deduplication shuffles whole rows, and customer value needs the result
    twice, so the tidy rows are written before features are added. The clean
    table is written once, by year; the star and every report are then scans
    of it that read only the columns and years they need.
    """
    spark = raw.sparkSession
    tidy = written(clean(raw), "tidy")
    files.write_clean(with_features(tidy, tier_limits), f"{folder}/sales")
    sales = files.read_clean(spark, f"{folder}/sales").select(*CLEAN.fieldNames())
    return Built(sales, write_star(sales, f"{folder}/star"))


def load(spark: SparkSession, folder: str) -> Built:
    """What an earlier ``build`` wrote to the folder."""
    sales = files.read_clean(spark, f"{folder}/sales").select(*CLEAN.fieldNames())
    return Built(sales, read_star(spark, f"{folder}/star"))
