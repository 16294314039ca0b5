"""Small lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# target group of a search -> level of education (fixed values)
HIGHER_EDUCATION = ("12",)
SECONDARY_EDUCATION = ("10", "11", "13", "15", "16", "17", "18", "19", "20", "21", "22", "23", "24")


def target_groups(spark: SparkSession) -> DataFrame:
    rows = [(g, "korkeakoulu") for g in HIGHER_EDUCATION] + [(g, "toinen_aste") for g in SECONDARY_EDUCATION]
    return spark.createDataFrame(rows, "haunkohdejoukko string, haun_tyyppi string")


def first_source_searches(spark: SparkSession) -> DataFrame:
    """Searches served by the first achievement source.  The list is data of
    the installation; give it as a CSV seed with ``read_seed``."""
    return spark.createDataFrame([], "haku_oid string")


SEEDS = {"raw_haunkohdejoukko": target_groups, "int_sure_haut": first_source_searches}
