"""Small tables for the operators of the llm package."""

import os

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in any column, empty and long texts, ties, repeated rows.
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta", "en", "a", 35),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (3, "", "en", "a", 0),
    (4, " \t\n ", "en", "b", 4),
    (5, "word " * 30_000, "en", "b", 150_000),
    (6, "é日本 x y\r\nz  \x85w", "fr", "", None),
    (None, "no id at all here, not even one", "de", "c", 31),
    (7, "Alpha beta gamma delta epsilon zeta", "en", "a", 35),
    (7, "Alpha beta gamma delta epsilon zeta", "en", "a", 35),
    (-8, "a", "en", "c", 1),
]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(spark, *names):
    """The odd rows with further columns named like the operators' own."""
    from pyspark.sql import functions as F

    return odd(spark).withColumns({n: F.lit(f"own {n}") for n in names})


def documents(spark, sf=SF):
    return spark.read.parquet(os.path.join(sf, "documents.parquet"))


def labels(spark, sf=SF):
    return spark.read.parquet(os.path.join(sf, "labels.parquet"))


def pages(spark, sf=SF):
    return spark.read.parquet(os.path.join(sf, "pages.parquet"))
