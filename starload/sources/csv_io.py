"""Processed-data CSV sink and source.

The sink writes a header, no index and NULL as an empty field, one file per
task (parallel write). The source reads by header name as text, checks the
required columns (V1) and converts with the tolerant casts, so a file written
by this sink or by any other tool with the same header reads back the same.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import na_token_to_null, to_double, to_int_key
from starload.operators.quality import columns_checked
from starload.sources.paths import read_headed_text


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; NULL becomes an empty field."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def read_csv_typed(spark: SparkSession, path: str, types: Mapping[str, str], name: str = "csv") -> DataFrame:
    """Read a headed CSV by column name and convert to the given types.

    ``types`` maps column name to ``int`` (tolerant integer), ``double``
    (tolerant float) or ``string`` (missing tokens to NULL).
    """
    raw = columns_checked(read_headed_text(spark, path, name, ","), types, name)
    cols = []
    for c, t in types.items():
        s = na_token_to_null(c)
        if t == "int":
            cols.append(to_int_key(c, c).alias(c))
        elif t == "double":
            cols.append(to_double(c).alias(c))
        elif t == "string":
            cols.append(s.alias(c))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return raw.select(*cols)
