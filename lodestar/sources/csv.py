"""SRC-1 / SRC-2: CSV sources with string columns.

No type inference (it would scan the data twice and changes the sort order of
keys that are compared as strings).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_strings(spark: SparkSession, paths: str | Sequence[str],
                     columns: int | None = None, sep: str = ",") -> DataFrame:
    """SRC-1: headerless CSV, every column a nullable string ``_c0, _c1, …``.

    With ``columns`` given the schema is fixed up front; otherwise Spark reads
    the first line only to count the columns (still no inference pass).
    """
    reader = spark.read.option("header", False).option("sep", sep)
    if columns:
        reader = reader.schema(T.StructType(
            [T.StructField(f"_c{i}", T.StringType(), True) for i in range(columns)]))
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_csv_with_header(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> DataFrame:
    """SRC-2 / FLT-4: the first row names the columns; every row equal to it is dropped.

    Files joined end to end repeat their header lines; all copies go, wherever
    they sit.  Only one row reaches the driver (``first()``).
    """
    raw = read_csv_strings(spark, paths, sep=sep)
    header = raw.first()
    if header is None:
        return raw
    names = [str(v) if v is not None else f"_c{i}" for i, v in enumerate(header)]
    same = F.lit(True)
    for c, v in zip(raw.columns, header):
        same = same & (F.col(c).eqNullSafe(F.lit(v)))
    return raw.where(~same).toDF(*names)
