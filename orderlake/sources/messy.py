"""Permissive reads of messy text files (B2).

Records that do not fit the declared schema are kept: the whole raw line goes
to the corrupt-record column and the job does not fail.  Spark refuses a query
over raw CSV/JSON that references *only* the corrupt column; select it together
with typed columns (as the bronze queries do), or persist the read first when a
report needs the corrupt lines alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def read_messy(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv",
               corrupt_col: str = CORRUPT, **options) -> DataFrame:
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    if corrupt_col not in schema.fieldNames():
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType(), True)])
    reader = (spark.read.schema(schema).format(fmt)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt_col))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)
