"""Small frames of ids and totals that the driver already holds."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_rows(spark: SparkSession, rows: Iterable[dict], schema: T.StructType | str) -> DataFrame:
    """A few driver-side rows (ids, totals) as a frame, decoded inside the JVM."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    text = F.lit(json.dumps(list(rows)))
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(text, T.ArrayType(schema))))
