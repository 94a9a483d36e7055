"""Small column helpers shared by every plan."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: descriptor of the only partition of a table without range columns.
UNPARTITIONED = "-5"
# Fixed value: directory name Hive-style partitioning uses for NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_column(condition: Column | str) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def all_of(conditions: Iterable[Column | str]) -> Column | None:
    cols = [as_column(c) for c in conditions]
    return functools.reduce(lambda a, b: a & b, cols) if cols else None


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    return not isinstance(data_type, T.MapType)


def content_hash(df: DataFrame) -> Column:
    """Hash of a row's values: an order of ties that a task which runs again repeats."""
    return F.xxhash64(*[F.col(quoted(f.name)) for f in df.schema.fields if _hashable(f.dataType)])


def bucket_id(keys: Sequence[str], buckets: int) -> Column:
    """Murmur3 (seed 42) bucket of the key, the same number `repartition` would pick."""
    return F.pmod(F.hash(*[F.col(quoted(k)) for k in keys]), F.lit(buckets))


def route_by_key(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "bucket") -> DataFrame:
    """Tag every row with its bucket (D8). Spark places the rows; see `hash_bucketed`."""
    return df.withColumn(name, bucket_id(keys, buckets))


def _escaped(text: str) -> str:
    return text.replace("%", "%25").replace(",", "%2C").replace("=", "%3D")


def partition_desc(cols: Sequence[str]) -> Column:
    """``a=1,b=2`` over the sorted column names; ``-5`` without any (E6). Commas, equal
    and percent signs inside names and values are escaped, so no two value lists agree."""
    if not cols:
        return F.lit(UNPARTITIONED)

    def value(c: str) -> Column:
        text = F.col(quoted(c)).cast("string")
        for mark, code in (("%", "%25"), (",", "%2C"), ("=", "%3D")):
            text = F.replace(text, F.lit(mark), F.lit(code))
        return F.concat(F.lit(f"{_escaped(c)}="), F.coalesce(text, F.lit(NULL_PARTITION)))

    return F.concat_ws(",", *[value(c) for c in sorted(cols)])


def parse_partition_desc(desc: Column) -> Column:
    """Descriptor back to ``map<string,string>``; the unpartitioned one is empty."""
    pairs = F.str_to_map(desc, F.lit(","), F.lit("="))
    plain = F.transform_values(F.transform_keys(pairs, lambda k, v: unescape_path(k)), lambda k, v: unescape_path(v))
    return F.when(desc == UNPARTITIONED, F.create_map().cast("map<string,string>")).otherwise(plain)


def unescape_path(value: Column) -> Column:
    """Undo the %XX escapes of partition directory names (a plus sign is literal)."""
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
