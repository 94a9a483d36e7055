"""Typed decode of change-event fields as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.functions.columns import quoted

# Names of the logical types that change events carry.
DATE = "io.debezium.time.Date"
YEAR = "io.debezium.time.Year"
TIME_MILLIS = "io.debezium.time.Time"
TIME_MICROS = "io.debezium.time.MicroTime"
TIME_NANOS = "io.debezium.time.NanoTime"
TIMESTAMP_MILLIS = "io.debezium.time.Timestamp"
TIMESTAMP_MICROS = "io.debezium.time.MicroTimestamp"
TIMESTAMP_NANOS = "io.debezium.time.NanoTimestamp"
ZONED_TIMESTAMP = "io.debezium.time.ZonedTimestamp"
ZONED_TIME = "io.debezium.time.ZonedTime"
DECIMAL = "org.apache.kafka.connect.data.Decimal"
# Names of ours for decimals that a source writes as digits or as a double.
DECIMAL_TEXT = "decimal_text"
DECIMAL_DOUBLE = "decimal_double"


@dataclass(frozen=True)
class FieldSpec:
    """How one field is encoded: a primitive type or a logical type name."""

    kind: str
    precision: int = 10
    scale: int = 0


# Primitive wire types and the table types they become.
_PRIMITIVE: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "int8": T.IntegerType(),
    "int16": T.IntegerType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}


def field_spec(wire: str, name: str | None = None, parameters: Mapping[str, str] | None = None) -> FieldSpec:
    """Encoding of a field from the schema block of a change event.

    Connectors may put a package of their own before the name of a logical type.
    """
    if name is None:
        return FieldSpec(wire)
    logical = (DATE, YEAR, TIME_MILLIS, TIME_MICROS, TIME_NANOS, TIMESTAMP_MILLIS, TIMESTAMP_MICROS,
               TIMESTAMP_NANOS, ZONED_TIMESTAMP, ZONED_TIME, DECIMAL)
    for known in logical:
        if name == known or name.endswith(f".{known}"):
            given = parameters or {}
            return FieldSpec(known, int(given.get("connect.decimal.precision", 10)), int(given.get("scale", 0)))
    return FieldSpec(wire)


def wire_type(spec: FieldSpec) -> T.DataType:
    """Type to give `from_json` for a field before it is decoded."""
    if spec.kind in (DATE, YEAR):
        return T.IntegerType()
    if spec.kind in (TIME_MILLIS, TIME_MICROS, TIME_NANOS, TIMESTAMP_MILLIS, TIMESTAMP_MICROS, TIMESTAMP_NANOS):
        return T.LongType()
    if spec.kind == DECIMAL_DOUBLE:
        return T.DoubleType()
    if spec.kind in (ZONED_TIMESTAMP, ZONED_TIME, DECIMAL, DECIMAL_TEXT, "bytes"):
        return T.StringType()
    return _PRIMITIVE[spec.kind]


def _width(precision: int) -> int:
    """Hex digits that hold an unscaled value: a long, or twice that."""
    return 16 if precision <= 18 else 32


def hex_digits(data: Column, precision: int) -> Column:
    """Signed big-endian bytes as sign-extended hex digits; NULL for no bytes."""
    width = F.lit(_width(precision))
    text = F.hex(data)
    sign = F.when(text >= "8", "F").otherwise("0")
    padded = F.lpad(F.nullif(text, F.lit("")), F.greatest(F.length(text), width), sign)
    kept = F.right(padded, width)
    # bytes above the width may only repeat the sign; anything else is a wider value than declared
    above = F.left(padded, F.length(padded) - width)
    fits = (F.length(F.replace(above, sign, F.lit(""))) == 0) & ((kept >= "8") == (text >= "8"))
    return F.when(fits, kept).when(
        padded.isNotNull(), F.raise_error(F.concat(F.lit(f"decimal wider than its precision {precision}: "), text))
    )


def unscaled_integer(digits: Column, precision: int = 38) -> Column:
    """Exact integer of `hex_digits`.

    Up to 18 digits fit into a long; wider values are put together from a signed
    upper and an unsigned lower half.
    """
    if precision <= 18:
        return F.conv(digits, 16, -10).cast("bigint")
    high = F.conv(F.left(digits, F.lit(16)), 16, -10).cast("decimal(19,0)")
    low = F.conv(F.right(digits, F.lit(16)), 16, 10).cast("decimal(20,0)")
    # A negative number borrows one upper unit, so that no step leaves 38 digits.
    borrow = F.when(digits >= "8", F.lit(Decimal(1))).otherwise(F.lit(Decimal(0)))
    lent = F.when(digits >= "8", F.lit(Decimal(2**64))).otherwise(F.lit(Decimal(0)))
    return ((high + borrow) * F.lit(Decimal(2**64)) + (low - lent)).cast("decimal(38,0)")


def scaled_decimal(digits: Column, precision: int, scale: int) -> Column:
    """`hex_digits` of an unscaled value to DECIMAL(precision, scale), exactly."""
    value = unscaled_integer(digits, precision).cast(f"decimal({precision},0)")
    target = f"decimal({precision},{scale})"
    if scale == 0:
        return value
    if scale <= 6 or precision + scale < 38:
        return (value * F.lit(Decimal(1).scaleb(-scale))).cast(target)
    # A product of this width would round; an exponent in the text does not.
    return F.concat(value.cast("string"), F.lit(f"E-{scale}")).cast(target)


def _floor_div(value: Column, by: int) -> Column:
    """Division that rounds down, so times before 1970 keep their place."""
    v, n = value.cast("bigint"), F.lit(by).cast("bigint")
    return F.call_function("div", v - F.pmod(v, n), n)


def _moment(micros: Column) -> Column:
    """UTC wall clock of microseconds since 1970, whatever the session's zone is."""
    return F.timestamp_add("MICROSECOND", micros.cast("bigint"), F.lit("1970-01-01").cast("timestamp_ntz"))


def _wall_clock(instant: Column, zone: str) -> Column:
    """Local date and time of an instant in the server's zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _moment(F.unix_micros(instant)))


def decode_value(value: Column, spec: FieldSpec, wire: T.DataType, zone: str = "UTC") -> Column:
    """One field to its table type; times of day become microseconds.

    A decimal is given as its `hex_digits`.
    """
    kind = spec.kind
    if kind == DATE:
        return F.date_add(F.lit("1970-01-01").cast("date"), value.cast("int"))
    if kind == YEAR:
        return value.cast("int")
    if kind == TIME_MILLIS:
        return value.cast("bigint") * 1000
    if kind == TIME_MICROS:
        return value.cast("bigint")
    if kind == TIME_NANOS:
        return _floor_div(value, 1000)
    if kind == TIMESTAMP_MILLIS:
        return _moment(value.cast("bigint") * 1000)
    if kind == TIMESTAMP_MICROS:
        return _moment(value)
    if kind == TIMESTAMP_NANOS:
        return _moment(_floor_div(value, 1000))
    if kind in (ZONED_TIMESTAMP, ZONED_TIME):
        return _wall_clock(value.cast("timestamp"), zone)
    if kind == DECIMAL:
        return scaled_decimal(value, spec.precision, spec.scale)
    if kind in (DECIMAL_TEXT, DECIMAL_DOUBLE):
        return value.cast(f"decimal({spec.precision},{spec.scale})")
    if kind == "bytes":
        return value if isinstance(wire, T.BinaryType) else F.unbase64(value)
    if kind not in _PRIMITIVE:
        raise ValueError(f"unknown field encoding {kind}")
    return value.cast(_PRIMITIVE[kind])


def decode_envelope(df: DataFrame, specs: Mapping[str, FieldSpec], zone: str = "UTC") -> DataFrame:
    """Decode the named columns; others pass through.

    Decimal bytes become hex digits in a projection of their own, because the
    steps above it read the digits more than once.
    """
    first, out = [], []
    for f in df.schema.fields:
        value = F.col(quoted(f.name))
        spec = specs.get(f.name)
        if spec is not None and spec.kind == DECIMAL:
            data = value if isinstance(f.dataType, T.BinaryType) else F.unbase64(value)
            first.append(hex_digits(data, spec.precision).alias(f.name))
        else:
            first.append(value)
        out.append(value if spec is None else decode_value(value, spec, f.dataType, zone).alias(f.name))
    return df.select(*first).select(*out)


# -- D10 ------------------------------------------------------------------------

# Source column types and the table types they map to.
SOURCE_TYPES: dict[str, str] = {
    "bigint": "bigint",
    "int": "int",
    "tinyint": "int",
    "smallint": "int",
    "mediumint": "int",
    "double": "double",
    "float": "float",
    "date": "date",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "tinytext": "string",
    "text": "string",
    "mediumtext": "string",
    "longtext": "string",
    "varchar": "string",
    "tinyblob": "binary",
    "blob": "binary",
    "mediumblob": "binary",
    "longblob": "binary",
}


def table_type(source_type: Column, precision: Column, scale: Column) -> Column:
    """Table type of a source column type; NULL when it is not supported."""
    t = F.trim(F.lower(source_type))
    base = F.regexp_extract(t, r"^([a-z]+)", 1)
    size = F.regexp_extract(t, r"^[a-z]+\(([^)]*)\)", 1)
    mapping = F.create_map(*[F.lit(x) for kv in SOURCE_TYPES.items() for x in kv])
    args = F.regexp_replace(size, r"\s", "")
    return (
        F.when(base.isin("decimal", "numeric") & args.rlike(r"^\d+,\d+$"), F.concat(F.lit("decimal("), args, F.lit(")")))
        .when(base.isin("decimal", "numeric") & (args == ""),
              F.concat(F.lit("decimal("), F.coalesce(precision, F.lit(9)), F.lit(","), F.coalesce(scale, F.lit(3)), F.lit(")")))
        .when((base == "char") & args.rlike(r"^\d+$"), F.concat(F.lit("char("), args, F.lit(")")))
        .when((base == "varchar") & (args == "") | (base == "varchar") & args.rlike(r"^\d+$"), "string")
        .when(t == base, mapping[base])
    )


def schema_from_source(columns: DataFrame) -> DataFrame:
    """Column metadata rows to table columns.

    Takes (table_name, column_name, position, source_type) with optional
    ``precision`` and ``scale``. Unsupported types are reported, not dropped.
    """
    have = set(columns.columns)
    precision = F.col("precision") if "precision" in have else F.lit(None).cast("int")
    scale = F.col("scale") if "scale" in have else F.lit(None).cast("int")
    mapped = table_type(F.col("source_type"), precision, scale)
    return columns.select(
        "table_name", "column_name", "position", "source_type",
        mapped.alias("table_type"), mapped.isNotNull().alias("supported"),
    )


def struct_of(columns: list[tuple[str, str]]) -> T.StructType:
    """Schema from (name, table type) pairs of one table."""
    return T.StructType.fromDDL(", ".join(f"{quoted(n)} {t}" for n, t in columns))
