"""Hash keys and change hashes, as column expressions.

A key must not depend on how a number happened to be stored: 1, 1.0 and
DECIMAL 1.00 are one business key. Every part is therefore brought to one
canonical text first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "|"
NO_SENSOR = "NO_SENSOR"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def canonical_text(df: DataFrame, name: str) -> Column:
    """Text of a column that is the same for equal values of any numeric type; null becomes ''."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = _double_text(col.cast("double"))
    elif isinstance(kind, T.DecimalType):
        text = _trimmed(col.cast("string")) if kind.scale else col.cast("string")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(col, TIMESTAMP_TEXT)
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(""))


def _trimmed(text: Column) -> Column:
    """Decimal text without zeros at its end, '1.50' as '1.5' and '1.0' as '1'."""
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def _double_text(col: Column) -> Column:
    # Between 0.001 and ten million a double's own text is plain digits. Others take
    # a decimal's digits where that is the same number, else their own text, so that
    # no two doubles share a text (1e-11, 2e-11 and 0 differ).
    size = F.abs(col)
    plain = (size < 1e7) & ((size >= 1e-3) | (size == 0))
    decimal = col.try_cast(T.DecimalType(38, 10))
    fixed = F.when(decimal.cast("double") == col, _trimmed(decimal.cast("string")))
    return F.when(plain, _trimmed((col + 0.0).cast("string"))).otherwise(F.coalesce(fixed, col.cast("string")))


def hash_key(df: DataFrame, entity: str, *parts: str | Column) -> Column:
    """MD5 over the entity name and the key parts, joined by '|'.

    A part is a column name, taken in canonical text, or a ready text expression.
    """
    texts = [canonical_text(df, p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, F.lit(entity), *texts).cast("binary"))


def hash_diff(df: DataFrame, columns: Sequence[str], separator: str = SEPARATOR) -> Column:
    """MD5 over attribute values, for telling a changed version from a repeated one."""
    return F.md5(F.concat_ws(separator, *[canonical_text(df, c) for c in columns]).cast("binary"))


def reading_key_parts(df: DataFrame, extra: Sequence[str] = ()) -> list[str]:
    """The columns of ``df`` that decide a reading's key."""
    known = ["well_id", "survey_type_id", "sensor_id", "timestamp", "trace_num"]
    return [c for c in known if c in df.columns] + [c for c in extra if c not in known]


def reading_key(df: DataFrame, extra: Sequence[str] = ()) -> Column:
    """Key of one reading: well, survey, sensor (or NO_SENSOR), then timestamp, else trace number, else ''.

    ``extra`` adds key parts such as ``depth_ft`` for a finer grain.
    """
    has = set(df.columns)
    sensor = F.lit(NO_SENSOR)
    if "sensor_id" in has:
        sensor = F.when(F.col("sensor_id").isNull(), F.lit(NO_SENSOR)).otherwise(canonical_text(df, "sensor_id"))
    moments = [
        F.when(F.col(c).isNotNull(), canonical_text(df, c)) for c in ("timestamp", "trace_num") if c in has
    ]
    moment = F.coalesce(*moments, F.lit(""))
    return hash_key(df, "READING", "well_id", "survey_type_id", sensor, moment, *extra)
