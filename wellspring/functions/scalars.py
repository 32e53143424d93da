"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def good_share(flag: str | Column = "quality_flag") -> Column:
    """Share of rows flagged 1; a null flag counts as bad."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.avg(F.when(flag == 1, 1.0).otherwise(0.0))


def quality_score(flag: str = "quality_flag") -> Column:
    """1.0 for a good reading, 0.5 for any other."""
    return F.when(F.col(flag) == 1, 1.0).otherwise(0.5)


def quality_band(share: str | Column) -> Column:
    """Display band of a quality share: above 90 %, 70 to 90 %, below 70 %."""
    share = F.col(share) if isinstance(share, str) else share
    return F.when(share > 0.9, "good").when(share >= 0.7, "fair").when(share.isNotNull(), "poor")


def pct_change(before: Column, after: Column) -> Column:
    """Percentage change relative to ``before`` with its sign kept; 0 where ``before`` is 0."""
    return F.when(before == 0, F.lit(0.0)).otherwise((after - before) / before * 100)


def weighted_mean(value: str, weight: str) -> Column:
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))


def entity_label(prefix: str, key: str) -> Column:
    """'WELL-7' style label."""
    return F.concat(F.lit(f"{prefix}-"), F.col(key).cast("string"))


def run_time(moment: str) -> Column:
    """A run's clock reading as a literal; functions never read the clock themselves."""
    return F.lit(moment).cast("timestamp_ntz")


def with_audit(df: DataFrame, source: str | Column, loaded_at: str | Column) -> DataFrame:
    """Add load_timestamp and record_source; one load time per run."""
    return df.withColumns(
        {
            "load_timestamp": run_time(loaded_at) if isinstance(loaded_at, str) else loaded_at,
            "record_source": F.lit(source) if isinstance(source, str) else source,
        }
    )


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls per column; columns the table lacks are passed over."""
    return df.fillna({name: value for name, value in defaults.items() if name in df.columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column, so aggregates skip it."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def iso_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps become ISO 8601 text, null stays null."""
    changed = {}
    for field in df.schema:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            changed[field.name] = F.date_format(field.name, ISO_TIMESTAMP)
        elif isinstance(field.dataType, T.DateType):
            changed[field.name] = F.date_format(field.name, "yyyy-MM-dd")
    return df.withColumns(changed) if changed else df


def as_documents(df: DataFrame) -> DataFrame:
    """Rows ready for a document store: no NaN, no native timestamps."""
    return iso_text(nan_to_null(df))
