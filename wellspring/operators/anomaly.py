"""Anomaly rules: sigma band, z-score, interquartile fence, fixed threshold.

Statistics over the whole table come in as scalar subqueries, so rows are
neither joined nor shuffled to be flagged. All comparisons are strict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.operators.joins import left_join
from wellspring.operators.quantiles import group_quantiles

# Default thresholds of the rules.
SIGMA, Z_LIMIT, FENCE, DEGRADE_SHARE = 2.0, 2.5, 1.5, 0.1


def known(column: str) -> Column:
    """The value, or null for NaN, which Spark holds larger than any number."""
    return F.when(~F.isnan(column), F.col(column))


def _mean_std(df: DataFrame, column: str) -> Column:
    clean = known(column)
    return df.agg(F.struct(F.avg(clean).alias("mean"), F.stddev_samp(clean).alias("std"))).scalar()


def threshold_flag(df: DataFrame, column: str, limit: float, name: str = "is_anomaly") -> DataFrame:
    """1 where abs(value) > limit; NaN is a missing value, as everywhere here."""
    return df.withColumn(name, _flag(F.abs(known(column)) > limit))


def sigma_flag(df: DataFrame, column: str, sigmas: float = SIGMA, name: str = "is_anomaly") -> DataFrame:
    """1 outside mean +- sigmas * sample standard deviation of the whole table."""
    stats = _mean_std(df, column)
    low, high = stats["mean"] - sigmas * stats["std"], stats["mean"] + sigmas * stats["std"]
    return df.withColumn(name, _flag((known(column) < low) | (known(column) > high)))


def z_score(df: DataFrame, column: str, name: str = "z_score") -> DataFrame:
    """abs((value - mean) / sample std); null where the standard deviation is 0 or unknown."""
    stats = _mean_std(df, column)
    return df.withColumn(name, F.abs(F.try_divide(known(column) - stats["mean"], stats["std"])))


def fences(
    df: DataFrame, group: Sequence[str], column: str, k: float = FENCE
) -> DataFrame:
    """Q1, Q3 and the fence of every group, one row each."""
    q = group_quantiles(df, group, column, [0.25, 0.75])
    q = q.select(*group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    reach = k * (F.col("q3") - F.col("q1"))
    return q.withColumns({"lower_bound": F.col("q1") - reach, "upper_bound": F.col("q3") + reach})


def iqr_outliers(
    df: DataFrame,
    group: Sequence[str] | None,
    column: str,
    k: float = FENCE,
    name: str = "is_anomaly",
) -> DataFrame:
    """1 outside the group's interquartile fence; without a group, outside the table's."""
    bounds = fences(df, list(group or []), column, k)
    if not group:
        whole = bounds.select(F.struct("lower_bound", "upper_bound")).scalar()
        outside = (known(column) < whole["lower_bound"]) | (known(column) > whole["upper_bound"])
        return df.withColumn(name, _flag(outside))
    outside = (known(column) < F.col("lower_bound")) | (known(column) > F.col("upper_bound"))
    joined = left_join(df, bounds.select(*group, "lower_bound", "upper_bound"), list(group))
    return joined.withColumn(name, _flag(outside)).select(*df.columns, name)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def detect_anomalies(
    facts: DataFrame,
    group: Sequence[str] = ("well_key",),
    column: str = "amplitude",
    z_limit: float = Z_LIMIT,
    k: float = FENCE,
) -> DataFrame:
    """Reset and set is_anomaly: z-score over the limit, or outside the group's fence.

    The union of the two key sets is an OR of two flags on the row.
    """
    marked = iqr_outliers(z_score(facts, column, "_z"), group, column, k, "_outside")
    flag = _flag((F.col("_z") > z_limit) | (F.col("_outside") == 1))
    return marked.withColumn("is_anomaly", flag).drop("_z", "_outside")


def anomaly_rate(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """One row: readings, flagged and the percentage."""
    flagged = F.coalesce(F.sum(flag), F.lit(0))
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("total"),
        flagged.alias("anomalies"),
        F.coalesce(F.try_divide(flagged * 100.0, rows), F.lit(0.0)).alias("anomaly_pct"),
    )


def in_sample(key: str | Column, share: float, seed: int = 0) -> Column:
    """True for about ``share`` of all keys, the same ones on every run and on any partitioning.

    Compares eight hex digits of MD5(key, seed) with the share as a hex bound.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")
    key = F.col(key) if isinstance(key, str) else key
    if share == 1:
        return F.lit(True)
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.substring(digest, 1, 8) < F.lit(sample_bound(share))


def sample_bound(share: float) -> str:
    return f"{int(share * 2**32):08x}"


def sample_fraction(df: DataFrame, key: str, share: float, seed: int = 0) -> DataFrame:
    """The rows of a repeatable sample."""
    return df.filter(in_sample(key, share, seed))


def degrade_sample(df: DataFrame, key: str, share: float = DEGRADE_SHARE, seed: int = 0) -> DataFrame:
    """Set quality_flag 0 and data_quality_score 0.5 on a repeatable sample of the readings."""
    chosen = in_sample(key, share, seed)
    return df.withColumns(
        {
            "quality_flag": F.when(chosen, F.lit(0)).otherwise(F.col("quality_flag")),
            "data_quality_score": F.when(chosen, F.lit(0.5)).otherwise(F.col("data_quality_score")),
        }
    )


def degrade_exact(df: DataFrame, key: str, share: float = DEGRADE_SHARE, seed: int = 0) -> DataFrame:
    """As ``degrade_sample``, but on exactly floor(rows * share) rows: those first in hash order."""
    from wellspring.operators.numbering import number_rows

    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    placed = number_rows(df.withColumn("_hash", digest), ["_hash", key], "_row_no")
    wanted = F.floor(placed.agg(F.count(F.lit(1))).scalar() * share)
    chosen = F.col("_row_no") <= wanted
    return placed.withColumns(
        {
            "quality_flag": F.when(chosen, F.lit(0)).otherwise(F.col("quality_flag")),
            "data_quality_score": F.when(chosen, F.lit(0.5)).otherwise(F.col("data_quality_score")),
        }
    ).drop("_hash", "_row_no")
