"""Marts, KPIs and the aggregate reports over them.

Marts aggregate the facts on their integer keys first, which combines on the
map side and leaves one row per key pair, and join the descriptive dimensions
to that small result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions.scalars import entity_label, fill_defaults, good_share, nan_to_null, run_time
from wellspring.operators.anomaly import SIGMA, sigma_flag
from wellspring.operators.quantiles import group_quantiles

# What a null in a mart column is shown as.
MART_DEFAULTS = {
    "well_name": "Unknown",
    "sensor_type": "Unknown",
    "manufacturer": "Unknown",
    "latitude": 0.0,
    "longitude": 0.0,
    "total_readings": 0,
    "avg_amplitude": 0.0,
    "data_quality_rate": 0.0,
    "anomaly_count": 0,
}


def well_analytics(
    measurements: DataFrame, wells: DataFrame | None, processed_at: str, sigmas: float = SIGMA
) -> DataFrame:
    """Per well: amplitude statistics, two-sigma anomalies and quality share.

    Readings without a well are left out; wells are the left side's concern
    only, so readings of wells no hub knows stay.
    """
    flagged = sigma_flag(nan_to_null(measurements), "amplitude", sigmas)
    per_well = (
        flagged.filter(F.col("well_id").isNotNull())
        .groupBy("well_id")
        .agg(
            F.avg("amplitude").alias("avg_amplitude"),
            F.stddev_samp("amplitude").alias("std_amplitude"),
            F.min("amplitude").alias("min_amplitude"),
            F.max("amplitude").alias("max_amplitude"),
            F.count("amplitude").alias("reading_count"),
            F.sum("is_anomaly").alias("anomaly_count"),
            good_share().alias("quality_score"),
        )
    )
    if wells is not None:
        per_well = per_well.join(wells.select("well_id").distinct(), "well_id", "left")
    return per_well.withColumns(
        {"well_name": entity_label("WELL", "well_id"), "processed_at": run_time(processed_at)}
    )


def _per_key(facts: DataFrame, keys: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """Mergeable measures per fact key."""
    return nan_to_null(facts).groupBy(*keys).agg(
        F.count("reading_key").alias("_readings"),
        F.sum("amplitude").alias("_sum"),
        F.count("amplitude").alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("quality_flag") == 1).alias("_good"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        F.min("timestamp").alias("first_reading"),
        F.max("timestamp").alias("last_reading"),
        *extra,
    )


def _merged() -> dict[str, Column]:
    """The measures of ``_per_key`` rows, put together over any coarser group."""
    return {
        "total_readings": F.sum("_readings"),
        "avg_amplitude": F.try_divide(F.sum("_sum"), F.sum("_n")),
        "data_quality_rate": F.try_divide(F.sum("_good"), F.sum("_rows")),
        "anomaly_count": F.sum("anomaly_count"),
        "first_reading": F.min("first_reading"),
        "last_reading": F.max("last_reading"),
    }


def _pick(*names: str) -> list[Column]:
    merged = _merged()
    return [merged[n].alias(n) for n in names]


def _current(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("is_current") == 1)


def mart_well_performance(facts: DataFrame, wells: DataFrame, sources: DataFrame) -> DataFrame:
    """Readings per current well and source format."""
    named = (
        _per_key(facts, ["well_key", "source_key"])
        .join(_current(wells).select("well_key", "well_id", "well_name", "latitude", "longitude"), "well_key")
        .join(F.broadcast(sources.select("source_key", "source_format")), "source_key")
    )
    return named.groupBy("well_id", "well_name", "latitude", "longitude", "source_format").agg(
        *_pick(
            "total_readings", "avg_amplitude", "data_quality_rate", "anomaly_count", "first_reading", "last_reading"
        )
    )


def mart_sensor_analysis(facts: DataFrame, sensors: DataFrame) -> DataFrame:
    """Readings per current sensor."""
    named = _per_key(facts, ["sensor_key"]).join(
        _current(sensors).select("sensor_key", "sensor_id", "sensor_type", "manufacturer"), "sensor_key"
    )
    return named.groupBy("sensor_id", "sensor_type", "manufacturer").agg(
        *_pick("total_readings", "data_quality_rate", "avg_amplitude", "first_reading", "last_reading")
    )


def mart_survey_summary(surveys: DataFrame, sources: DataFrame) -> DataFrame:
    """Surveys per type and source format; averages are means of survey averages."""
    return (
        surveys.join(F.broadcast(sources.select("source_key", "source_format")), "source_key")
        .groupBy("survey_type", "source_format")
        .agg(
            F.count_distinct("well_key").alias("wells_surveyed"),
            F.sum("total_readings").alias("total_readings"),
            F.avg("avg_amplitude").alias("avg_amplitude"),
            F.avg("data_quality_rate").alias("avg_data_quality_rate"),
            F.min("survey_start_date").alias("earliest_survey"),
            F.max("survey_end_date").alias("latest_survey"),
        )
    )


def mart_well_performance_wide(facts: DataFrame, wells: DataFrame, sources: DataFrame) -> DataFrame:
    """The documented wider well mart: deviation, score-based quality, depth range. One row per well key."""
    per_key = nan_to_null(facts).groupBy("well_key", "source_key").agg(
        F.count("reading_key").alias("total_readings"),
        F.avg("amplitude").alias("avg_amplitude"),
        F.stddev_samp("amplitude").alias("std_amplitude"),
        F.avg("data_quality_score").alias("data_quality_rate"),
        F.sum("is_anomaly").alias("anomaly_count"),
        F.min("depth").alias("min_depth"),
        F.max("depth").alias("max_depth"),
    )
    kept = ["well_id", "well_name", "latitude", "longitude", "basin", "field", "operator"]
    return (
        per_key.join(_current(wells).select("well_key", *kept), "well_key")
        .join(F.broadcast(sources.select("source_key", "source_format")), "source_key")
        .select(*kept, "source_format", *[c for c in per_key.columns if not c.endswith("_key")])
    )


def mart_sensor_analysis_wide(facts: DataFrame, sensors: DataFrame) -> DataFrame:
    """The documented wider sensor mart: model, frequency, score-based quality. One row per sensor key."""
    per_key = nan_to_null(facts).groupBy("sensor_key").agg(
        F.count("reading_key").alias("total_measurements"),
        F.avg("amplitude").alias("avg_amplitude"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("data_quality_score").alias("avg_quality"),
        F.sum("is_anomaly").alias("anomaly_count"),
    )
    kept = ["sensor_id", "sensor_type", "manufacturer", "model"]
    return per_key.join(_current(sensors).select("sensor_key", *kept), "sensor_key").select(
        *kept, *[c for c in per_key.columns if c != "sensor_key"]
    )


def survey_listing(surveys: DataFrame, wells: DataFrame) -> DataFrame:
    """The documented survey list: one row per survey of a current well."""
    return surveys.join(_current(wells).select("well_key", "well_name"), "well_key").select(
        "survey_id",
        "survey_type",
        "well_name",
        "survey_start_date",
        "survey_end_date",
        "total_readings",
        "avg_amplitude",
        "data_quality_rate",
    )


def sensor_reliability(wide_mart: DataFrame) -> DataFrame:
    """Mean quality per sensor, best first."""
    return (
        wide_mart.groupBy("sensor_id", "sensor_type", "manufacturer")
        .agg(F.avg("avg_quality").alias("reliability_score"), F.sum("anomaly_count").alias("anomaly_count"))
        .orderBy(F.desc("reliability_score"), "sensor_id")
    )


def monthly_readings(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Readings and mean amplitude per month; facts are counted per day key before the calendar is joined."""
    per_day = nan_to_null(facts).groupBy("time_key").agg(
        F.count("reading_key").alias("_readings"), F.sum("amplitude").alias("_sum"), F.count("amplitude").alias("_n")
    )
    return (
        per_day.join(F.broadcast(calendar.select("time_key", "year", "month")), "time_key")
        .groupBy("year", "month")
        .agg(F.sum("_readings").alias("monthly_readings"), *_pick("avg_amplitude"))
        .orderBy("year", "month")
    )


def load_mart(mart: DataFrame) -> DataFrame:
    """A mart as the dashboard reads it: nulls replaced by their display value."""
    return fill_defaults(mart, MART_DEFAULTS)


def kpi_stats(well_mart: DataFrame, sensor_mart: DataFrame) -> DataFrame:
    """One row of headline numbers; an empty well mart gives zeros, an empty sensor mart one sensor."""
    wells = load_mart(well_mart)
    sensors = sensor_mart.agg(F.count_distinct("sensor_id")).scalar()
    # One row per well first: a distinct count beside other sums would multiply the rows instead.
    per_well = wells.groupBy("well_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("total_readings").alias("total_readings"),
        F.sum("data_quality_rate").alias("_quality"),
        F.count("data_quality_rate").alias("_rated"),
        F.sum("anomaly_count").alias("total_anomalies"),
        F.sum(F.col("avg_amplitude") * F.col("total_readings")).alias("_weighted"),
    )
    totals = per_well.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
        F.count("well_id").alias("total_wells"),
        F.sum("total_readings").alias("total_readings"),
        F.try_divide(F.sum("_quality"), F.sum("_rated")).alias("avg_data_quality"),
        F.sum("total_anomalies").alias("total_anomalies"),
        F.try_divide(F.sum("_weighted"), F.sum("total_readings")).alias("avg_amplitude"),
    )
    shown = F.when(F.col("_rows") == 0, F.lit(0)).when(sensors == 0, F.lit(1)).otherwise(sensors)
    return totals.select(
        "total_wells",
        F.coalesce("total_readings", F.lit(0)).alias("total_readings"),
        F.coalesce("avg_data_quality", F.lit(0.0)).alias("avg_data_quality"),
        F.coalesce("total_anomalies", F.lit(0)).alias("total_anomalies"),
        shown.cast("long").alias("total_sensors"),
        F.coalesce("avg_amplitude", F.lit(0.0)).alias("avg_amplitude"),
    )


def wells_map(well_mart: DataFrame) -> DataFrame:
    """Mart rows with usable coordinates, typed for a map."""
    return (
        load_mart(well_mart)
        .filter((F.col("latitude") != 0) & (F.col("longitude") != 0))
        .select(
            F.col("well_id").cast("long"),
            F.col("well_name").cast("string"),
            F.col("latitude").cast("double").alias("lat"),
            F.col("longitude").cast("double").alias("lon"),
            F.col("total_readings").cast("long"),
            F.col("avg_amplitude").cast("double"),
            F.col("data_quality_rate").cast("double"),
            F.col("anomaly_count").cast("long"),
        )
    )


def quality_by_source(well_mart: DataFrame) -> DataFrame:
    """Mean quality percentage per source format."""
    return well_mart.groupBy("source_format").agg((F.avg("data_quality_rate") * 100).alias("quality_pct"))


def top_wells(well_mart: DataFrame, k: int = 10) -> DataFrame:
    """The k mart rows with most readings, and their anomaly percentage."""
    rate = F.round(F.try_divide(F.col("anomaly_count") * 100.0, F.col("total_readings")), 2)
    return (
        well_mart.orderBy(F.desc("total_readings"), "well_id", "source_format")
        .limit(k)
        .select(
            "well_id",
            "well_name",
            "source_format",
            "total_readings",
            "avg_amplitude",
            "anomaly_count",
            rate.alias("anomaly_rate_pct"),
        )
    )


def reading_statistics(readings: DataFrame) -> DataFrame:
    """One row: rows, wells, sorted survey types, depth and amplitude ranges."""
    return nan_to_null(readings).agg(
        F.count(F.lit(1)).alias("total_traces"),
        F.count_distinct("well_id").alias("unique_wells"),
        F.sort_array(F.collect_set("survey_type_id")).alias("survey_types"),
        F.min("depth_ft").alias("min_depth_ft"),
        F.max("depth_ft").alias("max_depth_ft"),
        F.min("amplitude").alias("min_amplitude"),
        F.max("amplitude").alias("max_amplitude"),
    )


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column; all columns in one pass."""
    df = nan_to_null(df)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.inline(cells))
    found = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = group_quantiles(long, ["column_name"], "value", [0.25, 0.5, 0.75])
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name STRING")
    return names.join(found, "column_name", "left").join(quartiles, "column_name", "left").select(
        "column_name",
        F.coalesce("count", F.lit(0)).alias("count"),
        "mean",
        "std",
        "min",
        *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))],
        "max",
    )


def load_check(analytics: DataFrame) -> DataFrame:
    """Rows loaded and the readings they stand for."""
    return analytics.agg(
        F.count(F.lit(1)).alias("wells"), F.coalesce(F.sum("reading_count"), F.lit(0)).alias("readings")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row count per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def freshness(moments: Sequence[DataFrame], as_of: str) -> DataFrame:
    """Newest of several one-column tables of load times, and its age in days at ``as_of``.

    Each table is reduced to its own maximum before the union.
    """
    newest = [m.agg(F.max(F.col(m.columns[0]).cast("timestamp_ntz")).alias("_t")) for m in moments]
    whole = reduce(DataFrame.unionByName, newest)
    return whole.agg(F.max("_t").alias("last_load_time")).withColumn(
        "days_since_load", F.datediff(F.lit(as_of).cast("date"), F.to_date("last_load_time"))
    )
