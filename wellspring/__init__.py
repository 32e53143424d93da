"""Sensor data warehouse on Spark: functions from DataFrames to DataFrames.

The names below are the public surface; everything else is a detail of the
module it lives in.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions travel with their code, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from wellspring.api import Dashboard, extract_flags, parse_sgx, recover  # noqa: E402
from wellspring.functions import (  # noqa: E402
    as_documents,
    extract_patterns,
    fill_defaults,
    hash_diff,
    hash_key,
    marker_positions,
    nan_to_null,
    pct_change,
    quality_band,
    reading_key,
    with_audit,
)
from wellspring.operators.anomaly import (  # noqa: E402
    anomaly_rate,
    degrade_exact,
    degrade_sample,
    detect_anomalies,
    iqr_outliers,
    sample_fraction,
    sigma_flag,
    threshold_flag,
    z_score,
)
from wellspring.operators.history import (  # noqa: E402
    changed_rows,
    dedup_first,
    latest_version,
    scd2,
    validity,
    version_history,
)
from wellspring.operators.joins import (  # noqa: E402
    flag_where_in,
    insert_ignore,
    lookup_key,
    orphans,
    reference_counts,
    rejects,
    upsert,
)
from wellspring.operators.marts import (  # noqa: E402
    column_summary,
    freshness,
    kpi_stats,
    mart_sensor_analysis,
    mart_survey_summary,
    mart_well_performance,
    monthly_readings,
    quality_by_source,
    reading_statistics,
    table_counts,
    top_wells,
    well_analytics,
    wells_map,
)
from wellspring.operators.numbering import hand_out_keys, number_rows, slice_rows, spread_blocks, surrogate_key  # noqa: E402
from wellspring.operators.quality import gate, run_checks, success_rate, vault_rules  # noqa: E402
from wellspring.operators.quantiles import group_quantiles  # noqa: E402
from wellspring.operators.snapshots import (  # noqa: E402
    SnapshotStore,
    as_of,
    compare_snapshots,
    list_snapshots,
    read_snapshot,
    read_snapshots,
    snapshot_diff,
    snapshot_summary,
    write_snapshot,
)
from wellspring.operators.star import (  # noqa: E402
    assign_sensors,
    date_range,
    dim_data_source,
    dim_sensor,
    dim_time,
    dim_well,
    fact_rejects,
    fact_sensor_reading,
    fact_survey_event,
    refresh_dimension,
)
from wellspring.operators.vault import (  # noqa: E402
    build_hub,
    build_link,
    build_measurement_satellite,
    build_satellite,
    build_vault,
    denormalise,
    lineage,
    traverse,
    union_sources,
)
from wellspring.plans.file_vault import Landing, load_files, read_file_vault  # noqa: E402
from wellspring.plans.jobs import WarehouseInputs, run_daily, run_warehouse, write_vault  # noqa: E402
from wellspring.plans.vault_star import load_star, read_star  # noqa: E402
from wellspring.schemas import conform  # noqa: E402
from wellspring.session import build_session  # noqa: E402
from wellspring.sources.buckets import open_bucketed, write_bucketed  # noqa: E402
from wellspring.sources.files import list_sources, read_bytes, read_dir, read_master, read_table, read_vault, static_rows  # noqa: E402
from wellspring.sources.ranges import scan_files, triage_files  # noqa: E402
from wellspring.sources.repair import (  # noqa: E402
    classify_files,
    repair_dir,
    repair_manifest,
    repair_parquet,
    scan_files_for_patterns,
)
from wellspring.sources.sinks import (  # noqa: E402
    append_counted,
    append_table,
    export_marts,
    run_report,
    stage,
    to_csv,
    to_documents,
    to_jdbc,
    to_json,
    write_table,
)
from wellspring.sources.traces import read_sgx, read_trace_files, sgx_errors, sgx_headers, write_sgx  # noqa: E402
from wellspring.streaming.incremental import incremental_load, incremental_traces  # noqa: E402

__all__ = sorted(name for name in globals() if not name.startswith("_"))
