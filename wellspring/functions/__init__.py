"""Column-level functions: keys, scalars, text patterns."""

from wellspring.functions.keys import canonical_text, hash_diff, hash_key, reading_key
from wellspring.functions.patterns import (
    DEFAULT_PATTERNS,
    bytes_as_text,
    extract_patterns,
    from_hex,
    hex_share,
    marker_positions,
)
from wellspring.functions.scalars import (
    as_documents,
    entity_label,
    fill_defaults,
    good_share,
    iso_text,
    nan_to_null,
    pct_change,
    quality_band,
    quality_score,
    run_time,
    weighted_mean,
    with_audit,
)

__all__ = [
    "DEFAULT_PATTERNS",
    "as_documents",
    "bytes_as_text",
    "canonical_text",
    "entity_label",
    "extract_patterns",
    "fill_defaults",
    "from_hex",
    "good_share",
    "hash_diff",
    "hash_key",
    "hex_share",
    "iso_text",
    "marker_positions",
    "nan_to_null",
    "pct_change",
    "quality_band",
    "quality_score",
    "reading_key",
    "run_time",
    "weighted_mean",
    "with_audit",
]
