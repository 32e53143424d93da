"""Pattern, marker and hex helpers over text and decoded bytes."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published default pattern list.
DEFAULT_PATTERNS = [
    r"FLAG\{[A-Z0-9_]+\}",
    r"flag\{[a-z0-9_]+\}",
    r"CTF\{[^\}]+\}",
    r"CPETRO\{[^\}]+\}",
]


def bytes_as_text(content: str | Column = "content") -> Column:
    """One character per byte, so that character offsets are byte offsets."""
    return F.decode(content, "ISO-8859-1")


def extract_patterns(
    df: DataFrame, text: str | Column, patterns: Sequence[str] = DEFAULT_PATTERNS, keep: Sequence[str] = ()
) -> DataFrame:
    """First match of each pattern per row: ``keep`` columns, pattern_no, match, 0-based offset.

    The same text matched by two patterns is reported once, for the first of
    them. Rows without a match give nothing.
    """
    text = F.col(text) if isinstance(text, str) else text
    found = [
        F.struct(F.lit(i).alias("pattern_no"), F.regexp_extract(text, p, 0).alias("match"))
        for i, p in enumerate(patterns)
    ]
    hits = F.filter(F.array(*found), lambda h: h["match"] != "")
    # A projection of its own, so that each pattern is searched once per text.
    searched = df.select(*keep, text.alias("_text"), hits.alias("_hits")).filter(F.size("_hits") > 0)
    texts = F.transform("_hits", lambda h: h["match"])
    # A hit repeats an earlier one if its text first stands elsewhere in the list.
    firsts = F.filter("_hits", lambda h, i: F.array_position(texts, h["match"]) == i + 1)
    placed = F.transform(
        firsts,
        lambda h: F.struct(
            h["pattern_no"].alias("pattern_no"),
            h["match"].alias("match"),
            (F.position(h["match"], F.col("_text")) - 1).alias("offset"),
        ),
    )
    return searched.select(*keep, F.inline(placed))


def extract_all(
    df: DataFrame, text: str | Column, patterns: Sequence[str] = DEFAULT_PATTERNS, keep: Sequence[str] = ()
) -> DataFrame:
    """Every match of every pattern: ``keep`` columns, pattern_no, match, 0-based offset.

    A place that two patterns match with the same text is reported once, for the
    first of them. A pattern must not match the empty string. All of it runs in
    the JVM: a text is split at its matches, and running lengths of the pieces
    give the offsets.
    """
    for p in patterns:
        if re.search(p, ""):
            raise ValueError(f"{p!r} matches the empty string")
    text = F.col(text) if isinstance(text, str) else text
    count = range(len(patterns))
    searched = df.select(*keep, text.alias("_text"))
    found = [F.regexp_extract_all("_text", F.lit(p), F.lit(0)).alias(f"_m{i}") for i, p in enumerate(patterns)]
    searched = searched.select(*keep, "_text", *found).filter(reduce(lambda a, b: a | b, [F.size(f"_m{i}") > 0 for i in count]))
    hits = [_placed(p, i) for i, p in enumerate(patterns)]
    placed = searched.select(*keep, F.array_sort(F.concat(*hits)).alias("_hits"))

    def first(h: Column, i: Column) -> Column:
        before = F.get("_hits", i - 1)
        return (i == 0) | (before["offset"] != h["offset"]) | (before["match"] != h["match"])

    return placed.select(*keep, F.inline(F.filter("_hits", first))).select(*keep, "pattern_no", "match", "offset")


def _placed(pattern: str, number: int) -> Column:
    """(offset, match, pattern_no) of all matches, which stand in ``_m<number>``."""
    matched, pieces = F.col(f"_m{number}"), F.split("_text", pattern, -1)
    # ends of the matches
    steps = F.zip_with(F.slice(pieces, 1, F.size(matched)), matched, lambda a, m: F.char_length(a) + F.char_length(m))
    ends = F.when(F.size(matched) > 0, running_sums(steps)).otherwise(F.array().cast("array<bigint>"))
    return F.zip_with(
        matched,
        ends,
        lambda m, e: F.struct((e - F.char_length(m)).alias("offset"), m.alias("match"), F.lit(number).alias("pattern_no")),
    )


_BLOCK = 256  # elements a fold copies at most


def running_sums(values: Column) -> Column:
    """Running sums of an array of numbers, as longs. In blocks, since every step of a fold copies what it has built."""
    return _once(values, _sums_of)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _sums_of(values: Column) -> Column:
    nothing = F.array().cast("array<bigint>")

    def inside(block: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("out"))

        def step(s: Column, x: Column) -> Column:
            at = s["at"] + x
            return F.struct(at.alias("at"), F.concat(s["out"], F.array(at)).alias("out"))

        return F.aggregate(block, start, step, lambda s: s["out"])

    starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(_BLOCK))
    blocks = F.transform(starts, lambda b: inside(F.slice(values, b + 1, _BLOCK)))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))

    def join(s: Column, block: Column) -> Column:
        end = s["at"] + F.coalesce(F.try_element_at(block, F.lit(-1)), F.lit(0))
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.transform(block, lambda x: x + s["at"]))).alias("out"))

    return F.aggregate(blocks, start, join, lambda s: F.flatten(s["out"]))


def marker_positions(text: str | Column, marker: str) -> Column:
    """All 0-based positions of a marker, overlapping ones too; the text is split where a marker begins."""
    if not marker:
        raise ValueError("marker must not be empty")
    text = F.col(text) if isinstance(text, str) else text
    none = F.array().cast("array<bigint>")

    def starts(pieces: Column) -> Column:
        lengths = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.char_length(p))
        later = F.when(F.size(pieces) > 1, running_sums(lengths)).otherwise(none)
        return F.concat(F.when(text.startswith(marker), F.array(F.lit(0).cast("long"))).otherwise(none), later)

    # a lookahead consumes nothing, so the next match may start inside this one
    return F.when(text.isNotNull(), _once(F.split(text, f"(?={re.escape(marker)})", -1), starts))


def hex_share(text: str | Column, sample: int | None = None) -> Column:
    """Share of hex digits in the text, or in its first ``sample`` characters."""
    text = F.col(text) if isinstance(text, str) else text
    if sample is not None:
        text = F.substring(text, 1, sample)
    return F.try_divide(F.length(F.regexp_replace(text, "[^0-9A-Fa-f]", "")), F.length(text))


def from_hex(text: str | Column) -> Column:
    """Bytes of hex text, white space ignored; null where it is not hex."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.regexp_replace(text, r"\s", ""))
