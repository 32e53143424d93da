"""Raw bytes in ranges against the same work on whole files."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from wellspring.functions.patterns import bytes_as_text, extract_all, extract_patterns, marker_positions
from wellspring.registry import damage
from wellspring.sources import files, ranges, repair


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(2)
    body = b"PAR1" + rng.randbytes(500) + b"PAR1" + rng.randbytes(300) + b"PAR1"
    lined = re.sub(rb"(.{64})", rb"\1\n", body.hex().encode())
    made = {
        "whole": body,
        "trailing": body + b"junk" * 9,
        "hex": body.hex().encode(),
        "hex_lines": lined,
        "hex_trailing": (body + b"tail").hex().encode().upper(),
        "hex_wide": re.sub(rb"(.{30})", rb"\1" + b" " * 5000, body.hex().encode()),
        "hex_broken": body.hex().encode() + b"zz",
        "hex_shifted": b"50415231" + b"0" + b"50415231" * 3 + b"0",
        "none": rng.randbytes(900).replace(b"PAR1", b"xxxx"),
        "late": b"x" + body,
        "single": b"PAR1 once",
    }
    for name, content in made.items():
        (tmp_path / f"{name}.parquet").write_bytes(content)
    return tmp_path, made


def want_triage(data):
    share = len(re.findall(rb"[0-9A-Fa-f]", data)) / len(data)
    was_hex = data[:2] in (b"50", b"35") and share > 0.9
    if was_hex:
        squeezed = re.sub(rb"\s", b"", data)
        data = bytes.fromhex(squeezed.decode()) if len(squeezed) % 2 == 0 and not re.search(rb"[^0-9A-Fa-f]", squeezed) else b""
    n, cut = data.count(b"PAR1"), data.rfind(b"PAR1") + 4 if b"PAR1" in data else 0
    return was_hex, n, cut


@pytest.mark.parametrize("size", [61, 333, 1 << 20])
def test_triage_is_the_same_for_any_range(spark, folder, size):
    path, made = folder
    found = {r.path.rsplit("/", 1)[1][:-8]: r for r in ranges.triage_files(spark, str(path), range_bytes=size).collect()}
    for name, data in made.items():
        r = found[name]
        assert (r.was_hex, r.n_markers, r.cut_at) == want_triage(data), name
        assert r.original_size == len(data)
    status = {n: r.status for n, r in found.items()}
    assert status == {
        "whole": "whole", "trailing": "trailing", "hex": "hex", "hex_lines": "hex", "hex_trailing": "hex_and_trailing", "hex_wide": found["hex_wide"].status,
        "hex_broken": "no_marker", "hex_shifted": "single_marker", "none": "no_marker", "late": "marker_not_first", "single": "single_marker",
    }


def test_triage_agrees_with_whole_file_triage(spark, folder):
    path, _ = folder
    of = {r.path: tuple(r)[1:] for r in repair.classify_files(spark, str(path)).collect()}
    for r in ranges.triage_files(spark, str(path), range_bytes=100).collect():
        if not any(n in r.path for n in ("hex_wide", "hex_broken", "hex_shifted")):  # judged by their first 100 bytes there
            assert tuple(r)[1:] == of[r.path], r.path


PATTERNS = [r"FLAG\{[A-Z0-9_]+\}", r"[a-z]+@[a-z]+", r"\bab\b", "aXa"]


@pytest.mark.parametrize("size", [37, 1 << 20])
def test_matches_are_the_same_for_any_range(spark, tmp_path, size):
    rng = random.Random(4)
    texts = {
        "a.txt": b"".join(rng.choice([b"FLAG{A_1}", b" ab ", b"xab", b"u@v", b"\xff\n", b"aXaXa", b"FLAG{"]) for _ in range(300)),
        "b.txt": b"no hit here",
        "c.txt": b"FLAG{" + b"Q" * 400 + b"}",
    }
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    for name, data in texts.items():
        (tmp_path / "one" / name).write_bytes(data)
    (tmp_path / "two" / "a.txt").write_bytes(texts["b.txt"] + b" u@v")
    got = sorted(
        (r.path.split("/")[-2], r.source_file, r.pattern_no, r.match, r.offset)
        for r in ranges.scan_files(spark, str(tmp_path), "*.txt", PATTERNS, size).collect()
    )
    want = []
    for place, name, data in [*(("one", n, d) for n, d in texts.items()), ("two", "a.txt", texts["b.txt"] + b" u@v")]:
        text = data.decode("latin-1")
        want += [(place, name, i, m.group(), m.start()) for i, p in enumerate(PATTERNS) for m in re.finditer(p, text, re.ASCII)]
    assert got == sorted(want)


@pytest.mark.parametrize("size", [37, 1 << 20])
def test_first_matches_are_those_of_whole_files(spark, tmp_path, size):
    rng = random.Random(6)
    pieces = [b"FLAG{A_1}", b" ab ", b"xab", b"u@v", b"\xff\n", b"aXaXa", b"FLAG{", b"(aa)", b"."]
    for i in range(40):
        filler = rng.choice([b".", b"x\n", b"xab"]) * rng.randrange(90)
        (tmp_path / f"{i:02}.txt").write_bytes(filler + b"".join(rng.choice(pieces) for _ in range(rng.randrange(9))))
    (tmp_path / "empty.txt").write_bytes(b"")
    patterns = [*PATTERNS, r"([a-z])\1", "XaX", "a*", "FLAG.A_1."]
    whole = files.read_bytes(spark, str(tmp_path), "*.txt").select(
        F.element_at(F.split("path", "/"), -1).alias("source_file"), bytes_as_text("content").alias("t")
    )
    want = sorted(tuple(r) for r in extract_patterns(whole, "t", patterns, ["source_file"]).collect())
    got = repair.scan_files_for_patterns(spark, str(tmp_path), "*.txt", patterns, range_bytes=size)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 60


def test_first_match_over_the_end_of_a_range(spark, tmp_path):
    (tmp_path / "big.txt").write_bytes(b"x" * ((16 << 20) - 3) + b"FLAG{A_1}" + b"y" * (17 << 20))
    assert [tuple(r) for r in repair.scan_files_for_patterns(spark, str(tmp_path), "*.txt").collect()] == [("big.txt", 0, "FLAG{A_1}", (16 << 20) - 3)]
    read = ranges.read_ranges(files.list_sources(spark, str(tmp_path)), ahead=1 << 20, behind=64)
    assert read.agg(F.max(F.length("content"))).first()[0] == (17 << 20) + 64  # and no more in a task


def test_a_file_beyond_two_gigabytes_is_cut_for_many_tasks(spark, tmp_path):
    """A sparse file, beyond what Spark hands over as one value."""
    path = tmp_path / "big.parquet"
    with open(path, "wb") as f:
        f.truncate(3 << 30)
        f.seek((3 << 30) - 4)
        f.write(b"PAR1")
    listed = files.list_sources(spark, str(tmp_path))
    cut = ranges.file_ranges(listed, 64 << 20)
    assert cut.count() == 48 and len({r[0] for r in cut.selectExpr("spark_partition_id()").distinct().collect()}) > 1
    one = ranges.triage_ranges(listed, 256 << 20).first()
    assert (one.original_size, one.n_markers, one.cut_at, one.status) == (3 << 30, 1, 3 << 30, "single_marker")


def test_all_matches_and_marker_places(spark):
    texts = ["aaa", "", None, "the thethe", "xthe", "noth", "the", " ab ab xab ab", "ab" * 2000, "é 12-3 12-4"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for marker in ("the", "aa", "ab", "("):
        got = {r[0]: r[1] for r in df.select("i", marker_positions("t", marker)).collect()}
        assert got == {i: None if t is None else [m.start() for m in re.finditer(f"(?={re.escape(marker)})", t)] for i, t in enumerate(texts)}
    patterns = [r"\bab\b", r"[0-9]+-[0-9]", "ab"]
    got = sorted(tuple(r) for r in extract_all(df, "t", patterns, ["i"]).collect())
    want, seen = [], set()
    for i, t in enumerate(texts):
        for n, p in enumerate(patterns):
            for m in re.finditer(p, t or ""):
                if (i, m.start(), m.group()) not in seen:
                    seen.add((i, m.start(), m.group()))
                    want.append((i, n, m.group(), m.start()))
    assert got == sorted(want)
    with pytest.raises(ValueError):
        extract_all(df, "t", ["a*"])


def test_files_are_found_in_tasks_as_spark_lists_them(spark, tmp_path):
    names = [
        "a.txt", "b.bin", ".hidden.txt", "_tmp.txt", "_metadata.txt", "_k=1.txt", "é ü+%20.txt", "in/c.txt", "in/deep/er/d.txt", "in/_no/e.txt", "in/.no/f.txt",
        "k=1/g.txt", "h.txt._COPYING_", "empty.txt", "_metadata/k.txt", "_metadata/_metadata", "two/i.csv", "two/j.tx",
    ]
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * (0 if name == "empty.txt" else i + 1))
    (tmp_path / "none").mkdir()
    places = [str(tmp_path), f"{tmp_path}/", f"file:{tmp_path}", f"file://{tmp_path}", f"{tmp_path}/{{in,two}}", f"{tmp_path}/a.txt", f"{tmp_path}/none"]
    for place in places:
        for glob in ("*", "*.{txt,csv}", "[^a]*.t?t") if place == str(tmp_path) else ("*.t*",):
            want = sorted(tuple(r) for r in files.list_sources(spark, place, glob).select("path", "length").collect())
            assert sorted(tuple(r) for r in files.find_files(spark, place, glob).collect()) == want, (place, glob)
    with pytest.raises(AnalysisException):
        files.find_files(spark, str(tmp_path / "missing"))


def test_many_small_files_are_not_listed_by_the_driver(spark, tmp_path):
    """The driver's file index holds every file, and plans a task for every 32 of them."""
    rows = spark.range(3000).select(F.col("id").cast("string").alias("name"), F.lit(b"u@v").alias("content"))
    damage.write_files(rows, str(tmp_path / "raw")).write.format("noop").mode("overwrite").save()
    assert 200 < len(list((tmp_path / "raw").iterdir())) <= 256
    for found in (ranges.scan_files(spark, str(tmp_path / "raw"), "*", PATTERNS, 100), ranges.triage_files(spark, str(tmp_path / "raw"), "*", 100)):
        assert found.count() == 3000
        assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
