"""Every stage of the corpus pipeline against a plain version of the same rules, and the quality distances on their own."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wellspring.llm import pii, quality_rules
from wellspring.llm.store import marked

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CHARS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\v\f\r", ".,;:", "!?'\"()-", "#*$%&|<>"]


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "in", "and"]) if rng.random() < 0.5 else f"wo{rng.choice('abcdefgh')}{rng.choice('klmnop')}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = [prose(rng, rng.choice([12, 60, 120])) for _ in range(60)]
    for t in texts[:8]:  # near copies, by one word
        w = t.split(" ")
        w[-1] = "changed"
        texts.append(" ".join(w))
    texts += texts[20:24]  # exact copies
    texts.append("again and again and " * 20)  # repeats itself
    texts += ["#$%&|<>*" * 60 + prose(rng, 12), " ".join(f"zq{i}" for i in range(90))]  # odd characters, odd words
    # long enough that chance alone doesn't part it from the language's words
    texts += [prose(rng, 150) + " mail ann.b@mail.example.com or 10.0.0.255 " + prose(rng, 60), None, "", "  \n", "six words are not quite enough"]
    out = [(i, t, ["en", "de"][i % 2], ["web", "book", None, "code"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    return [*out, out[30], (None, texts[31], "en", None, None)]


@pytest.fixture(scope="module")
def stages(spark, rows, tmp_path_factory):
    """The rows before every stage and after the last."""
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(folder / "documents.parquet"))
    docs, seen = spark.read.parquet(str(folder / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(list(map(tuple, docs.collect())))
        stage(spark, docs, str(folder)).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
    return [*seen, docs.collect()], str(folder)


def words(text):
    return WORD.findall(text or "")


def classes(text):
    counts = [sum(c in kind for c in text or "") for kind in CHARS]
    return [*counts, len(text or "") - sum(counts)]


def js_distance(p, q):
    bits = 0.0
    for a, b in zip(p, q, strict=True):
        m = (a + b) / 2
        bits += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(bits / 2, 0))


def verdicts(rows):
    """(char distance, word distance, kept) by plain counting."""
    by_lang, chars = {}, {}
    for _, text, lang, *_ in rows:
        by_lang.setdefault(lang, Counter()).update(words(text))
        chars[lang] = [a + b for a, b in zip(chars.get(lang, [0] * 8), classes(text), strict=True)]
    out = []
    for _, text, lang, *_ in rows:
        w, c = words(text), classes(text)
        seen, total = by_lang[lang], sum(by_lang[lang].values())
        common = sorted(x for x, n in seen.items() if n >= total * quality_rules.COMMON_SHARE)
        shares = [seen[x] / total for x in common]
        far = odd = None
        if w:
            mine = Counter(w)
            got = [mine[x] / len(w) for x in common]
            odd = js_distance([*got, max(0.0, 1 - sum(got))], [*shares, max(0.0, 1 - sum(shares))])
        if sum(c):
            far = js_distance([x / sum(c) for x in c], [x / sum(chars[lang]) for x in chars[lang]])
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        often = Counter(windows)
        repeated = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
        failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        odd_chars = sum(c) >= quality_rules.LEAST_CHARS and (far or 0) > quality_rules.CHAR_LIMIT
        odd_words = len(w) >= quality_rules.LEAST_WORDS and (odd or 0) > quality_rules.WORD_LIMIT
        out.append((far, odd, not failed and not odd_chars and not odd_words))
    return out


def test_quality_distances_against_plain_counting(spark, rows):
    got = sorted(quality_rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)
    want = sorted(((r[0], *v) for r, v in zip(rows, verdicts(rows), strict=True)), key=lambda r: str(r[0]))
    by_id = {}
    for r in want:
        by_id.setdefault(r[0], []).append(r[1:])
    for r in got:
        far, odd, kept = by_id[r.doc_id][0]
        assert r.kept == kept
        for mine, plain in ((r.char_distance, far), (r.word_distance, odd)):
            assert (mine is None) == (plain is None) and (plain is None or abs(mine - plain) < 1e-6)
    assert len(got) == len(rows)


@pytest.mark.parametrize("parts", [1, 3])
def test_languages_of_any_size_have_references(spark, rows, parts, monkeypatch):
    monkeypatch.setattr(quality_rules, "LANGUAGE_SHARE", 0.2)
    rng = random.Random(12)
    soup = "#$%&|<>*" * 60 + prose(rng, 60)
    small = [(1000 + i, prose(rng, 70), f"l{i % 9}", None, 1) for i in range(45)]
    small += [(2000, soup, "l1", None, 1), (2001, " ".join(f"zq{i}" for i in range(90)), "l2", None, 1), (2002, "", "l3", None, 1)]
    small += [(2003, " \n " * 80, "blank", None, 1), (2004, None, "none", None, 1), (2005, prose(rng, 80), None, None, 1)]
    # every word once in 600: no common word at all
    small += [(2006, " ".join(f"u{i}" for i in range(600)), "rare", None, 1)]
    docs = [*rows[:-1], *small]
    by_id = {r[0]: v for r, v in zip(docs, verdicts(docs), strict=True)}
    got = quality_rules.quality_rules(spark.createDataFrame(docs, SCHEMA).repartition(parts)).collect()
    assert len(got) == len(docs)
    for r in got:
        far, odd, kept = by_id[r.doc_id]
        assert r.kept == kept, r
        for mine, plain in ((r.char_distance, far), (r.word_distance, odd)):
            assert (mine is None) == (plain is None) and (plain is None or abs(mine - plain) < 1e-6)
    assert not by_id[2000][2] and not by_id[2001][2] and by_id[1003][2]


def test_quality_stage_keeps_what_the_rules_keep(stages, rows):
    before, after = stages[0][0], stages[0][1]
    want = [r for r, (_, _, kept) in zip(before, verdicts(before), strict=True) if kept]
    assert Counter(after) == Counter(want) and 0 < len(want) < len(rows)


def test_one_row_of_each_group_of_near_duplicates_stays(stages):
    before, after = stages[0][1], stages[0][2]
    sets = []
    for r in before:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    group = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, r in zip(group, before, strict=True):
        least.setdefault(g, []).append((r[0] is None, r[0] or 0))
    assert Counter((r[0] is None, r[0] or 0) for r in after) == Counter(min(ids) for ids in least.values())
    assert set(after) <= set(before) and len(after) < len(before)


def test_personal_data_goes_and_other_rows_stay_as_they_were(stages):
    before, after = sorted(stages[0][2], key=str), sorted(stages[0][3], key=str)
    assert [r[0] for r in before] == [r[0] for r in after]
    assert any(pii.base_spans(r[1]) for r in before) and not any(pii.base_spans(r[1]) for r in after)
    for a, b in zip(before, after, strict=True):
        assert a[2:4] == b[2:4] and (a == b or re.search(r"<(email|ip|card|phone)>", b[1]) and b[4] == len(b[1]))


def test_mix_takes_near_its_targets_and_at_most_three_copies(stages):
    before, after = stages[0][3], stages[0][4]
    copies, there = Counter(after), Counter(before)
    assert set(copies) <= set(there) and all(n <= 3 * there[r] for r, n in copies.items())
    sources = sorted({r[3] for r in before}, key=lambda s: (s is None, s or ""))
    size = {s: sum(len(words(r[1])) for r in before if r[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    capped: set = set()
    while True:
        free = [s for s in sources if s not in capped]
        unit = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit > 3 * size[s]}
        if not over:
            break
        capped |= over
    for s in sources:
        target = 3 * size[s] if s in capped else weight[s] * unit
        assert abs(sum(len(words(r[1])) for r in after if r[3] == s) - target) <= 0.03 * target + 12


def test_packing_places_every_word_once(stages):
    before, after = stages[0][4], stages[0][5]
    want, got = Counter(), Counter()
    for r in before:
        want[r[0]] += len(words(r[1]))
    for r in after:
        got[r.doc_id] += r.n_words
    assert got == want
    used = Counter()
    for r in after:
        used[(r.bin_id, r.bin_length)] += r.n_words
    assert len({b for b, _ in used}) == len(used) and all(n <= length for (_, length), n in used.items())


def test_run_gives_the_rows_of_its_stages(spark, stages):
    seen, folder = stages
    got = corpus_pipeline.run(spark, folder).collect()
    assert sum(r.n_words for r in got) == pytest.approx(sum(r.n_words for r in seen[5]), rel=0.05)
    assert {r.doc_id for r in got} <= {r[0] for r in seen[3]}


def test_an_empty_table_goes_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_taken_once_are_not_joined(spark):
    rows = [(i, f"text {i}", None if i % 3 else "en", "web", i) for i in range(1000)] + [(7, "text 7", None, "web", 7), (None, None, None, None, None)]
    keyed = corpus_pipeline._keyed(spark.createDataFrame(rows, SCHEMA).repartition(3))
    of_key = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("id"))
    copies = F.when(F.col("id") == 7, 2).when(F.col("id") == 8, 0).when(F.col("id") == 9, 3).otherwise(F.col("rows"))
    verdicts = of_key.select("key", copies.cast("long").alias("copies"), "rows")
    joined = marked(keyed, "key", verdicts.filter("copies != 1 or rows != 1")).filter("met").select("doc_id").collect()
    assert {7, 8, 9} <= {r.doc_id for r in joined} and len(joined) < 10
    want = Counter(rows) - Counter([rows[8]]) + Counter([rows[9]] * 2)
    assert Counter(map(tuple, corpus_pipeline._rows_of(keyed, verdicts).collect())) == want
