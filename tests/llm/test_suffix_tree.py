"""The tree's probabilities decide a text's score, for known and for unseen words."""

import zlib

from wellspring.llm.suffix_tree_lm import suffix_tree_scores


def test_what_stands_before_decides_known_and_unseen_words(spark):
    train = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(900, 1000) if zlib.crc32(str(i).encode()) % 5 == 1][:4]
    # "up" and "down" by turns; after "new" always a word seen once, after "old" always the same one
    rows = [(i, "up down " * 20 + f"old same new zip{i}") for i in train]
    rows += [(held[0], "up down " * 20), (held[1], "up up down down " * 10)]
    rows += [(held[2], "up down old same new zest"), (held[3], "up down old zest new same")]
    got = {r.doc_id: r for r in suffix_tree_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    turns, pairs, after_new, after_old = (got[i] for i in held)
    assert all(got[i].held_out for i in held) and abs(turns.base_score - pairs.base_score) < 1e-9
    # words alone give log10(0.5) a word or less, whatever their order
    assert turns.score / 40 > -0.25 and pairs.score < turns.score - 10
    assert after_new.n_known == after_old.n_known and after_new.score > after_old.score + 1


def test_probabilities_after_a_context_sum_to_one_at_most(spark):
    text = "cab ab a bac abba b ab"
    rows = [(0, text)] * 50  # doc_id 0 is a training row
    heads = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]
    known = sorted(set(text.split()))
    nexts = [*(f"ab {w}" for w in known), "ab zzz"]
    rows += [(i, t) for i, t in zip(heads, [*nexts, "ab"], strict=False)]
    # a word's own end: of "ab w" all but the text's end, which is scored after it
    got = {r.doc_id: r.score for r in suffix_tree_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    total = sum(10 ** got[i] for i, _ in zip(heads, nexts, strict=False)) + 10 ** got[heads[len(nexts)]]
    assert 0 < total <= 1
