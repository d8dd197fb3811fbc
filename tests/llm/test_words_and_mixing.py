import re

import numpy as np
import pyarrow as pa
import pytest

from meterline.llm import mixing
from meterline.llm.common import numbered
from meterline.llm.words import ALNUM, SPACED, find_words, shingles

DOCS = "doc_id long, source string, text string, size string, _row string"
TEXTS = [None, "", " \t\x0b", "Hello  World", "É a\tB é", "a" * 50_000 + " b", "one two " * 3_000, "\x85x y z"]


def test_words_of_both_kinds_match_the_patterns():
    for kind, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = find_words(pa.array(TEXTS, pa.string()), kind)
        for i, text in enumerate(TEXTS):
            lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            words = [found.text(j).decode() for j in range(found.first[i], found.first[i + 1])]
            assert words == re.findall(pattern, lowered)


def test_equal_words_hash_alike_wherever_they_are():
    found = find_words(pa.array(["x Hello", "hello", "hell o"]), SPACED)
    hashes = found.hashes()
    assert hashes[1] == hashes[2] and len(set(hashes.tolist())) == 4


def test_shingles_are_distinct_runs_or_the_whole_sequence():
    sets = list(shingles(find_words(pa.array(["a b a b a", "a", None, "b", "a b"])), 2))
    assert [len(s) for s in sets] == [2, 1, 0, 1, 1]
    assert sets[4][0] in sets[0] and sets[1][0] != sets[3][0]


def test_numbers_are_gapless_in_order(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as k").repartition(5)
    rows = numbered(df, [df.k, df.id], "n", "numbers").collect()
    assert [r["n"] for r in sorted(rows, key=lambda r: (r["k"], r["id"]))] == list(range(1000))
    assert numbered(df.limit(0), [df.k], "n", "numbers").count() == 0


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, "clash", "clash") for row in rows], DOCS)


def test_targets_stop_at_the_bound_and_share_the_rest(spark):
    # words: a 10, b 100, null 90; weights 5, 2, 1 of 200 words
    rows = [(1, "a", "w " * 10), (2, "b", "w " * 100), (3, None, "w " * 90), (4, "b", None), (5, "b", "")]
    report = {r["doc_id"]: r for r in mixing.mix_report(docs_of(spark, rows)).collect()}
    assert report[1]["target"] == 30 and report[1]["taken"] == 30
    assert report[2]["target"] == pytest.approx(170 * 2 / 3)
    assert report[3]["target"] == pytest.approx(170 / 3)
    assert sum(report[i]["target"] for i in (1, 2, 3)) == pytest.approx(200)
    assert report[4]["size"] == 0 and report[4]["taken"] == 0
    assert all(r["taken"] <= 3 * r["size"] for r in report.values())


def test_copies_are_near_targets_and_reruns_agree(spark):
    draw = np.random.default_rng(1)
    rows = [(i, f"s{i % 4}", "w " * int(draw.integers(1, 60))) for i in range(2000)]
    docs = docs_of(spark, rows)
    first = sorted(mixing.mix_report(docs).collect())
    assert first == sorted(mixing.mix_report(docs.repartition(7)).collect())
    for source in range(4):
        mine = [r for r in first if r["doc_id"] % 4 == source]
        assert sum(r["taken"] for r in mine) == pytest.approx(mine[0]["target"], rel=0.01)
    emitted = mixing.mixed(docs)
    assert emitted.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in first}
    copies = {r["doc_id"]: r["count"] for r in emitted.groupBy("doc_id").count().collect()}
    assert all(taken[i] == len(text.split()) * copies.get(i, 0) for i, _, text in rows)


def test_mixing_of_nothing(spark):
    assert mixing.mix_report(docs_of(spark, [])).count() == 0
    alone = docs_of(spark, [(1, "a", ""), (None, None, None), (1, "a", "")])
    assert mixing.mixed(alone).count() == 3


def test_code_point_order_of_sources(spark):
    rows = [(1, "b", "w w w w"), (2, "B", "w w w w"), (3, "é", "w w w w"), (4, "\U0001f600", "w w w w")]
    targets = {r["doc_id"]: r["target"] for r in mixing.mix_report(docs_of(spark, rows)).collect()}
    # B weighs 5, b 2, é 1, and the fourth 5 again
    assert targets[2] == targets[4] > targets[1] > targets[3]
