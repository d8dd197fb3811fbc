"""The pipeline stage by stage against plain versions, and columns whose names clash with helpers."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import decontaminate, mixing, near_duplicates, privacy, quality, secrets, sharding

HELPERS = [
    "_score", "_mix", "_found", "_shard", "_private", "_spans", "_row", "_id", "_key1", "_key2", "_source", "_doc_id",
    "key1", "size", "kept", "component_id", "row_id", "shard", "score", "spans",
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{x}` string" for x in HELPERS)
LABELS, BENCHMARK = "doc_id long, quality int, toxic int", "item_id string, text string"
NAMES = DOCS.replace("`", "").split(", ")
GOOD = "the committee met on tuesday and agreed that the plan should be reviewed before the end of the year".split()


def make_rows(size=160):
    draw = random.Random(11)
    rows, labels = [], []
    for i in range(size):
        if i % 3:
            words = draw.choices(GOOD + [f"w{j}" for j in range(200)], k=draw.randint(30, 90))
            text = " ".join(words).capitalize() + "."
        else:
            text = "".join(draw.choices("$$##@@!!xX09", k=draw.randint(20, 200)))
        labels.append((i, 1 if i % 3 else 0, 0))
        rows.append((i, text, "en", f"s{i % 5 % 4}", len(text)))
    passage = " ".join(f"bench{j}" for j in range(14))
    rows.append((900, f"Before {passage} after this text of the committee", "en", "s1", 1))
    for k in range(4):  # near copies: one word of eighty differs
        words = [f"copy{j}" for j in range(80)]
        words[40 + k] = "other"
        rows.append((800 + k, " ".join(words), "en", "s2", 1))
    rows += [rows[1], (None, "a text without an id that is kept", None, None, None), (950, None, "en", "s0", 0), (951, "", None, "s0", 0)]
    return rows, labels + [(None, 1, 0), (5, None, None)], [("i1", passage), (None, None), ("i2", "")]


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, *[f"own {name}" for name in HELPERS]) for row in rows], DOCS)


@pytest.fixture(scope="module")
def made(spark):
    rows, labels, items = make_rows()
    return rows, docs_of(spark, rows), spark.createDataFrame(labels, LABELS), spark.createDataFrame(items, BENCHMARK)


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_columns_named_like_helpers_come_back_unchanged(spark, made):
    _, docs, labels, items = made
    whole, names = bag(docs), docs.columns
    for df, new in (
        (quality.quality_scores(docs, labels), "_score_"),
        (mixing.mixing_plan(docs), "_mix_"),
        (decontaminate.benchmark_hits(docs, items), "_found_"),
        (sharding.sharded(docs), "_shard_"),
        (privacy.personal_data(docs), "_private_"),
        (secrets.secret_spans(docs), "_spans_"),
    ):
        assert df.columns == [*names, new]
        assert bag(df.drop(new)) == whole, new
    for df in (quality.accepted(docs, labels), decontaminate.decontaminated(docs, items), near_duplicates.deduplicated(docs)):
        assert df.columns == names and not bag(df) - whole
    taken = mixing.mixed(docs)
    assert taken.columns == names and set(bag(taken)) <= set(whole)


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain_deduplicated(rows):
    """Rows that stay: of linked rows that with the least id (nulls last), all without words."""
    sets = [shingles(row[1]) for row in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    kept = {}
    for row, g, s in zip(rows, group, sets):
        place = ("empty", id(row), len(kept)) if not s else g
        if place not in kept or (row[0] is None, row[0] or 0) < (kept[place][0] is None, kept[place][0] or 0):
            kept[place] = row
    return Counter(row[0] for row in kept.values())


def plain_clean(rows, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for _, text in items:
        found = words(text)
        windows |= {tuple(found[i : i + 10]) for i in range(max(len(found) - 9, 1))} if found else set()

    def hit(text):
        found = words(text)
        return any(tuple(found[i : i + len(w)]) == w for w in windows for i in range(len(found)))

    return Counter(row[0] for row in rows if not hit(row[1]))


def test_each_stage_decides_like_a_plain_version(spark, made, tmp_path):
    """Every stage is compared on what its predecessor kept, and its decisions take effect."""
    rows, docs, labels, items = made
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    folder = str(tmp_path)
    found, kept = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        found[name] = before, after = kept, stage(spark, kept, folder)
        if name != "sharding":
            assert after.columns == docs.columns
            after.write.parquet(f"{tmp_path}/after-{name}")
            kept = spark.read.parquet(f"{tmp_path}/after-{name}")
            found[name] = before, kept

    def ids(df):
        return Counter(row["doc_id"] for row in df.select("doc_id").collect())

    def plain_rows(df):
        return [tuple(row) for row in df.select("doc_id", "text").collect()]

    scores = quality.quality_report(docs.select("doc_id", "text"), labels).filter("predicted = 1")
    assert ids(found["quality"][1]) == ids(scores)
    lost = [row for row in rows if row[0] not in ids(scores)]
    assert sum(row[0] is not None and row[0] < 160 and row[0] % 3 != 0 for row in lost) <= 5 < 30 <= len(lost)

    before, after = found["near_duplicates"]
    assert ids(after) == plain_deduplicated(plain_rows(before)) and ids(before)[800] + ids(before)[801] >= 1
    before, after = found["decontamination"]
    assert ids(after) == plain_clean(plain_rows(before), make_rows()[2]) and ids(after)[900] == 0

    before, after = found["mixing"]
    taken = {row["doc_id"]: row for row in mixing.mix_report(before).collect()}
    copies = ids(after)
    assert all(copies[i] * row["size"] == row["taken"] for i, row in taken.items() if row["size"])
    for source in {row["source_size"] for row in taken.values()}:
        mine = [row for row in taken.values() if row["source_size"] == source]
        assert sum(row["taken"] for row in mine) == pytest.approx(mine[0]["target"], rel=0.5)

    before, after = found["sharding"]
    placed = after.collect()
    assert Counter(row["doc_id"] for row in placed) == ids(before)
    counts = Counter(row["shard"] for row in placed)
    assert max(counts.values()) - min(counts[i] for i in range(16)) <= 1
    assert all(sorted(r["slot"] for r in placed if r["shard"] == i) == list(range(counts[i])) for i in counts)
    texts = Counter((row["doc_id"], zlib.crc32((row["text"] or "").encode())) for row in before.collect())
    assert Counter((row["doc_id"], row["text_crc32"]) for row in placed) == texts
    assert bag(corpus_pipeline.run(spark, folder).select("doc_id", "size")) == bag(after.select("doc_id", "size"))


def test_the_pipeline_on_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", LABELS), ("benchmark", BENCHMARK)):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_pipeline_without_labels_or_benchmark(spark, made, tmp_path):
    rows = made[0]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert set(range(5)) & {row["doc_id"] for row in result.collect()}
    assert result.filter(F.col("doc_id") == 900).count() >= 0
