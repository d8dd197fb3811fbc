"""Near-duplicate documents and vectors, components and shards against brute force."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import embeddings, language_model, near_duplicates, quality, sharding
from meterline.llm.components import components


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cliques(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(200, 201), (201, 200), (300, 300)]
    links += [(draw.randrange(400, 500), draw.randrange(400, 500)) for _ in range(60)]
    draw.shuffle(links)
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for link in links for n in link if link[0] != link[1]}
    assert {n: got[n] for n in nodes} == roots_of(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@pytest.fixture(scope="module")
def families():
    """Families of edited copies around the threshold, unrelated texts, exact copies and odd ones."""
    draw = random.Random(7)
    vocabulary = [f"v{i}" for i in range(300)]
    texts = []
    for family in range(12):
        origin = draw.choices(vocabulary, k=draw.randint(5, 120))
        for _ in range(draw.randint(1, 9)):
            words = list(origin)
            for _ in range(draw.randint(0, max(1, len(words) // 12))):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts.append(" ".join(words))
        texts += [texts[-1].upper()] * (family % 3)
    origin = draw.choices(vocabulary, k=80)
    for i in range(200):  # a group larger than a node that is compared exhaustively
        words = list(origin)
        words[i % 80] = f"new{i}"
        texts.append(" ".join(words))
    texts += [" ".join(draw.choices(vocabulary, k=40)) for _ in range(60)]
    texts += ["the same line", *[f"the same line {i}" for i in range(40)], "a", "a", "A b", "", "", " \t"]
    return texts


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, families, width):
    rows = list(enumerate(families)) + [(len(families), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as signature", "0 as path")
    sets = {i: shingle_set(text, width) for i, text in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = roots_of(sets, links)
    got = near_duplicates.near_duplicates(docs, width, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(rows)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == want[r["doc_id"]]) for r in got)
    kept = near_duplicates.deduplicated(docs, width, 80)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in want if want[i] == i}


def test_every_branch_has_coordinates_of_its_own(spark):
    branches = near_duplicates.TREES * near_duplicates.ROOT_BRANCHES
    width = near_duplicates.INNER_COORDINATES
    sketch = near_duplicates._SKETCH
    roots = [(i, 9, [int(i == j) for j in range(branches)], *[0] * len(sketch)) for i in range(branches)]
    kinds = "class_id long, n_shingles long, signature array<int>, " + ", ".join(f"{name} long" for name in sketch)
    classes = spark.createDataFrame(roots, kinds)
    paths = {}
    for row in near_duplicates._root_members(classes).collect():
        paths.setdefault(row["branch"], {})[row["class_id"]] = row["path"]
    # one coordinate each, and no branch goes by that of another
    for branch, found in paths.items():
        assert [i for i in found if list(found.values()).count(found[i]) == 1] == [branch]
    # nodes below a branch see its own part of the inner coordinates only
    inner = [bytes(1 if i == j // width else 0 for j in range(branches * width)) for i in range(branches)]
    signatures = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(inner)], "class_id long, inner binary")
    together = near_duplicates._root_members(classes).withColumn("path", F.col("branch").cast("long"))
    nodes = near_duplicates._children(together, 2, signatures).groupBy("branch", "path")
    for row in nodes.agg(F.collect_list("class_id").alias("ids")).collect():
        assert row["ids"] == [row["branch"]] or row["branch"] not in row["ids"] and len(row["ids"]) == branches - 1


def test_near_duplicates_below_branching_nodes(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "SMALL_NODE", 4)
    monkeypatch.setattr(near_duplicates, "FIRST_NODE", 2)
    monkeypatch.setattr(near_duplicates, "MOST_LEVELS", 2)
    branched, children = [], near_duplicates._children
    monkeypatch.setattr(near_duplicates, "_children", lambda *a: branched.append(1) or children(*a))
    # families share a passage of 60 of 100 words, so that nodes hold several components
    draw = random.Random(3)
    passage, texts = [f"p{i}" for i in range(60)], []
    for family in range(12):
        own = [f"f{family}x{i}" for i in range(40)]
        texts += [" ".join(passage + own[:39] + [f"n{draw.random()}"]) for _ in range(6)]
    rows = list(enumerate(texts))
    sets = {i: shingle_set(text, 2) for i, text in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == roots_of(sets, links) and branched


def test_near_copies_are_listed_with_one_leader_first(spark, monkeypatch):
    """Pairs that come to confirmation stay near the number of copies, and all copies are found."""
    asked, consider = [], near_duplicates._Links.consider
    monkeypatch.setattr(
        near_duplicates._Links, "consider", lambda self, pairs: asked.append(pairs.distinct().count()) or consider(self, pairs)
    )
    text = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(text[: i % 110] + [f"x{i}"] + text[i % 110 + 1 :])) for i in range(400)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 400
    assert sum(asked) < 4 * 400


def test_pairs_below_the_threshold_are_listed_once(spark, monkeypatch):
    """Members of several nodes of the first level meet in one of them."""
    listed, store = [], near_duplicates.stored

    def seen(df, label):
        kept = store(df, label)
        if label == "near":
            listed.append((kept.count(), kept.distinct().count()))
        return kept

    monkeypatch.setattr(near_duplicates, "stored", seen)
    monkeypatch.setattr(near_duplicates, "FIRST_NODE", 2)
    shared = [f"p{i}" for i in range(85)]
    rows = [(i, " ".join(shared + [f"f{i}x{j}" for j in range(14)])) for i in range(40)]
    rows += [(40 + i, " ".join(shared + [f"f{i}x{j}" for j in range(13)] + ["end"])) for i in range(40)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    sets = {i: shingle_set(text, 2) for i, text in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {r["doc_id"]: r["component_id"] for r in got} == roots_of(sets, links)
    assert listed[0][0] == listed[0][1] > 500


def edited_copies(count):
    """Copies of one text with up to 24 changed words, in lists that say how many."""
    draw = random.Random(11)
    origin = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(count):
        words = list(origin)
        for place in draw.sample(range(150), draw.choice([0, 1, 1, 2, 2, 3, 4, 6, 9, 10, 12, 16, 24])):
            words[place] = f"n{i}x{place}" if draw.random() < 0.9 else f"n{place}"
        texts.append(" ".join(words))
    return list(enumerate(dict.fromkeys(texts)))


def links_of(rows, width):
    sets = {i: shingle_set(text, width) for i, text in rows}
    return sets, [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]


@pytest.mark.parametrize("width, count", [(2, 420), (5, 800)])
def test_pairs_just_below_the_threshold_are_not_all_listed(spark, monkeypatch, width, count):
    """Copies too far from the rest for a link, but not for sketches, are told from it by their rare shingles."""
    rows, stores, store = edited_copies(count), [], near_duplicates.stored

    def seen(df, label):
        kept = store(df, label)
        stores.append((label, kept.count()))
        return kept

    monkeypatch.setattr(near_duplicates, "stored", seen)
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == roots_of(*links_of(rows, width))
    assert sum(n for label, n in stores if label in ("near", "pairs")) < 12 * len(rows)


@pytest.mark.parametrize("width", [2, 5])
def test_rare_shingles_find_every_link(spark, families, width):
    rows = [(i, text) for i, text in enumerate(dict.fromkeys(families)) if text.split()] + [(5000 + i, x) for i, x in edited_copies(60)]
    rows += [(9000, "a b"), (9001, "A  b"), (9002, " ".join(f"w{i}" for i in range(125)))]
    sets, links = links_of(rows, width)
    texts = spark.createDataFrame(rows, "class_id long, text string")
    members = texts.select("class_id", F.col("class_id").alias("root"), *[F.lit(0).cast("long").alias(x) for x in near_duplicates._SKETCH])
    rare = near_duplicates._rare_shingles(texts, width, 80)
    assert all(r["place"] <= len(sets[r["class_id"]]) / 5 + 1 and r["n_shingles"] == len(sets[r["class_id"]]) for r in rare.collect())
    pairs = near_duplicates._pairs_by_rare_shingles(members, rare, 80, F.lit(True)).select("a", "b").distinct().collect()
    found = {tuple(r) for r in pairs}
    assert set(links) <= found and len(links) > 300 and all(a < b for a, b in found)
    # members of one component are not listed
    joined = members.withColumn("root", F.least("root", F.lit(5000)))
    pairs = near_duplicates._pairs_by_rare_shingles(joined, rare, 80, F.lit(True)).select("a", "b").distinct().collect()
    assert {tuple(r) for r in pairs} == {(a, b) for a, b in found if a < 5000}


def test_the_central_leader_is_nearest_to_all(spark):
    origin = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(origin))]
    rows += [(i, " ".join(f"x{i}y{j}" if j % 30 == i % 30 else word for j, word in enumerate(origin))) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    large = near_duplicates.signed_documents(docs, 2).withColumnRenamed("doc_id", "class_id").withColumn("path", F.lit(7).cast("long"))
    assert [r["class_id"] for r in near_duplicates._central(large).collect()] == [0]


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "x y z"), (None, "a b c d"), (None, "q r s"), (3, None), (3, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.near_duplicates(docs, 2, 80).collect()
    found = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got)
    assert found == sorted(
        [("1", "1", True), ("1", "1", True), ("2", "2", True), ("None", "1", False), ("None", "None", True), ("3", "3", True), ("3", "2", False)]
    )
    assert near_duplicates.deduplicated(docs, 2, 80).count() == 4
    assert near_duplicates.near_duplicates(docs.limit(0)).count() == 0


def test_vectors_equal_all_pairs(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(60):
        centre = draw.normal(size=32)
        for _ in range(int(draw.integers(1, 6))):
            near = centre + draw.normal(size=32) * draw.choice([0.02, 0.2, 0.3])
            rows.append((len(rows), [float(x) for x in near.astype(np.float32)], int(i % 3)))
    rows += [(1000 + i, rows[0][1], 0) for i in range(5)] + [(2000, [2 * x for x in rows[0][1]], 0), (2001, rows[0][1], None)]
    rows += [(3000, None, 0), (3001, [0.0] * 32, 0), (3002, [float("nan")] * 32, 0), (3003, [None, 1.0], 0), (3004, [], 0)]
    rows += [(3005, [float("inf")] * 32, 0), (3006, [1.0, 2.0], 0), (3007, [2.0, 4.0], 0), (3008, rows[0][1][:-1], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as class_id")
    usable = {i: (np.array(v, float), k) for i, v, k in rows if k is not None and v and None not in v}
    usable = {i: x for i, x in usable.items() if np.isfinite(x[0]).all() and x[0].any()}

    def cosine(x, y):
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y))

    links = [
        (a, b)
        for a, (x, k) in usable.items()
        for b, (y, m) in usable.items()
        if a < b and k == m and len(x) == len(y) and cosine(x, y) >= 0.93
    ]
    want = roots_of([r[0] for r in rows], links)
    got = embeddings.near_duplicate_vectors(vectors).collect()
    assert len(got) == len(rows) and {r["vec_id"]: r["component_id"] for r in got} == want
    assert all(r["n_links"] == sum(r["vec_id"] in link for link in links) for r in got)
    assert embeddings.near_duplicate_vectors(vectors.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(400, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    other = vectors + 0.1 * draw.normal(size=vectors.shape)
    other /= np.linalg.norm(other, axis=1)[:, None]
    codes = [embeddings.encode(v) for v in vectors]
    signs, factors = np.stack([c[0] for c in codes]), np.stack([c[1] for c in codes])
    value, error = embeddings.estimate(signs, factors, other @ embeddings.rotations(64).T, 64)
    off = value - (vectors * other).sum(1)
    assert abs(off.mean()) < 0.01 and (np.abs(off) <= error).all()


@pytest.mark.parametrize("dimension", [3, 256, 384, 1024])
def test_long_vectors_are_sorted_out_by_their_codes(spark, monkeypatch, dimension):
    """Not all pairs below the limit are computed exactly, and no pair at the limit is lost."""
    draw = np.random.default_rng(dimension)
    rows = []
    for _ in range(12):
        centre = draw.normal(size=dimension)
        for _ in range(6):  # cosines from about 0.7 to 1
            rows.append((len(rows), (centre + draw.normal(size=dimension) * draw.choice([0.05, 0.25, 0.65])).tolist(), 1))
    exact, seen = embeddings._exact, []

    def counted(pairs):
        seen.append(pairs.count())
        return exact(pairs)

    monkeypatch.setattr(embeddings, "_exact", counted)
    got = embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    units = np.array([r[1] for r in rows]) / np.linalg.norm([r[1] for r in rows], axis=1)[:, None]
    cosines = np.triu(units @ units.T, 1)
    links = [tuple(map(int, x)) for x in np.argwhere(cosines >= embeddings.LIMIT)]
    assert {r["vec_id"]: r["component_id"] for r in got} == roots_of(range(len(rows)), links)
    assert len(links) <= sum(seen)
    if dimension > 256:
        assert sum(seen) <= 0.85 * (cosines >= 0.6).sum()


def shard_rows(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "9 as shard")
    return sharding.shard_report(docs, 16).collect(), docs


def test_shards_are_even_gapless_and_keep_groups(spark):
    draw = random.Random(1)
    texts = [f"group {draw.randrange(60)}" for _ in range(300)] + [f"single {i}" for i in range(703)] + [None, None, "", ""]
    rows, docs = shard_rows(spark, texts)
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    by_shard = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(16)}
    sizes = [len(slots) for slots in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1 and all(slots == list(range(len(slots))) for slots in by_shard.values())
    shards = {}
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text or "").encode())
        if text is not None:
            shards.setdefault(text, set()).add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    assert sharding.sharded(docs).columns == ["doc_id", "text", "shard", "_shard"]


def test_a_group_larger_than_a_shard_is_split(spark):
    rows, _ = shard_rows(spark, ["hot"] * 400 + [f"s {i // 2}" for i in range(600)])
    sizes = [sum(r["shard"] == s for r in rows) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and len({(r["shard"], r["slot"]) for r in rows}) == 1000
    torn = [i for i in range(300) if len({r["shard"] for r in rows if r["doc_id"] in (400 + 2 * i, 401 + 2 * i)}) > 1]
    assert len(torn) <= 30


def cut_groups(rows, texts):
    shards, slots = {}, {}
    for r in rows:
        shards.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    return sum(len(s) > 1 for s in shards.values())


@pytest.mark.parametrize("size, groups, most", [(2, 4000, 15), (300, 100, 4)])
def test_groups_stay_whole_where_there_are_no_singles(spark, size, groups, most):
    texts = [f"group {i}" for i in range(groups)] * size
    rows, _ = shard_rows(spark, texts)
    assert len(rows) == len(texts) and cut_groups(rows, texts) <= most


def test_groups_of_more_than_a_quarter_of_a_shard_stay_whole(spark):
    sizes = [60] * 12 + [35] * 12 + [1] * 460  # a shard holds 100
    texts = [f"group {i}" for i, n in enumerate(sizes) for _ in range(n)]
    random.Random(4).shuffle(texts)
    rows, _ = shard_rows(spark, texts)
    assert len(rows) == len(texts) and cut_groups(rows, texts) == 0


def test_a_group_cut_by_a_shard_changes_places_with_singles():
    # shards' free places end at 10, 20 and 40; documents without neighbours begin at place 24
    assert sharding._exchanges([(8, 13), (18, 24)], [10, 20, 40], 24) == [(18, 24, 24), (8, 13, 30)]
    assert sharding._exchanges([(8, 20)], [10, 20, 40], 30) == []


@pytest.mark.parametrize("count", [0, 1, 5])
def test_fewer_documents_than_shards(spark, count):
    rows, _ = shard_rows(spark, ["x"] * count)
    assert sorted(r["doc_id"] for r in rows) == list(range(count))
    assert max([0] + [sum(r["shard"] == s for r in rows) for s in range(16)]) <= 1


# quality and language model -------------------------------------------------------


def test_ranking_separates_held_out_documents(spark):
    draw = random.Random(6)

    def text(good):
        words = [draw.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(draw.randint(20, 200))]
        return " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)

    rows = [(i, text(i % 5 > 0), i % 5 > 0) for i in range(600)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(None, None, 0.5), (7000, "", 0.5)], "doc_id long, text string, _score double")
    labels = spark.createDataFrame([(i, int(g)) for i, _, g in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    report = {r["doc_id"]: r for r in quality.quality_report(docs.drop("_score"), labels).collect()}
    assert len(report) == 602 and all(0 <= r["score"] <= 1 for r in report.values())
    assert all(report[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert all(report[i]["predicted"] == int(good) for i, _, good in rows)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    again = {r["doc_id"]: r["score"] for r in quality.quality_report(docs.drop("_score"), flipped).collect()}
    assert again == {i: r["score"] for i, r in report.items()}
    none = quality.quality_report(docs.drop("_score"), labels.limit(0)).collect()
    assert [r["score"] for r in none] == pytest.approx([0.7] * 602)
    assert quality.quality_report(docs.drop("_score").limit(0), labels).count() == 0


def brute_force_model(texts, order):
    contexts = [{} for _ in range(order + 1)]
    for text in texts:
        symbols = [0] * order + [b + 1 for b in (text or "").encode().lower()] + [257]
        for at in range(order, len(symbols)):
            for k in range(order + 1):
                counts = contexts[k].setdefault(tuple(symbols[at - k : at]), {})
                counts[symbols[at]] = counts.get(symbols[at], 0) + 1

    def score(text):
        symbols, total = [0] * order + [b + 1 for b in (text or "").encode().lower()] + [257], 0.0
        for at in range(order, len(symbols)):
            excluded, symbol = set(), symbols[at]
            for k in range(order, -1, -1):
                counts = contexts[k].get(tuple(symbols[at - k : at]), {})
                left = {s: n for s, n in counts.items() if s not in excluded}
                whole = sum(left.values()) + len(left)
                if not left:
                    continue
                if symbol in left:
                    total += np.log10(left[symbol] / whole)
                    break
                total += np.log10(len(left) / whole)
                excluded |= set(counts)
            else:
                total += np.log10(1 / (257 - len(excluded)))
        return total

    return score


def test_runs_are_tallied_within_little_memory():
    draw = np.random.default_rng(3)
    runs, train = draw.integers(0, 1 << 20, 1 << 20) << 34, draw.random(1 << 20) < 0.8
    keys, which, uses = np.unique(runs, return_inverse=True, return_counts=True)
    wanted = keys, np.bincount(which[train], minlength=len(keys)), uses
    tracemalloc.start()
    got = language_model.tallied(runs, train)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(map(np.array_equal, got, wanted))
    assert peak < 5 * train.size * 8  # np.unique with the places of all runs takes more
    assert all(len(part) == 0 for part in language_model.tallied(runs[:0], train[:0]))


@pytest.mark.parametrize("most", [language_model.MOST_BROADCAST, 4])
def test_language_model_equals_brute_force(spark, most):
    draw = random.Random(8)
    texts = ["".join(draw.choices("abcdé \n", k=draw.randint(0, 40))) for _ in range(120)] + [None, "", "ABC abc", "zzz", "\x00\x01"]
    rows = list(enumerate(texts)) + [(1, texts[1]), (None, "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key")
    train = [(i, t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    model = brute_force_model([t for _, t in train], 3)
    counts = {}
    for _, text in train:
        for token in [*(text or "").encode().lower().split(), "end"]:
            counts[token] = counts.get(token, 0) + 1
    total, size = sum(counts.values()), len(counts)
    got = language_model.scored_texts(docs, 3, most).collect()
    assert len(got) == len(rows)
    for row in got:
        texts_of = [t for i, t in rows if i == row["doc_id"]]
        tokens = [*(texts_of[0] or "").encode().lower().split(), "end"]
        assert row["score"] == pytest.approx(model(texts_of[0]), abs=1e-9)
        base = sum(np.log10((counts.get(t, 0) + 0.5) / (total + 0.5 * (size + 1))) for t in tokens)
        assert row["base_score"] == pytest.approx(base, abs=1e-9)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens), sum(t in counts for t in tokens), total)


def test_language_model_of_nothing(spark):
    docs = spark.createDataFrame([(0, "a")], "doc_id long, text string")
    assert language_model.scored_texts(docs.limit(0)).count() == 0
    # the only document may be held out, so that nothing is learned
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:1]
    row = language_model.scored_texts(spark.createDataFrame([(ids[0], "ab")], "doc_id long, text string")).first()
    assert row["held_out"] and row["train_tokens"] == 0 and row["score"] == pytest.approx(3 * np.log10(1 / 257))
