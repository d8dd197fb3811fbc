"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of word shingles.  Trees branch them: at a node some coordinates of the
min-wise signature are drawn, and documents that agree in one go to a common child.  Small
nodes are compared exhaustively, large ones branch on; several independent trees make a
missed pair unlikely.  Sketches of two bits per coordinate sort out pairs, and every link is
confirmed on the full sets.  As only components are asked for, pairs that are already in one
component need no comparison, and large nodes are first compared with a few of their members;
so thousands of copies of one text cost no more than their rows.  Nodes full of pairs just below
the threshold, which sketches cannot tell from links, branch by the rarest shingles instead: a
linked pair has one of them in common for certain, so such a branch loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import forget, row_slices, stored
from meterline.llm.components import components
from meterline.llm.words import U64, find_words, mix, shingles

TREES = 4
# Branches drawn at a root, by one coordinate each, and at any other node, by several each.
# Every branch of a root has a coordinate of its own, and the nodes below it draw from
# ``INNER_COORDINATES`` that no other branch of a root uses.  At similarity 0.8 the trees lose a
# pair with probability 0.2^12 = 4e-9 if it need not branch on.  Below a branch whose
# coordinates agree in the part s, L levels lose it with q(L) = (1 - s^2 + s^2 q(L - 1))^2,
# q(0) = 0; over the binomial s the trees lose it with (0.2 + 0.8 E[q])^12, which is 8e-7 after
# one level, 2e-5 after three, 6e-5 after five and 2e-4 after eleven, the most there are.
# Two coordinates at once let nodes of unlike texts that share a common passage shrink faster
# than their branches multiply.
ROOT_BRANCHES = 3
BRANCHES = 2
BRANCH_COORDINATES = 2
INNER_COORDINATES = 32
# Coordinates that a sketch shows: all of inner nodes.
COORDINATES = TREES * ROOT_BRANCHES * INNER_COORDINATES
# Members of a node whose pairs are all confirmed at once, and in a larger one the members that
# all others are compared with first; then members of a node of which all pairs between
# components are compared without branching on.
FIRST_NODE = 16
LEADERS = 4
SMALL_NODE = 1_024
# Members from which a node may branch by rare shingles; it does so if its leaders are alike with more than
# one in ``DENSE_SHARE`` of its members, and with more than ``FIRST_NODE`` each in other components.  In
# smaller nodes a member has few pairs in any case, and nodes of fewer copies branch on by coordinates.
DENSE_NODE = 256
DENSE_SHARE = 8
# Members whose sketches are put together to one in the middle of their node.
MIDDLE = 3
MOST_LEVELS = 12
# Levels at which pairs are listed in the first only of the nodes they share, of at most 96 a member.
FIRST_LEVELS = 3
# Standard errors that a sketch may fall short of what the threshold makes it expect: a pair at the
# threshold does so with probability 3e-6, and one of similarity 0.69 stays below as often as not.
SKETCH_ERRORS = 4.5

_SKETCH = [f"s{i}" for i in range(COORDINATES // 32)]
_SIGNED = (
    "doc_id long, key1 long, key2 long, n_shingles long, digest1 long, digest2 long, "
    "signature array<int>, inner binary, " + ", ".join(f"{name} long" for name in _SKETCH)
)
_BY_SET = ["digest1", "digest2", "n_shingles"]


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Min-wise signatures of non-empty sets and their sketches.

    The coordinates of the roots have 32 bits each.  Those of inner nodes have 8: members that
    agree by chance only make a node larger, and no pair that agrees is lost.
    """
    roots = TREES * ROOT_BRANCHES
    factors = mix(np.arange(1, roots * (1 + INNER_COORDINATES) + 1, dtype=U64)) | U64(1)
    values, firsts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    signature = np.empty((len(sets), len(factors)), U64)
    for i, factor in enumerate(factors):
        signature[:, i] = np.minimum.reduceat(values * factor, firsts)
    signature = mix(signature)
    bits = ((signature[:, roots:] >> U64(60)) & U64(3)).reshape(len(sets), len(_SKETCH), 32)
    sketch = (bits << np.arange(0, 64, 2, dtype=U64)).sum(axis=2, dtype=U64)
    inner = (signature[:, roots:] & U64(255)).astype(np.uint8)
    return signature[:, :roots].astype(np.uint32).view(np.int32), inner, sketch.view(np.int64)


def signed_documents(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text keys, n_shingles, digest of the set, signature, sketch) of every document."""
    names = [part.split()[0] for part in _SIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text", 1 << 20):
                yield signed(piece)

    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingles(find_words(batch.column("text")), width))
        full = np.flatnonzero([len(s) > 0 for s in sets])
        digests = np.zeros((len(sets), 2), U64)
        sketch = np.zeros((len(sets), len(_SKETCH)), np.int64)
        lists = np.zeros(len(sets), np.int64)
        values = np.zeros(0, np.int32)
        inner = [b""] * len(sets)
        if len(full):
            chosen = [sets[i] for i in full]
            firsts = np.cumsum([0, *map(len, chosen[:-1])])
            joined = np.concatenate(chosen)
            # sums over the set do not depend on its order
            digests[full, 0] = np.add.reduceat(mix(joined), firsts)
            digests[full, 1] = np.add.reduceat(mix(joined ^ U64(0x5851F42D4C957F2D)), firsts)
            signature, below, sketch[full] = _signatures(chosen)
            values, lists[full] = signature.reshape(-1), signature.shape[1]
            for i, row in zip(full, below):
                inner[i] = row.tobytes()
        offsets = pa.array(np.append(0, np.cumsum(lists)).astype(np.int32))
        arrays = [
            batch.column("doc_id"),
            batch.column("key1"),
            batch.column("key2"),
            pa.array([len(s) for s in sets], pa.int64()),
            *(pa.array(column.view(np.int64)) for column in digests.T.copy()),
            pa.ListArray.from_arrays(offsets, pa.array(values)),
            pa.array(inner, pa.binary()),
            *(pa.array(column) for column in sketch.T.copy()),
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    return _keyed(docs).mapInArrow(run, _SIGNED)


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with two keys of their text, under which it is found again for confirmation."""
    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("key1"), F.crc32("text").alias("key2"), "text"
    )


def _agreement(other: str) -> Column:
    """Coordinates in which two sketches agree, at two bits each."""
    even = F.lit(0x5555555555555555)

    def differing(name: str) -> Column:
        both = F.col(name).bitwiseXOR(F.col(f"{other}{name}"))
        return F.bit_count(both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(even))

    return F.lit(COORDINATES) - sum((differing(name) for name in _SKETCH[1:]), differing(_SKETCH[0]))


def _ends() -> list[Column]:
    """The pair (a, b) in one row, a < b, and the agreement of its sketches."""
    a, b = F.least("class_id", "o_class_id"), F.greatest("class_id", "o_class_id")
    return [a.alias("a"), b.alias("b"), _agreement("o_").alias("agree")]


def _needed_agreement(similarity: float) -> float:
    agree = similarity + (1 - similarity) / 4
    return COORDINATES * (agree - SKETCH_ERRORS * (agree * (1 - agree) / COORDINATES) ** 0.5)


def _alike(similarity: float) -> Column:
    """Whether a pair in one row is worth confirming: sketches, and sizes that allow the similarity."""
    small, large = F.least("n_shingles", "o_n_shingles"), F.greatest("n_shingles", "o_n_shingles")
    return (small >= large * (similarity - 1e-9)) & (_agreement("o_") >= _needed_agreement(similarity))


def _others(members: DataFrame) -> DataFrame:
    kept = ["class_id", "n_shingles", *_SKETCH] + [name for name in ("root", "earlier", "place") if name in members.columns]
    return members.select("path", *[F.col(name).alias(f"o_{name}") for name in kept])


def _texts(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(class_id, text) of distinct classes."""
    wanted = ids.join(classes.select("class_id", "key1", "key2"), "class_id")
    found = _keyed(docs).drop("doc_id").join(wanted, ["key1", "key2"])
    return found.groupBy("class_id").agg(F.first("text").alias("text"))


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the similarity."""
    left = pairs.join(texts.select(F.col("class_id").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("class_id").alias("b"), F.col("text").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "left", 1 << 20):
                one = shingles(find_words(piece.column("left")), width)
                two = shingles(find_words(piece.column("right")), width)
                linked = []
                for x, y in zip(one, two):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b")], ["a", "b"]).filter(
                    pa.array(linked, pa.bool_())
                )

    return stored(both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long"), "confirmed")


class _Links:
    """Links and components found so far among the classes of one join."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int, percent: int):
        self.docs, self.classes, self.width, self.percent = docs, classes, width, percent
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None

    def with_roots(self, members: DataFrame) -> DataFrame:
        """Members with the ``root`` of their component, themselves while they have no link."""
        if self.roots is None:
            return members.withColumn("root", F.col("class_id"))
        roots = self.roots.select(F.col("id").alias("class_id"), F.col("root").alias("_root"))
        return members.join(roots, "class_id", "left").select(
            *[F.col(name) for name in members.columns], F.coalesce("_root", "class_id").alias("root")
        )

    def across(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose ends are in different components."""
        if self.roots is None:
            return pairs
        ends = self.roots.select("id", "root")
        joined = pairs.join(ends.toDF("a", "_a"), "a", "left").join(ends.toDF("b", "_b"), "b", "left")
        return joined.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b", "agree")

    def consider(self, pairs: DataFrame) -> None:
        """Confirm candidate pairs (a < b): the best of each class, then those still between components."""
        pairs = stored(self.across(pairs.distinct()), "pairs")
        if pairs.isEmpty():
            forget(pairs)
            return
        ids = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
        texts = stored(_texts(ids, self.classes, self.docs), "texts")
        ends = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
        best = pairs.select(ends.alias("e"), "agree").groupBy("e.x").agg(F.max_by("e.y", F.struct("agree", "e.y")).alias("y"))
        first = stored(best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "first")
        self._add(first, texts)
        rest = stored(self.across(pairs).join(first, ["a", "b"], "left_anti").select("a", "b"), "pairs")
        if not rest.isEmpty():
            self._add(rest, texts)
        forget(pairs, first, rest, texts)

    def _add(self, pairs: DataFrame, texts: DataFrame) -> None:
        links = _confirmed(pairs, texts, self.width, self.percent)
        self.links = links if self.links is None else self.links.unionByName(links)
        self.roots = components(self.links)


def _root_members(classes: DataFrame) -> DataFrame:
    """Classes below every branch of a root, each of which goes by a coordinate of its own."""
    start = classes.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(TREES * ROOT_BRANCHES - 1))))
    path = F.xxhash64("branch", F.element_at("signature", F.col("branch") + 1))
    return start.withColumn("path", path).select("path", "branch", "class_id", "n_shingles", *_SKETCH)


def _children(members: DataFrame, branches: int, signatures: DataFrame) -> DataFrame:
    """Members of the next level: per branch, documents that agree in its coordinates share a path."""

    def coordinate(branch: int, i: int) -> Column:
        drawn = F.pmod(F.xxhash64("path", F.lit(branch), F.lit(i)), F.lit(INNER_COORDINATES))
        at = F.col("branch") * INNER_COORDINATES + drawn.cast("int") + 1
        return F.substr("inner", at, F.lit(1))

    drawn = [
        F.xxhash64("path", F.lit(branch), *[coordinate(branch, i) for i in range(BRANCH_COORDINATES)])
        for branch in range(branches)
    ]
    signed = members.join(signatures, "class_id").withColumn("_paths", F.array(*drawn))
    return signed.withColumn("path", F.explode("_paths")).drop("_paths", "inner")


def _crowded(members: DataFrame) -> DataFrame:
    """Members of nodes that hold more than one document, with the number of them."""
    sizes = members.groupBy("path").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    return members.join(sizes, "path")


def _parts(members: DataFrame) -> DataFrame:
    """(path, size, across, main) of nodes with several components: pairs between them, and the largest one."""
    parts = members.groupBy("path", "root").agg(F.count("*").alias("n")).groupBy("path")
    parts = parts.agg(
        F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("within"), F.max_by("root", F.struct("n", "root")).alias("main")
    )
    across = (F.col("size") * F.col("size") - F.col("within")) / 2
    return parts.select("path", "size", across.alias("across"), "main").filter(F.col("across") > 0)


def _pairs_within(members: DataFrame, alike: Column) -> DataFrame:
    """Pairs (a < b) of members of one node in different components that are worth confirming.

    Where the largest component ``main`` of a node is known, its members are not compared with one another.
    Members that :func:`_with_earlier` gives meet in the first of the nodes they share, all others in each.
    """
    once, some = F.col("class_id") < F.col("o_class_id"), members
    if "main" in members.columns:
        some = members.filter(F.col("root") != F.col("main"))
        once |= F.col("o_root") == F.col("main")
    apart = once & (F.col("root") != F.col("o_root")) & alike
    if "earlier" in members.columns:
        apart &= ~F.arrays_overlap("earlier", "o_earlier")
    return some.join(_others(members), "path").filter(apart).select("path", *_ends())


def _with_earlier(members: DataFrame) -> DataFrame:
    """Members with those nodes of their class whose path is less than theirs."""
    paths = members.groupBy("class_id").agg(F.collect_list("path").alias("earlier"))
    less = F.expr("filter(earlier, x -> x < path)")
    return members.join(paths, "class_id").withColumn("earlier", less)


def _drawn(large: DataFrame, leaders: int) -> DataFrame:
    """A few members of each node, drawn by hash."""
    names = [f"h{seed}" for seed in range(leaders)]
    heads = [F.min_by("class_id", F.xxhash64("class_id", F.lit(seed))).alias(name) for seed, name in enumerate(names)]
    drawn = large.groupBy("path").agg(*heads)
    drawn = drawn.select("path", F.explode(F.array_distinct(F.array(*names))).alias("class_id"))
    return drawn.join(large, ["path", "class_id"])


def _central(large: DataFrame) -> DataFrame:
    """The member of each node that is nearest to its middle: copies that differ in different places link with it best.

    The middle's sketch has those bits that most of a few members have, of three two at least.
    """

    def most(name: str) -> Column:
        return F.bit_or(name).bitwiseAND(F.bitwise_not(F.bit_xor(name))).bitwiseOR(F.bit_and(name))

    middle = _drawn(large, MIDDLE).groupBy("path").agg(*[most(name).alias(f"o_{name}") for name in _SKETCH])
    near = large.join(middle, "path").select("path", "class_id", _agreement("o_").alias("agree"))
    nearest = near.groupBy("path").agg(F.max_by("class_id", F.struct("agree", "class_id")).alias("class_id"))
    return nearest.join(large, ["path", "class_id"])


def _met(large: DataFrame, leaders: DataFrame, alike: Column) -> DataFrame:
    """Pairs of members of large nodes with their leaders, and whether they are ``apart``, in two components."""
    met = large.join(_others(leaders), "path").filter((F.col("class_id") != F.col("o_class_id")) & alike)
    return met.select("path", *_ends(), (F.col("root") != F.col("o_root")).alias("apart"))


def _pairs_with_leaders(large: DataFrame, leaders: DataFrame, alike: Column) -> DataFrame:
    """Pairs of members of large nodes with their leaders, between components."""
    return _met(large, leaders, alike).filter("apart").drop("apart")


def _rare_shingles(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(class_id, path, place, n_shingles): the rarest shingles of each class, and their place among all of its own.

    Two sets that reach the similarity share ``percent`` of a hundred of either, so they share one of these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text", 1 << 20):
                sets = list(shingles(find_words(piece.column("text")), width))
                ids = np.repeat(piece.column("class_id").to_numpy(), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets).view(np.int64))], ["class_id", "path"])

    every = stored(texts.mapInArrow(run, "class_id long, path long"), "shingles")
    holders = every.groupBy("path").agg(F.count("*").alias("holders"))
    ranked = every.join(holders, "path").groupBy("class_id")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("holders", "path"))).alias("_all"), F.count("*").alias("n_shingles"))
    needed = F.expr(f"cast((n_shingles * {percent} + 99) div 100 as int)")
    rarest = F.slice("_all", 1, F.col("n_shingles").cast("int") - needed + 1)
    placed = F.transform(rarest, lambda x, i: F.struct(x.holders.alias("holders"), x.path.alias("path"), (i + 1).alias("place")))
    shared = F.filter(placed, lambda x: x.holders > 1)
    return ranked.select("class_id", F.explode(shared).alias("_one"), "n_shingles").select(
        "class_id", "_one.path", "_one.place", "n_shingles"
    )


def _pairs_by_rare_shingles(members: DataFrame, rare: DataFrame, percent: int, alike: Column) -> DataFrame:
    """Pairs between components of classes (class_id, root, sketch) that share a rare shingle, as far as they may link.

    If the shingle at places i and j is the first that sets of sizes m and n share, they share at most
    1 + min(m - i, n - j); the similarity asks for percent * (m + n) / (100 + percent).
    """

    def may_link(shared: Column, size: Column) -> Column:
        return shared * (100 + percent) >= percent * (F.col("n_shingles") + size)

    rest = 1 + F.col("n_shingles") - F.col("place")
    branched = members.join(rare, "class_id")
    least = branched.groupBy("path").agg(F.min("n_shingles").alias("_least"))
    branched = branched.join(least, "path").filter(may_link(rest, F.col("_least"))).drop("_least")
    branched = stored(branched.join(_parts(branched).select("path", "main"), "path"), "branched")
    both = F.least(rest, 1 + F.col("o_n_shingles") - F.col("o_place"))
    return _pairs_within(branched, may_link(both, F.col("o_n_shingles")) & alike)


def _linked_classes(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, root) of classes that are linked with others.

    In the children of the roots a number of pairs in proportion to the members is confirmed
    first: those with the central member of a large node, which bring most copies together, and
    then between the components those with drawn leaders and those of small nodes.  Then nodes of
    which all members are in one component are done.  Of the others those full of copies in
    many components are dense, and their members branch by rare shingles; in the rest all pairs
    between components are compared or the node branches on.  What is left to confirm is
    gathered.
    """
    found = _Links(docs, classes, width, percent)
    alike = _alike(percent / 100)
    signatures = classes.select("class_id", "inner")
    ends = ["a", "b", "agree"]
    members = _root_members(classes)
    members = stored(_crowded(members).withColumn("root", F.col("class_id")), "members")
    large = members.filter(F.col("size") > FIRST_NODE).drop("size")
    found.consider(_pairs_with_leaders(large, _central(large), alike).select(ends))
    small = found.with_roots(members.filter(F.col("size") <= FIRST_NODE).drop("root"))
    rooted = stored(found.with_roots(large.drop("root")), "rooted")
    led = _pairs_with_leaders(rooted, _drawn(rooted, LEADERS), alike)
    found.consider(_pairs_within(small, alike).unionByName(led).select(ends))
    gathered: list[DataFrame] = []
    dense: list[DataFrame] = []
    nodes = stored(found.with_roots(large.drop("root")), "rooted")
    for level in range(1, MOST_LEVELS + 1):
        rooted = stored(nodes.join(_parts(nodes), "path"), "rooted")
        crowds = rooted.filter(F.col("size") > DENSE_NODE)
        led = stored(_met(crowds, _drawn(crowds, LEADERS), alike), "led")
        met = led.groupBy("path").agg(F.count("*").alias("met"), F.count_if("apart").alias("apart"))
        copies = crowds.join(met.filter(F.col("apart") > LEADERS * FIRST_NODE), "path")
        copies = stored(copies.filter(F.col("met") * DENSE_SHARE > F.col("size") * LEADERS).select("path", "class_id"), "dense")
        dense.append(copies.select("class_id"))
        rooted = rooted.join(copies.select("path").distinct(), "path", "left_anti")
        # per node the pairs between components: few of them are compared at once
        near = (F.col("across") <= F.col("size") * (SMALL_NODE / 2)) | F.lit(level == MOST_LEVELS)
        close = rooted.filter(near).drop("size", "across")
        close = _with_earlier(close) if level <= FIRST_LEVELS else close
        gathered.append(stored(_pairs_within(close, alike).select(ends), "near"))
        far = stored(rooted.filter(~near).drop("size", "across", "main"), "far")
        if far.isEmpty():
            break
        gathered.append(led.filter("apart").join(far.select("path").distinct(), "path", "left_semi").select(ends))
        nodes = stored(_crowded(_children(far, BRANCHES, signatures)).drop("size"), "members")
    ids = stored(reduce(DataFrame.unionByName, dense).distinct(), "dense")
    if not ids.isEmpty():
        rare = _rare_shingles(_texts(ids, classes, docs), width, percent)
        members = found.with_roots(classes.join(ids, "class_id", "left_semi").select("class_id", *_SKETCH))
        gathered.append(stored(_pairs_by_rare_shingles(members, rare, percent, alike).select(ends), "near"))
    more = reduce(DataFrame.unionByName, gathered).distinct()
    if not more.isEmpty():
        found.consider(more)
    if found.roots is None:
        return classes.select(F.col("class_id").alias("id"), F.col("class_id").alias("root")).limit(0)
    return found.roots


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document.

    A document's set are its distinct runs of ``width`` words, A to Z lower-cased; with fewer
    words the whole sequence is one; without words it is empty and linked with nothing.
    Documents are linked when 100 * intersection >= ``percent`` * union.  ``component_id`` is
    the smallest doc_id reachable by links.  Rows with the same id are documents of their own
    and have the smallest component of any of them.  Rows without an id are linked like all
    others; their component is null when it holds no id, and they are kept only then.
    """
    signed, found = _found(docs, width, percent)
    empty = signed.filter(F.col("n_shingles") == 0).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return found.select(columns).unionByName(empty.select(columns)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _found(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Signed documents, and those with a set again with their component's number and least id."""
    signed = stored(signed_documents(docs, width), "signed")
    alike = signed.filter(F.col("n_shingles") > 0)
    first = F.min_by(F.struct("key1", "key2", "signature", "inner", *_SKETCH), F.struct("key1", "key2"))
    classes = alike.groupBy(*_BY_SET).agg(F.min("doc_id").alias("least_id"), first.alias("_first"))
    classes = stored(
        classes.select(*_BY_SET, "least_id", "_first.*").withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    roots = _linked_classes(docs, classes, width, percent)
    grouped = classes.select(*_BY_SET, "class_id", "least_id").join(roots.toDF("class_id", "_root"), "class_id", "left")
    grouped = grouped.withColumn("_root", F.coalesce("_root", "class_id"))
    least = grouped.groupBy("_root").agg(F.min("least_id").alias("component_id"))
    named = stored(grouped.join(least, "_root").select(*_BY_SET, F.col("_root").alias("component"), "component_id"), "named")
    rows = alike.select("doc_id", "key1", "key2", *_BY_SET)
    return signed, rows.join(named, _BY_SET).select("doc_id", "n_shingles", "key1", "key2", "component", "component_id")


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, in the columns of ``docs``: that with the smallest id.

    Where several rows share that id, one of those with the smallest text key stays.  All
    documents without words stay, as they are linked with nothing.
    """
    signed, found = _found(docs, width, percent)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key1", "key2")
    chosen = found.groupBy("component").agg(F.min(order).alias("_one")).select("_one.doc_id", "_one.key1", "_one.key2")
    chosen = stored(chosen, "chosen")
    keyed = F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_key1"), F.crc32("text").alias("_key2")
    rows = docs.select(F.struct("*").alias("_row"), *keyed)
    keys = chosen.toDF("_c_id", "_c_key1", "_c_key2")
    same = F.col("_id").eqNullSafe(F.col("_c_id")) & (F.col("_key1") == F.col("_c_key1"))
    kept = rows.join(keys, same & (F.col("_key2") == F.col("_c_key2")), "left_semi")
    repeated = found.groupBy("doc_id", "key1", "key2").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    if not repeated.isEmpty():  # else the texts need no second shuffle
        kept = kept.dropDuplicates(["_id", "_key1", "_key2"])
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return kept.select("_row.*").unionByName(docs.filter(wordless))
