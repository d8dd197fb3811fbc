"""A Merkle manifest of documents: proofs and tamper checks by a recursive climb.

Leaves are hashes of documents, in order of doc_id within each source.  Sixteen neighbours make
a node, up to one root per source, and the roots of the sources make the tree of the manifest in
the same way.  All levels are stored as node rows that name their parent and hold the digests of
their run.  A recursive query starts at every leaf and climbs by joining the parents: it appends
the siblings to the leaf's proof and folds the leaf's hash upwards.  The leaves of one run share
all siblings but their own, so they climb together in one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import forget, numbered, stored

# How many nodes make one of the next level, and which rows the tamper trial changes.
FAN = 16
TAMPERED_OF = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The tree over the roots of the sources; those of sources are called by the place of their first leaf.
_TOP = -1
_SIZE = 32  # bytes of a digest, which is hashed and shown as hex text
_DIGESTS = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
_PARENT = ("p_tree", "p_level", "p_idx", "slot")

def _without(slot: str) -> str:
    """SQL of the digests of a run but one."""
    return f"concat(substr(children, 1, {_SIZE} * {slot}), substr(children, {_SIZE} * {slot} + {_SIZE + 1}))"


def _folded(slot: str, digest: str) -> str:
    """SQL of the digest over a run in which one is put in the place of another."""
    return _hashed(f"overlay(children PLACING {digest} FROM {_SIZE} * {slot} + 1 FOR {_SIZE})")


def _hashed(digests: str) -> str:
    return f"unhex(sha2(lower(hex({digests})), 256))"


_CLIMB = f"""
WITH RECURSIVE climb (tree, run, folded, proof, p_tree, p_level, p_idx, slot) AS (
  SELECT tree, run, folded, proof, p_tree, p_level, p_idx, slot FROM {{runs}}
  UNION ALL
  SELECT c.tree, c.run, transform(c.folded, f -> {_folded("c.slot", "f")}), concat(c.proof, {_without("c.slot")}),
         p.p_tree, p.p_level, p.p_idx, p.slot
  FROM climb c JOIN {{nodes}} p ON p.tree = c.p_tree AND p.level = c.p_level AND p.idx = c.p_idx
)
SELECT tree, run, folded, proof FROM climb WHERE p_tree IS NULL
"""


def _field(value: Column) -> Column:
    """A value with its length before it, so that no two rows of values give the same text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    """The digest of a document whose text is ``text``."""
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.sha2(F.concat(*map(_field, fields)), 256)


@contextmanager
def _unlimited_recursion(spark: SparkSession) -> Iterator[None]:
    """The climb has a row per run and level, and ends at the root."""
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _above(level: DataFrame) -> DataFrame:
    """The nodes over a level, of the trees that have more than one node there."""
    grouped = level.filter("n > 1").groupBy("tree", "level", "n", F.expr(f"idx div {FAN}").alias("run"))
    members = grouped.agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("members"))
    joined = members.withColumn("children", F.expr("aggregate(members, X'', (all, x) -> concat(all, x.digest))"))
    return joined.selectExpr(
        "tree", "level + 1 AS level", "run AS idx", f"(n + {FAN - 1}) div {FAN} AS n", "children", f"{_hashed('children')} AS digest"
    )


def _built(bottom: DataFrame, most: int) -> list[DataFrame]:
    """All levels over a bottom one, where the widest tree has ``most`` nodes."""
    levels = []
    while most > 1:
        bottom = stored(_above(bottom), "level")
        levels.append(bottom)
        most = -(-most // FAN)
    return levels


def _parents(nodes: DataFrame, tops: DataFrame, sources: int) -> DataFrame:
    """Nodes with their parent and their slot below it; the root has none.

    ``tops`` places the root of each source in the tree above, which exists if there are several.
    """
    placed = nodes.join(tops.select("tree", F.col("idx").alias("_u")), "tree", "left")
    inside, above = F.col("n") > 1, (F.col("tree") != _TOP) & F.lit(sources > 1)
    own = F.when(inside, F.col("idx")).when(above, F.col("_u"))
    return placed.withColumns(
        {
            "p_tree": F.when(inside, F.col("tree")).when(above, F.lit(_TOP).cast("long")),
            "p_level": F.when(inside, F.col("level") + 1).when(above, F.lit(1)),
            "p_idx": F.floor(own / FAN).cast("long"),
            "slot": (own % FAN).cast("int"),
        }
    ).drop("_u")


def merkle_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per document.

    ``tampered`` is a boolean over the columns of ``docs``: for these rows the climb starts from
    the hash of the text with A to Z in lower case, else from the leaf, and always with the
    original siblings; null texts stay.  ``verified`` says whether it ends in the root.
    Documents are ordered by doc_id, nulls first, and rows of one id by their leaf; the null
    source comes first.  A null in any column, an empty text and a repeated row are leaves like
    any other; without documents there are no rows.  Extra columns are not read.  Texts of any
    length are hashed as they are.
    """
    spark = docs.sparkSession
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    lowered = F.translate(F.col("text"), _UPPER, _LOWER)
    leaf = leaf_digest(F.col("text"))
    leaves = stored(
        docs.select(
            "doc_id", "source", F.unhex(leaf).alias("leaf"), F.when(changed, F.unhex(leaf_digest(lowered))).alias("other")
        ),
        "leaves",
    )
    placed = numbered(leaves, [F.col("source"), F.col("doc_id"), F.col("leaf")], "place", "placed")
    sources = stored(
        placed.groupBy("source").agg(F.min("place").alias("tree"), F.count("*").alias("n")), "sources"
    )
    sizes = sources.agg(F.count("*").alias("sources"), F.max("n").alias("most")).first()
    if not sizes["sources"]:
        return leaves.select("doc_id", *[F.lit("").alias(x) for x in _DIGESTS], F.lit(True).alias("verified"))
    named = sources.withColumnRenamed("source", "_source")
    leaves_in = placed.join(named, F.col("source").eqNullSafe(F.col("_source"))).withColumn("idx", F.col("place") - F.col("tree"))

    # the runs of leaves; a lone leaf is no node of a level above
    members = F.sort_array(F.collect_list(F.struct("idx", "leaf", "doc_id", "other")))
    runs = leaves_in.groupBy("tree", "n", F.expr(f"idx div {FAN}").alias("run")).agg(members.alias("members"))
    lone = F.col("n") == 1
    runs = stored(
        runs.withColumn("children", F.expr("aggregate(members, X'', (all, x) -> concat(all, x.leaf))"))
        .withColumn("digest", F.when(lone, F.col("children")).otherwise(F.expr(_hashed("children"))))
        .withColumns({"leaves": F.col("n"), "idx": F.col("run")})
        .withColumns({"n": F.expr(f"(n + {FAN - 1}) div {FAN}"), "level": F.when(lone, 0).otherwise(1)}),
        "runs",
    )
    keys = ["tree", "level", "idx", "n", "children", "digest"]
    inner = _built(runs.select("tree", "level", "idx", "n", "digest"), -(-sizes["most"] // FAN))
    lower = reduce(DataFrame.unionByName, [level.select(keys) for level in inner], runs.select(keys))
    roots = lower.filter("n = 1").select("tree", "digest")
    tops = stored(numbered(roots, [F.col("tree")], "idx", "roots"), "tops")
    bottom = tops.select(
        F.lit(_TOP).cast("long").alias("tree"), F.lit(0).alias("level"), "idx", F.lit(sizes["sources"]).cast("long").alias("n"), "digest"
    )
    upper = _built(bottom, sizes["sources"])
    last = upper[-1] if upper else tops
    root = bytes(last.select("digest").first()["digest"])  # the only row

    above = [level.select(keys) for level in inner + upper]
    nodes = reduce(DataFrame.unionByName, above, lower.select(keys).limit(0))
    nodes = stored(_parents(nodes, tops, sizes["sources"]), "nodes")
    # leaves that are not tampered with arrive in the digest of their run; the others have a value each
    fold = _folded(f"(x.idx % {FAN})", "x.other")
    values = f"transform(filter(members, x -> x.other IS NOT NULL), x -> IF(leaves = 1, x.other, {fold}))"
    start = F.expr(f"concat(array(digest), {values})")
    climbing = stored(
        _parents(runs, tops, sizes["sources"]).select("tree", "run", start.alias("folded"), F.expr("X''").alias("proof"), *_PARENT),
        "climbing",
    )
    with _unlimited_recursion(spark):
        climbed = stored(spark.sql(_CLIMB, runs=climbing, nodes=nodes), "climbed")
    forget(leaves, placed, nodes, climbing, *inner, *upper)

    subroots = tops.select("tree", F.col("digest").alias("subroot"))
    runs = runs.select("tree", "run", "leaves", "members", "children")
    # both sides grow with the documents, so the join is the same at every size
    rows = runs.join(climbed.hint("merge"), ["tree", "run"]).join(subroots, "tree").selectExpr("*", "posexplode(members) AS (at, x)")
    siblings = F.when(F.col("leaves") == 1, F.expr("X''")).otherwise(F.expr(_without("at")))
    value = "IF(x.other IS NULL, 0, size(filter(slice(members, 1, at + 1), m -> m.other IS NOT NULL)))"
    end = F.expr(f"folded[{value}]")

    def shown(digest: Column) -> Column:
        return F.lower(F.hex(digest))

    return rows.select(
        F.col("x.doc_id").alias("doc_id"),
        shown(F.col("x.leaf")).alias("leaf"),
        shown(F.col("subroot")).alias("subroot"),
        shown(F.lit(root)).alias("root"),
        F.sha2(shown(F.concat(siblings, "proof")), 256).alias("proof_sha256"),
        shown(end).alias("folded_root"),
        (end == F.lit(root)).alias("verified"),
    )


def tamper_trial(docs: DataFrame) -> DataFrame:
    """The manifest where every row whose checksum of doc_id five divides is tampered with."""
    return merkle_manifest(docs, F.crc32(F.col("doc_id").cast("string")) % TAMPERED_OF == 0)
