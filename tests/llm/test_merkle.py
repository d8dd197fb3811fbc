import hashlib
import random
import zlib

import pytest

from meterline.llm.merkle import merkle_manifest, tamper_trial

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx string, n string, place string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    doc_id, source, lang, n_chars, _ = row
    fields = [x if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if x is None else f"{len(x.encode())}:{x}" for x in fields])


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def climbed(levels, at, folded):
    """Siblings from bottom to top, and where a digest put in place of the one at ``at`` ends."""
    proof = []
    for level in levels[:-1]:
        first = at // 16 * 16
        run = level[first : first + 16]
        left, right = run[: at - first], run[at - first + 1 :]
        proof, folded, at = proof + left + right, h(*left, folded, *right), at // 16
    return proof, folded


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[4]), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels_of([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources]
    top = levels_of([tree[-1][0] for tree in trees])
    result = []
    for place, (source, tree) in enumerate(zip(sources, trees)):
        for at, (_, _, leaf, row) in enumerate(sorted(by_source[source], key=lambda x: x[:3])):
            start, text = leaf, row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                start = leaf_of(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            below, folded = climbed(tree, at, start)
            above, folded = climbed(top, place, folded)
            root = top[-1][0]
            result.append((row[0], leaf, tree[-1][0], root, h(*below, *above), folded, folded == root))
    return sorted(result, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(*row, *["clash"] * 4) for row in rows], DOCS).repartition(3)
    got = tamper_trial(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(row) for row in got.collect()), key=str) == plain(rows)


def row_of(i, source):
    return i, source, random.choice(["en", None]), i % 7 or None, random.choice([f"Text {i}", f"low {i}", "", None, "É" + "X" * 300])


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1], [300], [257, 1, 16, 3], [1] * 40])
def test_equals_a_plain_tree(spark, sizes):
    random.seed(len(sizes))
    names = [None, "", "a", "B", "é"] + [f"s{i}" for i in range(40)]
    rows = [row_of(100 * k + i, names[k]) for k, size in enumerate(sizes) for i in range(size)]
    check(spark, rows)


def test_nulls_repeated_rows_and_nothing(spark):
    rows = [(None, None, None, None, None)] * 2 + [(5, "a", "en", 1, "X")] * 18 + [(5, "a", "en", 1, "Y"), (None, "a", None, 3, "Z")]
    check(spark, rows)
    check(spark, [])


def test_no_row_is_tampered_with_unless_asked(spark):
    docs = spark.createDataFrame([(*row_of(i, "a"), *["x"] * 4) for i in range(40)], DOCS)
    assert merkle_manifest(docs).filter("NOT verified").count() == 0
