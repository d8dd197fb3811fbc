"""Phrases whose words occur together more often than their parts let expect.

Level by level, phrases of two and three words become candidates when all their parts are
frequent and they are seen often enough.  Candidates and their parts are then counted by
double-array tries of bounded size, over which phrases and the places of all texts are dealt
alike: numpy advances the states of many places at once, word by word, and adds up how often
each state is reached.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches_of, broadcast, forget, received, row_slices, stored
from meterline.llm.double_array import DoubleArray, build
from meterline.llm.words import U64, Words, find_words, mix

# What ends a piece of text, the white space between words, the language of a null one.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
NO_LANG = "und"
# Phrases of one trie, which takes some 10 MB, words of all texts for which there is a trie, and tries
# that a task takes, one after another.
TRIE_PHRASES = 1 << 17
TRIE_WORDS = 1 << 22
TRIES_A_PASS = 2
# Places of texts that are dealt over the tries at once, and most of them in a row on the way there.
DEALT_PLACES = 1 << 19
_PLACES_A_ROW = 1 << 11
# Most bits of the tables that say which words and pairs are frequent; wrong only by letting more through.
MOST_BITS = 27
WINDOW = 2 << 20
# Rows that a Python task gets at once; parts of a language that are ranked before it comes together.
_ROWS = 600
_RANKED_PARTS = 64

_WORD = np.ones(256, bool)
_WORD[[*BREAKS, *BLANKS]] = False
_BREAK = np.zeros(256, bool)
_BREAK[[*BREAKS]] = True
_KEYS = ["k1", "k2", "k3"]
_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], pa.Array]]:
    """Languages and texts in windows; a text beyond one is cut after the end of a piece."""
    for batch in batches:
        for rows in row_slices(batch, "text", WINDOW):
            langs, texts = rows.column("lang").to_pylist(), rows.column("text")
            if rows.num_rows > 1 or len(text := (texts[0].as_py() or "").encode()) <= WINDOW:
                yield langs, texts
                continue
            low = 0
            while low < len(text):
                high = max(text.rfind(b, low, low + WINDOW) for b in BREAKS) + 1
                if high <= low:
                    later = [at for b in BREAKS if (at := text.find(b, low)) >= 0]
                    high = min(later) + 1 if later else len(text)
                if high + WINDOW > len(text) and low + WINDOW >= len(text):
                    high = len(text)
                yield langs, pa.array([text[low:high].decode()])
                low = high


def keyed_words(langs: list[str], texts: pa.Array, seed: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their keys (never 0, other ones in each language), and whether the next one is in the same piece."""
    words = find_words(texts, _WORD)
    salts = {lang: int.from_bytes(hashlib.blake2b(f"{seed} {lang}".encode(), digest_size=8).digest()) for lang in set(langs)}
    salt = np.array([salts[lang] for lang in langs], U64)
    keys = mix(words.hashes() ^ np.repeat(salt, words.counts))
    keys[keys == 0] = 1
    breaks = np.cumsum(_BREAK[words.data], dtype=np.int64)
    following = np.zeros(len(keys), bool)
    if len(keys):
        following[:-1] = breaks[words.end[:-1] - 1] == breaks[words.start[1:]]
        last = words.first[1:][words.counts > 0] - 1
        following[last] = False
    return words, keys, following


def _texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def _shown_words(words: Words, which: np.ndarray) -> pa.Array:
    """The texts of some words, cut from their bytes all at once."""
    sizes = words.end[which] - words.start[which]
    ends = np.append(0, np.cumsum(sizes))
    places = np.repeat(words.start[which] - ends[:-1], sizes) + np.arange(ends[-1])
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(words.data[places]))]
    return pa.Array.from_buffers(pa.string(), len(which), buffers)


def _distinct_of(words: Words, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of every different word with its key, and how often it occurs."""
    _, first, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    sizes, same = words.end - words.start, first[which]
    if np.array_equal(sizes[same], sizes):
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        if np.array_equal(words.data[within + np.repeat(words.start[same], sizes)], words.data[within + np.repeat(words.start, sizes)]):
            return first, counts
    places: dict[tuple[int, bytes], list[int]] = {}  # two words share a key
    for i, key in enumerate(keys.tolist()):
        places.setdefault((key, words.text(i)), []).append(i)
    return np.array([x[0] for x in places.values()]), np.array([len(x) for x in places.values()])


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, key, n): how often each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, column in _texts(batches):
            words, keys, _ = keyed_words(langs, column, seed)
            first, counts = _distinct_of(words, keys)
            texts_of = np.searchsorted(words.first, first, "right") - 1
            arrays = [
                pa.array(langs, pa.string()).take(pa.array(texts_of)),
                _shown_words(words, first),
                _signed(keys[first]),
                pa.array(counts.astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "word", "key", "n"])

    found = texts.mapInArrow(run, "lang string, word string, key long, n long")
    return found.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _distinct_words(texts: DataFrame) -> tuple[DataFrame, int]:
    """Counted words whose keys are all different, and the seed of the keys."""
    seed = 0
    while True:
        words = stored(word_counts(texts, seed), "words")
        if words.groupBy("key").count().filter("count > 1").isEmpty():
            return words, seed
        forget(words)
        seed += 1


def _mixed(keys: list[np.ndarray]) -> np.ndarray:
    """One number per phrase of keys, whose leading bits place it in a table of bits."""
    total = keys[0].copy()
    for key in keys[1:]:
        total = mix(total * U64(3) + key)
    return total


def _distinct(phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of an array of keys, and how often each occurs."""
    _, first, which, counts = np.unique(_mixed(list(phrases)), return_index=True, return_inverse=True, return_counts=True)
    if not np.array_equal(phrases[:, first][:, which], phrases):  # two phrases share a number
        return np.unique(phrases, axis=1, return_counts=True)
    return phrases[:, first], counts


# Words of 64 bits that make a row of such a table on its way to the driver.
_CHUNK = 1 << 10


def _table_of(numbers: DataFrame, size: int) -> np.ndarray:
    """A table of bits in which the place of every number is set, at most 16 MB of them."""
    bits = min(max(size, 1).bit_length() + 5, MOST_BITS)
    place = F.shiftrightunsigned("number", 64 - bits)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(number, {64 - bits}) & 63 AS INT))")
    cells = numbers.groupBy(F.shiftright(place, 6).alias("cell")).agg(F.bit_or(bit).alias("set"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, value = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for chunk in np.unique(cell // _CHUNK).tolist():
                mine = cell // _CHUNK == chunk
                chunks.setdefault(chunk, np.zeros(_CHUNK, np.int64))[cell[mine] % _CHUNK] = value[mine]
        arrays = [pa.array(list(chunks), pa.int64()), pa.array([x.tobytes() for x in chunks.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["chunk", "bits"])

    dealt = cells.repartition(F.floor(F.col("cell") / _CHUNK)).mapInArrow(packed, "chunk long, bits binary")
    table = np.zeros(max(1 << (bits - 6), _CHUNK), np.int64)
    for row in dealt.collect():
        table[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] |= np.frombuffer(row["bits"], np.int64)
    return table[: 1 << (bits - 6)].view(U64)


def _shown(table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    place = numbers >> U64(65 - (len(table) * 64).bit_length())
    return (table[(place >> U64(6)).astype(np.int64)] >> (place & U64(63))) & U64(1) > 0


def _seen(texts: DataFrame, seed: int, table: Broadcast, words: int, least: int) -> DataFrame:
    """Phrases of two or three words whose parts the table shows, and that are seen ``least`` times."""
    names = _KEYS[:words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = received(table)
        for langs, column in _texts(batches):
            _, keys, following = keyed_words(langs, column, seed)
            if len(keys) < words:
                continue
            good = following[:-1].copy()
            if words == 2:
                shown = _shown(frequent, keys)
                good &= shown[:-1] & shown[1:]
            else:
                good &= _shown(frequent, _mixed([keys[:-1], keys[1:]]))
                good = good[:-1] & good[1:]
            at = np.flatnonzero(good)
            columns = [keys[at + i] for i in range(words)]
            phrases, counts = _distinct(np.stack(columns))
            yield pa.RecordBatch.from_arrays([*map(_signed, phrases), pa.array(counts.astype(np.int64))], [*names, "n"])

    found = texts.mapInArrow(run, ", ".join(f"{name} long" for name in names) + ", n long")
    return found.groupBy(*names).agg(F.sum("n").alias("n")).filter(F.col("n") >= least).drop("n")


def _with_number(phrases: DataFrame, names: list[str]) -> DataFrame:
    """Phrases with the number that :func:`_mixed` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) for name in names]
            yield pa.RecordBatch.from_arrays([_signed(_mixed(keys))], ["number"])

    return phrases.select(*names).mapInArrow(run, "number long")


def candidates(texts: DataFrame, words: DataFrame, seed: int, least: int) -> DataFrame:
    """(k1, k2, k3) of the phrases to count, 0 where they are shorter.

    A phrase is one of them when it may occur ``least`` times: its words, and for three words
    its pairs, all do, and it is itself seen so often.  Words that occur in one come along.
    """
    spark = texts.sparkSession
    frequent = words.filter(F.col("n") >= least).select(F.col("key").alias("number"))
    table = broadcast(spark, _table_of(frequent, frequent.count()))
    pairs = stored(_seen(texts, seed, table, 2, least), "pairs")
    table.destroy()
    table = broadcast(spark, _table_of(_with_number(pairs, _KEYS[:2]), pairs.count()))
    triples = _seen(texts, seed, table, 3, least)
    none = F.lit(0).cast("long")
    longer = pairs.withColumn("k3", none).unionByName(triples)
    singles = pairs.select(F.explode(F.array("k1", "k2")).alias("k1")).distinct()
    found = stored(longer.unionByName(singles.withColumns({"k2": none, "k3": none})), "candidates")
    table.destroy()
    return found


_TRIE = "trie int, part string, keys binary, base binary, check binary, phrases binary, states binary"
_PLACES = "trie int, part string, places binary, counts binary"


def _trie_of(first: np.ndarray, second: np.ndarray, shards: int) -> np.ndarray:
    """The trie of what begins with two words of these keys, which are hashes; 0 for the second where there is none."""
    return (first ^ (second >> U64(1))).view(np.int64) % shards


def tries(phrases: DataFrame, shards: int) -> DataFrame:
    """The phrases dealt over tries as :func:`_trie_of` does: per trie a row of its arrays, and one of its phrases' states."""
    begins = F.col("k1").bitwiseXOR(F.shiftrightunsigned("k2", 1))
    dealt = phrases.withColumn("trie", F.pmod(begins, F.lit(shards).cast("long")).cast("int"))

    def made(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.ascontiguousarray(group[_KEYS].to_numpy(np.int64)).view(U64)
        trie = build(keys)
        arrays = {"keys": trie.keys, "base": trie.base.astype(np.int32), "check": trie.check.astype(np.int32)}
        known = {"phrases": keys, "states": trie.states_of(keys).astype(np.int32)}
        none = dict.fromkeys([*arrays, *known])
        rows = [
            none | {"trie": group["trie"].iloc[0], "part": part} | {name: value.tobytes() for name, value in values.items()}
            for part, values in (("trie", arrays), ("phrases", known))
        ]
        return pd.DataFrame(rows)[[field.split()[0] for field in _TRIE.split(", ")]]

    return dealt.groupBy("trie").applyInPandas(made, _TRIE)


def _dealt(texts: DataFrame, seed: int, table: Broadcast, shards: int) -> DataFrame:
    """Places of the texts for each trie: distinct rows of keys that 0 fills up, and how often each occurs.

    A place is a row of two or three words where the table shows that they may be a phrase, and one
    of its word alone, for the tries of both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = received(table)

        def shown(keys: list[np.ndarray]) -> np.ndarray:
            return _shown(wanted, _mixed(keys))

        def made(longer: list[np.ndarray], single: list[np.ndarray]) -> pa.RecordBatch:
            phrases, counts = _distinct(np.concatenate(longer, axis=1))
            words, times = np.unique(np.concatenate(single), return_counts=True)
            words = words[None][[0, 0, 0]] * np.array([[1], [0], [0]], U64)
            phrases, counts = np.concatenate([phrases, words], axis=1), np.concatenate([counts, times]).astype(np.uint32)
            trie_of = _trie_of(phrases[0], phrases[1], shards)
            order = np.argsort(trie_of, kind="stable")
            rows, counts, trie_of = phrases[:, order].T, counts[order], trie_of[order]
            begins = np.flatnonzero(np.append(True, trie_of[1:] != trie_of[:-1])) if len(order) else np.zeros(0, np.int64)
            cuts = [
                (low, min(low + _PLACES_A_ROW, end))
                for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(order)])
                for low in range(begin, end, _PLACES_A_ROW)
            ]
            arrays = [
                pa.array(trie_of[[low for low, _ in cuts]].astype(np.int32)),
                pa.array(["places"] * len(cuts), pa.string()),
                pa.array([np.ascontiguousarray(rows[low:high]).tobytes() for low, high in cuts], pa.binary()),
                pa.array([counts[low:high].tobytes() for low, high in cuts], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["trie", "part", "places", "counts"])

        longer, single, size = [], [], 0
        for langs, column in _texts(batches):
            _, keys, following = keyed_words(langs, column, seed)
            ends = np.zeros(2, U64)
            second = np.append(keys, ends)[1:-1] * following
            third = np.append(keys, ends)[2:] * (following & np.append(following[1:], False)[: len(keys)])
            none = np.zeros(len(keys), U64)
            single.append(keys[shown([keys, none, none])])
            at = np.flatnonzero(following)
            at = at[shown([keys[at], second[at], none[at]])]
            first, second, third = keys[at], second[at], third[at]
            third[third != 0] *= shown([x[third != 0] for x in (first, second, third)])
            longer.append(np.stack([first, second, third]))
            size += len(keys)
            if size >= DEALT_PLACES:
                yield made(longer, single)
                longer, single, size = [], [], 0
        if size:
            yield made(longer, single)

    return texts.mapInArrow(run, _PLACES)


def phrase_counts(texts: DataFrame, seed: int, phrases: DataFrame, words: int) -> DataFrame:
    """(k1, k2, k3, n): how often each of the phrases occurs in all texts, which have so many words.

    Texts are read once: their places are dealt over the tries as the phrases are, by the first two
    words, so each is walked in one trie however many there are.  A task has the places of
    ``TRIES_A_PASS`` tries and holds one trie at a time.
    """
    spark, size = texts.sparkSession, phrases.count()
    shards = max(-(-size // TRIE_PHRASES), -(-words // TRIE_WORDS), 1)
    stored_tries = stored(tries(phrases, shards), "tries")
    table = broadcast(spark, _table_of(_with_number(phrases, _KEYS), size))
    found = stored(_counted(stored_tries, _dealt(texts, seed, table, shards), shards), "counts")
    table.destroy()
    return found


def _counted(stored_tries: DataFrame, places: DataFrame, shards: int) -> DataFrame:
    """(k1, k2, k3, n) of the phrases of all tries that some places reach."""

    def counts(phrases: np.ndarray, states: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        seen = total[states] > 0
        columns = [pa.array(np.ascontiguousarray(phrases[seen, i])) for i in range(len(_KEYS))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(total[states[seen]])], [*_KEYS, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trie, known, total = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["trie"] != at:
                    if known:
                        yield counts(*known, total)
                    at, trie, known, total = row["trie"], None, None, None
                if row["part"] == "trie":
                    trie = DoubleArray(*(np.frombuffer(row[name], kind) for name, kind in (("keys", U64), ("base", np.int32), ("check", np.int32))))
                    total = np.zeros(len(trie.check), np.int64)
                elif row["part"] == "phrases":
                    known = np.frombuffer(row["phrases"], np.int64).reshape(-1, len(_KEYS)), np.frombuffer(row["states"], np.int32)
                elif trie is not None:  # else there is no phrase for what the table let through
                    rows, times = np.frombuffer(row["places"], U64).reshape(-1, len(_KEYS)), np.frombuffer(row["counts"], np.uint32)
                    for level, (which, states) in enumerate(trie.walk_rows(rows)):
                        if level == 0:  # a word is counted where it is a row of its own
                            alone = rows[which, 1] == 0
                            which, states = which[alone], states[alone]
                        np.add.at(total, states, times[which].astype(np.int64))
        if known:
            yield counts(*known, total)

    rows = stored_tries.unionByName(places, allowMissingColumns=True)
    parts = -(-shards // TRIES_A_PASS)
    dealt = rows.repartitionById(parts, F.floor(F.col("trie") / TRIES_A_PASS).cast("int"))
    ordered = dealt.sortWithinPartitions("trie", F.col("part") == "places")
    return ordered.mapInArrow(run, ", ".join(f"{name} long" for name in [*_KEYS, "n"]))


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)); decimals of 38 digits hold the products of counts up to 10^16."""
    a, left, right = (f"CAST({x} AS DECIMAL(38, 0))" for x in (a, left, right))
    return F.expr(f"(CAST(1000000 AS DECIMAL(38, 0)) * {a} * {a}) div ({left} * {right})")


def collocations(docs: DataFrame, least: int = 10, part_percent: int = 50, most: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``most`` phrases of each language.

    Texts are lower-cased from A to Z, cut into pieces at ``.,;:!?`` and line ends, and those
    into words at spaces and tabs; null texts are empty, a null language is ``und``.  Phrases of
    two or three words with at least ``least`` occurrences (a) within pieces, overlaps included,
    are scored by the cut into a first part (l occurrences) and the rest (r) that scores lowest,
    the earliest of equals; n are all words of the language.  A phrase is dropped when a longer
    one that holds its words in a row has at least ``part_percent`` of its occurrences.  Equal
    scores are ordered by occurrences, then by the bytes of the phrase.  Repeated rows count as
    often as they occur, texts of any length are worked on in windows, without texts there are
    no rows, and extra columns are not read.
    """
    texts = _texts_of(docs)
    with arrow_batches_of(docs.sparkSession, _ROWS):
        words, seed = _distinct_words(texts)
        phrases = candidates(texts, words, seed, least)
        total = words.agg(F.sum("n")).first()[0] or 0
        counts = phrase_counts(texts, seed, phrases, total)
    one = counts.filter("k2 = 0").select("k1", "n")
    begun = one.join(words.select(F.col("key").alias("k1"), "lang"), "k1")  # a key is of one language
    two = counts.filter("k2 != 0 AND k3 = 0 AND n >= %d" % least).select("k1", "k2", "n")
    three = counts.filter("k3 != 0 AND n >= %d" % least).select(*_KEYS, F.col("n").alias("a"))

    holding = three.select(
        F.explode(F.array(F.struct("k1", "k2"), F.struct(F.col("k2").alias("k1"), F.col("k3").alias("k2")))).alias("part"), "a"
    )
    holding = holding.groupBy("part.k1", "part.k2").agg(F.max("a").alias("longer"))
    pairs = two.withColumnRenamed("n", "a").join(holding, ["k1", "k2"], "left")
    pairs = pairs.filter(F.coalesce(F.col("longer") * 100 < F.col("a") * part_percent, F.lit(True)))
    pairs = pairs.join(begun.toDF("k1", "l", "lang"), "k1").join(one.toDF("k2", "r"), "k2")
    pairs = pairs.select("lang", "k1", "k2", F.lit(0).cast("long").alias("k3"), "a", "l", "r", _score("a", "l", "r").alias("score"))

    cut = three.join(begun.toDF("k1", "l1", "lang"), "k1").join(two.toDF("k2", "k3", "r1"), ["k2", "k3"])
    cut = cut.join(two.toDF("k1", "k2", "l2"), ["k1", "k2"]).join(one.toDF("k3", "r2"), "k3")
    cut = cut.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    first = F.col("s1") <= F.col("s2")
    cut = cut.select(
        "lang",
        *_KEYS,
        "a",
        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    return _ranked(pairs.unionByName(cut), words, most)


def _ranked(scored: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """Scored phrases in words; ranks, ties kept, are cut in parts of a language before it comes together and is spelled."""
    part = F.pmod(F.xxhash64(*_KEYS), F.lit(_RANKED_PARTS))
    for whole in (["lang", "_part"], ["lang"]):
        best = Window.partitionBy(*whole).orderBy(F.desc("score"), F.desc("a"))
        scored = scored.withColumn("_part", part).withColumn("_rank", F.rank().over(best)).filter(F.col("_rank") <= most)
    spelled = scored.drop("_part", "_rank")
    named = words.select("key", "word")
    for key, word in zip(_KEYS, ("_w1", "_w2", "_w3")):
        spelled = spelled.join(named.toDF(key, word), key, "left")
    spelled = spelled.withColumn("phrase", F.concat_ws(" ", "_w1", "_w2", "_w3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    names = [field.split()[0] for field in _RESULT.split(", ")]
    return ranked.withColumn("rank", F.col("rank").cast("long")).join(totals, "lang").select(*names)
