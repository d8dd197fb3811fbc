"""Scoring texts by prediction by partial matching over a trie of byte contexts.

The model counts which byte follows each context of up to ``ORDER`` bytes in the training
texts.  A byte is predicted by the longest context seen; a byte new to a context costs an
escape, in proportion to how many different bytes the context has had, and is then looked
for in the next shorter one, where the bytes of the longer context are excluded.  Below all
contexts every symbol is equally likely.  All texts end with a symbol of their own.

Counting, the trie and its probabilities are DataFrames keyed by packed runs of symbols, so
nothing depends on the vocabulary fitting into one place.  The most frequent runs and words
are looked up in a broadcast table of bounded size; those beyond it go through a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import broadcast, forget, received, row_slices, stored
from meterline.llm.words import LOWER, SPACED, U64, find_words, text_bytes

ORDER = 5
HELD_OUT_OF = 5
HELD_OUT = 1
# Runs and words each that the broadcast tables hold at most.
MOST_BROADCAST = 1 << 20
# Bytes of text whose runs are counted at once before they are handed to the shuffle.
COUNTED_BYTES = 2 << 20

# Symbols take nine bits: 0 stands before the text, 1 to 256 are bytes, 257 ends the text.
_BITS = 9
_ALPHABET = 257
_END = 257
_WORD, _RUN = 0, 1
# The token that ends every text; word hashes are scrambled, so none is likely to equal it.
_END_TOKEN = -1


def packed_runs(column: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol of every text, its end included, packed with the ``order`` symbols before.

    Also returns where each text's symbols start.
    """
    data, offsets = text_bytes(column)
    texts = len(offsets) - 1
    step = order + 1
    # each text is preceded by ``order`` zeros and followed by its end
    first = offsets[:-1] + np.arange(texts) * step + order
    symbols = np.zeros(len(data) + texts * step, np.int64)
    lengths = np.diff(offsets)
    where = np.arange(len(data)) + np.repeat(np.arange(texts) * step + order, lengths)
    symbols[where] = LOWER[data].astype(np.int64) + 1
    symbols[first + lengths] = _END
    runs = symbols.copy()
    for back in range(1, order + 1):
        runs[back:] |= symbols[:-back] << (_BITS * back)
    inside = np.ones(len(symbols), bool)
    for back in range(1, order + 1):
        inside[first - back] = False
    return runs[inside], np.append(0, np.cumsum(lengths + 1))  # a copy, which may be overwritten


class KeyTable:
    """Integer keys with a value each, found by open addressing over whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.bits = max(int(2 * max(len(keys), 1)).bit_length(), 4)
        self.index = np.full(1 << self.bits, -1, np.int32)
        waiting, at = np.arange(len(keys), dtype=np.int32), self._slots(keys)
        while len(waiting):
            free = self.index[at] < 0
            self.index[at[free]] = waiting[free]
            placed = self.index[at] == waiting
            waiting, at = waiting[~placed], (at[~placed] + 1) & (len(self.index) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(U64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key in the table, -1 where it is absent."""
        at = self._slots(keys)
        found = self.index[at]
        if not len(self.keys):
            return found
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.index) - 1)
            found[open_] = self.index[at[open_]]
            again = found[open_]
            open_ = open_[(again >= 0) & (self.keys[again] != keys[open_])]
        return found


def held_out(doc_id: Column) -> Column:
    """Documents the model does not learn from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT_OF == HELD_OUT


def tallied(runs: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different runs, how often each occurs in training texts, and in all; overwrites ``runs``.

    The mark of a training text is carried in the lowest bit, so one sort in place is all.
    """
    runs <<= 1
    runs |= train
    runs.sort()
    starts = np.flatnonzero((runs[1:] ^ runs[:-1]) > 1) + 1
    starts = np.append(0, starts) if len(runs) else starts
    uses = np.diff(np.append(starts, len(runs)))
    n = np.add.reduceat(runs & 1, starts) if len(runs) else uses
    return runs[starts] >> 1, n, uses


def _counted(docs: DataFrame, order: int) -> DataFrame:
    """(kind, key, n, uses): occurrences in training texts and in all texts.

    Words are counted in training texts only; runs of all texts are listed, since each of
    them needs a probability.
    """
    names = ["kind", "key", "n", "uses"]

    def rows(kind: int, keys: np.ndarray, n: np.ndarray, uses: np.ndarray) -> pa.RecordBatch:
        arrays = [np.full(len(keys), kind, np.int32), keys, n.astype(np.int64), uses.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text", COUNTED_BYTES):
                texts, train = piece.column("text"), piece.column("train").to_numpy(zero_copy_only=False)
                runs, first = packed_runs(texts, order)
                yield rows(_RUN, *tallied(runs, np.repeat(train, np.diff(first))))
                del runs
                words = find_words(texts, SPACED)
                hashes = words.hashes().view(np.int64)[np.repeat(train, words.counts)]
                tokens = np.append(hashes, np.full(int(train.sum()), _END_TOKEN, np.int64))
                if len(tokens):
                    different, uses = np.unique(tokens, return_counts=True)
                    yield rows(_WORD, different, uses, uses)

    parts = docs.select("text", (~held_out(F.col("doc_id"))).alias("train"))
    counted = parts.mapInArrow(run, "kind int, key long, n long, uses long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))


def _suffix(key: Column, symbols: int) -> Column:
    return key.bitwiseAND(F.lit((1 << (_BITS * symbols)) - 1))


def run_probabilities(runs: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value, uses) with log10 of the probability of the last symbol of each run.

    ``runs`` (key, n, uses) lists the runs of order + 1 symbols; n is 0 for those that only
    occur outside the training texts.  Going up from single symbols, each level holds for
    every run its count, and what its last symbol gets once its context was escaped from.
    """
    levels = {order: runs.select("key", "n", "uses")}
    for k in range(order - 1, -1, -1):
        longer = levels[k + 1].withColumn("key", _suffix(F.col("key"), k + 1))
        levels[k] = stored(longer.groupBy("key").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")), "level")
    total, kinds = levels[0].agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    level = levels[0].select(
        "key",
        "n",
        F.lit(total).alias("total"),
        F.lit(kinds).alias("kinds"),
        F.lit(1.0 / max(_ALPHABET - kinds, 1)).alias("escaped"),
        "uses",
    )
    for k in range(1, order + 1):
        low = level.select(F.col("key").alias("_low"), *[F.col(c).alias(f"l_{c}") for c in ("n", "total", "kinds", "escaped")])
        rows = levels[k].withColumn("_low", _suffix(F.col("key"), k)).join(low, "_low")
        rows = stored(rows.withColumn("_context", F.shiftright("key", _BITS)), "level")
        seen = F.col("n") > 0
        contexts = rows.groupBy("_context").agg(
            F.sum("n").alias("total"),
            F.count_if(seen).alias("kinds"),
            F.sum(F.when(seen, F.col("l_n")).otherwise(0)).alias("excluded"),
        )
        left, new = F.col("l_total") - F.col("excluded"), F.col("l_kinds") - F.col("kinds")
        escaped = (
            F.when((left <= 0) | (new <= 0), F.col("l_escaped"))
            .when(F.col("l_n") > 0, F.col("l_n") / (left + new))
            .otherwise(new / (left + new) * F.col("l_escaped"))
        )
        level = stored(
            rows.join(contexts, "_context").select("key", "n", "total", "kinds", escaped.alias("escaped"), "uses"), "level"
        )
        forget(rows)
    whole = F.col("total") + F.col("kinds")
    chance = (
        F.when(F.col("total") == 0, F.col("escaped"))
        .when(F.col("n") > 0, F.col("n") / whole)
        .otherwise(F.col("kinds") / whole * F.col("escaped"))
    )
    return level.select("key", F.log10(chance).alias("value"), "uses")


def _frequent(values: DataFrame, by: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the rows whose ``by`` reaches the least power of two that at most ``most`` reach."""
    power = F.floor(F.log2(F.col(by))).cast("int")
    sizes = {r["p"]: r["n"] for r in values.filter(F.col(by) > 0).groupBy(power.alias("p")).agg(F.count("*").alias("n")).collect()}
    least, taken = 64, 0
    for p in sorted(sizes, reverse=True):
        if taken + sizes[p] > most:
            break
        least, taken = p, taken + sizes[p]
    chosen = values.filter(F.col(by) >= float(2**least)).select("key", "value").toArrow()
    return chosen.column("key").to_numpy(), chosen.column("value").to_numpy()


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
    "kinds array<int>, keys array<long>, times array<long>"
)


def scored_texts(docs: DataFrame, order: int = ORDER, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per document.

    ``score`` is log10 of the probability that the model gives to the whole text, A to Z
    lower-cased, and its end; null texts score as empty ones.  ``base_score`` adds up over
    words and the end log10((c + 0.5) / (N + 0.5 * (V + 1))).  Repeated rows each count in
    training and each have their score.
    """
    counts = stored(_counted(docs, order), "counts")
    words = counts.filter(F.col("kind") == _WORD)
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known = words.select("key", F.log10(F.col("n") + 0.5).alias("value"), F.col("n").alias("uses"))
    runs = stored(run_probabilities(counts.filter(F.col("kind") == _RUN), order), "runs")
    tables = broadcast(
        docs.sparkSession, (_frequent(known, "uses", most_broadcast), _frequent(runs, "uses", most_broadcast))
    )
    names = [part.split()[0] for part in _SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_known, runs_known = (KeyTable(*table) for table in received(tables))
        for batch in batches:
            for piece in row_slices(batch, "text", 1 << 20):
                yield scored(piece, words_known, runs_known)

    def scored(batch: pa.RecordBatch, words_known: KeyTable, runs_known: KeyTable) -> pa.RecordBatch:
        texts = batch.column("text")
        found = find_words(texts, SPACED)
        hashes, rows = found.hashes().view(np.int64), np.arange(len(texts))
        owners = np.append(np.repeat(rows, found.counts), rows)
        base, n_known, rest = looked_up(np.append(hashes, np.full(len(rows), _END_TOKEN)), owners, len(rows), words_known)
        runs_of, first = packed_runs(texts, order)
        model, _, more = looked_up(runs_of, np.repeat(rows, np.diff(first)), len(rows), runs_known)
        listed = sorted_rest([(_WORD, *rest), (_RUN, *more)], len(rows))
        arrays = [
            batch.column("doc_id"),
            batch.column("held_out"),
            pa.array(found.counts.astype(np.int64) + 1),
            pa.array(n_known.astype(np.int64)),
            pa.array(base),
            pa.array(model),
            *listed,
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    columns = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    parts = stored(columns.mapInArrow(run, _SCORED).withColumn("_id", F.monotonically_increasing_id()), "scored")
    rest = parts.select("_id", F.explode(F.arrays_zip("kinds", "keys", "times")).alias("r")).select(
        "_id", F.col("r.kinds").alias("kind"), F.col("r.keys").alias("key"), F.col("r.times").alias("times")
    )
    all_values = known.withColumn("kind", F.lit(_WORD)).unionByName(runs.withColumn("kind", F.lit(_RUN)))
    sums = rest.join(all_values.select("kind", "key", "value"), ["kind", "key"], "left").groupBy("_id").agg(
        F.sum(F.when(F.col("kind") == _WORD, F.coalesce("value", F.lit(math.log10(0.5))) * F.col("times"))).alias("_base"),
        F.sum(F.when((F.col("kind") == _WORD) & F.col("value").isNotNull(), F.col("times"))).alias("_known"),
        F.sum(F.when(F.col("kind") == _RUN, F.col("value") * F.col("times"))).alias("_model"),
    )
    share = math.log10(tokens + 0.5 * (distinct + 1))
    none = F.lit(0)
    return parts.join(sums, "_id", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", none)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", none) - F.col("n_tokens") * share).alias("base_score"),
        (F.col("model") + F.coalesce("_model", none)).alias("score"),
    )


def looked_up(keys: np.ndarray, owners: np.ndarray, rows: int, table: KeyTable) -> tuple:
    """Per row the sum of values and number of keys that the table has, and the keys it has not."""
    found = table.find(keys)
    here = found >= 0
    hits = np.bincount(owners[here], minlength=rows)
    values = np.bincount(owners[here], weights=table.values[found[here]], minlength=rows) if here.any() else np.zeros(rows)
    return values.astype(float), hits, (keys[~here], owners[~here])


def sorted_rest(rest: list[tuple[int, np.ndarray, np.ndarray]], rows: int) -> list[pa.Array]:
    """Keys without a value as lists per row: kind, key and how often it occurs there."""
    kinds = np.concatenate([np.full(len(keys), kind, np.int32) for kind, keys, _ in rest])
    keys, owners = np.concatenate([r[1] for r in rest]), np.concatenate([r[2] for r in rest])
    order = np.lexsort((keys, kinds, owners))
    kinds, keys, owners = kinds[order], keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1]) | (owners[1:] != owners[:-1])
    starts = np.flatnonzero(new)
    times = np.diff(np.append(starts, len(keys)))
    offsets = pa.array(np.searchsorted(owners[starts], np.arange(rows + 1)).astype(np.int32))
    parts = (kinds[starts], keys[starts], times.astype(np.int64))
    return [pa.ListArray.from_arrays(offsets, pa.array(part)) for part in parts]
