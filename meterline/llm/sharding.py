"""Sharding by balanced label propagation over links between documents.

Every document starts in a shard by hash.  In each round the linked documents ask to move
to the shard where most of their neighbours are, and quotas admit as many as a shard has
room for.  Then groups are settled: those of some size are put whole where there is room,
those the rounds left in several shards fill shards up one after another, and last documents
without links fill all shards up to equal counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import forget, numbered, stored, unused

SHARDS = 16
ROUNDS = 4
# The part of a shard's count from which groups that move are placed one by one after the rounds;
# there are at most SHARDS / PLANNED_GROUP of them.
PLANNED_GROUP = 1 / 64
# Documents in the order in which they take places: groups placed one by one, other groups that
# are whole, groups without a shard, and documents without neighbours.
_PLANNED, _WHOLE, _OPEN, _SINGLE = range(4)
_GROUPS = ["_group1", "_group2"]
_DRAWS = 1 << 20


def text_links(docs: DataFrame) -> DataFrame:
    """Documents with the digest of their text as group; equal texts are linked.

    ``size`` is the number of UTF-8 bytes plus 1 and ``text_crc32`` their checksum, both
    as of an empty text for null, but a null text is linked with nothing.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select(
        "*",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.xxhash64(F.lit(1), "text").alias("_group1"),
        F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(2), F.md5("text"))).alias("_group2"),
    )


def _admitted(demand: dict[tuple[int, int], int], load: dict[int, int], room: float, shards: int) -> list[float]:
    """For each shard the part of the rows asking for it that fit, given who leaves it."""
    parts = [1.0] * shards
    for _ in range(20):
        for to in range(shards):
            asking = sum(n for (_, t), n in demand.items() if t == to)
            leaving = sum(n * parts[t] for (s, t), n in demand.items() if s == to)
            if asking:
                parts[to] = min(1.0, max(0.0, room - load.get(to, 0) + leaving) / asking)
    return parts


def _shares(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def planned_shards(groups: list[tuple[int, int | None]], small: list[int], share: list[int]) -> list[int | None]:
    """A shard for each group (size, shard that holds it whole if any), or None where none has room.

    Groups stay where they are as far as they fit, large ones first; each other goes to the
    fullest shard that has room beside ``small``, the rows of small groups in it, or else to
    the fullest that has room without them.
    """
    room, small, chosen = list(share), list(small), [None] * len(groups)
    order = sorted(range(len(groups)), key=lambda i: -groups[i][0])
    for i in order:
        size, held = groups[i]
        if held is not None and size <= room[held]:
            chosen[i] = held
            room[held] -= size
    for i in order:
        size = groups[i][0]
        if chosen[i] is None:
            fitting = [s for s in range(len(share)) if size <= room[s] - small[s]]
            fitting = fitting or [s for s in range(len(share)) if size <= room[s]]
            if fitting:
                chosen[i] = min(fitting, key=lambda s: (room[s] - small[s], s))
                room[chosen[i]] -= size
    return chosen


def propagated_labels(nodes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``nodes`` (row_id, _group1, _group2; null when linked with nothing) with ``shard`` and ``_turn``.

    Groups with a shard are whole in it.  Without one are documents that have no neighbours,
    groups larger than a shard, and those that neither the rounds nor the plan made whole.
    """
    rows = nodes.count()
    grouped = nodes.filter(F.col("_group2").isNotNull())
    moving = F.col("_n") <= max(_shares(rows, shards)[0], 2)
    # stored, so that the joins below have an exchange of their own, which can split a hot group
    twins = grouped.groupBy(*_GROUPS).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    twins = stored(twins.withColumn("_moves", moving).drop("_n"), "twins")
    movers, large = twins.filter("_moves").drop("_moves"), twins.filter(~F.col("_moves")).drop("_moves")
    single = grouped.join(twins, _GROUPS, "left_anti").unionByName(nodes.filter(F.col("_group2").isNull()))
    start = F.pmod(F.xxhash64("row_id"), F.lit(shards)).cast("int")
    linked = stored(grouped.join(movers, _GROUPS).select("row_id", *_GROUPS, start.alias("shard")), "labels")
    for turn in range(rounds):
        held = linked.groupBy(*_GROUPS, "shard").agg(F.count("*").alias("n"))
        wanted = held.groupBy(*_GROUPS).agg(
            # ties are drawn by hash, so that no shard is favoured
            F.max_by("shard", F.struct("n", F.xxhash64("_group1", "shard"), "shard")).alias("_want")
        )
        wanted = stored(wanted, "wanted")
        asked = held.join(wanted, _GROUPS).filter(F.col("shard") != F.col("_want"))
        demand = {
            (row["shard"], row["_want"]): row["n"]
            for row in asked.groupBy("shard", "_want").agg(F.sum("n").alias("n")).collect()
        }
        if not demand:
            break
        load = {row["shard"]: row["n"] for row in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        parts = _admitted(demand, load, rows / shards, shards)
        draw = F.pmod(F.xxhash64(*_GROUPS, F.lit(turn)), F.lit(_DRAWS))
        chance = F.element_at(F.array(*[F.lit(part * _DRAWS) for part in parts]), F.col("_want") + 1)
        label = F.when(draw < chance, F.col("_want")).otherwise(F.col("shard"))
        moved = linked.join(wanted, _GROUPS).select("row_id", *_GROUPS, label.alias("shard"))
        before, linked = linked, stored(moved, "labels")
        forget(before, wanted)

    def without_shard(frame: DataFrame, turn: int) -> DataFrame:
        return frame.select("row_id", *_GROUPS, F.lit(0).alias("shard"), F.lit(turn).alias("_turn"))

    return (
        _settled(linked, rows, shards)
        .unionByName(without_shard(grouped.join(large, _GROUPS), _OPEN))
        .unionByName(without_shard(single, _SINGLE))
    )


def _settled(linked: DataFrame, rows: int, shards: int) -> DataFrame:
    """Labelled rows with ``_turn``: every group is whole in a shard or has none."""
    share = _shares(rows, shards)
    held = linked.groupBy(*_GROUPS, "shard").agg(F.count("*").alias("n"))
    places = held.groupBy(*_GROUPS).agg(
        F.sum("n").alias("n"), F.min("shard").alias("_first"), F.max("shard").alias("_last")
    )
    places = places.select(*_GROUPS, "n", F.when(F.col("_first") == F.col("_last"), F.col("_first")).alias("_held"))
    groups = stored(places, "settled")
    planned = F.col("n") >= max(rows / shards * PLANNED_GROUP, 2)
    small = [0] * shards
    for row in groups.filter(~planned & F.col("_held").isNotNull()).groupBy("_held").agg(F.sum("n").alias("n")).collect():
        small[row["_held"]] = row["n"]
    chosen = groups.filter(planned).select("n", "_held", *_GROUPS).collect()
    chosen = sorted((tuple(row) for row in chosen), key=lambda row: (row[0], row[2:]))
    placed = planned_shards([row[:2] for row in chosen], small, share)
    plan = [(*row[2:], shard) for row, shard in zip(chosen, placed)]
    plan = linked.sparkSession.createDataFrame(plan, "_group1 long, _group2 long, _planned int")
    labels = groups.join(F.broadcast(plan), _GROUPS, "left").select(
        *_GROUPS,
        F.coalesce(F.when(planned, F.col("_planned")).otherwise(F.col("_held")), F.lit(0)).alias("shard"),
        F.when(planned & F.col("_planned").isNotNull(), _PLANNED)
        .when(~planned & F.col("_held").isNotNull(), _WHOLE)
        .otherwise(_OPEN)
        .alias("_turn"),
    )
    return linked.drop("shard").join(stored(labels, "settled"), _GROUPS).select("row_id", *_GROUPS, "shard", "_turn")


def _case(value: Column, choices: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(x).cast("long") for x in choices]), value.cast("int") + 1)


def _across(rows: DataFrame, position: Column, cuts: list[int]) -> list[tuple[int, int]]:
    """First position and end of the groups in ``rows`` that lie across one of the cuts."""
    if not cuts:
        return []
    rows = rows.select(position.alias("_at"), *_GROUPS)
    near = rows.filter(F.col("_at").isin([cut - i for cut in cuts for i in (0, 1)])).collect()
    beside = {row["_at"]: (row["_group1"], row["_group2"]) for row in near}
    cut = {beside[c] for c in cuts if c in beside and beside[c] == beside.get(c - 1)}
    if not cut:
        return []
    names = [(F.col("_group1") == one) & (F.col("_group2") == two) for one, two in sorted(cut)]
    found = rows.filter(reduce(Column.__or__, names)).groupBy(*_GROUPS)
    return sorted((row["a"], row["e"] + 1) for row in found.agg(F.min("_at").alias("a"), F.max("_at").alias("e")).collect())


def _exchanges(across: list[tuple[int, int]], filled: list[int], singles: int) -> list[tuple[int, int, int]]:
    """(a, e, to): places [a, e) of a group that is cut, and as many from ``to`` on of documents
    without neighbours, which begin at place ``singles``, in one shard."""
    free = [[max(low, singles), high] for low, high in zip([0, *filled], filled)]
    found = []
    for a, e in sorted(across, key=lambda x: x[0] - x[1]):
        fitting = [x for x in free if x[1] - x[0] >= e - a]
        if fitting:
            taken = min(fitting, key=lambda x: x[1] - x[0])
            found.append((a, e, taken[0]))
            taken[0] += e - a
    return found


def assigned_shards(nodes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``row_id`` with its final ``shard`` and its gapless ``slot`` in it; counts differ by one at most.

    Whole groups keep their shard as far as its count goes; the others fill the shards up one
    after another, then documents without neighbours.  A group that the end of a shard would
    cut changes places with documents without neighbours, where one shard has enough of them.
    """
    labels = propagated_labels(nodes.select("row_id", *_GROUPS), shards, rounds)
    alone = F.col("_turn") >= _OPEN
    order = [alone, *[F.col(name) for name in ("shard", "_turn", "_group2", "_group1", "row_id")]]
    places = numbered(labels, order, "_place", "places")
    linked, rows, singles = [0] * shards, 0, 0
    for row in places.groupBy("_turn", "shard").agg(F.count("*").alias("n")).collect():
        rows += row["n"]
        singles += row["n"] if row["_turn"] == _SINGLE else 0
        linked[row["shard"]] += 0 if row["_turn"] >= _OPEN else row["n"]
    share = _shares(rows, shards)
    first = [sum(linked[:shard]) for shard in range(shards)]
    kept = [min(x, most) for x, most in zip(linked, share)]
    # a group that a full shard would cut does not stay in it
    ends = {first[s] + kept[s]: s for s in range(shards) if linked[s] > share[s]}
    for a, e in _across(places.filter(~alone), F.col("_place"), list(ends)):
        for end, full in ends.items():
            if a < end < e:
                kept[full] = a - first[full]
    spilt = [sum(linked[:shard]) - sum(kept[:shard]) for shard in range(shards)]
    filled = [sum(share[: shard + 1]) - sum(kept[: shard + 1]) for shard in range(shards)]

    position = F.col("_place") - _case(F.col("shard"), first)
    stays = ~alone & (position < _case(F.col("shard"), kept))
    # number among the documents that fill the shards up
    free = F.when(alone, F.col("_place") - sum(kept)).otherwise(
        _case(F.col("shard"), spilt) + position - _case(F.col("shard"), kept)
    )
    single = rows - sum(kept) - singles  # number of the first without neighbours
    cuts = sorted({bound for bound in filled[:-1] if 0 < bound < single})
    moves = _exchanges(_across(places.filter(~stays & (F.col("_turn") < _SINGLE)), free, cuts), filled, single)
    _free = F.col("_free")
    changed = _free
    for a, e, to in moves:
        changed = (
            F.when((_free >= a) & (_free < e), _free - a + to)
            .when((_free >= to) & (_free < to + e - a), _free - to + a)
            .otherwise(changed)
        )
    taker = sum((F.when(_free >= bound, 1).otherwise(0) for bound in filled[:-1]), F.lit(0))
    offset = [kept[i] - (filled[i - 1] if i else 0) for i in range(shards)]
    return (
        places.withColumns({"_slot": F.when(stays, position), "_free": F.when(~stays, free)})
        .withColumn("_free", changed)
        .withColumn("_shard", F.when(stays, F.col("shard")).otherwise(taker))
        .select(
            "row_id",
            F.col("_shard").cast("int").alias("shard"),
            F.coalesce("_slot", F.col("_free") + _case(F.col("_shard"), offset)).cast("long").alias("slot"),
        )
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``_shard``: size, text_crc32, law, shard, slot.

    The law is ``rows``: the counts of the shards are at most one apart.  Every row is placed,
    repeated ones too, each in a slot of its own; other columns stay as they are, and
    the new one gets underscores behind its name until no column has it.
    """
    linked = text_links(docs.select(F.struct("*").alias("_row"), "text"))
    rows = stored(linked.drop("text").withColumn("row_id", F.monotonically_increasing_id()), "linked")
    placed = assigned_shards(rows, shards)
    return rows.join(placed, "row_id").select(
        "_row.*", F.struct("size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot").alias(unused(docs, "_shard"))
    )


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document with its place; the texts themselves are read once and not kept."""
    linked = text_links(docs.select("doc_id", "text")).drop("text")
    rows = stored(linked.withColumn("row_id", F.monotonically_increasing_id()), "linked")
    placed = assigned_shards(rows, shards)
    return rows.join(placed, "row_id").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
