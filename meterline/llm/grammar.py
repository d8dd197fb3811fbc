"""Re-Pair grammar compression of token ids with numpy, one grammar per shard.

Pairs of neighbouring symbols are replaced by new symbols, round after round, until none occurs
twice.  Each rule keeps the number of ids it expands to, so any range of ids is decoded from the
symbols that cover it alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A pair has to occur this often to become a rule.  Rounds over a whole sequence have to shorten it by this
# part; those after them look at the places alone that may hold such a pair.
LEAST = 2
LEAST_GAIN = 0.1
# Pairs are counted in this many buckets; each bucket counts exactly one pair that fell into it.
_BUCKETS = 1 << 19
# Most rules that one round adds, and one that looks at some places.
_RULES_A_ROUND = 1 << 11
_RULES_AT_PLACES = 1 << 13
# One of so many neighbouring pairs tells which are frequent, at every length of a sequence; at places all are counted.
_COUNTED_STEP = 2


@dataclass
class Grammar:
    """``sequence`` of symbols; those from ``base`` on are rules (left, right), which expand to ``lengths`` ids."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    sequence: np.ndarray

    def symbol_lengths(self, symbols: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones(self.base, np.int64), self.lengths])[symbols]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols, of which each different one is expanded once."""
        number = np.zeros(self.base + len(self.left), np.int32)
        number[symbols] = 1
        different = np.flatnonzero(number)
        number[different] = np.arange(len(different))
        which, sizes, ids = number[symbols], self.symbol_lengths(different), self._expanded(different)
        starts, sizes = (np.cumsum(sizes) - sizes)[which], sizes[which]
        shift = starts - (np.cumsum(sizes) - sizes)
        return ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols; every round replaces each rule by its two sides."""
        while True:
            rules = symbols >= self.base
            if not rules.any():
                return symbols
            places = np.cumsum(np.append(0, 1 + rules[:-1]))
            longer = np.empty(len(symbols) + int(rules.sum()), np.int64)
            longer[places] = symbols
            at, used = places[rules], symbols[rules] - self.base
            longer[at], longer[at + 1] = self.left[used], self.right[used]
            symbols = longer

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` up to ``stop``; symbols outside are not expanded."""
        ends = np.cumsum(self.symbol_lengths(self.sequence))
        total = int(ends[-1]) if len(ends) else 0
        start, stop = max(start, 0), total if stop is None else min(stop, total)
        if start >= stop:
            return np.zeros(0, np.int64)
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop)
        before = int(ends[first - 1]) if first else 0
        return self.expand(self.sequence[first : last + 1])[start - before : stop - before]


def compress(ids: np.ndarray, least: int = LEAST) -> Grammar:
    """The grammar of a sequence of ids, in which no pair occurs ``least`` times; the same ids always give the same one."""
    sequence = ids.astype(np.int64)
    base = int(sequence.max()) + 1 if len(sequence) else 0
    left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.ones(base, np.int64)
    while len(sequence) > 1:
        symbols = base + len(left)
        keys = (sequence[:-1] << 32) | sequence[1:]
        bucket = _bucket(keys)
        pairs, counts = _pair_counts(keys[::_COUNTED_STEP], bucket[::_COUNTED_STEP], max(least // _COUNTED_STEP, 2))
        chosen = _compatible(pairs, counts, symbols, _RULES_A_ROUND)
        if not len(chosen):
            break
        a, b = pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF
        of_bucket = np.full(_BUCKETS, -1, np.int32)
        of_bucket[_bucket(pairs[chosen])] = np.arange(len(chosen))
        rule = of_bucket[bucket]
        at = np.flatnonzero(rule >= 0)
        rule = rule[at]
        same = pairs[chosen][rule] == keys[at]
        at, rule = at[same], rule[same]
        once = _without_overlaps(at, at + 1, sequence)
        at, rule = at[once], rule[once]
        kept = np.ones(len(sequence), bool)
        kept[at + 1] = False
        sequence[at] = symbols + rule
        before, sequence = len(sequence), sequence[kept]
        lengths = np.concatenate([lengths, lengths[a] + lengths[b]])
        left, right = np.concatenate([left, a]), np.concatenate([right, b])
        if before - len(sequence) < LEAST_GAIN * before:
            break
    more, sequence = _finished(sequence, base + len(left), least)
    for a, b in more:
        lengths = np.concatenate([lengths, lengths[a] + lengths[b]])
    left, right = (np.concatenate([side, *(sides[i] for sides in more)]) for i, side in enumerate((left, right)))
    return Grammar(base, left, right, lengths[base:], sequence)


def _finished(sequence: np.ndarray, symbols: int, least: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Left and right sides of the rules that are still to be made, round by round, and the sequence left.

    All pairs are counted at the places that may hold one that occurs ``least`` times.  A pair never
    occurs more often than at first, so a place that holds a rarer one is left alone until the pair
    there changes, and a round takes as long as there are such places.
    """
    size, more = len(sequence), []
    if size < 2:
        return more, sequence
    after, before = np.arange(1, size + 1), np.arange(-1, size)  # of the symbols left; replaced ones are passed over
    left_out, live = np.zeros(size, bool), np.zeros(size, bool)
    rule_of = np.full(_BUCKETS, -2, np.int32)  # -1: of a frequent pair without a rule
    places = np.arange(size - 1)
    while True:
        keys = (sequence[places] << 32) | sequence[after[places]]
        pairs, counts = _all_pair_counts(keys, least)
        if not len(pairs):
            return more, sequence[~left_out]
        chosen = pairs[_compatible(pairs, counts, symbols, _RULES_AT_PLACES)]
        of_pairs, of_chosen = _bucket(pairs), _bucket(chosen)
        rule_of[of_chosen] = np.arange(len(chosen))
        alone = rule_of[of_chosen] == np.arange(len(chosen))  # of those that share a bucket one is replaced in this round
        chosen, of_chosen = chosen[alone], of_chosen[alone]
        rule_of[of_pairs] = -1
        rule_of[of_chosen] = np.arange(len(chosen))
        rule = rule_of[_bucket(keys)]
        rule_of[of_pairs] = -2
        often = rule > -2
        live[places[often]] = True
        at = np.flatnonzero(rule >= 0)
        at = at[chosen[rule[at]] == keys[at]]
        at, rule = places[at], rule[at]
        once = _without_overlaps(at, after[at], sequence)
        at, rule = at[once], rule[once]
        second = after[at]
        sequence[at] = symbols + rule
        left_out[second] = True
        after[at] = after[second]
        before[after[at]] = at
        earlier = before[at]
        live[at], live[earlier[earlier >= 0]], live[second] = True, True, False
        live[at[after[at] == size]] = False
        places = np.flatnonzero(live)
        live[places] = False
        symbols += len(chosen)
        more.append((chosen >> 32, chosen & 0xFFFFFFFF))


def _bucket(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(45)).view(np.int64)


def _pair_counts(keys: np.ndarray, bucket: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that occur ``least`` times and how often; of the pairs that share a bucket one is counted."""
    counted = np.full(_BUCKETS, -1, np.int64)
    counted[bucket] = keys
    counts = np.bincount(bucket[counted[bucket] == keys], minlength=_BUCKETS)
    often = np.flatnonzero(counts >= least)
    return counted[often], counts[often]


def _all_pair_counts(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that occur ``least`` times, in ascending order, and how often."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    often = counts >= least
    return keys[first[often]], counts[often]


def _compatible(pairs: np.ndarray, counts: np.ndarray, symbols: int, most: int = _RULES_A_ROUND) -> np.ndarray:
    """The most frequent pairs that cannot overlap: no symbol is the left side of one and the right of another.

    A symbol takes the side that it has in its most frequent pair.
    """
    often = np.lexsort((pairs, -counts))[: 2 * most]
    a, b = pairs[often] >> 32, pairs[often] & 0xFFFFFFFF
    alike = a == b
    side = np.zeros(symbols, np.int8)  # 1: left, 2: right, 3: both sides of its own pair
    sides = np.stack([np.where(alike, 3, 1), np.where(alike, 3, 2)], axis=1).astype(np.int8)
    side[np.stack([a, b], axis=1).ravel()[::-1]] = sides.ravel()[::-1]  # the first pair writes last
    fits = np.where(alike, side[a] == 3, (side[a] == 1) & (side[b] == 2))
    return often[fits][:most]


def _without_overlaps(at: np.ndarray, after: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """Which of some places and those after them are replaced: of equal symbols in a run, every second from its start."""
    once = np.ones(len(at), bool)
    same = np.flatnonzero(sequence[at] == sequence[after])
    if len(same):
        begins = np.append(True, after[same[:-1]] != at[same[1:]])
        number = np.arange(len(same))
        once[same] = (number - number[begins][np.cumsum(begins) - 1]) % 2 == 0
    return once
