"""Double-array tries over phrases of word keys, walked from all places of a text at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Bases that are tried at once for a node, and about how many cells are looked at for that at once.
_MOST_TRIED, _CELLS = 1 << 12, 1 << 16


@dataclass
class DoubleArray:
    """A trie whose symbols are the places of ``keys``.

    State ``s`` goes on symbol ``c`` to ``base[s] + c`` if that cell's ``check`` is ``s``.  The
    first states, one per symbol, stand for the phrases of one word.
    """

    keys: np.ndarray
    base: np.ndarray
    check: np.ndarray

    def __post_init__(self) -> None:
        # where the keys with the same leading bits begin; keys are hashes, so few share them
        self.bits = max(len(self.keys).bit_length(), 1)
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.starts = np.append(np.searchsorted(self.keys, edges), len(self.keys))

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        """The symbol of each key, -1 where the trie has none."""
        found = np.full(len(keys), -1, np.int64)
        lead = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        open_places = np.flatnonzero(at < end)
        at, end = at[open_places], end[open_places]
        while len(open_places):
            hit = self.keys[at] == keys[open_places]
            found[open_places[hit]] = at[hit]
            on = ~hit & (at + 1 < end)
            open_places, at, end = open_places[on], at[on] + 1, end[on]
        return found

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states after one more symbol each; -1 where the trie has no such phrase."""
        cells = self.base[states] + symbols
        inside = (symbols >= 0) & (cells >= 0) & (cells < len(self.check))
        cells = np.where(inside, cells, 0)
        return np.where(inside & (self.check[cells] == states), cells, -1)

    def walk(self, symbols: np.ndarray, following: np.ndarray, words: int):
        """Per level the states that all places of a text reach.

        ``following[i]`` says that word ``i + 1`` may follow word ``i``.
        """
        for _, states in self._walked(np.flatnonzero(symbols >= 0), symbols, following, words):
            yield states

    def walk_rows(self, rows: np.ndarray):
        """Per level the rows of keys that reach a state, and the states; 0 ends a shorter row."""
        symbols, following = self.symbols(rows.reshape(-1)), rows != 0
        begins = np.arange(len(rows)) * rows.shape[1]
        following = np.append(following[:, 1:], np.zeros((len(rows), 1), bool), axis=1).reshape(-1)
        for places, states in self._walked(begins[symbols[begins] >= 0], symbols, following, rows.shape[1]):
            yield places // rows.shape[1], states

    def _walked(self, places: np.ndarray, symbols: np.ndarray, following: np.ndarray, words: int):
        """Per level the places of those given that come so far, and their states."""
        begins, states = places, symbols[places]
        yield begins, states
        for level in range(1, words):
            on = begins + level - 1 < len(following)
            begins, states = begins[on], states[on]
            on = following[begins + level - 1]
            begins, states = begins[on], states[on]
            states = self.step(states, symbols[begins + level])
            begins, states = begins[states >= 0], states[states >= 0]
            yield begins, states

    def states_of(self, phrases: np.ndarray) -> np.ndarray:
        """The state of each row of keys; 0 ends a shorter phrase."""
        symbols = self.symbols(phrases.reshape(-1)).reshape(phrases.shape)
        states = symbols[:, 0].copy()
        for level in range(1, phrases.shape[1]):
            longer = phrases[:, level] != 0
            states[longer] = self.step(states[longer], symbols[longer, level])
        return states


def build(phrases: np.ndarray) -> DoubleArray:
    """The trie of some phrases, rows of keys that 0 fills up, and of all their beginnings."""
    keys = np.unique(phrases)
    keys = keys[keys != 0]
    size = len(keys)
    trie = DoubleArray(keys, np.zeros(size, np.int64), np.full(size, -1, np.int64))
    free_from = size
    for level in range(1, phrases.shape[1]):
        longer = phrases[phrases[:, level] != 0][:, : level + 1]
        if not len(longer):
            break
        longer = longer[np.lexsort(longer.T[::-1])]
        longer = longer[np.append(True, (longer[1:] != longer[:-1]).any(axis=1))]
        parents = trie.states_of(longer[:, :level])
        free_from = _place(trie, parents, trie.symbols(longer[:, level]), free_from)
    return trie


def _place(trie: DoubleArray, parents: np.ndarray, symbols: np.ndarray, free_from: int) -> int:
    """Cells for the children of one level; returns the first cell that is still free.

    Nodes with many children draw bases until all their cells are free, those of like width
    together and the widest first; single children then fill the free cells one after another.
    """
    order = np.lexsort((symbols, parents))
    parents, symbols = parents[order], symbols[order]
    first = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
    counts = np.diff(np.append(first, len(parents)))
    span = len(trie.keys)
    base, check = trie.base, trie.check
    taken = check >= 0
    taken[:span] = True  # the states of single words
    wanted = np.zeros(len(check), np.int64)

    def reach(cells: int) -> None:
        nonlocal base, check, taken, wanted
        more = max(cells - len(check), 0)
        if more:
            more = max(more, len(check) // 4)
            base, check = np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1, np.int64))
            taken, wanted = np.append(taken, np.zeros(more, bool)), np.append(wanted, np.zeros(more, np.int64))

    draw = np.random.default_rng(0)  # the same phrases always give the same trie
    several, high, placed = np.flatnonzero(counts > 1), free_from, 0
    width = np.frexp(counts[several])[1]
    for alike in np.unique(width)[::-1]:
        nodes = several[width == alike]
        placed += int(counts[nodes].sum())
        high = max(high, free_from + placed + placed // 4)
        while len(nodes):
            sizes = counts[nodes]
            begins, total = np.cumsum(sizes) - sizes, int(sizes.sum())
            node = np.repeat(np.arange(len(nodes)), sizes)
            places = first[nodes][node] + np.arange(total) - begins[node]
            shift = symbols[places] - symbols[first[nodes]][node]
            reach(high + span)
            cells = draw.integers(free_from, high, (min(max(_CELLS // total, 1), _MOST_TRIED), len(nodes)))
            fits = np.logical_and.reduceat(~taken[cells[:, node] + shift], begins, axis=1)
            cells = cells[fits.argmax(axis=0), np.arange(len(nodes))][node] + shift
            on = np.flatnonzero(fits.any(axis=0)[node])
            wanted[cells[on][::-1]] = node[on][::-1]  # of nodes that want a cell the first has it
            chosen = fits.any(axis=0)
            chosen[node[on][wanted[cells[on]] != node[on]]] = False
            on = np.flatnonzero(chosen[node])
            taken[cells[on]], check[cells[on]] = True, parents[places[on]]
            base[parents[first[nodes[chosen]]]] = (cells - symbols[places])[begins[chosen]]
            if 4 * chosen.sum() < len(nodes):  # too few are free
                high += max((high - free_from) // 8, total)
            nodes = nodes[~chosen]
    single = first[counts == 1]
    reach(free_from + len(single) + int(taken[free_from:].sum()))
    cells = free_from + np.flatnonzero(~taken[free_from:])[: len(single)]
    taken[cells], check[cells] = True, parents[single]
    base[parents[single]] = cells - symbols[single]
    used = int(np.flatnonzero(taken)[-1]) + 1 if taken.any() else 0
    trie.base, trie.check = base[:used], check[:used]
    open_cells = np.flatnonzero(~taken[:used])
    return int(open_cells[0]) if len(open_cells) else used
