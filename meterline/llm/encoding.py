"""Token ids of many texts at once from a byte-level tokenizer.

Texts are cut where the tokenizer's own words end for certain (a pattern of letters, digits, marks
and white space, a space leading the word after it), so the ids of the pieces joined are the ids
of the text.  Equal pieces are encoded once.
"""

from __future__ import annotations

import json
import os
import sys
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa

from meterline.llm.words import U64, Words, text_bytes

# Bytes of text worked on at once, and bytes of different pieces remembered from earlier ones.
WINDOW = 1 << 19
MOST_KNOWN = 12 << 20
# Remembered pieces are found by so many leading bits of their hash, and told apart by the 32 last;
# a later one takes the place of an earlier.
_PLACE_BITS = 22
# Pieces that the library encodes at once, and those that one string of them holds.
_AT_ONCE, _JOINED = 1 << 14, 1 << 8

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = _VISIBLE & ~_LETTER
_MARK[0x30:0x3A] = False
# Characters of two bytes from U+00C0 on, none of them white space; those below U+0100 are letters but two.
_TWO_BYTES = np.zeros(256, bool)
_TWO_BYTES[0xC3:0xE0] = True
_NO_LETTER = np.zeros(256, bool)
_NO_LETTER[[0x97, 0xB7]] = True


def _spaces(data: np.ndarray) -> np.ndarray:
    """Places of spaces and line ends after a character that is surely no white space.

    Only a run of white space holds white space or what comes after it, so one begins there.
    """
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = at[at > 1]
    return at[_VISIBLE[data[at - 1]] | (_TWO_BYTES[data[at - 2]] & (data[at - 1] >= 0x80))]


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places where the words of the tokenizer end, whatever surrounds them: those of
    :func:`_spaces`, marks after a letter, and what follows a single line end."""
    spaces = _spaces(data)
    marks = np.flatnonzero(_MARK[data])
    marks = marks[marks > 1]
    latin = (data[marks - 2] == 0xC3) & (data[marks - 1] >= 0x80) & ~_NO_LETTER[data[marks - 1]]
    marks = marks[_LETTER[data[marks - 1]] | latin]
    lines = spaces[data[spaces] == 0x0A] + 1
    lines = lines[lines < len(data)]
    lines = lines[_VISIBLE[data[lines]] | _TWO_BYTES[data[lines]]]
    return np.concatenate([spaces, marks, lines])


class TextEncoder:
    """Encodes windows of text; remembers the ids of short pieces between them."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        if any(token.split() != [token] for token in self.added):
            raise ValueError("tokens that hold white space are not supported")
        self.separator = _separator(model)
        self._forget()

    def _forget(self) -> None:
        self.tags = np.zeros(1 << _PLACE_BITS, np.uint32)
        self.places = np.full(1 << _PLACE_BITS, -1, np.int32)
        self.bytes, self.ids = Runs(np.uint8), Runs(np.uint32)

    def windows(self, column: pa.Array):
        """(text, ids, whether the text ends) for parts of the texts of a column, in order.

        Only texts beyond a window have several parts.
        """
        data, offsets = text_bytes(column)
        text, low = 0, 0
        while text < len(column):
            high = min(low + WINDOW, len(data))
            while True:
                last = int(np.searchsorted(offsets, high, "right")) - 1  # texts before this one end in the window
                if last > text or high == len(data):
                    stop = int(offsets[last])
                    break
                cuts = _spaces(data[low:high])
                if len(cuts):
                    stop, last = low + int(cuts[-1]), text
                    break
                high = min(high + WINDOW, len(data))
            edges = np.maximum(offsets[text:last], low)
            starts = np.concatenate([[low], edges, low + self._cuts(data[low:stop])]).astype(np.int64)
            starts = np.sort(starts, kind="stable")  # merges the sorted parts
            starts = starts[np.append(True, starts[1:] > starts[:-1]) & (starts < stop)]
            ids, ends = self._pieces(data[low:stop], starts - low, stop - low)
            bounds = np.append(starts, stop)
            if last > text:
                for i in range(text, last):
                    first, after = np.searchsorted(bounds, [max(offsets[i], low), offsets[i + 1]])
                    yield i, ids[ends[first] : ends[after]], True
                text, low = last, stop
            else:
                yield text, ids, False
                low = stop

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Cuts, but for those within a token that is recognised as a whole."""
        cuts, raw = _cuts(data), data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                cuts = cuts[(cuts <= at) | (cuts >= at + len(token))]
                at = raw.find(token, at + len(token))
        return cuts

    def _pieces(self, data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after another, and where those of each begin and the last end."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        stops = np.append(starts[1:], size)
        hashes = Words(data, starts, stops, np.array([0, len(starts)])).hashes()
        if self.bytes.size > MOST_KNOWN:
            self._forget()
        slots, tags = (hashes >> U64(64 - _PLACE_BITS)).astype(np.int64), hashes.astype(np.uint32)
        used = np.where(self.tags[slots] == tags, self.places[slots], -1)
        unknown = np.flatnonzero(used < 0)
        if len(unknown):
            _, first, which = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            first = unknown[first]
            used[unknown] = self.bytes.count + which
            self._remember([data[starts[i] : stops[i]].tobytes() for i in first.tolist()])
            self.tags[slots[first]] = tags[first]
            self.places[slots[first]] = used[first]
        same, _ = self.bytes.gathered(used)
        if len(same) != size or not np.array_equal(same, data):  # two pieces share a hash
            ids, sizes = self._encoded([data[i:j].tobytes() for i, j in zip(starts.tolist(), stops.tolist())])
            return ids, np.append(0, np.cumsum(sizes))
        ids, ends = self.ids.gathered(used)
        return ids, np.append(0, ends)

    def _remember(self, raw: list[bytes]) -> None:
        ids, sizes = self._encoded(raw)
        self.bytes.extend(np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw)))
        self.ids.extend(ids, sizes)

    def _encoded(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pieces, one after another, and how many each has."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low in range(0, len(raw), _AT_ONCE):
            some = raw[low : low + _AT_ONCE]
            found = (self._joined(some) if self.separator else None) or self._single(some)
            ids.append(found[0])
            sizes.append(found[1])
        return np.concatenate(ids), np.concatenate(sizes)

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _single(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._batch([x.decode() for x in raw])
        return np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    def _joined(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same with a token between pieces, around which the library encodes each by itself;
        none if a piece holds that token."""
        text, number = self.separator
        joined = [text.join(raw[low : low + _JOINED]) for low in range(0, len(raw), _JOINED)]
        if sum(x.count(text) for x in joined) != len(raw) - len(joined):
            return None
        lists = self._batch([x.decode() for x in joined])
        for ids in lists:
            ids.append(number)
        ids = np.fromiter(chain.from_iterable(lists), np.uint32)
        ends = np.flatnonzero(ids == number)
        return ids[ids != number], np.diff(ends, prepend=-1) - 1


def _separator(model: str) -> tuple[bytes, int] | None:
    """The token, and its id, at which texts of a byte-level tokenizer are split before all else.

    It must be the only one that is added, take nothing from around it, and not overlap with itself.
    """
    parts = json.loads(model)
    splits, added = parts.get("pre_tokenizer") or {}, parts.get("added_tokens") or []
    if parts.get("normalizer") or parts.get("truncation") or splits.get("type") != "ByteLevel" or len(added) != 1:
        return None
    token, text = added[0], added[0]["content"]
    if any(token.get(name) for name in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    if any(text.startswith(text[i:]) for i in range(1, len(text))):
        return None
    return text.encode(), token["id"]


class Runs:
    """Runs of values one after another, in arrays with room for more of them."""

    def __init__(self, kind: type):
        self.count = self.size = 0
        self.values, self.ends = np.empty(1 << 16, kind), np.zeros(1 << 12, np.int64)

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        """Further runs of the given sizes."""
        count, size = self.count + len(sizes), self.size + len(values)
        self.values, self.ends = _roomy(self.values, self.size, size), _roomy(self.ends, self.count + 1, count + 1)
        self.values[self.size : size] = values
        self.ends[self.count + 1 : count + 1] = self.size + np.cumsum(sizes)
        self.count, self.size = count, size

    def gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of some runs, one after another, and where those of each end."""
        starts = self.ends[which]
        sizes = self.ends[which + 1] - starts
        ends = np.cumsum(sizes)
        at = np.repeat(starts - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.values[at], ends


def _roomy(array: np.ndarray, used: int, needed: int) -> np.ndarray:
    """``array``, or a copy of its used part in twice the room that is needed."""
    if needed <= len(array):
        return array
    longer = np.empty(2 * needed, array.dtype)
    longer[:used] = array[:used]
    return longer


def encoder_of(model: str) -> TextEncoder:
    """The encoder of a Python worker, which its later tasks find again.

    Functions of this package are unpickled for every task, so their own globals would not stay.
    """
    kept = sys.modules.setdefault("_kept_encoders", ModuleType("_kept_encoders"))
    if getattr(kept, "model", None) != model:
        kept.model, kept.encoder = model, TextEncoder(model)
    return kept.encoder
