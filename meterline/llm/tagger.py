"""A character tagger: bidirectional LSTM with a conditional random field, in numpy.

Sequences are rows of character classes of one length.  Training is exact back-propagation
of the negative log-likelihood of the tag sequences; decoding is Viterbi.  Everything is
computed for many rows at once, one step along the rows at a time.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
RATE = 0.02
BATCH = 64


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Weights: per direction an input table by class and a recurrent matrix, then tag scores."""

    def __init__(self, classes: int, tags: int, seed: int = 0):
        draw = np.random.default_rng(seed)
        self.tags = tags
        gates = 4 * HIDDEN
        self.weights = {
            "output": draw.normal(0, 0.2, (2 * HIDDEN, tags)),
            "bias": np.zeros(tags),
            "moves": np.zeros((tags, tags)),
            "first": np.zeros(tags),
        }
        for way in ("ahead", "back"):
            self.weights[f"{way}_in"] = draw.normal(0, 0.3, (classes, gates))
            self.weights[f"{way}_rec"] = draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, gates))

    # network ------------------------------------------------------------------

    def _lstm(self, rows: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (row, step, unit), along the rows or against them."""
        table, recurrent = self.weights[f"{way}_in"], self.weights[f"{way}_rec"]
        count, steps = rows.shape
        hidden, cell = np.zeros((count, HIDDEN), table.dtype), np.zeros((count, HIDDEN), table.dtype)
        out = np.empty((count, steps, HIDDEN), table.dtype)
        for t in range(steps) if way == "ahead" else range(steps - 1, -1, -1):
            gates = table[rows[:, t]] + hidden @ recurrent
            opened = _sigmoid(gates[:, : 3 * HIDDEN])
            let, forget, show = np.split(opened, 3, axis=1)
            new = np.tanh(gates[:, 3 * HIDDEN :])
            before, before_hidden = cell, hidden
            cell = forget * cell + let * new
            squashed = np.tanh(cell)
            hidden = show * squashed
            out[:, t] = hidden
            if keep is not None:
                keep.append((t, let, forget, show, new, before, before_hidden, squashed))
        return out

    def _lstm_slopes(self, rows: np.ndarray, way: str, kept: list, slopes: np.ndarray, into: dict) -> None:
        recurrent = self.weights[f"{way}_rec"]
        table_slope = into[f"{way}_in"] = np.zeros_like(self.weights[f"{way}_in"])
        rec_slope = into[f"{way}_rec"] = np.zeros_like(recurrent)
        d_hidden, d_cell = np.zeros((len(rows), HIDDEN)), np.zeros((len(rows), HIDDEN))
        for t, let, forget, show, new, before, before_hidden, squashed in reversed(kept):
            d_hidden = d_hidden + slopes[:, t]
            d_cell = d_cell + d_hidden * show * (1 - squashed**2)
            gates = np.concatenate(
                [
                    d_cell * new * let * (1 - let),
                    d_cell * before * forget * (1 - forget),
                    d_hidden * squashed * show * (1 - show),
                    d_cell * let * (1 - new**2),
                ],
                axis=1,
            )
            np.add.at(table_slope, rows[:, t], gates)
            rec_slope += before_hidden.T @ gates
            d_hidden, d_cell = gates @ recurrent.T, d_cell * forget

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._lstm(rows, "ahead"), self._lstm(rows, "back")], axis=2)
        return states @ self.weights["output"] + self.weights["bias"]

    # random field -------------------------------------------------------------

    def loss_and_slopes(self, rows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags and its slopes in all weights."""
        kept: dict[str, list] = {"ahead": [], "back": []}
        states = np.concatenate([self._lstm(rows, way, kept[way]) for way in ("ahead", "back")], axis=2)
        scores = states @ self.weights["output"] + self.weights["bias"]
        moves, first = self.weights["moves"], self.weights["first"]
        count, steps, size = scores.shape
        forward, backward = np.empty_like(scores), np.zeros_like(scores)
        forward[:, 0] = first + scores[:, 0]
        for t in range(1, steps):
            forward[:, t] = scores[:, t] + _logsumexp(forward[:, t - 1, :, None] + moves, 1)
        for t in range(steps - 2, -1, -1):
            backward[:, t] = _logsumexp(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        total = _logsumexp(forward[:, -1], 1)
        at = np.arange(count)[:, None], np.arange(steps)[None, :], tags
        gold = scores[at].sum(1) + first[tags[:, 0]] + moves[tags[:, :-1], tags[:, 1:]].sum(1)
        d_scores = np.exp(forward + backward - total[:, None, None])
        d_scores[at] -= 1
        d_moves = np.zeros_like(moves)
        for t in range(steps - 1):
            joint = forward[:, t, :, None] + moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
            d_moves += np.exp(joint - total[:, None, None]).sum(0)
        np.add.at(d_moves, (tags[:, :-1], tags[:, 1:]), -1)
        slopes = {"moves": d_moves, "first": d_scores[:, 0].sum(0), "bias": d_scores.sum((0, 1))}
        slopes["output"] = np.einsum("rti,rtk->ik", states, d_scores)
        d_states = d_scores @ self.weights["output"].T
        self._lstm_slopes(rows, "ahead", kept["ahead"], d_states[..., :HIDDEN], slopes)
        self._lstm_slopes(rows, "back", kept["back"], d_states[..., HIDDEN:], slopes)
        return float((total - gold).mean()), {name: slope / count for name, slope in slopes.items()}

    def fit(self, rows: np.ndarray, tags: np.ndarray, rounds: int, seed: int = 0) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each round."""
        draw = np.random.default_rng(seed)
        mean = {name: np.zeros_like(w) for name, w in self.weights.items()}
        square = {name: np.zeros_like(w) for name, w in self.weights.items()}
        losses, step = [], 0
        for turn in range(rounds):
            order, lost = draw.permutation(len(rows)), []
            for low in range(0, len(order), BATCH):
                chosen = order[low : low + BATCH]
                loss, slopes = self.loss_and_slopes(rows[chosen], tags[chosen])
                lost.append(loss)
                step += 1
                size = np.sqrt(sum((s**2).sum() for s in slopes.values()))
                for name, slope in slopes.items():
                    slope = slope * min(1.0, 5.0 / (size + 1e-12))
                    mean[name] += 0.1 * (slope - mean[name])
                    square[name] += 0.001 * (slope**2 - square[name])
                    towards = mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = self.weights[name] - RATE * (1 - turn / rounds) * towards
            losses.append(float(np.mean(lost)))
        return losses

    def decode(self, rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags, and per step how far the best tag's score is above the others' in the network.

        ``allowed`` (tags + 1, tags) says which tag may follow which; its last row is for the start.
        """
        scores = self.emissions(rows)
        barred = np.where(allowed, 0.0, -1e9).astype(scores.dtype)
        moves, best = self.weights["moves"] + barred[:-1], self.weights["first"] + barred[-1] + scores[:, 0]
        count, steps, _ = scores.shape
        origin = np.zeros(scores.shape, np.int8)
        for t in range(1, steps):
            ways = best[:, :, None] + moves
            origin[:, t] = ways.argmax(1)
            best = ways.max(1) + scores[:, t]
        tags = np.zeros((count, steps), np.int8)
        tags[:, -1] = best.argmax(1)
        each = np.arange(count)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = origin[each, t, tags[:, t]]
        margin = scores - scores[..., :1]
        return tags, np.take_along_axis(margin, tags[..., None].astype(np.int64), 2)[..., 0]
