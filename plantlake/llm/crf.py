"""A linear-chain conditional random field in numpy, over batches of padded sequences.

A word has a fixed number of binary features, given as indices of weight rows;
labels are numbered, 0 being the outside. Sequences start and end outside.
"""

from __future__ import annotations

import numpy as np

#: Score of what a label sequence must not do.
FORBIDDEN = -1e4
#: Words of the sequences that are padded and decoded together.
WORDS_AT_ONCE = 100_000


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(n, longest, …) with zeros behind each sequence, and the lengths."""
    sizes = np.array([len(s) for s in sequences])
    out = np.zeros((len(sequences), sizes.max(), *sequences[0].shape[1:]), dtype=sequences[0].dtype)
    for row, s in zip(out, sequences, strict=True):
        row[: len(s)] = s
    return out, sizes


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Crf:
    """``weights`` (features, labels), ``moves`` (labels, labels); ``allowed`` says which moves may be."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, allowed: np.ndarray):
        self.weights, self.moves, self.allowed = weights, moves, allowed

    @property
    def steps(self) -> np.ndarray:
        return np.where(self.allowed, self.moves, FORBIDDEN)

    @classmethod
    def fit(cls, words: list[np.ndarray], labels: list[np.ndarray], features: int, allowed: np.ndarray,
            rounds: int = 60, rate: float = 0.5, prior: float = 0.02) -> Crf:
        """The conditional likelihood's maximum, nearly, by full-batch adaptive gradient steps.

        ``prior`` is the weight of the squared parameters. Without sequences
        every word is outside.
        """
        k = len(allowed)
        model = cls(np.zeros((features, k)), np.zeros((k, k)), allowed)
        if not words:
            model.weights[:, 1:] = FORBIDDEN
            return model
        x, sizes = padded(words)
        y, _ = padded(labels)
        real = np.arange(x.shape[1])[None, :] < sizes[:, None]
        gold = np.eye(k)[y] * real[:, :, None]
        seen = np.zeros((k, k))
        both = real[:, 1:]
        np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
        np.add.at(seen, (np.zeros(len(y), dtype=int), y[:, 0]), 1)
        np.add.at(seen, (y[np.arange(len(y)), sizes - 1], np.zeros(len(y), dtype=int)), 1)
        n, past_w, past_m = len(words), 1e-8, 1e-8
        for _ in range(rounds):
            single, pair = model._expected(x, sizes)
            error = (gold - single) / n
            up = np.zeros_like(model.weights)
            for f in range(x.shape[2]):
                np.add.at(up, x[:, :, f][real], error[real])
            up -= prior * model.weights / n
            move = np.where(allowed, (seen - pair) / n - prior * model.moves / n, 0)
            past_w, past_m = past_w + up**2, past_m + move**2
            model.weights += rate * up / np.sqrt(past_w)
            model.moves += rate * move / np.sqrt(past_m)
        return model

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Label scores of words given as rows of feature indices."""
        total = self.weights[x[..., 0]].copy()
        for f in range(1, x.shape[-1]):
            total += self.weights[x[..., f]]
        return total

    def _expected(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of every word, and expected moves over all sequences."""
        s, steps, last = self.scores(x), self.steps, sizes - 1
        rows, length = np.arange(len(x)), x.shape[1]
        ahead, back = np.zeros_like(s), np.zeros_like(s)
        ahead[:, 0] = s[:, 0] + steps[0]
        for t in range(1, length):
            ahead[:, t] = s[:, t] + _logsum(ahead[:, t - 1, :, None] + steps, 1)
        total = _logsum(ahead[rows, last] + steps[:, 0], 1)
        back[:, -1] = steps[:, 0]
        for t in range(length - 2, -1, -1):
            on = _logsum(steps[None] + (s[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where((t >= last)[:, None], steps[:, 0], on)
        real = np.arange(length)[None, :] < sizes[:, None]
        single = np.exp(np.minimum(ahead + back - total[:, None, None], 0)) * real[:, :, None]
        pair = np.zeros_like(self.moves)
        pair[0] += single[:, 0].sum(axis=0)
        pair[:, 0] += single[rows, last].sum(axis=0)
        for t in range(1, length):
            on = real[:, t]
            joint = ahead[on, t - 1, :, None] + steps + (s[on, t] + back[on, t])[:, None, :] - total[on, None, None]
            pair += np.exp(np.minimum(joint, 0)).sum(axis=0)
        return single, pair

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The best label sequence of each (Viterbi), ties to the smaller label."""
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        out: list = [None] * len(sequences)
        at = 0
        while at < len(order):
            # sequences of about one length together: little is padded
            count = max(1, WORDS_AT_ONCE // max(1, len(sequences[order[at]])))
            while count > 1 and len(sequences[order[min(at + count, len(order)) - 1]]) * count > 2 * WORDS_AT_ONCE:
                count //= 2
            some = order[at : at + count]
            for i, best in zip(some, self._viterbi(*padded([sequences[i] for i in some])), strict=True):
                out[i] = best
            at += count
        return out

    def _viterbi(self, x: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        s, steps, rows = self.scores(x), self.steps, np.arange(len(x))
        came = np.zeros(s.shape, dtype=np.int16)
        score = s[:, 0] + steps[0]
        for t in range(1, x.shape[1]):
            ways = score[:, :, None] + steps
            came[:, t] = ways.argmax(axis=1)
            new = ways.max(axis=1) + s[:, t]
            score = np.where((t < sizes)[:, None], new, score)
        label = (score + steps[:, 0]).argmax(axis=1)
        found = np.zeros(x.shape[:2], dtype=np.int64)
        for t in range(x.shape[1] - 1, -1, -1):
            found[:, t] = label
            label = np.where(t < sizes, came[rows, t, label], label)
        return [f[:n] for f, n in zip(found, sizes, strict=True)]
