"""Linear-chain conditional random field in numpy: training by gradient, decoding by Viterbi, many chains at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Weights of features per label, of label pairs, and of the first label."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of chains laid end to end. ``scores`` is words x labels, ``lengths`` per chain.

        Chains are taken longest first and step by step, so each step works on all chains that still go on.
        """
        order = np.argsort(-lengths, kind="stable")
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
        size = lengths[order]
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        best = np.empty(scores.shape, scores.dtype)
        came = np.zeros(scores.shape, np.int8)
        for t, n in enumerate(alive):
            at = begin[:n] + t
            if t == 0:
                best[at] = scores[at] + self.start
                continue
            reach = best[at - 1][:, :, None] + self.move
            came[at] = reach.argmax(1)
            best[at] = scores[at] + reach.max(1)
        labels = np.zeros(len(scores), np.int8)
        if len(alive):
            ends = begin + size - 1
            some = size > 0
            labels[ends[some]] = best[ends[some]].argmax(1)
            for t in range(len(alive) - 1, 0, -1):
                at = begin[: alive[t]] + t
                labels[at - 1] = came[at, labels[at]]
        return labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def fit(features: np.ndarray, labels: np.ndarray, chain: np.ndarray, kinds: int, steps: int = 100, rate: float = 0.1, ridge: float = 1e-3) -> Chain:
    """Fit on words in chain order. ``features`` is words x features, ``chain`` numbers the chain of each word.

    Maximises the mean log-likelihood of whole chains less a ridge penalty, with Adam.
    """
    n, m = features.shape
    first = np.flatnonzero(np.r_[True, chain[1:] != chain[:-1]])
    lengths = np.diff(np.r_[first, n])
    place = np.arange(n) - np.repeat(first, lengths)
    which = np.repeat(np.arange(len(first)), lengths)
    longest, count = int(lengths.max()), len(first)
    mask = np.zeros((count, longest), bool)
    mask[which, place] = True
    x = np.zeros((count, longest, m))
    x[which, place] = features
    y = np.zeros((count, longest), np.int64)
    y[which, place] = labels
    truth = np.eye(kinds)[y] * mask[:, :, None]
    pairs = np.einsum("cti,ctj->ij", truth[:, :-1], truth[:, 1:])
    weights = [np.zeros((m, kinds)), np.zeros((kinds, kinds)), np.zeros(kinds)]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        emit, move, start = weights
        score = x @ emit
        forward, backward = np.empty_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0] + start
        for t in range(1, longest):
            reach = score[:, t] + _log_sum(forward[:, t - 1][:, :, None] + move, 1)
            forward[:, t] = np.where(mask[:, t, None], reach, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            reach = _log_sum(move + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], reach, 0)
        norm = _log_sum(forward[:, -1], 1)
        single = np.exp(forward + backward - norm[:, None, None]) * mask[:, :, None]
        moved = np.zeros((kinds, kinds))
        for t in range(1, longest):
            joint = forward[:, t - 1][:, :, None] + move + (score[:, t] + backward[:, t])[:, None, :] - norm[:, None, None]
            moved += (np.exp(joint) * mask[:, t, None, None]).sum(0)
        slopes = [
            np.einsum("ctm,ctk->mk", x, truth - single) / count - ridge * emit,
            (pairs - moved) / count - ridge * move,
            (truth[:, 0] - single[:, 0]).mean(0) - ridge * start,
        ]
        for w, g, u, v in zip(weights, slopes, mean, square, strict=True):
            u += 0.1 * (g - u)
            v += 0.01 * (g * g - v)
            w += rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Chain(*weights)
