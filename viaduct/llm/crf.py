"""A linear-chain conditional random field over sequences of hashed features, in numpy.

A sequence is a list of tokens, a token a list of feature names. The score of a labelling is the sum of a weight for
each (feature, label) and each pair of neighbouring labels. Training maximises the penalised log-likelihood by
gradient ascent with forward and backward sums; decoding is Viterbi. Both run over padded batches, one step of the
chain at a time for all sequences.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np

BUCKETS = 1 << 13


def buckets(features: list[str]) -> list[int]:
    return [crc32(name.encode()) % BUCKETS for name in features]


class Chains:
    """Sequences as padded arrays: `ids` (sequence, place, feature), with `BUCKETS` for none, and `lengths`."""

    def __init__(self, sequences: list[list[list[int]]]):
        self.lengths = np.array([len(sequence) for sequence in sequences])
        wide = max((len(token) for sequence in sequences for token in sequence), default=1)
        self.ids = np.full((len(sequences), int(self.lengths.max(initial=1)), wide), BUCKETS, np.int32)
        for row, sequence in enumerate(sequences):
            for place, token in enumerate(sequence):
                self.ids[row, place, :len(token)] = token


def emissions(weights: np.ndarray, chains: Chains) -> np.ndarray:
    padded = np.vstack([weights, np.zeros((1, weights.shape[1]))])
    return padded[chains.ids].sum(axis=2)


def _sum_exp(scores: np.ndarray, axis: int) -> np.ndarray:
    top = scores.max(axis=axis, keepdims=True)
    return np.log(np.exp(scores - top).sum(axis=axis)) + top.squeeze(axis)


def train(sequences, labels: list[list[int]], n_labels: int, rounds: int = 150, rate: float = 0.5,
          penalty: float = 0.002) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature, label) and (label, next label). The same input gives the same weights."""
    chains = Chains(sequences)
    rows, steps = chains.ids.shape[:2]
    truth = np.zeros((rows, steps, n_labels))
    for row, sequence in enumerate(labels):
        truth[row, np.arange(len(sequence)), sequence] = 1
    real = np.arange(steps)[None, :] < chains.lengths[:, None]
    both = real[:, 1:]
    weights, moves = np.zeros((BUCKETS, n_labels)), np.zeros((n_labels, n_labels))
    seen_w, seen_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    pairs = (truth[:, :-1, :, None] * truth[:, 1:, None, :] * both[:, :, None, None]).sum(axis=(0, 1))
    for _ in range(rounds):
        score = emissions(weights, chains)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, steps):
            step = _sum_exp(ahead[:, t - 1, :, None] + moves[None], 1) + score[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            step = _sum_exp(moves[None] + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(real[:, t + 1, None], step, 0.0)
        whole = _sum_exp(ahead[:, -1], 1)
        single = np.exp(ahead + back - whole[:, None, None]) * real[:, :, None]
        pair = np.exp(ahead[:, :-1, :, None] + moves[None, None] + (score + back)[:, 1:, None, :]
                      - whole[:, None, None, None]) * both[:, :, None, None]
        gradient = np.zeros((BUCKETS + 1, n_labels))
        np.add.at(gradient, chains.ids, (truth * real[:, :, None] - single)[:, :, None, :])
        for value, slope, seen in ((weights, gradient[:-1] / rows - penalty * weights, seen_w),
                                   (moves, (pairs - pair.sum(axis=(0, 1))) / rows - penalty * moves, seen_m)):
            seen += slope * slope
            value += rate * slope / np.sqrt(seen)
    return weights, moves


def viterbi(weights: np.ndarray, moves: np.ndarray, sequences) -> list[np.ndarray]:
    """The best labels of every sequence."""
    if not sequences:
        return []
    chains = Chains(sequences)
    score = emissions(weights, chains)
    rows, steps, n_labels = score.shape
    best = score[:, 0]
    came = np.zeros((rows, steps, n_labels), np.int8)
    ends = np.zeros(rows, np.int64)
    ends[chains.lengths == 1] = best[chains.lengths == 1].argmax(axis=1)
    for t in range(1, steps):
        options = best[:, :, None] + moves[None]
        came[:, t] = options.argmax(axis=1)
        best = options.max(axis=1) + score[:, t]
        last = chains.lengths == t + 1
        ends[last] = best[last].argmax(axis=1)
    labels = np.zeros((rows, steps), np.int64)
    place = ends
    for t in range(steps - 1, -1, -1):
        # Before its last place a sequence follows its marks back; from there on it waits.
        place = np.where(t == chains.lengths - 1, ends, place)
        labels[:, t] = place
        place = np.where(t < chains.lengths, came[np.arange(rows), t, place], place)
    return [labels[row, :length] for row, length in enumerate(chains.lengths)]
