"""A linear-chain conditional random field over word shapes, in numpy.

Sequences are lists of pieces (letter runs, digit runs, single other characters). Training
maximises the conditional log-likelihood of a small labelled table by gradient ascent with
forward-backward; decoding is Viterbi over batches of sequences of like length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

PIECE = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
#: Words whose own text is a feature; all others count by shape alone.
CUES = frozenset(
    "tel phone call calls mobile fax cell contact contacto ring reach whatsapp number email mail write send e at dot com org net de ip host server ping connect address from card visa mastercard credit charged pay "
    "telefon handy tfno anrufen appelez téléphone teléfono móvil llame correo courriel tarjeta carte karte serial code id isbn order invoice account lot version build section".split()
)


def shape(piece: str) -> str:
    if piece.isdigit():
        return f"d{len(piece)}" if len(piece) <= 5 else "d6-9" if len(piece) < 10 else "d10-15" if len(piece) < 16 else "d16+"
    if piece[0].isalpha():
        case = "A" if piece.isupper() else "Aa" if piece[0].isupper() else "a"
        return case + ("1" if len(piece) == 1 else "2" if len(piece) == 2 else "3" if len(piece) <= 4 else "n")
    return piece


def features(pieces: list[tuple[str, bool]]) -> list[list[str]]:
    """Features of each (piece, does white space precede it)."""
    shapes = [shape(p) for p, _ in pieces]
    words = [p.lower() if p.lower() in CUES else "" for p, _ in pieces]
    out = []
    for i, (_, gap) in enumerate(pieces):
        f = [f"s={shapes[i]}", f"g={gap}{shapes[i]}"]
        if words[i]:
            f.append(f"w={words[i]}")
        for d in (-2, -1, 1, 2):
            j = i + d
            inside = 0 <= j < len(pieces)
            f.append(f"s{d}={shapes[j] if inside else '^'}")
            if inside and words[j]:
                f.append(f"w{d}={words[j]}")
        if i + 1 < len(pieces):
            f.append(f"n={shapes[i]}|{pieces[i + 1][1]}|{shapes[i + 1]}")
        if i:
            f.append(f"p={shapes[i - 1]}|{gap}|{shapes[i]}")
        out.append(f)
    return out


class Model:
    """Labels, feature weights [feature, label] and transition weights [label, label]."""

    def __init__(self, labels: list[str], index: dict[str, int], emit: np.ndarray, move: np.ndarray) -> None:
        self.labels, self.index, self.emit, self.move = labels, index, emit, move

    def scores(self, pieces: list[tuple[str, bool]]) -> np.ndarray:
        out = np.zeros((len(pieces), len(self.labels)))
        for i, fs in enumerate(features(pieces)):
            out[i] = self.emit[[self.index[f] for f in fs if f in self.index]].sum(0)
        return out

    def decode(self, sequences: list[list[tuple[str, bool]]]) -> list[list[str]]:
        """The likeliest labels of each sequence; like lengths are decoded together."""
        out: list[list[str]] = [[] for _ in sequences]
        for group in _by_length(sequences):
            length = max(len(sequences[i]) for i in group)
            score = np.zeros((len(group), length, len(self.labels)))
            for g, i in enumerate(group):
                score[g, : len(sequences[i])] = self.scores(sequences[i])
            path = self._viterbi(score, np.array([len(sequences[i]) for i in group]))
            for g, i in enumerate(group):
                out[i] = [self.labels[k] for k in path[g, : len(sequences[i])]]
        return out

    def _viterbi(self, score: np.ndarray, length: np.ndarray) -> np.ndarray:
        n, steps, k = score.shape
        best, back = score[:, 0].copy(), np.zeros((n, steps, k), np.int8)
        for t in range(1, steps):
            paths = best[:, :, None] + self.move[None]
            choice = paths.argmax(1)
            moved = np.take_along_axis(paths, choice[:, None], 1)[:, 0] + score[:, t]
            live = (t < length)[:, None]
            back[:, t] = np.where(live, choice, np.arange(k))
            best = np.where(live, moved, best)
        path = np.zeros((n, steps), np.int64)
        path[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return path


def _by_length(sequences: list, most: int = 60_000) -> Iterator[list[int]]:
    order = sorted((i for i in range(len(sequences)) if sequences[i]), key=lambda i: len(sequences[i]))
    held: list[int] = []
    for i in order:
        if held and (len(held) + 1) * len(sequences[i]) > most:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def train(table: list[list[tuple[str, bool, str]]], labels: list[str], rounds: int = 100, ridge: float = 0.02) -> Model:
    """Fit to sequences of (piece, gap before, label); deterministic."""
    index: dict[str, int] = {}
    known = {x: k for k, x in enumerate(labels)}
    rows, gold = [], []
    for sequence in table:
        fs = features([(p, g) for p, g, _ in sequence])
        rows.append([[index.setdefault(f, len(index)) for f in x] for x in fs])
        gold.append([known[y] for _, _, y in sequence])
    # places by time, longest sequences first, so that those of one time are a block and none is padding
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    rows, gold = [rows[i] for i in order], [gold[i] for i in order]
    k, none = len(labels), len(index)  # a feature of weight zero fills places up
    count = np.bincount([len(r) for r in rows])[::-1].cumsum()[::-1][1:]  # sequences of more than t places
    first = np.append(0, count.cumsum())
    block = [slice(first[t], first[t + 1]) for t in range(len(count))]
    flat = np.full((first[-1], max(len(f) for fs in rows for f in fs)), none)
    y = np.zeros(first[-1], np.int64)
    for i, (fs, ys) in enumerate(zip(rows, gold, strict=True)):
        for t, (f, c) in enumerate(zip(fs, ys, strict=True)):
            flat[first[t] + i, : len(f)], y[first[t] + i] = f, c
    by = np.argsort(flat, axis=None, kind="stable")
    by = by[flat.ravel()[by] < none]  # places by feature; every feature has some
    starts, place = np.flatnonzero(np.diff(flat.ravel()[by], prepend=-1)), by // flat.shape[1]

    def by_feature(values: np.ndarray) -> np.ndarray:
        """Sums of [place, label] values over the places that have each feature."""
        return np.add.reduceat(values[place], starts)

    pairs = [(slice(first[t], first[t] + count[t + 1]), block[t + 1]) for t in range(len(count) - 1)]
    onehot = np.eye(k)[y]
    want_emit = by_feature(onehot)
    want_move = sum((onehot[a].T @ onehot[b] for a, b in pairs), np.zeros((k, k)))
    emit, move = np.zeros((len(index), k)), np.zeros((k, k))
    speed = [np.zeros_like(emit), np.zeros_like(move)]
    for r in range(rounds):
        weights, score = np.vstack((emit, np.zeros(k))), np.zeros((len(flat), k))
        for f in flat.T:
            score += weights[f]
        likely, step = np.exp(score - score.max(1, keepdims=True)), np.exp(move)
        alpha, beta = np.empty_like(score), np.ones_like(score)  # each place's sum to one, by the scale kept in ``likely``
        for t, at in enumerate(block):
            part = likely[at] if not t else (alpha[pairs[t - 1][0]] @ step) * likely[at]
            scale = part.sum(1, keepdims=True)
            alpha[at] = part / scale
            likely[at] /= scale
        expected = np.zeros((k, k))
        for a, b in reversed(pairs):
            ahead = likely[b] * beta[b]
            beta[a] = ahead @ step.T
            expected += alpha[a].T @ ahead
        grads = [want_emit - by_feature(alpha * beta) - ridge * emit, want_move - expected * step - ridge * move]
        for w, g, v in zip((emit, move), grads, speed, strict=True):
            v[:] = 0.9 * v + 0.1 * g * g
            w += 0.1 * (0.98**r) * g / (np.sqrt(v) + 1e-6)
    return Model(labels, index, emit, move)
