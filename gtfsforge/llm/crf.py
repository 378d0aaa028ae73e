"""A linear-chain conditional random field over three tags: outside, begin, inside.

An inside tag only follows begin or inside.  Trained by gradient steps on the
log-likelihood, with forward and backward passes over all sequences at once;
decoded by Viterbi over all sequences at once.
"""

from __future__ import annotations

import numpy as np

OUT, BEGIN, INSIDE = 0, 1, 2
NEVER = -1e4


def _forbid(trans: np.ndarray) -> np.ndarray:
    trans = trans.copy()
    trans[OUT, INSIDE] = NEVER
    return trans


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(features: np.ndarray, tags: np.ndarray, lengths: np.ndarray, epochs: int = 60, rate: float = 0.1, penalty: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights of features by tag, transition weights) from sequences laid end to end.

    features: tokens by features; tags: of each token; lengths: of the sequences.
    """
    s, t, f = len(lengths), int(lengths.max()), features.shape[1]
    row = np.repeat(np.arange(s), lengths)
    col = np.arange(len(tags)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    first = col == 0
    w, trans = np.zeros((f, 3)), np.zeros((3, 3))
    seen = np.zeros((f, 3))
    for k in range(3):
        seen[:, k] = features[tags == k].sum(0)
    moved = np.zeros((3, 3))
    np.add.at(moved, (tags[:-1][~first[1:]], tags[1:][~first[1:]]), 1.0)
    moments = [np.zeros_like(x) for x in (w, w, trans, trans)]
    mask = np.zeros((s, t), bool)
    mask[row, col] = True
    for epoch in range(1, epochs + 1):
        a = _forbid(trans)
        e = np.full((s, t, 3), 0.0)
        e[row, col] = features @ w
        fwd = np.zeros((s, t, 3))
        fwd[:, 0] = e[:, 0] + np.array([0.0, 0.0, NEVER])
        for i in range(1, t):
            step = _logsum(fwd[:, i - 1, :, None] + a[None], 1) + e[:, i]
            fwd[:, i] = np.where(mask[:, i, None], step, fwd[:, i - 1])
        total = _logsum(fwd[:, -1], 1)
        bwd = np.zeros((s, t, 3))
        want = np.zeros((3, 3))
        for i in range(t - 2, -1, -1):
            on = mask[:, i + 1]
            after = e[:, i + 1] + bwd[:, i + 1]
            bwd[:, i] = np.where(on[:, None], _logsum(a[None] + after[:, None, :], 2), 0.0)
            pair = np.exp(fwd[on, i, :, None] + a[None] + after[on][:, None, :] - total[on][:, None, None])
            want += pair.sum(0)
        post = np.exp(fwd + bwd - total[:, None, None])[row, col]
        grads = ((features.T @ post - seen) / s + penalty * w, (want - moved) / s + penalty * trans)
        for i, (x, g) in enumerate(zip((w, trans), grads)):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g**2 - v)
            x -= rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return w, _forbid(trans)


def viterbi(e: np.ndarray, trans: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The best tags of tokens with emission scores e, in sequences that begin at `starts`.

    Sequences none of whose tokens can gain by a tag other than outside are
    outside altogether, and are not walked through.
    """
    n = len(e)
    tags = np.zeros(n, np.int8)
    if not n:
        return tags
    # the most that a begin or inside token can gain, with what its transitions can gain over outside to outside
    stay = trans[OUT, OUT]
    extra = max(0.0, (trans[:, BEGIN].max() - stay)) + max(0.0, trans[BEGIN:, OUT].max() - stay)
    gain = np.maximum(e[:, BEGIN], e[:, INSIDE]) - e[:, OUT]
    inside = max(0.0, trans[BEGIN:, INSIDE].max() - stay)
    hopeful = gain + max(extra, inside, extra + inside) > 0
    lengths = np.diff(np.concatenate((starts, [n])))
    seqs = np.flatnonzero(np.add.reduceat(hopeful, starts) > 0)
    if not len(seqs):
        return tags
    seqs = seqs[np.argsort(-lengths[seqs], kind="stable")]
    s, ln = starts[seqs], lengths[seqs]
    best = e[s] + np.array([0.0, 0.0, NEVER])
    back: list[np.ndarray] = []
    for i in range(1, int(ln[0])):
        k = int(np.searchsorted(-ln, -i, side="left"))  # sequences longer than i
        cand = best[:k, :, None] + trans[None]
        came = cand.argmax(1)
        back.append(came.astype(np.int8))
        best[:k] = np.take_along_axis(cand, came[:, None, :], 1)[:, 0] + e[s[:k] + i]
    now = best.argmax(1)
    tags[s + ln - 1] = now
    for i in range(int(ln[0]) - 1, 0, -1):
        k = int(np.searchsorted(-ln, -i, side="left"))
        now[:k] = back[i - 1][np.arange(k), now[:k]]
        tags[s[:k] + i - 1] = now[:k]
    return tags
