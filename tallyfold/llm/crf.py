"""A linear-chain conditional random field with two tags, for many sequences at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Steps of a block.  Blocks of all sequences advance together; what a block does to a tag vector is one 2 x 2 matrix.
STEPS = 32


@dataclass
class Chain:
    """Marginals: ``p`` of tag 1 at every place, ``pairs`` summed over neighbours, ``starts`` summed over first places."""

    p: np.ndarray
    pairs: np.ndarray
    starts: np.ndarray


def forward_backward(score: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False) -> Chain:
    """Exact marginals of sequences that lie in a row; sequence s is ``first[s]:first[s + 1]``.

    ``score`` is the log-odds of tag 1 at each place, ``trans`` and ``start`` are
    log-potentials.  Sequences are cut into blocks: a block's product of
    matrices is formed for all blocks in parallel, carried from block to block
    of a sequence, and then spread within the blocks.
    """
    n, lengths = len(score), np.diff(first)
    blocks = -(-lengths // STEPS)
    seq = np.repeat(np.arange(len(lengths)), blocks)
    order = np.arange(len(seq)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    nb = len(seq)
    at = first[seq][:, None] + order[:, None] * STEPS + np.arange(STEPS)[None, :]
    real = at < first[seq + 1][:, None]
    at = np.where(real, at, 0)
    s = np.where(real, np.clip(score, -40, 40)[at] if n else 0.0, 0.0)
    one = 1 / (1 + np.exp(-s.T))
    zero = 1 - one
    (t00, t01), (t10, t11) = np.exp(trans)
    pi0, pi1 = np.exp(start)
    # m_ij[k, b] takes tag i before place k of block b to tag j at it
    m00, m01, m10, m11 = t00 * zero, t01 * one, t10 * zero, t11 * one
    head = order == 0
    m00[0, head] = m10[0, head] = pi0 * zero[0, head]
    m01[0, head] = m11[0, head] = pi1 * one[0, head]
    gap = ~real.T
    m00[gap] = m11[gap] = 1.0
    m01[gap] = m10[gap] = 0.0
    w00, w01, w10, w11 = np.ones(nb), np.zeros(nb), np.zeros(nb), np.ones(nb)
    for k in range(STEPS):
        w00, w01 = w00 * m00[k] + w01 * m10[k], w00 * m01[k] + w01 * m11[k]
        w10, w11 = w10 * m00[k] + w11 * m10[k], w10 * m01[k] + w11 * m11[k]
        if k % 4 == 3:
            size = w00 + w01 + w10 + w11
            w00, w01, w10, w11 = w00 / size, w01 / size, w10 / size, w11 / size
    enter, leave = np.zeros((2, nb)), np.ones((2, nb))
    base = np.cumsum(blocks) - blocks
    enter[0, head] = 1.0
    longest = int(blocks.max()) if len(blocks) else 0
    for k in range(1, longest):
        b = base[blocks > k] + k
        c = b - 1
        u, v = enter[0, c] * w00[c] + enter[1, c] * w10[c], enter[0, c] * w01[c] + enter[1, c] * w11[c]
        enter[0, b], enter[1, b] = u / (u + v), v / (u + v)
    for k in range(longest - 1, 0, -1):
        b = base[blocks > k] + k
        u, v = w00[b] * leave[0, b] + w01[b] * leave[1, b], w10[b] * leave[0, b] + w11[b] * leave[1, b]
        leave[0, b - 1], leave[1, b - 1] = u / (u + v), v / (u + v)
    ahead, back = np.empty((2, STEPS, nb)), np.empty((2, STEPS, nb))
    u, v = enter
    for k in range(STEPS):
        u, v = u * m00[k] + v * m10[k], u * m01[k] + v * m11[k]
        size = u + v
        u, v = u / size, v / size
        ahead[0, k], ahead[1, k] = u, v
    u, v = leave
    for k in range(STEPS - 1, -1, -1):
        back[0, k], back[1, k] = u, v
        u, v = m00[k] * u + m01[k] * v, m10[k] * u + m11[k] * v
        size = u + v
        u, v = u / size, v / size
    b0, b1 = ahead[0] * back[0], ahead[1] * back[1]
    one = b1 / (b0 + b1)
    p = one.T[real]
    if not pairs:
        return Chain(p, np.zeros((2, 2)), np.zeros(2))
    before = np.concatenate([enter[:, None], ahead[:, :-1]], axis=1)
    joint = np.stack([before[0] * m00 * back[0], before[0] * m01 * back[1], before[1] * m10 * back[0], before[1] * m11 * back[1]])
    joint /= joint.sum(axis=0)
    inner = real.T.copy()
    inner[0, head] = False
    first_one = one[0, head]
    return Chain(p, joint[:, inner].sum(axis=1).reshape(2, 2), np.array([(1 - first_one).sum(), first_one.sum()]))


@dataclass
class Field:
    """Weights: of each feature for tag 1, of neighbouring tags, of the first tag."""

    weight: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        """Log-odds of each place; ``features`` holds the places of its binary features, -1 for none."""
        padded = np.append(self.weight, 0.0)
        return padded[features].sum(axis=1)

    def tag(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        return forward_backward(self.score(features), first, self.trans, self.start).p


def train(features: np.ndarray, tags: np.ndarray, first: np.ndarray, size: int, rounds: int = 60, ridge: float = 1.0, weights: np.ndarray | None = None) -> Field:
    """Maximum conditional likelihood with a ridge, by Adam on the whole gradient; ``weights`` are of the places."""
    field = Field(np.zeros(size), np.zeros((2, 2)), np.zeros(2))
    w = np.ones(len(tags)) if weights is None else weights
    total = max(1.0, float(w.sum()))
    follows = np.ones(len(tags), bool)
    follows[first[:-1][np.diff(first) > 0]] = False
    seen_pairs = np.zeros((2, 2))
    k = np.flatnonzero(follows)
    np.add.at(seen_pairs, (tags[k - 1], tags[k]), 1)
    heads = first[:-1][np.diff(first) > 0]
    seen_starts = np.bincount(tags[heads], minlength=2).astype(float)
    flat = features.ravel()
    flat = np.where(flat < 0, size, flat)
    params = np.zeros(size + 6)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        field = Field(params[:size], params[size : size + 4].reshape(2, 2), params[size + 4 :])
        chain = forward_backward(field.score(features), first, field.trans, field.start, pairs=True)
        gap = (tags - chain.p) * w
        grad = np.concatenate(
            [
                np.bincount(flat, np.repeat(gap, features.shape[1]), size + 1)[:size],
                (seen_pairs - chain.pairs).ravel(),
                seen_starts - chain.starts,
            ]
        )
        grad = (grad - ridge * params) / total * 1000
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        params = params + 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * (1 - step / (rounds + 10))
    return Field(params[:size].copy(), params[size : size + 4].reshape(2, 2).copy(), params[size + 4 :].copy())


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the last weight is of the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ ((y - p) * weights) - ridge * beta
        hess = (x * (p * (1 - p) * weights)[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return beta


def probability(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
