"""Scaled forward-backward over many sequences at once.

Sequences lie one after another in ``ids``; a step's potential for each state is ``table[id]``. Sequences go forward side
by side, the longest first, so that those that still run are always the first rows. Long sequences are cut into blocks whose
transfer matrices are computed side by side, so that the number of numpy calls depends on the block length and not on the
longest sequence; the messages that enter each block are then chained exactly. The block length is the one that costs least
for the lengths at hand, since a matrix takes the work of as many sequences as there are states.

Messages are divided by their sums every few steps only (``Chain.rescale``). Backward messages are divided by the same numbers and
start so that a block's last forward and backward messages have the product 1; the product then stays 1 at every step, and
state probabilities and transitions need no sums of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

from atomframe.llm.common import ranges

#: The least block length.
BLOCK = 256
#: Steps between two rescalings, at most, and the powers of ten by which messages may shrink or grow between them.
RESCALE, POWERS = 8, 250
#: The ids that could be worked on in the time that the numpy calls of a step take, about.
STEP = 256
#: Rows whose emissions are counted at a time.
SOME_ROWS = 1 << 16


@dataclass
class Chain:
    start: np.ndarray  # initial potentials (K)
    move: np.ndarray  # transition potentials (K, K)
    table: np.ndarray  # emission potentials (ids, K)

    @cached_property
    def rescale(self) -> int:
        """Steps between two rescalings: so few that messages stay within a double's range."""
        step = sum(np.abs(np.log10(x[x > 0])).max(initial=0) for x in (self.table.max(axis=1, initial=0), self.move)) + np.log10(len(self.start) + 1)
        return max(1, min(RESCALE, int(POWERS / step)))


def _block_length(lengths: np.ndarray, k: int) -> int:
    """BLOCK, doubled as often as makes the work least."""
    longest, costs = int(lengths.max(initial=0)), {}
    block = BLOCK
    while not costs or block < 2 * longest:
        inner = int((np.maximum(-(-lengths // block) - 1, 0) * block).sum())
        costs[block] = min(block, longest) * STEP + (inner * k + block * STEP if inner else 0)
        block *= 2
    return min(costs, key=costs.__getitem__)


def _blocks(lengths: np.ndarray, block: int):
    counts = -(-lengths // block)
    of = np.repeat(np.arange(len(lengths)), counts)
    number = ranges(np.zeros(len(counts), np.int64), counts)
    begin = (np.cumsum(lengths) - lengths)[of] + number * block
    size = np.minimum(block, lengths[of] - number * block)
    return of, number, begin, size, counts


def _transfers(c: Chain, ids: np.ndarray, begin: np.ndarray, first: np.ndarray, block: int):
    """The matrix that takes the message before each full block to the one at its end, and the log of its scale."""
    k, n = len(c.start), len(begin)
    e = c.table[ids[begin]]
    m = c.move[None] * e[:, None, :]
    m[first] = (c.start * e[first])[:, None, :]
    log = np.zeros(n)
    for t in range(1, block):
        m = (m.reshape(-1, k) @ c.move).reshape(n, k, k)
        m *= c.table[ids[begin + t]][:, None, :]
        if t % c.rescale == 0 or t == block - 1:
            s = m.max(axis=(1, 2))
            m /= s[:, None, None]
            log += np.log(s)
    return m, log


@dataclass
class _Blocks:
    """Blocks of sequences: the sequence, the number in it, the first id and the size of each, and the message that enters."""

    of: np.ndarray
    number: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    entering: np.ndarray
    log: np.ndarray  # for each sequence the log scale up to its last block
    groups: list[np.ndarray]  # full blocks by their numbers
    transfers: np.ndarray  # the matrices of the blocks of ``groups``, one group after another

    @property
    def last(self) -> np.ndarray:
        """Each sequence's last block."""
        return np.flatnonzero(np.append(self.of[1:] != self.of[:-1], True)) if len(self.of) else np.zeros(0, np.int64)


def _entering(c: Chain, ids: np.ndarray, lengths: np.ndarray) -> _Blocks:
    k = len(c.start)
    block = _block_length(lengths, k)
    of, number, begin, size, counts = _blocks(lengths, block)
    v = np.full((len(of), k), 1.0 / k)
    log = np.zeros(len(lengths))
    full = np.flatnonzero(number < counts[of] - 1)
    full = full[np.argsort(number[full], kind="stable")]
    groups, m = [], np.zeros((0, k, k))
    if len(full):
        m, scale = _transfers(c, ids, begin[full], number[full] == 0, block)
        groups, at = np.split(full, np.flatnonzero(np.diff(number[full])) + 1), 0
        for b in groups:
            w = np.einsum("nk,nkj->nj", v[b], m[at : at + len(b)])
            s = w.sum(axis=1)
            v[b + 1] = w / s[:, None]
            log[of[b]] += scale[at : at + len(b)] + np.log(s)
            at += len(b)
    return _Blocks(of, number, begin, size, v, log, groups, m)


class _Steps:
    """The steps of blocks, one step's rows after another's; the rows of a step are the blocks that have it, longest first."""

    def __init__(self, c: Chain, ids: np.ndarray, begin: np.ndarray, size: np.ndarray):
        self.chain = c
        self.order = np.argsort(-size, kind="stable")
        falling = size[self.order]
        self.live = np.searchsorted(-falling, -np.arange(int(falling[0]) if len(size) else 0), side="left")
        self.off = np.cumsum(self.live) - self.live
        #: The place of each row in ``ids``, and its id.
        self.place = begin[self.order][ranges(np.zeros_like(self.live), self.live)] + np.repeat(np.arange(len(self.live)), self.live)
        self.ids = ids[self.place]

    def rows(self, t: int) -> slice:
        return slice(self.off[t], self.off[t] + self.live[t])

    def potentials(self, t: int, out: np.ndarray) -> np.ndarray:
        return np.take(self.chain.table, self.ids[self.rows(t)], axis=0, out=out[: self.live[t]], mode="clip")

    def forward(self, entering: np.ndarray, first: np.ndarray, keep: np.ndarray | None = None):
        """The last message of each block, the log of its scale, and the divisors by step; ``keep`` gets all messages."""
        c, a = self.chain, entering[self.order]
        moved, e, ones = np.empty_like(a), np.empty_like(a), np.ones(a.shape[1])
        log, divisors = np.zeros(len(a)), {}
        for t, j in enumerate(self.live.tolist()):
            m = np.matmul(a[:j], c.move, out=moved[:j])
            if not t:
                m[first[self.order][:j]] = c.start
            now = np.multiply(m, self.potentials(t, e), out=a[:j])
            if t % c.rescale == c.rescale - 1:
                divisors[t] = s = now @ ones
                now /= s[:, None]
                log[:j] += np.log(s)
            if keep is not None:
                keep[self.rows(t)] = now
        return a, log, divisors


def log_likelihood(c: Chain, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The natural log of each sequence's total potential; 0 for an empty sequence."""
    x = _entering(c, ids, lengths)
    last = x.last
    steps = _Steps(c, ids, x.begin[last], x.size[last])
    a, log, _ = steps.forward(x.entering[last], x.number[last] == 0)
    x.log[x.of[last[steps.order]]] += log + np.log(a.sum(axis=1))
    return x.log


def _posteriors(c: Chain, ids: np.ndarray, lengths: np.ndarray, moves: bool):
    """The steps, each row's state probabilities, the expected transitions, and the log likelihoods."""
    k = len(c.start)
    x = _entering(c, ids, lengths)
    first = x.number == 0
    steps = _Steps(c, ids, x.begin, x.size)
    gamma = np.empty((len(steps.ids), k))
    a, log, divisors = steps.forward(x.entering, first, gamma)
    # messages that come back into each block from the right: last blocks get ones, the others are chained
    last = x.last
    leaving = np.ones((len(x.of), k))
    if x.groups:
        back, tails = np.empty((len(x.of), k)), last[x.number[last] > 0]
        back[tails] = _backward(c, ids, x.begin[tails], x.size[tails])
        at = len(x.transfers)
        for b in reversed(x.groups):
            leaving[b] = back[b + 1]
            w = np.einsum("nij,nj->ni", x.transfers[at - len(b) : at], leaving[b])
            back[b] = w / w.sum(axis=1, keepdims=True)
            at -= len(b)
    beta = leaving[steps.order]
    beta /= (a * beta).sum(axis=1, keepdims=True)
    xi, e, back_move = np.zeros((k, k)), np.empty_like(a), np.ascontiguousarray(c.move.T)
    for t in range(len(steps.live) - 1, -1, -1):
        j = steps.live[t]
        eb = steps.potentials(t, e)
        eb *= beta[:j]
        if t in divisors:
            eb /= divisors[t][:, None]
        if moves and t:
            before = steps.off[t - 1]
            xi += gamma[before : before + j].T @ eb
        elif moves:
            inner = ~first[steps.order][:j]
            xi += x.entering[steps.order][:j][inner].T @ eb[inner]
        gamma[steps.rows(t)] *= beta[:j]
        np.matmul(eb, back_move, out=beta[:j])
    sel = np.isin(steps.order, last)
    x.log[x.of[steps.order[sel]]] += (log + np.log(a.sum(axis=1)))[sel]
    return steps, first, gamma, xi * c.move, x.log


def posteriors(c: Chain, ids: np.ndarray, lengths: np.ndarray, moves: bool = False):
    """Each step's state probabilities, the expected transitions (or None) and the log likelihoods."""
    steps, _, rows, xi, log = _posteriors(c, ids, lengths, moves)
    gamma = np.empty_like(rows)
    gamma[steps.place] = rows
    return gamma, xi if moves else None, log


def expected(c: Chain, ids: np.ndarray, lengths: np.ndarray):
    """The expected emissions (ids, K), transitions (K, K) and first states (K)."""
    steps, first, gamma, xi, _ = _posteriors(c, ids, lengths, True)
    emit = np.zeros_like(c.table)
    for at in range(0, len(gamma), SOME_ROWS):
        some, these = np.ascontiguousarray(gamma[at : at + SOME_ROWS].T), steps.ids[at : at + SOME_ROWS]
        for k, weights in enumerate(some):
            emit[:, k] += np.bincount(these, weights=weights, minlength=len(emit))
    starts = gamma[: len(steps.order)][first[steps.order]].sum(axis=0) if len(gamma) else np.zeros(len(c.start))
    return emit, xi, starts


def _backward(c: Chain, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The normalised message that leaves each block to the left, with nothing on its right."""
    steps = _Steps(c, ids, begin, size)
    beta, e, back_move = np.ones((len(begin), len(c.start))), np.empty((len(begin), len(c.start))), np.ascontiguousarray(c.move.T)
    for t in range(len(steps.live) - 1, -1, -1):
        j = steps.live[t]
        eb = steps.potentials(t, e)
        eb *= beta[:j]
        new = np.matmul(eb, back_move, out=beta[:j])
        if t % c.rescale == 0:
            new /= new.sum(axis=1, keepdims=True)
    out = np.empty_like(beta)
    out[steps.order] = beta
    return out
