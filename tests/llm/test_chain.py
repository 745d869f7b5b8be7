import numpy as np
import pytest

from atomframe.llm import chain as H


def plain(c, ids):
    alphas, log, a = [], 0.0, None
    for i, x in enumerate(ids):
        a = (c.start if i == 0 else a @ c.move) * c.table[x]
        log += np.log(a.sum())
        a = a / a.sum()
        alphas.append(a)
    b, gammas, xi = np.ones(len(c.start)), [], np.zeros_like(c.move)
    for i in range(len(ids) - 1, -1, -1):
        g = alphas[i] * b
        gammas.append(g / g.sum())
        if i:
            x = alphas[i - 1][:, None] * c.move * (c.table[ids[i]] * b)[None]
            xi += x / x.sum()
        b = c.move @ (c.table[ids[i]] * b)
        b = b / b.sum()
    return log, np.array(gammas[::-1]).reshape(-1, len(c.start)), xi


@pytest.mark.parametrize("lengths", [[0, 1, 5], [300, 0, 256, 257, 2000, 1, 512, 513], []])
def test_blocks_equal_plain_recursion(lengths):
    rng = np.random.default_rng(3)
    c = H.Chain(rng.random(3), rng.random((3, 3)), rng.random((20, 3)) * 1e-3)
    ids = rng.integers(0, 20, sum(lengths))
    log = H.log_likelihood(c, ids, np.array(lengths, dtype=np.int64))
    gamma, xi, again = H.posteriors(c, ids, np.array(lengths, dtype=np.int64), moves=True)
    at, total = 0, np.zeros((3, 3))
    for k, n in enumerate(lengths):
        want, g, x = plain(c, ids[at : at + n])
        assert log[k] == pytest.approx(want) and again[k] == pytest.approx(want)
        assert np.allclose(gamma[at : at + n], g)
        total += x
        at += n
    assert np.allclose(xi, total)


def check(c, ids, lengths):
    log = H.log_likelihood(c, ids, np.array(lengths, dtype=np.int64))
    gamma, xi, again = H.posteriors(c, ids, np.array(lengths, dtype=np.int64), moves=True)
    emit, moves, starts = H.expected(c, ids, np.array(lengths, dtype=np.int64))
    at, total, first = 0, np.zeros_like(c.move), np.zeros(len(c.start))
    for k, n in enumerate(lengths):
        want, g, x = plain(c, ids[at : at + n])
        assert log[k] == pytest.approx(want) and again[k] == pytest.approx(want)
        assert np.allclose(gamma[at : at + n], g)
        total, at = total + x, at + n
        first += g[0] if n else 0
    by_id = np.stack([np.bincount(ids, weights=gamma[:, k], minlength=len(c.table)) for k in range(len(c.start))], axis=1)
    assert np.allclose(emit, by_id) and np.allclose(xi, total) and np.allclose(moves, total) and np.allclose(starts, first)


@pytest.mark.parametrize("block", [1, 2, 7, 256, 4096])
def test_any_block_length_gives_the_same(block, monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(H, "_block_length", lambda lengths, k: block)
    c = H.Chain(rng.random(3), rng.random((3, 3)), rng.random((20, 3)) * 1e-3)
    lengths = [30, 0, 1, 14, 15, 7, 600]
    check(c, rng.integers(0, 20, sum(lengths)), lengths)


@pytest.mark.parametrize("scale", [1e-90, 1e-40, 1e40])
def test_potentials_far_from_one(scale):
    """Products of eight such potentials leave the range of doubles."""
    rng = np.random.default_rng(5)
    c = H.Chain(rng.random(3), rng.random((3, 3)), (0.1 + rng.random((20, 3))) * scale)
    lengths = [700, 0, 9, 257]
    check(c, rng.integers(0, 20, sum(lengths)), lengths)


def test_usual_lengths_need_no_transfer_matrices(monkeypatch):
    """Matrices take K times the work of a message: only where few long texts would keep all steps waiting."""
    seen = []
    transfers = H._transfers
    monkeypatch.setattr(H, "_transfers", lambda c, ids, begin, *rest: (seen.append(len(begin)), transfers(c, ids, begin, *rest))[1])
    rng = np.random.default_rng(6)
    c = H.Chain(rng.random(3), rng.random((3, 3)), rng.random((20, 3)))
    usual = rng.integers(200, 700, 500)
    H.log_likelihood(c, rng.integers(0, 20, usual.sum()), usual)
    assert not seen
    H.log_likelihood(c, rng.integers(0, 20, 100_000), np.array([100_000]))
    assert seen
