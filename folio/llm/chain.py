"""Exact forward-backward over many sequences at once.

All sequences lie end to end in one array of positions. The step into position t is the matrix
``A * e_t``, or, at a sequence's first position, the start vector in every row: that forgets the
sequence before. Matrix products are associative, so the positions are cut into equal blocks whose
products are built side by side; a short pass over the blocks then gives the state at each block's
edges, and the recursions run through all blocks side by side again. Work per position is constant
and each numpy call handles one position of every block.
"""

from __future__ import annotations

import numpy as np

from folio.llm.common import ship


def _blocks(n: int) -> tuple[int, int]:
    """Blocks and block length: many blocks keep the numpy calls few, up to a point."""
    length = max(1, int(np.sqrt(n / 3)))
    return -(-n // length), length


class Chain:
    """A linear chain with transitions ``A`` (from, to) and start weights ``pi``.

    ``run(E, starts)`` takes non-negative weights ``E`` (position, state), at least one of each
    position above zero, and marks of the first positions of sequences (the first is one).
    """

    def __init__(self, A: np.ndarray, pi: np.ndarray):
        self.A, self.pi = np.asarray(A, float), np.asarray(pi, float)

    def run(self, E: np.ndarray, starts: np.ndarray, backward: bool = True):
        """Per position the state's chances given its sequence so far (``alpha``), the log weight
        that the position adds to its sequence (``log``), and, if ``backward``, the chances given the
        whole sequence (``gamma``) and the expected transition counts over all sequences."""
        n, k = E.shape
        if n == 0:
            return np.empty((0, k)), np.empty(0), np.empty((0, k)), np.zeros((k, k))
        m, length = _blocks(n)
        pad = m * length - n
        # State first, then blocks side by side: (step, state, block). The largest weight of a position is taken across
        # whole rows of blocks; within the few states of one position numpy is slow.
        e = np.array((np.concatenate([E, np.ones((pad, k))]) if pad else E).reshape(m, length, k).transpose(1, 2, 0), float, order="C")
        top = e.max(axis=1)
        e /= top[:, None]
        first = np.ascontiguousarray(np.concatenate([starts, np.ones(pad, bool)]).reshape(m, length).T)
        resets = first.any(axis=1)
        A, pi = self.A, self.pi

        product, step = np.zeros((k, k, m)), np.empty((k, k, m))  # to, from, block: one matrix product a position
        product[np.arange(k), np.arange(k)] = 1
        for s in range(length):
            np.matmul(A.T, product.reshape(k, -1), out=step.reshape(k, -1))
            if resets[s]:
                at = np.flatnonzero(first[s])
                step[:, :, at] = product[:, :, at].sum(axis=0) * pi[:, None, None]
            product, step = step, product
            product *= e[s][:, None]
            if s % 8 == 7 or s == length - 1:
                product /= product.max(axis=(0, 1))
        product = np.ascontiguousarray(product.transpose(2, 1, 0))

        into = np.empty((k, m))
        v = pi
        for b in range(m):
            into[:, b] = v
            v = v @ product[b]
            v = v / v.sum()
        alpha, scale = np.empty((length, k, m)), np.empty((length, m))
        now = into
        for s in range(length):
            now = np.matmul(A.T, now, out=alpha[s])
            if resets[s]:
                now[:, first[s]] = pi[:, None]
            now *= e[s]
            now.sum(axis=0, out=scale[s])
            now /= scale[s]
        flat = lambda x: x.transpose(2, 0, 1).reshape(-1, k)[:n]
        log = (np.log(scale) + np.log(top)).T.reshape(-1)[:n]
        if not backward:
            return flat(alpha), log, None, None

        # beta: weight of what follows a position, per state there; 'after' holds it for a block's last position.
        after = np.empty((k, m))
        v = np.ones(k)
        for b in range(m - 1, -1, -1):
            after[:, b] = v
            v = product[b] @ v
            v = v / v.max()
        gamma = np.empty((length, k, m))
        # counts[i, j] sums alpha_{t-1}[i] A[i, j] e_t[j] beta_t[j] / weight over positions t that start no sequence
        counts = np.zeros((k, k))
        beta = after
        for s in range(length - 1, -1, -1):
            g = np.multiply(alpha[s], beta, out=gamma[s])
            g /= g.sum(axis=0)
            ahead = e[s] * beta
            before = alpha[s - 1] if s else np.concatenate([pi[:, None], alpha[-1][:, :-1]], axis=1)
            back = A @ ahead
            weight = (before * back).sum(axis=0)
            ahead /= weight
            if resets[s]:
                ahead[:, first[s]] = 0
                back[:, first[s]] = 1
            counts += before @ ahead.T
            beta = back / back.max(axis=0)
        return flat(alpha), log, flat(gamma), A * counts


ship(__name__)
