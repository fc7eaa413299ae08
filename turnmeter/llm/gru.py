"""A gated recurrent network over word classes, in numpy.

The network reads one class per step and gives a softmax over the class of the
next token. It is trained by back-propagation truncated to windows of ``WINDOW``
steps; between windows the state is carried on, in training as in scoring, so a
document is read whole. Many documents run side by side in slots; a slot takes
the next document when its own ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

WINDOW = 32
BLOCK = 2048  # rows of class probabilities held at once: larger arrays leave the cache and are mapped anew each time
END = 0  # the class of the end token, and what is read before the first token


class Params(NamedTuple):
    read: np.ndarray     # classes x 3H: what each class adds to the gates
    carry: np.ndarray    # H x 3H: what the state adds to the gates
    out: np.ndarray      # H x classes
    bias: np.ndarray     # classes

    def to_bytes(self) -> bytes:
        return b"".join(p.astype("<f4").tobytes() for p in self)

    @classmethod
    def from_bytes(cls, raw: bytes, classes: int, hidden: int) -> Params:
        flat, out = np.frombuffer(raw, "<f4"), []
        for shape in ((classes, 3 * hidden), (hidden, 3 * hidden), (hidden, classes), (classes,)):
            n = int(np.prod(shape))
            out.append(flat[:n].reshape(shape).copy())
            flat = flat[n:]
        return cls(*out)


def initial(class_counts: np.ndarray, hidden: int, seed: int = 1) -> Params:
    """Starts as the unigram model of the classes."""
    rng, n = np.random.default_rng(seed), len(class_counts)
    share = (class_counts + 1.0) / (class_counts.sum() + n)
    small = [rng.normal(0, s, shape).astype(np.float32) for s, shape in
             ((0.1, (n, 3 * hidden)), (1 / np.sqrt(hidden), (hidden, 3 * hidden)), (0.02, (hidden, n)))]
    return Params(*small, np.log(share).astype(np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _step(p: Params, x: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
    """The next state; ``keep`` collects what back-propagation needs."""
    n = h.shape[1]
    given, own = p.read[x], h @ p.carry
    given[:, :2 * n] += own[:, :2 * n]
    gates = _sigmoid(given[:, :2 * n])
    z, r = gates[:, :n], gates[:, n:]
    new = r * own[:, 2 * n:]
    new += given[:, 2 * n:]
    np.tanh(new, out=new)
    if keep is not None:
        keep.append((x, h, z, r, own[:, 2 * n:], new))
    out = h - new
    out *= z
    out += new
    return out


def _log_softmax_at(p: Params, states: np.ndarray, targets: np.ndarray, probs: bool = False):
    """Natural-log probability of each target; with ``probs`` all probabilities too."""
    logits = states @ p.out
    logits += p.bias
    if np.abs(p.out).sum(0).max() + np.abs(p.bias).max() > 60:  # states are at most 1, so else exp() is safe
        logits -= logits.max(1, keepdims=True)
    at = logits[np.arange(len(targets)), targets]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    found = at - np.log(total)
    if not probs:
        return found
    logits *= (1 / total)[:, None]
    return found, logits


class Slots:
    """Documents side by side, in windows. Iterates over (inputs, targets, mask, state rows to clear).

    ``live`` are the tags of the documents of the present window, ``ended`` the
    slots whose document ends with it.
    """

    def __init__(self, documents: Iterable[tuple[object, np.ndarray]], width: int):
        self._next, self._width = iter(documents), width
        self._slots: list[list] = []  # [tag, codes, position]
        self.live: list[object] = []
        self.ended: list[int] = []

    def _take(self) -> list | None:
        for tag, codes in self._next:
            return [tag, codes, 0]
        return None

    def windows(self):
        while True:
            keep = [i for i, s in enumerate(self._slots) if s is not None]
            fresh = []
            for i, s in enumerate(self._slots):
                if s is None and (new := self._take()) is not None:
                    self._slots[i] = new
                    fresh.append(i)
            while len(self._slots) < self._width and (new := self._take()) is not None:
                self._slots.append(new)
            order = [i for i, s in enumerate(self._slots) if s is not None]
            if not order:
                return
            known = set(keep)
            rows = [i if i in known else -1 for i in order]  # which state row each slot goes on from
            self._slots = [self._slots[i] for i in order]
            b = len(order)
            inputs = np.full((b, WINDOW), END, np.int64)
            targets = np.full((b, WINDOW), END, np.int64)
            mask = np.zeros((b, WINDOW), bool)
            self.live, self.ended = [s[0] for s in self._slots], []
            for i, s in enumerate(self._slots):
                _, codes, at = s
                part = codes[at:at + WINDOW]
                n = len(part)
                targets[i, :n] = part
                inputs[i, 1:n] = part[:-1]
                inputs[i, 0] = codes[at - 1] if at else END
                mask[i, :n] = True
                s[2] = at + n
                if s[2] >= len(codes):
                    self.ended.append(i)
            yield inputs, targets, mask, np.array(rows)
            for i in self.ended:
                self._slots[i] = None


def _resume(h: np.ndarray | None, rows: np.ndarray, hidden: int) -> np.ndarray:
    """States of the window's slots: carried on, or zero for a new document."""
    out = np.zeros((len(rows), hidden), np.float32)
    on = rows >= 0
    if h is not None:
        out[on] = h[rows[on]]
    return out


def score(p: Params, documents: Iterable[tuple[object, np.ndarray]], width: int = 512) -> Iterator[tuple[object, float]]:
    """(tag, sum of natural-log class probabilities) of each document, as they end."""
    hidden, slots, h, sums = p.carry.shape[0], Slots(documents, width), None, np.zeros(0)
    for inputs, targets, mask, rows in slots.windows():
        h = _resume(h, rows, hidden)
        sums = np.where(rows >= 0, sums[np.maximum(rows, 0)] if len(sums) else 0.0, 0.0)
        states = np.empty((WINDOW, len(rows), hidden), np.float32)
        steps = int(mask.any(0).sum())
        for t in range(steps):
            h = states[t] = _step(p, inputs[:, t], h)
        found, size = np.zeros((steps, len(rows))), max(1, BLOCK // len(rows))
        for t in range(0, steps, size):
            at = mask[:, t:min(t + size, steps)].T
            own, aim = states[t:t + len(at)], targets[:, t:t + len(at)].T
            own, aim = (own.reshape(-1, hidden), aim.reshape(-1)) if at.all() else (own[at], aim[at])
            found[t:t + size][at] = _log_softmax_at(p, own, aim)
        sums = sums + found.sum(0)
        for i in slots.ended:
            yield slots.live[i], float(sums[i])


def _gradients(p: Params, inputs, targets, mask, h):
    """(gradients of the mean loss, last state) of one window."""
    b, hidden = h.shape
    kept: list = []
    states = np.empty((WINDOW, b, hidden), np.float32)
    for t in range(WINDOW):
        h = states[t] = _step(p, inputs[:, t], h, kept)
    g_read, g_carry, g_out, g_bias = (np.zeros_like(x) for x in p)
    share = (mask.T / max(mask.sum(), 1)).astype(np.float32)
    size, back, carried = max(1, BLOCK // b), np.ascontiguousarray(p.out.T), np.ascontiguousarray(p.carry.T)
    dh, d_own = np.zeros_like(h), np.empty((b, 3 * hidden), np.float32)
    for begin in reversed(range(0, WINDOW, size)):
        end = min(begin + size, WINDOW)
        flat, aim = states[begin:end].reshape(-1, hidden), targets[:, begin:end].T.reshape(-1)
        _, d = _log_softmax_at(p, flat, aim, probs=True)
        d[np.arange(len(aim)), aim] -= 1
        d *= share[begin:end].reshape(-1, 1)
        g_out += flat.T @ d
        g_bias += np.ones(len(d), np.float32) @ d
        d_states = (d @ back).reshape(end - begin, b, hidden)
        d_given = np.empty((end - begin, b, 3 * hidden), np.float32)
        for t in reversed(range(begin, end)):
            x, before, z, r, own_n, new = kept[t]
            dh += d_states[t - begin]
            rest = 1 - z
            dn = dh * rest
            dn *= 1 - new * new
            rest *= z
            rest *= before - new
            d_own[:, :hidden] = dh * rest
            d_own[:, 2 * hidden:] = by_own = dn * r
            by_own *= own_n
            by_own *= 1 - r
            d_own[:, hidden:2 * hidden] = by_own
            d_given[t - begin] = d_own
            d_given[t - begin, :, 2 * hidden:] = dn
            g_carry += before.T @ d_own
            dh *= z
            dh += d_own @ carried
        # sums by the class that was read
        x = inputs[:, begin:end].T.reshape(-1).astype(np.int16)
        order = np.argsort(x, kind="stable")
        x = x[order]
        first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        g_read[x[first]] += np.add.reduceat(d_given.reshape(-1, 3 * hidden)[order], first, axis=0)
    return Params(g_read, g_carry, g_out, g_bias), h


def train(p: Params, documents: list[np.ndarray], epochs: int = 2, width: int = 64, rate: float = 0.01) -> Params:
    """Adam over truncated windows; the step size falls linearly to a tenth."""
    steps = max(1, epochs * sum(-(-len(d) // WINDOW) for d in documents) // width)
    m, v, k = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(len(documents))
        h = None
        for inputs, targets, mask, rows in Slots(((None, documents[i]) for i in order), width).windows():
            h = _resume(h, rows, p.carry.shape[0])
            grads, h = _gradients(p, inputs, targets, mask, h)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            k += 1
            lr = rate * max(0.1, 1 - 0.9 * k / steps)
            for i, g in enumerate(grads):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.01 * (g * g - v[i])
                p[i][...] -= lr * (m[i] / (1 - 0.9 ** k)) / (np.sqrt(v[i] / (1 - 0.99 ** k)) + 1e-8)
    return p
