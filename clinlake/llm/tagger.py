"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Gates are piecewise linear (clipped to 0..1 or -1..1), in training as in use, so that a step is a gather, a small matrix
product and a few vector operations over all windows of a batch. Arrays are (features, windows).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 8
#: Gradient kept outside a clipped gate's linear part, in training only.
_LEAK = 0.05
#: Largest gradient handed from step to step.
_LARGEST = 0.1

# Symbols: the printable ASCII characters, then blanks, other letters, and all else.
_BLANK, _LETTER, _ELSE = 95, 96, 97
N_SYMBOLS = 98


def _symbol(code: int) -> int:
    if 32 <= code < 127:
        return code - 32
    return _BLANK if code in (9, 10, 11, 12, 13, 133, 160) else _LETTER if chr(code).isalpha() else _ELSE


_SYMBOLS = np.array([_symbol(c) for c in range(0x3000)], dtype=np.uint8)


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.where(codes < len(_SYMBOLS), _SYMBOLS[np.minimum(codes, len(_SYMBOLS) - 1)], _LETTER).astype(np.uint8)


@dataclass
class Direction:
    """One LSTM: gates i, f, o, g by symbol (bias included), and from the last hidden state."""

    by_symbol: np.ndarray  # (4 * HIDDEN, N_SYMBOLS)
    by_hidden: np.ndarray  # (4 * HIDDEN, HIDDEN)

    @classmethod
    def new(cls, rng: np.random.Generator) -> Direction:
        by_symbol = rng.normal(0, 0.3, (4 * HIDDEN, N_SYMBOLS))
        by_symbol[: 3 * HIDDEN] += 0.5
        by_symbol[HIDDEN : 2 * HIDDEN] += 0.3  # remember at first
        return cls(by_symbol.astype(np.float32), rng.normal(0, 0.2, (4 * HIDDEN, HIDDEN)).astype(np.float32))

    def run(self, x: np.ndarray) -> np.ndarray:
        """Hidden states (steps, HIDDEN, windows) of symbols (steps, windows), read in the order given."""
        n, width = x.shape
        states = np.empty((n, HIDDEN, width), dtype=np.float32)
        h, c = np.zeros((HIDDEN, width), np.float32), np.zeros((HIDDEN, width), np.float32)
        z, recurrent = np.empty((4 * HIDDEN, width), np.float32), np.empty((4 * HIDDEN, width), np.float32)
        gates, g = z[: 3 * HIDDEN], z[3 * HIDDEN :]
        i, f, o = (gates[k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
        for t in range(n):
            np.take(self.by_symbol, x[t], axis=1, out=z, mode="clip")
            np.matmul(self.by_hidden, h, out=recurrent)
            z += recurrent
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            np.maximum(g, -1, out=g)
            np.minimum(g, 1, out=g)
            c *= f
            i *= g
            c += i
            np.maximum(c, -1, out=c)
            np.minimum(c, 1, out=c)
            h = states[t]
            np.multiply(o, c, out=h)
        return states

    def learn(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """``run``, with what ``gradients`` needs."""
        h, c = np.zeros((HIDDEN, x.shape[1]), np.float32), np.zeros((HIDDEN, x.shape[1]), np.float32)
        states, kept = [], []
        for t in range(len(x)):
            z = self.by_symbol[:, x[t]] + self.by_hidden @ h
            i, f, o = np.split(np.clip(z[: 3 * HIDDEN], 0, 1), 3)
            g = np.clip(z[3 * HIDDEN :], -1, 1)
            before, last = c, h
            cell = f * before + i * g
            c = np.clip(cell, -1, 1)
            h = o * c
            states.append(h)
            kept.append((z, i, f, o, g, before, cell, c, last))
        return np.array(states), kept

    def gradients(self, x: np.ndarray, kept: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = x.shape[1]
        dh, dc = np.zeros((HIDDEN, width), np.float32), np.zeros((HIDDEN, width), np.float32)
        all_dz, d_hidden = np.empty((len(x), 4 * HIDDEN, width), np.float32), np.zeros_like(self.by_hidden)
        for t in range(len(x) - 1, -1, -1):
            z, i, f, o, g, before, cell, c, last = kept[t]
            dh = np.clip(dh + d_states[t], -_LARGEST, _LARGEST)
            dc = np.clip((dc + dh * o) * np.where(np.abs(cell) < 1, 1, _LEAK), -_LARGEST, _LARGEST)
            dz = np.concatenate([dc * g, dc * before, dh * c, dc * i])
            dz[: 3 * HIDDEN] *= np.where((z[: 3 * HIDDEN] > 0) & (z[: 3 * HIDDEN] < 1), 1, _LEAK)
            dz[3 * HIDDEN :] *= np.where(np.abs(z[3 * HIDDEN :]) < 1, 1, _LEAK)
            d_hidden += dz @ last.T
            dh, dc = self.by_hidden.T @ dz, dc * f
            all_dz[t] = dz
        one_hot = np.zeros((x.size, N_SYMBOLS), np.float32)
        one_hot[np.arange(x.size), x.ravel()] = 1
        return all_dz.transpose(1, 0, 2).reshape(4 * HIDDEN, -1) @ one_hot, d_hidden


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Tags 0 (nothing) to n_tags - 1 for every character of a window."""

    def __init__(self, n_tags: int, seed: int):
        rng = np.random.default_rng(seed)
        self.forward, self.backward = Direction.new(rng), Direction.new(rng)
        self.emit = rng.normal(0, 0.3, (n_tags, 2 * HIDDEN)).astype(np.float32)
        self.bias = np.zeros((n_tags, 1), np.float32)
        self.transitions = np.zeros((n_tags, n_tags), np.float32)  # from row to column

    def _parameters(self) -> list[np.ndarray]:
        return [
            self.forward.by_symbol, self.forward.by_hidden, self.backward.by_symbol, self.backward.by_hidden,
            self.emit, self.bias, self.transitions,
        ]

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(steps, tags, windows) of symbols (steps, windows)."""
        x = x.astype(np.intp)
        found = np.matmul(self.emit[:, :HIDDEN], self.forward.run(x))
        found += np.matmul(self.emit[:, HIDDEN:], self.backward.run(x[::-1]))[::-1]
        found += self.bias
        return found

    def quiet(self, emissions: np.ndarray) -> np.ndarray:
        """Windows whose best path is surely tag 0 throughout.

        A stretch of other tags can gain, for each of its characters, at most the emission over tag 0 and the best
        transition among other tags, and what entering and leaving it may gain counts in full for each as well.
        """
        gains = self.transitions - self.transitions[0, 0]
        most = sum(max(0.0, float(g.max())) for g in (gains[1:, 1:], gains[0, 1:], gains[1:, 0]))
        return (emissions[:, 1:].max(axis=1) - emissions[:, 0] + most < 0).all(axis=0)

    def decode(self, emissions: np.ndarray) -> np.ndarray:
        """The best tags (steps, windows)."""
        n, _, width = emissions.shape
        score, back = emissions[0], np.empty((n, *emissions.shape[1:]), np.int8)
        for t in range(1, n):
            reached = score[:, None, :] + self.transitions[:, :, None]
            back[t] = reached.argmax(axis=0)
            score = reached.max(axis=0) + emissions[t]
        tags = np.empty((n, width), np.int8)
        tags[-1] = score.argmax(axis=0)
        for t in range(n - 1, 0, -1):
            tags[t - 1] = back[t][tags[t], np.arange(width)]
        return tags

    def _loss_gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The mean loss of the CRF a character, and its gradients, by forward and backward sums."""
        x = x.astype(np.intp)
        n, width = x.shape
        forward, kept_forward = self.forward.learn(x)
        backward, kept_backward = self.backward.learn(x[::-1])
        states = np.concatenate([forward, backward[::-1]], axis=1)
        e = np.matmul(self.emit, states) + self.bias
        move = self.transitions[:, :, None]
        alpha, beta = [e[0]], [np.zeros_like(e[0])]
        for t in range(1, n):
            alpha.append(_log_sum(alpha[-1][:, None] + move, 0) + e[t])
        for t in range(n - 1, 0, -1):
            beta.append(_log_sum(move + (e[t] + beta[-1])[None], 1))
        alpha, beta = np.array(alpha), np.array(beta[::-1])
        total = _log_sum(alpha[-1], 0)
        d_e = np.exp(alpha + beta - total)
        pairs = np.exp(alpha[:-1, :, None] + move + (e[1:] + beta[1:])[:, None] - total)
        d_move = pairs.sum(axis=(0, 3))
        steps, windows = np.indices(tags.shape)
        d_e[steps, tags, windows] -= 1
        np.subtract.at(d_move, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        gold = e[steps, tags, windows].sum() + self.transitions[tags[:-1], tags[1:]].sum()
        d_e /= n * width
        d_states = np.matmul(self.emit.T, d_e)
        grads = [
            *self.forward.gradients(x, kept_forward, d_states[:, :HIDDEN]),
            *self.backward.gradients(x[::-1], kept_backward, d_states[::-1, HIDDEN:]),
            np.einsum("tkb,thb->kh", d_e, states), d_e.sum(axis=(0, 2))[:, None], d_move / (n * width),
        ]
        return float(total.sum() - gold) / (n * width), grads

    def train(self, batches) -> list[float]:
        """One Adam step for each (symbols, tags) batch, both (steps, windows); the losses."""
        losses, first, second = [], [np.zeros_like(p) for p in self._parameters()], [np.zeros_like(p) for p in self._parameters()]
        for step, (x, tags) in enumerate(batches, 1):
            loss, grads = self._loss_gradients(x, tags)
            losses.append(loss)
            scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads)))))
            rate = 0.03 / (1 + step / 200)
            for p, g, m, v in zip(self._parameters(), grads, first, second, strict=True):
                g = g * scale
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return losses
