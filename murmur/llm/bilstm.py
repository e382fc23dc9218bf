"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EMBED, HIDDEN = 10, 16


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _lstm(x: np.ndarray, w_in: np.ndarray, w_state: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Hidden states (steps, 2, batch, HIDDEN) of inputs (steps, 2, batch, EMBED): two
    independent directions side by side."""
    steps, _, batch, _ = x.shape
    inputs = np.matmul(x, w_in) + bias[:, None, :]
    gates = np.empty_like(inputs)
    cells = np.zeros((steps + 1, 2, batch, HIDDEN), np.float32)
    states = np.zeros_like(cells)
    bent = np.empty((steps, 2, batch, HIDDEN), np.float32)
    for t in range(steps):
        a = inputs[t] + np.matmul(states[t], w_state)
        gates[t, :, :, : 3 * HIDDEN] = _sigmoid(a[:, :, : 3 * HIDDEN])
        gates[t, :, :, 3 * HIDDEN :] = np.tanh(a[:, :, 3 * HIDDEN :])
        i, f, o, g = (gates[t, :, :, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        cells[t + 1] = f * cells[t] + i * g
        bent[t] = np.tanh(cells[t + 1])
        states[t + 1] = o * bent[t]
    return states[1:], (x, gates, cells, states, bent)


def _lstm_back(d_out: np.ndarray, kept: tuple, w_in: np.ndarray, w_state: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gradients of the inputs, both weights and the bias."""
    x, gates, cells, states, bent = kept
    d_gates = np.empty_like(gates)
    back = w_state.transpose(0, 2, 1)
    dh = dc = np.zeros(d_out.shape[1:], np.float32)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g = (gates[t, :, :, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - bent[t] ** 2)
        da = d_gates[t]
        da[:, :, :HIDDEN] = dc * g * i * (1 - i)
        da[:, :, HIDDEN : 2 * HIDDEN] = dc * cells[t] * f * (1 - f)
        da[:, :, 2 * HIDDEN : 3 * HIDDEN] = dh * bent[t] * o * (1 - o)
        da[:, :, 3 * HIDDEN :] = dc * i * (1 - g**2)
        dh, dc = np.matmul(da, back), dc * f
    dx = np.matmul(d_gates, w_in.transpose(0, 2, 1))

    def product(left: np.ndarray) -> np.ndarray:
        flat = left.transpose(1, 3, 0, 2).reshape(2, left.shape[3], -1)
        return np.matmul(flat, d_gates.transpose(1, 0, 2, 3).reshape(2, -1, d_gates.shape[3]))

    return dx, product(x), product(states[:-1]), d_gates.sum((0, 2))


@dataclass
class Tagger:
    """Weights; ``tags`` of the CRF, where 0 is outside."""

    embed: np.ndarray
    w_in: np.ndarray  # both directions: forward, backward
    w_state: np.ndarray
    gate_bias: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    move: np.ndarray
    allowed: np.ndarray  # added to ``move``: 0, or very low where a tag can't follow

    @classmethod
    def fresh(cls, signs: int, allowed: np.ndarray, seed: int = 0) -> Tagger:
        rng = np.random.default_rng(seed)
        tags = len(allowed)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        gate_bias = np.zeros((2, 4 * HIDDEN), np.float32)
        gate_bias[:, HIDDEN : 2 * HIDDEN] = 1
        both = lambda n: np.stack([normal(n, 4 * HIDDEN), normal(n, 4 * HIDDEN)])
        return cls(
            normal(signs, EMBED) * 3, both(EMBED), both(HIDDEN), gate_bias, normal(2 * HIDDEN, tags),
            np.zeros(tags, np.float32), np.zeros((tags, tags), np.float32), allowed.astype(np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.w_in, self.w_state, self.gate_bias, self.out, self.bias, self.move]

    def emissions(self, signs: np.ndarray, keep: bool = False):
        """(steps, batch, tags) from (batch, steps) sign numbers."""
        x = self.embed[signs.T]
        states, kept = _lstm(np.stack([x, x[::-1]], 1), self.w_in, self.w_state, self.gate_bias)
        both = np.concatenate([states[:, 0], states[::-1, 1]], 2)
        scores = both @ self.out + self.bias
        return (scores, both, kept) if keep else scores

    def _sums(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log sums of paths up to each step, from each step on, and in all."""
        move = self.move + self.allowed
        steps = len(scores)
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0] + self.allowed[0]
        for t in range(1, steps):
            alpha[t] = scores[t] + _lse(alpha[t - 1][:, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _lse(move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        return alpha, beta, _lse(alpha[-1], 1)

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        alpha, beta, total = self._sums(scores)
        return np.exp(alpha + beta - total[None, :, None])

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tags (batch, steps)."""
        move = self.move + self.allowed
        steps, batch, _ = scores.shape
        best, came = scores[0] + self.allowed[0], []
        for t in range(1, steps):
            ways = best[:, :, None] + move
            came.append(ways.argmax(1))
            best = scores[t] + ways.max(1)
        tags = np.empty((steps, batch), np.int64)
        tags[-1] = best.argmax(1)
        rows = np.arange(batch)
        for t in range(steps - 2, -1, -1):
            tags[t] = came[t][rows, tags[t + 1]]
        return tags.T

    def gradients(self, signs: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The mean negative log likelihood of ``tags``, and its gradients."""
        scores, both, kept = self.emissions(signs, keep=True)
        alpha, beta, total = self._sums(scores)
        steps, batch, n_tags = scores.shape
        gold = tags.T
        rows = np.arange(batch)
        move = self.move + self.allowed
        path = np.take_along_axis(scores, gold[:, :, None], 2).sum((0, 2)) + move[gold[:-1], gold[1:]].sum(0) + self.allowed[0][gold[0]]
        d_scores = np.exp(alpha + beta - total[None, :, None])
        d_move = np.zeros_like(self.move)
        for t in range(1, steps):
            both_at = alpha[t - 1][:, :, None] + move + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
            d_move += np.exp(both_at).sum(0)
        np.add.at(d_move, (gold[:-1], gold[1:]), -1)
        for t in range(steps):
            d_scores[t, rows, gold[t]] -= 1
        d_scores = (d_scores / batch).astype(np.float32)
        d_both = d_scores @ self.out.T
        d_states = np.stack([d_both[:, :, :HIDDEN], d_both[::-1, :, HIDDEN:]], 1)
        dx, d_in, d_state, d_gate = _lstm_back(d_states, kept, self.w_in, self.w_state)
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, signs.T, dx[:, 0] + dx[::-1, 1])
        d_out = both.reshape(-1, both.shape[2]).T @ d_scores.reshape(-1, n_tags)
        return float((total - path).mean()), [
            d_embed, d_in, d_state, d_gate, d_out, d_scores.sum((0, 1)), (d_move / batch).astype(np.float32),
        ]

    def fit(self, signs: np.ndarray, tags: np.ndarray, rounds: int, batch: int = 64, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam over all windows ``rounds`` times; the mean loss of each round."""
        rng = np.random.default_rng(seed)
        own = self.weights()
        mean, square = [np.zeros_like(w) for w in own], [np.zeros_like(w) for w in own]
        step, losses = 0, []
        total = rounds * -(-len(signs) // batch)
        for _ in range(rounds):
            order, lost = rng.permutation(len(signs)), []
            for i in range(0, len(order), batch):
                which = order[i : i + batch]
                loss, grads = self.gradients(signs[which], tags[which])
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
                step += 1
                now = rate * (1 - step / (total + 1))
                for w, g, m, s in zip(own, grads, mean, square):
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
                lost.append(loss)
            losses.append(float(np.mean(lost)))
        return losses
