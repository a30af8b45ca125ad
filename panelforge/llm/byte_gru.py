"""A small bidirectional gated recurrent network over bytes, in numpy.

One direction reads the bytes forwards, one backwards; at every position both
states give the class scores of that position. Training is backpropagation
through time with Adam over windows of bytes. Arrays are (features, lanes), so a
step of many windows is one small matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes that one lane reads at prediction time; the state starts anew in each chunk.
CHUNK = 256
#: Bytes of text that one call of the recurrence holds.
PREDICT_BYTES = 1 << 17


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class ByteGru:
    """Weights: per direction input table (3h, 256), recurrence (3h, h) and read-out (classes, h)."""

    labels: list[str]
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    readout: list[np.ndarray]
    bias: np.ndarray

    @property
    def hidden(self) -> int:
        return self.recurrent[0].shape[1]

    def _states(
        self, side: int, chars: np.ndarray, active: np.ndarray | None = None, trace: list | None = None
    ) -> np.ndarray:
        """States (steps, h, lanes) of one direction over ``chars`` (steps, lanes).

        At step t only the first ``active[t]`` lanes hold a byte (all of them if None); lanes
        are sorted by falling length, and a backward lane starts at its own last byte.
        """

        steps, lanes = chars.shape
        n, table, matrix = self.hidden, self.inputs[side], self.recurrent[side]
        h = np.zeros((n, lanes), dtype=np.float32)
        states = np.zeros((steps, n, lanes), dtype=np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            width = lanes if active is None else active[t]
            before = h[:, :width]
            u = matrix @ before
            x = table.take(chars[t, :width], axis=1)
            gates = _sigmoid(x[: 2 * n] + u[: 2 * n])
            z, r = gates[:n], gates[n:]
            c = np.tanh(x[2 * n :] + r * u[2 * n :])
            if trace is not None:
                trace.append((t, before.copy(), z, r, c, u[2 * n :]))
            states[t, :, :width] = h[:, :width] = before + z * (c - before)
        return states

    def scores(self, chars: np.ndarray, active: np.ndarray | None = None) -> np.ndarray:
        """Class probabilities (steps, classes, lanes) of every position."""

        logits = np.matmul(self.readout[0], self._states(0, chars, active))
        logits += np.matmul(self.readout[1], self._states(1, chars, active))
        logits += self.bias[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def pooled(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Mean position probabilities (texts, classes) of ``data[bounds[i]:bounds[i+1]]``; empty texts get zeros."""

        sizes = np.diff(bounds)
        counts = -(-sizes // CHUNK)
        owner = np.repeat(np.arange(len(sizes)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begins = bounds[owner] + CHUNK * nth
        lengths = np.minimum(bounds[owner + 1] - begins, CHUNK)
        sums = np.zeros((len(sizes), len(self.labels)), dtype=np.float64)
        order = np.argsort(-lengths, kind="stable")  # lanes of like length share a block
        per_call = max(1, PREDICT_BYTES // CHUNK)
        for low in range(0, len(order), per_call):
            lanes = order[low : low + per_call]
            steps = np.arange(int(lengths[lanes[0]]))
            inside = steps[:, None] < lengths[lanes][None, :]
            at = np.where(inside, begins[lanes][None, :] + steps[:, None], begins[lanes][None, :])
            chars = np.where(inside, data[at], 0)
            found = self.scores(chars, inside.sum(axis=1))
            found *= inside[:, None, :]
            np.add.at(sums, owner[lanes], found.sum(axis=0, dtype=np.float64).T)
        return sums / np.maximum(sizes, 1)[:, None]

    def label_positions(self, text: bytes) -> list[str]:
        """The label of every byte of a text."""

        found: list[str] = []
        for low in range(0, len(text), CHUNK):
            chars = np.frombuffer(text[low : low + CHUNK], dtype=np.uint8)[:, None]
            found += [self.labels[k] for k in self.scores(chars)[:, :, 0].argmax(axis=1)]
        return found


def _gradients(model: ByteGru, chars: np.ndarray, target: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Gradients of the mean cross-entropy over all positions, in the order of :func:`_weights`."""

    steps, lanes = chars.shape
    n, k = model.hidden, len(model.labels)
    traces: list[list] = [[], []]
    states = [model._states(side, chars, None, traces[side]) for side in (0, 1)]
    logits = np.matmul(model.readout[0], states[0]) + np.matmul(model.readout[1], states[1]) + model.bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    lane = np.arange(lanes)
    loss = float(-np.log(np.maximum(p[:, target, lane], 1e-9)).mean())
    p[:, target, lane] -= 1
    p /= steps * lanes
    grads = []
    for side in (0, 1):
        d_read = np.einsum("tkb,thb->kh", p, states[side])
        d_out = np.matmul(model.readout[side].T, p)
        matrix = model.recurrent[side]
        d_matrix, d_table = np.zeros_like(matrix), np.zeros((256, 3 * n), dtype=np.float32)
        d_h = np.zeros((n, lanes), dtype=np.float32)
        for t, before, z, r, c, uc in reversed(traces[side]):
            d_h = d_h + d_out[t]
            d_c = d_h * z * (1 - c * c)
            d_z = d_h * (c - before) * z * (1 - z)
            d_r = d_c * uc * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_c * r])
            d_x = np.concatenate([d_z, d_r, d_c])
            d_matrix += d_u @ before.T
            np.add.at(d_table, chars[t], d_x.T)
            d_h = d_h * (1 - z) + matrix.T @ d_u
        grads += [d_table.T, d_matrix, d_read]
    return [*grads, p.sum(axis=(0, 2))], loss


def _weights(model: ByteGru) -> list[np.ndarray]:
    found = []
    for side in (0, 1):
        found += [model.inputs[side], model.recurrent[side], model.readout[side]]
    return [*found, model.bias]


def train(
    windows: np.ndarray, target: np.ndarray, labels: list[str], hidden: int = 8, rounds: int = 300,
    lanes: int = 256, rate: float = 0.02, seed: int = 7, least_lanes: int = 8,
) -> ByteGru:
    """Fit on ``windows`` (examples, steps) of bytes and the class number of each.

    A batch holds about ``lanes`` examples, and of every class at least ``least_lanes``.
    """

    random = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return random.normal(0, scale, shape).astype(np.float32)

    model = ByteGru(
        labels, [draw(3 * hidden, 256, scale=0.3) for _ in (0, 1)],
        [draw(3 * hidden, hidden, scale=hidden**-0.5) for _ in (0, 1)],
        [draw(len(labels), hidden, scale=0.3) for _ in (0, 1)], np.zeros(len(labels), dtype=np.float32),
    )
    weights = _weights(model)
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    # Every class has the same share of each batch.
    members = [np.flatnonzero(target == k) for k in range(len(labels))]
    for step in range(1, rounds + 1):
        pick = np.concatenate([random.choice(m, max(least_lanes, lanes // len(labels))) for m in members])
        grads, _ = _gradients(model, np.ascontiguousarray(windows[pick].T), target[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        shrink = min(1.0, 1.0 / max(norm, 1e-9))
        pace = rate * min(1.0, 2.0 * (1 - step / (rounds + 1)))
        for w, g, m, v in zip(weights, grads, first, second):
            g = g * shrink
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model
