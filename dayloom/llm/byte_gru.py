"""A bidirectional gated recurrent network over bytes that labels every position, in numpy.

Bytes come in windows of ``WINDOW``; each direction has its own weights. At every position the two states give one
distribution over the labels. Training is backpropagation through time over whole windows, with Adam.
"""

from __future__ import annotations

import numpy as np

WINDOW = 64
_F = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= _F(0.5)
    np.tanh(x, out=x)
    x *= _F(0.5)
    x += _F(0.5)
    return x


class Direction:
    """One gated recurrent layer; its input weights are rows picked by the byte."""

    NAMES = ("gate_in", "gate_rec", "new_in", "new_rec", "new_bias")

    def __init__(self, size: int, rng: np.random.Generator) -> None:
        scale = 1 / np.sqrt(size)
        self.gate_in = rng.normal(0, 0.3, (256, 2 * size)).astype(_F)
        self.gate_rec = rng.normal(0, scale, (size, 2 * size)).astype(_F)
        self.new_in = rng.normal(0, 0.3, (256, size)).astype(_F)
        self.new_rec = rng.normal(0, scale, (size, size)).astype(_F)
        self.new_bias = np.zeros(size, _F)

    def run(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step of ``x`` (steps, windows); ``keep`` gathers what ``back`` needs."""
        size = len(self.new_bias)
        h = np.zeros((x.shape[1], size), _F)
        states = np.empty((*x.shape, size), _F)
        for t, byte in enumerate(x):
            gates = h @ self.gate_rec
            gates += self.gate_in[byte]
            _sigmoid(gates)
            z, r = gates[:, :size], gates[:, size:]
            m = h @ self.new_rec
            m += self.new_bias
            n = r * m
            n += self.new_in[byte]
            np.tanh(n, out=n)
            if keep is not None:
                keep.append((h, gates, m, n))
            h = h - n
            h *= z
            h += n
            states[t] = h
        return states

    def back(self, x: np.ndarray, kept: list, d_states: np.ndarray) -> dict[str, np.ndarray]:
        size = len(self.new_bias)
        grads = {k: np.zeros_like(getattr(self, k)) for k in ("gate_rec", "new_rec", "new_bias")}
        d_gate_in, d_new_in = np.empty((*x.shape, 2 * size), _F), np.empty((*x.shape, size), _F)
        dh = np.zeros_like(d_states[0])
        for t in range(len(x) - 1, -1, -1):
            h, gates, m, n = kept[t]
            z, r = gates[:, :size], gates[:, size:]
            dh = dh + d_states[t]
            da = dh * (1 - z) * (1 - n * n)
            d_gates = np.concatenate((dh * (h - n) * z * (1 - z), da * m * r * (1 - r)), axis=1)
            dm = da * r
            d_new_in[t], d_gate_in[t] = da, d_gates
            grads["new_rec"] += h.T @ dm
            grads["new_bias"] += dm.sum(axis=0)
            grads["gate_rec"] += h.T @ d_gates
            dh = dh * z + dm @ self.new_rec.T + d_gates @ self.gate_rec.T
        grads["gate_in"], grads["new_in"] = _by_byte(x, d_gate_in), _by_byte(x, d_new_in)
        return grads


def _by_byte(x: np.ndarray, d: np.ndarray) -> np.ndarray:
    columns = d.reshape(-1, d.shape[-1]).T
    return np.stack([np.bincount(x.ravel(), c, 256) for c in columns], axis=1).astype(_F)


class ByteGru:
    def __init__(self, labels: list[str], size: int = 8, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.ahead, self.behind = Direction(size, rng), Direction(size, rng)
        self.out = rng.normal(0, 0.3, (2 * size, len(labels))).astype(_F)
        self.out_bias = np.zeros(len(labels), _F)

    def _weights(self) -> dict[str, np.ndarray]:
        found = {f"{d}.{k}": getattr(getattr(self, d), k) for d in ("ahead", "behind") for k in Direction.NAMES}
        return found | {"out": self.out, "out_bias": self.out_bias}

    def probabilities(self, x: np.ndarray, kept: tuple[list, list] | None = None) -> np.ndarray:
        """(steps, windows, labels) for bytes ``x`` (steps, windows)."""
        keep_a, keep_b = kept or (None, None)
        both = np.concatenate((self.ahead.run(x, keep_a), self.behind.run(x[::-1], keep_b)[::-1]), axis=2)
        if kept is not None:
            self._states = both
        p = both @ self.out
        p += self.out_bias
        np.exp(p, out=p)  # states lie in (-1, 1), so the logits stay small
        p /= p.sum(axis=2, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss and its gradients; ``weight`` (steps, windows) sums to 1."""
        kept: tuple[list, list] = ([], [])
        p = self.probabilities(x, kept)
        size = len(self.ahead.new_bias)
        loss = -float((np.log(p[:, np.arange(len(y)), y] + 1e-9) * weight).sum())
        d = p
        d[:, np.arange(len(y)), y] -= 1
        d *= weight[:, :, None]
        grads = {"out": np.einsum("tbh,tbl->hl", self._states, d), "out_bias": d.sum(axis=(0, 1))}
        d_states = d @ self.out.T
        grads |= {f"ahead.{k}": g for k, g in self.ahead.back(x, kept[0], d_states[:, :, :size]).items()}
        behind = self.behind.back(x[::-1], kept[1], d_states[::-1, :, size:])
        return loss, grads | {f"behind.{k}": g for k, g in behind.items()}

    def train(self, x: np.ndarray, y: np.ndarray, length: np.ndarray, steps: int, batch: int, seed: int = 0) -> None:
        """Fit to windows ``x`` (windows, steps) with labels ``y``; only the first ``length`` bytes of each count."""
        rng = np.random.default_rng(seed)
        share = 1 / np.bincount(y, minlength=len(self.labels)).clip(1)  # every label weighs the same
        pick = share[y] / share[y].sum()
        weights = self._weights()
        first = {k: np.zeros_like(w) for k, w in weights.items()}
        second = {k: np.zeros_like(w) for k, w in weights.items()}
        for step in range(1, steps + 1):
            rows = rng.choice(len(x), batch, p=pick)
            inside = np.arange(x.shape[1])[:, None] < length[rows]
            _, grads = self.gradients(x[rows].T, y[rows], (inside / inside.sum()).astype(_F))
            rate = 0.02 * (1 - 0.9 * step / steps)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                scaled = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                weights[k] -= (rate * scaled).astype(_F)

    def pooled(self, texts: list[bytes], block: int = 2048) -> np.ndarray:
        """Mean probabilities of each text over all its bytes; nothing for an empty one."""
        windows, owner, lengths = _windows(texts)
        sums = np.zeros((len(texts), len(self.labels)))
        for a in range(0, len(windows), block):
            part, length = windows[a : a + block], lengths[a : a + block]
            p = self.probabilities(np.ascontiguousarray(part.T))
            if (length < part.shape[1]).any():
                p *= (np.arange(part.shape[1])[:, None] < length)[:, :, None]
            per_window = p.sum(axis=0)
            for label in range(len(self.labels)):
                sums[:, label] += np.bincount(owner[a : a + block], per_window[:, label], len(texts))
        return sums / np.maximum(1, np.fromiter(map(len, texts), np.int64, len(texts)))[:, None]


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the texts in rows of ``WINDOW``, the text of each row and the number of its bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    rows = -(-sizes // WINDOW)
    padded = b"".join(t.ljust(r * WINDOW, b"\0") for t, r in zip(texts, rows.tolist()))
    owner = np.repeat(np.arange(len(texts)), rows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(rows) - rows, rows)
    return np.frombuffer(padded, np.uint8).reshape(-1, WINDOW), owner, np.minimum(WINDOW, sizes[owner] - place * WINDOW)
