"""A convolutional network over bytes in numpy: training on labelled windows and batched scoring.

A byte has a short vector; filters of several widths slide over a window's bytes; each filter keeps its largest response in the window, and a softmax layer turns these into one score per label. Filters of all widths are
one matrix over the widest stretch, narrower ones being zero beyond their width.
"""

from __future__ import annotations

import numpy as np

PAD = 256
WIDTHS = (2, 3, 4, 5)


def windows(raw: bytes, length: int) -> np.ndarray:
    """Windows of ``length`` bytes over all of a text, the last one padded; a text without bytes is one window of padding."""
    n = max(1, -(-len(raw) // length))
    out = np.full(n * length, PAD, np.int16)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, length)


class Network:
    """Weights: ``byte`` (257, size), ``filters`` (widest * size, filters), ``bias``, ``out`` (filters, labels), ``out_bias``."""

    def __init__(self, labels: int, *, size: int = 8, filters: int = 16, seed: int = 3) -> None:
        r = np.random.Generator(np.random.PCG64(seed))
        self.size, self.reach = size, max(WIDTHS)
        self.mask = np.zeros((self.reach * size, len(WIDTHS) * filters), np.float32)
        for i, w in enumerate(WIDTHS):
            self.mask[: w * size, i * filters : (i + 1) * filters] = 1
        self.p = {
            "byte": r.normal(0, 0.5, (PAD + 1, size)),
            "filters": r.normal(0, 0.4, self.mask.shape) * self.mask,
            "bias": np.zeros(self.mask.shape[1]),
            "out": r.normal(0, 0.1, (self.mask.shape[1], labels)),
            "out_bias": np.zeros(labels),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def patches(self, x: np.ndarray) -> np.ndarray:
        """The vectors of each stretch of ``reach`` bytes: (windows * places, reach * size)."""
        e = self.p["byte"][x]
        n, length, size = e.shape
        step = e.strides[1]
        view = np.lib.stride_tricks.as_strided(e, (n, length - self.reach + 1, self.reach * size), (e.strides[0], step, e.itemsize))
        return view.reshape(-1, self.reach * size)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each window, not below 0, and all responses."""
        all_ = (self.patches(x) @ self.p["filters"]).reshape(len(x), -1, self.mask.shape[1])
        return np.maximum(all_.max(axis=1) + self.p["bias"], 0), all_

    def log_chances(self, x: np.ndarray, pooled: np.ndarray | None = None) -> np.ndarray:
        z = (self.pooled(x)[0] if pooled is None else pooled) @ self.p["out"] + self.p["out_bias"]
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        top, all_ = self.pooled(x)
        logs = self.log_chances(x, top)
        n, rows = len(x), np.arange(len(x))
        dz = np.exp(logs)
        dz[rows, y] -= 1
        dz /= n
        grad = {"out": top.T @ dz, "out_bias": dz.sum(axis=0)}
        dtop = (dz @ self.p["out"].T) * (top > 0)
        grad["bias"] = dtop.sum(axis=0)
        # Only the place of its largest response moves a filter.
        at = all_.argmax(axis=1)
        stretch = x[rows[:, None, None], at[:, :, None] + np.arange(self.reach)]
        met = self.p["byte"][stretch].reshape(n, at.shape[1], -1)
        grad["filters"] = np.einsum("nfp,nf->pf", met, dtop) * self.mask
        back = (dtop[:, :, None] * self.p["filters"].T[None]).reshape(-1, self.size)
        grad["byte"] = np.zeros_like(self.p["byte"])
        np.add.at(grad["byte"], stretch.reshape(-1), back)
        return float(-logs[rows, y].mean()), grad

    def scored(self, x: np.ndarray, group: int = 256) -> np.ndarray:
        """Log chances of windows, computed in groups of fixed size."""
        return np.concatenate([self.log_chances(x[i : i + group]) for i in range(0, len(x), group)])


def trained(x: np.ndarray, y: np.ndarray, labels: int, *, epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 3) -> Network:
    """A network trained with Adam; the same for the same windows."""
    model = Network(labels, seed=seed)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    r = np.random.Generator(np.random.PCG64(seed + 1))
    step, steps = 0, max(1, epochs * -(-len(x) // batch))
    for _ in range(epochs):
        order = r.permutation(len(x))
        for i in range(0, len(x), batch):
            pick = order[i : i + batch]
            _, grad = model.loss_and_gradient(x[pick], y[pick])
            step += 1
            pace = rate * (1 - 0.95 * step / steps)
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.p[k] -= (pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model
