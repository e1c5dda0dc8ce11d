"""A byte-level convolutional network in numpy, trained and applied over windows of bytes.

One layer of filters of several widths slides over the bytes of a window; each
filter's greatest response in the window (max pooling), rectified, is a feature, and a linear
layer turns features into class logits. A filter of width ``w`` is ``w`` tables
of one weight per byte value, that is, a convolution over one-hot bytes: the
response at a place is a sum of ``w`` table rows. For application the tables of
neighbouring places are summed into tables over byte pairs, which halves the
look-ups. Max pooling sends a gradient to one place per filter and window only,
so a training step updates just the table rows of the bytes there.
"""

from __future__ import annotations

import numpy as np

PAD = 0


def cut(texts: list[bytes], size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, index of their text): windows of ``size`` bytes every ``step``, covering every text.

    The last window of a text is filled up with zero bytes; an empty text has none.
    """
    length = np.array([len(t) for t in texts], np.int64)
    count = np.where(length == 0, 0, np.maximum(1, -(-(length - (size - step)) // step)))
    joined = np.frombuffer(b"".join(texts) + bytes(size), np.uint8)
    begin = np.r_[0, np.cumsum(length)[:-1]] if len(texts) else length
    of = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = begin[of] + nth * step
    left = length[of] - nth * step
    out = joined[start[:, None] + np.arange(size)]
    out[np.arange(size)[None, :] >= left[:, None]] = PAD
    return out, of


class ByteConvNet:
    """``widths``: {filter width: number of filters}; ``classes`` logits."""

    BLOCK = 64  # windows whose responses are held at once when applied

    def __init__(self, widths: dict[int, int], classes: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.widths = dict(widths)
        self.filters = {w: rng.normal(0, 0.5, (w, 256, n)).astype(np.float32) for w, n in widths.items()}
        for f in self.filters.values():
            f[:, PAD] = -1  # a filled-up place never is a filter's best
        self.bias = {w: np.zeros(n, np.float32) for w, n in widths.items()}
        total = sum(widths.values())
        self.out = rng.normal(0, 1 / np.sqrt(total), (total, classes)).astype(np.float32)
        self.out_bias = np.zeros(classes, np.float32)
        self.pairs: dict[int, list[np.ndarray]] = {}

    # --- training ---------------------------------------------------------------

    def _responses(self, x: np.ndarray):
        """Greatest response of each filter and where it is."""
        best, where = [], []
        for w, f in self.filters.items():
            m = x.shape[1] - w + 1
            r = np.take(f[0], x[:, :m], axis=0)
            for k in range(1, w):
                r += np.take(f[k], x[:, k:k + m], axis=0)
            at = r.argmax(axis=1)
            where.append(at)
            best.append(np.take_along_axis(r, at[:, None], axis=1)[:, 0] + self.bias[w])
        return best, where

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 8, batch: int = 128,
            rate: float = 0.02, seed: int = 2) -> "ByteConvNet":
        """Adagrad on the weighted cross entropy; ``x``: windows, ``y``: classes."""
        rng = np.random.default_rng(seed)
        params = [*self.filters.values(), *self.bias.values(), self.out, self.out_bias]
        square = [np.full_like(p, 1e-2) for p in params]
        nf = len(self.filters)

        def step(i, grad):
            square[i] += grad * grad
            params[i] -= rate * grad / np.sqrt(square[i])

        for _ in range(epochs):
            order = rng.permutation(len(x))
            for b in range(0, len(x), batch):
                i = order[b:b + batch]
                xb, yb, wb = x[i], y[i], weight[i]
                best, where = self._responses(xb)
                z = np.concatenate(best, axis=1)
                h = np.maximum(z, 0)
                p = self._softmax(h @ self.out + self.out_bias)
                p[np.arange(len(i)), yb] -= 1
                d = (p * (wb / wb.sum())[:, None]).astype(np.float32)
                dz = (d @ self.out.T) * (z > 0)
                step(2 * nf, h.T @ d)
                step(2 * nf + 1, d.sum(axis=0))
                at = 0
                for j, (w, f) in enumerate(self.filters.items()):
                    n = f.shape[2]
                    g = dz[:, at:at + n]
                    at += n
                    step(nf + j, g.sum(axis=0))
                    grad = np.zeros_like(f)
                    for k in range(w):
                        byte = np.take_along_axis(xb, where[j] + k, axis=1)
                        np.add.at(grad[k], (byte, np.arange(n)[None, :]), g)
                    step(j, grad)
        self.pairs = {}
        return self

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    # --- application -------------------------------------------------------------

    def _pair_tables(self) -> dict[int, list[np.ndarray]]:
        if not self.pairs:
            for w, f in self.filters.items():
                tables = [(f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, w - 1, 2)]
                self.pairs[w] = tables + ([f[w - 1]] if w % 2 else [])
        return self.pairs

    def __getstate__(self):
        return self.__dict__ | {"pairs": {}}

    def features(self, x: np.ndarray) -> np.ndarray:
        """Max-pooled, rectified responses of every window."""
        tables = self._pair_tables()
        out = np.empty((len(x), self.out.shape[0]), np.float32)
        for b in range(0, len(x), self.BLOCK):
            xb = x[b:b + self.BLOCK]
            pair = xb[:, :-1].astype(np.uint16) << 8 | xb[:, 1:]
            at = 0
            for w, parts in tables.items():
                m = x.shape[1] - w + 1
                r = None
                for k, t in enumerate(parts):
                    index = pair[:, 2 * k:2 * k + m] if len(t) == 65536 else xb[:, w - 1:w - 1 + m]
                    rows = np.take(t, index, axis=0)
                    r = rows if r is None else np.add(r, rows, out=r)
                n = r.shape[2]
                out[b:b + self.BLOCK, at:at + n] = r.max(axis=1) + self.bias[w]
                at += n
        return np.maximum(out, 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.out + self.out_bias

    def mean_logits(self, texts: list[bytes], size: int, step: int, group: int = 1 << 20) -> np.ndarray:
        """Per text the mean of its windows' logits, over all of it; zero where there is no byte.

        Texts go through in groups of about ``group`` bytes, a longer one
        piece by piece, so that memory does not follow the longest text.
        """
        total = np.zeros((len(texts), self.out.shape[1]), np.float64)
        count = np.zeros(len(texts), np.int64)
        pieces, of, held = [], [], 0

        def flush():
            x, i = cut(pieces, size, step)
            i = np.array(of, np.int64)[i]
            if len(x):
                z = self.logits(x)
                for c in range(z.shape[1]):
                    total[:, c] += np.bincount(i, z[:, c], len(texts))
                np.add(count, np.bincount(i, minlength=len(texts)), out=count)

        stride = group // step * step
        for i, t in enumerate(texts):
            at = 0
            while True:  # pieces begin where a window would and end where its last one ends
                piece = t[at:at + stride + size - step]
                pieces.append(piece), of.append(i)
                held += len(piece)
                if held >= group:
                    flush()
                    pieces, of, held = [], [], 0
                at += stride
                if at + size - step >= len(t):
                    break
        flush()
        return total / np.maximum(count, 1)[:, None]
