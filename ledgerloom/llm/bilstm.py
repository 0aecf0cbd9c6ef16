"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Labels: 0 is outside, 1 .. are kinds. From one kind a text goes on in it or outside, never straight
into another kind. Gates are clipped lines (between 0 and 1, the cell between -1 and 1), which cost
a fraction of the smooth ones.
"""

from __future__ import annotations

import numpy as np

CHARACTERS = 160
HIDDEN = 8


def character_classes(text: str) -> np.ndarray:
    """A class for each code point: ASCII as it is, the rest in 32 by their last bits."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points, 128 + (points & 31)).astype(np.int32)


class Tagger:
    """Weights by name; ``run`` labels blocks of windows, ``gradient`` trains on them."""

    def __init__(self, kinds: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        h, labels = HIDDEN, kinds + 1
        self.kinds = kinds
        self.p = {"first": np.zeros(labels)}
        for way in "lr":  # the columns are the gates in, keep and out, then the cell's new content
            bias = np.concatenate([np.full(h, 0.5), np.full(h, 0.8), np.full(2 * h, 0.5)])
            bias[3 * h :] = 0
            self.p[f"x{way}"] = rng.normal(0, 0.3, (CHARACTERS, 4 * h)) + bias
            self.p[f"h{way}"] = rng.normal(0, 0.25, (h, 4 * h))
            self.p[f"o{way}"] = rng.normal(0, 0.3, (h, labels))
        self.p["bias"] = np.array([1.0] + [0.0] * kinds)
        self.p["enter"] = np.full(kinds, -2.0)
        self.p["stay"] = np.full(kinds, 1.0)
        self.p["leave"] = np.full(kinds, -1.0)
        self.low = np.array([0.0] * (3 * h) + [-1.0] * h)

    def packed(self) -> Tagger:
        """The same with single precision, for running."""
        out = Tagger.__new__(Tagger)
        out.kinds, out.low = self.kinds, self.low.astype(np.float32)
        out.p = {name: value.astype(np.float32) for name, value in self.p.items()}
        return out

    def emissions(self, block: np.ndarray) -> np.ndarray:
        """Scores (time x windows x labels) of a block of character classes (time x windows)."""
        p, n = self.p, block.shape[1]
        out = np.empty((len(block), n, self.kinds + 1), p["bias"].dtype)
        hid = HIDDEN
        for way, times in (("l", range(len(block))), ("r", range(len(block) - 1, -1, -1))):
            x, u, o = p[f"x{way}"], p[f"h{way}"], p[f"o{way}"]
            h = np.zeros((n, hid), out.dtype)
            c = np.zeros((n, hid), out.dtype)
            for t in times:
                z = x[block[t]]
                z += h @ u
                np.maximum(z, self.low, out=z)
                np.minimum(z, 1, out=z)
                c *= z[:, hid : 2 * hid]
                c += z[:, :hid] * z[:, 3 * hid :]
                np.maximum(c, -1, out=h)
                np.minimum(h, 1, out=h)
                h *= z[:, 2 * hid : 3 * hid]
                if way == "l":
                    out[t] = h @ o
                else:
                    out[t] += h @ o
        out += p["bias"]
        return out

    def surely_outside(self, e: np.ndarray) -> np.ndarray:
        """For each window whether staying outside is the best path, by a bound that needs no search.

        A path gains over staying outside at each character in a kind at most what the kind's score,
        with the better of entering and staying, is above the score outside; leaving is counted if it
        should ever pay. Outside is best if no stretch gains: one inside the window pays for entering
        and leaving, one that reaches its end for entering, and one that begins with it for nothing.
        """
        p = self.p
        first = np.maximum(p["first"][1:] - p["first"][0], np.maximum(p["enter"], p["stay"]))
        step = np.maximum(first, p["stay"]) + np.maximum(p["leave"], 0)
        gain = e[:, :, 1] + step[0]
        for k in range(1, self.kinds):
            np.maximum(gain, e[:, :, k + 1] + step[k], out=gain)
        gain -= e[:, :, 0]
        enters = min(0.0, float((p["enter"] - p["stay"]).max()))
        both = min(0.0, float((p["enter"] + p["leave"] - p["stay"]).max()))
        sure = np.maximum(gain[1:], 0).sum(axis=0) + both <= 0
        sure &= gain[:0:-1].cumsum(axis=0).max(axis=0, initial=-np.inf) + enters <= 0
        return sure & (gain.cumsum(axis=0).max(axis=0) <= 0)

    def decode(self, e: np.ndarray) -> np.ndarray:
        """The best labels (time x windows) for emissions; of equal paths the one outside."""
        p = self.p
        best = e[0] + p["first"]
        stays = np.empty((len(e), e.shape[1], self.kinds), bool)
        left = np.empty(e.shape[:2], np.int8)
        for t in range(1, len(e)):
            goes_on, enters = best[:, 1:] + p["stay"], best[:, :1] + p["enter"]
            np.greater(goes_on, enters, out=stays[t])
            leaves = best[:, 1:] + p["leave"]
            kind = leaves.argmax(axis=1)
            ahead = np.take_along_axis(leaves, kind[:, None], 1)[:, 0]
            left[t] = np.where(ahead > best[:, 0], kind + 1, 0)
            best = np.concatenate([np.maximum(ahead, best[:, 0])[:, None], np.maximum(goes_on, enters)], axis=1) + e[t]
        out = np.empty(e.shape[:2], np.int8)
        label = best.argmax(axis=1).astype(np.int8)
        rows = np.arange(e.shape[1])
        for t in range(len(e) - 1, -1, -1):
            out[t] = label
            if t:
                kept = np.where(stays[t][rows, np.maximum(label, 1) - 1], label, 0)
                label = np.where(label > 0, kept, left[t]).astype(np.int8)
        return out

    def labels(self, block: np.ndarray) -> np.ndarray:
        """The labels (time x windows) of a block of character classes."""
        e = self.emissions(block)
        out = np.zeros(block.shape, np.int8)
        open_ = np.flatnonzero(~self.surely_outside(e))
        if len(open_):
            out[:, open_] = self.decode(e[:, open_])
        return out

    # --- training -----------------------------------------------------------------------

    def _transitions(self) -> np.ndarray:
        a = np.full((self.kinds + 1, self.kinds + 1), -1e4)
        a[0, 0] = 0
        a[0, 1:], a[1:, 0] = self.p["enter"], self.p["leave"]
        a[range(1, self.kinds + 1), range(1, self.kinds + 1)] = self.p["stay"]
        return a

    def gradient(self, block: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the labels (time x windows) by character, and its gradient."""
        p, hid, (steps, n) = self.p, HIDDEN, block.shape
        kept = {}
        e = np.zeros((steps, n, self.kinds + 1)) + p["bias"]
        for way, times in (("l", range(steps)), ("r", range(steps - 1, -1, -1))):
            h, c, states = np.zeros((n, hid)), np.zeros((n, hid)), {}
            for t in times:
                raw = p[f"x{way}"][block[t]] + h @ p[f"h{way}"]
                z = np.clip(raw, self.low, 1)
                new = c * z[:, hid : 2 * hid] + z[:, :hid] * z[:, 3 * hid :]
                after = np.clip(new, -1, 1) * z[:, 2 * hid : 3 * hid]
                states[t] = raw, z, c, new, h, after
                h, c = after, new
                e[t] += h @ p[f"o{way}"]
            kept[way] = states
        loss, de, g = self._crf(e, labels)
        g["bias"] = de.sum(axis=(0, 1))
        for way, times in (("l", range(steps - 1, -1, -1)), ("r", range(steps))):
            gx, gu, go = (np.zeros_like(p[f"{name}{way}"]) for name in "xho")
            dh, dc = np.zeros((n, hid)), np.zeros((n, hid))
            for t in times:
                raw, z, c, new, h, after = kept[way][t]
                go += after.T @ de[t]
                dh = dh + de[t] @ p[f"o{way}"].T
                dnew = dc + dh * z[:, 2 * hid : 3 * hid] * (np.abs(new) < 1)
                dz = np.concatenate(
                    [dnew * z[:, 3 * hid :], dnew * c, dh * np.clip(new, -1, 1), dnew * z[:, :hid]], axis=1
                ) * ((raw > self.low) & (raw < 1))
                np.add.at(gx, block[t], dz)
                gu += h.T @ dz
                dh, dc = dz @ p[f"h{way}"].T, dnew * z[:, hid : 2 * hid]
            g |= {f"x{way}": gx, f"h{way}": gu, f"o{way}": go}
        return loss / block.size, {name: value / block.size for name, value in g.items()}

    def _crf(self, e: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
        """Negative log-likelihood summed over the windows, its gradient by emission and by transition."""
        a, (steps, n, _) = self._transitions(), e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)

        def total(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis)
            return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))

        alpha[0] = e[0] + self.p["first"]
        for t in range(1, steps):
            alpha[t] = total(alpha[t - 1][:, :, None] + a, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = total(a + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = total(alpha[-1], 1)
        de = np.exp(alpha + beta - z[:, None])
        first = de[0].sum(axis=0)
        moves = np.zeros_like(a)
        rows = np.arange(n)
        right = e[0][rows, labels[0]] + self.p["first"][labels[0]]
        for t in range(1, steps):
            moves += np.exp(alpha[t - 1][:, :, None] + a + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(axis=0)
            np.add.at(moves, (labels[t - 1], labels[t]), -1)
            right = right + a[labels[t - 1], labels[t]] + e[t][rows, labels[t]]
        np.add.at(first, labels[0], -1)
        np.subtract.at(de, (np.arange(steps)[:, None], rows[None], labels), 1)
        k = np.arange(1, self.kinds + 1)
        g = {"first": first, "enter": moves[0, 1:], "leave": moves[1:, 0], "stay": moves[k, k]}
        return float((z - right).sum()), de, g

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int, batch: int = 64, rate: float = 0.02, seed: int = 0) -> float:
        """Adam on random batches of windows (windows x time); returns the last losses' mean."""
        rng = np.random.default_rng(seed)
        m = {name: np.zeros_like(value) for name, value in self.p.items()}
        v = {name: np.zeros_like(value) for name, value in self.p.items()}
        losses = []
        for t in range(1, steps + 1):
            rows = rng.integers(0, len(windows), batch)
            loss, g = self.gradient(windows[rows].T, labels[rows].T)
            losses.append(loss)
            size = np.sqrt(sum((x * x).sum() for x in g.values()))
            now = rate * min(1.0, 3 * (1 - t / (steps + 1)))
            for name, value in g.items():
                value = value * min(1.0, 1.0 / (size + 1e-12))
                m[name] = 0.9 * m[name] + 0.1 * value
                v[name] = 0.99 * v[name] + 0.01 * value * value
                self.p[name] -= now * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.99**t)) + 1e-6)
        return float(np.mean(losses[-20:])) if losses else 0.0
