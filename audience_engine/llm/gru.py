"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation.

Symbols: ``heads`` frequent words, ``groups`` middle symbols (less frequent words of one group),
one symbol for rare words and one for the end of a document.  The model gives the probability of
the next symbol's class, and of a frequent word inside its class; words inside a middle or
rare symbol have fixed shares, which the caller adds.

Documents are streamed in lanes: each lane holds documents one after the other, in windows of
``WINDOW`` symbols.  The state is carried from window to window and starts at zero with each
document, so a score covers the whole document.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 24
WINDOW = 32
LANES = 256
RATE, CLIP = 0.01, 5.0
#: States whose output is computed at a time; their arrays stay in a core's cache.
AT_ONCE = 2048


def initial(class_of: np.ndarray, weights: np.ndarray, n_classes: int, heads: int, seed: int = 1) -> dict[str, np.ndarray]:
    """Parameters; biases start at the logarithm of the symbols' shares."""
    rng = np.random.default_rng(seed)
    symbols, h = len(class_of), HIDDEN
    by_class = np.bincount(class_of, weights=weights, minlength=n_classes) + 1.0
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {"gates": small(symbols, 3 * h), "u": (rng.standard_normal((h, 3 * h)) / h**0.5).astype(np.float32),
            "cw": small(n_classes, h), "cb": np.log(by_class / by_class.sum()).astype(np.float32),
            "ww": small(max(heads, 1), h), "wb": np.log((weights[:heads] + 1.0) if heads else np.ones(1)).astype(np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Lanes:
    """Documents dealt to lanes, the longest first into the shortest lane."""

    def __init__(self, docs: list[np.ndarray], lanes: int = LANES):
        n = max(1, min(lanes, len(docs)))
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        import heapq

        heap, held = [(0, j) for j in range(n)], [[] for _ in range(n)]
        for i in order:
            size, j = heapq.heappop(heap)
            held[j].append(i)
            heapq.heappush(heap, (size + len(docs[i]), j))
        # the longest lanes first: the lanes that still run are then the first ones
        sizes = [sum(len(docs[i]) for i in x) for x in held]
        held = [held[j] for j in sorted(range(n), key=lambda j: -sizes[j])]
        self.sizes = np.array([sum(len(docs[i]) for i in x) for x in held], dtype=np.int64)
        self.steps = int(self.sizes.max(initial=0))
        self.x = np.zeros((self.steps, n), dtype=np.int32)
        self.doc = np.full((self.steps, n), -1, dtype=np.int32)
        self.keep = np.ones((self.steps, n), dtype=np.float32)
        for j, own in enumerate(held):
            at = 0
            for i in own:
                m = len(docs[i])
                self.x[at:at + m, j], self.doc[at:at + m, j], self.keep[at, j] = docs[i], i, 0.0
                at += m

    def windows(self, size: int = WINDOW):
        """(first step, last step, lanes that still run)."""
        for a in range(0, self.steps, size):
            yield a, min(a + size, self.steps), int((self.sizes > a).sum())


def _states(p: dict[str, np.ndarray], x: np.ndarray, keep: np.ndarray, h: np.ndarray, tape: list | None):
    """States before each symbol (steps x lanes x hidden), and the one after the last."""
    d = HIDDEN
    out = np.empty((*x.shape, d), dtype=np.float32)
    gates = np.take(p["gates"], x, axis=0)
    for t in range(len(x)):
        hb = h * keep[t][:, None]
        out[t] = hb
        a, u = gates[t], hb @ p["u"]
        zr = _sigmoid(a[:, :2 * d] + u[:, :2 * d])
        z, r, q = zr[:, :d], zr[:, d:], u[:, 2 * d:]
        n = r * q
        n += a[:, 2 * d:]
        np.tanh(n, out=n)
        h = hb - n
        h *= z
        h += n
        if tape is not None:
            tape.append((hb, z, r, q, n))
    return out, h


def _log_softmax(x: np.ndarray) -> np.ndarray:
    """In place."""
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


class Output:
    """Class-factored softmax over the states."""

    def __init__(self, class_of: np.ndarray, heads: int):
        self.class_of, self.heads = class_of, heads
        # frequent words are numbered so that each class is a run of words
        own = class_of[:heads]
        self.runs = {int(c): (int(np.flatnonzero(own == c)[0]), int(np.flatnonzero(own == c)[-1]) + 1) for c in np.unique(own)}

    def log_probs(self, p: dict[str, np.ndarray], h: np.ndarray, y: np.ndarray, grads: dict | None = None):
        """Natural log probability of each symbol y after state h; with ``grads``, adds gradients of the
        mean loss to it and also returns the gradient of the states."""
        c = self.class_of[y]
        rows = np.arange(len(y))
        lc = h @ p["cw"].T
        lc += p["cb"]
        lc = _log_softmax(lc)
        out = lc[rows, c]
        dh = None
        if grads is not None:
            dc = np.exp(lc, out=lc)
            dc[rows, c] -= 1
            dc /= len(y)
            grads["cw"] += dc.T @ h
            grads["cb"] += dc.sum(axis=0)
            dh = dc @ p["cw"]
        head = np.flatnonzero(y < self.heads)
        head = head[np.argsort(c[head], kind="stable")]
        ends = np.flatnonzero(np.append(np.diff(c[head]) != 0, True)) + 1 if len(head) else []
        # the states of frequent words, sorted by class, and what goes back to them
        states, words, classes = h[head], y[head], c[head]
        chosen, back = np.zeros(len(head), dtype=out.dtype), np.zeros_like(states)
        at = 0
        for e in ends:
            own, at = slice(at, e), e
            s, t = self.runs[int(classes[own.start])]
            if t - s == 1:
                continue
            lw = states[own] @ p["ww"][s:t].T
            lw += p["wb"][s:t]
            lw = _log_softmax(lw)
            k, w = rows[:e - own.start], words[own] - s
            chosen[own] = lw[k, w]
            if grads is not None:
                dw = np.exp(lw, out=lw)
                dw[k, w] -= 1
                dw /= len(y)
                grads["ww"][s:t] += dw.T @ states[own]
                grads["wb"][s:t] += dw.sum(axis=0)
                np.matmul(dw, p["ww"][s:t], out=back[own])
        out[head] += chosen
        if grads is None:
            return out
        dh[head] += back
        return out, dh


def score(p: dict[str, np.ndarray], out: Output, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document, state carried over all its windows."""
    total = np.zeros(len(docs))
    if not docs:
        return total
    lanes = Lanes(docs)
    h = np.zeros((lanes.x.shape[1], HIDDEN), dtype=np.float32)
    for a, b, n in lanes.windows():
        hb, h = _states(p, lanes.x[a:b, :n], lanes.keep[a:b, :n], h[:n], None)
        doc = lanes.doc[a:b, :n].ravel()
        live = np.flatnonzero(doc >= 0)
        states, x = hb.reshape(-1, HIDDEN), lanes.x[a:b, :n].ravel()
        lp = [out.log_probs(p, states[i], x[i]) for i in (live[k:k + AT_ONCE] for k in range(0, len(live), AT_ONCE))]
        total += np.bincount(doc[live], weights=np.concatenate(lp), minlength=len(docs))
    return total


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, v in like.items():
        out[k] = flat[at:at + v.size].reshape(v.shape)
        at += v.size
    return out


def learn(p: dict[str, np.ndarray], out: Output, docs: list[np.ndarray], rate: float = RATE, lanes: int = 64) -> dict[str, np.ndarray]:
    """One pass of truncated backpropagation through the windows, with Adam."""
    if not docs:
        return p
    # parameters, gradients and moments lie in one array each
    held = np.concatenate([v.ravel() for v in p.values()])
    slope, m1, m2, change, scale = (np.zeros_like(held) for _ in range(5))
    p, g = _views(held, p), _views(slope, p)
    d, step = HIDDEN, 0
    run = Lanes(docs, lanes)
    total_steps = max(1, -(-run.steps // WINDOW))
    h = np.zeros((run.x.shape[1], d), dtype=np.float32)
    for a, b, n in run.windows():
        x, keep = run.x[a:b, :n], run.keep[a:b, :n]
        tape: list = []
        hb, h = _states(p, x, keep, h[:n], tape)
        live = np.flatnonzero(run.doc[a:b, :n].ravel() >= 0)
        slope.fill(0)
        _, dlive = out.log_probs(p, hb.reshape(-1, d)[live], x.ravel()[live], g)
        dout = np.zeros((x.size, d), dtype=np.float32)
        dout[live] = dlive
        dout = dout.reshape(*x.shape, d)
        dh = np.zeros((n, d), dtype=np.float32)
        da = np.empty((*x.shape, 3 * d), dtype=np.float32)
        for t in range(len(x) - 1, -1, -1):
            before, z, r, q, new = tape[t]
            dn, dz = dh * (1 - z), dh * (before - new)
            dnew = dn * (1 - new * new)
            dr = dnew * q * r * (1 - r)
            dz = dz * z * (1 - z)
            du = np.concatenate([dz, dr, dnew * r], axis=1)
            da[t] = np.concatenate([dz, dr, dnew], axis=1)
            g["u"] += before.T @ du
            dh = (dh * z + du @ p["u"].T + dout[t]) * keep[t][:, None]
        flat, order = da.reshape(-1, 3 * d), np.argsort(x.ravel(), kind="stable")
        ids = x.ravel()[order]
        starts = np.flatnonzero(np.append(True, np.diff(ids) != 0))
        g["gates"][ids[starts]] += np.add.reduceat(flat[order], starts, axis=0)
        norm = sum(float((v * v).sum()) for v in g.values()) ** 0.5
        step += 1
        lr = rate * (1 - 0.9 * step / total_steps)
        if norm > CLIP:
            slope *= CLIP / norm
        m1 *= 0.9
        m1 += np.multiply(slope, 0.1, out=change)
        m2 *= 0.99
        np.multiply(slope, 0.01, out=change)
        m2 += np.multiply(change, slope, out=change)
        np.divide(m1, 1 - 0.9**step, out=change)
        change *= lr
        np.divide(m2, 1 - 0.99**step, out=scale)
        np.sqrt(scale, out=scale)
        scale += 1e-6
        change /= scale
        held -= change
    return p


__all__ = ["initial", "Lanes", "Output", "score", "learn", "HIDDEN"]
