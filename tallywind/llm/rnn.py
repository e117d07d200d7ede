"""A gated recurrent network over word numbers in numpy, with an output softmax factored into classes.

Word ``i`` below ``classes * width`` is in class ``i // width``; the number behind the last word stands for all other
words and is a class of its own. A word's probability is its class's times its share in the class, both softmax over
the state. Every word has its own input to the gates; one more input row opens a text.

Training is truncated backpropagation: gradients stop at the edge of a window, states are carried over it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

FLOAT = np.float32


class Net:
    def __init__(self, hidden: int, classes: int, width: int, seed: int = 0):
        self.hidden, self.classes, self.width = hidden, classes, width
        self.words = classes * width
        self.other, self.opening = self.words, self.words + 1
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(FLOAT)
        self.params = {
            "x": draw(self.words + 2, 3 * hidden),
            "u": draw(hidden, 3 * hidden),
            "wc": draw(hidden, classes + 1),
            "bc": np.zeros(classes + 1, FLOAT),
            "ww": draw(classes, hidden, width),
            "bw": np.zeros((classes, width), FLOAT),
        }

    def vector(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params.values()])

    def load(self, vector: np.ndarray) -> Net:
        at = 0
        for name, p in self.params.items():
            self.params[name] = vector[at : at + p.size].reshape(p.shape).astype(FLOAT)
            at += p.size
        return self

    def forward(self, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool = False):
        """States (steps, lanes, hidden) from ``inputs`` (steps, lanes); lanes restart where ``fresh``. Also what backward needs.

        Inside, lanes run along the last axis, so that each gate of a step is one run of memory; products have lanes first.
        """
        steps, lanes = inputs.shape
        n = self.hidden
        gates = np.ascontiguousarray(self.params["x"][inputs].transpose(0, 2, 1))
        u = self.params["u"]
        h = np.ascontiguousarray(h.T)
        restart = fresh.any(axis=1)
        states = np.empty((steps, n, lanes), FLOAT)
        before, inner = (np.empty((steps, n, lanes), FLOAT), np.empty((steps, n, lanes), FLOAT)) if keep else (None, None)
        for t in range(steps):
            if restart[t]:
                h = np.where(fresh[t], FLOAT(0), h)
            a = np.ascontiguousarray((np.ascontiguousarray(h.T) @ u).T)
            g, c = gates[t, : 2 * n], gates[t, 2 * n :]
            g += a[: 2 * n]
            g *= FLOAT(0.5)
            np.tanh(g, out=g)
            g += FLOAT(1)
            g *= FLOAT(0.5)
            if keep:
                before[t], inner[t] = h, a[2 * n :]
            a[2 * n :] *= g[n:]
            c += a[2 * n :]
            np.tanh(c, out=c)
            np.subtract(h, c, out=states[t])
            h = states[t]
            h *= g[:n]
            h += c
        return states.transpose(0, 2, 1), h.T, (gates, before, inner) if keep else None

    def log_probs(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """Natural log-probabilities of ``targets`` at ``states`` (rows), and the loss gradient at the states."""
        p = self.params
        group = np.minimum(targets // self.width, self.classes)
        logits = states @ p["wc"]
        logits += p["bc"]
        logits -= logits.max(axis=1, keepdims=True)
        shares = np.exp(logits)
        total = shares.sum(axis=1)
        rows = np.arange(len(targets))
        out = logits[rows, group] - np.log(total)
        at_states = None
        if grads is not None:
            shares /= total[:, None]
            shares[rows, group] -= 1
            grads["wc"] = states.T @ shares
            grads["bc"] = shares.sum(axis=0)
            at_states = shares @ p["wc"].T
            grads["ww"], grads["bw"] = np.zeros_like(p["ww"]), np.zeros_like(p["bw"])
        order = np.argsort(group.astype(np.uint8 if self.classes < 255 else np.uint16), kind="stable")
        ends = np.searchsorted(group[order], np.arange(self.classes + 1))
        for c in range(self.classes):
            mine = order[ends[c] : ends[c + 1]]
            if not len(mine):
                continue
            s = states[mine]
            logits = s @ p["ww"][c]
            logits += p["bw"][c]
            logits -= logits.max(axis=1, keepdims=True)
            shares = np.exp(logits)
            total = shares.sum(axis=1)
            rows, place = np.arange(len(mine)), targets[mine] - c * self.width
            out[mine] += logits[rows, place] - np.log(total)
            if grads is not None:
                shares /= total[:, None]
                shares[rows, place] -= 1
                grads["ww"][c] = s.T @ shares
                grads["bw"][c] = shares.sum(axis=0)
                at_states[mine] += shares @ p["ww"][c].T
        return out, at_states

    def gradient(self, inputs: np.ndarray, fresh: np.ndarray, targets: np.ndarray, used: np.ndarray, h: np.ndarray):
        """(loss, tokens, gradients, last states) of one window; ``used`` marks real tokens."""
        steps, lanes = inputs.shape
        n = self.hidden
        states, last, (gates, before, inner) = self.forward(inputs, fresh, h, keep=True)
        grads: dict[str, np.ndarray] = {}
        at = np.flatnonzero(used.ravel())
        logs, at_states = self.log_probs(states.reshape(-1, n)[at], targets.ravel()[at], grads)
        down = np.zeros((steps * lanes, n), FLOAT)
        down[at] = at_states
        # Lanes last, as in ``forward``.
        down = np.ascontiguousarray(down.reshape(steps, lanes, n).transpose(0, 2, 1))
        z, r, c = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        shut, to_c, kept, open_ = before - c, 1 - c * c, 1 - z, 1 - r
        u_t = self.params["u"].T.copy()
        restart = fresh.any(axis=1)
        at_gates = np.empty((steps, 3 * n, lanes), FLOAT)
        at_a = np.empty((steps, 3 * n, lanes), FLOAT)
        carried = np.zeros((n, lanes), FLOAT)
        for t in range(steps - 1, -1, -1):
            d = down[t]
            d += carried
            to_z, to_r, dc = at_gates[t, :n], at_gates[t, n : 2 * n], at_gates[t, 2 * n :]
            np.multiply(d, kept[t], out=dc)
            dc *= to_c[t]
            np.multiply(d, shut[t], out=to_z)
            to_z *= z[t]
            to_z *= kept[t]
            np.multiply(dc, inner[t], out=to_r)
            to_r *= r[t]
            to_r *= open_[t]
            at_a[t, : 2 * n] = at_gates[t, : 2 * n]
            np.multiply(dc, r[t], out=at_a[t, 2 * n :])
            d *= z[t]
            carried = (np.ascontiguousarray(at_a[t].T) @ u_t).T + d
            if restart[t]:
                carried[:, fresh[t]] = 0
        rows = lambda x: x.transpose(0, 2, 1).reshape(steps * lanes, -1)
        grads["u"] = rows(before).T @ rows(at_a)
        flat, words = rows(at_gates), inputs.ravel()
        order = np.argsort(words.astype(np.uint16 if self.opening < 1 << 16 else np.int64), kind="stable")
        first = np.flatnonzero(np.diff(words[order], prepend=-1))
        grads["x"] = np.zeros_like(self.params["x"])
        grads["x"][words[order][first]] = np.add.reduceat(flat[order], first, axis=0)
        return -float(logs.sum()), len(at), grads, last


class Adam:
    def __init__(self, net: Net, rate: float):
        self.net, self.rate, self.turn = net, rate, 0
        self.mean = {k: np.zeros_like(p) for k, p in net.params.items()}
        self.square = {k: np.zeros_like(p) for k, p in net.params.items()}

    def step(self, grads: dict[str, np.ndarray], tokens: int) -> None:
        self.turn += 1
        scale = FLOAT(1 / max(tokens, 1))
        scaled = (g.ravel() * scale for g in grads.values())
        norm = np.sqrt(sum(float(g @ g) for g in scaled))
        scale *= FLOAT(min(1.0, 1.0 / max(norm, 1e-12)))
        rate = self.rate * np.sqrt(1 - 0.999**self.turn) / (1 - 0.9**self.turn)
        for k, g in grads.items():
            g = g * scale
            self.mean[k] += FLOAT(0.1) * (g - self.mean[k])
            self.square[k] += FLOAT(0.001) * (g * g - self.square[k])
            self.net.params[k] -= FLOAT(rate) * self.mean[k] / (np.sqrt(self.square[k]) + FLOAT(1e-8))


class Lanes:
    """Texts fed side by side in windows. A lane takes the next text where its last one ends, so lanes stay full and a
    text of any length passes through with its state carried from window to window."""

    def __init__(self, texts: Iterator[tuple[object, np.ndarray]], lanes: int, steps: int, opening: int):
        self.texts, self.steps, self.opening = texts, steps, opening
        self.current: list[tuple[object, np.ndarray, int] | None] = [None] * lanes

    def windows(self, ended: Callable[[object], None] | None = None):
        """(inputs, fresh, targets, used, owner per token as an index into keys, keys); keys end when their text does."""
        lanes, steps = len(self.current), self.steps
        while True:
            inputs = np.full((steps, lanes), self.opening, dtype=np.int64)
            fresh = np.zeros((steps, lanes), dtype=bool)
            targets = np.zeros((steps, lanes), dtype=np.int64)
            owner = np.full((steps, lanes), -1, dtype=np.int64)
            keys: list[object] = []
            done: list[object] = []
            for lane in range(lanes):
                t = 0
                while t < steps:
                    if self.current[lane] is None:
                        key, words = next(self.texts, (None, None))
                        if words is None:
                            break
                        self.current[lane] = (key, words, 0)
                    key, words, at = self.current[lane]
                    n = min(steps - t, len(words) - at)
                    targets[t : t + n, lane] = words[at : at + n]
                    if at:
                        inputs[t : t + n, lane] = words[at - 1 : at + n - 1]
                    else:
                        fresh[t, lane] = True
                        inputs[t + 1 : t + n, lane] = words[: n - 1]
                    owner[t : t + n, lane] = len(keys)
                    keys.append(key)
                    t, at = t + n, at + n
                    if at == len(words):
                        done.append(key)
                        self.current[lane] = None
                    else:
                        self.current[lane] = (key, words, at)
            if not keys:
                return
            yield inputs, fresh, targets, owner, keys
            if ended is not None:
                for key in done:
                    ended(key)


def train(net: Net, texts: Iterator[np.ndarray], lanes: int, steps: int, rate: float) -> int:
    """One pass over texts of word numbers; the tokens seen."""
    adam, seen = Adam(net, rate), 0
    h = np.zeros((lanes, net.hidden), FLOAT)
    for inputs, fresh, targets, owner, _ in Lanes(((None, w) for w in texts), lanes, steps, net.opening).windows():
        _, tokens, grads, h = net.gradient(inputs, fresh, targets, owner >= 0, h)
        adam.step(grads, tokens)
        seen += tokens
    return seen


def score(net: Net, texts: Iterator[tuple[object, np.ndarray]], lanes: int, steps: int) -> Iterator[tuple[object, float]]:
    """(key, natural log-probability) of every text, given as word numbers, as texts end."""
    h = np.zeros((lanes, net.hidden), FLOAT)
    total: dict[object, float] = {}
    done: list[object] = []
    for inputs, fresh, targets, owner, keys in Lanes(texts, lanes, steps, net.opening).windows(done.append):
        yield from ((key, total.pop(key)) for key in done)
        done.clear()
        states, h, _ = net.forward(inputs, fresh, h)
        at = np.flatnonzero(owner.ravel() >= 0)
        logs, _ = net.log_probs(states.reshape(-1, net.hidden)[at], targets.ravel()[at])
        sums = np.bincount(owner.ravel()[at], weights=logs, minlength=len(keys))
        for key, value in zip(keys, sums, strict=True):
            total[key] = total.get(key, 0.0) + float(value)
    yield from ((key, total.pop(key)) for key in done)
