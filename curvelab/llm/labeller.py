"""A bidirectional LSTM over the blocks of a page, in numpy.

Every block is the mean of the vectors of its path names, the mean of the vectors of its hashed
words and a few numbers.  One LSTM reads the blocks forwards, one backwards; a logistic unit on
both states labels each block with the whole page in view.  Training is Adam with
back-propagation through time on padded batches.
"""

from __future__ import annotations

import math
import zlib

import numpy as np

NAMES, WORDS, NUMBERS = 2048, 4096, 6
#: Steps whose inputs are prepared together, and cells (pages x longest page) of a batch.
STEPS, BATCH_CELLS = 1024, 60_000

Block = tuple[tuple[str, ...], str, float]


def _code(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


class Vocabulary:
    """Hash codes, remembered for repeated names and words."""

    def __init__(self, size: int, most: int = 200_000):
        self.size, self.most, self.known = size, most, {}

    def codes(self, words) -> list[int]:
        known, out = self.known, []
        for w in words:
            c = known.get(w)
            if c is None:
                if len(known) > self.most:
                    known.clear()
                c = known[w] = _code(w, self.size)
            out.append(c)
        return out


_PATH_CODES, _WORD_CODES = Vocabulary(NAMES), Vocabulary(WORDS)


def encode_page(blocks: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Path codes, word codes and numbers of a page's blocks, all words of each block among them."""
    paths, words, numbers = [], [], np.zeros((len(blocks), NUMBERS))
    for i, (path, text, linked) in enumerate(blocks):
        # the path as a set, and its last elements once more as such
        paths.append(_PATH_CODES.codes(dict.fromkeys([*path, *("last:" + p for p in path[-3:])])) or [0])
        all_words = text.lower().split()
        words.append(_WORD_CODES.codes(all_words))
        marks = sum(text.count(c) for c in ".,;!?")
        numbers[i] = (
            math.log1p(len(text)) / 6,
            math.log1p(len(all_words)) / 4,
            linked,
            min(1.0, 10 * marks / len(text)),
            i / len(blocks),
            1.0 if text[-1] in ".!?" else 0.0,
        )
    return paths, words, numbers


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _batches(order: list[int], pages, most: int) -> list[list[int]]:
    """Pages of like length together, at most ``most`` and ``BATCH_CELLS`` cells (a longer page alone)."""
    out: list[list[int]] = []
    for k in order:
        if out and len(out[-1]) < most and (len(out[-1]) + 1) * len(pages[k][0]) <= BATCH_CELLS:
            out[-1].append(k)
        else:
            out.append([k])
    return out


class BlockLabeller:
    """Parameters and passes.  Batches are (time, page) matrices padded at the end."""

    def __init__(self, name_size: int = 12, word_size: int = 6, hidden: int = 12, seed: int = 11):
        rng = np.random.default_rng(seed)
        d = name_size + word_size + NUMBERS
        small = lambda *s: rng.normal(0, 0.1, s)
        self.p = {"names": small(NAMES, name_size), "words": small(WORDS, word_size), "out": small(2 * hidden), "bias": np.zeros(1)}
        for way in "fb":
            self.p[f"x{way}"] = small(d, 4 * hidden)
            self.p[f"h{way}"] = small(hidden, 4 * hidden)
            self.p[f"c{way}"] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)])  # open forget gates
        self.hidden, self.sizes = hidden, (name_size, word_size)

    # -- forward

    def _inputs(self, pages) -> tuple[np.ndarray, np.ndarray, list]:
        steps, count = max(len(p[0]) for p in pages), len(pages)
        x = np.zeros((steps, count, sum(self.sizes) + NUMBERS))
        live = np.zeros((steps, count))
        flat = {"names": ([], [], []), "words": ([], [], [])}
        for j, (paths, words, numbers) in enumerate(pages):
            live[: len(paths), j] = 1
            x[: len(paths), j, sum(self.sizes) :] = numbers
            for kind, lists in (("names", paths), ("words", words)):
                rows, codes, weights = flat[kind]
                for t, some in enumerate(lists):
                    rows += [t * count + j] * len(some)
                    codes += some
                    weights += [1 / len(some)] * len(some) if some else []
        bags = []
        at = 0
        for kind, size in zip(("names", "words"), self.sizes):
            rows, codes, weights = (np.array(v, k) for v, k in zip(flat[kind], (np.int64, np.int64, float)))
            bags.append((kind, rows, codes, weights, at, size))
            if len(rows):
                first = np.flatnonzero(np.diff(rows, prepend=-1))
                x.reshape(steps * count, -1)[rows[first], at : at + size] = np.add.reduceat(
                    self.p[kind][codes] * weights[:, None], first
                )
            at += size
        return x, live, bags

    def _run(self, way: str, x: np.ndarray, live: np.ndarray, keep: bool):
        steps, count, _ = x.shape
        n = self.hidden
        h, c = np.zeros((count, n)), np.zeros((count, n))
        states, memory = np.zeros((steps, count, n)), []
        for k, t in enumerate(range(steps) if way == "f" else range(steps - 1, -1, -1)):
            if k % STEPS == 0:  # the part that needs no state, for the next steps at once
                low = t if way == "f" else max(0, t + 1 - STEPS)
                pre = x[low : low + STEPS] @ self.p[f"x{way}"] + self.p[f"c{way}"]
            z = pre[t - low] + h @ self.p[f"h{way}"]
            gates = _sigmoid(z[:, : 3 * n])
            f, i, o, g = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :], np.tanh(z[:, 3 * n :])
            new = f * c + i * g
            tanh = np.tanh(new)
            on = live[t][:, None]
            if keep:
                memory.append((t, h, c, f, i, o, g, tanh, on))
            h, c = on * (o * tanh) + (1 - on) * h, on * new + (1 - on) * c
            states[t] = h
        return states, memory

    def _forward(self, pages, keep: bool):
        x, live, bags = self._inputs(pages)
        forward, memory_f = self._run("f", x, live, keep)
        backward, memory_b = self._run("b", x, live, keep)
        states = np.concatenate([forward, backward], axis=2)
        prob = _sigmoid(states @ self.p["out"] + self.p["bias"][0])
        return prob, live, x, bags, states, memory_f, memory_b

    def label(self, pages) -> list[np.ndarray]:
        """Probability of main text for every block of every page (pages without blocks: empty)."""
        out: list = [np.empty(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k][0]), key=lambda k: len(pages[k][0]))
        for some in _batches(order, pages, 256):
            prob = self._forward([pages[k] for k in some], False)[0]
            for j, k in enumerate(some):
                out[k] = prob[: len(pages[k][0]), j]
        return out

    # -- training

    def _backward(self, way: str, memory, d_states: np.ndarray, x: np.ndarray, grad: dict, d_x: np.ndarray) -> None:
        n = self.hidden
        d_h, d_c = np.zeros(d_states.shape[1:]), np.zeros(d_states.shape[1:])
        for t, h, c, f, i, o, g, tanh, on in reversed(memory):
            d_h = d_h + d_states[t]
            into, past = d_h * on, d_h * (1 - on)
            d_new = (d_c + 0) * on + into * o * (1 - tanh**2)
            d_z = np.concatenate(
                [d_new * c * f * (1 - f), d_new * g * i * (1 - i), into * tanh * o * (1 - o), d_new * i * (1 - g**2)], axis=1
            )
            grad[f"x{way}"] += x[t].T @ d_z
            grad[f"h{way}"] += h.T @ d_z
            grad[f"c{way}"] += d_z.sum(axis=0)
            d_x[t] += d_z @ self.p[f"x{way}"].T
            d_h = past + d_z @ self.p[f"h{way}"].T
            d_c = d_new * f + d_c * (1 - on)

    def gradients(self, pages, labels) -> tuple[float, dict]:
        """Mean log loss over the blocks and its gradients."""
        prob, live, x, bags, states, memory_f, memory_b = self._forward(pages, True)
        y = np.zeros_like(prob)
        for j, some in enumerate(labels):
            y[: len(some), j] = some
        total = live.sum()
        loss = -(live * (y * np.log(prob + 1e-12) + (1 - y) * np.log(1 - prob + 1e-12))).sum() / total
        d = live * (prob - y) / total
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["out"] += np.einsum("tcn,tc->n", states, d)
        grad["bias"] += d.sum()
        d_states = d[:, :, None] * self.p["out"]
        d_x = np.zeros_like(x)
        self._backward("f", memory_f, d_states[:, :, : self.hidden], x, grad, d_x)
        self._backward("b", memory_b, d_states[:, :, self.hidden :], x, grad, d_x)
        for kind, rows, codes, weights, at, size in bags:
            if len(rows):
                np.add.at(grad[kind], codes, d_x.reshape(len(d_x) * d_x.shape[1], -1)[rows, at : at + size] * weights[:, None])
        return float(loss), grad

    def fit(self, pages, labels, epochs: int = 6, batch: int = 32, rate: float = 0.02, seed: int = 13) -> list[float]:
        """Adam, the last third of the epochs at a fifth of the rate; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, step = [], 0
        groups = _batches(sorted(range(len(pages)), key=lambda k: len(pages[k][0])), pages, batch)
        for epoch in range(epochs):
            total = 0.0
            now = rate / 5 if 3 * epoch >= 2 * epochs else rate
            for g in rng.permutation(len(groups)):
                step += 1
                loss, grad = self.gradients([pages[k] for k in groups[g]], [labels[k] for k in groups[g]])
                total += loss
                for k, v in grad.items():
                    first[k] += 0.1 * (v - first[k])
                    second[k] += 0.001 * (v * v - second[k])
                    self.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            losses.append(total / max(1, len(groups)))
        return losses
