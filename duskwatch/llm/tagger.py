"""Character tagger: bidirectional LSTM with CRF transitions, in numpy.

``CharacterTagger.train`` learns from windows of text with labelled spans; ``decode`` gives
the spans of each window under the likeliest tag sequence.  All windows have ``WINDOW``
characters, shorter ones are padded, so batches are plain arrays.
"""

from __future__ import annotations

import numpy as np

WINDOW = 64
HIDDEN = 12
_SINGLE = "@._%+-() \n:/=,"  # characters with a class of their own
_CLASSES = 5 + len(_SINGLE)  # padding, lower, upper, digit, anything else, and those


def _class_table() -> np.ndarray:
    table = np.full(129, 4, dtype=np.int64)
    for low, high, number in (("a", "z", 1), ("A", "Z", 2), ("0", "9", 3)):
        table[ord(low) : ord(high) + 1] = number
    for i, character in enumerate(_SINGLE):
        table[ord(character)] = 5 + i
    return table


_TABLE = _class_table()


def encode(windows: list[str]) -> np.ndarray:
    """Character classes, one row per position and one column per window."""
    ids = np.zeros((WINDOW, len(windows)), dtype=np.int64)
    for i, window in enumerate(windows):
        points = np.frombuffer(window.encode("utf-32-le"), dtype=np.uint32)
        ids[: len(points), i] = _TABLE[np.minimum(points, 128)]
    return ids


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class CharacterTagger:
    """Tags are outside, and begin and inside for each of ``kinds``."""

    def __init__(self, kinds: tuple[str, ...], seed: int = 0) -> None:
        self.kinds, self.tags = kinds, 1 + 2 * len(kinds)
        draw = np.random.default_rng(seed).normal
        shape = {
            "xf": (_CLASSES, 4 * HIDDEN), "hf": (HIDDEN, 4 * HIDDEN),
            "xb": (_CLASSES, 4 * HIDDEN), "hb": (HIDDEN, 4 * HIDDEN),
            "out": (2 * HIDDEN, self.tags), "bias": (self.tags,), "step": (self.tags, self.tags),
        }
        self.p = {k: draw(0, 0.25, s).astype(np.float32) for k, s in shape.items()}
        self.trained = False
        # inside a kind comes only after begin or inside of it
        self.illegal = np.zeros((self.tags, self.tags), dtype=np.float32)
        for inside in range(2, self.tags, 2):
            self.illegal[:, inside] = -1e4
            self.illegal[[inside - 1, inside], inside] = 0

    # -- one direction of the LSTM

    def _run(self, ids: np.ndarray, x: str, h: str, keep: bool):
        wx, wh = self.p[x], self.p[h]
        count, n = ids.shape
        hidden = np.zeros((n, HIDDEN), dtype=np.float32)
        cell = np.zeros_like(hidden)
        outputs = np.empty((count, n, HIDDEN), dtype=np.float32)
        tape = []
        for t in range(count):
            z = wx[ids[t]] + hidden @ wh
            gates = _sigmoid(z[:, : 3 * HIDDEN])  # input, forget, output
            fresh = np.tanh(z[:, 3 * HIDDEN :])
            before, previous = cell, hidden
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            cell = f * cell + i * fresh
            squashed = np.tanh(cell)
            hidden = o * squashed
            outputs[t] = hidden
            if keep:
                tape.append((i, f, o, fresh, before, previous, squashed))
        return outputs, tape

    def _run_back(self, ids, tape, given, x: str, h: str, grads: dict) -> None:
        wh = self.p[h]
        gx, gh = np.zeros_like(self.p[x]), np.zeros_like(wh)
        dh = np.zeros_like(given[0])
        dc = np.zeros_like(dh)
        for t in range(len(ids) - 1, -1, -1):
            i, f, o, fresh, before, previous, squashed = tape[t]
            dh = dh + given[t]
            dc = dc + dh * o * (1 - squashed**2)
            dz = np.concatenate(
                (
                    dc * fresh * i * (1 - i),
                    dc * before * f * (1 - f),
                    dh * squashed * o * (1 - o),
                    dc * i * (1 - fresh**2),
                ),
                axis=1,
            )
            np.add.at(gx, ids[t], dz)
            gh += previous.T @ dz
            dh, dc = dz @ wh.T, dc * f
        grads[x], grads[h] = gx, gh

    def _emissions(self, ids: np.ndarray, keep: bool = False):
        ahead, tape_f = self._run(ids, "xf", "hf", keep)
        behind, tape_b = self._run(ids[::-1], "xb", "hb", keep)
        both = np.concatenate((ahead, behind[::-1]), axis=2)
        return both @ self.p["out"] + self.p["bias"], both, tape_f, tape_b

    # -- training

    def _gradients(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
        e, both, tape_f, tape_b = self._emissions(ids, keep=True)
        count, n, k = e.shape
        step = self.p["step"] + self.illegal
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, count):
            alpha[t] = e[t] + _logsumexp(alpha[t - 1][:, :, None] + step, 1)
        for t in range(count - 2, -1, -1):
            beta[t] = _logsumexp(step + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[-1], 1)
        de = np.exp(alpha + beta - total[:, None])
        pairs = np.zeros((k, k), dtype=np.float64)
        for t in range(1, count):
            joint = alpha[t - 1][:, :, None] + step + (e[t] + beta[t])[:, None, :]
            pairs += np.exp(joint - total[:, None, None]).sum(0)
        rows, columns = np.indices(gold.shape)
        score = e[rows, columns, gold].sum(0) + step[gold[:-1], gold[1:]].sum(0)
        de[rows, columns, gold] -= 1
        np.subtract.at(pairs, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        de /= n
        flat, top = both.reshape(-1, 2 * HIDDEN), de.reshape(-1, k)
        grads = {"out": flat.T @ top, "bias": top.sum(0), "step": pairs / n}
        given = de @ self.p["out"].T
        self._run_back(ids, tape_f, given[:, :, :HIDDEN], "xf", "hf", grads)
        self._run_back(ids[::-1], tape_b, given[::-1, :, HIDDEN:], "xb", "hb", grads)
        return float((total - score).mean()), grads

    def train(
        self,
        windows: list[str],
        spans: list[list[tuple[str, int, int]]],
        *,
        steps: int = 300,
        batch: int = 64,
        rate: float = 0.02,
        seed: int = 0,
    ) -> list[float]:
        """Adam on windows with their spans (kind, start, end); returns the loss of each step."""
        ids = encode(windows)
        gold = np.zeros_like(ids)
        for column, found in enumerate(spans):
            for kind, start, end in found:
                begin = 1 + 2 * self.kinds.index(kind)
                gold[start, column] = begin
                gold[start + 1 : end, column] = begin + 1
        order, losses = np.random.default_rng(seed), []
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        waiting = np.empty(0, dtype=np.int64)
        for turn in range(1, steps + 1 if windows else 1):
            if not len(waiting):
                waiting = order.permutation(len(windows))
            chosen, waiting = waiting[:batch], waiting[batch:]
            loss, grads = self._gradients(ids[:, chosen], gold[:, chosen])
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = (g * min(1.0, 5 / max(size, 1e-9))).astype(np.float32)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                m, v = first[k] / (1 - 0.9**turn), second[k] / (1 - 0.99**turn)
                self.p[k] -= rate * (1 - turn / (steps + 1)) * m / (np.sqrt(v) + 1e-6)
            losses.append(loss)
        self.trained = bool(len(windows))
        return losses

    # -- decoding

    def decode(self, windows: list[str], chunk: int = 512) -> list[list[tuple[str, int, int]]]:
        """Spans of each window; a window without any gives an empty list."""
        out: list[list[tuple[str, int, int]]] = []
        for at in range(0, len(windows), chunk):
            part = windows[at : at + chunk]
            for window, tags in zip(part, self._likeliest(encode(part)).T.tolist()):
                out.append(self._spans(tags[: len(window)]))
        return out

    def _likeliest(self, ids: np.ndarray) -> np.ndarray:
        e = self._emissions(ids)[0]
        step = (self.p["step"] + self.illegal).T  # to, from
        best, came = e[0], []
        for t in range(1, len(e)):
            through = best[:, None, :] + step
            came.append(through.argmax(2))
            best = e[t] + through.max(2)
        tags = np.empty(ids.shape, dtype=np.int64)
        tags[-1] = best.argmax(1)
        every = np.arange(ids.shape[1])
        for t in range(len(e) - 2, -1, -1):
            tags[t] = came[t][every, tags[t + 1]]
        return tags

    def _spans(self, tags: list[int]) -> list[tuple[str, int, int]]:
        found, open_ = [], None
        for at, tag in enumerate([*tags, 0]):
            if open_ is not None and (tag == 0 or tag % 2):
                found.append((self.kinds[(tags[open_] - 1) // 2], open_, at))
                open_ = None
            if tag % 2:
                open_ = at
        return found
