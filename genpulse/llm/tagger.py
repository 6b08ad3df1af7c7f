"""A character-level bidirectional LSTM with a linear-chain CRF, in numpy.

Small enough to be trained in seconds on the driver from labelled spans and to travel to the tasks
with their code. `labelled_texts` makes the spans: sentences of invented words in which addresses,
numbers and things that only look like them stand at known places.
"""

from __future__ import annotations

import random
import string
from functools import lru_cache

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Characters with a symbol of their own; other letters share one, and all the rest another.
CHARS = " \n" + string.ascii_letters + string.digits + string.punctuation
_VOCABULARY = len(CHARS) + 2
_CODE = np.full(128, _VOCABULARY - 1, dtype=np.int16)
_CODE[[ord(c) for c in CHARS]] = np.arange(len(CHARS))

#: Size of the model and of its training, all bounded parameters.
EMBED, HIDDEN, WINDOW, BATCH, STEPS, RATE, SEED = 12, 16, 96, 32, 400, 0.015, 7


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    out = np.full(len(points), _VOCABULARY - 2, dtype=np.int16)
    low = points < 128
    out[low] = _CODE[points[low]]
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


class Examples:
    """Labelled spans in invented prose, from a seed."""

    syllables = "the an en er on ti re th nd is or es ou in que la ment tion ver sch keit der das und los ción ez ué é ö ü ñ ll ga bo do".split()

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def pick(self, options):
        return options[int(self.rng.random() * len(options))]

    def digits(self, n: int) -> str:
        return str(self.rng.randrange(10**n)).zfill(n)

    def word(self) -> str:
        w = "".join(self.pick(self.syllables) for _ in range(self.rng.randint(1, 4)))
        w = w.capitalize() if self.rng.random() < 0.15 else w.upper() if self.rng.random() < 0.03 else w
        return w + self.pick(["", "", "", "", "", ",", ".", ".", "!", ":"])

    def name(self) -> str:
        return "".join(self.pick(list(string.ascii_lowercase)) for _ in range(self.rng.randint(2, 8)))

    def email(self) -> str:
        user = self.name() + self.pick(["", "." + self.name(), self.digits(2), "." + self.digits(2), "_" + self.name()])
        host, top = self.pick([self.name(), "mail" + self.digits(1), self.name() + "-" + self.name()]), self.pick(["com", "org", "net", "de", "fr", "io", "example.com", "co.uk"])
        at, dot = self.pick([("@", "."), ("@", "."), ("@", "."), (" [at] ", " [dot] "), ("[at]", "."), (" (at) ", "."), (" (at) ", " (dot) ")])
        return user + at + host + dot + top

    def ip(self) -> str:
        if self.rng.random() < 0.25:
            return ":".join(f"{self.rng.randint(1, 65535):x}" for _ in range(8))
        return ".".join(str(self.rng.randint(0, 255)) for _ in range(4))

    def card(self) -> str:
        body = self.pick(["4", "4", "5", "37", "6011"])
        body += self.digits((14 if body == "37" else 15) - len(body))
        number = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        sep = self.pick(["", "", " ", "-", "."])
        return sep.join(number[k : k + 4] for k in range(0, len(number), 4))

    def phone(self) -> str:
        a, b, c = self.digits(3), self.digits(3), self.digits(4)
        return self.pick([f"+{self.pick(['1', '44', '49', '33', '34'])} ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"+{self.digits(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{self.digits(12)}", f"+49.{a}.{b}.{c}"])

    def other(self) -> str:
        d = self.digits
        return self.pick([
            f"20{d(2)}-0{d(1)}-1{d(1)}", f"19{d(2)}", f"{d(1)}.{d(1)}", f"{d(1)}.{d(1)}.{d(1)}", f"v{d(1)}.{d(2)}.{d(1)}.{d(1)}", f"{d(2)}:{d(2)}", f"${d(2)}.{d(2)}", f"{d(3)},{d(3)}", f"#{d(5)}",
            "AKIA" + "".join(self.pick(list(string.ascii_uppercase + string.digits)) for _ in range(16)), "password=" + "".join(self.pick(list("0123456789abcdef")) for _ in range(18)),
            'token = "' + "".join(self.pick(list("0123456789abcdef")) for _ in range(40)) + '"', f"pp. {d(2)}-{d(3)}", f"{d(2)}%", d(1), d(3), d(8), d(20), f"{d(4)}/{d(2)}", "CC BY-NC 4.0", "@" + self.name(), f"{self.name()}{d(2)}", f"ISBN {d(3)}-{d(1)}-{d(5)}-{d(3)}-{d(1)}", f"{d(2)}.{d(2)}.20{d(2)}",
            "[at]", "(at)", "0x" + d(6), f"({d(1)})", f"- {d(1)}", f"{d(4)} {d(4)}",
        ])

    def text(self, length: int) -> tuple[str, np.ndarray]:
        """length characters and their tags."""
        parts, tags = [], []

        def add(s: str, kind: int | None = None) -> None:
            parts.append(s)
            if kind is None:
                tags.extend([0] * len(s))
            else:
                tags.extend([1 + 2 * kind] + [2 + 2 * kind] * (len(s) - 1))

        while len(tags) < 2 * length:
            roll = self.rng.random()
            if roll < 0.24:
                kind = self.rng.randrange(len(KINDS))
                add(getattr(self, KINDS[kind])(), kind)
                add(self.pick(["", "", "", ".", ",", ";"]))
            elif roll < 0.36:
                add(self.other())
            else:
                add(self.word())
            add(self.pick([" ", " ", " ", " ", " ", " ", "\n"]))
        at = self.rng.randrange(length)
        return "".join(parts)[at : at + length], np.array(tags[at : at + length], dtype=np.int8)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lstm(x: np.ndarray, w: dict, d: str, keep: bool = False):
    """(T, B, hidden) outputs of one direction over embedded input (T, B, embed); and what backward needs."""
    steps, batch, hidden = len(x), x.shape[1], w[f"u{d}"].shape[0]
    h, c = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
    gates = x.reshape(steps * batch, -1) @ w[f"w{d}"] + w[f"b{d}"]
    gates = gates.reshape(steps, batch, -1)
    out, saved = np.empty((steps, batch, hidden), np.float32), []
    for t in range(steps):
        z = gates[t] + h @ w[f"u{d}"]
        s = _sigmoid(z[:, : 3 * hidden])
        i, f, o, g = s[:, :hidden], s[:, hidden : 2 * hidden], s[:, 2 * hidden :], np.tanh(z[:, 3 * hidden :])
        c_new = f * c + i * g
        squashed = np.tanh(c_new)
        if keep:
            saved.append((i, f, o, g, c, squashed, h))
        h, c = o * squashed, c_new
        out[t] = h
    return out, saved


def _lstm_back(x, grad, saved, w: dict, d: str, into: dict) -> np.ndarray:
    u = w[f"u{d}"]
    dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    dz_all = np.empty((*grad.shape[:2], 4 * grad.shape[2]), np.float32)
    du = np.zeros_like(u)
    for t in range(len(grad) - 1, -1, -1):
        i, f, o, g, c, squashed, h = saved[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed**2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        dz_all[t] = dz
        du += h.T @ dz
        dh, dc = dz @ u.T, dc * f
    flat = dz_all.reshape(-1, dz_all.shape[2])
    into[f"u{d}"] = du
    into[f"w{d}"] = x.reshape(-1, x.shape[2]).T @ flat
    into[f"b{d}"] = flat.sum(0)
    return (flat @ w[f"w{d}"].T).reshape(x.shape)


def _forbidden() -> np.ndarray:
    """Added to the CRF's transitions: an inside tag follows only its own kind."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = -1e4
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return out


def _logsumexp(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def _crf_grads(e: np.ndarray, tags: np.ndarray, move: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood, and its gradients by emissions (T, B, tags) and transitions."""
    steps, batch, _ = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, steps):
        alpha[t] = e[t] + _logsumexp(alpha[t - 1][:, :, None] + move, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsumexp(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _logsumexp(alpha[-1], 1)
    here = np.arange(batch)
    grad_e = np.exp(alpha + beta - z[None, :, None])
    pair = np.exp(alpha[:-1, :, :, None] + move + (e[1:] + beta[1:])[:, :, None, :] - z[None, :, None, None])
    grad_move = pair.sum((0, 1))
    gold = e[np.arange(steps)[:, None], here, tags].sum(0) + move[tags[:-1], tags[1:]].sum(0)
    grad_e[np.arange(steps)[:, None], here, tags] -= 1
    np.subtract.at(grad_move, (tags[:-1], tags[1:]), 1)
    return float((z - gold).mean()), grad_e / batch, (grad_move / batch).astype(np.float32)


def emissions(x: np.ndarray, w: dict) -> np.ndarray:
    """(T, B, tags) scores of codes (T, B)."""
    embedded = w["embed"][x]
    ahead, _ = _lstm(embedded, w, "f")
    back, _ = _lstm(embedded[::-1], w, "r")
    return np.concatenate([ahead, back[::-1]], axis=2) @ w["out"] + w["bias"]


def viterbi(e: np.ndarray, w: dict) -> np.ndarray:
    """(T, B) best tags under the CRF."""
    move, (steps, batch, _) = w["move"] + _forbidden(), e.shape
    start = np.zeros(TAGS, np.float32)
    start[2::2] = -1e4
    score, came = e[0] + start, np.empty((steps, batch, TAGS), np.int8)
    for t in range(1, steps):
        options = score[:, :, None] + move
        came[t] = options.argmax(1)
        score = options.max(1) + e[t]
    out = np.empty((steps, batch), np.int8)
    out[-1] = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = came[t, np.arange(batch), out[t]]
    return out


def train(steps: int = STEPS, seed: int = SEED) -> dict:
    """Weights fitted by Adam on steps * BATCH windows of labelled text."""
    rng, examples = np.random.default_rng(seed), Examples(seed)
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"embed": init(_VOCABULARY, EMBED), "out": init(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
    for d in "fr":
        w |= {f"w{d}": init(EMBED, 4 * HIDDEN), f"u{d}": init(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN, np.float32)}
        w[f"b{d}"][HIDDEN : 2 * HIDDEN] = 1
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pairs = [examples.text(WINDOW) for _ in range(BATCH)]
        x, y = np.stack([codes(t) for t, _ in pairs], 1), np.stack([g for _, g in pairs], 1)
        embedded = w["embed"][x]
        ahead, kept_f = _lstm(embedded, w, "f", True)
        back, kept_r = _lstm(embedded[::-1], w, "r", True)
        hidden = np.concatenate([ahead, back[::-1]], axis=2)
        _, de, dmove = _crf_grads(hidden @ w["out"] + w["bias"], y, w["move"])
        g = {"move": dmove, "bias": de.sum((0, 1)), "out": hidden.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)}
        dh = de @ w["out"].T
        dx = _lstm_back(embedded, dh[:, :, :HIDDEN], kept_f, w, "f", g)
        dx = dx + _lstm_back(embedded[::-1], dh[::-1, :, HIDDEN:], kept_r, w, "r", g)[::-1]
        g["embed"] = np.zeros_like(w["embed"])
        np.add.at(g["embed"], x.ravel(), dx.reshape(-1, EMBED))
        norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in w:
            v = g[k] * min(1.0, 5 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.999 * second[k] + 0.001 * v * v
            w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return w


@lru_cache(maxsize=4)
def trained(steps: int = STEPS, seed: int = SEED) -> dict:
    """The same weights for the same parameters, fitted once in a process."""
    return train(steps, seed)
