"""A character tagger in numpy: bidirectional LSTM with CRF transitions, its training from labelled spans, and batched decoding."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Outside, then begin and inside of each kind.
N_TAGS = 1 + 2 * len(KINDS)
#: Characters with a class of their own; others fall into digit, ASCII letter, other letter, white space, other. Class 0 is padding.
OWN = "@.-_+%()/:=\"',;#[]<>*"
N_CLASSES = 6 + len(OWN)


def char_classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = np.full(len(code), 5, np.int8)
    out[code > 127] = 3
    lower = code | 32
    out[(lower >= 97) & (lower <= 122) & (code < 128)] = 2
    out[(code >= 48) & (code <= 57)] = 1
    out[(code == 32) | ((code >= 9) & (code <= 13)) | (code == 160)] = 4
    for i, c in enumerate(OWN):
        out[code == ord(c)] = 6 + i
    return out


def allowed() -> np.ndarray:
    """Log scores that forbid an inside tag without its begin or inside tag before."""
    out = np.zeros((N_TAGS, N_TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = -1e4
        out[[inside - 1, inside], inside] = 0
    return out


FORBID = allowed()
FORBID_START = FORBID[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """Weights of both directions stand side by side: arrays have a leading axis of 2, and the backward one reads turned windows."""

    def __init__(self, hidden: int, seed: int) -> None:
        r = np.random.Generator(np.random.PCG64(seed))
        self.hidden = hidden
        self.p = {
            "input": r.normal(0, 0.3, (2, N_CLASSES, 4 * hidden)),
            "again": r.normal(0, 0.8 / np.sqrt(hidden), (2, hidden, 4 * hidden)),
            "out": r.normal(0, 0.3, (2, hidden, N_TAGS)),
            "bias": np.zeros(N_TAGS),
            "move": np.zeros((N_TAGS, N_TAGS)),
        }
        self.p["input"][:, :, hidden : 2 * hidden] += 1.0  # remember at first

    def _run(self, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (2, T, n, H) of windows of classes (n, T), and what the gradient needs."""
        n, length, h = *x.shape, self.hidden
        both = np.stack((x, x[:, ::-1]))
        state, cell = np.zeros((2, n, h), self.p["input"].dtype), np.zeros((2, n, h), self.p["input"].dtype)
        states, tape = np.empty((2, length, n, h), state.dtype), []
        for t in range(length):
            z = self.p["input"][np.array([[0], [1]]), both[:, :, t]] + state @ self.p["again"]
            i, f, o = (_sigmoid(z[..., k * h : (k + 1) * h]) for k in range(3))
            g = np.tanh(z[..., 3 * h :])
            before, last = cell, state
            cell = f * cell + i * g
            tc = np.tanh(cell)
            state = o * tc
            states[:, t] = state
            if keep:
                tape.append((i, f, o, g, before, last, tc, both[:, :, t]))
        return states, tape

    def scores(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, list]:
        """Emission scores (T, n, tags)."""
        states, tape = self._run(x, keep)
        return states[0] @ self.p["out"][0] + states[1, ::-1] @ self.p["out"][1] + self.p["bias"], states, tape

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        e, states, tape = self.scores(x, keep=True)
        length, n, _ = e.shape
        move = self.p["move"] + FORBID
        ahead, back = np.empty_like(e), np.zeros_like(e)
        ahead[0] = e[0] + FORBID_START
        for t in range(1, length):
            s = ahead[t - 1][:, :, None] + move
            top = s.max(axis=1)
            ahead[t] = top + np.log(np.exp(s - top[:, None]).sum(axis=1)) + e[t]
        for t in range(length - 2, -1, -1):
            s = move + (e[t + 1] + back[t + 1])[:, None]
            top = s.max(axis=2)
            back[t] = top + np.log(np.exp(s - top[:, :, None]).sum(axis=2))
        top = ahead[-1].max(axis=1)
        total = top + np.log(np.exp(ahead[-1] - top[:, None]).sum(axis=1))
        de = np.exp(ahead + back - total[None, :, None])
        rows = np.arange(n)
        gold = sum(e[t, rows, y[:, t]] for t in range(length)) + sum(move[y[:, t - 1], y[:, t]] for t in range(1, length))
        dmove = np.zeros_like(move)
        for t in range(1, length):
            pair = ahead[t - 1][:, :, None] + move + (e[t] + back[t])[:, None] - total[:, None, None]
            dmove += np.exp(pair).sum(axis=0)
            np.add.at(dmove, (y[:, t - 1], y[:, t]), -1.0)
            de[t, rows, y[:, t]] -= 1
        de[0, rows, y[:, 0]] -= 1
        scale = 1.0 / n
        de *= scale
        h = self.hidden
        grad = {"bias": de.sum(axis=(0, 1)), "move": dmove * scale, "input": np.zeros_like(self.p["input"]), "again": np.zeros_like(self.p["again"])}
        turned = np.stack((de, de[::-1]))
        grad["out"] = np.einsum("dtnh,dtnk->dhk", states, turned)
        dh_all = np.einsum("dtnk,dhk->dtnh", turned, self.p["out"])
        dstate, dcell = np.zeros((2, n, h)), np.zeros((2, n, h))
        for t in range(length - 1, -1, -1):
            i, f, o, g, before, last, tc, c = tape[t]
            dh = dh_all[:, t] + dstate
            dc = dcell + dh * o * (1 - tc * tc)
            dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), axis=2)
            for d in range(2):
                np.add.at(grad["input"][d], c[d], dz[d])
            grad["again"] += last.transpose(0, 2, 1) @ dz
            dstate = dz @ self.p["again"].transpose(0, 2, 1)
            dcell = dc * f
        return float((total - gold).mean()), grad

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags (n, T) of windows, by Viterbi over all windows at once."""
        e, _, _ = self.scores(x)
        length, n, _ = e.shape
        move = (self.p["move"] + FORBID).astype(e.dtype)
        best, back = e[0] + FORBID_START.astype(e.dtype), np.empty((length, n, N_TAGS), np.int8)
        for t in range(1, length):
            s = best[:, :, None] + move
            back[t] = s.argmax(axis=1)
            best = np.take_along_axis(s, back[t][:, None].astype(np.int64), axis=1)[:, 0] + e[t]
        out = np.empty((n, length), np.int8)
        out[:, -1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = back[t][np.arange(n), out[:, t]]
        return out


_SYLLABLES = "an be cor de el fi gra ho in ka lo men nor os pri qua re sto tu ver wi ze ère ción ung the and".split()


def _word(r: np.random.Generator) -> str:
    w = "".join(r.choice(_SYLLABLES) for _ in range(r.integers(1, 4)))
    return w.capitalize() if r.random() < 0.15 else w


def _ascii(r: np.random.Generator) -> str:
    return _word(r).lower().encode("ascii", "ignore").decode() or "mail"


def _digits(r: np.random.Generator, n: int) -> str:
    return "".join(map(str, r.integers(0, 10, n)))


def _span(r: np.random.Generator, kind: str) -> str:
    if kind == "email":
        user = _ascii(r) + r.choice(["", ".", "_", "-"]) + r.choice(["", _ascii(r), _digits(r, 2), _digits(r, 4)])
        host = _ascii(r) + r.choice(["", _digits(r, 1), "-" + _ascii(r)])
        return f"{user.rstrip('._-')}{r.choice(['@', '@', '@', ' @ '])}{host}.{r.choice(['com', 'org', 'net', 'example.com', 'co.uk', 'de'])}"
    if kind == "ip":
        return ".".join(str(r.integers(0, 256)) for _ in range(4))
    if kind == "card":
        n = int(r.choice([14, 15, 16, 16, 16, 16, 19]))
        d, sep = _digits(r, n), str(r.choice(["", "", " ", "-", "."]))
        return sep.join(d[i : i + 4] for i in range(0, n, 4))
    a, b, c = _digits(r, 3), _digits(r, 3), _digits(r, 4)
    forms = (f"+1 ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{a[:2]} {b} {c} {a}", f"+1-{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{a[:2]}{b}{c}{a}")
    return str(r.choice(forms))


def _decoy(r: np.random.Generator) -> str:
    n = lambda k: _digits(r, int(k))
    forms = (
        f'token = "{"".join(r.choice(list("0123456789abcdef"), 40))}"', f"{r.integers(1, 9)}.{r.integers(0, 9)}", n(r.integers(1, 9)), f"20{n(2)}-0{r.integers(1, 9)}-1{n(1)}",
        f"20{n(2)}-0{r.integers(1, 9)}-1{n(1)} 1{n(1)}:{r.integers(10, 60)}:{r.integers(10, 60)}", f"${r.integers(1, 999)},{n(3)}.{n(2)}", f"version {r.integers(1, 9)}.{n(1)}.{n(1)}",
        f"#{n(5)}", f"{n(2)}%", f"({n(4)})", f"1{n(1)}:{r.integers(10, 60)}", f"@{_ascii(r)}", f"{_ascii(r)}{n(3)}", f"{n(1)}/{n(2)}", f"No. {n(6)}", n(r.integers(20, 30)),
    )
    return str(r.choice(forms))


def labelled(n: int, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``n`` windows cut from sentences with written spans and decoys: classes, tags, texts."""
    r = np.random.Generator(np.random.PCG64(seed))
    xs, ys, texts = np.zeros((n, length), np.int8), np.zeros((n, length), np.int8), []
    for row in range(n):
        text, tags = "", []
        aim, done = int(r.integers(0, length)), False
        while len(text) < 2 * length:
            # One span or decoy near a drawn place, and few others.
            kind = str(r.choice(["decoy", "decoy", *KINDS] if (now := not done and len(text) >= aim) or r.random() < 0.12 else ["word"]))
            done = done or now
            part = _word(r) if kind == "word" else _decoy(r) if kind == "decoy" else _span(r, kind)
            k = KINDS.index(kind) if kind in KINDS else -1
            text += part
            tags += [0] * len(part) if k < 0 else [1 + 2 * k] + [2 + 2 * k] * (len(part) - 1)
            gap = str(r.choice([" ", " ", " ", " ", ", ", ". ", "\n", "!! ", "%%% ", " | ", ".\n", "*** "]))
            text += gap
            tags += [0] * len(gap)
        at = int(r.integers(0, 12))
        y = np.array(tags[at : at + length], np.int8)
        if y[0] > 0 and y[0] % 2 == 0:  # what is left of a span cut by the edge counts as one; decoding drops spans at an edge
            y[0] -= 1
        texts.append(text[at : at + length])
        xs[row], ys[row] = char_classes(texts[-1]), y
    return xs, ys, texts


@lru_cache(maxsize=4)
def trained(length: int = 48, hidden: int = 16, rows: int = 2400, epochs: int = 10, batch: int = 32, seed: int = 11) -> Tagger:
    """A tagger trained with Adam on ``rows`` labelled windows, the bound of the training; the same for the same parameters."""
    x, y, _ = labelled(rows, length, seed)
    model = Tagger(hidden, seed)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    r, step, steps = np.random.Generator(np.random.PCG64(seed + 1)), 0, epochs * (rows // batch)
    for _ in range(epochs):
        order = r.permutation(rows)
        for i in range(0, rows - batch + 1, batch):
            pick = order[i : i + batch]
            _, grad = model.loss_and_gradient(x[pick], y[pick])
            step += 1
            norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
            rate = 0.012 * (1 - 0.9 * step / steps) * min(1.0, 5.0 / (norm + 1e-9))
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    model.p = {k: v.astype(np.float32) for k, v in model.p.items()}
    return model
