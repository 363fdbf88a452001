"""Op 6: personal data by a character-level bidirectional LSTM with CRF transitions, in numpy.

Four fixed patterns find the base spans. Windows around a bounded sample of them are the labelled spans that the
network is trained on, beside windows with digits or "@" that hold none. A text is cut into windows that overlap by
half; every window with a digit or "@" is scored (no other can hold any of the kinds), the emissions of overlapping
windows are blended, each weighing most in its middle, and a run of windows is decoded as one by the CRF: a span across
a window's end comes out whole. Decoded spans that touch no base span and pass their kind's check are added.

The sample: ``sample`` windows per kind and as many without, of smallest hash, collected as text of a window each.

Defined results: null counts as empty; no spans give the digest of the empty string. Offsets are code points, ends
exclusive. Added spans have the same kinds. Rows that repeat are scanned one for one; an empty table gives no rows, and
nothing is trained without base spans (then nothing is added). Other columns are not read. Patterns take linear time,
and long texts are scored in pieces of a bounded number of windows.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import Scratch, Taken, map_arrow, table, utf8
from asofkit.llm.secret_scan import code_points, span_columns

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
OVERLAP = 4  # windows that two pieces of a long run share
LABELS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind
_TRIGGER = re.compile(rb"[0-9@]")
_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match never begins inside of a run of digits
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: bytes) -> bool:
    d = [x - 48 for x in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def holds(kind: str, value: bytes) -> bool:
    """What a span of the kind must fulfil."""
    digits = bytes(c for c in value if 48 <= c <= 57)
    if kind == "email":
        return b"@" in value[1:] and b"." in value.partition(b"@")[2]
    if kind == "ip":
        parts = value.split(b".")
        return len(parts) == 4 and all(p.isdigit() and int(p[:9]) <= 255 and len(p) < 10 for p in parts)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes."""
    out, last, at = [], 0, text.find(b"@")
    while at >= 0:  # from each "@" back over its local part, so that long words cost no more than their length
        part = text[last:at]
        start = last + len(part.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
        last = domain.end() if domain else at + 1
        at = text.find(b"@", last)
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(int(p.lstrip(b"0")[:4] or b"0") <= 255 for p in m[0].split(b"."))]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if holds("card", m[0])]
    return out + [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if holds("phone", m[0])]


_CODES = np.where((np.arange(256) >= 32) & (np.arange(256) < 127), np.arange(256) - 30, 1)  # 0 pads, 1 is any other byte
SYMBOLS = 97


def codes(text: bytes) -> np.ndarray:
    return _CODES[np.frombuffer(text, np.uint8)]


def labels_of(spans: list[tuple[str, int, int]], start: int, end: int) -> np.ndarray:
    """Labels of the bytes start..end; a span cut by the window's start goes on there."""
    out = np.zeros(end - start, np.int64)
    for kind, s, e in spans:
        if s < end and e > start:
            k = 1 + 2 * KINDS.index(kind)
            out[max(s, start) - start : min(e, end) - start] = k + 1
            if s >= start:
                out[s - start] = k
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Embedding, an LSTM in each direction, a linear layer, and CRF transitions."""

    def __init__(self, size: int = 12, hidden: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {"emb": r.normal(0, 0.3, (SYMBOLS, size)), "out": r.normal(0, 0.3, (2 * hidden, LABELS)), "bias": np.zeros(LABELS),
                  "trans": np.zeros((LABELS, LABELS)), "first": np.zeros(LABELS)}
        for d in "fb":
            self.p[f"x{d}"] = r.normal(0, 0.3, (size, 4 * hidden))
            self.p[f"h{d}"] = r.normal(0, 0.3, (hidden, 4 * hidden))
            self.p[f"c{d}"] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)])
        # Inside may only follow begin or inside of its kind.
        self.allowed = np.array([[b == 0 or b % 2 == 1 or a in (b, b - 1) for b in range(LABELS)] for a in range(LABELS)])

    def _lstm(self, x: np.ndarray, d: str):
        """x: batch, time, size; gives the hidden states and what the gradient needs."""
        n, t, h = len(x), x.shape[1], self.hidden
        pre = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        out, cells, gates = np.zeros((n, t, h)), np.zeros((n, t, h)), np.zeros((n, t, 4 * h))
        a, c = np.zeros((n, h)), np.zeros((n, h))
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = pre[:, i] + a @ self.p[f"h{d}"]
            g = np.concatenate([_sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h :])], 1)  # forget, input, output, candidate
            c = g[:, :h] * c + g[:, h : 2 * h] * g[:, 3 * h :]
            a = g[:, 2 * h : 3 * h] * np.tanh(c)
            out[:, i], cells[:, i], gates[:, i] = a, c, g
        return out, cells, gates

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Emissions of many windows, in single precision; what goes into the gates is one table row per symbol."""
        n, t, h = len(x), x.shape[1], self.hidden
        both = np.empty((n, t, 2 * h), np.float32)
        with np.errstate(over="ignore"):
            for d, order in (("f", range(t)), ("b", range(t - 1, -1, -1))):
                table = (self.p["emb"] @ self.p[f"x{d}"] + self.p[f"c{d}"]).astype(np.float32)
                again = self.p[f"h{d}"].astype(np.float32)
                a, c = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
                for i in order:
                    z = table[x[:, i]] + a @ again
                    g = 1 / (1 + np.exp(-z[:, : 3 * h]))  # forget, input, output
                    c = g[:, :h] * c + g[:, h : 2 * h] * np.tanh(z[:, 3 * h :])
                    a = g[:, 2 * h :] * np.tanh(c)
                    both[:, i, h * (d == "b") : h * (1 + (d == "b"))] = a
        return both @ self.p["out"].astype(np.float32) + self.p["bias"].astype(np.float32)

    def _forward(self, x: np.ndarray):
        e = self.p["emb"][x]
        f, b = self._lstm(e, "f"), self._lstm(e, "b")
        both = np.concatenate([f[0], b[0]], 2)
        em = both @ self.p["out"] + self.p["bias"]
        return em, (e, f, b, both)

    def _scores(self):
        return np.where(self.allowed, self.p["trans"], -1e4), np.where(np.arange(LABELS) >= 0, self.p["first"], 0)

    def _crf(self, em: np.ndarray, y: np.ndarray):
        """Loss, and gradients of emissions, transitions and first scores, by forward and backward sums."""
        n, t, _ = em.shape
        trans, first = self._scores()
        alpha, beta = np.zeros_like(em), np.zeros_like(em)
        lse = lambda v, ax: np.log(np.exp(v - (m := v.max(ax, keepdims=True))).sum(ax)) + np.squeeze(m, ax)
        alpha[:, 0] = first + em[:, 0]
        for i in range(1, t):
            alpha[:, i] = lse(alpha[:, i - 1][:, :, None] + trans, 1) + em[:, i]
        for i in range(t - 2, -1, -1):
            beta[:, i] = lse(trans + (em[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
        z = lse(alpha[:, -1], 1)
        g_em = np.exp(alpha + beta - z[:, None, None])
        g_tr = np.zeros_like(trans)
        for i in range(1, t):
            g_tr += np.exp(alpha[:, i - 1][:, :, None] + trans + (em[:, i] + beta[:, i])[:, None, :] - z[:, None, None]).sum(0)
        rows, steps = np.arange(n)[:, None], np.arange(t)
        gold = em[rows, steps, y].sum(1) + first[y[:, 0]] + trans[y[:, :-1], y[:, 1:]].sum(1)
        g_first = g_em[:, 0].sum(0) - np.bincount(y[:, 0], minlength=LABELS)
        g_em[rows, steps, y] -= 1
        np.add.at(g_tr, (y[:, :-1], y[:, 1:]), -1)
        return float((z - gold).sum()), g_em, np.where(self.allowed, g_tr, 0), g_first

    def _back(self, d: str, e, state, g_out, grads):
        out, cells, gates = state
        n, t, h = out.shape
        order = range(t - 1, -1, -1) if d == "f" else range(t)
        step = -1 if d == "f" else 1
        dz = np.zeros_like(gates)
        da, dc = np.zeros((n, h)), np.zeros((n, h))
        for i in order:
            g, c = gates[:, i], np.tanh(cells[:, i])
            prev = i + step
            before = cells[:, prev] if 0 <= prev < t else 0.0
            da = da + g_out[:, i]
            dc = dc + da * g[:, 2 * h : 3 * h] * (1 - c * c)
            dz[:, i, :h] = dc * before * g[:, :h] * (1 - g[:, :h])
            dz[:, i, h : 2 * h] = dc * g[:, 3 * h :] * g[:, h : 2 * h] * (1 - g[:, h : 2 * h])
            dz[:, i, 2 * h : 3 * h] = da * c * g[:, 2 * h : 3 * h] * (1 - g[:, 2 * h : 3 * h])
            dz[:, i, 3 * h :] = dc * g[:, h : 2 * h] * (1 - g[:, 3 * h :] ** 2)
            if 0 <= prev < t:
                grads[f"h{d}"] += out[:, prev].T @ dz[:, i]
            da, dc = dz[:, i] @ self.p[f"h{d}"].T, dc * g[:, :h]
        flat = dz.reshape(-1, 4 * h)
        grads[f"x{d}"] += e.reshape(-1, e.shape[2]).T @ flat
        grads[f"c{d}"] += flat.sum(0)
        return dz @ self.p[f"x{d}"].T

    def loss(self, x: np.ndarray, y: np.ndarray):
        em, (e, f, b, both) = self._forward(x)
        loss, g_em, g_tr, g_first = self._crf(em, y)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["trans"], grads["first"], grads["bias"] = g_tr, g_first, g_em.sum((0, 1))
        grads["out"] = both.reshape(-1, both.shape[2]).T @ g_em.reshape(-1, LABELS)
        g = g_em @ self.p["out"].T
        ge = self._back("f", e, f, g[:, :, : self.hidden], grads) + self._back("b", e, b, g[:, :, self.hidden :], grads)
        np.add.at(grads["emb"], x, ge)
        return loss, grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Tagger:
        """Adam on random batches."""
        m, s = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        r = np.random.default_rng(seed)
        for t in range(1, steps + 1):
            rows = r.integers(0, len(x), min(batch, len(x)))
            _, grads = self.loss(x[rows], y[rows])
            for k, g in grads.items():
                g = np.clip(g / len(rows), -1, 1)
                m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.999 * s[k] + 0.001 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def decode(self, runs: list[np.ndarray], together: int = 512) -> list[np.ndarray]:
        """The best labels of each run of emissions; runs of like length are decoded side by side."""
        trans, first = (v.astype(np.float32) for v in self._scores())
        out: list = [None] * len(runs)
        order, at = sorted(range(len(runs)), key=lambda r: len(runs[r])), 0
        while at < len(order):
            some = [r for r in order[at : at + together] if len(runs[r]) <= 2 * len(runs[order[at]])]
            at += len(some)
            size = np.array([len(runs[r]) for r in some])
            em = np.zeros((len(some), size[-1], LABELS), np.float32)
            for k, r in enumerate(some):
                em[k, : size[k]] = runs[r]
            best, back = first + em[:, 0], np.empty((size[-1], len(some), LABELS), np.int8)
            stay = np.arange(LABELS, dtype=np.int8)
            for i in range(1, size[-1]):
                score = best[:, :, None] + trans
                ended = (size <= i)[:, None]
                back[i] = np.where(ended, stay, score.argmax(1))
                best = np.where(ended, best, score.max(1) + em[:, i])
            labels, rows = np.empty((len(some), size[-1]), np.int64), np.arange(len(some))
            labels[:, -1] = best.argmax(1)
            for i in range(size[-1] - 1, 0, -1):
                labels[:, i - 1] = back[i][rows, labels[:, i]]
            for k, r in enumerate(some):
                out[r] = labels[k, : size[k]]
        return out


def window_starts(text: bytes) -> list[int]:
    """Windows, half over half, that hold a digit or an "@"."""
    starts = set()
    for m in _TRIGGER.finditer(text):
        k = m.start() // STRIDE
        starts.update((k * STRIDE, max(k - 1, 0) * STRIDE))
    return sorted(starts)


_EDGE = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)[:, None]


def _blended(text: bytes, starts: list[int], em: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(start, emissions) of each run of windows that touch."""
    out, i = [], 0
    while i < len(starts):
        j = i
        while j + 1 < len(starts) and starts[j + 1] - starts[j] <= STRIDE:
            j += 1
        first = starts[i]
        total, seen = np.zeros((starts[j] + WINDOW - first, LABELS), np.float32), np.zeros((starts[j] + WINDOW - first, 1), np.float32)
        for k in range(i, j + 1):
            at = starts[k] - first
            total[at : at + WINDOW] += em[k] * _EDGE
            seen[at : at + WINDOW] += _EDGE
        out.append((first, (total / seen)[: min(starts[j] + WINDOW, len(text)) - first]))
        i = j + 1
    return out


def pieces_of(text: bytes, starts: list[int], windows: int) -> list[tuple[list[int], int, int]]:
    """The windows of a text in pieces of ``windows`` at most, and the part of the text each of them speaks for.

    A run of touching windows is one piece, so it is decoded as one; a longer one is cut into pieces that overlap by ``OVERLAP``
    windows, and one speaks up to the middle of the overlap, the next from there on.
    """
    out, i = [], 0
    while i < len(starts):
        low = 0 if i == 0 else starts[i]
        while i < len(starts):
            j = i
            while j + 1 < len(starts) and j + 1 - i < windows and starts[j + 1] - starts[j] <= STRIDE:
                j += 1
            whole = j + 1 == len(starts) or starts[j + 1] - starts[j] > STRIDE
            high = (len(text) if j + 1 == len(starts) else starts[j + 1]) if whole else starts[j - OVERLAP // 2]
            out.append((starts[i : j + 1], low, high))
            low, i = high, j + 1 if whole else j + 1 - OVERLAP
            if whole:
                break
    return out


def added_spans(texts: list[bytes], tagger: Tagger, bases: list[list[tuple[str, int, int]]], windows: int = 2048) -> list[list[tuple[str, int, int]]]:
    """The spans that the tagger adds to each text. Windows of many texts are scored side by side, at most twice ``windows`` at a time."""
    out: list[list] = [[] for _ in texts]
    taken = [Taken((a, b) for _, a, b in base) for base in bases]
    group, held = [], 0

    def close():
        x = np.zeros((held, WINDOW), np.int64)
        row = 0
        for t, starts, _, _ in group:
            for s in starts:
                piece = codes(texts[t][s : s + WINDOW])
                x[row, : len(piece)] = piece
                row += 1
        em = np.concatenate([tagger.emissions(x[i : i + 512]) for i in range(0, len(x), 512)])
        runs, row = [], 0
        for t, starts, low, high in group:
            runs += [(t, low, high, first, run) for first, run in _blended(texts[t], starts, em[row : row + len(starts)])]
            row += len(starts)
        for (t, low, high, first, _), labels in zip(runs, tagger.decode([run for *_, run in runs]), strict=True):
            for at in np.flatnonzero(labels % 2 == 1).tolist():
                stop = at + 1
                while stop < len(labels) and labels[stop] == labels[at] + 1:
                    stop += 1
                kind, s, e = KINDS[labels[at] // 2], first + at, first + stop
                if low <= s < high and holds(kind, texts[t][s:e]) and not taken[t].touches(s, e) and not (out[t] and s < out[t][-1][2]):
                    out[t].append((kind, s, e))

    for t, text in enumerate(texts):
        for piece in pieces_of(text, window_starts(text), windows):
            group.append((t, *piece))
            held += len(piece[0])
            if held >= windows:
                close()
                group, held = [], 0
    if group:
        close()
    return out


def fit(docs: DataFrame, text: str = "text", sample: int = 300, steps: int = 400) -> Tagger | None:
    """A tagger from a bounded sample of windows, or None without any base span."""
    def cut(batch):
        cols = {"kind": [], "window": [], "y": []}
        for t in utf8(batch, "t"):
            spans = base_spans(t)
            taken, longest = Taken((s, e) for _, s, e in spans), max((e - s for _, s, e in spans), default=0)
            ordered = sorted(spans, key=lambda x: x[1])
            for kind, s, e in spans:
                # The place of the span in its window differs from window to window, by the text before it.
                start = max(0, s - (s * 7 + e * 3) % 32)
                cols["kind"].append(kind)
                cols["window"].append(t[start : start + WINDOW])
                near = ordered[bisect_left(ordered, start - longest, key=lambda x: x[1]) : bisect_left(ordered, start + WINDOW, key=lambda x: x[1])]
                cols["y"].append(labels_of(near, start, start + WINDOW).tolist())
            for start in window_starts(t):
                if not taken.touches(start, start + WINDOW):
                    cols["kind"].append("none")
                    cols["window"].append(t[start : start + WINDOW])
                    cols["y"].append([0] * WINDOW)
        return cols

    found = Scratch(docs.sparkSession).keep(
        map_arrow(docs.select(F.col(text).alias("t")), cut, "kind string, window binary, y array<long>").dropDuplicates(["kind", "window"]))
    rows = [r for k in (*KINDS, "none") for r in found.where(F.col("kind") == k).orderBy(F.xxhash64("window"), "window", "y").limit(sample).collect()]
    if all(r.kind == "none" for r in rows):
        return None
    x = np.zeros((len(rows), WINDOW), np.int64)
    for i, r in enumerate(rows):
        piece = codes(bytes(r.window))
        x[i, : len(piece)] = piece
    return Tagger().fit(x, np.array([r.y for r in rows], np.int64), steps)


def find_personal_data(docs: DataFrame, tagger: Tagger | None, text: str = "text", id: str = "doc_id") -> DataFrame:
    """A row per row of ``docs``: doc_id and spans (kind, start, end, score: null for base spans, 1 for added ones)."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def scan(batch):
        out = []
        texts = utf8(batch, "t")
        bases = [base_spans(t) for t in texts]
        added = added_spans(texts, shared.value, bases) if shared.value else [[]] * len(texts)
        for t, base, more in zip(texts, bases, added, strict=True):
            rows = [(*b, None) for b in base] + [(*a, 1.0) for a in more]
            starts, ends = code_points(t, [r[1] for r in rows]), code_points(t, [r[2] for r in rows])
            rows = sorted(zip([r[0] for r in rows], starts, ends, [r[3] for r in rows], strict=True), key=lambda r: (KINDS.index(r[0]), r[1], r[2]))
            out.append([{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in rows])
        return {"doc_id": batch.column("i"), "spans": out}

    return map_arrow(docs.select(F.col(id).alias("i"), F.col(text).alias("t")), scan,
                     "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return span_columns(find_personal_data(docs, fit(docs)), KINDS)
