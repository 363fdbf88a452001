"""Op 1: secret scans by grammar inference.

Three fixed patterns find the base spans. Their contents are labelled credentials; ordinary tokens beside them are
labelled as words. From a bounded sample of each, a prefix tree is built over classes of characters, and states whose
outgoing frequencies a Hoeffding bound cannot tell apart are merged (with all that follows from them), which gives one
probabilistic automaton per kind. Every token of ``LEAST`` characters or more that no base span touches is scored,
whatever its characters: the likelihood of its format under the best credential automaton against that under the
automaton of words. The margin alone decides, so letters that are as likely a word stay unmarked.

The sample: ``sample`` distinct values per kind, of smallest hash; words under ``LONG`` characters and longer ones are
sampled apart, as long tokens and the numbers among them are rare, and train one automaton. Batches leave all but their
own smallest out, which loses none of the smallest of all. Words that the first automata find more likely credentials
leave the sample, and the automaton of words is made again. A kind with under 5 labelled values must
stand out the more, by a margin that widens as they get fewer.

Defined results: null counts as empty; no spans give the digest of the empty string. Offsets are code points, ends
exclusive. Spans of the method have the kind "format" and come after the listed kinds. Without labelled credentials of
any kind nothing is added. Rows that repeat are scanned one for one; an empty table gives no rows; other columns are
not read. Patterns take linear time on long texts, and whether a
token touches a base span is a binary search.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import Scratch, Taken, caching, map_arrow, table, utf8

KINDS = ("assign", "access", "hex", "format")


def _either(word: str) -> str:
    """The word in either case, spelled out: the search then skips to its first letters."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Each name's first letter is looked for before the rest of it.
_NAMES = "|".join(f"(?<={_either(n[0])}){_either(n[1:])}" for n in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"[PpSsTtAa](?:{_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)".encode())
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")  # a shorter run holds no longer match
HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST = 8  # characters of a labelled value, and so of a candidate
LONG = 16
FEW = 5  # labelled values of a kind below which its margin widens
TOKEN = re.compile(rb"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{%d,}" % LEAST)


def code_points(text: bytes, at: Iterable[int]) -> list[int]:
    """Byte offsets as code point offsets."""
    if text.isascii():
        return list(at)
    starts = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return starts[np.array(list(at), np.int64)].tolist()


def base_spans(text: bytes) -> list[tuple[str, int, int, bytes]]:
    """(kind, start, end, credential) in bytes."""
    out = [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST]
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]


def other_tokens(text: bytes, spans: list[tuple]) -> list[tuple[int, int]]:
    """Tokens of ``LEAST`` characters or more that no span touches; dots, dashes and the like at their ends don't count."""
    out, taken = [], Taken((s, e) for _, s, e, *_ in spans)
    for m in TOKEN.finditer(text):
        value = m[0].rstrip(b".-_/+")
        start = m.start() + len(value) - len(value.lstrip(b".-_/+"))
        end = m.start() + len(value)
        if end - start >= LEAST and not taken.touches(start, end):
            out.append((start, end))
    return out


#: Classes of characters by their first letter; the number of characters that share a class.
_CLASS = {c: "f" if c in "abcdef" else "l" if c.islower() else "U" if c.isupper() else "0" if c.isdigit() else c
          for c in map(chr, range(33, 127))}
_SHAPE = bytes(ord(_CLASS.get(chr(c), "?")) for c in range(256))  # classes are members of themselves
_SIZE = {k: float(sum(v == k for v in _CLASS.values())) for k in set(_CLASS.values())}


class Automaton:
    """A probabilistic automaton: per state the counts of next classes, of ends, and the next states."""

    END = ""

    def __init__(self, values: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.rest: dict[int, tuple[str, int]] = {}  # states of one value alone: it, and where they begin in it
        for v in values:
            self._add(0, "".join(_CLASS.get(c, "?") for c in v), 0)
        self.bound = float(np.sqrt(0.5 * np.log(2 / alpha)))
        self._merge_states()

    def _open(self, at: int) -> None:
        """Give a state of one value alone its count and next state."""
        if at in self.rest:
            classes, i = self.rest.pop(at)
            self.count[at] = {classes[i : i + 1]: 1}
            if i < len(classes):
                self.next[at] = {classes[i]: self._new(classes, i + 1)}

    def _new(self, classes: str, i: int) -> int:
        self.rest[len(self.next)] = classes, i
        self.next.append({})
        self.count.append({})
        return len(self.next) - 1

    def _add(self, at: int, classes: str, i: int) -> None:
        """Count a value from its place ``i`` and a state on. Where it leaves the known states, its rest is kept as one."""
        while True:
            self._open(at)
            c = classes[i : i + 1]
            self.count[at][c] = self.count[at].get(c, 0) + 1
            if c == self.END:
                return
            i += 1
            if c not in self.next[at]:
                self.next[at][c] = self._new(classes, i)
                return
            at = self.next[at][c]

    def _compatible(self, a: int, b: int) -> bool:
        """Whether counts of both, and of the states that follow, may come from one source."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if a in self.rest or b in self.rest:  # counts of 1 all the way: the bound is over any difference
                continue
            x, y = self.count[a], self.count[b]
            n, m = sum(x.values()), sum(y.values())
            if not n or not m:
                continue
            slack = self.bound * (n**-0.5 + m**-0.5)
            if any(abs(x.get(c, 0) / n - y.get(c, 0) / m) > slack for c in x.keys() | y.keys()):
                return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if b in self.rest:
                self._add(a, *self.rest[b])
                continue
            self._open(a)
            for c, k in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + k
            for c, child in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _merge_states(self) -> None:
        kept, seen = [0], {0}
        border = [(0, c) for c in sorted(self.next[0])]
        while border:
            parent, c = border.pop(0)
            state = self.next[parent].get(c)
            if state is None or state in seen:
                continue
            into = next((k for k in kept if self._compatible(k, state)), None)
            if into is None:
                kept.append(state)
                seen.add(state)
                border += [(state, x) for x in sorted(self.next[state])]
            else:
                self.next[parent][c] = into
                self._fold(into, state)
                border += [(into, x) for x in sorted(self.next[into]) if self.next[into][x] not in seen]
        self.states = len(kept)
        self.next = [self.next[i] if i in seen else {} for i in range(len(self.next))]
        self.count = [self.count[i] if i in seen else {} for i in range(len(self.count))]
        self.rest.clear()
        self.steps: dict[tuple[int, str], tuple[float, int]] = {}

    def _step(self, at: int, c: str) -> tuple[float, int]:
        """Log chance of a step, and where it leads."""
        n = sum(self.count[at].values())
        chance = float(np.log((self.count[at].get(c, 0) + 0.05) / (n + 1.0)) - np.log(_SIZE.get(c, 1.0)))
        got = self.steps[at, c] = chance, self.next[at].get(c, 0)
        return got

    def log_likelihood(self, value: str) -> float:
        """Of the string; unseen steps have a small chance, and lead back to the start."""
        at, total = 0, 0.0
        for c in [*(_CLASS.get(x, "?") for x in value), self.END]:
            chance, at = self.steps.get((at, c)) or self._step(at, c)
            total += chance
        return total


class Model:
    def __init__(self, values: dict[str, list[str]], margin: float = 12.0):
        """margin: log odds from which a token counts as a credential."""
        self.margin = margin
        self.kinds = {k: Automaton(v) for k, v in values.items() if k != "word" and v}
        # A format known from few values only must stand out the more.
        self.doubt = {k: margin * max(0, FEW - len(values[k])) / FEW for k in self.kinds}
        words = values.get("word", [])
        self.word = Automaton(words)
        # Words of the sample that are more likely credentials are just that, without a label; they would teach their format.
        self.word = Automaton([v for v in words if self.score(v) < 0])
        self.scores: dict[bytes, float] = {}

    def score(self, value: str) -> float:
        """Log odds of a credential's format against a word's."""
        if not self.kinds:
            return float("-inf")
        return max(a.log_likelihood(value) - self.doubt[k] for k, a in self.kinds.items()) - self.word.log_likelihood(value)

    def score_token(self, token: bytes) -> float:
        """The same; scores of usual shapes are kept, which most words share."""
        shape = token.translate(_SHAPE)
        got = self.scores.get(shape)
        if got is None:
            got = self.score(shape.decode())
            if len(shape) <= 64:
                if len(self.scores) > 300_000:
                    self.scores.clear()
                self.scores[shape] = got
        return got


def fit(docs: DataFrame, text: str = "text", sample: int = 400) -> Model:
    """Automata from a bounded sample: ``sample`` distinct values of each kind, whole."""
    sampled = ("assign", "access", "hex", "word", "long word")

    def order(value: bytes) -> tuple[int, bytes]:
        """As Spark orders by xxhash64(value), value."""
        h = xxhash.xxh64_intdigest(value, seed=42)
        return h - (h >> 63 << 64), value

    def label(batch):
        found = {k: set() for k in sampled}
        for t in utf8(batch, "t"):
            spans = base_spans(t)
            for kind, _, _, value in spans:
                found[kind].add(value)
            for s, e in other_tokens(t, spans):
                found["word" if e - s < LONG else "long word"].add(t[s:e])
        rows = [(k, v.decode()) for k, values in found.items() for v in heapq.nsmallest(sample, values, key=order)]
        return {"kind": [k for k, _ in rows], "value": [v for _, v in rows]}

    found = Scratch(docs.sparkSession).keep(map_arrow(docs.select(F.col(text).alias("t")), label, "kind string, value string").distinct())
    values = {k: [r.value for r in found.where(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
              for k in sampled}
    return Model(values | {"word": values.pop("word") + values.pop("long word")})


def find_secrets(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id") -> DataFrame:
    """A row per row of ``docs``: doc_id and spans (kind, start, end, score; base spans have no score), by start and kind."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batch):
        out, model = [], shared.value
        caching(model.scores.clear)
        for t in utf8(batch, "t"):
            spans = base_spans(t)
            rows = [(k, s, e, None) for k, s, e, _ in spans]
            for s, e in other_tokens(t, spans):
                score = model.score_token(t[s:e])
                if score >= model.margin:
                    rows.append(("format", s, e, score))
            if rows:
                starts, ends = code_points(t, [r[1] for r in rows]), code_points(t, [r[2] for r in rows])
                rows = sorted(((k, s, e, x) for (k, _, _, x), s, e in zip(rows, starts, ends, strict=True)), key=lambda r: (r[1], KINDS.index(r[0]), r[2]))
            out.append([{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in rows])
        return {"doc_id": batch.column("i"), "spans": out}

    return map_arrow(docs.select(F.col(id).alias("i"), F.col(text).alias("t")), scan,
                     "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def span_columns(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """doc_id, a count per base kind, the digest of the base spans, and all spans as one string."""
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    fixed = F.filter("spans", lambda x: x["score"].isNull())

    def number(kind: str):
        return F.size(F.filter(fixed, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in base]
    return found.select("doc_id", *counts, F.sha2(F.array_join(F.transform(fixed, text), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", text), ",").alias("spans"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return span_columns(find_secrets(docs, fit(docs)), ("assign", "access", "hex"))
