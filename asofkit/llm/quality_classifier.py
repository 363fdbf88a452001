"""Op 4: a quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every text. How often each pattern of votes occurs is
counted over all documents (at most 3 ** labellers patterns, combined map-side); expectation-maximisation on these
counts estimates each labeller's accuracy and so each pattern's posterior, without any true label. A linear scorer over
hashed features (words, shapes of words, repeated words and lines) is then fitted to the posteriors of a bounded
sample, and judges every text. The scorer reads more than the labellers do, so it generalises over them.

The sample: at most ``sample`` distinct texts (fewer are all taken), each weighted by the rows that it stands for. It is a
priority sample: a text's chance grows with its number of copies, by a hash of the text, so one that many rows repeat is
in it with its own weight and others weigh alike. Their features travel to the driver as sparse counts, at most
``BUCKETS`` numbers per text, never the texts.

Defined results: a null or blank text has no features and no vote; it is kept (quality says nothing against it).
Rows that repeat are judged one for one; an empty table gives no rows. Other columns are carried whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import SPACES, Scratch, bounded, caching, map_arrow, table, thrifty, utf8
from asofkit.llm.quality_rules import repeated_words

BUCKETS = 1 << 14
_MARKS = b"#*$%&|<>=~^_\\"
_MARKED = re.compile(rb"[#*$%&<>=~^_\\]+(?=[\x20\x09-\x0D]|$)")
_UPPER, _LOWER, _ENDS = bytes(range(65, 91)), bytes(range(97, 123)), (b".", b"!", b"?", b":", b";", b'"')
GOOD, NONE, BAD = 1, 0, -1


def _number_of(chars: bytes, text: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def measures(text: bytes) -> tuple[list[bytes], list[bytes], dict[str, float]]:
    words = text.split()
    lines = [x for x in (y.strip(SPACES) for y in text.split(b"\n")) if x]
    n = max(len(words), 1)
    upper, lower, marks = (_number_of(x, text) for x in (_UPPER, _LOWER, _MARKS))
    counts = Counter(words)
    return words, lines, {
        "n": len(words),
        "marks": marks / n,
        "marked": (len(_MARKED.findall(text)) if marks else 0) / n,
        "caps": upper / max(upper + lower, 1),
        "again": repeated_words(words) / n,
        "top": max(counts.values(), default=0) / n,
        "same": sum(map(eq, words, islice(words, 1, None))) / n,
        "lines": 1 - len(set(lines)) / max(len(lines), 1),
        "ends": 1 - sum(x.endswith(_ENDS) for x in lines) / max(len(lines), 1),
        "shout": text.count(b"!!") / n,
        "bars": sum(counts.get(x, 0) for x in (b"|", b"||", b"-", b"*", b"\xe2\x80\xa2")) / n,
    }


def votes(m: dict[str, float]) -> list[int]:
    """The labellers. Each knows one defect or one sign of prose, and else says nothing; they overlap on purpose."""
    n = m["n"]
    bad = [
        n > 0 and m["marks"] >= 0.10,
        n > 0 and m["marked"] >= 0.20,
        m["caps"] >= 0.40,
        n >= 16 and m["again"] >= 0.30,
        n >= 10 and m["top"] >= 0.30,
        n >= 10 and m["same"] >= 0.10,
        n >= 10 and m["lines"] >= 0.40,
        n > 0 and m["shout"] >= 0.10,
        n >= 10 and m["bars"] >= 0.10,
        n >= 10 and m["ends"] >= 0.80,
    ]
    good = [
        n > 0 and m["marks"] < 0.03 and m["caps"] < 0.25 and m["shout"] < 0.02,
        n >= 10 and m["again"] < 0.10 and m["top"] < 0.20 and m["same"] < 0.05 and m["lines"] < 0.20,
        n > 0 and m["ends"] < 0.30 and m["bars"] < 0.02 and m["marked"] < 0.05,
    ]
    return [BAD if x else NONE for x in bad] + [GOOD if x else NONE for x in good]


LABELLERS = 13


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of "good" for each pattern. Two classes; each labeller has its own chance of each vote in each class.

    The start says only that labellers are right more often than not, which also names the classes.
    """
    onehot = np.stack([patterns == v for v in (BAD, NONE, GOOD)], 2).astype(float)  # pattern, labeller, vote
    chance = np.stack([np.tile([0.5, 0.3, 0.2], (patterns.shape[1], 1)), np.tile([0.1, 0.3, 0.6], (patterns.shape[1], 1))])
    prior = np.array([0.2, 0.8])
    for _ in range(rounds):
        log = np.log(prior)[:, None] + np.einsum("plv,clv->cp", onehot, np.log(chance))
        post = np.exp(log - log.max(0))
        post /= post.sum(0)
        weight = post * counts
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        chance = np.einsum("cp,plv->clv", weight, onehot) + 1.0
        chance /= chance.sum(2, keepdims=True)
        # No labeller is worse than a guess: a class keeps its name.
        flat = chance.mean(0)
        wrong = (chance[0, :, 0] < chance[1, :, 0]) | (chance[0, :, 2] > chance[1, :, 2])
        chance[:, wrong] = flat[wrong]
    return post[1]


#: Each byte's kind: A, a (other letters, and bytes of characters beyond ASCII), 0, or the byte itself.
_KIND = bytes(65 if c in _UPPER else 97 if c in _LOWER or c > 127 else 48 if 48 <= c < 58 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+")


class _Shapes(dict):
    """Bucket of the shape of a word of kinds (runs of a kind of character as one); far fewer than words."""

    def __missing__(self, kinds: bytes) -> int:
        import xxhash

        if len(self) > 50_000:
            self.clear()
        got = self[kinds] = xxhash.xxh3_64_intdigest(_RUN.sub(rb"\1", kinds)[:12], seed=1) % BUCKETS
        return got


_SHAPES = _Shapes()


class _Buckets(dict):
    """Two buckets of each word in one number: itself, and below it its shape."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word.lower()) % BUCKETS * BUCKETS + _SHAPES[word.translate(_KIND)]
        return got


_BUCKETS = _Buckets()


def features(words: list[bytes], m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values (length 1 in all) of a text."""
    import xxhash

    if not words:
        return np.empty(0, np.int64), np.empty(0)
    caching(_BUCKETS.clear)
    caching(_SHAPES.clear)
    pairs = np.divmod(np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words)), BUCKETS)
    marks = [xxhash.xxh3_64_intdigest(f"{k}:{int(10 * v)}".encode(), seed=2) % BUCKETS for k, v in m.items() if k != "n"]
    shapes, count = np.unique(pairs[1], return_counts=True)
    own, own_count = np.unique(pairs[0], return_counts=True)
    # Words, shapes and measures have a third of the length each, whatever their number.
    parts = [(own, np.log1p(own_count)), (shapes, count / len(words)), (np.array(marks), np.ones(len(marks)))]
    at = np.concatenate([a for a, _ in parts])
    return at, np.concatenate([v / np.sqrt(3 * (v * v).sum()) for _, v in parts])


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 200, decay: float = 1e-4,
               weight: np.ndarray | None = None) -> np.ndarray:
    """Logistic weights (the last is the bias) on soft targets, by full-batch Adam; ``weight`` of each row, else alike."""
    weights = np.zeros(BUCKETS + 1)
    if not rows:
        return weights
    share = np.full(len(rows), 1 / len(rows)) if weight is None else weight / weight.sum()
    doc = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    at, value = np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows])
    m, s = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(np.bincount(doc, value * weights[at], len(rows)) + weights[-1])))
        err = (p - target) * share
        grad = np.bincount(at, value * err[doc], BUCKETS + 1) + decay * weights
        grad[-1] += err.sum()
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        weights -= 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
    return weights


class Model:
    def __init__(self, weights: np.ndarray, threshold: float = 0.5):
        self.weights, self.threshold = weights, threshold

    def score(self, text: bytes) -> float:
        """The chance that the text is good; 1 for a blank one."""
        words, _, m = measures(text)
        if not words:
            return 1.0
        at, value = features(words, m)
        return float(1 / (1 + np.exp(-(value @ self.weights[at] + self.weights[-1]))))


def sampled_texts(rows: DataFrame, sample: int) -> tuple[DataFrame, dict[int, float]]:
    """(t, h) of at most ``sample`` distinct texts t of ``rows``, and the weight of each by its hash h."""
    hashed = rows.select("t", F.xxhash64("t").alias("h"))
    groups = Scratch(rows.sparkSession).keep(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("c")))
    # A cut of the priorities that leaves more than the sample, but not many more: by the number of texts per power of two of copies.
    sizes = groups.groupBy(F.floor(F.log2("c") + 1e-9).alias("b")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    at_least, number = 2.0 ** sizes.column("b").to_numpy(), sizes.column("n").to_numpy()
    low, high, want = 0.0, 1.0, sample + 10 * sample**0.5 + 50
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (number * np.minimum(1, at_least * mid)).sum() < want else (low, mid)
    ranked = groups.withColumn("at", (F.shiftrightunsigned("h", 11) + 0.5) / F.lit(2.0**53) / F.col("c"))
    top = ranked.where(F.col("at") <= high).orderBy("at", "h").limit(sample + 1).toArrow()
    h, c, at = (top.column(k).to_numpy()[:sample] for k in ("h", "c", "at"))
    least = 1 / top.column("at").to_numpy()[-1] if len(top) > sample else 0.0
    picked = rows.sparkSession.createDataFrame([(x,) for x in h.tolist()], "h long")
    return hashed.join(F.broadcast(picked), "h", "left_semi").dropDuplicates(["h"]), dict(zip(h.tolist(), np.maximum(c, least).tolist(), strict=True))


def fit(docs: DataFrame, text: str = "text", sample: int = 4_000, threshold: float = 0.5) -> Model:
    rows = docs.select(F.col(text).alias("t"))

    def vote(batch):
        v = np.array([votes(measures(t)[2]) for t in utf8(batch, "t")], np.int64).reshape(-1, LABELLERS)
        code, count = np.unique((v + 1) @ 3 ** np.arange(LABELLERS), return_counts=True)
        return {"code": code, "c": count}

    seen = map_arrow(rows, vote, "code long, c long").groupBy("code").agg(F.sum("c").alias("c")).toArrow()
    codes, counts = seen.column("code").to_numpy(), seen.column("c").to_numpy()
    if not len(codes):
        return Model(np.zeros(BUCKETS + 1), threshold)
    patterns = codes[:, None] // 3 ** np.arange(LABELLERS) % 3 - 1
    posterior = dict(zip(codes.tolist(), fit_labellers(patterns, counts).tolist(), strict=True))

    def feature(batch):
        out = []
        for h, t in zip(batch.column("h").to_pylist(), utf8(batch, "t"), strict=True):
            words, _, m = measures(t)
            if words:
                at, value = features(words, m)
                out.append((h, at, value, int((np.array(votes(m)) + 1) @ 3 ** np.arange(LABELLERS))))
        return {"h": [h for h, *_ in out], "at": [a for _, a, _, _ in out], "value": [v for _, _, v, _ in out], "code": [c for *_, c in out]}

    chosen, weight = sampled_texts(rows, sample)
    made = map_arrow(chosen, feature, "h long, at array<int>, value array<double>, code long").orderBy("h").toArrow()
    fitted = [(np.array(a, np.int64), np.array(v)) for a, v in zip(made.column("at").to_pylist(), made.column("value").to_pylist(), strict=True)]
    return Model(fit_scorer(fitted, np.array([posterior.get(c, 0.5) for c in made.column("code").to_pylist()]),
                            weight=np.array([weight[h] for h in made.column("h").to_pylist()])), threshold)


def kept_rows(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the model keeps, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(t) >= shared.value.threshold for t in utf8(batch, text)], pa.bool_()))

    return bounded(docs).mapInArrow(thrifty(run), docs.schema)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents: score and verdict."""
    docs = table(spark, sf_dir, "documents")
    model = spark.sparkContext.broadcast(fit(docs))

    def judge(batch):
        scores = [model.value.score(t) for t in utf8(batch, "text")]
        return {"doc_id": batch.column("doc_id"), "score": scores, "kept": [s >= model.value.threshold for s in scores]}

    return map_arrow(docs.select("doc_id", "text"), judge, "doc_id long, score double, kept boolean")
