"""Op 3: URL verdicts by rules, and by gradient-boosted trees where no rule speaks.

Trees are trained on lexical features: length, depth, digit ratio, entropy, parameter counts, and statistics of host
suffixes. Labelled URLs: those that a rule judges, those whose host holds a word of ``BLOCK_WORDS`` (block), and, with
``WEAK`` weight, all others (allow: most of the web is). Suffix statistics are block rates over all labelled URLs,
aggregated by Spark and joined back on the suffix; a labelled row's own label is left out of its rate.
The trees are fitted on a bounded sample of ``sample`` labelled URLs by hash; every URL is judged.

Defined results: a null URL, or one without "://", has empty host and path, no rule, and is judged by the trees on its
text (null counts as empty). Rows that repeat are judged one for one. An empty table gives no rows. Other columns are
not read. Of rules that fit, the longest (host and path) wins; of equally long ones the first by code points.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import Scratch, map_arrow, strings, table

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words that name a kind of site in its host.
BLOCK_WORDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "track", "viagra", "xxx")
WEAK = 0.5
FEATURES = ("length", "host_length", "depth", "labels", "digit_ratio", "entropy", "params", "hyphens", "host_digits", "suffix_rate", "host_rate")
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_WORDS = re.compile("|".join(BLOCK_WORDS))


def host_path(url: str) -> tuple[str, str]:
    m = _PARTS.search(url)
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


def rule_of(host: str, path: str, rules=RULES) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits."""
    fits = [(len(h) + len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min((-n, r, v) for n, r, v in fits)[1:] if fits else None


def lexical(url: str, host: str, path: str) -> list[float]:
    n = max(len(url), 1)
    counts = np.unique(np.frombuffer(url.encode("utf-32-le"), np.uint32), return_counts=True)[1] / n
    return [len(url), len(host), path.count("/"), host.count("."), sum(map(str.isdigit, url)) / n,
            float(-(counts * np.log2(counts)).sum()) + 0.0, url.count("=") + url.count("&"), host.count("-"), sum(map(str.isdigit, host))]


class Trees:
    """Boosted regression trees for the log odds of "block", on binned features."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 5.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.trees = rounds, depth, rate, bins, least, []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T] if len(x) else []
        mean = np.clip((w @ y) / w.sum(), 1e-3, 1 - 1e-3) if len(x) else 0.5
        self.base = float(np.log(mean / (1 - mean)))
        binned, f = self._binned(x) if len(x) else x, np.full(len(x), self.base)
        for _ in range(self.rounds if len(x) and 0 < y.mean() < 1 else 0):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(binned, w * (y - p), w * p * (1 - p))
            self.trees.append(tree)
            f += self._leaf(tree, binned)
        return self

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[tuple]:
        """Nodes in heap order: (feature, bin, value); a leaf has feature -1."""
        nodes: list[tuple] = [(-1, 0, 0.0)] * (2 ** (self.depth + 1) - 1)
        members = {0: np.arange(len(g))}
        for at in range(len(nodes)):
            rows = members.pop(at, None)
            if rows is None:
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            best, nodes[at] = (1e-6, -1, 0), (-1, 0, self.rate * gs / (hs + 1.0))
            if at < 2**self.depth - 1:
                for j in range(x.shape[1]):
                    gl = np.cumsum(np.bincount(x[rows, j], g[rows], self.bins))[:-1]
                    hl = np.cumsum(np.bincount(x[rows, j], h[rows], self.bins))[:-1]
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    gain[(hl < self.least / 4) | (hs - hl < self.least / 4)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, k)
            if best[1] >= 0:
                nodes[at] = (best[1], best[2], 0.0)
                left = x[rows, best[1]] <= best[2]
                members[2 * at + 1], members[2 * at + 2] = rows[left], rows[~left]
        return nodes

    @staticmethod
    def _leaf(tree: list[tuple], x: np.ndarray) -> np.ndarray:
        feature, cut, value = (np.array(c) for c in zip(*tree, strict=True))
        at = np.zeros(len(x), np.int64)
        while (inner := feature[at] >= 0).any():
            f = feature[at]
            right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return value[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        if self.trees:
            binned = self._binned(x)
            for tree in self.trees:
                f += self._leaf(tree, binned)
        return 1 / (1 + np.exp(-f))


def _rates(rows: DataFrame, by: str, out: str, prior: float = 5.0) -> DataFrame:
    """rows with the smoothed block rate of their ``by``, their own label left out."""
    sums = rows.groupBy(by).agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("label")).alias("b"))
    rest_w, rest_b = F.col("w") - F.col("weight"), F.col("b") - F.col("weight") * F.col("label")
    return rows.join(sums, by).withColumn(out, (rest_b + prior * 0.2) / (rest_w + prior)).drop("w", "b")


def url_verdicts(pages: DataFrame, url: str = "url", id: str = "page_id", rules=RULES, sample: int = 20_000) -> DataFrame:
    """A row per row of ``pages``: page_id, host, path, rule, verdict, p_block (the trees' chance of "block")."""
    scratch = Scratch(pages.sparkSession)

    def parse(batch):
        cols = {k: [] for k in ("host", "path", "rule", "ruled", "label", "weight", "suffix", "x")}
        for u in strings(batch, "u"):
            host, path = host_path(u)
            rule = rule_of(host, path, rules)
            bad = rule[1] == "block" if rule else bool(_WORDS.search(host))
            row = (host, path, *(rule or (None, None)), float(bad), 1.0 if rule or bad else WEAK, ".".join(host.split(".")[-2:]), lexical(u, host, path))
            for k, v in zip(cols, row, strict=True):
                cols[k].append(v)
        return {"page_id": batch.column("i"), **cols}

    parsed = scratch.keep(map_arrow(pages.select(F.col(id).alias("i"), F.col(url).alias("u")), parse, (
        "page_id long, host string, path string, rule string, ruled string, label double, weight double, suffix string, x array<double>")))
    rated = scratch.keep(_rates(_rates(parsed, "suffix", "suffix_rate"), "host", "host_rate")
                         .withColumn("x", F.concat("x", F.array("suffix_rate", "host_rate"))))
    few = (rated.select("x", "label", "weight", F.xxhash64("page_id", "host", "path").alias("h")).orderBy("h", "x", "label").limit(sample).toArrow())
    x = np.array(few.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    model = pages.sparkSession.sparkContext.broadcast(Trees().fit(x, few.column("label").to_numpy(), few.column("weight").to_numpy()))

    def judge(batch):
        p = model.value.score(np.array(batch.column("x").to_pylist(), float).reshape(-1, len(FEATURES)))
        verdict = [r or ("block" if v >= 0.5 else "allow") for r, v in zip(batch.column("ruled").to_pylist(), p, strict=True)]
        return {k: batch.column(k) for k in ("page_id", "host", "path", "rule")} | {"verdict": verdict, "p_block": p}

    return map_arrow(rated.select("page_id", "host", "path", "rule", "ruled", "x"), judge,
                     "page_id long, host string, path string, rule string, verdict string, p_block double")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))
