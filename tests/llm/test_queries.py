"""Each query of the document operators on the given tables: its columns, their types, and its rows by plain Python."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from asofkit.llm import pii, quality_classifier, queries, secret_scan
from asofkit.llm.common import table
from tests.llm.test_operators import PERSONAL, SECRETS, fair_targets, plain_spans, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in table(spark, SF, "documents").collect()}


def run(spark, name, types):
    df = queries.QUERIES[name](spark, SF)
    assert dict(df.dtypes[: len(types)]) == types
    return df.collect()


@pytest.mark.parametrize(("name", "patterns", "kinds", "by_start"), [
    ("op1_secret_scan", SECRETS, ("assign", "access", "hex"), True), ("op6_pii", PERSONAL, pii.KINDS, False)])
def test_span_queries_on_the_given_table(spark, texts, name, patterns, kinds, by_start):
    types = {"doc_id": "bigint", **{f"n_{k}": "bigint" for k in kinds}, "base_sha256": "string", "spans": "string"}
    got = {r.doc_id: r for r in run(spark, name, types)}
    assert got.keys() == texts.keys()
    order = lambda s: (s[1], kinds.index(s[0])) if by_start else (kinds.index(s[0]), s[1])
    for i, d in texts.items():
        base = sorted(plain_spans(patterns, d.text or ""), key=order)
        written = [f"{k}:{s}:{e}" for k, s, e in base]
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in base) for k in kinds]
        assert got[i].base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        spans = got[i].spans.split(",") if got[i].spans else []
        assert not Counter(written) - Counter(spans)  # base spans stay
        places = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in spans)]
        known = list(secret_scan.KINDS) if by_start else list(pii.KINDS)
        assert places == sorted(places, key=lambda s: (s[1], known.index(s[0]), s[2]) if by_start else (known.index(s[0]), s[1]))


def split_url(url):
    """Host and path by plain searches."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((p for p in map(rest.find, "/?#") if p >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min((p for p in map(tail.find, "?#") if p >= 0), default=len(tail))]


def test_url_query_by_a_second_parser(spark):
    types = {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}
    got = {r.page_id: r for r in run(spark, "op3_url_filter", types)}
    urls = {r.page_id: r.url for r in table(spark, SF, "pages").collect()}
    assert got.keys() == urls.keys()
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    for i, url in urls.items():
        host, path = split_url(url)
        parts = host.split(".")
        fits = [r for r in rules for k in range(len(parts)) if r.split("/")[0] == ".".join(parts[k:]) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == rules[rule] if rule else got[i].verdict in ("allow", "block")


def test_em_equals_a_plain_one():
    r = np.random.default_rng(3)
    patterns = np.unique(r.integers(-1, 2, (40, 4)), axis=0)
    counts = r.integers(1, 50, len(patterns))
    got = quality_classifier.fit_labellers(patterns, counts, rounds=15)

    votes, prior = (-1, 0, 1), [0.2, 0.8]
    chance = [[dict(zip(votes, p, strict=True)) for _ in range(4)] for p in ((0.5, 0.3, 0.2), (0.1, 0.3, 0.6))]
    for _ in range(15):
        post = []
        for pattern in patterns:
            joint = [prior[c] * math.prod(chance[c][j][v] for j, v in enumerate(pattern)) for c in (0, 1)]
            post.append([x / sum(joint) for x in joint])
        weight = [[p[c] * n for p, n in zip(post, counts, strict=True)] for c in (0, 1)]
        prior = [(sum(w) + 1) / (sum(map(sum, weight)) + 2) for w in weight]
        for j in range(4):
            new = []
            for c in (0, 1):
                raw = {v: 1 + sum(w for w, p in zip(weight[c], patterns, strict=True) if p[j] == v) for v in votes}
                new.append({v: x / sum(raw.values()) for v, x in raw.items()})
            if new[0][-1] < new[1][-1] or new[0][1] > new[1][1]:
                new = [{v: (new[0][v] + new[1][v]) / 2 for v in votes}] * 2
            chance[0][j], chance[1][j] = new
    assert got == pytest.approx([p[1] for p in post])


def test_quality_query(spark, texts):
    got = run(spark, "op4_quality_classifier", {"doc_id": "bigint", "score": "double", "kept": "boolean"})
    assert {r.doc_id for r in got} == texts.keys() and all(r.kept == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_token_query(spark, texts):
    got = run(spark, "op7_token_counts", {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"})
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: (len((d.text or "").encode()), len(library.encode(d.text or "", add_special_tokens=False).ids)) for i, d in texts.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_mixing_query(spark, texts):
    got = run(spark, "op8_mixing", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint", "first_position": "double"})
    sizes, taken = Counter(), defaultdict(int)
    for d in texts.values():
        sizes[d.source] += len(words_of(d.text))
    want = fair_targets(sizes)
    for r in got:
        source = texts[r.doc_id].source
        assert (r.size, r.source_size) == (len(words_of(texts[r.doc_id].text)), sizes[source])
        assert r.target == pytest.approx(want[source]) and 0 <= r.taken <= 3 * r.size and (r.first_position is None) == (r.taken == 0)
        taken[source] += r.taken
    assert len(got) == len(texts) and all(abs(taken[s] - t) <= 1 for s, t in want.items())


def test_quality_rules_query(spark, texts):
    types = {"doc_id": "bigint", "n_words": "bigint", **dict.fromkeys(("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "bigint"), "base_failed": "boolean", "kept": "boolean"}
    got = {r.doc_id: r for r in run(spark, "op10_quality_rules", types)}
    assert got.keys() == texts.keys()
    for i, d in texts.items():
        w = words_of(d.text)
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = len({k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)})
        lines = [x for x in (d.text or "").split("\n") if words_of(x)]
        base = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in d.text or ""), len(lines) - len(set(lines)), again, len(w) < 20 or 100 * again > 30 * len(w))
        assert tuple(got[i])[1:7] == base and not (got[i].kept and got[i].base_failed)
