"""Each operator on rows with nulls, empty and long texts, ties, repeats and extra columns, and against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from asofkit.llm import bpe, common, exact_dedup, mixing, ngram_join, pii, quality_classifier, quality_rules, queries, secret_scan, token_counts, url_filter
from asofkit.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, `_size` string, word int"


def corpus() -> list[tuple]:
    """Prose-like texts with exact and near copies, junk, nulls, blanks, a very long text and repeated rows."""
    r = random.Random(3)
    vocabulary = ["".join(r.choice("aeiourstln") for _ in range(r.randint(2, 8))) for _ in range(900)]

    def prose(n):
        return "\n".join(" ".join(r.choice(vocabulary) for _ in range(min(12, n - i))).capitalize() + "." for i in range(0, n, 12))

    texts = [prose(r.randint(20, 200)) for _ in range(60)]
    for i in range(0, 20, 2):  # near copies at various distances
        words = texts[i].split(" ")
        for k in (1, 3, 8):
            w = list(words)
            for _ in range(k):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w))
    texts += texts[:8] + [texts[0]] * 5
    texts += ["spam " * 300, "BUY!! NOW!! " * 60, " ".join(f"{w}***" for w in vocabulary[:80]), "one two", "A b c d e", "a B c d e"]
    texts += [None, "", "  \n\t", prose(6000), "é" * 40 + " naïve Σ σς ΑΣ.", "x\x1cy z"]
    texts += [f'{prose(12)} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" {prose(5)}' for i in range(20)]
    texts += [f"{prose(10)} call +1 ({100 + i}) 555-{1000 + i} or mail u{i}@mail{i}.example.com at 10.{i}.2.3 {prose(4)}" for i in range(30)]
    rows = [(i, t, "en", ["a", "b", None, "ü", "zz"][i % 5] if i % 3 else "a", 1, 5, "clash", 7) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[1], None, None, None, None, None, None), (None, "only here without an id today", "x", "b", 1, 1, "", 1)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Op 9

def shingles(text):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked_groups(texts: dict):
    """(size, smallest reachable id) by all pairs."""
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_ngram_join_equals_all_pairs(docs, rows):
    want = linked_groups({r[0]: r[1] for r in rows if r[0] is not None})
    got = ngram_join.ngram_join(docs, tile=4).collect()  # small tiles: blocks are dealt to pairs of tiles
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert Counter(r.component_id for r in got if r.doc_id is None) == Counter([want[1][1], None])
    assert len({v[1] for v in want.values()}) < len(want) - 20


def test_ngram_join_query_on_the_given_table(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.op9_ngram_join(spark, SF).collect()}
    assert got == linked_groups(texts)


def test_no_pair_over_the_threshold_is_ruled_out():
    r = np.random.default_rng(5)
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * r.uniform(0.7, 1))], r.integers(0, 2**63, int(n * r.uniform(0, 0.3))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            v, w = ngram_join.count_vector(a), ngram_join.count_vector(b)
            m = min(len(v), len(w))
            sizes, points = np.array([len(a), len(b)]), np.stack([ngram_join.fold(v, m), ngram_join.fold(w, m)])
            q, p = ngram_join.RTree(sizes, points).search(sizes, points)
            assert (0, 1) in set(zip(q.tolist(), p.tolist(), strict=True))
            assert abs(np.diff(ngram_join.band(sizes))[0]) <= 1


def test_one_row_of_each_component_stays(spark, docs, rows):
    """Also where doc_ids repeat with other texts, or are null."""
    r = random.Random(6)
    base = [" ".join(r.choice("abcdefghij") * r.randint(1, 4) for _ in range(60)) for _ in range(6)]
    frame = [(1, base[0]), (1, base[0] + " z"), (1, base[1]), (2, base[1] + " y"), (None, base[2]), (None, base[2] + " x"), (3, base[3]), (None, base[3] + " q"), (None, ""), (4, None), (5, "few words")]
    got = ngram_join.one_of_each(spark.createDataFrame([(*x, 1) for x in frame], "doc_id long, text string, body int"))
    assert got.columns == ["doc_id", "text", "body"]
    kept = Counter((x.doc_id, x.text) for x in got.collect())
    assert sum(kept.values()) == 7 and kept[(3, base[3])] == kept[(None, "")] == kept[(4, None)] == kept[(5, "few words")] == 1
    assert sum(kept[x] for x in frame[:2]) == sum(kept[x] for x in frame[4:6]) == 1 and kept[(1, base[1])] == 1


def test_a_block_of_near_copies_costs_its_size(spark, monkeypatch):
    """Rows with vectors dealt in all rounds: linear in a block of near copies, where all pairs of tiles would be its square over the tile."""
    dealt, make = [], ngram_join._dealt
    r, base = random.Random(2), [f"w{i}" for i in range(300)]
    texts = [" ".join(base[:k] + [f"x{r.random()}"] + base[k + 1 :]) for k in (r.randrange(300) for _ in range(1_500))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def counted(*args):
        rows = make(*args).cache()
        biggest = rows.groupBy("key").count().agg({"count": "max"}).first()[0]
        dealt.append((rows.count(), biggest or 0, args[0].groupBy("pivot").count().agg({"count": "max"}).first()[0] or 0))
        return rows

    monkeypatch.setattr(ngram_join, "_dealt", counted)
    assert {x.component_id for x in ngram_join.ngram_join(frame, tile=50).collect()} == {0}
    (_, first, block), (_, reps, _), (last, _, _) = dealt
    # 30 tiles: all pairs of them would be 30 times the block
    assert first == block >= 1_000 and reps <= 60 and last <= block


# Op 5

def test_exact_dedup(docs, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter((r[0], best[r[1] or ""], len(groups[r[1] or ""]), r[0] == best[r[1] or ""]) for r in rows)
    got = exact_dedup.marked(docs)
    assert Counter((r.row.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == want
    kept = exact_dedup.kept_rows(docs)
    assert kept.columns == docs.columns
    assert Counter((r.text or "") for r in kept.collect()) == Counter({t: 1 for t in groups})
    # Content is hashed only where length and beginning repeat.
    hashed = {r.text for r in got.where("hash IS NOT NULL").select("row.text").collect()}
    assert all(sum(len((u or "").encode()) == len((t or "").encode()) for u in map(lambda r: r[1], rows)) > 1 for t in hashed)


# Op 2 and 7

@pytest.mark.parametrize("seed", range(3))
def test_encoder_equals_the_library(seed):
    path, r = public_tokenizers.path("word_bpe_49k.json"), random.Random(seed)
    library = Tokenizer.from_file(path)
    encoder, decoder = bpe.tools(open(path).read())
    alphabet = "abcdefghijklmnopqrstuvwxyz'  éÉΣςİſ1²!<|>\n\x1e\x85́　한𝒳🎉"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 300))) for _ in range(400)]
    texts += ["", " \n", "x<|endoftext|>y <|startoftext|><|endoftext|>", "a" * 3000, "aab" * 500, *[r[1] or "" for r in corpus()]]
    for t in texts:
        want, got = library.encode(t, add_special_tokens=False).ids, np.frombuffer(encoder.encode(t), "<u4")
        assert got.tolist() == want, t[:80]
        assert decoder.decode(got).decode() == library.decode(want, skip_special_tokens=False)


def test_bpe_query_and_clashes(spark, docs, rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in queries.QUERIES["op2_bpe"](spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    coded = bpe.bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), ids="t")
    assert coded.columns == [*docs.columns, "t"] and coded.count() == len(rows)
    with pytest.raises(ValueError):
        bpe.bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"), ids="node")


def test_token_counts_and_cache(spark, docs, rows, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    cache = f"{tmp_path}/cache"
    half = docs.where("doc_id < 50")
    assert token_counts.token_counts(half, path, cache).count() == sum(r[0] is not None and r[0] < 50 for r in rows)
    first = spark.read.parquet(cache).count()
    assert first == len({r[1] or "" for r in rows if r[0] is not None and r[0] < 50})
    for _ in range(2):
        assert Counter(map(tuple, token_counts.token_counts(docs, path, cache).collect())) == want
        assert spark.read.parquet(cache).count() == len({r[1] or "" for r in rows})  # misses once, then nothing
    special = spark.createDataFrame([(1, "a <|endoftext|>b"), (1, "a <|endoftext|>b")], "doc_id long, text string")
    assert [r.n_tokens for r in token_counts.token_counts(special, path, cache).collect()] == [len(library.encode("a <|endoftext|>b").ids)] * 2


# Op 8

def fair_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, left, open_, out = {s: i % 3 + 1 for i, s in enumerate(order)}, sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        for s in over or set(open_):
            out[s] = 3.0 * sizes[s] if over else level * weight[s]
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over or set(open_)
    return out


@pytest.mark.parametrize("bucket_rows", [3, 20_000])
def test_mixing(docs, rows, bucket_rows):
    sizes, by = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    want = fair_targets(sizes)
    mixed = mixing.streams(docs, bucket_rows=bucket_rows).cache()
    got = mixed.collect()
    assert Counter(tuple(r.row) for r in got) == Counter(rows)
    for r in got:
        assert r["_target"] == pytest.approx(want[r.row.source]) and 0 <= r["_taken"] <= 3 * len(words_of(r.row.text))
        by[r.row.source] += r["_taken"]
    assert all(abs(by[s] - want[s]) <= 5 for s in want)
    each = mixing.occurrences(mixed).collect()
    assert sum(r["_words"] for r in each) == sum(by.values()) and all(0 <= r["_position"] <= 1 for r in each)


def test_mixed_rows_are_the_occurrences_in_order(spark, docs, rows):
    got = mixing.mixed_rows(docs)
    assert got.columns == docs.columns
    want = mixing.in_training_order(mixing.occurrences(mixing.streams(docs), cut=False), "row.doc_id").select("row.*")
    assert Counter(got.collect()) == Counter(want.collect())
    assert got.count() > 0 and len(got.select("row" if "row" in got.columns else "doc_id").collect()) == want.count()


def test_mixing_stops_small_sources_and_reruns_agree(spark):
    frame = spark.createDataFrame([(i, "w " * (5 if i % 10 else 1), "big" if i % 10 else f"s{i % 20}") for i in range(400)], "doc_id long, text string, source string")
    a, b = ({(r.row.doc_id, r["_taken"], r["_target"]) for r in mixing.streams(f).collect()} for f in (frame, frame.repartition(7)))
    assert a == b
    sizes = Counter()
    for r in frame.collect():
        sizes[r.source] += len(r.text.split())
    want = fair_targets(sizes)
    assert {r.row.source: r["_target"] for r in mixing.streams(frame).collect()} == pytest.approx(want)
    assert any(want[s] == 3 * sizes[s] for s in want)


def test_positions_invert_the_schedule(spark):
    from pyspark.sql import functions as F

    for c, knots in mixing.SCHEDULES.items():
        grid = np.linspace(0, 1, 2001)
        weights = np.interp(grid, *zip(*knots, strict=True))
        demand = np.concatenate([[0], np.cumsum((weights[1:] + weights[:-1]) / 2)])
        shares = [0.0, 0.1, 0.37, 0.5, 0.9, 1.0]
        got = spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.position(F.col("s"), F.lit(c)).alias("t")).collect()
        assert [r.t for r in got] == pytest.approx(list(np.interp(shares, demand / demand[-1], grid)), abs=2e-3)


# Op 10

def test_quality_rules_base(docs, rows):
    got = Counter(map(lambda r: tuple(r)[:7], quality_rules.quality_rules(docs).collect()))
    want = Counter()
    for i, t, *_ in rows:
        w = words_of(t)
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = len({k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)})
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), again, len(w) < 20 or 100 * again > 30 * len(w)] += 1
    assert got == want


def test_quality_rules_bands(docs, rows):
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert all(kept[i] for i, t, *_ in rows[:60] if len(words_of(t)) >= 20)
    packer = zstandard.ZstdCompressor(level=3)
    noise = bytes(random.Random(1).choices(range(33, 127), k=20_000))
    assert quality_rules.ratios(noise, packer)[1] > 0.5 and quality_rules.ratios(b"ab" * 9_000, packer)[1] > 0.5
    assert quality_rules.ratios(b"", packer) == (1.0, 0.0)


def test_quality_rules_find_partial_noise_and_repetition(spark):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("aeiourstln") for _ in range(r.randint(2, 8))) for _ in range(900)]
    prose = lambda n: "".join(" ".join(r.choices(vocabulary, k=12)) + ".\n" for _ in range(n // 70))
    noise = lambda n: "".join("".join(chr(c) for c in r.choices(range(40, 123), k=76)) + "\n" for _ in range(n // 77))
    again = lambda n: (r.choice(vocabulary) + " ") * (n // 6)
    texts = [prose(100_000 * (100 - k) // 100) + junk(100_000 * k // 100) for junk in (noise, again) for k in (20, 35, 49)]
    texts += [prose(50_000) + noise(48_000) + prose(50_000)] + [prose(n) for n in (3_000, 9_000, 30_000, 100_000, 400_000)]
    got = {x.doc_id: x for x in quality_rules.quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].kept for i in range(len(texts))] == [False] * 7 + [True] * 5
    assert all(not _outside_of_band(t, got[i].ratio) for i, t in enumerate(texts) if i < 2)  # the chunks tell, not the whole


def _outside_of_band(text, ratio):
    return quality_rules._outside(len(text.encode()), ratio * len(text.encode()))


# Op 4

def test_quality_sample_is_bounded_and_weighted(spark):
    copies = spark.range(3_000).selectExpr("if(id < 1000, 'one hot text of many rows', concat('a text of its own ', id)) AS t")
    chosen, weight = quality_classifier.sampled_texts(copies, 50)
    got = chosen.collect()
    assert len(got) == len(weight) == 50 and {x.h for x in got} == set(weight)
    assert {x.t: weight[x.h] for x in got}["one hot text of many rows"] == 1_000
    assert sum(weight.values()) == pytest.approx(3_000, rel=0.5) and len({w for w in weight.values() if w < 1_000}) == 1
    whole, weight = quality_classifier.sampled_texts(copies, 5_000)
    assert whole.count() == 2_001 and sum(weight.values()) == 3_000
    rows, target = [(np.array([1]), np.ones(1)), (np.array([2]), np.ones(1))], np.array([1.0, 0.0])
    twice = quality_classifier.fit_scorer([rows[0], rows[0], rows[1]], np.array([1.0, 1.0, 0.0]))
    assert quality_classifier.fit_scorer(rows, target, weight=np.array([2.0, 1.0])) == pytest.approx(twice)


def test_quality_classifier_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    got = {r.doc_id: r.kept for r in quality_classifier.op4_quality_classifier(spark, sf).collect()}
    good = [got[i] for i, q in truth.items() if q == 1]
    bad = [not got[i] for i, q in truth.items() if q == 0]
    assert sum(good) / len(good) >= 0.98 and sum(bad) / len(bad) >= 0.9


def test_quality_classifier_rows(docs, none, rows):
    model = quality_classifier.fit(docs, sample=40)
    kept = quality_classifier.kept_rows(docs, model)
    assert kept.columns == docs.columns
    left = Counter(map(tuple, kept.collect()))
    assert not left - Counter(rows) and sum(r[1] in (None, "", "  \n\t") for r in left) == 3
    assert quality_classifier.kept_rows(none, quality_classifier.fit(none)).count() == 0


# Op 3

def test_url_rules_and_verdicts(spark):
    urls = ["http://a.net/x", "http://NET/", "http://net", "https://www.Example.net/en/1?x=1", "http://example.com/de/2", "http://xexample.com/de/2",
            "http://b.org/fr/", "ftp://org/fr", None, "no host", "", "://", "http://spam-farm.example.org/en/1#://net/", "http://a.net/x"]
    want = [("a.net", "/x", "net/", "block"), ("net", "/", "net/", "block"), ("net", "", None, None), ("www.example.net", "/en/1", "example.net/en/", "allow"),
            ("example.com", "/de/2", "example.com/de/", "block"), ("xexample.com", "/de/2", None, None), ("b.org", "/fr/", "org/fr/", "allow"), ("org", "/fr", None, None),
            *[("", "", None, None)] * 4, ("spam-farm.example.org", "/en/1", None, None), ("a.net", "/x", "net/", "block")]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, label string")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(want):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict in ("allow", "block") and (verdict is None or got[i].verdict == verdict)


def test_url_trees_on_held_out_urls(spark):
    got = url_filter.url_verdicts(table(spark, "/root/testdata/sf0.1", "pages"), sample=800).where("rule IS NULL").collect()
    named = [r for r in got if re.search("|".join(url_filter.BLOCK_WORDS), r.host)]
    others = [r for r in got if not re.search("|".join(url_filter.BLOCK_WORDS), r.host)]
    assert sum(r.verdict == "block" for r in named) / len(named) >= 0.9
    assert sum(r.verdict == "allow" for r in others) / len(others) >= 0.98


# Op 1 and 6

def plain_spans(patterns: dict, text: str) -> list:
    return [(k, m.start(), m.end()) for k, (p, ok) in patterns.items() for m in re.finditer(p, text) if ok(m)]


SECRETS = {
    "assign": (r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}


def luhn(text):
    d = [int(c) for c in reversed(text)]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def digits(text):
    return "".join(re.findall("[0-9]", text))


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
}
ODD = ["a@b.c@d.e", "x@@y.z", "a@b@c.d.e", "@a.b", "1.2.3.4.5.6.7.8", "300.1.1.1", "001.2.3.4", "4111 1111 1111 1111", "4111-1111 11111111 1", "+1 2", "+12(34)567-89.",
       "PASSWORD: 'abcdefgh1'", "api_key=token=abcdefgh", "apikey : short", "password = secret: abcdefghij", "ſecret=abcdefghij", "AKIAAKIA123", "AKIA" + "Z" * 12,
       "0" * 40 + "g" + "f" * 31, "toKen=12345678", "Token\"='deadbeef" * 4, "é@ü.de é.a@b-c.de", "5" * 5000, "a" * 5000 + "@x", "tOkEn='" + "x" * 3000]


@pytest.mark.parametrize(("module", "patterns"), [(secret_scan, SECRETS), (pii, PERSONAL)])
def test_base_spans_equal_the_patterns(module, patterns):
    r = random.Random(11)
    alphabet = "aAf0123459@.+-() :='\"kKtTé"
    texts = ODD + ["".join(r.choice(alphabet) for _ in range(120)) for _ in range(1500)] + [r[1] or "" for r in corpus()]
    for t in texts:
        raw = t.encode()
        found = [x[:3] for x in module.base_spans(raw)]
        at = secret_scan.code_points(raw, [p for _, s, e in found for p in (s, e)])
        assert Counter((k, at[2 * i], at[2 * i + 1]) for i, (k, _, _) in enumerate(found)) == Counter(plain_spans(patterns, t)), t[:90]


def test_span_queries(spark, docs, none, rows):
    model = secret_scan.fit(docs)
    got = secret_scan.span_columns(secret_scan.find_secrets(docs, model), ("assign", "access", "hex")).collect()
    tagger = pii.fit(docs, steps=30)
    private = pii.span_columns(pii.find_personal_data(docs, tagger), pii.KINDS).collect()
    for found, patterns, first in ((got, SECRETS, "start"), (private, PERSONAL, "kind")):
        want, kinds = Counter(), list(patterns)
        for i, t, *_ in rows:
            spans = sorted(plain_spans(patterns, t or ""), key=lambda s: (s[1], kinds.index(s[0])) if first == "start" else (kinds.index(s[0]), s[1]))
            text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
            want[i, *(sum(s[0] == k for s in spans) for k in kinds), hashlib.sha256(text.encode()).hexdigest()] += 1
        assert Counter((r.doc_id, *(r[f"n_{k}"] for k in kinds), r.base_sha256) for r in found) == want
    assert secret_scan.find_secrets(none, secret_scan.fit(none)).count() == 0
    assert pii.find_personal_data(none, pii.fit(none)).count() == 0


def test_automata_tell_formats_apart():
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(200)]
    words = ["".join(random.Random(i).choices("abcdefghijklmnoprstu", k=18)) for i in range(200)] + [f"chapter-{i}-of-the-book" for i in range(50)]
    model = secret_scan.Model({"hex": hexes[:150], "word": words[:150] + words[200:]})
    assert all(model.score(x[:24]) >= model.margin for x in hexes[150:] if re.search("[0-9]", x[:24]))
    assert all(model.score(x) < model.margin for x in words)
    assert secret_scan.Model({}).score(hexes[0]) == float("-inf")


def test_candidates_without_digits_and_short_ones_are_scored(spark):
    r, letters = random.Random(6), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    key = lambda n, of=letters + "0123456789": "".join(r.choices(of, k=n))
    syllables = ["tion", "ver", "ing", "ent", "re", "con", "ble", "ous", "ly", "an"]
    word = lambda n: "".join(r.choices(syllables, k=n))
    numbers = [f"2024-{i % 12 + 1:02}-{i % 28 + 1:02}" for i in range(40)] + [str(4000_0000_0000_0000 + 7919 * i**3) for i in range(40)]
    plain = [f"{word(3)} {word(5)} {word(8).capitalize()} {x}" for x in numbers for _ in range(20)]
    labelled = [f'the api_key = "{key(r.randint(8, 40))}" of {word(3)}' for _ in range(300)]
    planted = [key(n, letters) for n in (16, 20, 24, 32) for _ in range(25)] + [key(n) for n in (10, 12, 15) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(plain + labelled + [f"{word(2)} {k}, {word(4)}" for k in planted])), "doc_id long, text string")
    model = secret_scan.fit(docs)
    found = {x.doc_id: [s for s in x.spans if s.kind == "format"] for x in secret_scan.find_secrets(docs, model).collect()}
    texts = {x.doc_id: x.text for x in docs.collect()}
    marked = {texts[i][s.start : s.end] for i, spans in found.items() for s in spans}
    bare = planted[:100], planted[100:]
    assert all(sum(k in marked for k in of) / len(of) >= 0.85 for of in bare)
    assert not marked - set(planted), "long plain words, dates and numbers stay"
    assert all(model.score_token(k.encode()) == model.score(k) for k in planted)


def test_automata_learn_whole_values(spark):
    texts = [f"digest {hashlib.sha512(str(i).encode()).hexdigest()} of plain-words-{i}" for i in range(60)]
    hexes = secret_scan.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).kinds["hex"]
    ends, steps = sum(c.get("", 0) for c in hexes.count), sum(sum(c.values()) for c in hexes.count)
    assert (ends, steps) == (60, 60 * 129)  # no end at 64
    long = secret_scan.Automaton(["a" * 100_000 + str(i) for i in range(3)] + ["0b" * 50_000])
    assert sum(sum(c.values()) for c in long.count) == 3 * 100_002 + 100_001


def test_tagger_gradients_and_held_out_spans():
    r = np.random.default_rng(2)
    tagger = pii.Tagger(size=3, hidden=4)
    x, y = r.integers(1, 97, (3, 7)), np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [5, 6, 6, 0, 7, 8, 8]])
    _, grads = tagger.loss(x, y)
    for name in ("emb", "xf", "hb", "cf", "out", "bias", "first", "trans"):
        p = tagger.p[name]
        for at in [np.unravel_index(i, p.shape) for i in r.choice(p.size, 4, replace=False)] if name not in ("emb", "trans") else [(int(x[0, 0]), 1)] if name == "emb" else [(0, 0), (1, 2)]:
            old = p[at]
            p[at] = old + 1e-5
            up = tagger.loss(x, y)[0]
            p[at] = old - 1e-5
            down = tagger.loss(x, y)[0]
            p[at] = old
            assert grads[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-5), name
    rng, made = random.Random(4), []
    for i in range(300):
        words = " ".join(rng.choice(["the", "mail", "sent", "to", "room", "12", "v2.0"]) for _ in range(rng.randint(2, 6)))
        value = rng.choice([f"u{rng.randint(1, 999)}@mail{i}.example.com", f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.3.{rng.randint(0, 255)}", f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"])
        made.append(f"{words} {value} {words}".encode())
    cut = lambda t: np.pad(pii.codes(t[:64]), (0, 64 - len(t[:64])))
    train = made[:220]
    tagger = pii.Tagger().fit(np.stack([cut(t) for t in train]), np.stack([pii.labels_of(pii.base_spans(t), 0, 64) for t in train]), steps=250)
    want = [(t, s) for t in made[220:] for s in pii.base_spans(t)]
    assert sum(s in pii.added_spans([t], tagger, [[]])[0] for t, s in want) / len(want) >= 0.8


# Pipeline

def test_pipeline_stages(spark, docs, none, rows):
    frame, counts = docs, []
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = stage(spark, frame, SF)
        assert name == "bpe" or frame.columns == docs.columns
        frame = frame.cache()
        counts.append(frame.count())
        if name == "exact_dedup":
            assert Counter(r.text or "" for r in frame.collect()) == Counter({r.text or "": 1 for r in before.collect()})
        if name == "near_dedup":
            groups = linked_groups({r.doc_id: r.text for r in before.collect() if r.doc_id is not None})
            assert sorted(r.doc_id for r in frame.collect() if r.doc_id is not None) == sorted({v[1] for v in groups.values()})
        if name == "mixing":
            assert max(Counter(r.doc_id for r in frame.collect()).values()) <= 3 and not any(not words_of(r.text) for r in frame.collect())
    assert counts[-1] == counts[-2] > 0
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r[0]: r[1] for r in rows}
    for r in frame.where("doc_id IS NOT NULL").collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_empty_tables(none, tmp_path):
    assert ngram_join.ngram_join(none).count() == 0
    assert exact_dedup.marked(none).count() == 0
    assert mixing.streams(none).count() == 0
    assert quality_rules.quality_rules(none).count() == 0
    assert token_counts.token_counts(none, public_tokenizers.path("byte_bpe_50k.json"), f"{tmp_path}/c").count() == 0
    assert url_filter.url_verdicts(none.selectExpr("doc_id AS page_id", "text AS url")).count() == 0


def test_an_operator_keeps_its_caches_until_another_ones_task(monkeypatch):
    r = random.Random(1)
    texts = [" ".join(r.choice(["one", "two", "Three", "fours", "5"]) + str(r.randint(0, 9)) for _ in range(30)) for _ in range(20)]
    task = lambda operator, fn: list(common.thrifty(lambda batches: (fn(b) for b in batches), operator)(texts))
    judge = lambda t: quality_classifier.features(*_words_and_measures(t))
    filled = []

    def seen(t):
        filled.append((len(ngram_join._HASHES), len(quality_classifier._BUCKETS)))
        return judge(t)

    want = task("quality", seen)
    # Both caches grow from text to text (texts are longer than the windows that are hashed), and into the next task.
    assert all(x <= y and u <= v for (x, u), (y, v) in itertools.pairwise(filled)) and min(filled[-1]) >= 30
    task("quality", seen)
    assert filled[len(texts)] >= filled[len(texts) - 1]
    sets = task("join", lambda t: (ngram_join.shingle_set(t.encode()), len(quality_classifier._BUCKETS)))
    assert all(n == 0 for _, n in sets) and ngram_join._HASHES
    for (at, value), (again, v) in zip(want, task("quality", judge), strict=True):
        assert (again == at).all() and (v == value).all()
    assert all((ngram_join.shingle_set(t.encode()) == s).all() for t, (s, _) in zip(texts, sets, strict=True))
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    whole = [bpe.tools(source)[0].encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHED", 1)
    bpe.tools.cache_clear()
    assert [bpe.tools(source)[0].encode(t) for t in texts] == whole


def _words_and_measures(text):
    words, _, m = quality_classifier.measures(text.encode())
    return words, m
