"""Ops 11 to 13 on rows with nulls, empty and long texts, ties, repeats and extra columns, and against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
import xxhash

from asofkit.llm import prefix_trie, repair, simhash
from asofkit.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, ids string, head int, node string"


def conversations(seed: int = 4) -> list[tuple]:
    """Conversations of up to 40 turns that share beginnings, with nulls, blanks, repeats, ties, unknown roles and a very long text."""
    r = random.Random(seed)
    lines = ["Yes.", "no", "Why?", "", " \n", None, "Stop!", "a b c", "a b c.", "é…", "ok \t", "Yes. \x1c"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for c in [None, -105, -100, -7, *range(0, 40), *range(100, 140), 300, 301, 950]:
        n = r.choice([1, 2, 3, 5, 8, 8, 40])
        begin = r.choice([0, 0, 2, 5])
        for t in range(n):
            role = ("system" if c and c % 3 == 0 and t == 0 else "user" if t % 2 == 0 else "assistant") if r.random() < 0.85 else r.choice(roles)
            text = lines[t % 5] if t < begin else r.choice(lines)
            turn = None if r.random() < 0.03 else t * r.choice([1, 1, 1, 2])
            rows.append((c, turn, role, text))
    rows += [(20, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(5)] * 2  # whole rows repeat
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"same {t}.") for c in range(400, 460) for t in range(7)]  # many equal conversations
    rows += [(777, 0, "user", "w " * 200_000 + "end."), (777, 1, "assistant", "x" * 300_000)]
    r.shuffle(rows)
    return [(*row, "clash", 1, "clash") for row in rows]


@pytest.fixture(scope="module")
def rows():
    return conversations()


@pytest.fixture(scope="module")
def talk(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def no_talk(spark):
    return spark.createDataFrame([], SCHEMA)


def in_order(turns):
    """Turns (turn, role, text): null first, ties by a digest."""
    key = lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest())
    return sorted(turns, key=key)


# Op 11

NEXT = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}


def cheapest(turns):
    """(cost, audit, repaired) by trying all edits of every row: the least cost, then the least audit."""
    seen, kind = set(), []
    for _, role, text in turns:
        blank, again = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
        seen.add((role, text))
        kind.append("blank" if blank else "duplicate" if again else "truncated" if text.rstrip(" \t\n\v\f\r")[-1] not in ".!?" else "")

    @lru_cache(None)
    def best(i, state, put):
        out = [(0, "", ())] if i == len(turns) and state in "EA" else []
        owed = "a" if state == "U" else "u"
        name = {"u": "user", "a": "assistant"}[owed]
        if i < len(turns):
            _, role, text = turns[i]
            out.append(one(2, "D", (), best(i + 1, state, 0)))
            if kind[i] not in ("blank", "duplicate"):
                worse = 5 * (kind[i] == "truncated")
                if (state, role[:1]) in NEXT:
                    out.append(one(worse, "K", (f"{role}:{text}",), best(i + 1, NEXT[state, role[:1]], 0)))
                out.append(one(1 + worse, "R", (f"{name}:{text}",), best(i + 1, NEXT[state, owed], 0)))
        if put < 2:
            out.append(one(5, "I", (f"{name}:",), best(i, NEXT[state, owed], put + 1)))
        return min((x for x in out if x), default=None)

    def one(cost, letter, line, rest):
        return rest and (cost + rest[0], letter + rest[1], line + rest[2])

    return kind, best(0, "E", 0)


def repaired_by_hand(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text, mine = " " if role is None else role, " " if text is None else text, by[conv]
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        mine.extend([(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1))
    out = {}
    for conv, turns in by.items():
        turns = in_order(turns)
        kind, (cost, audit, lines) = cheapest(turns)
        known = {t[0] for t in turns if t[0] is not None}
        illegal = sum((x[1][:1] + y[1][:1]) not in ("su", "ua", "au") for x, y in zip(turns, turns[1:], strict=False))
        out[conv] = (max(known) - min(known) + 1 - len(known) if known else 0, kind.count("blank"), kind.count("duplicate"), kind.count("truncated"),
                     illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def as_op11(spark, frame, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("talk"))
    frame.write.parquet(f"{at}/conversations.parquet")
    return repair.op11_conversation_repair(spark, at)


def test_repair_query_equals_trying_all_edits(spark, talk, rows, tmp_path_factory):
    df = as_op11(spark, talk, tmp_path_factory)
    assert dict(df.dtypes) == {"conv_id": "bigint", **dict.fromkeys(COLUMNS[:6], "bigint"), "audit": "string", "repaired_sha256": "string"}
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}
    want = repaired_by_hand(rows)
    assert len(want) == df.count() and got == want
    assert {"D", "K", "R"} == set("".join(v[6] for v in want.values())) and any(not v[6] for v in want.values())


def test_repair_query_on_the_given_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in repair.op11_conversation_repair(spark, SF).collect()} == repaired_by_hand(rows)


@pytest.fixture(scope="module")
def repairs(talk):
    return Counter(repair.repaired(repair.damaged(talk)).collect())


@pytest.mark.parametrize("chunk", [2, 7])
def test_chunks_do_not_change_repairs(talk, repairs, chunk):
    assert Counter(repair.repaired(repair.damaged(talk), chunk).collect()) == repairs


def test_fix_up_stops_where_vectors_meet():
    r = random.Random(2)
    codes = bytes(r.choice([1, 2, 1, 2, 9, 10, 3, 0, 5]) for _ in range(5_000))
    right, low, _ = repair.run_back(codes, (0, 3, 1, 2))
    guess, guess_low, _ = repair.run_back(codes, repair.END)
    again, again_low, ran = repair.run_back(codes, (0, 3, 1, 2), guess, guess_low)
    assert again == right and again_low == low and ran < 200


def test_a_very_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} " + ("x" if t % 7 else "x.")) for t in range(20_000)]
    frame = repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    one = repair.repaired(frame).collect()
    assert len(one) == 1 and len(one[0].audit) == frame.count() and one == repair.repaired(frame, 100_000).collect()


# Op 12

def trie_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        own[conv].append((turn, role or "", text or ""))
    own = {c: [(role, text) for _, role, text in in_order(t)] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = None if c is None else c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple((own.get(base, [])[:h] if c is not None else []) + turns[h:])
    nodes = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    smallest = lambda cs: min((c for c in cs if c is not None), default=None)
    children, leaves, saved = Counter(p[:-1] for p in nodes if p), Counter(), Counter()
    for p, cs in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in nodes.items():
        ends = sorted((c for c in cs if whole[c] == p), key=lambda c: (c is None, c or 0))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((smallest(cs), len(p), smallest(nodes[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], digest))
    return Counter(out)


@pytest.mark.parametrize(("most", "piece"), [(4_096, 50_000), (3, 4), (1, 1)])
def test_trie_equals_a_dictionary_of_prefixes(talk, rows, most, piece):
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.sequences_of(talk)), most, piece)
    assert Counter(map(tuple, got.collect())) == trie_by_hand(rows)


def test_trie_query_on_the_given_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    df = prefix_trie.op12_prefix_trie(spark, SF)
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    assert Counter(map(tuple, df.collect())) == trie_by_hand(rows)


def test_trie_of_one_long_shared_beginning(spark):
    rows = [(c, t, "user", "start" if t < 300 else f"{c % 25} {t}") for c in range(1, 41) for t in range(303)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.sequences_of(frame)), most=10)
    assert Counter(map(tuple, got.collect())) == trie_by_hand(rows)


# Op 13

def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints: dict):
    root = {i: i for i in prints}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


def near_texts():
    r = random.Random(9)
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) for _ in range(500)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 120))) for _ in range(150)]
    for i in range(60):
        w = texts[i].split()
        w[r.randrange(len(w))] = r.choice(words)
        texts.append(" ".join(w))
    hot = " ".join(r.choice(words) for _ in range(400)).split()
    for _ in range(150):
        w = list(hot)
        w[r.randrange(len(w))] = r.choice(words)
        texts.append(" ".join(w).upper())
    return texts + texts[:30] + [texts[0]] * 40 + ["", None, " \n", "One two", "one TWO", "a b c d", "é È ü", " ".join(r.choice(words) for _ in range(200_000))]


def test_simhash_query_columns_equal_all_pairs(spark, tmp_path_factory):
    texts = near_texts()
    rows = [(i, t, 1, "clash") for i, t in enumerate(texts)] + [(3, texts[3], 1, ""), (None, texts[5], 1, ""), (None, "nobody else has this text", 1, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp int, rows string").repartition(4)
    at = str(tmp_path_factory.mktemp("docs"))
    frame.write.parquet(f"{at}/documents.parquet")
    got = simhash.op13_simhash_dedup(spark, at).collect()
    prints = {i: fingerprint_by_hand(t) for i, t in enumerate(texts)}
    want = linked(prints)
    assert len(got) == len(rows) and len({w for w in want.values()}) < len(texts) - 200
    assert all((r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id]) for r in got if r.doc_id is not None)
    assert Counter(r.component_id for r in got if r.doc_id is None) == Counter([want[5], None])


@pytest.mark.parametrize("shard_rows", [1, 40])
def test_simhash_shards_do_not_change_links(spark, shard_rows):
    texts = near_texts()[:360]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = linked({i: fingerprint_by_hand(t) for i, t in enumerate(texts)})
    assert {r.doc_id: r.component_id for r in simhash.simhash_dedup(frame, shard_rows=shard_rows).collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_vantage_point_search_links_what_all_pairs_link(seed):
    r = np.random.default_rng(seed)
    base = r.integers(-(2**63), 2**63 - 1, 1_500, dtype=np.int64)
    flips = np.zeros((3_000, 64), np.uint8)
    for row in flips:
        row[r.choice(64, r.integers(0, 9), replace=False)] = 1
    fp = np.unique(np.concatenate([base, base[r.integers(0, 3, 3_000)] ^ np.packbits(flips, axis=1).view("<i8").ravel()]))
    r.shuffle(fp)
    for home in (len(fp), len(fp) // 3):
        found, all_pairs = simhash.Links(len(fp)), simhash.Links(len(fp))
        found.search(fp, home)
        all_pairs.leaf(fp, np.arange(home), np.arange(len(fp)))
        assert len(found.made) == len(all_pairs.made) > 100
        assert all((int(fp[a]) ^ int(fp[b])).bit_count() <= 4 or bin((int(fp[a]) ^ int(fp[b])) & (2**64 - 1)).count("1") <= 4 for a, b in found.made)


def test_empty_tables(spark, no_talk, tmp_path_factory):
    assert as_op11(spark, no_talk, tmp_path_factory).count() == 0
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.sequences_of(no_talk))).count() == 0
    assert simhash.simhash_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
