"""Ops 1 and 6 on texts of megabytes: time and memory bounded, results those of short pieces."""

import random
import time
import tracemalloc

import numpy as np

from asofkit.llm import pii, secret_scan
from asofkit.llm.common import Taken


def test_taken_places_equal_a_search_of_all():
    r = random.Random(4)
    for _ in range(300):
        spans = [(a, a + r.randint(1, 9)) for a in (r.randrange(100) for _ in range(r.randint(0, 12)))]
        taken = Taken(spans)
        for _ in range(40):
            s = r.randrange(105)
            e = s + r.randint(1, 8)
            assert taken.touches(s, e) == any(a < e and s < b for a, b in spans)


def test_tokens_beside_very_many_spans_take_linear_time():
    r = random.Random(1)
    text = " ".join(f"token={r.randbytes(8).hex()} plainwordhere{i % 977}" for i in range(140_000)).encode()
    assert len(text) > 5_000_000
    began = time.process_time()
    spans = secret_scan.base_spans(text)
    others = secret_scan.other_tokens(text, spans)
    assert time.process_time() - began < 20
    assert len(spans) >= 140_000 and len(others) == 140_000


def test_a_kind_of_few_values_is_scored_with_a_wider_margin():
    r = random.Random(3)
    words = ["".join(r.choice("aeiournstl") for _ in range(r.randint(8, 20))) for _ in range(300)]
    keys = ["AKIA" + "".join(r.choice("ABCDEFGHIJ0123456789") for _ in range(16)) for _ in range(30)]
    few, many = secret_scan.Model({"access": keys[:2], "word": words}), secret_scan.Model({"access": keys[:20], "word": words})
    assert few.doubt["access"] > many.doubt["access"] == 0
    assert all(many.score(k) >= many.margin for k in keys[20:]) and all(few.score(w) < few.margin for w in words)


def test_pieces_of_long_runs_speak_for_every_place_once():
    text = b"7" * 5_000 + b" no digits here at all, for quite a while, longer than a window of the tagger is " * 3 + b"9" * 900
    starts = pii.window_starts(text)
    for windows in (8, 20, 2_048):
        pieces = pii.pieces_of(text, starts, windows)
        assert max(len(p) for p, _, _ in pieces) <= windows and {s for p, _, _ in pieces for s in p} == set(starts)
        assert pieces[0][1] == 0 and pieces[-1][2] == len(text)
        assert all(a[2] <= b[1] for a, b in zip(pieces, pieces[1:], strict=False))
        # what a piece speaks for lies inside its windows, but for stretches without any
        assert all(p[0] <= low or low == 0 for p, low, _ in pieces)


def test_a_long_text_is_tagged_in_bounded_memory_as_its_parts_are():
    tagger = pii.Tagger(size=3, hidden=4)
    r = random.Random(5)
    part = " ".join(r.choice(["call 555 0101 now", "mail me @ home", "1234 5678 9012", "no"]) for _ in range(300)).encode()
    whole = pii.added_spans([part], tagger, [[]])[0]
    assert pii.added_spans([part], tagger, [[]], windows=16)[0] is not None
    gap = b" plain words without any trigger whatever, on and on, for longer than two windows of the tagger take, really. " * 2
    gap = gap[: len(gap) // 32 * 32]
    lead = (part + b" " * (-len(part) % 32) + gap) * 16
    tracemalloc.start()
    got = pii.added_spans([lead], tagger, [[]], windows=64)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(lead) > 50_000 and peak < 40 << 20
    step = len(lead) // 16
    shifted = {(k, s + i * step, e + i * step) for i in range(16) for k, s, e in whole}
    assert isinstance(got, list) and len(set(got) ^ shifted) <= max(24, len(shifted) // 5)
    assert np.all(np.diff([s for _, s, _ in got]) > 0)
