"""Op 10: quality rules by compression bands.

Text that compresses far better than prose repeats itself; text that hardly compresses is noise or encoded data. Whole
documents and chunks of ``CHUNK`` bytes are compressed with zstandard; the ratio (compressed / raw) must lie in the
band of its length: short texts compress badly by nature, long ones well. A document is rejected if its own ratio lies
outside of its band, or if more than ``tolerated`` of its chunks do: half of two, a share that falls with their number,
a tenth from ten chunks (40 KB) on.

The fixed values of the contract (words, symbols, repeated lines and windows) are counted in the same pass.

Defined results: null text counts as empty; texts of fewer than 20 words fail the base rule. Windows of 8 words are
compared by 64-bit hashes. Rows that repeat are judged one for one; an empty table gives no rows; other columns are not
read. A very long text is compressed in one piece by a task (memory: the text and its output).
"""

from __future__ import annotations

import re

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession

from asofkit.llm.common import SPACES, map_arrow, table, utf8
from asofkit.llm.ngram_join import windows, word_hashes

#: (bytes up to, least ratio, most ratio), zstandard level 3. Prose lies well inside at each length.
BANDS = ((256, 0.45, 1.10), (1_024, 0.32, 0.90), (4_096, 0.25, 0.75), (16_384, 0.20, 0.65), (1 << 62, 0.12, 0.60))
CHUNK = 4_096
BAD_CHUNKS, BAD_IN_LONG = 0.5, 0.1
_SYMBOLS = re.compile(rb"[#*$%&|<>]")


def _outside(raw: int, packed: int) -> bool:
    low, high = next((lo, hi) for upto, lo, hi in BANDS if raw <= upto)
    return not low <= packed / raw <= high


def tolerated(size: int) -> float:
    """The share of chunks that may lie outside of their bands in a text of so many bytes: one chunk, a tenth in long texts."""
    return min(BAD_CHUNKS, max(BAD_IN_LONG, 1 / max(-(-(size - CHUNK // 2) // CHUNK), 1)))


def ratios(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float]:
    """The whole text's ratio, and the share of its chunks outside of their bands. A rest under half a chunk joins the last."""
    if not text:
        return 1.0, 0.0
    whole = len(packer.compress(text))
    cuts = list(range(0, max(len(text) - CHUNK // 2, 1), CHUNK)) + [len(text)]
    if len(cuts) == 2:
        return whole / len(text), float(_outside(len(text), whole))
    bad = sum(_outside(b - a, len(packer.compress(text[a:b]))) for a, b in zip(cuts, cuts[1:], strict=False))
    return whole / len(text), bad / (len(cuts) - 1)


def repeated_words(words: list[bytes], n: int = 8) -> int:
    """Words that lie in a window of ``n`` words found twice or more in the text."""
    if len(words) <= n:
        return 0
    found = windows(word_hashes(words), n)
    ordered = np.sort(found)
    if (ordered[1:] != ordered[:-1]).all():
        return 0
    _, place, count = np.unique(found, return_inverse=True, return_counts=True)
    again = count[place] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:len(again)] += again
    edge[n : n + len(again)] -= again
    return int((np.cumsum(edge)[:-1] > 0).sum())


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def quality_rules(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """A row per row of ``docs``: counts, base_failed, ratio, bad_chunks (share) and kept."""
    def judge(batch):
        packer = zstandard.ZstdCompressor(level=3)
        cols = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunks")}
        for t in utf8(batch, "t"):
            words = t.split()
            joined = b"".join(words)
            points = len(joined) if joined.isascii() else len(joined.decode())
            n, again = len(words), repeated_words(words)
            failed = n < 20 or 100 * again > 30 * n
            ratio, bad = ratios(t, packer)
            ok = not failed and not _outside(len(t), ratio * len(t)) and bad <= tolerated(len(t))
            for k, v in zip(cols, (n, points, len(_SYMBOLS.findall(t)), repeated_lines(t), again, failed, ok, ratio, bad), strict=True):
                cols[k].append(v)
        return {"doc_id": batch.column("i"), **cols}

    return map_arrow(docs.selectExpr(f"`{id}` AS i", f"`{text}` AS t"), judge, (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, ratio double, bad_chunks double"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
