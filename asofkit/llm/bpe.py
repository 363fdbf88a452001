"""Op 2: BPE encoding without merging: longest token matches, checked against pairs that cannot stand side by side.

``Vocabulary`` holds what a tokenizer file says: the bytes of each token, the rank of each merge, the merge each token
comes from. ``Encoder`` finds, for each place of a word, the longest token that begins there (one Aho-Corasick pass
over the reversed word), and goes left to right: a token may follow another only if merging would never have crossed
their border; else the next shorter token is tried, and with none left the last token is taken back. A place that was
given up is not tried again, so the time is linear in the word. The result equals the merges'.

Words are cut as the file's pre-tokenizer does. A cache of chunks between white space, bounded per worker, saves
encoding a word again. ``Decoder`` joins token texts out of one byte string by an offset table.

Defined results: null counts as empty; a text without words has no ids and decodes to the empty text. Rows that repeat
are encoded one for one; an empty table gives no rows. Special tokens' strings inside a text become their ids, as the
library has it. Other columns are carried, whatever their names; only the result columns must not clash with them,
so they are given by the caller.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from asofkit.llm.common import bounded, caching, strings, table, thrifty

#: White space as the tokenizers library has it (Unicode White_Space).
_SPACE = regex.compile(r"[\t-\r\x20\x85\xa0  -     　]+")
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")
_END = 256
#: Most entries of each of a worker's three caches; a full one is emptied.
CACHED = 200_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A tokenizers file of the word-end BPE kind. Symbols are bytes; a word's last byte is another symbol (plus 256)."""

    def __init__(self, source: str):
        d = json.loads(source)
        model, letters = d["model"], byte_letters()
        self.end, vocab = model["end_of_word_suffix"], model["vocab"]
        kinds = [x["type"] for x in d["normalizer"]["normalizers"]], [x["type"] for x in d["pre_tokenizer"]["pretokenizers"]]
        if not self.end or kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or d["decoder"] or model["ignore_merges"]:
            raise ValueError("not a word-end BPE file of the known kind")
        self.pattern = d["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = {x["content"]: x["id"] for x in d["added_tokens"]}

        def symbols(token: str) -> str:
            body, last = (token[: -len(self.end)], True) if token.endswith(self.end) and token != self.end else (token, False)
            text = "".join(chr(letters[c]) for c in body)
            return text[:-1] + chr(ord(text[-1]) + _END) if last else text

        self.ids = {symbols(t): i for t, i in vocab.items()}
        self.texts = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # Ranks: base symbols first, then merges in order. Each token must come from one merge only.
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = [(symbols(a), symbols(b)) for a, b in merges]
        self.rank = {s: r for r, s in enumerate(s for s in self.ids if len(s) == 1)}
        base = len(self.rank)
        self.parts, self.pairs = {}, {}
        for r, (a, b) in enumerate(pairs):
            if a + b in self.rank:
                raise ValueError("a token comes from two merges: the pair table needs one")
            self.rank[a + b] = base + r
        for a, b in pairs:
            self.parts[self.rank[a + b]] = self.rank[a], self.rank[b]
            self.pairs[self.rank[a], self.rank[b]] = self.rank[a + b]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        v, self.v = vocabulary, vocabulary
        by_rank = sorted(v.rank, key=v.rank.get)
        self.lengths = [len(s) for s in by_rank]
        self.ids = [v.ids[s].to_bytes(4, "little") for s in by_rank]
        self.shorter = [next((v.rank[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in v.rank), -1) for s in by_rank]
        self.find = ahocorasick.Automaton()
        for s, r in v.rank.items():
            self.find.add_word(s[::-1], r)
        self.find.make_automaton()
        self.allowed: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(v.pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, v.special)) + ")") if v.special else None
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves a border between these tokens: undo merges on both sides of it, latest first; no pair
        met on the way may merge earlier than what is undone."""
        known = self.allowed.get((left, right))
        if known is not None:
            return known
        a, b, limit, parts = left, right, 1 << 62, self.v.parts
        while True:
            met = self.v.pairs.get((a, b))
            if met is not None and met < limit:
                ok = False
                break
            undo_left = a in parts and (b not in parts or a > b)
            if undo_left:
                limit, a = a, parts[a][1]
            elif b in parts:
                limit, b = b + 1, parts[b][0]
            else:
                ok = True
                break
        if len(self.allowed) > CACHED:
            self.allowed.clear()
        self.allowed[left, right] = ok
        return ok

    def word(self, word: str) -> bytes:
        """Ids of one pre-tokenized word, little-endian, 4 bytes each."""
        s = word.encode().decode("latin-1")
        s = s[:-1] + chr(ord(s[-1]) + _END)
        n, lengths, shorter, allowed = len(s), self.lengths, self.shorter, self.allowed
        longest = [-1] * n  # by end in the reversed word; matches at one end come longest first
        for end, r in self.find.iter(s[::-1]):
            if longest[end] < 0:
                longest[end] = r
        longest.reverse()
        tokens, at, token, last, dead = [], 0, longest[0], -1, set()
        while True:
            if token < 0:  # nothing shorter begins here: take back the last token
                dead.add(at)
                token = tokens.pop()
                at -= lengths[token]
                last = tokens[-1] if tokens else -1
                token = shorter[token]
                continue
            end = at + lengths[token]
            if end not in dead:
                ok = True if last < 0 else allowed.get((last, token))
                if ok is None:
                    ok = self.compatible(last, token)
                if ok:
                    tokens.append(token)
                    if end == n:
                        break
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
        return b"".join([self.ids[t] for t in tokens])

    def _plain(self, text: str) -> bytes:
        out = []
        for w in self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()):
            got = self.words.get(w)
            if got is None:
                if len(self.words) > CACHED:
                    self.words.clear()
                got = self.words[w] = self.word(w)
            out.append(got)
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        got = self._plain(chunk)
        if len(chunk) < 64:
            if len(self.chunks) > CACHED:
                self.chunks.clear()
            self.chunks[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        if self.cut is not None and "<" in text:
            return b"".join(np.uint32(self.v.special[x]).astype("<u4").tobytes() if x in self.v.special else self._parted(x)
                            for x in self.cut.split(text))
        return self._parted(text)

    def _parted(self, text: str) -> bytes:
        """White space never joins words, so chunks between it are encoded one by one."""
        chunks = text.split() if not _SEPARATORS.search(text) else [x for x in _SPACE.split(text) if x]
        known, make = self.chunks.get, self._chunk
        return b"".join([known(c) or make(c) for c in chunks])


class Decoder:
    """Token texts joined with a space, as the library does for files without a decoder."""

    def __init__(self, vocabulary: Vocabulary):
        size = max(vocabulary.texts) + 1
        texts = [(vocabulary.texts.get(i, "") + " ").encode() for i in range(size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        start, lengths = self.offsets[ids], np.diff(self.offsets)[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(start - ends + lengths, lengths) + np.arange(ends[-1])
        return self.blob[at][:-1].tobytes()


@lru_cache(maxsize=2)
def tools(source: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder per worker and vocabulary."""
    v = Vocabulary(source)
    return Encoder(v), Decoder(v)


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """All columns of ``docs``, with the ids (array of long) and, if named, the decoded text.

    vocabulary: path of the tokenizers file, read by the driver alone and handed to the workers (a few MB, fixed).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    new = [StructField(ids, ArrayType(LongType(), False))] + ([StructField(decoded, StringType())] if decoded else [])
    clash = {f.name.lower() for f in docs.schema} & {f.name.lower() for f in new}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist: name the result columns otherwise")
    schema = StructType([*docs.schema, *new])
    arrow = to_arrow_schema(schema)

    def run(batches):
        caching(tools.cache_clear)
        encoder, decoder = tools(source.value)
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), 256):
                batch = whole.slice(at, 256)
                coded = [np.frombuffer(encoder.encode(t), "<u4") for t in strings(batch, text)]
                offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
                flat = np.concatenate(coded) if coded else np.empty(0, np.uint32)
                cols = [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64)))]
                if decoded:
                    cols.append(pa.array([decoder.decode(c).decode() for c in coded], pa.string()))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return bounded(docs).mapInArrow(thrifty(run), schema)


def with_digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    def digest(batches):
        for batch in batches:
            col = batch.column(ids)
            flat, off = np.ascontiguousarray(col.flatten().to_numpy(zero_copy_only=False)).astype("<u4"), col.offsets.to_numpy() - col.offsets[0].as_py()
            texts = batch.column(decoded).to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(off).astype(np.int64)),
                pa.array([hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return bounded(encoded.select("doc_id", ids, decoded)).mapInArrow(thrifty(digest), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """Every row of documents: number of ids, digest of the ids, digest of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_digests(bpe_encode(docs, public_tokenizers.path(vocabulary), decoded="decoded"))
