"""Encoding of a corpus by a public byte-level BPE vocabulary, and streaming decoding (problem 6).

Method: the merges are compiled into a finite-state transducer over bytes whose states are made when first needed. A
state is what the input still leaves open: the last token that is certain and the bytes after it. Reading a byte adds
one boundary, whose token is the only one that the merges allow next to the token before it; tokens that all open
readings share are emitted, so the lookahead is bounded by the longest token of the vocabulary. Decoding feeds the
tokens' bytes to an incremental UTF-8 state machine and gives text as soon as a character is complete.

Null and empty texts get an empty list. Texts are encoded whole, special tokens' names in them are ordinary text.
Repeated rows are encoded each; any other columns are left alone.
"""

from __future__ import annotations

import base64
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm.common import table

# Fixed value: the pattern that splits a text before the merges, as published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "byte_bpe_50k.tiktoken"
MEMO = 300_000  # pieces whose tokens a worker remembers; beyond, it starts anew
STATES = 400_000  # states a worker keeps; beyond, it starts anew


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids, which are the order of the merges."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class State:
    """What is certain (the last token, -1 at the start) and what is open (bytes after it, the token that ends at each)."""

    __slots__ = ("final", "last", "next", "open", "token")

    def __init__(self, token: int, open_: bytes, last: tuple[int, ...], final: tuple[int, ...]):
        self.token, self.open, self.last, self.final, self.next = token, open_, last, final, {}


class Transducer:
    """Byte-level BPE as a transducer whose states are determinised when first reached."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.heads = {b[:n] for b in ranks for n in range(1, len(b))}  # proper beginnings of tokens
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple[int, bytes], State] = {}
        self.start = self._state(-1, b"", ())

    def _merged(self, text: bytes) -> list[bytes]:
        parts = [text[i : i + 1] for i in range(len(text))]
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens apart when they stand side by side."""
        if left < 0:
            return True
        key = (left, right)
        if key not in self.pairs:
            a, b = self.bytes[left], self.bytes[right]
            self.pairs[key] = self._merged(a + b) == [a, b]
        return self.pairs[key]

    def _chain(self, last: tuple[int, ...], at: int) -> list[tuple[int, int]]:
        """(boundary, token that ends there) from a boundary back to the certain one, nearest first."""
        out = []
        while at > 0:
            t = last[at - 1]
            out.append((at, t))
            at -= len(self.bytes[t])
        return out

    def _state(self, token: int, open_: bytes, last: tuple[int, ...]) -> State:
        key = (token, open_)
        s = self.states.get(key)
        if s is None:
            final = tuple(t for _, t in reversed(self._chain(last, len(open_))))
            s = self.states[key] = State(token, open_, last, final)
        return s

    def step(self, s: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """The next state and the tokens that have become certain."""
        data = s.open + bytes((byte,))
        n = len(data)
        found = -1
        for j in range(n):  # longest first; exactly one fits
            t = self.ranks.get(data[j:])
            if t is not None and self._fits(s.token if j == 0 else s.last[j - 1], t):
                found = t
                break
        last = (*s.last, found)
        # boundaries at which a later token may still begin, and what their readings share
        live = [j for j in range(n) if data[j:] in self.heads]
        shared = [0, *(at for at, _ in reversed(self._chain(last, n)))]
        for j in live:
            own = {0, *(at for at, _ in self._chain(last, j))}
            shared = [at for at in shared if at in own]
        cut = shared[-1]
        sure = tuple(t for _, t in reversed(self._chain(last, cut)))
        if cut:
            s2 = self._state(sure[-1], data[cut:], last[cut:])
        else:
            s2 = self._state(s.token, data, last)
        s.next[byte] = (s2, sure)
        return s2, sure

    def feed(self, data: bytes) -> list[int]:
        """Tokens of one piece."""
        s, out = self.start, []
        for b in data:
            hit = s.next.get(b)
            s, sure = hit if hit is not None else self.step(s, b)
            if sure:
                out.extend(sure)
        out.extend(s.final)
        if len(self.states) > STATES:
            self.states, self.pairs = {}, {}
            self.start = self._state(-1, b"", ())
        return out


class Utf8:
    """Incremental UTF-8: bytes in, complete characters out; what no character can begin with becomes U+FFFD."""

    # first byte -> bytes that follow, smallest and largest second byte
    LEAD = {
        **{b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}, 0xE0: (2, 0xA0, 0xBF), **{b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)}, 0xED: (2, 0x80, 0x9F),
        0xF0: (3, 0x90, 0xBF), **{b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}, 0xF4: (3, 0x80, 0x8F),
    }

    def __init__(self):
        self.held, self.need, self.low, self.high = bytearray(), 0, 0x80, 0xBF

    def push(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.held.append(b)
                    self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(self.held.decode("utf-8"))
                        self.held = bytearray()
                    continue
                out.append("�")
                self.held, self.need, self.low, self.high = bytearray(), 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif b in self.LEAD:
                self.need, self.low, self.high = self.LEAD[b]
                self.held = bytearray((b,))
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        rest, self.held, self.need = ("�" if self.need else ""), bytearray(), 0
        return rest


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int]):
        import regex

        self.machine, self.split, self.memo = Transducer(ranks), regex.compile(PATTERN).findall, {}

    def encode(self, text: str | None) -> array:
        out, memo = array("i"), self.memo
        for piece in self.split(text) if text else ():
            ids = memo.get(piece)
            if ids is None:
                if len(memo) > MEMO:
                    memo.clear()
                ids = array("i", self.machine.feed(piece.encode("utf-8", "replace")))
                if len(piece) <= 64:
                    memo[piece] = ids
            out.extend(ids)
        return out

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text piece by piece, each as early as its characters are complete."""
        utf8 = Utf8()
        for i in ids:
            if piece := utf8.push(self.machine.bytes[i]):
                yield piece
        if rest := utf8.end():
            yield rest


def _tokenizer(ranks) -> Tokenizer:
    """The worker's tokenizer, kept from task to task."""
    kept = sys.modules.setdefault("_pagelode_tokenizers", types.ModuleType("_pagelode_tokenizers")).__dict__
    if ranks.id not in kept:
        kept[ranks.id] = Tokenizer(ranks.value)
    return kept[ranks.id]


class Ranks:
    """A vocabulary sent once to every executor; its size is that of the file, whatever the corpus."""

    def __init__(self, spark: SparkSession, path: str):
        self.id, self._sent = path, spark.sparkContext.broadcast(load_ranks(path))

    @property
    def value(self) -> dict[bytes, int]:
        return self._sent.value


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, ids."""
    ranks = Ranks(docs.sparkSession, path or vocabulary_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(ranks)
        for batch in batches:
            flat, ends = array("i"), array("i", [0])
            for text in batch.column("text").to_pylist():
                flat.extend(tok.encode(text))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(memoryview(ends), pa.int32()), pa.array(memoryview(flat), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def count_tokens(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """docs(doc_id, text, and text columns to keep) -> doc_id, those columns, n_tokens; 0 for null and empty texts."""
    ranks = Ranks(docs.sparkSession, path or vocabulary_path())
    heads = ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(ranks)
        for batch in batches:
            n = pa.array([len(tok.encode(t)) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in heads], n], names=[*heads, "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in keep], "text")
    return rows.mapInArrow(run, "doc_id long, " + "".join(f"{c} string, " for c in keep) + "n_tokens long")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_tokens, same: whether the streaming decoder gives the text back."""
    ranks = Ranks(docs.sparkSession, path or vocabulary_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(ranks)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [tok.encode(t) for t in texts]
            same = ["".join(tok.decode(i)) == (t or "") for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, ids), pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_tokens", "same"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, same boolean")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the ids of its text by byte_bpe_50k, without special tokens."""
    return encode(table(spark, sf_dir, "documents"))


def p6_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
