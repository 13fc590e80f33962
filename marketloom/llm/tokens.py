"""Encoding of a corpus with a public byte-level BPE vocabulary.

Method: the merges are compiled into a finite-state transducer that is determinised lazily. It reads the bytes of one
pre-token; its state holds the bytes since the last settled boundary and, for each position there, the last token of the
prefix's encoding. A step finds the one token that ends the longer prefix (the token whose pair with the token before it
re-encodes to itself) and emits tokens as soon as all encodings still open share them; as a position stays open only while
the bytes from it begin some vocabulary entry, the lookahead is bounded by the longest entry. States and arcs are numbered as
texts need them and are kept for the life of the worker. On top of it a bounded memo holds the output of whole
white-space-led chunks, since no pre-token crosses from non-space to space.

Defined results: null and empty texts give an empty list; lone surrogates cannot occur in Arrow strings; texts of any length
are encoded whole; repeated rows stay separate rows; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import codecs
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pre-token pattern that the byte_bpe vocabularies are defined with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of Unicode, as the pattern's \s reads it.
SPACE = "\t-\r \x85\xa0  -     　"
MEMO_CHUNKS = 400_000
MAX_STATES = 2_000_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to ids, from a file of base64 tokens and ranks."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Transducer:
    """Lazily determinised transducer from the bytes of one pre-token to token ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.prefixes = {t[:k] for t in ranks for k in range(1, len(t) + 1)}
        self.longest = max(map(len, ranks))
        self.fits: dict[tuple[int, int], bool] = {}
        self.whole: dict[bytes, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple[bytes, tuple[int, ...], int]] = [(b"", (), -1)]
        self.number: dict[tuple[bytes, tuple[int, ...], int], int] = {self.states[0]: 0}
        self.open: list[tuple[int, ...]] = [(0,)]  # by state: the positions of its window from which a token may still grow
        self.arcs: dict[int, tuple[int, bytes]] = {}

    def merged(self, word: bytes) -> list[int]:
        """Plain merging by rank: the definition, used for pairs only."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def pair_fits(self, left: int, right: int) -> bool:
        key = (left, right)
        if (known := self.fits.get(key)) is None:
            known = self.fits[key] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def stands(self, token: bytes) -> bool:
        """Whether the token's bytes encode to the token alone."""
        if (known := self.whole.get(token)) is None:
            known = self.whole[token] = self.merged(token) == [self.ranks[token]]
        return known

    def step(self, state: int, byte: int) -> tuple[int, bytes]:
        """Next state and the ids that became certain, as packed 32-bit integers."""
        arc = self.arcs.get(state << 8 | byte)
        if arc is None:
            arc = self.arcs[state << 8 | byte] = self._determinise(state, byte)
        return arc

    def _determinise(self, state: int, byte: int) -> tuple[int, bytes]:
        # window: the open bytes; lasts[i]: the token ending at position i + 1 of the window; before: the token settled last
        window, lasts, before = self.states[state]
        window, found = window + bytes([byte]), -1
        end = len(window)
        for start in self.open[state]:
            piece = window[start:]
            if (token := self.ranks.get(piece)) is None or not self.stands(piece):
                continue
            left = before if start == 0 else lasts[start - 1]
            if left == -2 or left >= 0 and not self.pair_fits(left, token):
                continue
            found = token
            break
        lasts = (*lasts, found)
        # positions from which a longer token may still start; 0 is the settled boundary
        live = [p for p in self.open[state] if window[p:] in self.prefixes] + [end]
        chains = [self._boundaries(lasts, p) for p in live]
        shared = chains[0]
        for chain in chains[1:]:
            n = 0
            while n < min(len(shared), len(chain)) and shared[n] == chain[n]:
                n += 1
            shared = shared[:n]
        cut = shared[-1] if shared else 0
        out = [lasts[b - 1] for b in shared]
        if cut:
            usable = {p for chain in chains for p in chain}
            window, before = window[cut:], out[-1]
            lasts = tuple(t if i + 1 in usable else -2 for i, t in enumerate(lasts) if i >= cut)
            live = [p - cut for p in live]
        key = (window, lasts, before)
        if (number := self.number.get(key)) is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            self.open.append(tuple(live))
        return number, np.array(out, np.int32).tobytes()

    def _boundaries(self, lasts: tuple[int, ...], position: int) -> list[int]:
        """Token ends of the encoding of the window's first `position` bytes, from the left."""
        ends = []
        while position > 0:
            ends.append(position)
            position -= len(self.bytes_of[lasts[position - 1]])
        return ends[::-1]

    def encode(self, word: bytes) -> bytes:
        if len(self.states) > MAX_STATES:
            self._reset()
        state, out = 0, []
        for byte in word:
            state, ids = self.step(state, byte)
            if ids:
                out.append(ids)
        window, lasts, _ = self.states[state]
        out.append(np.array([lasts[b - 1] for b in self._boundaries(lasts, len(window))], np.int32).tobytes())
        return b"".join(out)


class Memo(dict):
    """Chunk to packed ids; a missing chunk goes through the transducer."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.transducer, self.words, self.split = transducer, {}, regex.compile(PATTERN).findall

    def __missing__(self, chunk: str) -> bytes:
        out = []
        for word in self.split(chunk):
            ids = self.words.get(word)
            if ids is None:
                ids = self.transducer.encode(word.encode("utf-8"))
                if len(word) < 64:
                    self.words[word] = ids
            out.append(ids)
        packed = b"".join(out)
        if len(chunk) < 64:
            self[chunk] = packed
        return packed

    def trim(self) -> None:
        if len(self) > MEMO_CHUNKS:
            self.clear()
        if len(self.words) > MEMO_CHUNKS:
            self.words.clear()


class Encoder:
    """Texts to packed ids."""

    def __init__(self, vocabulary: bytes) -> None:
        self.memo = Memo(Transducer(read_ranks(vocabulary)))
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall

    def packed(self, text: str | None) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.chunks(text))) if text else b""

    def ids(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


class StreamingDecoder:
    """Ids to text piece by piece: an incremental UTF-8 state machine holds back unfinished characters."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        return self.utf8.decode(b"".join(self.bytes_of[i] for i in ids), final)


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(vocabulary: bytes) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def encode(df: DataFrame, vocabulary_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids): one row per row of `df`. The vocabulary file (under 2 MB) is read once on the driver and broadcast."""
    with open(vocabulary_path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                packed = [encoder.packed(x) for x in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, packed)], dtype=np.int64) // 4
                flat = np.frombuffer(b"".join(packed), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
                encoder.memo.trim()
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["key", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", id_col)


def count_tokens(df: DataFrame, vocabulary_path: str, *, keep: tuple[str, ...] = ("doc_id", "source"), text_col: str = "text") -> DataFrame:
    """The kept columns and n_tokens of each row; only the counts leave Python."""
    with open(vocabulary_path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            counts = [len(encoder.packed(x)) // 4 for x in batch.column(batch.num_columns - 1).to_pylist()]
            encoder.memo.trim()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*keep, "n_tokens"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens bigint"
    return df.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)
