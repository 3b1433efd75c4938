"""Encoding of a corpus with a public byte-level BPE vocabulary.

The vocabulary file (ranks of byte strings) is serialised straight into a
sentencepiece BPE model: every byte string becomes a piece of byte-mapped
characters whose score is its negative rank, with identity normalisation. The
merges of highest score first are then the merges of lowest rank first.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import struct
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files; a parameter of every operator.
VOCABULARY_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
#: Fixed value: the pattern of the rank files that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The unknown piece; no byte maps to its character, so no text has it.
UNKNOWN = "\ue000"
#: Bytes of a vocabulary file that is sent to the workers.
LARGEST = 64 << 20
#: Segments whose ids a worker remembers.
CACHE = 1 << 18
#: Bytes of text that are encoded in one step (a longer text is a step of its own).
STEP = 1 << 22

OTHER, LETTER, NUMBER, SPACE, BETWEEN = range(5)


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where it is one, else the next free one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(free)) for b in range(256)]


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Byte strings and ranks of the content of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file."""
    return parse_ranks(Path(path).read_bytes())


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _flag(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: piece i is the byte string of rank i; the unknown piece comes last."""
    chars = byte_characters()
    by_rank = sorted(ranks.items(), key=lambda item: item[1])
    if [rank for _, rank in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be dense")
    piece = lambda text, score, kind: _message(1, _message(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _flag(3, kind))
    pieces = [piece("".join(chars[b] for b in token), -float(rank), 1) for token, rank in by_rank]
    pieces.append(piece(UNKNOWN, 0.0, 2))
    trainer = _flag(3, 2) + _flag(4, len(pieces)) + _flag(40, len(pieces) - 1)
    normalizer = _message(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0)
    return b"".join(pieces) + _message(2, trainer) + _message(3, normalizer)


@functools.lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """The class of every code point in the terms of PATTERN."""
    classes = np.zeros(0x110000, dtype=np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    everything = "".join(map(chr, points))
    at = np.array(points)
    for kind, what in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(what, everything):
            classes[at[found.start() : found.end()]] = kind
    return classes


def pretoken_starts(points: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Where a pre-token of PATTERN starts, for texts that are joined by the characters at ``between``."""
    kinds = character_classes()[points]
    kinds[between] = BETWEEN
    starts = np.ones(len(points), dtype=bool)
    starts[1:] = kinds[1:] != kinds[:-1]
    after = np.append(kinds[1:], BETWEEN)
    # The last white space before a word stands alone, or leads the word if it is a plain space.
    last = (kinds == SPACE) & (after < SPACE)
    starts |= last
    starts[1:][(last & (points == 0x20))[:-1]] = False
    at = np.flatnonzero((points == 0x27) & starts & (kinds == OTHER))
    if len(at):
        padded = np.append(points, [0, 0, 0])
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        starts[at[short | long] + 1] = False
        ends = np.concatenate([at[short] + 2, at[long] + 3])
        starts[ends[ends < len(starts)]] = True
    return starts


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, source: str | bytes):
        """From the path or the content of a rank file."""
        self.ranks = parse_ranks(source) if isinstance(source, bytes) else read_ranks(source)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.tokens = [token for token, _ in sorted(self.ranks.items(), key=lambda item: item[1])]
        self.map = dict(enumerate(byte_characters()))
        # No merge ever joins two bytes that stand side by side in no token, so text may be cut between them.
        self.joined = np.zeros(1 << 16, dtype=bool)
        for token in self.tokens:
            for a, b in zip(token, token[1:]):
                self.joined[a << 8 | b] = True
        self.known: dict[bytes, list[int]] = {}

    def _segments(self, segments: list[bytes]) -> list[list[int]]:
        """Ids of byte segments, each encoded by the model once while it is remembered."""
        missing = list({s for s in segments if s not in self.known})
        if len(self.known) + len(missing) > CACHE:
            self.known.clear()
            missing = list(set(segments))
        mapped = [s.decode("latin-1").translate(self.map) for s in missing]
        self.known.update(zip(missing, self.model.encode(mapped, num_threads=1) if mapped else []))
        return [self.known[s] for s in segments]

    def _step(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and their number for each text."""
        raw = b"\0".join(texts) + b"\0"
        data = np.frombuffer(raw, dtype=np.uint8)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        characters = np.flatnonzero((data & 0xC0) != 0x80)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = pretoken_starts(points, np.searchsorted(characters, ends))
        cut = np.ones(len(data), dtype=bool)
        cut[1:] = ~self.joined[data[:-1].astype(np.uint16) << 8 | data[1:]]
        cut[characters[starts]] = True
        at = np.flatnonzero(cut)
        lengths = np.diff(np.append(at, len(data)))
        real = np.ones(len(data), dtype=bool)
        real[ends] = False
        lengths, at = lengths[real[at]], at[real[at]]
        if not len(at):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        # Up to seven bytes and their number fit into one integer; longer segments are numbered behind them.
        padded = np.append(data, np.zeros(8, dtype=np.uint8)).astype(np.uint64)
        keys = lengths.astype(np.uint64) << np.uint64(56)
        for k in range(7):
            more = lengths > k
            keys[more] |= padded[at[more] + k] << np.uint64(8 * k)
        long = np.flatnonzero(lengths > 7)
        words = [raw[a : a + n] for a, n in zip(at[long].tolist(), lengths[long].tolist())]
        numbers, distinct_words = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
        keys[long] = np.uint64(0xFF << 56) | numbers.astype(np.uint64)
        codes, distinct = pd.factorize(keys)
        segments = [
            distinct_words[key & 0xFFFFFFFF] if key >> 56 == 0xFF else key.to_bytes(8, "little")[: key >> 56] for key in distinct.tolist()
        ]
        ids = self._segments(segments)
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(counts.sum()))
        first = np.cumsum(counts) - counts
        each = counts[codes]
        upto = np.cumsum(each)
        tokens = flat[np.repeat(first[codes] - upto + each, each) + np.arange(upto[-1])]
        per_text = np.bincount(np.searchsorted(ends, at), weights=each, minlength=len(texts)).astype(np.int64)
        return tokens, per_text

    def encode_column(self, texts: pa.Array) -> pa.ListArray:
        """Token ids of a column; the empty list for a null and an empty text."""
        values = [(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts]
        parts, sizes, start = [], [], 0
        while start < len(values):
            end, size = start + 1, len(values[start])
            while end < len(values) and size + len(values[end]) <= STEP:
                size += len(values[end])
                end += 1
            tokens, each = self._step(values[start:end])
            parts.append(tokens)
            sizes.append(each)
            start = end
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, dtype=np.int64)
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of the texts."""
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of token ids, by the inverse mapping of their bytes."""
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


_MODELS: dict[str, ByteBpe] = {}


def encoder(digest: str, content: Broadcast[bytes]) -> ByteBpe:
    """The encoder of a rank file's content, made once per process; the content is only fetched for that."""
    if digest not in _MODELS:
        _MODELS[digest] = ByteBpe(content.value)
    return _MODELS[digest]


def encode_table(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """``(key, ids)`` of every row: the token ids of its text, without special tokens.

    A null and an empty text have the empty list; strings of special tokens
    are ordinary text; repeated rows stay repeated; a text of any length is
    encoded whole. Other columns aren't read. No shuffle: the rows go through
    Arrow batches where they are read. The driver alone reads the vocabulary
    file, of at most ``LARGEST`` bytes; the workers get its content.
    """
    content = Path(vocabulary or os.path.join(VOCABULARY_DIR, "byte_bpe_50k.tiktoken")).read_bytes()
    if len(content) > LARGEST:
        raise ValueError(f"a vocabulary of {len(content)} bytes is too large")
    digest, shared = hashlib.sha256(content).hexdigest(), df.sparkSession.sparkContext.broadcast(content)
    rows = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(digest, shared)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), model.encode_column(batch.column(1))], names=["__key", "ids"])

    kind = rows.schema["__key"].dataType.simpleString()
    return rows.mapInArrow(run, f"`__key` {kind}, ids array<int>").withColumnRenamed("__key", key)
