"""Byte-level BPE with a sentencepiece model made from a rank file.

The vocabulary is written out as a sentencepiece BPE model: each byte stands
for one character, a piece's score is its negative rank, and normalisation is
the identity, so that the pair with the lowest rank merges first and leftmost
first, as in the rank file's own algorithm.  Texts are cut by the tokenizer's
pattern, each cut is encoded on its own, and ids decode by the inverse table.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections import ChainMap
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SHIFT = 0x100  # byte b is written as this character and the following ones
_KEEP = 1 << 18  # encoded pre-tokens kept by a worker
_LONG = 64  # characters beyond which a pre-token is not kept
_PART = 1 << 18  # characters of a text that is taken whole, and pre-tokens of a longer one taken at a time
_TOGETHER = 1 << 20  # characters of short texts encoded together
_LATIN = 0x250  # code points below have a pattern of their own, which is faster


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which run from 0 without gaps."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """A protocol buffer field: varint, 32-bit float, or bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def as_characters(data: bytes) -> str:
    return "".join([chr(_SHIFT + b) for b in data])


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model whose piece i is token i; the unknown piece comes last."""
    normal, unknown = 1, 2
    pieces = [_field(1, _field(1, as_characters(t).encode()) + _field(2, float(-i)) + _field(3, normal)) for i, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    # model_type BPE, vocab_size, unk_id, and no bos, eos or pad (-1 as a 64-bit varint)
    none = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(41, none) + _field(42, none) + _field(43, none)
    # identity, without dummy prefix, space removal or space escaping
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


def _ranges(characters: Iterable[str]) -> str:
    """Characters as ranges for a bracketed class."""
    out: list[list[int]] = []
    for c in sorted(map(ord, characters)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join([f"\\U{a:08x}-\\U{b:08x}" for a, b in out])


def explicit(pattern: str, limit: int = 0x110000) -> re.Pattern:
    """The pattern with its Unicode classes written out as tiktoken has them, for texts whose code points are below limit."""
    import tiktoken

    every = "".join([chr(c) for c in range(limit) if not 0xD800 <= c < 0xE000])

    def members(name: str) -> str:
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        return _ranges(set(b"".join([bytes(probe.encode_ordinary(every[a : a + 65536])) for a in range(0, len(every), 65536)]).decode()))

    known: dict[str, str] = {}
    out, inside = [], False
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.S):
        if part[:2] == r"\p" or part == r"\s":
            known[part] = known.get(part) or members(part)
            part = known[part] if inside else f"[{known[part]}]"
        elif part == r"\S" and not inside:
            known[r"\s"] = known.get(r"\s") or members(r"\s")
            part = f"[^{known[r'\s']}]"
        elif len(part) > 1 and part[1].isalpha():
            raise ValueError(f"the pattern has {part}, which is not known here")
        inside = part == "[" or inside and part != "]"
        out.append(part)
    return re.compile("".join(out))


class ByteBpe:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        from sentencepiece import SentencePieceProcessor

        self.tokens = read_ranks(path)
        self.pieces = SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.pattern = pattern
        self.latin = explicit(pattern, _LATIN)
        self.beyond = re.compile(f"[^\0-{chr(_LATIN - 1)}]")
        self.bytes_of = {str(i): t for i, t in enumerate(self.tokens)}
        self.known: dict[str, str] = {}

    @cached_property
    def wide(self) -> re.Pattern:
        return explicit(self.pattern)

    def _learn(self, cuts: set[str]) -> dict[str, str]:
        """Ids, as text, of pre-tokens that are not known yet; short ones are known from now on."""
        new = list(cuts)
        ids = self.pieces.encode([as_characters(c.encode()) for c in new], num_threads=1)
        found = {c: ",".join(map(str, x)) for c, x in zip(new, ids, strict=True)}
        if len(self.known) + len(found) > _KEEP:
            self.known = {}
        self.known.update((c, x) for c, x in found.items() if len(c) <= _LONG)
        return found

    def _joined(self, groups: list[list[str]]) -> list[str]:
        """For each list of pre-tokens its ids in decimal, joined by commas."""
        table = self.known
        if new := set().union(*groups).difference(table):
            found = self._learn(new)
            if self.known is not table or any(len(c) > _LONG for c in new):
                both = ChainMap(found, table)
                return [",".join([both[c] for c in g]) for g in groups]
        return [",".join(map(table.__getitem__, g)) for g in groups]

    def _split(self, text: str) -> re.Pattern:
        return self.wide if self.beyond.search(text) else self.latin

    def parts(self, text: str) -> Iterator[str]:
        """The text's ids as text, a bounded number of pre-tokens at a time."""
        found = (m.group() for m in self._split(text).finditer(text))
        while some := list(islice(found, _PART)):
            yield self._joined([some])[0]

    def encode(self, text: str) -> list[int]:
        return [int(i) for part in self.parts(text) for i in part.split(",")]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def _encoded(self, texts: Iterable[str]) -> Iterator[Iterator[str]]:
        """For each text the parts of its ids as text; short texts are encoded together."""
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) > _PART or size + len(text) > _TOGETHER:
                yield from (iter([x]) for x in self._joined(waiting)) if waiting else ()
                waiting, size = [], 0
            if len(text) > _PART:
                yield self.parts(text)
            else:
                waiting.append(self._split(text).findall(text))
                size += len(text)
        if waiting:
            yield from (iter([x]) for x in self._joined(waiting))

    def digests(self, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """For each text (number of ids, SHA-256 of the ids joined by commas, SHA-256 of what they decode to)."""
        return map(self._digest, self._encoded(texts))

    def lengths(self, texts: Iterable[str]) -> Iterator[int]:
        """For each text the number of its ids."""
        return (sum(p.count(",") + 1 for p in parts if p) for parts in self._encoded(texts))

    def _digest(self, parts: Iterator[str]) -> tuple[int, str, str]:
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for part in parts:
            if part:
                ids.update((b"," if n else b"") + part.encode())
                each = part.split(",")
                n += len(each)
                decoded.update(b"".join(map(self.bytes_of.__getitem__, each)))
        return n, ids.hexdigest(), decoded.hexdigest()


@lru_cache(2)
def loaded(path: str, pattern: str) -> ByteBpe:
    """The encoder, made once in each worker."""
    return ByteBpe(path, pattern)


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The whole text is encoded, without special tokens; a null text counts as
    empty.  An empty text has 0 tokens and the digests of the empty string.
    Null ids stay null and repeated rows stay repeated.  An empty table gives an
    empty result.  Other columns are not looked at.  path must lead to the rank
    file on every executor.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            rows = list(bpe.digests(t.as_py() or "" for t in batch["text"]))
            n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of each row, as token_digests() has them."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                ids = bpe.encode(batch["text"][i].as_py() or "")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([ids], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def decode_ids(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (binary): what the ids of encode_ids() stand for; null ids give null."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            data = [None if x is None else bpe.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, data binary")
