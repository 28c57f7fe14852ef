"""Operator 1: byte-level BPE encoding and decoding.

The ``tokenizers`` library runs inside Arrow batches.  Bytes are written as
characters through the byte table of byte-level BPE; ids are the ranks of a
tiktoken vocabulary file.  Every split of a token into two known tokens is a
merge, ranked by the token it makes, so the pieces merge in tiktoken's order.

A text is cut at each single blank between two non-blank characters.  The
pattern never matches across such a cut, and the blank opens the next match,
so the parts are encoded alone; parts seen before come from a bounded cache.

Edge cases: a null text is encoded as the empty text (no ids, no bytes); a
null id stays; repeated rows give repeated results; an empty table gives an
empty result; further columns of ``encode``/``decode`` inputs stay untouched.
"""

from __future__ import annotations

import base64
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyframe.llm.common import pick

#: Parts of one generation of a worker's cache.
CACHE_PARTS = 150_000

_UNSAFE_CUT = re.compile(r"\s | \s|^ | $")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_LINE = re.compile(r"(?<=\S)(\n)(?=\S)")
_CLOSING = ".,;:!?#$%&*)"


def byte_table() -> list[str]:
    """The character that stands for each byte.

    Printable Latin-1 bytes stand for themselves, the others are numbered
    upwards from U+0100.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def build_tokenizer(ranks: dict[bytes, int], pattern: str):
    """A ``tokenizers`` BPE over the byte characters that merges by rank."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table = byte_table()

    def spell(token: bytes) -> str:
        return "".join(table[b] for b in token)

    merges = sorted(
        (rank, ranks[token[:i]], ranks[token[i:]], token, i)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks)
    tokenizer = Tokenizer(models.BPE(
        vocab={spell(token): rank for token, rank in ranks.items()},
        merges=[(spell(token[:i]), spell(token[i:])) for _, _, _, token, i in merges],
        ignore_merges=True))  # a match that is a token itself is that token
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


def parts_of(text: str) -> list[str]:
    """The text cut before each single blank between non-blank characters."""
    if not text:
        return []
    if _UNSAFE_CUT.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *(" " + p for p in rest)]


def finer(part: str) -> list[str]:
    """A part cut where matches surely end: around a lone line feed, and
    between a letter and a closing run of ASCII punctuation."""
    out = []
    for piece in _LINE.split(part):
        core = piece.rstrip(_CLOSING)
        if core and core != piece and core[-1].isalpha():
            out += [core, piece[len(core):]]
        else:
            out.append(piece)
    return out


class PartIds(dict):
    """Part -> packed ids; two generations bound what a worker keeps."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.older = tokenizer, tokenizer.model, {}
        self.spelled = dict(enumerate(byte_table()))

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            pieces = finer(part)
            ids = self.encode(part) if len(pieces) == 1 else b"".join([self[p] for p in pieces])
        if len(self) >= CACHE_PARTS:
            self.older = dict(self)
            self.clear()
        self[part] = ids
        return ids

    def encode(self, piece: str) -> bytes:
        """Letters after at most one blank are one match and go to the model at once."""
        if piece.removeprefix(" ").isalpha():
            tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.spelled))
            return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Encodes texts with one tokenizer; parts seen before come from the cache."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores already
        self.tokenizer = build_tokenizer(read_ranks(path), pattern)
        self.seen = PartIds(self.tokenizer)

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.seen.__getitem__, parts_of(text)))

    def offsets(self, text: str) -> list[dict]:
        """Id and character range of each token.

        Tokens that hold only some bytes of a character share its range.
        """
        out, at = [], 0
        for part in parts_of(text):
            e = self.tokenizer.encode(part, add_special_tokens=False)
            out += [{"id": i, "start": at + a, "end": at + b} for i, (a, b) in zip(e.ids, e.offsets)]
            at += len(part)
        return out


class Decoder:
    """Ids to bytes; unknown ids raise."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        spelled, back = byte_table(), {}
        for b, c in enumerate(spelled):
            back[c] = b
        for token, rank in ranks.items():
            # by way of the characters, as the vocabulary of the tokenizer holds them
            self.tokens[rank] = bytes(back[spelled[b]] for b in token)

    def data(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_WORKERS: dict[tuple, object] = {}


def _worker(kind, *args):
    """One encoder or decoder for each worker process."""
    if (kind, args) not in _WORKERS:
        _WORKERS[kind, args] = kind(*args)
    return _WORKERS[kind, args]


def encode_column(path: str, pattern: str):
    """Column function: text -> packed ids (binary, 4 bytes an id)."""

    @arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        encoder = _worker(Encoder, path, pattern)
        return pa.array([encoder.ids(t or "") for t in texts.to_pylist()], pa.binary())

    return ids


def offsets_column(path: str, pattern: str):
    """Column function: text -> array of (id, start, end), in characters."""

    @arrow_udf("array<struct<id:int,start:int,end:int>>")
    def offsets(texts: pa.Array) -> pa.Array:
        encoder = _worker(Encoder, path, pattern)
        kind = pa.list_(pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([encoder.offsets(t or "") for t in texts.to_pylist()], kind)

    return offsets


def decode_column(path: str):
    """Column function: packed ids -> bytes."""

    @arrow_udf("binary")
    def data(ids: pa.Array) -> pa.Array:
        decoder = _worker(Decoder, path)
        return pa.array([decoder.data(i or b"") for i in ids.to_pylist()], pa.binary())

    return data


def text_column():
    """Column function: decoded bytes -> text.

    Ids of a window, not of a whole text, may begin or end inside a character;
    its bytes become U+FFFD instead of failing.
    """

    @arrow_udf("string")
    def text(data: pa.Array) -> pa.Array:
        return pa.array([(d or b"").decode("utf-8", "replace") for d in data.to_pylist()], pa.string())

    return text


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids, n_tokens); ids packed as binary."""
    out = pick(docs, "doc_id", "text").select("doc_id", encode_column(path, pattern)("text").alias("ids"))
    return out.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` (binary) to the rows of ``encode``."""
    return encoded.withColumn("decoded", decode_column(path)("ids"))


def roundtrip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: n_tokens and the digests of ids and decoded bytes."""
    both = decode(encode(docs, path, pattern), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
