"""Operator 11: token counts with a whole-token shortcut.

``prove`` runs offline, once for a vocabulary: it encodes every vocabulary
string alone and keeps those that come back as one token.  The count of a
pre-token depends on the pre-token alone, so a pre-token among them counts 1
without a merge; only the rest goes through the merges of the library.

* ``.json`` (``tokenizers``): with a byte-level pre-tokenizer and no
  normalizer, a text is cut at single blanks between non-blanks, where its
  pattern never matches across, and around a lone line feed or before closing
  punctuation.  Strings of added tokens inside a text are one token each, as
  in the library.  Other tokenizers encode whole texts.
* ``.model`` (``sentencepiece``): with an identity normalizer, and if no piece
  holds a blank behind another character, no merge crosses a single blank, so
  the same cuts hold.  Other models encode whole texts.

The proven strings (at most the vocabulary) are broadcast.  Parts seen before
come from a bounded cache; parts of over ``CACHE_CHARS`` characters are never
kept.

Edge cases: a null text counts as the empty text (no bytes, no tokens); a null
id stays; repeated rows give repeated results; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyframe.llm.bpe import byte_table, finer, parts_of
from tallyframe.llm.common import pick

LIMIT = 1024
#: Parts that a worker keeps beside the proven strings, and the longest of them.
CACHE_PARTS = 150_000
CACHE_CHARS = 64


class JsonCounter:
    """Token counts of a ``tokenizers`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores already
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        for key in ("truncation", "padding"):
            spec[key] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.model, self.cutter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.vocabulary = spec["model"]["vocab"]
        added = spec.get("added_tokens") or []
        plain = all(not t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        cutter = spec.get("pre_tokenizer") or {}
        self.cuttable = (plain and spec.get("normalizer") is None and cutter.get("type") == "ByteLevel"
                         and cutter.get("use_regex", True) and not cutter["add_prefix_space"])
        names = sorted((t["content"] for t in added), key=len, reverse=True)  # the longest of those that start at a place
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.back, self.blank = {c: b for b, c in enumerate(byte_table())}, byte_table()[32]

    def prove(self) -> list[str]:
        """Vocabulary strings that alone are one pre-token and one token.

        Entries that are no whole characters can't be a pre-token.
        """
        if not self.cuttable:
            return []
        out = []
        for spelled in self.vocabulary:
            try:
                text = bytes(self.back[c] for c in spelled).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            alone = self.cutter.pre_tokenize_str(text)
            if len(alone) == 1 and len(self.model.tokenize(alone[0][0])) == 1:
                out.append(text)
        return out

    def merged(self, part: str) -> int:
        """Tokens of a part that isn't proven: its pre-tokens through the merges.

        ASCII letters, or digits, after at most one blank are one pre-token.
        """
        core = part.removeprefix(" ")
        if core.isascii() and (core.isalpha() or core.isdigit()):
            return len(self.model.tokenize(core if len(core) == len(part) else self.blank + core))
        return sum(len(self.model.tokenize(spelled)) for spelled, _ in self.cutter.pre_tokenize_str(part))

    def split(self, text: str) -> tuple[list[str], int]:
        """Stretches between strings of added tokens, and how many of these there are."""
        if self.added is None:
            return [text], 0
        stretches = self.added.split(text)
        return stretches, len(stretches) - 1

    def pieces(self, part: str) -> list[str]:
        core = part.removeprefix(" ")
        return [part] if core.isascii() and core.isalnum() else finer(part)

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


class PieceCounter:
    """Token counts of a ``sentencepiece`` model."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = model.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        how = spec.normalizer_spec
        names = [p.piece for p in spec.pieces]
        self.cuttable = (not how.precompiled_charsmap and how.add_dummy_prefix and not how.remove_extra_whitespaces
                         and how.escape_whitespaces and spec.trainer_spec.model_type == 2
                         and not any("▁" in n.lstrip("▁") for n in names))
        self.names = names

    def prove(self) -> list[str]:
        """" word" for every piece that comes back alone from "word"."""
        words = [n[1:] for n in self.names if n.startswith("▁") and len(n) > 1 and "▁" not in n[1:]] if self.cuttable else []
        return [" " + w for w, ids in zip(words, self.library.encode(words, num_threads=1) if words else []) if len(ids) == 1]

    def merged(self, part: str) -> int:
        """A part opens with the blank that the library puts before a text."""
        return len(self.library.encode(part[1:]))

    def split(self, text: str) -> tuple[list[str], int]:
        return [" " + text] if text else [], 0

    def pieces(self, part: str) -> list[str]:
        return [part]

    def whole(self, text: str) -> int:
        return len(self.library.encode(text))


def library_of(path: str) -> JsonCounter | PieceCounter:
    return PieceCounter(path) if path.endswith(".model") else JsonCounter(path)


def prove(path: str) -> list[str]:
    """The strings of a vocabulary that count 1 wherever they are a pre-token."""
    return library_of(path).prove()


class Counts(dict):
    """Part -> its tokens.  Proven strings are always in it."""

    def __init__(self, path: str, proven: list[str]):
        self.library, self.proven, self.older = library_of(path), dict.fromkeys(proven, 1), {}
        super().__init__(self.proven)

    def __missing__(self, part: str) -> int:
        n = self.older.get(part)
        if n is None:
            pieces = self.library.pieces(part)
            n = self.library.merged(part) if len(pieces) == 1 else sum([self[p] for p in pieces])
        if len(part) <= CACHE_CHARS:
            if len(self) >= CACHE_PARTS + len(self.proven):
                self.older = dict(self)
                self.clear()
                self.update(self.proven)
            self[part] = n
        return n

    def of(self, text: str) -> int:
        """Tokens of a whole text."""
        if not self.library.cuttable:
            return self.library.whole(text)
        stretches, n = self.library.split(text)
        return n + sum(sum(map(self.__getitem__, parts_of(s))) for s in stretches)


_WORKERS: dict[str, Counts] = {}


def counts_of(path: str, proven: list[str]) -> Counts:
    """One table of counts for each worker process and vocabulary."""
    if path not in _WORKERS:
        _WORKERS[path] = Counts(path, proven)
    return _WORKERS[path]


def count_column(spark, path: str):
    """Column function: text -> its number of tokens."""
    proven = spark.sparkContext.broadcast(prove(path))  # at most the vocabulary

    @arrow_udf("bigint")
    def tokens(texts: pa.Array) -> pa.Array:
        counts = counts_of(path, proven.value)
        return pa.array([counts.of(t or "") for t in texts.to_pylist()], pa.int64())

    return tokens


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    return pick(docs, "doc_id", "text").select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        count_column(docs.sparkSession, path)("text").alias("n_tokens"),
    ).withColumn("over_limit", F.coalesce(F.col("n_tokens") > limit, F.lit(False)))
