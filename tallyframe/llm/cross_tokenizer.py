"""Operator 12: alignment of the tokens of two tokenizers.

Token-byte incidence matrices A and B (a row for each token, a column for each
byte) are built by hand in compressed sparse rows.  Gustavson row products
A.Bt give the overlap links with the bytes they share; products of the
token-group incidence matrices give the links inside a group, a group being
the bytes between two offsets where tokens of both sides end.

A text is cut where neither side has a token across: at single blanks between
non-blanks, around lone line feeds and before closing punctuation, as far as no
piece of the model holds the two characters next to each other.  Tokens of both
end there, so the matrices are block-diagonal over these parts, and the parts
of a batch that weren't seen lately are multiplied at once.  A part's links are
the rows of a part-pair matrix L; the occurrences D of parts in documents then
give the links of documents as the product D.L.  If the piece model can merge
across a blank, whole texts are the parts.

The links of each document are written to the shared folder once.  Corpus-wide
counts of pairs are sums over that table.  The pairs with the highest counts,
``HEAD`` at most, are broadcast; all others are looked up by a shuffle, where
no pair has more rows than its count, so none is hot.

Edge cases: null and empty texts, and texts whose tokens' bytes differ from
blank + text, have no tokens and all columns 0 or ''; null ids stay; repeated
rows count as documents of their own; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.bpe import byte_table, finer, parts_of
from tallyframe.llm.common import pick, prepare

#: Pairs whose counts go to every task, 17 bytes each.
HEAD = 8192
#: Parts a worker keeps links of (two generations), and the longest of them.
CACHE_PARTS = 150_000
CACHE_CHARS = 64
#: Entries that a product expands at once, characters of the texts a task holds at once.
BLOCK = 1 << 20
GROUP_CHARS = 2_000_000


# --- sparse rows ----------------------------------------------------------------


@dataclass
class Rows:
    """A sparse matrix: row i has ``columns[starts[i]:starts[i + 1]]`` with these values."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def incidence(cls, ends: np.ndarray, width: int) -> "Rows":
        """Row i covers the columns from the end of row i - 1 up to ends[i]."""
        starts = np.concatenate(([0], ends)).astype(np.int64)
        return cls(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64), width)

    @classmethod
    def membership(cls, columns: np.ndarray, width: int) -> "Rows":
        """Row i has the one column columns[i]."""
        return cls(np.arange(len(columns) + 1), columns.astype(np.int64), np.ones(len(columns), np.int64), width)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def transposed(self) -> "Rows":
        order = np.argsort(self.columns, kind="stable")
        rows = np.repeat(np.arange(len(self)), self.lengths())
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Rows(starts, rows[order], self.values[order], len(self))


def fan_out(left: Rows, right: Rows) -> np.ndarray:
    """Entries that each row of the product expands before sums (the symbolic pass)."""
    each = right.lengths()[left.columns]
    sums = np.concatenate(([0], np.cumsum(each)))
    return sums[left.starts[1:]] - sums[left.starts[:-1]]


def row_blocks(left: Rows, right: Rows, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gustavson's product: (rows, columns, values) of a few rows after another.

    Every entry (i, k) adds its multiple of row k of ``right`` to row i.
    """
    lengths, sums = right.lengths(), np.cumsum(fan_out(left, right))
    at = 0
    while at < len(left):
        done = sums[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sums, done + block, "right")))
        a, b = left.starts[at], left.starts[to]
        k = left.columns[a:b]
        fan = lengths[k]
        total = int(fan.sum())
        if total:
            entry = np.repeat(np.arange(b - a), fan)
            place = np.arange(total) - np.repeat(np.cumsum(fan) - fan, fan) + right.starts[k][entry]
            row = np.repeat(np.arange(at, to), np.diff(left.starts[at:to + 1]))[entry]
            key, value = row * right.width + right.columns[place], left.values[a:b][entry] * right.values[place]
            if (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            key = key[first]
            yield key // right.width, key % right.width, np.add.reduceat(value, first)
        at = to


def product(left: Rows, right: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, values) of the whole product."""
    blocks = [*row_blocks(left, right)]
    return tuple(np.concatenate(x) for x in zip(*blocks)) if blocks else (np.zeros(0, np.int64),) * 3


# --- tokens -----------------------------------------------------------------------


class Side:
    """Ids of a ``tokenizers`` file or a ``sentencepiece`` model, and their bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores already
        self.pieces = path.endswith(".model")
        if self.pieces:
            import sentencepiece
            from sentencepiece import sentencepiece_model_pb2 as model

            spec = model.ModelProto()
            with open(path, "rb") as f:
                spec.ParseFromString(f.read())
            prefixed = spec.normalizer_spec.add_dummy_prefix
            spec.normalizer_spec.add_dummy_prefix = False  # the blank before a text is part of it here
            self.library = s = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
            names = [s.id_to_piece(i) for i in range(s.vocab_size())]
            self.data = [bytes([int(n[3:-1], 16)]) if s.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
            self.cuttable = (prefixed and not spec.normalizer_spec.precompiled_charsmap and not spec.normalizer_spec.remove_extra_whitespaces
                             and not any("▁" in n.lstrip("▁") for n in names))
            #: Neighbours within a piece; no merge joins two characters that are none.
            self.neighbours = {n[i:i + 2] for i_, n in enumerate(names) if not s.is_byte(i_) for i in range(len(n) - 1)}
        else:
            from tokenizers import Tokenizer

            self.library = t = Tokenizer.from_file(path)
            t.encode_special_tokens = True  # their strings in a text are ordinary text
            self.spelled = dict(enumerate(byte_table()))
            back = {c: b for b, c in self.spelled.items()}
            self.data = [b""] * t.get_vocab_size()
            for token, i in t.get_vocab().items():
                self.data[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
            self.cuttable, self.neighbours = True, set()
        self.lengths = np.array([len(d) for d in self.data], np.int64)

    def encode(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts; letters after at most one blank are one pre-token and go to the merges at once."""
        if self.pieces:
            return self.library.encode(parts, num_threads=1)
        tokenize, spelled = self.library.model.tokenize, self.spelled
        out = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(spelled))] if p.removeprefix(" ").isalpha() else None for p in parts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.library.encode_batch([parts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def agrees(self, parts: list[bytes], ids: list[list[int]]) -> list[bool]:
        """Whether the bytes of the ids make the part."""
        if b"".join([self.data[t] for few in ids for t in few]) == b"".join(parts):
            lengths = np.add.reduceat(np.append(self.lengths[flat(ids)], 0), np.cumsum([0, *map(len, ids[:-1])]))
            if all(ids) and lengths.tolist() == [*map(len, parts)]:
                return [True] * len(parts)
        return [b"".join([self.data[t] for t in few]) == part for part, few in zip(parts, ids)]


def flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))


class Decimals(dict):
    def __missing__(self, x: int) -> str:
        self[x] = name = str(x)
        return name


#: Ids as text; at most a vocabulary.
_DECIMAL = Decimals()

#: What is kept of a part: whether its bytes agree, numbers of tokens, groups, overlap and group links,
#: packed pairs and their links, and the groups as text.
Part = tuple[bool, int, int, int, int, int, bytes, bytes, str]
NO_TOKENS: Part = (False, 0, 0, 0, 0, 0, b"", b"", "")


def pair_code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


class Aligner:
    """Links of parts, multiplied for all new parts of a batch at once."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(path_a), Side(path_b)
        self.cuttable = self.a.cuttable and self.b.cuttable
        self.seen: dict[str, Part] = {}
        self.older: dict[str, Part] = {}

    def parts(self, text: str) -> list[str]:
        return parts_of(" " + text) if self.cuttable else [" " + text]

    def align(self, parts: list[str]) -> list[Part]:
        """The links of each part by one product of block-diagonal matrices."""
        ids_a, ids_b, data = self.a.encode(parts), self.b.encode(parts), [p.encode() for p in parts]
        out = [NO_TOKENS] * len(parts)
        good = [i for i, (x, y) in enumerate(zip(self.a.agrees(data, ids_a), self.b.agrees(data, ids_b))) if x and y]
        if not good:
            return out
        if len(good) < len(parts):
            ids_a, ids_b = ([ids[i] for i in good] for ids in (ids_a, ids_b))
        tokens_a, tokens_b = flat(ids_a), flat(ids_b)
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.a.lengths[tokens_a]), np.cumsum(self.b.lengths[tokens_b])
        width = int(ends_a[-1])

        rows, columns, _ = product(Rows.incidence(ends_a, width), Rows.incidence(ends_b, width).transposed())
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        inside = fan_out(Rows.membership(group_a, len(common)), Rows.membership(group_b, len(common)).transposed())

        stop_a = np.cumsum(n_a)
        stop_group = np.searchsorted(common, ends_a[stop_a - 1]) + 1
        owner = np.searchsorted(stop_a, rows, "right")  # the part of each link
        codes = pair_code(tokens_a[rows], tokens_b[columns])
        order = np.lexsort((codes, owner))
        owner, codes = owner[order], codes[order]
        first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (codes[1:] != codes[:-1]))))
        links = np.diff(np.append(first, len(codes))).astype(np.int32).tobytes()
        edges = np.searchsorted(owner[first], np.arange(len(good) + 1)).tolist()
        total = np.bincount(owner, minlength=len(good)).tolist()
        pairs = codes[first].tobytes()
        inside = np.add.reduceat(inside, stop_a - n_a).tolist()
        spelled_a, spelled_b = self.spell(tokens_a, group_a, len(common)), self.spell(tokens_b, group_b, len(common))
        groups = [f"{x}|{y}" for x, y in zip(spelled_a, spelled_b)]
        stops, start = stop_group.tolist(), 0
        for k, (i, a, b, stop) in enumerate(zip(good, n_a.tolist(), n_b.tolist(), stops)):
            x, y = edges[k], edges[k + 1]
            out[i] = (True, a, b, stop - start, total[k], inside[k], pairs[8 * x:8 * y], links[4 * x:4 * y], ";".join(groups[start:stop]))
            start = stop
        return out

    @staticmethod
    def spell(tokens: np.ndarray, group: np.ndarray, groups: int) -> list[str]:
        """The decimal ids of each group, joined by commas."""
        names = [_DECIMAL[t] for t in tokens.tolist()]
        edges = np.searchsorted(group, np.arange(groups + 1)).tolist()
        return [names[x] if y - x == 1 else ",".join(names[x:y]) for x, y in zip(edges, edges[1:])]

    def pieces(self, part: str) -> list[str]:
        """A part cut further, where no piece of B joins the two sides."""
        out = []
        for piece in finer(part) if self.cuttable else [part]:
            if out and out[-1][-1:] + piece[:1] in self.b.neighbours:
                out[-1] += piece
            elif piece:
                out.append(piece)
        return out

    def of(self, parts: list[str]) -> list[Part]:
        """Links of distinct parts; the pieces of new ones are aligned together."""
        seen, older = self.seen, self.older
        known = [seen.get(p) or older.get(p) for p in parts]
        unknown = [i for i, k in enumerate(known) if k is None]
        cut = [self.pieces(parts[i]) for i in unknown]
        pieces = {p: seen.get(p) or older.get(p) for p in chain.from_iterable(cut)}
        new = [p for p, k in pieces.items() if k is None]
        pieces.update(zip(new, self.align(new) if new else []))
        for i, few in zip(unknown, cut):
            known[i] = pieces[few[0]] if len(few) == 1 else chained([pieces[p] for p in few])
        self.keep(pieces)
        self.keep({p: k for p, k in zip(parts, known) if p not in seen})
        return known

    def keep(self, links: dict[str, Part]) -> None:
        """For the next batches; the older generation goes when the younger is full."""
        self.seen.update((name, part) for name, part in links.items() if len(name) <= CACHE_CHARS)
        if len(self.seen) > CACHE_PARTS:
            self.older, self.seen = self.seen, {}


def chained(pieces: list[Part]) -> Part:
    """Pieces one after another; a pair may occur several times."""
    if not all(p[0] for p in pieces):
        return NO_TOKENS
    n_a = n_b = groups = links = inside = 0
    for p in pieces:
        n_a, n_b, groups, links, inside = n_a + p[1], n_b + p[2], groups + p[3], links + p[4], inside + p[5]
    return (True, n_a, n_b, groups, links, inside, b"".join([p[6] for p in pieces]), b"".join([p[7] for p in pieces]), ";".join([p[8] for p in pieces]))


@dataclass
class Aligned:
    """Documents of a group: their parts (one row a document with tokens), and the links of the parts."""

    rows: list[int]
    occurrences: Rows
    parts: list[Part]
    orders: list[np.ndarray]
    pairs: np.ndarray
    links: Rows

    def by_document(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, pair, links): the product of occurrences and the parts' links."""
        return row_blocks(self.occurrences, self.links)


@contextmanager
def no_collector() -> Iterator[None]:
    """Links are tuples without cycles, many of them: the collector would only walk over them again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def aligned(aligner: Aligner, texts: list[str | None]) -> Aligned:
    with no_collector():
        return _aligned(aligner, texts)


def _aligned(aligner: Aligner, texts: list[str | None]) -> Aligned:
    index: dict[str, int] = {}
    held = [np.array([index.setdefault(p, len(index)) for p in aligner.parts(t)], np.int64) if t else np.zeros(0, np.int64) for t in texts]
    parts = aligner.of([*index])
    fine = np.array([p[0] for p in parts], bool)
    rows = [i for i, h in enumerate(held) if len(h) and fine[h].all()]
    orders = [held[i] for i in rows]
    starts = np.concatenate(([0], np.cumsum([len(o) for o in orders]))).astype(np.int64)
    columns = np.concatenate(orders) if orders else np.zeros(0, np.int64)
    sizes = np.array([len(p[7]) // 4 for p in parts], np.int64)
    codes = np.frombuffer(b"".join([p[6] for p in parts]), np.int64)
    counts = np.frombuffer(b"".join([p[7] for p in parts]), np.int32).astype(np.int64)
    pairs, places = np.unique(codes, return_inverse=True)
    links = Rows(np.concatenate(([0], np.cumsum(sizes))), places.astype(np.int64), counts, max(1, len(pairs)))
    return Aligned(rows, Rows(starts, columns, np.ones(len(columns), np.int64), max(1, len(parts))), parts, orders, pairs, links)


_WORKERS: dict[tuple, Aligner] = {}


def aligner_of(*paths: str) -> Aligner:
    """One aligner for each worker process and pair of tokenizers."""
    if paths not in _WORKERS:
        _WORKERS[paths] = Aligner(*paths)
    return _WORKERS[paths]


def text_groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about GROUP_CHARS characters of text."""
    for batch in batches:
        at, chars = 0, 0
        for i, text in enumerate(batch.column(column)):
            chars += len(text.as_py() or "")
            if chars >= GROUP_CHARS:
                yield batch.slice(at, i + 1 - at)
                at, chars = i + 1, 0
        if at < len(batch):
            yield batch.slice(at)


# --- jobs -------------------------------------------------------------------------


ROW = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, "
       "groups_sha256 string, pairs array<bigint>, links array<int>")


def document_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of (doc_id, text): its alignment, its distinct pairs and the links of each."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        for batch in text_groups(batches, 1):
            found = aligned(aligner, batch.column(1).to_pylist())
            facts = np.array([p[1:6] for p in found.parts], np.int64).reshape(-1, 5)
            documents = len(found.rows)
            pairs: list[list[np.ndarray]] = [[] for _ in range(documents)]
            links: list[list[np.ndarray]] = [[] for _ in range(documents)]
            for doc, pair, n in found.by_document():
                edges = np.searchsorted(doc, np.arange(documents + 1)).tolist()
                for d in range(doc[0], doc[-1] + 1):
                    pairs[d].append(found.pairs[pair[edges[d]:edges[d + 1]]])
                    links[d].append(n[edges[d]:edges[d + 1]].astype(np.int32))
            out = [[0] * 5 + ["", [], []] for _ in range(len(batch))]
            for d, (row, order) in enumerate(zip(found.rows, found.orders)):
                groups = ";".join([found.parts[i][8] for i in order.tolist()])
                out[row] = [*facts[order].sum(axis=0).tolist(), hashlib.sha256(groups.encode()).hexdigest(),
                            np.concatenate(pairs[d]), np.concatenate(links[d])]
            kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                                             [c.strip().split()[0] for c in ROW.split(",")])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(align, ROW)


def split_counts(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows from a count on that at most ``most`` rows reach, and the other rows.

    The least count comes from a histogram over powers of 2**(1/4).
    """
    step = F.floor(F.log2("n") * 4).cast("int")
    sizes = {r["s"]: r["rows"] for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("rows")).collect()}  # 252 rows at most
    least, total = max(sizes, default=0) + 1, 0
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > most:
            break
        least = s
    return counts.where(step >= least), counts.where(step < least)


def alignment(docs: DataFrame, path_a: str, path_b: str, head: int = HEAD, folder: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links.

    ``path_a``: a byte-level ``tokenizers`` file, ``path_b``: a
    ``sentencepiece`` model.  ``folder``: where the tables of links and counts
    go; a new folder beside the checkpoints if None.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or f"{spark.sparkContext.getCheckpointDir()}/alignment-{uuid.uuid4().hex}"
    # the number is written with the row, so both sides of the later join see the same one
    document_links(pick(docs, "doc_id", "text"), path_a, path_b).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    rows = spark.read.schema(f"{ROW}, row bigint").parquet(f"{folder}/rows")
    rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")).write.parquet(f"{folder}/counts")
    counts = spark.read.schema("pair bigint, n bigint").parquet(f"{folder}/counts").withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of A at most, so it may be broadcast
    ranked = counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("bigint").alias("best"))
    near, far = split_counts(ranked, head)
    linked = (rows.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x"))
              .select("row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links")))
    found = linked.join(F.broadcast(near), "pair")  # HEAD rows at most
    beyond = linked.join(F.broadcast(near.select("pair")), "pair", "left_anti").join(far, "pair")
    sums = [F.sum(F.col("links") * F.col("best")).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum")]
    scores = found.groupBy("row").agg(*sums).unionByName(beyond.groupBy("row").agg(*sums)).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return rows.join(scores, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", "n_group_links")
