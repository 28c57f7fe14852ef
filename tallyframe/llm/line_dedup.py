"""Operator 6: line dedup by pairwise alignment.

Documents overlap when they share a line.  Every line belongs to the first
document (smallest id) that has it, and a later document is paired with the
owners of its lines and with the first document of the very same lines, so
each line makes one pair for each later document and no group of copies is
paired with itself.  All lines that a pair shares are aligned with patience
diff, whoever owns them: lines that are rare in the pair (once in either
document) are anchors, the longest run of anchors in the same order holds, and
the gaps between them are aligned in turn.  The aligned blocks are deleted
from the later document.

No line is too frequent to count.  Rare lines meet their owners by a shuffle,
in which none has over a ``HOT_SHARE``-th of the rows; the frequent ones, at
most ``HOT_SHARE`` lines, are broadcast with their owners.  A pair is filled
from the document with fewer lines, and only with the lines that both have, so
an owner of very many lines costs a pair no more than the other side does.

Lines are compared without surrounding white space; lines without any other
character are neither compared nor deleted.

Edge cases: null texts have no lines and stay null; rows without an id come
after all others; rows that share an id (also: rows without one) are one
document for the comparison and are not compared with each other; a text of
which all lines go becomes the empty text; an empty table gives an empty
result; ``line_dedup`` keeps all columns and rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyframe.llm.common import pick, stored

#: Stands for the id of rows without one.
LAST = (1 << 63) - 1

#: Stands for a line that isn't compared.
BLANK = -1

#: A line with at least this part of all rows of repeated lines is frequent.
HOT_SHARE = 1000


def line_digests(text: str) -> list[int]:
    """A digest of each line, in order; ``BLANK`` for lines without other characters than white space."""
    return [xxhash.xxh3_64_intdigest(line.encode()) - (1 << 63) if line else BLANK for line in map(str.strip, text.split("\n"))]


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
        before[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two sequences, by patience diff."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        anchors = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place]
        if not anchors:
            continue
        held = [anchors[k] for k in longest_rising([j for _, j in anchors])]
        last_a, last_b = a0, b0
        for i, j in [*held, (a1, b1)]:
            # the gap ends with the anchor itself, so matches grow from anchors backwards too
            todo.append((last_a, min(i + 1, a1), last_b, min(j + 1, b1)) if (i, j) != (a1, b1) else (last_a, a1, last_b, b1))
            last_a, last_b = i + 1, j + 1
    return sorted(set(pairs))


def aligned_places(shared: list[dict]) -> list[int]:
    """Places of a later document's lines that align with an earlier one's, from the places (``mine``, ``theirs``) of each line that both have."""
    a = sorted((p, i) for i, s in enumerate(shared) for p in s["mine"])
    b = sorted((p, i) for i, s in enumerate(shared) for p in s["theirs"])
    return [a[i][0] for i, _ in patience([x for _, x in a], [x for _, x in b])]


def row_key(doc_id: Column, text: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(LAST)).cast("bigint").alias("doc"), F.xxhash64(text).alias("row")]


ENTRIES = pa.list_(pa.struct([("line", pa.int64()), ("at", pa.list_(pa.int32()))]))


def line_lists(docs: DataFrame) -> DataFrame:
    """(doc, row, whole, entries): a digest of all lines in order, and each distinct line as a digest with its places; repeated rows once.

    ``row`` digests the text and tells rows with one id apart.
    """

    @arrow_udf("array<struct<line:bigint,at:array<int>>>")
    def places(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            held: dict[int, list[int]] = {}
            for i, x in enumerate(line_digests(t)):
                if x != BLANK:
                    held.setdefault(x, []).append(i)
            out.append([{"line": x, "at": at} for x, at in held.items()])
        return pa.array(out, ENTRIES)

    source = pick(docs, "doc_id", "text").where("text is not null")
    return (source.select(*row_key(F.col("doc_id"), F.col("text")), whole_digest()("text").alias("whole"), places("text").alias("entries"))
            .dropDuplicates(["doc", "row"]))


def whole_digest():
    """Column function: text -> a digest of its compared lines in order."""

    @arrow_udf("bigint")
    def digest(texts: pa.Array) -> pa.Array:
        return pa.array([xxhash.xxh3_64_intdigest(b",".join(b"%d" % x for x in line_digests(t) if x != BLANK), 1) - (1 << 63) for t in texts.to_pylist()], pa.int64())

    return digest


def pairs_of(lists: DataFrame) -> DataFrame:
    """(doc, row, owner, owner_row): later rows and earlier ones that they are aligned with.

    A line pairs a row with the first document that has it, the whole text
    with the first document that has all the same lines.
    """
    keys = lists.select("doc", "row", F.explode(F.array_union(F.col("entries.line"), F.array("whole"))).alias("line"))
    owners = stored(keys.groupBy("line").agg(F.min(F.struct("doc", "row")).alias("first"), F.count("*").alias("n")).where("n > 1")
                    .select("line", "n", F.col("first.doc").alias("owner"), F.col("first.row").alias("owner_row")), "owners")
    least = max(2, -(-(owners.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE))
    hot = F.broadcast(owners.where(F.col("n") >= least).drop("n"))  # HOT_SHARE rows at most
    rare = keys.join(hot.select("line"), "line", "left_anti").join(owners.where(F.col("n") < least).drop("n"), "line")
    return (keys.join(hot, "line").unionByName(rare).where(F.col("doc") != F.col("owner"))
            .select("doc", "row", "owner", "owner_row").distinct())


def shared_lines(lists: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc, row, owner, owner_row, shared array<(mine, theirs)>): the places of the lines that a pair shares."""
    mine = lists.select("doc", "row", F.explode("entries").alias("e")).select("doc", "row", F.col("e.line").alias("line"), F.col("e.at").alias("mine"))
    theirs = mine.select(F.col("doc").alias("owner"), F.col("row").alias("owner_row"), "line", F.col("mine").alias("theirs"))
    size = lists.select("doc", "row", F.size("entries").alias("n"))
    sized = (pairs.join(size, ["doc", "row"])
             .join(size.select(F.col("doc").alias("owner"), F.col("row").alias("owner_row"), F.col("n").alias("m")), ["owner", "owner_row"]))
    sized = stored(sized, "pairs")
    ids = ["doc", "row", "owner", "owner_row"]
    from_mine = sized.where("n <= m").select(*ids).join(mine, ["doc", "row"]).join(theirs, ["owner", "owner_row", "line"])
    from_theirs = sized.where("n > m").select(*ids).join(theirs, ["owner", "owner_row"]).join(mine, ["doc", "row", "line"])
    both = from_mine.select(*ids, "mine", "theirs").unionByName(from_theirs.select(*ids, "mine", "theirs"))
    return both.groupBy(*ids).agg(F.collect_list(F.struct("mine", "theirs")).alias("shared"))


def deletions(docs: DataFrame) -> DataFrame:
    """(doc, row, deleted): places of the lines that each later row loses."""
    lists = stored(line_lists(docs), "lines")

    @arrow_udf("array<int>")
    def align(shared: pa.Array) -> pa.Array:
        return pa.array([aligned_places(s) for s in shared.to_pylist()], pa.list_(pa.int32()))

    each = shared_lines(lists, pairs_of(lists)).select("doc", "row", align("shared").alias("places"))
    return each.groupBy("doc", "row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("deleted"))


def cut_lines(docs: DataFrame) -> DataFrame:
    """docs by position (c0, c1, ...), cut, with the columns n_lines and deleted (places)."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = (names[docs.columns.index(n)] for n in ("doc_id", "text"))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n", -1))).alias("n_lines")
    keyed = plain.select("*", *row_key(F.col(doc_id), F.col(text)), n_lines)

    @arrow_udf("string")
    def without(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for t, at in zip(texts.to_pylist(), places.to_pylist()):
            if t is not None and at:
                drop = set(at)
                t = "\n".join(line for i, line in enumerate(t.split("\n")) if i not in drop)
            out.append(t)
        return pa.array(out, pa.string())

    joined = keyed.join(deletions(docs), ["doc", "row"], "left").withColumn(text, without(text, "deleted"))
    return joined.select(*names, "n_lines", "deleted")


def line_dedup(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, text without the deleted lines; ``n_chars``, where there, is counted anew."""
    out = cut_lines(docs)
    if "n_chars" in docs.columns:
        text, n_chars = (f"c{docs.columns.index(n)}" for n in ("text", "n_chars"))
        out = out.withColumn(n_chars, F.char_length(text).cast("bigint"))
    return out.drop("n_lines", "deleted").toDF(*docs.columns)


def line_dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_deleted, kept_sha256 of every document."""
    out = cut_lines(pick(docs, "doc_id", "text"))
    return out.select(F.col("c0").alias("doc_id"), F.col("n_lines").cast("bigint"),
                      F.coalesce(F.size("deleted"), F.lit(0)).cast("bigint").alias("n_deleted"),
                      F.sha2(F.coalesce("c1", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
