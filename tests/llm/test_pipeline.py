"""The corpus pipeline, stage by stage against brute force."""

import random

import corpus_pipeline
import numpy as np
import pytest
import tiktoken

from tallyframe.llm import bpe, common
from test_llm import (PATH, PATTERN, SCHEMA, WORDS, brute_components, brute_cut_lines, brute_fp, brute_leaks, ordered, rows_of, sha)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """documents, labels and benchmark with planted cases, as Parquet."""
    common.prepare(spark)
    home = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(12)
    text = lambda k: " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(k))
    line, items = text(9), [(k, text(20)) for k in range(4)]
    docs, kinds = [], {}
    for i in range(300):
        lines = [text(rng.randint(5, 25)) for _ in range(rng.randint(1, 4))]
        kind = ["clean", "clean", "clean", "toxic", "copy", "leak", "boiler", "near"][i % 8]
        if kind == "toxic":
            lines = [" ".join([*x.split(), rng.choice(["idiot", "moron", "scum"])]) + ". You idiot" for x in lines]
        elif kind == "copy":
            lines = docs[i - 4][1].split("\n")
        elif kind == "leak":
            lines.append("see " + items[i % 4][1].upper() + " end")
        elif kind == "boiler":
            lines.insert(1, line)
        elif kind == "near":
            lines = [docs[i - 7][1].replace("\n", " ") + " x"]
        docs.append((i, "\n".join(lines)))
        kinds[i] = kind
    docs += [(1000, None), (1001, ""), (None, text(30)), (1002, docs[0][1]), (1003, text(3)), (1003, text(3))]
    labels = [(i, 1, int(k == "toxic")) for i, k in kinds.items() if i % 4 != 1]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], SCHEMA).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{home}/benchmark.parquet")
    return home, docs, kinds, items


def test_stages(spark, tables):
    home, docs, kinds, items = tables
    df, seen = spark.read.parquet(f"{home}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, home)
        if k < 4:
            assert out.columns == df.columns, name
        path = f"{home}/stage{k}"
        out.write.parquet(path)
        df = spark.read.parquet(path)
        seen.append(df)
    texts = [[(r["doc_id"], r["text"]) for r in s.collect()] for s in seen[:4]]

    # 1: toxic documents go, all others stay
    assert ordered(texts[0]) == ordered([(i, t) for i, t in docs if kinds.get(i) != "toxic"])
    # 2: aligned lines go, all documents stay
    assert ordered(texts[1]) == ordered([(i, t) for i, _, _, t in brute_cut_lines(texts[0])])
    # 3: one document of each group of fingerprints stays
    fps = [(i, brute_fp(t)) for i, t in texts[1]]
    group = brute_components(sorted({f for _, f in fps}), 2)
    low = {}
    for i, f in fps:
        if i is not None:
            low[group[f]] = min(low.get(group[f], i), i)
    want = [(i, t) for (i, t), (_, f) in zip(texts[1], fps) if low.get(group[f]) == i]
    assert ordered(texts[2]) == ordered(want)
    # 4: documents that overlap a benchmark item go
    leaks = {r[0] for r in brute_leaks(texts[2], items) if r[1]}
    assert leaks and ordered(texts[3]) == ordered([(i, t) for i, t in texts[2] if i not in leaks])
    assert min(i for i, k in kinds.items() if k == "leak") not in {i for i, _ in texts[3]}
    # 5: digests of ids and bytes
    e = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    want = []
    for i, t in texts[3]:
        ids = e.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t or "")))
    assert rows_of(seen[4], "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)
    # run() gives the same rows
    whole = corpus_pipeline.run(spark, home)
    assert rows_of(whole, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)


def test_stages_on_an_empty_table(spark, tables):
    home = tables[0]
    df = spark.read.parquet(f"{home}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, home)
        assert out.count() == 0, name
        df = out if "text" in out.columns else df


def test_registration_without_the_subpackage():
    import __spark_entry__ as entry
    assert {"pipeline", *(f"op{n}_" for n in range(1, 14))} <= {q if q == "pipeline" else q.split("_")[0] + "_" for q in entry.queries()}
