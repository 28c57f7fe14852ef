"""Token counts and cross-tokenizer alignment against the libraries and brute force."""

import collections
import random

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import cross_tokenizer as ct
from tallyframe.llm import token_counts as tc

from test_llm import ROWS, clashing, ordered, rows_of, sha, table

JSON, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
BITS = ["x", "xx", "a", " ", " ", "\n", "  ", "é", "字", "🙂", "12", "'s", "!!", ".", "---", "　", "\x1c", "\x85", "²", "'", "The", " of",
        "<|endoftext|>", "<s>", "<0x41>", " ", "word", "Straße", "\t", "abc123", " 1984"]


def fuzz(n=600, seed=5, bits=BITS):
    rng = random.Random(seed)
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(n)]


# --- 11 -----------------------------------------------------------------------


def library_counts(path, texts):
    if path.endswith(".model"):
        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_libraries():
    texts = fuzz() + [t or "" for _, t in ROWS] + ["<|endoftext|>", " <|endoftext|> ", "<|endoftext|><|endoftext|>a", "▁x ▁"]
    for path in (JSON, PIECE, WORD):
        counts = tc.Counts(path, tc.prove(path))
        assert [counts.of(t) for t in texts] == library_counts(path, texts)


def test_every_code_point_after_a_blank():
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [f"a {c}b{c} {c}" for c in chars]
    counts = tc.Counts(JSON, tc.prove(JSON))
    assert [counts.of(t) for t in texts] == library_counts(JSON, texts)


def test_proof():
    proven = tc.prove(JSON)
    library = Tokenizer.from_file(JSON)
    assert len(proven) > 45_000
    assert all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in random.Random(1).sample(proven, 3000))
    single = {t for t in library.get_vocab() if t.isascii() and t.isalpha() and len(library.encode(t, add_special_tokens=False).ids) == 1}
    assert single <= set(proven)
    unproven = {t for t in library.get_vocab() if t.isascii() and t.isalpha()} - set(proven)
    assert all(len(library.encode(t, add_special_tokens=False).ids) > 1 for t in unproven)
    assert tc.prove(WORD) == [] and len(tc.prove(PIECE)) > 10_000


def test_cache_is_bounded_and_right(monkeypatch):
    monkeypatch.setattr(tc, "CACHE_PARTS", 5)
    counts = tc.Counts(JSON, tc.prove(JSON))
    texts = fuzz(200) + ["z" * 5000]
    assert [counts.of(t) for t in texts] == library_counts(JSON, texts)
    assert len(counts) <= 5 + len(counts.proven) and all(len(p) <= tc.CACHE_CHARS for p in counts.keys() - counts.proven.keys())


def test_token_counts(spark):
    texts = [t or "" for _, t in ROWS]
    want = [(i, len(t.encode()), n, n > 40) for (i, _), t, n in zip(ROWS, texts, library_counts(JSON, texts))]
    for df in (table(spark, ROWS), clashing(table(spark, ROWS))):
        got = tc.token_counts(df, JSON, 40)
        assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == ordered(want)
    assert tc.token_counts(table(spark, []), JSON).count() == 0
    assert dict(tc.token_counts(table(spark, []), JSON).dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}


# --- 12 -----------------------------------------------------------------------


def brute_alignment(rows):
    a, b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    bytes_of = {c: i for i, c in enumerate(ct.byte_table())}

    def spans(data):
        ends = np.cumsum([len(d) for d in data]).tolist()
        return list(zip([0, *ends[:-1]], ends))

    docs, held = [], collections.Counter()
    for i, t in rows:
        doc = None
        if t:
            ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            data_a = [bytes(bytes_of[c] for c in a.id_to_token(x)) for x in ids_a]
            names = [b.id_to_piece(x) for x in ids_b]
            data_b = [bytes([int(n[3:5], 16)]) if b.is_byte(x) else n.replace("▁", " ").encode() for x, n in zip(ids_b, names)]
            if b"".join(data_a) == b"".join(data_b) == (" " + t).encode():
                sa, sb = spans(data_a), spans(data_b)
                links, j = [], 0
                for x, (p, q) in zip(ids_a, sa):
                    while sb[j][1] <= p:
                        j += 1
                    k = j
                    while k < len(sb) and sb[k][0] < q:
                        links.append((x, ids_b[k]))
                        k += 1
                cuts = sorted({q for _, q in sa} & {q for _, q in sb})
                groups, pa_, pb = [], 0, 0
                for c in cuts:
                    ga, gb = [], []
                    while pa_ < len(sa) and sa[pa_][1] <= c:
                        ga.append(ids_a[pa_])
                        pa_ += 1
                    while pb < len(sb) and sb[pb][1] <= c:
                        gb.append(ids_b[pb])
                        pb += 1
                    groups.append((ga, gb))
                doc = (len(ids_a), len(ids_b), groups, links)
                held.update(set(links))
        docs.append((i, doc))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for i, doc in docs:
        if doc is None:
            out.append((i, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        n_a, n_b, groups, links = doc
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    sha(spelled), sum(len(x) * len(y) for x, y in groups)))
    return ordered(out)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")


def test_alignment(spark):
    rows = ROWS + [(1000 + i, t) for i, t in enumerate(fuzz(300) + ["▁", "a ▁ b", " ", "  lead", "trail  ", "x" * 3000, "字" * 500, "\x00a"])]
    for head in (0, 40, 10 ** 6):
        got = ct.alignment(clashing(table(spark, rows)), JSON, PIECE, head=head)
        assert rows_of(got, *COLUMNS) == brute_alignment(rows)
    assert ct.alignment(table(spark, []), JSON, PIECE).count() == 0


def test_alignment_with_small_caches_and_groups(monkeypatch):
    monkeypatch.setattr(ct, "CACHE_PARTS", 3)
    monkeypatch.setattr(ct, "BLOCK", 7)
    aligner, texts = ct.Aligner(JSON, PIECE), fuzz(120, 9)
    want = {i: w for i, *w in brute_alignment([*enumerate(texts)])}
    for s in range(0, 120, 30):
        found = ct.aligned(aligner, texts[s:s + 30])
        links = collections.Counter()
        for doc, _, n in ct.row_blocks(found.occurrences, found.links, 7):
            for d, k in zip(doc.tolist(), n.tolist()):
                links[s + found.rows[d]] += k
        assert [links[i] for i in range(s, s + 30)] == [want[i][3] for i in range(s, s + 30)]
    assert len(aligner.seen) <= 3 and all(len(p) <= ct.CACHE_CHARS for p in aligner.older)


def test_whole_texts_where_cuts_are_not_proven():
    aligner = ct.Aligner(JSON, PIECE)
    aligner.cuttable = False
    texts = [t for t in fuzz(60, 11) if t]
    found = ct.aligned(aligner, texts)
    want = {i: w for i, *w in brute_alignment([*enumerate(texts)])}
    assert [found.parts[found.orders[d][0]][1:5] for d in range(len(found.rows))] == [tuple(want[i][:4]) for i in found.rows]


def test_products():
    rng = np.random.default_rng(2)
    dense_a, dense_b = rng.integers(0, 3, (17, 23)) * (rng.random((17, 23)) < 0.3), rng.integers(0, 3, (23, 11)) * (rng.random((23, 11)) < 0.3)

    def rows(dense):
        i, j = np.nonzero(dense)
        starts = np.concatenate(([0], np.cumsum(np.bincount(i, minlength=len(dense)))))
        return ct.Rows(starts, j, dense[i, j], dense.shape[1])

    a, b = rows(dense_a), rows(dense_b)
    for block in (1, 5, 10 ** 6):
        out = np.zeros((17, 11), int)
        for i, j, v in ct.row_blocks(a, b, block):
            out[i, j] += v
        assert (out == dense_a @ dense_b).all()
    back = a.transposed().transposed()
    assert (back.starts == a.starts).all() and (back.columns == a.columns).all() and (back.values == a.values).all()
    assert ct.fan_out(a, b).tolist() == [int((dense_b[np.flatnonzero(r)] != 0).sum()) for r in dense_a]


def test_split_counts(spark):
    df = spark.range(100).select(F.col("id").alias("pair"), (F.col("id") % 7 + 1).alias("n"))
    for most in (0, 1, 20, 30, 1000):
        near, far = ct.split_counts(df, most)
        assert near.count() <= most and near.count() + far.count() == 100
        low, high = near.agg(F.min("n")).first()[0], far.agg(F.max("n")).first()[0]
        assert low is None or high is None or low > high
