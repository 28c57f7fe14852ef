"""Operator 8: toxicity by a weighted finite-state pattern grammar.

Words become classes (insult, doubtful insult, threat, target, negation,
reported speech); doubtful ones also turn up in clean texts, and count by how
many there are.  A scope transducer marks insults and threats that stand under a negation or in
reported speech; a clause transducer reads its marks and, at the end of a
clause, writes what the clause says of whom.  Both are composed into one
machine.  A document's score is a logistic function of its matched clauses;
the insult lexicon (words and word beginnings) and the arc weights are learned
from labelled training rows.

The fit takes at most ``SAMPLE`` labelled rows of each label (those with the
smallest hash of the id); scoring covers whole texts of all rows.

Edge cases: null and empty texts get the score of a text without matches; null
ids, labels without document, null labels and documents without label don't
take part in the fit; without any positive label the seed lexicon and prior
weights are used; repeated rows get equal scores; an empty table gives an
empty result; further columns never reach the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyframe.llm.common import bucket_of_id, own_name, pick, shared

#: Labelled rows of each label that the fit takes.
SAMPLE = 10_000
THRESHOLD = 0.7
#: A learned entry is so pure, in LEAST_TEXTS toxic texts at least, and matches so
#: many of their words that fewer than CHANCE entries would be by luck.
LEAST_TEXTS = 3
LEAST_PRECISION = 0.95
CHANCE = 0.1
#: A doubtful entry is in so many times the share of toxic texts than of clean ones.
LEAST_LIFT = 4.0
#: Candidates for the lexicon, most frequent first, and entries each toxic text should have.
CANDIDATES = 2000
COVER = 6
#: Lengths of word beginnings.
STEMS = (4, 5, 6, 7, 8)
CACHE_WORDS = 200_000

SEED_INSULTS = frozenset("idiot moron stupid scum pathetic worthless trash loser disgusting dumb".split())
THREATS = frozenset("kill hurt destroy burn beat smash töten umbringen tuer frapper matar golpear".split())
TARGETS = frozenset("you your yours u he she they them him her du dich dir ihr sie tu te toi vous il elle ils tú usted ustedes él ella".split())
NEGATIONS = frozenset("not no never isn't aren't don't nicht kein keine nie pas jamais ne nunca ni".split())
REPORTS = frozenset("said says called quoted wrote claimed sagte nannte schrieb dit disait appelé dijo llamó escribió".split())

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")

# --- transducers: (state, symbol) -> (state, written symbol) -----------------

CLASSES = "imtynro."


def scope_transducer() -> dict:
    """Marks i, m and t: plain as they are; negated within three words j, l, u; reported k, k, v."""
    arcs = {}
    for reported in (0, 1):
        for left in range(4):
            for c in CLASSES:
                after, out = (reported, max(0, left - 1)), c
                if c == ".":
                    after = (0, 0)
                elif c == "n":
                    after, out = (reported, 3), "o"
                elif c == "r":
                    after, out = (1, max(0, left - 1)), "o"
                elif c in "imt":
                    out = {"i": "ijk", "m": "mlk", "t": "tuv"}[c][2 if reported else 1 if left else 0]
                arcs[(reported, left), c] = after, out
    return arcs


def clause_transducer() -> dict:
    """Writes (plain insults to 2, doubtful 0/1, weak 0/1, threat 0/1, target 0/1) at the end of a clause."""
    arcs = {}
    for s in product(range(3), (0, 1), (0, 1), (0, 1), (0, 1)):
        plain, doubtful, weak, threat, target = s
        for c in "ijkmltuvyo.":
            arcs[s, c] = {
                "i": ((min(2, plain + 1), doubtful, weak, threat, target), None),
                "m": ((plain, 1, weak, threat, target), None),
                "l": (s, None),
                "t": ((plain, doubtful, weak, 1, target), None),
                "y": ((plain, doubtful, weak, threat, 1), None),
                "o": (s, None),
                ".": ((0, 0, 0, 0, 0), s),
            }.get(c, ((plain, doubtful, 1, threat, target), None))
    return arcs


def compose(first: dict, second: dict, start: tuple) -> dict:
    """The machine that feeds what ``first`` writes to ``second``; states reached from start."""
    arcs, new = {}, [start]
    symbols = sorted({c for _, c in first})
    seen = {start}
    while new:
        a, b = new.pop()
        for c in symbols:
            a2, mark = first[a, c]
            b2, out = second[b, mark]
            arcs[(a, b), c] = (a2, b2), out
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                new.append((a2, b2))
    return arcs


START = ((0, 0), (0, 0, 0, 0, 0))
#: Numbered states, and symbols as bytes: arc [state][byte] -> (state, clause).
_ARCS = compose(scope_transducer(), clause_transducer(), START)
_STATE = {s: i for i, s in enumerate(dict.fromkeys([START, *(s for s, _ in _ARCS)]))}
MACHINE = [{} for _ in _STATE]
for (_s, _c), (_to, _out) in _ARCS.items():
    MACHINE[_STATE[_s]][ord(_c)] = _STATE[_to], _out


def clause_of(codes: bytes) -> tuple:
    """What one clause (class codes, without its end) says."""
    state = 0
    for c in codes:
        state = MACHINE[state][c][0]
    return MACHINE[state][ord(".")][1]


class Codes(dict):
    """Word as written -> class code, with "." after words that end a clause."""

    def __init__(self, strong: frozenset[str], doubtful: frozenset[str]):
        super().__init__()
        self.strong, self.doubtful = strong, doubtful

    def __missing__(self, word: str) -> bytes:
        core = _EDGE.sub("", word)
        entries = [core, *(core[:n] + "*" for n in STEMS if len(core) > n)]
        if not core:
            code = b""
        elif not self.strong.isdisjoint(entries):
            code = b"i"
        elif not self.doubtful.isdisjoint(entries):
            code = b"m"
        else:
            code = next((c for c, words in ((b"t", THREATS), (b"y", TARGETS), (b"n", NEGATIONS), (b"r", REPORTS)) if core in words), b"o")
        if word[-1] in ".!?;:":
            code += b"."
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = code
        return code


def words_of(text: str) -> list[str]:
    return text.lower().replace("\n", " . ").split()


FEATURES = 12


def features(text: str | None, codes: Codes) -> list[float]:
    """Numbers of clauses by what they say, and their share."""
    words = words_of(text or "")
    said = b"".join(map(codes.__getitem__, words)) + b"."
    if not any(c in said for c in (b"i", b"m", b"t")):
        return [0.0] * FEATURES
    clauses = [c for c in said.split(b".") if c]
    n = Counter(clause_of(c) for c in clauses if any(x in c for x in (b"i", b"m", b"t")))
    plain = sum(k for (p, _, _, _, y), k in n.items() if p and not y)
    aimed = sum(k for (p, _, _, _, y), k in n.items() if p and y)
    twice = sum(k for (p, _, _, _, _), k in n.items() if p > 1)
    doubtful = sum(k for (p, d, _, _, _), k in n.items() if d and not p)
    weak = sum(k for (p, _, w, _, _), k in n.items() if w and not p)
    threat = sum(k for (_, _, _, t, y), k in n.items() if t and not y)
    aimed_threat = sum(k for (_, _, _, t, y), k in n.items() if t and y)
    kinds = len({w for w in words if codes[w][:1] == b"m"}) if b"m" in said else 0
    return [math.log1p(plain), math.log1p(aimed), math.log1p(twice), math.log1p(weak), math.log1p(threat),
            math.log1p(aimed_threat), float(plain + aimed > 0), (plain + aimed + weak) / max(1, len(clauses)),
            math.log1p(doubtful), float(kinds > 1), float(kinds > 2), min(1.0, 10 * said.count(b"m") / max(1, len(words)))]


#: Weights before any label is seen: one plain insult passes, weak and doubtful ones don't.
PRIOR = np.array([3.0, 3.5, 1.0, 1.0, 0.5, 2.0, 2.0, 2.0, 0.3, 0.5, 0.5, 0.5, -4.0])


@dataclass(frozen=True)
class Grammar:
    """Learned lexicon and weights (the last one is the intercept)."""

    strong: frozenset[str]
    doubtful: frozenset[str]
    weights: tuple[float, ...]

    def score(self, x: list[float]) -> float:
        z = sum(w * v for w, v in zip(self.weights, x)) + self.weights[-1]
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def labelled_sample(docs: DataFrame, labels: DataFrame, train, sample: int) -> tuple[DataFrame, float]:
    """(text, toxic): distinct texts of at most ``sample`` rows of each label; the share of toxic labels."""
    known = (pick(labels, "doc_id", "toxic").where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .where(train(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    taken = None
    for value in (0, 1):
        few = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        taken = few if taken is None else taken.unionByName(few)
    # at most 2 * sample rows of two numbers: bounded, so it is broadcast
    rows = (pick(docs, "doc_id", "text").join(F.broadcast(taken), "doc_id")
            .select(F.coalesce("text", F.lit("")).alias("text"), "toxic").dropDuplicates(["text"]))
    return rows, float(known.agg(F.avg("toxic")).first()[0] or 0.0)


def entries_of(text: str) -> Counter:
    """Lexicon entries that would match (words, and beginnings with a *), with
    the number of different words of the text that each one matches."""
    out: Counter = Counter()
    for core in {_EDGE.sub("", word) for word in set(words_of(text))}:
        if len(core) > 2 and core[0].isalpha():
            out[core] += 1
            out.update(core[:n] + "*" for n in STEMS if len(core) > n)
    return out


def chosen(texts: list[set[int]], penalty: dict[int, float], names: list[str], cover: int, least: float) -> set[int]:
    """Entries by greedy cover of the texts, each ``cover`` times; an entry's
    worth is the share of texts that still need it, less its penalty."""
    need, holders, out = [cover] * len(texts), {}, set()
    for i, has in enumerate(texts):
        for e in has:
            holders.setdefault(e, []).append(i)
    while holders:
        worth = {e: sum(need[i] > 0 for i in at) / len(texts) - penalty[e] for e, at in holders.items()}
        best = min(worth, key=lambda e: (-worth[e], len(names[e]), names[e]))
        if worth[best] < least:
            break
        out.add(best)
        for i in holders.pop(best):
            need[i] -= 1
    return out


def learn_lexicon(sample: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Entries that mark toxic texts: (strong, doubtful)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = {"clean": Counter(), "toxic": Counter(), "words": Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = entries_of(text)
                n["toxic" if toxic else "clean"].update(found.keys())
                if toxic:
                    n["words"].update(found)
            keys = list(n["clean"].keys() | n["toxic"].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in n.values())],
                                             ["entry", *n])

    counted = (sample.select("text", "toxic").mapInArrow(count, "entry string, clean bigint, toxic bigint, words bigint")
               .groupBy("entry").agg(*(F.sum(c).alias(c) for c in ("clean", "toxic", "words"))))
    counted = shared(counted.where(F.col("toxic") >= LEAST_TEXTS))
    clean, toxic = (sample.where(F.col("toxic") == v).count() for v in (0, 1))
    share = min(0.9, max(toxic, 1) / max(1, clean + toxic))
    least = math.ceil(math.log(max(1, counted.count()) / CHANCE) / -math.log(share))
    often = counted.where(F.col("words") >= least)
    precise = F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + F.col("clean"))
    lifted = F.col("toxic") / max(1, toxic) >= LEAST_LIFT * (F.col("clean") + 0.5) / (clean + 1)
    kinds = [often.where(w).orderBy(F.desc("toxic"), "entry").limit(CANDIDATES).collect() for w in (precise, ~precise & lifted)]
    known = [r["entry"] for rows in kinds for r in rows]
    number = {e: i for i, e in enumerate(known)}
    penalty = {number[r["entry"]]: 2 * r["clean"] / max(1, clean) for rows in kinds for r in rows}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(number[e] for e in entries_of(t) if e in number) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["has"])

    texts = [set(r["has"]) for r in sample.where("toxic = 1").select("text").mapInArrow(present, "has array<int>").collect()]
    if not texts:
        return SEED_INSULTS, frozenset()
    least_worth = max(LEAST_TEXTS / len(texts), 0.01)
    n_pure = len(kinds[0])
    strong = chosen([{e for e in has if e < n_pure} for has in texts], dict.fromkeys(penalty, 0.0), known, COVER, least_worth)
    missed = [has for has in texts if has.isdisjoint(strong)]
    doubtful = chosen([{e for e in has if e >= n_pure} for has in missed], penalty, known, COVER, least_worth) if missed else set()
    unclear = {r["entry"] for r in counted.where(F.col("entry").isin(sorted(SEED_INSULTS))).where("clean > toxic").collect()}
    return frozenset(known[i] for i in strong) | (SEED_INSULTS - unclear), frozenset(known[i] for i in doubtful)


def learn_weights(x: np.ndarray, y: np.ndarray, steps: int = 60, pull: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to the prior weights."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -40, 40)))
        grad = x1.T @ (p - y) + pull * (w - PRIOR)
        hess = (x1 * (p * (1 - p))[:, None]).T @ x1 + pull * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train, sample: int = SAMPLE) -> Grammar:
    """``train``: column function of the id, true for rows that may be learned from."""
    rows, natural = labelled_sample(docs, labels, train, sample)
    rows = shared(rows)
    strong, doubtful = learn_lexicon(rows)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(strong, doubtful)
        for batch in batches:
            x = [features(t, codes) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1).cast(pa.float64())], ["x", "y"])

    got = rows.select("text", "toxic").mapInArrow(described, "x array<double>, y double").collect()  # 2 * sample rows at most
    y = np.array([r["y"] for r in got])
    if not y.any():
        return Grammar(strong, doubtful, tuple(PRIOR))
    w = learn_weights(np.array([r["x"] for r in got]), y)
    if 0 < natural < 1 and y.mean() < 1:  # the sample holds more toxic texts than the labels do
        w[-1] += math.log(natural / (1 - natural)) - math.log(y.mean() / (1 - y.mean()))
    return Grammar(strong, doubtful, tuple(float(v) for v in w))


def score_column(grammar: Grammar):
    """Column function: text -> score."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        codes = Codes(grammar.strong, grammar.doubtful)
        return pa.array([grammar.score(features(t, codes)) for t in texts.to_pylist()], pa.float64())

    return score


def scored(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text) -> (doc_id, score, predicted)."""
    out = pick(docs, "doc_id", "text").select("doc_id", score_column(grammar)("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject_toxic(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that aren't predicted toxic; all columns stay."""
    mark = own_name(docs, "llm_score")
    at = docs.columns.index("text")
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    kept = plain.withColumn(mark, score_column(grammar)(f"c{at}")).where(F.col(mark) < threshold).drop(mark)
    return kept.toDF(*docs.columns)


def held_out(doc_id) -> object:
    return bucket_of_id(doc_id, 3) == 1


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    grammar = fit(docs, labels, lambda i: ~held_out(i), sample)
    return scored(docs, grammar).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
