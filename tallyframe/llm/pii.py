"""Operator 9: personal data by boosted trees over candidate spans.

Four fixed patterns give the base spans (e-mail, IP address, card and phone
numbers), which always stay.  High-recall generators propose further spans of
the same kinds, which may overlap: every stretch of neighbouring digit groups
of a run, and addresses with written-out signs.  Gradient-boosted trees score
them from format and context, and a span is added where its score reaches its
kind's threshold and neither a base span nor a better one touches it.

The trees learn from base spans that were altered so that the patterns miss
them: a number put beside them, other separators, a plus sign or an at sign
taken away.  The altered span is a hit; the candidates that cross its ends, or
hold a wrong check digit, are none, nor are candidates of the texts as they
are that fail a check of their kind or touch a base span of another kind.
Other candidates off the base have no label and are left out.  Thresholds are the lowest ones that reach
``PRECISION`` on documents held out from the trees; a kind for which none does
adds nothing.

Besides, assigned secrets (a key or token, then a long value) are counted; they
are no span of the four kinds.

The fit takes every document with an id: equal candidates are stored once with
their number, each level of each tree is one pass over them, and what reaches
the driver are sums by node, feature and bin.  Thresholds lie on a grid of
``GRID`` steps.  Finding covers whole texts of all rows.  Places are code
points, ends exclusive.

Edge cases: null and empty texts have no spans; the fit leaves null ids out;
without candidates of both labels nothing is added to the base; repeated rows
get equal results; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallyframe.llm.common import pick
from tallyframe.sources.tables import stored

KINDS = ("email", "ip", "card", "phone")
#: Steps of the thresholds, and of the gradients, which are summed as whole numbers so that no order matters.
GRID = 1 << 14
UNIT = float(1 << 30)
PRECISION = 0.95
LEAST_HITS = 20

Span = tuple[str, int, int]

# --- base -------------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a start inside a run of digits ends as a start at its head does, so only heads are tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches: every match has one @, so the search goes from @ to @."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str | None) -> list[Span]:
    """The base spans, by kind and start."""
    text = text or ""
    out = emails(text)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# --- candidates ---------------------------------------------------------------

_RUN = re.compile(r"[0-9](?:[\x20().\-/]{0,2}[0-9])++")
_GROUP = re.compile(r"[0-9]+")
#: Digit groups and digits of one candidate.
GROUPS = 6
DIGITS = 19
_AT = re.compile(r"@|[(\[]\x20?at\x20?[)\]]", re.I)
_LEFT = re.compile(r"[^\s@<>\"']{1,64}\x20?\Z")
_RIGHT = re.compile(r"\x20?[^\s@<>\"']{1,255}(?:\x20?[(\[]\x20?dot\x20?[)\]]\x20?[^\s@<>\"']{1,63}){0,4}", re.I)

#: Words near a span that tell its kind.
HINTS = {
    "email": ("mail", "contact", "write", "an", "correo"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "pay", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "teléfono"),
}
CONTEXT = 24

#: Names that secrets are assigned to.
_SECRET = re.compile(r"""\b(?:api[_-]?key|access[_-]?key|secret|token|passwd|password|auth)\b["']?\x20?[:=]\x20?["']?([A-Za-z0-9+/_.\-]{16,})""", re.I)


def secrets(text: str | None) -> list[tuple[int, int]]:
    """Places of assigned values of 16 characters and more that hold a digit."""
    return [m.span(1) for m in _SECRET.finditer(text or "") if _DIGIT.search(m[1])]


def candidates(text: str | None) -> list[Span]:
    """High-recall proposals; a run of digits may be proposed as several kinds."""
    text = text or ""
    out: list[Span] = []
    for m in _AT.finditer(text):
        left, right = _LEFT.search(text, max(0, m.start() - 65), m.start()), _RIGHT.match(text, m.end())
        if left and right:
            out.append(("email", left.start(), right.end()))
    if not _DIGIT.search(text):
        return out
    for m in _RUN.finditer(text):
        if m.end() - m.start() >= 7:
            out += run_spans(text, [g.span() for g in _GROUP.finditer(text, *m.span())])
    return out


def run_spans(text: str, groups: list[tuple[int, int]]) -> list[Span]:
    """Every stretch of neighbouring digit groups that has the digits of a kind."""
    out: list[Span] = []
    for i, (start, _) in enumerate(groups):
        digits, dotted = 0, True
        first = start
        while first > 0 and text[first - 1] in "+(" and start - first < 2:
            first -= 1
        for j in range(i, min(i + GROUPS, len(groups))):
            a, b = groups[j]
            digits += b - a
            dotted = dotted and b - a <= 3 and (j == i or text[groups[j - 1][1]:a] == ".")
            if digits > DIGITS:
                break
            if j - i == 3 and dotted:
                out.append(("ip", start, b))
            if digits >= 12:
                out.append(("card", start, b))
            if 7 <= digits <= 15:
                out.append(("phone", first, b))
    return out


FEATURES = 24


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, start, end = span
    s = text[start:end]
    before, after = text[max(0, start - CONTEXT):start].lower(), text[end:end + CONTEXT].lower()
    near = set(re.findall(r"[^\W\d_]+", before))
    runs = [len(r) for r in _GROUP.findall(s)]
    digits = "".join(c for c in s if "0" <= c <= "9")
    return [
        float(KINDS.index(kind)), float(len(s)), float(len(digits)), float(len(runs)),
        float(max(runs, default=0)), float(min(runs, default=0)), float(runs[0] if runs else 0), float(runs[-1] if runs else 0),
        float(sum(c.isalpha() for c in s)), float(s.count(".")), float(s.count("-")), float(s.count(" ")), float(s.count("/")),
        float(s.count("(") + s.count("[")), float(len(s.rsplit(".", 1)[-1]) if "." in s else 0),
        float(any(w in near for w in HINTS[kind])), float(any(w in near for k in KINDS if k != kind for w in HINTS[k])),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(bool(re.search(r"[0-9+(][\x20().\-/]{0,2}\Z", before))),
        float(bool(re.match(r"[\x20().\-/]{0,2}[0-9]", after))), float(s[:1] == "+"), float(luhn(digits)) if digits else 0.0, float(checks(text, span)),
    ]


def checks(text: str, span: Span) -> bool:
    """Whether a candidate meets the check of its kind: Luhn, parts of an address, digits of a phone number, a dotted host.

    A number inside a word, and a bare run of digits as a phone number, fail.
    """
    kind, start, end = span
    if kind == "email":
        return bool(re.search(r"[.]|\bdot\b", re.split(r"@|\bat\b", text[start:end], flags=re.I)[-1], re.I))
    if text[start - 1:start].isalnum() or text[end:end + 1].isalnum():
        return False
    runs = _GROUP.findall(text, start, end)
    n = sum(map(len, runs))
    if kind == "card":
        return 16 <= n <= 19 and luhn("".join(runs))
    if kind == "ip":
        return len(runs) == 4 and all(len(r) <= 3 and int(r) <= 255 for r in runs)
    return 8 <= n <= 15 and (len(runs) > 1 or text[start] == "+")


# --- training examples ------------------------------------------------------------


def altered(text: str, span: Span, other: str) -> list[tuple[str, Span, bool]]:
    """(text, place, whether it is one) of a base span changed so that its pattern misses it; ``other``: digits to put beside it."""
    kind, start, end = span
    left, s, right = text[max(0, start - 2 * CONTEXT):start], text[start:end], text[end:end + 2 * CONTEXT]
    out = []

    def put(value: str, before: str = "", after: str = "", good: bool = True) -> None:
        at = len(left) + len(before)
        out.append((left + before + value + after + right, (kind, at, at + len(value)), good))

    if kind == "email":
        put(s.replace("@", " [at] "))
        put(s.replace("@", "(at)"))
        return out
    put(s, after=" " + other)
    put(s, before=other + " ")
    digits = [c for c in s if c.isdigit()]
    if kind == "card":
        put(".".join("".join(digits[i:i + 4]) for i in range(0, len(digits), 4)))
        wrong = s[:-1] + str((int(s[-1]) + 1) % 10)
        put(wrong, after=" " + other, good=False)
        put(wrong, good=False)
    if kind == "phone":
        put(s[1:])
        put(s.replace(" ", "/").replace("-", "/"))
        put("20{}{}-0{}-1{} 1{}:2{}".format(*digits[:6]), good=False)  # a date and time
    if kind == "ip":
        put("9" + s.split(".")[0].zfill(2) + s[s.index("."):], after=" " + other, good=False)
    return out


def examples(text: str | None) -> list[tuple[bool, list[float]]]:
    """Labelled candidates of a text: of its altered base spans, and those off the base that fail a check."""
    text = text or ""
    base = base_spans(text)
    out, index = [], Spans(base)
    others = {kind: Spans([b for b in base if b[0] != kind]) for kind in KINDS}
    for c in candidates(text):
        if others[c[0]].touch(c) or not index.touch(c) and not checks(text, c):
            out.append((False, describe(text, c)))
    numbers = [text[s:e] for k, s, e in base if k in ("card", "ip")]
    for n, span in enumerate(base):
        other = numbers[(n + 1) % len(numbers)] if numbers else "".join(_GROUP.findall(text[span[1]:span[2]]))
        for changed, (kind, start, end), good in altered(text, span, other):
            own = Spans(base_spans(changed))
            for c in candidates(changed):
                if c[0] == kind and c[1] < end and start < c[2] and not own.touch(c):
                    out.append((good and c[1:] == (start, end), describe(changed, c)))
    return out


# --- boosted trees --------------------------------------------------------------


@dataclass
class Trees:
    """Additive trees of fixed depth: node k has children 2k+1 and 2k+2."""

    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def chance(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(value)))):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            z += value[node - len(feature)]
        return 1 / (1 + np.exp(-z))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32) -> Trees:
    """Gradient boosting on log loss, splits from histograms of the features."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    codes = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    model = Trees(float(np.log(mean / (1 - mean))))
    for _ in range(rounds):
        p = model.chance(x)
        g, h = y - p, p * (1 - p)
        inner = 2 ** depth - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            best = 1e-6
            total_g, total_h = g[here].sum(), h[here].sum()
            for f, edges in enumerate(cuts):
                if not len(edges) or not len(here):
                    continue
                hist_g = np.cumsum(np.bincount(codes[here, f], g[here], len(edges) + 1))[:-1]
                hist_h = np.cumsum(np.bincount(codes[here, f], h[here], len(edges) + 1))[:-1]
                gain = (hist_g ** 2 / (hist_h + 1) + (total_g - hist_g) ** 2 / (total_h - hist_h + 1) - total_g ** 2 / (total_h + 1))
                if gain.max() > best:
                    best, feature[k], cut[k] = float(gain.max()), f, edges[int(gain.argmax())]
            node[here] = 2 * k + 1 + (x[here, feature[k]] > cut[k])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        model.trees.append((feature, cut, value))
    return model


@dataclass
class Finder:
    """Trees and the threshold of each kind."""

    trees: Trees
    thresholds: dict[str, float]

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """(base spans, added spans)."""
        text = text or ""
        base = base_spans(text)
        open_kinds = [k for k in KINDS if self.thresholds[k] <= 1]
        index = Spans(base)
        proposed = [c for c in candidates(text) if c[0] in open_kinds and not index.touch(c)] if open_kinds else []
        if not proposed:
            return base, []
        chance = self.trees.chance(np.array([describe(text, c) for c in proposed]))
        added, taken = [], Spans([])
        for p, c in sorted(zip(chance.tolist(), proposed), key=lambda r: (-r[0], r[1][1] - r[1][2], r[1])):
            if p >= self.thresholds[c[0]] and not taken.touch(c):
                added.append(c)
                taken.add(c)
        return base, added


class Spans:
    """Stretches of a text merged where they overlap; a search asks whether a span touches one."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, s, e in sorted(spans, key=lambda x: x[1]):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def touch(self, span: Span) -> bool:
        i = bisect_left(self.starts, span[2])
        return i > 0 and self.ends[i - 1] > span[1]

    def add(self, span: Span) -> None:
        """A span that touches none."""
        i = bisect_left(self.starts, span[1])
        self.starts.insert(i, span[1])
        self.ends.insert(i, span[2])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def redact(text: str | None, spans: list[Span]) -> str:
    """The text with each found span replaced by its kind; overlaps are merged."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [(text or "")[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + (text or "")[at:]


NOTHING_ADDED = Finder(Trees(), {k: 2.0 for k in KINDS})


def candidate_counts(docs: DataFrame) -> DataFrame:
    """(held boolean, hit boolean, x array, n): the labelled candidates of all documents, equal ones once; held: not for the trees."""
    rows = pick(docs, "doc_id", "text").where("doc_id is not null").where(F.col("text").rlike("[0-9@]"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, hit, x = [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for good, features in examples(text):
                    held.append(d % 3 == 0)
                    hit.append(good)
                    x.append(features)
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.bool_()), pa.array(hit, pa.bool_()), pa.array(x, pa.list_(pa.float64()))], ["held", "hit", "x"])

    found = rows.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(described, "held boolean, hit boolean, x array<double>")
    return stored(found.groupBy("held", "hit", "x").agg(F.count("*").alias("n")), "candidates")


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit, x, n) of a batch of (hit, x, n)."""
    hit, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
    return hit.astype(float), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(hit), FEATURES), n.astype(np.int64)


def boost_table(found: DataFrame, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32) -> Trees:
    """``boost`` over the rows (hit, x, n) of a table, a row counting n times; a job for each level of each tree."""
    source, sc = found.select("hit", "x", "n"), found.sparkSession.sparkContext
    steps = ", ".join(repr(float(q)) for q in np.linspace(0, 1, bins + 1)[1:-1])
    first = source.agg(F.sum("n"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)),
                       *[F.expr(f"percentile(x[{f}], array({steps}), n)") for f in range(FEATURES)]).first()
    cuts = [np.unique(first[2 + f]) for f in range(FEATURES)]
    mean = float(np.clip(first[1] / first[0], 1e-4, 1 - 1e-4))
    model = Trees(float(np.log(mean / (1 - mean))))
    inner = 2 ** depth - 1

    def level(feature: np.ndarray, cut: np.ndarray, done: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradients and of their slopes by (node of the level, feature, bin)."""
        nodes, cast = 2 ** done, sc.broadcast((model, cuts, feature, cut))  # the trees so far

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, edges, feature, cut = cast.value
            total = np.zeros((2, nodes * FEATURES * bins), np.int64)
            for batch in batches:
                if not len(batch):
                    continue
                y, x, n = _arrays(batch)
                p = trees.chance(x)
                parts = [np.rint(v * UNIT).astype(np.int64) * n for v in (y - p, p * (1 - p))]
                node = np.zeros(len(x), np.int64)
                for _ in range(done):
                    node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
                for f, e in enumerate(edges):
                    at = ((node - (nodes - 1)) * FEATURES + f) * bins + np.searchsorted(e, x[:, f], side="left")
                    for t, v in zip(total, parts):
                        np.add.at(t, at, v)
            cells = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(total[0][cells]), pa.array(total[1][cells])], ["cell", "g", "h"])

        out = np.zeros((2, nodes * FEATURES * bins))
        for r in source.mapInArrow(sums, "cell bigint, g bigint, h bigint").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():  # nodes x features x bins
            out[:, r["cell"]] = r["g"] / UNIT, r["h"] / UNIT
        cast.destroy()
        return tuple(out.reshape(2, nodes, FEATURES, bins))

    for _ in range(rounds):
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        leaves = []
        for done in range(depth):
            for k, (g, h) in enumerate(zip(*level(feature, cut, done)), 2 ** done - 1):
                total_g, total_h = g[0].sum(), h[0].sum()
                best, left = 1e-6, (total_g, total_h)
                for f, edges in enumerate(cuts):
                    if not len(edges):
                        continue
                    sum_g, sum_h = np.cumsum(g[f])[:len(edges)], np.cumsum(h[f])[:len(edges)]
                    gain = sum_g ** 2 / (sum_h + 1) + (total_g - sum_g) ** 2 / (total_h - sum_h + 1) - total_g ** 2 / (total_h + 1)
                    i = int(gain.argmax())
                    if gain[i] > best:
                        best, feature[k], cut[k], left = float(gain[i]), f, edges[i], (sum_g[i], sum_h[i])
                if done == depth - 1:
                    leaves += [left, (total_g - left[0], total_h - left[1])]
        model.trees.append((feature, cut, np.array([rate * g / (h + 1) for g, h in leaves])))
    return model


def threshold_table(held: DataFrame, trees: Trees) -> dict[str, float]:
    """By kind: the lowest step of the grid from which up the candidates (hit, x, n) reach ``PRECISION``; 2.0 if none does."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                y, x, n = _arrays(batch)
                step = np.floor(trees.chance(x) * GRID).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].astype(np.int32)), pa.array(step), pa.array(n), pa.array((n * y).astype(np.int64))],
                                                 ["kind", "step", "n", "hits"])

    out = {k: 2.0 for k in KINDS}
    n, hits = np.zeros((2, len(KINDS), GRID + 1), np.int64)
    for r in (held.select("hit", "x", "n").mapInArrow(scored, "kind int, step int, n bigint, hits bigint")
              .groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()):  # kinds x steps
        n[r["kind"], r["step"]], hits[r["kind"], r["step"]] = r["n"], r["hits"]
    for i, kind in enumerate(KINDS):
        above, right = (np.cumsum(c[i][::-1])[::-1] for c in (n, hits))
        good = np.flatnonzero((right >= PRECISION * above) & (right >= LEAST_HITS) & (n[i] > 0))
        if len(good):
            out[kind] = float(good[0] / GRID)
    return out


def fit(docs: DataFrame) -> Finder:
    found = candidate_counts(docs)
    labels = {(r["held"], r["hit"]) for r in found.select("held", "hit").distinct().collect()}  # four at most
    if len({hit for _, hit in labels}) < 2 or not any(not held for held, _ in labels):
        return NOTHING_ADDED
    trees = boost_table(found.where("not held"))
    return Finder(trees, threshold_table(found.where("held"), trees))


RESULT = "struct<n_email:bigint,n_ip:bigint,n_card:bigint,n_phone:bigint,base:string,spans:string,n_added:bigint,n_secrets:bigint>"


def spans_column(finder: Finder):
    """Column function: text -> counts of base spans, base spans and all spans as text."""

    @arrow_udf(RESULT)
    def found(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            base, added = finder.spans(text)
            out.append({f"n_{k}": sum(b[0] == k for b in base) for k in KINDS} | {"base": joined(base), "spans": joined(base + added),
                                                                                      "n_added": len(added), "n_secrets": len(secrets(text))})
        kinds = [(f"n_{k}", pa.int64()) for k in KINDS]
        return pa.array(out, pa.struct([*kinds, ("base", pa.string()), ("spans", pa.string()), ("n_added", pa.int64()), ("n_secrets", pa.int64())]))

    return found


def redacted_column(finder: Finder):
    """Column function: text -> text without its personal data."""

    @arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([redact(t, sum(finder.spans(t), [])) for t in texts.to_pylist()], pa.string())

    return clean


def find_pii(docs: DataFrame, finder: Finder | None = None) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans, the added ones and secrets counted, and n_private, all of them together."""
    finder = finder or fit(docs)
    found = pick(docs, "doc_id", "text").select("doc_id", spans_column(finder)("text").alias("f"))
    every = F.col("f.n_email") + F.col("f.n_ip") + F.col("f.n_card") + F.col("f.n_phone") + F.col("f.n_added") + F.col("f.n_secrets")
    return found.select("doc_id", *(f"f.n_{k}" for k in KINDS), F.sha2(F.col("f.base").cast("binary"), 256).alias("base_sha256"), "f.spans",
                        "f.n_added", "f.n_secrets", every.alias("n_private"))
