"""Operator 3: language-model scoring with a gated recurrent network.

Word counts cover all training rows and are a table in the shared folder.  The
most frequent words are predicted by a GRU with a class-factored output: first
the word's class (words in order of frequency, ``CLASS_WORDS`` a class), then
the word among its class; all other words are one more class, within which a
word has its smoothed count's share.  There are ``VOCABULARY`` such words up to
``VOCABULARY_TOKENS`` training tokens and more beyond (the fourth root of the
tokens), so the vocabulary grows with the corpus.  The output starts as the
unigram model, so training only refines it.

Training is truncated backpropagation in numpy: windows of ``STEPS`` steps, the
state carried from window to window.  A first network is trained on the
``WARM_DOCS`` training rows with the smallest hashes of the id; from it every
task trains on every token of its training rows, and the mean of the tasks'
networks, weighted by tokens, is the model.

Scoring packs whole documents into lanes and carries each one's state from
window to window up to its end.  Counts of the ``HEAD`` most frequent words go
to the tasks; other words are looked up by a join with the table of counts.

Edge cases: null and empty texts are one end token; null ids are scored, never
learned from and not held out; unknown words count 0; without training rows
the base is the contract's formula with N = V = 0; repeated rows get equal
results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import bucket_of_id, pick, prepare

VOCABULARY = 2048
VOCABULARY_TOKENS = 4_000_000
CLASS_WORDS = 64
HIDDEN = 24
STEPS = 16
LANES = 128
WARM_DOCS = 1000
WARM_EPOCHS = 3
#: Words whose counts go to every task: at most 131,072 words and numbers.
HEAD = 131_072
#: Distinct words a task holds before it passes its counts on, tokens it scores at once.
COUNT_WORDS = 200_000
SCORE_TOKENS = 1_500_000
SMOOTH = 0.1
#: Floats of one row of network weights on their way to the mean.
CHUNK = 8192
END = b""


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased words, then the end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


# --- network ----------------------------------------------------------------


class Network:
    """GRU with class-factored softmax over vocabulary ids 0..size-1.

    Id ``size`` stands for every other word; its class is the last one.
    """

    NAMES = ("inputs", "state", "class_w", "class_b", "word_w", "word_b")

    def __init__(self, counts: np.ndarray, others: float, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.size, self.hidden = len(counts), hidden
        self.classes = -(-self.size // CLASS_WORDS)
        f = counts.astype(np.float64) + SMOOTH
        padded = np.zeros(self.classes * CLASS_WORDS)
        padded[:self.size] = f
        table = padded.reshape(self.classes, CLASS_WORDS)
        mass = np.append(table.sum(axis=1), others + SMOOTH)
        with np.errstate(divide="ignore"):
            inside = np.log(table / table.sum(axis=1, keepdims=True))
        inside[table == 0] = -1e9
        self.inputs = rng.normal(0, 0.1, (self.size + 1, 3 * hidden)).astype(np.float32)
        self.state = (rng.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.class_w = np.zeros((hidden, self.classes + 1), np.float32)
        self.class_b = np.log(mass / mass.sum()).astype(np.float32)
        self.word_w = np.zeros((self.classes, CLASS_WORDS, hidden), np.float32)
        self.word_b = inside.astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> "Network":
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def run(self, h: np.ndarray, x: np.ndarray, keep: np.ndarray, record: bool = False):
        """States of each step (T, B, H); ``keep`` is 0 where a document starts.

        Gates are (1 + tanh) / 2.  ``record``: also the states before each step,
        gates, candidates and carried products of all steps.
        """
        k, states, dtype = self.hidden, np.empty((*x.shape, self.hidden), self.state.dtype), self.state.dtype
        slots = len(x) if record else 1
        products, gates, news = (np.empty((slots, x.shape[1], n * k), dtype) for n in (3, 2, 1))
        before = np.empty((slots, x.shape[1], k), dtype)
        into, fresh = self.inputs[x], ~keep.all(axis=1)
        into_gates, into_new = into[:, :, :2 * k], into[:, :, 2 * k:]
        for t in range(len(x)):
            at = t if record else 0
            if fresh[t]:
                h = h * keep[t][:, None]
            u = np.matmul(h, self.state, out=products[at])
            zr = np.add(u[:, :2 * k], into_gates[t], out=gates[at])
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            n = np.multiply(zr[:, k:], u[:, 2 * k:], out=news[at])
            n += into_new[t]
            np.tanh(n, out=n)
            if record:
                before[t] = h
            d = h - n
            d *= zr[:, :k]
            h = np.add(n, d, out=states[t])
        return h, states, (before, gates, news, products[:, :, 2 * k:])

    def log_chances(self, states: np.ndarray, y: np.ndarray, grads: dict | None = None):
        """Natural logs of the targets' chances; fills gradients of the output layer.

        Rows lie by class, so a class is a slice: products are made slice by
        slice, everything else for all rows at once.
        """
        of = np.minimum(y // CLASS_WORDS, self.classes) if self.size % CLASS_WORDS == 0 else np.where(y == self.size, self.classes, y // CLASS_WORDS)
        order = np.argsort(of.astype(np.int16), kind="stable")  # HEAD / CLASS_WORDS classes at most
        of, s, rows = of[order], states[order], np.arange(len(y))
        edges = np.searchsorted(of, np.arange(self.classes + 1)).tolist()
        inner = edges[-1]  # rows from here on are of other words
        # states are within -1..1 and weights small, so no logit comes near the range of exp
        e = s @ self.class_w
        e += self.class_b
        logs = e[rows, of]
        np.exp(e, out=e)
        total = e @ np.ones(e.shape[1], e.dtype)
        logs -= np.log(total)
        if grads is not None:
            e *= (1 / total)[:, None]
            e[rows, of] -= 1
            grads["class_w"], grads["class_b"] = s.T @ e, e.sum(axis=0)
            back = e @ self.class_w.T
        slices = [(c, i, j) for c, (i, j) in enumerate(zip(edges, edges[1:])) if i < j]
        e, few = np.empty((inner, CLASS_WORDS), np.result_type(s, self.word_w)), rows[:inner]
        target = y[order[:inner]] - of[:inner] * CLASS_WORDS
        for c, i, j in slices:
            part = np.matmul(s[i:j], self.word_w[c].T, out=e[i:j])
            part += self.word_b[c]
        logs[:inner] += e[few, target]
        np.exp(e, out=e)
        total = e @ np.ones(CLASS_WORDS, e.dtype)
        logs[:inner] -= np.log(total)
        out = np.empty_like(logs)
        out[order] = logs
        if grads is None:
            return out
        e *= (1 / total)[:, None]
        e[few, target] -= 1
        grads["word_w"], grads["word_b"] = np.zeros_like(self.word_w), np.zeros_like(self.word_b)
        for c, i, j in slices:
            np.matmul(e[i:j].T, s[i:j], out=grads["word_w"][c])
            np.add.reduce(e[i:j], axis=0, out=grads["word_b"][c])
            back[i:j] += e[i:j] @ self.word_w[c]
        unsorted = np.empty_like(back)
        unsorted[order] = back
        return out, unsorted

    def gradients(self, h: np.ndarray, x: np.ndarray, y: np.ndarray, keep: np.ndarray, real: np.ndarray | None = None):
        """One window: (state after it, gradients of the negative log-likelihood, its sum); steps that aren't ``real`` count nothing."""
        k, grads = self.hidden, {}
        h1, states, (before, gates, n, carried) = self.run(h, x, keep, record=True)
        if real is None or real.all():
            logs, back = self.log_chances(states.reshape(-1, k), y.ravel(), grads)
        else:
            back = np.zeros((x.size, k), states.dtype)
            logs, back[real.ravel()] = self.log_chances(states.reshape(-1, k)[real.ravel()], y.ravel()[real.ravel()], grads)
        back, fresh = back.reshape(*x.shape, k), ~keep.all(axis=1)
        z, r = gates[:, :, :k], gates[:, :, k:]
        by_n, by_z, by_r = (1 - z) * (1 - n * n), (before - n) * 2 * z * (1 - z), carried * 2 * r * (1 - r)
        into, product, d = np.empty((*x.shape, 3 * k), states.dtype), np.empty((*x.shape, 3 * k), states.dtype), np.zeros_like(h)
        turned = np.ascontiguousarray(self.state.T)
        for t in range(len(x) - 1, -1, -1):
            d = d + back[t]
            np.multiply(d, by_z[t], out=into[t, :, :k])
            d_n = np.multiply(d, by_n[t], out=into[t, :, 2 * k:])
            np.multiply(d_n, by_r[t], out=into[t, :, k:2 * k])
            product[t, :, :2 * k] = into[t, :, :2 * k]
            np.multiply(d_n, r[t], out=product[t, :, 2 * k:])
            d *= z[t]
            d += product[t] @ turned
            if fresh[t]:
                d *= keep[t][:, None]
        flat_x = x.ravel()
        order = np.argsort(flat_x.astype(np.uint16) if self.size < 1 << 16 else flat_x, kind="stable")
        ordered = flat_x[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        grads["inputs"] = ordered[first], np.add.reduceat(into.reshape(-1, 3 * k)[order], first, axis=0)
        grads["state"] = before.reshape(-1, k).T @ product.reshape(-1, 3 * k)
        return h1, grads, -float(logs.sum())


class Trainer:
    """Adagrad over windows of a token stream."""

    def __init__(self, network: Network, rate: float):
        self.network, self.rate, self.tokens, self.loss = network, rate, 0, 0.0
        self.squares = {n: np.full_like(getattr(network, n), 1e-2) for n in Network.NAMES}

    def train(self, docs: list[np.ndarray], lanes: int = LANES) -> None:
        """Documents one after another, dealt to lanes in equal stretches; the last one is filled up with steps that don't count."""
        y = np.concatenate(docs)
        lanes = max(1, min(lanes, len(y) // STEPS))
        starts = np.cumsum([0, *map(len, docs[:-1])])
        end_id = int(docs[0][-1])
        x = np.concatenate(([end_id], y[:-1]))
        keep = np.ones(len(y), np.float32)
        keep[starts] = 0
        x[starts] = end_id
        length = -(-len(y) // lanes)
        real = np.arange(lanes * length) < len(y)
        pad = lanes * length - len(y)
        x, y, keep = np.append(x, np.full(pad, end_id)), np.append(y, np.full(pad, end_id)), np.append(keep, np.ones(pad, np.float32))
        x, y, keep, real = (a.reshape(lanes, length).T for a in (x, y, keep, real))
        h = np.zeros((lanes, self.network.hidden), self.network.state.dtype)
        for t in range(0, length, STEPS):
            wx, wy, wk, wr = (np.ascontiguousarray(a[t:t + STEPS]) for a in (x, y, keep, real))
            tokens = int(wr.sum())
            if not tokens:
                break
            h, grads, loss = self.network.gradients(h, wx, wy, wk, wr)
            self.tokens += tokens
            self.loss += loss
            self.step(grads, tokens)

    def step(self, grads: dict, tokens: int) -> None:
        for name in Network.NAMES:
            weights, squares, g = getattr(self.network, name), self.squares[name], grads[name]
            at: object = slice(None)
            if name == "inputs":
                at, g = g
            g *= 100.0 / tokens
            step = g * g
            if name == "inputs":
                step += squares[at]
                squares[at] = step
            else:
                squares += step
                step[...] = squares
            np.sqrt(step, out=step)
            np.divide(g, step, out=step)
            step *= self.rate
            weights[at] -= step


def packed(lengths: list[int], most: int) -> list[list[int]]:
    """Documents dealt to lanes: longest first, to the lane with least so far."""
    lanes = max(1, min(most, len(lengths)))
    heap, out = [(0, i) for i in range(lanes)], [[] for _ in range(lanes)]
    for d in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        load, lane = heapq.heappop(heap)
        out[lane].append(d)
        heapq.heappush(heap, (load + lengths[d], lane))
    return sorted(out, key=lambda ds: -sum(lengths[d] for d in ds))


def document_logs(network: Network, docs: list[np.ndarray], steps: int = 32, most: int = 512) -> np.ndarray:
    """Natural log-likelihood of each whole document (other words: of their class)."""
    if not docs:
        return np.zeros(0)
    lanes = packed([len(d) for d in docs], most)
    order = [d for lane in lanes for d in lane]
    lengths = np.array([len(docs[d]) for d in order])
    y = np.concatenate([docs[d] for d in order])
    starts = np.cumsum(lengths) - lengths
    x = np.concatenate((y[-1:], y[:-1]))
    x[starts] = y[-1]  # every document ends with the same id, and starts from it
    keep = np.ones(len(y), np.float32)
    keep[starts] = 0
    owner = np.repeat(order, lengths)
    loads = np.array([sum(len(docs[d]) for d in lane) for lane in lanes])
    first = np.cumsum(loads) - loads
    out = np.zeros(len(docs))
    h = np.zeros((len(lanes), network.hidden), network.state.dtype)
    for t in range(0, int(loads[0]), steps):
        live = int((loads > t).sum())  # lanes come with the longest first
        step = np.arange(t, min(t + steps, int(loads[0])))[:, None]
        inside = step < loads[None, :live]
        at = np.minimum(first[None, :live] + step, len(y) - 1)
        h, states, _ = network.run(h[:live], x[at], keep[at])
        at = at[inside]
        logs = network.log_chances(states[inside], y[at])
        out += np.bincount(owner[at], logs, len(docs))
    return out


# --- jobs ---------------------------------------------------------------------


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all rows of (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(n.keys()), pa.binary()), pa.array(list(n.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                n.update(words_of(text))
                if len(n) > COUNT_WORDS:
                    yield rows()
                    n.clear()
        yield rows()

    return docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def ranks_of(words: list[bytes], ranks: dict[bytes, int], other: int) -> np.ndarray:
    return np.fromiter(map(ranks.get, words, repeat(other)), np.int32, len(words))


def token_groups(texts, ids: dict[bytes, int], size: int, most: int):
    """Lists of documents (as vocabulary ids) of about ``most`` tokens."""
    held, tokens = [], 0
    for text in texts:
        words = words_of(text)
        held.append(ranks_of(words, ids, size))
        tokens += len(words)
        if tokens >= most:
            yield held
            held, tokens = [], 0
    if held:
        yield held


def mean_network(weights: DataFrame) -> np.ndarray:
    """(slot, chunk, tokens, w) -> the mean of w by tokens; slots bound what a task adds up."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(w, np.float64) for w in table.column("w").to_pylist())
        return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()], pa.int32()),
                         "tokens": pa.array([sum(table.column("tokens").to_pylist())], pa.int64()),
                         "w": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk int, tokens bigint, w binary"
    few = weights.groupBy("slot", "chunk").applyInArrow(add, schema)
    rows = sorted(few.groupBy("chunk").applyInArrow(add, schema).collect(), key=lambda r: r["chunk"])
    return np.concatenate([np.frombuffer(r["w"], np.float64) / max(1, r["tokens"]) for r in rows]) if rows else np.zeros(0)


class Model:
    """What scoring needs: head counts, totals and the network."""

    def __init__(self, words: list[bytes], counts: np.ndarray, total: int, distinct: int, network: Network, others: tuple[int, int]):
        self.words, self.counts, self.total, self.distinct = words, counts, total, distinct
        self.network, self.others = network, others


def vocabulary_of(tokens: int, least: int = VOCABULARY) -> int:
    """Words of the network: ``least``, times the fourth root of the tokens beyond VOCABULARY_TOKENS, in whole classes."""
    grown = least * max(1.0, tokens / VOCABULARY_TOKENS) ** 0.25
    return min(HEAD, max(least, int(grown) // CLASS_WORDS * CLASS_WORDS))


def most_frequent(counts: DataFrame, most: int, least: int) -> list:
    """Rows of (word, n), the most frequent first: at most ``most``, ``least`` if there are so many.

    Taken from a count on, found from a histogram over powers of 2**(1/4);
    only where these are fewer than ``least`` are the next ones sorted.
    """
    step = F.floor(F.log2("n") * 4).cast("int")
    sizes = {r["s"]: r["words"] for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("words")).collect()}  # 252 rows at most
    low, total = max(sizes, default=0) + 1, 0
    for s in sorted(sizes, reverse=True):
        if total + sizes[s] > most:
            break
        low, total = s, total + sizes[s]
    rows = counts.where(step >= low).collect()  # ``most`` rows at most
    rows.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    if total < least:
        rows += counts.where(step < low).orderBy(F.desc("n"), "word").limit(least - total).collect()
    return rows


def fit(docs: DataFrame, folder: str, vocabulary: int | None = None) -> tuple[Model, DataFrame]:
    """Model and table of counts from training rows (doc_id, text); ``vocabulary``: words of the network, by the corpus if None."""
    spark = docs.sparkSession
    count_words(docs).write.parquet(f"{folder}/counts")
    counts = spark.read.schema("word binary, n bigint").parquet(f"{folder}/counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    vocabulary = vocabulary or vocabulary_of(total, VOCABULARY)
    top = most_frequent(counts, HEAD, min(vocabulary, HEAD))
    words, n = [bytes(r["word"]) for r in top], np.array([r["n"] for r in top], np.int64)
    if END not in words[:vocabulary]:  # no training rows, or an end rarer than the vocabulary's words
        spot = min(len(words), vocabulary - 1)
        at = words.index(END) if END in words else None
        ends = int(n[at]) if at is not None else sum(r["n"] for r in counts.where(F.col("word") == F.lit(END)).collect())
        words, n = ([w for w in words if w != END], np.delete(n, at) if at is not None else n)
        words.insert(spot, END)
        n = np.insert(n, spot, ends)
    size = min(vocabulary, len(words))
    others = (int(total - n[:size].sum()), int(distinct - (n[:size] > 0).sum()))
    network = Network(n[:size], others[0])
    if total == 0:
        return Model(words, n, 0, 0, network, others), counts
    known = {w: i for i, w in enumerate(words[:size])}

    def warm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in batches for t in b.column(0).to_pylist()]  # WARM_DOCS rows at most
        for held in token_groups(texts, known, size, 1 << 60):
            trainer = Trainer(network, 0.05)
            for _ in range(WARM_EPOCHS):
                trainer.train(held, 32)
        yield pa.RecordBatch.from_arrays([pa.array([network.flat().astype("<f4").tobytes()], pa.binary())], ["w"])

    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(WARM_DOCS)
    sample = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text").dropDuplicates(["doc_id"])
    first = sample.orderBy("doc_id").limit(WARM_DOCS).coalesce(1).select("text").mapInArrow(warm, "w binary").first()
    network.load(np.frombuffer(first["w"], "<f4"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(network, 0.02)
        for held in token_groups((t for b in batches for t in b.column(0).to_pylist()), known, size, SCORE_TOKENS // 5):
            trainer.train(held)
        if trainer.tokens:
            flat = network.flat().astype(np.float64) * trainer.tokens
            parts = [flat[i:i + CHUNK] for i in range(0, len(flat), CHUNK)]
            slot = int(abs(flat[0]) * 1e6) % 64
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32()),
                 pa.array([trainer.tokens] * len(parts), pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["slot", "chunk", "tokens", "w"])

    trained = mean_network(docs.select("text").mapInArrow(train, "slot int, chunk int, tokens bigint, w binary"))
    if len(trained):
        network.load(trained)
    return Model(words, n, int(total), int(distinct), network, others), counts


ROW = "doc_id bigint, n_tokens bigint, known bigint, base double, net double, rare double, others bigint, beyond string"


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: what the head's counts and the network give, and the words beyond the head.

    ``base``/``rare``: sums of log10(c + 0.1) over head words, and over those
    of them outside the network's vocabulary; ``others``: tokens outside it.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # HEAD words and one network

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        size, ids = m.network.size, {w: i for i, w in enumerate(m.words)}
        logs = np.append(np.log10(m.counts + SMOOTH), 0.0)  # the last: beyond the head
        seen = np.append(m.counts > 0, False)

        def flush(rows: list, docs_ids: list) -> pa.RecordBatch:
            net = document_logs(m.network, docs_ids) / np.log(10)
            columns = [*zip(*rows)] if rows else [[] for _ in range(7)]
            doc, n, known, base, rare, others, beyond = (list(c) for c in columns)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(net, pa.float64()), pa.array(rare, pa.float64()), pa.array(others, pa.int64()), pa.array(beyond, pa.string())],
                ["doc_id", "n_tokens", "known", "base", "net", "rare", "others", "beyond"])

        rows, docs_ids, tokens = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                ranks = ranks_of(words, ids, -1)
                outside = (ranks < 0) | (ranks >= size)
                far = np.flatnonzero(ranks < 0)
                rows.append((doc, len(words), int(seen[ranks].sum()), float(logs[ranks].sum()), float(logs[ranks[outside]].sum()),
                             int(outside.sum()), b" ".join([words[i] for i in far]).decode() if len(far) else None))
                docs_ids.append(np.where(outside, size, ranks).astype(np.int32))
                tokens += len(words)
                if tokens >= SCORE_TOKENS:
                    yield flush(rows, docs_ids)
                    rows, docs_ids, tokens = [], [], 0
        if rows:
            yield flush(rows, docs_ids)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(score, ROW)


def lm_score(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    ``folder``: where the tables of counts and parts go; a new folder beside
    the checkpoints if None.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or f"{spark.sparkContext.getCheckpointDir()}/lm-{uuid.uuid4().hex}"
    source = pick(docs, "doc_id", "text")
    bucket = bucket_of_id(F.col("doc_id"), 10)
    model, counts = fit(source.where(bucket > 0), folder)
    # the number is written with the row, so both sides of the later join see the same one
    score_rows(source, model).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    rows = spark.read.schema(f"{ROW}, row bigint").parquet(f"{folder}/rows")
    far = rows.where("beyond is not null").select("row", F.explode(F.split("beyond", " ", -1)).alias("w")).select("row", F.col("w").cast("binary").alias("word"))
    c = F.coalesce("n", F.lit(0))
    looked_up = (far.join(counts, "word", "left").groupBy("row")
                 .agg(F.sum(F.log10(c + F.lit(SMOOTH))).alias("far_base"), F.sum((c > 0).cast("bigint")).alias("far_known")))
    beyond = F.coalesce("far_base", F.lit(0.0))
    log_all = F.log10(F.lit(model.total + SMOOTH * (model.distinct + 1)))
    log_others = F.log10(F.lit(model.others[0] + SMOOTH * (model.others[1] + 1)))
    return rows.join(looked_up, "row", "left").select(
        "doc_id", (bucket == 0).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("far_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + beyond - F.col("n_tokens") * log_all).alias("base_score"),
        (F.col("net") + F.col("rare") + beyond - F.col("others") * log_others).alias("score"))
