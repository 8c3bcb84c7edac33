"""Toxicity by a small bidirectional gated recurrent network, written and trained in numpy.

The inputs of a word are the evidence of the word itself and that of its character
4-grams and 5-grams (log odds of appearing in toxic training texts, shrunk by how often
they were seen), and a few hashed bits that let the network tell words apart. A forward
and a backward gated unit read a window of words, attention pools their states into one
vector, and a linear layer scores it. A text's score is that of its highest window;
overlapping windows cover the whole text.

Training: evidence is counted on a bounded sample of labelled texts; the windows with
the most evidence of each toxic text are its examples, the clean texts give their
hardest and some further windows as counterexamples. The last step fits the text score
to probabilities at the labels' own rate of toxic texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.common import batch, byte_column, ship, steps, texts_of

# Bounds of the training sample: texts of each class, and code points of a text in it.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1200, 1800, 20000
WINDOW, STRIDE = 30, 20  # words
HIDDEN = 8  # of each direction
EPOCHS, BATCH, RATE = 4, 256, 0.01
_BITS = 20  # of an evidence table's index
_HASHED = 4  # inputs that tell words apart
_INPUTS = 5 + _HASHED
_SEPARATORS = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_KNOWN_WORDS = 120_000  # words whose projections a worker remembers at once


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters and digits; text beyond ASCII counts as letters."""
    return text.decode().lower().encode().translate(_SEPARATORS).split()


def _slots(words: list[bytes]):
    """Table slots of the words and of their 4-grams and 5-grams, with each gram's word."""
    mask = np.uint64((1 << _BITS) - 1)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    line = b"".join([b"<" + w + b">" for w in words])
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.repeat(np.cumsum(size), size)
    owner = np.repeat(np.arange(len(words)), size)
    code = np.frombuffer(line, np.uint8).astype(np.uint64)
    out = [hashes & mask]
    for n in (4, 5):
        many = max(len(code) - n + 1, 0)
        h = np.full(many, n, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = (h ^ code[k : k + many]) * np.uint64(0x100000001B3)
                h ^= h >> np.uint64(31)
        inside = np.arange(many) + n <= end[:many]
        out.append((h[inside] & mask, owner[:many][inside]))
    return hashes, out


def _pooled(values: np.ndarray, owner: np.ndarray, n: int):
    """Largest and mean value of each word's grams; zero for a word without any."""
    most, mean = np.zeros(n, np.float32), np.zeros(n, np.float32)
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        most[owner[first]] = np.maximum.reduceat(values, first)
        count = np.diff(np.r_[first, len(owner)])
        mean[owner[first]] = np.add.reduceat(values, first) / count
    return most, mean


def inputs(words: list[bytes], evidence: np.ndarray) -> np.ndarray:
    """One row of network inputs per word."""
    out = np.zeros((len(words), _INPUTS), np.float32)
    if words:
        hashes, (own, four, five) = _slots(words)
        out[:, 0] = evidence[0][own]
        out[:, 1], out[:, 2] = _pooled(evidence[1][four[0]].astype(np.float32), four[1], len(words))
        out[:, 3], out[:, 4] = _pooled(evidence[2][five[0]].astype(np.float32), five[1], len(words))
        bits = (hashes[:, None] >> np.arange(40, 40 + _HASHED, dtype=np.uint64)) & np.uint64(1)
        out[:, 5:] = bits.astype(np.float32) * 0.2 - 0.1
    return out


def count_evidence(texts: list[list[bytes]], toxic: np.ndarray) -> np.ndarray:
    """Shrunk log odds, by slot, of words, 4-grams and 5-grams; each text counts once."""
    seen = np.zeros((3, 2, 1 << _BITS), np.float32)
    for words, label in zip(texts, toxic):
        distinct = list(set(words))
        if distinct:
            _, (own, four, five) = _slots(distinct)
            for k, slots in enumerate((own, four[0], five[0])):
                seen[k, label, np.unique(slots)] += 1
    clean, bad = max(int((toxic == 0).sum()), 1), max(int(toxic.sum()), 1)
    odds = np.log((seen[:, 1] + 0.5) / (bad + 1)) - np.log((seen[:, 0] + 0.5) / (clean + 1))
    total = seen.sum(1)
    return (odds * total / (total + 8) / 4).astype(np.float16)


def window_matrix(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of all windows of all texts (-1: none), and each window's text."""
    each = np.where(counts > 0, np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(counts)), each)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    begin = nth * STRIDE
    at = begin[:, None] + np.arange(WINDOW)
    inside = at < counts[text][:, None]
    base = (np.cumsum(counts) - counts)[text]
    return np.where(inside, at + base[:, None], -1), text


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """The weights, with scoring and one step of training."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        n = HIDDEN
        self.w = {"o": draw.normal(0, 0.3, 2 * n), "b": np.zeros(1), "v": draw.normal(0, 0.3, 2 * n)}
        for side in "fr":  # forward and reverse; gates in the order update, reset, new
            self.w["x" + side] = draw.normal(0, 0.5, (_INPUTS, 3 * n))
            self.w["c" + side] = np.zeros(3 * n)
            self.w["g" + side] = draw.normal(0, 0.3, (n, 2 * n))
            self.w["n" + side] = draw.normal(0, 0.3, (n, n))
        self.w = {k: x.astype(np.float32) for k, x in self.w.items()}
        self.moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in self.w.items()}
        self.taken = 0

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Input parts of both directions' gates; the last row is for positions without a word."""
        w = self.w
        both = np.concatenate([rows @ w["xf"] + w["cf"], rows @ w["xr"] + w["cr"]], axis=1)
        return np.concatenate([both, np.zeros((1, both.shape[1]), np.float32)])

    def _read(self, part, there, side, keep):
        """States (step, window, unit) of one direction; ``part`` gives a step's gate inputs."""
        n, w = HIDDEN, self.w
        h = np.zeros((there.shape[1], n), np.float32)
        states, kept = np.empty((WINDOW, there.shape[1], n), np.float32), []
        order = range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)
        for t in order:
            x = part(t)
            gates = _sigmoid(x[:, : 2 * n] + h @ w["g" + side])
            z, r = gates[:, :n], gates[:, n:]
            inner = h @ w["n" + side]
            new = np.tanh(x[:, 2 * n :] + r * inner)
            after = h + there[t][:, None] * (1 - z) * (new - h)
            if keep:
                kept.append((t, h, z, r, inner, new))
            h = after
            states[t] = h
        return states, kept

    def forward(self, table, at, keep=False):
        n = HIDDEN
        at = at.T
        there = (at >= 0).astype(np.float32)
        gate = {"f": slice(0, 3 * n), "r": slice(3 * n, 6 * n)}
        sides = [self._read(lambda t, s=s: table[at[t], gate[s]], there, s, keep) for s in "fr"]
        states = np.concatenate([sides[0][0], sides[1][0]], axis=2)
        energy = states @ self.w["v"] + (there - 1) * 1e9
        energy -= energy.max(0)
        weight = np.exp(energy) * there
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tb,tbn->bn", weight, states)
        logit = pooled @ self.w["o"] + self.w["b"][0]
        return (logit, states, weight, pooled, sides, there) if keep else logit

    def train(self, rows, at, label, importance):
        """One step of Adam on the weighted cross entropy of a batch of windows."""
        n, w = HIDDEN, self.w
        used, at = np.unique(at, return_inverse=True)  # -1, if there, comes first
        blank = int(len(used) > 0 and used[0] < 0)
        at, rows = at.reshape(label.shape[0], -1) - blank, rows[used[blank:]]
        table = self.project(rows)
        logit, states, weight, pooled, sides, there = self.forward(table, at, True)
        d_logit = ((_sigmoid(logit) - label) * importance / len(label)).astype(np.float32)
        grad = {k: np.zeros_like(x) for k, x in w.items()}
        grad["o"], grad["b"][0] = pooled.T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * w["o"]
        d_weight = np.einsum("bn,tbn->tb", d_pooled, states)
        d_energy = weight * (d_weight - (weight * d_weight).sum(0))
        grad["v"] = np.einsum("tb,tbn->n", d_energy, states)
        d_states = weight[:, :, None] * d_pooled + d_energy[:, :, None] * w["v"]
        x_all = np.concatenate([rows, np.zeros((1, rows.shape[1]), np.float32)])
        for k, side in enumerate("fr"):
            d_next = np.zeros((at.shape[0], n), np.float32)
            for t, h, z, r, inner, new in reversed(sides[k][1]):
                d = d_states[t][:, k * n : (k + 1) * n] + d_next
                live = d * there[t][:, None]
                d_new = live * (1 - z) * (1 - new * new)
                d_gates = np.concatenate(
                    [live * (h - new) * z * (1 - z), d_new * inner * r * (1 - r)], axis=1
                )
                d_next = d - live + live * z + d_gates @ w["g" + side].T + (d_new * r) @ w["n" + side].T
                grad["g" + side] += h.T @ d_gates
                grad["n" + side] += h.T @ (d_new * r)
                d_x = np.concatenate([d_gates, d_new], axis=1)
                grad["x" + side] += x_all[at[:, t]].T @ d_x
                grad["c" + side] += d_x.sum(0)
        self.taken += 1
        for k, g in grad.items():
            first, second = self.moments[k]
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            step = first / (1 - 0.9**self.taken) / (np.sqrt(second / (1 - 0.999**self.taken)) + 1e-8)
            w[k] -= (RATE * step).astype(np.float32)


class Model:
    """Evidence tables, network and calibration: of a fixed size whatever it was fitted on."""

    def __init__(self, evidence, network, scale, shift):
        self.evidence, self.network, self.scale, self.shift = evidence, network, scale, shift
        self.forget()

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("evidence", "network", "scale", "shift")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.forget()

    def forget(self) -> None:
        # the last row stays zero: it stands for positions without a word
        self.known, self.table = {}, np.zeros((1, 6 * HIDDEN), np.float32)

    def _rows(self, words: list[bytes]) -> np.ndarray:
        """Row of each word in the table of projections, which grows by unknown words."""
        get = self.known.get
        at = [get(w, -1) for w in words]
        if -1 in at:
            fresh = list(dict.fromkeys([w for w, k in zip(words, at) if k < 0]))
            if len(self.known) + len(fresh) > _KNOWN_WORDS:
                self.forget()
                fresh = list(dict.fromkeys(words))
            base = len(self.known)
            if base + len(fresh) >= len(self.table):
                held = self.table[:base]
                self.table = np.zeros((base + max(base // 2, len(fresh)) + 1, 6 * HIDDEN), np.float32)
                self.table[:base] = held
            self.known.update(zip(fresh, range(base, base + len(fresh))))
            self.table[base : base + len(fresh)] = self.network.project(inputs(fresh, self.evidence))[:-1]
            get = self.known.get
            at = [get(w) for w in words]
        return np.array(at, np.int64)

    def highest(self, texts: list[list[bytes]]) -> np.ndarray:
        """The highest window's score of each text, on the network's scale; -30 without words."""
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        best = np.full(len(texts), -30.0)
        rows = self._rows([w for t in texts for w in t])
        if len(rows):
            at, text = window_matrix(counts)
            for i in range(0, len(at), 4096):
                part = at[i : i + 4096]
                own = np.where(part >= 0, rows[part], -1)
                np.maximum.at(best, text[i : i + 4096], self.network.forward(self.table, own))
        return best

    def scores(self, texts: list[list[bytes]]) -> np.ndarray:
        return _sigmoid(np.clip(self.scale * self.highest(texts) + self.shift, -40, 40))


def _calibrated(highest: np.ndarray, label: np.ndarray, rate: float) -> tuple[float, float]:
    """Scale and shift that fit probabilities to text scores, classes weighted to ``rate``."""
    share = max(label.mean(), 1e-6)
    weight = np.where(label == 1, rate / share, (1 - rate) / max(1 - share, 1e-6))
    x = np.clip(highest, -30, 30)
    target = np.where(label == 1, 0.98, 0.02)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + b)
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-6
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(g * x).sum() + 1e-3 * (a - 1), g.sum()])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit(texts: list[bytes], toxic: list[int], rate: float, seed: int = 7) -> Model:
    """Train on labelled texts; ``rate`` is the share of toxic texts to calibrate to."""
    label = np.array(toxic, np.int64)
    words = [words_of(t) for t in texts]
    evidence = count_evidence(words, label)
    network, draw = Network(seed), np.random.default_rng(seed)
    distinct = list(dict.fromkeys(w for t in words for w in t))
    index = {w: k for k, w in enumerate(distinct)}
    rows = inputs(distinct, evidence)
    if len(distinct) and 0 < label.sum() < len(label):
        counts = np.fromiter(map(len, words), np.int64, len(words))
        at, text = window_matrix(counts)
        flat = np.fromiter((index[w] for t in words for w in t), np.int64, int(counts.sum()))
        strength = np.append(rows[:, :5].max(1), 0)
        ids = np.where(at >= 0, flat[at], -1)
        peak = np.where(ids >= 0, strength[ids], 0)
        peak = np.sort(peak, axis=1)[:, -2:].sum(1)
        order = np.lexsort((-peak, text))
        nth = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        other = draw.random(len(order)) < 0.1
        chosen = order[(nth < np.where(label[text[order]] == 1, 2, 3)) | (other & (label[text[order]] == 0))]
        # a toxic text's second window counts only if it has evidence of its own
        best = np.zeros(len(words), np.float32)
        np.maximum.at(best, text, peak)
        chosen = chosen[(label[text[chosen]] == 0) | (peak[chosen] >= 0.6 * best[text[chosen]])]
        target = label[text[chosen]].astype(np.float32)
        importance = np.where(target == 1, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6))
        for _ in range(EPOCHS):
            mixed = draw.permutation(len(chosen))
            for i in range(0, len(mixed), BATCH):
                pick = mixed[i : i + BATCH]
                network.train(rows, ids[chosen[pick]], target[pick], importance[pick])
    model = Model(evidence, network, 1.0, 0.0)
    if 0 < label.sum() < len(label):
        highest = np.concatenate([model.highest(words[i:j]) for i, j in steps([len(t) for t in texts])])
        model.scale, model.shift = _calibrated(highest, label, rate)
    else:
        model.shift = -4.0  # nothing to learn from: all texts count as clean
    model.forget()
    return model


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most SAMPLE_TOXIC and SAMPLE_CLEAN labelled texts that are not held out.

    The sample takes the ids with the smallest hashes of each class, and of those texts
    the ones of at most SAMPLE_CHARS code points. Labels that are null or neither 0 nor 1
    and labels without a text are passed over; of contradicting labels, toxic counts.
    """
    spark = ship(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    rates = known.agg(F.avg("label")).first()[0]
    sample = []
    for label, size in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        ids = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(size)
        sample += [(r["id"], label) for r in ids.collect()]
    if not sample:
        return fit([], [], 0.0)
    chosen = spark.createDataFrame(sample, "id long, label int")
    texts = texts_of(docs)
    got = (
        texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["id"])  # of a fixed size
        .where(F.length("text") <= SAMPLE_CHARS)
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
        .toArrow()
        .sort_by("id")
    )
    data = [x.encode() for x in got["text"].to_pylist()]
    return fit(data, got["label"].to_pylist(), float(rates or 0.0))


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def _scored(texts: list[bytes], model: Model) -> np.ndarray:
    out = [model.scores([words_of(t) for t in texts[i:j]]) for i, j in steps([len(x) for x in texts])]
    return np.concatenate(out) if out else np.zeros(0)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``.

    Null and empty texts and texts without words score close to 0. A null doc_id is not
    held out. Repeated rows score alike; other columns play no part; without any label
    all texts count as clean; an empty table gives an empty result.
    """
    spark = ship(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels))  # of a fixed size

    def score(batches):
        for found in batches:
            scores = _scored(byte_column(found.column(1)), model.value)
            yield batch(
                _SCORES,
                doc_id=found.column(0),
                held_out=found.column(2),
                score=scores,
                predicted=(scores >= 0.5).astype(np.int32),
            )
        model.value.forget()  # what it remembers of words; an idle worker holds none

    marked = texts_of(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return marked.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns."""
    spark = ship(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels))
    place = docs.columns.index("text")

    def keep(batches):
        for found in batches:
            texts = [x or b"" for x in byte_column(found.column(place))]
            yield found.filter(pa.array(_scored(texts, model.value) < 0.5))
        model.value.forget()

    return docs.mapInArrow(keep, docs.schema)
