"""Toxicity scores by a small convolutional text classifier, trained in NumPy.

Words (runs of letters and digits, ASCII lower-cased) are hashed into ``BUCKETS`` embedding rows; a word's vector is the sum of
the rows of the word and of its first bytes (``STEMS``), so that forms of one stem have something in common. Filters of
several widths slide over the whole text, each keeps its largest response, and a logistic unit turns these maxima into a
score. Scoring holds ``CHUNK`` positions at a time, however long a text is.

Every labelled row is learned from or calibrates. Up to ``most_each`` rows of each label train the network in the driver.
Where there are more, that is only where training starts: all rows then pass through it in parts (``improve``), each part on a
task, and the parts' changes are averaged by Spark. The fifth of the rows that is not trained on calibrates the score
(Platt scaling) and picks each language's threshold, by counts of all its scores.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import drop_table, flat, fresh, lower_ascii, map_arrow, materialize, named, possible, scramble, slices, word_hashes, word_spans

BITS, DIM, FILTERS, WIDTHS = 15, 16, 16, (1, 2, 3)
BUCKETS = 1 << BITS
STEMS = (4, 5)
PAD = BUCKETS  # embedding row of zeros between documents
CHUNK = 32768
THRESHOLD = 0.7
MOST_EACH = 4000
LIMITS = (0.3, 0.9)  # a language's calibrated threshold lies between: few calibration rows may part at any score
PART_ROWS = 8192  # rows that one copy of the model learns from before copies are averaged
UNIT = 2.0 ** 24  # changes of parameters are added up as whole numbers of 1 / UNIT: in any order with one result
BINS = 64  # scores are counted by logit in steps of 1 / BINS
DROPPED = 0.5  # share of words hidden in each training step, against learning single documents by heart

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows (word, stems) of every word of all texts, and the first word of each text."""
    data, offsets = flat(texts)
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets, _NOT_WORD)
    hashes = [word_hashes(data, starts, ends)]
    longer = np.concatenate([data, np.zeros(max(STEMS), np.uint8)])
    length = ends - starts
    for n in STEMS:
        stem = np.full(len(starts), n, np.uint64)
        for j in range(n):
            stem = stem << np.uint64(8) | np.where(j < length, longer[starts + j], 0).astype(np.uint64)
        hashes.append(scramble(stem))
    return np.stack([(h >> np.uint64(64 - BITS)).astype(np.uint16) for h in hashes], 1), first


def padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with PADs behind each text, so that no filter spans two texts; start of each text in it."""
    gap = max(WIDTHS)
    n = len(first) - 1
    out = np.full((len(ids) + gap * n, ids.shape[1]), PAD, np.uint16)
    out[np.arange(len(ids)) + gap * np.repeat(np.arange(n), np.diff(first))] = ids
    return out, first[:-1] + gap * np.arange(n)


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    bias: np.ndarray
    output: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict = field(default_factory=dict)

    def maxima(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Largest response of every filter in each text (ids as from ``padded``), chunk by chunk."""
        top = np.full((len(starts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        tail = np.full((max(WIDTHS), ids.shape[1]), PAD, np.uint16)
        every = np.concatenate([f[j] for f in self.filters for j in range(len(f))], axis=1)
        for at in range(0, len(ids), CHUNK):
            own = np.concatenate([ids[at:at + CHUNK + max(WIDTHS)], tail])
            n = min(CHUNK, len(ids) - at)
            a, b = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + n, "left")
            cuts = np.maximum(starts[a:b] - at, 0)
            x = sum(self.embedding[own[:, i]] for i in range(own.shape[1]))
            parts, col = x @ every, 0
            for w, width in enumerate(WIDTHS):
                response = parts[:n, col:col + FILTERS].copy()
                for j in range(1, width):
                    response += parts[j:n + j, col + j * FILTERS:col + (j + 1) * FILTERS]
                col += width * FILTERS
                part = np.maximum.reduceat(response, cuts, axis=0)
                cols = slice(w * FILTERS, (w + 1) * FILTERS)
                top[a:b, cols] = np.maximum(top[a:b, cols], part)
        return top

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        ids, starts = padded(ids, first)
        if not len(starts):
            return np.empty(0)
        return np.maximum(self.maxima(ids, starts) + self.bias, 0).astype(np.float64) @ self.output + self.intercept

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = self.slope * self.logits(*word_ids(texts)) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Steps:
    """Adam's state beside a model. Only the word positions that win a filter get gradients."""

    def __init__(self, model: Model, rng: np.random.Generator, rate: float):
        self.model, self.rng, self.rate, self.t = model, rng, rate, 0
        self.params = [model.embedding, *model.filters, model.bias, model.output]
        self.first_moment = [np.zeros_like(p) for p in self.params]
        self.second = [np.zeros_like(p) for p in self.params]
        self.intercept_m = self.intercept_v = 0.0

    def take(self, ids: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
        """One step on the logistic loss of some texts."""
        model, rate, gap = self.model, self.rate, max(WIDTHS)
        self.t += 1
        t = self.t
        first = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
        seq, starts = padded(np.concatenate(ids), first)
        ends = np.append(starts[1:], len(seq))
        seq[self.rng.random(len(seq)) < DROPPED] = PAD
        wide = np.concatenate([seq, np.full((gap, seq.shape[1]), PAD, np.uint16)])
        x = sum(model.embedding[wide[:, i]] for i in range(wide.shape[1]))
        grads = [np.zeros_like(p) for p in self.params]
        pooled, where = [], []
        for f in model.filters:
            response = sum(x[j:len(seq) + j] @ f[j] for j in range(len(f)))
            at = np.stack([a + response[a:b].argmax(0) for a, b in zip(starts, ends)])
            pooled.append(np.take_along_axis(response, at, 0))
            where.append(at)
        top = np.concatenate(pooled, 1) + model.bias
        h = np.maximum(top, 0)
        z = h @ model.output + model.intercept
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(ids)
        grads[-1] += h.T @ dz + 1e-4 * model.output
        dh = (dz[:, None] * model.output * (top > 0)).astype(np.float32)
        grads[-2] += dh.sum(0)
        for w, f in enumerate(model.filters):
            d, at = dh[:, w * FILTERS:(w + 1) * FILTERS], where[w]
            for j in range(len(f)):
                grads[1 + w][j] += np.einsum("nfd,nf->df", x[at + j], d)
                back = (d[:, :, None] * f[j].T[None]).reshape(-1, DIM)
                for i in range(wide.shape[1]):
                    np.add.at(grads[0], wide[(at + j).ravel(), i], back)
        grads[0][PAD] = 0
        for p, g, m, v in zip(self.params, grads, self.first_moment, self.second):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(p.dtype)
        g = dz.sum()
        self.intercept_m, self.intercept_v = 0.9 * self.intercept_m + 0.1 * g, 0.999 * self.intercept_v + 0.001 * g * g
        model.intercept -= rate * (self.intercept_m / (1 - 0.9 ** t)) / (np.sqrt(self.intercept_v / (1 - 0.999 ** t)) + 1e-8)


def fit(ids: list[np.ndarray], y: np.ndarray, seed: int = 5, batch: int = 64, rate: float = 0.01) -> Model:
    """Adam on the logistic loss, classes weighted alike."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.01, (BUCKETS + 1, DIM))  # small: words never trained on stay quiet
    emb = emb.astype(np.float32)
    emb[PAD] = 0
    model = Model(emb, [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(len(WIDTHS) * FILTERS, np.float32), rng.normal(0, 0.3, len(WIDTHS) * FILTERS), 0.0)
    n = len(ids)
    steps_each = max(1, -(-n // batch))
    epochs = int(np.clip(900 // steps_each, 6, 150))
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    steps = Steps(model, rng, rate)
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(n), steps_each):
            steps.take([ids[i] for i in some], y[some], weight[some])
    return model


def _rows(model: Model) -> np.ndarray:
    """All trained parameters as rows of ``DIM`` numbers, the embedding's first."""
    last = np.zeros(DIM)
    last[0] = model.intercept
    return np.concatenate([model.embedding.astype(np.float64), *[f.reshape(-1, FILTERS) for f in model.filters],
                           model.bias.reshape(-1, DIM), model.output.reshape(-1, DIM), last[None]])


def _set_rows(model: Model, rows: np.ndarray) -> None:
    """The inverse of ``_rows``."""
    at = 0
    for p in [model.embedding, *model.filters, model.bias, model.output]:
        n = p.size // DIM
        p[...] = rows[at:at + n].reshape(p.shape)
        at += n
    model.intercept = float(rows[at, 0])


def _dealt(docs: DataFrame, labelled: DataFrame, parts: int) -> DataFrame:
    """part, doc_id, toxic, text: every text of a labelled doc_id, once for each of its labels, sorted by a hash in each part.

    Texts move once: texts and labels are dealt by their doc_id alike and meet in their part. Texts whose doc_id has no label stay
    out as far as ``possible`` tells."""
    def part(key: str):
        return F.pmod(F.xxhash64(key, F.lit(13)), F.lit(parts)).alias("part")

    known = labelled.groupBy("id").agg(F.sort_array(F.collect_list("toxic")).alias("toxics"))
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    texts = possible(texts, F.col("doc_id"), labelled.select("id"), "likely").filter("likely")
    both = texts.select(part("doc_id"), "doc_id", "text", F.lit(None).cast("array<int>").alias("toxics")).unionAll(
        known.select(part("id"), F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), "toxics"))
    met = both.repartition(parts, "part").withColumn("toxics", F.max("toxics").over(Window.partitionBy("part", "doc_id")))
    return (met.filter("text IS NOT NULL AND toxics IS NOT NULL").select("part", "doc_id", F.explode("toxics").alias("toxic"), "text")
            .sortWithinPartitions("part", F.xxhash64("doc_id", F.lit(14)), "doc_id", "toxic", "text"))


def improve(model: Model, docs: DataFrame, labelled: DataFrame, n: int, share: float, batch: int = 64, rate: float = 0.003) -> None:
    """One pass of training over all texts of ``docs`` (doc_id, text) that ``labelled`` (id, toxic) has labels for, about ``n`` rows,
    ``share`` of them toxic.

    Rows are dealt to parts by a hash of doc_id; each part's task moves a copy of the model by its rows, ``batch`` at a time. A
    parameter row's new value is the mean over the parts that moved it, by their numbers of rows. The driver gets the sums:
    one row per parameter row, however many texts there are."""
    spark = docs.sparkSession
    parts = max(1, -(-n // PART_ROWS))
    sent = spark.sparkContext.broadcast(pickle.dumps(model))
    weights = np.array([0.5 / max(1 - share, 1e-9), 0.5 / max(share, 1e-9)])
    columns = [f"d{i}" for i in range(DIM)]
    dealt = _dealt(docs, labelled, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, names = _rows(pickle.loads(sent.value)), ["row", "n", *columns]
        state: dict = {}

        def begin(part: int) -> None:
            state.update(part=part, steps=Steps(pickle.loads(sent.value), np.random.default_rng(part), rate), n=0, ids=[], y=[])

        def take() -> None:
            if state["ids"]:
                y = np.array(state["y"])
                state["steps"].take(state["ids"], y.astype(np.float64), weights[y])
                state.update(n=state["n"] + len(y), ids=[], y=[])

        def moved() -> pa.RecordBatch:
            take()
            change = _rows(state["steps"].model) - start
            at = np.flatnonzero(change.any(1))
            whole = np.rint(change[at] * state["n"] * UNIT).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.full(len(at), state["n"], np.int64)), *[pa.array(c) for c in whole.T]], names)

        for rows in batches:
            for some in slices(rows):
                ids, first = word_ids(some.column("text"))
                for part, y, a, b in zip(some.column("part").to_pylist(), some.column("toxic").to_pylist(), first[:-1], first[1:]):
                    if state.get("part") != part:
                        if state:
                            yield moved()
                        begin(part)
                    state["ids"].append(ids[a:b])
                    state["y"].append(y)
                    if len(state["y"]) == batch:
                        take()
        if state:
            yield moved()

    schema = "row int, n long, " + ", ".join(f"{c} long" for c in columns)
    sums = map_arrow(dealt, run, schema).groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns])
    table = materialize(sums, "improve")
    new = _rows(model)
    for r in table.collect():  # at most one per row of _rows
        new[r.row] += np.array(r[2:], np.float64) / (r.n * UNIT)
    drop_table(table)
    _set_rows(model, new)


def _counted(model: Model, texts: DataFrame) -> tuple[np.ndarray, ...]:
    """Logit (in steps of 1 / BINS), label, number of rows and language of all ``texts``, one entry for those that agree."""
    sent = texts.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    most = 60 * BINS  # beyond it scores are 0 or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for rows in batches:
            for some in slices(rows):
                ids, first = word_ids(some.column("text"))
                # one text at a time: a logit's last bits, and so its step, would depend on the rows beside it
                z = np.array([own.logits(ids[a:b], np.array([0, b - a]))[0] for a, b in zip(first[:-1], first[1:])])
                at = np.clip(np.rint(z * BINS), -most, most).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(at), some.column("toxic"), some.column("lang")], ["at", "toxic", "lang"])

    found = materialize(map_arrow(texts, run, "at int, toxic int, lang string").groupBy("lang", "toxic", "at").agg(F.count("*").alias("n")), "scores")
    counts = found.orderBy("lang", "at", "toxic").collect()  # bounded: labels and steps of each language
    drop_table(found)
    return (np.array([r.at / BINS for r in counts]), np.array([r.toxic for r in counts], np.float64), np.array([r.n for r in counts], np.float64),
            np.array([r.lang for r in counts], object))


def calibrate(model: Model, z: np.ndarray, y: np.ndarray, weight: np.ndarray, lang: np.ndarray, n: np.ndarray | None = None) -> None:
    """Platt scaling of the logits (targets smoothed), then each language's threshold: the score of best weighted F1,
    where a language with fewer than ten positives takes that of all languages. ``n``: rows that an entry stands for, if not one."""
    rows = np.ones(len(y)) if n is None else n
    pos, neg = max(weight[y == 1].sum(), 1e-9), max(weight[y == 0].sum(), 1e-9)
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, c = weight * (p - target), weight * p * (1 - p)
        # a prior around slope 1, so that separable rows do not drive it up
        step = np.linalg.solve([[(c * z * z).sum() + 10, (c * z).sum()], [(c * z).sum(), c.sum() + 1]], [(g * z).sum() + 10 * (a - 1), g.sum() + b])
        step *= min(1.0, 1.0 / max(np.abs(step).max(), 1e-9))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    if not np.isfinite([a, b]).all() or a <= 0:
        a, b = 1.0, 0.0
    model.slope, model.shift = float(a), float(b)
    score = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))

    def best(of: np.ndarray) -> float:
        order = np.argsort(-score[of], kind="stable")
        s, hit, w = score[of][order], y[of][order], weight[of][order]
        right, named = np.cumsum(w * hit), np.cumsum(w)
        f1 = 2 * right / (named + (w * hit).sum())
        if n is not None:  # no cut between rows of one score
            f1[:-1][s[1:] == s[:-1]] = -1
        i = int(f1.argmax())
        below = s[i + 1] if i + 1 < len(s) else 0.0
        return float(np.clip((s[i] + below) / 2, *LIMITS))  # of equally good cuts, none at an extreme

    every = np.ones(len(y), bool)
    model.thresholds = {None: best(every) if (rows * y).sum() >= 10 else THRESHOLD}
    for name in {x for x in lang.tolist() if x is not None}:
        own = lang == name
        model.thresholds[name] = best(own) if (rows * y)[own].sum() >= 10 else model.thresholds[None]


def train(docs: DataFrame, labels: DataFrame, most_each: int = MOST_EACH, holdout: int | None = 1) -> Model:
    """Fit and calibrate on labelled rows of (doc_id, text, lang) and (doc_id, toxic).

    Rows whose crc32(doc_id as text) mod 3 is ``holdout`` are never read. All others are: four fifths train, the rest
    calibrates. Training starts in the driver with at most ``most_each`` rows of each label, those of lowest hash; where a label
    has more, all rows are then passed through (``improve``). Rows without a label or doc_id do not count;
    repeated labels of one doc_id do. Without both labels the model scores every text alike."""
    labelled = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    if holdout is not None:
        labelled = labelled.filter(F.crc32(F.col("id").cast("string").cast("binary")) % 3 != holdout)
    counts = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    more = any(n > most_each for n in counts.values())
    calibrates = F.pmod(F.xxhash64("id", F.lit(12)), F.lit(5)) == 4
    order = F.xxhash64("id", F.lit(11))
    start = labelled
    if more:  # where training starts: rows that have a text and do not calibrate
        start = labelled.filter(~calibrates).join(docs.select(F.col("doc_id").alias("id")), "id", "left_semi")
    first = None
    for label in (0, 1):
        own = start.filter(F.col("toxic") == label).orderBy(order, "id").limit(most_each)
        first = own if first is None else first.unionAll(own)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))

    def texts(of: DataFrame) -> DataFrame:
        return plain.join(of, F.col("doc_id") == F.col("id")).select("doc_id", "toxic", "lang", "text")

    def few(of: DataFrame) -> DataFrame:
        """``texts``, of which most do not move."""
        likely = possible(plain.filter("doc_id IS NOT NULL"), F.col("doc_id"), of.select("id"), "likely").filter("likely")
        return likely.join(of, F.col("doc_id") == F.col("id")).select("doc_id", "toxic", "lang", "text")

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids, first = word_ids(part.column("text"))
                blobs = [ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), part.column("lang"), pa.array(blobs, pa.binary())], ["doc_id", "toxic", "lang", "words"])

    rows = map_arrow(texts(F.broadcast(first)), prepare, "doc_id long, toxic int, lang string, words binary").collect()  # at most 2 * most_each
    rows.sort(key=lambda r: (zlib.crc32(b"%d" % r.doc_id), r.doc_id))
    y = np.array([r.toxic for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        empty = Model(np.zeros((BUCKETS + 1, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS],
                      np.zeros(len(WIDTHS) * FILTERS, np.float32), np.zeros(len(WIDTHS) * FILTERS), -4.0)
        empty.thresholds = {None: THRESHOLD}
        return empty
    ids = [np.frombuffer(r.words, np.uint16).reshape(-1, 1 + len(STEMS)) for r in rows]
    if more:
        model = fit(ids, y)
        n = sum(counts.values())
        improve(model, plain, labelled.filter(~calibrates), n * 4 // 5, counts[1] / n)
        z, y, n, lang = _counted(model, few(labelled.filter(calibrates)))
        if (n * y).sum() >= 3 and (n * (1 - y)).sum() >= 3:
            calibrate(model, z, y, n, lang, n)
        else:
            model.thresholds = {None: THRESHOLD}
        return model
    lang = np.array([r.lang for r in rows], object)
    apart = np.arange(len(rows)) % 5 == 4
    for label in (0, 1):  # tiny tables: calibrate on what there is
        if (y[apart] == label).sum() < 3 or (y[~apart] == label).sum() < 3:
            apart[:] = True
    learn = np.flatnonzero(~apart) if not apart.all() else np.arange(len(rows))
    model = fit([ids[i] for i in learn], y[learn])
    rest = np.flatnonzero(apart)
    z = np.concatenate([model.logits(np.concatenate([ids[i] for i in some]), np.concatenate(([0], np.cumsum([len(ids[i]) for i in some]))))
                        for some in np.array_split(rest, max(1, len(rest) // 100))])
    share = {label: counts.get(label, 0) / max(1, (y == label).sum()) for label in (0, 1)}  # labelled rows may lack a text or have several
    calibrate(model, z, y[rest], np.array([share[int(v)] for v in y[rest]]), lang[rest])
    return model


def _judged(docs: DataFrame, model: Model, columns: list, result, schema) -> DataFrame:
    """``result(rows, scores, limits, rejected)`` of every slice of ``columns`` of ``docs``, one of them ``text``; the language
    comes as one column more behind them."""
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # a fixed size: BUCKETS * DIM numbers
    cache: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "model" not in cache:
            cache["model"] = pickle.loads(sent.value)
        own = cache["model"]
        for batch in batches:
            for part in slices(batch, most=500_000):
                s = own.scores(part.column("text"))
                limit = np.array([own.thresholds.get(x, own.thresholds[None]) for x in part.column(part.num_columns - 1).to_pylist()])
                yield result(part, s, limit, s >= limit)

    [lang] = fresh(docs, "_lang")
    return map_arrow(docs.select(*columns, F.col("lang").cast("string").alias(lang)), run, schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text, lang) -> doc_id, score, predicted (score >= 0.7), threshold and rejected (by language).

    Reads whole texts; a null or empty text gets the score of no words; a null or unknown language the threshold
    of all languages. doc_id passes through, null and repeated ones too; other columns are ignored."""
    def result(part: pa.RecordBatch, s: np.ndarray, limit: np.ndarray, rejected: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array(limit), pa.array(rejected)],
                                          ["doc_id", "score", "predicted", "threshold", "rejected"])

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")]
    return _judged(docs, model, columns, result, "doc_id long, score double, predicted int, threshold double, rejected boolean")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns unchanged. Each row is judged by its own text and
    language: rows that share a doc_id, or have none, do not fall with each other."""
    names = docs.columns

    def result(part: pa.RecordBatch, s: np.ndarray, limit: np.ndarray, rejected: np.ndarray) -> pa.RecordBatch:
        return part.select(list(range(len(names)))).filter(pa.array(~rejected))

    return _judged(docs, model, named(docs), result, docs.schema)
