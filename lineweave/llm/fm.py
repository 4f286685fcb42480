"""Factorisation machine over selected hashed terms and binned statistics.

``score = w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``: every pair of
features interacts through the product of low-rank vectors, and the sum-of-squares identity makes the
score linear in the number of features present. All features are 0/1.

Features of a text are its distinct words, on request their first bytes (all hashed to 2**20
buckets), and the quantile bins of a few
statistics. Fitting works on a bounded sample of labelled rows (``sample_rows``, the first by a hash of
the id, whatever the size of the corpus): Spark counts every bucket per class over the sample. Buckets that tell
something alone (``least_gain``) are kept, at most ``terms``. Of the others the most frequent (``pair_terms``) are looked
at in pairs: a bucket is kept if the documents that hold it together with another one differ in class from
those of either bucket (``least_pair_gain``), so a word that counts in company only is seen too. What reaches the
driver is at most ``sample_rows x (terms + pair_terms + statistics)`` small integers. Scoring is one pass over the
documents without any shuffle.

Cases: without labelled rows, or with one class only, the model is a constant (0.5, or the class's
smoothed share) and no term is kept; an empty text has its statistics' bins only; a null text counts
as empty; labels that repeat an id count once (the largest); null labels and null ids are left out; documents
that repeat an id are learned from and scored once each; a very long text is one slice of work with about 20 bytes
for every byte of it; an empty table of documents gives a constant model and no scores; other columns of the
documents are ignored (:func:`scored`) or pass (:func:`kept`), whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.llm import textops as T
from lineweave.llm.tables import cut, prepare

BUCKET_BITS = 20


@dataclass
class Settings:
    """``separators``, ``prefixes`` (bytes from the start of longer words that are terms of their own)
    and ``statistics`` (Words, texts -> rows x statistics floats) define the features."""

    separators: np.ndarray
    statistics: Callable[[T.Words, list[bytes]], np.ndarray] | None = None
    prefixes: tuple[int, ...] = ()
    sample_rows: int = 8192
    terms: int = 4096
    least_rows: int = 5
    least_gain: float = 22.0
    pair_terms: int = 1024
    least_pair_gain: float = 60.0
    bins: int = 8
    rank: int = 8
    epochs: int = 30
    batch: int = 512
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    bias: float
    place: np.ndarray = field(default_factory=lambda: np.full(1 << BUCKET_BITS, -1, np.int32))
    edges: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    linear: np.ndarray = field(default_factory=lambda: np.empty(0))
    factors: np.ndarray = field(default_factory=lambda: np.empty((0, 1)))


def terms_of(words: T.Words, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word, and of the first bytes of every longer word."""
    rows, hashes = [words.doc], [words.h]
    for n in settings.prefixes:
        long = np.flatnonzero(words.end - words.start > n)
        codes = T.constants(256, 100 + n)
        total = np.full(len(long), T.U64(n))
        for j in range(n):
            total = T.mix(total + codes[words.buf[words.start[long] + j]])
        rows.append(words.doc[long])
        hashes.append(total)
    h = np.concatenate(hashes)
    return np.concatenate(rows).astype(np.int64), (h >> T.U64(64 - BUCKET_BITS)).astype(np.int64)


def _bins(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[s], stats[:, s], side="right") for s in range(stats.shape[1])], axis=1)


def features(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, start of each row's run; rows + 1 entries) for a slice of texts."""
    s = model.settings
    words = T.hash_words(texts, s.separators)
    row, bucket = terms_of(words, s)
    place = model.place[bucket]
    known = place >= 0
    width = np.int64(1) << 20
    pairs = [row[known] * width + place[known]]
    if s.statistics and model.edges.size:
        bins = _bins(s.statistics(words, texts), model.edges)
        first = len(model.linear) - bins.shape[1] * s.bins
        numbers = first + np.arange(bins.shape[1]) * s.bins + bins
        pairs.append((np.arange(len(texts), dtype=np.int64)[:, None] * width + numbers).ravel())
    both = np.unique(np.concatenate(pairs))
    return both % width, np.searchsorted(both, np.arange(len(texts) + 1, dtype=np.int64) * width)


def _row_sums(values: np.ndarray, run: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[run[1:]] - total[run[:-1]]


def logits(model: Model, numbers: np.ndarray, run: np.ndarray) -> np.ndarray:
    v = model.factors[numbers]
    linear = _row_sums(model.linear[numbers], run)
    squares = _row_sums(v, run) ** 2 - _row_sums(v * v, run)
    return model.bias + linear + 0.5 * squares.sum(axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def train(model: Model, numbers: np.ndarray, run: np.ndarray, y: np.ndarray) -> None:
    """Adam on the logistic loss with weight decay, in fixed random order."""
    s = model.settings
    rng = np.random.default_rng(s.seed)
    n, k = len(model.linear), s.rank
    model.factors = rng.normal(0.0, 0.02, (n, k))
    params = [np.array([model.bias]), model.linear, model.factors]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(s.epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), s.batch):
            rows = order[lo : lo + s.batch]
            sizes = run[rows + 1] - run[rows]
            own = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(run[rows] - own[:-1], sizes) + np.arange(own[-1])
            cols, row = numbers[at], np.repeat(np.arange(len(rows)), sizes)
            v = model.factors[cols]
            sums = _row_sums(v, own)
            z = params[0][0] + _row_sums(model.linear[cols], own) + 0.5 * (sums**2 - _row_sums(v * v, own)).sum(axis=1)
            error = (sigmoid(z) - y[rows]) / len(rows)
            by_entry = error[row]
            grads = [np.array([error.sum()]), np.bincount(cols, by_entry, n) + s.decay * model.linear, np.empty((n, k))]
            for f in range(k):
                grads[2][:, f] = np.bincount(cols, by_entry * (sums[row, f] - v[:, f]), n)
            grads[2] += s.decay * model.factors
            step += 1
            for p, g, (m1, m2) in zip(params, grads, moments):
                m1 *= 0.9
                m1 += 0.1 * g
                m2 *= 0.999
                m2 += 0.001 * g * g
                p -= s.rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    model.bias = float(params[0][0])


def _sample_buckets(settings: Settings):
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        row, bucket = terms_of(T.hash_words(texts, settings.separators), settings)
        both = np.unique(row << BUCKET_BITS | bucket)
        y = batch.column(0).to_numpy()[both >> BUCKET_BITS]
        return pa.RecordBatch.from_arrays([pa.array((both & ((1 << BUCKET_BITS) - 1)).astype(np.int32)), pa.array(y)], names=["bucket", "y"])

    return T.map_slices("text", work)


def _sample_statistics(settings: Settings):
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        stats = settings.statistics(T.hash_words(texts, settings.separators), texts)
        return pa.RecordBatch.from_arrays([pa.array(list(stats), pa.list_(pa.float64()))], names=["stats"])

    return T.map_slices("text", work)


def _sample_features(model: Model):
    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        numbers, run = features(model, texts)
        parts = (numbers[run[i] : run[i + 1]].astype(np.uint16) for i in range(len(texts)))
        return pa.RecordBatch.from_arrays([batch.column(0), T.binary_column(parts)], names=["y", "numbers"])

    return T.map_slices("text", work)


def _gain(n: np.ndarray, k: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Likelihood ratio of n rows, k of them of class 1, against a share of p."""
    with np.errstate(divide="ignore", invalid="ignore"):
        one = np.where(k > 0, k * np.log(k / (n * p)), 0.0)
        zero = np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - p))), 0.0)
    return np.nan_to_num(2 * (one + zero), nan=0.0, posinf=0.0)


def in_pairs(x: np.ndarray, y: np.ndarray, settings: Settings) -> np.ndarray:
    """For every column of the 0/1 matrix ``x``: its largest gain in a pair, that is, of the rows that hold both
    columns against the share of class 1 among the rows of either, whichever explains more."""
    n, k = x.sum(axis=0), y @ x
    # Half a row of each class keeps shares away from 0 and 1.
    share = (k + 0.5) / (n + 1.0)
    best = np.zeros(x.shape[1])
    for lo in range(0, x.shape[1], 256):
        some = slice(lo, lo + 256)
        both, ones = x.T @ x[:, some], x.T @ (x[:, some] * y[:, None])
        gain = np.minimum(_gain(both, ones, share[:, None]), _gain(both, ones, share[None, some]))
        gain[both < settings.least_rows] = 0.0
        gain[np.arange(lo, min(lo + 256, x.shape[1])), np.arange(gain.shape[1])] = 0.0
        best = np.maximum(best, gain.max(axis=1))
    return best


def _sampled(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, start of each row's run, labels) of the sample, in an order of its own."""
    rows = sample.mapInArrow(_sample_features(model), "y int, numbers binary").toPandas().sort_values(["y", "numbers"])
    parts = [np.frombuffer(b, np.uint16) for b in rows["numbers"]]
    run = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return np.concatenate(parts).astype(np.int64), run, rows["y"].to_numpy().astype(float)


def fit(docs: DataFrame, labels: DataFrame, label: str, settings: Settings) -> Model:
    """Learns ``label`` (0/1) from the rows of ``labels`` (doc_id, label); the caller has left out
    what must not be learned from. Only ``text`` of the joined documents is looked at."""
    prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    chosen = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The broadcast side has at most sample_rows rows of two numbers.
    sample = cut(texts.join(F.broadcast(cut(chosen, "fm-ids")), "doc_id"), "fm-sample").select("y", "text")

    n, positive = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    share = (positive + 1.0) / (n + 2.0)
    model = Model(settings, float(np.log(share / (1 - share))))
    if not 0 < positive < n:
        return model
    p = positive / n
    counts = sample.mapInArrow(_sample_buckets(settings), "bucket int, y int").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    # Likelihood ratio of the bucket's own class shares against the sample's.
    gain = F.expr(f"2 * (if(k = 0, 0, k * ln(k / (n * {p}D))) + if(k = n, 0, (n - k) * ln((n - k) / (n * {1 - p}D))))")
    counts = cut(counts.where(f"n >= {settings.least_rows}").withColumn("gain", gain), "fm-counts")
    alone = counts.where(f"gain >= {settings.least_gain}").orderBy(F.desc("gain"), "bucket").limit(settings.terms)
    others = counts.where(f"gain < {settings.least_gain}").orderBy(F.expr(f"abs(2 * n - {n})"), "bucket").limit(settings.pair_terms)
    terms, more = (d.select("bucket").toPandas()["bucket"].to_numpy() for d in (alone, others))
    terms = _with_pairs(sample, model, terms, more)
    model.place[terms] = np.arange(len(terms))
    columns = len(terms)
    if settings.statistics:
        stats = np.array(sample.mapInArrow(_sample_statistics(settings), "stats array<double>").toPandas()["stats"].tolist())
        model.edges = np.quantile(stats, np.arange(1, settings.bins) / settings.bins, axis=0).T
        columns += stats.shape[1] * settings.bins
    model.linear, model.factors = np.zeros(columns), np.zeros((columns, settings.rank))
    train(model, *_sampled(sample, model))
    return model


def _with_pairs(sample: DataFrame, model: Model, terms: np.ndarray, more: np.ndarray) -> np.ndarray:
    """``terms`` and those of ``more`` that tell something in a pair with any of both."""
    settings = model.settings
    if not len(more):
        return terms
    # The matrix is bounded too: the terms that tell most alone, and all others.
    looked = np.concatenate([terms[: settings.pair_terms], more])
    trial = Model(settings, 0.0, linear=np.zeros(len(looked)))
    trial.place[looked] = np.arange(len(looked))
    numbers, run, y = _sampled(sample, trial)
    x = np.zeros((len(y), len(looked)), np.float32)
    x[np.repeat(np.arange(len(y)), np.diff(run)), numbers] = 1.0
    gain = in_pairs(x, y.astype(np.float32), settings)[len(looked) - len(more) :]
    return np.concatenate([terms, more[gain >= settings.least_pair_gain]])


def scorer(model: Model) -> Callable[[list[bytes]], np.ndarray]:
    def score(texts: list[bytes]) -> np.ndarray:
        if not len(model.linear):
            return np.full(len(texts), sigmoid(np.array([model.bias]))[0])
        return sigmoid(logits(model, *features(model, texts)))

    return score


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every row of ``docs``."""
    prepare(docs.sparkSession)
    score = scorer(model)

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        s = score(texts)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(T.map_slices("text", work), "doc_id long, score double, predicted int")


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model predicts as 1, in all their columns."""
    prepare(docs.sparkSession)
    score = scorer(model)

    def work(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        return batch.filter(pa.array(score(texts) >= 0.5))

    return docs.mapInArrow(T.map_slices("text", work), docs.schema)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))
