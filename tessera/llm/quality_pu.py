"""Quality classifier by positive-unlabelled learning.

The non-negative unbiased risk  pi R_P(+) + max(0, R_U(-) - pi R_P(-))  is minimised by a small network over features
of the whole text. Trusted positives are rows labelled 1; unlabelled rows are web texts without a label. The class prior
pi is estimated from a first classifier (positives against unlabelled): the least ratio of the unlabelled rows' upper
tail to the positives' upper tail, each with a confidence margin.

Nulls count as empty texts and are scored. Labels that are null are no labels. With no positive or no unlabelled
row there is nothing to learn and every score is 0.5. Repeated rows are scored alike; of rows that repeat an id in the sample one is learnt, whatever their order.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, bounded_batches, held_out, materialise
from .words import shingles, word_hashes

#: The most rows of either kind that the networks are fitted on: the rows with the smallest hash of their id. All rows give scale, prior and cut.
SAMPLE_ROWS = 8000
THRESHOLD = 0.3

#: Outputs of a network are counted in so many bins for each unit, up to this size of an output.
BINS, OUTPUTS = 64, 1024

#: Byte classes: other, lower, upper, digit, blank, line end, sentence end, comma, exclaiming, asking, bar, symbol, quote, bracket, link, beyond ASCII.
_GROUPS = {1: "abcdefghijklmnopqrstuvwxyz", 2: "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 3: "0123456789", 4: " \t", 5: "\n\r", 6: ".", 7: ",;", 8: "!", 9: "?", 10: "|", 11: "#$%&*+=~^@", 12: "'\"`", 13: "()[]{}<>", 14: "/:_-\\"}
_CLASS = np.zeros(256, np.uint8)
for _k, _chars in _GROUPS.items():
    _CLASS[[ord(c) for c in _chars]] = _k
_CLASS[128:] = 15
N_FEATURES = 256 + 16 + 13


def _entropy(counts: np.ndarray) -> float:
    p = counts[counts > 0] / max(counts.sum(), 1)
    return float(-(p * np.log(p)).sum())


def text_features(text: bytes) -> np.ndarray:
    """Shares of byte classes and of pairs of them, and shares of repeated words, runs and lines."""
    out = np.zeros(N_FEATURES, np.float32)
    n = len(text)
    if not n:
        return out
    c = _CLASS[np.frombuffer(text, np.uint8)]
    pairs = c[:-1].astype(np.intp) * 16 + c[1:]
    out[:256] = np.sqrt(np.bincount(pairs, minlength=256) / n)
    out[256:272] = np.bincount(c, minlength=16) / n
    h, _ = word_hashes([text])
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = len(h)
    rest = [np.log1p(n), np.log1p(m), n / (m + 1), len(lines) / (m + 1)]
    if m:
        for s in (h, shingles(h, 4)):
            s = np.sort(s)
            first = np.flatnonzero(s[1:] != s[:-1])
            rest.append((len(first) + 1) / len(s))
            rest.append(_entropy(np.diff(first, prepend=-1, append=len(s) - 1)) / np.log(len(s) + 1))
    else:
        rest += [0.0] * 4
    distinct = set(lines)
    rest += [len(distinct) / max(len(lines), 1), sum(map(len, distinct)) / n, max(map(len, lines), default=0) / n]
    rest += [float(np.mean([x[-1:] in b".!?" for x in lines])) if lines else 0.0, 1.0 * (m == 0)]
    out[272 : 272 + len(rest)] = rest
    return out


def features(texts: list[bytes]) -> np.ndarray:
    return np.stack([text_features(t) for t in texts]) if texts else np.zeros((0, N_FEATURES), np.float32)


class Network:
    """One hidden layer; learnt with Adam on a loss whose slope at the outputs is given."""

    def __init__(self, n_in: int, hidden: int = 48, seed: int = 0):
        r = np.random.default_rng(seed)
        self.w = [r.normal(0, n_in**-0.5, (n_in, hidden)).astype(np.float32), np.zeros(hidden, np.float32), r.normal(0, hidden**-0.5, hidden).astype(np.float32), np.zeros(1, np.float32)]
        self.mean = np.zeros(n_in, np.float32)
        self.scale = np.ones(n_in, np.float32)
        self.cut = 0.0
        self.constant: float | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.maximum(x @ self.w[0] + self.w[1], 0)
        return a, a @ self.w[2] + self.w[3][0]

    def slopes(self, x: np.ndarray, a: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
        back = np.outer(d, self.w[2]) * (a > 0)
        return [x.T @ back, back.sum(0), a.T @ d, np.array([d.sum()], np.float32)]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self.forward(self.scaled(x))[1].astype(float) - self.cut
        return _sigmoid(z + np.log(THRESHOLD / (1 - THRESHOLD)))


def _adam(net: Network, batches, slope, rate: float = 3e-3, decay: float = 1e-4) -> None:
    m, v = [np.zeros_like(w) for w in net.w], [np.zeros_like(w) for w in net.w]
    for t, (p, u) in enumerate(batches, 1):
        for k, g in enumerate(slope(p, u)):
            g = g + decay * net.w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            net.w[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def _rounds(p: np.ndarray, u: np.ndarray, epochs: int, size: int, seed: int):
    r = np.random.default_rng(seed)
    steps = max(1, max(len(p), len(u)) // size)
    for _ in range(epochs):
        for _ in range(steps):
            yield p[r.integers(0, len(p), min(size, len(p)))], u[r.integers(0, len(u), min(size, len(u)))]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled, from both kinds' counts by bins of rising scores: the least ratio of upper tails."""
    n_p, n_u = p.sum(), u.sum()
    if not n_p or not n_u:
        return 0.5
    qp, qu = p[::-1].cumsum() / n_p, u[::-1].cumsum() / n_u
    e = np.sqrt(np.log(4 / delta) / 2) * (n_p**-0.5 + n_u**-0.5)
    ok = qp > 0
    best = np.argmin((qu[ok] + e) / qp[ok])
    return float(np.clip(qu[ok][best] / qp[ok][best], 0.02, 0.98))


def rank(net: Network, p: np.ndarray, u: np.ndarray, epochs: int, size: int, seed: int) -> None:
    """Fit net to tell positives from unlabelled rows."""

    def against(a: np.ndarray, b: np.ndarray):
        (ha, za), (hb, zb) = net.forward(a), net.forward(b)
        ga, gb = net.slopes(a, ha, -_sigmoid(-za) / len(a)), net.slopes(b, hb, _sigmoid(zb) / len(b))
        return [x + y for x, y in zip(ga, gb, strict=True)]

    _adam(net, _rounds(p, u, epochs, size, seed), against, decay=1e-3)


def minimise(net: Network, p: np.ndarray, u: np.ndarray, prior: float, epochs: int, size: int, seed: int) -> None:
    """Fit net to the least non-negative risk. Logistic loss, so scores are posteriors."""

    def risk(a: np.ndarray, b: np.ndarray):
        (ha, za), (hb, zb) = net.forward(a), net.forward(b)
        negative = np.logaddexp(0, zb).mean() - prior * np.logaddexp(0, za).mean()
        gu = net.slopes(b, hb, _sigmoid(zb) / len(b))
        gn = net.slopes(a, ha, prior * _sigmoid(za) / len(a))
        if negative < 0:  # the unbiased risk of negatives can't be below 0: step back instead
            return [y - x for x, y in zip(gu, gn, strict=True)]
        gp = net.slopes(a, ha, -prior * _sigmoid(-za) / len(a))
        return [x + y - z for x, y, z in zip(gp, gu, gn, strict=True)]

    _adam(net, _rounds(p, u, epochs, size, seed), risk, decay=1e-3)


def valley(z: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> float:
    """The output that separates the classes, from both kinds' counts at rising outputs z: the least dense place between the
    likely negatives (the lower half of the share of negatives among the unlabelled) and the lower edge of the trusted positives."""
    at = lambda n, q: z[min(np.searchsorted(n.cumsum(), q * n.sum()), len(z) - 1)]
    low, high = at(u, (1 - prior) / 2), at(p, 0.01)
    if high <= low:
        return float(high)
    grid, width = np.linspace(low, high, 101), (high - low) / 16
    dense = np.array([np.exp(-0.5 * ((z - g) / width) ** 2) @ (p + u) for g in grid])
    return float(grid[np.flatnonzero(dense <= dense.min() * 1.05 + 1e-9)].mean())


def labelled(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, quality) of the rows with a label, one for each id."""
    return labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_q"))


def sample_ids(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id") -> DataFrame:
    """(id, positive): at most rows trusted positives and as many unlabelled rows; none that is held out."""
    known = labelled(labels, id_col)
    ids = docs.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull() & ~held_out("_id")).distinct()
    joined = ids.join(known, "_id", "left")
    some = lambda cond, kind: joined.where(cond).orderBy(F.xxhash64("_id"), "_id").limit(rows).select("_id", F.lit(kind).alias("_positive"))
    return some(F.col("_q") == 1, True).unionByName(some(F.col("_q").isNull(), False))


def feature_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features) of every row."""

    def run(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in features(as_bytes(b.column(1)))], pa.binary())], ["_id", "_x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, _x binary")


def _matrix(stored: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(stored), np.float32).reshape(-1, N_FEATURES)


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature over all rows, by partial sums."""

    def run(it):
        n, total = 0, np.zeros((2, N_FEATURES))
        for b in it:
            x = _matrix(b.column(0).to_pylist()).astype(float)
            n, total = n + len(x), total + [x.sum(0), (x * x).sum(0)]
        yield pa.RecordBatch.from_arrays([pa.array(range(N_FEATURES), pa.int32()), pa.array([n] * N_FEATURES, pa.int64()), pa.array(total[0]), pa.array(total[1])], ["feature", "n", "s", "ss"])

    sums = rows.select("_x").mapInArrow(run, "feature int, n long, s double, ss double").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    got = sums.toPandas().sort_values("feature")
    mean = (got.s / got.n).to_numpy()
    return mean.astype(np.float32), np.sqrt(np.maximum((got.ss / got.n).to_numpy() - mean * mean, 0)).astype(np.float32)


def output_counts(rows: DataFrame, known: DataFrame, net: Network, without: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The network's outputs in bins, and how many of all trusted positives and of all unlabelled rows lie in each; held-out rows
    and the ids of without are not counted. Rows of one id are counted before they meet its label."""

    @F.arrow_udf("int")
    def output_bin(x: pa.Array) -> pa.Array:
        z = net.forward(net.scaled(_matrix(x.to_pylist())))[1]
        return pa.array(np.rint(np.clip(z, -OUTPUTS, OUTPUTS) * BINS).astype(np.int32))

    binned = rows.where(~held_out("_id")).select("_id", output_bin("_x").alias("_bin")).groupBy("_id", "_bin").count()
    if without is not None:
        binned = binned.join(F.broadcast(without), "_id", "left_anti")
    kinds = binned.join(known, "_id", "left").where(F.col("_q").isNull() | (F.col("_q") == 1)).groupBy("_bin")
    got = kinds.agg(F.sum(F.when(F.col("_q") == 1, F.col("count")).otherwise(0)).alias("p"), F.sum(F.when(F.col("_q").isNull(), F.col("count")).otherwise(0)).alias("u")).toPandas().sort_values("_bin")
    return got._bin.to_numpy() / BINS, got.p.to_numpy(float), got.u.to_numpy(float)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", epochs: int = 30, seed: int = 0) -> tuple[Network, float]:
    """The network of least non-negative risk and the class prior. Slopes come from a bounded sample, whose feature vectors alone
    reach the driver; the features' scale comes from all rows, prior and cut from all positives and unlabelled rows that aren't held out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known, stored = labelled(labels, id_col), materialise(feature_rows(docs, id_col, text_col), "quality")
    picked = F.broadcast(sample_ids(docs, labels, rows, id_col))  # at most 2 * rows ids
    got = stored.join(picked, "_id").toPandas().sort_values(["_id", "_x"]).drop_duplicates("_id")
    got = got.iloc[np.argsort([hash_order(str(i)) for i in got._id], kind="stable")]
    positive, unlabelled = got[got._positive.astype(bool)], got[~got._positive.astype(bool)]
    net, first = Network(N_FEATURES, seed=seed), Network(N_FEATURES, seed=seed + 1)
    if not len(positive) or not len(unlabelled):
        net.constant = 0.5
        return net, 0.5
    mean, deviation = moments(stored)
    for n in (net, first):
        n.mean, n.scale = mean, deviation + np.float32(1e-3)
    p, u = net.scaled(_matrix(positive._x)), net.scaled(_matrix(unlabelled._x))
    size, half_p, half_u = 256, len(p) // 2, len(u) // 2
    epochs, prior = max(epochs, 800 * size // max(len(p), len(u), size)), 0.5
    if half_p and half_u:
        rank(first, p[:half_p], u[:half_u], max(5, epochs // 4), size, seed)
        learnt = [(i,) for part, n in ((positive, half_p), (unlabelled, half_u)) for i in part._id[:n].tolist()]
        seen = spark.createDataFrame(learnt, T.StructType([T.StructField("_id", docs.schema[id_col].dataType)]))
        prior = estimate_prior(*output_counts(stored, known, first, seen)[1:])
    minimise(net, p, u, prior, epochs, size, seed + 2)
    net.cut = valley(*output_counts(stored, known, net), prior)
    return net, prior


def hash_order(s: str) -> int:
    import zlib

    return zlib.crc32(("order" + s).encode())


def score_column(net: Network, text_col: Column | str) -> Column:
    """The score of each text, 0 to 1."""

    @F.arrow_udf("double")
    def quality_score(t: pa.Array) -> pa.Array:
        return pa.array(net.score(features(as_bytes(t))), pa.float64())

    return quality_score(F.col(text_col) if isinstance(text_col, str) else text_col)
