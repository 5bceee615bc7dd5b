"""Quality classifier by positive-unlabelled learning.

Trusted good documents are the positives, web text of unknown quality is the unlabelled set. The
class prior is estimated from how the two sets' scores part; a small network then minimises the
non-negative unbiased risk  prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .session import crc32_of_id

#: The bounded samples on which the network is fitted; every document is scored.
POSITIVES, UNLABELLED = 12_000, 24_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 40, 512, 0.01, 1e-4, 11
THRESHOLD = 0.3

_PUNCT = [i for i in range(33, 127) if not chr(i).isalnum()]
N_FEATURES = len(_PUNCT) + 14


def features(text: str | None) -> np.ndarray:
    """How a whole text looks: shares of characters by kind, of repeated words and lines, and lengths."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    count = np.bincount(raw, minlength=256).astype(np.float64)
    n = len(raw)
    out[: len(_PUNCT)] = np.sqrt(count[_PUNCT] / n)
    words, lines = text.split(), text.split("\n")
    n_words, n_lines = max(1, len(words)), len(lines)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    pairs = {(a, b) for a, b in zip(words, words[1:])}
    out[len(_PUNCT) :] = [
        upper / n, lower / n, count[48:58].sum() / n, count[128:].sum() / n, count[10] / n * 10, count[32] / n * 5,
        upper / max(1.0, upper + lower), np.log1p(n) / 10, np.log1p(n_words) / 10, n / n_words / 20,
        len(set(words)) / n_words, len(pairs) / max(1, n_words - 1), len(set(lines)) / n_lines, np.log1p(n_words / n_lines) / 5,
    ]
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(np.clip((x - self.mean) / self.scale, -6, 6) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def train(pos: np.ndarray, unl: np.ndarray, prior: float | None) -> Network:
    """Adam on mini-batches. ``prior`` None: positives against unlabelled, as a plain classifier."""
    rng = np.random.default_rng(SEED)
    both = np.vstack([pos, unl])
    net = Network(both.mean(0), both.std(0) + 1e-3, rng.normal(0, 0.2, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), 0.0, prior or 0.5)
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    per_epoch = max(1, min(len(unl) // BATCH, 60))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for _ in range(EPOCHS):
        for _ in range(per_epoch):
            p = pos[rng.integers(0, len(pos), min(BATCH, 4 * len(pos)))]
            u = unl[rng.integers(0, len(unl), min(BATCH, 4 * len(unl)))]
            x = np.clip((np.vstack([p, u]) - net.mean) / net.scale, -6, 6)
            h = np.tanh(x @ params[0] + params[1])
            z = h @ params[2] + params[3][0]
            zp, zu = z[: len(p)], z[len(p) :]
            if prior is None:
                g = np.concatenate([(sigmoid(zp) - 1) / len(p), sigmoid(zu) / len(u)])
            else:
                negative = _softplus(zu).mean() - prior * _softplus(zp).mean()
                d_neg = np.concatenate([-prior * sigmoid(zp) / len(p), sigmoid(zu) / len(u)])
                d_pos = np.concatenate([prior * (sigmoid(zp) - 1) / len(p), np.zeros(len(u))])
                # Where the unbiased negative risk falls below 0 it only fits noise: step back.
                g = d_pos + d_neg if negative >= 0 else -d_neg
            gh = np.outer(g, params[2]) * (1 - h * h)
            grads = [x.T @ gh + DECAY * params[0], gh.sum(0), h.T @ g + DECAY * params[2], np.array([g.sum()])]
            step += 1
            for q, d, (m, v) in zip(params, grads, moment):
                m *= 0.9
                m += 0.1 * d
                v *= 0.999
                v += 0.001 * d * d
                q -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    return net


def class_prior(pos_scores: np.ndarray, unl_scores: np.ndarray) -> float:
    """The largest share of positives that no score range contradicts.

    Of any region, the unlabelled share is at least prior * the positives' share; the least ratio over
    the upper regions that hold a tenth of the positives or more is therefore a bound for the prior.
    """
    cuts = np.quantile(pos_scores, np.linspace(0.02, 0.9, 45))
    ratios = [(unl_scores >= c).mean() / (pos_scores >= c).mean() for c in cuts]
    return float(np.clip(min(ratios), 0.05, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray) -> Network | None:
    """None if there is no positive to learn from."""
    if not len(pos):
        return None
    if not len(unl):
        unl = pos
    first = train(pos, unl, None)
    return train(pos, unl, class_prior(first.logit(pos), first.logit(unl)))


def _sample(docs: DataFrame, rows: int, among: DataFrame | None = None) -> np.ndarray:
    """Features of the ``rows`` first texts in the order of a hash, computed on the executors.

    The rows are chosen by hash and id alone, from those with an id of ``among`` if given; texts stay where
    they are read, and what is broadcast has at most ``rows`` rows of two numbers.
    """

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t).tobytes())

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    narrow = keyed.select("doc_id", "key")
    if among is not None:
        narrow = narrow.join(among, "doc_id", "left_semi")
    chosen = narrow.orderBy("key", "doc_id").limit(rows).distinct().toDF("chosen_id", "chosen_key")
    same = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("key") == F.col("chosen_key"))
    found = keyed.join(F.broadcast(chosen), same).select("key", "doc_id", packed("text").alias("x"))
    got = found.orderBy("key", "doc_id").limit(rows).collect()
    return np.array([np.frombuffer(r.x, dtype=np.float32) for r in got], dtype=np.float64).reshape(-1, N_FEATURES)


def held_out():
    return F.coalesce(F.pmod(crc32_of_id(), F.lit(5)) == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Positives: documents with quality 1 that aren't held out. Unlabelled: documents that aren't held out."""
    texts = docs.where(~held_out()).select("doc_id", "text")
    good = labels.where((F.col("quality") == 1) & ~held_out()).select("doc_id").distinct()
    return fit(_sample(texts, POSITIVES, good), _sample(texts, UNLABELLED))


def predict(docs: DataFrame, model: Network | None) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1 for each whole text; null and empty texts have all
    features 0. Without a model every score is 0.5. Repeated rows score alike."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = shipped.value
        for batch in texts:
            if net is None or not len(batch):
                yield pd.Series(np.full(len(batch), 0.5))
            else:
                yield pd.Series(net.score(np.stack([features(t) for t in batch]).astype(np.float64)))

    return docs.withColumn("score", score("text"))


def op3_quality(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    plain = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(plain, learn(docs, labels)).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
