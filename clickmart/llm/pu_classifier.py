"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are labelled documents of good quality; unlabelled ones are web documents whatever their label. With a
class prior p and a loss l, the risk of a score g is p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)]): the
second part is the risk on negatives, which cannot be negative; where a batch makes it so, the step goes back.

The prior is estimated from the two samples: a first model tells positives from unlabelled documents; on rows it
did not see, the share of unlabelled documents above a score, over the share of positives above it, bounds the prior from
above, and the tightest bound over all scores with enough positives is taken. Labels of poor quality are never
used.

The threshold lies where the share of unlabelled documents above it is the prior, give or take what the estimate may be off
by: within that, in the widest gap between their scores. As the estimate can be too low, the threshold is never less than
``SPREAD`` robust deviations below the positives' median; a few wrong labels move neither of the two.

Features are read from the whole text: shares of character kinds and of single signs, word and line statistics.
Doc id, language and source are no inputs. The model is fitted on bounded samples (parameters ``positives`` and
``unlabelled``: rows with the smallest hashes of id and features), every document is scored.

Defined results: a missing text is empty, and an empty text scores 0. A document with several labels
is positive if all are. Repeated rows get equal scores. Without positives every other
score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Bounds of the samples the model is fitted on.
POSITIVES, UNLABELLED = 20_000, 40_000
THRESHOLD = 0.7
#: Part of the unlabelled documents that a gap between scores is measured over.
GAP = 0.005
#: Deviations (by the median absolute one) below the median that positives may reach without being rejected.
SPREAD = 3

SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KINDS = np.zeros((256, 6), np.float64)
for _byte in range(256):
    _char = chr(_byte)
    _KINDS[_byte, 0 if 48 <= _byte < 58 else 1 if 65 <= _byte < 91 else 2 if 97 <= _byte < 123 else 3 if _byte
           in (9, 10, 11, 12, 13, 32) else 4 if _byte < 128 else 5] = 1


def features(text: str) -> np.ndarray:
    """Figures of a whole text; all zero for an empty one."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(np.float64)
    n = max(1.0, counts.sum())
    kinds = counts @ _KINDS / n
    signs = counts[list(SIGNS)] / n
    words = data.split()
    m = max(1, len(words))
    distinct = set(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    long_lines = sum(map(len, lines)) / k
    ends = sum(not (w[-1:].isalnum() or w[-1] > 127) for w in distinct) / max(1, len(distinct))
    upper = sum(w.isupper() for w in distinct) / max(1, len(distinct))
    numbers = sum(w.isdigit() for w in distinct) / max(1, len(distinct))
    lengths = sum(map(len, words)) / m
    shape = [
        np.log1p(n) / 10, np.log1p(m) / 10, len(distinct) / m, len(distinct) / m**0.7, lengths / 10,
        np.log1p(long_lines) / 5, len(set(lines)) / k, np.log1p(k) / 5, ends, upper, numbers, k / m,
    ]
    if not data:
        return np.zeros(len(kinds) + len(signs) + 1 + len(shape))
    return np.concatenate([np.sqrt(kinds), np.sqrt(signs), [np.sqrt(signs.sum())], shape])


WIDTH = len(features("a"))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([features(t) for t in common.texts(batch.column("_text"))], np.float32)
        flat = pa.array(found.reshape(-1))
        offsets = np.arange(0, (batch.num_rows + 1) * WIDTH, WIDTH, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_file"), batch.column("_row"), batch.column("_id"),
             pa.ListArray.from_arrays(offsets, flat)],
            names=["_file", "_row", "_id", "x"],
        )


@dataclass
class Model:
    """Standardised features, then one hidden layer."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.maximum(z @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _train(
    pos: np.ndarray, unl: np.ndarray, prior: float, seed: int, hidden: int = 16, steps: int = 1500, rate: float = 4e-3
) -> tuple:
    """Weights that minimise the non-negative risk with the logistic loss, by Adam on batches."""
    rng = np.random.default_rng(seed)
    width = pos.shape[1]
    theta = [rng.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden),
             np.zeros(1)]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    size = 512
    batches = max(1, min(len(pos), len(unl)) // size)
    epochs = -(-steps // batches)
    t = 0

    def part(x: np.ndarray, sign: float, weight: float) -> tuple[float, list[np.ndarray]]:
        """Weighted mean of l(sign * g) and its gradient."""
        h = x @ theta[0] + theta[1]
        a = np.maximum(h, 0)
        g = sign * (a @ theta[2] + theta[3])
        loss = weight * float(np.mean(np.logaddexp(0, -g)))
        d = -sign * weight / (1 + np.exp(np.clip(g, -30, 30))) / len(x)
        back = np.outer(d, theta[2]) * (h > 0)
        return loss, [x.T @ back, back.sum(0), a.T @ d, np.array([d.sum()])]

    for epoch in range(epochs):
        orders = [np.array_split(rng.permutation(len(x)), batches) for x in (pos, unl)]
        for ip, iu in zip(*orders, strict=True):
            _, good = part(pos[ip], 1, prior)
            loss_p, from_p = part(pos[ip], -1, prior)
            loss_u, from_u = part(unl[iu], -1, 1.0)
            if loss_u - loss_p >= 0:
                grad = [a + u - p for a, u, p in zip(good, from_u, from_p, strict=True)]
            else:
                grad = [p - u for u, p in zip(from_u, from_p, strict=True)]
            t += 1
            step = rate * (1 - epoch / epochs * 0.9)
            for k, g in enumerate(grad):
                g = g + 1e-4 * theta[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                theta[k] = theta[k] - step * (first[k] / (1 - 0.9**t)) / (
                    np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8
                )
    return theta[0], theta[1], theta[2], float(theta[3][0])


def _slack(n_pos: int, n_unl: int) -> float:
    """What shares in two samples of these sizes may be off by."""
    return float(np.sqrt(np.log(20) / 2) * (n_pos**-0.5 + n_unl**-0.5))


def cut(unl: np.ndarray, prior: float, n_pos: int) -> float:
    """The logit above which the ``prior`` part of the unlabelled documents lies, within the widest gap near there."""
    found, n = np.sort(unl), len(unl)
    off = _slack(n_pos, n)
    width = max(1, round(GAP * n))
    low = int(np.clip((1 - prior - off) * n, 0, n - 1))
    high = int(np.clip((1 - prior + off) * n, low, n - 1))
    # A gap of several documents begins at each place; past the last one it ends there.
    begins = np.arange(low, high + 1)
    ends = np.minimum(begins + width, n - 1)
    best = int(np.argmax(found[ends] - found[begins]))
    return float(found[begins[best]] + found[ends[best]]) / 2


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 0) -> float:
    """Share of positives among the unlabelled, from scores of rows that the first model did not see."""
    if len(pos) < 2 or len(unl) < 2:
        return 0.5
    best = 1.0
    # The bound is looser the smaller the samples, so a part of what they may be off by is taken off.
    for fold in (0, 1):
        w1, b1, w2, b2 = _train(pos[fold::2], unl[fold::2], 0.5, seed)
        sp, su = (np.maximum(x[1 - fold :: 2] @ w1 + b1, 0) @ w2 + b2 for x in (pos, unl))
        slack = _slack(len(sp), len(su))
        for cut in np.quantile(sp, np.linspace(0.01, 0.8, 200)):
            above_p, above_u = np.mean(sp >= cut), np.mean(su >= cut)
            best = min(best, (above_u - slack * 0.1) / above_p)
    return float(np.clip(best, 0.05, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray, seed: int = 0) -> Model | None:
    """A model from features of trusted positives and of unlabelled documents."""
    if not len(pos) or not len(unl):
        return None
    mean, scale = unl.mean(0), np.maximum(unl.std(0), 1e-3)
    zp, zu = (np.clip((x - mean) / scale, -6, 6) for x in (pos, unl))
    prior = estimate_prior(zp, zu, seed)
    model = Model(mean, scale, *_train(zp, zu, prior, seed), prior)
    # Scores are shifted so that the cut lands at the threshold.
    known = model.logit(pos)
    middle = np.median(known)
    least = middle - SPREAD * 1.4826 * np.median(np.abs(known - middle))
    model.b2 += float(np.log(THRESHOLD / (1 - THRESHOLD)) - min(least, cut(model.logit(unl), prior, len(pos))))
    return model


# In Spark


def held_out(id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 2 by 4; a missing id does not."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    """The features of the ``n`` rows with the smallest hashes of id and features."""
    hashed = rows.select(F.xxhash64(F.lit(17), "_id", "x").alias("o"), "x")
    total = rows.count()
    if total > 4 * n:
        # Twice as many as needed pass, so that the order is made of them, not of n rows of every partition.
        hashed = hashed.filter(F.col("o") < -(1 << 63) + (2 * n * (1 << 64)) // total)
    found = hashed.orderBy("o").limit(n).select("x").toArrow()
    flat = found["x"].combine_chunks() if found.num_rows else None
    return flat.flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64) if found.num_rows else np.zeros((0, WIDTH))


def _scored(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("x").flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
        found = np.where(x.any(1), model.score(x) if model else 0.5, 0.0)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("_file", "_row", "_id")), pa.array(found, pa.float64())],
            names=["_file", "_row", "_id", "score"],
        )


def scores(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
    quality: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> DataFrame:
    """Per document: ``_file``, ``_row``, ``_id`` and the ``score`` of good quality.

    Rows that ``held_out`` marks lend neither labels nor features to the fit.
    """
    rows = common.keyed(docs, _id=id, _text=text)
    kind = rows.schema["_id"].dataType.simpleString()
    known = common.stored(
        common.map_arrow(rows, _featured, f"_file long, _row long, _id {kind}, x array<float>"), "features"
    )
    usable = known.filter(~held_out(F.col("_id")))
    good = (
        labels.select(F.col(label_id).alias("_id"), F.col(quality).alias("q")).groupBy("_id")
        .agg(F.min("q").alias("q")).filter("q = 1")
    )
    model = fit(_sample(usable.join(good, "_id", "left_semi"), positives), _sample(usable, unlabelled))
    out = common.map_arrow(known, _scored, f"_file long, _row long, _id {kind}, score double", model)
    out._model = model
    return out


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with at least that score, with all their columns."""
    docs = common.rooted(docs)
    kept = scores(docs, labels).filter(F.col("score") >= threshold).select("_file", "_row")
    return common.whole_rows(docs).join(kept, ["_file", "_row"], "left_semi").select("doc.*")
