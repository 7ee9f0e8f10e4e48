"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams (edges included); the n-grams have
trained vectors in a hashed table, a bag of words is the mean of its words'
vectors, and a linear softmax gives its class.  Tables and softmax are trained
jointly in numpy, so a misspelling that was never seen shares most of its
n-gram vectors with the word it came from.

A text is scored by overlapping bags of ``WINDOW`` words over its whole length;
the most toxic bag decides, so one passage is not diluted by a long text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetframe.llm.common import append_to_table, crc32_fold, first_labelled, labelled_ids, ranges, read_table, text_blocks

BITS, DIM, SIZES = 17, 8, (3, 4, 5)
WINDOW, STRIDE = 8, 4
#: Documented bounds of the training sample: rows of each class, and characters of their texts together; longer
#: texts than PLAIN_CHARS are taken only for a class with few others (``first_labelled``).
ROWS_PER_CLASS, CHARS_PER_CLASS = 1500, 8_000_000
PLAIN_CHARS = 10_000
#: Gradient steps that a small sample gets at least.
LEAST_STEPS = 200
#: Weight of the starting evidence.
EVIDENCE = 4.0
BLOCK = 1 << 18

_SEPARATOR = np.array([not chr(i).isalnum() for i in range(128)] + [False])


@dataclass
class Bags:
    """N-grams of a block of texts: bucket and word of each, words of each text."""
    buckets: np.ndarray
    words: np.ndarray
    sizes: np.ndarray
    text_words: np.ndarray


def subword_bags(texts: list[str], bits: int = BITS) -> Bags:
    """Hashed character n-grams of every word (a run of letters and digits)."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    joined = " " + " ".join(lowered) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    separator = _SEPARATOR[np.minimum(codes, 128)]
    starts = np.zeros(len(codes), bool)
    starts[1:] = separator[:-1] & ~separator[1:]
    word_of = np.cumsum(starts) - 1
    ends = np.cumsum(lengths + 1)
    seen = np.concatenate([[0], np.cumsum(starts)[ends]])
    text_words = np.diff(seen)
    symbols = np.where(separator, np.uint32(1), codes).astype(np.uint64)
    gaps = np.cumsum(separator)
    buckets, words = [], []
    rolled = symbols[:-1] * np.uint64(0x100000001B3) + symbols[1:] if len(symbols) > 1 else symbols
    for n in range(3, max(SIZES) + 1):
        rolled = rolled[:-1] * np.uint64(0x100000001B3) + symbols[n - 1:]
        if len(rolled) == 0:
            break
        if n not in SIZES:
            continue
        valid = np.flatnonzero(gaps[n - 2:len(gaps) - 1] == gaps[:len(gaps) - n + 1])
        mixed = (rolled[valid] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append(((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                        >> np.uint64(64 - bits)).astype(np.int32))
        words.append(word_of[valid + 1].astype(np.int32))
    buckets = np.concatenate(buckets) if buckets else np.zeros(0, np.int32)
    words = np.concatenate(words) if words else np.zeros(0, np.int32)
    return Bags(buckets, words, np.bincount(words, minlength=int(text_words.sum())), text_words)


def windows(text_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and count by text of the overlapping bags of every text."""
    counts = np.where(text_words > 0, np.maximum(1, -(-(text_words - WINDOW) // STRIDE) + 1), 0)
    text_start = np.cumsum(text_words) - text_words
    first = np.repeat(text_start, counts) + STRIDE * ranges(np.zeros(len(counts), np.int64), counts)
    end = np.minimum(first + WINDOW, np.repeat(text_start + text_words, counts))
    return first, end, counts


@dataclass
class ToxicityModel:
    """Trained tables; ``scale`` and ``shift`` calibrate the deciding bag's logit."""
    vectors: np.ndarray
    softmax: np.ndarray
    scale: float
    shift: float

    def scorer(self):
        """The n-gram table projected on the softmax difference: what a task needs."""
        return (self.vectors @ (self.softmax[1] - self.softmax[0])).astype(np.float32), self.scale, self.shift


def bag_logits(table: np.ndarray, bags: Bags):
    words = np.bincount(bags.words, weights=table[bags.buckets], minlength=len(bags.sizes))[:len(bags.sizes)]
    words /= np.maximum(bags.sizes, 1)
    first, end, counts = windows(bags.text_words)
    total = np.concatenate([[0.0], np.cumsum(words)])
    return (total[end] - total[first]) / np.maximum(end - first, 1), first, end, counts


def text_logits(table: np.ndarray, bags: Bags) -> np.ndarray:
    """Logit of the deciding bag of each text; 0 where a text has no word."""
    logits, _, _, counts = bag_logits(table, bags)
    out = np.zeros(len(counts))
    some = counts > 0
    if some.any():
        out[some] = np.maximum.reduceat(logits, (np.cumsum(counts) - counts)[some])
    return out


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def train(texts: list[str], labels: np.ndarray, epochs: int = 8, rate: float = 300.0, seed: int = 7,
          class_counts: tuple[int, int] | None = None) -> ToxicityModel:
    """Joint gradient descent on n-gram vectors and softmax, documents in mini-batches.

    The gradient of a text goes to its bags in proportion to a softmax over
    their logits, sharper in later epochs.  One text in five is kept from the
    descent and calibrates the logit, at the class mix of ``class_counts`` (labels 0 and
    1 that the texts were sampled from; by default the texts' own).  Without both classes the model scores
    the share of label 1 for every text.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.5 / DIM, 0.5 / DIM, (1 << BITS, DIM))
    softmax = rng.normal(0, 0.5, (2, DIM))
    softmax /= np.linalg.norm(softmax[1] - softmax[0])
    labels = np.asarray(labels, float)
    if len(labels) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return ToxicityModel(vectors, softmax, 0.0, float(np.log(share / (1 - share))))
    order = rng.permutation(len(texts))
    kept = order[:max(2, len(order) // 5)]
    fit = order[len(kept):]
    batches = [fit[i:i + 64] for i in range(0, len(fit), 64)]
    prepared = [(subword_bags([texts[i] for i in b]), labels[b]) for b in batches]
    vectors += np.outer(EVIDENCE * evidence(prepared), softmax[1] - softmax[0])
    epochs = max(epochs, -(-LEAST_STEPS // len(batches)))
    share = labels[fit].mean()
    bias = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
    for epoch in range(epochs):
        sharp = 1.0 + 11.0 * epoch / epochs
        step = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(prepared)):
            bags, y = prepared[k]
            project = softmax[1] - softmax[0]
            logits, first, end, counts = bag_logits(vectors @ project, bags)
            if not len(logits):
                continue
            owner = np.repeat(np.arange(len(counts)), counts)
            top = np.full(len(counts), -np.inf)
            np.maximum.at(top, owner, logits)
            share_of = np.exp(np.clip(sharp * (logits - top[owner]), -60, 0))
            share_of /= np.bincount(owner, share_of, minlength=len(counts))[owner]
            text_logit = np.bincount(owner, share_of * logits, minlength=len(counts))
            error = _sigmoid(text_logit + bias) - y
            error *= np.where(y > 0, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
            flow = error[owner] * share_of / (end - first)
            edge = np.bincount(first, flow, minlength=len(bags.sizes) + 1)[:len(bags.sizes) + 1]
            edge -= np.bincount(end, flow, minlength=len(bags.sizes) + 1)[:len(bags.sizes) + 1]
            per_word = np.cumsum(edge)[:-1] / np.maximum(bags.sizes, 1)
            grad = np.bincount(bags.buckets, per_word[bags.words], minlength=1 << BITS) / len(y)
            touched = np.flatnonzero(grad)
            towards = grad[touched] @ vectors[touched]
            vectors[touched] -= step * np.outer(grad[touched], project) * 8
            softmax[1] -= step * towards * 0.01
            softmax[0] += step * towards * 0.01
            softmax /= np.linalg.norm(softmax[1] - softmax[0])
            bias -= 0.05 * error.mean()
    model = ToxicityModel(vectors, softmax, 1.0, 0.0)
    table = model.scorer()[0]
    held = text_logits(table, subword_bags([texts[i] for i in kept]))
    own = np.array([(labels == 0).sum(), (labels == 1).sum()], float)
    weight = (own if class_counts is None else np.maximum(np.array(class_counts, float), own)) / own
    weight *= own.sum() / (weight * own).sum()
    model.scale, model.shift = calibrate(held, labels[kept], weight[labels[kept].astype(int)])
    return model


def evidence(prepared) -> np.ndarray:
    """Two-sample z statistic of every n-gram bucket: share of toxic against share
    of other texts that hold it.  Starts the descent; weak evidence counts as none."""
    holds, totals = np.zeros((2, 1 << BITS)), np.zeros(2)
    for bags, y in prepared:
        text = np.repeat(np.arange(len(y)), bags.text_words)[bags.words]
        pairs = np.unique(text.astype(np.int64) << BITS | bags.buckets)
        for label in (0, 1):
            mine = y[pairs >> BITS] == label
            holds[label] += np.bincount(pairs[mine] & ((1 << BITS) - 1), minlength=1 << BITS)
            totals[label] += (y == label).sum()
    share = (holds.sum(0) + 0.5) / (totals.sum() + 1)
    z = (holds[1] / max(totals[1], 1) - holds[0] / max(totals[0], 1)) / np.sqrt(
        share * (1 - share) * (1 / max(totals[1], 1) + 1 / max(totals[0], 1)))
    return np.sign(z) * np.maximum(np.abs(z) - 3.0, 0.0)


def calibrate(logit: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0, steps: int = 50) -> tuple[float, float]:
    """Logistic fit ``sigmoid(scale * logit + shift)`` of weighted rows by Newton steps with a small ridge."""
    x = np.stack([logit, np.ones_like(logit)], 1)
    spread = max(float(np.std(logit)), 1e-6)
    x[:, 0] /= spread
    w = np.zeros(2)
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + 0.05 * np.array([w[0], 0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([0.05, 1e-6])
        w -= np.linalg.solve(hess, grad)
    return float(max(w[0] / spread, 1e-6)), float(w[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", fold=None,
                 rows_per_class: int = ROWS_PER_CLASS, chars_per_class: int = CHARS_PER_CLASS) -> ToxicityModel:
    """Train on a bounded sample (``first_labelled``) of the rows where ``fold`` holds;
    the score is calibrated at the class mix of all of them, so the bound does not move it."""
    fold = F.lit(True) if fold is None else fold
    rows = first_labelled(docs, labels, label_col, fold, rows_per_class, chars_per_class, ["text"], PLAIN_CHARS) \
        .select("doc_id", "text", "label").toPandas().sort_values("doc_id")
    counts = dict(map(tuple, labelled_ids(labels, label_col, fold).groupBy("label").count().collect()))
    return train(rows["text"].tolist(), rows["label"].to_numpy(), class_counts=(counts.get(0, 0), counts.get(1, 0)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: more toxic) and ``predicted`` (1 from 0.5 on).

    Every whole text is scored.  Null, empty and word-less texts are a bag of no
    words and get the score of a zero logit.  All other columns are kept;
    columns named like the results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.scorer())  # 2^17 floats

    def score(column: pa.Array) -> list[pa.Array]:
        table, scale, shift = shared.value
        out = np.empty(len(column))
        for lo, hi, texts in text_blocks(column, BLOCK):
            out[lo:hi] = _sigmoid(scale * text_logits(table, subword_bags(texts)) + shift)
        return [pa.array(out), pa.array((out >= 0.5).astype(np.int32))]

    return append_to_table(docs, lambda t: F.col(t.of(text_col)), score, "score double, predicted int")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``documents``; labels
    with crc32(doc_id) mod 5 = 0 are held out of the training (null id: held_out NULL)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"), fold=crc32_fold("doc_id", 5) != 0)
    held = docs.withColumn("held_out", crc32_fold("doc_id", 5) == 0)
    return score_toxicity(held, model).select("doc_id", "held_out", "score", "predicted")
