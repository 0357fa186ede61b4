"""Toxicity by subword bags: embeddings of character n-grams, averaged into a linear softmax (op3).

A word is the bag of its character n-grams (with marks at its ends) and of the
whole word, hashed to ``2**BITS`` buckets. A document's vector is the average
of its words' subword embeddings; a linear softmax over the two classes is
trained jointly with the embeddings (AdaGrad, numpy, on the driver, over a
bounded sample). A misspelt or inflected word that the sample lacks still
shares most n-gram vectors with the known one.

Repeats of a word in a document count logarithmically, and the average counts
``NEUTRAL`` further subwords with a zero vector, so that a few words alone
don't decide. Buckets in under ``MIN_TEXTS`` training documents stay zero; the cut does not grow
with the sample, so rare words keep vectors of their own. Buckets in over
``MOST_SHARE`` of the training documents of label 0 stay zero, too. Since the softmax
is linear, scoring needs one number a bucket (the projection of its vector):
the broadcast model has a fixed size of 2**BITS floats.

Defined cases: NULL, empty and wordless texts get the score of the bias alone;
with training rows of one label only every score is that label (0 without
any); rows with a NULL id are scored and not held out; repeated rows
give repeated results; an empty table gives an empty result. Labels, lang,
source and id are no inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .common import map_slices, utf8_buffers
from .labelled import held_out, training_rows

BITS = 20
DIM = 4
NGRAMS = (3, 4, 5)
NEUTRAL = 300
EPOCHS = 8
RATE = 1.0
BATCH = 32
#: Bounds of the training sample: rows of each label, bytes of text in all.
SAMPLE_ROWS = {1: 1500, 0: 3000}
SAMPLE_BYTES = 24 << 20
THRESHOLD = 0.7
#: Training texts that a bucket must be in to have a vector, whatever the size of the sample.
MIN_TEXTS = 3
#: Largest share of the training texts of label 0 that such a bucket may be in; commoner ones only dilute long texts.
MOST_SHARE = 0.2


@dataclass
class Bags:
    """Words of a slice: for each (row, word) its weight; for each word its subword buckets."""

    row: np.ndarray
    word: np.ndarray
    weight: np.ndarray
    first: np.ndarray  # first bucket of each word, and the number of buckets at the end
    buckets: np.ndarray


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(first bucket of each word, buckets of all words)."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(size)
    word = np.repeat(np.arange(len(words)), size)
    up, down = tk.powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(tk.mix(points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    owners, hashes = [], []
    at = np.arange(len(points))
    for n in NGRAMS:
        i = at[at + n <= end[word]]
        owners.append(word[i])
        hashes.append(tk.mix((sums[i + n] - sums[i]) * down[i] + np.uint64(n)))
    start = end - size
    owners.append(np.arange(len(words)))
    hashes.append(tk.mix((sums[end] - sums[start]) * down[start] + np.uint64(99)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    bucket = (np.concatenate(hashes)[order] >> np.uint64(64 - BITS)).astype(np.int32)
    return np.searchsorted(owner[order], np.arange(len(words) + 1)), bucket


def bags(texts: list[str | None]) -> Bags:
    data, offsets = utf8_buffers(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    w = tk.words(data, offsets, ~tk.ALNUM)
    _, first, word = np.unique(w.hash, return_index=True, return_inverse=True)
    raw = data.tobytes()
    known = [raw[a:b].decode() for a, b in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)]
    start, buckets = subwords(known)
    key, count = np.unique(w.doc * np.int64(len(known) + 1) + word, return_counts=True)
    return Bags(key // (len(known) + 1), key % (len(known) + 1), 1 + np.log(count), start, buckets)


def features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each text; the weights are shares of its subwords and the neutral ones."""
    b = bags(texts)
    sizes = np.diff(b.first)
    limits = np.searchsorted(b.row, np.arange(len(texts) + 1))
    out = []
    for i, j in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        word, weight = b.word[i:j], b.weight[i:j]
        n = sizes[word]
        at = np.repeat(b.first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        total = (weight * n).sum() + NEUTRAL
        out.append((b.buckets[at], (np.repeat(weight, n) / total).astype(np.float32)))
    return out


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 3, min_texts: int = MIN_TEXTS) -> tuple[np.ndarray, float]:
    """(score of each bucket, bias): embeddings and softmax trained jointly, then projected on label 1 against 0."""
    size = 1 << BITS
    scores = np.zeros(size, np.float32)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        return scores, (np.inf if share else -np.inf)
    x: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(0, len(texts), 200):
        x += features(texts[k : k + 200])
    seen = np.zeros((2, size), np.int32)
    for (bucket, _), label in zip(x, labels.tolist(), strict=True):
        seen[label, np.unique(bucket)] += 1
    keep = (seen.sum(axis=0) >= min_texts) & (seen[0] <= MOST_SHARE * (labels == 0).sum())
    for k, (bucket, weight) in enumerate(x):
        ok = keep[bucket]
        x[k] = bucket[ok], weight[ok]
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (size, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_e, seen_s, seen_b = np.full(size, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            bucket = np.concatenate([x[i][0] for i in rows])
            weight = np.concatenate([x[i][1] for i in rows])
            count = np.array([len(x[i][0]) for i in rows])
            some = count > 0
            hidden = np.zeros((len(rows), DIM), np.float32)
            if some.any():
                hidden[some] = np.add.reduceat(embed[bucket] * weight[:, None], (np.cumsum(count) - count)[some])
            z = hidden @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1  # gradient of the cross entropy
            to_soft, to_bias, to_hidden = hidden.T @ p, p.sum(0), p @ soft.T
            used, at = np.unique(bucket, return_inverse=True)
            spread = np.repeat(to_hidden, count, axis=0) * weight[:, None]
            to_embed = np.stack([np.bincount(at, spread[:, d], len(used)) for d in range(DIM)], 1).astype(np.float32)
            seen_e[used] += (to_embed**2).mean(1)
            embed[used] -= rate * to_embed / np.sqrt(seen_e[used])[:, None]
            seen_s += to_soft**2
            soft -= rate * to_soft / np.sqrt(seen_s)
            seen_b += to_bias**2
            bias -= rate * to_bias / np.sqrt(seen_b)
    scores = (embed @ (soft[:, 1] - soft[:, 0])) * keep
    return scores.astype(np.float32), float(bias[1] - bias[0])


def logits(texts: list[str | None], scores: np.ndarray, bias: float) -> np.ndarray:
    b = bags(texts)
    n = np.diff(b.first)
    sums = np.concatenate(([0.0], np.cumsum(scores[b.buckets], dtype=np.float64)))
    by_word = sums[b.first[1:]] - sums[b.first[:-1]]
    top = np.bincount(b.row, b.weight * by_word[b.word], len(texts))
    return top / (np.bincount(b.row, b.weight * n[b.word], len(texts)) + NEUTRAL) + bias


def probability(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-z))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = THRESHOLD, sample_rows: dict[int, int] | None = None,
    sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    sample = training_rows(docs, labels, label_col, sample_rows or SAMPLE_ROWS, sample_bytes, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(train([t for t, _ in sample], np.array([y for _, y in sample], np.int64)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = probability(logits(batch.column(2).to_pylist(), *model.value))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["id", "held_out", "score", "predicted"]
        )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    schema = rows.select("id", "held_out").schema.add("score", "double").add("predicted", "integer")
    return map_slices(rows, run, schema, "text").withColumnRenamed("id", id_col)
