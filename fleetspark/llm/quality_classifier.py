"""Quality by hashed word n-grams: logistic regression trained with follow-the-regularised-leader updates (op9).

Tokens are lower-cased words and runs of punctuation; a token that repeats one
of the two before it becomes a common repeat mark. Tokens and neighbouring
pairs are hashed to ``2**BITS`` weights; a document's counts are scaled to
length one. FTRL-proximal runs on the driver over a bounded sample, with a
learning rate for each weight and an L1 term that leaves rare weights at zero.
Scoring is one sparse dot product a document with the broadcast weights, whose
size is fixed.

Defined cases: NULL and empty texts get the score of the bias alone; with
training rows of one label only every score is that label (0 without any); rows with a NULL id are scored and not held out; repeated rows give
repeated results; an empty table gives an empty result. Labels, lang, source
and id are no inputs of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .common import map_slices, utf8_buffers
from .labelled import held_out, training_rows
from .toxicity import probability

BITS = 18
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.01
EPOCHS = 3
#: Bounds of the training sample: rows of each label, bytes of text in all.
SAMPLE_ROWS = {1: 6000, 0: 1500}
SAMPLE_BYTES = 32 << 20
THRESHOLD = 0.5

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(0x21, 0x7F) if not tk.ALNUM[b]]] = True
_REPEAT = np.uint64(0x5EED)


def features(texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, weight number, value), sorted by row; the values of a row have length one."""
    data, offsets = utf8_buffers(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
    rows = len(offsets) - 1
    parts = [tk.word_spans(data, offsets, kind) for kind in (tk.ALNUM, _PUNCTUATION)]
    start, end, row = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.argsort(start, kind="stable")
    start, end, row = start[order], end[order], row[order]
    token = tk.byte_span_hashes(tk.LOWER[data], start, end)
    again = np.zeros(len(token), bool)
    for k in (1, 2):
        again[k:] |= (token[k:] == token[:-k]) & (row[k:] == row[:-k])
    token[again] = _REPEAT
    pair = tk.gram_hashes(token, 2)
    inside = row[1:] == row[:-1]
    number = np.concatenate((tk.mix(token), pair[inside])) >> np.uint64(64 - BITS)
    key = np.concatenate((row, row[:-1][inside])) << BITS | number.astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    row = key >> BITS
    length = np.sqrt(np.bincount(row, count.astype(np.float64) ** 2, rows))
    return row, key & ((1 << BITS) - 1), count / length[row]


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 9) -> np.ndarray:
    """Weights, the bias last."""
    size = 1 << BITS
    weights = np.zeros(size + 1)
    if len(set(labels.tolist())) < 2:
        weights[size] = np.inf if len(labels) and labels[0] else -np.inf
        return weights
    parts = []
    for k in range(0, len(texts), 200):  # slices bound the scratch arrays
        row, number, value = features(texts[k : k + 200])
        parts.append((row + k, number.astype(np.int32), value.astype(np.float32)))
    row, number, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    start = np.searchsorted(row, np.arange(len(texts) + 1))
    del row, parts
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(at):
        return np.where(np.abs(z[at]) <= L1, 0.0, (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(texts)).tolist():
            at = np.append(number[start[i] : start[i + 1]], size)
            x = np.append(value[start[i] : start[i + 1]], 1.0)
            w = weight(at)
            g = (probability(np.dot(w, x)) - labels[i]) * x
            rise = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rise * w
            n[at] += g * g
    return weight(np.arange(size + 1))


def logits(texts: list[str | None] | pa.Array, weights: np.ndarray) -> np.ndarray:
    row, number, value = features(texts)
    return np.bincount(row, weights[number] * value, len(texts)) + weights[-1]


def score_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = THRESHOLD, sample_rows: dict[int, int] | None = None,
    sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    sample = training_rows(docs, labels, label_col, sample_rows or SAMPLE_ROWS, sample_bytes, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(train([t for t, _ in sample], np.array([y for _, y in sample], np.int64)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = probability(logits(batch.column(2), model.value))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["id", "held_out", "score", "predicted"]
        )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    schema = rows.select("id", "held_out").schema.add("score", "double").add("predicted", "integer")
    return map_slices(rows, run, schema, "text").withColumnRenamed("id", id_col)
