"""Rule filter on repetition within a document, by suffix arrays over words (op7).

The longest common prefixes of neighbours in the suffix array give, for every
word, the longest word sequence that starts there and occurs again in the same
document (the maximal repeated substrings). The union of the spans of
``min_repeat`` words and more is the covered part. A document is rejected if
the covered part is over ``max_covered_percent`` of its words or a repeat is
longer than ``max_repeat`` words, and if it fails the base rules (under 50
words, or over half of its words in 3-word windows found twice).

Every row is judged alone: no shuffle, and memory bounded by a slice of the
batch (or one longer text). Defined cases: a NULL or empty text has zeros
everywhere and fails the base; repeated rows give repeated results; an empty
table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import tokens as tk
from .common import clean_columns, map_slices, utf8_buffers
from .suffixes import covered, longest_repeats

MIN_WORDS = 50
MIN_REPEAT = 10
MAX_COVERED_PERCENT = 50
MAX_REPEAT = 200

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, word_start: np.ndarray) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    start = np.union1d(breaks + 1, offsets[:-1])
    start = start[start < len(data)]
    end = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, start)], offsets[np.searchsorted(offsets, start, "right")] if len(start) else 0)
    has_word = np.searchsorted(word_start, end) > np.searchsorted(word_start, start)
    start, end = start[has_word], end[has_word]
    doc = np.searchsorted(offsets, start, "right") - 1
    key = tk.byte_span_hashes(data, start, end)
    order = np.lexsort((key, doc))
    again = np.zeros(len(order), bool)
    again[1:] = (key[order[1:]] == key[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    return np.bincount(doc[order[again]], minlength=rows)


def judge(data: np.ndarray, offsets: np.ndarray, min_repeat: int, max_covered_percent: int, max_repeat: int) -> dict[str, np.ndarray]:
    """The columns of :func:`quality_rules` for the texts of a slice."""
    w = tk.words(data, offsets)
    n_words = np.diff(w.offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[w.start] = 1
    inside[w.end] -= 1  # a word may start where, in the next row, another ends
    in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
    longest = longest_repeats(w.hash, w.doc)
    repeat_words = _per_row(covered(np.minimum(longest, 3), 3), w.offsets)
    covered_words = _per_row(covered(longest, min_repeat), w.offsets)
    most = np.zeros(len(n_words), np.int64)
    np.maximum.at(most, w.doc, longest)
    base_failed = (n_words < MIN_WORDS) | (100 * repeat_words > 50 * n_words)
    return {
        "n_words": n_words,
        "word_chars": _per_row(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
        "n_dup_lines": duplicate_lines(data, offsets, w.start),
        "n_repeat_words": repeat_words,
        "covered_words": covered_words,
        "longest_repeat": most,
        "base_failed": base_failed,
        "kept": ~base_failed & (100 * covered_words <= max_covered_percent * n_words) & (most <= max_repeat),
    }


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_repeat: int = MIN_REPEAT,
    max_covered_percent: int = MAX_COVERED_PERCENT,
    max_repeat: int = MAX_REPEAT,
    keep_columns: tuple[str, ...] = (),
) -> DataFrame:
    """(id, counts, base_failed, kept) for every row; ``keep_columns`` of the input are handed through."""
    rows = clean_columns(docs, id_col, text_col, *keep_columns)
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long, base_failed boolean, kept boolean"
    through = [id_col, *([text_col] if keep_columns else []), *keep_columns]
    schema = rows.select(*through).schema
    for part in counts.split(", "):
        schema = schema.add(*part.split())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8_buffers(batch.column(1))
        found = judge(data, offsets, min_repeat, max_covered_percent, max_repeat)
        own = [batch.column(batch.schema.get_field_index(c)) for c in through]
        return pa.RecordBatch.from_arrays([*own, *map(pa.array, found.values())], [*through, *found])

    return map_slices(rows, run, schema, text_col)
