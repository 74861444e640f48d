"""Ordinal cumulative-link regression on graded ratings, over hashed text.

P(grade >= k) = sigmoid(w . x - threshold_k), with one weight vector and ordered thresholds. The features of a text are
the shares of its words in 2**16 buckets: each word as it is written, and what it looks like (capitals, digits, signs at
its end, its length, whether it repeats an earlier word of its line). A few weights for looks learn fast, as many words share them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import ship
from rollmill.llm.labelled import PER_CLASS, labelled_sample
from rollmill.llm.text import U64, Piece, mix, pieces, unused

BITS = 16
#: The last buckets are for looks.
LOOKS = 32
EPOCHS = 200
#: A document is selected when its grade is 1 or more with this probability.
SELECT_AT = 0.5

_bytes = np.arange(256)
_UPPER = (_bytes >= 0x41) & (_bytes <= 0x5A)
_LETTER = _UPPER | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
_DIGIT = (_bytes >= 0x30) & (_bytes <= 0x39)
_SIGN = ~(_LETTER | _DIGIT) & (_bytes > 0x20)


@dataclass
class Ordinal:
    weight: np.ndarray
    thresholds: np.ndarray  # ordered; one less than the grades
    grades: np.ndarray  # ascending


def _runs(table: np.ndarray, piece: Piece) -> np.ndarray:
    """Bytes of a kind in each word."""
    whole = np.zeros(len(piece.buf) + 1, np.int64)
    np.cumsum(table[piece.buf], out=whole[1:])
    return whole[piece.end] - whole[piece.start]


def buckets(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a piece: text numbers, buckets and shares, sorted by text."""
    n = len(piece.start)
    size = piece.end - piece.start
    word = piece.hashes(lower=False)
    text = np.repeat(np.arange(piece.hi - piece.lo), piece.count)
    upper, letter, digit, sign = (_runs(t, piece) for t in (_UPPER, _LETTER, _DIGIT, _SIGN))
    folded = piece.hashes()
    same = np.zeros(n, bool)
    same[1:] = (folded[1:] == folded[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((folded, text))
    again = np.zeros(n, bool)
    again[order[1:]] = (folded[order[1:]] == folded[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    looks = [(upper > 1) & (upper == letter), digit > 0, sign == 1, sign == 2, sign >= 3, same, again & (size > 6), size <= 2, size >= 16, letter == 0]
    top = (1 << BITS) - LOOKS
    count = np.maximum(piece.count, 1)
    texts, where, share = [text], [(word % U64(top)).astype(np.int64)], [1.0 / count[text]]
    for k, on in enumerate(looks):
        texts.append(text[on])
        where.append(np.full(int(on.sum()), top + k))
        share.append(1.0 / count[text[on]])
    # one row for each text that is short, and one for each that has no words
    for k, on in ((len(looks), piece.count == 0), (len(looks) + 1, piece.count < 8)):
        rows = np.flatnonzero(on)
        texts.append(rows)
        where.append(np.full(len(rows), top + k))
        share.append(np.ones(len(rows)))
    key = np.concatenate(texts) * (1 << BITS) + np.concatenate(where)
    key, back = np.unique(key, return_inverse=True)
    return key >> BITS, key & ((1 << BITS) - 1), np.bincount(back, np.concatenate(share), len(key))


def scaled(where: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shares on one scale: those of looks are large and met in many texts, those of words are small."""
    return np.where(where >= (1 << BITS) - LOOKS, 10 * share, np.sqrt(share))


def scores(weight: np.ndarray, piece: Piece) -> np.ndarray:
    text, where, share = buckets(piece)
    return np.bincount(text, weight[where] * scaled(where, share), piece.hi - piece.lo)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(sample: pa.Table, totals: dict[int, int], rate: float = 0.3, decay: float = 2e-4) -> Ordinal:
    """Full-batch Adagrad on (grade, text). Thresholds are a first one and positive gaps, so they stay ordered; rows are weighed by totals."""
    grade = np.array(sample.column("grade").to_pylist(), np.int64)
    grades = np.unique(grade) if len(grade) else np.array([0])
    level = np.searchsorted(grades, grade)
    k = len(grades) - 1
    weight = np.zeros(1 << BITS)
    if not k:
        return Ordinal(weight.astype(np.float32), np.zeros(0), grades)
    rows, where, share, at = [], [], [], 0
    for piece in pieces(sample.column("text")):
        t, w, s = buckets(piece)
        rows.append((t + at).astype(np.int32))
        where.append(w.astype(np.int32))
        share.append(scaled(w, s).astype(np.float32))
        at += piece.hi - piece.lo
    rows, where, share = (np.concatenate(x) for x in (rows, where, share))
    each = np.array([totals.get(int(g), 0) / max(1, int((grade == g).sum())) for g in grades])[level]
    each = each / each.mean()
    base, gaps = np.zeros(1), np.zeros(max(0, k - 1))
    seen, seen_t = np.full(1 << BITS, 1e-8), np.full(k, 1e-8)
    for _ in range(EPOCHS):
        x = np.bincount(rows, weight[where] * share, len(grade))
        t = np.concatenate([base, base + np.cumsum(np.exp(gaps))])
        above = np.concatenate([np.ones((len(x), 1)), _sigmoid(x[:, None] - t[None, :]), np.zeros((len(x), 1))], 1)
        low, high = above[np.arange(len(x)), level], above[np.arange(len(x)), level + 1]
        p = np.maximum(low - high, 1e-9)
        dl, dh = low * (1 - low), high * (1 - high)
        dx = each * (dl - dh) / p  # of the log-likelihood
        grad = -np.bincount(where, dx[rows] * share, 1 << BITS) / len(x) + decay * weight
        seen += grad * grad
        weight -= rate * grad / np.sqrt(seen)
        dt = np.zeros(k + 2)
        np.add.at(dt, level, -each * dl / p)
        np.add.at(dt, level + 1, each * dh / p)
        dt = -dt[1 : k + 1] / len(x)
        grad = np.concatenate([[dt.sum()], np.cumsum(dt[::-1])[::-1][1:] * np.exp(gaps)])
        seen_t += grad * grad
        move = rate * grad / np.sqrt(seen_t)
        base, gaps = base - move[:1], gaps - move[1:]
    return Ordinal(weight.astype(np.float32), np.concatenate([base, base + np.cumsum(np.exp(gaps))]), grades)


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """The graded rating of a label: 0 unusable, 1 usable but toxic, 2 usable."""
    return F.when(F.col(quality) <= 0, 0).otherwise(F.when(F.col(toxic) > 0, 1).otherwise(2))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Ordinal:
    """Fit on at most ``per_class`` documents of each grade of labels (doc_id, quality, toxic)."""
    return fit(*labelled_sample(docs, labels, grade_of(), per_class))


def score_quality(docs: DataFrame, model: Ordinal) -> DataFrame:
    """docs, all columns, with expected_grade and tail_probability (of a grade above the lowest).

    Only the text is an input. A null, empty or blank text has no words, which is a feature of its own. With labels of one grade, or none, that
    grade is expected and tail_probability is 1. Repeated rows get equal scores; an empty table stays empty. Columns of docs of these two
    names are replaced.
    """
    own = ["expected_grade", "tail_probability"]
    return _scored(docs.select([c for c in docs.columns if c.lower() not in own]), model, own)


def selected(docs: DataFrame, model: Ordinal, at: float = SELECT_AT) -> DataFrame:
    """The rows of docs, all columns as they are, of a tail probability of ``at`` or more."""
    own = [unused(docs.columns, "expected_grade"), unused(docs.columns, "tail_probability")]
    return _scored(docs, model, own).where(F.col(own[1]) >= at).select(docs.columns)


def _scored(docs: DataFrame, model: Ordinal, own: list[str]) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    names = docs.columns
    at = names.index("text")
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        step = np.diff(m.grades).astype(float)
        for batch in batches:
            x = np.concatenate([scores(m.weight, p) for p in pieces(batch.column(at))] or [np.zeros(0)])
            above = _sigmoid(x[:, None] - m.thresholds[None, :])
            tail = above[:, 0] if len(step) else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.grades[0] + above @ step), pa.array(tail)], [*names, *own])

    return docs.mapInArrow(run, docs.withColumns(dict.fromkeys(own, F.lit(0.0))).schema)
