"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals.

Words are runs of letters and digits in lower case (A-Z); their features are hashes of the word and of its first four to nine bytes,
of which each also tells whether the word goes on. The chain runs over the whole text; blocks of 64 words are worked out side by side, with
the messages that enter them from both sides. The tables label whole documents, so words get their labels
first: in toxic documents those with a feature that toxic documents have and clean ones hardly ever do. Forward-backward
marginals give each word's probability; a document's score is a logistic function of their sum and their largest. All words of the
sample of labelled documents train the field.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import ship
from rollmill.llm.labelled import PER_CLASS, labelled_sample
from rollmill.llm.text import NOT_ALNUM, U64, Piece, hash_ranges, pieces, shingle_hashes, unused

BITS = 18
PREFIXES = (4, 5, 6, 7, 8, 9)
SPAN = 64
EPOCHS = 6
#: Words of a mini-batch, about; it has whole texts.
BATCH_WORDS = 1 << 15
#: Log odds of a word without features that training met, before training.
BIAS = -4.0
#: A feature marks toxic words when this share of the documents that have it is toxic, and so many of them are that
#: one feature of all is expected to be met by chance.
LEAST_DOCS, LEAST_SHARE = 3, 0.9
#: A word of this marginal belongs to an offending span; a document of this score is toxic.
SPAN_AT, PREDICT_AT = 0.5, 0.3


@dataclass
class Field:
    weight: np.ndarray  # of the features, for toxic against clean; 0 for those that training hasn't met
    bias: float  # of every word
    step: np.ndarray  # step[a, b]: from tag a to tag b
    calibration: np.ndarray  # of the document features and their constant


def features(piece: Piece) -> np.ndarray:
    """(words, 1 + len(PREFIXES)) of feature numbers. A word that isn't longer than a prefix has its whole again."""
    whole = hash_ranges(piece.buf, piece.start, piece.end) * U64(0xD1342543DE82EF95)
    out = np.empty((len(whole), 1 + len(PREFIXES)), np.int32)
    out[:, 0] = whole >> U64(64 - BITS)
    for j, k in enumerate(PREFIXES, 1):
        longer = np.flatnonzero(piece.end - piece.start > k)
        start = piece.start[longer]
        cut = (hash_ranges(piece.buf, start, start + k) + U64(j)) * U64(0xA24BAED4963EE407)
        out[:, j] = out[:, 0]
        out[longer, j] = cut >> U64(64 - BITS)
    return out


def blocks(first: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of up to ``span`` words that texts are worked out in, and each run's text."""
    count = np.diff(first)
    runs = -(-count // span)
    text = np.repeat(np.arange(len(count)), runs)
    k = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    start = first[text] + k * span
    return start, np.minimum(start + span, first[text + 1]), text


def marginals(score: np.ndarray, size: np.ndarray, step: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over whole texts in blocks: score (n, span) toxic against clean, size (n) words of each block, text (n) ascending.

    Gives P(toxic) of each word (zero beyond the end) and the expected number of each step, (2, 2).
    """
    n, span = score.shape
    out, steps = np.zeros((n, span)), np.zeros((2, 2))
    if not n:
        return out, steps
    live = np.arange(span)[None, :] < size[:, None]
    emit = np.exp(np.clip(np.stack([-score, score], -1) / 2, -30, 30))
    move = np.exp(step)
    enter, leave = _messages(emit, live, move, text)
    ahead = np.zeros((span, n, 2))
    for t in range(span):
        now = (enter if t == 0 else ahead[t - 1] @ move) * emit[:, t]
        if t:
            now = np.where(live[:, t, None], now, ahead[t - 1])
        ahead[t] = now / now.sum(1, keepdims=True)
    back = leave
    for t in range(span - 1, -1, -1):
        both = ahead[t] * back
        out[:, t] = np.where(live[:, t], both[:, 1] / both.sum(1), 0)
        right = emit[:, t] * back
        if t:
            on = live[:, t]
            pair = ahead[t - 1][:, :, None] * move[None] * right[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            steps += pair[on].sum(0)
            new = right @ move.T
            back = np.where(on[:, None], new / new.sum(1, keepdims=True), back)
    # steps from a block's last word to the next block's first
    after = np.flatnonzero(np.diff(text, prepend=text[0] - 1) == 0)
    pair = ahead[span - 1][after - 1][:, :, None] * move[None] * right[after][:, None, :]
    steps += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
    return out, steps


def _messages(emit: np.ndarray, live: np.ndarray, move: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What enters each block from the words before it, and from those after it (both of sum 1 or all ones)."""
    n, span = live.shape
    enter, leave = np.ones((n, 2)), np.ones((n, 2))
    start = np.flatnonzero(np.diff(text, prepend=text[0] - 1))
    count = np.diff(np.append(start, n))
    start, count = start[count > 1], count[count > 1]
    if not len(start):
        return enter, leave
    # weights from a block's first tag to its last, for blocks of longer texts only
    mine = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    prod = np.zeros((len(mine), 2, 2))
    prod[:, [0, 1], [0, 1]] = emit[mine, 0]
    for t in range(1, span):
        new = prod @ move * emit[mine, t, None, :]
        prod = np.where(live[mine, t, None, None], new / new.sum((1, 2), keepdims=True), prod)
    at = np.cumsum(count) - count
    through = prod @ move
    ahead, behind = np.ones((len(mine), 2)), np.ones((len(mine), 2))
    for k in range(1, int(count.max())):
        to = at[count > k] + k
        new = np.einsum("ni,nij->nj", ahead[to - 1], through[to - 1])
        ahead[to] = new / new.sum(1, keepdims=True)
    total = prod.sum(2)
    last = np.zeros((len(mine), 2))
    for k in range(int(count.max()) - 1, 0, -1):
        to = at[count > k] + k
        ends = (count[count > k] == k + 1)[:, None]
        after = last[np.minimum(to + 1, len(mine) - 1)]
        new = np.where(ends, total[to], np.einsum("nij,nj->ni", through[to], after))
        last[to] = new / new.sum(1, keepdims=True)
        behind[to - 1] = last[to] @ move.T
    enter[mine], leave[mine] = ahead, behind / behind.sum(1, keepdims=True)
    return enter, leave


def padded(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    at = np.minimum(start[:, None] + np.arange(SPAN)[None, :], max(len(values) - 1, 0))
    return values[at] * (np.arange(SPAN)[None, :] < (end - start)[:, None])


def chain(score: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each word of texts that start at ``first`` (with one more entry at the end), and the expected steps."""
    out = np.zeros(len(score))
    if not len(out):
        return out, np.zeros((2, 2))
    start, end, text = blocks(first)
    live = np.arange(SPAN)[None, :] < (end - start)[:, None]
    p, steps = marginals(padded(score, start, end), end - start, step, text)
    out[(start[:, None] + np.arange(SPAN)[None, :])[live]] = p[live]
    return out, steps


def word_marginals(field: Field, piece: Piece) -> np.ndarray:
    """P(toxic) of each word of a piece."""
    if not len(piece.start):
        return np.zeros(0)
    return chain(field.weight[features(piece)].sum(1) + field.bias, piece.first, field.step)[0]


def document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, 3): log of the sum of -log(1 - p), logit of the largest p, 1."""
    whole = np.append(np.cumsum(np.insert(-np.log1p(-np.minimum(p, 1 - 1e-9)), 0, 0.0)), 0.0)
    total = whole[first[1:]] - whole[first[:-1]]
    top = np.zeros(len(first) - 1)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        top[full] = np.maximum.reduceat(p, first[full])
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.stack([np.log(np.maximum(total, 0) + 1e-6), np.log(top / (1 - top)), np.ones(len(top))], 1)


def _distinct(texts: pa.ChunkedArray) -> np.ndarray:
    """Whether a text is the first of its copies and, mostly, near copies: those that share the two smallest shingle hashes."""
    seen: set[tuple[int, ...]] = set()
    out = []
    for piece in pieces(texts):
        for s in shingle_hashes(piece.hashes(), piece.first, 4):
            key = tuple(s[:2].tolist())
            out.append(key not in seen or not key)
            seen.add(key)
    return np.array(out, bool)


def _with_labels(texts: pa.ChunkedArray, labels: np.ndarray) -> Iterator[tuple[Piece, np.ndarray]]:
    """Pieces, each with its texts' labels."""
    at = 0
    for piece in pieces(texts, NOT_ALNUM):
        yield piece, labels[at : at + piece.hi - piece.lo]
        at += piece.hi - piece.lo


def fit(sample: pa.Table, totals: dict[int, int]) -> Field:
    """Train on (grade, text), grade 1 for toxic; totals: labels of each grade, by which sample rows are weighed."""
    toxic = np.array(sample.column("grade").to_pylist(), bool)
    texts, size = sample.column("text"), 1 << BITS
    have = np.zeros((2, size), np.int32)
    new = _distinct(texts)
    # features are made again in each pass: those of one piece are held at a time
    at = 0
    for piece, own in _with_labels(texts, toxic):
        feats = features(piece)
        text = np.repeat(np.arange(piece.hi - piece.lo), piece.count)
        key = np.unique(np.concatenate([text.astype(np.int64) * size + feats[:, k] for k in range(feats.shape[1])]))
        key = key[new[at : at + len(own)][key // size]]
        kind = own[key // size].astype(np.int64)
        at += len(own)
        have += np.bincount(kind * size + key % size, minlength=2 * size).reshape(2, size).astype(np.int32)
    chance = min(max(float(toxic[new].mean()) if new.any() else 0.5, 1e-3), 0.9)
    need = max(LEAST_DOCS, np.log(max(1, int((have.sum(0) >= LEAST_DOCS).sum()))) / -np.log(chance))
    marks = (have[1] >= need) & (have[1] >= LEAST_SHARE * have.sum(0))

    feats_in, tags_in, sizes_in = [np.zeros((0, 1 + len(PREFIXES)), np.int32)], [np.zeros(0, bool)], [np.zeros(0, np.int64)]
    for piece, own in _with_labels(texts, toxic):
        feats_in.append(features(piece))
        tags_in.append(marks[feats_in[-1]].any(1) & np.repeat(own, piece.count))
        sizes_in.append(piece.count)
    weight, bias, step = _train(*(np.concatenate(x) for x in (feats_in, tags_in, sizes_in)))
    field = Field(weight.astype(np.float32), bias, step, np.array([0.0, 0.0, 0.0]))
    rows = [document_features(word_marginals(field, p), p.first) for p in pieces(texts, NOT_ALNUM)]
    x = np.concatenate(rows) if rows else np.zeros((0, 3))
    share = {g: totals.get(g, 0) / max(1, int((toxic == bool(g)).sum())) for g in (0, 1)}
    field.calibration = _logistic(x, toxic, np.where(toxic, share[1], share[0]))
    return field


def _train(ids: np.ndarray, tags: np.ndarray, sizes: np.ndarray, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float, np.ndarray]:
    """Adagrad on the conditional log-likelihood of whole texts (words' features and tags, and the texts' sizes), in mini-batches."""
    size = 1 << BITS
    weight, bias, step = np.zeros(size), BIAS, np.zeros((2, 2))
    seen, seen_bias, seen_step = np.full(size, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    first = np.append(0, np.cumsum(sizes))
    draw = np.random.default_rng(5)
    for _ in range(EPOCHS):
        order = draw.permutation(np.flatnonzero(sizes))
        cut = np.cumsum(sizes[order]) // BATCH_WORDS
        for mine in np.split(order, np.flatnonzero(np.diff(cut)) + 1) if len(order) else []:
            count = sizes[mine]
            own = np.append(0, np.cumsum(count))
            words = np.repeat(first[mine] - own[:-1], count) + np.arange(own[-1])
            feats, tag = ids[words], tags[words]
            p, expected = chain(weight[feats].sum(1) + bias, own, step)
            off = p - tag
            grad = np.bincount(feats.ravel(), np.repeat(off, feats.shape[1]), size)
            met = np.bincount(feats.ravel(), minlength=size) > 0
            grad += decay * weight * met
            seen += grad * grad
            weight -= rate * grad / np.sqrt(seen)
            seen_bias += off.sum() ** 2
            bias -= 0.2 * off.sum() / np.sqrt(seen_bias)
            inner = np.ones(len(tag), bool)
            inner[own[:-1]] = False
            had = np.bincount((tag[:-1] * 2 + tag[1:])[inner[1:]], minlength=4).reshape(2, 2)
            grad = expected - had
            seen_step += grad * grad
            step -= 0.2 * grad / np.sqrt(seen_step)
    return weight, float(bias), step


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 25, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps; with no rows or one class, a constant."""
    out = np.zeros(x.shape[1])
    if not len(x) or y.all() or not y.any():
        out[-1] = -4.0 if not len(x) or not y.any() else 4.0
        return out
    weight = weight / weight.mean()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        out = out + np.linalg.solve(curve, x.T @ (weight * (y - p)) - ridge * out)
    return out


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Field:
    """Fit on at most ``per_class`` toxic and as many clean documents of labels (doc_id, toxic)."""
    return fit(*labelled_sample(docs, labels, (F.col("toxic") > 0).cast("int"), per_class))


def score_toxicity(docs: DataFrame, field: Field, spans: bool = False) -> DataFrame:
    """docs, all columns, with toxic_score (0 to 1), and with ``spans`` toxic_spans array<struct<begin, end>> in UTF-8 bytes.

    Only the text is an input. A null, empty or blank text gets the score of a document without toxic words, and no spans. Repeated
    rows get equal scores; an empty table stays empty. Columns of docs of these two names are replaced.
    """
    own = ["toxic_score", *["toxic_spans"] * spans]
    return _scored(docs.select([c for c in docs.columns if c.lower() not in own]), field, spans, own)


def without_toxic(docs: DataFrame, field: Field, at: float = PREDICT_AT) -> DataFrame:
    """The rows of docs, all columns as they are, that score under ``at``; a null or empty text scores as one without toxic words."""
    name = unused(docs.columns, "toxic_score")
    return _scored(docs, field, False, [name]).where(F.col(name) < at).select(docs.columns)


def _scored(docs: DataFrame, field: Field, spans: bool, own: list[str]) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    names = docs.columns
    at = names.index("text")
    sent = spark.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        for batch in batches:
            scores, found = [], []
            for piece in pieces(batch.column(at), NOT_ALNUM):
                p = word_marginals(field, piece)
                z = document_features(p, piece.first) @ field.calibration
                scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                if spans:
                    found += offending(p, piece)
            columns = [*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(found, kind)] if spans else []), [*names, *own])

    schema = docs.withColumn(own[0], F.lit(0.0))
    if spans:
        schema = schema.withColumn(own[1], F.expr("cast(null as array<struct<begin: bigint, end: bigint>>)"))
    return docs.mapInArrow(run, schema.schema)


def offending(p: np.ndarray, piece: Piece) -> list[list[dict[str, int]]]:
    """For each text of a piece its runs of words of a marginal of SPAN_AT or more, as byte offsets."""
    out = []
    for k in range(piece.hi - piece.lo):
        hot = np.flatnonzero(p[piece.first[k] : piece.first[k + 1]] >= SPAN_AT) + piece.first[k]
        cut = np.flatnonzero(np.diff(hot, prepend=-2) > 1)
        last = np.append(cut[1:], len(hot)) - 1
        out.append([{"begin": int(piece.start[hot[a]] - piece.text_at[k]), "end": int(piece.end[hot[b]] - piece.text_at[k])} for a, b in zip(cut, last, strict=True)] if len(hot) else [])
    return out
