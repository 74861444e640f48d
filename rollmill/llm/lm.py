"""Language-model scores: a gated recurrent network over a class-factored vocabulary, and counts of all training words.

Words are counted over all training texts (64-bit hashes, see text.py). The most frequent words are predicted by the network in two steps,
class and word in its class. All others share classes by the end of their spelling, in which a word has the
probability (c + 1) / (N + V + 1), c being its count and N, V the class's words and distinct words; unknown words count as one word of
their class. So P is a distribution over known words and one unknown word for each class, and

    log10 P(text) = sum of log10 P(class | state) + log10 P(word | class, state or count), the end included.

Training is truncated back-propagation in numpy over every window of every training text, the state carried from the text's start to its
end. Texts are dealt by the hash of id and text to units of about UNIT_TOKENS tokens, and units to rounds; a unit starts from the round's common
parameters, and the parameters are averaged after each round, weighed by tokens. So the model doesn't depend on how rows lie in partitions.
Scoring carries the state through the whole of each text. Counts of frequent words are broadcast within a fixed bound; all other words
of a text are joined to the table of counts.
"""

from __future__ import annotations

import heapq
import math
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, ship
from rollmill.llm.text import U64, Piece, mix, pieces

HIDDEN = 16
CLASSES, CLASS_WORDS = 32, 64
VOCABULARY = CLASSES * CLASS_WORDS  # the end of a text is word 0
ENDINGS = 32
ALL_CLASSES = CLASSES + ENDINGS
SYMBOLS = VOCABULARY + ENDINGS
#: Words whose counts are broadcast, at most: 18 bytes each.
TABLE_WORDS = 1 << 19
#: Rounds that training texts are dealt to; together they cover all words once.
ROUNDS = 2
#: Tokens of a unit, about. Its texts run side by side in TRAIN_LANES lanes, in windows of TRAIN_WINDOW tokens.
UNIT_TOKENS = 1 << 21
TRAIN_LANES, TRAIN_WINDOW = 128, 32
#: Longer texts come first in a unit, so that no lane runs on alone.
LONG_TEXT = 4096
#: Copies of one row that a unit gets at once.
COPIES = 64
LANES, WINDOW = 512, 32
#: Words that a task holds before it scores them.
HELD_WORDS = 1 << 22
RATE = 0.02
#: Logits within this bound need no shift before they are exponentiated: 64 of the largest or smallest exponentials are float32 numbers.
SAFE_EXPONENT = 60.0
#: Parameters in one row of the exchange that averages them.
CHUNK = 1 << 14
_COUNT_PIECE = 1 << 23
#: Places after its beginning's first one at which a hash is looked for before it is searched.
LOOKS = 16


@dataclass
class Vocabulary:
    """What scoring needs of the counts: the table of frequent words, and sums."""

    words: np.ndarray  # uint64 hashes, ascending
    logs: np.ndarray  # log10(count + 1)
    symbols: np.ndarray  # int16: word of the network's vocabulary, or -1
    total: int  # N, ends included
    distinct: int  # V, the end included
    ends: int
    ending_log: np.ndarray  # log10(N + V + 1) of each ending's words
    start_class: np.ndarray  # log shares of the classes
    start_word: np.ndarray  # log shares of the words in their class

    @cached_property
    def starts(self) -> tuple[int, np.ndarray]:
        """So many low bits of a hash aside: where words of each beginning start, about one word to a beginning."""
        bits = max(1, len(self.words).bit_length())
        return 64 - bits, np.searchsorted(self.words, np.arange(1 << bits, dtype=U64) << U64(64 - bits)).astype(np.int32)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Of each hash its place in the table, or -1."""
        if not len(self.words):
            return np.full(len(words), -1)
        shift, starts = self.starts
        last = len(self.words) - 1
        at = np.minimum(starts[(words >> U64(shift)).astype(np.int64)], last).astype(np.int64)
        left = np.flatnonzero(self.words[at] < words)
        for _ in range(LOOKS):  # hashes are spread evenly: most are found at once
            if not len(left):
                break
            left = left[at[left] < last]
            at[left] += 1
            left = left[self.words[at[left]] < words[left]]
        at[left] = np.minimum(np.searchsorted(self.words, words[left]), last)
        return np.where(self.words[at] == words, at, -1)


def ending(piece: Piece) -> np.ndarray:
    """The class of a word's spelling, by its last two bytes."""
    last = piece.buf[piece.end - 1].astype(U64)
    before = piece.buf[np.maximum(piece.end - 2, 0)].astype(U64) * (piece.end - piece.start > 1)
    upper = lambda x: np.where((x >= 0x41) & (x <= 0x5A), x + U64(32), x)
    return (mix(upper(last) * U64(257) + upper(before)) >> U64(59)).astype(np.int16)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, n): how often each word of docs (text) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0), limit=_COUNT_PIECE):
                words = piece.hashes()
                order = np.argsort(words)  # any occurrence has the word's ending
                words = words[order]
                at = np.flatnonzero(np.diff(words, prepend=~words[:1]))
                yield pa.RecordBatch.from_arrays([pa.array(words[at].view(np.int64)), pa.array(ending(piece)[order[at]].astype(np.int32)), pa.array(np.diff(at, append=len(words)))], ["word", "ending", "n"])

    ship(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word bigint, ending int, n bigint")
    return rows.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """Sums of the counts, and their most frequent words: as many as fit TABLE_WORDS with all words of their frequency.

    counts is best a checkpointed table; what comes to the driver is bounded by TABLE_WORDS rows.
    """
    step = F.floor(F.log2("n") * 64).cast("int")
    found = counts.groupBy("ending", step.alias("step")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()
    by_step: dict[int, int] = {}
    for r in found:
        by_step[r.step] = by_step.get(r.step, 0) + r.v
    low, room = 1 << 30, TABLE_WORDS
    for s in sorted(by_step, reverse=True):
        if by_step[s] > room:
            break
        low, room = s, room - by_step[s]
    top = counts.where(step >= low).select("word", "ending", "n").toArrow()
    words, kind, n = (top.column(k).to_numpy() for k in ("word", "ending", "n"))
    words = words.view(U64)
    order = np.argsort(words)
    words, kind, n = words[order], kind[order], n[order]
    rank = np.lexsort((words, -n))[: VOCABULARY - 1]
    symbols = np.full(len(words), -1, np.int16)
    symbols[rank] = np.arange(1, len(rank) + 1)
    sums = np.zeros((ENDINGS, 2))
    for r in found:
        sums[r.ending] += (r.n, r.v)
    total, distinct = int(sums[:, 0].sum()) + ends, int(sums[:, 1].sum()) + (ends > 0)
    share = np.zeros(VOCABULARY)
    share[0] = ends
    share[1 : len(rank) + 1] = n[rank]
    np.subtract.at(sums[:, 0], kind[rank], n[rank])
    np.subtract.at(sums[:, 1], kind[rank], 1)
    classes = np.concatenate([share.reshape(CLASSES, -1).sum(1), sums[:, 0]]) + 1
    inside = share.reshape(CLASSES, -1) + 0.5
    return Vocabulary(
        words, np.log10(n + 1), symbols, total, distinct, ends, np.log10(sums.sum(1) + 1),
        np.log(classes / classes.sum()).astype(np.float32), np.log(inside / inside.sum(1, keepdims=True)).astype(np.float32).ravel(),
    )


def symbols_of(v: Vocabulary, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its symbol (vocabulary, else its ending's), its place in the table or -1, and its hash."""
    words = piece.hashes()
    at = v.places(words)
    symbol = v.symbols[at] if len(v.words) else np.full(len(words), -1, np.int16)
    return np.where((at >= 0) & (symbol >= 0), symbol, VOCABULARY + ending(piece)).astype(np.int16), at, words


SHAPES = {"gate": (SYMBOLS, 3 * HIDDEN), "step": (HIDDEN, 3 * HIDDEN), "class": (HIDDEN, ALL_CLASSES), "class_0": (ALL_CLASSES,), "word": (VOCABULARY, HIDDEN), "word_0": (VOCABULARY,)}


def start(v: Vocabulary) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(7)
    out = {k: draw.normal(0, 0.3 if k == "gate" else 0.2 if k == "step" else 0.05, s).astype(np.float32) for k, s in SHAPES.items()}
    return out | {"class_0": v.start_class.copy(), "word_0": v.start_word.copy()}


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def shaped(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = math.prod(s)
        out[k] = np.ascontiguousarray(x[at : at + n].reshape(s), np.float32)
        at += n
    return out


def _class_of(symbol: np.ndarray) -> np.ndarray:
    return np.where(symbol < VOCABULARY, symbol // CLASS_WORDS, symbol - VOCABULARY + CLASSES)


def _log_shares(x: np.ndarray, at: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Log of each row's softmax at ``at``, and the sum of the row's exponentials, which take the place of x. No entry is beyond +-``most``."""
    if most > SAFE_EXPONENT:
        x -= x.max(1, keepdims=True)
    own = x[np.arange(len(x)), at]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return own - np.log(total), total


def _outputs(p: dict[str, np.ndarray], state: np.ndarray, target: np.ndarray, grads: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """log P (natural) of each target's class, and word where the network has it; with ``grads`` also the states' gradient of -log P."""
    kind, w = _class_of(target), state.shape[1]
    order = np.argsort(kind, kind="stable")
    kind = kind[order]
    cut = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    n, rows = cut[-1], np.arange(len(target))  # the first n are words of the network
    h = np.ones((len(target), w + 1), state.dtype)  # with a one for the constants
    h[:, :w] = state[order]
    to_class, to_word = np.vstack([p["class"], p["class_0"]]), np.column_stack([p["word"], p["word_0"]])
    most = max(1.0, float(np.abs(state).max(initial=0))) * float(max(np.abs(to_class).sum(0).max(), np.abs(to_word).sum(1).max()))
    x = h @ to_class
    found, total = _log_shares(x, kind, most)
    mine = [(slice(cut[c], cut[c + 1]), slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)) for c in range(CLASSES) if cut[c] < cut[c + 1]]
    e, inside = np.empty((n, CLASS_WORDS), state.dtype), target[order[:n]] % CLASS_WORDS
    for here, own in mine:
        np.matmul(h[here], to_word[own].T, out=e[here])
    more, all_words = _log_shares(e, inside, most)
    found[:n] += more
    out, back = np.empty_like(found), None
    out[order] = found
    if grads is not None:
        # (share - 1 at the target) times the state, the division by the sum being left to the narrower factor
        x[rows, kind] -= total
        e[rows[:n], inside] -= all_words
        total, all_words = 1 / total[:, None], 1 / all_words[:, None]
        g = (h * total).T @ x
        grads["class"] += g[:w]
        grads["class_0"] += g[w]
        sorted_back = (x @ p["class"].T) * total
        h, to_state = h[:n] * all_words, np.empty((n, w), state.dtype)
        for here, own in mine:
            g = e[here].T @ h[here]
            grads["word"][own] += g[:, :w]
            grads["word_0"][own] += g[:, w]
            np.matmul(e[here], p["word"][own], out=to_state[here])
        to_state *= all_words
        sorted_back[:n] += to_state
        back = np.empty_like(sorted_back)
        back[order] = sorted_back
    return out, back


def _states(p: dict[str, np.ndarray], h: np.ndarray, symbol: np.ndarray, first: np.ndarray, gates: bool) -> tuple[np.ndarray, ...]:
    """The states before each step of a window, and after it; with ``gates`` between these also the gates, new states and products of each step, otherwise of the last.

    States are (width, lanes), so that a gate is one run of memory.
    """
    (size, n), w = symbol.shape, h.shape[0]
    kept = size if gates else 1
    prev, zr, news, ys = (np.empty((m, k, n), h.dtype) for m, k in ((size, w), (kept, 2 * w), (kept, w), (kept, 3 * w)))
    x = np.take(p["gate"].T.copy(), symbol.ravel(), axis=1, mode="clip").reshape(3 * w, size, n)
    step = p["step"].T.copy()
    step[: 2 * w] *= -1  # a sigmoid needs its argument negated
    keep, starts = (~first).astype(h.dtype), first.any(1).tolist()
    for t in range(size):
        k = t if gates else 0
        if starts[t]:
            h = h * keep[t]
        prev[t] = h
        y, gate, new = ys[k], zr[k], news[k]
        np.matmul(step, h, out=y)
        np.subtract(y[: 2 * w], x[: 2 * w, t], out=gate)
        np.exp(gate, out=gate)
        gate += 1
        np.reciprocal(gate, out=gate)
        np.multiply(gate[w:], y[2 * w :], out=new)
        new += x[2 * w :, t]
        np.tanh(new, out=new)
        h = h - new
        h *= gate[:w]
        h += new
    return prev, zr, news, ys[:, 2 * w :], h


class Lanes:
    """Texts to score laid end to end in lanes of about equal length, the longest lanes first."""

    def __init__(self, texts: list[np.ndarray], lanes: int):
        sizes = np.array([len(t) for t in texts])
        lanes = max(1, min(lanes, len(texts), int(sizes.sum() // max(1, sizes.max())) * 4))
        heap = [(0, k, []) for k in range(lanes)]
        for i in np.argsort(-sizes, kind="stable").tolist():
            n, k, mine = heap[0]
            mine.append(i)
            heapq.heapreplace(heap, (n + int(sizes[i]), k, mine))
        heap.sort(key=lambda x: (-x[0], x[1]))
        self.size = np.array([h[0] for h in heap])
        self.order = [h[2] for h in heap]
        self.symbol = np.zeros((int(self.size[0]), lanes), np.int16)
        self.first = np.zeros((int(self.size[0]), lanes), bool)
        for k, mine in enumerate(self.order):
            self.symbol[: self.size[k], k] = np.concatenate([texts[i] for i in mine])
            self.first[np.cumsum([0, *(sizes[i] for i in mine[:-1])]), k] = True
        self.sizes = sizes

    def windows(self, length: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, lanes that reach beyond start)."""
        for a in range(0, len(self.symbol), length):
            yield a, min(a + length, len(self.symbol)), int(np.searchsorted(-self.size, -a, "left"))

    def sums(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.sizes))
        for k, mine in enumerate(self.order):
            out[mine] = np.add.reduceat(values[: self.size[k], k].astype(np.float64), np.cumsum([0, *(self.sizes[i] for i in mine[:-1])]))
        return out


def text_scores(p: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Natural log P of each text's classes and network words; texts are symbols, the end included."""
    if not texts:
        return np.zeros(0)
    lanes = Lanes(texts, LANES)
    out = np.zeros(lanes.symbol.shape, np.float32)
    h = np.zeros((HIDDEN, lanes.symbol.shape[1]), np.float32)
    for a, b, n in lanes.windows(WINDOW):
        states, *_, h = _states(p, h[:, :n], lanes.symbol[a:b, :n], lanes.first[a:b, :n], False)
        states = states.transpose(0, 2, 1).reshape(-1, HIDDEN)
        out[a:b, :n] = _outputs(p, states, lanes.symbol[a:b, :n].ravel())[0].reshape(b - a, n)
    return lanes.sums(out)


def window_grads(p: dict[str, np.ndarray], h: np.ndarray, symbol: np.ndarray, first: np.ndarray, live: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the sum of -log P over a window (steps, lanes), the gradient cut at its start, and the states (lanes, width) at its end.

    ``first`` marks a text's first token, before which the state is zero; ``live`` marks tokens, which come before the rest of their lane.
    """
    (size, n), w = symbol.shape, h.shape[1]
    prev, zr, news, ys, h = _states(p, h.T, symbol, first, True)
    grads = {k: np.zeros_like(x) for k, x in p.items()}
    on = live.ravel()
    back = np.zeros((size * n, w), h.dtype)
    back[on] = _outputs(p, prev.transpose(0, 2, 1).reshape(-1, w)[on], symbol.ravel()[on], grads)[1]
    back = np.ascontiguousarray(back.reshape(size, n, w).transpose(0, 2, 1))
    # what doesn't depend on later steps, for the whole window at once
    zs, rs = zr[:, :w], zr[:, w:]
    to_new = (1 - zs) * (1 - news * news)
    to_z = (prev - news) * zs * (1 - zs)
    to_r = ys * rs * (1 - rs)
    # gradients of the new state's own argument, of both gates, and of the product that the reset gate scales
    d, dh = np.empty((size, 4 * w, n), h.dtype), np.zeros((w, n), h.dtype)
    keep, starts, on, dead = (~first).astype(h.dtype), first.any(1).tolist(), live.astype(h.dtype), (~live.all(1)).tolist()
    for t in range(size - 1, -1, -1):
        if dead[t]:
            dh *= on[t]
        own = d[t]
        np.multiply(dh, to_new[t], out=own[:w])
        np.multiply(dh, to_z[t], out=own[w : 2 * w])
        np.multiply(own[:w], to_r[t], out=own[2 * w : 3 * w])
        np.multiply(own[:w], rs[t], out=own[3 * w :])
        dh *= zs[t]
        dh += p["step"] @ own[w:]
        dh += back[t]
        if starts[t]:
            dh *= keep[t]
    grads["step"] += np.matmul(prev, d[:, w:].transpose(0, 2, 1)).sum(0)
    flat_symbol = symbol.ravel()
    order = np.argsort(flat_symbol, kind="stable")
    which = flat_symbol[order]
    at = np.flatnonzero(np.diff(which, prepend=np.int16(-1)))
    sums = np.add.reduceat(d[:, : 3 * w].transpose(0, 2, 1).reshape(-1, 3 * w)[order], at)
    grads["gate"][which[at]] = np.concatenate([sums[:, w:], sums[:, :w]], 1)
    return grads, h.T


class Trainer:
    """Adam over a stream of texts (symbols, the end included) in a fixed number of lanes; a window is trained on when all lanes have one."""

    def __init__(self, p: dict[str, np.ndarray], rate: float = RATE, lanes: int = TRAIN_LANES, window: int = TRAIN_WINDOW):
        self.p, self.rate, self.window, self.turn, self.tokens = {k: x.copy() for k, x in p.items()}, rate, window, 0, 0
        self.one, self.two = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
        self.queues: list[deque[tuple[np.ndarray, int]]] = [deque() for _ in range(lanes)]
        self.pending = np.zeros(lanes, np.int64)
        self.h = np.zeros((lanes, HIDDEN), np.float32)

    def add(self, text: np.ndarray) -> None:
        k = int(self.pending.argmin())
        self.queues[k].append((text, 0))
        self.pending[k] += len(text)
        self.tokens += len(text)
        while self.pending.min() >= self.window:
            self._step()

    def finish(self) -> dict[str, np.ndarray]:
        while self.pending.any():
            self._step()
        return self.p

    def _step(self) -> None:
        lanes = np.flatnonzero(self.pending)
        symbol = np.zeros((self.window, len(lanes)), np.int16)
        first, live = np.zeros(symbol.shape, bool), np.zeros(symbol.shape, bool)
        for column, k in enumerate(lanes.tolist()):
            queue, at = self.queues[k], 0
            while at < self.window and queue:
                text, done = queue[0]
                m = min(self.window - at, len(text) - done)
                symbol[at : at + m, column] = text[done : done + m]
                first[at, column] = done == 0
                at += m
                if done + m == len(text):
                    queue.popleft()
                else:
                    queue[0] = (text, done + m)
            live[:at, column] = True
            self.pending[k] -= at
        grads, self.h[lanes] = window_grads(self.p, self.h[lanes], symbol, first, live)
        self.turn += 1
        scale, size = self.rate / (1 + self.turn / 400), float(live.sum()) ** 0.5
        slow, fast = 1 - 0.9**self.turn, (1 - 0.99**self.turn) ** 0.5
        for k, g in grads.items():
            one, two = self.one[k], self.two[k]
            g *= 0.1 / size
            one *= 0.9
            one += g
            g *= g  # 0.1 * 0.1, the share of a square in its mean
            two *= 0.99
            two += g
            root = np.sqrt(two, out=g)
            root += 1e-6 * fast
            np.divide(one, root, out=root)
            root *= scale * fast / slow
            self.p[k] -= root


def coded_texts(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """(key, long, symbols) for each row of docs (doc_id, text), COPIES or fewer equal rows in one, with their number ``times``."""
    sent = docs.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        for batch in batches:
            rows = []
            for piece in pieces(batch.column(1)):
                symbol = symbols_of(v, piece)[0]
                rows += [np.append(symbol[a:b], np.int16(0)).tobytes() for a, b in zip(piece.first[:-1].tolist(), piece.first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["key", "symbols"])

    text = F.col("text").cast("string")
    coded = docs.select(F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("key"), text.alias("text")).mapInArrow(run, "key bigint, symbols binary")
    coded = coded.groupBy("key").agg(F.first("symbols").alias("symbols"), F.count("*").alias("n"))
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES)))
    coded = coded.select("key", "symbols", "n", part.alias("part"))
    return coded.select(
        F.when(F.col("part") > 0, F.xxhash64("key", "part")).otherwise(F.col("key")).alias("key"), (F.octet_length("symbols") > 2 * LONG_TEXT).alias("long"),
        F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES).cast("int").alias("times"), "symbols",
    )


def train(docs: DataFrame, v: Vocabulary, rounds: int = ROUNDS, unit_tokens: int = UNIT_TOKENS) -> dict[str, np.ndarray]:
    """The network after all texts of docs (doc_id, text): each unit trains from its round's start, then parameters are averaged."""
    spark = docs.sparkSession
    ship(spark)
    p, size = start(v), len(flat(start(v)))
    units = max(1, -(-v.total // (rounds * unit_tokens)))
    coded = coded_texts(docs, v).withColumn("unit", F.pmod(F.xxhash64("key", F.lit(11)), F.lit(units * rounds)))
    coded = checkpointed(coded)
    for k in range(rounds):
        now = spark.sparkContext.broadcast(flat(p))

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            start_, done, tokens, unit, trainer = shaped(now.value), np.zeros(size), 0, None, None
            for batch in batches:
                for u, times, symbols in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                    if u != unit:
                        if trainer is not None:
                            done, tokens = done + flat(trainer.finish()) * float(trainer.tokens), tokens + trainer.tokens
                        unit, trainer = u, Trainer(start_)
                    for _ in range(times):
                        trainer.add(np.frombuffer(symbols, np.int16))
            if trainer is not None:
                done, tokens = done + flat(trainer.finish()) * float(trainer.tokens), tokens + trainer.tokens
                x = (done / tokens).astype(np.float32)
                at = range(0, size, CHUNK)
                columns = [pa.array(range(len(at)), pa.int32()), pa.array([unit % 64] * len(at), pa.int32()), pa.array([float(tokens)] * len(at)), pa.array([x[a : a + CHUNK].tobytes() for a in at], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, _PART)

        def mean(keys: tuple, blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weight = 0.0, 0.0
            for block in blocks:
                for w, x in zip(block.column("w").to_pylist(), block.column("x").to_pylist(), strict=True):
                    total, weight = total + np.frombuffer(x, np.float32).astype(float) * w, weight + w
            columns = [pa.array([keys[0].as_py()], pa.int32()), pa.array([0], pa.int32()), pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, _PART)

        schema = "chunk int, part int, w double, x binary"
        mine = coded.where(F.col("unit") % rounds == k).repartition(min(units, 4096), "unit").sortWithinPartitions("unit", F.col("long").desc(), "key")
        parts = mine.select("unit", "times", "symbols").mapInArrow(run, schema)
        rows = parts.groupBy("chunk", "part").applyInArrow(mean, schema).groupBy("chunk").applyInArrow(mean, schema).select("chunk", "x").toArrow()
        if rows.num_rows:
            found = dict(zip(*(rows.column(c).to_pylist() for c in range(2)), strict=True))
            p = shaped(np.concatenate([np.frombuffer(found[c], np.float32) for c in range(len(found))]))
    return p


_PART = ["chunk", "part", "w", "x"]


def score_texts(docs: DataFrame, held_out: Column, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs (doc_id, text).

    Learns from the rows where held_out is false (a null is false). Words are split at ASCII white space, A-Z taken as a-z; each text has one more token,
    its end. A null or empty text has the end alone. base_score is the add-one unigram's log10 probability of the tokens,
    all unknown words counting as one. Repeated rows are learned from and scored each for itself. With nothing to learn from, no word is known and
    train_tokens is 0. Other columns aren't read.
    """
    spark = docs.sparkSession
    ship(spark)
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    learn = own.where(~F.col("held_out"))
    counts = checkpointed(word_counts(learn))
    v = vocabulary(counts, learn.count())
    p = train(learn, v, rounds)
    sent, model = spark.sparkContext.broadcast(v), spark.sparkContext.broadcast(flat(p))
    ln10 = math.log(10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, p = sent.value, shaped(model.value)
        held: list[tuple[pa.RecordBatch, list, list, list]] = []
        texts: list[np.ndarray] = []
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            scores, at = text_scores(p, texts) / ln10, 0
            for batch, ints, reals, rest in held:
                size = batch.num_rows
                ints, reals = (np.concatenate(x, 1) if x else np.zeros((2, 0)) for x in (ints, reals))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(ints[0].astype(np.int64)), pa.array(ints[1].astype(np.int64)), pa.array(reals[0]), pa.array(reals[1] + scores[at : at + size]), *(pa.array(x, pa.list_(pa.int64())) for x in zip(*rest, strict=True))],
                    _SCORED,
                )
                at += size

        for batch in batches:
            if not batch.num_rows:
                continue
            ints, reals, rest = [], [], []
            for piece in pieces(batch.column(2)):
                symbol, at, words = symbols_of(v, piece)
                tail = symbol >= VOCABULARY
                logs = np.where(at >= 0, v.logs[at], 0.0) if len(v.logs) else np.zeros(len(at))
                inside = np.where(tail, logs - v.ending_log[np.maximum(symbol - VOCABULARY, 0)], 0.0)
                sums = [np.diff(np.insert(np.cumsum(x, dtype=float), 0, 0.0)[piece.first]) for x in (at >= 0, logs, inside)]
                end = math.log10(v.ends + 1)
                ints.append(np.stack([piece.count + 1, np.rint(sums[0]).astype(np.int64) + (v.ends > 0)]))
                reals.append(np.stack([sums[1] + end, sums[2]]))
                for a, b in zip(piece.first[:-1].tolist(), piece.first[1:].tolist(), strict=True):
                    texts.append(np.append(symbol[a:b], np.int16(0)))
                    rest.append([x.astype(np.int64) if x.dtype != U64 else x.view(np.int64) for x in np.unique(words[a:b][at[a:b] < 0], return_counts=True)])
                n += len(words) + piece.hi - piece.lo
            held.append((batch, ints, reals, rest))
            if n >= HELD_WORDS:
                yield from out()
                held, texts, n = [], [], 0
        if held:
            yield from out()

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, own double, words array<bigint>, times array<bigint>"
    scored = checkpointed(own.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    rare = rare.join(counts.select("word", "n"), "word").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    every = math.log10(v.total + v.distinct + 1)
    logs, known = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(v.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * every).alias("base_score"), (F.col("own") + logs).alias("score"),
    )


_SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "base", "own", "words", "times"]
