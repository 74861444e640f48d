"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The automaton accepts every run of words of every item. A document's words are streamed through it; the state
gives the longest suffix of what was read that occurs in an item. Words that no item has put it back to its start, so
only runs of known words are walked. Windows are all runs of ``width`` words of an item, and each shorter item as a whole.

Items are read in blocks of bounded size, one automaton for each; several blocks are passes over the documents that
carry the spans found so far, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, ship
from rollmill.llm.text import unused

#: Words of an automaton at most; it has up to twice as many states. Larger benchmarks take several.
BLOCK_WORDS = 500_000
#: Automata that are in use at once, at most.
PASSES = 4
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LETTERS).split()


class ItemAutomaton:
    """Suffix automaton of items [(item_id, words)]; items without words are left out."""

    def __init__(self, items: list[tuple[int, list[bytes]]], width: int):
        self.width, self.ids = width, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[int]] = [set()]
        whole: dict[int, list[tuple[int, int]]] = {}
        self.least = width
        for item, words in items:
            if not words:
                continue
            state, path = 0, []
            for w in words:
                state = self._extend(state, self.ids.setdefault(w, len(self.ids)))
                path.append(state)
            # every prefix's state and its suffixes get the item
            for s in path:
                while s > 0 and item not in self.items[s]:
                    self.items[s].add(item)
                    s = self.link[s]
            if len(words) < width:
                self.least = min(self.least, len(words))
                whole.setdefault(len(words), []).append((item, tuple(self.ids[w] for w in words)))
        # shorter items: the state that holds each, and from there to all states of which it is a suffix
        here: dict[int, list[tuple[int, int]]] = {}
        for n, found in whole.items():
            for item, words in found:
                state = 0
                for w in words:
                    state = self.next[state][w]
                here.setdefault(state, []).append((n, item))
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        if here:
            for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                self.short[s] = (*self.short[self.link[s]], *here.get(s, ()))

    def _extend(self, last: int, c: int) -> int:
        follow, link, length = self.next, self.link, self.length
        if c in follow[last]:
            q = follow[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = len(link)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.items.append(set())
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        twin = len(self.link)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.items.append(set(self.items[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged spans [a, b) of words inside occurrences of windows, and the items whose windows occur."""
        get, follow, link, length, width = self.ids.get, self.next, self.link, self.length, self.width
        ids = [get(w, -1) for w in words]
        known = np.fromiter(ids, np.int64, len(ids)) >= 0
        edge = np.flatnonzero(np.diff(known.view(np.int8), prepend=0, append=0))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()

        def hit(a: int, b: int) -> None:
            while spans and spans[-1][1] >= a:
                a = min(a, spans.pop()[0])
            spans.append((a, b))

        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a < self.least:
                continue
            state = n = 0
            for i in range(a, b):
                c = ids[i]
                while state and c not in follow[state]:
                    state = link[state]
                    n = length[state]
                if c in follow[state]:
                    state = follow[state][c]
                    n += 1
                if n >= width:
                    s = state
                    while length[link[s]] >= width:
                        s = link[s]
                    items |= self.items[s]
                    hit(i + 1 - width, i + 1)
                if n >= self.least and self.short[state]:
                    for k, item in self.short[state]:
                        if k <= n:
                            items.add(item)
                            hit(i + 1 - k, i + 1)
        return spans, items


def item_blocks(items: DataFrame, width: int, words: int = BLOCK_WORDS) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items (item_id, text) in blocks of about ``words`` words; only one block is on the driver at a time.

    Of an item of more words each block has a run, and the next begins ``width - 1`` words before its end: no window is lost.
    """
    block, n = [], 0
    for row in items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).toLocalIterator():
        found = words_of(row[1])
        for a in range(0, max(1, len(found) - width + 1), words):
            block.append((row[0], found[a : a + words + width - 1]))
            n += len(block[-1][1])
            if n >= words:
                yield block
                block, n = [], 0
    if block:
        yield block


def _matched(docs: DataFrame, items: DataFrame, width: int, block_words: int) -> DataFrame:
    """docs with three more columns at the end: spans array<bigint> (2k: first word, 2k+1: after the last), items array<bigint>, number of words.

    Documents are streamed through one automaton after the other; with more than PASSES of them what is found so far is checkpointed in between.
    """
    spark = docs.sparkSession
    ship(spark)
    own = [unused(docs.columns, name) for name in ("_spans", "_items", "_words")]
    out = docs.withColumns(dict(zip(own, (F.array().cast("array<bigint>"), F.array().cast("array<bigint>"), F.lit(0).cast("bigint")), strict=True)))
    text_at = out.columns.index("text")

    def passed(automaton: ItemAutomaton):  # noqa: ANN202
        sent = spark.sparkContext.broadcast(automaton)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = sent.value
            for batch in batches:
                columns = batch.columns
                spans, items, n = (columns[k].to_pylist() for k in (-3, -2, -1))
                for i, value in enumerate(columns[text_at]):
                    words = words_of(value.as_py())
                    n[i] = len(words)
                    found, which = find.match(words)
                    if found:
                        both = sorted(found + list(zip(spans[i][::2], spans[i][1::2], strict=True)))
                        merged = both[:1]
                        for a, b in both[1:]:
                            if a <= merged[-1][1]:
                                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
                            else:
                                merged.append((a, b))
                        spans[i] = [x for s in merged for x in s]
                        items[i] = sorted({*items[i], *which}, key=lambda x: (x is None, x or 0))
                many = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([*columns[:-3], pa.array(spans, many), pa.array(items, many), pa.array(n, pa.int64())], batch.schema.names)

        return run

    found, k = False, 0
    for k, block in enumerate(item_blocks(items, width, block_words), 1):
        found = True
        out = out.mapInArrow(passed(ItemAutomaton(block, width)), out.schema)
        if k % PASSES == 0:
            out = checkpointed(out)
    return out if found else out.mapInArrow(passed(ItemAutomaton([], width)), out.schema)


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest) of each row of docs (doc_id, text).

    Words are runs of 0-9, A-Z (as a-z), a-z and all characters beyond ASCII. A word is hit when it lies inside an
    occurrence of a window. A null or empty text, or item, has no words: no hit, items_sha256 that of the empty
    string. Items may share words or be repeated; each with an occurring window counts once for each item_id, and all those without an id
    count as one, named null. Rows without a doc_id, and repeated ones, are treated as others; no items hit nothing. Other columns aren't read.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [["null" if x is None else str(x) for x in r] for r in batch.column(1).to_pylist()]
            sums = [hashlib.sha256(",".join(sorted(r)).encode()).hexdigest() for r in rows]
            spans = [[b - a for a, b in zip(s[::2], s[1::2], strict=True)] for s in batch.column(2).to_pylist()]
            hit = [sum(s) for s in spans]
            cols = [batch.column(0), batch.column(3), pa.array(hit, pa.int64()), pa.array([len(r) for r in rows], pa.int64()), pa.array(sums, pa.string()), pa.array([x > 0 for x in hit], pa.bool_()), pa.array([max(s, default=0) for s in spans], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _matched(own, items, width, block_words).select("doc_id", "_items", "_spans", "_words")  # own has no such names
    return found.mapInArrow(digest, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, longest bigint")


def cut_spans(text: str, spans: list[int]) -> str:
    """``text`` without the given word spans and what stands between their words."""
    raw = text.encode()
    lower = raw.lower()
    at = [m.span() for m in _WORD.finditer(lower)]
    out, done = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]]).decode()


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs, all columns, without what they share with the items.

    Each span of windows (``width`` words or longer, or a whole shorter item) is cut from the text; a document of which spans cover
    the share ``coverage`` or more of the words goes. n_chars, where there is one, is set anew for cut texts. Rows with null, empty
    or clean texts stay as they are; repeated rows are treated alike; the result has the columns of docs, in their order.
    """
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = [], []
            for value, spans, n in zip(batch.column(at), batch.column(len(names)).to_pylist(), batch.column(len(names) + 2).to_pylist(), strict=True):
                text = value.as_py()
                keep.append(not spans or sum(spans[1::2]) - sum(spans[::2]) < coverage * n)
                texts.append(cut_spans(text, spans) if spans and keep[-1] else text)
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(names))]
            cut = pa.array([bool(s) for s in batch.column(len(names)).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([*columns, cut], [*names, mark]).filter(pa.array(keep, pa.bool_()))

    mark = unused(names, "_cut")
    texts = docs.withColumn("text", F.col("text").cast("string"))
    out = _matched(texts, items, width, block_words).mapInArrow(run, texts.withColumn(mark, F.lit(True)).schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(mark), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(names)
