"""Exact token counts of every prefix of a text, by dynamic programming over the pieces of a sentencepiece BPE model.

The tokens of a prefix are those of a shorter prefix and one more piece: the only piece that ends there and that merges would leave
standing beside the last piece of the shorter prefix. So with ``last`` the last piece of each prefix,

    count(prefix) = count(prefix without its last piece) + 1,

and characters that no piece has count as their UTF-8 bytes. Whether two pieces stay side by side is found by merging them by rank, once for
each pair that is met. A text is cut before each run of spaces and around line ends, which no piece crosses; the counts at all
prefixes of a chunk are kept with it, so each distinct chunk is worked out once, many chunks at a time. Truncation and budget questions are
searches in the table: the library only lends its vocabulary.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import ship
from rollmill.llm.text import U64, mix

_SPACES = re.compile(r" +[^ ]*")
_SPACES_AND_LINES = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_INNER = re.compile("[^▁]▁")
#: Chunks up to so many characters are kept, and so many of them at once in each worker.
KEPT_CHARS = 48
KEPT_CHUNKS = 400_000
#: Pairs of pieces of which a worker remembers whether they stay side by side.
KEPT_PAIRS = 1_000_000
#: Characters of texts (one text at least) of which the chunks are counted in one call, and chunks that are worked out side by side.
GROUP_CHARS = 1 << 22
SIDE_BY_SIDE = 1 << 15
#: Chunks up to so many characters, nearly all, are worked out apart from longer ones, which have wider tables.
WORD_CHARS = 20
#: Longer chunks are worked out one after the other.
LONG_CHUNK = 64
_LAST = itemgetter(-1)
_BASE = U64(0x9E3779B97F4A7C15 | 1)


class Pieces:
    """The vocabulary of a model: its pieces, their ranks, and which of them stay side by side."""

    def __init__(self, model: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = library.get_piece_size()
        plain = [k for k in range(size) if not (library.is_control(k) or library.is_unknown(k) or library.is_byte(k) or library.is_unused(k))]
        self.score = {library.id_to_piece(k).replace("▁", " "): library.get_score(k) for k in plain}
        if any(_INNER.search(library.id_to_piece(k)) for k in plain):
            raise ValueError("a piece of this vocabulary crosses a space; prefix counts need one that doesn't")
        if sum(map(library.is_byte, range(size))) != 256:
            raise ValueError("prefix counts need a vocabulary with a piece for each byte")
        # texts are taken as they are, with one space before them
        probe = "ﬁ Å  Ａ　é\t\nx  "
        if library.decode(library.encode(probe)) != probe or len(library.encode("a  b")) == len(library.encode("a b")) or library.encode("ﬁ") == library.encode("fi"):
            raise ValueError("this model normalises its input; prefix counts need one that doesn't")
        self.line = any("\n" in p for p in self.score)
        # pieces are merged in the order of their ranks; characters are there from the start
        self.rank = {p: -1 if len(p) == 1 else k for k, p in enumerate(sorted(self.score, key=lambda p: -self.score[p]))}
        # pieces that merging reaches, by number, and the two pieces that each is made of
        self.names: list[str] = []
        self.made: dict[str, tuple[str, str]] = {}
        for p in self.score:
            parts = self.merged(p, 2)
            if len(parts) <= 2:
                self.names.append(p)
                if len(parts) == 2:
                    self.made[p] = parts[0], parts[1]
        # pieces of one score (runs of spaces), and those made of them, have no order in time
        seen = Counter(self.score.values())
        self.tied: set[str] = set()
        for p in sorted(self.names, key=len):
            if (len(p) > 1 and seen[self.score[p]] > 1) or not self.tied.isdisjoint(self.made.get(p, ())):
                self.tied.add(p)
        self.longest = max(map(len, self.names))
        self.number = {p: k for k, p in enumerate(self.names)}
        self.unknown = len(self.names)
        self.beside: dict[int, bool] = {}
        codes, size = _codes(self.names)
        whole = _sums(codes.T)[size, np.arange(len(size))]
        order = np.argsort(whole)
        self.hashes, self.numbers = whole[order], order.astype(np.int32)
        if len(np.unique(whole)) != len(whole):
            raise ValueError("two pieces have one hash")
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(whole >> U64(44)).astype(np.int64)] = True

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merge by rank until ``least`` pieces are left: the best pair first, of equal ones the leftmost."""
        parts, score = list(text), self.score
        while len(parts) > least:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Whether merging leaves these two pieces as they are."""
        return left == self.unknown or self.all_stay([left * (self.unknown + 1) + right])[0]

    def all_stay(self, keys: list[int]) -> list[bool]:
        """For pairs of a piece and a known one after it, as left * (unknown + 1) + right: ``apart`` for each that is met, once."""
        beside, size = self.beside, self.unknown + 1
        out = list(map(beside.get, keys))
        if None in out:
            for k, key in enumerate(keys):
                if out[k] is None:
                    left, right = divmod(key, size)
                    if left == self.unknown:
                        out[k] = True
                        continue
                    a, b = self.names[left], self.names[right]
                    tied = a in self.tied or b in self.tied
                    out[k] = beside[key] = self.merged(a + b) == [a, b] if tied else self.apart(a, b)
        return out

    def apart(self, left: str, right: str) -> bool:
        """Whether no merge across the border of two pieces comes before the merges that made them.

        For pieces that aren't tied. Goes back in time from merge to merge. A merge across the border of equal rank comes after one of the left piece, before one of the right.
        """
        rank, made = self.rank, self.made
        limit = len(rank) + 1
        while True:
            if rank.get(left + right, limit) < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, made[left][1]
            else:
                limit, right = b + 1, made[right][0]

    def long_counts(self, chunk: str) -> np.ndarray:
        """Tokens of each prefix of one chunk."""
        last, count = [-1] * (len(chunk) + 1), np.zeros(len(chunk) + 1, np.int64)
        number, stays, longest = self.number, self.stays, self.longest
        for i in range(1, len(chunk) + 1):
            for at in range(max(0, i - longest), i):
                piece = number.get(chunk[at:i])
                if piece is not None and (at == 0 or stays(last[at], piece)):
                    last[i], count[i] = piece, count[at] + 1
                    break
            else:
                last[i], count[i] = self.unknown, count[i - 1] + len(chunk[i - 1].encode())
        return count[1:]

    def prefix_counts(self, chunks: list[str]) -> tuple[np.ndarray, list[int]]:
        """Tokens of each prefix of each chunk, a row for each in the chunks' order, which is best sorted.

        Prefixes are worked out side by side, one length after the other; one that the chunk before has too is taken from there.
        """
        codes, size = _codes(chunks)
        n, width = codes.shape
        codes = np.ascontiguousarray(codes.T)
        sums, power = _sums(codes), _powers(self.longest + 1)
        # whether a prefix isn't that of the row before (which may be shorter, and then has zeros here)
        new = np.ones((width, n), bool)
        new[:, 1:] = np.logical_or.accumulate(codes[:, 1:] != codes[:, :-1], axis=0)
        new[:, 1:] |= size[:-1] < np.arange(1, width + 1)[:, None]
        last = np.full((width + 1, n), -1, np.int32)
        count = np.zeros((width + 1, n), np.int32)
        for i in range(1, width + 1):
            there = size >= i
            left = own = np.flatnonzero(new[i - 1] & there)
            for length in range(min(i, self.longest), 0, -1):
                if not len(left):
                    break
                h = sums[i][left] - sums[i - length][left] * power[length]
                some = np.flatnonzero(self.maybe[(h >> U64(44)).astype(np.int64)])
                if not len(some):
                    continue
                at = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
                same = self.hashes[at] == h[some]
                some, piece = some[same], self.numbers[at[same]]
                rows = left[some]
                if length < i and len(rows):
                    key = last[i - length][rows].astype(np.int64) * (self.unknown + 1) + piece
                    distinct, back = np.unique(key, return_inverse=True)
                    ok = np.array(self.all_stay(distinct.tolist()), bool)[back]
                    some, rows, piece = some[ok], rows[ok], piece[ok]
                last[i][rows] = piece
                count[i][rows] = count[i - length][rows] + 1
                rest = np.ones(len(left), bool)
                rest[some] = False
                left = left[rest]
            if len(left):
                c = codes[i - 1][left]
                last[i][left] = self.unknown
                count[i][left] = count[i - 1][left] + 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            if len(own) < n:
                rows = np.flatnonzero(there)
                first = own[np.searchsorted(own, rows, "right") - 1]
                last[i][rows], count[i][rows] = last[i][first], count[i][first]
        return count[1:].T, size.tolist()


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, one row for each, and their lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), int(size.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return out, size


def _sums(codes: np.ndarray) -> np.ndarray:
    """Hash of each prefix, a column for each text of ``codes``; that of a range [a, b) is sums[b] - sums[a] * base ** (b - a)."""
    out = np.zeros((codes.shape[0] + 1, codes.shape[1]), U64)
    for k in range(codes.shape[0]):
        out[k + 1] = out[k] * _BASE + mix(codes[k].astype(U64) + U64(1))
    return out


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Counts(dict):
    """Tokens of every prefix of a chunk: a run of spaces and what follows, a line end, or what follows a line end."""

    def __init__(self, model: str):
        self.pieces = Pieces(model)
        self.cut = _SPACES if self.pieces.line else _SPACES_AND_LINES

    def chunks(self, text: str) -> list[str]:
        # the library puts one space before its input; the mark U+2581 in a text merges as a space does
        return self.cut.findall(" " + text.replace("▁", " ")) if text else []

    def learn(self, chunks: set[str]) -> None:
        """Work out the chunks that aren't known yet."""
        new = sorted(chunks.difference(self))
        sizes = list(map(len, new))
        for least, most in ((1, WORD_CHARS), (WORD_CHARS + 1, LONG_CHUNK)):
            short = [x for x, n in zip(new, sizes, strict=True) if least <= n <= most]
            for a in range(0, len(short), SIDE_BY_SIDE):
                part = short[a : a + SIDE_BY_SIDE]
                found, size = self.pieces.prefix_counts(part)
                # at most four tokens a character: one byte for each prefix of a short chunk
                width, every = found.shape[1], found.astype(np.uint8).tobytes()
                for k, x, n in zip(range(0, len(every), width), part, size, strict=True):
                    self[x] = every[k : k + n] if n < LONG_CHUNK else found[k // width].copy()
        for x, n in zip(new, sizes, strict=True):
            if n > LONG_CHUNK:
                self[x] = self.pieces.long_counts(x)

    def trim(self, chunks: set[str]) -> None:
        """Between groups: when too many chunks or pairs of pieces are known, forget all pairs, and all chunks but those of this group."""
        if len(self) > KEPT_CHUNKS:
            kept = {x: self[x] for x in chunks.intersection(self)}
            self.clear()
            if len(kept) <= KEPT_CHUNKS:
                self.update(kept)
        if len(self.pieces.beside) > KEPT_PAIRS:
            self.pieces.beside.clear()

    def forget(self, chunks: set[str]) -> None:
        for x in chunks:
            if len(x) > KEPT_CHARS:
                self.pop(x, None)

    def __missing__(self, chunk: str) -> bytes | np.ndarray:
        self.learn({chunk})
        return self.pop(chunk) if len(chunk) > KEPT_CHARS else self[chunk]


@lru_cache(maxsize=4)
def counts(model: str) -> Counts:
    return Counts(model)


class PrefixTable:
    """Token counts of all prefixes of one text: running ones at its cuts (``ends``: in characters; ``total``: tokens before there), and each chunk's own."""

    def __init__(self, text: str, known: Counts, parts: list[str] | None = None):
        self.parts = known.chunks(text) if parts is None else parts
        self.own = list(map(known.__getitem__, self.parts))

    @cached_property
    def total(self) -> list[int]:
        return list(accumulate(int(x[-1]) for x in self.own))

    @cached_property
    def ends(self) -> list[int]:
        return [n - 1 for n in accumulate(map(len, self.parts))]

    @property
    def n_tokens(self) -> int:
        return int(sum(map(_LAST, self.own)))

    def count(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters, encoded by themselves."""
        if chars <= 0:
            return 0
        k = bisect_right(self.ends, chars)
        before, at = (self.total[k - 1], self.ends[k - 1]) if k else (0, -1)
        if k == len(self.ends) or chars <= at:
            return before
        return before + int(self.own[k][chars - at - 1])

    def every(self) -> np.ndarray:
        """Tokens of the prefixes of 0, 1, 2, ... characters."""
        if not self.parts:
            return np.zeros(1, np.int64)
        each = [np.frombuffer(x, np.uint8) if isinstance(x, bytes) else x for x in self.own]
        before = [0, *self.total[:-1]]
        out = np.concatenate([x.astype(np.int64) + b for x, b in zip(each, before, strict=True)])
        out[0] = 0  # before the first character there is only the library's space
        return out

    def fit(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens. A longer prefix may have fewer tokens, so the last chunk that can fit is searched from its end."""
        k = min(bisect_right(self.total, budget), len(self.total) - 1)
        while k >= 0:
            before, at = (self.total[k - 1], self.ends[k - 1]) if k else (0, -1)
            own = self.own[k]
            for n in range(len(own), 0, -1):
                if before + int(own[n - 1]) <= budget:
                    return max(at + n, 0)
            k -= 1
        return 0


def groups(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a column (null: empty), GROUP_CHARS in all or one text at a time."""
    out, chars = [], 0
    for x in column:
        text = x.as_py() or ""
        if out and chars + len(text) > GROUP_CHARS:
            yield out
            out, chars = [], 0
        out.append(text)
        chars += len(text)
    if out:
        yield out


def token_counts(docs: DataFrame, model: str, limit: int = 4096, tables: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars); with ``tables`` also prefix_tokens, the counts of the prefixes of 0, 1, 2, ... characters.

    Counts are the library's for the whole text, without begin, end or added special tokens; strings of special
    tokens are ordinary text. fit_chars is the length of the longest prefix, inside words too, of at most ``limit`` tokens. A null text
    counts as an empty one (0 tokens). One row for each input row, repeated ones and those without an id too; an empty table gives none; other columns aren't read.
    """
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint"
    if tables:
        schema += ", prefix_tokens array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts(model)
        for batch in batches:
            sizes, n, fit, every = [], [], [], []
            for texts in groups(batch.column(1)):
                parts = [known.chunks(x) for x in texts]
                seen = set().union(*parts)
                known.trim(seen)
                known.learn(seen)
                for text, own in zip(texts, parts, strict=True):
                    sizes.append(len(text.encode()))
                    table = PrefixTable(text, known, own)
                    n.append(table.n_tokens)
                    fit.append(table.fit(limit) if table.n_tokens > limit else len(text))
                    if tables:
                        every.append(table.every())
                known.forget(seen)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()), pa.array(fit, pa.int64())]
            if tables:
                columns.append(pa.array(every, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "prefix_tokens"][: len(columns)])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
