import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm import components, decontam, fingerprints, licenses, lm, neardup, order, packing, quality, tokens, toxicity, warc
from rollmill.llm.text import mix, pieces, shingle_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, sketch string"


def frame(spark, texts, source=lambda k: f"s{k % 3}"):
    """Documents with a column whose name an operator uses itself."""
    return spark.createDataFrame([(k, t, "en", source(k), len(t or ""), "x") for k, t in enumerate(texts)], DOCS)


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


ODD = [None, "", " \t\n", "one", "One two", "é" * 5, "a" * 70_000, words(random.Random(5), 40_000)]


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        t = words(rng, rng.randrange(5, 120)).split()
        out.append(" ".join(t))
        for _ in range(rng.randrange(3)):
            u = list(t)
            u[rng.randrange(len(u))] = "edit"
            out.append(" ".join(u))
    return [*out, *out[:3], *ODD]


def sets(texts, width):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    return out


def test_shingles_match_python():
    texts = corpus()
    got = [len(s) for p in pieces(__import__("pyarrow").array(texts), limit=3000) for s in shingle_hashes(p.hashes(), p.first, 4)]
    assert got == [len(s) for s in sets(texts, 4)]


def all_pairs(texts, width):
    """(set size, component, kept) of each text, by comparing all pairs."""
    own = sets(texts, width)
    parent = list(range(len(texts)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(own)):
        for j in range(i):
            both = len(own[i] & own[j])
            if own[i] and own[j] and 100 * both >= 80 * (len(own[i]) + len(own[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {k: (len(own[k]), find(k), find(k) == k) for k in range(len(texts))}


def family(rng, n, length, edits):
    """Copies of one text with a few words of it changed: some are near each other, some only to a third one."""
    base = words(rng, length).split()
    out = []
    for _ in range(n):
        t = list(base)
        for k in rng.sample(range(length), rng.randrange(edits + 1)):
            t[k] = f"e{rng.randrange(3)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize(("width", "find"), [(4, neardup.near_duplicates), (5, neardup.near_duplicates), (5, fingerprints.near_groups)])
def test_near_duplicates_against_all_pairs(spark, width, find):
    texts = corpus(width)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in find(frame(spark, texts), width).collect()}
    assert got == all_pairs(texts, width)
    assert find(frame(spark, []), width).count() == 0


@pytest.mark.parametrize("find", [neardup.near_duplicates, fingerprints.near_groups])
def test_hot_groups_over_several_blocks(spark, monkeypatch, find):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(21)
    texts = [*family(rng, 90, 120, 6), *family(rng, 60, 60, 4), *family(rng, 60, 12, 2), *family(rng, 30, 6, 1), "same text of a few words", "Same text of a FEW words"]
    rng.shuffle(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in find(frame(spark, texts), 4).collect()}
    assert got == all_pairs(texts, 4)


def test_small_sets_share_one_of_their_smallest_hashes():
    rng = np.random.default_rng(3)
    for n in range(1, 41):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            drop = rng.integers(0, n // 5 + 1)
            b = np.unique(np.concatenate([rng.choice(a, n - drop, replace=False), rng.integers(0, 1 << 63, drop, np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert len(np.intersect1d(neardup.smallest(a, 80), neardup.smallest(b, 80)))
    assert not len(neardup.smallest(np.arange(41, dtype=np.uint64), 80))


def test_near_duplicates_pick_rows_not_ids(spark):
    import corpus_pipeline

    rng = random.Random(11)
    a, b, c, d, e, f = (words(rng, 60) for _ in range(6))
    rows = [
        (None, a), (None, a + " edit"),  # a group without ids, of different texts
        (None, b),  # alone, without an id
        (7, c), (7, d),  # one id, two texts that nothing links
        (3, e), (9, e + " edit"), (9, f),  # an id that is rejected with one text and kept with the other
        (5, b + " edit two"), (2, d), (2, d),  # ids before nulls; a repeated row
        (None, ""), (None, None), (4, " "),
    ]
    docs = spark.createDataFrame([(k, t, "en", "s", 1, "x") for k, t in rows], DOCS)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert got == Counter([(None, a), (5, b + " edit two"), (7, c), (3, e), (9, f), (2, d), (None, ""), (None, None), (4, " ")])
    seen = Counter((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert seen[None, None, True] == 4 and seen[None, 5, False] == 1 and seen[7, 7, True] == 1 and seen[7, 2, False] == 1


def test_shared_counts_agree():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 60, 30)).astype(np.uint32) for _ in range(12)]
    i, j = np.triu_indices(12, 1)
    want = [len(set(rows[a]) & set(rows[b])) for a, b in zip(i, j, strict=True)]
    assert neardup.shared(rows, i, j, columns=7).tolist() == want
    assert neardup.shared(rows, i[:5], j[:5]).tolist() == want[:5]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (5, 5)], "u bigint, v bigint")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100}
    assert components.components(links.limit(0)).count() == 0


@pytest.mark.parametrize("size", [2, 1000])
def test_order_of_cells(spark, monkeypatch, size):
    monkeypatch.setattr(order, "RANGE_CELLS", size)
    ids = [-(1 << 54), -7, 0, 3, 4095, 4096, 9000, 50_000, 1 << 50]
    cells = spark.createDataFrame([(c, abs(c) % 100 + 1) for c in ids], "cell bigint, weight bigint").repartition(3)
    assert {r.cell: r.before for r in order.running_cells(cells).collect()} == {c: sum(abs(x) % 100 + 1 for x in ids if x < c) for c in ids}
    assert {r.cell: r.above for r in order.next_cells(cells).collect()} == dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    assert order.next_cells(cells.limit(0)).count() == order.running_cells(cells.limit(0)).count() == 0


def test_language_model_base_score_and_gain(spark):
    rng = random.Random(3)
    texts = [" ".join(f"{lang}{rng.randrange(60)}" for _ in range(rng.randrange(3, 60))) for lang in ("a", "b") for _ in range(1500)] + [None, "", "Unknown wOrds A1"]
    rng.shuffle(texts)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    got = {r.doc_id: r for r in lm.score_texts(frame(spark, texts), held).collect()}
    out = [zlib.crc32(str(k).encode()) % 7 == 2 for k in range(len(texts))]
    own = [[*(t or "").encode().lower().split(), None] for t in texts]
    counts = Counter(w for k, t in enumerate(own) if not out[k] for w in t)
    n, v = sum(counts.values()), len(counts)
    for k, t in enumerate(own):
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[k], len(t), sum(counts[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    unseen = [got[k] for k in range(len(texts)) if out[k]]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert lm.score_texts(frame(spark, []), held).count() == 0


def test_language_model_gradient():
    draw = np.random.default_rng(2)
    p = {k: draw.normal(0, 0.3, s) for k, s in lm.SHAPES.items()}
    state, target = draw.normal(0, 1, (9, lm.HIDDEN)), draw.integers(0, lm.SYMBOLS, 9).astype(np.int16)
    grads = {k: np.zeros_like(x) for k, x in p.items()}
    _, back = lm._outputs(p, state, target, grads)
    near = state.copy()
    near[4, 3] += 1e-5
    slope = -(lm._outputs(p, near, target)[0].sum() - lm._outputs(p, state, target)[0].sum()) / 1e-5
    assert back[4, 3] == pytest.approx(slope, rel=1e-3)


def test_token_counts_are_the_library_s(spark, monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "▁", "\n", "\t", "é", "<s>", "　", "😀", " " * 17]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(400)] + corpus()
    got = {r.doc_id: r for r in tokens.token_counts(frame(spark, texts), MODEL, 30, tables=True).collect()}
    for k, t in enumerate(texts):
        n = len(library.encode(t or ""))
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((t or "").encode()), n, n > 30)
        assert len(library.encode((t or "")[: got[k].fit_chars])) <= 30
        assert len(got[k].prefix_tokens) == len(t or "") + 1 and got[k].prefix_tokens[-1] == n
        if got[k].over_limit:
            assert min(got[k].prefix_tokens[got[k].fit_chars + 1 :]) > 30 >= got[k].prefix_tokens[got[k].fit_chars]
    known = tokens.counts(MODEL)
    spaceless = ["日本語の文章" * 40, "x" * 200, "".join(corpus()[0].split())[:300] + "é" * 20]
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "encode", None)  # the table needs no library
    tables = [tokens.PrefixTable(t, known) for t in [*texts[:200], *spaceless]]
    every = [t.every().tolist() for t in tables]
    fits = [[t.fit(k) for k in range(0, 60, 7)] for t in tables]
    monkeypatch.undo()
    for t, table, own, fit in zip([*texts[:200], *spaceless], tables, every, fits, strict=True):
        want = [len(library.encode(t[:k])) for k in range(len(t) + 1)]
        assert own == [table.count(k) for k in range(len(t) + 1)] == want
        assert fit == [max(k for k in range(len(t) + 1) if want[k] <= budget) for budget in range(0, 60, 7)]


def test_pieces_stay_side_by_side_as_merging_says():
    own, rng = tokens.counts(MODEL).pieces, random.Random(4)
    short = [p for p in own.names if len(p) <= 3]
    for k in range(6000):
        a, b = (rng.choice(own.names if k % 2 else short) for _ in range(2))
        assert own.stays(own.number[a], own.number[b]) == (own.merged(a + b) == [a, b]), (a, b)
    for a in short[:400]:
        assert own.stays(own.number[a], own.number[a]) == (own.merged(a + a) == [a, a]), a


def test_chunks_share_the_work_of_their_beginnings(monkeypatch):
    """Each distinct prefix of a group is worked out once, whatever zeros a text has, and the chunks of the present group outlast trimming."""
    import sentencepiece

    library, own, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), tokens.counts(MODEL).pieces, random.Random(9)
    asked, plain = [], own.all_stay
    monkeypatch.setattr(own, "all_stay", lambda keys: asked.append(len(keys)) or plain(keys))
    own.prefix_counts([" international"])
    alone = sum(asked)
    asked.clear()
    own.prefix_counts(sorted([" international"] * 3 + [" international"[:n] for n in range(2, 14)]))
    assert sum(asked) == alone > 0
    chunks = ["".join(rng.choice("abe\0é日😀") for _ in range(rng.randrange(1, 9))) for _ in range(600)]
    chunks += ["a", "a\0", "a\0b", "a\0\0", "b", "b\0\0a", "\0", "e" * 40]
    for some in (sorted(set(chunks)), chunks):
        found, size = own.prefix_counts(some)
        assert size == list(map(len, some))
        for x, row, n in zip(some, found.tolist(), size, strict=True):
            assert row[:n] == own.long_counts(x).tolist(), x
    texts = ["a\0", "a", "a\0b a\0", "b\0\0a \0", "x " * 30, None]
    got = tokens.Counts(MODEL)
    for t in texts:
        assert tokens.PrefixTable(t or "", got).n_tokens == len(library.encode(t or "")), t
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 3)
    before = set(got)
    got.trim({" x", " a", " new"})
    assert len(before) > 3 and set(got) == before & {" x", " a"}
    monkeypatch.setattr(tokens, "GROUP_CHARS", 5)
    assert list(tokens.groups(pa.array(["abc", "de", "f", None, "long text", ""]))) == [["abc", "de"], ["f", ""], ["long text"], [""]]


def test_packing_fills_and_respects_conflicts(spark):
    texts = corpus(2, 80)
    rows = packing.pack(frame(spark, texts, lambda k: None if k % 4 else "hot"), 300, 2, 1000).collect()
    need = {k: len((t or "").encode().split()) for k, t in enumerate(texts)}
    total, bins = Counter(), {}
    for r in rows:
        total[r.doc_id] += r.n_tokens
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    assert {k: total[k] for k in need} == need
    for own in bins.values():
        assert sum(r.n_tokens for r in own) == own[0].bin_tokens <= 300
        keys = [" ".join((texts[r.doc_id] or "").lower().split()) for r in own]
        assert len(own) == 1 or len(set(keys)) == len(keys)
        assert len(own) == 1 or max(Counter(r.source for r in own).values()) <= 2


def test_packing_of_repeated_and_nameless_rows(spark):
    long = words(random.Random(3), 1000)
    rows = [(1, long, "a"), (1, long, "a"), (None, long, None), (None, None, None), (None, "one two", "a"), (1, "one two", "a"), (1, "ONE two", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({k: F.lit("x") for k in ("row", "piece", "cluster", "n", "shard")})
    got = packing.pack(docs, 300, 4).collect()
    bins = {}
    for r in got:
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    assert all(sum(r.n_tokens for r in own) == own[0].bin_tokens <= 300 for own in bins.values())
    assert sum(r.n_tokens for r in got) == 3006 and sum(r.n_tokens for r in got if r.bin_id is None) == 0
    assert sum(len(own) == 1 and own[0].n_tokens == 300 for own in bins.values()) == 9
    assert sum(r.n_tokens == 2 for own in bins.values() for r in own) == 3
    assert all(sum(r.n_tokens == 2 for r in own) <= 1 for own in bins.values())  # copies but for case
    assert packing.pack(docs.limit(0)).count() == 0


def naive_best_fit(lengths, sources, clusters, capacity, per_source):
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        fits = [(capacity - sum(x[0] for x in own), k) for k, own in enumerate(bins) if sum(x[0] for x in own) + n <= capacity and (c is None or all(x[2] != c for x in own)) and sum(x[1] == s for x in own) < per_source]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        bins[k].append((n, s, c))
        out.append(k)
    return out


def test_best_fit_against_a_naive_packer():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randrange(1, 40)
        lengths = sorted((rng.randrange(1, 30) for _ in range(n)), reverse=True)
        sources, clusters = [rng.choice("abc") for _ in range(n)], [rng.choice([None, "x", "y", "z"]) for _ in range(n)]
        per = rng.randrange(1, 4)
        assert packing.best_fit(lengths, sources, clusters, 30, per) == naive_best_fit(lengths, sources, clusters, 30, per)


def test_best_fit_takes_the_tightest_compatible_bin():
    # lengths fall; the third fits bin 0 exactly but shares its cluster
    assert packing.best_fit([7, 6, 3, 1], ["a", "b", "c", "d"], ["x", None, "x", None], 10, 1) == [0, 1, 1, 1]
    assert packing.best_fit([5, 4, 4], ["a", "a", "b"], [None] * 3, 10, 1) == [0, 1, 0]


def labelled(spark, n=400):
    rng = random.Random(9)
    texts, rows = [], []
    for k in range(n):
        t = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 80))]
        toxic, junk = k % 5 == 0, k % 7 == 0
        for _ in range(3 if toxic else 0):
            t[rng.randrange(len(t))] = rng.choice(["vileword", "slurstem" + rng.choice("abcdefgh")])
        texts.append(" ".join(w.upper() + "!!" if junk else w for w in t))
        rows.append((k, 0 if junk else 1, int(toxic)))
    return [*texts, *ODD], spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_toxicity(spark):
    texts, labels = labelled(spark)
    docs = frame(spark, texts)
    field = toxicity.train(docs, labels.where("doc_id % 4 <> 1"))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, field, spans=True).collect()}
    assert len(got) == len(texts)
    wrong = sum((got[k].toxic_score >= 0.3) != (k % 5 == 0) for k in range(400))
    assert wrong <= 8
    for k in range(0, 400, 5):
        for s in got[k].toxic_spans:
            assert texts[k].encode()[s["begin"] : s["end"]].lower().startswith((b"vile", b"slur", b"w"))
        assert got[k].toxic_spans
    assert all(0 <= r.toxic_score <= 1 for r in got.values())
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.score_toxicity(docs, none).where("toxic_score >= 0.3").count() == 0


@pytest.mark.parametrize("span", [1, 2, 3, 64])
def test_marginals_sum_over_all_taggings(span):
    rng = np.random.default_rng(0)
    sizes, step = [7, 1, 4, 0, 2], rng.normal(0, 1, (2, 2))
    first = np.append(0, np.cumsum(sizes))
    score = rng.normal(0, 1, first[-1])
    start, end, text = toxicity.blocks(first, span)
    live = np.arange(span)[None, :] < (end - start)[:, None]
    flat = np.minimum(start[:, None] + np.arange(span)[None, :], len(score) - 1)
    p, steps = toxicity.marginals(score[flat] * live, end - start, step, text)
    want_steps, got = np.zeros((2, 2)), np.zeros(len(score))
    got[flat[live]] = p[live]
    for a, n in zip(first[:-1].tolist(), sizes, strict=True):
        total, hit, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            tags = [code >> k & 1 for k in range(n)]
            w = math.exp(sum(score[a + k] * (tags[k] - 0.5) for k in range(n)) + sum(step[x, y] for x, y in zip(tags, tags[1:])))
            total += w
            hit += np.array(tags) * w
            for x, y in zip(tags, tags[1:]):
                moves[x, y] += w
        assert got[a : a + n] == pytest.approx(hit / total)
        want_steps += moves / total
    assert steps == pytest.approx(want_steps)
    assert not p[~live].any()


def test_spans_and_document_scores(spark):
    """A span goes on across the edge of a block; the score is the logistic function of the marginals' features."""
    texts, labels = labelled(spark)
    field = toxicity.train(frame(spark, texts), labels)
    tail = " ".join(f"w{k % 300}" for k in range(toxicity.SPAN - 1))
    long = f"{tail} vileword vileword ".encode()
    rows = [long.decode() + tail, None, "", "vileword"]
    docs = frame(spark, rows).withColumns({"toxic_score": F.lit("mine"), "TOXIC_SPANS": F.lit("mine")})
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, field, spans=True).collect()}
    assert [tuple(s) for s in got[0].toxic_spans] == [(len(tail) + 1, len(tail) + 18)]
    assert got[1].toxic_spans == got[2].toxic_spans == [] and got[1].toxic_score == got[2].toxic_score
    assert [tuple(s) for s in got[3].toxic_spans] == [(0, 8)]
    piece = next(pieces(pa.array(rows), toxicity.NOT_ALNUM))
    p = toxicity.word_marginals(field, piece)
    for k in range(4):
        own = p[piece.first[k] : piece.first[k + 1]]
        top = min(max(own.max(initial=0), 1e-6), 1 - 1e-6)
        x = [math.log(sum(-math.log1p(-min(v, 1 - 1e-9)) for v in own) + 1e-6), math.log(top / (1 - top)), 1]
        assert got[k].toxic_score == pytest.approx(1 / (1 + math.exp(-float(np.dot(x, field.calibration)))))
    left = toxicity.without_toxic(docs, field)
    assert left.columns == docs.columns and {r.doc_id: r.toxic_score for r in left.collect()} == {1: "mine", 2: "mine"}


def test_sample_is_bounded_in_bytes(spark):
    from rollmill.llm.labelled import labelled_sample

    docs = frame(spark, ["x" * 100] * 50 + [None] * 3)
    labels = spark.createDataFrame([(k, k % 2) for k in range(53)] + [(1, 1), (None, 1), (2, None)], "doc_id bigint, toxic int")
    sample, totals = labelled_sample(docs, labels, F.col("toxic"), 4000, 1000)
    assert totals == {0: 27, 1: 26}
    for g in (0, 1):
        own = [t for t, x in zip(sample.column("text").to_pylist(), sample.column("grade").to_pylist(), strict=True) if x == g]
        assert 10 <= len(own) and sum(len(t or "") for t in own) == 1000
    assert labelled_sample(docs, labels, F.col("toxic"), 4000, 10)[0].num_rows >= 2


def test_quality(spark):
    texts, labels = labelled(spark)
    docs = frame(spark, texts)
    model = quality.train(docs, labels.where("doc_id % 4 <> 1"))
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 2
    got = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert len(got) == len(texts)
    assert sum((got[k].tail_probability < 0.5) != (k % 7 == 0) for k in range(400)) <= 4
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in got.values())
    assert quality.score_quality(docs, quality.train(docs, labels.limit(0))).where("tail_probability = 1").count() == len(texts)


def naive_log_p(p, texts):
    """Natural log P of each text, one token after the other."""
    sigmoid, w, out = lambda x: 1 / (1 + np.exp(-x)), lm.HIDDEN, []
    for text in texts:
        h, total = np.zeros(w), 0.0
        for s in text.tolist():
            kind = s // lm.CLASS_WORDS if s < lm.VOCABULARY else s - lm.VOCABULARY + lm.CLASSES
            x = h @ p["class"] + p["class_0"]
            total += x[kind] - np.log(np.exp(x).sum())
            if s < lm.VOCABULARY:
                own = slice(kind * lm.CLASS_WORDS, (kind + 1) * lm.CLASS_WORDS)
                x = p["word"][own] @ h + p["word_0"][own]
                total += x[s - kind * lm.CLASS_WORDS] - np.log(np.exp(x).sum())
            a, b = p["gate"][s], h @ p["step"]
            z, r = sigmoid(a[:w] + b[:w]), sigmoid(a[w : 2 * w] + b[w : 2 * w])
            new = np.tanh(a[2 * w :] + r * b[2 * w :])
            h = (1 - z) * new + z * h
        out.append(total)
    return np.array(out)


def network(seed=3):
    draw = np.random.default_rng(seed)
    return {k: draw.normal(0, 0.3, s) for k, s in lm.SHAPES.items()}, draw


def test_language_model_against_a_naive_pass():
    p, draw = network()
    texts = [np.append(draw.integers(0, lm.SYMBOLS, n), 0).astype(np.int16) for n in (0, 1, 5, 31, 32, 33, 90, 3)]
    assert lm.text_scores({k: x.astype(np.float32) for k, x in p.items()}, texts) == pytest.approx(naive_log_p(p, texts), rel=1e-4)


def test_recurrent_gradient():
    p, draw = network(5)
    sizes = (3, 4, 2)  # two texts in the first lane, one and a dead step in the second
    texts = [draw.integers(0, lm.SYMBOLS, n).astype(np.int16) for n in sizes]
    symbol = np.zeros((7, 2), np.int16)
    symbol[:, 0], symbol[:2, 1] = np.concatenate(texts[:2]), texts[2]
    first, live = np.zeros((7, 2), bool), np.ones((7, 2), bool)
    first[0], first[3, 0], live[2:, 1] = True, True, False
    grads, _ = lm.window_grads(p, np.zeros((2, lm.HIDDEN)), symbol, first, live)
    for name in lm.SHAPES:
        hot = np.argsort(-np.abs(grads[name]).ravel())[[0, 1, 7]]
        for at in hot.tolist():
            sides = []
            for step in (1e-5, -1e-5):
                near = {k: x.copy() for k, x in p.items()}
                near[name].ravel()[at] += step
                sides.append(-naive_log_p(near, texts).sum())
            assert grads[name].ravel()[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-3, abs=1e-7), name


def test_training_streams_every_token_once(monkeypatch):
    p, draw = network(6)
    texts = [np.append(draw.integers(1, lm.SYMBOLS, n), 0).astype(np.int16) for n in draw.integers(0, 90, 60).tolist()]
    plain, seen, starts = lm.window_grads, [], []

    def spy(p, h, symbol, first, live):
        seen.append(symbol[live])
        starts.append(first.sum())
        return plain(p, h, symbol, first, live)

    monkeypatch.setattr(lm, "window_grads", spy)
    trainer = lm.Trainer({k: x.astype(np.float32) for k, x in p.items()}, lanes=4, window=8)
    for t in texts:
        trainer.add(t)
    trainer.finish()
    assert Counter(np.concatenate(seen).tolist()) == Counter(np.concatenate(texts).tolist())
    assert sum(starts) == len(texts) and trainer.tokens == sum(map(len, texts))


@pytest.mark.parametrize("scale", [1, 40])
def test_outputs_are_few_operations(scale):
    """Each exponential once, in one array for the classes and one for all words: a call for each class took most of the time. Large logits are shifted first."""
    p, draw = network(8)
    p = {k: (x * scale).astype(np.float32) for k, x in p.items()}
    state, target = np.tanh(draw.normal(0, 1, (900, lm.HIDDEN))).astype(np.float32), draw.integers(0, lm.SYMBOLS, 900).astype(np.int16)
    calls, plain = [], np.exp
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(np, "exp", lambda x, **k: calls.append(x.shape) or plain(x, **k))
        out, back = lm._outputs(p, state, target, {k: np.zeros_like(x) for k, x in p.items()})
    assert calls == [(900, lm.ALL_CLASSES), ((target < lm.VOCABULARY).sum(), lm.CLASS_WORDS)]
    exact = {k: x.astype(float) for k, x in p.items()}
    want, slope = lm._outputs(exact, state.astype(float), target, {k: np.zeros_like(x) for k, x in exact.items()})
    assert out == pytest.approx(want, rel=1e-4, abs=1e-3) and back == pytest.approx(slope, rel=1e-3, abs=1e-3 * scale) and np.isfinite(out).all()
    for k in range(40):
        kind = lm._class_of(target)[k]
        x = exact["class"].T @ state[k] + exact["class_0"]
        total = x[kind] - x.max() - np.log(np.exp(x - x.max()).sum())
        if target[k] < lm.VOCABULARY:
            own = slice(kind * lm.CLASS_WORDS, (kind + 1) * lm.CLASS_WORDS)
            x = exact["word"][own] @ state[k] + exact["word_0"][own]
            total += x[target[k] % lm.CLASS_WORDS] - x.max() - np.log(np.exp(x - x.max()).sum())
        assert out[k] == pytest.approx(total, rel=1e-4, abs=1e-3)


def test_places_of_words():
    draw = np.random.default_rng(4)
    for words in (draw.integers(0, 1 << 64, 3000, np.uint64), draw.integers(0, 3000, 900, np.uint64), np.array([0, (1 << 64) - 1], np.uint64), np.array([7], np.uint64), np.zeros(0, np.uint64)):
        words = np.unique(words)
        v = lm.Vocabulary(words, *[None] * 8)
        asked = np.concatenate([draw.permutation(words), draw.integers(0, 4000, 500, np.uint64), draw.integers(0, 1 << 64, 500, np.uint64)])
        where = {int(x): k for k, x in enumerate(words)}
        assert v.places(asked).tolist() == [where.get(int(x), -1) for x in asked]


def test_scores_do_not_depend_on_partitions(spark):
    texts = corpus(12, 60)
    held = F.col("doc_id") % 5 == 2
    docs = frame(spark, [*texts, *["same row"] * 3]).withColumn("doc_id", F.when(~F.col("text").isin("same row"), F.col("doc_id")))
    got = [sorted((r.doc_id or -1, r.n_known, r.score) for r in lm.score_texts(docs.repartition(n), held).collect()) for n in (2, 8)]
    assert [x[:2] for x in got[0]] == [x[:2] for x in got[1]]
    assert [x[2] for x in got[0]] == pytest.approx([x[2] for x in got[1]], rel=1e-5)


def brute_minhash(text):
    """The permutations one by one, in integers."""
    found = [int(x) for p in pieces(pa.array([text])) for s in shingle_hashes(p.hashes(), p.first, 5) for x in s]
    m = (1 << 64) - 1
    low = [min((int(a) * x + int(b)) & m for x in found) if found else None for a, b in zip(fingerprints._FACTOR, fingerprints._TERM, strict=True)]
    return [0 if x is None else int(mix(np.array([x], np.uint64))[0] >> np.uint64(48)) for x in low]


def test_fingerprints_and_edits(spark):
    texts = [t for t in corpus(6, 12) if len(t or '') < 5000]
    got = {r.doc_id: r for r in fingerprints.with_edits(frame(spark, texts).withColumn("doc_id", F.col("doc_id") * 100)).collect()}
    for k, t in enumerate(texts):
        t, after = t or "", texts[k - 1 if k else len(texts) - 1] or ""
        r, cut = got[100 * k], len(t) // 3
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()
        assert r.fingerprint == fingerprints.signatures([t])[0].tobytes().hex()
        one, edit, follows = (brute_minhash(x) for x in (t, t[: len(t) - cut] + after[:cut], after))
        assert r.fingerprint == "".join(x.to_bytes(2, "little").hex() for x in one)
        for likeness, other in ((r.near_edited, edit), (r.near_next, follows)):
            same = sum(x == y for x, y in zip(one, other, strict=True)) / len(one)
            assert likeness == pytest.approx(max(0, (same - 2**-16) / (1 - 2**-16)))
    a, b = sets(["a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o q"], 5)
    x, y = fingerprints.signatures(["a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o q"])
    assert fingerprints.likeness(x, y) == pytest.approx(len(a & b) / len(a | b), abs=0.15)


def test_licenses(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [(1, "a/LICENSE", mit), (2, "a/b/c/x.txt", "plain words only"), (3, "a/b/LICENSE", apache), (4, "a/d/y.txt", "text\n" + apache + "\nmore text"), (5, "z/q.txt", None), (6, None, ""), (7, "a/b/e.txt", "one")]
    got = {r.doc_id: (r.license, r.origin) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, path string, text string")).collect()}
    assert got == {1: ("MIT", "own"), 2: ("Apache-2.0", "inherited"), 3: ("Apache-2.0", "own"), 4: ("Apache-2.0", "own"), 5: (None, "none"), 6: (None, "none"), 7: ("Apache-2.0", "inherited")}


PROBES = {
    "Apache-2.0": "                 Apache License\n           Version 2.0, January 2004\n        http://www.apache.org/licenses/",
    "GPL-3.0": "      GNU GENERAL PUBLIC LICENSE\n       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>",
    "BSD-2-Clause": "Copyright (c) 2001 Nobody. All rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "MIT": "# SPDX-License-Identifier: MIT\nimport os",
    "ISC": "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "one line " * 40 + "under the GNU Lesser General Public\nLicense, version 3 " + "and on " * 40,
    "Proprietary": "words\nAll rights reserved.\nmore words",
    None: "the license of a word",
}


def naive_licenses(texts):
    """Every run, line, paragraph and text against every template, with dictionaries."""
    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").lower().encode())
    frequency = Counter(w for t in texts for w in set(split(t)))
    vector = lambda ws: {w: k * (math.log((1 + len(texts)) / (1 + frequency[w])) + 1) for w, k in Counter(ws).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = []
    for t in texts:
        words, best = split(t), (None, 0.0)
        units = [split(u) for u in [*(t or "").split("\n"), *re.split(r"\n[ \t\r]*\n", t or ""), t or ""]]
        for name, template, least in licenses.template_rows():
            m, size = vector(template), len(template)
            for u in [*units, *(words[i : i + size] for i in range(len(words) - size + 1))]:
                v = vector(u)
                cosine = round(min(1.0, sum(x * m.get(w, 0) for w, x in v.items()) / norm(v) / norm(m)), 9) if u else 0.0
                if cosine >= least and cosine > best[1] and not (name == "Proprietary" and best[0] not in (None, name)):
                    best = (name, cosine)
        out.append(best)
    return out


def test_licenses_against_all_units(spark):
    rng = random.Random(3)
    texts = [*PROBES.values(), None, "", "   ", "one two\n\n \nthree", "x " * 50 + "Released under the MIT" + "\nLicense and more " * 3]
    for _, words, _ in licenses.template_rows()[::4]:
        w = [rng.choice(["foo", "the", words[0].decode()]) if rng.random() < 0.12 else x.decode() for x in words]
        texts.append("".join(rng.choice(["of ", "the ", "word "]) for _ in range(rng.randrange(12))) + rng.choice(["\n", " ", "\n\n"]) + "".join(x + rng.choice([" ", " ", "\n"]) for x in w) + "tail")
    texts += texts[:3]
    rows = [(k, t, "extra") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, license string").withColumn("path", F.lit(None).cast("string"))
    got = {r.doc_id: (r.license, r.cosine) for r in licenses.scan_licenses(docs.repartition(3)).collect()}
    for k, (name, cosine) in enumerate(naive_licenses(texts)):
        assert got[k][0] == name and got[k][1] == pytest.approx(cosine, abs=1e-6), texts[k]
    assert [got[k][0] for k in range(len(PROBES))] == list(PROBES)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    long = "<p>" + "x" * 200
    rows = [(5, "http://a/\r\nX: y", long), (2, None, long), (9, "http://b", "short"), (3, "http://c", "short"), (4, "http://d", None), (7, "é", long + "é"), (2000, "u", long)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    sums = []
    for k in ("one", "two"):
        folder = f"file://{tmp_path}/{k}"
        manifest = warc.write_archives(pages.repartition(3), folder, roll=300).collect()
        sums.append(sorted(map(tuple, manifest)))
        (tmp_path / k / ".00000000-0009.left.tmp").write_bytes(b"left over")
    assert sums[0] == sums[1] and len(sums[0]) > 1
    got = {r.page_id: r for r in warc.read_archives(spark, folder, payloads=True).collect()}
    want = {p: (h or "").encode() for p, _, h in rows}
    assert {k: r.payload_digest for k, r in got.items()} == {k: hashlib.sha256(v).hexdigest() for k, v in want.items()}
    assert {k: r.payload_bytes for k, r in got.items()} == {k: len(v) for k, v in want.items()}
    assert {k: r.refers_to for k, r in got.items() if r.record_type == "revisit"} == {5: 2, 2000: 2}
    assert all(bytes(r.payload) == want[k] for k, r in got.items() if r.payload is not None)
    first = sorted((tmp_path / "two").glob("part-*.warc.gz"))[0]
    assert gzip.decompress(first.read_bytes()).startswith(b"WARC/1.1\r\n")
    assert warc.read_archives(spark, folder).count() == len(rows)
    empty = f"file://{tmp_path}/none"
    assert warc.write_archives(pages.limit(0), empty).count() == 0


def test_pages_without_ids_fill_several_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SMALL_SHARD", 500)
    pages = spark.createDataFrame([(None if k % 3 else k, f"u{k}", f"{k} " * 60) for k in range(60)], "page_id bigint, url string, html string")
    manifest = warc.write_archives(pages, f"file://{tmp_path}").collect()
    assert sum(r.records for r in manifest) == 60 and len({r.shard for r in manifest}) > 5 and max(r.records for r in manifest) < 20
    got = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert sorted(r.payload_digest for r in got) == sorted(hashlib.sha256((f"{k} " * 60).encode()).hexdigest() for k in range(60))


def brute_hits(text, items, width):
    grams = {}
    for i, w in items:
        for a in range(max(1, len(w) - width + 1) if w else 0):
            grams.setdefault(tuple(w[a : a + width]), set()).add(i)
    hit, which = set(), set()
    for size in {len(g) for g in grams}:
        for a in range(len(text) - size + 1):
            if found := grams.get(tuple(text[a : a + size])):
                hit |= set(range(a, a + size))
                which |= found
    return hit, which


def test_automaton_against_windows():
    rng = random.Random(4)
    for _ in range(400):
        letters = [bytes([97 + k]) for k in range(rng.choice([1, 2, 3]))]
        width = rng.choice([2, 3, 4])
        items = [(k, [rng.choice(letters) for _ in range(rng.randrange(9))]) for k in range(rng.randrange(6))]
        text = [rng.choice([*letters, b"zz"]) for _ in range(rng.randrange(30))]
        spans, which = decontam.ItemAutomaton(items, width).match(text)
        assert ({x for a, b in spans for x in range(a, b)}, which) == brute_hits(text, items, width)


@pytest.mark.parametrize("block", [10, 100_000])
def test_contamination(spark, block):
    rng = random.Random(8)
    tests = [words(rng, 25), "Short item", None, "", words(rng, 25)]
    texts = [*corpus(3), f"before {tests[0]} after", "a SHORT, item b", f"x {' '.join(tests[4].split()[3:15])} y"]
    items = spark.createDataFrame([(k + 8, t) for k, t in enumerate(tests)], "item_id bigint, text string")
    split = [(k + 8, decontam.words_of(t)) for k, t in enumerate(tests)]
    got = {r.doc_id: r for r in decontam.contamination(frame(spark, texts), items, 10, block).collect()}
    for k, t in enumerate(texts):
        own = decontam.words_of(t)
        hit, which = brute_hits(own, split, 10)
        digest = hashlib.sha256(",".join(sorted(map(str, which))).encode()).hexdigest()
        r = got[k]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(own), len(hit), len(which), digest, bool(hit))
    clean = {r.doc_id: r.text for r in decontam.decontaminate(frame(spark, texts), items, 10, 0.95, block).collect()}
    assert clean[len(texts) - 2] == "a  b"
    assert all(clean[k] == texts[k] for k in clean if not got[k].contaminated)
    assert decontam.contamination(frame(spark, texts), items.limit(0)).where("contaminated").count() == 0
    # items and documents without ids, an item over several blocks, callers' columns of the names in use
    docs = frame(spark, texts).select(F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).alias("doc_id"), "text", *(F.lit("x").alias(k) for k in ("_spans", "_items", "_words", "_cut")))
    nameless = spark.createDataFrame([(None, tests[0]), (None, tests[4]), (3, tests[0]), (3, None)], "item_id bigint, text string")
    split = [("null", decontam.words_of(tests[0])), ("null", decontam.words_of(tests[4])), ("3", decontam.words_of(tests[0]))]
    want = Counter()
    for k, t in enumerate(texts):
        hit, which = brute_hits(decontam.words_of(t), split, 10)
        want[k if k % 2 == 0 else None, len(hit), len(which), hashlib.sha256(",".join(sorted(which)).encode()).hexdigest()] += 1
    for size in (1, 4, 7, 1000):
        assert Counter((r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in decontam.contamination(docs, nameless, 10, size).collect()) == want
    kept = decontam.decontaminate(docs, nameless, 10)
    assert kept.columns == docs.columns and all(r["_cut"] == r["_words"] == "x" for r in kept.collect())


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    texts, labels = labelled(spark)
    texts += [texts[1], "note " + " ".join(f"item{k}" for k in range(12)) + " " + words(random.Random(2), 60)]
    d = f"file://{tmp_path}"
    frame(spark, texts).drop("sketch").write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"item{k}" for k in range(12)))], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert len(texts) - 2 not in kept  # a copy of document 1
    assert "item3" not in kept[len(texts) - 1]
    clean = [k for k in range(400) if k % 5 and k % 7]
    assert sum(k in kept for k in clean) >= len(clean) - 4
    assert not any(k in kept for k in range(0, 400, 35))
    total = sum(len((t or "").encode().split()) for t in kept.values())
    packed = corpus_pipeline.run(spark, d)
    assert packed.agg(F.sum("n_tokens")).first()[0] == total
