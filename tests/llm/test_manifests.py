"""Quality rules, integer k-means and the Merkle manifest against brute force, with their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rollmill.llm import centroids, fingerprints, manifest, packing, queries, rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, bucket string, cluster string, rank string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows, partitions=3):
    """rows: (doc_id, text, lang, source); further columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "x", "y", "z", "r") for i, t, la, s in rows], SCHEMA).repartition(partitions)


def some_texts(seed=3):
    rng = random.Random(seed)
    out = [None, "", " \t\n", "one", "a b c", "a b c d", "a a a a", "x y z q x y z", "é€𝄞 " * 60, "l\nl\n\nl \n l", "# $ % & | < > *"]
    out += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 200))) for _ in range(40)]
    out += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(40, 300))) for _ in range(40)]
    return [*out, " ".join(f"{rng.randrange(60)}" for _ in range(70_000)), *out[20:30]]


def plain_counts(text):
    text = text or ""
    w = WORD.findall(text)
    runs = Counter(zip(w, w[1:], w[2:]))
    places = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(places) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places), failed)


def grams(text):
    codes = [zlib.crc32(x.encode()) for x in WORD.findall(text or "")]
    return [c % rules.BUCKETS for c in codes] + [(a * rules.PAIR + b) % rules.BUCKETS for a, b in zip(codes, [*codes[1:], 0], strict=False)]


def test_rules_match_brute_force(spark):
    rows = [(k if k % 9 else None, t, "en", "s") for k, t in enumerate(some_texts())]
    own = docs(spark, rows)
    trusted = spark.createDataFrame([(k,) for k in (20, 21, 22, 22, 70, None, 9999)], "doc_id bigint")
    weights = rules.ngram_weights(own, trusted)
    all_, good = Counter(), Counter()
    for i, t, *_ in rows:
        all_.update(grams(t))
        if i in (20, 21, 22, 70):
            good.update(grams(t))
    scale = sum(all_.values()) / sum(good.values())
    want = {b: round(1e6 * math.log((good[b] * scale + rules.PRIOR) / (n + rules.PRIOR))) for b, n in all_.items()}
    have = {r.bucket: r.weight for r in weights.collect()}
    assert have.keys() == want.keys() and max(abs(have[b] - want[b]) for b in have) <= 1
    got = sorted(map(repr, (tuple(r) for r in rules.judged(own, weights, ("doc_id", "n_words", "lang")).collect())))
    exp = []
    for i, t, lang, _ in rows:
        plain, total, n = plain_counts(t), sum(have[b] for b in grams(t)), len(grams(t))
        exp.append((i, lang, *plain, total / (n * 1_000_000) if n else 0.0, not plain[5] and total >= n * round(rules.LEAST_RATIO * 1_000_000)))
    assert got == sorted(map(repr, exp))


def test_rules_edges(spark):
    own = docs(spark, [(1, "a " * 60, "en", "s"), (2, " ".join(f"w{k}" for k in range(60)), "en", "s")])
    none = spark.createDataFrame([], "doc_id bigint")
    flat = rules.ngram_weights(own, none)
    assert flat.where("weight <> 0").count() == 0  # nothing is trusted: the base decides
    assert {r.doc_id: r.kept for r in rules.judged(own, flat).collect()} == {1: False, 2: True}
    assert rules.judged(own.limit(0), flat).count() == 0 and rules.ngram_weights(own.limit(0), none).count() == 0
    assert rules.judged(own, flat.limit(0)).where("log_ratio = 0").count() == 2
    assert {r.doc_id: r.kept for r in rules.judged(own, flat).where("kept").collect()} == {2: True}  # a filter on top changes nothing


def test_rules_run_without_python(spark):
    own = docs(spark, [(1, "a b c", "en", "s")])
    plan = rules.judged(own, rules.ngram_weights(own, own.select("doc_id")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def naive_k_means(vectors, order, k, rounds):
    rows = [[math.floor(1024 * float(x)) for x in v] for v in vectors]
    c = [rows[j] for j in order[:k]]
    def nearest(r):
        return min((sum((a - b) ** 2 for a, b in zip(r, x, strict=True)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        at = [nearest(r)[1] for r in rows]
        c = [[sum(col) // len(col) for col in zip(*[r for r, a in zip(rows, at, strict=True) if a == j], strict=True)] if j in at else c[j] for j in range(len(c))]
    return [nearest(r) for r in rows], c


def seed():
    return F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)


def run_k_means(spark, vectors, k=8, rounds=10, dims=64, kind="float", partitions=4):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], f"vec_id bigint, embedding array<{kind}>, cluster string, lead string").repartition(partitions)
    return centroids.cluster(frame, seed(), k, rounds, dims)


def test_k_means_match_naive(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(5, 64))
    vectors = [(i, [float(np.float32(x)) for x in base[i % 5] * (0.01 if i % 7 else 1) + 0.3 * rng.normal(size=64)]) for i in range(160)]
    vectors += [(1000 + i, vectors[3][1]) for i in range(60)]  # a hot copy: ties between centroids
    bad = [(5000, None), (5001, []), (5002, [1.0] * 63), (5003, [1.0] * 63 + [None]), (5004, [1.0] * 63 + [math.nan]), (5005, [math.inf] + [1.0] * 63)]
    order = sorted(range(len(vectors)), key=lambda j: hashlib.sha256(f"3:{vectors[j][0]}".encode()).hexdigest())
    want, centres = naive_k_means([v for _, v in vectors], order, 8, 10)
    found = run_k_means(spark, vectors + bad)
    got = {r.vec_id: (r.distance, r.cluster) for r in found.vectors.collect()}
    assert found.centres == centres and got == {i: w for (i, _), w in zip(vectors, want, strict=True)}
    sums = {j: sum(d for d, c in want if c == j) for j in range(8)}
    for r in centroids.with_inertia(found).collect():
        assert (r.cluster_inertia, r.inertia) == (sums[r.cluster], sum(sums.values())) and r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()
    again = run_k_means(spark, vectors + bad, partitions=1)
    assert again.centres == centres


def test_k_means_edges(spark):
    assert run_k_means(spark, [(1, None), (2, [1.0])]).vectors.count() == 0
    assert run_k_means(spark, []).vectors.count() == 0
    few = run_k_means(spark, [(1, [0.5, 0.25]), (2, [1.0, 1.0]), (None, [9.0, 9.0])], k=8, rounds=2, dims=2)
    assert len(few.centres) == 3 and {(r.vec_id, r.distance) for r in few.vectors.collect()} == {(1, 0), (2, 0), (None, 0)}
    same = run_k_means(spark, [(i, [1.0, 2.0]) for i in range(20)], k=3, rounds=3, dims=2)
    assert {r.cluster for r in same.vectors.collect()} == {0}  # equal centroids: the smallest number, and those without vectors stay
    huge = [(1, [3e30, 0.0]), (2, [3e30, 1.0]), (3, [-3e30, 0.0]), (4, [2e5, -2e5]), (5, [2e5, -2e5])]
    order = sorted(range(5), key=lambda j: hashlib.sha256(f"3:{huge[j][0]}".encode()).hexdigest())
    want, centres = naive_k_means([v for _, v in huge], order, 2, 4)
    found = run_k_means(spark, huge, k=2, rounds=4, dims=2, kind="double")
    assert found.centres == centres
    assert {r.vec_id: (r.distance, r.cluster) for r in found.vectors.collect()} == {i: (d if d < 1 << 63 else None, c) for (i, _), (d, c) in zip(huge, want, strict=True)}
    assert {r.inertia for r in centroids.with_inertia(found).collect()} == {sum(d for d, _ in want) if sum(d for d, _ in want) < 1 << 63 else None}


def test_k_means_filter_leaves_out_distances():
    """The bounds spare most distances, and never the nearest."""
    rng = np.random.default_rng(2)
    x = centroids.integers(rng.normal(size=(9, 64))[rng.integers(0, 9, 4000)] + 0.2 * rng.normal(size=(4000, 64)))
    f = x.astype(float)
    axes = centroids.Axes(f.mean(0), np.linalg.eigh(np.cov(f.T))[1][:, ::-1])
    c = x[:8]
    best, far, done = centroids.nearest(x, *axes.rotated(f), c, *axes.rotated(c.astype(float)))
    full = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (far == full.min(1)).all() and done < 0.5 * full.size


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def naive_manifest(rows, tampered, altered):
    """doc_id, leaf, subroot, root, proof, folded, verified by climbing one list after another. rows: doc_id, source, lang, n_chars, text."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha(*map(enc, r))

    def climb(nodes):
        """The root, and for each node its (before, after) by level."""
        paths = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            for k, a in enumerate(at):
                run = nodes[a // 8 * 8 : a // 8 * 8 + 8]
                paths[k].append(("".join(run[: a % 8]), "".join(run[a % 8 + 1 :])))
            nodes = [sha(*nodes[a : a + 8]) for a in range(0, len(nodes), 8)]
            at = [a // 8 for a in at]
        return nodes[0], paths

    none_first = lambda v, zero: (v is not None, zero if v is None else v)
    langs = sorted({r[2] for r in rows}, key=lambda v: none_first(v if v is None else v.encode(), b""))
    out, trees = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (none_first(r[0], 0), leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own])))
    root, tops = climb([t[1] for t in trees])
    for (own, sub, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            way = path + top
            h = leaf((*r[:4], altered(r[4]))) if tampered(r[0]) else leaf(r)
            for a, b in way:
                h = sha(a, h, b)
            out.append((r[0], leaf(r), sub, root, sha(*(a + b for a, b in way)), h, h == root))
    return out


def check_manifest(spark, rows, partitions=3):
    own = docs(spark, rows, partitions)
    third = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 0
    lower = lambda t: t and re.sub("[A-Z]", lambda m: m[0].lower(), t)
    want = naive_manifest([(i, s, la, None if t is None else len(t), t) for i, t, la, s in rows], third, lower)
    got = manifest.manifest(own, F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0, F.lit(False)), manifest.lower_ascii(F.col("text")))
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_manifest_matches_naive(spark):
    rng = random.Random(4)
    langs = [None, "", "en", "de", "é", "e", "EN"]
    rows = [(k, rng.choice([None, "", "Abc", "xyz", "ÄÖ Q", "a" * 50]), rng.choice(langs[:6]) if k % 3 else "en", rng.choice([None, "s", ""])) for k in range(700)]
    rows += [(None, "N", "en", None)] * 3 + [(5, "Other", "en", "s")] * 2 + [(9001, "Alone", "EN", "s")]
    check_manifest(spark, rows)
    check_manifest(spark, rows[:80], 1)


def test_manifest_of_few_rows_and_many_groups(spark):
    check_manifest(spark, [(1, "Text", "en", "s")])
    check_manifest(spark, [(k, "Text", f"l{k % 90}", "s") for k in range(95)])
    for n in (2, 8, 9, 64, 65):
        check_manifest(spark, [(k, "T", "en", "s") for k in range(n)])
    got = manifest.manifest(docs(spark, [(1, "a", "en", "s")]).limit(0), F.lit(True), F.col("text"))
    assert got.count() == 0 and got.columns[:3] == ["doc_id", "leaf", "subroot"]


def test_bins_depend_on_rows_alone(spark):
    rng = random.Random(6)
    rows = [(None if k % 10 == 0 else k, " ".join("w" for _ in range(rng.randrange(0, 90))), "en", f"s{k % 5}") for k in range(700)] + [(7, "x y z", "en", "hot")] * 120
    bins = []
    for n in (1, 7):
        out = packing.pack(docs(spark, rows, n), 100, 3, 100).collect()
        assert sum(r.n_tokens for r in out) == sum(len(t.split()) for _, t, *_ in rows)
        bins.append(sorted(repr(tuple(r)) for r in out))
    assert bins[0] == bins[1] and len({r.bin_id.split("-")[0] for r in out if r.bin_id}) >= 5


def test_bins_of_given_sizes_and_clusters(spark):
    rows = [(k, "a b", "en", f"s{k}") for k in range(12)]
    own = docs(spark, rows).select("doc_id", "source", F.lit(10).alias("tokens"), F.when(F.col("doc_id") < 6, 1).alias("component"))
    out = packing.pack(own, 100, 4, 100, "tokens", "component").collect()
    assert {r.n_tokens for r in out} == {10} and len({r.bin_id for r in out}) == 6  # six of one cluster stand apart


def test_smallest_id_is_not_a_missing_one(spark):
    low = -(1 << 63)
    got = fingerprints.with_edits(docs(spark, [(low, "a b", "en", "s"), (None, "c d", "en", "s"), (None, "e f", "en", "s"), (4, "g h", "en", "s")])).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got if r.doc_id is not None) == [(False, low), (False, 4)] and sum(r.doc_id is None for r in got) == 2
    after = {r.doc_id: r.edited_sha256 for r in got if r.doc_id is not None}
    assert after == {4: sha("g " + "a"), low: sha("a " + "e")}  # the row without an id that comes first has the larger text


def test_contract_queries_hold_out_rows_without_ids(spark, tmp_path):
    rng = random.Random(8)
    clean = lambda: " ".join(f"w{rng.randrange(50)}" for _ in range(60))
    rows = [(k, clean() + (" badword" * 5 if k % 4 == 0 else ""), "en", "s") for k in range(80)] + [(None, clean(), "en", "s"), (None, None, None, None)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, k % 2, int(k % 4 == 0)) for k in range(80)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for q in (queries.op5_quality, queries.op6_toxicity):
        got = q(spark, str(tmp_path)).collect()
        assert len(got) == 82 and all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(queries.op11_quality_rules(spark, str(tmp_path)).collect()) == 82
    assert len(queries.op13_manifest(spark, str(tmp_path)).collect()) == 82


def test_quality_scores_match_plain_features():
    """The sum of weights over each word and its looks, text by text."""
    from rollmill.llm import quality
    from rollmill.llm.text import hash_ranges, pieces

    rng = random.Random(9)
    made = [" ".join(rng.choice(["The", "the", "ABC!", "x", "|", "###", "w12", "longwordlongwordlong", "é", "and,", "twice-said"]) for _ in range(rng.randrange(0, 40))) for _ in range(60)] + [None, "", "  "]
    weight = np.random.default_rng(1).normal(size=1 << quality.BITS)
    top = (1 << quality.BITS) - quality.LOOKS

    def word_hash(w: bytes, lower: bool) -> int:
        return int(hash_ranges(np.frombuffer(w + b" ", np.uint8), np.array([0]), np.array([len(w)]), lower)[0])

    def plain(text):
        words = (text or "").encode().split()
        share, folded = Counter(), [w.lower() for w in words]
        for k, w in enumerate(words):
            upper, digit = sum(65 <= c <= 90 for c in w), sum(48 <= c <= 57 for c in w)
            letter = upper + sum(97 <= c <= 122 or c >= 128 for c in w)
            sign = len(w) - letter - digit
            looks = [upper > 1 and upper == letter, digit > 0, sign == 1, sign == 2, sign >= 3, k > 0 and folded[k] == folded[k - 1], folded[k] in folded[:k] and len(w) > 6, len(w) <= 2, len(w) >= 16, letter == 0]
            share[word_hash(w, False) % top] += 1 / len(words)
            for j, on in enumerate(looks):
                share[top + j] += on / len(words)
        share[top + len(looks) if words else top + 10] += not words
        share[top + 11] += len(words) < 8
        return sum(weight[b] * (10 * s if b >= top else math.sqrt(s)) for b, s in share.items())

    import pyarrow as pa

    got = np.concatenate([quality.scores(weight, p) for p in pieces(pa.array(made, pa.string()), limit=500)])
    assert np.allclose(got, [plain(t) for t in made])


def test_quality_fit_is_where_the_likelihood_is_flat():
    """Weights and thresholds of a small fit: no nearby ones have a likelihood that is better by more than the fit's own last steps."""
    import pyarrow as pa

    from rollmill.llm import quality
    from rollmill.llm.text import pieces

    rng = random.Random(3)
    grades = [k % 3 for k in range(90)]
    made = [" ".join(rng.choice(["bad", "word"] if g == 0 else ["fair", "word"] if g == 1 else ["good", "word"]) for _ in range(20)) for g in grades]
    sample, totals = pa.table({"grade": pa.array(grades, pa.int32()), "text": made}), {0: 30, 1: 30, 2: 30}
    model = quality.fit(sample, totals)
    assert (np.diff(model.thresholds) > 0).all()

    def loss(weight, thresholds, decay=2e-4):
        x = np.concatenate([quality.scores(weight, p) for p in pieces(sample.column("text"))])
        above = np.concatenate([np.ones((90, 1)), 1 / (1 + np.exp(-(x[:, None] - thresholds[None]))), np.zeros((90, 1))], 1)
        g = np.array(grades)
        return -np.log(above[np.arange(90), g] - above[np.arange(90), g + 1]).mean() + decay / 2 * (weight**2).sum()

    base = loss(model.weight.astype(float), model.thresholds)
    start = loss(np.zeros(1 << quality.BITS), np.array([-0.7, 0.7]))
    assert base < 0.2 * start
    used = np.flatnonzero(np.abs(model.weight) > 0.05)
    for b in used[:6]:
        for step in (-0.05, 0.05):
            moved = model.weight.astype(float)
            moved[b] += step
            assert loss(moved, model.thresholds) > base - 2e-3
    assert np.argmax([loss(model.weight.astype(float), model.thresholds + s) for s in (-1.0, 0.0, 1.0)]) != 1
