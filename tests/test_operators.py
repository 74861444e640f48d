import hashlib
import itertools
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollmill.functions import ids
from rollmill.operators import gate, hygiene, parsing, rollouts, sampling
from rollmill.sources import adapters, config, pools, readers, sinks
from rollmill.streaming.incremental import process_available


def test_stable_id_keeps_nulls(spark):
    got = spark.sql("select cast(null as string) a, 3 b").select(ids.stable_id(F.col("a"), F.col("b"))).first()[0]
    assert got == hashlib.sha256(b"None\x1f3").hexdigest()


def test_allocation():
    assert sampling.allocate(10, [1, 1, 1]) == [4, 3, 3]
    assert sampling.allocate(7, [0.5, 0.35, 0.15]) == [4, 2, 1]
    assert sampling.allocate(0, [1]) == [0]
    for bad in ([-1, 2], [0, 0]):
        with pytest.raises(ValueError):
            sampling.allocate(3, bad)


@given(st.integers(0, 500), st.lists(st.integers(0, 9), min_size=1, max_size=6).filter(any))
def test_allocation_sums_and_bounds(total, weights):
    got = sampling.allocate(total, weights)
    assert sum(got) == total
    assert all(abs(g - total * w / sum(weights)) < 1 for g, w in zip(got, weights, strict=True))


def test_bottom_k_uses_window_group_limit(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("sample_id"), (F.col("id") % 3).alias("band"))
    out = sampling.bottom_k(rows, "band", 5, 7)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    want = {b: sorted((hashlib.sha256(f"5\x1f{i}".encode()).hexdigest()[:16], str(i)) for i in range(1000) if i % 3 == b)[:7] for b in range(3)}
    got = {b: sorted((r.rank_key, r.sample_id) for r in out.collect() if r.band == b) for b in range(3)}
    assert got == want


def test_mixture_is_sequential(spark):
    rows = spark.createDataFrame([(f"{pool}{k}", f"Prompt  {k}", pool, "b") for pool in "xy" for k in range(6)], "sample_id string, user_prompt string, pool string, difficulty_band string")
    pool = lambda name, weight, **more: (adapters.PoolSource(name, weight, {"b": 1.0}, **more), rows.where(F.col("pool") == name))
    got = adapters.mixture([pool("x", 1), pool("y", 1, oversample=2)], 6, 1).collect()
    assert len({r.user_prompt for r in got}) == len(got) == 6
    assert [r.rank_key for r in got] == sorted(r.rank_key for r in got)
    ranks = sorted((hashlib.sha256(f"1\x1fx{k}".encode()).hexdigest()[:16], k) for k in range(6))
    assert {r.sample_id for r in got if r.pool == "x"} == {f"x{k}" for _, k in ranks[:3]}
    with pytest.raises(ValueError, match="eligible"):
        adapters.mixture([pool("x", 1)], 7, 1)
    with pytest.raises(ValueError, match="new prompts"):
        adapters.mixture([pool("x", 1), pool("y", 1)], 10, 1)
    with pytest.raises(ValueError):
        adapters.mixture([], 1, 1)


def test_pool_filters(spark):
    rows = spark.createDataFrame([("a", "b", None), ("b", "b", "s"), ("c", "z", "s"), ("d", None, "t")], "sample_id string, difficulty_band string, subset string")
    wanted = lambda **more: {r.sample_id for r in adapters.eligible(rows, adapters.PoolSource("p", **more)).collect()}
    assert wanted(bands={"b": 1}) == {"a", "b"}
    assert wanted(bands={"b": 1, "None": 1}, subsets=["None", "t"]) == {"a", "d"}
    assert wanted(bands={"b": 1}, domains=["x"]) == set()


def test_adapters(spark, tmp_path):
    with pytest.raises(ValueError, match="parquet, pool"):
        adapters.create_adapter("other")
    with pytest.raises(ValueError):
        adapters.register_adapter("pool", adapters.PoolAdapter)
    folder = f"file://{tmp_path}/t"
    spark.createDataFrame([("p2", '{"z":1}'), ("p1", None)], "user_prompt string, about string").write.parquet(folder)
    got = adapters.create_adapter("parquet", path=folder, provenance_field="about").prepare(spark, 5, 3, "sys").collect()
    assert [r.user_prompt for r in got] == ["p1", "p2"]
    assert got[0].sample_id == hashlib.sha256(f"parquet\x1f{folder}\x1f3\x1f0\x1fp1".encode()).hexdigest()
    assert json.loads(got[1].provenance_json) == {"z": 1, "adapter": "parquet", "input_path": folder}
    assert got[0].source == "parquet:t" and got[0].system_prompt == "sys" and list(got[0].asDict()) == adapters.SEED_COLUMNS


def test_first_wins_and_resume(spark):
    rows = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3)], "k string, o int")
    assert sorted(map(tuple, sampling.first_wins(rows, "k", F.col("o")).collect())) == [("x", 1), ("y", 3)]
    want = rollouts.fan_out(spark.createDataFrame([("p",), ("q",)], "sample_id string"), 4, 9)
    done = want.where("candidate_index < 2")
    left = rollouts.remaining(want, done)
    assert left.count() == 4
    assert rollouts.completeness(want, done).first().asDict() == {"expected": 8, "completed": 4, "missing": 4, "unexpected": 0}


CASES = [
    ("<reasoning>a</reasoning><response>b</response>", "a", "b", True),
    ("<reasoning a</reasoning><response>b</response>", "a", "b", True),
    ("<reasoning>a</think><response>b", "a", "b", False),
    ("<reasoning>a</reasoning><response>b", "a</reasoning>", "b", False),
    ("<reasoning>a</reasoning>", "a", None, False),
    ('{"reasoning":"a","response":"b"}', "a", "b", True),
    ("<think>a", "a", None, False),
    ("<think>a</think>b", "a", "b", True),
    ("a</think>b", "a", "b", True),
    ("plain", None, "plain", False),
    ("", None, None, False),
    (None, None, None, False),
    ("  \n", None, "", False),
]


def test_split_reasoning(spark):
    rows = spark.createDataFrame([(k, c[0]) for k, c in enumerate(CASES)], "k int, raw_generation string")
    got = {r.k: (r.reasoning, r.response, r.reasoning_parsed) for r in parsing.split_reasoning(rows).collect()}
    assert got == {k: c[1:] for k, c in enumerate(CASES)}


def test_verdict_table(spark):
    space = list(itertools.product(["passed", "failed", "indeterminate", "error", "unavailable"], ["correct", "incorrect", "reference_conflict", "indeterminate", None], ["high", "medium", "low"]))

    def want(det, verdict, confidence):
        if verdict is None:
            return "indeterminate"
        if det == "passed":
            return "verified" if verdict == "correct" else "conflict"
        if verdict == "incorrect":
            return "incorrect" if confidence == "high" else "indeterminate"
        if verdict == "reference_conflict":
            return "conflict"
        if det == "failed":
            return "conflict" if verdict == "correct" else "indeterminate"
        return "supported" if verdict == "correct" and confidence == "high" else "indeterminate"

    rows = spark.createDataFrame(space, "s string, v string, c string")
    for r in rows.select("*", gate.correctness_verdict(F.col("s"), F.col("v"), F.col("c")).alias("got")).collect():
        assert r.got == want(r.s, r.v, r.c), r


def block(n, tag):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_repeated_span():
    assert hygiene.repeated_span(block(127, "w")) is None
    a, b, c = block(64, "a"), block(64, "b"), block(128, "c")
    twice = hygiene.repeated_span(f"{a} {a}")
    assert (twice[1], round(twice[2], 3), twice[3]) == (64, 0.5, 2)
    thrice = hygiene.repeated_span(f"{a} {a} {a}")
    assert (thrice[1], round(thrice[2], 3), thrice[3]) == (64, 0.667, 3)
    long = hygiene.repeated_span(f"{c} {c}")
    assert (long[1], round(long[2], 3), long[3]) == (128, 0.5, 2)
    assert hygiene.repeated_span(f"{a} {b}") is None
    text = f"{a.replace(' ', chr(10) + ' ')} {b} {a.upper()}"
    assert hygiene.repeated_span(text)[0] == text[: text.index(" b0")]  # as it stands in the text


def naive_span(words):
    """The rule itself, window by window."""
    folded, best, sites = [w.casefold() for w in words], None, {}
    if len(words) < 128:
        return None
    for at in range(len(words) - 63):
        own = sites.setdefault(tuple(folded[at : at + 64]), [])
        if not own or at - own[-1] >= 64:
            own.append(at)
            if len(own) > 1:
                n = max(n for n in range(64, min(256, len(words) - at, at - own[0]) + 1) if folded[own[0] : own[0] + n] == folded[at : at + n])
                covers = max(n, (len(own) - 1) * 64) / len(words)
                if best is None or covers > best[2]:
                    best = (" ".join(words[own[0] : own[0] + n]), n, covers, len(own))
                if covers >= 0.1 and (n >= 128 or len(own) >= 3):
                    return best
    return best


def test_repeated_span_against_the_rule():
    rng = random.Random(3)
    for k in range(60):
        parts = [block(rng.randrange(20, 150), c) for c in "xyz"] + ["A a " * rng.randrange(10, 90)]
        words = " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))).split() + [f"u{j}" for j in range(rng.choice([0, 40, 3000]))]
        assert hygiene.repeated_span(" ".join(words)) == naive_span(words), k


def test_repeated_numbers(spark):
    text = " ".join(["3.1234567891", "x", "3.1234567899"] * 2 + ["7.0000000001"])
    got = spark.createDataFrame([(text,), ("none",)], "t string").select(hygiene.repeated_numbers(F.col("t")).alias("n")).collect()
    assert [(s["count"], s["value"]) for s in got[0].n] == [(4, "3.123456789")]
    assert got[1].n == []


def test_boxed_values(spark):
    rows = [(r"\boxed{1} \boxed{2}", "2"), (r"\fbox{a} \boxed{b}", "a"), (r"\boxed{}", None), (r"\boxed{a", None), (r"\boxed{\frac{1}{2}}", r"\frac{1}{2}"), (r"\boxed{\boxed{3}}", "3"), (r"\boxed{ 1 } \boxed{\}}", r"\}"), (r"} \boxed{a} {", "a"), (None, None)]
    got = spark.createDataFrame(rows, "t string, want string").select("want", pools.boxed_value(F.col("t")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_split_commas():
    from rollmill.operators.answers import split_commas

    assert split_commas(r"(1,2),\ [3,{4,5}], , 6") == ["(1,2)", "[3,{4,5}]", "6"]
    assert split_commas("}a,b") == ["}a,b"] and split_commas("") == []


def test_case_folding_is_unicode_s(spark):
    words = ["Straße", "ŉ ﬁ ﬀ", "ὈΔΥΣΣΕΎΣ", "ᾳ ᾼ", "Ꭰ ꭰ", "İ", "K", "plain É", None]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", ids.fold_case(F.col("w")).alias("f")).collect()
    assert [r.f for r in got] == [r.w and r.w.casefold() for r in got]


def test_stages_and_publishing(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("candidate_id"))
    folder = f"file://{tmp_path}/stage"
    sinks.write_shards(rows.where("id < 40"), folder)
    assert sinks.run_stage(rows, folder, "candidate_id").count() == 100
    assert sinks.stage_complete(spark, folder) and not sinks.stage_complete(spark, folder, resume=False)
    assert sinks.run_stage(rows, folder, "candidate_id").select("candidate_id").distinct().count() == 100
    again = sinks.run_stage(rows.where("candidate_id < '5'"), folder, "candidate_id", resume=False)
    assert again.count() < 100 and len(list(tmp_path.glob("stage.incomplete.*"))) == 1
    sinks.rotate(spark, folder)
    with pytest.raises(RuntimeError, match="missing"):
        sinks.stage_complete(spark, folder)
    with pytest.raises(RuntimeError):
        sinks.mark_stage(spark, f"file://{tmp_path}/none", 0.0)
    out = f"file://{tmp_path}/pool"
    assert sinks.publish(rows, out, longest=F.max(F.length("candidate_id"))) == {"rows": 100, "longest": 2}
    assert spark.read.parquet(out).count() == 100 and sinks.published_counts(spark, out)["rows"] == 100
    with pytest.raises(FileExistsError):
        sinks.publish(rows, out)
    with pytest.raises(ValueError):
        sinks.publish(rows.limit(0), f"{out}2")
    assert not (tmp_path / "pool2").exists() and len(list(tmp_path.glob("pool2.incomplete.*"))) == 1
    assert sinks.seed_shard_rows(1000, 4, 5) == 50 and sinks.seed_shard_rows(0, 4, 5) == 1 and sinks.seed_shard_rows(10**9, 1, 1) == 100_000
    sinks.write_seeds(rows.withColumnRenamed("candidate_id", "sample_id"), f"file://{tmp_path}/seeds", 100, 2, 5)
    assert len(list((tmp_path / "seeds").glob("part-*"))) >= 10
    sinks.snapshot(spark, f"file://{tmp_path}/run", '{"a": 1}')
    sinks.snapshot(spark, f"file://{tmp_path}/run", '{"a": 1}')
    with pytest.raises(RuntimeError):
        sinks.snapshot(spark, f"file://{tmp_path}/run", '{"a": 2}')


def test_configurations(tmp_path, monkeypatch):
    monkeypatch.setenv("POOLS", "/pools")
    path = tmp_path / "run.json"
    path.write_text(json.dumps({"run_id": "r-1", "output": "out", "adapter": "pool", "params": {"sources": [{"path": "$POOLS/a"}, {"path": "b"}]}}))
    got = config.load_config(str(path))
    assert got.run_dir == f"{tmp_path}/out/r-1" and [s["path"] for s in got.params["sources"]] == ["/pools/a", f"{tmp_path}/b"]
    assert got.fingerprint() != config.RunConfig("r-1", "o", "pool", seed=1).fingerprint()
    for bad in ({"run_id": "a b"}, {"analysis_samples": 5}, {"verifier_threshold": 2}):
        with pytest.raises(ValueError):
            config.RunConfig(**({"run_id": "r", "output": "o", "adapter": "pool"} | bad))
    path.write_text('{"run_id": "r", "output": "o", "adapter": "pool", "more": 1}')
    with pytest.raises(ValueError, match="more"):
        config.load_config(str(path))
    assert [config.duration_seconds(t) for t in ("1-02:03:04", "10:00", "01:00:01")] == [93784, 600, 3601]
    with pytest.raises(ValueError):
        config.duration_seconds("1-00:10")


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"problem": "p", "answer": "1"}, {"problem": "q"}]')
    got = readers.array_rows(spark, f"file://{tmp_path}/a.json", "problem string, answer string").orderBy("source_index").collect()
    assert [(r.problem, r.answer, r.source_index, r.raw_file) for r in got] == [("p", "1", 0, "a.json"), ("q", None, 1, "a.json")]
    folder = tmp_path / "ids"
    spark.range(5).select(F.col("id").cast("string").alias("candidate_id"), F.lit(1).alias("x")).write.parquet(f"file://{folder}")
    (folder / "part-broken.parquet").write_bytes(b"PAR1 no file")
    (folder / ".part-hidden.parquet").write_bytes(b"x")
    assert readers.saved_ids(spark, f"file://{folder}").count() == 5
    files = readers.named_rows(spark, [f"file://{p}" for p in folder.glob("part-0*.parquet")])
    assert all(r.raw_file.endswith(".parquet") for r in files.collect())
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("y", T.LongType()), T.StructField("x", T.StringType())])
    assert readers.available(files, schema).first().asDict() == {"y": None, "x": "1"}


def test_candidate_schema(spark):
    from rollmill.operators import schemas

    rows = spark.createDataFrame([("1", "s")], "candidate_index string, sample_id string")
    assert schemas.as_candidates(rows).schema == schemas.CANDIDATE and len(schemas.CANDIDATE) == 60
    with pytest.raises(ValueError, match="other"):
        schemas.as_candidates(rows.withColumn("other", F.lit(1)))
    assert len(schemas.SFT_COLUMNS) == 20 and set(schemas.SFT_COLUMNS) <= set(schemas.CANDIDATE.names)
    assert "enum" in json.dumps(schemas.quality_schema())
    both = schemas.union_all([rows, rows.select("sample_id").withColumn("z", F.lit(2))])
    assert both.columns == ["candidate_index", "sample_id", "z"] and both.count() == 2


def test_reports_escape_and_check(spark):
    from rollmill.operators import reports, review

    x = F.lit("</script>\u2028&'")
    got = spark.range(1).select(reports.embedded_json(x).alias("j"), reports.html_text(x).alias("h"), reports.shortened(F.lit(" a  bc def "), 6).alias("s")).first()
    assert "<" not in got.j and "\u2028" not in got.j and json.loads(f'"{got.j}"') == "</script>\u2028&'"
    assert got.h == "&lt;/script&gt;\u2028&amp;&#x27;" and got.s == "a b..."
    one, two = (spark.createDataFrame([(k,)], "candidate_id string") for k in "ab")
    assert reports.cohorts(one, two).count() == 2
    with pytest.raises(ValueError):
        reports.cohorts(one, one)
    labels = spark.createDataFrame([(1, "a"), (2, "zz")], "id long, prefix string")
    rows = spark.createDataFrame([("ab",), ("ac",)], "sample_id string")
    assert {(r.id, r.matches) for r in review.by_prefix(labels, rows).collect()} == {(1, 2), (2, 0)}
    with pytest.raises(ValueError, match="1"):
        review.exactly_one(review.by_prefix(labels, rows))
    with pytest.raises(ValueError):
        rollouts.checked(one, two)


def test_stream_processes_each_file_once(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{k}" for k in ("in", "out", "state"))
    for low in (0, 10):
        spark.range(low, low + 10).write.mode("append").parquet(source)
        process_available(spark, "id bigint", source, out, state, lambda df: df.withColumn("twice", F.col("id") * 2))
    assert spark.read.parquet(out).count() == 20


def test_stream_leaves_out_rows_that_come_again(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{k}" for k in ("in", "out", "state"))
    for low in (0, 5):
        spark.range(low, low + 10).unionAll(spark.range(low, low + 2)).coalesce(1).write.mode("append").parquet(source)
        process_available(spark, "id bigint", source, out, state, lambda df: df, key="id")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(15))


def test_literal_answers_and_typed_scores(spark):
    from pyspark.sql import functions as F

    from rollmill.operators import answers

    said = [("-3.5e2 km", "number"), ("No", "boolean"), ("`e`", "choice"), ("a\nb", "text"), ("a\nb\nc", None), ("", None), (None, None), ("x" * 121, None)]
    rows = spark.createDataFrame(said, "said string, kind string")
    assert all(r.kind == r.got for r in rows.select("kind", answers.literal_answer(F.col("said"), F.lit("no_answer"))["answer_type"].alias("got")).collect())
    pairs = [("1/3", "2/6", 1.0), ("1/3", "0.33333333", 0.0), ("{1, 2}", "{2, 1}", 1.0), ("{1, 2}", "{2}", 0.0), ("{(1,2),(3,4)}", "{(3,4),(1,2)}", 1.0), ("1,234", "1234", 1.0), (r"\frac{1}{2}", "0.5", 1.0), ("1/0", "1/0", None), ("x=1", "1", None), ("", "1", None), (None, None, None), ("50%", "0.5", 1.0), ("{1, 1, 2}", "{1, 2, 2}", 0.0)]
    rows = spark.createDataFrame(pairs, "gold string, value string, want double")
    side = lambda c: F.struct(F.when(F.col(c).startswith("{"), "set").otherwise("number").alias("answer_type"), F.col(c).alias("value"), F.lit(None).cast("array<string>").alias("values"), F.lit(None).cast("string").alias("unit"))
    got = rows.select("gold", "want", answers.typed_score(side("gold"), side("value")).alias("got")).collect()
    assert [(r.gold, r.got) for r in got] == [(r.gold, r.want) for r in got]


def test_regroup_counts_what_is_missing_and_orders_texts(spark):
    from rollmill.operators import phases

    keys = spark.createDataFrame([(1,), (2,)], "id long")
    told = spark.createDataFrame([(1, 1, "b"), (1, 0, "z"), (1, 0, "a"), (3, 0, "no request")], "id long, sample_index long, text string")
    out = {r.id: (r.texts, r.missing) for r in phases.regroup(phases.sample_requests(keys, "id", 3), told, "id", "text").collect()}
    assert out == {1: (["a", "b"], 1), 2: ([], 3)}


def test_evidence_has_to_occur_and_repetitions_twice(spark):
    from pyspark.sql import functions as F

    from rollmill.operators import phases

    rows = spark.createDataFrame([
        (["b  c"], "a b c d", None, "no_new_progress", True), (["b c"], "a b c d", None, "repetition", False), (["b c"], "b c b\nc", None, "repetition", True), (["a", "d"], "a b c d", None, "circular_rechecking", True),
        (["r"], "a", "r", "unresolved_branch", True), (["r"], "a", "r", "no_new_progress", False), ([], "a", None, "no_new_progress", False), (None, None, None, "repetition", False),
    ], "e array<string>, a string, b string, c string, want boolean")
    got = rows.select("want", phases.anchored(F.col("e"), F.col("a"), F.col("b"), F.col("c")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
