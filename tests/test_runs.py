"""Runs as graphs of phases, builds of pools and seeds, and puzzles as a source: stopped and taken up, refused, counted."""

import json

import pytest
from pyspark.sql import functions as F

from rollmill.operators import graph, puzzles, reports, rescoring, review
from rollmill.sources import builds, sinks
from rollmill.sources.adapters import PoolAdapter, create_adapter
from rollmill.sources.config import RunConfig


class Provider:
    """Answers every request, writes down what it was asked for, and fails at one call."""

    def __init__(self, spark, log, fail_at=None):
        self.spark, self.log, self.fail_at, self.calls = spark, log, fail_at, 0

    def __call__(self, phase, requests):
        self.calls += 1
        keys = [c for c in ("candidate_id", "target", "sample_index", "category") if c in requests.columns]
        asked = [json.dumps([phase, *r]) for r in requests.select(keys).collect()]
        if self.calls == self.fail_at:
            raise RuntimeError("the provider is gone")
        with open(self.log, "a") as f:
            f.writelines(x + "\n" for x in asked)
        text = {
            "extract": '{"status":"extracted","answer_type":"number","value":"7"}', "hygiene": '{"verdict":"clear","evidence":[],"explanation":"fine"}', "critique": "fine",
            "retry_2": '{"correctness":{"verdict":"correct","confidence":"high","feedback":"ok"},"reasoning":{"score":5,"issues":[],"feedback":"f"},"response":{"score":5,"issues":[],"feedback":"f"},"hygiene_confirmations":[]}',
        }.get(phase, "no scores")
        return requests.select(*keys, F.lit(text).alias("text"))


def candidates(spark, n=12):
    rows = [(f"c{k}", f"<think>thought {k}</think>The answer is 7.", "stop", '{"entry":{"answer":7},"type":"reference_answer"}') for k in range(n)]
    return spark.createDataFrame(rows, "candidate_id string, raw_generation string, finish_reason string, verification_json string")


def test_a_stopped_run_goes_on_without_asking_twice(spark, tmp_path):
    folder, log = f"file://{tmp_path}/run", tmp_path / "asked"
    rows, phases = candidates(spark), graph.decision_graph(PoolAdapter([]))
    for fail_at in (2, 4, 3, 5):
        run = graph.Run(spark, folder, Provider(spark, log, fail_at), waves=2)
        with pytest.raises(RuntimeError, match="gone"):
            run.through(rows, phases)
    last = Provider(spark, log)
    run = graph.Run(spark, folder, last, waves=2)
    out = run.gathered(run.through(rows, phases), ["quality_score", "verification_status", "judge_retry_count", "hygiene_raw_outputs_json", "productivity_filtered_eligible"]).collect()
    assert len(out) == 12 and all((r.verification_status, r.judge_retry_count, r.quality_score, r.productivity_filtered_eligible) == ("passed", 2, 5, True) for r in out)
    assert all(set(json.loads(r.hygiene_raw_outputs_json)) == {"repetition", "circular_rechecking", "no_new_progress", "unresolved_branch"} for r in out)
    asked = log.read_text().split("\n")[:-1]
    assert len(asked) == len(set(asked)) == 12 * (2 + 2 + 4 + 1 + 1 + 1)
    quiet = Provider(spark, log)
    graph.Run(spark, folder, quiet, waves=2).through(rows, phases)
    assert quiet.calls == 0  # everything is there


def test_a_phase_that_reads_what_nobody_writes(spark, tmp_path):
    run = graph.Run(spark, f"file://{tmp_path}/run", lambda phase, requests: requests)
    with pytest.raises(ValueError, match="judge_raw_output"):
        run.through(candidates(spark, 1), graph.decision_graph(PoolAdapter([]))[6:])


def test_findings_by_category(spark):
    """Missing, failed and repeated answers: a list in the order of the categories, and a map."""
    finding = "struct<category: string, verdict: string>"
    rows = spark.createDataFrame(
        [("a", "no_new_progress", ("no_new_progress", "clear"), "t2", None), ("a", "repetition", ("repetition", "defect"), "z", None), ("a", "repetition", ("repetition", "clear"), "b", None), ("a", "unresolved_branch", None, None, "failed"), ("b", "repetition", None, None, "no response")],
        f"candidate_id string, category string, f {finding}, text string, error string",
    ).withColumns({"finish_reason": F.lit("stop"), "num_generated_tokens": F.lit(3), "prompt_truncated": F.lit(None).cast("boolean")})
    (r,) = graph.by_category(rows).collect()
    assert r.candidate_id == "a" and json.loads(r.hygiene_findings_json) == [{"category": "repetition", "verdict": "clear"}, {"category": "no_new_progress", "verdict": "clear"}]
    assert json.loads(r.hygiene_raw_outputs_json)["repetition"] == {"text": "b", "finish_reason": "stop", "num_generated_tokens": 3, "prompt_truncated": False}


def raw_pools(spark, tmp_path, **more):
    rows = [(f"question {k % 20}", str(k), float(k % 10), "t", "<think>a</think>b", None, None) for k in range(25)]
    spark.createDataFrame(rows, "question string, final_answer string, difficulty double, topic string, r1_solution_1 string, r1_solution_2 string, r1_solution_3 string").coalesce(1).write.parquet(f"{tmp_path}/raw/math")
    (tmp_path / "raw/list").mkdir(parents=True)
    (tmp_path / "raw/list/some.json").write_text(json.dumps([{"problem": f"p{k}", "answer": k, "solution": f"s{k}"} for k in range(7)]))
    tree = {"output": "pools", "raw": "raw", "sources": [
        {"name": "math", "kind": "graded", "repo": "r/math", "revision": "1", "options": {"model": "m"}},
        {"name": "list", "kind": "array", "repo": "r/list", "revision": "2", "files": "*.json", "fields": "problem string, answer bigint, solution string"},
        {"name": "empty", "kind": "graded", "repo": "r/e", "revision": "1", "raw": "math", "files": "none*.parquet", "options": {"model": "m"}},
    ]}
    path = tmp_path / "pools.json"
    path.write_text(json.dumps(tree | more))
    return str(path), tree


def test_pools_from_a_configuration(spark, tmp_path):
    path, tree = raw_pools(spark, tmp_path)
    got = builds.build_pools(spark, path, ["math", "list"])
    assert {k: (v["prompts"], v["references"]) for k, v in got.items()} == {"math": (20, 25), "list": (7, 7)}
    assert spark.read.parquet(f"{tmp_path}/pools/math/prompts").count() == 20
    assert builds.build_pools(spark, path, ["math"])["math"] == got["math"]  # built once
    with pytest.raises(ValueError, match="no source"):
        builds.build_pools(spark, path, ["maths"])
    tree["sources"][0]["options"] = {"model": "another"}
    (tmp_path / "pools.json").write_text(json.dumps(tree))
    with pytest.raises(RuntimeError, match="another configuration"):
        builds.build_pools(spark, path, ["math"])
    with pytest.raises(Exception):  # noqa: B017  no raw files
        builds.build_pools(spark, path, ["empty"])
    assert builds.built(spark, f"{tmp_path}/pools/empty") is None
    for wrong in ({"sources": 1}, {"sources": [{**tree["sources"][0], "other": 1}]}, {"sources": [tree["sources"][0]] * 2}, {"sources": [{**tree["sources"][0], "kind": "x"}]}, {"sources": [{**tree["sources"][0], "kind": "array"}]}):
        with pytest.raises(ValueError):
            builds.load_pools(tree | wrong)


def test_too_few_rows_leave_no_build(spark, tmp_path):
    with pytest.raises(ValueError, match="at least"):
        builds.publish_build(spark, f"{tmp_path}/out", {"a": spark.range(3)}, {"a": 4})
    assert builds.built(spark, f"{tmp_path}/out") is None and not (tmp_path / "out").exists() and any("incomplete" in p.name for p in tmp_path.iterdir())


def test_seeds_are_prepared_once(spark, tmp_path):
    config = RunConfig("r1", str(tmp_path), "puzzles", {"chunk": 4}, seed=3, num_samples=30)
    folder = builds.prepare(spark, config, slots=2)
    first = sorted(spark.read.parquet(folder).collect())
    assert len(first) == 30 and builds.prepare(spark, config) == folder and len([p for p in (tmp_path / "r1/seeds").iterdir() if p.name.endswith(".parquet")]) >= 4
    other = RunConfig("r1", str(tmp_path), "puzzles", {"chunk": 4}, seed=4, num_samples=30)
    with pytest.raises(RuntimeError, match="another configuration"):
        builds.prepare(spark, other)
    builds.prepare(spark, other, force=True)
    assert sorted(spark.read.parquet(folder).collect()) != first
    assert any(p.name.startswith("seeds.incomplete") for p in (tmp_path / "r1").iterdir())


def test_puzzles_are_the_same_at_any_number_of_partitions(spark):
    made = []
    for n in ("2", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        made.append(sorted(create_adapter("puzzles", tasks={"sum_chain": 2.0, "sum_grid": 1.0}, chunk=5).prepare(spark, 61, 9).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert made[0] == made[1] and len({r.sample_id for r in made[0]}) == 61
    tasks = [r.source for r in made[0]]
    assert (tasks.count("puzzles:sum_chain"), tasks.count("puzzles:sum_grid")) == (41, 20)
    for wrong in ({"tasks": {}}, {"tasks": {"x": 1.0}}, {"tasks": {"sum_chain": 0.0}}, {"bands": {"x": 1.0}}):
        with pytest.raises(ValueError):
            create_adapter("puzzles", **wrong)


def test_native_scores(spark):
    rows = [("sum_chain", "12", "12.0", 1.0), ("sum_chain", "12", "13", 0.0), ("linear_equation", "4", "x = 4", 1.0), ("linear_equation", "4", "four", 0.0), ("other", "4", "4", None), ("sum_grid", "[]", "none", 0.0)]
    meta = F.struct(F.lit(None).cast("array<array<bigint>>").alias("puzzle"), F.lit(None).cast("array<bigint>").alias("numbers"))
    out = spark.createDataFrame(rows, "task string, answer string, said string, want double").select("want", puzzles.native_score(F.col("task"), F.col("answer"), meta, F.col("said")).alias("got"))
    assert [r.got for r in out.collect()] == [r[3] for r in rows]


def test_a_whole_run(spark, tmp_path):
    """From a configuration to the table for training; what is there isn't asked for again, and another configuration is refused."""
    config = RunConfig("r", f"file://{tmp_path}", "puzzles", {"tasks": {"sum_chain": 1.0}}, seed=5, num_samples=4, rollouts_per_prompt=2, analysis_samples=1)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for mode in ("direct", "direct"):
        provider = Provider(spark, tmp_path / "asked")
        folder = graph.whole_run(spark, config, provider, mode)
        assert spark.read.parquet(folder).count() == 8 and spark.conf.get("spark.sql.files.maxPartitionBytes") == size
    assert provider.calls == 0 and spark.read.parquet(f"{tmp_path}/r/candidates").where("raw_generation = 'no scores'").count() == 8
    (told,) = reports.run_report(spark, f"{tmp_path}/r").collect()
    assert (told.samples, told.generated, told.valid) == (4, 8, True) and told.seconds > 0 and told.generated_per_hour == pytest.approx(8 * 3600 / told.seconds)
    with pytest.raises(RuntimeError, match="another configuration"):
        graph.whole_run(spark, RunConfig("r", f"file://{tmp_path}", "puzzles", {}, seed=6, num_samples=4), provider)


@pytest.mark.parametrize(("mode", "want"), [("direct", "draft"), ("direct_polish", "draft"), ("draft_polish", None)])
def test_a_failed_polish(spark, tmp_path, mode, want):
    def provide(name, requests):
        return requests.select("candidate_id", F.lit("draft" if name == "generate" else None).cast("string").alias("text"), F.lit(None if name == "generate" else "gone").cast("string").alias("error"))

    rows = spark.createDataFrame([("a", "p", None)], "candidate_id string, user_prompt string, system_prompt string")
    run = graph.Run(spark, f"file://{tmp_path}/run", provide, waves=1)
    (r,) = run.gathered(run.through(rows, graph.generation_graph(mode)), ["raw_generation"]).collect()
    assert r.raw_generation == want


def test_saved_rows_are_judged_again_in_a_folder_of_their_own(spark, tmp_path):
    rows, phases = candidates(spark, 3), graph.decision_graph(PoolAdapter([]), samples=1)
    run = graph.Run(spark, f"file://{tmp_path}/run", Provider(spark, tmp_path / "asked"), waves=1)
    saved = run.gathered(run.through(rows, phases), [c for c in run.owner if c != "candidate_id"])
    saved.write.parquet(f"{tmp_path}/saved")
    judged = spark.createDataFrame([("c0", "b", None), ("c0", "b", "[]"), ("c1", None, None)], "candidate_id string, judge_raw_output string, hygiene_findings_json string")
    got = rescoring.rejudge_saved(spark, f"{tmp_path}/saved", judged, f"{tmp_path}/again", PoolAdapter([]))
    assert got == {"rows": 3, "changed": 3} and spark.read.parquet(f"{tmp_path}/again/changes").where("new_quality_score = 0").count() == 3
    with pytest.raises(FileExistsError):
        rescoring.rejudge_saved(spark, f"{tmp_path}/saved", judged, f"{tmp_path}/again", PoolAdapter([]))


def test_store_tells_parts(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/x")
    assert sinks.Store(spark, f"{tmp_path}/x").parts(f"{tmp_path}/x") and not sinks.Store(spark, f"{tmp_path}/x").parts(f"{tmp_path}/y")


def test_calibration_asks_for_one_row_and_a_text(spark):
    rows = spark.createDataFrame([("abc1", "t", None), ("abd2", " ", "u")], "sample_id string, reasoning string, draft_generation string")
    label = lambda *r: spark.createDataFrame(list(r), "id int, prefix string, field string, category string, expected string")
    seen = lambda x: F.when(x == "t", "clear").otherwise("defect")
    ok = label((1, "abc", "reasoning", "repetition", "clear"), (2, "abd2", "draft_generation", "repetition", "clear"))
    assert sorted(tuple(r) for r in review.calibrated(ok, rows, ["reasoning", "draft_generation"], seen).collect()) == [("repetition", "clear", "clear", 1), ("repetition", "clear", "defect", 1)]
    for wrong in (label((1, "ab", "reasoning", "c", "clear")), label((1, "x", "reasoning", "c", "clear")), label((1, "abd", "reasoning", "c", "clear")), label((1, "abc", "draft_generation", "c", "clear"))):
        with pytest.raises(ValueError):
            review.calibrated(wrong, rows, ["reasoning", "draft_generation"], seen).collect()


def test_tokens_by_a_vocabulary(spark):
    import public_tokenizers
    import sentencepiece

    from rollmill.functions.tokenizers import token_counter

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [None, "", "one two", "x" * 300, "Ünïcode 漢字"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", token_counter(path)(F.col("t")).alias("n")).orderBy("k").collect()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert [r.n for r in got] == [None if t is None else len(model.encode(t)) for t in texts]
