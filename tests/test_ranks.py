"""Ranks against sorted lists, plans without one task for all rows, and mixtures with many contested prompts against a plain loop."""

import hashlib
import random

from pyspark.sql import functions as F

from rollmill.functions.ranks import first_ranked, ranked
from rollmill.operators import reports, sampling
from rollmill.sources.adapters import PoolSource, mixture


def rows(spark, n=500, partitions=5):
    rng = random.Random(n)
    made = [(rng.choice([None, "a", "b", "b", "b", ""]), rng.choice([None, *range(n)]), k) for k in range(n)]
    return made, spark.createDataFrame(made, "g string, x int, k int").repartition(partitions)


def key(v):
    return (v is not None, v if v is not None else 0)


def test_ranks_in_groups_and_over_all(spark):
    made, df = rows(spark)
    order = sorted(made, key=lambda r: ((r[0] is not None, r[0] or ""), key(r[1]), r[2]))
    want, seen = {}, {}
    for g, _, k in order:
        want[k] = seen[g] = seen.get(g, -1) + 1
    got = ranked(df, [F.col("g"), F.col("x"), F.col("k")], ["g"])
    assert got.columns == ["g", "x", "k", "rank"] and {r.k: r["rank"] for r in got.collect()} == want
    over = sorted(made, key=lambda r: (key(r[1]), r[2]))
    got = ranked(df, [F.col("x"), F.col("k")], name="place")
    assert {r.k: r.place for r in got.collect()} == {k: n for n, (_, _, k) in enumerate(over)}
    down = first_ranked(df, [F.col("x").desc(), F.col("k")], 40)
    assert [r.k for r in sorted(down.collect(), key=lambda r: r["rank"])] == [k for _, _, k in sorted(made, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))[:40]]
    assert ranked(df.limit(0), [F.col("x")]).count() == 0 and first_ranked(df, [F.col("k")], 10_000).count() == 500


def test_no_task_holds_all_rows(spark):
    decided = spark.range(300).select(
        F.col("id").cast("string").alias("candidate_id"), F.lit("s").alias("sample_id"), F.lit("x").alias("source"), F.lit("p").alias("user_prompt"), F.lit("r").alias("reasoning"), F.lit("t").alias("response"),
        (F.col("id") % 5).alias("quality_score"), (F.col("id") % 2 == 0).alias(reports.SELECTED), F.lit(True).alias("correctness_only_eligible"), F.lit("c").alias("correctness_verdict"), F.lit("h").alias("hygiene_status"),
        F.array().cast("array<string>").alias("exclusion_reasons"), F.array().cast("array<struct<category: string, verdict: string>>").alias("findings"),
    )
    made = {"digest": reports.digest(decided), "markdown": reports.markdown(decided), "pages": reports.pages(decided, 7), "stride": sampling.stride_shard(decided, 1, 3, 20), "first": first_ranked(decided, [F.col("candidate_id")], 9)}
    for name, df in made.items():
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString(), name
    assert made["digest"].agg(F.max("rank")).first()[0] == 300 and made["markdown"].count() == 300 and made["stride"].count() == 20
    pages = {r.page: r.html for r in made["pages"].collect()}
    assert len(pages) == 43 and pages[0].count("<article") == 7 and "</script>" not in pages[0][: pages[0].rindex("</script>")]


def test_pages_are_files(spark, tmp_path):
    made = [(f"c{k}", "<b>&", "</script>") for k in range(5)]
    decided = spark.createDataFrame(made, "candidate_id string, user_prompt string, response string").withColumn("sample_id", F.lit("s"))
    for c, t in (("source", "string"), ("reasoning", "string"), ("quality_score", "bigint"), (reports.SELECTED, "boolean"), ("correctness_only_eligible", "boolean"), ("correctness_verdict", "string"), ("hygiene_status", "string"), ("exclusion_reasons", "array<string>"), ("findings", "array<struct<category: string, verdict: string>>")):
        decided = decided.withColumn(c, F.lit(None).cast(t))
    reports.write_pages(decided, f"{tmp_path}/site", 2)
    files = sorted(tmp_path.glob("site/page=*/*.txt"))
    assert len(files) == 3 and all(f.read_text().count("</script>") == 1 and "&lt;b&gt;&amp;" in f.read_text() for f in files)
    reports.write_markdown(decided, f"{tmp_path}/review")
    assert sum(f.read_text().count("\n## ") + f.read_text().startswith("## ") for f in tmp_path.glob("review/selected=false/*.txt")) == 5


def test_contested_prompts_go_to_the_first(spark):
    """Pools that share most of their prompts, against one band after another."""
    rng = random.Random(2)
    pools, sources = [], []
    for p in range(3):
        made = [(f"p{p}-{k}", f"Prompt {rng.randrange(60)}", rng.choice(["hard", "easy"])) for k in range(150)]
        pools.append(made)
        sources.append(PoolSource(f"p{p}", weight=1.0, bands={"hard": 0.5, "easy": 0.5}, oversample=4.0))
    got = mixture([(s, spark.createDataFrame(m, "sample_id string, user_prompt string, difficulty_band string")) for s, m in zip(sources, pools, strict=True)], 36, 7).collect()
    rank = lambda i: (hashlib.sha256(f"7\x1f{i}".encode()).hexdigest()[:16], i)
    taken, want = set(), []
    for made in pools:
        for band in ("hard", "easy"):
            top = sorted((r for r in made if r[2] == band), key=lambda r: rank(r[0]))[:24]
            mine = []
            for i, prompt, _ in top:
                if len(mine) < 6 and prompt not in taken and prompt not in {m[1] for m in mine}:
                    mine.append((i, prompt))
            taken |= {m[1] for m in mine}
            want += [m[0] for m in mine]
    assert sorted(r.sample_id for r in got) == sorted(want) and [r.rank_key for r in got] == sorted(r.rank_key for r in got)
