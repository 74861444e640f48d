"""Reports over decided candidates: records, counts, Markdown, digests, pages and the payload of a site. Texts are columns; files are written by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.ids import collapse
from rollmill.functions.ranks import ranked

SELECTED = "productivity_filtered_eligible"


def is_selected(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def digest_order() -> list[Column]:
    return [is_selected(F.col(SELECTED)), F.coalesce("source", F.lit("")), F.coalesce("sample_id", F.lit("")), F.col("candidate_id")]


def salient(findings: Column) -> Column:
    """Findings that aren't clear."""
    return F.filter(findings, lambda f: f["verdict"] != "clear")


def records(rows: DataFrame) -> DataFrame:
    """The fields that reviewers see of rows with findings array<struct<category, verdict, ...>> and exclusion_reasons."""
    return rows.select(
        F.col("candidate_id").alias("id"), "sample_id", "source", F.col("user_prompt").alias("question"), "reasoning", "response", F.col("quality_score").alias("score"), is_selected(F.col(SELECTED)).alias("selected"),
        is_selected(F.col("correctness_only_eligible")).alias("correctness_only"), F.col("correctness_verdict").alias("correctness"), F.col("hygiene_status").alias("hygiene"), F.col("exclusion_reasons").alias("exclusions"), salient(F.col("findings")).alias("findings"),
    )


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) of each column's values, nulls too; one pass over the rows."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def batch_counts(rows: DataFrame) -> DataFrame:
    flag = is_selected(F.col(SELECTED))
    return rows.agg(F.count("*").alias("count"), F.count_if(flag).alias("passed"), F.count_if(~flag).alias("rejected"))


def throughput(rows: DataFrame, seconds: Column) -> DataFrame:
    """Of rows (sample_id, raw_generation, generation_complete, two flags): how many are generated, complete and eligible, and how many of each in an hour of ``seconds`` in all."""
    made = rows.agg(
        F.count_distinct("sample_id").alias("samples"), F.count("raw_generation").alias("generated"), F.count_if("generation_complete").alias("complete"),
        F.count_if("correctness_only_eligible").alias("correctness_only"), F.count_if(SELECTED).alias("selected"), seconds.alias("seconds"),
    )
    hour = {f"{c}_per_hour": F.col(c) * 3600 / F.col("seconds") for c in ("samples", "generated", "complete", "correctness_only", "selected")}
    return made.withColumns({**hour, "valid": F.col("generated") > 0})


def run_report(spark: SparkSession, run_dir: str) -> DataFrame:
    """throughput of a whole run's candidates over the time between its first and last stage markers; a run without generations is an error."""
    times = spark.read.json([f"{run_dir}/phases/*.manifest", f"{run_dir}/answers/*.manifest", f"{run_dir}/*.manifest"]).agg(F.min("started_at_unix").alias("a"), F.max("completed_at_unix").alias("b")).first()
    out = throughput(spark.read.parquet(f"{run_dir}/candidates"), F.lit(times.b - times.a))
    if not out.first().generated:
        raise ValueError(f"{run_dir} has no generations")
    return out


def search(rows: DataFrame, words: str = "", state: str = "all", source: str | None = None) -> DataFrame:
    """rows (question, response, id, source, selected) with the words in their texts, of a state (all, pass, reject) and a source."""
    text = F.lower(F.concat_ws(" ", "question", "response", "id", "source"))
    rows = rows.where(F.contains(text, F.lit(words.lower()))) if words else rows
    rows = rows if source is None else rows.where(F.col("source") == source)
    return {"all": rows, "pass": rows.where("selected"), "reject": rows.where(~F.col("selected"))}[state]


def markdown(rows: DataFrame) -> DataFrame:
    """(selected, rank, markdown): one section for each row, ranked in its half by score, then sample_id."""
    fence = lambda x: F.concat(F.lit("```text\n"), F.replace(F.coalesce(x, F.lit("")), F.lit("```"), F.lit("'''")), F.lit("\n```"))
    score = F.coalesce(F.col("quality_score").cast("string"), F.lit("-"))
    body = F.concat(
        F.lit("## "), "sample_id", F.lit("\n\nScore "), score, F.lit(", source "), F.coalesce("source", F.lit("-")), F.lit("\n\n### Prompt\n\n"), fence(F.col("user_prompt")), F.lit("\n\n### Reasoning\n\n"), fence(F.col("reasoning")),
        F.lit("\n\n### Response\n\n"), fence(F.col("response")), F.lit("\n"),
    )
    rows = rows.select(is_selected(F.col(SELECTED)).alias("selected"), F.coalesce("quality_score", F.lit(0)).alias("_score"), "sample_id", "candidate_id", body.alias("markdown"))
    out = ranked(rows, [F.col("selected"), F.col("_score").desc(), F.col("sample_id"), F.col("candidate_id")], ["selected"])
    return out.select("selected", (F.col("rank") + 1).alias("rank"), "markdown")


def write_markdown(rows: DataFrame, folder: str) -> None:
    """Sections in order, in files below selected=true and selected=false."""
    out = markdown(rows).repartitionByRange("selected", "rank").sortWithinPartitions("selected", "rank")
    out.select("selected", F.col("markdown").alias("value")).write.partitionBy("selected").text(folder)


def shortened(text: Column, chars: int) -> Column:
    """White space collapsed; longer texts end in three points."""
    x = collapse(F.coalesce(text, F.lit("")))
    return F.when(F.length(x) > chars, F.concat(F.rtrim(F.left(x, F.lit(chars - 3))), F.lit("..."))).otherwise(x)


def digest(rows: DataFrame, chars: int = 120) -> DataFrame:
    """(rank, line): a Markdown list of the rows, the selected ones first, then by source and sample_id."""
    mark = F.when(is_selected(F.col(SELECTED)), "x").otherwise(" ")
    line = F.concat(F.lit("- ["), mark, F.lit("] "), F.coalesce("source", F.lit("")), F.lit(" "), F.left("sample_id", F.lit(12)), F.lit(": "), shortened(F.col("user_prompt"), chars))
    order = {f"_{k}": x for k, x in enumerate(digest_order())}
    out = ranked(rows.select(line.alias("line"), *(x.alias(k) for k, x in order.items())), [F.col("_0").desc(), *map(F.col, list(order)[1:])])
    return out.select((F.col("rank") + 1).alias("rank"), "line")


def html_text(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def embedded_json(x: Column) -> Column:
    """JSON text that may stand in a script of a page: no tag can end it, no line separators."""
    for a, b in (("<", "\\u003c"), (chr(0x2028), "\\u2028"), (chr(0x2029), "\\u2029")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def pages(rows: DataFrame, per_page: int = 50) -> DataFrame:
    """(page, html): records in the order of their ids, ``per_page`` to a page, each as an article and all of them as JSON in a script."""
    own = records(rows)
    article = F.concat(F.lit('<article id="'), html_text(F.col("id")), F.lit('"><h2>'), html_text(F.coalesce("question", F.lit(""))), F.lit("</h2><pre>"), html_text(F.coalesce("response", F.lit(""))), F.lit("</pre></article>"))
    lines = own.select("id", article.alias("article"), embedded_json(F.to_json(F.struct(*own.columns))).alias("json"))
    placed = ranked(lines, [F.col("id")]).withColumn("page", F.floor(F.col("rank") / per_page))
    listed = placed.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("rank", "article", "json"))).alias("all"))  # per_page rows
    part = lambda name, between: F.array_join(F.transform("all", lambda x: x[name]), between)
    return listed.select("page", F.concat(F.lit("<!doctype html>\n"), part("article", "\n"), F.lit("\n<script>const rows = ["), part("json", ","), F.lit("];</script>\n")).alias("html"))


def write_pages(rows: DataFrame, folder: str, per_page: int = 50) -> None:
    """A file of text for each page, below page=N."""
    pages(rows, per_page).select("page", F.col("html").alias("value")).write.partitionBy("page").text(folder)


def cohorts(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both cohorts with their names; a candidate in both is an error."""
    twice = first.select("candidate_id").join(second.select("candidate_id"), "candidate_id", "left_semi")
    if not twice.isEmpty():
        raise ValueError("cohorts overlap")
    return first.withColumn("cohort", F.lit("first")).unionByName(second.withColumn("cohort", F.lit("second")), allowMissingColumns=True)


def curated(notes: DataFrame, rows: DataFrame) -> DataFrame:
    """(id, problem) of notes (id, cohort, quote, quote_field) on rows (id, cohort, reasoning, response): orphan, repeated, cohort, quote; no rows when all is well."""
    counted = notes.groupBy("id").agg(F.count("*").alias("n"), F.first("cohort").alias("note_cohort"), F.first("quote").alias("quote"), F.first("quote_field").alias("quote_field"))
    joined = counted.join(rows.select("id", "cohort", "reasoning", "response"), "id", "left")
    text = F.when(F.col("quote_field") == "response", F.col("response")).otherwise(F.col("reasoning"))
    unquoted = F.col("quote").isNotNull() & ~F.coalesce(F.contains(text, F.col("quote")), F.lit(False))
    problem = F.when(F.col("cohort").isNull(), "orphan").when(F.col("n") > 1, "repeated").when(~F.col("note_cohort").eqNullSafe(F.col("cohort")), "cohort").when(unquoted, "quote")
    return joined.select("id", problem.alias("problem")).where("problem is not null")


def site_payload(cases: DataFrame, batch: DataFrame, earlier: int) -> DataFrame:
    """One row (json) for a site: counts of the batch and the curated cases' records, of which there are few."""
    own = records(cases)
    listed = own.agg(F.array_sort(F.collect_list(F.struct("id", F.to_json(F.struct(*own.columns)).alias("j")))).alias("c"))
    head = batch_counts(batch).select(F.to_json(F.struct("count", "passed", "rejected", F.lit(earlier).alias("earlier_count"))).alias("h"))
    parts = listed.select(F.array_join(F.transform("c", lambda x: x["j"]), ",").alias("c"))
    both = head.withColumn("k", F.lit(1)).join(parts.withColumn("k", F.lit(1)), "k")
    return both.select(embedded_json(F.concat(F.lit('{"batch":'), "h", F.lit(',"cases":['), "c", F.lit("]}"))).alias("json"))
