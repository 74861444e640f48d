"""Registered queries over candidates: model outputs read strictly, phases, decisions made again, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.ids import collapse
from rollmill.functions.session import table
from rollmill.operators import answers, hygiene, judge, phases, reports, rescoring, schemas
from rollmill.plans.registry import register
from rollmill.sources.adapters import PoolAdapter

# Candidates out of conversations: each user turn and its answer, with what models may have written about them. Shapes go by k.
_RAW = """case conv_id % 8 when 0 then concat('<reasoning>', a, '</reasoning><response>', b, '</response>') when 1 then concat('<reasoning ', a, '</reasoning><response>', b, '</response>')
    when 2 then concat('<reasoning>', a, '</think><response>', b) when 3 then concat('<reasoning>', a, '</reasoning>') when 4 then concat('<think>', a)
    when 5 then concat('<think>', a, '</think>', b) when 6 then concat(a, '</think>', b) else b end"""
#: A judge's output that can be read, by k.
JUDGED_WELL = """concat('Scores: {"correctness":{"verdict":"', case k % 4 when 2 then 'incorrect' when 3 then 'indeterminate' else 'correct' end,
        '","confidence":"', case (k div 4) % 2 when 0 then 'high' else 'low' end, '","feedback":"ok"},"reasoning":{"score":', 2 + k % 4, ',"issues":', case when k % 4 = 3 then '[]' when k % 2 = 0 then '["meandering","meandering"]' else '["meta_commentary"]' end,
        ',"feedback":"f"},"response":{"score":"', case when k % 4 < 2 then 3 + k % 3 else 1 + k % 3 end, '","issues":', case when k % 4 < 2 and k % 3 = 2 then '[]' else '["unclear"]' end,
        ',"feedback":"f"},"hygiene_confirmations":[{"category":"repetition","verdict":"confirmed_defect","feedback":"x"}]}')"""
_FIELDS = {
    "finish_reason": "case conv_id % 3 when 0 then 'length' when 1 then 'stop' end",
    "verification_json": """case when k % 7 <> 0 then concat('{"entry":{"answer":', n, '},"type":"reference_answer"}') end""",
    "answer_json": """case k % 5 when 0 then '{"status":"no_answer","answer_type":"other"}' when 1 then '{"status":"ambiguous","answer_type":"number"}' else concat('{"status":"extracted","answer_type":"number","value":"', n + k % 2, '","values":[]}') end""",
    "reference_answer_json": """case when k % 11 <> 0 then concat('{"status":"extracted","answer_type":"number","value":"', n, '.0"}') end""",
    "judge_raw_output": f"case k % 6 when 5 then null when 4 then 'no scores' else {JUDGED_WELL} end",
    "hygiene_findings_json": """case when k % 10 <> 3 then concat('[{"category":"repetition","method":"model","verdict":"', case when k % 9 = 0 then 'defect' else 'clear' end,
        '"},{"category":"circular_rechecking","method":"model","verdict":"clear"},{"category":"no_new_progress","method":"model","verdict":"clear"},{"category":"unresolved_branch","method":"model","verdict":"clear"}]') end""",
}


def candidates(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", collapse(F.col("text")).alias("a"))
    told = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), collapse(F.col("text")).alias("b"))
    rows = asked.join(told, ["conv_id", "turn"]).withColumns({"k": F.expr("conv_id * 31 + turn"), "n": F.length("b").cast("bigint")})
    rows = rows.withColumns({"raw_generation": F.expr(_RAW), **{c: F.expr(e) for c, e in _FIELDS.items()}})
    return rows.select(
        F.concat(F.lit("s"), "conv_id").alias("sample_id"), F.concat("conv_id", F.lit("-"), "turn").alias("candidate_id"), F.col("a").alias("user_prompt"), F.concat(F.lit("src"), (F.col("k") % 3).cast("string")).alias("source"),
        F.lit("m").alias("model"), F.col("turn").alias("candidate_index"), "raw_generation", *_FIELDS,
    )


_SQL = """with t as (select u.conv_id, u.turn, trim(regexp_replace(u.text, '[\\s\\x1c-\\x1f]+', ' ', 'g')) as a, trim(regexp_replace(r.text, '[\\s\\x1c-\\x1f]+', ' ', 'g')) as b from conversations u join conversations r on r.conv_id = u.conv_id and r.turn = u.turn + 1 where u.role = 'user' and r.role = 'assistant'),
    s as (select *, conv_id || '-' || turn as candidate_id, 's' || conv_id as sample_id, conv_id * 31 + turn as k, conv_id % 8 in (0, 1, 5, 6) as parsed, conv_id % 8 not in (3, 4) and b <> '' as answered from t),
    v as (select *, parsed and answered and conv_id % 3 <> 0 as complete,
        case when k % 7 = 0 then 'unavailable' when not answered then 'error' when k % 5 < 2 or k % 11 = 0 then 'indeterminate' when k % 2 = 0 then 'passed' else 'failed' end as verification_status,
        k % 6 < 4 as judged, case when k % 4 = 2 then 'incorrect' when k % 4 = 3 then 'indeterminate' else 'correct' end as verdict, (k // 4) % 2 = 0 as high,
        least(2 + k % 4, case when k % 4 < 2 then 3 + k % 3 else 1 + k % 3 end) as raw from s),
    c as (select *, case when not judged then 'indeterminate' when verification_status = 'passed' then case when verdict = 'correct' then 'verified' else 'conflict' end
        when verdict = 'incorrect' then case when high then 'incorrect' else 'indeterminate' end when verification_status = 'failed' then case when verdict = 'correct' then 'conflict' else 'indeterminate' end
        when verdict = 'correct' and high then 'supported' else 'indeterminate' end as correctness,
        list_filter([case when conv_id % 3 = 0 then 'reasoning_limit_stop' end, case when not answered or k % 5 = 0 then 'final_answer_missing_or_malformed' end, case when k % 9 = 0 and k % 10 <> 3 and judged then 'repetition' end], lambda x: x is not null) as failures,
        conv_id % 3 = 2 or (answered and k % 5 = 1) or k % 10 = 3 or (k % 9 = 0 and not judged) as unsure, k % 10 = 3 or (k % 9 = 0 and not judged) as hygiene_error from v),
    h as (select *, case when len(failures) > 0 then 'failed' when unsure then 'indeterminate' else 'passed' end as hygiene_status, case when not complete then true when correctness = 'incorrect' then true else not judged end as zeroed from c),
    q as (select *, case when zeroed then 0 else least(raw, case when hygiene_status = 'failed' then 2 when correctness = 'conflict' or (correctness = 'indeterminate' and verification_status <> 'unavailable') or (k % 4 <> 3 and k % 2 = 0) or hygiene_status = 'indeterminate' then 3 else 5 end) end as quality_score,
        complete and correctness in ('verified', 'supported') and k % 5 >= 2 and judged as right_ from h),
    f as (select *, right_ and hygiene_status = 'passed' and quality_score >= 4 as good, list_concat(list_filter([case when not complete then 'generation_incomplete' end, case when correctness not in ('verified', 'supported') then 'correctness_' || correctness end,
        case when k % 5 < 2 then 'final_answer_unavailable' end, case when not judged then 'judge_error' end, case when hygiene_error then 'hygiene_error' end, case when quality_score < 4 then 'quality_below_4' end,
        case when hygiene_status <> 'passed' then 'hygiene_' || hygiene_status end], lambda x: x is not null), list_transform(failures, lambda x: 'hygiene_' || x)) as reasons from q)"""


def _decided(spark: SparkSession, d: str) -> DataFrame:
    return rescoring.reverified(_saved(spark, d), PoolAdapter([]))[0]


def _saved(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with decisions of another day: some errors of verification, all of score 3, none selected."""
    rows = candidates(spark, d).withColumns({"reasoning": F.lit("old"), "response": F.lit("old"), "reasoning_parsed": F.lit(False)})
    old = {"verification_status": F.when(F.length("raw_generation") % 2 == 0, "error").otherwise("passed"), "quality_score": F.lit(3).cast("bigint"), "productivity_filtered_eligible": F.lit(False), "judge_generation_error": F.lit(None).cast("string")}
    return rows.withColumns(old)


@register(f"{_SQL} select candidate_id, verification_status, correctness as correctness_verdict, quality_score, hygiene_status, right_ as correctness_only_eligible, good as productivity_filtered_eligible, case when len(reasons) = 0 then '[]' else '[\"' || array_to_string(reasons, '\", \"') || '\"]' end as exclusion_reasons_json from f")
def reverified_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Saved rows parsed, verified and decided again, from the texts of their models."""
    return _decided(spark, d).select("candidate_id", "verification_status", "correctness_verdict", "quality_score", "hygiene_status", "correctness_only_eligible", "productivity_filtered_eligible", "exclusion_reasons_json")


_OLD = "case when length(case conv_id % 8 when 0 then '<reasoning>' || a || '</reasoning><response>' || b || '</response>' when 1 then '<reasoning ' || a || '</reasoning><response>' || b || '</response>' when 2 then '<reasoning>' || a || '</think><response>' || b when 3 then '<reasoning>' || a || '</reasoning>' when 4 then '<think>' || a when 5 then '<think>' || a || '</think>' || b when 6 then a || '</think>' || b else b end) % 2 = 0 then 'error' else 'passed' end"


@register(f"{_SQL} select count(*) as rows, count(*) filter (where {_OLD} = 'error') as errors_before, count(*) filter (where verification_status = 'error') as errors_after, count(*) filter (where {_OLD} <> verification_status or quality_score <> 3 or good) as changed from f")
def reverify_report(spark: SparkSession, d: str) -> DataFrame:
    return rescoring.reverified(_saved(spark, d), PoolAdapter([]))[1]


@register(f"{_SQL} select candidate_id, 3 as old_quality_score, case when k % 2 = 0 then quality_score else 0 end as new_quality_score, false as old_productivity_filtered_eligible, case when k % 2 = 0 then good else false end as new_productivity_filtered_eligible from f where (k % 2 = 0 and (quality_score <> 3 or good)) or k % 2 = 1")
def rejudged_changes(spark: SparkSession, d: str) -> DataFrame:
    """Saved rows judged again: every second one gets its outputs, the others none and are judge errors."""
    saved = _decided(spark, d).drop("_span").withColumns({"quality_score": F.lit(3).cast("bigint"), "productivity_filtered_eligible": F.lit(False)})
    k = F.expr("bigint(split_part(candidate_id, '-', 1)) * 31 + bigint(split_part(candidate_id, '-', 2))")
    new = saved.where(k % 2 == 0).select("candidate_id", "judge_raw_output", "hygiene_findings_json")
    plain = saved.select(*[c for c in saved.columns if c in schemas.CANDIDATE.names])
    return rescoring.rejudged(plain, new.unionAll(new), PoolAdapter([]))[1]


@register(f"{_SQL} select sample_id, candidate_id, turn as candidate_index, case when conv_id % 8 = 7 then null when a = '' then 0 else len(string_split(a, ' ')) end as reasoning_num_tokens, case when conv_id % 8 in (3, 4) then null when b = '' then 0 else len(string_split(b, ' ')) end as response_num_tokens, quality_score, good as productivity_filtered_eligible, 20 as n_columns from f")
def training_projection(spark: SparkSession, d: str) -> DataFrame:
    """Decided rows as candidates of the fixed schema, then the columns for training."""
    rows = _decided(spark, d)
    out = schemas.for_training(schemas.as_candidates(rows.select(*[c for c in rows.columns if c in schemas.CANDIDATE.names])))
    return out.select("sample_id", "candidate_id", "candidate_index", "reasoning_num_tokens", "response_num_tokens", "quality_score", "productivity_filtered_eligible", F.lit(len(out.columns)).alias("n_columns"))


@register(f"{_SQL}, l as (select unnest([{{'c': 'quality_score', 'v': quality_score::varchar}}, {{'c': 'hygiene_status', 'v': hygiene_status}}]) as x from f) select x.c as \"column\", x.v as value, count(*) as n from l group by all")
def decision_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.value_counts(_decided(spark, d), ["quality_score", "hygiene_status"])


@register(f"{_SQL} select count(*) as count, count(*) filter (where good) as passed, count(*) filter (where not good) as rejected from f")
def batch_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.batch_counts(_decided(spark, d))


@register(f"""{_SQL}, m as (select count(distinct sample_id) as samples, count(*) as generated, count(*) filter (where complete) as complete, count(*) filter (where right_) as correctness_only, count(*) filter (where good) as selected, sum(length(a) + length(b)) / 100.0 as seconds from f)
    select *, generated > 0 as valid, samples * 3600 / seconds as samples_per_hour, generated * 3600 / seconds as generated_per_hour, complete * 3600 / seconds as complete_per_hour, correctness_only * 3600 / seconds as correctness_only_per_hour, selected * 3600 / seconds as selected_per_hour from m""")
def throughput_report(spark: SparkSession, d: str) -> DataFrame:
    rows = _decided(spark, d)
    texts = table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", F.length(collapse(F.col("text"))).alias("x"))
    told = table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.length(collapse(F.col("text"))).alias("y"))
    lengths = texts.join(told, ["conv_id", "turn"]).select(F.concat("conv_id", F.lit("-"), "turn").alias("candidate_id"), (F.col("x") + F.col("y")).alias("size"))
    return reports.throughput(rows.join(lengths, "candidate_id"), F.sum("size") / 100.0)


def _reviewed(spark: SparkSession, d: str) -> DataFrame:
    found = F.from_json("hygiene_findings_json", "array<struct<category: string, method: string, verdict: string>>")
    return _decided(spark, d).withColumn("findings", F.coalesce(found, F.array().cast("array<struct<category: string, method: string, verdict: string>>")))


@register(f"{_SQL} select candidate_id as id, 'src' || k % 3 as source, quality_score as score, good as selected, case when k % 9 = 0 and k % 10 <> 3 then 'repetition' else '' end as findings, array_to_string(reasons, ',') as exclusions from f where contains(lower(a || ' ' || case when conv_id % 8 in (3, 4) then '' else b end || ' ' || candidate_id || ' src' || k % 3), 'src1') and not good")
def review_records(spark: SparkSession, d: str) -> DataFrame:
    """The records of a review, searched for a word among the rejected."""
    out = reports.search(reports.records(_reviewed(spark, d)), "SRC1", "reject")
    return out.select("id", "source", "score", "selected", F.array_join(F.transform("findings", lambda f: f["category"]), ",").alias("findings"), F.array_join("exclusions", ",").alias("exclusions"))


@register(f"""{_SQL}, x as (select *, case when conv_id % 8 = 7 then null else a end as reasoning, case when conv_id % 8 in (3, 4) then null else b end as response from f)
    select good as selected, row_number() over (partition by good order by quality_score desc, sample_id, candidate_id) as rank, sha256('## ' || sample_id || chr(10) || chr(10) || 'Score ' || quality_score || ', source src' || k % 3 || chr(10) || chr(10) || '### Prompt' || chr(10) || chr(10) || '```text' || chr(10) || a || chr(10) || '```' || chr(10) || chr(10) || '### Reasoning' || chr(10) || chr(10) || '```text' || chr(10) || coalesce(reasoning, '') || chr(10) || '```' || chr(10) || chr(10) || '### Response' || chr(10) || chr(10) || '```text' || chr(10) || coalesce(response, '') || chr(10) || '```' || chr(10)) as section_id from x""")
def review_markdown(spark: SparkSession, d: str) -> DataFrame:
    return reports.markdown(_decided(spark, d)).select("selected", "rank", F.sha2("markdown", 256).alias("section_id"))


@register(f"""{_SQL}, x as (select *, case when length(a) > 60 then rtrim(left(a, 57)) || '...' else a end as p from f)
    select row_number() over (order by good desc, 'src' || k % 3, sample_id, candidate_id) as rank, '- [' || case when good then 'x' else ' ' end || '] src' || k % 3 || ' ' || left(sample_id, 12) || ': ' || p as line from x""")
def review_digest(spark: SparkSession, d: str) -> DataFrame:
    return reports.digest(_decided(spark, d), 60)


@register(f"{_SQL} select count(*) as rows, count(*) filter (where good) as passed, 4::bigint as earlier from f")
def site_payload(spark: SparkSession, d: str) -> DataFrame:
    """The site's payload, read back."""
    rows = _reviewed(spark, d)
    out = reports.site_payload(rows.where(F.col("productivity_filtered_eligible")), rows, 4)
    x = F.from_json("json", "batch struct<count: bigint, passed: bigint, rejected: bigint, earlier_count: bigint>, cases array<struct<id: string>>")
    return out.select(x.alias("x")).select(F.col("x.batch.count").alias("rows"), F.size("x.cases").cast("bigint").alias("passed"), F.col("x.batch.earlier_count").alias("earlier"))


_NOTES = "case doc_id % 6 when 0 then 'orphan' when 1 then 'repeated' when 2 then 'cohort' when 3 then 'quote' end"


@register(f"select doc_id::varchar as id, {_NOTES} as problem from documents where doc_id % 6 < 4 and text <> ''")
def curation_problems(spark: SparkSession, d: str) -> DataFrame:
    """Notes without a row, repeated ones, of another cohort, with a quote that isn't there; two of six are well."""
    docs = table(spark, d, "documents").where("text <> ''")
    k = F.col("doc_id") % 6
    notes = docs.select(F.col("doc_id").cast("string").alias("id"), F.when(k == 2, "b").otherwise("a").alias("cohort"), F.when(k == 3, F.concat("text", F.lit("!"))).when(k == 4, F.col("text")).alias("quote"), F.lit("reasoning").alias("quote_field"), k.alias("k"))
    notes = notes.unionAll(notes.where("k = 1")).drop("k")
    rows = docs.where(k > 0).select(F.col("doc_id").cast("string").alias("id"), F.lit("a").alias("cohort"), F.col("text").alias("reasoning"), F.lit(None).cast("string").alias("response"))
    return reports.curated(notes, rows)


@register("""select doc_id, case doc_id % 12 when 0 then 'empty' when 1 then 'no_object' when 2 then 'fields' when 3 then 'correctness' when 4 then 'feedback_says_correct' when 5 then 'feedback_rejects_reference' when 6 then 'reasoning' when 7 then 'reasoning_issues' when 8 then 'hygiene_confirmations' when 9 then 'response_too_good' when 10 then 'correct_with_issue' end as error,
    case when doc_id % 12 = 11 then 'correct' end as verdict, case when doc_id % 12 = 11 then 4 end as reasoning_score, case when doc_id % 12 = 11 then 'meandering,unverifiable' end as issues from documents""")
def judge_outputs(spark: SparkSession, d: str) -> DataFrame:
    """A judge's outputs, each breaking one rule, and right ones with numbers as texts and repeated issues."""
    good = {"v": "correct", "c": "high", "f": "fine", "s": '"4"', "i": '["meandering","unverifiable","meandering"]', "rs": "5.0", "ri": "[]", "h": "[]", "x": ""}
    change = {2: {"x": ',"more":1'}, 3: {"c": "sure"}, 4: {"v": "incorrect", "f": "the candidate answer 3 is correct", "rs": "2", "ri": '["unclear"]'}, 5: {"f": "The REFERENCE answer given is wrong"}, 6: {"s": "6"}, 7: {"s": "5"}, 8: {"h": '[{"category":"repetition","verdict":"maybe","feedback":"x"}]'}, 9: {"v": "indeterminate", "rs": "4", "ri": '["unclear"]'}, 10: {"rs": "2", "ri": '["incorrect"]'}}

    def text(k: int) -> str:
        p = good | change.get(k, {})
        return f'Here: {{"correctness":{{"verdict":"{p["v"]}","confidence":"{p["c"]}","feedback":"{p["f"]}"}},"reasoning":{{"score":{p["s"]},"issues":{p["i"]},"feedback":"r"}},"response":{{"score":{p["rs"]},"issues":{p["ri"]},"feedback":"r"}},"hygiene_confirmations":{p["h"]}{p["x"]}}} done'

    raw = F.when(F.col("doc_id") % 12 == 0, "").when(F.col("doc_id") % 12 == 1, F.replace("text", F.lit("{"), F.lit("")))
    for k in range(2, 12):
        raw = raw.when(F.col("doc_id") % 12 == k, text(k))
    out = judge.judge_scores(raw)
    return table(spark, d, "documents").withColumn("j", out).select("doc_id", "j.error", "j.verdict", "j.reasoning_score", F.array_join("j.reasoning_issues", ",").alias("issues"))


@register("""select doc_id, case doc_id % 7 when 0 then 'empty' when 1 then 'no_object' when 2 then 'fields' when 3 then 'values' when 4 then 'extracted_without_value' when 5 then 'conditional_form' end as error, case when doc_id % 7 = 6 then n_chars::varchar end as value from documents""")
def answer_extractions(spark: SparkSession, d: str) -> DataFrame:
    shapes = {2: '{"status":"extracted","answer_type":"number","value":"1","x":1}', 3: '{"status":"found","answer_type":"number"}', 4: '{"status":"extracted","answer_type":"number","value":""}', 5: '{"status":"conditional","answer_type":"number","value":"1"}'}
    raw = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 7 == 1, "none")
    for k, text in shapes.items():
        raw = raw.when(F.col("doc_id") % 7 == k, text)
    raw = raw.otherwise(F.concat(F.lit('```json\n{"status":"extracted","answer_type":"number","value":"'), F.col("n_chars").cast("string"), F.lit('"}\n```')))
    return table(spark, d, "documents").withColumn("x", judge.answer_extraction(raw)).select("doc_id", "x.error", "x.value")


_TEXT = "trim(regexp_replace(text, '[\\s\\x1c-\\x1f]+', ' ', 'g'))"


@register(f"""with t as (select doc_id, {_TEXT} as w from documents) select doc_id, case doc_id % 7 when 4 then case when w = '' then 'uncertain' else 'defect' end when 6 then 'clear' else 'uncertain' end as verdict,
    case doc_id % 7 when 0 then 'empty model output' when 1 then 'unreadable assessment' when 2 then 'unanchored evidence' end as error from t""")
def hygiene_assessments(spark: SparkSession, d: str) -> DataFrame:
    """Findings of a model: missing, unreadable, without evidence in the text, shown once only, well, of a cut trace, clear."""
    k = F.col("doc_id") % 7
    shape = lambda verdict, evidence: F.to_json(F.struct(F.lit(verdict).alias("verdict"), evidence.alias("evidence"), F.lit("why").alias("explanation")))
    none = F.array().cast("array<string>")
    raw = (
        F.when(k == 0, "").when(k == 1, '{"verdict":"defect","evidence":[],"explanation":"x"}').when(k == 2, shape("defect", F.array(F.concat("text", F.lit("☃")))))
        .when(k == 3, shape("defect", F.array(F.concat(F.lit("only "), F.col("doc_id").cast("string"), F.lit(" once"))))).when(k == 4, F.concat(F.lit("```json\n"), shape("defect", F.array("text", F.col("text"))), F.lit("```"))).otherwise(shape("clear", none))
    )
    trace = F.concat("text", F.lit(" only "), F.col("doc_id").cast("string"), F.lit(" once"))
    out = judge.assessment(raw, F.lit("repetition"), trace, F.lit(None).cast("string"), k == 5, phases.anchoring)
    return table(spark, d, "documents").withColumn("f", out).select("doc_id", "f.verdict", "f.error")


@register("""select doc_id as candidate_id, c as category, case when c = 'repetition' and doc_id % 2 = 0 then 'span ' || n_chars when c in ('circular_rechecking', 'no_new_progress') and doc_id % 3 = 0 then 'numbers' end as signal from documents, (values ('repetition'), ('circular_rechecking'), ('no_new_progress'), ('unresolved_branch')) as t(c)""")
def hygiene_requests(spark: SparkSession, d: str) -> DataFrame:
    numbers = F.when(F.col("doc_id") % 3 == 0, "numbers")
    rows = table(spark, d, "documents").withColumn("candidate_id", F.col("doc_id"))
    out = hygiene.requests(rows, {"repetition": F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("span "), "n_chars")), "circular_rechecking": numbers, "no_new_progress": numbers})
    return out.select("candidate_id", "category", "signal")


@register("""select doc_id, case when doc_id % 3 = 0 then n_chars || '.123456789' end as top, case when doc_id % 3 = 0 then 5 end as places, case when doc_id % 3 = 0 and doc_id % 2 = 0 then n_chars || '.987654321' end as second, case when doc_id % 3 = 0 then length(text) + 1 end as first_at from documents""")
def repeated_number_signal(spark: SparkSession, d: str) -> DataFrame:
    """Precise numbers behind each text: one at five places, one at four or three."""
    n = F.col("n_chars").cast("string")
    one, two = F.concat(F.lit(" "), n, F.lit(".12345678901")), F.concat(F.lit(" -"), n, F.lit(".1234567890 "), n, F.lit(".987654321"))
    text = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.repeat(one, F.lit(5)), F.repeat(F.replace(two, F.lit("-"), F.lit("v")), F.when(F.col("doc_id") % 2 == 0, 4).otherwise(3)))).otherwise(F.col("text"))
    found = table(spark, d, "documents").withColumn("f", hygiene.repeated_numbers(text))
    at = lambda k: F.try_element_at("f", F.lit(k))
    return found.select("doc_id", at(1)["value"].alias("top"), at(1)["count"].alias("places"), at(2)["value"].alias("second"), at(1)["first"].alias("first_at"))


@register("""select doc_id as candidate_id, t as target, sha256(case when t = 'candidate' then text else source end) as text_id, case doc_id % 4 when 0 then 'no response' when 1 then 'bad request' end as error from documents, (values ('candidate'), ('reference')) as x(t) where t = 'candidate' or doc_id % 3 <> 0""")
def extraction_phase(spark: SparkSession, d: str) -> DataFrame:
    """Requests for the candidate's answer and the reference's; some get no response, some an error, and no other row is concerned."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("candidate_id"), F.col("text").alias("response"), F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("reference_text"))
    asked = phases.extraction_requests(rows)
    came = asked.where("candidate_id % 4 <> 0").select("candidate_id", "target", F.when(F.col("candidate_id") % 4 == 1, "bad request").alias("error"), F.col("text").alias("answer"))
    out = phases.settled(asked, came, ["candidate_id", "target"], "answer")
    return out.select("candidate_id", "target", F.sha2("text", 256).alias("text_id"), "error")


@register("""select doc_id as candidate_id, case when doc_id % 5 = 0 then null when doc_id % 3 = 0 then 'done ' || lang else source end as direct, case when doc_id % 3 = 0 and doc_id % 5 <> 0 then 'done ' || lang end as draft_polish, case when doc_id % 5 = 0 then null else source end as unpolished from documents""")
def polish_modes(spark: SparkSession, d: str) -> DataFrame:
    """What is left of a draft when its polish fails: direct modes keep it."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("candidate_id"), F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("draft_generation"), "lang")
    came = rows.where("candidate_id % 3 = 0").select("candidate_id", F.concat(F.lit("done "), "lang").alias("text"))
    direct = phases.polished(phases.generation_requests(rows, "direct_polish"), came, "direct_polish").withColumnRenamed("raw_generation", "direct")
    both = phases.polished(direct, came, "draft_polish").withColumnRenamed("raw_generation", "draft_polish")
    out = phases.polished(both, came, "draft_polish", polish=False)
    return out.select("candidate_id", "direct", "draft_polish", F.col("raw_generation").alias("unpolished"))


@register("""select doc_id, case when doc_id % 2 = 0 then 'ok' when doc_id % 3 = 0 then 'ok again' when doc_id % 5 = 0 then 'ok at last' else 'bad' end as output, case when doc_id % 2 = 0 then 'ok' else 'bad' end as first_output, case when doc_id % 2 = 0 then 0 when doc_id % 3 = 0 then 1 else 2 end as retry_count from documents""")
def two_retries(spark: SparkSession, d: str) -> DataFrame:
    """Rows that aren't valid are asked again, at most twice; what came first is kept."""
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "ok").otherwise("bad").alias("output"))
    valid = lambda r: r.withColumn("valid", F.col("output").startswith("ok"))
    one = phases.retry_requests(valid(rows), "doc_id", "valid", "output", 1).where("doc_id % 3 = 0").select("doc_id", F.lit("ok again").alias("output"))
    rows = phases.with_retry(valid(rows), one, "doc_id", "valid", "output", 1)
    two = phases.retry_requests(valid(rows), "doc_id", "valid", "output", 2).where("doc_id % 5 = 0").select("doc_id", F.lit("ok at last").alias("output"))
    return phases.with_retry(valid(rows), two, "doc_id", "valid", "output", 2).select("doc_id", "output", "first_output", "retry_count")


@register("""select doc_id, case when doc_id % 2 = 0 then 'judge_generation_error' else 'generation_error' end as error_column, case when doc_id % 3 = 0 then '<think>' || lang else lang end as raw, ('0x' || substr(sha256(doc_id || chr(31) || 'critique_local'), 1, 8))::bigint as seed, case when doc_id % 2 = 0 then 'critique_global' else 'critique_local' end as kind from documents""")
def phase_columns(spark: SparkSession, d: str) -> DataFrame:
    """Seeds of a phase, kinds of critiques, columns of errors, thoughts that were cut."""
    rows = table(spark, d, "documents").withColumn("candidate_id", F.col("doc_id").cast("string"))
    rows = phases.sampling_columns(rows, "critique_local", 0.7, 512)
    phase = F.when(F.col("doc_id") % 2 == 0, "arbitration_fallback").otherwise("polish")
    raw = phases.unfinished(F.col("lang"), F.when(F.col("doc_id") % 3 == 0, "length").otherwise("stop"))
    return rows.select("doc_id", phases.error_column(phase).alias("error_column"), raw.alias("raw"), "seed", phases.critique_kind(F.col("doc_id")).alias("kind"))


@register("""with t as (select doc_id, text, case when length(text) >= 4000 and doc_id % 2 = 0 then floor(length(text) * 0.65::double)::bigint end as a from documents), f as (select *, instr(substr(text, a + 1), chr(10) || chr(10)) as i from t), p as (select *, case when i > 0 then a + i - 1 else a end as c from f)
    select doc_id, sha256(case when text = '' then '(missing)' when c is null then text else 'EARLIER PART (where a result may first be found):' || chr(10) || left(text, c) || chr(10) || chr(10) || 'LATER PART (was more work needed after the result?):' || chr(10) || substr(text, c + 1) end) as shown_id from p""")
def shown_traces(spark: SparkSession, d: str) -> DataFrame:
    category = F.when(F.col("doc_id") % 2 == 0, "circular_rechecking").otherwise("repetition")
    return table(spark, d, "documents").select("doc_id", F.sha2(phases.shown_trace(F.col("text"), category), 256).alias("shown_id"))


@register("""select doc_id, case doc_id % 5 when 0 then null when 1 then case when n_chars % 2 = 0 then 1.0 else 0.25 end when 4 then 1.0 end::double as score, case doc_id % 5 when 2 then 'structured_answer_unavailable' when 3 then 'answer_type_requires_model_review' end as reason,
    case doc_id % 5 when 1 then case when n_chars % 2 = 0 then n_chars::varchar else '0' end when 0 then 'a,b,a b' when 4 then n_chars || '.0' when 3 then 'x' else '' end as candidates, case doc_id % 5 when 0 then '(no reference answer is available)' when 2 then '"' || lang || '"' else n_chars::varchar end as told from documents""")
def pooled_verification(spark: SparkSession, d: str) -> DataFrame:
    """Rows without verification, with a scorer of their source, without a structured answer, of a type for review, comparable."""
    k, n = F.col("doc_id") % 5, F.col("n_chars").cast("string")
    own = lambda more: F.concat(F.lit('{"entry":{"answer":'), F.when(k == 2, F.concat(F.lit('"'), "lang", F.lit('"'))).otherwise(n), F.lit("}" + more + "}"))
    verification = F.when(k == 0, None).when(k == 1, own(',"source_dataset":"grid"')).otherwise(own(""))
    extracted = lambda t, v: F.concat(F.lit(f'{{"status":"extracted","answer_type":"{t}","value":"'), v, F.lit('"}'))
    answer = F.when(k == 0, '{"status":"extracted","answer_type":"text","values":["a"," b "]}').when(k == 1, extracted("number", F.when(F.col("n_chars") % 2 == 0, n).otherwise("0"))).when(k == 2, '{"status":"ambiguous","answer_type":"other"}').when(k == 3, extracted("text", F.lit("x"))).otherwise(extracted("number", F.concat(n, F.lit(".0"))))
    reference = F.when(k == 3, extracted("text", F.lit("x"))).otherwise(extracted("number", n))
    rows = table(spark, d, "documents").withColumns({"verification_json": verification, "answer_json": answer, "reference_answer_json": reference})
    return answers.verify_pooled(rows, "v", F.lit(0.25)).select("doc_id", "v.score", "v.reason", F.array_join(answers.answer_candidates(answer), ",").alias("candidates"), answers.reference_answer(verification).alias("told"))
