"""Queries over documents of which some texts are empty or white space: results are still those of the SQL."""

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def blanks(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("blanks"))
    text = F.expr("case id % 11 when 0 then '' when 1 then '  ' when 2 then '\\n\\t' else concat('text ', id div 3) end")
    docs = spark.range(700).select(F.col("id").alias("doc_id"), text.alias("text"), F.expr("if(id % 2 = 0, 'de', 'en')").alias("lang"), F.concat(F.lit("src"), F.col("id") % 4).alias("source"))
    docs.withColumn("n_chars", F.length("text").cast("bigint")).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("name", ["array_source_counts", "deterministic_findings", "pool_builds", "reference_unpivot", "seed_errors"])
def test_blank_texts_against_sql(spark, blanks, name):
    import duckdb

    from rollmill import plans

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{blanks}/documents.parquet/*.parquet'")
    cursor = con.execute(plans.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    have = sorted(repr([r[c] for c in columns]) for r in plans.queries()[name](spark, blanks).collect())
    assert have == sorted(repr(list(r)) for r in cursor.fetchall())
