"""Members of JSON arrays against the whole file read at once, in blocks of every size."""

import json
import random

import pytest

from rollmill.sources.arrays import member_texts
from rollmill.sources.readers import array_rows


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return rng.randrange(100)
    if kind < 3:
        return "".join(rng.choice('ab{}[]",:\\ \né') for _ in range(rng.randrange(12)))
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {f"k{j}{{": value(rng, depth + 1) for j in range(rng.randrange(3))}


@pytest.mark.parametrize("block", [16, 97, 1000, 1 << 20])
def test_members_match_the_whole_file(spark, tmp_path, block):
    rng = random.Random(block)
    arrays = {"a.json": [{"n": k, "x": value(rng)} for k in range(60)], "b.json": [{"n": k, "x": value(rng)} for k in range(7)], "empty.json": []}
    for k, (name, items) in enumerate(arrays.items()):
        (tmp_path / name).write_text(json.dumps(items, indent=k or None, ensure_ascii=False) + "\n" * k)
    (tmp_path / "none.json").write_text("")
    keep = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = {(r.raw_file, r.source_index): json.loads(r.text) for r in member_texts(spark, f"{tmp_path}/*.json").collect()}
        rows = array_rows(spark, f"{tmp_path}/b.json", "n bigint, missing string").collect()
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    assert got == {(name, k): item for name, items in arrays.items() for k, item in enumerate(items)}
    assert sorted((r.n, r.missing, r.source_index, r.raw_file) for r in rows) == [(k, None, k, "b.json") for k in range(7)]


@pytest.mark.parametrize("text", ['[{"a": 1}, {"b": ', '[{"a": "x}', '[{"a": 1}, 5, {"b": 2}]', "[1, 2]"])
def test_broken_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    if text == '[{"a": 1}, 5, {"b": 2}]':  # the member in between is part of the text before an object, which can't be read
        rows = array_rows(spark, str(tmp_path), "a bigint, b bigint").collect()
        assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.source_index)] == [(1, None), (None, None)]
        return
    with pytest.raises(Exception):  # noqa: B017
        member_texts(spark, str(tmp_path)).collect()
