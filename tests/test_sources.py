"""Splitting JSON arrays: the rows of the whole-text reader, however the files are cut."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.sources import json_arrays
from tokenloom.sources import shards as S


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "16"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def stories(n, seed):
    rng = random.Random(seed)
    bits = ["{", "}", "[", "]", '"', "\\", "\\\\", '\\"', ",", "a b", "é漢\U0001f600", "\n", "},{", '"}', "\t"]
    text = lambda most: "".join(rng.choice(bits) for _ in range(rng.randrange(most)))
    out = []
    for i in range(n):
        row = {"story": text(60 if i % 7 else 900), "summary": text(9), "source": f"s{i}"}
        if i % 3 == 0:
            row["instruction"] = {"prompt:": text(9), "words": [text(5), "w"], "features": []}
        out.append(row)
    return out


def whole_text(spark, path):
    """The plain reader: a file is one value."""
    record = F.from_json("value", T.ArrayType(S.STORY), {"mode": "FAILFAST"})
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("shard"), F.posexplode(record).alias("doc_pos", "record"))
    return rows.select("shard", F.col("doc_pos").cast("long").alias("doc_pos"), "record.*")


def test_split_files_give_the_rows_of_whole_files(spark, tmp_path, tiny_splits):
    for i, (n, style) in enumerate([(40, {}), (0, {}), (1, {"indent": 2}), (25, {"indent": 1, "ensure_ascii": False}), (60, {"ensure_ascii": False})]):
        (tmp_path / f"{i}.json").write_text(json.dumps(stories(n, i), **style), encoding="utf-8")
    (tmp_path / "5.json").write_text(" [ ]\n")
    path = str(tmp_path)
    got = S.read_shards(spark, path)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 8
    assert sorted(map(str, got.collect())) == sorted(map(str, whole_text(spark, path).collect()))
    assert got.count() == 126 and "wholetext" not in got._jdf.queryExecution().toString().lower()
    pieces = spark.read.option("lineSep", "}").text(path)
    assert pieces.agg(F.max(F.length("value"))).first()[0] < (tmp_path / "4.json").stat().st_size / 4
    manifest = S.list_shards(spark, path, F.regexp_extract("shard", "([^/]*)$", 1))
    assert "from_json" not in manifest._jdf.queryExecution().toString()
    assert [(r.shard, r.shard_id, r.num_shards) for r in manifest.orderBy("shard").collect()] == [(f"{i}.json", i, 6) for i in range(6)]


@pytest.mark.parametrize("text", ['[{"story": "a"}, {"story": "b"', '[{"story": "a"}, 3]', '[{"story": "a"} x {"story": "b"}]', '[{"story": "a}]', '[{"story": }]', '[{"story": "a"}]]x'])
@pytest.mark.parametrize("before", [0, 30])
def test_malformed_files_fail(spark, tmp_path, tiny_splits, text, before):
    head = json.dumps(stories(before, 1))[:-1] + ", " if before else "["
    (tmp_path / "a.json").write_text(head + text[1:])
    with pytest.raises(Exception, match="array of objects|cut off|MALFORMED|Malformed|PARSE"):
        S.read_shards(spark, str(tmp_path)).collect()


def test_opened_counts_outside_strings():
    assert json_arrays._opened('{"a{": "\\\\", "b": "\\"{"') == ((1, 2), 0)
    assert json_arrays._opened('x{" {') == ((1, 1), 1)
