import json
import random

import pytest

from aljibe.sources import files, json_arrays

SCHEMA = "id bigint, note string, tags array<string>, inner struct<a:bigint,b:string,c:array<struct<x:string>>>"


def document(dice, i):
    text = "".join(dice.choice(['{', '}', '[', ']', '"', "\\", "\\\\", ",", ":", "é", "日", "\n", "a", " "]) for _ in range(dice.randrange(0, 60)))
    return {"id": i, "note": text, "tags": [text[:3], "}"] * dice.randrange(0, 3), "inner": {"a": i, "b": '"}]{', "c": [{"x": text[::-1]}] * dice.randrange(0, 3)}}


@pytest.fixture
def small_splits(spark):
    limits = {"spark.sql.files.maxPartitionBytes": "4KB", "spark.sql.files.openCostInBytes": "1KB"}
    old = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("most", [json_arrays.BROADCAST_SPLITS, 0])
def test_one_file_is_read_by_several_tasks(spark, tmp_path, rows, small_splits, monkeypatch, indent, most):
    monkeypatch.setattr(json_arrays, "BROADCAST_SPLITS", most)
    dice = random.Random(indent)
    (tmp_path / "big.json").write_text(json.dumps([document(dice, i) for i in range(400)], ensure_ascii=indent is None, indent=indent))
    pieces = json_arrays._pieces(spark, str(tmp_path), "*.json")
    assert pieces.rdd.getNumPartitions() > 8
    got = files.read_json_arrays(spark, str(tmp_path), SCHEMA)
    expected = spark.read.schema(SCHEMA).option("multiLine", True).json(str(tmp_path))
    assert rows(got) == rows(expected) and got.count() == 400


def test_documents_longer_than_splits(spark, tmp_path, rows, small_splits):
    long = [{"id": i, "note": "}{" * 9000 if i % 2 else "x" * 20_000, "tags": ["}"] * 3000, "inner": None} for i in range(6)]
    (tmp_path / "long.json").write_text(json.dumps(long))
    assert rows(files.read_json_arrays(spark, str(tmp_path), SCHEMA)) == rows(spark.read.schema(SCHEMA).option("multiLine", True).json(str(tmp_path)))


def test_odd_files(spark, tmp_path, rows):
    texts = {
        "empty_array": "[]", "blank": " \n", "nothing": "", "one": '{"id": 1, "inner": {"a": 5, "c": [{"x": "{"}]}}', "bom": '﻿[{"id": 2}]', "spaced": '\n [ {"id" : 3} ,\n{"id":4} ]\n\n',
        "items": '[1, "}", null, {"id": 5}, [[{"id": 99}]], {}]', "broken": '[{"id": 6}, {"id": 7, "note": "abc', "cut": '[{"id": 8}, {"id": 9',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "other.txt").write_text('[{"id": 100}]')
    found = json_arrays.json_documents(spark, str(tmp_path))
    assert sorted(r[0] for r in found.collect()) == sorted(
        ['{"id": 1, "inner": {"a": 5, "c": [{"x": "{"}]}}', '{"id": 2}', '{"id" : 3}', '{"id":4}', '{"id": 5}', "{}", '{"id": 6}', '{"id": 7, "note": "abc', '{"id": 8}', '{"id": 9'])
    got = files.read_json_arrays(spark, str(tmp_path), "id bigint").where("id < 7 or id = 8")
    assert rows(got) == [(1,), (2,), (3,), (4,), (5,), (6,), (8,)]
