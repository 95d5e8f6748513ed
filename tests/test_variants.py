import json

from pyspark.sql import functions as F

from aljibe.operators import variants


def leaves(value, path="$"):
    """Plain values and empty containers of a parsed document, by path."""
    if isinstance(value, dict) and value:
        return [leaf for key, item in value.items() for leaf in leaves(item, f"{path}.{key}")]
    if isinstance(value, list) and value:
        return [leaf for place, item in enumerate(value) for leaf in leaves(item, f"{path}[{place}]")]
    return [(path, value)]


DOCUMENTS = [
    {"a": 1, "b": {"c": [1, {"d": None}, []], "e": {}}, "f": "x\"y"}, {"a": "1"}, {"a": 1.5, "new": True}, [], [1, [2, [3]]], "text", 7, None, {"": 1, "a b": 2},
]


def test_every_plain_value_has_a_row(spark):
    texts = [(i, json.dumps(document)) for i, document in enumerate(DOCUMENTS)] + [(90, None), (91, "{"), (92, ""), (93, '{"a": 1} x')]  # what follows a document is ignored
    df = spark.createDataFrame(texts, "id int, text string")
    fields = variants.document_fields(variants.documents_of(df, "text"), ["id"], "document")
    got = [(r.id, r.path, json.loads(r.value)) for r in fields.collect()]
    expected = [(i, path, value) for i, document in enumerate(DOCUMENTS) for path, value in leaves(document)] + [(93, "$.a", 1)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert sorted(r.id for r in variants.malformed(df, "text").collect()) == [91, 92]
    plan = fields._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and plan.count("Scan") == 1


def test_deep_values_stay_as_text(spark):
    df = spark.createDataFrame([('{"a": {"b": {"c": 1}}, "d": 2}',)], "text string")
    fields = variants.document_fields(variants.documents_of(df, "text"), [], "document", depth=2)
    assert sorted((r.path, r.kind, r.value) for r in fields.collect()) == [("$.a.b", "OBJECT", '{"c":1}'), ("$.d", "BIGINT", "2")]


def test_kinds_of_a_path_show_drift(spark, rows):
    df = spark.createDataFrame([(json.dumps(d),) for d in ({"v": [1, 2]}, {"v": ["x"]}, {"v": None}, {"w": 2.5})], "text string")
    kinds = variants.field_kinds(variants.document_fields(variants.documents_of(df, "text"), [], "document"))
    assert rows(kinds) == [("$.v", "VOID", 1), ("$.v[]", "BIGINT", 2), ("$.v[]", "STRING", 1), ("$.w", "DECIMAL", 1)]


def test_messages_keep_what_is_not_expected(spark):
    texts = [
        '{"messages": "none", "turns": [{"role": "user", "n": "two", "extra": {"x": 1}}, 5, {"role": 3}]}', '{"messages": [], "turns": [{"role": "no"}]}', "{}", "[1]", "null",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = variants.document_messages(variants.documents_of(df, "text"), ["id"], "document", {"role": "string", "n": "int"})
    assert [tuple(r) for r in found.orderBy("id", "place").collect()] == [
        (0, 0, "user", None, "OBJECT<extra: OBJECT<x: BIGINT>, n: STRING, role: STRING>", '{"extra":{"x":1},"n":"two","role":"user"}'),
        (0, 1, None, None, "BIGINT", "5"), (0, 2, "3", None, "OBJECT<role: BIGINT>", '{"role":3}')]
    assert found.where(F.col("id") == 1).count() == 0  # the first list is the empty one
