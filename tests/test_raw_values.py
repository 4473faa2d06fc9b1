"""Raw index: a payload is parsed for a value only if its text has the keys of the path."""

from __future__ import annotations

from bazaarspark.sources import landing, raw_index


def test_values_are_found_however_their_keys_are_written(spark):
    texts = ['{"a":{"b":1}}', "{'a':{'b':2}}", '{"\\u0061":{"b":3}}', '{"a": { "b" : "it\'s" }}', '{"b":{"a":4}}', '{"ab":5}', '{"a":{"b":null}}', "[]", "no", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string")
    found = df.select("i", raw_index.value("a.b").alias("v"), raw_index.value("ab").alias("w"))
    plain = df.selectExpr("i", "get_json_object(payload, '$.a.b') v", "get_json_object(payload, '$.ab') w")
    rows = found.orderBy("i").collect()
    assert rows == plain.orderBy("i").collect()
    assert [r.v for r in rows[:4]] == ["1", "2", "3", "it's"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert 'Contains(payload' in plan and '"ab"' in plan


def test_nested_envelopes_are_found_however_their_key_is_written(spark):
    inner = ['{"type":"ad","data":{"id":1}}', '{"type":"ad","d\\u0061ta":{"id":1}}', '{"type":"ad","id":1}']
    df = spark.createDataFrame([(f'{{"platform":"x","data":{t}}}',) for t in inner], "value string")
    found = landing.from_text(df)
    assert [r.payload for r in found.collect()] == ['{"id":1}', '{"id":1}', inner[2]]
    assert "Contains(" in found._jdf.queryExecution().executedPlan().toString()
