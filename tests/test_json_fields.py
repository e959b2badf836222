"""Fields found in JSON text, their types and their values."""

from tabfold.sources.json_fields import field_kinds, field_types, merge_kinds, typed_fields

ROWS = [
    (1, '{"a": 1, "b": true, "c": "x", "d": 1, "f": null, "two words": 5}'),
    (2, '{"a": 2.5, "b": false, "c": "1", "d": "y", "e": {"z": [1, 2]}}'),
    (3, '{"a": null, "d": true}'), (4, "not json"), (5, None), (6, "[1, 2]"), (7, "{}"), (8, '{"g": 9007199254740993}'),
]
TYPES = {"a": "double", "b": "boolean", "c": "string", "d": "string", "e": "string", "f": "string", "g": "bigint", "two words": "bigint"}


def test_types_and_values(spark):
    df = spark.createDataFrame(ROWS, "id long, j string")
    assert {r.field: r.type for r in field_types(field_kinds(df, "j")).collect()} == TYPES
    found = typed_fields(df, "j")
    assert found.columns == ["id", "j", *sorted(TYPES)]
    by_id = {r.id: r for r in found.collect()}
    assert by_id[1].a == 1.0 and by_id[2].a == 2.5 and by_id[3].a is None
    assert [by_id[i].d for i in (1, 2, 3)] == ["1", "y", "true"] and by_id[2].e == '{"z":[1,2]}'
    assert by_id[8].g == 9007199254740993 and by_id[1]["two words"] == 5
    assert all(v is None for i in (4, 5, 6, 7) for v in list(by_id[i])[2:])


def test_parts_merge_to_the_whole(spark):
    df = spark.createDataFrame(ROWS, "id long, j string")
    parts = field_kinds(df.where("id < 2"), "j").unionAll(field_kinds(df.where("id >= 2"), "j"))
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(merge_kinds(parts)) == rows(field_kinds(df, "j"))
    assert rows(field_types(merge_kinds(parts))) == rows(field_types(field_kinds(df, "j")))


def test_the_most_frequent_fields_and_no_rows(spark):
    df = spark.createDataFrame(ROWS, "id long, j string")
    assert typed_fields(df, "j", prefix="p_", most=2).columns == ["id", "j", "p_a", "p_d"]
    assert typed_fields(df.limit(0), "j").columns == ["id", "j"]
