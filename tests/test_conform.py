import pytest

from loadweir import Column
from loadweir.operators.conform import REASONS, conform, evolve_union, split_rejects

CONTRACT = [
    Column("id", "integer", nullable=False),
    Column("views", "integer"),
    Column("published_at", "timestamp", path="snippet.publishedAt"),
    Column("ok", "boolean"),
    Column("note", "string"),
]


@pytest.fixture
def raw(spark):
    return spark.sql(
        """SELECT * FROM VALUES
        ('1', '10', named_struct('publishedAt', '2024-01-01T00:00:00Z'), 'true', 5),
        ('x', '20', named_struct('publishedAt', '2024-01-02T00:00:00Z'), 'false', 6),
        (NULL, '30', named_struct('publishedAt', 'soon'), 'maybe', 7),
        ('4', NULL, NULL, NULL, 8) AS t(ID, views, snippet, ok, extra)"""
    )


def test_types_order_and_extras(raw):
    df = conform(raw, CONTRACT)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("id", "bigint"),
        ("views", "bigint"),
        ("published_at", "timestamp"),
        ("ok", "boolean"),
        ("note", "string"),
    ]
    assert [r.id for r in df.collect()] == [1, None, None, 4]
    assert conform(raw, CONTRACT, extra="keep").columns[-2:] == ["snippet", "extra"]


def test_missing_required_column(raw):
    with pytest.raises(ValueError, match="Required columns"):
        conform(raw, [Column("sku", "string", nullable=False)])


def test_rejects_keep_raw_values_and_every_row(raw):
    good, rejects = split_rejects(raw, CONTRACT)
    assert sorted(r.id for r in good.collect()) == [1, 4]
    reasons = {r.views: r[REASONS] for r in rejects.collect()}
    assert reasons["20"] == ["id: not a valid integer"]
    assert reasons["30"] == [
        "id: null",
        "published_at: not a valid timestamp",
        "ok: not a valid boolean",
    ]
    assert {r.ID for r in rejects.collect()} == {"x", None}
    assert good.count() + rejects.count() == raw.count()


def test_json_column(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{",)], "payload string")
    good, rejects = split_rejects(df, [Column("payload", "json")])
    assert good.schema["payload"].dataType.simpleString() == "variant"
    assert (good.count(), rejects.count()) == (1, 1)
    structs = spark.sql("SELECT named_struct('a', 1) AS payload")
    value = conform(structs, [Column("payload", "json")]).selectExpr("to_json(payload)").first()[0]
    assert value == '{"a":1}'


@pytest.mark.parametrize("kind", ["double", "float", "decimal(5,2)"])
def test_fractions_are_no_integers(spark, rows, kind):
    df = spark.sql(f"SELECT CAST(v AS {kind}) AS v FROM VALUES (3.5), (4.0), (-0.25), (NULL) AS t(v)")
    good, rejects = split_rejects(df, [Column("v", "integer")])
    assert sorted(rows(good), key=str) == [(4,), (None,)]
    assert sorted(float(v) for v, _ in rows(rejects)) == [-0.25, 3.5]


def test_evolution_adds_and_widens(spark, rows):
    old = spark.sql("SELECT 1 AS id, 2 AS n, named_struct('a', 1) AS s")
    new = spark.sql("SELECT 5L AS ID, 2.5D AS n, named_struct('b', 'x', 'a', 3L) AS s, true AS flag")
    both = evolve_union(old, new)
    assert both.columns == ["id", "n", "s", "flag"]
    assert both.schema["n"].dataType.simpleString() == "double"
    assert both.schema["s"].dataType.simpleString() == "struct<a:bigint,b:string>"
    assert rows(both.select("id", "n", "s.a", "s.b", "flag")) == [
        (1, 2.0, 1, None, None),
        (5, 2.5, 3, "x", True),
    ]


def test_evolution_refuses_other_changes(spark):
    with pytest.raises(ValueError, match="'a' cannot change"):
        evolve_union(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 'x' AS a"))


def test_evolution_with_empty_sides(spark, rows):
    full, empty = spark.sql("SELECT 1 AS a"), spark.createDataFrame([], "a int, b string")
    assert rows(evolve_union(full, empty)) == [(1, None)]
    assert rows(evolve_union(empty, full)) == [(1, None)]
