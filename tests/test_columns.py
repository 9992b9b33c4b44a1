import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadweir.functions import json_get, table_name, to_case
from loadweir.operators import columns as cols
from loadweir.operators import nested


@pytest.mark.parametrize(
    "name, snake, camel, pascal",
    [
        ("publishedAt", "published_at", "publishedAt", "PublishedAt"),
        ("HTMLBody", "html_body", "htmlBody", "HtmlBody"),
        ("total views", "total_views", "totalViews", "TotalViews"),
        ("_extracted_at", "_extracted_at", "_extractedAt", "_ExtractedAt"),
        ("2nd", "_2_nd", "_2Nd", "_2Nd"),
        ("channel-id.v2", "channel_id_v2", "channelIdV2", "ChannelIdV2"),
    ],
)
def test_cases(name, snake, camel, pascal):
    assert to_case(name, "snake_case") == snake
    assert to_case(name, "camel_case") == camel
    assert to_case(name, "pascal_case") == pascal


def test_table_name():
    assert table_name("channelStats", prefix="raw_") == "raw_channel_stats"
    assert table_name("posts", suffix="_v1", case="pascal_case") == "Posts_v1"
    with pytest.raises(ValueError):
        table_name("posts", case="kebab-case")


def test_names_that_become_one(spark):
    df = spark.sql("SELECT 1 AS `user id`, 2 AS userId")
    with pytest.raises(ValueError, match="both become 'user_id'"):
        cols.normalise_columns(df)


def test_aliases(spark, rows):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert cols.apply_aliases(df, {"a": "b", "b": "a"}).columns == ["b", "a"]
    with pytest.raises(ValueError, match="unknown columns"):
        cols.apply_aliases(df, {"c": "d"})
    with pytest.raises(ValueError, match="both become 'b'"):
        cols.apply_aliases(df, {"a": "b"})


def test_resolution_by_case(spark):
    df = spark.sql("SELECT 1 AS ID, 2 AS Name")
    assert cols.resolve_columns(df, ["id", "name"]).columns == ["id", "name"]
    with pytest.raises(ValueError, match="not found"):
        cols.resolve_columns(df, ["id"], case_sensitive=True)
    with pytest.raises(ValueError, match="ambiguous"):
        cols.match_names(["ID", "Id"], ["id"])
    assert cols.match_names(["ID", "id"], ["id"]) == {"id": "id"}


def test_pii(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('ann@x.org', 1), ('bob', 2), (NULL, 3) AS t(mail, id)")
    digest = hashlib.sha256(b"saltbob").hexdigest()
    hashed = {i: m for m, i in rows(cols.protect_pii(df, ["MAIL"], "hash", "salt"))}
    assert hashed[2] == digest and hashed[3] is None
    masked = {i: m for m, i in rows(cols.protect_pii(df, ["mail"], "mask", keep=4))}
    # A value no longer than what is kept is masked whole.
    assert masked == {1: "*****.org", 2: "***", 3: None}
    assert cols.protect_pii(df, ["mail"], "drop").columns == ["id"]
    with pytest.raises(ValueError, match="not found"):
        cols.protect_pii(df, ["phone"])


def test_stamp_is_an_argument(spark):
    at = datetime(2024, 1, 1, 12)
    df = cols.stamp(spark.range(1), "l1", at)
    row = df.select("_load_id", F.col("_extracted_at").cast("string")).first()
    assert tuple(row) == ("l1", "2024-01-01 12:00:00")


def test_flatten_two_deep(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('c', 2), 'd.e', 3) AS a")
    assert nested.flatten(df).columns == ["id", "a__b__c", "a__d.e"]
    assert nested.flatten(df, max_depth=1).columns == ["id", "a__b", "a__d.e"]
    assert tuple(nested.flatten(df).first()) == (1, 2, 3)
    clash = spark.sql("SELECT 1 AS a__b, named_struct('b', 2) AS a")
    with pytest.raises(ValueError, match="same name"):
        nested.flatten(clash)


def test_children_of_empty_and_null_arrays(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES (1, array('x', NULL)), (2, array()), (3, NULL) AS t(id, tags)"
    )
    children = nested.explode_children(df, "id", "tags", "tag")
    assert rows(children) == [(1, 0, "x"), (1, 1, None)]


def test_json_paths(spark, rows):
    df = spark.createDataFrame([('{"a": {"b": 7}}',), ("{oops",), ('{"a": {"b": "x"}}',), (None,)], "j string")
    got = [r[0] for r in df.select(json_get("j", "$.a.b", "bigint")).collect()]
    assert got == [7, None, None, None]


@pytest.mark.parametrize("mode", ["hash", "mask", "drop"])
def test_protection_reaches_nested_leaves(spark, mode):
    df = spark.sql("""
        SELECT 1 AS id, named_struct('email', 'ann@example.org', 'city', 'Bonn') AS contact,
               array(named_struct('email', 'bob@example.org', 'n', 1), NULL) AS friends,
               map('home', named_struct('email', 'eve@example.org', 'x', 2)) AS more,
               array('kim@example.org', NULL) AS mails, named_struct('email', 'joe@example.org') AS only
        UNION ALL SELECT 2, NULL, NULL, NULL, NULL, NULL""")
    fields = ["contact.email", "friends.email", "more.email", "mails", "only.EMAIL"]
    out = cols.protect_pii(df, fields, mode)
    text = str(out.collect())
    assert "example" not in text and "Bonn" in text and out.columns[:4] == df.columns[:4]
    last = out.filter("id = 2").first()
    assert all(v is None for v in last[1:])
    if mode == "hash":
        got = out.filter("id = 1").first()
        assert len(got.contact.email) == len(got.friends[0].email) == len(got.mails[0]) == 64
        assert got.friends[1] is None and got.mails[1] is None and got.more["home"].x == 2
    with pytest.raises(ValueError, match="not found"):
        cols.protect_pii(df, ["contact.phone"], mode)
