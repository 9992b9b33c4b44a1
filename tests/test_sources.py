import gzip
import json
import os

import pytest

from loadweir.sources import readers
from loadweir.sources.params import bind_params, merge_params, read_query
from loadweir.sources.registry import open_source, register_source, select_resources


def lines(folder, name, *bodies):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines(body + "\n" for body in bodies)


def test_json_bodies(spark, tmp_path, rows):
    folder = str(tmp_path / "bodies")
    lines(folder, "a.json", '{"data": {"items": [{"id": 1}, {"id": 2}]}}', '{"data": {"items": []}}')
    lines(folder, "b.json", "{oops", '{"data": {"items": [{"id": 3, "x": 1}]}}')
    df = readers.read_json_records(spark, folder, "id bigint", "data.items")
    assert rows(df) == [(1, None), (2, None), (3, None), (None, "{oops")]


def test_json_array_bodies(spark, tmp_path, rows):
    folder = str(tmp_path / "bodies")
    lines(folder, "a.json", '[{"id": 1, "at": "2024-01-01T00:00:00Z"}, {"id": 2}]', '{"id": 3}')
    df = readers.read_json_records(spark, folder, "id bigint, at timestamp")
    assert rows(df, "id") == [(1,), (2,), (3,)]


def test_json_column(spark, rows):
    df = spark.createDataFrame([(7, '{"r": [{"id": 1}]}'), (8, "x")], "page int, body string")
    flat = readers.parse_json_records(df, "body", "id bigint", "r", keep=("page",))
    assert rows(flat) == [(7, 1, None), (8, None, "x")]
    single = readers.parse_json_records(df, "body", "r string", keep=("page",))
    assert rows(single, "page", "r") == [(7, '[{"id":1}]'), (8, None)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_file_formats(spark, folder, rows, fmt):
    spark.range(3).write.format(fmt).save(folder)
    assert rows(readers.read_files(spark, folder, fmt, "id bigint")) == [(0,), (1,), (2,)]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="Unsupported file format"):
        readers.read_files(spark, "/x", "xml", "id bigint")


def test_parameters():
    templates = {"channelId": "{channel_id}", "userId": "{user_id}/{user_id}", "fixed": "v", "n": 5, "b": True}
    bound = bind_params(templates, {"channel_id": "UC1"}, {"user_id": 7})
    assert bound == {"channelId": "UC1", "userId": "7/7", "fixed": "v", "n": 5, "b": True}
    assert bind_params({"q": "{unknown}"}, {}) == {"q": "{unknown}"}
    assert merge_params({"a": 1, "b": 1}, {"b": 2}, {"c": 3}) == {"a": 1, "b": 2, "c": 3}


def test_query_values_are_not_spliced(spark):
    df = spark.createDataFrame([("o'b",), ("x' OR '1'='1",)], "name string")
    text = "SELECT * FROM {t} WHERE name = :name"
    assert read_query(spark, text, {"name": "o'b"}, t=df).count() == 1
    assert read_query(spark, text, {"name": "' OR '1'='1"}, t=df).count() == 0


def test_select_resources(spark):
    source = {"users": spark.range(1), "posts": spark.range(2)}
    assert list(select_resources(source, ["posts", "users"])) == ["posts", "users"]
    with pytest.raises(ValueError, match="Resource 'events' not found in source 'api'"):
        select_resources(source, ["events"], "api")
    with pytest.raises(ValueError, match="no resources"):
        select_resources({}, [], "api")


def test_registry(spark):
    with pytest.raises(ValueError, match="Unsupported source type: kafka. Supported types: .*rest_api"):
        open_source(spark, "kafka")
    register_source("numbers", lambda s, n: s.range(n))
    assert open_source(spark, "numbers", n=4).count() == 4


def test_feed_from_parent_with_repeats(spark, rows):
    parent = spark.sql("SELECT * FROM VALUES (1), (1), (NULL) AS t(id)")
    child = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (2, 'c'), (NULL, 'd') AS t(pid, v)")
    assert rows(readers.feed_from_parent(child, parent, "pid", "id")) == [(1, "a"), (1, "b")]


def test_landing_loses_no_line(spark, tmp_path, rows):
    folder = str(tmp_path / "land")
    lines(folder, "b.json", '{"id": 1, "text": "é"}', "not json", '{"id": "abc", "text": "x"}', "")
    with gzip.open(f"{folder}/a.json.gz", "wt") as out:
        out.write("\n".join(json.dumps({"id": i, "text": "t"}) for i in range(10, 1010)))
    df = open_source(spark, "landing", path=folder, schema="id bigint, text string")
    assert len(rows(df.filter("_corrupt_record IS NULL"), "id", "text")) == 1001
    assert rows(df.filter("_corrupt_record IS NOT NULL"), "id", "text", "_corrupt_record") == [
        (None, "x", '{"id": "abc", "text": "x"}'),
        (None, None, "not json"),
    ]
    assert {os.path.basename(r[0]) for r in rows(df, "_source_file")} == {"a.json.gz", "b.json"}


@pytest.mark.parametrize("open_it", ["landing", "rest_api"])
def test_a_corrupt_mark_does_not_depend_on_what_is_selected(spark, tmp_path, open_it):
    folder = str(tmp_path / "land")
    lines(folder, "a.json", '{"id": 1, "v": 5}', '{"id": 2, "v": "abc"}', '[{"id": 3, "v": 7}, {"id": "x"}, 4]', "[oops", "  ")
    df = open_source(spark, open_it, path=folder, schema="id bigint, v bigint")
    wanted = {(1, None), (2, '{"id": 2, "v": "abc"}'), (3, None), (None, '{"id":"x"}'), (None, "4"), (None, "[oops")}
    assert {tuple(r) for r in df.select("id", "_corrupt_record").collect()} == wanted
    assert df.filter("_corrupt_record IS NOT NULL").count() == 4
    assert df.select("_corrupt_record").filter("_corrupt_record IS NULL").count() == 2


class Reader:
    """Stands in for ``spark.read``: no database is started in tests."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    def jdbc(self, *args, **options):
        self.calls.append((args, options))


def test_jdbc_read_options():
    spark = Reader()
    readers.read_jdbc(spark, "jdbc:x", "t", "id", 0, 100, 4, {"user": "u"})
    args, options = spark.calls[0]
    assert args == ("jdbc:x", "t")
    assert options == {
        "column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4,
        "properties": {"user": "u"},
    }
    with pytest.raises(ValueError, match="lower and upper"):
        readers.read_jdbc(spark, "jdbc:x", "t", "id")
