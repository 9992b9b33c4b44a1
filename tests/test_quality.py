from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadweir import Check, Column
from loadweir.operators import quality as q


@pytest.fixture
def df(spark):
    return spark.sql(
        """SELECT id, n, name, CAST(ts AS TIMESTAMP) AS ts FROM VALUES
        (1, 5, 'ab', '2024-01-01'), (1, 0, 'xyz', '2024-01-02'), (2, -1, NULL, NULL),
        (NULL, NULL, 'abc', '2024-01-03'), (NULL, 9, '', '2024-01-03') AS t(id, n, name, ts)"""
    )


def outcome(results):
    return {r.check_name: (r.total_rows, r.failed_rows, r.passed) for r in results.collect()}


def test_row_checks(df):
    checks = [
        Check("not_null", columns=("id", "name")),
        Check("positive", columns=("n",)),
        Check("range", column="n", min_value=0, max_value=5),
        Check("pattern", column="name", pattern="b"),
        Check("completeness", required_columns=("id", "n"), name="complete"),
    ]
    assert outcome(q.run_checks(df, checks)) == {
        "not_null:id": (5, 2, False),
        "not_null:name": (5, 1, False),
        "positive:n": (5, 2, False),
        "range:n": (5, 2, False),
        "pattern:name": (5, 2, False),
        "complete": (5, 2, False),
    }


def test_unique_skips_null_keys(df):
    checks = [Check("unique", columns=("id",)), Check("unique", columns=("id", "n"))]
    assert outcome(q.run_checks(df, checks)) == {
        "unique:id": (5, 1, False),
        "unique:id,n": (5, 0, True),
    }


def test_one_scan_without_shuffling_rows(spark, df, folder):
    df.write.parquet(folder)
    checks = [Check("not_null", columns=("id",)), Check("volume", min_rows=1)]
    plan = q.run_checks(spark.read.parquet(folder), checks)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<id:int>" in text


def test_table_checks(df):
    as_of = datetime(2024, 1, 3, 12)
    checks = [
        Check("freshness", column="ts", max_age_hours=12, name="edge"),
        Check("freshness", column="ts", max_age_hours=11, name="late"),
        Check("volume", min_rows=5, max_rows=5, name="exact"),
        Check("volume", min_rows=6, name="few"),
    ]
    assert outcome(q.run_checks(df, checks, as_of)) == {
        "edge": (5, 0, True),
        "late": (5, 1, False),
        "exact": (5, 0, True),
        "few": (5, 1, False),
    }
    with pytest.raises(ValueError, match="as_of"):
        q.run_checks(df, checks)


def test_empty_table(df):
    checks = [
        Check("not_null", columns=("id",)),
        Check("unique", columns=("id",)),
        Check("freshness", column="ts", max_age_hours=12),
        Check("volume", max_rows=3),
    ]
    got = outcome(q.run_checks(df.limit(0), checks, datetime(2024, 1, 1)))
    assert got == {
        "not_null:id": (0, 0, True),
        "unique:id": (0, 0, True),
        "freshness:ts": (0, 1, False),
        "volume": (0, 0, True),
    }


def test_missing_columns(df):
    with pytest.raises(ValueError, match="not found"):
        q.run_checks(df, [Check("not_null", column="sku")])
    lost = [Check("completeness", required_columns=("sku",))]
    assert outcome(q.run_checks(df, lost)) == {"completeness:sku": (5, 5, False)}
    assert outcome(q.run_checks(df.limit(0), lost)) == {"completeness:sku": (0, 0, False)}


def test_schema_check(df):
    contract = [Column("ID", "integer"), Column("n", "float"), Column("sku", "string")]
    got = outcome(q.run_checks(df, [Check("schema")], contract=contract))
    failed = {name for name, (_, _, passed) in got.items() if not passed}
    assert failed == {"schema:ID", "schema:n", "schema:sku", "schema:name", "schema:ts"}


def test_gate_and_score(df):
    results = q.run_checks(
        df,
        [
            Check("not_null", columns=("id",), severity="warning"),
            Check("volume", min_rows=100),
            Check("volume", max_rows=100, name="cap"),
        ],
    )
    with pytest.raises(q.QualityError, match="volume") as error:
        q.gate(results)
    assert [r.check_name for r in error.value.failures] == ["volume"]
    warned = q.gate(results, fail_on_error=False)
    assert sorted(r.check_name for r in warned) == ["not_null:id", "volume"]
    assert q.quality_score(results).first().quality_score == pytest.approx(1 / 3)
    actions = {r.check_name: r.action for r in q.gate_action(results).collect()}
    assert actions == {"not_null:id": "warn", "volume": "abort", "cap": "pass"}


def test_tagged_rows_split_whole(df):
    checks = [Check("not_null", column="id"), Check("positive", column="n"), Check("volume", min_rows=1)]
    good, failed = q.split_tagged(q.tag_rows(df, checks))
    assert good.columns == df.columns
    assert good.count() + failed.count() == df.count()
    tags = sorted(map(tuple, (r.failed_checks for r in failed.collect())))
    assert tags == [("not_null:id",), ("not_null:id",), ("positive:n",), ("positive:n",)]
    assert q.tag_rows(df, []).filter(F.size("failed_checks") > 0).count() == 0


def test_names_must_differ(df):
    with pytest.raises(ValueError, match="distinct names"):
        q.run_checks(df, [Check("positive", column="n"), Check("positive", column="n")])
