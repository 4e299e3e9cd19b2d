from pyspark.sql import functions as F

from millrace.functions import columns as fc
from millrace.operators.masking import mask_columns, restrict_rows
from fixtures import stores


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def test_composite_key(spark):
    assert one(spark, fc.composite_key("a", "b"), a="SYD01", b=7) == "SYD01-7"
    df = spark.createDataFrame([("SYD01", None)], "a string, b int")
    assert df.select(fc.composite_key("a", "b")).first()[0] is None


def test_row_hash_has_no_collisions_by_null_or_separator(spark):
    rows = [("X", "b", None), ("X", None, "b"), (None, "X", "b"), ("X||b", "", None), ("X", "b||", "")]
    df = fc.with_row_hash(spark.createDataFrame(rows, "a string, b string, c string"))
    hashes = [r["row_hash"] for r in df.collect()]
    assert len(set(hashes)) == len(rows) and None not in hashes


def test_classify(spark):
    groups = {"AUS": ["SYD01", "MEL01"], "NZL": ["AKL01"]}
    df = spark.createDataFrame([("SYD01",), ("AKL01",), ("LON01",), (None,)], "id string")
    got = [r[0] for r in df.select(fc.classify("id", groups)).collect()]
    assert got == ["AUS", "NZL", None, None]


def test_epoch_and_text(spark):
    assert one(spark, fc.epoch_to_text("s"), s=1640995200) == "2022-01-01 00:00:00"
    assert one(spark, fc.epoch_to_text("s", "yyyy-MM-dd"), s=1640995200) == "2022-01-01"
    assert one(spark, fc.text_to_epoch("t"), t="2022-01-01 00:00:00") == 1640995200
    assert one(spark, fc.text_to_epoch("t"), t="junk") is None
    assert one(spark, fc.month_of("t"), t="2022-01-31 23:59:59") == "2022-01"


def test_json_path(spark):
    assert one(spark, fc.json_path("j", "a.b"), j='{"a":{"b":5}}') == "5"
    assert one(spark, fc.json_path("j", "a.b"), j="junk") is None


def test_masking(spark):
    df = stores(spark)
    hidden = mask_columns(df, ["email"], groups=["staff"])
    assert {r["email"] for r in hidden.collect()} == {"REDACTED"}
    assert hidden.columns == df.columns
    assert hidden.select("phone_number").distinct().count() == 9
    seen = mask_columns(df, ["email"], groups=["admins"])
    assert "REDACTED" not in {r["email"] for r in seen.collect()}
    assert [r["id"] for r in restrict_rows(df, "id = 'SYD01'", []).collect()] == ["SYD01"]
    assert restrict_rows(df, "id = 'SYD01'", ["admins"]).count() == 9


def test_masked_column_is_not_read(spark, tmp_path):
    stores(spark).write.parquet(str(tmp_path / "s"))
    df = mask_columns(spark.read.parquet(str(tmp_path / "s")), ["email"], []).select("id", "email")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan
