"""Content checks that read only the columns that may be empty."""

from arrivo.operators import quality


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def profile(spark, sql, path, probe=None):
    spark.sql(sql).repartition(3).write.parquet(path)
    return quality.table_profile("t", spark.read.parquet(path))


def test_only_unproven_columns_are_read(spark, tmp_path):
    p = profile(spark, "SELECT id AS a, CAST(NULL AS string) AS b, 'x' AS c, named_struct('x', 1, 'y', CAST(NULL AS int)) AS d, "
                "CAST(NULL AS array<int>) AS e FROM range(5000)", str(tmp_path / "t"))
    assert "ReadSchema: struct<b:string,e:array<int>>" in scans(p)
    r = p.first()
    assert (r["rows"], r["columns"], r.empty_columns, r.numeric_columns) == (5000, 5, 2, 1)


def test_no_column_is_read_when_all_are_proven(spark, sf):
    p = quality.table_profile("documents", spark.read.parquet(f"{sf}/documents.parquet"))
    assert "ReadSchema: struct<>" in scans(p)


def test_value_that_only_a_late_row_holds(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id, IF(id = 9000, 'v', NULL) AS late, CAST(NULL AS int) AS none FROM range(10000)").coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert quality.unproven_columns(df) == ["late", "none"]
    assert quality.table_profile("t", df).first().empty_columns == 1


def test_empty_table_and_odd_names(spark, tmp_path):
    p = profile(spark, "SELECT id AS `a.b`, id AS `turista x` FROM range(0)", str(tmp_path / "t")).first()
    assert (p["rows"], p.empty_columns, p.keyword_columns) == (0, 2, 1)
