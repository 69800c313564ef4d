"""Encoded features in long form."""

from arrivo.operators import features as FE


def test_encoded_long(spark):
    train = spark.createDataFrame([(1, "a", None, 1.0), (2, None, "p", 3.0), (3, "b", "q", None)], "k int, cat string, more string, x double")
    pre = FE.preprocessing_pipeline(["x"], ["cat", "more"]).fit(train)
    assert FE.feature_names(pre, ["x"], ["cat", "more"]) == ["x", "cat=a", "cat=b", "cat=missing", "more=missing", "more=p", "more=q"]
    rows = spark.createDataFrame([(4, "b", "p", 2.0), (5, "z", None, 3.0)], "k int, cat string, more string, x double")
    got = {(r.k, r.feature): round(r.value, 6) for r in FE.encoded_long(pre, rows, ["x"], ["cat", "more"], ["k"]).collect()}
    # the missing number is filled with 2, so mean 2 and deviation sqrt(2 / 3)
    assert got == {(4, "x"): 0.0, (4, "cat=b"): 1.0, (4, "more=p"): 1.0, (5, "x"): 1.224745, (5, "more=missing"): 1.0}
    width = pre.transform(rows).select("features").first()[0].size
    assert width == 7


def test_no_rows_and_no_categories(spark):
    train = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k int, x double")
    pre = FE.preprocessing_pipeline(["x"], []).fit(train)
    assert FE.feature_names(pre, ["x"], []) == ["x"]
    assert [r.value for r in FE.encoded_long(pre, train, ["x"], [], ["k"]).collect()] == [0.0, 0.0]
    assert FE.encoded_long(pre, train.limit(0), ["x"], [], ["k"]).count() == 0
