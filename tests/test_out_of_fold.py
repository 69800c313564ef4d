"""Out-of-fold means and memos that rest on scratch tables."""

import pandas as pd

from arrivo import session
from arrivo.operators import model as MO

ROWS = [("a", 0, 1.0), ("a", 0, 3.0), ("a", 1, 5.0), ("a", 2, 100.0), (None, 0, 7.0), (None, 1, 9.0), ("b", 2, 4.0), ("b", 2, 4.0)]


def test_means_of_the_other_folds(spark):
    train = spark.createDataFrame(ROWS, "k string, fold int, turistas double")
    got = sorted(((r.k or "", r.fold, r.turistas, round(r.prediction, 9)) for r in MO.out_of_fold_mean(train, ["k"]).collect()))
    df = pd.DataFrame(ROWS, columns=["k", "fold", "turistas"]).fillna({"k": ""})
    want = []
    for r in df.itertuples():
        rest = df[df.fold != r.fold]
        same = rest[rest.k == r.k].turistas
        want.append((r.k, r.fold, r.turistas, round(same.mean() if len(same) else rest.turistas.mean(), 9)))
    assert got == sorted(want)


def test_without_keys_and_with_one_fold(spark):
    train = spark.createDataFrame(ROWS, "k string, fold int, turistas double")
    got = {(r.fold, round(r.prediction, 6)) for r in MO.out_of_fold_mean(train, []).collect()}
    assert got == {(0, 24.4), (1, round(119 / 6, 6)), (2, 5.0)}
    alone = MO.out_of_fold_mean(train.where("fold = 0"), ["k"]).collect()
    assert len(alone) == 3 and all(r.prediction is None for r in alone)
    assert MO.out_of_fold_mean(train.limit(0), ["k"]).count() == 0


def test_memos_go_with_the_scratch_tables(spark, monkeypatch):
    app = spark.sparkContext.applicationId
    kept = session.memo()
    kept[app, "t"], kept["other", "t"] = 1, 2
    monkeypatch.setattr(session, "_SCRATCH", {app: [session.scratch_path(spark, "memo")]})
    monkeypatch.setattr(session, "_MEMOS", [kept])
    session.remove_scratch(spark)
    assert kept == {("other", "t"): 2}
