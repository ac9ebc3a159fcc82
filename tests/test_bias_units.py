"""Hand-worked post-training metrics."""

from retailcast.operators import bias as B


def _df(spark):
    # facet a (0): TP=2 FP=1 TN=3 FN=1 ; facet d (1): TP=1 FP=2 TN=1 FN=2
    rows = []
    for facet, tp, fp, tn, fn in ((0, 2, 1, 3, 1), (1, 1, 2, 1, 2)):
        rows += [(facet, 1, 200.0, 150)] * tp + [(facet, 0, 200.0, 50)] * fp
        rows += [(facet, 0, 10.0, 50)] * tn + [(facet, 1, 10.0, 150)] * fn
    return spark.createDataFrame(rows, "is_weekend int, high_demand int, prediction double, units_sold long")


def test_extended(spark):
    r = B.posttraining_extended(_df(spark)).first()
    qa, qd = 3 / 7, 3 / 6
    assert abs(r["DPPL"] - (qa - qd)) < 1e-12
    assert abs(r["DI"] - qd / qa) < 1e-12
    assert abs(r["DCAcc"] - (3 / 3 - 3 / 3)) < 1e-12
    assert abs(r["DCR"] - (3 / 3 - 4 / 4)) < 1e-12
    assert abs(r["RD"] - (2 / 3 - 1 / 3)) < 1e-12
    assert abs(r["DAR"] - (2 / 3 - 1 / 3)) < 1e-12
    assert abs(r["DRR"] - (1 / 3 - 3 / 4)) < 1e-12
    assert abs(r["AD"] - (5 / 7 - 2 / 6)) < 1e-12
    assert abs(r["TE"] - (2 / 2 - 1 / 1)) < 1e-12


def test_cddpl(spark):
    df = spark.createDataFrame(
        [("g1", 1, 1), ("g1", 1, 0), ("g1", 0, 1), ("g2", 1, 0), ("g2", 0, 0)],
        "grp string, is_weekend int, pred_bin int")
    r = B.cddpl(df, group="grp").first()["CDDPL"]
    # g1: neg=1 (d share 1), pos=2 (d share 1/2) -> DD=0.5 ; g2: neg=2 (d 1/2), pos=0 -> DD=0.5
    assert abs(r - (3 * 0.5 + 2 * 0.5) / 5) < 1e-12


def test_one_vs_rest_three_values(spark):
    rows = [(0, 1, 200.0, 150), (0, 0, 10.0, 50), (1, 1, 10.0, 150), (1, 0, 10.0, 50), (2, 0, 200.0, 50),
            (2, 0, 10.0, 50)]
    df = spark.createDataFrame(rows, "is_weekend int, high_demand int, prediction double, units_sold long")
    got = {r["facet_value"]: r for r in B.posttraining_one_vs_rest(df).collect()}
    assert set(got) == {0.0, 1.0, 2.0}
    # value 2: label rate 0 vs rest 2/4 ; prediction rate 1/2 vs rest 1/4
    assert abs(got[2.0]["DPL_labels"] - 0.5) < 1e-12 and abs(got[2.0]["DPPL_predicted"] - (0.25 - 0.5)) < 1e-12
    assert (got[2.0]["n_d"], got[2.0]["n_a"]) == (2, 4)
    assert B.excluded_rows(df).first()["n_excluded"] == 0
