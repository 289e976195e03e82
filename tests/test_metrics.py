"""Cell-level metrics: closed forms from FIXTURES."""

import math

from clausework.operators import metrics as M


def _metrics(spark, tp, fp, fn, tn):
    conf = spark.createDataFrame([(tp, fp, fn, tn)], "tp long, fp long, fn long, tn long")
    return M.macro_metrics(conf).first()


def test_macro_example(spark):
    m = _metrics(spark, 3, 1, 1, 4)
    assert math.isclose(m["accuracy"], 7 / 9)
    for k in ("precision", "recall", "f1"):
        assert math.isclose(m[k], 0.775)


def test_only_class_zero_present(spark):
    m = _metrics(spark, 0, 0, 0, 10)
    assert m["accuracy"] == 1.0 and m["precision"] == 1.0 and m["recall"] == 1.0 and m["f1"] == 1.0


def test_no_predicted_positives(spark):
    m = _metrics(spark, 0, 0, 2, 8)
    # class 1: precision undefined -> 0, recall 0; class 0: P=8/10, R=1
    assert math.isclose(m["precision"], (0 + 0.8) / 2)
    assert math.isclose(m["recall"], (0 + 1.0) / 2)


def test_confusion_and_loss(spark):
    cells = spark.createDataFrame([(1, 0, 0, 2.0, 1), (1, 0, 1, -2.0, 1), (1, 0, 2, 0.0, 0), (1, 0, 3, -1.0, 0)],
                                  "row_id long, window int, label_id int, logit double, y int")
    c = M.confusion(cells).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (1, 1, 1, 1)   # logit 0 -> p = 0.5 -> predicted
    loss = M.bce_loss(cells).first()["loss"]
    def bce(z, y):
        return max(z, 0) - z * y + math.log1p(math.exp(-abs(z)))
    assert math.isclose(loss, (bce(2, 1) + bce(-2, 1) + bce(0, 0) + bce(-1, 0)) / 4)
