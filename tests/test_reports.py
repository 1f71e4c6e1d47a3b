"""Reports of hand-made splits, line by line."""

from parcelflow.operators import reports

TILE = "tile_id long, tile_name string, source string, split string, xmin double, ymin double, xmax double, ymax double, is_negative int"


def tile(k, name, source, split, x, negative=0):
    return (k, name, source, split, x, 0.0, x + 100.0, 100.0, negative)


def text(report):
    return [r.line for r in sorted(report.collect(), key=lambda r: (r.section, r.item))]


def test_leakage_names_what_two_sets_share(spark):
    bad = [tile(1, "a", "s1", "train", 0.0), tile(2, "a", "s1", "val", 50.0), tile(3, "c", "s2", "val", 900.0), tile(4, "d", "s3", "DROPPED_BUFFER", 0.0)]
    assert text(reports.leakage(spark.createDataFrame(bad, TILE))) == [
        "train source_tif: 1", "  s1", "val source_tif: 2", "  s1", "  s2", "shared source_tif: 1", "  s1", "dup tile_name count: 1", "val tiles overlapping train: 1/2", "DATA LEAKAGE RISK: YES"]
    good = [tile(1, "a", "s1", "train", 0.0), tile(2, "b", "s2", "val", 500.0)]
    assert text(reports.leakage(spark.createDataFrame(good, TILE)))[-3:] == ["dup tile_name count: 0", "val tiles overlapping train: 0/1", "DATA LEAKAGE RISK: NO"]
    assert text(reports.leakage(spark.createDataFrame([], TILE))) == ["train source_tif: 0", "val source_tif: 0", "shared source_tif: 0", "dup tile_name count: 0", "val tiles overlapping train: 0/0", "DATA LEAKAGE RISK: NO"]


def test_split_report_says_pass_and_fail(spark):
    rows = [tile(1, "a", "s1", "train", 0.0), tile(2, "b", "s1", "test", 50.0, 1), tile(3, "c", "s2", "DROPPED_BUFFER", 60.0)]
    assert text(reports.splitting(spark.createDataFrame(rows, TILE))) == [
        "  train: rows    1 | positives    1 | negatives    0", "  val  : rows    0 | positives    0 | negatives    0", "  test : rows    1 | positives    0 | negatives    1",
        "  buffer: 1", "  s1: test,train (2)", "  train and val share: 0", "  train and test share: 1", "  val and test share: 0", "  overlapping pairs across sets: 1", "  FAIL"]
    assert text(reports.splitting(spark.createDataFrame(rows[:1], TILE)))[-1] == "  PASS"


def test_evaluation_without_ground_truth(spark):
    s = spark.createDataFrame([(0.5, 0, 3, 0, 0.0, 0.0, 0.0), (0.65, 2, 1, 2, 2 / 3, 0.5, 4 / 7)], "threshold double, tp long, fp long, fn long, precision double, recall double, f1 double")
    got = {(r.threshold, r.line_no): r.line for r in reports.evaluation(s).collect()}
    assert got[0.5, 1] == "no ground truth" and (0.5, 2) not in got
    assert [got[0.65, k] for k in range(5)] == ["conf >= 0.65", "TP / FP / FN: 2 / 1 / 2", "  Precision : 0.667", "  Recall    : 0.500", "  F1        : 0.571"]
