"""Literal edge frames, one per trap listed in FIXTURES.md §3."""

from pyspark.sql import functions as F

from pomelo import params as P
from pomelo.functions.dates import normalise_run_date, normalise_run_date_py
from pomelo.functions.recode import age_bucket, birth_year
from pomelo.operators import features as FE
from pomelo.operators import labels as LB
from pomelo.operators import merge as MG
from pomelo.operators import metrics as MT
from pomelo.operators import sets as ST
from pomelo.operators import tokens as TK
from pomelo.operators.model import score_with_weights

CL = P.ClassNames()


def beh(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, feature string")


def explode(spark, feature):
    return sorted(tuple(r) for r in TK.explode_behavior(beh(spark, [("e", feature)]))
                  .select("item_code", "value").collect())


def test_trailing_colon_kept(spark):
    assert explode(spark, "a:1:") == [("a", 1.0)]


def test_no_value_dropped(spark):
    for f in ("a:", "a", ""):
        assert explode(spark, f) == []


def test_empty_code_kept(spark):
    assert explode(spark, ":5") == [("", 5.0)]


def test_three_parts_dropped(spark):
    assert explode(spark, "x:y:z") == []


def test_double_space_two_tokens(spark):
    assert explode(spark, "a:1  b:1") == [("a", 1.0), ("b", 1.0)]


def test_java_whitespace_trimmed(spark):
    assert explode(spark, "\t a:1 \n") == [("a", 1.0)]


def test_null_entity_or_feature_dropped(spark):
    df = beh(spark, [(None, "a:1"), ("e", None), ("  ", "a:1")])
    assert TK.explode_behavior(df).count() == 0


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, item_name string, install_num bigint")


def test_topk_tie_larger_code_wins(spark):
    items = FE.item_codes(_items(spark, [("1", "x", 5), ("2", "x", 5), ("3", "y", 9)]))
    got = sorted(r.item_code for r in FE.top_k_items(items, 2).collect())
    assert got == ["112", "113"]


def test_topk_unused_item_takes_a_slot(spark):
    items = FE.item_codes(_items(spark, [("1", "a", 9), ("2", "b", 8), ("3", "c", 7)]))
    tokens = TK.explode_behavior(beh(spark, [("e", "112:1 113:1")]))
    idx = FE.item_index(_items(spark, [("1", "a", 9), ("2", "b", 8), ("3", "c", 7)]), tokens, 2)
    assert [(r.item_code, r.column_index) for r in idx.collect()] == [("112", 0)]
    assert items.count() == 3


def test_repeated_item_one_index(spark):
    dim = _items(spark, [("1", "a", 9)])
    tokens = TK.explode_behavior(beh(spark, [("e", "111:1 111:2")]))
    idx = FE.item_index(dim, tokens, 10)
    pairs = FE.topk_pairs(tokens, FE.top_k_items(FE.item_codes(dim), 10), 10)
    assert FE.feature_rows(pairs, idx, 10).collect()[0].feature == "0:1"


def test_feature_indices_sorted_numerically(spark):
    dim = _items(spark, [(str(i), f"n{i}", 100 - i) for i in range(12)])
    toks = " ".join(f"11{i}:1" for i in (11, 2, 10, 0))
    tokens = TK.explode_behavior(beh(spark, [("e", toks)]))
    idx = FE.item_index(dim, tokens, 12)
    pairs = FE.topk_pairs(tokens, FE.top_k_items(FE.item_codes(dim), 12), 12)
    assert FE.feature_rows(pairs, idx, 12).collect()[0].feature == "0:1 1:1 2:1 3:1"


def _tagged(spark, labels, feats):
    lab = spark.createDataFrame(labels, "entity_id string, label int")
    fe = spark.createDataFrame(feats, "entity_id string, feature string")
    counts = ST.tag_counts(lab, fe)
    return counts, ST.tagged_sets(counts, fe)


def test_duplicate_labels_neither_train_nor_predict(spark):
    counts, t = _tagged(spark, [("e", 1), ("e", 0)], [("e", "0:1")])
    assert ST.train_rows(t).count() == 0 and ST.predict_rows(t).count() == 0
    assert ST.cardinality_report(counts, t).collect()[0].n_multi_label == 1


def test_label_without_features_neither(spark):
    counts, t = _tagged(spark, [("e", 1)], [("f", "0:1")])
    assert [r.entity_id for r in ST.train_rows(t).collect()] == []
    assert [r.entity_id for r in ST.predict_rows(t).collect()] == ["f"]
    assert ST.cardinality_report(counts, t).collect()[0].n_label_no_feature == 1


def test_empty_feature_string_dropped(spark):
    counts, t = _tagged(spark, [("e", 1)], [("e", "junk")])
    assert ST.train_rows(t).count() == 0
    assert ST.cardinality_report(counts, t).collect()[0].n_empty_feature == 1


def test_trusted_null_keeps_prediction_and_trusted_only_added(spark):
    pred = spark.createDataFrame([("a", "pos"), ("b", "neg")], "entity_id string, class_name string")
    trusted = spark.createDataFrame([("a", None), ("b", "pos"), ("c", "neg"), ("b", "neither"), ("a", "neither"), ("d", "neg"), ("d", "pos")],
                                    "entity_id string, class_name string")
    got = {r.entity_id: r.class_name for r in MG.override_merge(pred, trusted, P.ClassNames()).collect()}
    assert got == {"a": "pos", "b": "pos", "c": "neg", "d": "neg"}


def test_score_equal_to_threshold_is_class_0(spark):
    feats = spark.createDataFrame([("e", "0:1 1:1")], "entity_id string, feature string")
    w = spark.createDataFrame([(0, 0.25), (1, -0.25)], "column_index int, weight double")
    r = score_with_weights(feats, w, 0.5).collect()[0]
    assert r.score == 0.5 and r.prediction == 0


def test_f1_tie_goes_to_higher_threshold(spark):
    # P = 2.  t=0.9: tp=1 pp=1 -> 2/3 ; t=0.6: tp=2 pp=4 -> 4/6 = 2/3 (exact tie)
    rows = [(0.9, 1), (0.8, 0), (0.7, 0), (0.6, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    curve = MT.f1_by_threshold(df, ranges=3)
    f = {round(r.threshold, 6): (r.tp, r.pp, r.f1) for r in curve.collect()}
    assert f[0.9] == (1, 1, 2 / 3) and f[0.6] == (2, 4, 2 / 3) and f[0.1] == (2, 5, 4 / 7)
    best = MT.best_threshold(curve).collect()[0]
    assert (best.threshold, best.f1) == (0.9, 2 / 3)


def test_zero_denominator_ratio_is_null(spark):
    df = spark.createDataFrame([(1,), (1,)], "label int")
    r = MT.class_balance(df).collect()[0]
    assert r.n_pos == 2 and r.n_neg == 0 and r.ratio is None


def test_empty_input_no_error(spark):
    empty = beh(spark, [])
    assert TK.explode_behavior(empty).count() == 0
    assert MT.class_balance(spark.createDataFrame([], "label int")).collect()[0].n == 0


def test_lenient_date(spark):
    df = spark.createDataFrame([("20170231",), ("20171300",), ("20170100",), ("20171028",)], "d string")
    got = [r.x for r in df.select(normalise_run_date("d").alias("x")).collect()]
    assert got == ["20170303", "20171231", "20161231", "20171028"]
    assert [normalise_run_date_py(x) for x in ("20170231", "20171300", "20170100")] == got[:3]


def test_age_edges(spark):
    df = spark.createDataFrame([(a,) for a in (6, 7, 14, 15, 76, 77)], "age int")
    assert [r.b for r in df.select(age_bucket("age").alias("b")).collect()] == [0, 1, 1, 2, 5, 0]


def test_code_length_birth_year(spark):
    df = spark.createDataFrame([("111111850101",), ("11111119850101",), ("111111198501011",)], "c string")
    assert [r.y for r in df.select(birth_year("c").alias("y")).collect()] == [1985, 1985, 0]


def test_decode_filters_out_of_range_and_regex(spark):
    coded = spark.createDataFrame(
        [(1, "11111119850101", "3"), (2, "X12", "4"), (3, "111111198501011", "5"), (4, "11111119850101", "3")],
        "user_id bigint, first_code string, second_code string")
    got = [tuple(r) for r in LB.decode_attributes(coded, 2017, CL).collect()]
    assert got == [(1, 32, "3.0", "pos")]


def test_first_per_key_is_min(spark):
    df = spark.createDataFrame([("e", 1), ("e", 0), ("f", 1)], "entity_id string, label int")
    assert sorted(tuple(r) for r in LB.first_per_key(df).collect()) == [("e", 0), ("f", 1)]


def test_changed_item_share_counts(spark):
    from pomelo.operators import compare as CP
    preds = spark.createDataFrame(
        [("a", "neg", "N"), ("a", "pos", "O"), ("b", "neg", "N"), ("b", "pos", "O"),
         ("c", "pos", "N"), ("c", "neg", "O"), ("d", "neg", "N"), ("d", "neg", "O")],
        "entity_id string, class_name string, stat_date string")
    ch = CP.snapshot_changes(preds, "N", "O")
    assert sorted(r.entity_id for r in ch.collect()) == ["a", "b", "c"]
    items = spark.createDataFrame([("a", "7"), ("a", "7"), ("b", "8"), ("c", "7")],
                                  "entity_id string, item_id string")
    lst = spark.createDataFrame([("7",)], "item_id string")
    r = CP.changed_item_share(ch, items, items, lst, "neg").collect()[0]
    # new side: a, b changed to neg; a holds item 7 (listed twice)
    assert (r.n_changed_new, r.n_hit_new, r.n_hit_rows_new, r.share_new) == (2, 1, 2, 0.5)
    # old side: c was neg; c holds item 7
    assert (r.n_changed_old, r.n_hit_old, r.n_hit_rows_old, r.share_old) == (1, 1, 1, 1.0)


def test_f1_curve_empty_and_single_score(spark):
    empty = spark.createDataFrame([], "score double, label int")
    assert MT.f1_by_threshold(empty).count() == 0
    one = spark.createDataFrame([(0.3, 1), (0.3, 0)], "score double, label int")
    r = MT.f1_by_threshold(one, ranges=4).collect()
    assert [(x.threshold, x.tp, x.pp, x.f1) for x in r] == [(0.3, 1, 2, 2 / 3)]
