"""A key holding a third of all rows: results whole, work split."""

from pyspark.sql import functions as F

from pomelo.operators import features as FE
from pomelo.operators import tokens as TK


def _skewed_behavior(spark):
    # 3000 rows for one hot entity (copies with different item sets) and
    # 6000 rows spread over 2000 other entities
    hot = [("hot", " ".join(f"11{(i * 7 + j) % 300}:1" for j in range(5))) for i in range(3000)]
    cold = [(f"e{i % 2000}", f"11{i % 300}:1 11{(i + 1) % 300}:2") for i in range(6000)]
    return spark.createDataFrame(hot + cold, "entity_id string, feature string")


def test_hot_entity_is_split_and_result_is_whole(spark):
    beh = _skewed_behavior(spark)
    dim = spark.createDataFrame([(str(i), f"n{i}", 1000 - i) for i in range(300)],
                                "item_id string, item_name string, install_num bigint")
    tokens = TK.explode_behavior(beh)
    topk = FE.top_k_items(FE.item_codes(dim), 300)
    pairs = FE.topk_pairs(tokens, topk, 300)
    # the de-duplicating shuffle hashes (entity, code): the hot entity's
    # pairs land in several partitions instead of one task (AQE would merge
    # this tiny shuffle into one partition, so coalescing is off for the check)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        parts = (pairs.select("entity_id", F.spark_partition_id().alias("p"))
                 .where(F.col("entity_id") == "hot").select("p").distinct().count())
    finally:
        spark.conf.set(key, old)
    assert parts > 1
    idx = FE.number_items(FE.active_items(topk, pairs, 300))
    feats = {r.entity_id: r.feature for r in FE.feature_rows(pairs, idx, 300).collect()}
    # brute force on the driver for this small fixture
    codes = {int(r.item_code[2:]) for r in idx.collect()}
    pos = {r.item_code: r.column_index for r in idx.collect()}
    hot_codes = sorted({pos[f"11{(i * 7 + j) % 300}"] for i in range(3000) for j in range(5)})
    assert feats["hot"] == " ".join(f"{c}:1" for c in hot_codes)
    assert len(feats) == 2001 and len(codes) == 300


def test_copies_do_not_multiply_join_rows(spark):
    from pomelo.operators import compare as CP
    from pomelo.operators import labels as LB
    # 200 copies of one stored prediction in each snapshot: one changed row
    preds = spark.createDataFrame([("a", "pos", "N")] * 200 + [("a", "neg", "O")] * 200,
                                  "entity_id string, class_name string, stat_date string")
    assert CP.snapshot_changes(preds, "N", "O").count() == 1
    # 100 copies of one user row with 50 devices: 50 label rows, not 5000
    users = spark.createDataFrame([(1, 2, "D")] * 100 + [(1, 1, "C")], "user_id bigint, label_code int, stat_date string")
    dev = spark.createDataFrame([(f"d{i}", 1, "D") for i in range(50)],
                                "entity_id string, user_id bigint, stat_date string")
    rows = LB.user_device_labels(users, dev, "D").collect()
    assert len(rows) == 50 and {r.label for r in rows} == {1}      # the code of another day does not count
    assert LB.two_branch_labels(users, dev, "D").count() == 50


def test_null_classes_and_null_items_are_kept_or_dropped_as_they_should(spark):
    from pomelo.operators import compare as CP
    preds = spark.createDataFrame([("a", None, "N"), ("a", "neg", "O"), ("b", None, "N"), ("b", None, "O"), ("c", "pos", "N"),
                                   ("c", None, "O"), ("d", "pos", "N"), ("d", "pos", "O")],
                                  "entity_id string, class_name string, stat_date string")
    assert sorted(map(tuple, CP.snapshot_changes(preds, "N", "O").collect())) == [("a", None, "neg"), ("c", "pos", None)]
    dim = spark.createDataFrame([(None, "x", 9), (" \t", "y", 8), ("1", "z", 7), ("2", "w", 6)],
                                "item_id string, item_name string, install_num bigint")
    assert [r.item_code for r in FE.top_k_items(FE.item_codes(dim), 2).collect()] == ["111", "112"]
