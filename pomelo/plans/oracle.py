"""ANSI-SQL (DuckDB) statements equivalent to the registered queries.

Statements are built from named CTE pieces; each piece lists the pieces it
reads, and ``statement()`` emits them in dependency order.  A
mismatch points at one step.
"""

from __future__ import annotations

from pomelo.params import QUERY_PARAMS as QP
from pomelo.sources.fixtures import FIXTURE_SQL

K = QP.top_k
D = QP.run_date
SEED = QP.split_seed
POS, NEG = QP.classes.positive, QP.classes.negative

PIECES: dict[str, tuple[str, tuple[str, ...]]] = {}


def piece(name: str, sql: str, *deps: str) -> None:
    PIECES[name] = (sql, deps)


for _n, _s in FIXTURE_SQL.items():
    piece(_n, _s)

# --- feature build ------------------------------------------------------------
piece("beh_pairs", f"""
    SELECT trim(entity_id) AS entity_id, string_split(rtrim(trim(token), ':'), ':') AS parts
    FROM behavior_tokens
    WHERE stat_date = '{D}' AND entity_id IS NOT NULL AND length(trim(entity_id)) > 0""", "behavior_tokens")
piece("beh_explode", """
    SELECT entity_id, trim(parts[1]) AS item_code, CAST(trim(parts[2]) AS DOUBLE) AS value
    FROM beh_pairs WHERE len(parts) = 2""", "beh_pairs")
piece("beh_items", """
    SELECT entity_id, substr(trim(parts[1]), 3) AS item_id
    FROM beh_pairs WHERE len(parts) = 2""", "beh_pairs")
piece("items", f"""
    SELECT '11' || trim(replace(item_id, chr(10), '')) AS item_code,
           trim(replace(item_name, chr(10), '')) AS item_name,
           CAST(install_num AS BIGINT) AS install_num
    FROM item_dim WHERE stat_date = '{D}' AND item_id IS NOT NULL
      AND regexp_replace(item_id, '[\\x00-\\x20]', '', 'g') <> ''""", "item_dim")
piece("topk", f"""
    SELECT * FROM items ORDER BY install_num DESC, item_code DESC, item_name DESC LIMIT {K}""", "items")
piece("active", """
    SELECT * FROM topk WHERE item_code IN (SELECT item_code FROM beh_explode)""", "topk", "beh_explode")
piece("item_index", """
    SELECT item_code, item_name, install_num,
           CAST(row_number() OVER (ORDER BY install_num DESC, item_code DESC, item_name DESC) - 1 AS BIGINT)
             AS column_index
    FROM active""", "active")
piece("features", """
    SELECT entity_id, string_agg(CAST(column_index AS VARCHAR) || ':1', ' ' ORDER BY column_index) AS feature
    FROM (SELECT DISTINCT b.entity_id, i.column_index
          FROM beh_explode b JOIN item_index i ON b.item_code = i.item_code) t
    GROUP BY entity_id""", "beh_explode", "item_index")
piece("feature_long", """
    SELECT entity_id, CAST(trim(p[1]) AS INTEGER) AS column_index, CAST(trim(p[2]) AS DOUBLE) AS value
    FROM (SELECT entity_id, string_split(rtrim(trim(tok), ':'), ':') AS p
          FROM (SELECT entity_id, unnest(string_split(trim(feature), ' ')) AS tok FROM features) x) y
    WHERE len(p) = 2""", "features")


# --- labels ---------------------------------------------------------------------
LD, AD = QP.label_date, QP.agreement_date
piece("labels_raw", f"""
    SELECT d.entity_id, CASE WHEN CAST(u.label_code AS INTEGER) = 2 THEN 1 ELSE 0 END AS label
    FROM (SELECT DISTINCT user_id, label_code FROM users WHERE label_code IN (1, 2) AND stat_date = '{LD}') u
    JOIN device_user d ON u.user_id = d.user_id
    WHERE d.stat_date = '{LD}'""", "users", "device_user")
piece("known_labels", "SELECT entity_id, MIN(label) AS label FROM labels_raw GROUP BY entity_id", "labels_raw")
piece("two_branch", f"""
    SELECT d.entity_id, 1 AS label
    FROM (SELECT DISTINCT user_id FROM users WHERE label_code = 2 AND stat_date = '{AD}') u JOIN device_user_twin d ON u.user_id = d.user_id
    WHERE d.stat_date = '{AD}'
    UNION ALL
    SELECT d.entity_id, 0 AS label
    FROM (SELECT DISTINCT user_id FROM users WHERE label_code = 1 AND stat_date = '{AD}') u JOIN device_user_twin d ON u.user_id = d.user_id
    WHERE d.stat_date = '{AD}'""", "users", "device_user_twin")
piece("branch_labels", "SELECT entity_id, MIN(label) AS label FROM two_branch GROUP BY entity_id", "two_branch")
piece("decoded_age", f"""
    SELECT user_id, second_code,
           {QP.reference_year} - CASE WHEN length(trim(first_code)) = 14 THEN CAST(substr(trim(first_code), 7, 4) AS INTEGER)
                                WHEN length(trim(first_code)) = 12 THEN CAST(substr(trim(first_code), 7, 2) AS INTEGER) + 1900
                                ELSE 0 END AS age
    FROM (SELECT first_code, second_code, MIN(user_id) AS user_id FROM coded_ids
          WHERE regexp_matches(first_code, '^[0-9].*$') GROUP BY first_code, second_code) t""", "coded_ids")
piece("decoded", f"""
    SELECT CAST(user_id AS BIGINT) AS user_id, age,
           CAST(CAST(CASE WHEN age BETWEEN 7 AND 14 THEN 1 WHEN age BETWEEN 15 AND 22 THEN 2
                          WHEN age BETWEEN 23 AND 35 THEN 3 WHEN age BETWEEN 36 AND 45 THEN 4
                          WHEN age BETWEEN 46 AND 76 THEN 5 ELSE 0 END AS DOUBLE) AS VARCHAR) AS age_range,
           CASE WHEN CAST(trim(second_code) AS INTEGER) % 2 = 0 THEN '{NEG}' ELSE '{POS}' END AS class_name
    FROM decoded_age WHERE age >= 7 AND age <= 76""", "decoded_age")
piece("device_labels", f"""
    SELECT d.entity_id, MIN(CASE WHEN x.class_name = '{POS}' THEN 1 ELSE 0 END) AS label
    FROM decoded x JOIN device_user d ON x.user_id = d.user_id
    WHERE d.stat_date = '{AD}' GROUP BY d.entity_id""", "decoded", "device_user")

# --- sets, split, scoring ---------------------------------------------------------
NACTIVE = ("CAST(len(list_filter(string_split(trim({f}), ' '), "
           "lambda t: len(string_split(rtrim(trim(t), ':'), ':')) = 2)) AS INTEGER)")
piece("tagged", f"""
    SELECT COALESCE(l.entity_id, f.entity_id) AS entity_id,
           COALESCE(l.n_label, 0) AS n_label, COALESCE(l.label, 0.0) AS label,
           COALESCE(f.n_feature, 0) AS n_feature, COALESCE(f.feature, '') AS feature,
           {NACTIVE.format(f="COALESCE(f.feature, '')")} AS n_active
    FROM (SELECT entity_id, COUNT(*) AS n_label, SUM(CAST(label AS DOUBLE)) AS label
          FROM labels_raw WHERE entity_id IS NOT NULL AND label IS NOT NULL GROUP BY entity_id) l
    FULL OUTER JOIN (SELECT entity_id, COUNT(*) AS n_feature, MIN(feature) AS feature
                     FROM features WHERE entity_id IS NOT NULL GROUP BY entity_id) f
    ON l.entity_id = f.entity_id""", "labels_raw", "features")
piece("train", """SELECT entity_id, label, feature, n_active FROM tagged
    WHERE n_label = 1 AND n_feature = 1 AND n_active > 0""", "tagged")
piece("predict", """SELECT entity_id, label, feature, n_active FROM tagged
    WHERE n_label = 0 AND n_feature = 1 AND n_active > 0""", "tagged")
piece("split", f"""
    SELECT entity_id, label, feature,
           CASE WHEN CAST(('0x' || substr(md5(entity_id || '#{SEED}'), 1, 8)) AS BIGINT) / 4294967296.0 < {QP.train_fraction}
                THEN 'train' ELSE 'valid' END AS split
    FROM train""", "train")
piece("train_terms", """
    SELECT label, CAST(trim(p[1]) AS INTEGER) AS column_index, CAST(trim(p[2]) AS DOUBLE) AS value
    FROM (SELECT label, string_split(rtrim(trim(tok), ':'), ':') AS p
          FROM (SELECT label, unnest(string_split(trim(feature), ' ')) AS tok FROM split WHERE split = 'train') a) b
    WHERE len(p) = 2""", "split")


def fit_rows(first_loss: str) -> str:
    """Rows of an optimal fit; ``first_loss`` in terms of ``p``, the share of label 1."""
    return f"""
            SELECT 'column' AS part, CAST(column_index AS VARCHAR) AS key, COUNT(*) AS n, SUM(label * value) AS value
            FROM train_terms GROUP BY column_index
            UNION ALL SELECT 'score', entity_id, n_active, 1.0 FROM predict
            UNION ALL SELECT 'loss', 'first', 0, ROUND({first_loss}, 6)
            FROM (SELECT AVG(label) AS p FROM split WHERE split = 'train') s
            UNION ALL SELECT 'loss', 'last', 0, 0.0
            UNION ALL SELECT 'loss', 'rises', 0, 0.0"""


piece("weights", """
    SELECT column_index, CAST((column_index * 37) % 101 - 50 AS DOUBLE) / 100.0 AS weight
    FROM item_index WHERE (column_index * 37) % 101 <> 50""", "item_index")


def margins(src: str, keep: str = "") -> str:
    """Long-form margin per entity of the feature strings in ``src``."""
    k = f", {keep}" if keep else ""
    return f"""
    SELECT x.entity_id{k}, ROUND(COALESCE(SUM(w.weight * x.value), 0), 6) AS margin
    FROM (SELECT entity_id{k}, CAST(trim(p[1]) AS INTEGER) AS column_index, CAST(trim(p[2]) AS DOUBLE) AS value
          FROM (SELECT entity_id{k}, string_split(rtrim(trim(tok), ':'), ':') AS p
                FROM (SELECT entity_id{k}, unnest(string_split(trim(feature), ' ')) AS tok FROM {src}) a) b
          WHERE len(p) = 2) x
    LEFT JOIN weights w ON x.column_index = w.column_index
    GROUP BY x.entity_id{k}"""


piece("valid_rows", "SELECT * FROM split WHERE split = 'valid'", "split")
piece("valid_scored", f"""
    SELECT entity_id, label, margin, 1.0 / (1.0 + exp(-margin)) AS score,
           CASE WHEN 1.0 / (1.0 + exp(-margin)) > {QP.threshold} THEN 1 ELSE 0 END AS prediction
    FROM ({margins('valid_rows', 'label')}) m""", "valid_rows", "weights")
piece("f1_curve", """
    SELECT threshold,
           CAST(SUM(pos) OVER w AS BIGINT) AS tp, CAST(SUM(cnt) OVER w AS BIGINT) AS pp,
           CAST(2 * SUM(pos) OVER w AS DOUBLE) / CAST(SUM(cnt) OVER w + (SELECT SUM(pos) FROM g) AS DOUBLE) AS f1
    FROM g WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "g")
piece("g", """
    SELECT score AS threshold, SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, COUNT(*) AS cnt
    FROM valid_scored GROUP BY score""", "valid_scored")
piece("best", """
    SELECT threshold, f1 FROM f1_curve WHERE f1 IS NOT NULL
    ORDER BY f1 DESC, threshold DESC LIMIT 1""", "f1_curve")


def hard(src: str, pred: str) -> str:
    return f"""
    SELECT (1.0 + tp * 1.0 / NULLIF(pos, 0) - fp * 1.0 / NULLIF(neg, 0)) / 2 AS auc,
           hit * 1.0 / NULLIF(n, 0) AS accuracy
    FROM (SELECT SUM(CASE WHEN {pred} = 1 AND label = 1 THEN 1 ELSE 0 END) AS tp,
                 SUM(CASE WHEN {pred} = 1 AND label = 0 THEN 1 ELSE 0 END) AS fp,
                 SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                 SUM(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg,
                 SUM(CASE WHEN {pred} = label THEN 1 ELSE 0 END) AS hit,
                 COUNT(*) AS n FROM {src}) c"""


piece("train_metrics", f"""
    SELECT CAST({QP.threshold} AS DOUBLE) AS default_threshold,
           (SELECT auc FROM ({hard('valid_scored', 'prediction')}) a) AS auc_default,
           (SELECT accuracy FROM ({hard('valid_scored', 'prediction')}) a) AS accuracy_default,
           (SELECT threshold FROM best) AS select_threshold,
           (SELECT auc FROM ({hard('vb', 'pb')}) a) AS auc_select,
           (SELECT accuracy FROM ({hard('vb', 'pb')}) a) AS accuracy_select""", "valid_scored", "best", "vb")
piece("vb", """SELECT label, CASE WHEN score > (SELECT threshold FROM best) THEN 1 ELSE 0 END AS pb
    FROM valid_scored""", "valid_scored", "best")
piece("predict_scored", f"""
    SELECT entity_id, margin, 1.0 / (1.0 + exp(-margin)) AS score,
           CASE WHEN 1.0 / (1.0 + exp(-margin)) > (SELECT threshold FROM best) THEN 1 ELSE 0 END AS prediction
    FROM ({margins('predict')}) m""", "predict", "weights", "best")
piece("kpp", f"""
    SELECT entity_id, CASE WHEN label = 1 THEN '{POS}' ELSE '{NEG}' END AS class_name FROM train
    UNION ALL
    SELECT entity_id, CASE WHEN prediction = 1 THEN '{POS}' ELSE '{NEG}' END AS class_name FROM predict_scored""",
      "train", "predict_scored")

# --- truth, evaluation, merge -------------------------------------------------------
piece("truth_latest", """
    SELECT entity_id, class_name FROM truth_full
    WHERE CAST(stat_date AS INTEGER) = (SELECT MAX(CAST(stat_date AS INTEGER)) FROM truth_full)""", "truth_full")
piece("trusted1", """SELECT entity_id, MIN(class_name) AS class_name FROM truth_latest
    WHERE class_name IS NOT NULL GROUP BY entity_id""", "truth_latest")
piece("truth_part", """SELECT entity_id, class_name FROM trusted1
    WHERE entity_id NOT IN (SELECT entity_id FROM known_labels)""", "trusted1", "known_labels")
piece("stored_latest", f"SELECT DISTINCT entity_id, class_name FROM predictions WHERE stat_date = '{QP.snapshot_new}'",
      "predictions")


def acc(truth: str, pred: str) -> str:
    return f"""SELECT AVG(CAST(t.class_name = p.class_name AS INTEGER)) AS accuracy, COUNT(*) AS n
    FROM {truth} t JOIN {pred} p ON t.entity_id = p.entity_id"""


piece("eval_metrics", f"""
    SELECT (SELECT accuracy FROM ({acc('truth_latest', 'kpp')}) a) AS accuracy_full,
           (SELECT accuracy FROM ({acc('truth_part', 'kpp')}) a) AS accuracy_part""",
      "truth_latest", "truth_part", "kpp")
piece("merged", """
    SELECT COALESCE(p.entity_id, t.entity_id) AS entity_id, COALESCE(t.class_name, p.class_name) AS class_name
    FROM kpp p FULL OUTER JOIN trusted1 t ON p.entity_id = t.entity_id""", "kpp", "trusted1")


def balance(src: str, col: str, pos, neg) -> str:
    return f"""SELECT COUNT(*) AS n,
           CAST(SUM(CASE WHEN {col} = {pos} THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
           CAST(SUM(CASE WHEN {col} = {neg} THEN 1 ELSE 0 END) AS BIGINT) AS n_neg
    FROM {src}"""


piece("run_record", f"""
    SELECT m.*, CAST(pc.n_pos AS DOUBLE) AS pred_pos, CAST(pc.n_neg AS DOUBLE) AS pred_neg,
           pc.n_pos * 1.0 / NULLIF(pc.n_neg, 0) AS pred_ratio,
           CAST(mc.n_pos AS DOUBLE) AS merged_pos, CAST(mc.n_neg AS DOUBLE) AS merged_neg,
           mc.n_pos * 1.0 / NULLIF(mc.n_neg, 0) AS merged_ratio,
           e.accuracy_full, e.accuracy_part
    FROM train_metrics m, ({balance('kpp', 'class_name', repr(POS), repr(NEG))}) pc,
         ({balance('merged', 'class_name', repr(POS), repr(NEG))}) mc, eval_metrics e""",
      "train_metrics", "kpp", "merged", "eval_metrics")

# --- snapshots ------------------------------------------------------------------------
piece("changes", f"""
    SELECT a.entity_id, a.class_name AS class_new, b.class_name AS class_old
    FROM (SELECT DISTINCT entity_id, class_name FROM predictions WHERE stat_date = '{QP.snapshot_new}') a
    JOIN (SELECT DISTINCT entity_id, class_name FROM predictions WHERE stat_date = '{QP.snapshot_old}') b
      ON a.entity_id = b.entity_id
    WHERE a.class_name IS DISTINCT FROM b.class_name""", "predictions")


def rnd(cols: list[str], src: str, keep: list[str] | None = None) -> str:
    """Select ``cols`` in order, rounding all but those in ``keep``."""
    keep = keep or []
    sel = ", ".join(c if c in keep else f"ROUND({c}, 6) AS {c}" for c in cols)
    return f"SELECT {sel} FROM {src}"


def statement(final: str, *deps: str) -> str:
    """``WITH <deps in order> <final>``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in PIECES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final
    ctes = ",\n".join(f"{n} AS ({PIECES[n][0]})" for n in order)
    return f"WITH {ctes}\n{final}"


piece("dim", """
    SELECT CASE WHEN length(item_code) > 2 THEN substr(item_code, 3) ELSE item_code END AS code,
           item_name AS name, column_index FROM item_index""", "item_index")

RUN_RECORD_COLS = ["default_threshold", "auc_default", "accuracy_default", "select_threshold",
                   "auc_select", "accuracy_select", "pred_pos", "pred_neg", "pred_ratio",
                   "merged_pos", "merged_neg", "merged_ratio", "accuracy_full", "accuracy_part"]

DRIFT_ITEM_IDS = ("7", "42", "137", "1009")
for _side, _day in (("new", QP.snapshot_new), ("old", QP.snapshot_old)):
    piece(f"hits_{_side}", f"""
    SELECT entity_id FROM (
        SELECT trim(entity_id) AS entity_id, string_split(rtrim(trim(token), ':'), ':') AS parts
        FROM behavior_tokens WHERE stat_date = '{_day}') t
    WHERE len(parts) = 2 AND substr(trim(parts[1]), 3) IN ({", ".join(f"'{i}'" for i in DRIFT_ITEM_IDS)})""",
          "behavior_tokens")


def oracle_statements() -> dict[str, str]:
    return {
        "behavior_explode": statement("SELECT entity_id, item_code, value FROM beh_explode", "beh_explode"),
        "behavior_items_stripped": statement("SELECT entity_id, item_id FROM beh_items", "beh_items"),
        "item_topk": statement("SELECT item_code, item_name, install_num FROM topk", "topk"),
        "active_items_semi": statement("SELECT item_code, item_name, install_num FROM active", "active"),
        "item_index": statement("SELECT code, name, column_index FROM dim", "dim"),
        "feature_strings": statement("SELECT entity_id, feature FROM features", "features"),
        "feature_parse_long": statement("SELECT entity_id, column_index, value FROM feature_long",
                                        "feature_long"),
        "labels_from_users": statement("SELECT entity_id, label FROM known_labels", "known_labels"),
        "labels_two_branch_union": statement(
            "SELECT entity_id, label FROM two_branch", "two_branch"),
        "labels_from_devices": statement("SELECT entity_id, label FROM device_labels", "device_labels"),
        "label_balance": statement(
            f"SELECT n, n_pos, n_neg, ROUND(n_pos * 1.0 / NULLIF(n_neg, 0), 6) AS ratio "
            f"FROM ({balance('known_labels', 'label', 1, 0)}) b", "known_labels"),
        "decode_attributes": statement("SELECT user_id, age, age_range, class_name FROM decoded", "decoded"),
        "bucket_distribution": statement(
            "SELECT age_range, COUNT(*) AS n, ROUND(COUNT(*) * 1.0 / SUM(COUNT(*)) OVER (), 6) AS share "
            "FROM decoded GROUP BY age_range", "decoded"),
        "value_counts": statement("SELECT age, COUNT(*) AS n FROM decoded GROUP BY age", "decoded"),
        "run_date_normalise": """
            SELECT o_orderkey, raw_date,
                   strftime(make_date(CAST(substr(raw_date, 1, 4) AS INTEGER), 1, 1)
                            + to_months(CAST(substr(raw_date, 5, 2) AS INTEGER) - 1)
                            + to_days(CAST(substr(raw_date, 7, 2) AS INTEGER) - 1), '%Y%m%d') AS run_date
            FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y%m')
                         || lpad(CAST(day(o_orderdate) + CAST(o_orderkey % 4 AS INTEGER) * 3 AS VARCHAR), 2, '0')
                         AS raw_date FROM orders) o""",
        "latest_partition_scan": statement(
            "SELECT entity_id, class_name AS class_trusted FROM truth_latest", "truth_latest"),
        "latest_partition_catalog": statement(
            "SELECT entity_id, class_name AS class_trusted FROM truth_latest", "truth_latest"),
        "lr_fit_predict": statement(fit_rows("ln(2)"), "predict", "train_terms"),
        "lr_fit_intercept": statement(
            fit_rows("-(p * ln(p) + (1 - p) * ln(1 - p))") + """
            UNION ALL SELECT 'column', '-1', COUNT(*), SUM(label) FROM split WHERE split = 'train'""",
            "predict", "train_terms", "split"),
        "three_way_label_pred": statement(f"""
            SELECT x.user_id, d.entity_id, x.class_name AS class_trusted, p.class_name AS class_pred
            FROM decoded x JOIN device_user d ON x.user_id = d.user_id
            JOIN (SELECT DISTINCT entity_id, class_name FROM predictions
                  WHERE stat_date = '{QP.snapshot_new}') p ON d.entity_id = p.entity_id
            WHERE d.stat_date = '{LD}'""",
            "decoded", "device_user", "predictions"),
        "train_set": statement("SELECT * FROM train", "train"),
        "predict_set": statement("SELECT * FROM predict", "predict"),
        "set_cardinality_report": statement("""
            SELECT CAST(SUM(CASE WHEN n_label = 1 AND n_feature = 1 AND n_active > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
                   CAST(SUM(CASE WHEN n_label = 0 AND n_feature = 1 AND n_active > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_predict,
                   CAST(SUM(CASE WHEN n_label >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_multi_label,
                   CAST(SUM(CASE WHEN n_feature >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_multi_feature,
                   CAST(SUM(CASE WHEN n_label >= 1 AND n_feature = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_label_no_feature,
                   CAST(SUM(CASE WHEN n_label <= 1 AND n_feature = 1 AND n_active = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_empty_feature
            FROM tagged""", "tagged"),
        "hash_split": statement("SELECT entity_id, label, split FROM split", "split"),
        "score_linear": statement(f"""
            SELECT entity_id, margin, ROUND(1.0 / (1.0 + exp(-margin)), 6) AS score,
                   CASE WHEN 1.0 / (1.0 + exp(-margin)) > {QP.threshold} THEN 1 ELSE 0 END AS prediction
            FROM ({margins('predict')}) m""", "predict", "weights"),
        "f1_by_threshold": statement(rnd(["threshold", "tp", "pp", "f1"], "f1_curve", ["tp", "pp"]), "f1_curve"),
        "best_threshold": statement(rnd(["threshold", "f1"], "best"), "best"),
        "hard_auc_accuracy": statement(rnd(["default_threshold", "auc_default", "accuracy_default",
                                            "select_threshold", "auc_select", "accuracy_select"],
                                           "train_metrics"), "train_metrics"),
        "accuracy_avg": statement(f"SELECT ROUND(accuracy, 6) AS accuracy, n FROM ({acc('truth_part', 'stored_latest')}) a",
                                  "truth_part", "stored_latest"),
        "eval_full_and_part": statement(rnd(["accuracy_full", "accuracy_part"], "eval_metrics"), "eval_metrics"),
        "label_agreement": statement("""
            SELECT n_left, n_right, n_both, n_match, n_mismatch, n_left_only, n_right_only,
                   ROUND(n_match * 1.0 / NULLIF(n_both, 0), 6) AS match_ratio,
                   ROUND(n_mismatch * 1.0 / NULLIF(n_both, 0), 6) AS mismatch_ratio
            FROM (SELECT CAST(SUM(CASE WHEN l IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_left,
                         CAST(SUM(CASE WHEN r IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_right,
                         CAST(SUM(CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_both,
                         CAST(SUM(CASE WHEN l IS NOT NULL AND r IS NOT NULL AND l = r THEN 1 ELSE 0 END) AS BIGINT) AS n_match,
                         CAST(SUM(CASE WHEN l IS NOT NULL AND r IS NOT NULL AND l <> r THEN 1 ELSE 0 END) AS BIGINT) AS n_mismatch,
                         CAST(SUM(CASE WHEN r IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_left_only,
                         CAST(SUM(CASE WHEN l IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_right_only
                  FROM (SELECT a.label AS l, b.label AS r FROM device_labels a
                        FULL OUTER JOIN branch_labels b ON a.entity_id = b.entity_id) j) c""",
            "device_labels", "branch_labels"),
        "agreed_rows": statement("""
            SELECT a.entity_id, a.label FROM device_labels a JOIN branch_labels b
            ON a.entity_id = b.entity_id WHERE a.label = b.label""", "device_labels", "branch_labels"),
        "left_only_rows": statement(f"""
            SELECT entity_id, CASE WHEN label = 1 THEN '{POS}' ELSE '{NEG}' END AS class_name
            FROM device_labels WHERE entity_id NOT IN (SELECT entity_id FROM branch_labels)""",
            "device_labels", "branch_labels"),
        "known_plus_predicted": statement("SELECT entity_id, class_name FROM kpp", "kpp"),
        "override_merge": statement("SELECT entity_id, class_name FROM merged", "merged"),
        "snapshot_changes": statement("SELECT entity_id, class_new, class_old FROM changes", "changes"),
        "changed_item_share": statement(f"""
            SELECT n_changed_new, n_hit_new, n_hit_rows_new, n_changed_old, n_hit_old, n_hit_rows_old,
                   ROUND(n_hit_new * 1.0 / NULLIF(n_changed_new, 0), 6) AS share_new,
                   ROUND(n_hit_old * 1.0 / NULLIF(n_changed_old, 0), 6) AS share_old
            FROM (SELECT
              (SELECT COUNT(*) FROM changes WHERE class_new = '{NEG}') AS n_changed_new,
              (SELECT COUNT(DISTINCT c.entity_id) FROM changes c JOIN hits_new h ON c.entity_id = h.entity_id
                 WHERE c.class_new = '{NEG}') AS n_hit_new,
              (SELECT COUNT(*) FROM changes c JOIN hits_new h ON c.entity_id = h.entity_id
                 WHERE c.class_new = '{NEG}') AS n_hit_rows_new,
              (SELECT COUNT(*) FROM changes WHERE class_old = '{NEG}') AS n_changed_old,
              (SELECT COUNT(DISTINCT c.entity_id) FROM changes c JOIN hits_old h ON c.entity_id = h.entity_id
                 WHERE c.class_old = '{NEG}') AS n_hit_old,
              (SELECT COUNT(*) FROM changes c JOIN hits_old h ON c.entity_id = h.entity_id
                 WHERE c.class_old = '{NEG}') AS n_hit_rows_old) s""", "changes", "hits_new", "hits_old"),
        "run_record": statement(rnd(RUN_RECORD_COLS, "run_record"), "run_record"),
        "validation_run": statement(f"""
            SELECT '{QP.snapshot_new}' AS date,
                   ROUND((SELECT accuracy FROM ({acc('truth_latest', 'stored_latest')}) a), 6) AS accuracy_full,
                   ROUND((SELECT accuracy FROM ({acc('truth_part', 'stored_latest')}) a), 6) AS accuracy_part""",
            "truth_latest", "truth_part", "stored_latest"),
        "partition_overwrite_roundtrip": statement("""
            SELECT code, name, column_index, '20171027' AS stat_date FROM dim
            UNION ALL
            SELECT code, name, column_index, '""" + D + """' AS stat_date FROM dim""", "dim"),
        "table_overwrite_append_roundtrip": statement("""
            SELECT entity_id, label FROM known_labels
            UNION ALL
            SELECT a.entity_id, a.label FROM device_labels a JOIN branch_labels b
            ON a.entity_id = b.entity_id WHERE a.label = b.label""",
            "known_labels", "device_labels", "branch_labels"),
        "null_format_roundtrip": statement(
            "SELECT entity_id, class_name, stat_date FROM truth_full", "truth_full"),
        "publish_results": statement("""
            SELECT 'prediction_day' AS sink, entity_id AS key, class_name, CAST(NULL AS DOUBLE) AS value FROM merged
            UNION ALL SELECT 'latest', entity_id, class_name, NULL FROM merged
            """ + "".join(f"UNION ALL SELECT 'metrics', '{c}', NULL, ROUND({c}, 6) FROM run_record\n"
                          for c in RUN_RECORD_COLS),
            "merged", "run_record"),
    }
