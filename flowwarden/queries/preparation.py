"""Cleansing, labels, weights, metrics, splits and feature arrays."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowwarden.functions.scalars import category_or, lookup
from flowwarden.operators import cleanse, labels, metrics, quantiles, sampling
from flowwarden.plans import bindings, features, score
from flowwarden.plans.bindings import FLOW_FEATURES
from flowwarden.queries.registry import query
from flowwarden.schemas import ATTACK_TYPES, FEATURES, TRAINING_LABELS


def _finite(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN CAST(0 AS DOUBLE) ELSE CAST({c} AS DOUBLE) END"


def _plain(c: str) -> str:
    return f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END"


_CLEAN = ", ".join(f"{_finite('CAST(' + c + ' AS DOUBLE)')} AS {c}" for c in FLOW_FEATURES)
_CATEGORY = "coalesce(nullif(trim(attack_cat), ''), 'Normal')"
_CLASS = (
    f"CASE {_CATEGORY} "
    + " ".join(f"WHEN '{n}' THEN {i}" for n, i in TRAINING_LABELS.items())
    + " ELSE 0 END"
)

# --- columns and rows


@query("SELECT l_orderkey AS orderkey, l_quantity AS dur, l_tax AS dload FROM lineitem")
def p01_normalise_names(spark, d):
    rows = bindings.table(spark, d, "lineitem")
    odd = rows.select(
        F.col("l_orderkey").alias(" OrderKey"), F.col("l_quantity").alias("DUR "), F.col("l_tax").alias(" dLoad ")
    )
    return cleanse.normalise_names(odd)


@query("SELECT * EXCLUDE (attack_cat) FROM raw_flows", ("raw_flows",))
def p02_drop_columns(spark, d):
    return cleanse.drop_columns(bindings.raw_flows(spark, d), ["id", "attack_cat"])


@query(
    """SELECT count(*) AS rows, 'spkts,dpkts' AS missing FROM raw_flows""", ("raw_flows",)
)
def p03_schema_report(spark, d):
    rows = bindings.raw_flows(spark, d)
    missing = cleanse.missing_columns(rows, ["dur", "spkts", "dpkts", "rate", "label"])
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("missing", F.lit(",".join(missing)))


@query(
    f"SELECT CASE WHEN isnan(rate) THEN NULL ELSE rate END AS rate, dur, proto FROM raw_flows", ("raw_flows",)
)
def p04_nan_to_null(spark, d):
    return cleanse.nan_as_null(bindings.raw_flows(spark, d).select("rate", "dur", "proto"))


@query(f"SELECT proto, label, {_CLEAN} FROM raw_flows", ("raw_flows",))
def p05_clean_features(spark, d):
    rows = bindings.raw_flows(spark, d).select("proto", "label", *FLOW_FEATURES)
    return cleanse.clean_features(rows, FLOW_FEATURES)


@query(
    f"SELECT label, {_finite('dur')} AS dur, CAST(0 AS DOUBLE) AS spkts, CAST(0 AS DOUBLE) AS sttl FROM raw_flows",
    ("raw_flows",),
)
def p06_missing_features(spark, d):
    return cleanse.clean_features(bindings.raw_flows(spark, d).select("label", "dur"), ["dur", "spkts", "sttl"])


_SPARSE = ["dur", "rate", "dload", "dbytes", "service"]
_PRESENT = " + ".join(
    f"CASE WHEN {c} IS NULL {'OR isnan(rate) ' if c == 'rate' else ''}THEN 0 ELSE 1 END" for c in _SPARSE
)


@query(f"SELECT {', '.join(_SPARSE)} FROM raw_flows WHERE {_PRESENT} >= 4", ("raw_flows",))
def p07_drop_sparse_rows(spark, d):
    # Four of five values are asked for here, so that the rule has rows to drop.
    return cleanse.drop_sparse_rows(bindings.raw_flows(spark, d).select(*_SPARSE), 0.8)


_FILLED = ["dur", "rate", "dload", "dbytes"]
_MEDIANS = ", ".join(f"quantile_cont({_plain(c)}, 0.5) AS m_{c}" for c in _FILLED)


@query(
    f"""SELECT proto, {', '.join(f"coalesce({_plain(c)}, m_{c}) AS {c}" for c in _FILLED)}
        FROM raw_flows, (SELECT {_MEDIANS} FROM raw_flows) m""",
    ("raw_flows",),
)
def p08_fill_medians(spark, d):
    return cleanse.fill_medians(bindings.raw_flows(spark, d).select("proto", *_FILLED))


_CLIPPED = ["dur", "dload", "sbytes", "dbytes"]
_BOUNDS = ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.01) AS l_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS h_{c}" for c in _CLIPPED
)


@query(
    f"""SELECT proto, {', '.join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest(CAST({c} AS DOUBLE), l_{c}), h_{c}) END AS {c}" for c in _CLIPPED)}
        FROM raw_flows, (SELECT {_BOUNDS} FROM raw_flows) b""",
    ("raw_flows",),
)
def p09_clip_outliers(spark, d):
    return cleanse.clip_outliers(bindings.raw_flows(spark, d).select("proto", *_CLIPPED), [*_CLIPPED, "absent"])


@query(f"SELECT attack_cat AS raw, {_CATEGORY} AS category, proto FROM raw_flows", ("raw_flows",))
def p10_clean_category(spark, d):
    return bindings.raw_flows(spark, d).select(
        F.col("attack_cat").alias("raw"), category_or(F.col("attack_cat")).alias("category"), "proto"
    )


@query(
    f"""SELECT {_CATEGORY} AS attack_cat,
               CASE WHEN {_CATEGORY} = 'Normal' THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS binary_label
        FROM raw_flows""",
    ("raw_flows",),
)
def p11_binary_label(spark, d):
    return labels.with_labels(bindings.raw_flows(spark, d)).select("attack_cat", "binary_label")


@query(
    f"SELECT {_CATEGORY} AS attack_cat, CAST({_CLASS} AS DOUBLE) AS class_label FROM raw_flows", ("raw_flows",)
)
def p12_class_label(spark, d):
    return labels.with_labels(bindings.raw_flows(spark, d)).select("attack_cat", "class_label")


@query(
    """SELECT service, code, label FROM raw_flows LEFT JOIN
         (SELECT service AS s, CAST(row_number() OVER (ORDER BY service) - 1 AS BIGINT) AS code
          FROM (SELECT DISTINCT service FROM raw_flows WHERE service IS NOT NULL) v) m ON service = s""",
    ("raw_flows",),
)
def p13_encode_labels(spark, d):
    return labels.encode_labels(bindings.raw_flows(spark, d).select("service", "label"), "service", "code")[0]


@query(
    f"""SELECT f.attack_cat, f.sbytes, m.code AS attack_id FROM
          (SELECT {_CATEGORY} AS attack_cat, sbytes, label FROM raw_flows) f
        JOIN (SELECT attack_cat, CAST(row_number() OVER (ORDER BY attack_cat) - 1 AS BIGINT) AS code FROM
               (SELECT DISTINCT {_CATEGORY} AS attack_cat FROM raw_flows
                WHERE label = 1 AND {_CATEGORY} <> 'Normal') v) m
          ON f.attack_cat = m.attack_cat WHERE f.label = 1""",
    ("raw_flows",),
)
def p14_encode_attacks(spark, d):
    # The whole table is the training split, and is encoded with its own codes.
    rows = labels.with_labels(bindings.raw_flows(spark, d)).select("attack_cat", "sbytes", "label")
    _, encoded, _ = labels.encode_attacks(rows, rows, "attack_cat", "label", "attack_id")
    return encoded.drop("label")


_CODES = {
    "proto": "CASE proto WHEN 'tcp' THEN 1 WHEN 'udp' THEN 2 WHEN 'unas' THEN 3 WHEN 'arp' THEN 4 ELSE 0 END",
    "service": "CASE service WHEN '-' THEN 1 WHEN 'dns' THEN 2 WHEN 'http' THEN 3 WHEN 'ssh' THEN 7 ELSE 0 END",
    "state": "CASE state WHEN 'FIN' THEN 1 WHEN 'INT' THEN 2 ELSE 0 END",
}


@query(
    f"""SELECT proto, service, {', '.join(f'CAST({sql} AS DOUBLE) AS {c}_code' for c, sql in _CODES.items() if c != 'state')},
               CAST(0 AS DOUBLE) AS state_code FROM raw_flows""",
    ("raw_flows",),
)
def p15_fallback_codes(spark, d):
    rows = bindings.raw_flows(spark, d).select("proto", "service")
    return labels.with_fallback_codes(rows, list(_CODES))


_WIDE = {c: FLOW_FEATURES[i % len(FLOW_FEATURES)] for i, c in enumerate(FEATURES[:-1])}


@query(
    f"""SELECT label, {', '.join(f'{_finite(f"CAST({src} AS DOUBLE)")} * {i + 1} AS {c}' for i, (c, src) in enumerate(_WIDE.items()))},
               CAST(0 AS DOUBLE) AS {FEATURES[-1]} FROM raw_flows""",
    ("raw_flows",),
)
def p05_clean_39_features(spark, d):
    # The six measures stand for 38 features in turn, each with a factor of its own; the last feature is absent.
    rows = bindings.raw_flows(spark, d)
    wide = rows.select("label", *[(F.col(src).cast("double") * (i + 1)).alias(c) for i, (c, src) in enumerate(_WIDE.items())])
    return cleanse.clean_features(wide, FEATURES)


# --- counts and weights


@query(
    """SELECT CASE WHEN grouping(label) = 1 THEN 'table' ELSE 'label' END AS scope, label AS label_value,
              count(*) AS rows, CAST(11 AS BIGINT) AS columns,
              CAST(sum((dur IS NULL)::INT + (dload IS NULL)::INT + (dbytes IS NULL)::INT + (service IS NULL)::INT
                       + (attack_cat IS NULL)::INT) AS BIGINT) AS null_cells
       FROM raw_flows GROUP BY ROLLUP (label)""",
    ("raw_flows",),
)
def a14_table_profile(spark, d):
    return cleanse.profile(bindings.raw_flows(spark, d), "label")


_WEIGHTS = """SELECT {c} AS {c}, n, round(sqrt(CAST(sum(n) OVER () AS DOUBLE) / ({k} * n)), 9) AS weight
  FROM (SELECT {e} AS {c}, count(*) AS n FROM raw_flows {where} GROUP BY 1) c"""


def _rounded(df):
    return df.withColumn("weight", F.round("weight", 9))


@query(
    _WEIGHTS.format(c="binary_label", e=f"CAST(CASE WHEN {_CATEGORY} = 'Normal' THEN 0 ELSE 1 END AS DOUBLE)", k="2", where=""),
    ("raw_flows",),
)
def a06_binary_weights(spark, d):
    return _rounded(labels.class_weights(labels.with_labels(bindings.raw_flows(spark, d)), "binary_label", 2))


@query(
    _WEIGHTS.format(c="class_label", e=f"CAST({_CLASS} AS DOUBLE)", k="(count(*) OVER ())", where=""), ("raw_flows",)
)
def a07_class_weights(spark, d):
    return _rounded(labels.class_weights(labels.with_labels(bindings.raw_flows(spark, d)), "class_label"))


@query(
    _WEIGHTS.format(
        c="class_label", e=f"CAST({_CLASS} AS DOUBLE)", k="(count(*) OVER ())", where=f"WHERE {_CLASS} > 0"
    ),
    ("raw_flows",),
)
def a07_attack_class_weights(spark, d):
    rows = labels.with_labels(bindings.raw_flows(spark, d)).where(F.col("class_label") > 0)
    return _rounded(labels.class_weights(rows, "class_label"))


@query(
    f"""SELECT r.class_label, r.sbytes, w.weight FROM (SELECT CAST({_CLASS} AS DOUBLE) AS class_label, sbytes FROM raw_flows) r
        JOIN ({_WEIGHTS.format(c="class_label", e=f"CAST({_CLASS} AS DOUBLE)", k="(count(*) OVER ())", where="")}) w
          ON r.class_label = w.class_label""",
    ("raw_flows",),
)
def a07_weighted_rows(spark, d):
    rows = labels.with_labels(bindings.raw_flows(spark, d)).select("class_label", "sbytes")
    return _rounded(labels.with_weights(rows, "class_label", "weight"))


# --- rule-scored rows and metrics

_Z = " + ".join(f"{_finite(c)} * CAST({w} AS DOUBLE)" for c, w in score.RULE_WEIGHTS.items())


def _category_score(cat: int) -> str:
    terms = (
        f"{c} / CAST(100.0 AS DOUBLE) * CAST({w} AS DOUBLE)"
        for c, w in zip(score.RULE_FEATURES, score.category_weights(cat))
    )
    return "(" + " + ".join(terms) + ")"


_SCORES = ", ".join(f"{_category_score(c)} AS s{c}" for c in range(1, 10))
_TOP = "greatest(" + ", ".join(f"s{c}" for c in range(1, 10)) + ")"
_ARGMAX = "CASE " + " ".join(f"WHEN s{c} = top THEN {c}" for c in range(1, 10)) + " END"
_SUM_EXP = " + ".join(f"exp(s{c} - top)" for c in range(1, 10))
_NAMES = "CASE {c} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in ATTACK_TYPES.items()) + " ELSE 'Unknown' END"

# Rows of ``messages`` with the columns of the rule scorer; shared with the stream queries.
SCORED_SQL = f"""
  SELECT *, {_NAMES.format(c="attack_cat_id")} AS attack_type FROM (
   SELECT *, {_ARGMAX} AS attack_cat_id, 1 / ({_SUM_EXP}) AS attack_confidence FROM (
    SELECT *, {_TOP} AS top FROM (
     SELECT *, CASE WHEN binary_probability >= 0.5 THEN 1 ELSE 0 END AS binary_prediction, {_SCORES} FROM (
      SELECT * EXCLUDE (dur, rate, sbytes), 1 / (1 + exp(-({_Z} + CAST({score.RULE_BIAS} AS DOUBLE)))) AS binary_probability,
             {', '.join(f'{_finite(c)} AS {c}' for c in score.RULE_FEATURES)} FROM messages) a) b) c) e"""


def _scored(spark, d, include_normal=False):
    return score.rule_scores(cleanse.clean_features(bindings.messages(spark, d), score.RULE_FEATURES), include_normal)


def _binary_rows(spark, d):
    return _scored(spark, d, True).select(
        F.col("label"), F.col("binary_prediction").alias("prediction"), F.round("binary_probability", 9).alias("score")
    )


_CLASSES = "CASE attack_cat WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 4 WHEN 'signup' THEN 7 ELSE 9 END"


def _class_matrix(spark, d):
    truth = lookup(F.col("attack_cat"), {"click": 1, "error": 2, "purchase": 4, "signup": 7}, 9)
    rows = _scored(spark, d).select(truth.alias("label"), F.col("attack_cat_id").alias("prediction"))
    return metrics.confusion(rows)


_MATRIX = f"""(SELECT CAST({_CLASSES} AS DOUBLE) AS label, CAST(attack_cat_id AS DOUBLE) AS prediction, count(*) AS n
              FROM ({SCORED_SQL}) s WHERE binary_prediction = 1 GROUP BY ALL)"""
_BINARY_MATRIX = f"""(SELECT CAST(label AS DOUBLE) AS label, CAST(binary_prediction AS DOUBLE) AS prediction, count(*) AS n
              FROM ({SCORED_SQL}) s GROUP BY ALL)"""
_REPORT = """(SELECT class, CAST(support AS BIGINT) AS support,
     CASE WHEN predicted > 0 THEN CAST(hits AS DOUBLE) / predicted ELSE 0 END AS precision,
     CASE WHEN support > 0 THEN CAST(hits AS DOUBLE) / support ELSE 0 END AS recall,
     CASE WHEN support + predicted > 0 THEN CAST(2 * hits AS DOUBLE) / (support + predicted) ELSE 0 END AS f1
   FROM (SELECT class, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM (
     SELECT label AS class, n AS support, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM {matrix} a
     UNION ALL SELECT prediction, 0, n, 0 FROM {matrix} b) u GROUP BY class) r)"""
_MEASURES = ("precision", "recall", "f1")
_ROUNDED = ", ".join(f"round({m}, 9) AS {m}" for m in _MEASURES)


@query(f"SELECT label, prediction, n FROM {_BINARY_MATRIX} m", ("messages",))
def a08_confusion_matrix(spark, d):
    return metrics.confusion(_binary_rows(spark, d))


@query(f"SELECT label, prediction, n FROM {_MATRIX} m", ("messages",))
def a08_category_confusion(spark, d):
    return _class_matrix(spark, d)


@query(
    f"""SELECT label, CAST(sum(n) AS BIGINT) AS total, CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS correct,
               round(CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) / sum(n), 4) AS accuracy
        FROM {_MATRIX} m GROUP BY label""",
    ("messages",),
)
def a09_per_class_accuracy(spark, d):
    return metrics.per_class_accuracy(_class_matrix(spark, d))


@query(
    f"""SELECT round(CAST(sum(u) AS DOUBLE) / (CAST(max(p) AS DOUBLE) * max(q)), 9) AS auc_roc FROM (
          SELECT pos * (below + CAST(0.5 AS DOUBLE) * neg) AS u, sum(pos) OVER () AS p, sum(neg) OVER () AS q FROM (
            SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY binary_probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
            FROM (SELECT round(binary_probability, 9) AS binary_probability, sum(label) AS pos, sum(1 - label) AS neg
                  FROM ({SCORED_SQL}) s GROUP BY 1) a) b) c""",
    ("messages",),
)
def a10_roc_auc(spark, d):
    return spark.createDataFrame([(round(metrics.areas(_binary_rows(spark, d))["auc_roc"], 9),)], "auc_roc double")


@query(
    f"""SELECT round(sum((recall - coalesce(last_recall, 0)) * (precision + coalesce(last_precision, precision)) / 2), 9) AS auc_pr FROM (
          SELECT recall, precision, lag(recall) OVER w AS last_recall, lag(precision) OVER w AS last_precision FROM (
            SELECT binary_probability, CAST(sum(pos) OVER up AS DOUBLE) / sum(pos) OVER () AS recall,
                   CAST(sum(pos) OVER up AS DOUBLE) / (sum(pos + neg) OVER up) AS precision
            FROM (SELECT round(binary_probability, 9) AS binary_probability, sum(label) AS pos, sum(1 - label) AS neg
                  FROM ({SCORED_SQL}) s GROUP BY 1) a
            WINDOW up AS (ORDER BY binary_probability DESC ROWS UNBOUNDED PRECEDING)) b
          WINDOW w AS (ORDER BY binary_probability DESC)) c""",
    ("messages",),
)
def a10_pr_auc(spark, d):
    return spark.createDataFrame([(round(metrics.areas(_binary_rows(spark, d))["auc_pr"], 9),)], "auc_pr double")


@query(
    f"""SELECT score, CAST(sum(pos) OVER up AS BIGINT) AS tp, CAST(sum(neg) OVER up AS BIGINT) AS fp FROM (
          SELECT round(binary_probability, 9) AS score, sum(label) AS pos, sum(1 - label) AS neg FROM ({SCORED_SQL}) s GROUP BY 1) a
        WINDOW up AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
    ("messages",),
)
def a10_curve(spark, d):
    return metrics.curve(_binary_rows(spark, d)).select("score", "tp", "fp")


@query(
    f"""SELECT round(sum(recall * support) / sum(support), 9) AS accuracy, round(sum(f1 * support) / sum(support), 9) AS weighted_f1,
               round(sum(precision * support) / sum(support), 9) AS weighted_precision,
               round(sum(recall * support) / sum(support), 9) AS weighted_recall
        FROM {_REPORT.format(matrix=_MATRIX)} r""",
    ("messages",),
)
def a11_overall_metrics(spark, d):
    found = metrics.overall_metrics(_class_matrix(spark, d))
    return found.select([F.round(c, 9).alias(c) for c in found.columns])


@query(
    f"""SELECT round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS binary_f1
        FROM {_REPORT.format(matrix=_BINARY_MATRIX)} r WHERE class = 1""",
    ("messages",),
)
def a12_positive_f1(spark, d):
    found = metrics.positive_f1(metrics.confusion(_binary_rows(spark, d)))
    return found.select([F.round(c, 9).alias(c) for c in found.columns])


@query(
    f"""SELECT 'class' AS scope, class, support, {_ROUNDED} FROM {_REPORT.format(matrix=_MATRIX)} r
        UNION ALL SELECT 'macro avg', NULL, CAST(sum(support) AS BIGINT), {', '.join(f'round(avg({m}), 9)' for m in _MEASURES)}
          FROM {_REPORT.format(matrix=_MATRIX)} r
        UNION ALL SELECT 'weighted avg', NULL, CAST(sum(support) AS BIGINT),
          {', '.join(f'round(sum({m} * support) / sum(support), 9)' for m in _MEASURES)} FROM {_REPORT.format(matrix=_MATRIX)} r""",
    ("messages",),
)
def a13_class_report(spark, d):
    found = metrics.class_report_with_averages(_class_matrix(spark, d))
    return found.select("scope", "class", "support", *[F.round(m, 9).alias(m) for m in _MEASURES])


@query(
    f"""SELECT record_id, label, attack_cat AS actual, attack_type AS predicted, round(binary_probability, 9) AS binary_probability
        FROM ({SCORED_SQL}) s WHERE binary_prediction = 1 ORDER BY CAST(record_id AS BIGINT) LIMIT 5""",
    ("messages",),
)
def l08_first_detected(spark, d):
    rows = _scored(spark, d).select(
        "record_id", "label", F.col("attack_cat").alias("actual"), F.col("attack_type").alias("predicted"),
        F.round("binary_probability", 9).alias("binary_probability"),
    )
    return rows.orderBy(F.col("record_id").cast("bigint")).limit(5)


_SCORE_COLUMNS = """record_id, {b} AS binary_prediction, round(binary_probability, 9) AS binary_probability, {c} AS attack_cat_id,
  {t} AS attack_type, {f} AS attack_confidence"""
_FLAGGED = "CASE WHEN binary_prediction = 1 THEN {x} ELSE {y} END"


@query(
    "SELECT "
    + _SCORE_COLUMNS.format(
        b="binary_prediction",
        c=_FLAGGED.format(x="attack_cat_id", y="0"),
        t=_FLAGGED.format(x="attack_type", y="'Normal'"),
        f=_FLAGGED.format(x="round(attack_confidence, 9)", y="CAST(0 AS DOUBLE)"),
    )
    + f" FROM ({SCORED_SQL}) s",
    ("messages",),
)
def u02_scored_with_normals(spark, d):
    rows = _scored(spark, d, include_normal=True)
    return rows.select(
        "record_id", "binary_prediction", F.round("binary_probability", 9).alias("binary_probability"),
        "attack_cat_id", "attack_type", F.round("attack_confidence", 9).alias("attack_confidence"),
    )


@query(
    f"SELECT count(*) AS rows, CAST(sum(binary_prediction) AS BIGINT) AS attacks FROM ({SCORED_SQL}) s", ("messages",)
)
def a15_batch_counts(spark, d):
    return _scored(spark, d, include_normal=True).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("binary_prediction").alias("attacks")
    )


@query(
    f"""SELECT record_id, 1 AS binary_prediction, round(binary_probability, 9) AS binary_probability, attack_cat_id,
               round(attack_confidence, 9) AS attack_confidence FROM ({SCORED_SQL}) s WHERE binary_prediction = 1""",
    ("messages",),
)
def d02_python_model_scoring(spark, d):
    rows = score.score_with(
        bindings.messages(spark, d), score.NumpyRules(), score.RULE_FEATURES, ["record_id"]
    )
    return rows.select(
        "record_id", "binary_prediction", F.round("binary_probability", 9).alias("binary_probability"),
        "attack_cat_id", F.round("attack_confidence", 9).alias("attack_confidence"),
    )


# --- moments and quantiles


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std FROM (SELECT {_CLEAN} FROM raw_flows) f"
        for c in FLOW_FEATURES
    ),
    ("raw_flows",),
)
def a16_column_moments(spark, d):
    rows = cleanse.clean_features(bindings.raw_flows(spark, d).select(*FLOW_FEATURES), FLOW_FEATURES)
    found = metrics.column_moments(rows, FLOW_FEATURES)
    return found.select("feature", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


_QUANTILES = {"q01": 0.01, "median": 0.5, "q99": 0.99}


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + ", ".join(f"round(quantile_cont({c}, {p}), 6) AS {n}" for n, p in _QUANTILES.items()) + " FROM lineitem"
        for c in ("l_extendedprice", "l_discount", "l_quantity")
    )
)
def a17_exact_quantiles(spark, d):
    columns = ["l_extendedprice", "l_discount", "l_quantity"]
    found = quantiles.exact_quantiles(
        bindings.table(spark, d, "lineitem"), columns, list(_QUANTILES.values())
    )
    schema = "feature string, " + ", ".join(f"{n} double" for n in _QUANTILES)
    return spark.createDataFrame([(c, *[round(v, 6) for v in found[c]]) for c in columns], schema)


# --- splits and samples

_HASH = "CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 13) AS BIGINT)"


@query(
    f"""SELECT alert_id, severity, hash_rank <= cut AS in_test FROM (
          SELECT alert_id, severity, rn, hash_rank, max(CASE WHEN rn = n_test THEN hash_rank END) OVER (PARTITION BY severity) AS cut FROM (
            SELECT a.alert_id, a.severity, a.hash_rank, s.n_test, row_number() OVER (PARTITION BY a.severity ORDER BY a.hash_rank) AS rn
            FROM (SELECT alert_id, severity, {_HASH.format(k='alert_id')} AS hash_rank FROM alerts) a
            JOIN (SELECT severity, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, severity) <= wanted - sum(base) OVER ()
                                              THEN 1 ELSE 0 END AS n_test
                  FROM (SELECT severity, n, wanted, CAST(wanted * n AS DOUBLE) / total AS share,
                               CAST(floor(CAST(wanted * n AS DOUBLE) / total) AS BIGINT) AS base
                        FROM (SELECT severity, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
                                     CAST(ceil(sum(count(*)) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT) AS wanted
                              FROM alerts GROUP BY severity) c) b) s ON a.severity = s.severity) r) t""",
    ("alerts",),
)
def u03_stratified_split(spark, d):
    rows = bindings.alerts(spark, d).select("alert_id", "severity")
    return sampling.with_test_flag(rows, "alert_id", "severity", test_size=0.2)


@query(
    f"SELECT event_id, {_HASH.format(k='event_id')} < {int(0.2 * 16**13)} AS in_test FROM events"
)
def u03_split_by_hash(spark, d):
    train, test = sampling.split_by_hash(bindings.table(spark, d, "events").select("event_id"), "event_id", 0.2)
    return sampling.concat(train.withColumn("in_test", F.lit(False)), test.withColumn("in_test", F.lit(True)))


@query(
    f"""SELECT alert_id, severity FROM alerts
        QUALIFY row_number() OVER (PARTITION BY severity ORDER BY {_HASH.format(k='alert_id')}, alert_id) <= 100""",
    ("alerts",),
)
def u04_balanced_sample(spark, d):
    return sampling.balanced_sample(bindings.alerts(spark, d).select("alert_id", "severity"), "severity", "alert_id", 100)


@query(f"SELECT event_id, value FROM events WHERE {_HASH.format(k='event_id')} < {int(0.1 * 16**13)}")
def u05_bernoulli_sample(spark, d):
    return sampling.bernoulli(bindings.table(spark, d, "events").select("event_id", "value"), "event_id", 0.1)


# --- feature arrays


def _clean_rows(spark, d, *extra):
    rows = bindings.raw_flows(spark, d).select(*extra, *FLOW_FEATURES)
    return cleanse.clean_features(rows, FLOW_FEATURES)


@query(
    f"SELECT label, {', '.join(f'{c} AS x{i}' for i, c in enumerate(FLOW_FEATURES))} FROM (SELECT label, {_CLEAN} FROM raw_flows) f",
    ("raw_flows",),
)
def m01_assemble(spark, d):
    rows = features.assembler(FLOW_FEATURES).transform(_clean_rows(spark, d, "label"))
    values = rows.select("label", vector_to_array("features_raw").alias("v"))
    return values.select("label", *[F.col("v")[i].alias(f"x{i}") for i in range(len(FLOW_FEATURES))])


_SCALED = ", ".join(f"round(({c} - avg({c}) OVER ()) / (stddev_samp({c}) OVER ()), 6) + 0 AS z{i}" for i, c in enumerate(FLOW_FEATURES))


@query(f"SELECT label, {_SCALED} FROM (SELECT label, {_CLEAN} FROM raw_flows) f", ("raw_flows",))
def m02_standardise(spark, d):
    rows = _clean_rows(spark, d, "label")
    fitted = features.binary_stages(FLOW_FEATURES).fit(rows)
    values = fitted.transform(rows).select("label", vector_to_array("features_vec").alias("v"))
    # Adding zero turns a rounded -0.0 into 0.0.
    return values.select("label", *[(F.round(F.col("v")[i], 6) + 0.0).alias(f"z{i}") for i in range(len(FLOW_FEATURES))])


def _index_sql(c: str) -> str:
    return f"""(SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS i
               FROM raw_flows WHERE {c} IS NOT NULL GROUP BY {c})"""


@query(
    f"""SELECT proto, service, state, p.i AS proto_idx,
               coalesce(s.i, CAST((SELECT count(DISTINCT service) FROM raw_flows) AS DOUBLE)) AS service_idx, t.i AS state_idx
        FROM raw_flows f LEFT JOIN {_index_sql('proto')} p ON f.proto = p.v
        LEFT JOIN {_index_sql('service')} s ON f.service = s.v LEFT JOIN {_index_sql('state')} t ON f.state = t.v""",
    ("raw_flows",),
)
def m03_index_categories(spark, d):
    # A dictionary by frequency that is made, kept and joined on the executors.
    rows = bindings.raw_flows(spark, d).select("proto", "service", "state")
    for c in rows.columns:
        rows, _ = labels.index_by_frequency(rows, c, f"{c}_idx")
    return rows


@query(
    f"""SELECT {_SCALED}, p.i AS z{len(FLOW_FEATURES)},
               coalesce(s.i, CAST((SELECT count(DISTINCT service) FROM raw_flows) AS DOUBLE)) AS z{len(FLOW_FEATURES) + 1}, t.i AS z{len(FLOW_FEATURES) + 2}
        FROM (SELECT proto, service, state, {_CLEAN} FROM raw_flows) f LEFT JOIN {_index_sql('proto')} p ON f.proto = p.v
        LEFT JOIN {_index_sql('service')} s ON f.service = s.v LEFT JOIN {_index_sql('state')} t ON f.state = t.v""",
    ("raw_flows",),
)
def m04_category_vector(spark, d):
    rows = _clean_rows(spark, d, "proto", "service", "state")
    vectors = features.category_stages(FLOW_FEATURES).fit(rows).transform(rows)
    values = vectors.select(vector_to_array("features_mc").alias("v"))
    return values.select(*[(F.round(F.col("v")[i], 6) + 0.0).alias(f"z{i}") for i in range(len(FLOW_FEATURES) + 3)])


@query(
    f"""SELECT label, {', '.join(f'{c} AS w{i}' for i, c in enumerate(FLOW_FEATURES))},
               {', '.join(f'CAST({sql} AS DOUBLE) AS w{len(FLOW_FEATURES) + i}' for i, sql in enumerate(_CODES.values()))},
               CAST(0 AS DOUBLE) AS w{len(FLOW_FEATURES) + 3}
        FROM (SELECT label, proto, service, state, {_CLEAN} FROM raw_flows) f""",
    ("raw_flows",),
)
def m12_widen_features(spark, d):
    rows = features.assembler(FLOW_FEATURES, "features_vec").transform(_clean_rows(spark, d, "label", "proto", "service", "state"))
    have, want = len(FLOW_FEATURES), len(FLOW_FEATURES) + 4
    wide = features.widen_vector(rows, "features_vec", "features_mc", have, want)
    values = wide.select("label", vector_to_array("features_mc").alias("v"))
    return values.select("label", *[F.col("v")[i].alias(f"w{i}") for i in range(want)])
