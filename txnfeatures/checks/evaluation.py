"""Evaluation of a labelled score table."""

from __future__ import annotations

from txnfeatures.checks import tables as t
from txnfeatures.operators import evaluation as E

QUERIES = {
    "confusion_matrix": lambda s, d: E.confusion_matrix(t.scored(s, d)),
    "classification_report": lambda s, d: t.rounded(E.classification_report(t.scored(s, d))),
    "roc_auc": lambda s, d: t.rounded(E.roc_auc(t.scored(s, d))),
    "average_precision": lambda s, d: t.rounded(E.average_precision(t.scored(s, d))),
    "score_summary": lambda s, d: t.rounded(E.score_summary(t.scored(s, d), "prediction")),
    "evaluation_metrics": lambda s, d: E.evaluate(t.scored(s, d), n_features=18),
    "apply_threshold": lambda s, d: t.rounded(E.apply_threshold(t.scored(s, d), "probability", 0.4)),
}

PER_SCORE_SQL = """per AS (
  SELECT probability, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY 1),
cum AS (
  SELECT *, sum(pos) OVER up - pos AS pos_before, sum(neg) OVER up - neg AS neg_before,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM per WINDOW up AS (ORDER BY probability))"""

AUC_SQL = "sum(pos * (neg_before + neg / 2.0::DOUBLE)) / (max(p)::DOUBLE * max(n))"
AP_SQL = "sum(pos * (p - pos_before)::DOUBLE / (p - pos_before + n - neg_before)) / max(p)"

CELLS_SQL = """cells AS (SELECT
    count(*) FILTER (label = 0 AND prediction = 0) AS n00, count(*) FILTER (label = 0 AND prediction = 1) AS n01,
    count(*) FILTER (label = 1 AND prediction = 0) AS n10, count(*) FILTER (label = 1 AND prediction = 1) AS n11
  FROM scored)"""

RATES_SQL = """rates AS (SELECT n00 + n01 AS s0, n10 + n11 AS s1, n00 + n01 + n10 + n11 AS n,
    n00 / (n00 + n10) AS p0, n11 / (n11 + n01) AS p1, n00 / (n00 + n01) AS r0, n11 / (n11 + n10) AS r1,
    2 * n00 / (2 * n00 + n01 + n10) AS f0, 2 * n11 / (2 * n11 + n01 + n10) AS f1, (n00 + n11) / (n00 + n01 + n10 + n11) AS acc
  FROM cells)"""

ORACLES = {
    "confusion_matrix": f"""WITH {t.SCORED_SQL}, grid AS (SELECT a AS label, b AS prediction FROM range(2) x(a), range(2) y(b))
      SELECT CAST(g.label AS INTEGER) AS label, CAST(g.prediction AS INTEGER) AS prediction, count(s.label) AS n_rows
      FROM grid g LEFT JOIN scored s ON s.label = g.label AND s.prediction = g.prediction GROUP BY 1, 2""",
    "classification_report": f"""WITH {t.SCORED_SQL}, {CELLS_SQL}, {RATES_SQL}
      SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM rates
      UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM rates
      UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), n FROM rates
      UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM rates
      UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
        round((f0 * s0 + f1 * s1) / n, 6), n FROM rates""",
    "roc_auc": f"WITH {t.SCORED_SQL}, {PER_SCORE_SQL} SELECT round({AUC_SQL}, 6) AS roc_auc FROM cum",
    "average_precision": f"WITH {t.SCORED_SQL}, {PER_SCORE_SQL} SELECT round({AP_SQL}, 6) AS average_precision FROM cum",
    "score_summary": f"""WITH {t.SCORED_SQL} SELECT count(*) AS n_rows, count(*) FILTER (prediction = 1) AS n_predicted,
      round(avg(prediction), 6) AS predicted_rate FROM scored""",
    "evaluation_metrics": f"""WITH {t.SCORED_SQL}, {PER_SCORE_SQL}
      SELECT round({AUC_SQL}, 4) AS roc_auc, round({AP_SQL}, 4) AS pr_auc, CAST(max(p) + max(n) AS BIGINT) AS n_test,
        CAST(max(p) AS BIGINT) AS n_fraud, CAST(18 AS INTEGER) AS features FROM cum""",
    "apply_threshold": f"""WITH {t.SCORED_SQL} SELECT label, round(probability, 6) AS probability, prediction,
      CAST(CASE WHEN probability >= 0.4::DOUBLE THEN 1 ELSE 0 END AS INTEGER) AS fraud_predicted FROM scored""",
}
