"""The registered queries as DuckDB SQL over the same tables.

Each statement states the result in its own terms: AUC by ranks over all rows,
silhouette by all pairs, boosting by one materialized weight table per round,
logistic fits on one 0/1 feature by their closed form.
"""

from __future__ import annotations

import math

from foldwright.checks.fold_oracles import fold_statements
from foldwright.checks.inputs import CENTERS, EIGHT_FLAGS, FIVE_FLAGS, PRICE_RULES, QUANTITY_RULES, RULE_ALPHAS, RULE_MODELS

APPLICANTS = """
lines AS (
  SELECT l_orderkey, count(*) - 1 AS family, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey
),
applicants AS (
  SELECT o_orderkey AS row_key,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS AGE,
         family AS APPLICANT_FAMILY_COUNT,
         c_mktsegment AS MARITAL_STATUS,
         o_orderpriority AS GENDER_DESC,
         CAST(o_orderdate AS DATE) AS APPLICATION_DATE,
         CAST(CASE WHEN o_orderstatus = 'F' THEN shipped END AS DATE) AS APPROVED_DATE,
         DATE '1985-01-01' - CAST((o_custkey * 7919) % 40000 AS INTEGER) AS APPLICANT_BIRTH_DATE,
         o_orderstatus AS APPLICATION_STATUS_NAME
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON l_orderkey = o_orderkey
)
"""

YEARS = """CAST(floor((
  (year(APPLICATION_DATE) - year(APPLICANT_BIRTH_DATE)) * 12
  + (month(APPLICATION_DATE) - month(APPLICANT_BIRTH_DATE))
  + CASE WHEN day(APPLICATION_DATE) = day(APPLICANT_BIRTH_DATE)
           OR (APPLICATION_DATE = last_day(APPLICATION_DATE) AND APPLICANT_BIRTH_DATE = last_day(APPLICANT_BIRTH_DATE))
         THEN 0 ELSE (day(APPLICATION_DATE) - day(APPLICANT_BIRTH_DATE)) / 31.0 END) / 12) AS BIGINT)"""

DERIVED = (
    APPLICANTS
    + f""",
complete AS (
  SELECT * EXCLUDE (AGE), {YEARS} AS AGE_AT_APPLICATION
  FROM applicants
  WHERE AGE IS NOT NULL AND APPLICANT_FAMILY_COUNT IS NOT NULL AND MARITAL_STATUS IS NOT NULL AND GENDER_DESC IS NOT NULL
),
derived AS (
  SELECT *,
         CAST(year(APPLICATION_DATE) AS INTEGER) AS APPLICATION_YEAR,
         CAST(date_diff('day', APPLICATION_DATE, APPROVED_DATE) AS INTEGER) AS PROCESSING_DAYS,
         CASE WHEN APPLICATION_STATUS_NAME = 'F' THEN 1 ELSE 0 END AS APPROVAL_LABEL,
         CASE WHEN AGE_AT_APPLICATION < 25 THEN 'Young (18-24)'
              WHEN AGE_AT_APPLICATION < 35 THEN 'Young Adult (25-34)'
              WHEN AGE_AT_APPLICATION < 45 THEN 'Middle Age (35-44)'
              WHEN AGE_AT_APPLICATION < 55 THEN 'Mature (45-54)'
              WHEN AGE_AT_APPLICATION < 65 THEN 'Senior (55-64)'
              ELSE 'Elderly (65+)' END AS AGE_GROUP,
         CASE WHEN APPLICANT_FAMILY_COUNT = 0 THEN 'No Dependents'
              WHEN APPLICANT_FAMILY_COUNT <= 2 THEN 'Small (1-2)'
              WHEN APPLICANT_FAMILY_COUNT <= 4 THEN 'Medium (3-4)'
              WHEN APPLICANT_FAMILY_COUNT <= 6 THEN 'Large (5-6)'
              ELSE 'Very Large (7+)' END AS FAMILY_SIZE_CATEGORY
  FROM complete
),
features AS (SELECT * FROM derived WHERE AGE_AT_APPLICATION BETWEEN 18 AND 100),
labelled AS (
  SELECT *, CASE WHEN (AGE_AT_APPLICATION > 35) <> (row_key % 5 = 0) THEN 1 ELSE 0 END AS label,
         CAST(AGE_AT_APPLICATION > 35 AS INTEGER) AS flag
  FROM features
)
"""
)

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
VOTES = ", ".join(f"CAST(l_quantity > {t} AS INTEGER) AS v{i}" for i, t in enumerate(QUANTITY_RULES))
MARGIN = " + ".join(f"({a}) * (2 * v{i} - 1)" for i, a in enumerate(RULE_ALPHAS))
SHARE = "(" + " + ".join(f"v{i}" for i in range(len(QUANTITY_RULES))) + f") / {len(QUANTITY_RULES)}.0"

RULES = f"""
rule_lines AS (
  SELECT {LINE_KEY}, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, {VOTES} FROM lineitem
)"""


def fold(key: str, k: int = 10) -> str:
    return f"CAST(CAST(concat('0x', substr(md5({key}), 1, 8)) AS BIGINT) % {k} AS INTEGER)"


LINE_FOLD = fold("concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)")

PREDICTIONS = (
    RULES
    + f""",
scored AS (
  SELECT *, 'vote' AS model, CAST({SHARE} AS DOUBLE) AS p1 FROM rule_lines
  UNION ALL SELECT *, 'weighted', 1 / (1 + exp(-CAST({MARGIN} AS DOUBLE))) FROM rule_lines
  UNION ALL SELECT *, 'price', l_extendedprice / 110000.0 FROM rule_lines
),
preds AS (
  SELECT model, {LINE_FOLD} AS fold, {LINE_KEY}, label, p1, CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored
)"""
)

METRICS = (
    PREDICTIONS
    + """,
ranked AS (
  SELECT model, fold, label, prediction,
         rank() OVER (PARTITION BY model, fold ORDER BY p1)
           + (count(*) OVER (PARTITION BY model, fold, p1) - 1) / 2.0 AS mean_rank
  FROM preds
),
sums AS (
  SELECT model, fold,
         CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS n,
         sum(CASE WHEN label = 1 THEN mean_rank ELSE 0 END) AS ranks,
         CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
         CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
         CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
         CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn
  FROM ranked GROUP BY model, fold
),
rates AS (
  SELECT *,
         coalesce(tp / nullif(tp + fp, 0), 0) AS precision1, coalesce(tn / nullif(tn + fn, 0), 0) AS precision0,
         coalesce(tp / nullif(p, 0), 0) AS recall1, coalesce(tn / nullif(n, 0), 0) AS recall0
  FROM sums
),
wide AS (
  SELECT model, fold,
         (ranks - p * (p + 1) / 2) / nullif(p * n, 0) AS auc,
         (tp + tn) / (p + n) AS accuracy,
         (p * precision1 + n * precision0) / (p + n) AS weighted_precision,
         (p * recall1 + n * recall0) / (p + n) AS weighted_recall,
         (p * coalesce(2 * precision1 * recall1 / nullif(precision1 + recall1, 0), 0)
          + n * coalesce(2 * precision0 * recall0 / nullif(precision0 + recall0, 0), 0)) / (p + n) AS weighted_f1
  FROM rates
),
metrics AS (
  UNPIVOT wide ON auc, accuracy, weighted_precision, weighted_recall, weighted_f1 INTO NAME metric VALUE value
),
comparison AS (
  SELECT model,
         avg(CASE WHEN metric = 'auc' THEN value END) AS auc_mean,
         stddev_pop(CASE WHEN metric = 'auc' THEN value END) AS auc_std,
         avg(CASE WHEN metric = 'accuracy' THEN value END) AS accuracy_mean,
         stddev_pop(CASE WHEN metric = 'accuracy' THEN value END) AS accuracy_std,
         avg(CASE WHEN metric = 'weighted_f1' THEN value END) AS weighted_f1_mean,
         stddev_pop(CASE WHEN metric = 'weighted_f1' THEN value END) AS weighted_f1_std
  FROM metrics GROUP BY model
)"""
)


def rounds(columns: list[str], places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns)


COMPARISON_COLUMNS = rounds([f"{m}_{s}" for m in ("auc", "accuracy", "weighted_f1") for s in ("mean", "std")])
POSITION = "CAST(list_position([" + ", ".join(f"'{m}'" for m in RULE_MODELS) + "], model) AS INTEGER)"


def metric_of(name: str) -> str:
    return f"WITH {METRICS} SELECT model, fold, round({name}, 6) AS {name} FROM wide"


# Slots of the assembled vector: three numbers, then a slot per category by falling frequency.
INDEXED = (
    DERIVED
    + """,
marital AS (
  SELECT MARITAL_STATUS, row_number() OVER (ORDER BY count(*) DESC, MARITAL_STATUS) - 1 AS marital_idx
  FROM features GROUP BY MARITAL_STATUS
),
gender AS (
  SELECT GENDER_DESC, row_number() OVER (ORDER BY count(*) DESC, GENDER_DESC) - 1 AS gender_idx
  FROM features GROUP BY GENDER_DESC
),
indexed AS (SELECT * FROM features JOIN marital USING (MARITAL_STATUS) JOIN gender USING (GENDER_DESC))
"""
)
SLOT_VALUES = [
    "CAST(AGE_AT_APPLICATION AS DOUBLE)",
    "CAST(APPLICANT_FAMILY_COUNT AS DOUBLE)",
    "CAST(APPLICATION_YEAR AS DOUBLE)",
    *[f"CASE WHEN marital_idx = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for i in range(5)],
    *[f"CASE WHEN gender_idx = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for i in range(5)],
]
SLOTS = (
    INDEXED
    + ", slots AS (SELECT row_key, "
    + ", ".join(f"{value} AS f{i:02d}" for i, value in enumerate(SLOT_VALUES))
    + " FROM indexed)"
)
SLOT_NAMES = [f"f{i:02d}" for i in range(len(SLOT_VALUES))]
SCALED = f"WITH {SLOTS} SELECT row_key, " + ", ".join(
    f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0), 6) + 0.0 AS {c}"
    for c in SLOT_NAMES
) + " FROM slots"

PRICE_VOTES = [f"CAST(o_totalprice > {t} AS INTEGER)" for t in PRICE_RULES]
PRICE_SUM = " + ".join(PRICE_VOTES)
PRICE_MARGIN = " + ".join(f"({a}) * (2 * {v} - 1)" for a, v in zip(RULE_ALPHAS, PRICE_VOTES))

BOX = """
amounts AS (SELECT l_returnflag, l_quantity * l_extendedprice AS amount FROM lineitem),
boxes AS (
  SELECT l_returnflag, count(*) AS n, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS median,
         quantile_cont(amount, 0.75) AS q3
  FROM amounts GROUP BY l_returnflag
),
marked AS (
  SELECT *, amount BETWEEN q1 - (q3 - q1) AND q3 + (q3 - q1) AS inside FROM amounts JOIN boxes USING (l_returnflag)
)"""

DISTANCES = ", ".join(
    f"(AGE_AT_APPLICATION - {c[0]}) ^ 2 + (APPLICANT_FAMILY_COUNT - {c[1]}) ^ 2" for c in CENTERS
)
CLUSTERED = (
    DERIVED
    + f""",
distances AS (SELECT *, [{DISTANCES}] AS d FROM features),
clustered AS (SELECT *, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster FROM distances)
"""
)


def poisson_case(draw: str, rate: float = 1.0) -> str:
    """Copies by a 32-bit draw: the number of cumulative Poisson probabilities at or below it."""
    total, term, cases = 0.0, math.exp(-rate), []
    for n in range(14):
        total += term
        cases.append(f"WHEN {draw} < {round(total * 2**32)} THEN {n}.0::DOUBLE")
        term *= rate / (n + 1)
    return "CASE " + " ".join(cases) + " END"


def boosting_rounds() -> str:
    """One weight table per round; the learner of round t is quantity rule t."""
    ctes = [RULES.strip(), "w0 AS MATERIALIZED (SELECT *, 1.0::DOUBLE / (SELECT count(*) FROM rule_lines) AS w FROM rule_lines)"]
    picks = []
    for t in range(len(QUANTITY_RULES)):
        ctes.append(f"e{t} AS MATERIALIZED (SELECT sum(CASE WHEN v{t} <> label THEN w ELSE 0 END) AS err FROM w{t})")
        ctes.append(f"a{t} AS MATERIALIZED (SELECT err, 0.5 * ln((1 - err) / err) AS alpha FROM e{t})")
        ctes.append(
            f"u{t} AS MATERIALIZED (SELECT * REPLACE "
            f"(w * exp((SELECT alpha FROM a{t}) * CASE WHEN v{t} <> label THEN 1 ELSE -1 END) AS w) FROM w{t})"
        )
        ctes.append(f"w{t + 1} AS MATERIALIZED (SELECT * REPLACE (w / (SELECT sum(w) FROM u{t}) AS w) FROM u{t})")
        picks.append(f"SELECT {t} AS round, round(err, 6) AS err, round(alpha, 6) AS alpha FROM a{t}")
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(picks)


# A depth-1 learner, or any majority vote over such learners, predicts each flag's majority.
MAJORITY = f"""WITH {DERIVED},
sides AS (SELECT flag, count(*) AS n, avg(label) AS share FROM labelled GROUP BY flag)
SELECT CAST(flag AS DOUBLE) AS flag, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, n FROM sides"""


def weighted_majority_rounds(n: int) -> str:
    """Boosting over the (age group, label) cells: a learner predicts each group's heavier label."""
    ctes = [
        "c0 AS MATERIALIZED (SELECT AGE_GROUP, label, count(*) / sum(count(*)) OVER () AS w FROM labelled GROUP BY AGE_GROUP, label)"
    ]
    picks = []
    for t in range(n):
        ctes.append(
            f"m{t} AS MATERIALIZED (SELECT *, label <> CASE WHEN sum(w * label) OVER g > sum(w) OVER g / 2 THEN 1 ELSE 0 END AS missed "
            f"FROM c{t} WINDOW g AS (PARTITION BY AGE_GROUP))"
        )
        ctes.append(f"e{t} AS MATERIALIZED (SELECT sum(CASE WHEN missed THEN w ELSE 0 END) AS err FROM m{t})")
        ctes.append(
            f"c{t + 1} AS MATERIALIZED (SELECT AGE_GROUP, label, w / CASE WHEN missed THEN 2 * err ELSE 2 * (1 - err) END AS w "
            f"FROM m{t} CROSS JOIN e{t})"
        )
        picks.append(f"SELECT {t} AS round, round(err, 6) AS err, round(0.5 * ln((1 - err) / err), 6) AS alpha FROM e{t}")
    return f"WITH {DERIVED}, " + ", ".join(ctes) + " " + " UNION ALL ".join(picks)


# Each fold's flag is scored by the share of label 1 in the other folds.
HELD_OUT = f"""{DERIVED},
folded AS (SELECT flag, label, {fold('CAST(row_key AS VARCHAR)', 5)} AS fold FROM labelled),
cells AS (SELECT fold, flag, sum(label) AS pos, count(*) AS n FROM folded GROUP BY fold, flag),
held AS (
  SELECT fold, CAST(flag AS DOUBLE) AS flag, n,
         (sum(pos) OVER f - pos) AS pos_out, (sum(n) OVER f - n) AS n_out, (sum(pos) OVER f - pos) / (sum(n) OVER f - n) AS share
  FROM cells WINDOW f AS (PARTITION BY flag)
)"""
HELD_PREDICTION = "CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction"

RULE_MISSES = [
    f"SELECT {t} AS rule, avg(CASE WHEN v{i} <> label THEN 1.0 ELSE 0.0 END) AS err FROM rule_lines"
    for i, t in enumerate(QUANTITY_RULES)
]


def bootstrap_votes(trees: int = 25) -> str:
    """Each bootstrap's weights, its best split by the Gini impurity that is left, the votes of both sides, and their share."""
    held = ", ".join(f"CAST({c} AS INTEGER) AS {n}" for n, c in EIGHT_FLAGS.items())
    sides = " UNION ALL ".join(f"SELECT tree, {j} AS slot, {n} AS side, sum(w) AS n, sum(w * y) AS pos FROM draws GROUP BY tree, {n}" for j, n in enumerate(EIGHT_FLAGS))
    side = "CASE slot " + " ".join(f"WHEN {j} THEN {n}" for j, n in enumerate(EIGHT_FLAGS)) + " END"
    names = ", ".join(EIGHT_FLAGS)
    doubles = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in EIGHT_FLAGS)
    return f"""WITH {DERIVED},
held AS (SELECT row_key, CAST(row_key % 2 = 0 AS INTEGER) AS y, {held} FROM labelled),
numbers AS (SELECT *, CAST(concat('0x', substr(md5(concat_ws('|', '42', tree, row_key)), 1, 8)) AS BIGINT) AS u
  FROM held CROSS JOIN (SELECT unnest(range({trees})) AS tree)),
draws AS MATERIALIZED (SELECT * FROM (SELECT *, {poisson_case('u')} AS w FROM numbers) WHERE w > 0),
sides AS MATERIALIZED ({sides}),
best AS (SELECT tree, arg_max(slot, (score, -slot)) AS slot FROM (
  SELECT tree, slot, sum((pos * pos + (n - pos) * (n - pos)) / n) AS score FROM sides GROUP BY tree, slot) GROUP BY tree),
leaves AS (SELECT s.tree, s.slot, s.side, CASE WHEN s.pos > s.n - s.pos THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS vote
  FROM sides s JOIN best b ON b.tree = s.tree AND b.slot = s.slot),
cells AS (SELECT {names}, count(*) AS n FROM held GROUP BY {names}),
shares AS (SELECT {names}, any_value(n) AS n, sum(vote) / {trees} AS p1 FROM cells JOIN leaves ON side = {side} GROUP BY {names})
SELECT {doubles}, round(p1, 6) AS p1, CASE WHEN p1 >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, n FROM shares"""


def statements() -> dict[str, str]:
    a, d = f"WITH {APPLICANTS}", f"WITH {DERIVED}"
    p, m = f"WITH {PREDICTIONS}", f"WITH {METRICS}"
    r = f"WITH {RULES}"
    return fold_statements(DERIVED, fold("CAST(row_key AS VARCHAR)")) | {
        # sources, sinks, actions
        "scan_csv": f"{a} SELECT * REPLACE (round(AGE, 6) AS AGE) FROM applicants",
        "scan_csv_whole_numbers": f"{a} SELECT row_key, CASE WHEN row_key % 5 < 3 THEN APPLICANT_FAMILY_COUNT END "
        "AS APPLICANT_FAMILY_COUNT FROM applicants",
        "scan_report": f"{a} SELECT 'APPLICANT_FAMILY_COUNT' AS column, count(*) FILTER (row_key % 5 = 4 OR "
        "row_key % 5 < 3 AND APPLICANT_FAMILY_COUNT IS NOT NULL) AS filled, "
        "count(*) FILTER (row_key % 5 = 4) AS unreadable FROM applicants "
        "UNION ALL SELECT 'MARITAL_STATUS', count(MARITAL_STATUS), 0::BIGINT FROM applicants",
        "scan_parquet": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate, round(o_totalprice, 6) AS o_totalprice) FROM orders",
        "row_count": "SELECT 'orders' AS stage, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer "
        "UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
        "stage_counts": f"{d} SELECT 'loaded' AS stage, count(*) AS n FROM applicants UNION ALL SELECT 'complete', count(*) FROM complete "
        "UNION ALL SELECT 'valid_age', count(*) FROM features",
        "preview": f"{d} SELECT row_key, AGE_AT_APPLICATION, APPLICATION_YEAR, PROCESSING_DAYS, APPROVAL_LABEL, AGE_GROUP, FAMILY_SIZE_CATEGORY "
        "FROM features ORDER BY row_key LIMIT 30",
        "schema_report": "SELECT column_name AS \"column\", CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' "
        "WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS type, "
        "is_nullable = 'YES' AS nullable FROM information_schema.columns WHERE table_name = 'orders'",
        "collect_scalar": "SELECT count(*) AS n, round((SELECT sum(l_quantity) FROM lineitem) / count(*), 6) AS per_order FROM orders",
        "to_local": f"{d} SELECT AGE_GROUP, count(*) AS n FROM features GROUP BY AGE_GROUP",
        "sink_results": "SELECT 'o_orderstatus' AS result, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY o_orderstatus "
        "UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority",
        "published_results": "SELECT 'o_orderstatus' AS result, o_orderstatus AS value, count(*) AS n, true AS whole, true AS same_set FROM orders "
        "GROUP BY o_orderstatus UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*), true, true FROM orders GROUP BY o_orderpriority",
        "observed_counts": f"{d} SELECT 'loaded' AS stage, count(*) AS n FROM applicants UNION ALL SELECT 'complete', count(*) FROM complete "
        "UNION ALL SELECT 'valid_age', count(*) FROM features UNION ALL SELECT 'prepared', count(*) FROM features",
        # cleaning, projection, filters
        "drop_null_subset": f"{a} SELECT row_key, round(AGE, 6) AS AGE, APPLICANT_FAMILY_COUNT, MARITAL_STATUS, GENDER_DESC FROM applicants "
        "WHERE AGE IS NOT NULL AND APPLICANT_FAMILY_COUNT IS NOT NULL AND MARITAL_STATUS IS NOT NULL AND GENDER_DESC IS NOT NULL",
        "cast_to_date": f"{a} SELECT row_key, APPLICATION_DATE, APPROVED_DATE, APPLICANT_BIRTH_DATE FROM applicants",
        "cast_int": f"{a} SELECT row_key, CAST(trunc(AGE) AS INTEGER) AS AGE FROM applicants",
        "cast_double_label": f"{d} SELECT row_key, CAST(label AS DOUBLE) AS LEARNED_LABEL FROM labelled",
        "drop_column": "SELECT * EXCLUDE (c_name) REPLACE (round(c_acctbal, 6) AS c_acctbal) FROM customer",
        "project": "SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key, "
        "round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem",
        "add_column": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year, round(o_totalprice / 2, 6) AS o_half FROM orders",
        "filter_range": f"{d} SELECT row_key, AGE_AT_APPLICATION FROM features",
        "filter_eq": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
        "filter_ne": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'",
        "binary_label": f"{a} SELECT row_key, CASE WHEN APPLICATION_STATUS_NAME = 'F' THEN 1 ELSE 0 END AS APPROVAL_LABEL FROM applicants",
        "bucketize_case": f"{d} SELECT row_key, AGE_GROUP, FAMILY_SIZE_CATEGORY FROM derived",
        "threshold_predict": f"SELECT {LINE_KEY}, CASE WHEN l_discount * 10 >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM lineitem",
        "feature_table": f"{d} SELECT * FROM features",
        # scalar functions
        "months_between_years": f"{a} SELECT row_key, {YEARS} AS years FROM applicants",
        "year_of": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders",
        "date_diff_days": f"{a} SELECT row_key, CAST(date_diff('day', APPLICATION_DATE, APPROVED_DATE) AS INTEGER) AS days FROM applicants",
        "arith": f"SELECT {LINE_KEY}, round(l_quantity + l_linenumber, 8) AS plus, round(l_extendedprice - l_quantity, 8) AS minus, "
        "round(l_quantity * l_linenumber, 8) AS times, round(l_extendedprice / l_quantity, 8) AS over, l_orderkey % 7 AS modulo, "
        "round(-l_quantity, 8) AS negated, 1.5::DOUBLE AS literal FROM lineitem",
        "literal": "SELECT c_custkey, 1.0::DOUBLE AS one, 'x' AS letter FROM customer",
        "exp_sigmoid": f"SELECT {LINE_KEY}, round(1 / (1 + exp(-(l_quantity / 10 - 2.5::DOUBLE))), 6) AS p1 FROM lineitem",
        "row_id": "SELECT count(*) AS n, count(*) AS n_ids FROM orders",
        "to_prob_vec": f"SELECT {LINE_KEY}, round(1 - l_discount, 6) AS p0, round(l_discount, 6) AS p1 FROM lineitem",
        # joins
        "vote_join": f"SELECT o_orderkey, CAST({PRICE_SUM} AS BIGINT) AS votes, round(({PRICE_SUM}) / {len(PRICE_RULES)}.0::DOUBLE, 6) AS p1 FROM orders",
        "vote_join_gaps": f"SELECT o_orderkey, CAST({PRICE_SUM} AS BIGINT) AS votes, "
        f"round(({PRICE_SUM}) / {len(PRICE_RULES)}.0::DOUBLE, 6) AS p1 FROM orders WHERE "
        + " AND ".join(f"(o_orderkey % 11 = {i}) = (o_orderkey % 13 = {i})" for i in range(len(PRICE_RULES))),
        "label_join": f"SELECT o_orderkey, CAST({PRICE_SUM} AS BIGINT) AS votes, round(({PRICE_SUM}) / {len(PRICE_RULES)}.0::DOUBLE, 6) AS p1, "
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders",
        "score_join": f"SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, "
        f"round(CAST({PRICE_MARGIN} AS DOUBLE), 6) AS margin FROM orders",
        # aggregation and profiling
        "value_counts": f"{d} SELECT AGE_GROUP AS value, count(*) AS n FROM features GROUP BY AGE_GROUP",
        "value_counts_many": f"{d} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM features GROUP BY {c}"
            for c in ("APPROVAL_LABEL", "MARITAL_STATUS", "GENDER_DESC", "AGE_GROUP", "FAMILY_SIZE_CATEGORY")
        ),
        "describe_numeric": f"{d} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM features"
            for c in ("AGE_AT_APPLICATION", "APPLICANT_FAMILY_COUNT", "APPLICATION_YEAR")
        ),
        "corr_matrix": f"{d} " + _corr(["AGE_AT_APPLICATION", "APPLICANT_FAMILY_COUNT", "APPLICATION_YEAR", "APPROVAL_LABEL"], "features"),
        "corr_matrix_with_nulls": f"{a}, flat AS (SELECT *, 1 AS CONSTANT FROM applicants) "
        + _corr(["AGE", "APPLICANT_FAMILY_COUNT", "CONSTANT"], "flat"),
        "sum_agg": "SELECT l_returnflag, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net "
        "FROM lineitem GROUP BY l_returnflag",
        "avg_agg": f"{d} SELECT MARITAL_STATUS, round(avg(AGE_AT_APPLICATION), 6) AS avg_age, "
        "round(avg(APPLICANT_FAMILY_COUNT), 6) AS avg_family FROM features GROUP BY MARITAL_STATUS",
        "group_rate": f"{d} SELECT AGE_GROUP, count(*) AS n, round(avg(APPROVAL_LABEL) * 100, 6) AS rate FROM features GROUP BY AGE_GROUP",
        "group_mode_top_n": "WITH c AS (SELECT l_returnflag, l_partkey AS value, count(*) AS count FROM lineitem GROUP BY ALL), "
        "o AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY count DESC, value) AS INTEGER) AS rank FROM c) "
        "SELECT * FROM o WHERE rank <= 5",
        "boxplot_stats": f"WITH {BOX} SELECT l_returnflag, any_value(n) AS n, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, "
        "round(any_value(q3), 4) AS q3, round(min(CASE WHEN inside THEN amount END), 4) AS whisker_low, "
        "round(max(CASE WHEN inside THEN amount END), 4) AS whisker_high, "
        "CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers FROM marked GROUP BY l_returnflag",
        "boxplot_outliers": f"WITH {BOX} SELECT l_returnflag, round(amount, 4) AS amount, count(*) AS n FROM marked WHERE NOT inside "
        "GROUP BY l_returnflag, marked.amount",
        "share_of_total": "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS amount, "
        "round(sum(o_totalprice) * 100 / (SELECT sum(o_totalprice) FROM orders), 2) AS pct FROM orders GROUP BY o_orderpriority",
        "top_n_with_others": "WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS name, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey), "
        "o AS (SELECT *, row_number() OVER (ORDER BY total DESC, name) AS place FROM s) "
        "SELECT CASE WHEN place <= 5 THEN name ELSE 'Others' END AS o_custkey, round(sum(total), 2) AS o_totalprice, "
        "CAST(min(least(place, 6)) AS INTEGER) AS position FROM o GROUP BY CASE WHEN place <= 5 THEN name ELSE 'Others' END",
        # folds, metrics, comparison
        "fold_assign": f"SELECT o_orderkey, {fold('CAST(o_orderkey AS VARCHAR)')} AS fold FROM orders",
        "fold_split": f"SELECT CASE WHEN {fold('CAST(o_orderkey AS VARCHAR)')} = 3 THEN 'test' ELSE 'train' END AS part, count(*) AS n, "
        "round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1",
        "cross_validate": f"""{d},
folded AS (SELECT row_key, MARITAL_STATUS, AGE_GROUP, label, {fold('CAST(row_key AS VARCHAR)')} AS fold FROM labelled),
cells AS (SELECT MARITAL_STATUS, AGE_GROUP, fold, sum(label) AS pos, count(*) AS n FROM folded GROUP BY ALL),
held AS (
  SELECT fold, MARITAL_STATUS, AGE_GROUP,
         (sum(pos) OVER (PARTITION BY MARITAL_STATUS, AGE_GROUP) - pos)
         / nullif(sum(n) OVER (PARTITION BY MARITAL_STATUS, AGE_GROUP) - n, 0) AS rate
  FROM cells
)
SELECT fold, row_key, label, CASE WHEN coalesce(rate, 0.5) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
       round(CAST(coalesce(rate, 0.5) AS DOUBLE), 6) AS p1
FROM folded JOIN held USING (fold, MARITAL_STATUS, AGE_GROUP)""",
        **{name: metric_of(name) for name in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")},
        "auc_roc": metric_of("auc"),
        "fold_metrics": f"{m} SELECT model, fold, metric, round(value, 6) AS value FROM metrics",
        "metrics_null_labels": "WITH " + METRICS.replace("  FROM preds\n", "  FROM preds WHERE l_orderkey % 7 > 1\n")
        + " SELECT model, fold, metric, round(value, 6) AS value FROM metrics WHERE metric IN ('accuracy', 'auc', 'weighted_recall')",
        "cv_summary": f"{m} SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(value) AS n_folds FROM metrics GROUP BY model, metric",
        "fold_series": f"{m} SELECT model, metric, fold, round(value, 6) AS value, "
        "round(avg(value) OVER (PARTITION BY model, metric), 6) AS mean FROM metrics",
        "model_comparison": f"{m} SELECT model, {COMPARISON_COLUMNS}, {POSITION} AS position FROM comparison",
        "best_model": f"{m} SELECT model, {COMPARISON_COLUMNS}, {POSITION} AS position FROM comparison "
        f"ORDER BY comparison.auc_mean DESC, {POSITION} LIMIT 1",
        "confusion_matrix": f"{p} SELECT model, fold, label, prediction, count(*) AS n FROM preds GROUP BY model, fold, label, prediction",
        "roc_curve": f"""{p},
points AS (SELECT model, p1, sum(label) AS pos, sum(1 - label) AS neg FROM preds GROUP BY model, p1),
summed AS (
  SELECT model, p1, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp,
         sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
  FROM points WINDOW down AS (PARTITION BY model ORDER BY p1 DESC)
)
SELECT model, round(p1, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(CAST(tp AS DOUBLE) / p, 6) AS tpr, round(CAST(fp AS DOUBLE) / n, 6) AS fpr FROM summed""",
        # feature preparation
        "string_index": f"WITH {INDEXED} SELECT row_key, CAST(marital_idx AS DOUBLE) AS MARITAL_STATUS_IDX, CAST(gender_idx AS DOUBLE) AS GENDER_DESC_IDX FROM indexed",
        "string_index_wide": "WITH counted AS (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, "
        "CAST(l_partkey AS VARCHAR)) - 1 AS part_index FROM lineitem GROUP BY l_partkey) "
        f"SELECT {LINE_KEY}, part_index FROM lineitem JOIN counted USING (l_partkey)",
        "one_hot": f"WITH {INDEXED} SELECT row_key, "
        + ", ".join(f"CASE WHEN marital_idx = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS m{i}" for i in range(5))
        + " FROM indexed",
        "assemble": f"WITH {SLOTS} SELECT row_key, {rounds(SLOT_NAMES)} FROM slots",
        "standardize": SCALED,
        "prep_pipeline": SCALED,
        "feature_names": f"""WITH {INDEXED}
SELECT 0 AS slot, 'AGE_AT_APPLICATION' AS name UNION ALL SELECT 1, 'APPLICANT_FAMILY_COUNT' UNION ALL SELECT 2, 'APPLICATION_YEAR'
UNION ALL SELECT CAST(3 + marital_idx AS INTEGER), 'MARITAL_STATUS_VEC_' || MARITAL_STATUS FROM marital
UNION ALL SELECT CAST(3 + (SELECT count(*) FROM marital) + gender_idx AS INTEGER), 'GENDER_DESC_VEC_' || GENDER_DESC FROM gender""",
        # models and ensembles
        "bootstrap_sample": "WITH draws AS (SELECT o_orderkey, CAST(concat('0x', substr(md5(concat_ws('|', '42', '3', o_orderkey)), 1, 8)) AS BIGINT) AS u FROM orders), "
        f"copies AS (SELECT o_orderkey, {poisson_case('u')} AS w FROM draws) SELECT * FROM copies WHERE w > 0",
        "tree_fit": MAJORITY,
        "tree_fit_five_flags": f"{d} SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {n}' for n, c in FIVE_FLAGS.items())}, "
        f"CASE WHEN avg(label) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, count(*) AS n FROM labelled GROUP BY {', '.join(str(i + 1) for i in range(5))}",
        "bagging_fit_bootstraps": bootstrap_votes(),
        "bagging_fit": MAJORITY,
        "bagging_fit_separate": MAJORITY,
        "gbt_fit": MAJORITY,
        "majority_vote": f"{r} SELECT {LINE_KEY}, label, round(CAST({SHARE} AS DOUBLE), 6) AS p1, "
        f"CASE WHEN {SHARE} >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(1 - CAST({SHARE} AS DOUBLE), 6) AS p0 FROM rule_lines",
        "logreg_fit": f"{d} SELECT CAST(flag AS DOUBLE) AS flag, count(*) AS n, round(avg(label), 3) AS p1 FROM labelled GROUP BY flag",
        "weak_learner_fit": f"{d} SELECT CAST(flag AS DOUBLE) AS flag, count(*) AS n, round(sum(label * (label + 1.0)) / sum(label + 1.0), 3) AS p1 "
        "FROM labelled GROUP BY flag",
        "weighted_error": f"{r}, e AS ({' UNION ALL '.join(RULE_MISSES)}) SELECT rule, round(err, 6) AS err, 1.0::DOUBLE AS total FROM e",
        "boost_alpha": f"{r}, e AS ({' UNION ALL '.join(RULE_MISSES)}) SELECT rule, round(err, 6) AS err, round(0.5 * ln((1 - err) / err), 6) AS alpha FROM e",
        "boost_reweight": f"{r}, e AS (SELECT avg(CASE WHEN v2 <> label THEN 1.0 ELSE 0.0 END) AS err FROM rule_lines) "
        f"SELECT {LINE_KEY}, round(CASE WHEN v2 <> label THEN 0.5 / err ELSE 0.5 / (1 - err) END, 6) AS relative_weight FROM rule_lines CROSS JOIN e",
        "boost_rounds": boosting_rounds(),
        "adaboost_fit": weighted_majority_rounds(3),
        "cross_validate_logistic_by_flag": f"WITH {HELD_OUT} SELECT fold, flag, {HELD_PREDICTION}, n, round(share, 3) AS p1 FROM held",
        "cross_validate_fold_scope_by_flag": f"WITH {HELD_OUT} SELECT fold, flag, {HELD_PREDICTION}, n, round(share, 3) AS p1 FROM held",
        "feature_importance_by_flag": f"""{d},
sides AS (
  SELECT 'large_family' AS feature, 0 AS slot, count(*) AS n, var_pop(label) AS spread FROM labelled GROUP BY APPLICANT_FAMILY_COUNT > 3
  UNION ALL SELECT 'older', 1, count(*), var_pop(label) FROM labelled GROUP BY AGE_AT_APPLICATION > 35
),
leftover AS (SELECT feature, slot, sum(n * spread) AS inside FROM sides GROUP BY feature, slot),
won AS (SELECT feature, slot, CASE WHEN inside = min(inside) OVER () THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM leftover)
SELECT CAST(row_number() OVER (ORDER BY importance DESC, slot) AS INTEGER) AS rank, feature, importance FROM won""",
        "cross_validate_bagging_by_flag": f"WITH {HELD_OUT} SELECT fold, flag, {HELD_PREDICTION}, n, "
        "CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p1 FROM held",
        "cross_validate_adaboost_by_flag": f"""WITH {HELD_OUT},
errors AS (SELECT *, sum(least(pos_out, n_out - pos_out)) OVER e / sum(n_out) OVER e AS err FROM held WINDOW e AS (PARTITION BY fold))
SELECT fold, flag, {HELD_PREDICTION}, n,
       round(1 / (1 + exp(-0.5 * ln((1 - err) / err) * CASE WHEN share > 0.5 THEN 1 ELSE -1 END)), 3) AS p1 FROM errors""",
        "adaboost_first_round": f"""{d},
sides AS (SELECT flag, count(*) AS n, avg(label) AS share FROM labelled GROUP BY flag),
miss AS (SELECT sum(n * least(share, 1 - share)) / sum(n) AS err FROM sides),
voted AS (SELECT flag, n, CASE WHEN share > 0.5 THEN 1 ELSE 0 END AS vote, 0.5 * ln((1 - err) / err) AS alpha FROM sides CROSS JOIN miss)
SELECT CAST(flag AS DOUBLE) AS flag, CAST(vote AS DOUBLE) AS prediction, round(1 / (1 + exp(-alpha * (2 * vote - 1))), 6) AS p1, n FROM voted""",
        "weighted_vote": f"{r}, s AS (SELECT *, CAST({MARGIN} AS DOUBLE) AS margin FROM rule_lines) "
        f"SELECT {LINE_KEY}, round(margin, 6) + 0.0 AS margin, round(1 / (1 + exp(-margin)), 6) AS p1, "
        "CASE WHEN 1 / (1 + exp(-margin)) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM s",
        # clustering
        "kmeans_fit": f"{d} SELECT CAST(flag AS DOUBLE) AS flag, CAST(flag AS DOUBLE) AS center, count(*) AS n FROM labelled GROUP BY flag",
        "nearest_center_nulls": """WITH far AS (SELECT o_orderkey, pow(o_totalprice / 1000.0, 2) AS a,
  pow(o_totalprice / 1000.0 - 100, 2) AS b, pow(o_totalprice / 1000.0 - 200, 2) AS c FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN NULL WHEN a <= b AND a <= c THEN 0
  WHEN b <= c THEN 1 ELSE 2 END::INTEGER AS cluster FROM far""",
        "nearest_center": """WITH slots AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
centers AS (SELECT label, i, avg(x) AS c FROM slots GROUP BY label, i),
distances AS (SELECT vec_id, centers.label AS center, sum((x - c) ^ 2) AS d FROM slots JOIN centers USING (i) GROUP BY vec_id, centers.label),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY center) - 1 AS nearest FROM distances)
SELECT vec_id, CAST(arg_min(nearest, d) AS INTEGER) AS nearest FROM numbered GROUP BY vec_id""",
        "silhouette": """WITH points AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sizes AS (SELECT label, count(*) AS size FROM points GROUP BY label),
pairs AS (
  SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.e, b.e) ^ 2) AS d
  FROM points a CROSS JOIN points b GROUP BY ALL
),
near AS (
  SELECT vec_id, own, max(CASE WHEN own = other THEN d / nullif(size - 1, 0) END) AS inside,
         min(CASE WHEN own <> other THEN d / size END) AS outside
  FROM pairs JOIN sizes ON other = label GROUP BY vec_id, own
)
SELECT count(*) AS n, round(avg(coalesce((outside - inside) / greatest(inside, outside), 0)), 6) AS silhouette FROM near""",
        "cluster_sizes": f"WITH {CLUSTERED} SELECT cluster, count(*) AS n FROM clustered GROUP BY cluster",
        "cluster_profile": f"WITH {CLUSTERED} SELECT cluster, count(*) AS n, round(avg(AGE_AT_APPLICATION), 6) AS avg_AGE_AT_APPLICATION, "
        "round(avg(APPLICANT_FAMILY_COUNT), 6) AS avg_APPLICANT_FAMILY_COUNT, round(avg(APPROVAL_LABEL) * 100, 6) AS rate FROM clustered GROUP BY cluster",
        "cluster_modes": f"WITH {CLUSTERED}, c AS (SELECT cluster, MARITAL_STATUS AS value, count(*) AS count FROM clustered GROUP BY ALL) "
        "SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY count DESC, value) AS INTEGER) AS rank FROM c",
        "approval_by_age_group": f"{d} SELECT AGE_GROUP, count(*) AS n, round(avg(AGE_AT_APPLICATION), 6) AS avg_age, "
        "round(avg(APPROVAL_LABEL) * 100, 6) AS approval_rate FROM features GROUP BY AGE_GROUP",
    }


def _corr(names: list[str], source: str) -> str:
    """Pearson over the rows where both are present; null where either is constant there."""
    parts = []
    for x in names:
        for y in names:
            r = f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN round(corr({x}, {y}), 6) END"
            parts.append(f"SELECT '{x}' AS a, '{y}' AS b, {r} AS r FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL")
    return " UNION ALL ".join(parts)
