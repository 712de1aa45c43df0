"""The same results as DuckDB SQL: training parts spelled out, Newton and Lloyd steps one statement each."""

from __future__ import annotations

from foldwright.checks.inputs import SWEEP_STARTS

STEPS = 9
#: Ages are moved and scaled for the Newton steps; the coefficients are turned back at the end.
_MIDDLE, _UNIT = 60.0, 25.0


def _training(derived: str, fold: str) -> str:
    """Rows with their fold, and once more for every training part that they are in."""
    return f"""{derived},
folded AS (SELECT *, {fold} AS fold FROM labelled),
training AS (SELECT part, folded.* FROM folded JOIN (SELECT unnest(range(10))::INTEGER AS part) ON fold <> part)"""


def _slots(training: str) -> str:
    def category(column: str, offset: str) -> str:
        return f"""
  SELECT c.part, ({offset} + row_number() OVER (PARTITION BY c.part ORDER BY c.n DESC, c.value) - 1)::INTEGER AS slot,
         '{column}_VEC_' || c.value AS name, '{column}' AS field, c.value,
         c.n / t.n AS mean, sqrt(c.n * (t.n - c.n) / t.n / (t.n - 1)) AS std
  FROM (SELECT part, {column} AS value, count(*)::DOUBLE AS n FROM training GROUP BY part, {column}) c
  JOIN (SELECT part, count(*)::DOUBLE AS n FROM training GROUP BY part) t ON t.part = c.part"""

    numbers = " UNION ALL ".join(
        f"SELECT part, {i} AS slot, '{c}' AS name, '{c}' AS field, NULL AS value, avg({c})::DOUBLE AS mean, stddev_samp({c}) AS std FROM training GROUP BY part"
        for i, c in enumerate(["AGE_AT_APPLICATION", "APPLICANT_FAMILY_COUNT", "APPLICATION_YEAR"])
    )
    return f"""{training},
marital AS (SELECT part, count(DISTINCT MARITAL_STATUS) AS n FROM training GROUP BY part),
slots AS ({numbers} UNION ALL {category("MARITAL_STATUS", "3")} UNION ALL
  SELECT g.part, (g.slot + m.n)::INTEGER, g.name, g.field, g.value, g.mean, g.std FROM ({category("GENDER_DESC", "3")}) g JOIN marital m ON m.part = g.part)"""


def _rows(training: str) -> str:
    columns = ", ".join(f"max(CASE WHEN slot = {i} THEN x END) AS f{i:02d}" for i in range(13))
    return f"""WITH {_slots(training)},
scaled AS (
  SELECT row_key, fold, slot, round((CASE field WHEN 'AGE_AT_APPLICATION' THEN AGE_AT_APPLICATION
           WHEN 'APPLICANT_FAMILY_COUNT' THEN APPLICANT_FAMILY_COUNT WHEN 'APPLICATION_YEAR' THEN APPLICATION_YEAR
           WHEN 'MARITAL_STATUS' THEN (MARITAL_STATUS = value)::INTEGER ELSE (GENDER_DESC = value)::INTEGER END - mean) / std, 6) + 0.0 AS x
  FROM folded JOIN slots ON slots.part = folded.fold)
SELECT row_key, fold, {columns} FROM scaled GROUP BY row_key, fold"""


def _cells(training: str) -> str:
    """Rows that share age and label share all that follows from the age."""
    return f"""{training},
w0 AS MATERIALIZED (
  SELECT part, label AS y, (AGE_AT_APPLICATION - {_MIDDLE}) / {_UNIT} AS z, count(*) / sum(count(*)) OVER (PARTITION BY part) AS w
  FROM training GROUP BY part, label, AGE_AT_APPLICATION),
spread AS (SELECT part, var_samp((AGE_AT_APPLICATION - {_MIDDLE}) / {_UNIT}) AS v FROM training GROUP BY part)"""


def _newton(weights: str, name: str, ridge: float = 0.0) -> tuple[str, str]:
    """Steps from zero; the last table holds (part, a, s) with a + s * z the log odds. The penalty is on s in units of the spread of z."""
    ctes = [f"{name}0 AS (SELECT part, 0.0::DOUBLE AS a, 0.0::DOUBLE AS s FROM spread)"]
    for i in range(STEPS):
        ctes.append(
            f"""{name}{i + 1} AS MATERIALIZED (
  SELECT part, a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS a, s + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS s
  FROM (SELECT part, a, s, sum(w * (y - p)) AS g0, sum(w * (y - p) * z) - {ridge} * any_value(v) * s AS g1, sum(w * p * (1 - p)) AS h00,
               sum(w * p * (1 - p) * z) AS h01, sum(w * p * (1 - p) * z * z) + {ridge} * any_value(v) AS h11
        FROM (SELECT c.part, b.a, b.s, c.w, c.y, c.z, v.v, 1 / (1 + exp(-(b.a + b.s * c.z))) AS p
              FROM {weights} c JOIN {name}{i} b ON b.part = c.part JOIN spread v ON v.part = c.part) GROUP BY part, a, s))"""
        )
    return ", ".join(ctes), f"{name}{STEPS}"


def _logistic(training: str, ridge: float) -> str:
    steps, last = _newton("w0", "b", ridge)
    return f"""WITH {_cells(training)}, {steps}
SELECT part AS fold, round(a - s * {_MIDDLE / _UNIT}, 6) + 0.0 AS intercept, round(s / {_UNIT}, 6) + 0.0 AS slope FROM {last}"""


def _boosting(training: str, rounds: int) -> str:
    ctes, picks = [_cells(training)], []
    for t in range(rounds):
        steps, last = _newton(f"w{t}", f"b{t}_")
        ctes += [
            steps,
            f"m{t} AS MATERIALIZED (SELECT c.*, ((b.a + b.s * c.z > 0)::INTEGER <> c.y) AS missed FROM w{t} c JOIN {last} b ON b.part = c.part)",
            f"e{t} AS MATERIALIZED (SELECT part, sum(CASE WHEN missed THEN w ELSE 0 END) AS err FROM m{t} GROUP BY part)",
            f"w{t + 1} AS MATERIALIZED (SELECT m.part, m.y, m.z, m.w / CASE WHEN m.missed THEN 2 * e.err ELSE 2 * (1 - e.err) END AS w "
            f"FROM m{t} m JOIN e{t} e ON e.part = m.part)",
        ]
        picks.append(f"SELECT part AS fold, {t} AS round, round(err, 6) AS err, round(0.5 * ln((1 - err) / err), 6) + 0.0 AS alpha FROM e{t}")
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(picks)


def _observed(training: str) -> str:
    sums = [f"SELECT part AS fold, '{c}' AS slot, label * {c} AS x FROM training" for c in ["AGE_AT_APPLICATION", "APPLICANT_FAMILY_COUNT", "APPLICATION_YEAR"]]
    sums += [f"SELECT part, '{c}_VEC_' || {c}, label FROM training" for c in ["MARITAL_STATUS", "GENDER_DESC"]]
    return f"WITH {training}, long AS ({' UNION ALL '.join(sums)}) SELECT fold, slot, count(*) AS n, round(sum(x)::DOUBLE, 2) AS expected FROM long GROUP BY fold, slot"


def _lloyd(derived: str, steps: int) -> str:
    """``c<steps>`` holds the centers (k, cluster, x, y) after so many steps, ``near`` each place's cluster by them."""
    starts = " UNION ALL ".join(
        f"SELECT {k} AS k, {i} AS cluster, {x}::DOUBLE AS x, {y}::DOUBLE AS y" for k, held in SWEEP_STARTS.items() for i, (x, y) in enumerate(held)
    )
    ctes = [
        f"{derived}, places AS MATERIALIZED (SELECT AGE_AT_APPLICATION::DOUBLE AS x, APPLICANT_FAMILY_COUNT::DOUBLE AS y, count(*) AS n FROM features GROUP BY 1, 2)",
        f"c0 AS ({starts})",
    ]

    def near(t: int) -> str:
        return f"""SELECT c.k, p.x, p.y, p.n, arg_min(c.cluster, (pow(p.x - c.x, 2) + pow(p.y - c.y, 2), c.cluster)) AS cluster
  FROM places p CROSS JOIN c{t} c GROUP BY c.k, p.x, p.y, p.n"""

    for t in range(steps):
        ctes.append(
            f"""c{t + 1} AS MATERIALIZED (
  SELECT c.k, c.cluster, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y FROM c{t} c
  LEFT JOIN (SELECT k, cluster, sum(n * x) / sum(n) AS x, sum(n * y) / sum(n) AS y FROM ({near(t)}) GROUP BY k, cluster) m
    ON m.k = c.k AND m.cluster = c.cluster)"""
        )
    ctes.append(f"near AS MATERIALIZED ({near(steps)})")
    return "WITH " + ", ".join(ctes)


def _choice(lloyd: str) -> str:
    return f"""{lloyd},
apart AS (
  SELECT a.k, a.x, a.y, a.n, a.cluster, b.cluster AS other,
         sum(b.n * (pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS far, sum(b.n) AS size
  FROM near a JOIN near b ON b.k = a.k GROUP BY ALL),
sides AS (
  SELECT k, x, y, n, max(CASE WHEN other = cluster THEN size END) AS own, max(CASE WHEN other = cluster THEN far / greatest(size - 1, 1) END) AS inner_,
         min(CASE WHEN other <> cluster THEN far / size END) AS outer_
  FROM apart GROUP BY k, x, y, n),
scores AS (
  SELECT k, sum(n * CASE WHEN own > 1 THEN (outer_ - inner_) / greatest(outer_, inner_) ELSE 0 END) / sum(n) AS silhouette FROM sides GROUP BY k)
SELECT k, round(silhouette, 6) AS silhouette, k = (SELECT arg_max(k, (silhouette, -k)) FROM scores) AS chosen FROM scores"""


def fold_statements(derived: str, fold: str) -> dict[str, str]:
    training, lloyd = _training(derived, fold), _lloyd(derived, 3)
    return {
        "fold_prep_slots": f"WITH {_slots(training)} SELECT part, slot, name, round(mean, 6) AS mean, round(std, 6) AS std FROM slots",
        "fold_prep_rows": _rows(training),
        "fold_logistic": _logistic(training, 0.0),
        "fold_logistic_ridge": _logistic(training, 0.1),
        "fold_logistic_slots": _observed(training),
        "fold_adaboost": _boosting(training, 3),
        "fold_adaboost_weights": f"WITH {training}, sizes AS (SELECT part AS fold, count(*) AS n FROM training GROUP BY part) "
        "SELECT fold, round, n, 0.5::DOUBLE AS missed FROM sizes CROSS JOIN (SELECT unnest(range(10))::INTEGER AS round)",
        "kmeans_steps": f"{lloyd} SELECT c.k, c.cluster, coalesce(s.n, 0)::BIGINT AS n, round(c.x, 6) AS age, round(c.y, 6) AS family "
        "FROM c3 c LEFT JOIN (SELECT k, cluster, sum(n) AS n FROM near GROUP BY k, cluster) s ON s.k = c.k AND s.cluster = c.cluster",
        "kmeans_sweep_choice": _choice(lloyd),
    }
