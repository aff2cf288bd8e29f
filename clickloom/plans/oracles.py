"""The named queries as SQL for DuckDB over the same Parquet tables, to check results against."""

from __future__ import annotations

from clickloom.operators.cleaning import RARE_TOKEN, blank_token
from clickloom.operators.descent import EPSILON, GRADIENT_FACTOR, LEARNING_RATE
from clickloom.plans.queries import (
    CHAIN_WEIGHTS,
    DESCRIBE_DIGITS,
    SAMPLE_SHARE,
    SCORE_DIGITS,
    SCORER_A,
    SCORER_B,
    TOY_FEATURES,
    TOY_WEIGHTS,
    TRACE_STEPS,
    UNSEEN,
)
from clickloom.sources.training_view import CATEGORICAL, NUMERIC

# Six places, and no negative zero.
R = "round({}, 6) + 0e0"


def num(x: float) -> str:
    """A double literal (a plain decimal would be DECIMAL)."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def h(text: str, digits: int = 4, kind: str = "INTEGER") -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS {kind})"


TV = f"""base AS (
  SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS rk, *
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
), tv AS (
  SELECT rk, CASE WHEN {h("'y|' || rk")} % 100 < 10 + 0.6e0 * l_quantity THEN 1 ELSE 0 END AS label,
    l_quantity AS c01, l_extendedprice AS c02, s_acctbal AS c03, CAST(p_size AS DOUBLE) AS c04, l_discount AS c05,
    p_brand AS b01,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS b02,
    l_linestatus AS b03,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS b04,
    p_type AS b05, c_mktsegment AS b06,
    CAST(l_suppkey AS VARCHAR) AS b07, CAST(l_partkey AS VARCHAR) AS b08
  FROM base
)"""

SPLIT = f"""CASE WHEN {h("'p|' || rk", 8, "BIGINT")} / 4294967296e0 < 0.7e0 THEN 'Train' ELSE 'Test' END"""
SPLIT_TV = f"sv AS (SELECT *, {SPLIT} AS data FROM tv)"


def long_rows(source: str, columns: list[str] = CATEGORICAL, extra: str = "label") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, {extra} FROM {source}" for c in columns)


def frequency(source: str) -> str:
    return f"SELECT feature, value, count(*) AS n FROM ({long_rows(source)}) GROUP BY feature, value"


def filled(source: str) -> str:
    parts = ", ".join(f"CASE WHEN {c} <> '' THEN {c} ELSE '{blank_token(c)}' END AS {c}" for c in CATEGORICAL)
    return f"SELECT * REPLACE ({parts}) FROM {source}"


def kept(source: str) -> str:
    return f"""SELECT feature, value, n FROM ({frequency(source)})
      WHERE n >= 0.01e0 * (SELECT count(*) FROM {source})"""


def folded(source: str) -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IN (SELECT value FROM kept WHERE feature = '{c}') THEN {c} ELSE '{RARE_TOKEN}' END AS {c}"
        for c in CATEGORICAL
    )
    return f"SELECT * REPLACE ({parts}) FROM {source}"


# Cleaned rows, learned from all rows (``clean``) or from the training part (``clean`` after SPLIT_TV).
CLEAN_ALL = f"filled AS ({filled('tv')}), kept AS ({kept('filled')}), clean AS ({folded('filled')})"
CLEAN_TRAIN = f"""{SPLIT_TV}, filled AS ({filled('sv')}),
  seen AS (SELECT * FROM filled WHERE data = 'Train'), kept AS ({kept('seen')}), clean AS ({folded('filled')}),
  trained AS (SELECT * FROM clean WHERE data = 'Train')"""

LOG = "CASE WHEN {0} < 0 THEN {0} ELSE ln(1 + {0}) END"


def mean_tables(source: str) -> str:
    return f"""means AS (SELECT feature, value, avg(label) AS mean FROM ({long_rows(source)})
      GROUP BY feature, value)"""


def encoded(source: str, part: str) -> str:
    joins = " ".join(
        f"LEFT JOIN means m_{c} ON m_{c}.feature = '{c}' AND m_{c}.value = t.{c}" for c in CATEGORICAL
    )
    columns = ", ".join(f"coalesce(m_{c}.mean, 0e0) AS {c}_bm" for c in CATEGORICAL)
    return f"SELECT t.rk, t.label, {columns}, {', '.join('t.' + c for c in NUMERIC)} FROM {source} t {joins} WHERE {part}"


def encode_query(ctes: str, trained: str, source: str, part: str) -> str:
    columns = ", ".join(f"{R.format(c + '_bm')} AS {c}_bm" for c in CATEGORICAL)
    return f"WITH {TV}, {ctes}, {mean_tables(trained)} SELECT rk, label, {columns} FROM ({encoded(source, part)})"


INDEXED = f"""counts AS ({frequency('clean')}), indexed AS (
    SELECT feature, value, n, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS idx,
      count(*) OVER (PARTITION BY feature) AS size
    FROM counts)"""


def one_hot(keep_rule: str) -> str:
    return f"""WITH {TV}, {CLEAN_ALL}, {INDEXED}
      SELECT CAST(row_number() OVER (ORDER BY feature, idx) - 1 AS INTEGER) AS slot, feature || '=' || value AS name,
        n AS n_rows
      FROM indexed WHERE {keep_rule}"""


# -- scorers --------------------------------------------------------------------------------------------------------


def sigmoid_of(features: list[str], weights: list) -> str:
    z = " + ".join([weights[0], *[f"{w} * {f}" for f, w in zip(features, weights[1:])]])
    return f"1e0 / (1e0 + exp(-({z})))"


def scores(name: str, scorer) -> str:
    features, weights = scorer
    return f"""{name} AS (SELECT rk, {SPLIT} AS data, label, round(probability, {SCORE_DIGITS}) AS probability,
        CAST(probability > 0.5 AS DOUBLE) AS prediction
      FROM (SELECT *, {sigmoid_of(features, [num(w) for w in weights])} AS probability FROM tv))"""


def loss_of(p: str = "probability") -> str:
    return f"CASE WHEN label = 1 THEN -ln({p} + {num(EPSILON)}) ELSE -ln(1 - {p} + {num(EPSILON)}) END"


CELLS = """count(*) FILTER (prediction = 1 AND label = 1) AS tp, count(*) FILTER (prediction = 1 AND label = 0) AS fp,
  count(*) FILTER (prediction = 0 AND label = 1) AS fn, count(*) FILTER (prediction = 0 AND label = 0) AS tn"""
F1 = "CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END"
METRICS = f"""{R.format('(tp + tn) * 1e0 / (tp + fp + fn + tn)')} AS accuracy,
  {R.format('CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fp) END')} AS "precision",
  {R.format('CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fn) END')} AS recall, {R.format(F1)} AS f1"""


def auc(source: str, by: str) -> str:
    return f"""SELECT {by}, (sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2e0) / (p * n) AS auc
      FROM (SELECT {by}, label,
          rank() OVER (PARTITION BY {by} ORDER BY probability)
            + (count(*) OVER (PARTITION BY {by}, probability) - 1) / 2e0 AS r,
          sum(label) OVER (PARTITION BY {by}) * 1e0 AS p, sum(1 - label) OVER (PARTITION BY {by}) * 1e0 AS n
        FROM {source})
      GROUP BY {by}, p, n"""


def report(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS "Name", m.data AS "Data", {R.format('auc')} AS "ROC",
        {R.format('loss')} AS "LogLoss", {R.format(F1)} AS "F1-Score"
      FROM (SELECT data, avg({loss_of()}) AS loss, {CELLS} FROM {source} GROUP BY data) m
      JOIN ({auc(source, 'data')}) a ON m.data = a.data"""


CURVE_OF = """curve AS (
    SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
    FROM (SELECT probability AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM {} GROUP BY 1)
    WINDOW w AS (ORDER BY threshold DESC))"""
CURVE = CURVE_OF.format("a")
CURVE_TRAIN = CURVE_OF.format("(SELECT * FROM a WHERE data = 'Train')")
CURVE_F = "CASE WHEN tp + p = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + (p - tp)) END"
BEST = f"SELECT threshold, f FROM (SELECT threshold, {CURVE_F} AS f FROM curve) ORDER BY f DESC, threshold DESC LIMIT 1"

TOY = """lt AS (SELECT rk, label, b03, ln(1 + c01) AS c01_t FROM tv),
  toy AS (SELECT rk, label, c01_t, (c01_t - m) / s AS c01_ts, CASE WHEN b03 = 'O' THEN 1 ELSE 0 END AS b03_t1
    FROM lt, (SELECT avg(c01_t) AS m, stddev_samp(c01_t) AS s FROM lt))"""


def step_of(weights: list[str], source: str) -> list[str]:
    """SQL for each weight after one gradient step."""
    p = sigmoid_of(TOY_FEATURES, weights)
    inputs = ["1e0", *TOY_FEATURES]
    return [
        f"{w} - {num(LEARNING_RATE)} * {num(GRADIENT_FACTOR)} * avg(({p} - label) * {x})" for w, x in zip(weights, inputs)
    ]


def trace() -> str:
    ctes = ["s0 AS (SELECT 0e0 AS w0, 0e0 AS w1, 0e0 AS w2)"]
    weights = ["w0", "w1", "w2"]
    for i in range(TRACE_STEPS):
        moved = ", ".join(f"{w} AS n{k}" for k, w in enumerate(step_of(weights, "toy")))
        ctes.append(
            f"s{i + 1} AS (SELECT n0 AS w0, n1 AS w1, n2 AS w2 FROM "
            f"(SELECT {moved} FROM toy, s{i} GROUP BY w0, w1, w2))"
        )
    p = sigmoid_of(TOY_FEATURES, weights)
    rows = " UNION ALL ".join(
        f"SELECT {i} AS step, {R.format(f'avg({loss_of(p)})')} AS loss, "
        + ", ".join(f"{R.format(w)} AS {w}" for w in weights)
        + f" FROM toy, s{i} GROUP BY w0, w1, w2"
        for i in range(TRACE_STEPS + 1)
    )
    return f"WITH {TV}, {TOY}, {', '.join(ctes)} {rows}"


def describe(columns: list[str], source: str = "tv") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), {DESCRIBE_DIGITS}) + 0e0 AS mean, "
        f"round(stddev_samp({c}), {DESCRIBE_DIGITS}) + 0e0 AS stddev, min({c}) AS \"min\", max({c}) AS \"max\" FROM {source}"
        for c in columns
    )


def scaler_rows(parts: list[tuple[str, str]], source: str, first: int = 0) -> str:
    """Mean and deviation of (name, expression) pairs, one row each."""
    return " UNION ALL ".join(
        f"SELECT CAST({first + i} AS INTEGER) AS slot, '{n}' AS name, {R.format(f'avg({x})')} AS mean, "
        f"{R.format(f'stddev_samp({x})')} AS stddev FROM {source}"
        for i, (n, x) in enumerate(parts)
    )


def features_onehot() -> str:
    numeric = scaler_rows([(c, LOG.format(c)) for c in NUMERIC], "trained")
    return f"""WITH {TV}, {CLEAN_TRAIN}, counts AS ({frequency('trained')}),
      indexed AS (SELECT feature, value, n, row_number() OVER (ORDER BY feature, n DESC, value) - 1 AS slot FROM counts),
      total AS (SELECT count(*) * 1e0 AS rows FROM trained)
      SELECT CAST(slot AS INTEGER) AS slot, feature || '=' || value AS name, {R.format('n / rows')} AS mean,
        {R.format('sqrt((n - n * n / rows) / (rows - 1))')} AS stddev
      FROM indexed, total
      UNION ALL
      SELECT CAST(slot + (SELECT count(*) FROM counts) AS INTEGER), name, mean, stddev FROM ({numeric})"""


def features_mean() -> str:
    parts = [(c, LOG.format(c)) for c in [f"{c}_bm" for c in CATEGORICAL] + NUMERIC]
    return f"""WITH {TV}, {CLEAN_TRAIN}, {mean_tables('trained')}, enc AS ({encoded('trained', 'true')})
      {scaler_rows(parts, 'enc')}"""


def score_new_rows() -> str:
    parts = [(c, LOG.format(c)) for c in [f"{c}_bm" for c in CATEGORICAL] + NUMERIC]
    stats = ", ".join(f"avg({x}) AS m_{n}, stddev_samp({x}) AS s_{n}" for n, x in parts)
    z = ", ".join(f"{R.format(f'CASE WHEN s_{n} = 0 THEN 0e0 ELSE (({x}) - m_{n}) / s_{n} END')} AS z_{n}" for n, x in parts)
    return f"""WITH {TV}, {CLEAN_TRAIN}, {mean_tables('trained')}, enc AS ({encoded('clean', 'true')}),
      every AS (SELECT *, {SPLIT} AS data FROM enc),
      stats AS (SELECT {stats} FROM every WHERE data = 'Train')
      SELECT rk, data, {z} FROM every, stats"""


def score_batch_weights() -> str:
    parts = [(c, LOG.format(c)) for c in [f"{c}_bm" for c in CATEGORICAL] + NUMERIC]
    stats = ", ".join(f"avg({x}) AS m_{n}, stddev_samp({x}) AS s_{n}" for n, x in parts)
    margin = " + ".join(
        [num(CHAIN_WEIGHTS[0])]
        + [f"{num(w)} * (CASE WHEN s_{n} = 0 THEN 0e0 ELSE (({x}) - m_{n}) / s_{n} END)" for w, (n, x) in zip(CHAIN_WEIGHTS[1:], parts)]
    )
    return f"""WITH {TV}, {CLEAN_TRAIN}, {mean_tables('trained')}, enc AS ({encoded('clean', 'true')}),
      every AS (SELECT *, {SPLIT} AS data FROM enc),
      stats AS (SELECT {stats} FROM every WHERE data = 'Train')
      SELECT rk, data, label, {R.format(f'1e0 / (1e0 + exp(-({margin})))')} AS probability FROM every, stats"""


def unseen_third() -> str:
    third = h("'u|' || rk")
    return encode_query(
        f"""{SPLIT_TV}, trained AS (SELECT * FROM sv WHERE data = 'Train'), other AS (SELECT * REPLACE (
          CASE WHEN {third} % 3 = 0 THEN '{UNSEEN}' ELSE b08 END AS b08, CASE WHEN {third} % 3 = 1 THEN '{UNSEEN}' ELSE b07 END AS b07) FROM sv)""",
        "trained", "other", "true",
    ).replace("SELECT rk, label, round", "SELECT rk, round", 1)


def slot_cells() -> str:
    """Contingency cells of one-hot slots and binned numbers of the training part: ``slot, name, cell, label, n``."""
    logged = ", ".join(f"{LOG.format(c)} AS {c}" for c in NUMERIC)
    binned = " UNION ALL ".join(
        f"""SELECT {i} AS k, '{c}' AS name, CASE WHEN {c} >= q1 THEN 1 ELSE 0 END + CASE WHEN {c} >= q2 THEN 1 ELSE 0 END
          + CASE WHEN {c} >= q3 THEN 1 ELSE 0 END AS cell, label, count(*) * 1e0 AS n
          FROM logged, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM logged)
          GROUP BY ALL"""
        for i, c in enumerate(NUMERIC)
    )
    return f"""logged AS (SELECT label, {logged} FROM trained),
      freq AS (SELECT feature, value, count(*) AS n FROM ({long_rows('trained')}) GROUP BY feature, value),
      slots AS (SELECT row_number() OVER (ORDER BY feature, n DESC, value) - 1 AS slot, feature, value FROM freq),
      by_label AS (SELECT feature, value, label, count(*) * 1e0 AS n FROM ({long_rows('trained')}) GROUP BY ALL),
      rows_of AS (SELECT label, count(*) * 1e0 AS rows FROM trained GROUP BY label),
      present AS (SELECT slot, s.feature || '=' || s.value AS name, r.label, rows, coalesce(b.n, 0e0) AS n
        FROM slots s CROSS JOIN rows_of r LEFT JOIN by_label b ON b.feature = s.feature AND b.value = s.value AND b.label = r.label),
      cells AS (SELECT slot, name, 1 AS cell, label, n FROM present UNION ALL SELECT slot, name, 0, label, rows - n FROM present
        UNION ALL SELECT (SELECT count(*) FROM slots) + k, name, cell, label, n FROM ({binned})),
      full_cells AS (SELECT g.slot, g.name, g.cell, r.label, coalesce(c.n, 0e0) AS n FROM (SELECT DISTINCT slot, name, cell FROM cells) g
        CROSS JOIN rows_of r LEFT JOIN cells c ON c.slot = g.slot AND c.cell = g.cell AND c.label = r.label),
      expected AS (SELECT *, sum(n) OVER (PARTITION BY slot, cell) * sum(n) OVER (PARTITION BY slot, label) / sum(n) OVER (PARTITION BY slot) AS e
        FROM full_cells),
      chi AS (SELECT slot, name, sum(CASE WHEN e > 0 THEN (n - e) * (n - e) / e ELSE 0e0 END) AS statistic,
        (count(DISTINCT CASE WHEN e > 0 THEN cell END) - 1) * (count(DISTINCT CASE WHEN e > 0 THEN label END) - 1) AS dof
        FROM expected GROUP BY slot, name)"""


def correlations() -> str:
    names = [*NUMERIC, "label"]
    return f"WITH {TV} " + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {R.format(f'corr({a}, {b})')} AS corr FROM tv"
        for a in names
        for b in names
    )


def boxplots() -> str:
    return f"""WITH {TV}, melted AS ({long_rows('tv', NUMERIC)}),
      q AS (SELECT feature, label, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
          quantile_cont(value, 0.75) AS q3 FROM melted GROUP BY feature, label),
      marked AS (SELECT m.feature, m.label, value, n, q1, median, q3,
          value BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) AS inside
        FROM melted m JOIN q ON m.feature = q.feature AND m.label = q.label)
      SELECT feature, label, n, {R.format('q1')} AS q1, {R.format('median')} AS median, {R.format('q3')} AS q3,
        {R.format('min(value) FILTER (inside)')} AS whisker_low, {R.format('max(value) FILTER (inside)')} AS whisker_high,
        count(*) FILTER (NOT inside) AS n_outliers
      FROM marked GROUP BY feature, label, n, q1, median, q3"""


def roles() -> str:
    names = [("rk", "string", "key"), ("label", "int", "label")]
    names += [(c, "double", "numeric") for c in NUMERIC] + [(c, "string", "categorical") for c in CATEGORICAL]
    return f"WITH {TV} " + " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS name, '{t}' AS type, '{r}' AS role, count({n}) AS n_values FROM tv"
        for i, (n, t, r) in enumerate(names)
    )


def oracle_sql() -> dict[str, str]:
    a, b = scores("a", SCORER_A), scores("b", SCORER_B)
    raw_means = encode_query(
        f"{SPLIT_TV}, trained AS (SELECT * FROM sv WHERE data = 'Train')", "trained", "sv", "true"
    )
    cats, nums = ", ".join(CATEGORICAL), ", ".join(NUMERIC)
    missing = [(c, "isnan" if c in NUMERIC else None) for c in ["rk", "label", *NUMERIC, *CATEGORICAL]]
    audit = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL{f' OR {f}({c})' if f else ''}) AS n_missing FROM tv"
        for c, f in missing
    )
    bm = [f"{c}_bm" for c in CATEGORICAL]
    audit_encoded = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS n_missing FROM enc"
        for c in ["rk", "label", *NUMERIC, "data", *bm]
    )
    return {
        "load_tsv": f"""WITH {TV} SELECT CAST(label AS BIGINT) AS label,
            {", ".join(f"round({c} * 100) + 0e0 AS {c}" for c in NUMERIC)}, {cats} FROM tv""",
        "sql_view": f"""WITH {TV} SELECT b02, label, count(*) AS n, {R.format('avg(c02)')} AS mean_c02
            FROM tv GROUP BY b02, label""",
        "parquet_roundtrip": f"""WITH {TV} SELECT b01, label, count(*) AS n, sum(c01) AS sum_c01, min(c02) AS min_c02,
            max(rk) AS max_rk FROM tv GROUP BY b01, label""",
        "csv_roundtrip": f"""WITH {TV} SELECT b02, b04, label, count(*) AS n, sum(c01) AS sum_c01, max(c02) AS max_c02
            FROM tv GROUP BY b02, b04, label""",
        "column_roles": roles(),
        "sample_hash": f"""WITH {TV} SELECT rk, label, c01, b01 FROM tv
            WHERE {h("'s|' || rk", 8, "BIGINT")} / {num(2**32)} < {num(SAMPLE_SHARE)}""",
        "train_test_split": f"WITH {TV} SELECT rk, {SPLIT} AS data FROM tv",
        "kfold_assign": f"""WITH {TV} SELECT rk, {h("'f|' || rk")} % 3 AS fold FROM tv""",
        "split_counts": f"""WITH {TV}, {SPLIT_TV} SELECT data, count(*) AS n_rows,
            count(*) FILTER (label = 1) AS n_positive FROM sv GROUP BY data""",
        "limit_rows": f"WITH {TV} SELECT rk, c01, b03, label FROM tv ORDER BY rk LIMIT 100",
        "sample_n": f"WITH {TV} SELECT rk, {nums}, label FROM tv ORDER BY md5(rk || '|1'), rk LIMIT 1000",
        "top_k_rows": f"""WITH {TV}, {TOY} SELECT {R.format('c01_ts')} AS c01_ts, b03_t1, label FROM toy
            ORDER BY 1 DESC, 2 DESC, 3 DESC LIMIT 5""",
        "label_distribution": f"WITH {TV} SELECT label, count(*) AS n FROM tv GROUP BY label",
        "category_frequency": f"WITH {TV} {frequency('tv')}",
        "categorical_profile": f"""WITH {TV}, counts AS ({frequency('tv')})
            SELECT feature, count(*) AS n_unique,
              CAST(sum(CASE WHEN value = '' THEN n ELSE 0 END) AS BIGINT) AS n_empty,
              count(*) FILTER (n = 1) AS n_count_eq_1, count(*) FILTER (n < 10) AS n_count_lt_10,
              count(*) FILTER (n < 100) AS n_count_lt_100, count(*) FILTER (n < 1000) AS n_count_lt_1000
            FROM counts GROUP BY feature""",
        "kept_categories": f"WITH {TV}, filled AS ({filled('tv')}) {kept('filled')}",
        "folding_profile": f"""WITH {TV}, {CLEAN_ALL}, before AS ({frequency('tv')}), after AS ({frequency('clean')})
            SELECT b.feature, n_before, n_after, kept FROM
              (SELECT feature, count(*) AS n_before FROM before GROUP BY feature) b
              JOIN (SELECT feature, count(*) AS n_after,
                  coalesce(string_agg(value, ',' ORDER BY value) FILTER (value <> '{RARE_TOKEN}'), '') AS kept
                FROM after GROUP BY feature) a ON a.feature = b.feature""",
        "feature_space_size": f"""WITH {TV}, {CLEAN_ALL}, counts AS ({frequency('clean')})
            SELECT (SELECT count(*) FROM counts) AS n_categories, {len(NUMERIC)} AS n_numeric,
              CAST((SELECT count(*) FROM counts) + {len(NUMERIC)} AS INTEGER) AS vector_size""",
        "numeric_describe": f"WITH {TV} {describe(NUMERIC)}",
        "merged_numeric_profile": f"""WITH {TV} {" UNION ALL ".join(
            f"SELECT '{c}' AS feature, count({c}) AS n, count(*) - count({c}) AS n_missing, round(avg({c}), {DESCRIBE_DIGITS}) + 0e0 AS mean, "
            f"round(stddev_samp({c}), {DESCRIBE_DIGITS}) + 0e0 AS stddev, min({c}) AS min, max({c}) AS max FROM tv" for c in NUMERIC)}""",
        "null_audit": f"WITH {TV} {audit}",
        "null_audit_encoded": f"""WITH {TV}, {CLEAN_TRAIN}, {mean_tables('trained')},
            enc AS (SELECT *, {SPLIT} AS data FROM ({encoded('clean', 'true')})) {audit_encoded}""",
        "distinct_values": f"WITH {TV} SELECT DISTINCT b05 FROM tv",
        "distinct_negatives": f"WITH {TV} SELECT DISTINCT c03 FROM tv WHERE c03 < 0",
        "correlation_matrix": correlations(),
        "boxplot_stats": boxplots(),
        "melt_numeric": f"""WITH {TV} SELECT label, feature AS variable, value FROM ({long_rows('tv', NUMERIC)})""",
        "impute_blank": f"WITH {TV} SELECT rk, {cats} FROM ({filled('tv')})",
        "impute_rare": f"WITH {TV}, {CLEAN_ALL} SELECT rk, {cats} FROM clean",
        "log_transform": f"""WITH {TV} SELECT rk, {", ".join(f"{R.format(LOG.format(c))} AS {c}" for c in NUMERIC)} FROM tv""",
        "toy_features": f"""WITH {TV}, {TOY} SELECT rk, {R.format('c01_t')} AS c01_t, {R.format('c01_ts')} AS c01_ts,
            b03_t1 FROM toy""",
        "string_index": f"""WITH {TV}, {CLEAN_ALL}, {INDEXED}
            SELECT feature, value, CAST(idx AS INTEGER) AS slot FROM indexed""",
        "one_hot": one_hot("true"),
        "one_hot_drop_last": one_hot("idx < size - 1"),
        "assemble_features": f"""WITH {TV}, {CLEAN_ALL} SELECT rk,
            CAST((SELECT count(*) FROM ({frequency('clean')})) + {len(NUMERIC)} AS INTEGER) AS n_slots,
            {R.format(" + ".join([num(len(CATEGORICAL)), *[f"({LOG.format(c)})" for c in NUMERIC]]))} AS total FROM clean""",
        "standardize": f"""WITH {TV}, s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in NUMERIC)}
            FROM tv) SELECT rk, {", ".join(f"{R.format(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in NUMERIC)} FROM tv, s""",
        "features_onehot": features_onehot(),
        "features_mean": features_mean(),
        "score_new_rows": score_new_rows(),
        "target_means": f"""WITH {TV} SELECT feature, value, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_positive,
            {R.format('avg(label)')} AS mean FROM ({long_rows('tv')}) GROUP BY feature, value""",
        "target_mean_encode": encode_query(CLEAN_TRAIN, "trained", "clean", "t.data = 'Train'"),
        "target_mean_encode_test": encode_query(CLEAN_TRAIN, "trained", "clean", "t.data = 'Test'"),
        "target_mean_encode_raw": raw_means,
        "target_mean_encode_shuffled": raw_means,
        "target_mean_encode_unseen": unseen_third(),
        "string_index_long": f"""WITH {TV}, counts AS ({frequency('tv')}) SELECT feature, value, n,
            row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS slot FROM counts""",
        "one_hot_long": f"""WITH {TV}, counts AS ({frequency('tv')}) SELECT feature, value, n AS n_rows,
            row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS slot FROM counts WHERE feature IN ('b07', 'b08')""",
        "chi_square_slots": f"""WITH {TV}, {CLEAN_TRAIN}, {slot_cells()}
            SELECT CAST(slot AS INTEGER) AS slot, name, {R.format('statistic')} AS statistic, dof FROM chi""",
        "chi_square_select_slots": f"""WITH {TV}, {CLEAN_TRAIN}, {slot_cells()},
            strong AS (SELECT slot, name, CASE WHEN dof = 0 THEN 0e0 ELSE statistic / dof END AS strength FROM chi)
            SELECT CAST(slot AS INTEGER) AS slot, name, CAST(row_number() OVER (ORDER BY strength DESC, slot) AS INTEGER) AS rank
            FROM strong ORDER BY strength DESC, slot LIMIT 50""",
        "score_batch_weights": score_batch_weights(),
        "report_runs": f"""WITH {TV}, {a}, {b} SELECT *, 'run-A' AS run_id FROM ({report('A', 'a')})
            UNION ALL SELECT *, 'run-B' FROM ({report('B', 'b')})""",
        "gd_trace_vectors": trace(),
        "chi_square_select": f"""WITH {TV}, {CLEAN_ALL}, c AS (SELECT feature, value, count(*) * 1e0 AS n,
              sum(label) * 1e0 AS pos FROM ({long_rows('clean')}) GROUP BY feature, value),
            t AS (SELECT feature, sum(n) AS rows, sum(pos) AS p FROM c GROUP BY feature),
            s AS (SELECT c.feature, sum(pow(pos - n * p / rows, 2) / (n * p / rows) +
              pow(n - pos - n * (rows - p) / rows, 2) / (n * (rows - p) / rows)) / greatest(count(*) - 1, 1) AS strength
              FROM c JOIN t ON c.feature = t.feature GROUP BY c.feature)
            SELECT feature, CAST(row_number() OVER (ORDER BY strength DESC, feature) AS INTEGER) AS rank
            FROM s ORDER BY strength DESC, feature LIMIT 4""",
        "target_mean_encode_loo": f"""WITH {TV}, {SPLIT_TV}, trained AS (SELECT * FROM sv WHERE data = 'Train'),
            g AS (SELECT avg(label) AS mean FROM trained)
            SELECT rk, label, {", ".join(R.format(
              f"CASE WHEN n_{c} > 1 THEN (p_{c} - label) * 1e0 / (n_{c} - 1) ELSE mean END") + f" AS {c}_bm" for c in CATEGORICAL)}
            FROM (SELECT *, {", ".join(f"count(*) OVER (PARTITION BY {c}) AS n_{c}, sum(label) OVER (PARTITION BY {c}) AS p_{c}"
              for c in CATEGORICAL)} FROM trained), g""",
        "chi_square_table": f"""WITH {TV}, {CLEAN_ALL}, c AS (SELECT feature, value, count(*) * 1e0 AS n,
              sum(label) * 1e0 AS pos FROM ({long_rows('clean')}) GROUP BY feature, value),
            t AS (SELECT feature, sum(n) AS rows, sum(pos) AS p FROM c GROUP BY feature)
            SELECT c.feature, {R.format('sum(pow(pos - n * p / rows, 2) / (n * p / rows) + '
              'pow(n - pos - n * (rows - p) / rows, 2) / (n * (rows - p) / rows))')} AS statistic, count(*) - 1 AS dof
            FROM c JOIN t ON c.feature = t.feature GROUP BY c.feature""",
        "gd_loss": f"""WITH {TV}, {TOY} SELECT
            {R.format(f"avg({loss_of(sigmoid_of(TOY_FEATURES, [num(w) for w in TOY_WEIGHTS]))})")} AS loss FROM toy""",
        "gd_step": f"""WITH {TV}, {TOY}, s AS (SELECT {", ".join(
            f"{w} AS w{k}" for k, w in enumerate(step_of(["0e0"] * 3, "toy")))} FROM toy)
            {" UNION ALL ".join(f"SELECT {k} AS slot, {R.format(f'w{k}')} AS weight FROM s" for k in range(3))}""",
        "gd_trace": trace(),
        "logistic_score": f"WITH {TV}, {a} SELECT rk, probability, prediction FROM a",
        "log_loss": f"WITH {TV}, {a} SELECT data, {R.format(f'avg({loss_of()})')} AS log_loss FROM a GROUP BY data",
        "confusion_matrix": f"WITH {TV}, {a} SELECT data, {CELLS} FROM a GROUP BY data",
        "confusion_table": f"""WITH {TV}, {a} SELECT t AS true_label, p AS predicted_label,
            (SELECT count(*) FROM a WHERE label = t AND prediction = p) AS n
            FROM (VALUES (1, 1), (1, 0), (0, 1), (0, 0)) v(t, p)""",
        "f1_metrics": f"WITH {TV}, {a} SELECT data, {METRICS} FROM (SELECT data, {CELLS} FROM a GROUP BY data)",
        "auc_roc": f"WITH {TV}, {a} SELECT data, {R.format('auc')} AS auc FROM ({auc('a', 'data')})",
        "roc_curve": f"""WITH {TV}, {a}, {CURVE} SELECT {R.format('fp * 1e0 / n')} AS "FPR",
            {R.format('tp * 1e0 / p')} AS "TPR" FROM curve UNION ALL SELECT 0e0, 0e0 UNION ALL SELECT 1e0, 1e0""",
        "f_by_threshold": f"""WITH {TV}, {a}, {CURVE} SELECT threshold, {R.format(CURVE_F)} AS "F-Measure" FROM curve""",
        "best_threshold": f"WITH {TV}, {a}, {CURVE_TRAIN} SELECT threshold, {R.format('f')} AS f_measure FROM ({BEST})",
        "threshold_effect": f"""WITH {TV}, {a}, {CURVE_TRAIN}, ts AS (SELECT 0.5e0 AS threshold UNION ALL
              SELECT threshold FROM ({BEST})),
            cut AS (SELECT data, threshold, label, CASE WHEN probability >= threshold THEN 1 ELSE 0 END AS prediction FROM a, ts)
            SELECT data, threshold, {METRICS} FROM (SELECT data, threshold, {CELLS} FROM cut GROUP BY data, threshold)""",
        "evaluation_report": f"WITH {TV}, {a} {report('A', 'a')}",
        "model_comparison": f"WITH {TV}, {a}, {b} {report('A', 'a')} UNION ALL {report('B', 'b')}",
        "prediction_agreement": f"""WITH {TV}, {a}, {b} SELECT count(*) AS n,
            CAST(count(*) - count(DISTINCT a.rk) AS BIGINT) AS n_repeated, {R.format('corr(a.probability, b.probability)')} AS corr,
            {R.format('max(abs(a.probability - b.probability))')} AS max_abs_diff,
            count(*) FILTER (a.prediction = b.prediction) AS n_same_class FROM a JOIN b ON a.rk = b.rk""",
    }
