"""SQL of the registered queries, for a second engine to run on the same tables."""

from __future__ import annotations

from ..functions.text import SPACES
from ..roles import ORDER_LISTING as ROLES
from .queries import FOLDS, NULL_RUNS, SEED

LISTING = """
li AS (
  SELECT l_orderkey,
         SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS size_a,
         SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS size_b,
         SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS size_c,
         CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS full_cnt,
         CAST(SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS half_cnt,
         CAST(MIN(EXTRACT(YEAR FROM l_shipdate)) AS DOUBLE) AS year_built
  FROM lineitem GROUP BY l_orderkey),
listing AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_totalprice AS label,
         CAST(SUBSTR(o.o_orderpriority, 1, 1) AS DOUBLE) AS quality,
         CAST(EXTRACT(YEAR FROM o.o_orderdate) AS DOUBLE) AS year_sold,
         li.size_a, li.size_b, li.size_c, li.full_cnt, li.half_cnt, li.year_built,
         c.c_acctbal AS acctbal, n.n_name AS grp, c.c_mktsegment AS segment, o.o_orderstatus AS status
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey)"""

# The categories of the given tables.
CATEGORIES = {
    "grp": tuple(f"NATION_{i}" for i in range(25)),
    "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "status": ("F", "O", "P"),
}
NUMERIC, CATEGORICAL = ROLES.numeric, ROLES.categorical
COLUMNS = ["id", "label", *NUMERIC, *CATEGORICAL]


def over_listing(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([LISTING.strip(), *ctes]) + "\n" + select


def each(template: str, values, glue: str = "\nUNION ALL\n") -> str:
    return glue.join(template.format(c=v) for v in values)


def hash32(expression: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5({expression} || ':{salt}'), 1, 8) AS BIGINT)"


def hash_rank(salt: str) -> str:
    return f"row_number() OVER (ORDER BY {hash32('id', salt)}, id) - 1"


FOLDED = f"""
ranked AS (SELECT *, {hash_rank(f'fold:{SEED}')} AS r, COUNT(*) OVER () AS n FROM listing),
folded AS (
  SELECT * EXCLUDE (r, n),
         CAST(CASE WHEN r < (n % {FOLDS}) * (n // {FOLDS} + 1) THEN r // (n // {FOLDS} + 1)
              ELSE (n % {FOLDS}) + (r - (n % {FOLDS}) * (n // {FOLDS} + 1)) // (n // {FOLDS}) END AS INTEGER) AS fold
  FROM ranked)""".strip()

FILLED = "filled AS (SELECT id, label, " + ", ".join(
    f"coalesce({c}, quantile_cont({c}, 0.5) OVER ()) AS {c}" for c in NUMERIC
) + ", " + ", ".join(CATEGORICAL) + " FROM listing)"

LONG = "long AS (" + each("SELECT '{c}' AS feature, id, label, {c} AS x FROM listing WHERE {c} IS NOT NULL", NUMERIC) + ")"


def metric_columns(y: str, p: str) -> str:
    return f"""COUNT(*) AS rows, round(avg(abs({y} - {p})), 6) AS mae,
  round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 6) AS rmse,
  round(1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * COUNT(*)), 6) AS r2,
  round(sqrt(avg(pow(ln(1 + {y}) - ln(1 + {p}), 2))), 6) AS rmsle,
  round(quantile_cont(abs({y} - {p}), 0.5), 6) AS median_absolute_error,
  round(avg({y} - {p}), 6) AS mean_residual_actual_minus_predicted"""


GUESSED = "guessed AS (SELECT id, label, 60000 + 60000 * quality AS guess FROM listing)"
EDGES = "edges AS (SELECT DISTINCT unnest(quantile_cont(label, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS e FROM listing)"
BANDED = """banded AS (SELECT g.id, g.label, g.guess,
  CAST((SELECT COUNT(*) FROM edges WHERE e < g.label) AS INTEGER) AS band FROM guessed g)"""

ENCODED_FULL = ",\n".join(
    f"""enc_{c} AS (SELECT {c}, (sum(label) + 10 * (SELECT avg(label) FROM listing)) / (COUNT(*) + 10) AS v
  FROM listing GROUP BY {c})""" for c in CATEGORICAL
)

PRIORS = f"""priors AS (SELECT f.fold, avg(b.label) AS prior, quantile_cont(b.label, 0.5) AS med
  FROM range({FOLDS}) t(fold) JOIN folded b ON b.fold <> t.fold
  JOIN (SELECT DISTINCT fold FROM folded) f ON f.fold = t.fold GROUP BY f.fold)"""


def crossed(c: str) -> str:
    return f"""cross_{c} AS (SELECT p.fold, k.{c},
  (coalesce(sum(b.label), 0) + 10 * any_value(p.prior)) / (COUNT(b.label) + 10) AS v
  FROM priors p CROSS JOIN (SELECT DISTINCT {c} FROM folded) k
  LEFT JOIN folded b ON b.fold <> p.fold AND b.{c} = k.{c} GROUP BY p.fold, k.{c})"""


FOLD_TABLE = f"""scored AS (SELECT f.id, f.fold, f.label, p.med AS median_guess, x.v AS group_guess
  FROM folded f JOIN priors p ON p.fold = f.fold
  JOIN cross_grp x ON x.fold = f.fold AND x.grp = f.grp),
wide AS (
  SELECT 'median_baseline' AS candidate, 0 AS ordinal, fold, avg(abs(label - median_guess)) AS mae,
    sqrt(avg(pow(label - median_guess, 2))) AS rmse,
    1 - sum(pow(label - median_guess, 2)) / (var_pop(label) * COUNT(*)) AS r2 FROM scored GROUP BY fold
  UNION ALL
  SELECT 'group_mean', 1, fold, avg(abs(label - group_guess)), sqrt(avg(pow(label - group_guess, 2))),
    1 - sum(pow(label - group_guess, 2)) / (var_pop(label) * COUNT(*)) FROM scored GROUP BY fold)"""
CV = [FOLDED, PRIORS, crossed("grp"), FOLD_TABLE]


def peers(training: str, queries: str, model: str, same_model: str) -> list[str]:
    """Exact neighbours: inside the group, then over all rows where the group does not settle it."""
    axes = "size_a + size_b + size_c AS x0, quality AS x1, year_sold - year_built AS x2"
    return [
        f"tr0 AS (SELECT {model} AS model, b.id, b.label, b.grp, {axes} FROM {training})",
        """med AS (SELECT model, quantile_cont(x0, 0.5) AS m0, quantile_cont(x1, 0.5) AS m1,
  quantile_cont(x2, 0.5) AS m2 FROM tr0 GROUP BY model)""",
        """tr AS (SELECT t.model, id, label, grp, coalesce(x0, m0) AS x0, coalesce(x1, m1) AS x1,
  coalesce(x2, m2) AS x2 FROM tr0 t JOIN med m ON m.model = t.model)""",
        """sc AS (SELECT model, stddev_pop(x0) AS s0, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2
  FROM tr GROUP BY model)""",
        f"""qu AS (SELECT q.model, q.id, q.grp, coalesce(x0, m0) AS x0, coalesce(x1, m1) AS x1,
  coalesce(x2, m2) AS x2, s0, s1, s2
  FROM (SELECT {same_model} AS model, id, grp, {axes} FROM {queries}) q
  JOIN med m ON m.model = q.model JOIN sc s ON s.model = q.model)""",
        """near1 AS (SELECT * FROM (SELECT q.model, q.id AS qid, t.id, t.label,
    ((t.x0 - q.x0) / s0) * ((t.x0 - q.x0) / s0) + ((t.x1 - q.x1) / s1) * ((t.x1 - q.x1) / s1)
      + ((t.x2 - q.x2) / s2) * ((t.x2 - q.x2) / s2) AS d2
  FROM qu q JOIN tr t ON t.model = q.model AND t.grp = q.grp)
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d2, id) <= 5)""",
        """open_ids AS (SELECT qid FROM near1 GROUP BY qid HAVING COUNT(*) < 5 OR max(d2) >= 2)""",
        """near2 AS (SELECT * FROM (SELECT q.model, q.id AS qid, t.id, t.label,
    ((t.x0 - q.x0) / s0) * ((t.x0 - q.x0) / s0) + ((t.x1 - q.x1) / s1) * ((t.x1 - q.x1) / s1)
      + ((t.x2 - q.x2) / s2) * ((t.x2 - q.x2) / s2) + CASE WHEN t.grp = q.grp THEN 0 ELSE 2 END AS d2
  FROM qu q JOIN open_ids o ON o.qid = q.id JOIN tr t ON t.model = q.model)
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d2, id) <= 5)""",
        """best AS (SELECT qid, label, d2 FROM near1 WHERE qid NOT IN (SELECT qid FROM open_ids)
  UNION ALL SELECT qid, label, d2 FROM near2)""",
        """price AS (SELECT qid, round(ln(CASE WHEN min(d2) = 0 THEN avg(label) FILTER (WHERE d2 = 0)
    ELSE sum(label / sqrt(d2)) FILTER (WHERE d2 > 0) / sum(1 / sqrt(d2)) FILTER (WHERE d2 > 0) END), 8)
    AS log_peer_price FROM best GROUP BY qid)""",
    ]


NOISE = [hash32("id", f"noise:{r}") for r in range(NULL_RUNS)]
GAINS = "gains AS (SELECT feature, pow(corr(x, label), 2) AS actual, [" + ", ".join(
    f"pow(corr(x, CAST({n} AS DOUBLE)), 2)" for n in NOISE
) + "] AS nulls FROM long GROUP BY feature)"

SPACE_SQL = " || ".join(f"chr({ord(c)})" for c in SPACES)
CLEAN_TEXT = f"coalesce(nullif(trim(text, {SPACE_SQL}), ''), 'Missing')"
N_SPLIT = "(SELECT COUNT(*) FROM listing)"

SPEARMAN_RANKS = """r AS (SELECT feature,
    rank() OVER (PARTITION BY feature ORDER BY x) + (COUNT(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
    rank() OVER (PARTITION BY feature ORDER BY label) + (COUNT(*) OVER (PARTITION BY feature, label) - 1) / 2.0 AS ry
  FROM long)"""
SPEARMAN = "SELECT feature, COUNT(*) AS rows, round(corr(rx, ry), 8) AS spearman FROM r GROUP BY feature"

# --- fits ----------------------------------------------------------------------------------------

INNER_FOLDS = 3
#: Sweeps of the descent; far more than it needs to settle.
SWEEPS = 300
DERIVED = {
    "TotalSF": "size_a + size_b + size_c", "TotalBath": "full_cnt + 0.5 * half_cnt", "AgeAtSale": "year_sold - year_built",
}


def linear_fit(l1: float, l2_rows: float, l2: float = 0.0, onehot: bool = False, log: bool = True, extended: bool = False) -> str:
    """Prices of a penalised linear fit on the whole design: products in SQL, then elimination, or descent if there is an l1.

    The squared part of the penalty is l2 + l2_rows / rows.
    """
    y = "ln(1 + label)" if log else "label"
    numeric = {**{c: c for c in NUMERIC}, **DERIVED}
    ctes = [FILLED]
    source = "filled"
    if extended:
        ctes.append("size_med AS (SELECT grp, quantile_cont(size_a + size_b + size_c, 0.5) AS m FROM filled GROUP BY grp)")
        ctes.append("""sized AS (SELECT f.*, CASE WHEN m > 0 THEN (size_a + size_b + size_c) / m END AS rel,
  quality * (size_a + size_b + size_c) AS inter FROM filled f JOIN size_med USING (grp))""")
        ctes.append("full_sized AS (SELECT * EXCLUDE (rel), coalesce(rel, quantile_cont(rel, 0.5) OVER ()) AS rel FROM sized)")
        numeric |= {"rel": "rel", "inter": "inter"}
        source = "full_sized"
    names = [f"x{i}" for i in range(len(numeric))]
    columns = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in zip(names, numeric.values()))
    ctes.append(f"base AS (SELECT id, {y} AS y, {hash32('id', f'inner:{SEED}')} % {INNER_FOLDS} AS f, {columns}, {', '.join(CATEGORICAL)} FROM {source})")
    if onehot:
        marks = [f"CASE WHEN {c} = '{k}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS c_{c}_{i}" for c in CATEGORICAL for i, k in enumerate(CATEGORIES[c])]
        names += [m.rsplit(" ", 1)[1] for m in marks]
        ctes += [f"design AS MATERIALIZED (SELECT id, y, {', '.join([*names[:len(numeric)], *marks])} FROM base)", "asked AS (SELECT * FROM design)"]
    else:
        for c in CATEGORICAL:
            ctes.append(f"""full_{c} AS (SELECT {c}, (sum(y) + 10 * (SELECT avg(y) FROM base)) / (COUNT(*) + 10) AS v FROM base GROUP BY {c})""")
            ctes.append(f"""out_{c} AS (SELECT t.f, k.{c}, (coalesce(sum(b.y), 0) + 10 * any_value(t.p)) / (COUNT(b.y) + 10) AS v
  FROM (SELECT m.f, avg(b.y) AS p FROM range({INNER_FOLDS}) m(f) JOIN base b ON b.f <> m.f GROUP BY m.f) t
  CROSS JOIN (SELECT DISTINCT {c} FROM base) k LEFT JOIN base b ON b.f <> t.f AND b.{c} = k.{c} GROUP BY t.f, k.{c})""")
        own = ", ".join(f"out_{c}.v AS c_{c}" for c in CATEGORICAL)
        joins = " ".join(f"JOIN out_{c} ON out_{c}.f = b.f AND out_{c}.{c} = b.{c}" for c in CATEGORICAL)
        ctes.append(f"design AS MATERIALIZED (SELECT id, y, {', '.join(names)}, {own} FROM base b {joins})")
        own = ", ".join(f"full_{c}.v AS c_{c}" for c in CATEGORICAL)
        joins = " ".join(f"JOIN full_{c} ON full_{c}.{c} = b.{c}" for c in CATEGORICAL)
        ctes.append(f"asked AS (SELECT id, {', '.join(names)}, {own} FROM base b {joins})")
        names += [f"c_{c}" for c in CATEGORICAL]
    k = len(names)
    ctes.append("mean AS MATERIALIZED (SELECT COUNT(*) AS n, avg(y) AS y0, " + ", ".join(
        f"avg({x}) AS m{i}, 1 / stddev_pop({x}) AS s{i}" for i, x in enumerate(names)) + " FROM design)")
    ctes.append("z AS (SELECT y - y0 AS y, n, " + ", ".join(f"({x} - m{i}) * s{i} AS z{i}" for i, x in enumerate(names)) + " FROM design CROSS JOIN mean)")
    ctes.append("prod AS MATERIALIZED (SELECT any_value(n) AS n, " + ", ".join(
        [f"sum(z{i} * z{j}) / any_value(n) AS g{i}_{j}" for i in range(k) for j in range(i, k)] + [f"sum(z{i} * y) / any_value(n) AS b{i}" for i in range(k)]) + " FROM z)")
    g = lambda i, j: f"g{min(i, j)}_{max(i, j)}"
    if l1:
        rows = ", ".join("[" + ", ".join(g(i, j) for j in range(k)) + "]" for i in range(k))
        ctes.append(f"""descent AS (SELECT 0 AS step, [{rows}] AS g, [{', '.join(['0.0::DOUBLE'] * k)}] AS w, [{', '.join(f'b{j}' for j in range(k))}] AS r,
    {l2} + {l2_rows} / n AS l2 FROM prod
  UNION ALL SELECT step + 1, g, list_transform(w, lambda v, i: CASE WHEN i = j THEN new ELSE v END),
    list_transform(r, lambda v, i: v - g[i][j] * (new - w[j])), l2
  FROM (SELECT *, sign(pull) * greatest(abs(pull) - {l1}, 0) / (g[j][j] + l2) AS new
    FROM (SELECT *, r[j] + g[j][j] * w[j] AS pull FROM (SELECT *, step % {k} + 1 AS j FROM descent WHERE step < {SWEEPS * k}))))""")
        ctes.append(f"w AS (SELECT w FROM descent WHERE step = {SWEEPS * k})")
    else:
        rows = ", ".join("[" + ", ".join([g(i, j) + (f" + {l2} + {l2_rows} / n" if i == j else "") for j in range(k)] + [f"b{i}"]) + "]" for i in range(k))
        ctes.append(f"""steps AS (SELECT 0 AS j, [{rows}] AS m FROM prod
  UNION ALL SELECT j + 1, CASE WHEN abs(m[j + 1][j + 1]) < 1e-9 THEN list_transform(m, lambda r, i: CASE WHEN i = j + 1 THEN list_transform(r, lambda v: 0.0::DOUBLE) ELSE r END)
    ELSE list_transform(m, lambda r, i: CASE WHEN i = j + 1 THEN list_transform(r, lambda v: v / r[j + 1])
      ELSE list_transform(r, lambda v, c: v - r[j + 1] * m[j + 1][c] / m[j + 1][j + 1]) END) END
  FROM steps WHERE j < {k})""")
        ctes.append(f"w AS (SELECT list_transform(m, lambda r: r[{k + 1}]) AS w FROM steps WHERE j = {k})")
    value = "y0 + " + " + ".join(f"w[{i + 1}] * s{i} * ({x} - m{i})" for i, x in enumerate(names))
    price = f"exp({value}) - 1" if log else value
    return "WITH RECURSIVE" + over_listing(*ctes, select=f"SELECT id, round(greatest({price}, 0.0), -2) AS price FROM asked CROSS JOIN mean CROSS JOIN w")[4:]


def planted_fit(shrink: str = "") -> str:
    """Prices of a label of known splits, as it is, or after `shrink` (SQL on the log label y, its mean and sum of squares)."""
    label = "100000.0::DOUBLE + CASE WHEN quality > 3 THEN 40000 ELSE 0 END + CASE WHEN year_sold >= 1995 THEN 10000 ELSE 0 END"
    if not shrink:
        return over_listing(select=f"SELECT id, round({label}, 2) AS price FROM listing")
    return over_listing(
        f"p AS (SELECT id, ln(1 + {label}) AS y FROM listing)", "s AS (SELECT avg(y) AS y0, sum(y * y) - COUNT(*) * avg(y) * avg(y) AS ss FROM p)",
        select=f"SELECT id, round(exp({shrink}) - 1, 2) AS price FROM p CROSS JOIN s")


FITS = {
    "ridge_fit": linear_fit(0, 10.0),
    "onehot_ols_fit": linear_fit(0, 0, onehot=True, log=False),
    "lasso_fit": linear_fit(0.001, 0),
    "elasticnet_fit": linear_fit(0.0005, 0, 0.0005),
    "ridge_extended_fit": linear_fit(0, 10.0, extended=True),
    **{f"{name}_fit": planted_fit() for name in ("forest", "gbt_shallow", "gbt_deep", "voting", "weighted")},
    # Every tree parts the same groups, so each leaves 0.95 of the residuals of the one before.
    **{f"{name}_fit": planted_fit("y0 + (1 - pow(0.95, 200)) * (y - y0)") for name in ("gbt_mid", "gbt_symmetric")},
    # Both bases give the label itself; a ridge of one on two equal columns gives each the weight ss / (2 ss + 1).
    "stacking_fit": planted_fit("y0 + (2 * ss / (2 * ss + 1)) * (y - y0)"),
}


ORACLES = {
    "dedup_rows": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "dedup_first": "SELECT l_linenumber, l_returnflag, l_linestatus, min(l_orderkey) AS position FROM lineitem GROUP BY ALL",
    "validate_ids": """SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS missing_ids,
  COUNT(*) FILTER (WHERE trim(CAST(l_orderkey AS VARCHAR)) = '') AS blank_ids,
  COUNT(l_orderkey) - COUNT(DISTINCT l_orderkey) AS repeated_ids FROM lineitem""",
    "parse_money": "SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders",
    "clean_numeric": """SELECT c_custkey, CAST(CAST(substr(c_name, 10) AS BIGINT) AS DOUBLE) AS padded,
  CAST('-.' || substr(c_name, 10) || 'e2' AS DOUBLE) AS scientific,
  CAST(NULL AS DOUBLE) AS suffixed, CAST(NULL AS DOUBLE) AS word FROM customer""",
    "clean_category": f"""SELECT doc_id, md5({CLEAN_TEXT}) AS text_md5, length({CLEAN_TEXT}) AS chars,
  coalesce(nullif(trim(lang), ''), 'Missing') AS lang FROM documents""",
    "csv_source": over_listing(select="SELECT " + ", ".join(COLUMNS) + " FROM listing"),
    "missing_profile": over_listing(select=each(
        "SELECT '{c}' AS column, COUNT(*) - COUNT({c}) AS missing_rows, "
        "round(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 6) AS missing_percent FROM listing", COLUMNS)),
    "numeric_summary": over_listing(select=each(
        "SELECT '{c}' AS column, COUNT({c}) AS count, round(avg({c}), 6) AS mean, "
        "round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
        "round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
        "round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM listing",
        [*NUMERIC, "label"])),
    "pearson_matrix": over_listing(select="\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, round(corr({a}, {b}), 8) AS pearson FROM listing"
        for a in NUMERIC for b in NUMERIC)),
    "spearman_target": over_listing(LONG, SPEARMAN_RANKS, select=SPEARMAN),
    "category_counts": over_listing(select=each(
        "SELECT '{c}' AS feature, coalesce({c}, 'Missing') AS category, COUNT(*) AS rows FROM listing GROUP BY 2",
        CATEGORICAL)),
    "histogram": over_listing(
        "v AS (SELECT 'label' AS variable, label AS x FROM listing UNION ALL "
        "SELECT 'log1p_label', ln(1 + label) FROM listing)",
        "b AS (SELECT variable, min(x) AS lo, max(x) AS hi FROM v GROUP BY variable)",
        "c AS (SELECT v.variable, CAST(least(floor((x - lo) / (hi - lo) * 30), 29) AS INTEGER) + 1 AS bin, "
        "COUNT(*) AS rows FROM v JOIN b ON b.variable = v.variable GROUP BY 1, 2)",
        select="""SELECT b.variable, CAST(s.i AS INTEGER) AS bin, round(lo + (hi - lo) * (s.i - 1) / 30, 6) AS lower,
  round(lo + (hi - lo) * s.i / 30, 6) AS upper, coalesce(c.rows, 0) AS rows
  FROM b CROSS JOIN range(1, 31) s(i) LEFT JOIN c ON c.variable = b.variable AND c.bin = s.i"""),
    "impute_median": over_listing(FILLED, select="SELECT * EXCLUDE (label) FROM filled"),
    "drop_incomplete": over_listing(select='SELECT "column" FROM (' + each(
        "SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS gone FROM listing", [*NUMERIC, *CATEGORICAL]
    ) + ") WHERE gone = 0"),
    "derived_features": over_listing(FILLED, select="""SELECT id, size_a + size_b + size_c AS "TotalSF",
  full_cnt + 0.5 * half_cnt AS "TotalBath", year_sold - year_built AS "AgeAtSale" FROM filled"""),
    "group_relative": over_listing(
        FILLED,
        "med AS (SELECT grp, quantile_cont(size_a + size_b + size_c, 0.5) AS m FROM filled GROUP BY grp)",
        select="""SELECT id, round(CASE WHEN m > 0 THEN (size_a + size_b + size_c) / m END, 8) AS "SF_Rel_to_Nbhd",
  quality * (size_a + size_b + size_c) AS "Qual_SF_Interact" FROM filled JOIN med ON med.grp = filled.grp"""),
    "split_assign": over_listing(
        f"h AS (SELECT id, {hash_rank(f'split:{SEED}')} < ceil({N_SPLIT} * 0.20) AS holdout FROM listing)",
        f"v AS (SELECT id, {hash_rank(f'split:{SEED + 1}')} AS r, COUNT(*) OVER () AS n FROM h WHERE NOT holdout)",
        select="""SELECT h.id, CASE WHEN holdout THEN 'holdout'
  WHEN r < ceil(n * (0.16::DOUBLE / (1::DOUBLE - 0.20::DOUBLE))) THEN 'validation' ELSE 'train' END AS partition
  FROM h LEFT JOIN v ON v.id = h.id"""),
    "kfold_assign": over_listing(FOLDED, select="SELECT id, fold FROM folded"),
    "permute_labels": over_listing(
        f"s AS (SELECT id, {hash_rank(f'null:{SEED}:0:to')} AS r FROM listing)",
        f"v AS (SELECT label, {hash_rank(f'null:{SEED}:0:from')} AS r FROM listing)",
        select="SELECT s.id, v.label FROM s JOIN v ON v.r = s.r"),
    "hash_order_index": over_listing(
        select=f"SELECT id, {hash_rank(f'order:{SEED}')} AS row_index FROM listing"),
    "target_encode_full": over_listing(ENCODED_FULL, select="SELECT id, " + ", ".join(
        f"round(enc_{c}.v, 6) AS {c}_encoded" for c in CATEGORICAL) + " FROM listing l " + " ".join(
        f"JOIN enc_{c} ON enc_{c}.{c} = l.{c}" for c in CATEGORICAL)),
    "target_encode_crossfit": over_listing(
        FOLDED, PRIORS, *[crossed(c) for c in CATEGORICAL],
        select="SELECT id, f.fold, " + ", ".join(
            f"round(cross_{c}.v, 6) AS {c}_encoded" for c in CATEGORICAL) + " FROM folded f " + " ".join(
            f"JOIN cross_{c} ON cross_{c}.fold = f.fold AND cross_{c}.{c} = f.{c}" for c in CATEGORICAL)),
    "onehot_encode": over_listing(select="SELECT id, " + ", ".join(
        f"CASE WHEN {c} = '{k}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{c}_{k}\""
        for c, ks in CATEGORIES.items() for k in ks) + " FROM listing"),
    "crossfit_metrics": over_listing(
        FOLDED, PRIORS, crossed("grp"),
        select="SELECT f.fold, " + metric_columns("f.label", "x.v")
        + " FROM folded f JOIN cross_grp x ON x.fold = f.fold AND x.grp = f.grp GROUP BY f.fold"),
    "knn_peer_price": over_listing(
        *peers("listing b", "listing", "0", "0"),
        select="SELECT l.id, p.log_peer_price FROM listing l JOIN price p ON p.qid = l.id"),
    "knn_peer_crossfit": over_listing(
        FOLDED, *peers(f"range({FOLDS}) m(f) JOIN folded b ON b.fold <> m.f", "folded", "m.f", "fold"),
        select="SELECT l.id, l.fold, p.log_peer_price FROM folded l JOIN price p ON p.qid = l.id"),
    "metric_summary": over_listing(GUESSED, select=f"SELECT {metric_columns('label', 'guess')} FROM guessed"),
    "quantile_bands": over_listing(GUESSED, EDGES, BANDED, select="SELECT id, band FROM banded"),
    "band_metrics": over_listing(
        GUESSED, EDGES, BANDED,
        select=f"SELECT band, {metric_columns('label', 'guess')}, round(100 * sum(pow(label - guess, 2)) / "
        "(SELECT sum(pow(label - guess, 2)) FROM guessed), 6) AS sse_percent FROM banded GROUP BY band"),
    "median_baseline_cv": over_listing(*CV, select=each(
        "SELECT fold, '{c}' AS metric, round({c}, 6) AS value FROM wide WHERE ordinal = 0",
        ("mae", "rmse", "r2"))),
    "cv_summary": over_listing(*CV, select="SELECT candidate, " + ", ".join(
        f"round(avg({m}), 5) AS {m}, round(stddev_samp({m}), 5) AS {m}_std" for m in ("mae", "rmse", "r2")
    ) + " FROM wide GROUP BY candidate"),
    "pick_winner": over_listing(
        *CV, select="SELECT candidate FROM wide GROUP BY candidate, ordinal ORDER BY avg(rmse), ordinal LIMIT 1"),
    "univariate_ols": over_listing(select="""SELECT regr_count(label, acctbal) AS rows,
  round(regr_slope(label, acctbal), 6) AS slope, round(regr_intercept(label, acctbal), 6) AS intercept FROM listing"""),
    "smearing_factor": over_listing(
        "f AS (SELECT regr_slope(ln(1 + label), quality) AS s, regr_intercept(ln(1 + label), quality) AS i FROM listing)",
        select="SELECT round(avg(exp(ln(1 + label) - (i + s * quality))), 8) AS factor FROM listing CROSS JOIN f"),
    "weighted_vote": over_listing(
        """f AS (SELECT regr_slope(ln(1 + label), quality) AS s1, regr_intercept(ln(1 + label), quality) AS i1,
  regr_slope(ln(1 + label), acctbal) AS s2, regr_intercept(ln(1 + label), acctbal) AS i2 FROM listing)""",
        select="""SELECT id, round(0.5 * (i1 + s1 * quality) + 0.5 * (i2 + s2 * acctbal), 8) AS voting,
  round(0.3 * (i1 + s1 * quality) + 0.7 * (i2 + s2 * acctbal), 8) AS weighted FROM listing CROSS JOIN f"""),
    "penalised_fits": over_listing(
        "m AS (SELECT avg(acctbal) AS a, stddev_pop(acctbal) AS s, avg(label) AS y, COUNT(*) AS n FROM listing)",
        "g AS (SELECT sum((acctbal - a) / s * (label - y)) AS sxy, any_value(n) AS n, any_value(y) AS y "
        "FROM listing CROSS JOIN m)",
        select="""SELECT 'ridge' AS model, round(sxy / (n + 1000.0), 3) AS slope, round(y, 3) AS intercept FROM g
  UNION ALL SELECT 'lasso', round(sign(sxy) * greatest(abs(sxy / n) - 100.0, 0), 3), round(y, 3) FROM g
  UNION ALL SELECT 'elasticnet', round(sign(sxy) * greatest(abs(sxy / n) - 50.0, 0) / 51.0, 3), round(y, 3) FROM g"""),
    "null_threshold": over_listing(
        LONG, GAINS, "t AS (SELECT feature, actual, (SELECT quantile_cont(u, 0.95) FROM unnest(nulls) x(u)) AS threshold FROM gains)",
        select="SELECT feature, round(threshold, 12) AS threshold, round(actual, 12) AS actual, "
        "actual > threshold AS selected FROM t"),
    "stability_count": over_listing(
        LONG, GAINS,
        select="SELECT feature, len(list_filter(nulls[1:5], lambda u: u < actual)) AS passes, "
        "len(list_filter(nulls[1:5], lambda u: u < actual)) >= 4 AS selected FROM gains"),
    "eda_job": over_listing(LONG, SPEARMAN_RANKS, select=SPEARMAN),
    "table_fingerprint": over_listing(
        "h AS (SELECT CAST('0x' || substr(md5(concat_ws(chr(31), " + ", ".join(
            f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in COLUMNS) + ")), 1, 15) AS BIGINT) AS h FROM listing)",
        select="SELECT COUNT(*) AS rows, bit_xor(h) AS xor_hash, CAST(sum(h) AS VARCHAR) AS sum_hash FROM h"),
} | FITS
