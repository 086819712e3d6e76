"""The same results in SQL for DuckDB, written without looking at the Spark plans."""

from __future__ import annotations

_KEY = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

MARKET = f"""
market AS (
  SELECT {_KEY} AS row_key,
         ('0x' || substr(md5({_KEY}), 1, 4))::int % 100 AS bucket,
         strftime(l_shipdate, '%d-%m-%Y') AS "Date",
         l_extendedprice / l_quantity AS "AveragePrice",
         l_quantity AS "Total Volume",
         CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN l_quantity ELSE 0.0 END AS "4046",
         CASE WHEN p_type IN ('MEDIUM', 'STANDARD') THEN l_quantity ELSE 0.0 END AS "4225",
         CASE WHEN p_type IN ('LARGE', 'PROMO') THEN l_quantity ELSE 0.0 END AS "4770",
         p_size::double AS "Total Bags",
         CASE WHEN p_size <= 20 THEN p_size ELSE 0 END::double AS "Small Bags",
         CASE WHEN p_size BETWEEN 21 AND 40 THEN p_size ELSE 0 END::double AS "Large Bags",
         CASE WHEN p_size > 40 THEN p_size ELSE 0 END::double AS "XLarge Bags",
         CASE l_linestatus WHEN 'F' THEN 'conventional' WHEN 'O' THEN 'organic' END AS "type",
         year(l_shipdate)::int AS "year",
         month(l_shipdate)::int AS shipped_month,
         n_name AS region
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

VOLUMES = [
    "Total Volume", "4046", "4225", "4770", "Total Bags", "Small Bags", "Large Bags", "XLarge Bags",
]
LOGS = ["4225", "4770", "Small Bags", "Large Bags", "XLarge Bags"]
FILE_COLUMNS = ["Date", "AveragePrice", *VOLUMES, "type", "year", "region"]
TYPES = {
    "row_key": "string", "bucket": "int", "Date": "string", "AveragePrice": "double",
    **{c: "double" for c in VOLUMES}, "type": "string", "year": "int", "region": "string",
}
MONTHS = {
    1: "JAN", 2: "FEB", 3: "MARCH", 4: "APRIL", 5: "MAY", 6: "JUNE", 7: "JULY", 8: "AUG",
    9: "SEPT", 10: "OCT", 11: "NOV", 12: "DEC",
}
MONTH_CASE = "CASE shipped_month " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in MONTHS.items()
) + " END"
TYPE_CASE = "CASE \"type\" WHEN 'conventional' THEN 0 WHEN 'organic' THEN 1 END::int"


def _q(name: str) -> str:
    return '"' + name + '"'


def _with(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([MARKET.strip(), *more]) + "\n" + body


def _columns(names: list[str]) -> str:
    return ", ".join(_q(n) for n in names)


def _dummies(expr: str, prefix: str, levels: list[str]) -> str:
    return ", ".join(
        f"({expr} = '{v}')::int AS {_q(prefix + '_' + v)}" for v in sorted(levels)[1:]
    )


REGIONS = [f"NATION_{i}" for i in range(25)]
YEARS = [str(y) for y in range(1995, 2002)]

# --- features of the linear model ---------------------------------------------------------

LINEAR = f"""
base AS (
  SELECT row_key, bucket, "type", "year", shipped_month AS m, "AveragePrice",
         {', '.join(f'ln({_q(c)} + 1) AS {_q("LOG " + c)}' for c in LOGS)}
  FROM market
),
span AS (SELECT min(m) AS lo, max(m) AS hi FROM base WHERE bucket < 70),
freq AS (
  SELECT "type" AS level,
         (row_number() OVER (ORDER BY count(*) DESC, "type") - 1)::double AS idx
  FROM base WHERE bucket < 70 GROUP BY "type"
),
raw AS (
  SELECT row_key, bucket, "type", m, idx, "AveragePrice" AS y, "year"::double AS x0,
         CASE WHEN hi > lo THEN (m - lo)::double / (hi - lo) ELSE 0.5 END AS x1,
         {', '.join(f'{_q("LOG " + c)} AS x{i + 2}' for i, c in enumerate(LOGS))}
  FROM base, span, freq WHERE freq.level = base."type"
),
fit AS (
  SELECT {', '.join(f'avg(x{i}) AS m{i}, stddev_samp(x{i}) AS s{i}' for i in range(7))}
  FROM raw WHERE bucket < 70
)"""


def _z(i: int, name: str) -> str:
    return f"round(CASE WHEN s{i} > 0 THEN (x{i} - m{i}) / s{i} ELSE 0 END, 6) AS {name}"


# --- the search of the linear model: coordinate descent as a recursive table ---------------

_SIZE = 10      # 1, eight features, label
# what a fold is fitted on: all other folds, or (one fit, called fold -1) all rows
_OTHER_FOLDS = "SELECT fold, i, j, s AS own, sum(s) OVER (PARTITION BY i, j) - s AS t FROM products"
_ALL_ROWS = "SELECT -1 AS fold, i, j, 0.0::double AS own, sum(s) AS t FROM products GROUP BY i, j"
_GRID = "(VALUES (0.05::double), (0.1), (0.2), (0.5)) p(reg), (VALUES (0.01::double), (0.5), (1.0)) e(mix)"
_RIDGE = "(SELECT 0.3::double AS reg, 0.0::double AS mix)"


def _descent(others: str, points: str, tol: str) -> str:
    return f"""
vectors AS (
  SELECT bucket % 10 AS fold,
         [1.0, {', '.join(f"CASE WHEN s{i} > 0 THEN (x{i} - m{i}) / s{i} ELSE 0 END" for i in range(7))}, idx, y] AS v
  FROM raw, fit WHERE bucket < 70
),
products AS (
  SELECT fold, i, j, sum(v[i] * v[j]) AS s FROM vectors, range(1, {_SIZE + 1}) a(i), range(1, {_SIZE + 1}) b(j)
  GROUP BY fold, i, j
),
others AS ({others}),
heads AS (
  SELECT fold, max(t) FILTER (i = 1 AND j = 1) AS n, list(t ORDER BY j) FILTER (i = 1) AS sums FROM others GROUP BY fold
),
covariances AS (
  SELECT fold, i, j, t / n - sums[i] / n * sums[j] / n AS c, sums[i] / n AS mean_i
  FROM others JOIN heads USING (fold)
),
spreads AS (
  SELECT fold, i, sqrt(greatest(c, 0)) AS s, sqrt(greatest(c, 0)) > 1e-9 * abs(mean_i) AS live
  FROM covariances WHERE i = j
),
scaled AS (
  SELECT c.fold, c.i, c.j, c.c / CASE WHEN a.live THEN a.s ELSE 1 END / CASE WHEN b.live THEN b.s ELSE 1 END AS a
  FROM covariances c JOIN spreads a ON a.fold = c.fold AND a.i = c.i JOIN spreads b ON b.fold = c.fold AND b.i = c.j
),
lines AS (
  SELECT fold, i, list(a ORDER BY j) FILTER (j BETWEEN 2 AND {_SIZE - 1}) AS line, max(a) FILTER (j = {_SIZE}) AS r
  FROM scaled WHERE i BETWEEN 2 AND {_SIZE - 1} GROUP BY fold, i
),
systems AS (
  SELECT fold, list(line ORDER BY i) AS a, list(r ORDER BY i) AS r FROM lines GROUP BY fold
),
settings AS (
  SELECT fold, a, r, reg, mix, reg * mix / s AS l1, reg * (1 - mix) / s AS l2,
         live, scales, s AS sy
  FROM systems JOIN (
    SELECT fold, max(s) FILTER (i = {_SIZE}) AS s,
           list(live ORDER BY i) FILTER (i BETWEEN 2 AND {_SIZE - 1}) AS live,
           list(CASE WHEN live THEN s ELSE 1 END ORDER BY i) FILTER (i BETWEEN 2 AND {_SIZE - 1}) AS scales
    FROM spreads GROUP BY fold) USING (fold),
    {points}
),
descent AS (
  SELECT fold, reg, mix, 0 AS step, [{', '.join(['0.0::double'] * (_SIZE - 2))}] AS beta, 0.0::double AS worst FROM settings
  UNION ALL
  SELECT fold, reg, mix, step + 1, list_transform(beta, lambda x, i: CASE WHEN i = k THEN moved ELSE x END),
         greatest(CASE WHEN k = 1 THEN 0 ELSE worst END, abs(moved - beta[k]))
  FROM (
    SELECT *, CASE WHEN live[k] THEN sign(rest) * greatest(abs(rest) - l1, 0) / (a[k][k] + l2) ELSE 0 END AS moved
    FROM (
      SELECT d.*, s.a, s.l1, s.l2, s.live, step % {_SIZE - 2} + 1 AS k,
             s.r[step % {_SIZE - 2} + 1] - list_dot_product(s.a[step % {_SIZE - 2} + 1], beta)
             + s.a[step % {_SIZE - 2} + 1][step % {_SIZE - 2} + 1] * beta[step % {_SIZE - 2} + 1] AS rest
      FROM descent d JOIN settings s ON s.fold = d.fold AND s.reg = d.reg AND s.mix = d.mix
      WHERE step < 500 * {_SIZE - 2} AND NOT (step > 0 AND step % {_SIZE - 2} = 0 AND worst <= {tol})))
),
fits AS (
  SELECT fold, reg, mix, sums[{_SIZE}] / n - list_dot_product(list_transform(sums[2:{_SIZE - 1}], lambda x: x / n), beta) AS b0,
         beta, worst <= {tol} AS converged
  FROM (
    SELECT d.fold, d.reg, d.mix, d.worst, list_transform(d.beta, lambda b, i: b * sy / scales[i]) AS beta
    FROM descent d JOIN settings s ON s.fold = d.fold AND s.reg = d.reg AND s.mix = d.mix
    QUALIFY row_number() OVER (PARTITION BY d.fold, d.reg, d.mix ORDER BY step DESC) = 1
  ) JOIN heads USING (fold)
),
scores AS (
  SELECT reg, mix, avg(rmse) AS avg_rmse FROM (
    SELECT fold, reg, mix, sqrt(greatest(sum(w[i] * w[j] * own), 0) / max(own) FILTER (i = 1 AND j = 1)) AS rmse
    FROM (SELECT fold, reg, mix, list_concat(list_concat([-b0], list_transform(beta, lambda b: -b)), [1.0::double]) AS w FROM fits)
    JOIN others USING (fold) GROUP BY fold, reg, mix)
  GROUP BY reg, mix
)"""


# The other settings of the regressor, as the library names them.
LINEAR_SETTINGS = {
    "aggregationDepth": "2", "epsilon": "1.35", "featuresCol": "features", "fitIntercept": "True",
    "labelCol": "AveragePrice", "loss": "squaredError", "maxBlockSizeInMB": "0.0", "maxIter": "500",
    "predictionCol": "prediction", "solver": "auto", "standardization": "True", "tol": "1e-06",
}


def _recursive(
    body: str, *more: str, others: str = _OTHER_FOLDS, points: str = _GRID, tol: str = "1e-10"
) -> str:
    tables = [LINEAR.strip(), _descent(others, points, tol).strip(), *more]
    return _with(body, *tables).replace("WITH ", "WITH RECURSIVE ", 1)


def _fitted(body: str) -> str:
    """With a table ``predicted`` of all rows under the ridge model of the training rows."""
    vector = ", ".join(f"CASE WHEN s{i} > 0 THEN (x{i} - m{i}) / s{i} ELSE 0 END" for i in range(7))
    predicted = f"""predicted AS (
  SELECT row_key, bucket, y, b0 + list_dot_product(beta, [{vector}, idx]) AS p FROM raw, fit, fits
)"""
    return _recursive(body, predicted, others=_ALL_ROWS, points=_RIDGE, tol="1e-13")


# --- trees of one split: every threshold of every feature --------------------------------

_TREE_COLUMNS = [*VOLUMES, "type_code", "sold_year", "sold_month"]
_TREE_VALUES = {
    **{c: f"{_q(c)}::double" for c in VOLUMES}, "type_code": f"({TYPE_CASE})::double",
    "sold_year": '"year"::double', "sold_month": "shipped_month::double",
}
TREE_ROWS = f"""
sample AS (SELECT row_key, "AveragePrice" AS y FROM market WHERE bucket < 70),
base AS (SELECT avg(y) AS base FROM sample),
cells AS (
  SELECT row_key, f, x FROM (
    SELECT row_key, unnest(range({len(_TREE_COLUMNS)})) AS f,
           unnest([{', '.join(_TREE_VALUES[c] for c in _TREE_COLUMNS)}]) AS x
    FROM market WHERE bucket < 70)
)"""


def _stump(name: str, source: str, penalty: float, least: int) -> str:
    """Tables of the best split of (row_key, g) rows with second derivative one."""
    score = lambda g, h: f"({g}) * ({g}) / ({h} + {penalty})"
    return f"""
{name}_sums AS (
  SELECT f, x, sum(g) AS g, count(*) AS n FROM cells JOIN {source} USING (row_key) GROUP BY f, x
),
{name}_cuts AS (
  SELECT f, (x + lead(x) OVER (PARTITION BY f ORDER BY x)) / 2 AS cut,
         sum(g) OVER (PARTITION BY f ORDER BY x) AS gl, sum(n) OVER (PARTITION BY f ORDER BY x) AS nl,
         sum(g) OVER (PARTITION BY f) AS gt, sum(n) OVER (PARTITION BY f) AS nt
  FROM {name}_sums
),
{name}_gains AS (
  SELECT *, {score('gl', 'nl')} + {score('gt - gl', 'nt - nl')} - {score('gt', 'nt')} AS gain
  FROM {name}_cuts WHERE cut IS NOT NULL AND nl >= {least} AND nt - nl >= {least}
),
{name} AS (
  SELECT f, cut, nl, nt, -gl / (nl + {penalty}) AS lower, -(gt - gl) / (nt - nl + {penalty}) AS upper,
         -gt / (nt + {penalty}) AS whole
  FROM {name}_gains ORDER BY round(gain / (SELECT max(gain) FROM {name}_gains), 9) DESC, f, cut LIMIT 1
)"""


def _nodes(tree: int, name: str) -> str:
    names = "[" + ", ".join(f"'{c}'" for c in _TREE_COLUMNS) + "]"
    return f"""SELECT {tree}::int AS tree, 0::int AS node, 0::int AS depth, nt::bigint AS rows, {names}[f + 1] AS feature,
  round(cut, 4) AS threshold, round(whole, 4) AS "value", round(base, 4) AS base FROM {name}, base
UNION ALL SELECT {tree}, 1, 1, nl::bigint, NULL, NULL, round(lower, 4), round(base, 4) FROM {name}, base
UNION ALL SELECT {tree}, 2, 1, (nt - nl)::bigint, NULL, NULL, round(upper, 4), round(base, 4) FROM {name}, base"""


_LEAF = "CASE WHEN x <= cut THEN lower ELSE upper END"
BOOSTED = (
    TREE_ROWS.strip(),
    'first_errors AS (SELECT row_key, base - y AS g FROM sample, base)',
    _stump("one", "first_errors", 1.0, 1).strip(),
    f"""second_errors AS (
  SELECT row_key, g + 0.3 * {_LEAF} AS g FROM first_errors JOIN cells USING (row_key) JOIN one USING (f)
)""",
    _stump("two", "second_errors", 1.0, 1).strip(),
)

# --- fixed predictors ---------------------------------------------------------------------

FIXED = """
train AS (SELECT * FROM market WHERE bucket < 70),
test AS (SELECT * FROM market WHERE bucket >= 70),
overall AS (SELECT avg("AveragePrice") AS m FROM train),
by_type AS (SELECT "type", avg("AveragePrice") AS m FROM train GROUP BY "type"),
by_region AS (SELECT region, avg("AveragePrice") AS m FROM train GROUP BY region),
predictions AS (
  SELECT 'Mean' AS model, test."type", "AveragePrice" AS y, overall.m AS p FROM test, overall
  UNION ALL
  SELECT 'Mean by type', test."type", "AveragePrice", coalesce(by_type.m, overall.m)
  FROM test CROSS JOIN overall LEFT JOIN by_type ON by_type."type" = test."type"
  UNION ALL
  SELECT 'Mean by region', test."type", "AveragePrice", coalesce(by_region.m, overall.m)
  FROM test CROSS JOIN overall LEFT JOIN by_region ON by_region.region = test.region
)"""

SCORES = """count(*) AS rows, round(avg(abs(y - p)), 4) AS mae,
  round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2"""

_DESCRIBED = ["AveragePrice", *VOLUMES, "year"]

SQL: dict[str, str] = {
    "q_input_files": " UNION ALL ".join(
        f"SELECT '{name}' AS input, count(*) AS rows FROM {name}" for name in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        )
    ),
    "q_csv_scan": _with(f"SELECT {_columns(FILE_COLUMNS)} FROM market"),
    "q_preview": _with(
        f"SELECT row_key, bucket, {_columns(FILE_COLUMNS)} FROM market ORDER BY row_key LIMIT 20"
    ),
    "q_feature_sql": _with(
        'SELECT row_key, "AveragePrice", "type", '
        + ", ".join(f'round(ln({_q(c)} + 1), 8) AS {_q("LOG " + c)}' for c in LOGS)
        + ', "year", shipped_month AS "month" FROM market'
    ),
    "q_calendar": _with(
        'SELECT row_key, "year" AS sold_year, shipped_month AS sold_month FROM market'
    ),
    "q_type_map": _with(f'SELECT row_key, "type", {TYPE_CASE} AS type_code FROM market'),
    "q_dummies": _with(
        f"SELECT row_key, {_columns(VOLUMES)}, {TYPE_CASE} AS type_code, "
        f"{_dummies('region', 'region', REGIONS)} FROM market"
    ),
    "q_dummies_all": _with(
        f"SELECT row_key, {_columns(VOLUMES)}, {TYPE_CASE} AS type_code, "
        f"{_dummies('\"year\"::varchar', 'year', YEARS)}, "
        f"{_dummies('region', 'region', REGIONS)}, "
        f"{_dummies(MONTH_CASE, 'Month', list(MONTHS.values()))} FROM market"
    ),
    "q_profile_info": _with(
        "\nUNION ALL ".join(
            f'SELECT {i}::int AS "position", \'{c}\' AS "column", \'{t}\' AS dtype, '
            f'count({_q(c)}) AS non_null, count(*) AS rows, {len(TYPES)}::int AS "columns" FROM market'
            for i, (c, t) in enumerate(TYPES.items())
        )
    ),
    "q_describe": _with(
        "\nUNION ALL ".join(
            f'SELECT \'{c}\' AS "column", count({_q(c)}) AS "count", round(avg({_q(c)}), 4) AS mean, '
            f"round(stddev_samp({_q(c)}), 4) AS std, round(min({_q(c)})::double, 4) AS min, "
            + ", ".join(
                f"round(quantile_cont({_q(c)}::double, {p}), 4) AS p{int(p * 100)}"
                for p in (0.25, 0.5, 0.75)
            )
            + f", round(max({_q(c)})::double, 4) AS max FROM market"
            for c in _DESCRIBED
        )
    ),
    "q_value_counts": _with('SELECT "year", count(*) AS "count" FROM market GROUP BY "year"'),
    "q_count_year_type": _with(
        'SELECT "year", "type", count(*) AS "count" FROM market GROUP BY "year", "type"'
    ),
    "q_count_month": _with(
        f'SELECT {MONTH_CASE} AS "Month", count(*) AS "count" FROM market GROUP BY 1'
    ),
    "q_box_stats": _with(
        """SELECT market."type", n, round(q1, 4) AS q1, round(q2, 4) AS median, round(q3, 4) AS q3,
  round(min("AveragePrice") FILTER ("AveragePrice" BETWEEN lo AND hi), 4) AS whisker_low,
  round(max("AveragePrice") FILTER ("AveragePrice" BETWEEN lo AND hi), 4) AS whisker_high,
  count(*) FILTER ("AveragePrice" < lo OR "AveragePrice" > hi) AS outliers
FROM market JOIN fences ON fences."type" = market."type"
GROUP BY market."type", n, q1, q2, q3""",
        """quarts AS (
  SELECT "type", count("AveragePrice") AS n, quantile_cont("AveragePrice", 0.25) AS q1,
         quantile_cont("AveragePrice", 0.5) AS q2, quantile_cont("AveragePrice", 0.75) AS q3
  FROM market GROUP BY "type"
),
fences AS (
  SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM quarts
)""",
    ),
    "q_letter_values": _with(
        "\nUNION ALL ".join(
            f'SELECT "year", count("AveragePrice") AS n, {p}::double AS prob, '
            f'round(quantile_cont("AveragePrice", {p}), 4) AS "value" FROM market GROUP BY "year"'
            for p in (0.5, 0.25, 0.75, 0.125, 0.875, 0.0625, 0.9375)
        )
    ),
    "q_histogram": _with(
        """SELECT b.bin, round(lo + b.bin * step, 4) AS low, round(lo + (b.bin + 1) * step, 4) AS high,
  coalesce(c.n, 0)::bigint AS "count", round(coalesce(c.n, 0) / (total * step), 10) AS density
FROM (SELECT unnest(range(bins))::int AS bin FROM plan) b CROSS JOIN plan
LEFT JOIN counts c ON c.bin = b.bin""",
        """stats AS (
  SELECT count(*) AS total, min("AveragePrice") AS lo, max("AveragePrice") AS hi,
         quantile_cont("AveragePrice", 0.75) - quantile_cont("AveragePrice", 0.25) AS iqr
  FROM market
),
sized AS (
  SELECT *, least(ceil((hi - lo) / (2 * iqr / pow(total, 1.0 / 3))), 50)::bigint AS bins FROM stats
),
plan AS (SELECT *, (hi - lo) / bins AS step FROM sized),
counts AS (
  SELECT least(floor(("AveragePrice" - lo) / step), bins - 1)::int AS bin, count(*) AS n
  FROM market, plan GROUP BY 1
)""",
    ),
    "q_kde": _with(
        """SELECT point, round(x, 4) AS x,
  round(sum(exp(-0.5 * pow(("AveragePrice" - x) / band, 2))) / (any_value(total) * any_value(band) * sqrt(2 * pi())), 12) AS density
FROM grid, market GROUP BY point, x""",
        """stats AS (
  SELECT count(*) AS total, min("AveragePrice") AS lo, max("AveragePrice") AS hi,
         stddev_samp("AveragePrice") * pow(count(*), -0.2) AS band
  FROM market
),
grid AS (
  SELECT i::int AS point, total, band,
         lo - 3 * band + i * ((hi + 3 * band) - (lo - 3 * band)) / 199 AS x
  FROM stats, (SELECT unnest(range(200)) AS i)
)""",
    ),
    "q_kde_binned": _with(
        """SELECT point, round(x, 4) AS x, round(sum(
  (c - rgt) * exp(-0.5 * pow((x - (lo + bin * width)) / band, 2)) + rgt * exp(-0.5 * pow((x - (lo + (bin + 1) * width)) / band, 2))
) / (any_value(total) * any_value(band) * sqrt(2 * pi())), 10) AS density
FROM grid, binned GROUP BY point, x""",
        """stats AS (
  SELECT count(*) AS total, min("AveragePrice") AS lo, max("AveragePrice") AS hi,
         stddev_samp("AveragePrice") * pow(count(*), -0.2) AS band,
         (max("AveragePrice") - min("AveragePrice")) / 4096 AS width
  FROM market
),
placed AS (SELECT ("AveragePrice" - lo) / width AS place FROM market, stats),
binned AS (
  SELECT least(floor(place), 4095) AS bin, count(*) AS c, sum(place - least(floor(place), 4095)) AS rgt
  FROM placed GROUP BY 1
),
grid AS (
  SELECT i::int AS point, total, band, lo, width,
         lo - 3 * band + i * ((hi + 3 * band) - (lo - 3 * band)) / 199 AS x
  FROM stats, (SELECT unnest(range(200)) AS i)
)""",
    ),
    "q_sketch_describe": _with(
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", probability, count("{c}") AS "count",
  round(min("{c}")::double, 6) AS "min", round(max("{c}")::double, 6) AS "max", true AS "within"
FROM market, (SELECT unnest([0.25, 0.5, 0.75])::double AS probability) GROUP BY probability"""
            for c in _DESCRIBED
        )
    ),
    "q_fit_stats": _with(
        """SELECT 'index' AS stage, level AS name, 'index' AS statistic, round(idx, 6) AS "value" FROM freq
UNION ALL SELECT 'min-max', 'month', 'min', lo::double FROM span
UNION ALL SELECT 'min-max', 'month', 'max', hi::double FROM span
UNION ALL """
        + "\nUNION ALL ".join(
            f"SELECT 'standard', '{name}', '{stat}', round({col}{i}, 6) FROM fit"
            for i, name in enumerate(["year", "month_scaled", *[f"LOG {c}" for c in LOGS]])
            for stat, col in (("mean", "m"), ("std", "s"))
        ),
        LINEAR.strip(),
    ),
    "q_string_index": _with(
        'SELECT row_key, "type", idx AS type_index FROM raw WHERE bucket < 70', LINEAR.strip()
    ),
    "q_minmax": _with(
        'SELECT row_key, m AS "month", round(x1, 8) AS month_scaled FROM raw WHERE bucket < 70',
        LINEAR.strip(),
    ),
    "q_standardize_samp": _with(
        f"SELECT row_key, {', '.join(_z(i, f'z{i}') for i in range(7))} FROM raw, fit WHERE bucket >= 70",
        LINEAR.strip(),
    ),
    "q_features": _with(
        f"SELECT row_key, {', '.join(_z(i, f'f{i}') for i in range(7))}, idx AS f7 "
        "FROM raw, fit WHERE bucket < 70",
        LINEAR.strip(),
    ),
    "q_standardize_pop": _with(
        "SELECT row_key, "
        + ", ".join(
            f"round(({_q(c)} - m{i}) / CASE WHEN s{i} > 0 THEN s{i} ELSE 1 END, 6) AS {_q(c)}"
            for i, c in enumerate(VOLUMES)
        )
        + " FROM market, pop",
        "pop AS (SELECT "
        + ", ".join(f"avg({_q(c)}) AS m{i}, stddev_pop({_q(c)}) AS s{i}" for i, c in enumerate(VOLUMES))
        + " FROM market WHERE bucket < 70)",
    ),
    "q_split": _with(
        "SELECT row_key, bucket, CASE WHEN bucket < 70 THEN 'train' ELSE 'test' END AS part FROM market"
    ),
    "q_folds": _with(
        'SELECT bucket % 10 AS fold, count(*) AS held_out, round(avg("AveragePrice"), 4) AS mean_label '
        "FROM market WHERE bucket < 70 GROUP BY 1"
    ),
    "q_param_grid": _with(
        """SELECT reg_param, elastic_net_param, fold, total - held_out AS trained_on, held_out
FROM (VALUES (0.05::double), (0.1), (0.2), (0.5)) r(reg_param),
     (VALUES (0.01::double), (0.5), (1.0)) e(elastic_net_param),
     (SELECT bucket % 10 AS fold, count(*) AS held_out FROM market WHERE bucket < 70 GROUP BY 1),
     (SELECT count(*) AS total FROM market WHERE bucket < 70)"""
    ),
    "q_elastic_net": _recursive(
        "SELECT fold, reg AS reg_param, mix AS elastic_net_param, round(b0, 2) AS intercept, "
        + ", ".join(f"round(beta[{i + 1}], 2) AS c{i}" for i in range(_SIZE - 2))
        + ", converged FROM fits"
    ),
    "q_cv_avg": _recursive(
        'SELECT reg AS "regParam", mix AS "elasticNetParam", round(avg_rmse, 4) AS avg_rmse FROM scores'
    ),
    "q_cv_pipeline": _recursive(
        'SELECT reg AS "regParam", mix AS "elasticNetParam", round(avg_rmse, 2) AS avg_rmse FROM scores'
    ),
    "q_linear_scored_in_sql": _fitted(
        "SELECT row_key, round(p, 3) AS prediction FROM predicted WHERE bucket >= 70"
    ),
    "q_client_metrics": _fitted(
        f"SELECT region AS client, {SCORES} FROM predicted JOIN market USING (row_key) GROUP BY region"
    ),
    "q_sparse_dummies": _with(
        """SELECT row_key, (n + m - 1)::int AS size, array_to_string(list_concat([0], list_concat(
  CASE WHEN r > 1 THEN [r - 1] ELSE [] END, CASE WHEN t > 1 THEN [n + t - 2] ELSE [] END)), ',') AS active
FROM (SELECT row_key, region, "type" FROM market) JOIN places USING (region) JOIN kinds USING ("type"),
  (SELECT count(*) AS n FROM places), (SELECT count(*) AS m FROM kinds)""",
        """places AS (SELECT region, row_number() OVER (ORDER BY region) AS r FROM (SELECT DISTINCT region FROM market))""",
        """kinds AS (SELECT "type", row_number() OVER (ORDER BY "type") AS t FROM (SELECT DISTINCT "type" FROM market))""",
    ),
    "q_sparse_users": """WITH users AS (
  SELECT u, row_number() OVER (ORDER BY u) - 1 AS r FROM (SELECT DISTINCT user_id::varchar AS u FROM events WHERE user_id IS NOT NULL)
), kinds AS (
  SELECT k, row_number() OVER (ORDER BY k) - 1 AS r FROM (SELECT DISTINCT event_type AS k FROM events WHERE event_type IS NOT NULL)
), widths AS (
  SELECT greatest((SELECT count(*) FROM users) - 1, 0) AS a, greatest((SELECT count(*) FROM kinds) - 1, 0) AS b
)
SELECT event_id, (a + b)::int AS size, array_to_string(list_concat(
  CASE WHEN users.r > 0 THEN [users.r - 1] ELSE [] END, CASE WHEN kinds.r > 0 THEN [a + kinds.r - 1] ELSE [] END), ',') AS active
FROM events LEFT JOIN users ON u = user_id::varchar LEFT JOIN kinds ON k = event_type, widths""",
    "q_region_effects": _with(
        'SELECT region, round(avg("AveragePrice"), 2) AS prediction FROM market WHERE bucket < 70 GROUP BY region'
    ),
    "q_best_params": _recursive(
        """SELECT 'regParam' AS param, reg::varchar AS "value" FROM best
UNION ALL SELECT 'elasticNetParam', mix::varchar FROM best
UNION ALL SELECT 'weightCol', NULL
"""
        + "\n".join(f"UNION ALL SELECT '{k}', '{v}'" for k, v in LINEAR_SETTINGS.items())
    ).replace("\nSELECT 'regParam'", ",\nbest AS (SELECT reg, mix FROM scores ORDER BY avg_rmse LIMIT 1)\nSELECT 'regParam'"),
    "q_stump": _with(
        _nodes(0, "one"), TREE_ROWS.strip(), "errors AS (SELECT row_key, base - y AS g FROM sample, base)",
        _stump("one", "errors", 0.0, 4).strip(),
    ),
    "q_boosted_stumps": _with(_nodes(0, "one") + "\nUNION ALL " + _nodes(1, "two"), *BOOSTED),
    "q_tree_scored_in_sql": _with(
        f"""SELECT row_key, round(any_value(base)
  + 0.3 * max({_LEAF.replace('cut', 'one.cut').replace('lower', 'one.lower').replace('upper', 'one.upper')}) FILTER (c.f = one.f)
  + 0.3 * max({_LEAF.replace('cut', 'two.cut').replace('lower', 'two.lower').replace('upper', 'two.upper')}) FILTER (c.f = two.f), 4) AS prediction
FROM (SELECT row_key, unnest(range({len(_TREE_COLUMNS)})) AS f,
             unnest([{', '.join(_TREE_VALUES[c] for c in _TREE_COLUMNS)}]) AS x
      FROM market WHERE bucket >= 70) c, one, two, base
GROUP BY row_key""",
        *BOOSTED,
    ),
    "q_ols": _with(
        """SELECT count(*) AS rows, round(regr_slope("AveragePrice", "Total Volume"), 4) AS slope,
  round(regr_intercept("AveragePrice", "Total Volume"), 4) AS intercept
FROM market WHERE bucket < 70"""
    ),
    "q_metrics": _with(
        f'SELECT model, "type", {SCORES} FROM predictions GROUP BY model, "type"', FIXED.strip()
    ),
    "q_leaderboard_fixed": _with(
        f"""SELECT model, rank() OVER (ORDER BY full_r2 DESC)::int AS rank, rows, mae, mse, rmse, r2
FROM (SELECT model, {SCORES}, 1 - avg((y - p) * (y - p)) / var_pop(y) AS full_r2
      FROM predictions GROUP BY model)""",
        FIXED.strip(),
    ),
    "q_best_run": _with(
        f"""SELECT 'price of ' || "type" AS experiment, model AS name, mae, mse, rmse, r2
FROM (SELECT model, "type", {SCORES} FROM predictions GROUP BY model, "type")
QUALIFY row_number() OVER (PARTITION BY "type" ORDER BY rmse, model) = 1""",
        FIXED.strip(),
    ),
    "q_telemetry": _with(
        "SELECT region AS client, count(*)::bigint AS rows FROM market GROUP BY region"
    ),
    "q_size_histogram": """SELECT up_to, n AS "count",
  (sum(n) OVER (ORDER BY up_to NULLS LAST ROWS UNBOUNDED PRECEDING))::bigint AS cumulative
FROM (SELECT CASE WHEN n_chars <= 0 THEN 0 WHEN n_chars <= 100 THEN 100 WHEN n_chars <= 1000 THEN 1000
             WHEN n_chars <= 5000 THEN 5000 WHEN n_chars <= 10000 THEN 10000 END::bigint AS up_to,
             count(*) AS n
      FROM documents GROUP BY 1)""",
    "q_requests_by_client": "SELECT user_id, count(*) AS requests FROM events GROUP BY user_id",
}
