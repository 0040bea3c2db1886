"""DuckDB SQL for the model queries that solve systems of equations: elimination and rounds as recursive tables."""

from __future__ import annotations

from statistics import NormalDist

from weeklens.config import TEST_WEEKS

W = "(PARTITION BY series_id ORDER BY week_start)"
Z95 = NormalDist().inv_cdf(0.975)


def eliminated(source: str, size: int, keys: str = "series_id") -> str:
    """Recursive body of Gauss-Jordan elimination over ``source`` (keys, m); ends at j = size. ``{self}`` is its name."""
    return f"""
        SELECT {keys}, 0 AS j, m FROM {source}
        UNION ALL
        SELECT {keys}, j + 1, list_transform(m, lambda line, i: CASE WHEN i = j + 1 THEN list_transform(line, lambda v: v / nullif(line[j + 1], 0))
               ELSE list_transform(line, lambda v, k: v - line[j + 1] * (m[j + 1][k] / nullif(m[j + 1][j + 1], 0))) END)
        FROM {{self}} WHERE j < {size}"""


# -- seasonal autoregression with moving-average terms -------------------------------------------

_LONG = (1, 2, 3, 4, 52, 53)
_TERMS = ("wa", "wb", "wc", "ea", "eb", "ec", "w")


def _form(left: dict[str, str], right: dict[str, str]) -> str:
    """Product of two weighted sums of terms, from the sums of their products."""
    parts = []
    for a, p in left.items():
        for b, q in right.items():
            i, j = sorted((a, b), key=_TERMS.index)
            parts.append(f"({p}) * ({q}) * {i}_{j}")
    return "(" + " + ".join(parts) + ")"


def _pair(target: dict, first: dict, second: dict) -> tuple[str, str]:
    aa, ab, bb, at, bt = _form(first, first), _form(first, second), _form(second, second), _form(first, target), _form(second, target)
    det = f"nullif({aa} * {bb} - {ab} * {ab}, 0)"
    return f"({at} * {bb} - {bt} * {ab}) / {det}", f"({bt} * {aa} - {at} * {ab}) / {det}"


_GRAM = [f"{a}_{b}" for i, a in enumerate(_TERMS) for b in _TERMS[i:]]
_NEAR = _pair({"w": "1", "wb": "-fp", "eb": "-ft"}, {"wa": "1", "wc": "-fp"}, {"ea": "1", "ec": "ft"})
_FAR = _pair({"w": "1", "wa": "-np", "ea": "-nt"}, {"wb": "1", "wc": "-np"}, {"eb": "1", "ec": "nt"})
_REST = {"w": "1", "wa": "-np", "wb": "-fp", "wc": "np * fp", "ea": "-nt", "eb": "-ft", "ec": "-nt * ft"}

_STEP = (
    "np * ws[-1] + fp * ws[-52] - np * fp * ws[-53] + nt * es[-1] + ft * es[-52] + nt * ft * es[-53]",
    "np * us[-1] + fp * us[-52] - np * fp * us[-53] + nt * xs[-1] + ft * xs[-52] + nt * ft * xs[-53]",
)
_ONE = "list_append(list_transform(range(52), lambda i: CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE))"

TABLES: dict[str, str] = {
    "sma_lagged": f"""
        SELECT series_id, week_start, y, w, {", ".join(f"lag(w, {k}) OVER {W} AS l{k}" for k in _LONG)}
        FROM changes WHERE split <> 'test'""",
    "sma_long": f"""
        SELECT series_id, [{", ".join("[" + ", ".join(f"sum(l{a} * {b})" for b in [*[f"l{k}" for k in _LONG], "w"]) + "]" for a in _LONG)}] AS m
        FROM sma_lagged WHERE l53 IS NOT NULL GROUP BY series_id""",
    "sma_solved": eliminated("sma_long", 6).format(self="sma_solved"),
    "sma_shocks": f"""
        SELECT series_id, week_start, y, w, w - {" - ".join(f"m[{i}][7] * l{k}" for i, k in enumerate(_LONG, 1))} AS e
        FROM sma_lagged JOIN sma_solved USING (series_id) WHERE j = 6""",
    "sma_terms": f"""
        SELECT series_id, week_start, w, lag(w, 1) OVER {W} AS wa, lag(w, 52) OVER {W} AS wb, lag(w, 53) OVER {W} AS wc,
               lag(e, 1) OVER {W} AS ea, lag(e, 52) OVER {W} AS eb, lag(e, 53) OVER {W} AS ec FROM sma_shocks""",
    "sma_gram": f"""
        SELECT series_id, count(*) AS n_used, {", ".join(f"sum({x.split('_')[0]} * {x.split('_')[1]}) AS {x}" for x in _GRAM)}
        FROM sma_terms WHERE ec IS NOT NULL GROUP BY series_id""",
    "sma_turns": f"""
        SELECT *, 0 AS turn, 0::DOUBLE AS np, 0::DOUBLE AS fp, 0::DOUBLE AS nt, 0::DOUBLE AS ft FROM sma_gram
        UNION ALL
        SELECT series_id, n_used, {", ".join(_GRAM)}, turn + 1, np, {_FAR[0]}, nt, {_FAR[1]}
        FROM (SELECT * REPLACE ({_NEAR[0]} AS np, {_NEAR[1]} AS nt) FROM sma_turns WHERE turn < 40)""",
    "sma_params": f"""
        SELECT *, n_used * (ln(2 * pi() * sigma2) + 1) + 10 AS aic, n_used * (ln(2 * pi() * sigma2) + 1) + 5 * ln(n_used) AS bic
        FROM (SELECT series_id, np, fp, nt, ft, n_used, greatest(0, {_form(_REST, _REST)}) / n_used AS sigma2 FROM sma_turns WHERE turn = 40)""",
    "sma_res": """
        SELECT series_id, week_start, w - (np * wa + fp * wb - np * fp * wc + nt * ea + ft * eb + nt * ft * ec) AS residual
        FROM sma_terms JOIN sma_params USING (series_id) WHERE ec IS NOT NULL""",
    "sma_state": """
        SELECT series_id, max(week_start) AS last_week, list(y ORDER BY week_start) AS ys, list(w ORDER BY week_start) AS ws,
               list(e ORDER BY week_start) AS es
        FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY week_start DESC) AS back FROM sma_shocks)
        WHERE back <= 53 GROUP BY ALL""",
    "sma_steps": f"""
        SELECT series_id, last_week, np, fp, nt, ft, sigma2, 0 AS h, ys, ws, es, {_ONE} AS ps, {_ONE} AS us, {_ONE} AS xs, 0::DOUBLE AS spread
        FROM sma_state JOIN sma_params USING (series_id)
        UNION ALL
        SELECT series_id, last_week, np, fp, nt, ft, sigma2, h + 1, list_append(ys, ys[-1] + ys[-52] - ys[-53] + nw), list_append(ws, nw),
               list_append(es, 0), list_append(ps, ps[-1] + ps[-52] - ps[-53] + nu), list_append(us, nu), list_append(xs, 0),
               spread + ps[-1] * ps[-1]
        FROM (SELECT *, {_STEP[0]} AS nw, {_STEP[1]} AS nu FROM sma_steps WHERE h < {TEST_WEEKS})""",
    "sma_fc": f"""
        SELECT series_id, 'sma' AS model_type, CAST(h AS INTEGER) AS horizon, CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE) AS forecast_date,
               greatest(0.0, ys[-1]) AS predicted_value, greatest(0.0, ys[-1] - {Z95!r} * sqrt(sigma2 * spread)) AS lower_bound,
               greatest(0.0, ys[-1] + {Z95!r} * sqrt(sigma2 * spread)) AS upper_bound
        FROM sma_steps WHERE h > 0""",
    "sma_centred": """
        SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY week_start) AS pos, count(*) OVER (PARTITION BY series_id) AS n,
               residual - avg(residual) OVER (PARTITION BY series_id) AS c FROM sma_res""",
    "sma_ljung": """
        SELECT series_id, any_value(n) * (any_value(n) + 2.0) * sum(s * s / (z * z) / (n - k)) AS lb_stat
        FROM (SELECT a.series_id, a.n, k, sum(a.c * b.c) AS s, max(v) AS z
              FROM sma_centred a CROSS JOIN generate_series(1, 10) g(k)
                   JOIN sma_centred b ON b.series_id = a.series_id AND b.pos = a.pos - k
                   JOIN (SELECT series_id, sum(c * c) AS v FROM sma_centred GROUP BY series_id) t ON t.series_id = a.series_id
              GROUP BY ALL) GROUP BY series_id""",
}

# -- unit-root test -------------------------------------------------------------------------------

_REMOVED = """
    list_transform(m, lambda line, i: CASE WHEN i > j + 1 THEN list_transform(line, lambda v, c: v - line[j + 1] / m[j + 1][j + 1] * m[j + 1][c])
                                           ELSE line END)"""
_PRODUCTS = "list_transform(v, lambda a: list_transform(v, lambda b: list_inner_product(a, b)))"
_LAGGED = "list_transform(range(1, {0} + 1), lambda i: d[{0} - i + 1:n - 1 - i])"
_ONES = "list_transform(range(n - 1 - {0}), lambda i: 1::DOUBLE)"

TABLES |= {
    "adf_base": """
        SELECT series_id, n, CAST(least(n // 2 - 2, ceil(12 * pow(n / 100, 0.25))) AS BIGINT) AS k, list(v - mean ORDER BY week_start) AS y
        FROM (SELECT series_id, week_start, CAST(total_sales AS DOUBLE) AS v, count(*) OVER s AS n, avg(total_sales) OVER s AS mean
              FROM dense WINDOW s AS (PARTITION BY series_id)) GROUP BY ALL""",
    "adf_changes": "SELECT *, list_transform(range(1, n), lambda i: y[i + 1] - y[i]) AS d FROM adf_base",
    "adf_orders": f"""
        SELECT series_id, n, k, y, d, {_PRODUCTS} AS m FROM (
            SELECT *, list_concat([{_ONES.format("k")}, y[k + 1:n - 1]], {_LAGGED.format("k")}, [d[k + 1:n - 1]]) AS v FROM adf_changes)""",
    "adf_left": f"""
        SELECT series_id, n, k, 0 AS j, m FROM adf_orders
        UNION ALL SELECT series_id, n, k, j + 1, {_REMOVED} FROM adf_left WHERE j < k + 2""",
    "adf_chosen": """
        SELECT series_id, arg_min(j - 2, o * (ln(2 * pi()) + ln(m[-1][-1] / o) + 1) + 2 * j) AS l
        FROM (SELECT *, n - 1 - k AS o FROM adf_left) WHERE j >= 2 GROUP BY series_id""",
    "adf_last": f"""
        SELECT series_id, n, l, {_PRODUCTS} AS m FROM (
            SELECT *, list_concat([{_ONES.format("l")}], {_LAGGED.format("l")}, [y[l + 1:n - 1], d[l + 1:n - 1]]) AS v
            FROM adf_changes JOIN adf_chosen USING (series_id))""",
    "adf_done": f"""
        SELECT series_id, n, l, 0 AS j, m FROM adf_last
        UNION ALL SELECT series_id, n, l, j + 1, {_REMOVED} FROM adf_done WHERE j < l + 1""",
    "adf_stat": """
        SELECT series_id, n - 1 - l AS o, l, b / a / sqrt((c - b * b / a) / (n - 1 - l - l - 2) / a) AS t
        FROM (SELECT *, m[l + 2][l + 2] AS a, m[l + 2][l + 3] AS b, m[l + 3][l + 3] AS c FROM adf_done WHERE j = l + 1)""",
    "adf_share": """
        SELECT *, CASE WHEN t > 2.74 THEN 1.0 WHEN t < -18.83 THEN 0.0 ELSE 0.5 + sign(z) * exp(-z * z / 2) / sqrt(2 * pi()) *
                  list_sum(list_transform(range(400), lambda i: exp((2 * i + 1) * ln(abs(z) + 1e-300) + ln(sqrt(pi())) - (i + 1) * ln(2) - lgamma(i + 1.5))))
                  END AS p
        FROM (SELECT *, CASE WHEN t <= -1.61 THEN 2.1659 + 1.4412 * t + 0.038269 * t * t
                             ELSE 1.7339 + 0.93202 * t - 0.12745 * t * t - 0.010368 * t * t * t END AS z FROM adf_stat)""",
}

# -- window learner: one row of sums for each split, a path of penalties, and its chosen weights --

_LAMBDAS = ("1e-6", "1e-5", "1e-4", "1e-3", "1e-2", "1e-1")

TABLES |= {
    "win_arrays": """
        SELECT series_id, max(week_start) AS last_week, list(scaled ORDER BY week_start) AS x, count(*) FILTER (split = 'train') AS t
        FROM scaled WHERE split <> 'test' GROUP BY series_id""",
    "win_spans": """
        SELECT * FROM (SELECT series_id, x, 'train' AS split, 52 AS a, t AS b FROM win_arrays
                       UNION ALL SELECT series_id, x, 'val', greatest(52, t), len(x) FROM win_arrays) WHERE b > a""",
    "win_products": f"""
        SELECT split, {_PRODUCTS} AS m FROM (
            SELECT split, list_concat([list_transform(range(b - a), lambda i: 1::DOUBLE)],
                                      list_transform(range(0, 53), lambda k: x[a - k + 1:b - k])) AS v FROM win_spans)""",
    "win_sums": """
        SELECT split, list(line ORDER BY i) AS m FROM (
            SELECT split, i, list(s ORDER BY c) AS line FROM (
                SELECT split, i, c, sum(m[i][c]) AS s FROM win_products, range(1, 55) r(i), range(1, 55) q(c) GROUP BY ALL) GROUP BY ALL)
        GROUP BY split""",
    "win_systems": f"""
        SELECT penalty, list_transform(range(1, 53), lambda i: list_transform(range(1, 54), lambda c:
               CASE WHEN c = 53 THEN m[i + 2][2] / m[1][1] - m[i + 2][1] / m[1][1] * (m[2][1] / m[1][1])
                    ELSE m[i + 2][c + 2] / m[1][1] - m[i + 2][1] / m[1][1] * (m[c + 2][1] / m[1][1]) + CASE WHEN i = c THEN penalty ELSE 0 END END)) AS m
        FROM win_sums, (SELECT CAST(unnest([{", ".join(_LAMBDAS)}]) AS DOUBLE) AS penalty) WHERE split = 'train'""",
    "win_solved": eliminated("win_systems", 52, "penalty").format(self="win_solved"),
    "win_models": """
        SELECT penalty, g.m[2][1] / g.m[1][1] - list_inner_product(s.back, list_transform(range(3, 55), lambda i: g.m[i][1] / g.m[1][1])) AS a,
               list_reverse(back) AS weights
        FROM (SELECT penalty, list_transform(m, lambda line: line[53]) AS back FROM win_solved WHERE j = 52) s JOIN win_sums g ON g.split = 'train'""",
    "win_missed": """
        SELECT split, penalty, x[pos + 1] - a - list_inner_product(x[pos - 51:pos], weights) AS r
        FROM (SELECT split, x, unnest(range(a, b)) AS pos FROM win_spans) JOIN win_models ON true""",
    "win_path": """
        SELECT penalty, train_loss, val_loss, a AS intercept, penalty = arg_min(penalty, val_loss) OVER () AS chosen, weights
        FROM (SELECT penalty, avg(r * r) FILTER (split = 'train') AS train_loss, avg(r * r) FILTER (split = 'val') AS val_loss
              FROM win_missed GROUP BY penalty) JOIN win_models USING (penalty)""",
    "win_ahead": f"""
        SELECT series_id, last_week, data_min, CASE WHEN data_max = data_min THEN 1 ELSE data_max - data_min END AS spread, a, weights, 0 AS h, x
        FROM win_arrays JOIN scaler USING (series_id) JOIN win_models ON penalty = 1e-4
        UNION ALL
        SELECT series_id, last_week, data_min, spread, a, weights, h + 1, list_append(x, a + list_inner_product(x[len(x) - 51:len(x)], weights))
        FROM win_ahead WHERE h < {TEST_WEEKS}""",
}

# -- additive model: one system for each state and span, sweeps over the changes of trend ---------

_KNOTS, _ORDER = 25, 10
_TREND, _FIXED = 2 + _KNOTS, 2 + _KNOTS + 2 * _ORDER
_T = "(week_start - first_week) / 7.0 / greatest(n - 1, 1)"
_DAY = "(week_start - DATE '1970-01-01') / 365.25"
_DESIGN = f"""
    list_concat([1::DOUBLE, {_T}], list_transform(range(1, {_KNOTS + 1}), lambda j: greatest(0, {_T} - 0.8::DOUBLE * j / {_KNOTS})),
                flatten(list_transform(range(1, {_ORDER + 1}), lambda k: [sin(2 * pi() * k * {_DAY}), cos(2 * pi() * k * {_DAY})])),
                list_transform(names, lambda h: CASE WHEN list_contains(coalesce(hs, []), h) THEN 1::DOUBLE ELSE 0 END))"""
_REST_OF = f"list_concat(x[1:2], x[{_TREND + 1}:])"
_SLOPE = "(leftover[e[1]::INT] - list_inner_product(g[e[1]::INT], acc) + g[e[1]::INT][e[1]::INT] * acc[e[1]::INT])"
Z90 = NormalDist().inv_cdf(0.9)


def parts(weeks: str) -> str:
    """Trend, yearly and holiday parts of weeks (series_id, week_start, ...), with their parameters."""
    return f"""
        SELECT *, list_inner_product(x[1:{_TREND}], coef[1:{_TREND}]) AS trend,
               list_inner_product(x[{_TREND + 1}:{_FIXED}], coef[{_TREND + 1}:{_FIXED}]) AS yearly,
               list_sum(list_transform(range({_FIXED + 1}, len(coef) + 1), lambda j: x[j] * coef[j])) AS holidays,
               greatest(0, x[2] - 1) AS ahead, list_sum(list_transform(coef[3:{_TREND}], lambda v: abs(v))) / {_KNOTS} AS size
        FROM (SELECT w.*, p.coef, p.sigma2, {_DESIGN} AS x FROM {weeks} w JOIN (SELECT series_id, state, coef, sigma2 FROM add_params) p ON p.series_id = w.series_id
              LEFT JOIN add_holidays h ON h.state = p.state AND h.week = w.week_start)"""


def ahead(source: str) -> str:
    half = f"{Z90!r} * sqrt(sigma2 + 2.0 * {_KNOTS} / 3.0 * size * size * pow(ahead, 3))"
    point = "trend + yearly + holidays"
    return f"""
        SELECT series_id, 'additive' AS model_type, CAST(horizon AS INTEGER) AS horizon, week_start AS forecast_date,
               round(greatest(0.0, {point}), 3) AS predicted_value, round(greatest(0.0, {point} - {half}), 3) AS lower_bound,
               round(greatest(0.0, {point} + {half}), 3) AS upper_bound FROM {source}"""


TABLES |= {
    "add_holidays": """
        SELECT state, CAST(date_trunc('week', ds) AS DATE) AS week, list_sort(list(DISTINCT holiday)) AS hs FROM holidays GROUP BY ALL""",
    "add_train": """
        SELECT series_id, split_part(series_id, '_', 1) AS state, week_start, CAST(total_sales AS DOUBLE) AS y,
               min(week_start) OVER s AS first_week, count(*) OVER s AS n
        FROM labelled WHERE split <> 'test' WINDOW s AS (PARTITION BY series_id)""",
    "add_weeks": """
        SELECT DISTINCT state, first_week, n, week_start, hs FROM add_train t
        LEFT JOIN add_holidays h USING (state) WHERE h.week = t.week_start
        UNION ALL
        SELECT DISTINCT state, first_week, n, week_start, [] FROM add_train t
        WHERE NOT EXISTS (SELECT 1 FROM add_holidays h WHERE h.state = t.state AND h.week = t.week_start)""",
    "add_names": "SELECT state, first_week, n, list_sort(list(DISTINCT name)) AS names FROM (SELECT state, first_week, n, unnest(hs) AS name FROM add_weeks) GROUP BY ALL",
    "add_design": f"""
        SELECT state, first_week, n, any_value(names) AS names, list(x ORDER BY week_start) AS rows
        FROM (SELECT *, {_DESIGN} AS x FROM add_weeks JOIN add_names USING (state, first_week, n)) GROUP BY ALL""",
    "add_columns": f"""
        SELECT *, list_transform(rows, lambda x: {_REST_OF}) AS rest,
               list_transform(range(1, len(rows[1]) + 1), lambda j: list_transform(rows, lambda x: x[j])) AS cols FROM add_design""",
    "add_split": f"""
        SELECT * EXCLUDE (cols), cols, cols[3:{_TREND}] AS few, list_concat(cols[1:2], cols[{_TREND + 1}:]) AS others,
               list_concat([0.04::DOUBLE, 0.04::DOUBLE], list_transform(range(len(cols) - {_TREND}), lambda i: 0.01::DOUBLE)) AS penalty FROM add_columns""",
    "add_systems": """
        SELECT state, first_week, n, list_transform(others, lambda a, i: list_concat(
                   list_transform(others, lambda b, k: list_inner_product(a, b) + CASE WHEN i = k THEN penalty[i] ELSE 0 END),
                   list_transform(others, lambda b, k: CASE WHEN i = k THEN 1::DOUBLE ELSE 0 END))) AS m FROM add_split""",
    "add_solved": eliminated("add_systems", "len(m)", "state, first_week, n").format(self="add_solved"),
    "add_inverse": "SELECT state, first_week, n, list_transform(m, lambda line: line[len(m) + 1:]) AS inverse FROM add_solved WHERE j = len(m)",
    "add_weights": """
        SELECT *, list_transform(few, lambda f: list_transform(inverse, lambda line: list_inner_product(line, list_transform(others, lambda o: list_inner_product(f, o))))) AS weights
        FROM add_split JOIN add_inverse USING (state, first_week, n)""",
    "add_spans": """
        SELECT *, list_transform(few, lambda a, i: list_transform(few, lambda b: list_inner_product(a, b)
                  - list_inner_product(weights[i], list_transform(others, lambda o: list_inner_product(o, b))))) AS g FROM add_weights""",
    "add_series": """
        SELECT series_id, state, first_week, n, list(y ORDER BY week_start) AS y FROM add_train GROUP BY ALL""",
    "add_plain": """
        SELECT *, list_transform(inverse, lambda line: list_inner_product(line, list_transform(others, lambda o: list_inner_product(o, y)))) AS plain
        FROM add_series JOIN add_spans USING (state, first_week, n)""",
    "add_costs": """
        SELECT *, list_avg(list_transform(rest, lambda x, i: pow(y[i] - list_inner_product(x, plain), 2))) / (0.05 * list_max(list_transform(y, lambda v: abs(v)))) AS cost,
               list_transform(few, lambda f, i: list_inner_product(f, y) - list_inner_product(weights[i], list_transform(others, lambda o: list_inner_product(o, y)))) AS leftover
        FROM add_plain""",
    "add_sweeps": f"""
        SELECT series_id, g, leftover, cost, 0 AS k, list_transform(range({_KNOTS}), lambda i: 0::DOUBLE) AS c FROM add_costs
        UNION ALL
        SELECT series_id, g, leftover, cost, k + 1, list_reduce(list_prepend(c, list_transform(range(1, {_KNOTS + 1}), lambda i: [i::DOUBLE])),
               lambda acc, e: list_transform(acc, lambda v, i: CASE WHEN i = e[1]::INT
                   THEN sign({_SLOPE}) * greatest(0, abs({_SLOPE}) - cost) / g[i][i] ELSE v END))
        FROM add_sweeps WHERE k < 200""",
    "add_params": """
        SELECT series_id, state, first_week, n, names, coef, list_avg(list_transform(rows, lambda x, i: pow(y[i] - list_inner_product(x, coef), 2))) AS sigma2
        FROM (SELECT *, list_concat(given[1:2], c, given[3:]) AS coef
              FROM (SELECT a.*, s.c, list_transform(plain, lambda v, i: v - list_inner_product(s.c, list_transform(weights, lambda w: w[i]))) AS given
                    FROM add_costs a JOIN add_sweeps s ON s.series_id = a.series_id AND s.k = 200))""",
    "add_next": f"""
        SELECT series_id, state, first_week, n, names, h AS horizon, CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE) AS week_start
        FROM (SELECT series_id, max(week_start) AS last_week FROM add_train GROUP BY series_id) JOIN add_params USING (series_id), range(1, {TEST_WEEKS} + 1) r(h)""",
    "add_all": "SELECT p.series_id, p.first_week, p.n, p.names, 0 AS horizon, l.week_start, l.split FROM labelled l JOIN add_params p ON p.series_id = l.series_id",
    "add_next_parts": parts("add_next"),
    "add_all_parts": parts("add_all"),
    "add_bent": f"""
        SELECT * REPLACE (list_transform(coef, lambda v, i: CASE WHEN i BETWEEN 3 AND {_TREND} THEN (CASE WHEN i % 2 = 0 THEN -8.0 ELSE 10.0 END) * i ELSE v END) AS coef)
        FROM add_params""",
    "add_bent_parts": parts("add_next").replace("FROM add_params)", "FROM add_bent)"),
}

# -- STL without robustness weights: local lines are fixed weights, a pass is a product with them ---

_FIT = "list_transform({fits}, lambda f: list_inner_product(f.h, {values}[f.l + 1:f.l + len(f.h)]))"
_MEAN = "list_transform(range(1, len({0}) - {1} + 2), lambda i: list_sum({0}[i:i + {1} - 1]) / {1})"

TABLES |= {
    "stl_series": """
        SELECT series_id, count(*) AS n, list(CAST(total_sales AS DOUBLE) ORDER BY week_start) AS y, list(week_start ORDER BY week_start) AS weeks
        FROM dense GROUP BY series_id""",
    "stl_sizes": "SELECT DISTINCT n FROM stl_series",
    "stl_places": """
        SELECT n, 'low' AS kind, n AS size, 53 AS reach, unnest(range(0, n)) AS pos FROM stl_sizes
        UNION ALL SELECT n, 'trend', n, 101, unnest(range(0, n)) FROM stl_sizes
        UNION ALL SELECT n, 'long', n // 52 + 1, 7, unnest(range(-1, n // 52 + 2)) FROM stl_sizes
        UNION ALL SELECT n, 'short', n // 52, 7, unnest(range(-1, n // 52 + 1)) FROM stl_sizes""",
    "stl_near": """
        SELECT n, kind, size, pos, l, list_transform(range(least(reach, size)), lambda j: CAST(l + j - pos AS DOUBLE)) AS o, reach
        FROM (SELECT *, greatest(0, least(pos - least(reach, size) // 2, size - least(reach, size))) AS l FROM stl_places)""",
    "stl_tricube": """
        SELECT *, list_transform(o, lambda v: CASE WHEN abs(v) / far <= 0.001 THEN 1 WHEN abs(v) / far <= 0.999 THEN pow(1 - pow(abs(v) / far, 3), 3) ELSE 0 END) AS raw
        FROM (SELECT *, greatest(1e-12, list_max(list_transform(o, lambda v: abs(v))) + CASE WHEN reach > size THEN (reach - size) // 2 ELSE 0 END) AS far FROM stl_near)""",
    "stl_shares": """
        SELECT *, list_inner_product(w, o) AS mx FROM (SELECT *, list_transform(raw, lambda v: v / list_sum(raw)) AS w FROM stl_tricube)""",
    "stl_fits": """
        SELECT n, kind, pos, l, list_transform(w, lambda v, i: v * (1 - CASE WHEN sqrt(spread) > 0.001 * (size - 1) THEN mx * (o[i] - mx) / spread ELSE 0 END)) AS h
        FROM (SELECT *, list_inner_product(w, list_transform(o, lambda v: (v - mx) * (v - mx))) AS spread FROM stl_shares)""",
    "stl_hats": """
        SELECT n, list({'l': l, 'h': h} ORDER BY pos) FILTER (kind = 'low') AS low, list({'l': l, 'h': h} ORDER BY pos) FILTER (kind = 'trend') AS slow,
               list({'l': l, 'h': h} ORDER BY pos) FILTER (kind = 'long') AS longer, list({'l': l, 'h': h} ORDER BY pos) FILTER (kind = 'short') AS shorter
        FROM stl_fits GROUP BY n""",
    "stl_rounds": f"""
        SELECT series_id, n, y, 0 AS k, list_transform(y, lambda v: 0::DOUBLE) AS trend, list_transform(y, lambda v: 0::DOUBLE) AS seasonal FROM stl_series
        UNION ALL
        SELECT series_id, n, y, k + 1, {_FIT.format(fits="slow", values="rest")}, seasonal
        FROM (SELECT *, list_transform(y, lambda v, i: v - seasonal[i]) AS rest
              FROM (SELECT series_id, n, y, k, slow, list_transform({_FIT.format(fits="low", values="third")}, lambda v, i: cycle[i + 52] - v) AS seasonal
                    FROM (SELECT *, {_MEAN.format("second", 3)} AS third
                          FROM (SELECT *, {_MEAN.format("once", 52)} AS second
                                FROM (SELECT *, {_MEAN.format("cycle", 52)} AS once
                                      FROM (SELECT *, list_transform(range(n + 104), lambda q: CASE WHEN (n - q % 52 + 51) // 52 > n // 52
                                                THEN list_inner_product(longer[q // 52 + 1].h, list_transform(range(len(longer[q // 52 + 1].h)), lambda j: left_over[q % 52 + 52 * (longer[q // 52 + 1].l + j) + 1]))
                                                ELSE list_inner_product(shorter[q // 52 + 1].h, list_transform(range(len(shorter[q // 52 + 1].h)), lambda j: left_over[q % 52 + 52 * (shorter[q // 52 + 1].l + j) + 1])) END) AS cycle
                                            FROM (SELECT r.*, h.low, h.slow, h.longer, h.shorter, list_transform(r.y, lambda v, i: v - r.trend[i]) AS left_over
                                                  FROM stl_rounds r JOIN stl_hats h ON h.n = r.n WHERE r.k < 5)))))))""",
    "stl_parts": """
        SELECT series_id, weeks[i] AS week_start, r.y[i] AS observed, trend[i] AS trend, seasonal[i] AS seasonal, r.y[i] - trend[i] - seasonal[i] AS residual
        FROM stl_rounds r JOIN stl_series s USING (series_id), unnest(range(1, r.n + 1)) AS u(i) WHERE k = 5""",
}

# -- the same with robustness weights: a local line from five sums, whose weights change after every second pass ---


def _local_sums(f: str, r: str, ry: str, y: str, size: str) -> str:
    """Sums of a place ``f`` over weights ``r`` and weighted values ``ry``, and the value next to it."""
    part = lambda v: f"{v}[{f}.l + 1:{f}.l + len({f}.a)]"
    dots = {"s": (f"{f}.a", r), "u": (f"{f}.b", r), "v": (f"{f}.c", r), "p": (f"{f}.a", ry), "q": (f"{f}.b", ry)}
    sums = ", ".join(f"'{k}': list_inner_product({a}, {part(b)})" for k, (a, b) in dots.items())
    return f"{{{sums}, 'n': {y}[greatest(0, least({size} - 1, {f}.pos)) + 1], 'size': {size}}}"


_LINE = """CASE WHEN m.s > 0 THEN m.p / m.s - CASE WHEN sqrt(greatest(0, m.v / m.s - m.u / m.s * (m.u / m.s))) > 0.001 * (m.size - 1)
    THEN (m.q / m.s - m.u / m.s * (m.p / m.s)) / (m.v / m.s - m.u / m.s * (m.u / m.s)) * (m.u / m.s) ELSE 0 END ELSE m.n END"""
_CYCLE = f"""list_transform(list_transform(range(n + 104), lambda q: CASE WHEN len(subs[q % 52 + 1].y) > n // 52
    THEN {_local_sums("longer[q // 52 + 1]", "subs[q % 52 + 1].r", "subs[q % 52 + 1].ry", "subs[q % 52 + 1].y", "len(subs[q % 52 + 1].y)")}
    ELSE {_local_sums("shorter[q // 52 + 1]", "subs[q % 52 + 1].r", "subs[q % 52 + 1].ry", "subs[q % 52 + 1].y", "len(subs[q % 52 + 1].y)")} END), lambda m: {_LINE})"""
_SLOW = f"""list_transform(list_transform(slow, lambda f: {_local_sums("f", "r", "list_transform(rest, lambda v, i: v * r[i])", "rest", "n")}), lambda m: {_LINE})"""
_SUBS = """list_transform(range(least(52, n)), lambda p: {'y': list_transform(range((n - p + 51) // 52), lambda j: gone[p + 52 * j + 1]),
    'r': list_transform(range((n - p + 51) // 52), lambda j: r[p + 52 * j + 1]),
    'ry': list_transform(range((n - p + 51) // 52), lambda j: r[p + 52 * j + 1] * gone[p + 52 * j + 1])})"""

TABLES |= {
    "rob_places": """
        SELECT n, list(f ORDER BY pos) FILTER (kind = 'trend') AS slow, list(f ORDER BY pos) FILTER (kind = 'long') AS longer,
               list(f ORDER BY pos) FILTER (kind = 'short') AS shorter
        FROM (SELECT n, kind, pos, {'l': l, 'pos': pos, 'a': raw, 'b': list_transform(raw, lambda v, i: v * o[i]),
                                    'c': list_transform(raw, lambda v, i: v * o[i] * o[i])} AS f FROM stl_tricube)
        GROUP BY n""",
    "rob_rounds": f"""
        SELECT series_id, n, y, 0 AS k, list_transform(y, lambda v: 0::DOUBLE) AS trend, list_transform(y, lambda v: 0::DOUBLE) AS seasonal,
               list_transform(y, lambda v: 1::DOUBLE) AS r FROM stl_series
        UNION ALL
        SELECT series_id, n, y, k + 1, trend, seasonal,
               CASE WHEN k % 2 = 0 OR k = 31 OR border <= 0 THEN CASE WHEN k % 2 = 0 OR k = 31 THEN r ELSE list_transform(r, lambda v: 1::DOUBLE) END
                    ELSE list_transform(missed, lambda v: CASE WHEN v / border <= 0.001 THEN 1 WHEN v / border <= 0.999 THEN pow(1 - pow(v / border, 2), 2) ELSE 0 END) END
        FROM (SELECT *, 6 * list_median(missed) AS border
              FROM (SELECT *, list_transform(y, lambda v, i: abs(v - trend[i] - seasonal[i])) AS missed
                    FROM (SELECT series_id, n, y, k, r, seasonal, {_SLOW} AS trend
                          FROM (SELECT *, list_transform(y, lambda v, i: v - seasonal[i]) AS rest
                                FROM (SELECT series_id, n, y, k, r, slow, list_transform({_FIT.format(fits="low", values="third")}, lambda v, i: cycle[i + 52] - v) AS seasonal
                                      FROM (SELECT *, {_MEAN.format("second", 3)} AS third
                                            FROM (SELECT *, {_MEAN.format("once", 52)} AS second
                                                  FROM (SELECT *, {_MEAN.format("cycle", 52)} AS once
                                                        FROM (SELECT *, {_CYCLE} AS cycle
                                                              FROM (SELECT *, {_SUBS} AS subs
                                                                    FROM (SELECT x.series_id, x.n, x.y, x.k, x.r, h.low, p.slow, p.longer, p.shorter,
                                                                                 list_transform(x.y, lambda v, i: v - x.trend[i]) AS gone
                                                                          FROM rob_rounds x JOIN stl_hats h ON h.n = x.n JOIN rob_places p ON p.n = x.n WHERE x.k < 32)))))))))))""",
    "rob_parts": """
        SELECT series_id, weeks[i] AS week_start, x.y[i] AS observed, trend[i] AS trend, seasonal[i] AS seasonal, x.y[i] - trend[i] - seasonal[i] AS residual
        FROM rob_rounds x JOIN stl_series s USING (series_id), unnest(range(1, x.n + 1)) AS u(i) WHERE k = 32""",
}

_FORECAST = "series_id, model_type, horizon, forecast_date, predicted_value, lower_bound, upper_bound"

TABLES |= {
    "model_fc": f"""
        SELECT {_FORECAST} FROM sar_fc WHERE scope = 'known'
        UNION ALL {ahead("add_next_parts")}
        UNION ALL
        SELECT series_id, 'window', CAST(h AS INTEGER), CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE), v, v * (1 - 0.12::DOUBLE), v * (1 + 0.12::DOUBLE)
        FROM (SELECT *, greatest(0.0, x[-1] * spread + data_min) AS v FROM win_ahead WHERE h > 0)""",
    "model_fc_rounded": """
        SELECT series_id, model_type, horizon, forecast_date, round(predicted_value, 3) AS predicted_value,
               round(lower_bound, 3) AS lower_bound, round(upper_bound, 3) AS upper_bound FROM model_fc""",
}

#: Query name: statement and the columns that are doubles.
STATEMENTS: dict[str, tuple[str, str]] = {
    "sma_fit": (
        """SELECT series_id, np AS phi1, fp AS phi_s, nt AS theta1, ft AS theta_s, sigma2, n_used, aic, bic,
                  CAST(NULL AS VARCHAR) AS error FROM sma_params""", "phi1 phi_s theta1 theta_s sigma2 aic bic"),
    "sma_residuals": ("SELECT * FROM sma_res", "residual"),
    "sma_forecast": (
        "SELECT series_id, model_type, horizon, forecast_date, predicted_value, lower_bound, upper_bound FROM sma_fc",
        "predicted_value lower_bound upper_bound"),
    "sma_evaluation": (
        """SELECT series_id, 'sma' AS model, mae / nullif(naive_mae, 0) AS "MASE", rmse AS "RMSE", mae AS "MAE", me AS "ME"
           FROM (SELECT f.series_id, avg(abs(predicted_value - total_sales)) AS mae,
                        sqrt(avg((predicted_value - total_sales) * (predicted_value - total_sales))) AS rmse,
                        avg(predicted_value - total_sales) AS me
                 FROM sma_fc f JOIN test t ON t.series_id = f.series_id AND t.week_start = f.forecast_date
                 GROUP BY f.series_id) JOIN naive USING (series_id)""", "MASE RMSE MAE ME"),
    "sma_diagnostics": (
        """SELECT series_id, lb_stat, lb_pvalue, lb_pvalue > 0.05 AS passed, aic, bic FROM (
               SELECT *, exp(-lb_stat / 2) * (1 + lb_stat / 2 + pow(lb_stat / 2, 2) / 2 + pow(lb_stat / 2, 3) / 6
                                              + pow(lb_stat / 2, 4) / 24) AS lb_pvalue FROM sma_ljung)
           JOIN sma_params USING (series_id)""", "lb_stat lb_pvalue aic bic"),
    "window_path": ("SELECT penalty, train_loss, val_loss, intercept, chosen FROM win_path", "penalty train_loss val_loss intercept"),
    "window_weights": (
        """SELECT CAST(53 - k AS INTEGER) AS weeks_back, weights[k] AS weight FROM win_path, range(1, 53) r(k) WHERE chosen""", "weight"),
    "window_losses": (
        "SELECT split, avg(r * r) AS loss, count(*) AS n_windows FROM win_missed WHERE penalty = 1e-4 GROUP BY split", "loss"),
    "window_forecast": (
        """SELECT series_id, 'window' AS model_type, CAST(h AS INTEGER) AS horizon, CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE) AS forecast_date,
                  greatest(0.0, x[-1] * spread + data_min) AS predicted_value, CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
           FROM win_ahead WHERE h > 0""", "predicted_value"),
    "additive_fit": (
        """SELECT series_id, n, CAST(pos AS INTEGER) AS term, round(coef[pos], 3) AS coef, round(sigma2, 3) AS sigma2
           FROM (SELECT *, unnest(range(1, len(coef) + 1)) AS pos FROM add_params)""", "coef sigma2"),
    "additive_forecast": (ahead("add_next_parts"), "predicted_value lower_bound upper_bound"),
    "additive_bounds": (ahead("add_bent_parts"), "predicted_value lower_bound upper_bound"),
    "additive_in_sample": (ahead("add_all_parts") + " WHERE split <> 'test'", "predicted_value lower_bound upper_bound"),
    "additive_components": (
        """SELECT series_id, week_start, round(trend, 3) AS trend, round(yearly, 3) AS yearly, round(holidays, 3) AS holidays,
                  round(trend + yearly + holidays, 3) AS fitted FROM add_all_parts""", "trend yearly holidays fitted"),
    "stored_models": ("SELECT * FROM model_fc_rounded", "predicted_value lower_bound upper_bound"),
    "weekly_scoring": (
        "SELECT *, 'v1' AS model_version, DATE '2001-08-06' AS generated_at FROM model_fc_rounded", "predicted_value lower_bound upper_bound"),
    "decompose_stl": (
        """SELECT series_id, week_start, observed, round(trend, 3) AS trend, round(seasonal, 3) AS seasonal, round(residual, 3) AS residual,
                  CAST(NULL AS VARCHAR) AS error FROM rob_parts""", "observed trend seasonal residual"),
    "decompose_stl_plain": (
        "SELECT *, CAST(NULL AS VARCHAR) AS error FROM stl_parts", "observed trend seasonal residual"),
    "adf_test": (
        """SELECT series_id, t AS test_stat, p AS p_value, CAST(l AS INTEGER) AS lags_used, CAST(o AS INTEGER) AS n_used,
                  CASE WHEN p < 0.05 THEN 'STATIONARY' ELSE 'NON-STATIONARY' END AS status,
                  -3.43035 - 6.5393 / o - 16.786 / (o * o) - 79.433 / (o * o * o) AS critical_1,
                  -2.86154 - 2.8903 / o - 4.234 / (o * o) - 40.040 / (o * o * o) AS critical_5,
                  -2.56677 - 1.5384 / o - 2.809 / (o * o) AS critical_10, CAST(NULL AS VARCHAR) AS error FROM adf_share""",
        "test_stat p_value critical_1 critical_5 critical_10"),
}
