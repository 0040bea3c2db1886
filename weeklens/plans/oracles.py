"""DuckDB SQL for the registered queries, over the same star tables.

Each statement names the common tables it needs (``weekly``, ``dense``, ...); their definitions are
prefixed as CTEs. Doubles are rounded like the Spark results.
"""

from __future__ import annotations

import math
import re
from statistics import NormalDist

from weeklens.config import PSI_BINS, SEASON, TEST_WEEKS
from weeklens.plans import model_oracles
from weeklens.plans.catalog import DIGITS, ONE_SERIES, SERIES_LIST
from weeklens.sources.star import BENEFIT_DAYS, REGION_STATES

SNAPS = list(REGION_STATES.values())
FLAGS = [*SNAPS, "is_holiday", "is_thanksgiving", "is_black_friday"]
Z95 = NormalDist().inv_cdf(0.975)
CRITICAL_RATIO = 8.0 / (8.0 + 2.0)
Z_COST = NormalDist().inv_cdf(CRITICAL_RATIO)


def _list(columns: list[str], pattern: str = "{}") -> str:
    return ", ".join(pattern.format(c) for c in columns)


def _snap_case() -> str:
    whens = " ".join(f"WHEN '{state}' THEN {column}" for state, column in REGION_STATES.items())
    return f"CAST(CASE split_part(series_id, '_', 1) {whens} ELSE 0 END AS TINYINT)"


W = "(PARTITION BY series_id ORDER BY week_start)"

# Definition order is dependency order.
TABLES: dict[str, str] = {
    "fact": """
        SELECT r_name AS state_id, r_name || '_1' AS store_id, c_mktsegment AS cat_id,
               c_mktsegment || '_' || n_name AS item_id, CAST(l_shipdate AS DATE) AS date,
               CAST(l_quantity AS INTEGER) AS sales
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "span": "SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem",
    "days": "SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span",
    "raw_cal": f"""
        SELECT 'd_' || CAST(date - lo + 1 AS VARCHAR) AS d, date,
               CASE WHEN month(date) = 11 AND isodow(date) = 4 AND day(date) BETWEEN 22 AND 28 THEN 'Thanksgiving'
                    WHEN month(date) = 11 AND isodow(date) = 5 AND day(date) BETWEEN 23 AND 29 THEN 'BlackFriday'
                    WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas'
                    WHEN month(date) = 7 AND day(date) = 4 THEN 'IndependenceDay' END AS event_name_1,
               {", ".join(f"CAST(day(date) BETWEEN {a} AND {b} AS TINYINT) AS {c}" for c, (a, b) in BENEFIT_DAYS.items())}
        FROM days""",
    "cal": f"""
        SELECT d, date, event_name_1,
               CASE WHEN event_name_1 = 'BlackFriday' THEN 'Commercial'
                    WHEN event_name_1 IS NOT NULL THEN 'National' END AS event_type_1,
               {_list(SNAPS)},
               CAST(event_name_1 IS NOT NULL AS TINYINT) AS is_holiday,
               CAST(coalesce(lower(event_name_1) LIKE '%thanksgiving%', false) AS TINYINT) AS is_thanksgiving,
               CAST(coalesce(lower(event_name_1) LIKE '%blackfriday%', false) AS TINYINT) AS is_black_friday,
               strftime(date, '%G-W%V') AS week_id, CAST(date_trunc('week', date) AS DATE) AS week_start
        FROM raw_cal""",
    "weekly": f"""
        SELECT store_id || '__' || cat_id AS series_id, store_id, cat_id, week_id, week_start,
               CAST(sum(sales) AS BIGINT) AS total_sales, {_list(FLAGS, "max({0}) AS {0}")}
        FROM fact JOIN cal USING (date) GROUP BY store_id, cat_id, week_id, week_start""",
    "week_flags": f"SELECT week_start, week_id, {_list(FLAGS, 'max({0}) AS {0}')} FROM cal GROUP BY ALL",
    "dense": f"""
        SELECT s.series_id, s.store_id, s.cat_id, f.week_id, f.week_start,
               coalesce(w.total_sales, 0) AS total_sales, {_list(FLAGS, "f.{0}")}
        FROM (SELECT DISTINCT series_id, store_id, cat_id FROM weekly) s CROSS JOIN week_flags f
             LEFT JOIN weekly w ON w.series_id = s.series_id AND w.week_start = f.week_start""",
    "numbered": f"""
        SELECT *, row_number() OVER {W} AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM dense""",
    "labelled": f"""
        SELECT series_id, week_start, total_sales, pos, n,
               CASE WHEN pos > n - {TEST_WEEKS} THEN 'test'
                    WHEN pos > n - {TEST_WEEKS} - greatest(1, floor(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE))) THEN 'val'
                    ELSE 'train' END AS split, n <= {TEST_WEEKS} AS too_short
        FROM numbered""",
    "train": "SELECT * FROM labelled WHERE split = 'train'",
    "known": "SELECT * FROM labelled WHERE split <> 'test'",
    "test": "SELECT * FROM labelled WHERE split = 'test'",
    "scaler": """
        SELECT series_id, CAST(min(total_sales) AS DOUBLE) AS data_min, CAST(max(total_sales) AS DOUBLE) AS data_max
        FROM train GROUP BY series_id""",
    "scaled": """
        SELECT series_id, week_start, split, total_sales, data_min, data_max,
               (total_sales - data_min) / coalesce(nullif(data_max - data_min, 0), 1) AS scaled
        FROM labelled JOIN scaler USING (series_id)""",
    "naive": f"""
        SELECT series_id, CASE WHEN count(*) > {SEASON} THEN avg(d52) ELSE avg(d1) END AS naive_mae
        FROM (SELECT series_id, CAST(abs(total_sales - lag(total_sales, {SEASON}) OVER {W}) AS DOUBLE) AS d52,
                     CAST(abs(total_sales - lag(total_sales, 1) OVER {W}) AS DOUBLE) AS d1 FROM train)
        GROUP BY series_id""",
    "known_rank": """
        SELECT series_id, week_start, CAST(total_sales AS DOUBLE) AS y,
               row_number() OVER (PARTITION BY series_id ORDER BY week_start DESC) AS back FROM known""",
    "origin": "SELECT series_id, max(week_start) AS last_week FROM known GROUP BY series_id",
    "baselines": f"""
        SELECT series_id, 'seasonal_naive' AS model_type, CAST(h AS INTEGER) AS horizon,
               CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE) AS forecast_date, greatest(0.0, y) AS predicted_value,
               CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
        FROM origin CROSS JOIN generate_series(1, {TEST_WEEKS}) g(h)
             JOIN known_rank USING (series_id) WHERE back = {SEASON} - (h - 1)
        UNION ALL
        SELECT o.series_id, 'drift', CAST(h AS INTEGER), CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE),
               greatest(0.0, a.y + h * ((a.y - b.y) / 8.0)), NULL, NULL
        FROM origin o CROSS JOIN generate_series(1, {TEST_WEEKS}) g(h)
             JOIN known_rank a ON a.series_id = o.series_id AND a.back = 1
             JOIN known_rank b ON b.series_id = o.series_id AND b.back = 8""",
    "pairs": """
        SELECT b.*, CAST(t.total_sales AS DOUBLE) AS actual FROM baselines b
        JOIN test t ON t.series_id = b.series_id AND t.week_start = b.forecast_date""",
    "results": """
        SELECT series_id, model_type AS model, mae / nullif(naive_mae, 0) AS "MASE", rmse AS "RMSE", mae AS "MAE", me AS "ME"
        FROM (SELECT series_id, model_type, avg(abs(predicted_value - actual)) AS mae,
                     sqrt(avg((predicted_value - actual) * (predicted_value - actual))) AS rmse,
                     avg(predicted_value - actual) AS me FROM pairs GROUP BY ALL) LEFT JOIN naive USING (series_id)""",
    "store": """
        SELECT series_id, forecast_date, horizon, predicted_value, CAST(NULL AS DOUBLE) AS lower_bound,
               CAST(NULL AS DOUBLE) AS upper_bound, model_type, 'v1' AS model_version, DATE '2001-08-06' AS generated_at
        FROM baselines
        UNION ALL
        SELECT series_id, forecast_date, horizon, predicted_value, predicted_value * CAST(0.88 AS DOUBLE),
               predicted_value * CAST(1.12 AS DOUBLE), model_type, 'v2', DATE '2001-08-13' FROM baselines""",
    "latest": "SELECT * FROM store WHERE model_version = 'v2'",
    "yearly": f"""
        SELECT series_id, 'seasonal_naive' AS model_type, week_start AS forecast_date,
               CAST(total_sales AS DOUBLE) AS actual,
               CAST(lag(total_sales, {SEASON}) OVER {W} AS DOUBLE) AS predicted_value FROM dense""",
    "scored": """
        SELECT y.series_id, model_type, forecast_date, predicted_value - actual AS error, actual, predicted_value,
               abs(predicted_value - actual) / CASE WHEN naive_mae > 0 THEN naive_mae ELSE 1 END AS mase,
               avg(predicted_value) OVER (PARTITION BY y.series_id) AS mean_demand,
               row_number() OVER (PARTITION BY y.series_id ORDER BY forecast_date DESC) AS rank
        FROM yearly y LEFT JOIN naive USING (series_id) WHERE predicted_value IS NOT NULL""",
    "history": "SELECT * FROM scored WHERE rank <= 12",
    "bounds": f"""
        SELECT series_id, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
        FROM (SELECT series_id, CAST(min(total_sales) AS DOUBLE) AS lo, CAST(max(total_sales) AS DOUBLE) AS hi
              FROM train GROUP BY series_id)""",
    "binned": f"""
        SELECT series_id, is_ref, {" + ".join(
            f"CAST(v >= lo + CAST({i} AS DOUBLE) * ((hi - lo) / CAST({PSI_BINS} AS DOUBLE)) AS INTEGER)" for i in range(1, PSI_BINS)
        )} AS bin
        FROM (SELECT series_id, CAST(total_sales AS DOUBLE) AS v, true AS is_ref FROM train
              UNION ALL SELECT series_id, CAST(total_sales AS DOUBLE), false FROM test) JOIN bounds USING (series_id)""",
    "bins": f"""
        SELECT series_id, b AS bin, count(*) FILTER (is_ref AND bin = b) AS r, count(*) FILTER (NOT is_ref AND bin = b) AS c
        FROM binned CROSS JOIN generate_series(0, {PSI_BINS - 1}) g(b) GROUP BY series_id, b""",
    "shares": """
        SELECT series_id, CASE WHEN r = 0 THEN 1e-6 ELSE r / (sum(r) OVER (PARTITION BY series_id) + 1e-6) END AS r,
               CASE WHEN c = 0 THEN 1e-6 ELSE c / (sum(c) OVER (PARTITION BY series_id) + 1e-6) END AS c FROM bins""",
    "psi": """
        SELECT series_id, psi_score, psi_score > 0.2 AS psi_alert,
               CASE WHEN psi_score > 0.2 THEN 'significant' WHEN psi_score >= 0.1 THEN 'minor' ELSE 'stable' END AS band
        FROM (SELECT series_id, round(sum((c - r) * ln(c / r)), 6) AS psi_score FROM shares GROUP BY series_id)""",
    "checks": """
        SELECT series_id, model_type, rolling_mase, recent_error, mean_demand, mase_alert, bias_alert, psi_alert, psi_score
        FROM (SELECT series_id, model_type, avg(mase) FILTER (rank <= 4) AS rolling_mase,
                     avg(error) FILTER (rank <= 3) AS recent_error, max(mean_demand) AS mean_demand,
                     count(*) >= 4 AND avg(mase) FILTER (rank <= 4) > 1.15 AS mase_alert,
                     count(*) >= 3 AND bool_and(abs(error) > CAST(0.1 AS DOUBLE) * mean_demand) FILTER (rank <= 3) AS bias_alert
              FROM history GROUP BY ALL) JOIN psi USING (series_id)""",
    "alerts": """
        SELECT series_id, model_type, 'mase_alert' AS alert_type, 'review' AS action, rolling_mase AS metric_value,
               printf('%s/%s: rolling 4-week MASE %.3f above 1.15', series_id, model_type, rolling_mase) AS message
        FROM checks WHERE mase_alert
        UNION ALL
        SELECT series_id, model_type, 'bias_alert', 'review', recent_error,
               printf('%s/%s: %s for 3 weeks, mean error %.1f against a limit of %.1f', series_id, model_type,
                      CASE WHEN recent_error > 0 THEN 'over-forecasting' ELSE 'under-forecasting' END,
                      recent_error, CAST(0.1 AS DOUBLE) * mean_demand)
        FROM checks WHERE bias_alert
        UNION ALL
        SELECT series_id, model_type, 'psi_alert', 'retrain', psi_score,
               printf('%s/%s: PSI %.4f above 0.20', series_id, model_type, psi_score) FROM checks WHERE psi_alert""",
    "health": """
        SELECT series_id, model_type, mase_4w, bias,
               CASE WHEN mase_4w > 1.15 THEN 'RED' WHEN mase_4w > 0.95 THEN 'AMBER' ELSE 'GREEN' END AS status
        FROM (SELECT series_id, model_type, avg(mase) FILTER (rank <= 4) AS mase_4w,
                     CASE WHEN count(*) >= 4 THEN avg(error) FILTER (rank <= 4) ELSE 0 END AS bias FROM history GROUP BY ALL)""",
    "trended": f"""
        SELECT series_id, week_start, CAST(total_sales AS DOUBLE) AS observed, (pos - 1) % 52 AS cyc,
               CASE WHEN pos > 26 AND pos <= n - 26 THEN
                   (sum(total_sales) OVER (PARTITION BY series_id ORDER BY week_start ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING)
                    + (lag(total_sales, 26) OVER {W} + lead(total_sales, 26) OVER {W}) / 2.0) / 52.0 END AS trend
        FROM numbered""",
    "cycles": """
        SELECT series_id, cyc, raw - avg(raw) OVER (PARTITION BY series_id) AS seasonal
        FROM (SELECT series_id, cyc, avg(observed - trend) AS raw FROM trended GROUP BY ALL)""",
    "parts": """
        SELECT series_id, week_start, observed, trend, seasonal, observed - trend - seasonal AS residual
        FROM trended JOIN cycles USING (series_id, cyc)""",
    "event_week": """
        SELECT week_start, arg_min(event_name_1, date) AS event_name FROM cal WHERE event_name_1 IS NOT NULL
        GROUP BY week_start""",
    "near": """
        SELECT near_week, arg_min(event_name, abs(o) * 10 + o) AS near_event
        FROM (SELECT event_name, o, CAST(week_start + CAST(7 * o AS INTEGER) AS DATE) AS near_week
              FROM event_week CROSS JOIN generate_series(-1, 1) g(o)) GROUP BY near_week""",
    "flagged": """
        SELECT series_id, week_start, observed AS sales, residual,
               coalesce(abs(residual - avg(residual) OVER (PARTITION BY series_id))
                        > 2.5 * stddev_samp(residual) OVER (PARTITION BY series_id), false) AS is_anomaly
        FROM parts""",
    "anomalies": """
        SELECT series_id, week_start, sales, residual, is_anomaly,
               CASE WHEN NOT is_anomaly THEN 'normal' WHEN near_event IS NOT NULL THEN 'explainable' ELSE 'unexplained' END
                   AS anomaly_class,
               CASE WHEN is_anomaly THEN coalesce(near_event, '') ELSE '' END AS event_label
        FROM flagged LEFT JOIN near ON near_week = week_start""",
    "centred": """
        SELECT series_id, pos, n, total_sales - avg(total_sales) OVER (PARTITION BY series_id) AS c FROM numbered""",
    "autocov": """
        SELECT a.series_id, a.n, k, sum(a.c * b.c) AS s
        FROM centred a CROSS JOIN generate_series(0, 60) g(k) JOIN centred b ON b.series_id = a.series_id AND b.pos = a.pos - k
        GROUP BY ALL""",
    "autocor": "SELECT series_id, n, k, s / max(s) FILTER (k = 0) OVER (PARTITION BY series_id) AS r FROM autocov",
    "acf_list": "SELECT series_id, any_value(n) AS n, list(r ORDER BY k) AS r FROM autocor GROUP BY series_id",
    "levinson": """
        SELECT series_id, n, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1.0 AS DOUBLE) AS v, CAST(1.0 AS DOUBLE) AS pacf
        FROM acf_list
        UNION ALL
        SELECT series_id, n, r, k + 1,
               list_append(list_transform(phi, lambda p, i: p - new * phi[len(phi) + 1 - i]), new), v * (1 - new * new), new
        FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda p, i: p * r[k + 2 - i])), 0)) / v AS new
              FROM levinson WHERE k < 60)""",
    "changes": f"""
        SELECT series_id, week_start, y, y - lag(y, 1) OVER {W} - lag(y, 52) OVER {W} + lag(y, 53) OVER {W} AS w, split
        FROM (SELECT series_id, week_start, CAST(total_sales AS DOUBLE) AS y, split FROM labelled)""",
    "sar_rows": f"""
        SELECT * FROM (SELECT series_id, week_start, split, w, lag(w, 1) OVER {W} AS w1, lag(w, 52) OVER {W} AS w52 FROM changes)
        WHERE w52 IS NOT NULL""",
    "sar_sums": """
        SELECT series_id, scope, count(*) AS n_used, sum(w1 * w1) AS s11, sum(w52 * w52) AS sss, sum(w1 * w52) AS s1s,
               sum(w1 * w) AS s1w, sum(w52 * w) AS ssw, sum(w * w) AS sww
        FROM (SELECT 'known' AS scope, * FROM sar_rows WHERE split <> 'test' UNION ALL SELECT 'all', * FROM sar_rows
              UNION ALL SELECT 'train', * FROM sar_rows WHERE split = 'train')
        GROUP BY ALL""",
    "sar_coef": """
        SELECT *, (s1w * sss - ssw * s1s) / nullif(s11 * sss - s1s * s1s, 0) AS phi1,
               (ssw * s11 - s1w * s1s) / nullif(s11 * sss - s1s * s1s, 0) AS phi_s FROM sar_sums""",
    "sar_all": """
        SELECT *, n_used * (ln(2 * pi() * sigma2) + 1) + 6 AS aic, n_used * (ln(2 * pi() * sigma2) + 1) + 3 * ln(n_used) AS bic
        FROM (SELECT *, greatest(0, sww - phi1 * s1w - phi_s * ssw) / n_used AS sigma2 FROM sar_coef)""",
    "sar_params": "SELECT series_id, phi1, phi_s, sigma2, n_used, aic, bic FROM sar_all WHERE scope = 'known'",
    "sar_res": """
        SELECT series_id, week_start, w - phi1 * w1 - phi_s * w52 AS residual
        FROM sar_rows JOIN sar_params USING (series_id) WHERE split <> 'test'""",
    "sar_state": """
        SELECT scope, series_id, max(week_start) AS last_week, list(y ORDER BY week_start) AS ys, list(w ORDER BY week_start) AS ws
        FROM (SELECT *, row_number() OVER (PARTITION BY scope, series_id ORDER BY week_start DESC) AS back
              FROM (SELECT 'known' AS scope, * FROM changes WHERE split <> 'test' UNION ALL SELECT 'all', * FROM changes
                    UNION ALL SELECT 'train', * FROM changes WHERE split = 'train'))
        WHERE back <= 53 GROUP BY ALL""",
    "sar_steps": """
        SELECT scope, series_id, last_week, phi1, phi_s, sigma2, 0 AS h, ys, ws,
               list_append(list_transform(range(52), lambda i: CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS ps,
               list_append(list_transform(range(51), lambda i: CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS us,
               CAST(0.0 AS DOUBLE) AS spread
        FROM sar_state JOIN sar_all USING (scope, series_id)
        UNION ALL
        SELECT scope, series_id, last_week, phi1, phi_s, sigma2, h + 1,
               list_append(ys, ys[-1] + ys[-52] - ys[-53] + nw), list_append(ws, nw),
               list_append(ps, ps[-1] + ps[-52] - ps[-53] + nu), list_append(us, nu), spread + ps[-1] * ps[-1]
        FROM (SELECT *, phi1 * ws[-1] + phi_s * ws[-52] AS nw, phi1 * us[-1] + phi_s * us[-52] AS nu
              FROM sar_steps WHERE h < CASE scope WHEN 'train' THEN 60 ELSE 13 END)""",
    "sar_fc": f"""
        SELECT scope, series_id, 'sar' AS model_type, CAST(h AS INTEGER) AS horizon,
               CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE) AS forecast_date, greatest(0.0, ys[-1]) AS predicted_value,
               greatest(0.0, ys[-1] - {Z95!r} * sqrt(sigma2 * spread)) AS lower_bound,
               greatest(0.0, ys[-1] + {Z95!r} * sqrt(sigma2 * spread)) AS upper_bound
        FROM sar_steps WHERE h > 0""",
    "res_centred": """
        SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY week_start) AS pos,
               count(*) OVER (PARTITION BY series_id) AS n, residual - avg(residual) OVER (PARTITION BY series_id) AS c
        FROM sar_res""",
    "res_cor": """
        SELECT series_id, n, k, s / max(s) FILTER (k = 0) OVER (PARTITION BY series_id) AS r
        FROM (SELECT a.series_id, a.n, k, sum(a.c * b.c) AS s
              FROM res_centred a CROSS JOIN generate_series(0, 40) g(k)
                   JOIN res_centred b ON b.series_id = a.series_id AND b.pos = a.pos - k GROUP BY ALL)""",
    "ljung": """
        SELECT series_id, any_value(n) * (any_value(n) + 2.0) * sum(r * r / (n - k)) AS lb_stat
        FROM res_cor WHERE k BETWEEN 1 AND 10 GROUP BY series_id""",
    "holidays": f"""
        SELECT DISTINCT state, ds, holiday FROM (
            SELECT unnest([{_list(list(REGION_STATES), "'{}'")}]) AS state, date AS ds, event_name_1 AS holiday
            FROM cal WHERE event_name_1 IS NOT NULL
            {"".join(f" UNION ALL SELECT '{s}', date, 'SNAP_{s}' FROM cal WHERE {c} = 1" for s, c in REGION_STATES.items())})""",
    "demand": "SELECT series_id, avg(total_sales) AS mean_demand FROM train GROUP BY series_id",
    "costs": f"""
        SELECT *, {CRITICAL_RATIO!r}::DOUBLE AS critical_ratio, greatest(0.0, mean_demand + {Z_COST!r} * sigma) AS order_quantity,
               2.0 * sigma * dens + 8.0 * sigma * (1.0 - {CRITICAL_RATIO!r}) * dens AS expected_cost,
               10.0 * sigma * dens AS expected_cost_textbook
        FROM (SELECT r.*, mean_demand, "MAE" * {math.sqrt(math.pi / 2)!r} AS sigma,
                     exp(-{Z_COST!r}::DOUBLE * {Z_COST!r}::DOUBLE / 2) / sqrt(2 * pi()) AS dens
              FROM results r JOIN demand USING (series_id))""",
    "runs": """
        SELECT CAST(year(forecast_date) * 4 + quarter(forecast_date) AS BIGINT) AS seq, series_id, model_type,
               round(avg(abs(error)) / any_value(naive_mae), 6) AS val_mase
        FROM scored JOIN naive USING (series_id) GROUP BY ALL""",
    "ordered_runs": """
        SELECT *, row_number() OVER (PARTITION BY series_id, model_type ORDER BY seq) AS step,
               encode_run AS run_id FROM (SELECT *, sha256(series_id || '|' || model_type || '|' || seq) AS encode_run FROM runs)""",
    "walked": """
        SELECT seq, series_id, model_type, run_id, val_mase, step, true AS promoted, CAST(NULL AS VARCHAR) AS champion_run,
               CAST(NULL AS DOUBLE) AS champion_mase, val_mase AS kept_mase, run_id AS kept_run
        FROM ordered_runs WHERE step = 1
        UNION ALL
        SELECT seq, series_id, model_type, run_id, val_mase, step, wins, kept_run, kept_mase,
               CASE WHEN wins THEN val_mase ELSE kept_mase END, CASE WHEN wins THEN run_id ELSE kept_run END
        FROM (SELECT o.seq, o.series_id, o.model_type, o.run_id, o.val_mase, o.step, w.kept_run, w.kept_mase,
                     NOT ((o.val_mase - w.kept_mase) / (w.kept_mase + 1e-9) > 0.05) AS wins
              FROM walked w JOIN ordered_runs o
                   ON o.series_id = w.series_id AND o.model_type = w.model_type AND o.step = w.step + 1)""",
    "unscored_runs": """
        SELECT seq, series_id, model_type, run_id, step, CASE WHEN seq % 5 >= 2 THEN val_mase END AS val_mase FROM ordered_runs""",
    "unscored_walk": """
        SELECT seq, series_id, model_type, val_mase, step, true AS promoted, CAST(NULL AS DOUBLE) AS champion_mase,
               'first' AS reason, val_mase AS kept_mase
        FROM unscored_runs WHERE step = 1
        UNION ALL
        SELECT seq, series_id, model_type, val_mase, step, reason NOT IN ('worse', 'no score'), kept_mase, reason,
               CASE WHEN reason NOT IN ('worse', 'no score') THEN val_mase ELSE kept_mase END
        FROM (SELECT o.seq, o.series_id, o.model_type, o.val_mase, o.step, w.kept_mase,
                     CASE WHEN o.val_mase IS NULL THEN 'no score' WHEN w.kept_mase IS NULL THEN 'champion without score'
                          WHEN (o.val_mase - w.kept_mase) / (w.kept_mase + 1e-9) > 0.05 THEN 'worse' ELSE 'not worse' END AS reason
              FROM unscored_walk w JOIN unscored_runs o
                   ON o.series_id = w.series_id AND o.model_type = w.model_type AND o.step = w.step + 1)""",
    "staged": """
        SELECT seq, series_id, model_type, run_id, val_mase,
               CASE WHEN NOT promoted THEN 'rolled_back'
                    WHEN seq = max(seq) FILTER (promoted) OVER (PARTITION BY series_id, model_type) THEN 'production'
                    ELSE 'archived' END AS stage
        FROM walked""",
}

_FORECAST = "series_id, model_type, horizon, forecast_date, predicted_value, lower_bound, upper_bound"
_STORE = (
    "series_id, forecast_date, horizon, predicted_value, lower_bound, upper_bound, model_type, model_version, generated_at"
)


def _acf_select(table: str) -> str:
    return f"""
        SELECT series_id, CAST(k AS INTEGER) AS lag, r AS acf, r - half AS acf_lower, r + half AS acf_upper FROM (
            SELECT *, CASE WHEN k = 0 THEN 0 ELSE {Z95!r} * sqrt((1 + 2 * coalesce(sum(CASE WHEN k > 0 THEN r * r END) OVER
                (PARTITION BY series_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END AS half
            FROM {table})"""


def _windows(source: str, keep: str) -> str:
    return f"""
        SELECT series_id, week_start, inputs, target FROM (
            SELECT series_id, week_start, split, total_sales AS target,
                   count(*) OVER f AS seen, string_agg(CAST(total_sales AS VARCHAR), ',') OVER f AS inputs
            FROM {source} WINDOW f AS (PARTITION BY series_id ORDER BY week_start ROWS BETWEEN 52 PRECEDING AND 1 PRECEDING))
        WHERE seen = 52 AND split = '{keep}'"""


# name -> (statement, double columns)
_STATEMENTS: dict[str, tuple[str, str]] = {
    "wide_scan": (
        """SELECT item_id || '_' || store_id AS id, item_id, cat_id || '_1' AS dept_id, cat_id, store_id, state_id, d,
                  CAST(coalesce(sum(sales), 0) AS INTEGER) AS sales
           FROM (SELECT DISTINCT item_id, cat_id, store_id, state_id FROM fact) CROSS JOIN cal
           LEFT JOIN (SELECT item_id AS i, store_id AS s, cat_id AS c, date, sales FROM fact) sold
                ON sold.i = item_id AND sold.s = store_id AND sold.c = cat_id AND sold.date = cal.date
           GROUP BY ALL""", ""),
    "wide_to_weekly": (
        f"""SELECT series_id, store_id, cat_id, week_id, week_start, total_sales, {_list(FLAGS)}
            FROM dense""", ""),
    "calendar_scan": ("SELECT * FROM cal", ""),
    "calendar_flags": ("SELECT * FROM cal", ""),
    "calendar_cached": ("SELECT * FROM cal", ""),
    "sell_prices_scan": (
        """SELECT l_partkey AS item_id, CAST(min(floor(l_extendedprice / l_quantity * 100 + 0.5)) AS BIGINT) AS sell_price
           FROM lineitem GROUP BY l_partkey""", ""),
    "weekly_cached": ("SELECT * FROM weekly", ""),
    "dashboard_scan": (
        """SELECT series_id, w.week_start, first_date, total_sales FROM weekly w
           JOIN (SELECT week_start, min(date) AS first_date FROM cal GROUP BY week_start) USING (week_start)""", ""),
    "store_scan": (f"SELECT {_STORE} FROM store", "predicted_value lower_bound upper_bound"),
    "store_export": (f"SELECT {_STORE} FROM store", "predicted_value lower_bound upper_bound"),
    "store_filtered": (
        f"""SELECT {_STORE} FROM store WHERE series_id = '{ONE_SERIES}' AND model_type = 'drift' AND model_version = 'v2'
            AND forecast_date BETWEEN DATE '2001-08-20' AND DATE '2001-10-15'""", "predicted_value lower_bound upper_bound"),
    "store_empty_filter": (
        f"SELECT {_STORE} FROM store WHERE model_type = 'drift'", "predicted_value lower_bound upper_bound"),
    "store_series": ("SELECT DISTINCT series_id FROM store", ""),
    "latest_version": (
        """SELECT series_id, model_type, arg_max(model_version, generated_at) AS model_version FROM store GROUP BY ALL""", ""),
    "latest_forecasts": (f"SELECT {_STORE} FROM latest", "predicted_value lower_bound upper_bound"),
    "latest_forecasts_between": (
        f"SELECT {_STORE} FROM latest WHERE forecast_date BETWEEN DATE '2001-08-20' AND DATE '2001-10-15'", "predicted_value lower_bound upper_bound"),
    "params_scan": (
        "SELECT series_id, 'sar' AS model_type, 'monthly' AS version, phi1, phi_s, sigma2 FROM sar_params", "phi1 phi_s sigma2"),
    "scaler_scan": ("SELECT * FROM scaler", "data_min data_max"),
    "scaler_params": ("SELECT * FROM scaler", "data_min data_max"),
    "results_csv": (
        """SELECT series_id, model, round("MASE", 3) AS "MASE", round("RMSE", 3) AS "RMSE", round("MAE", 3) AS "MAE",
                  round("ME", 3) AS "ME" FROM results""", "MASE RMSE MAE ME"),
    "retrain_source": (
        """SELECT series_id, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val,
                  count(*) FILTER (split = 'test') AS n_test FROM labelled GROUP BY series_id""", ""),
    "split_sizes": (
        """SELECT series_id, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val,
                  count(*) FILTER (split = 'test') AS n_test FROM labelled GROUP BY series_id""", ""),
    "weekly_sales": ("SELECT * FROM weekly", ""),
    "daily_calendar_join": (
        """SELECT state_id, cat_id, date, week_id, is_holiday, CAST(sum(sales) AS BIGINT) AS sales
           FROM fact JOIN cal USING (date) GROUP BY ALL""", ""),
    "dense_weekly": ("SELECT * FROM dense", ""),
    "whole_weeks": (
        """SELECT series_id, week_start, total_sales FROM weekly WHERE week_start IN
           (SELECT week_start FROM cal GROUP BY week_start HAVING count(*) = 7)""", ""),
    "series_ids": ("SELECT DISTINCT series_id FROM weekly", ""),
    "series_count": ("SELECT count(DISTINCT series_id) AS n_series FROM weekly", ""),
    "requested_series": (
        f"SELECT series_id, week_start, total_sales FROM weekly WHERE series_id IN ({_list(list(SERIES_LIST), chr(39) + '{}' + chr(39))})", ""),
    "first_series": (
        """SELECT series_id, week_start, total_sales FROM weekly WHERE series_id IN
           (SELECT DISTINCT series_id FROM weekly ORDER BY series_id LIMIT 5)""", ""),
    "one_series": (f"SELECT * FROM weekly WHERE series_id = '{ONE_SERIES}'", ""),
    "features": (
        f"""SELECT *, sin(2 * pi() * week_of_year / 52.0) AS week_sin, cos(2 * pi() * week_of_year / 52.0) AS week_cos,
               sin(2 * pi() * month(week_start) / 12.0) AS month_sin, cos(2 * pi() * month(week_start) / 12.0) AS month_cos,
               {_snap_case()} AS is_snap_week, CAST(year(week_start) AS INTEGER) AS year,
               CAST(quarter(week_start) AS INTEGER) AS quarter,
               CAST(lag(total_sales, 52) OVER {W} AS DOUBLE) AS sales_lag_52,
               avg(total_sales) OVER f AS rolling_4w_mean, stddev_samp(total_sales) OVER f AS rolling_4w_std
            FROM (SELECT *, CAST(weekofyear(week_start) AS INTEGER) AS week_of_year FROM dense)
            WINDOW f AS (PARTITION BY series_id ORDER BY week_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
        "week_sin week_cos month_sin month_cos sales_lag_52 rolling_4w_mean rolling_4w_std"),
    "snap_weeks": (
        f"SELECT series_id, split_part(series_id, '_', 1) AS state, week_start, {_snap_case()} AS is_snap_week FROM dense", ""),
    "rolling_stats": (
        """SELECT series_id, week_start, CAST(total_sales AS DOUBLE) AS value, avg(total_sales) OVER f AS rolling_mean,
                  coalesce(stddev_samp(total_sales) OVER f, 0) AS rolling_std
           FROM dense WINDOW f AS (PARTITION BY series_id ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
        "value rolling_mean rolling_std"),
    "lag_difference": (
        f"""SELECT * FROM (SELECT series_id, week_start, total_sales - lag(total_sales, 1) OVER {W} AS difference FROM dense)
            WHERE difference IS NOT NULL""", ""),
    "split_labels": ("SELECT series_id, week_start, total_sales, split, too_short FROM labelled", ""),
    "scaled_series": ("SELECT series_id, week_start, split, total_sales, scaled FROM scaled", "scaled"),
    "scaled_in_place": ("SELECT series_id, week_start, scaled FROM scaled", "scaled"),
    "restored_series": (
        """SELECT series_id, week_start, scaled, scaled * coalesce(nullif(data_max - data_min, 0), 1) + data_min AS restored
           FROM scaled""", "scaled restored"),
    "training_windows": (_windows("train", "train"), ""),
    "validation_windows": (_windows("known", "val"), ""),
    "seasonal_naive": (
        f"""SELECT series_id, 'seasonal_naive' AS model_type, CAST(h AS INTEGER) AS horizon,
               CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE) AS forecast_date, y AS predicted_value,
               CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
            FROM origin CROSS JOIN generate_series(1, 60) g(h) JOIN known_rank USING (series_id)
            WHERE back = {SEASON} - (h - 1) % {SEASON}""", "predicted_value lower_bound upper_bound"),
    "drift_line": (
        f"SELECT {_FORECAST} FROM baselines WHERE model_type = 'drift'", "predicted_value lower_bound upper_bound"),
    "future_weeks": (
        f"""SELECT series_id, CAST(h AS INTEGER) AS horizon, CAST(max(week_start) + 7 * CAST(h AS INTEGER) AS DATE) AS forecast_date
            FROM dense CROSS JOIN generate_series(1, {TEST_WEEKS}) g(h) GROUP BY series_id, h""", ""),
    "assembled_rows": (
        f"""SELECT t.series_id, 'seasonal_naive' AS model_type, CAST(t.horizon AS INTEGER) AS horizon,
               t.week_start AS forecast_date, b.predicted_value, b.lower_bound, b.upper_bound, 'v1' AS model_version
            FROM (SELECT series_id, week_start, row_number() OVER {W} AS horizon FROM test) t
            LEFT JOIN baselines b ON b.series_id = t.series_id AND b.horizon = t.horizon AND b.horizon <= 10
                 AND b.model_type = 'seasonal_naive'""", "predicted_value lower_bound upper_bound"),
    "heuristic_bounds": (
        """SELECT series_id, model_type, horizon, forecast_date, predicted_value, predicted_value * CAST(0.88 AS DOUBLE) AS lower_bound,
                  predicted_value * CAST(1.12 AS DOUBLE) AS upper_bound FROM baselines""", "predicted_value lower_bound upper_bound"),
    "first_horizon": (f"SELECT {_FORECAST} FROM baselines WHERE horizon <= 8", "predicted_value lower_bound upper_bound"),
    "forecast_actuals": (
        "SELECT series_id, model_type, forecast_date, actual, predicted_value FROM pairs", "actual predicted_value"),
    "value_range": (
        """SELECT series_id, model_type, min(least(actual, predicted_value)) AS low, max(greatest(actual, predicted_value)) AS high
           FROM pairs GROUP BY ALL""", "low high"),
    "accuracy": (
        'SELECT series_id, model AS model_type, "MAE", "RMSE", "ME" FROM results', "MAE RMSE ME"),
    "naive_scale": ("SELECT * FROM naive", "naive_mae"),
    "model_results": ("SELECT * FROM results", "MASE RMSE MAE ME"),
    "results_order": ("SELECT * FROM results", "MASE RMSE MAE ME"),
    "best_model": (
        """SELECT series_id, arg_min(model, "MASE") AS model, min("MASE") AS "MASE" FROM results GROUP BY series_id""", "MASE"),
    "model_means": (
        """SELECT model, avg("MASE") AS "MASE", avg("RMSE") AS "RMSE", avg("MAE") AS "MAE" FROM results GROUP BY model""",
        "MASE RMSE MAE"),
    "mean_demand": ("SELECT * FROM demand", "mean_demand"),
    "series_results": (
        f"""SELECT model, "MASE", "RMSE", "MAE", CASE WHEN "MASE" < 0.8 THEN 'Excellent' WHEN "MASE" < 1.0 THEN 'Good'
               WHEN "MASE" < 1.15 THEN 'Marginal' ELSE 'Poor' END AS band FROM results WHERE series_id = '{ONE_SERIES}'""",
        "MASE RMSE MAE"),
    "accuracy_bands": (
        """SELECT series_id, model, CASE WHEN "MASE" < 0.8 THEN 'Excellent' WHEN "MASE" < 1.0 THEN 'Good'
               WHEN "MASE" < 1.15 THEN 'Marginal' ELSE 'Poor' END AS band FROM results""", ""),
    "rolling_mase": (
        """SELECT series_id, model_type, forecast_date,
                  CASE WHEN count(*) OVER f = 4 THEN avg(abs(error)) OVER f END
                      / CASE WHEN naive_mae > 0 THEN naive_mae ELSE 1 END AS rolling_mase
           FROM scored JOIN naive USING (series_id)
           WINDOW f AS (PARTITION BY series_id ORDER BY forecast_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
        "rolling_mase"),
    "metrics_by_horizon": (
        """SELECT series_id, model_type, horizon, mae AS "MAE", rmse AS "RMSE", mae / nullif(naive_mae, 0) AS "MASE" FROM (
               SELECT series_id, model_type, horizon, avg(abs(predicted_value - actual)) OVER f AS mae,
                      sqrt(avg((predicted_value - actual) * (predicted_value - actual)) OVER f) AS rmse
               FROM pairs WINDOW f AS (PARTITION BY series_id, model_type ORDER BY horizon
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
           JOIN naive USING (series_id) WHERE horizon IN (4, 8, 13, 26)""", "MAE RMSE MASE"),
    "decompose_ma": ("SELECT * FROM parts", "observed trend seasonal residual"),
    "residual_stats": (
        """SELECT series_id, avg(residual) AS residual_mean, stddev_samp(residual) AS residual_std,
                  stddev_pop(residual) AS residual_std_pop FROM parts GROUP BY series_id""",
        "residual_mean residual_std residual_std_pop"),
    "control_limits": (
        """SELECT series_id, week_start, residual, 3.0 * stddev_pop(residual) OVER (PARTITION BY series_id) AS residual_limit,
                  0.1 * avg(observed) OVER (PARTITION BY series_id) AS bias_limit FROM parts""",
        "residual residual_limit bias_limit"),
    "anomalies": ("SELECT * FROM anomalies", "sales residual"),
    "anomaly_counts": (
        "SELECT series_id, count(*) FILTER (is_anomaly) AS n_anomalies FROM anomalies GROUP BY series_id", ""),
    "anomaly_summary": (
        "SELECT series_id, week_start, sales, residual, anomaly_class, event_label FROM anomalies WHERE is_anomaly",
        "sales residual"),
    "anomalies_without_calendar": (
        """SELECT series_id, week_start, sales, residual, 'unexplained' AS anomaly_class, '' AS event_label
           FROM flagged WHERE is_anomaly""", "sales residual"),
    "event_weeks": ("SELECT * FROM event_week", ""),
    "acf": (_acf_select("autocor"), "acf acf_lower acf_upper"),
    "pacf": (
        f"""SELECT series_id, CAST(k AS INTEGER) AS lag, pacf,
               pacf - CASE WHEN k = 0 THEN 0 ELSE {Z95!r} / sqrt(n) END AS pacf_lower,
               pacf + CASE WHEN k = 0 THEN 0 ELSE {Z95!r} / sqrt(n) END AS pacf_upper,
               CAST(NULL AS VARCHAR) AS error FROM levinson""",
        "pacf pacf_lower pacf_upper"),
    "sar_fit": ("SELECT * FROM sar_params", "phi1 phi_s sigma2 aic bic"),
    "sar_residuals": ("SELECT * FROM sar_res", "residual"),
    "sar_forecast": (
        f"SELECT {_FORECAST} FROM sar_fc WHERE scope = 'known'", "predicted_value lower_bound upper_bound"),
    "stored_scoring": (
        f"SELECT {_FORECAST} FROM sar_fc WHERE scope = 'all'", "predicted_value lower_bound upper_bound"),
    "unfitted_series": (f"SELECT DISTINCT series_id FROM weekly WHERE series_id IN {tuple(SERIES_LIST)!r}", ""),
    "sar_evaluation": (
        """SELECT series_id, 'sar' AS model, mae / nullif(naive_mae, 0) AS "MASE", rmse AS "RMSE", mae AS "MAE", me AS "ME"
           FROM (SELECT f.series_id, avg(abs(predicted_value - total_sales)) AS mae,
                        sqrt(avg((predicted_value - total_sales) * (predicted_value - total_sales))) AS rmse,
                        avg(predicted_value - total_sales) AS me
                 FROM sar_fc f JOIN test t ON t.series_id = f.series_id AND t.week_start = f.forecast_date
                 WHERE scope = 'known' GROUP BY f.series_id) JOIN naive USING (series_id)""", "MASE RMSE MAE ME"),
    "sar_diagnostics": (
        """SELECT series_id, lb_stat, lb_pvalue, lb_pvalue > 0.05 AS passed, aic, bic FROM (
               SELECT *, exp(-lb_stat / 2) * (1 + lb_stat / 2 + pow(lb_stat / 2, 2) / 2 + pow(lb_stat / 2, 3) / 6
                                              + pow(lb_stat / 2, 4) / 24) AS lb_pvalue FROM ljung)
           JOIN sar_params USING (series_id)""", "lb_stat lb_pvalue aic bic"),
    "sar_residual_acf": (_acf_select("res_cor"), "acf acf_lower acf_upper"),
    "design_input": ("SELECT series_id, week_start AS ds, CAST(total_sales AS DOUBLE) AS y FROM train", "y"),
    "holiday_table": ("SELECT * FROM holidays", ""),
    "error_history": (
        "SELECT series_id, model_type, forecast_date, error, mase, CAST(rank AS INTEGER) AS rank FROM history", "error mase"),
    "monitoring_source": (
        f"""SELECT series_id, model_type, forecast_date, error, abs(error) / (mean + 1e-6) AS mase FROM (
               SELECT *, predicted_value - lower_bound AS error, avg(predicted_value) OVER (PARTITION BY model_type) AS mean,
                      row_number() OVER (PARTITION BY model_type ORDER BY forecast_date DESC) AS back
               FROM latest WHERE series_id = '{ONE_SERIES}') WHERE back <= 12""", "error mase"),
    "mase_check": ("SELECT series_id, model_type, rolling_mase, mase_alert FROM checks", "rolling_mase"),
    "bias_check": (
        """SELECT series_id, model_type, recent_error, mean_demand,
                  CASE WHEN recent_error > 0 THEN 'over-forecasting' ELSE 'under-forecasting' END AS direction, bias_alert
           FROM checks""", "recent_error mean_demand"),
    "histogram_counts": (
        """SELECT series_id, string_agg(CAST(r AS VARCHAR), ',' ORDER BY bin) AS reference_counts,
                  string_agg(CAST(c AS VARCHAR), ',' ORDER BY bin) AS current_counts FROM bins GROUP BY series_id""", ""),
    "psi": ("SELECT * FROM psi", "psi_score"),
    "drift_checks": ("SELECT * FROM checks", "rolling_mase recent_error mean_demand psi_score"),
    "active_checks": (
        """SELECT series_id, model_type, mase_alert, bias_alert, psi_alert FROM checks
           WHERE mase_alert OR bias_alert OR psi_alert""", ""),
    "proxy_checks": (
        """SELECT series_id, model_type, avg(mase) FILTER (back <= 4) AS rolling_mase, avg(error) FILTER (back <= 3) AS recent_error,
                  max(mean) AS mean_demand, count(*) >= 4 AND avg(mase) FILTER (back <= 4) > 1.15 AS mase_alert,
                  bool_and(abs(error) > CAST(0.1 AS DOUBLE) * mean) FILTER (back <= 3) AS bias_alert, false AS psi_alert,
                  CAST(0 AS DOUBLE) AS psi_score
           FROM (SELECT *, abs(error) / (mean + 1e-6) AS mase FROM (
               SELECT *, predicted_value - lower_bound AS error, avg(predicted_value) OVER (PARTITION BY series_id, model_type) AS mean,
                      row_number() OVER (PARTITION BY series_id, model_type ORDER BY forecast_date DESC) AS back
               FROM latest) WHERE back <= 8) GROUP BY ALL""", "rolling_mase recent_error mean_demand psi_score"),
    "alert_rows": ("SELECT * FROM alerts", "metric_value"),
    "drift_job_alerts": (
        """WITH recent AS (SELECT series_id, week_start, CAST(total_sales AS DOUBLE) AS v FROM labelled WHERE pos > n - 4),
           both_samples AS (SELECT series_id, CAST(total_sales AS DOUBLE) AS v, true AS is_ref FROM train
                            UNION ALL SELECT series_id, v, false FROM recent),
           placed AS (SELECT series_id, is_ref, """
        + " + ".join(
            f"CAST(v >= lo + CAST({i} AS DOUBLE) * ((hi - lo) / CAST({PSI_BINS} AS DOUBLE)) AS INTEGER)" for i in range(1, PSI_BINS)
        )
        + """ AS bin FROM both_samples JOIN bounds USING (series_id)),
           counted AS (SELECT series_id, b, count(*) FILTER (is_ref AND bin = b) AS r, count(*) FILTER (NOT is_ref AND bin = b) AS c
                       FROM placed CROSS JOIN generate_series(0, 9) g(b) GROUP BY series_id, b),
           shared AS (SELECT series_id, CASE WHEN r = 0 THEN 1e-6 ELSE r / (sum(r) OVER (PARTITION BY series_id) + 1e-6) END AS r,
                      CASE WHEN c = 0 THEN 1e-6 ELSE c / (sum(c) OVER (PARTITION BY series_id) + 1e-6) END AS c FROM counted),
           shift AS (SELECT series_id, round(sum((c - r) * ln(c / r)), 6) AS score FROM shared GROUP BY series_id)
           SELECT series_id, model_type, alert_type, action, metric_value FROM alerts WHERE alert_type <> 'psi_alert'
           UNION ALL SELECT series_id, 'seasonal_naive', 'psi_alert', 'retrain', score FROM shift WHERE score > 0.2""", "metric_value"),
    "mase_warnings": (
        """SELECT series_id, model_type,
                  printf('%s/%s: MASE of the last 4 weeks is %.3f, above 1.15', series_id, model_type, rolling_mase) AS message
           FROM checks WHERE mase_alert""", ""),
    "health_table": ("SELECT * FROM health", "mase_4w bias"),
    "health_counts": ("SELECT status, count(*) AS n FROM health GROUP BY status", ""),
    "newsvendor": (
        """SELECT series_id, model, "MASE", "RMSE", "MAE", "ME", mean_demand, critical_ratio, sigma, order_quantity,
                  expected_cost, expected_cost_textbook FROM costs""",
        "MASE RMSE MAE ME mean_demand critical_ratio sigma order_quantity expected_cost expected_cost_textbook"),
    "newsvendor_by_share": (
        f"""SELECT series_id, model, b / (b + 2.0) AS critical_ratio, greatest(0.0, mean_demand + z * sigma) AS order_quantity,
               (2.0 * sigma + b * sigma * (1.0 - b / (b + 2.0))) * exp(-z * z / 2) / sqrt(2 * pi()) AS expected_cost
            FROM (SELECT *, CASE WHEN model = 'drift' THEN CAST(8.0 AS DOUBLE) ELSE CAST(3.0 AS DOUBLE) END AS b,
                         CASE WHEN model = 'drift' THEN {Z_COST!r} ELSE {NormalDist().inv_cdf(0.6)!r} END AS z FROM costs)""",
        "critical_ratio order_quantity expected_cost"),
    "cost_spread": (
        """SELECT series_id, model, expected_cost, max(expected_cost) OVER (PARTITION BY series_id) - expected_cost AS savings_vs_worst
           FROM costs""", "expected_cost savings_vs_worst"),
    "cheapest_and_dearest": (
        """SELECT series_id, arg_min(model, expected_cost) AS best_model, arg_max(model, expected_cost) AS worst_model,
                  max(expected_cost) - min(expected_cost) AS savings FROM costs GROUP BY series_id""", "savings"),
    "candidate_runs": (
        "SELECT seq, series_id, model_type, run_id, val_mase, 'candidate' AS stage FROM ordered_runs", "val_mase"),
    "run_decisions": (
        "SELECT seq, series_id, model_type, val_mase, promoted, champion_mase FROM walked", "val_mase champion_mase"),
    "unscored_decisions": (
        "SELECT seq, series_id, model_type, val_mase, promoted, champion_mase, reason FROM unscored_walk", "val_mase champion_mase"),
    "model_coverage": (
        f"""SELECT series_id, model, n_rows, CASE WHEN series_id IN {tuple(SERIES_LIST)!r} THEN 0 ELSE n_rows END AS n_values
            FROM (SELECT DISTINCT series_id FROM weekly)
            CROSS JOIN (VALUES ('sar', 13), ('sma', 13), ('window', 13), ('additive', 13), ('pacf', 61)) m(model, n_rows)""", ""),
    "run_stages": ("SELECT seq, series_id, model_type, stage FROM staged", ""),
    "champion_runs": (
        "SELECT series_id, model_type, run_id, val_mase FROM staged WHERE stage = 'production'", "val_mase"),
    "champion_of_series": (
        f"""SELECT series_id, model_type, run_id, val_mase FROM staged WHERE stage = 'production' AND series_id = '{ONE_SERIES}'""",
        "val_mase"),
    "promotion_step": (
        """SELECT seq, series_id, model_type, run_id, val_mase, promoted, champion_run, champion_mase,
                  CASE WHEN champion_run IS NULL THEN 'first' WHEN promoted THEN 'not worse' ELSE 'worse' END AS reason FROM walked
           WHERE seq = (SELECT max(seq) FROM runs)""", "val_mase champion_mase"),
    "rollback_alerts": (
        """SELECT seq, series_id, 'rollback' AS alert_type, (val_mase - champion_mase) / (champion_mase + 1e-9) AS metric_value,
                  champion_run AS kept_run FROM walked WHERE NOT promoted""", "metric_value"),
    "retrain_summary": (
        "SELECT series_id, model_type AS model, val_mase, run_id, promoted FROM walked", "val_mase"),
    "eda_tables": (
        """SELECT report, CASE WHEN report IN ('acf', 'pacf') THEN 61 * (SELECT count(DISTINCT series_id) FROM dense)
                               WHEN report = 'adf' THEN (SELECT count(DISTINCT series_id) FROM dense)
                               ELSE (SELECT count(*) FROM dense) END AS n_rows
           FROM (SELECT unnest(['stl', 'anomalies', 'acf', 'pacf', 'adf', 'rolling']) AS report)""", ""),
    "weekly_stream": (
        """SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, count(*) AS n_events,
                  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY ALL""", ""),
    "drift_stream": (
        """SELECT series_id, model_type, rolling_mase, recent_error, mean_demand, mase_alert, bias_alert, false AS psi_alert,
                  CAST(0 AS DOUBLE) AS psi_score FROM checks""", "rolling_mase recent_error mean_demand psi_score"),
}


def _renamed(tables: dict[str, str], names: dict[str, str], changes: dict[str, str]) -> dict[str, str]:
    """Copies of tables under other names, with parts of their text changed: the same model on other weeks."""
    out = {}
    for name, text in tables.items():
        for old, new in changes.items():
            text = text.replace(old, new)
        for old, new in names.items():
            name, text = name.replace(old, new), re.sub(rf"\b{old}", new, text)
        out[name] = text
    return out


_MODELS = model_oracles.TABLES
_ADDITIVE = {k: v for k, v in _MODELS.items() if k.startswith("add_")}
_WINDOW = {k: v for k, v in _MODELS.items() if k.startswith("win_")}
_CHOSEN = "penalty = (SELECT penalty FROM win_path WHERE chosen)"

#: The models fitted on the training weeks, forecasting the validation weeks, and refitted on both before the test weeks.
_JOBS = {
    **_renamed(_ADDITIVE, {"add_": "adt_"}, {"split <> 'test'": "split = 'train'", f"range(1, {TEST_WEEKS} + 1)": "range(1, 61)"}),
    "win_tried": f"""
        SELECT series_id, last_week, data_min, CASE WHEN data_max = data_min THEN 1 ELSE data_max - data_min END AS spread, a, weights, 0 AS h, x
        FROM (SELECT series_id, max(week_start) AS last_week, list(scaled ORDER BY week_start) AS x FROM scaled WHERE split = 'train' GROUP BY series_id)
             JOIN scaler USING (series_id) JOIN win_models ON {_CHOSEN}
        UNION ALL
        SELECT series_id, last_week, data_min, spread, a, weights, h + 1, list_append(x, a + list_inner_product(x[len(x) - 51:len(x)], weights))
        FROM win_tried WHERE h < 60""",
    "tried": f"""
        SELECT series_id, model_type AS model, forecast_date, predicted_value FROM sar_fc WHERE scope = 'train'
        UNION ALL SELECT series_id, 'additive', week_start, greatest(0.0, trend + yearly + holidays) FROM adt_next_parts
        UNION ALL SELECT series_id, 'window', CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE), greatest(0.0, x[-1] * spread + data_min) FROM win_tried WHERE h > 0""",
    "tried_scores": """
        SELECT series_id, model, mae / nullif(naive_mae, 0) AS val_mase
        FROM (SELECT series_id, model, avg(abs(predicted_value - total_sales)) AS mae
              FROM tried JOIN labelled USING (series_id) WHERE split = 'val' AND week_start = forecast_date GROUP BY ALL) JOIN naive USING (series_id)""",
    "joined": "SELECT * REPLACE ('train' AS split) FROM known",
    "joined_scaler": TABLES["scaler"].replace("FROM train", "FROM joined"),
    "joined_scaled": TABLES["scaled"].replace("FROM labelled", "FROM joined").replace("JOIN scaler", "JOIN joined_scaler"),
    "joined_naive": TABLES["naive"].replace("FROM train", "FROM joined"),
    **_renamed(
        {k: v for k, v in _WINDOW.items() if k not in ("win_path", "win_missed")}, {"win_": "wij_"},
        {"FROM scaled": "FROM joined_scaled", "JOIN scaler": "JOIN joined_scaler", "penalty = 1e-4": _CHOSEN.replace("win_", "WIN_")},
    ),
    "run_pairs": """
        SELECT series_id, 'sar' AS model, forecast_date, predicted_value FROM sar_fc WHERE scope = 'known'
        UNION ALL SELECT series_id, 'additive', week_start, greatest(0.0, trend + yearly + holidays) FROM add_next_parts
        UNION ALL SELECT series_id, 'window', CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE), greatest(0.0, x[-1] * spread + data_min) FROM wij_ahead WHERE h > 0
        UNION ALL SELECT series_id, model_type, forecast_date, predicted_value FROM pairs WHERE model_type = 'seasonal_naive'""",
    "run_results": """
        SELECT series_id, model, mae / nullif(naive_mae, 0) AS mase, rmse, mae, me
        FROM (SELECT series_id, model, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, avg(e) AS me
              FROM (SELECT p.series_id, model, predicted_value - total_sales AS e
                    FROM run_pairs p JOIN test t ON t.series_id = p.series_id AND t.week_start = p.forecast_date) GROUP BY ALL)
             JOIN joined_naive USING (series_id)""",
    # Models of the known weeks, asked for the weeks after the last one.
    "sal_coef": "SELECT series_id, phi1, phi_s, sigma2 FROM sar_all WHERE scope = 'known'",
    "sal_steps": TABLES["sar_steps"].replace("FROM sar_state JOIN sar_all USING (scope, series_id)", "FROM sar_state JOIN sal_coef USING (series_id) WHERE scope = 'all'")
    .replace("FROM sar_steps", "FROM sal_steps"),
    "sal_fc": TABLES["sar_fc"].replace("FROM sar_steps", "FROM sal_steps"),
    "add_after": f"""
        SELECT p.series_id, p.first_week, p.n, p.names, h AS horizon, CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE) AS week_start
        FROM (SELECT series_id, max(week_start) AS last_week FROM labelled GROUP BY series_id) l JOIN add_params p ON p.series_id = l.series_id
             JOIN range(1, {TEST_WEEKS} + 1) r(h) ON true""",
    "add_after_parts": model_oracles.parts("add_after"),
    "win_after": _WINDOW["win_ahead"].replace("win_ahead", "win_after").replace(
        "FROM win_arrays", "FROM (SELECT series_id, max(week_start) AS last_week, list(scaled ORDER BY week_start) AS x FROM scaled GROUP BY series_id)"),
    "next_fc": f"""
        SELECT {_FORECAST} FROM sal_fc
        UNION ALL {model_oracles.ahead("add_after_parts")}
        UNION ALL
        SELECT series_id, 'window', CAST(h AS INTEGER), CAST(last_week + 7 * CAST(h AS INTEGER) AS DATE), v, v * (1 - 0.12::DOUBLE), v * (1 + 0.12::DOUBLE)
        FROM (SELECT *, greatest(0.0, x[-1] * spread + data_min) AS v FROM win_after WHERE h > 0)""",
}
_JOBS = {k: v.replace("WIN_", "win_") for k, v in _JOBS.items()}
# Anomalies in the residuals of STL, by the same rules.
_JOBS |= {
    "rob_flagged": re.sub(r"\bparts\b", "rob_parts", TABLES["flagged"]).replace("2.5", "3.0"),
    "rob_anomalies": re.sub(r"\bflagged\b", "rob_flagged", TABLES["anomalies"]),
}

_JOB_STATEMENTS = {
    "anomalies_stl": ("SELECT * REPLACE (round(residual, 3) AS residual) FROM rob_anomalies", "sales residual"),
    "retrain_runs": ("SELECT series_id, model AS model_type, round(val_mase, 3) AS val_mase, 'candidate' AS stage FROM tried_scores", "val_mase"),
    "full_run": (
        """SELECT series_id, model, round_even(mase, 4) AS "MASE", round_even(rmse, 4) AS "RMSE", round_even(mae, 4) AS "MAE",
                  round_even(me, 4) AS "ME" FROM run_results""", "MASE RMSE MAE ME"),
    "score_next_weeks": (
        """SELECT series_id, model_type, horizon, forecast_date, round(predicted_value, 3) AS predicted_value, round(lower_bound, 3) AS lower_bound,
                  round(upper_bound, 3) AS upper_bound, 'v1' AS model_version FROM next_fc""", "predicted_value lower_bound upper_bound"),
}

#: Common tables of this module and of the models' one, which builds on them.
_EVERY = TABLES | _MODELS | _JOBS


def _needed(statement: str) -> list[str]:
    """Common tables a statement uses, directly or through others, in definition order."""
    found: set[str] = set()
    pending = [statement]
    while pending:
        words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", pending.pop()))
        new = (words & _EVERY.keys()) - found
        found |= new
        pending += [_EVERY[t] for t in new]
    return [t for t in _EVERY if t in found]


def _compose(statement: str, doubles: str) -> str:
    ctes = [f"{name} AS ({_EVERY[name]})" for name in _needed(statement)]
    rounding = ", ".join(f'round("{c}", {DIGITS}) + 0.0 AS "{c}"' for c in doubles.split())
    outer = f"SELECT * REPLACE ({rounding}) FROM (\n{statement})" if rounding else statement
    return (f"WITH RECURSIVE {',\n'.join(ctes)}\n" if ctes else "") + outer


def oracle_sql() -> dict[str, str]:
    return {name: _compose(*parts) for name, parts in (_STATEMENTS | model_oracles.STATEMENTS | _JOB_STATEMENTS).items()}
