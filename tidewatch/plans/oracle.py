"""Equivalent SQL (DuckDB dialect) for the registered queries: the oracle side
of the correctness compare.  Written independently of the Spark plans:
plain windows over whole features, ``quantile_cont``, ``lgamma``-based tails.
"""

from __future__ import annotations

from tidewatch.sqlref import chi2_sf_sql, ks_pvalue_sql

EV_REF, EV_CUR = "ts < TIMESTAMP '2024-01-16'", "ts >= TIMESTAMP '2024-01-16'"
LI_REF, LI_CUR = "l_shipdate < TIMESTAMP '1998-07-01'", "l_shipdate >= TIMESTAMP '1998-07-01'"
OR_REF, OR_CUR = "o_orderdate < TIMESTAMP '1998-07-01'", "o_orderdate >= TIMESTAMP '1998-07-01'"
LI_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_ALL_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"] + LI_NUMERIC
LI_CAT = ["l_returnflag", "l_linestatus"]


def r6(x: str) -> str:
    return f"round({x}, 6)"


def long_sql(table: str, ref: str, cur: str, num: list[str], cat: list[str]) -> str:
    parts = []
    for side, cond in ((0, ref), (1, cur)):
        for c in num:
            parts.append(f"SELECT {side} AS side, '{c}' AS feature, CAST({c} AS DOUBLE) + 0.0 AS num, CAST(NULL AS VARCHAR) AS cat FROM {table} WHERE {cond}")
        for c in cat:
            parts.append(f"SELECT {side} AS side, '{c}' AS feature, CAST(NULL AS DOUBLE) AS num, CAST({c} AS VARCHAR) AS cat FROM {table} WHERE {cond}")
    return " UNION ALL ".join(parts)


def drift_ctes(table: str, ref: str, cur: str, num: list[str], cat: list[str]) -> str:
    order = num + cat
    ordinal = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(order))
    ks_p = ks_pvalue_sql("d", "nr", "nc")
    chi_p = chi2_sf_sql("x", "k - 1")
    return f"""
lf AS ({long_sql(table, ref, cur, num, cat)}),
cnt AS (SELECT feature, num, cat, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c
        FROM lf WHERE (num IS NOT NULL AND NOT isnan(num)) OR cat IS NOT NULL GROUP BY feature, num, cat),
ntot AS (SELECT feature, CAST(sum(r) AS BIGINT) AS nr, CAST(sum(c) AS BIGINT) AS nc,
         sum(num * r) / nullif(sum(r), 0) AS mr, sum(num * c) / nullif(sum(c), 0) AS mc
         FROM cnt WHERE num IS NOT NULL GROUP BY feature),
ncum AS (SELECT feature, num, r, c, sum(r) OVER w AS cr, sum(c) OVER w AS cc FROM cnt WHERE num IS NOT NULL
         WINDOW w AS (PARTITION BY feature ORDER BY num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ksd AS (SELECT n.feature, max(abs(cr / nullif(nr, 0) - cc / nullif(nc, 0))) AS d FROM ncum n JOIN ntot t USING (feature) GROUP BY n.feature),
ks AS (SELECT t.feature, nr, nc, CASE WHEN nr > 0 AND nc > 0 THEN d END AS d, mr, mc,
       CASE WHEN mr IS NULL OR mc IS NULL THEN NULL WHEN mr = 0 THEN 0.0 ELSE abs((mc - mr) / mr) END AS shift
       FROM ntot t LEFT JOIN ksd USING (feature)),
ksp AS (SELECT *, {ks_p} AS p FROM ks),
cm AS (SELECT feature, CAST(sum(r) AS BIGINT) AS nr, CAST(sum(c) AS BIGINT) AS nc, CAST(count(*) AS BIGINT) AS k
       FROM cnt WHERE cat IS NOT NULL GROUP BY feature),
cc AS (SELECT c.feature, c.r, c.c, m.nr, m.nc, m.k, m.nr * (c.r + c.c) / (m.nr + m.nc) AS er, m.nc * (c.r + c.c) / (m.nr + m.nc) AS ec
       FROM cnt c JOIN cm m USING (feature) WHERE c.cat IS NOT NULL),
chx AS (SELECT feature, sum(
          CASE WHEN k = 2 THEN greatest(abs(r - er) - 0.5, 0.0) ELSE abs(r - er) END ^ 2 / nullif(er, 0)
        + CASE WHEN k = 2 THEN greatest(abs(c - ec) - 0.5, 0.0) ELSE abs(c - ec) END ^ 2 / nullif(ec, 0)) AS x
        FROM cc GROUP BY feature),
ch AS (SELECT m.feature, m.nr, m.nc, m.k - 1 AS dof,
       CASE WHEN m.nr > 0 AND m.nc > 0 AND m.k > 1 THEN x ELSE 0.0 END AS stat,
       CASE WHEN m.nr > 0 AND m.nc > 0 AND m.k > 1 THEN {chi_p.replace('k - 1', 'm.k - 1')} ELSE 1.0 END AS p
       FROM cm m LEFT JOIN chx USING (feature)),
det AS (
  SELECT feature, 'numerical' AS type, nr, nc, d AS stat, p, shift,
         coalesce(p < 0.05, false) OR coalesce(shift > 0.1, false) AS drift,
         concat_ws('; ', CASE WHEN p < 0.05 THEN 'KS-Test P-value significant' END,
                   CASE WHEN shift > 0.1 THEN 'Mean shift > 10%' END,
                   CASE WHEN d IS NULL THEN 'insufficient data' END) AS reasons
  FROM ksp
  UNION ALL
  SELECT feature, 'categorical', nr, nc, stat, p, NULL, coalesce(p < 0.05, false),
         concat_ws('; ', CASE WHEN p < 0.05 THEN 'Chi-Square P-value significant' END)
  FROM ch),
det_o AS (SELECT CASE feature {ordinal} END AS ordinal, * FROM det)
"""


def drift_with(table, ref, cur, num, cat, body: str) -> str:
    return "WITH " + drift_ctes(table, ref, cur, num, cat).strip() + "\n" + body


def ks_query(table, ref, cur, num):
    return drift_with(table, ref, cur, num, [], f"SELECT feature, nr AS n_ref, nc AS n_cur, {r6('d')} AS statistic, {r6('p')} AS p_value FROM ksp")


def chi_query(table, ref, cur, cat):
    return drift_with(table, ref, cur, [], cat, f"SELECT feature, nr AS n_ref, nc AS n_cur, dof, {r6('stat')} AS statistic, {r6('p')} AS p_value FROM ch")


def report_query(table, ref, cur, num, cat):
    return drift_with(table, ref, cur, num, cat,
                      f"SELECT feature, type, drift AS drift_detected, {r6('stat')} AS statistic, {r6('p')} AS p_value, reasons FROM det_o")


EV_NUM, EV_CAT = ["event_id", "user_id", "value"], ["event_type", "props"]
EV_ORDER = ["event_id", "ts", "user_id", "event_type", "value", "props"]
OR_NUM, OR_CAT = ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority"]


def _quantiles_union(table: str, cols: list[str], where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min(CAST({c} AS DOUBLE)) AS min, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, max(CAST({c} AS DOUBLE)) AS max FROM {table} WHERE {where}"
        for c in cols
    )


NULLABLE_LI = ("(SELECT l_orderkey, l_quantity, nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax, "
               "nullif(l_returnflag, 'N') AS l_returnflag, l_linestatus FROM lineitem)")

SCORED = "(SELECT l_returnflag, l_quantity AS label, l_extendedprice / 2000.0 AS prediction FROM lineitem)"
TWO_MODELS = ("(SELECT 'per_2000' AS model, l_quantity AS label, l_extendedprice / 2000.0 AS prediction FROM lineitem "
              "UNION ALL SELECT 'per_1500', l_quantity, l_extendedprice / 1500.0 FROM lineitem)")


def metrics_select(src: str, group: str | None = None, median: bool = True) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    med = ", quantile_cont(abs(label - prediction), 0.5) AS median_ae" if median else ""
    return (
        f"SELECT {g}CAST(count(*) AS BIGINT) AS n, avg(abs(label - prediction)) AS mae, sqrt(avg((label - prediction) ^ 2)) AS rmse, "
        f"1 - avg((label - prediction) ^ 2) / var_pop(label) AS r2, 1 - var_pop(label - prediction) / var_pop(label) AS explained_variance, "
        f"max(abs(label - prediction)) AS max_error{med}, "
        f"avg(CASE WHEN abs(label - prediction) <= 1 THEN 1.0 ELSE 0.0 END) * 100 AS within_1, "
        f"avg(CASE WHEN abs(label - prediction) <= 2 THEN 1.0 ELSE 0.0 END) * 100 AS within_2, "
        f"avg(CASE WHEN abs(label - prediction) <= 3 THEN 1.0 ELSE 0.0 END) * 100 AS within_3, "
        f"avg(CASE WHEN label <> 0 THEN abs((label - prediction) / label) END) * 100 AS mape FROM {src}{gb}"
    )


METRIC_COLS = ["mae", "rmse", "r2", "explained_variance", "max_error", "median_ae", "within_1", "within_2", "within_3", "mape"]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _quota_sql(src: str, bin_col: str, frac: str) -> str:
    """Exact quotas: total = ceil(frac * n); floor shares; largest remainders (ties by bin) +1."""
    return f"""(SELECT {bin_col}, fl + CASE WHEN rk <= total - sum(fl) OVER () THEN 1 ELSE 0 END AS quota FROM (
        SELECT {bin_col}, n, total, (total * n) // alln AS fl, (total * n) % alln AS rem,
               row_number() OVER (ORDER BY (total * n) % alln DESC, {bin_col}) AS rk
        FROM (SELECT {bin_col}, n, CAST(ceil(CAST({frac} AS DOUBLE) * sum(n) OVER ()) AS BIGINT) AS total, sum(n) OVER () AS alln
              FROM (SELECT {bin_col}, count(*) AS n FROM {src} GROUP BY {bin_col}) a) b) c)"""


def _bins_sql_fixed(src: str, col: str, out: str) -> str:
    # list_slice(e, 2, len-1) must be empty when len(e) <= 2
    return f"""(SELECT s.*, CASE WHEN {col} IS NULL THEN NULL ELSE
        len(list_filter(CASE WHEN len(e) > 2 THEN list_slice(e, 2, len(e) - 1) ELSE [] END, lambda x: x < {col})) END AS {out}
        FROM {src} s, (SELECT list_sort(list_distinct(quantile_cont(CAST({col} AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM {src}) q)"""


def stratified_sql() -> str:
    h = "md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR)))"
    b1 = _bins_sql_fixed("(SELECT o_orderkey, o_totalprice FROM orders)", "o_totalprice", "bin1")
    return f"""
WITH b1 AS (SELECT *, {h} AS h FROM {b1}),
q1 AS {_quota_sql('b1', 'bin1', '0.2')},
t AS (SELECT b1.*, row_number() OVER (PARTITION BY b1.bin1 ORDER BY h, o_orderkey) <= q1.quota AS is_test FROM b1 JOIN q1 USING (bin1)),
rest AS (SELECT o_orderkey, o_totalprice, h FROM t WHERE NOT is_test),
b2 AS {_bins_sql_fixed('rest', 'o_totalprice', 'bin2')},
q2 AS {_quota_sql('b2', 'bin2', '0.125 / (1 - 0.2)')},
v AS (SELECT b2.o_orderkey, row_number() OVER (PARTITION BY b2.bin2 ORDER BY h, o_orderkey) <= q2.quota AS is_val FROM b2 JOIN q2 USING (bin2))
SELECT o_orderkey, 'test' AS split FROM t WHERE is_test
UNION ALL SELECT o_orderkey, CASE WHEN is_val THEN 'val' ELSE 'train' END FROM v"""


def random_split_sql(table: str, key_cols: list[str], seed: int = 42, frac: str = "0.2") -> str:
    keys = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in key_cols)
    h = f"md5(concat_ws('|', '{seed}', {keys}))"
    order = ", ".join(key_cols)
    return f"""(SELECT *, CASE WHEN row_number() OVER (ORDER BY h, {order}) <= CAST(ceil(CAST({frac} AS DOUBLE) * count(*) OVER ()) AS BIGINT)
              THEN 'test' ELSE 'train' END AS split FROM (SELECT *, {h} AS h FROM {table}) x)"""


def retrain_loop_sql() -> str:
    """Each round's line by closed form, its errors on the round's held-out rows, and the decisions."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

    def part(where: str, price: str, more: str) -> str:
        return f"(SELECT {', '.join(keys)}, l_extendedprice * {price} AS x, l_quantity + {more} AS y FROM lineitem WHERE {where})"

    def line(split: str) -> str:
        return f"(SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {split} WHERE split = 'train')"

    def drifts(rows: str) -> str:  # these shifts pass the limit on the mean; equal tables have no drift at all
        return f"abs((SELECT avg(x) FROM {rows}) - (SELECT avg(x) FROM ref)) > 0.1 * abs((SELECT avg(x) FROM ref))"

    return f"""
WITH ref AS {part("l_shipdate < TIMESTAMP '1997-01-01'", '1.0', '0.0')},
first AS {part("l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'", '1.5', '0.0')},
later AS {part("l_shipdate >= TIMESTAMP '1998-01-01'", '2.0', '8.0')},
s1 AS {random_split_sql('(SELECT * FROM ref UNION ALL SELECT * FROM first)', keys)},
s2 AS {random_split_sql('(SELECT * FROM ref UNION ALL SELECT * FROM later)', keys)},
m1 AS {line('s1')}, m2 AS {line('s2')},
e AS (SELECT (SELECT avg(abs(y - m1.a - m1.b * x)) FROM s1, m1 WHERE split = 'test') AS own,
             (SELECT avg(abs(y - m1.a - m1.b * x)) FROM s2, m1 WHERE split = 'test') AS old,
             (SELECT avg(abs(y - m2.a - m2.b * x)) FROM s2, m2 WHERE split = 'test') AS new),
d AS (SELECT *, new < old - 0.01 AS better FROM e),
r AS (SELECT 1 AS round, 'no_new_data' AS status, NULL AS champ, NULL AS chal, NULL AS version
UNION ALL SELECT 2, CASE WHEN {drifts('ref')} THEN 'no_labels' ELSE 'no_drift' END, NULL, NULL, NULL
UNION ALL SELECT 3, CASE WHEN {drifts('first')} THEN 'no_labels' ELSE 'no_drift' END, NULL, NULL, NULL
UNION ALL SELECT 4, CASE WHEN {drifts('first')} THEN 'promoted' ELSE 'no_drift' END, NULL, own, 1 FROM d
UNION ALL SELECT 5, CASE WHEN better THEN 'promoted' ELSE 'kept_champion' END, old, new, CASE WHEN better THEN 2 END FROM d
UNION ALL SELECT 6, 'kept_champion', CASE WHEN better THEN new ELSE old END, new, NULL FROM d)
SELECT CAST(round AS INTEGER) AS round, status, round(CAST(champ AS DOUBLE), 4) AS champion_mae, round(CAST(chal AS DOUBLE), 4) AS challenger_mae,
       CAST(version AS INTEGER) AS version FROM r"""


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
_PRI_CASE = "CAST(CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES)) + " ELSE -1 END AS DOUBLE)"


def encode_all_sql() -> str:
    return f"""
WITH tr AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
st AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM tr),
cats AS (SELECT DISTINCT o_orderstatus AS cat FROM tr WHERE o_orderstatus IS NOT NULL),
kept AS (SELECT cat FROM cats WHERE cat > (SELECT min(cat) FROM cats))
SELECT o_orderkey, 'o_orderpriority' AS feature, round({_PRI_CASE}, 6) AS value FROM orders
UNION ALL SELECT o_orderkey, 'o_orderstatus_' || cat, round(CASE WHEN o_orderstatus = cat THEN 1.0 ELSE 0.0 END, 6) FROM orders, kept
UNION ALL SELECT o_orderkey, 'o_totalprice', round((o_totalprice - m) / CASE WHEN s = 0 OR s IS NULL THEN 1.0 ELSE s END, 6) FROM orders, st
"""


def ks_exact_sql() -> str:
    """Exact p by counting lattice paths with a recursive fold over one row of the grid at a time."""
    side = "count(*) FILTER (WHERE {})"
    return f"""
WITH RECURSIVE ev AS (SELECT concat_ws('|', event_type, CAST(hour(ts) AS VARCHAR)) AS slice, value, {EV_CUR} AS cur FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
cnt AS (SELECT slice, value, {side.format('NOT cur')} AS r, {side.format('cur')} AS c FROM ev GROUP BY 1, 2),
tot AS (SELECT slice, CAST(sum(r) AS BIGINT) AS n, CAST(sum(c) AS BIGINT) AS m FROM cnt GROUP BY 1),
cum AS (SELECT slice, sum(r) OVER w AS cr, sum(c) OVER w AS cc FROM cnt WINDOW w AS (PARTITION BY slice ORDER BY value)),
ks AS (SELECT slice, n, m, max(abs(cr / nullif(n, 0) - cc / nullif(m, 0))) AS d FROM cum JOIN tot USING (slice) GROUP BY ALL),
small AS (SELECT *, CAST(round(d * n * m) AS BIGINT) AS h FROM ks WHERE n > 0 AND m > 0 AND greatest(n, m) <= 1000),
fold AS (
  SELECT slice, n, m, h, CAST(0 AS BIGINT) AS i, list_transform(range(0, m + 1), lambda j: CASE WHEN j * n < h THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS u FROM small
  UNION ALL
  SELECT slice, n, m, h, i + 1, list_transform(range(0, m + 1), lambda j: CASE WHEN abs((i + 1) * m - j * n) >= h THEN 0.0::DOUBLE ELSE
      ((i + 1) / (i + 1 + m)) * list_sum(list_transform(range(0, j + 1), lambda k: CASE WHEN abs((i + 1) * m - k * n) < h THEN u[k + 1] ELSE 0.0::DOUBLE END)) END)
  FROM fold WHERE i < n),
exact AS (SELECT slice, greatest(0.0, least(1.0, 1.0 - u[m + 1])) AS p FROM fold WHERE i = n)
SELECT ks.slice, n AS n_ref, m AS n_cur, round(CASE WHEN n > 0 AND m > 0 THEN d END, 6) AS statistic,
       round(CASE WHEN greatest(n, m) <= 1000 AND n > 0 AND m > 0 THEN p ELSE {ks_pvalue_sql('d', 'n', 'm')} END, 6) AS p_value
FROM ks LEFT JOIN exact USING (slice)"""


def split_sql(feature: str, label: str, src: str) -> str:
    """All thresholds of a feature with the fall of the label's variance."""
    return f"""
SELECT '{feature}' AS feature, (v + nv) / 2 AS threshold, CAST(nl AS BIGINT) AS n_left, CAST(n - nl AS BIGINT) AS n_right, sl / nl AS mean_left,
       (s - sl) / (n - nl) AS mean_right, (nl * (sl / nl - s / n) ^ 2 + (n - nl) * ((s - sl) / (n - nl) - s / n) ^ 2) / n AS gain
FROM (SELECT v, lead(v) OVER w AS nv, sum(k) OVER w AS nl, sum(y) OVER w AS sl, sum(k) OVER () AS n, sum(y) OVER () AS s
      FROM (SELECT CAST({feature} AS DOUBLE) AS v, count(*) AS k, sum({label}) AS y FROM {src} GROUP BY 1) WINDOW w AS (ORDER BY v)) WHERE nv IS NOT NULL"""


def boosting_sql(features: list[str], label: str, src: str, rounds: int, rate: float) -> str:
    ctes = [f"r0 AS (SELECT {', '.join(features)}, {label} - (SELECT avg({label}) FROM {src}) AS y FROM {src})"]
    for i in range(1, rounds + 1):
        every = " UNION ALL ".join(f"SELECT * FROM ({split_sql(f, 'y', f'r{i - 1}')})" for f in features)
        value = "CASE s.feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in features) + " END"
        ctes.append(f"s{i} AS (SELECT * FROM ({every}) ORDER BY gain DESC, feature, threshold LIMIT 1)")
        ctes.append(f"r{i} AS (SELECT {', '.join(features)}, y - {rate} * CASE WHEN {value} <= s.threshold THEN s.mean_left ELSE s.mean_right END AS y FROM r{i - 1}, s{i} s)")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(
        f"SELECT {i} AS round, feature, round(threshold, 6) AS threshold, round({rate} * mean_left, 6) AS left_value, round({rate} * mean_right, 6) AS right_value FROM s{i}"
        for i in range(1, rounds + 1))


def psi_sql() -> str:
    base = drift_ctes("events", EV_REF, EV_CUR, ["value"], ["event_type"]).strip()
    return f"""WITH {base},
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(num, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
          FROM lf WHERE side = 0 AND num IS NOT NULL AND NOT isnan(num) GROUP BY feature),
nb AS (SELECT c.feature, CAST(len(list_filter(CASE WHEN len(e) > 2 THEN list_slice(e, 2, len(e) - 1) ELSE [] END, lambda x: x < c.num)) AS VARCHAR) AS bin, r, c.c
       FROM cnt c JOIN edges USING (feature) WHERE c.num IS NOT NULL
       UNION ALL SELECT feature, cat, r, c FROM cnt WHERE cat IS NOT NULL),
cells AS (SELECT feature, bin, sum(r) AS r, sum(c) AS c FROM nb GROUP BY feature, bin),
sh AS (SELECT feature, bin, r / sum(r) OVER (PARTITION BY feature) AS p, c / sum(c) OVER (PARTITION BY feature) AS q FROM cells),
agg AS (SELECT feature,
          sum((greatest(q, 0.0001) - greatest(p, 0.0001)) * ln(greatest(q, 0.0001) / greatest(p, 0.0001))) AS psi,
          sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js
        FROM sh GROUP BY feature)
SELECT feature, round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS psi_band,
       round(js, 6) AS js_divergence FROM agg"""


def std_median_sql() -> str:
    parts = []
    for c in LI_NUMERIC:
        parts.append(f"""SELECT '{c}' AS feature,
          stddev_samp(CASE WHEN {LI_REF} THEN {c} END) AS sr, stddev_samp(CASE WHEN {LI_CUR} THEN {c} END) AS sc,
          quantile_cont(CASE WHEN {LI_REF} THEN {c} + 0.0 END, 0.5) AS mr, quantile_cont(CASE WHEN {LI_CUR} THEN {c} + 0.0 END, 0.5) AS mc FROM lineitem""")
    u = " UNION ALL ".join(parts)
    return f"""SELECT feature, round(sr, 6) AS std_ref, round(sc, 6) AS std_cur, round(CASE WHEN sr <> 0 THEN abs((sc - sr) / sr) END, 6) AS std_shift,
      round(mr, 6) AS median_ref, round(mc, 6) AS median_cur, round(CASE WHEN mr <> 0 THEN abs((mc - mr) / mr) END, 6) AS median_shift FROM ({u})"""


def versions_sql() -> str:
    return """(SELECT CAST(row_number() OVER (ORDER BY yr) AS INTEGER) AS version, mae, r2 FROM (
      SELECT year(l_shipdate) AS yr, avg(abs(l_quantity - l_extendedprice / 2000.0)) AS mae,
             1 - avg((l_quantity - l_extendedprice / 2000.0) ^ 2) / var_pop(l_quantity) AS r2 FROM lineitem GROUP BY 1) y)"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["drift_ks_events"] = ks_query("events", EV_REF, EV_CUR, ["value"])
    q["drift_ks_lineitem"] = ks_query("lineitem", LI_REF, LI_CUR, LI_NUMERIC)
    q["drift_chi2_events"] = chi_query("events", EV_REF, EV_CUR, ["event_type"])
    q["drift_chi2_orders"] = chi_query("orders", OR_REF, OR_CUR, ["o_orderpriority", "o_orderstatus"])
    q["drift_chi2_yates"] = chi_query("lineitem", LI_REF, LI_CUR, ["l_linestatus", "l_returnflag"])
    q["drift_mean_shift"] = drift_with("lineitem", LI_REF, LI_CUR, LI_ALL_NUMERIC, [],
        "SELECT feature, round(mr, 6) AS mean_ref, round(mc, 6) AS mean_cur, round(shift, 6) AS mean_shift, shift > 0.1 AS shift_drift FROM ks")
    q["drift_report_events"] = report_query("events", EV_REF, EV_CUR, EV_NUM, EV_CAT)
    q["drift_vs_profile_events"] = report_query("events", EV_REF, EV_CUR, EV_NUM, EV_CAT)
    q["drift_report_lineitem"] = report_query("lineitem", LI_REF, LI_CUR, LI_ALL_NUMERIC, LI_CAT)
    summ = ("SELECT CAST(count(*) AS BIGINT) AS total_features_analyzed, CAST(count(*) FILTER (WHERE drift) AS BIGINT) AS drifted_features_count, "
            "coalesce(bool_or(drift), false) AS drift_detected_overall FROM det")
    q["drift_summary_orders"] = drift_with("orders", OR_REF, OR_CUR, OR_NUM, OR_CAT, summ)
    q["status_view"] = drift_with("orders", OR_REF, OR_CUR, OR_NUM, OR_CAT,
        "SELECT coalesce(bool_or(drift), false) AS drift_detected, CAST(count(*) FILTER (WHERE drift) AS BIGINT) AS drifted_features_count, "
        "CASE WHEN bool_or(drift) THEN 'DRIFTING' ELSE 'STABLE' END AS status FROM det")
    q["report_flatten"] = drift_with("events", EV_REF, EV_CUR, EV_NUM, EV_CAT,
        "SELECT feature, round(coalesce(stat, 0.0), 6) AS drift_score, round(coalesce(p, 1.0), 6) AS p_value, coalesce(drift, false) AS is_drifted FROM det")
    q["category_freq"] = drift_with("orders", OR_REF, OR_CUR, [], ["o_orderpriority", "o_orderstatus"],
        "SELECT feature, cat AS category, r AS n_ref, c AS n_cur, round(r / sum(r) OVER (PARTITION BY feature), 6) AS freq_ref, "
        "round(c / sum(c) OVER (PARTITION BY feature), 6) AS freq_cur FROM cnt")
    q["drift_share_lineitem"] = drift_with("lineitem", LI_REF, LI_CUR, LI_ALL_NUMERIC, LI_CAT,
        "SELECT CAST(count(*) AS BIGINT) AS n_features, CAST(count(*) FILTER (WHERE drift) AS BIGINT) AS n_drifted, "
        "round(avg(CASE WHEN drift THEN 1.0 ELSE 0.0 END), 6) AS drift_share, avg(CASE WHEN drift THEN 1.0 ELSE 0.0 END) >= 0.5 AS dataset_drift FROM det")
    nfeat = len(LI_ALL_NUMERIC) + len(LI_CAT)
    q["drift_bonferroni"] = drift_with("lineitem", LI_REF, LI_CUR, LI_ALL_NUMERIC, LI_CAT,
        f"SELECT feature, round(least(p * {nfeat}.0, 1.0), 6) AS p_value, "
        f"CASE WHEN type = 'numerical' THEN coalesce(least(p * {nfeat}.0, 1.0) < 0.05, false) OR coalesce(shift > 0.1, false) "
        f"ELSE coalesce(least(p * {nfeat}.0, 1.0) < 0.05, false) END AS drift_detected FROM det")
    q["psi_events"] = psi_sql()
    q["wasserstein_lineitem"] = drift_with("lineitem", LI_REF, LI_CUR, LI_NUMERIC, [],
        "SELECT feature, round(coalesce(sum(piece), 0.0), 6) AS wasserstein FROM (SELECT n.feature, "
        "abs(cr / nr - cc / nc) * (lead(num) OVER (PARTITION BY n.feature ORDER BY num) - num) AS piece FROM ncum n JOIN ntot USING (feature)) z GROUP BY feature")
    q["std_median_shift_lineitem"] = std_median_sql()
    q["drift_trend_events"] = """
WITH ref AS (SELECT avg(value) AS m FROM events WHERE ts < TIMESTAMP '2024-01-08'),
d AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS cm FROM events WHERE ts >= TIMESTAMP '2024-01-08' GROUP BY 1),
s AS (SELECT day, abs((cm - m) / m) AS ms FROM d, ref)
SELECT 'value' AS feature, day, round(ms, 6) AS mean_shift, round(ms - lag(ms) OVER (ORDER BY day), 6) AS mean_shift_delta,
       round(avg(ms) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS mean_shift_rolling FROM s"""
    band = ("CAST(CASE WHEN l_quantity / 2.5 >= 0 AND l_quantity / 2.5 <= 5 THEN 0 WHEN l_quantity / 2.5 > 5 AND l_quantity / 2.5 <= 10 THEN 1 "
            "WHEN l_quantity / 2.5 > 10 AND l_quantity / 2.5 <= 15 THEN 2 WHEN l_quantity / 2.5 > 15 AND l_quantity / 2.5 <= 20 THEN 3 END AS VARCHAR)")
    q["label_drift_bands"] = chi_query(f"(SELECT *, {band} AS target_band FROM lineitem)", LI_REF, LI_CUR, ["target_band"])
    q["concept_drift_monthly"] = """
WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(abs(l_quantity - l_extendedprice / 2000.0)) AS mae,
                  CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1)
SELECT month, n, round(mae, 6) AS mae, round(mae - lag(mae) OVER (ORDER BY month), 6) AS mae_delta,
       round(avg(mae) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS mae_rolling FROM m"""
    q["text_length_drift"] = ks_query("(SELECT *, length(text) AS text_length FROM documents)", "lang = 'en'", "lang <> 'en'", ["text_length"])

    q["recent_window"] = "SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000"
    q["batch_union"] = (f"SELECT event_id, ts, value FROM events WHERE {EV_REF} UNION ALL BY NAME "
                        f"SELECT event_id, user_id, event_type FROM events WHERE {EV_CUR}")
    q["table_counts_all"] = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in TABLES)

    q["profile_describe"] = (f"SELECT feature, CAST(count AS BIGINT) AS count, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, "
                             f"round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(max, 6) AS max FROM ({_quantiles_union('lineitem', LI_ALL_NUMERIC)})")
    miss = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('l_quantity', 'l_discount', 'l_tax') else ''}) AS BIGINT) AS missing_count, "
        f"count(*) AS n FROM {NULLABLE_LI}" for c in ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    q["profile_missing"] = f"SELECT feature, missing_count, round(missing_count * 100.0 / n, 6) AS missing_pct FROM ({miss}) WHERE missing_count > 0"
    q["profile_shape"] = ("SELECT 'l_extendedprice' AS feature, CAST(count(l_extendedprice) AS BIGINT) AS n, round(avg(l_extendedprice), 6) AS mean, "
                          "round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(stddev_samp(l_extendedprice), 6) AS std, "
                          "round(min(l_extendedprice), 6) AS min, round(max(l_extendedprice), 6) AS max, round(skewness(l_extendedprice), 6) AS skewness, "
                          "round(kurtosis(l_extendedprice), 6) AS kurtosis FROM lineitem")
    q["profile_target"] = ("SELECT 'c_acctbal' AS feature, lower(CAST(typeof(any_value(c_acctbal)) AS VARCHAR)) AS dtype, CAST(count(DISTINCT c_acctbal) AS BIGINT) AS n_distinct, "
                           "round(min(c_acctbal), 6) AS min, round(max(c_acctbal), 6) AS max, round(max(c_acctbal) - min(c_acctbal), 6) AS range FROM customer")
    numeric_types = "('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT', 'TINYINT', 'BOOLEAN', 'HUGEINT', 'REAL') OR data_type LIKE 'DECIMAL%'"
    q["column_types"] = (f"SELECT (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS n_rows, CAST(count(*) FILTER (WHERE data_type IN {numeric_types}) AS BIGINT) AS n_numeric, "
                         f"CAST(count(*) FILTER (WHERE NOT (data_type IN {numeric_types})) AS BIGINT) AS n_categorical, CAST(count(*) AS BIGINT) AS n_columns "
                         "FROM information_schema.columns WHERE table_name = 'lineitem'")
    q["shape_lineitem"] = ("SELECT (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS n_rows, "
                           "(SELECT CAST(count(*) AS BIGINT) FROM information_schema.columns WHERE table_name = 'lineitem') AS n_columns")
    vc = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY {c}" for c in ["p_brand", "p_type", "p_name"])
    q["value_counts_part"] = f"SELECT feature, value, CAST(n AS BIGINT) AS count FROM ({vc})"
    cols = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
    q["duplicates_lineitem"] = f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY {cols})"
    zc = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(count(*) FILTER (WHERE {c} = 0) AS BIGINT) AS zero_count, count(*) AS n FROM lineitem" for c in ["l_discount", "l_tax", "l_quantity"])
    q["zero_counts_lineitem"] = f"SELECT feature, zero_count, round(zero_count * 100.0 / n, 6) AS zero_pct FROM ({zc})"
    q["histogram_orders"] = """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 20)) AS INTEGER), 19) END AS bin, lo, hi
      FROM orders, r WHERE o_totalprice IS NOT NULL)
SELECT bin, round(lo + bin * (hi - lo) / 20, 6) AS bin_start, round(lo + (bin + 1) * (hi - lo) / 20, 6) AS bin_end, CAST(count(*) AS BIGINT) AS n
FROM b GROUP BY bin, lo, hi"""
    q["band_distribution"] = """
WITH x AS (SELECT l_quantity / 2.5 AS g FROM lineitem),
b AS (SELECT CASE WHEN g >= 0 AND g <= 5 THEN 0 WHEN g > 5 AND g <= 10 THEN 1 WHEN g > 10 AND g <= 15 THEN 2 WHEN g > 15 AND g <= 20 THEN 3 END AS band FROM x),
bands AS (SELECT * FROM (VALUES (0, '0-5'), (1, '5-10'), (2, '10-15'), (3, '15-20')) t(band, label))
SELECT bands.band, bands.label, CAST(coalesce(n, 0) AS BIGINT) AS n FROM bands LEFT JOIN (SELECT band, count(*) AS n FROM b GROUP BY band) c USING (band)"""
    others = [c for c in LI_ALL_NUMERIC if c != "l_extendedprice"]
    corr = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), l_extendedprice) AS corr FROM lineitem" for c in others)
    q["corr_top10"] = f"SELECT feature, round(corr, 6) AS corr FROM ({corr}) WHERE corr IS NOT NULL ORDER BY corr DESC, feature LIMIT 10"
    q["distinct_counts_customer"] = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM customer" for c in ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    q["range_outliers"] = "SELECT CAST(count(*) FILTER (WHERE p_size > 22 OR p_size < 15) AS BIGINT) AS n_outliers, CAST(count(*) AS BIGINT) AS n_rows FROM part"

    q["clean_binary_labels"] = ("SELECT doc_id, CASE WHEN lower(CASE WHEN quality = 1 THEN 'Yes' ELSE 'No' END) = 'yes' THEN 1 ELSE 0 END AS quality_yes, "
                                "CASE WHEN lower(CASE WHEN toxic = 1 THEN ' yes' ELSE 'YES' END) = 'yes' THEN 1 ELSE 0 END AS toxic_yes FROM labels")
    q["validate_part"] = ("SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey IS NULL THEN 'p_partkey:missing' END, CASE WHEN p_brand IS NULL THEN 'p_brand:missing' END, "
                          "CASE WHEN p_size IS NULL THEN 'p_size:missing' END, CASE WHEN p_size < 1 OR p_size > 40 THEN 'p_size:out_of_range' END, "
                          "CASE WHEN p_retailprice IS NULL THEN 'p_retailprice:missing' END, CASE WHEN p_retailprice < 900 OR p_retailprice > 990 THEN 'p_retailprice:out_of_range' END) AS violations, "
                          "NOT (p_partkey IS NULL OR p_brand IS NULL OR p_size IS NULL OR p_size < 1 OR p_size > 40 OR p_retailprice IS NULL OR p_retailprice < 900 OR p_retailprice > 990) AS is_valid FROM part")
    q["fill_defaults_orders"] = "SELECT o_orderkey, coalesce(nullif(o_orderpriority, '1-URGENT'), '3-MEDIUM') AS o_orderpriority, 'web' AS channel FROM orders"
    q["quoted_numeric"] = ("SELECT event_id, TRY_CAST(regexp_replace('\"' || regexp_extract(props, ':\\s*([^}]*)}', 1) || '\"', '^\"+|\"+$', '', 'g') AS DOUBLE) AS k_value FROM events")

    q["ordinal_encode"] = f"SELECT o_orderkey, {_PRI_CASE} AS priority_code FROM orders"
    q["onehot_dropfirst"] = ("WITH cats AS (SELECT DISTINCT c_mktsegment AS cat FROM customer WHERE c_mktsegment IS NOT NULL), "
                             "kept AS (SELECT cat FROM cats WHERE cat > (SELECT min(cat) FROM cats)) "
                             "SELECT c_custkey, 'c_mktsegment_' || cat AS feature, CAST(CASE WHEN c_mktsegment = cat THEN 1 ELSE 0 END AS DOUBLE) AS value FROM customer, kept")
    q["standard_scale"] = ("SELECT c_custkey, round((c_acctbal - m) / CASE WHEN s = 0 OR s IS NULL THEN 1.0 ELSE s END, 6) AS c_acctbal_scaled "
                           "FROM customer, (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer) st")
    q["encode_all"] = encode_all_sql()
    q["quantile_bins"] = f"SELECT o_orderkey, CAST(bin AS INTEGER) AS bin FROM {_bins_sql_fixed('(SELECT o_orderkey, o_totalprice FROM orders)', 'o_totalprice', 'bin')}"
    q["stratified_split_orders"] = stratified_sql()
    q["retrain_loop"] = retrain_loop_sql()
    q["random_split_orders"] = f"SELECT o_orderkey, split FROM {random_split_sql('(SELECT o_orderkey FROM orders)', ['o_orderkey'])}"

    q["regression_metrics_q"] = f"SELECT n, {', '.join(f'round({c}, 6) AS {c}' for c in METRIC_COLS)} FROM ({metrics_select(SCORED)})"
    q["within_k_by_flag"] = f"SELECT l_returnflag, n, round(within_1, 6) AS within_1, round(within_2, 6) AS within_2, round(within_3, 6) AS within_3 FROM ({metrics_select(SCORED, 'l_returnflag', False)})"
    q["error_bands"] = ("SELECT CASE WHEN e <= 1 THEN 'Excellent' WHEN e <= 2 THEN 'Good' WHEN e <= 3 THEN 'Fair' ELSE 'Poor' END AS status, CAST(count(*) AS BIGINT) AS n "
                        f"FROM (SELECT abs(label - prediction) AS e FROM {SCORED}) GROUP BY 1")
    q["quality_gate"] = (f"SELECT round(mae, 6) AS mae, round(r2, 6) AS r2, round(within_1, 6) AS within_1, "
                         "CASE WHEN mae < 2.0 THEN 'EXCELLENT' WHEN mae < 3.0 THEN 'GOOD' ELSE 'FAIR' END AS mae_gate, "
                         "CASE WHEN r2 > 0.8 THEN 'EXCELLENT' WHEN r2 > 0.7 THEN 'GOOD' ELSE 'FAIR' END AS r2_gate, "
                         f"CASE WHEN within_1 > 70.0 THEN 'EXCELLENT' WHEN within_1 > 60.0 THEN 'GOOD' ELSE 'FAIR' END AS within_1_gate FROM ({metrics_select(SCORED, None, False)})")
    q["compare_models_q"] = (f"WITH m AS ({metrics_select(TWO_MODELS, 'model', False)}) SELECT model, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, "
                             "round(within_1, 6) AS within_1, round(within_2, 6) AS within_2, model = (SELECT model FROM m ORDER BY r2 DESC, mae ASC, model DESC LIMIT 1) AS is_best FROM m")
    q["promote_decision"] = (f"WITH m AS ({metrics_select(TWO_MODELS, 'model', False)}), p AS (SELECT max(mae) FILTER (WHERE model = 'per_2000') AS champ, "
                             "max(mae) FILTER (WHERE model = 'per_1500') AS chal FROM m) SELECT round(champ, 6) AS champion_mae, round(chal, 6) AS challenger_mae, chal < champ - 0.01 AS promote FROM p")
    q["half_even_scores"] = f"SELECT CAST(round_even(prediction, 0) AS INTEGER) AS score, CAST(count(*) AS BIGINT) AS n FROM {SCORED} GROUP BY 1"
    li_keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rs = random_split_sql("(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem)", li_keys)
    mm = metrics_select(f"(SELECT CASE WHEN split = 'train' THEN 'train' ELSE 'val' END AS split, l_quantity AS label, l_extendedprice / 2000.0 AS prediction FROM {rs})", "split", False)
    gcols = ["mae", "rmse", "r2", "within_1"]
    sel = (", ".join(f"round(max({c}) FILTER (WHERE split = 'train'), 6) AS {c}_train" for c in gcols) + ", "
           + ", ".join(f"round(max({c}) FILTER (WHERE split = 'val'), 6) AS {c}_val" for c in gcols) + ", "
           + ", ".join(f"round(max({c}) FILTER (WHERE split = 'val') - max({c}) FILTER (WHERE split = 'train'), 6) AS {c}_gap" for c in gcols))
    q["overfit_gap_q"] = f"SELECT {sel} FROM ({mm})"
    q["at_risk_summary"] = ("SELECT CASE WHEN prediction >= 15 THEN 'excellent' WHEN prediction >= 12 THEN 'good' WHEN prediction >= 10 THEN 'pass' ELSE 'at_risk' END AS band, "
                            f"CAST(count(*) AS BIGINT) AS n FROM {SCORED} GROUP BY 1")
    q["bottom_20"] = (f"SELECT l_orderkey, l_linenumber, l_partkey, prediction FROM (SELECT *, round(l_extendedprice / 2000.0, 6) AS prediction FROM lineitem) "
                      f"ORDER BY prediction, {cols} LIMIT 20")
    q["pass_accuracy"] = (f"SELECT round(avg(CASE WHEN (label >= 10) = (prediction >= 10) THEN 1.0 ELSE 0.0 END) * 100, 6) AS pass_accuracy, "
                          f"round(avg(CASE WHEN label <> 0 THEN abs((label - prediction) / label) END) * 100, 6) AS mape FROM {SCORED}")
    q["ridge_fit"] = """
WITH s AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem),
c AS (SELECT sum((l_quantity - mx) * (l_extendedprice - my)) AS sxy, sum((l_quantity - mx) ^ 2) AS sxx, any_value(mx) AS mx, any_value(my) AS my FROM lineitem, s)
SELECT round(sxy / (sxx + 1.0), 4) AS coefficient, round(my - sxy / (sxx + 1.0) * mx, 3) AS intercept FROM c"""
    q["interaction_features"] = ("SELECT l_returnflag, round(avg(l_quantity ^ 2), 6) AS avg_q2, round(avg(l_discount * l_tax), 6) AS avg_disc_tax, "
                                 "round(avg(l_quantity * l_discount), 6) AS avg_q_disc, round(avg(l_discount + l_tax), 6) AS avg_disc_plus_tax FROM lineitem GROUP BY 1")
    q["zero_impute"] = ("WITH m AS (SELECT quantile_cont(l_discount + 0.0, 0.5) AS med FROM lineitem WHERE l_discount <> 0) "
                        "SELECT CAST(count(*) FILTER (WHERE l_discount = 0) AS BIGINT) AS n_zero, round(any_value(med), 6) AS median_nonzero, "
                        "round(avg(CASE WHEN l_discount = 0 THEN med ELSE l_discount END), 6) AS mean_after_impute FROM lineitem, m")
    q["mode_impute"] = (f"WITH m AS (SELECT l_returnflag AS mode FROM {NULLABLE_LI} WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, l_returnflag LIMIT 1) "
                        f"SELECT coalesce(l_returnflag, (SELECT mode FROM m)) AS l_returnflag, CAST(count(*) AS BIGINT) AS n FROM {NULLABLE_LI} GROUP BY 1")
    q["registry_next"] = f"SELECT CAST(coalesce(max(version), 0) + 1 AS INTEGER) AS next_version FROM {versions_sql()}"
    q["history_flatten"] = (f"SELECT 'v' || CAST(version AS VARCHAR) AS version, round(coalesce(mae, 0.0), 6) AS mae, round(coalesce(r2, 0.0), 6) AS r2, "
                            f"version = max(version) OVER () AS is_active FROM {versions_sql()}")
    keys = "c_custkey, c_name, c_nationkey, c_mktsegment"
    q["merge_on_many_keys"] = (f"SELECT {keys}, d1.c_acctbal AS c_acctbal_x, d2.c_acctbal AS c_acctbal_y "
                               "FROM (SELECT * FROM customer WHERE c_acctbal < 5000) d1 JOIN (SELECT * FROM customer WHERE c_acctbal >= 2000) d2 "
                               f"USING ({keys})")
    q["nation_region"] = "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"
    rows = ("CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(count(DISTINCT user_id) AS BIGINT) AS users, "
            "CAST(count(DISTINCT event_type) AS BIGINT) AS types, round(sum(value), 6) AS total FROM events")
    q["csv_two_separators"] = f"SELECT ',' AS sep, {rows} UNION ALL SELECT ';' AS sep, {rows}"
    q["corrupt_file_skip"] = f"SELECT {rows}"
    q["side_by_side_scores"] = ("SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(avg(abs(l_quantity - l_extendedprice / 2000.0)), 6) AS mae_a, "
                                "round(avg(abs(l_quantity - l_extendedprice / 1500.0)), 6) AS mae_b FROM lineitem GROUP BY 1")
    dct = [("c_custkey", "customer key", "identifier"), ("c_name", "customer name", "identifier"),
           ("c_nationkey", "nation of the customer", "categorical"), ("c_acctbal", "account balance", "numerical"),
           ("c_mktsegment", "market segment", "categorical")]
    types = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
    q["column_dictionary_customer"] = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{d}' AS description, '{k}' AS category, '{types[c]}' AS dtype, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM customer" for c, d, k in dct)
    q["drift_score_lineitem"] = drift_with("lineitem", LI_REF, LI_CUR, LI_ALL_NUMERIC, LI_CAT,
        "SELECT feature, type, round(CASE WHEN type = 'numerical' THEN stat "
        "WHEN nr + nc > 0 AND (SELECT k FROM cm WHERE cm.feature = det.feature) > 1 THEN sqrt(stat / (nr + nc)) ELSE 0.0 END, 6) AS drift_score FROM det")
    q["stream_ingest"] = "SELECT *, 'incoming_unlabeled' AS dataset_type FROM events"
    q["stream_windowed_profile"] = ("SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end, "
                                    "event_type AS category, CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS sum_value, round(sum(value * value), 6) AS sum_sq "
                                    "FROM events GROUP BY ALL")
    q["recent_files_window"] = """
SELECT row_number() OVER w - 1 AS position, event_id, user_id, event_type, round(value, 6) AS value
FROM (SELECT *, (dayofmonth(ts) - 1) // 4 AS slice FROM events) WINDOW w AS (ORDER BY slice DESC, event_id) QUALIFY row_number() OVER w <= 3000"""
    q["drift_ks_exact"] = ks_exact_sql()
    h = "md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR)))"
    q["stratified_folds_orders"] = f"""
WITH b AS (SELECT *, {h} AS h FROM {_bins_sql_fixed("(SELECT o_orderkey, o_totalprice FROM orders)", "o_totalprice", "bin")}),
r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY bin ORDER BY h, o_orderkey) AS rk, count(*) OVER (PARTITION BY bin) AS n FROM b)
SELECT o_orderkey, CAST(len(list_filter([1, 2, 3, 4], lambda f: rk > n * f // 5)) AS INTEGER) AS fold FROM r"""
    q["lasso_fit"] = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(b, 4) AS coefficient, round(my - b * mx, 3) AS intercept FROM (SELECT sign(c) * greatest(abs(c) - 0.5, 0) / v + 0.0 AS b, mx, my "
        f"FROM (SELECT covar_pop(l_extendedprice, {f}) AS c, var_pop({f}) AS v, avg({f}) AS mx, avg(l_extendedprice) AS my FROM lineitem))"
        for f in ["l_quantity", "l_discount", "l_tax", "l_linenumber"])
    q["tree_split_lineitem"] = " UNION ALL ".join(
        f"(SELECT feature, n_left, n_right, round(threshold, 6) AS threshold, round(mean_left, 6) AS mean_left, round(mean_right, 6) AS mean_right, round(gain, 6) AS gain "
        f"FROM ({split_sql(f, 'l_quantity', 'lineitem')}) ORDER BY gain DESC, threshold LIMIT 1)"
        for f in ["l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"])
    q["boosting_fit"] = boosting_sql(["l_discount", "l_tax", "l_linenumber"], "l_quantity", "lineitem", 3, 0.5)
    body = "drift AS drift_detected, round(stat, 6) AS statistic, round(p, 6) AS p_value, reasons FROM det"
    loads = [f"{EV_CUR} AND ts < TIMESTAMP '2024-01-24'", "ts >= TIMESTAMP '2024-01-24'"]
    q["stream_drift_gate"] = " UNION ALL ".join(
        "SELECT * FROM (" + drift_with("events", EV_REF, load, EV_NUM, EV_CAT, f"SELECT CAST({i} AS BIGINT) AS batch_id, feature, type, {body}") + ")"
        for i, load in enumerate(loads))
    # four-day windows count from 1970-01-01: they start every 345,600 s
    starts = ["TIMESTAMP '2024-01-14'", *[f"TIMESTAMP '2024-01-14' + INTERVAL '{4 * i} days'" for i in range(1, 6)]]
    q["stream_windowed_drift"] = " UNION ALL ".join(
        "SELECT * FROM (" + drift_with(
            "events", EV_REF, f"{EV_CUR} AND ts >= {w} AND ts < {w} + INTERVAL '4 days'", EV_NUM, EV_CAT,
            f"SELECT {w} AS window_start, {w} + INTERVAL '4 days' AS window_end, feature, type, {body}")
        + f") WHERE {w} + INTERVAL '4 days' <= (SELECT max(ts) - INTERVAL '1 day' FROM events) "
        f"AND EXISTS (SELECT 1 FROM events WHERE {EV_CUR} AND ts >= {w} AND ts < {w} + INTERVAL '4 days')"
        for w in starts)
    return q
