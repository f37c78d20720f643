"""DuckDB oracle SQL, one string per named query.

Written independently of the Spark plans and deliberately the brute-force
way the reference computes things: one filtered GROUP BY per segment
definition and period joined by UNION ALL, ROW_NUMBER de-duplication and a
LEFT JOIN for the period comparison, window ranks for cohorts. Nothing of the engine is imported: the fixed
values are typed again in ``oracle_values.py``, so a wrong constant on either
side shows as a difference.
"""

from __future__ import annotations

import math

from . import oracle_values as C
from . import oracle_values as B
from . import oracle_values as Q

B_HALF, C_HALF = "weeks_1_3", "weeks_4_6"
APPROVED_N = "count(*) FILTER (WHERE status = 'approved')"


def s(v) -> str:
    """SQL literal."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return "'" + str(v).replace("'", "''") + "'"


def case_map(expr: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {s(k)} THEN {s(v)}" for k, v in mapping.items())
    return f"COALESCE(CASE {expr} {whens} END, {s(default)})"


def safe_rate(a: str, t: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({t} AS DOUBLE), 0), 0.0)"


def ratio4(a: str, t: str, d: int = 4) -> str:
    u = 10 ** d
    return (f"CASE WHEN ({t}) > 0 THEN CAST((CAST({a} AS BIGINT) * {2 * u} + ({t})) // (2 * ({t})) AS DOUBLE)"
            f" / CAST({u} AS DOUBLE) ELSE 0.0 END")


def fixed(x: str, d: int, grouping: bool = False, plus: bool = False) -> str:
    u = 10 ** d
    n = f"CAST(round(({x}) * CAST({float(u)!r} AS DOUBLE)) AS BIGINT)"
    whole = f"(abs({n}) // {u})"
    whole_txt = f"format('{{:,}}', {whole})" if grouping else f"CAST({whole} AS VARCHAR)"
    sign = f"CASE WHEN {n} < 0 THEN '-' ELSE '{'+' if plus else ''}' END"
    if d == 0:
        return f"({sign} || {whole_txt})"
    return f"({sign} || {whole_txt} || '.' || lpad(CAST(abs({n}) % {u} AS VARCHAR), {d}, '0'))"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------------------- bindings

def geo_cte() -> str:
    fx = " ".join(f"WHEN {i} THEN {s(r)}" for i, r in enumerate(B.REGION_FX))
    return f"""geo AS (
  SELECT n.n_nationkey, n.n_name, r.r_regionkey, r.r_name, CASE r.r_regionkey {fx} END AS fx_rate
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def raw_e_cte() -> str:
    return f"""raw AS (
  SELECT CAST(e.event_id AS VARCHAR) AS transaction_id,
         CAST(e.ts AS TIMESTAMP) AS timestamp,
         CAST(floor(date_diff('day', DATE '{B.EVENTS_START}', CAST(e.ts AS DATE)) / {B.EVENTS_PERIOD_DAYS}) + 1 AS INTEGER) AS week_number,
         g.r_name AS country,
         'C' || CAST(g.r_regionkey AS VARCHAR) AS currency,
         CAST(e.value AS DOUBLE) / g.fx_rate AS amount,
         CAST(e.value AS DOUBLE) AS amount_usd,
         c.c_mktsegment AS card_brand,
         CASE WHEN e.k % 20 < 12 THEN 'Credit' WHEN e.k % 20 < 19 THEN 'Debit' ELSE 'Prepaid' END AS card_type,
         g.n_name AS issuer_bank,
         CASE WHEN e.event_type = 'error' THEN 'declined' ELSE 'approved' END AS status,
         CASE WHEN e.event_type = 'error' THEN 'reason_' || CAST(e.k % 8 AS VARCHAR) END AS decline_reason,
         CAST(e.k AS VARCHAR) AS merchant_id,
         CAST(e.user_id AS VARCHAR) AS customer_id,
         e.k % 7 = 0 AS is_recurring,
         CAST(hour(e.ts) AS INTEGER) AS hour_of_day
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey)"""


def raw_l_cte() -> str:
    div = B.LINEITEM_PRICE_DIVISOR
    usd = f"(CAST((CAST(round(l.l_extendedprice * 100) AS BIGINT) + {div // 2}) // {div} AS DOUBLE) / CAST(100 AS DOUBLE))"
    tid = ("concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), "
           "CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR), "
           "CAST(CAST(trunc(l.l_quantity) AS BIGINT) AS VARCHAR))")
    return f"""raw AS (
  SELECT {tid} AS transaction_id,
         CAST(l.l_shipdate AS TIMESTAMP) AS timestamp,
         CAST(year(l.l_shipdate) - {B.LINEITEM_FIRST_YEAR - 1} AS INTEGER) AS week_number,
         g.r_name AS country,
         'C' || CAST(g.r_regionkey AS VARCHAR) AS currency,
         {usd} / g.fx_rate AS amount,
         {usd} AS amount_usd,
         p.p_type AS card_brand,
         CASE WHEN l.l_discount < 0.06 THEN 'Credit' WHEN l.l_discount < 0.095 THEN 'Debit' ELSE 'Prepaid' END AS card_type,
         g.n_name AS issuer_bank,
         CASE WHEN l.l_returnflag = 'R' THEN 'declined' ELSE 'approved' END AS status,
         CASE WHEN l.l_returnflag = 'R' THEN o.o_orderpriority END AS decline_reason,
         CAST(l.l_suppkey AS VARCHAR) AS merchant_id,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         l.l_partkey % 7 = 0 AS is_recurring,
         CAST(CAST(trunc(l.l_quantity) AS BIGINT) % 24 AS INTEGER) AS hour_of_day
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey)"""


def amount_bucket_sql(x: str = "amount_usd") -> str:
    parts = [f"WHEN {x} < {s(float(u))} THEN {s(lab)}" for lab, u in C.AMOUNT_BUCKETS if u is not None]
    return f"CASE {' '.join(parts)} ELSE {s(C.AMOUNT_BUCKETS[-1][0])} END"


def hour_bucket_sql(x: str = "hour_of_day") -> str:
    parts = [f"WHEN {x} >= {lo} AND {x} < {hi} THEN {s(lab)}" for lab, lo, hi in C.HOUR_BUCKETS if lo is not None]
    return f"CASE {' '.join(parts)} ELSE {s(C.HOUR_BUCKETS[-1][0])} END"


def half_sql(x: str = "week_number", split: int = 3) -> str:
    return f"CASE WHEN {x} <= {split} THEN 'weeks_1_{split}' ELSE 'weeks_{split + 1}_6' END"


def base_ctes(b: str = "E", enriched: bool = True, split: int = 3) -> list[str]:
    ctes = [geo_cte(), raw_e_cte() if b == "E" else raw_l_cte()]
    if enriched:
        ctes.append(f"""enriched AS (
  SELECT *, {amount_bucket_sql()} AS amount_bucket, {hour_bucket_sql()} AS hour_bucket,
         {half_sql(split=split)} AS period_half FROM raw)""")
    return ctes


# --------------------------------------------------------------------------- segments

def money_sum(x: str) -> str:
    """Decimal sum (no overflow, no dropped amounts); 0.0 when nothing to sum."""
    return f"COALESCE(CAST(sum(CAST(({x}) AS DECIMAL(18, 4))) AS DOUBLE), 0.0)"


MEASURES = f"""count(*) AS total_transactions,
    count(*) FILTER (WHERE status = 'approved') AS approved_transactions,
    count(*) - count(*) FILTER (WHERE status = 'approved') AS declined_transactions,
    CAST(count(*) FILTER (WHERE status = 'approved') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS approval_rate,
    {money_sum('amount_usd')} AS total_amount_usd,
    {money_sum("CASE WHEN status = 'approved' THEN amount_usd END")} AS approved_amount_usd"""


def _seg_select(t: str, dims: list[str], declined: bool, kind: str, src: str) -> str:
    key = " || '|' || ".join(f"CAST({d} AS VARCHAR)" for d in dims)
    dcols = ", ".join((f"CAST({dims[i]} AS VARCHAR)" if i < len(dims) else "CAST(NULL AS VARCHAR)")
                      + f" AS dimension_{i + 1}" for i in range(4))
    where = ["decline_reason IS NOT NULL"] if declined else []
    if kind == "week":
        period, group = "'week_' || CAST(week_number AS VARCHAR)", ["week_number"]
        where.append("week_number IS NOT NULL")
    elif kind == "half":
        period, group = "period_half", ["period_half"]
    else:
        period, group = "'all'", []
    group += [d for d in dims if d not in group]
    w = f" WHERE {' AND '.join(where)}" if where else ""
    return (f"SELECT {s(t)} AS segment_type, {key} AS segment_key, {dcols}, {period} AS period,\n    {MEASURES}\n"
            f"  FROM {src}{w} GROUP BY {', '.join(group)}")


def segments_cte(name: str = "seg", src: str = "enriched", definitions: dict | None = None,
                 declined_only: dict | None = None) -> str:
    defs = C.SEGMENT_DEFINITIONS if definitions is None else definitions
    dec = C.DECLINED_ONLY_SEGMENT_DEFINITIONS if declined_only is None else declined_only
    parts = []
    for flag, group in ((False, defs), (True, dec)):
        for t, dims in group.items():
            for kind in ("week", "half", "all"):
                parts.append(_seg_select(t, dims, flag, kind, src))
    return f"{name} AS (\n  " + "\n  UNION ALL\n  ".join(parts) + ")"


# --------------------------------------------------------------------------- anomalies

def _dedup(period: str, prefix: str, src: str = "seg") -> str:
    prio = case_map("segment_type", C.TYPE_PRIORITY, C.TYPE_PRIORITY_DEFAULT)
    return f"""{prefix} AS (
  SELECT segment_key, segment_type, approval_rate AS {prefix}_rate, approved_transactions AS {prefix}_approved,
         total_transactions AS {prefix}_total, total_amount_usd AS {prefix}_amount_usd
  FROM (SELECT *, row_number() OVER (PARTITION BY segment_key ORDER BY {prio}, segment_type) AS rn
        FROM {src} WHERE period = '{period}') WHERE rn = 1)"""


def compare_ctes(src: str = "seg", exclude: tuple = (), b_period: str = B_HALF, c_period: str = C_HALF) -> list[str]:
    ctes = []
    if exclude:
        ctes.append(f"segx AS (SELECT * FROM {src} WHERE segment_type NOT IN ({', '.join(s(t) for t in exclude)}))")
        src = "segx"
    ctes += [_dedup(b_period, "baseline", src), _dedup(c_period, "current", src)]
    ctes.append("""cmp AS (
  SELECT b.segment_key, b.segment_type, b.baseline_rate, b.baseline_approved, b.baseline_total, b.baseline_amount_usd,
         COALESCE(c.current_rate, 0.0) AS current_rate, COALESCE(c.current_approved, 0) AS current_approved,
         COALESCE(c.current_total, 0) AS current_total, COALESCE(c.current_amount_usd, 0.0) AS current_amount_usd,
         COALESCE(c.current_rate, 0.0) - b.baseline_rate AS rate_change
  FROM baseline b LEFT JOIN current c ON b.segment_key = c.segment_key)""")
    return ctes


def p_value_sql() -> str:
    b1, b2, b3, b4, b5 = (s(x) for x in C.NORMAL_TAIL_B)
    t = f"(1.0 / (1.0 + {s(C.NORMAL_TAIL_P)} * az))"
    poly = f"({t} * ({b1} + {t} * ({b2} + {t} * ({b3} + {t} * ({b4} + {t} * {b5})))))"
    return (f"CASE WHEN n1 = 0 OR n2 = 0 THEN 1.0 WHEN pool = 0 OR pool = 1 THEN 1.0 WHEN se = 0 THEN 1.0 "
            f"ELSE 2.0 * {poly} * exp(-0.5 * (az * az)) / {s(math.sqrt(2 * math.pi))} END")


def pvalue_ctes(src: str = "cmp") -> list[str]:
    return [
        f"""pv1 AS (SELECT *, CAST(baseline_approved AS DOUBLE) AS c1, CAST(baseline_total AS DOUBLE) AS n1,
         CAST(current_approved AS DOUBLE) AS c2, CAST(current_total AS DOUBLE) AS n2 FROM {src})""",
        "pv2 AS (SELECT *, (c1 + c2) / (n1 + n2) AS pool FROM pv1)",
        """pv3 AS (SELECT *, CASE WHEN n1 = 0 OR n2 = 0 THEN NULL
                          ELSE sqrt(pool * (1.0 - pool) * (1.0 / n1 + 1.0 / n2)) END AS se FROM pv2)""",
        "pv4 AS (SELECT *, abs((c1 / NULLIF(n1, 0) - c2 / NULLIF(n2, 0)) / NULLIF(se, 0)) AS az FROM pv3)",
        f"pv AS (SELECT * EXCLUDE (c1, n1, c2, n2, pool, se, az), {p_value_sql()} AS p_value FROM pv4)",
    ]


def anomaly_ctes(exclude: tuple = (), b_period: str = B_HALF, c_period: str = C_HALF) -> list[str]:
    ctes = compare_ctes(exclude=exclude, b_period=b_period, c_period=c_period) + pvalue_ctes("cmp")
    std = "(SELECT stddev_pop(rate_change) FROM cmp)"
    mean = "(SELECT avg(rate_change) FROM cmp)"
    ticket = "CASE WHEN current_total > 0 THEN current_amount_usd / CAST(current_total AS DOUBLE) ELSE 0.0 END"
    ctes.append(f"""an0 AS (
  SELECT *, CASE WHEN {std} = 0 THEN 0.0 ELSE (rate_change - {mean}) / {std} END AS z_score,
         current_total AS affected_transactions,
         ((CAST(current_total AS DOUBLE) / {s(float(C.WEEKS_PER_PERIOD))}) * ({ticket}) * abs(rate_change)
          * {s(C.WEEKS_PER_MONTH)}) AS estimated_revenue_impact_usd
  FROM pv)""")
    ctes.append(f"""an AS (
  SELECT *, (abs(z_score) > {s(C.ANOMALY_Z)} OR p_value < {s(C.ANOMALY_P)})
            AND affected_transactions > {C.ANOMALY_MIN_AFFECTED} AS is_anomaly FROM an0)""")
    return ctes


ANOMALY_COLS = ("segment_key, segment_type, baseline_rate, current_rate, rate_change, round(z_score, 6) AS z_score, "
                "round(p_value, 6) AS p_value, is_anomaly, affected_transactions, "
                "round(estimated_revenue_impact_usd, 6) AS estimated_revenue_impact_usd")

IMPACT = "estimated_revenue_impact_usd"
ORDER_IMPACT = f"{IMPACT} DESC, segment_key ASC NULLS LAST"
ORDER_SCORE = "score DESC, segment_key ASC NULLS LAST"


def candidate_ctes(min_n: int = C.MIN_N) -> list[str]:
    return [
        "fl AS (SELECT * FROM an WHERE is_anomaly)",
        f"rest AS (SELECT * FROM an WHERE NOT is_anomaly ORDER BY {ORDER_IMPACT} LIMIT {min_n})",
        f"""rest2 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY {ORDER_IMPACT}) AS rn FROM rest)
          WHERE rn <= {min_n} - (SELECT count(*) FROM fl))""",
        "cand AS (SELECT * FROM fl UNION ALL SELECT * FROM rest2)",
    ]


def score_ctes() -> list[str]:
    w = C.SCORE_WEIGHTS

    def norm(x):
        lo, hi = f"(SELECT min({x}) FROM sc0)", f"(SELECT max({x}) FROM sc0)"
        return f"CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({x} - {lo}) / ({hi} - {lo}) END"

    return [
        "sc0 AS (SELECT *, abs(rate_change) AS mag, 1.0 - p_value AS sig FROM cand)",
        f"""sc1 AS (SELECT *, {case_map('segment_type', C.SPECIFICITY, C.SPECIFICITY_DEFAULT)} AS specificity,
         {case_map('segment_type', C.CATEGORY, C.CATEGORY_DEFAULT)} AS category,
         {norm(IMPACT)} AS impact_norm, {norm('mag')} AS magnitude_norm, {norm('sig')} AS significance_norm FROM sc0)""",
        f"""sc AS (SELECT *, {s(w['impact'])} * impact_norm + {s(w['magnitude'])} * magnitude_norm
         + {s(w['significance'])} * significance_norm + {s(w['specificity'])} * specificity AS score FROM sc1)""",
    ]


def topk_ctes(k: int = C.TOP_N) -> list[str]:
    return [
        f"tk0 AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {ORDER_SCORE}) = 1 AS is_best FROM sc)",
        f"tk AS (SELECT * FROM tk0 ORDER BY is_best DESC, {ORDER_SCORE} LIMIT {k})",
        f"rk AS (SELECT *, CAST(row_number() OVER (ORDER BY {ORDER_SCORE}) AS INTEGER) AS rank FROM tk)",
    ]


def label_sql(key: str = "segment_key") -> str:
    whens = " ".join(f"WHEN {s(k)} THEN {s(v)}" for k, v in C.SEGMENT_LABELS.items())
    return f"COALESCE(CASE {key} {whens} END, {key})"


def title_sql() -> str:
    pp = fixed("abs(rate_change) * 100.0", 0)
    return (f"CASE WHEN rate_change < 0 THEN {label_sql()} || ' Approval Rate Collapsed (' || {pp} || 'pp Drop)' "
            f"ELSE {label_sql()} || ' Approval Rate Anomaly (' || {pp} || 'pp Change)' END")


def description_sql() -> str:
    return (f"{label_sql()} || '''s approval rate ' || CASE WHEN rate_change < 0 THEN 'dropped' ELSE 'rose' END"
            f" || ' from ' || {fixed('baseline_rate * 100.0', 1)} || '% to ' || {fixed('current_rate * 100.0', 1)}"
            f" || '% starting Week 4, a ' || {fixed('abs(rate_change) * 100.0', 1)} || 'pp shift affecting '"
            f" || format('{{:,}}', affected_transactions)"
            f" || ' transactions per 3-week period. Estimated monthly revenue impact: $' || {fixed(IMPACT, 0, True)}"
            f" || '. Statistical significance: p=' || {fixed('p_value', 4)} || ', z=' || {fixed('z_score', 2)} || '.'")


def severity_sql(x: str = IMPACT) -> str:
    parts = " ".join(f"WHEN {x} > {s(float(t))} THEN {s(lab)}" for lab, t in C.SEVERITY_THRESHOLDS)
    return f"CASE {parts} ELSE {s(C.SEVERITY_DEFAULT)} END"


def insight_ctes(b: str = "E") -> list[str]:
    return (base_ctes(b) + [segments_cte()] + anomaly_ctes() + candidate_ctes() + score_ctes() + topk_ctes() + [
        f"""ins AS (SELECT rank, sha256(concat_ws('|', segment_type, segment_key, '{B_HALF}', '{C_HALF}')) AS insight_id,
         {title_sql()} AS title, {description_sql()} AS description, segment_key, baseline_rate, current_rate,
         rate_change, affected_transactions, {IMPACT}, {severity_sql()} AS severity FROM rk)"""])


INSIGHT_COLS = ("rank, insight_id, title, description, segment_key, baseline_rate, current_rate, rate_change, "
                f"affected_transactions, round({IMPACT}, 6) AS {IMPACT}, severity")


# --------------------------------------------------------------------------- simple views

def trend_cte(src: str = "raw") -> str:
    return f"""trend AS (
  SELECT week_number, count(*) AS total_transactions, count(*) FILTER (WHERE status = 'approved') AS approved_transactions,
         {safe_rate("count(*) FILTER (WHERE status = 'approved')", 'count(*)')} AS approval_rate,
         {money_sum('amount_usd')} AS total_amount_usd
  FROM {src} GROUP BY week_number)"""


def band_sql(x: str) -> str:
    return (f"CASE WHEN {x} >= {s(C.RATE_GREEN_THRESHOLD)} THEN 'green' WHEN {x} >= {s(C.RATE_YELLOW_THRESHOLD)} "
            f"THEN 'yellow' ELSE 'red' END")


def q(ctes: list[str], select: str) -> str:
    return with_(*ctes) + select


# --------------------------------------------------------------------------- exact tail, states, changes, history

def erfc_sql(x: str) -> str:
    """erfc(x) for x >= 0: the series of erf in nested form below 2, a continued fraction from there on."""
    series = (f"list_reduce(list_prepend(CAST(1.0 AS DOUBLE), list_transform(range(80, 0, -1), lambda i: CAST(i AS DOUBLE))), "
              f"lambda a, i: 1.0 + a * 2.0 * {x} * {x} / (2.0 * i + 1.0))")
    fraction = (f"list_reduce(list_prepend({x}, list_transform(range(300, 0, -1), lambda i: CAST(i AS DOUBLE))), "
                f"lambda a, i: {x} + (i / 2.0) / a)")
    return (f"CASE WHEN {x} < 2.0 THEN 1.0 - 2.0 / sqrt(pi()) * {x} * exp(-{x} * {x}) * {series} "
            f"ELSE exp(-{x} * {x}) / sqrt(pi()) / {fraction} END")


def exact_pvalue_ctes(src: str = "cmp") -> list[str]:
    ctes = pvalue_ctes(src)[:-1]
    ctes.append("pv5 AS (SELECT *, az / sqrt(2.0) AS x FROM pv4)")
    ctes.append(f"pv AS (SELECT * EXCLUDE (c1, n1, c2, n2, pool, se, az, x), CASE WHEN n1 = 0 OR n2 = 0 OR pool = 0 OR pool = 1 "
                f"OR se = 0 THEN 1.0 ELSE {erfc_sql('x')} END AS p_value FROM pv5)")
    return ctes


def judged_window_ctes() -> list[str]:
    """Six-hour windows an hour apart with at least five transactions, and each segment's state before."""
    return [
        "jw0 AS (SELECT *, date_trunc('hour', timestamp) - to_hours(k) + to_hours(6) AS we FROM raw, "
        "(SELECT unnest(range(0, 6)) AS k) t WHERE timestamp IS NOT NULL)",
        f"jw1 AS (SELECT country, we, count(*) AS n, {APPROVED_N} AS ok FROM jw0 GROUP BY country, we HAVING count(*) >= 5)",
        f"jw2 AS (SELECT *, CAST(ok AS DOUBLE) / CAST(n AS DOUBLE) AS rate, CAST(ok AS DOUBLE) / CAST(n AS DOUBLE) < {s(0.6)} AS low FROM jw1)",
        "jw AS (SELECT *, coalesce(lag(low) OVER (PARTITION BY country ORDER BY we), FALSE) AS was, "
        "lead(we) OVER (PARTITION BY country ORDER BY we) AS nxt FROM jw2)"]


def change_ctes(src: str, keys: str) -> list[str]:
    """Two-rate against one-rate binomial likelihood for every split of ``src`` (keys, w, k, n)."""
    def ll(k, n):
        return (f"((CASE WHEN {k} > 0 THEN {k} * ln({k} / {n}) ELSE 0.0 END) + "
                f"(CASE WHEN {n} - {k} > 0 THEN ({n} - {k}) * ln(({n} - {k}) / {n}) ELSE 0.0 END))")
    part = f"PARTITION BY {keys}"
    return [
        f"cs AS (SELECT {keys}, w, CAST(k AS DOUBLE) AS k, CAST(n AS DOUBLE) AS n FROM {src} WHERE w IS NOT NULL AND n > 0)",
        f"""cp0 AS (SELECT a.*, b.w AS cw, a.n1, a.kt - a.k1 AS k2, a.nt - a.n1 AS n2 FROM (
    SELECT *, sum(k) OVER ({part} ORDER BY w) AS k1, sum(n) OVER ({part} ORDER BY w) AS n1, sum(k) OVER ({part}) AS kt,
           sum(n) OVER ({part}) AS nt, count(*) OVER ({part}) AS n_weeks, row_number() OVER ({part} ORDER BY w) AS i FROM cs) a
    JOIN (SELECT *, row_number() OVER ({part} ORDER BY w) AS i FROM cs) b
    ON {" AND ".join(f"a.{x.strip()} = b.{x.strip()}" for x in keys.split(","))} AND b.i = a.i + 1)""",
        f"cp1 AS (SELECT *, round(greatest(2 * ({ll('k1', 'n1')} + {ll('k2', 'n2')} - {ll('kt', 'nt')}), 0.0), 9) AS lr FROM cp0)",
        f"""cp AS (SELECT *, k1 / n1 AS rate_before, k2 / n2 AS rate_after, sqrt(lr) / sqrt(2.0) AS x FROM cp1
    QUALIFY row_number() OVER ({part} ORDER BY lr DESC, cw) = 1)"""]


def disjoint_ctes() -> list[str]:
    """The greedy cover unrolled: each step picks the insight with the most impact among the rows left."""
    defs = C.SEGMENT_DEFINITIONS | C.DECLINED_ONLY_SEGMENT_DEFINITIONS
    keys = " ".join(f"WHEN {s(t)} THEN " + " || '|' || ".join(f"CAST({d} AS VARCHAR)" for d in dims) for t, dims in defs.items())
    declined = ", ".join(s(t) for t in C.DECLINED_ONLY_SEGMENT_DEFINITIONS)
    usd = f"CAST(0.0001 AS DOUBLE) / {s(float(C.WEEKS_PER_PERIOD))} * {s(float(C.WEEKS_PER_MONTH))}"
    ctes = [
        "pick AS (SELECT segment_type, segment_key, abs(rate_change) AS ch FROM rk)",
        f"cur AS (SELECT row_number() OVER () AS id, * FROM enriched WHERE period_half = '{C_HALF}')",
        f"""m1 AS (SELECT cur.id, CAST(round(amount_usd * 10000) AS BIGINT) AS u, pick.* FROM cur JOIN pick
    ON CASE pick.segment_type {keys} END IS NOT DISTINCT FROM pick.segment_key
    AND (pick.segment_type NOT IN ({declined}) OR decline_reason IS NOT NULL))""",
        "full_ AS (SELECT segment_type, segment_key, CAST(sum(u) AS DOUBLE) * any_value(ch) AS full_gain FROM m1 GROUP BY 1, 2)",
        "t1 AS (SELECT * FROM pick)"]
    for i in range(1, C.TOP_N + 1):
        ctes += [
            f"""p{i} AS (SELECT t.segment_type, t.segment_key, count(m.id) AS n, coalesce(CAST(sum(u) AS DOUBLE), 0.0) * any_value(t.ch) AS gain
    FROM t{i} t LEFT JOIN m{i} m ON m.segment_type = t.segment_type AND m.segment_key IS NOT DISTINCT FROM t.segment_key
    GROUP BY 1, 2 ORDER BY gain DESC, 1, 2 LIMIT 1)""",
            f"t{i + 1} AS (SELECT * FROM t{i} t WHERE NOT EXISTS (SELECT 1 FROM p{i} p WHERE p.segment_type = t.segment_type "
            f"AND p.segment_key IS NOT DISTINCT FROM t.segment_key))",
            f"m{i + 1} AS (SELECT * FROM m{i} WHERE id NOT IN (SELECT m.id FROM m{i} m JOIN p{i} p ON m.segment_type = p.segment_type "
            f"AND m.segment_key IS NOT DISTINCT FROM p.segment_key))"]
    steps = " UNION ALL ".join(f"SELECT {i} AS step, * FROM p{i}" for i in range(1, C.TOP_N + 1))
    ctes.append(f"""dj AS (SELECT CAST(step AS INTEGER) AS step, a.segment_type, a.segment_key, n AS charged_transactions,
    round(gain * ({usd}), 6) AS charged_impact_usd, round(coalesce(full_gain, 0.0) * ({usd}), 6) AS full_impact_usd
    FROM ({steps}) a LEFT JOIN full_ f ON f.segment_type = a.segment_type AND f.segment_key IS NOT DISTINCT FROM a.segment_key)""")
    return ctes


def asof_ctes() -> list[str]:
    """History of all earlier days per issuer, country and overall; moments of the groups give each prior's weight."""
    def history(name, dims):
        on = " AND ".join([f"x.{d} IS NOT DISTINCT FROM g.{d}" for d in dims] + ["CAST(x.timestamp AS DATE) < days.day"])
        cols = "".join(f"g.{d}, " for d in dims)
        groups = f"(SELECT DISTINCT {', '.join(dims)} FROM raw WHERE timestamp IS NOT NULL) g" if dims else "(SELECT 1) g"
        return (f"{name} AS (SELECT {cols}days.day, count(x.transaction_id) AS n, count(*) FILTER (WHERE x.status = 'approved') AS k "
                f"FROM days CROSS JOIN {groups} LEFT JOIN raw x ON {on} GROUP BY {cols}days.day)")

    def weight(name, src):
        return (f"""{name} AS (SELECT day, CASE WHEN nn > 0 AND v > 0 AND rho > 0 THEN least(greatest((1 - rho) / rho, 1.0), 10000.0)
    ELSE 10000.0 END AS w FROM (SELECT *, (sp - kk * kk / nullif(nn, 0)) / nullif(v, 0) - (g - 1) AS ex,
      ex / nullif(nn - s2 / nullif(nn, 0) - (g - 1), 0) AS rho FROM (
      SELECT day, count(*) FILTER (WHERE n > 0) AS g, CAST(sum(n) AS DOUBLE) AS nn, CAST(sum(k) AS DOUBLE) AS kk,
             sum(CAST(n AS DOUBLE) * n) AS s2, coalesce(sum(CAST(k AS DOUBLE) * k / nullif(n, 0)), 0.0) AS sp,
             kk / nullif(nn, 0) * (1 - kk / nullif(nn, 0)) AS v FROM {src} GROUP BY day)))""")

    return [
        "days AS (SELECT CAST(unnest(generate_series(min(CAST(timestamp AS DATE)), max(CAST(timestamp AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM raw)",
        history("h0", []), history("h1", ["country"]), history("h2", ["country", "issuer_bank"]),
        weight("w1", "h1"), weight("w2", "h2"),
        "e1 AS (SELECT h1.*, (h1.k + w * ((h0.k + 1.0) / (h0.n + 2.0))) / (h1.n + w) AS p FROM h1 JOIN w1 USING (day) JOIN h0 USING (day))",
        """e2 AS (SELECT h2.*, (h2.k + w * e1.p) / (h2.n + w) AS p FROM h2 JOIN w2 USING (day)
    JOIN e1 ON e1.day = h2.day AND e1.country IS NOT DISTINCT FROM h2.country)"""]


def new_rows(b: str, E: list[str], R: list[str], seg: list[str]) -> dict[str, str]:
    out: dict[str, str] = {}
    log_p = "round(log10(p_value), 6) AS log10_p"
    out["ztest_pvalue_exact"] = q(seg + compare_ctes() + exact_pvalue_ctes(), (
        "SELECT segment_key, baseline_approved, baseline_total, current_approved, current_total, "
        f"round(p_value, 12) AS p_value, {log_p} FROM pv"))
    an = anomaly_ctes()
    polynomial = set(pvalue_ctes("cmp"))
    at = next(i for i, c in enumerate(an) if c in polynomial)
    out["anomalies_exact_p"] = q(seg + an[:at] + exact_pvalue_ctes() + [c for c in an[at:] if c not in polynomial],
                                 f"SELECT {ANOMALY_COLS} FROM an")
    stamp = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
    out["alert_episodes"] = q(R + judged_window_ctes() + [
        "isl AS (SELECT *, count(*) FILTER (WHERE low AND NOT was) OVER (PARTITION BY country ORDER BY we) AS island FROM jw)"], (
        f"SELECT country, {stamp.format('min(we)')} AS fell_at, {stamp.format('arg_max_null(nxt, we)')} AS recovered_at, "
        "count(*) AS n_windows, min(rate) AS lowest_rate FROM isl WHERE low GROUP BY country, island"))
    out["alert_stream"] = q(R + judged_window_ctes(), (
        f"SELECT country, CASE WHEN low THEN 'fell' ELSE 'recovered' END AS event, {stamp.format('we')} AS window_end, "
        "n AS total_transactions, ok AS approved_transactions, rate AS approval_rate FROM jw WHERE low <> was "
        "AND we <= (SELECT max(timestamp) FROM raw) - INTERVAL 2 HOURS"))
    out["segments_incremental"] = q(seg, "SELECT * FROM seg")
    first = """cw AS (SELECT customer_id, week_number AS cohort_week FROM raw WHERE customer_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY timestamp ASC NULLS FIRST, transaction_id) = 1)"""
    early = "coalesce(r.week_number <= 3, FALSE)"
    out["cohort_retention"] = q(R + [first, f"""ret AS (
  SELECT cohort_week, customer_id, bool_or({early}) AS e, bool_or(NOT {early}) AS l FROM raw r JOIN cw USING (customer_id) GROUP BY 1, 2)""",
                                     """rs AS (SELECT cohort_week, count(*) AS n_customers, count(*) FILTER (WHERE e) AS n_early,
    count(*) FILTER (WHERE l) AS n_late, count(*) FILTER (WHERE e AND l) AS n_retained FROM ret GROUP BY 1)"""],
                                f"SELECT *, {ratio4('n_retained', 'n_early')} AS retention_rate FROM rs")
    p = f"least(1.0, ({erfc_sql('x')}) * (n_weeks - 1))"
    src = ("src AS (SELECT segment_type, segment_key, CAST(substr(period, 6) AS INTEGER) AS w, approved_transactions AS k, "
           "total_transactions AS n FROM seg WHERE period LIKE 'week\\_%' ESCAPE '\\' AND segment_key IS NOT NULL AND segment_type <> 'time_weekly')")
    out["change_points"] = q(seg + [src] + change_ctes("src", "segment_type, segment_key"), (
        "SELECT segment_type, segment_key, cw AS change_week, round(rate_before, 6) AS rate_before, round(rate_after, 6) AS rate_after, "
        f"round(lr, 6) AS lr_statistic, round({p}, 6) AS p_value, n_weeks FROM cp"))
    over_all = "src AS (SELECT 0 AS every, week_number AS w, approved_transactions AS k, total_transactions AS n FROM trend)"
    out["headline_trend_found"] = q(R + [trend_cte(), over_all] + change_ctes("src", "every"), (
        f"SELECT week_number, total_transactions, approval_rate, {band_sql('approval_rate')} AS rate_band, "
        f"{s(C.TARGET_THRESHOLD)} AS target_rate, approval_rate < {s(C.TARGET_THRESHOLD)} AS below_target, "
        "COALESCE(week_number = (SELECT cw FROM cp), FALSE) AS is_inflection FROM trend"))
    out["disjoint_impact"] = q(seg + anomaly_ctes() + candidate_ctes() + score_ctes() + topk_ctes() + disjoint_ctes(),
                               "SELECT * FROM dj")
    out["risk_score_asof"] = q(R + asof_ctes(), (
        "SELECT transaction_id, r.country, r.issuer_bank, coalesce(n, 0) AS hist_n, coalesce(k, 0) AS hist_approved, "
        "round(coalesce(p, 0.5), 6) AS expected_approval, round(1.0 - coalesce(p, 0.5), 6) AS risk_score FROM raw r LEFT JOIN e2 "
        "ON e2.day = CAST(r.timestamp AS DATE) AND e2.country IS NOT DISTINCT FROM r.country "
        "AND e2.issuer_bank IS NOT DISTINCT FROM r.issuer_bank"))
    box = ("bx AS (SELECT period_half, status, count(amount_usd) AS n, min(amount_usd) AS min, quantile_cont(amount_usd, 0.25) AS q1, "
           "quantile_cont(amount_usd, 0.5) AS median, quantile_cont(amount_usd, 0.75) AS q3, max(amount_usd) AS max "
           "FROM enriched GROUP BY 1, 2)")
    low, high = "bx.q1 - (bx.q3 - bx.q1) * 1.5", "bx.q3 + (bx.q3 - bx.q1) * 1.5"
    out["amount_box_whiskers"] = q(E + [box], (
        "SELECT bx.period_half, bx.status, any_value(bx.n) AS n, any_value(bx.min) AS min, round(any_value(bx.q1), 6) AS q1, "
        "round(any_value(bx.median), 6) AS median, round(any_value(bx.q3), 6) AS q3, any_value(bx.max) AS max, "
        f"min(amount_usd) FILTER (WHERE amount_usd >= {low}) AS lower_whisker, "
        f"max(amount_usd) FILTER (WHERE amount_usd <= {high}) AS upper_whisker, "
        f"count(*) FILTER (WHERE amount_usd < {low}) AS n_below, count(*) FILTER (WHERE amount_usd > {high}) AS n_above "
        "FROM enriched e JOIN bx ON e.period_half = bx.period_half AND e.status = bx.status GROUP BY 1, 2"))
    out["hourly_rates_dense"] = q(R + [
        "hours AS (SELECT unnest(generate_series(min(date_trunc('hour', timestamp)), max(date_trunc('hour', timestamp)), INTERVAL 1 HOUR)) AS h FROM raw)",
        "places AS (SELECT DISTINCT country FROM raw WHERE timestamp IS NOT NULL)",
        f"hr AS (SELECT country, date_trunc('hour', timestamp) AS h, count(*) AS n, {APPROVED_N} AS k FROM raw WHERE timestamp IS NOT NULL GROUP BY 1, 2)"], (
        "SELECT places.country, strftime(hours.h, '%Y-%m-%d %H:%M:%S') AS bucket, coalesce(n, 0) AS total_transactions, "
        "coalesce(k, 0) AS approved_transactions, CAST(k AS DOUBLE) / CAST(n AS DOUBLE) AS approval_rate FROM places CROSS JOIN hours "
        "LEFT JOIN hr ON hr.h = hours.h AND hr.country IS NOT DISTINCT FROM places.country"))
    return out


def build(b: str = "E") -> dict[str, str]:
    E = base_ctes(b)
    R = base_ctes(b, enriched=False)
    seg = E + [segments_cte()]
    an = seg + anomaly_ctes()
    out: dict[str, str] = {}
    out["enrich_buckets"] = q(E, "SELECT transaction_id, week_number, hour_of_day, amount_usd, amount_bucket, "
                                 "hour_bucket, period_half FROM enriched")
    out["weekly_trend"] = q(R + [trend_cte()], "SELECT * FROM trend")
    out["overall_kpi"] = q(R, "SELECT count(*) AS total_transactions, count(*) FILTER (WHERE status = 'approved') "
                              "AS approved_transactions, " + safe_rate("count(*) FILTER (WHERE status = 'approved')",
                                                                       "count(*)") + " AS approval_rate FROM raw")
    pat = Q.E_PATTERN if b == "E" else Q.L_PATTERN
    flags = {
        "hot_issuer": f"country = {s(pat['country'])} AND issuer_bank = {s(pat['issuer'])}",
        "high_value": f"amount_usd > {s(C.PATTERN_HIGH_VALUE_USD)}",
        "evening": f"hour_of_day >= {C.PATTERN_EVENING_HOUR}",
    }
    cols = ["count(*) AS total", "count(*) FILTER (WHERE status = 'approved') AS approved"]
    rates = ["CAST(approved AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0) AS approval_rate"]
    for k, cond in flags.items():
        cols += [f"count(*) FILTER (WHERE {cond}) AS {k}_total",
                 f"count(*) FILTER (WHERE ({cond}) AND status = 'approved') AS {k}_approved"]
        rates.append(f"CAST({k}_approved AS DOUBLE) / NULLIF(CAST({k}_total AS DOUBLE), 0) AS {k}_rate")
    out["pattern_audit"] = q(R + [f"pa AS (SELECT week_number, {', '.join(cols)} FROM raw GROUP BY week_number)"],
                             f"SELECT *, {', '.join(rates)} FROM pa")
    out["half_period_rate"] = q(R, f"SELECT {half_sql()} AS period_half, count(*) AS total, "
                                   "avg(CASE WHEN status = 'approved' THEN 1.0 ELSE 0.0 END) AS approval_rate "
                                   "FROM raw WHERE week_number IS NOT NULL GROUP BY 1")
    out["segments_all"] = q(seg, "SELECT * FROM seg")
    out["declined_reason_segments"] = q(E + [segments_cte(definitions={})], "SELECT * FROM seg")
    dedup = []
    for h in (B_HALF, C_HALF):
        dedup.append(_dedup(h, "d_" + h, "seg"))
    out["segment_dedup"] = q(seg + dedup, " UNION ALL ".join(
        f"SELECT segment_key, segment_type, '{h}' AS period, d_{h}_total AS total_transactions, "
        f"d_{h}_rate AS approval_rate FROM d_{h}" for h in (B_HALF, C_HALF)))
    ticket = "CASE WHEN current_total > 0 THEN current_amount_usd / CAST(current_total AS DOUBLE) ELSE 0.0 END"
    out["period_join"] = q(seg + compare_ctes(), (
        "SELECT segment_key, segment_type, baseline_rate, baseline_approved, baseline_total, current_rate, "
        f"current_approved, current_total, rate_change, {r6(ticket)} AS avg_ticket_usd, "
        f"{r6(f'((CAST(current_total AS DOUBLE) / {s(float(C.WEEKS_PER_PERIOD))}) * ({ticket}) * abs(rate_change) * {s(C.WEEKS_PER_MONTH)})')}"
        f" AS {IMPACT} FROM cmp"))
    out["zscore"] = q(an, "SELECT segment_key, rate_change, round(z_score, 6) AS z_score FROM an")
    out["ztest_pvalue"] = q(seg + compare_ctes() + pvalue_ctes("cmp"),
                            "SELECT segment_key, baseline_approved, baseline_total, current_approved, current_total, "
                            "round(p_value, 6) AS p_value FROM pv")
    out["anomalies"] = q(an, f"SELECT {ANOMALY_COLS} FROM an")
    out["anomalies_excl_artefacts"] = q(seg + anomaly_ctes(exclude=("time_weekly", "decline_reason",
                                                                     "country_decline_reason")),
                                        f"SELECT {ANOMALY_COLS} FROM an")
    out["anomaly_fallback"] = q(an + candidate_ctes(Q.FALLBACK_MIN_N), f"SELECT {ANOMALY_COLS} FROM cand")
    sc = an + candidate_ctes() + score_ctes()
    out["insight_scores"] = q(sc, "SELECT segment_key, segment_type, category, specificity, "
                                  "round(impact_norm, 6) AS impact_norm, round(magnitude_norm, 6) AS magnitude_norm, "
                                  "round(significance_norm, 6) AS significance_norm, round(score, 6) AS score FROM sc")
    out["diverse_topk"] = q(sc + topk_ctes(), "SELECT rank, segment_key, segment_type, category, is_best, "
                                              "round(score, 6) AS score FROM rk")
    ins = insight_ctes(b)
    out["insights"] = q(ins, f"SELECT {INSIGHT_COLS} FROM ins")
    out["insight_text"] = q(an + candidate_ctes(), f"SELECT segment_key, {title_sql()} AS title, "
                                                   f"{description_sql()} AS description, {severity_sql()} AS severity "
                                                   "FROM cand")
    out["severity_counts"] = q(ins, "SELECT severity, count(*) AS n FROM ins GROUP BY severity")
    out["summary"] = q(ins, (
        "SELECT round(avg(baseline_rate), 4) AS overall_baseline_rate, round(avg(current_rate), 4) AS overall_current_rate, "
        "round(avg(current_rate) - avg(baseline_rate), 4) AS total_rate_change, "
        f"round(COALESCE((SELECT sum({IMPACT}) FROM ins), 0.0), 2) AS total_monthly_revenue_impact_usd, "
        "count(*) FILTER (WHERE is_anomaly) AS anomalies_detected, "
        + ", ".join(f"(SELECT count(*) FROM ins WHERE severity = '{sv}') AS {sv}_insights"
                    for sv in ("critical", "high", "medium", "low"))
        + ", round(CAST(sum(baseline_approved) AS DOUBLE) / NULLIF(sum(baseline_total), 0), 4) AS weighted_baseline_rate"
          ", round(CAST(sum(current_approved) AS DOUBLE) / NULLIF(sum(current_total), 0), 4) AS weighted_current_rate"
        + " FROM an"))
    out["summary_json"] = ("SELECT * EXCLUDE (weighted_baseline_rate, weighted_current_rate), TRUE AS utc_stamp FROM ("
                           + out["summary"] + ")")
    # cohorts
    ft = f"""ftr AS (
  SELECT week_number, status,
         CASE WHEN timestamp IS NOT NULL AND row_number() OVER (PARTITION BY customer_id
              ORDER BY timestamp ASC NULLS LAST, transaction_id) = 1 THEN 'first_time' ELSE 'returning' END AS ct
  FROM raw)"""
    fta = """fta AS (
  SELECT week_number, count(*) FILTER (WHERE ct = 'first_time') AS ft_n,
         count(*) FILTER (WHERE ct = 'first_time' AND status = 'approved') AS ft_ok,
         count(*) FILTER (WHERE ct = 'returning') AS re_n,
         count(*) FILTER (WHERE ct = 'returning' AND status = 'approved') AS re_ok
  FROM ftr GROUP BY week_number)"""
    out["first_time_vs_returning"] = q(R + [ft, fta], (
        f"SELECT week_number AS week, {ratio4('ft_ok', 'ft_n')} AS first_time_rate, ft_n AS first_time_n, "
        f"{ratio4('re_ok', 're_n')} AS returning_rate, re_n AS returning_n FROM fta"))
    rec = "COALESCE(is_recurring, FALSE)"
    out["recurring_vs_onetime"] = q(R + [f"""rv AS (
  SELECT week_number, count(*) FILTER (WHERE {rec}) AS rn, count(*) FILTER (WHERE {rec} AND status = 'approved') AS ra,
         count(*) FILTER (WHERE NOT {rec}) AS onn, count(*) FILTER (WHERE NOT {rec} AND status = 'approved') AS oa
  FROM raw GROUP BY week_number)"""], (
        f"SELECT week_number AS week, {ratio4('ra', 'rn')} AS recurring_rate, rn AS recurring_n, "
        f"{ratio4('oa', 'onn')} AS onetime_rate, onn AS onetime_n FROM rv"))
    acq = [f"""fw AS (
  SELECT customer_id, week_number AS cohort_week FROM (
    SELECT customer_id, week_number, row_number() OVER (PARTITION BY customer_id
           ORDER BY timestamp ASC NULLS FIRST, transaction_id) AS rn FROM raw WHERE customer_id IS NOT NULL)
  WHERE rn = 1)""", f"""acq AS (
  SELECT fw.cohort_week, r.week_number AS transaction_week,
         {ratio4("count(*) FILTER (WHERE r.status = 'approved')", 'count(*)')} AS approval_rate,
         count(DISTINCT r.customer_id) + max(CASE WHEN r.customer_id IS NULL THEN 1 ELSE 0 END) AS n_customers,
         count(*) AS n_transactions
  FROM raw r LEFT JOIN fw ON r.customer_id = fw.customer_id GROUP BY 1, 2)"""]
    out["acquisition_cohorts"] = q(R + acq, "SELECT * FROM acq")
    out["customer_type_tags"] = q(R, (
        "SELECT transaction_id, customer_id, week_number, CASE WHEN timestamp IS NOT NULL AND row_number() OVER "
        "(PARTITION BY customer_id ORDER BY timestamp ASC NULLS LAST, transaction_id) = 1 "
        "THEN 'first_time' ELSE 'returning' END AS customer_type FROM raw"))
    out["weekly_trend_from_cube"] = out["weekly_trend"]
    out["cohort_matrix"] = q(R + acq, "SELECT cohort_week, " + ", ".join(
        f"max(CASE WHEN transaction_week = {w} THEN approval_rate END) AS w{w}" for w in range(1, 7))
        + " FROM acq GROUP BY cohort_week")
    # views
    out["headline_trend"] = q(R + [trend_cte()], (
        f"SELECT week_number, total_transactions, approval_rate, {band_sql('approval_rate')} AS rate_band, "
        f"{s(C.TARGET_THRESHOLD)} AS target_rate, approval_rate < {s(C.TARGET_THRESHOLD)} AS below_target, "
        f"COALESCE(week_number = {C.INFLECTION_WEEK}, FALSE) AS is_inflection FROM trend"))
    out["country_breakdown"] = q(seg + [f"""cb AS (
  SELECT dimension_1 AS country, max(CASE WHEN period = '{B_HALF}' THEN approval_rate END) AS e,
         max(CASE WHEN period = '{C_HALF}' THEN approval_rate END) AS l
  FROM seg WHERE segment_type = 'country' AND period IN ('{B_HALF}', '{C_HALF}') GROUP BY dimension_1)"""], (
        "SELECT country, COALESCE(e, 0.0) AS early_rate, COALESCE(l, 0.0) AS late_rate, "
        "round((COALESCE(e, 0.0) - COALESCE(l, 0.0)) * 100.0, 6) AS drop_pp, "
        f"{band_sql('COALESCE(l, 0.0)')} AS late_band, "
        "(row_number() OVER (ORDER BY (l IS NULL), l ASC NULLS FIRST, country ASC NULLS FIRST) = 1) "
        "AND (COALESCE(e, 0.0) - COALESCE(l, 0.0)) * 100.0 > 0 AS is_worst FROM cb"))
    # the events span six periods, the line items the seven years 1995 to 2001
    weeks = [f"week_{w}" for w in range(1, 7 if b == "E" else 8)]
    out["issuer_heatmap"] = q(seg, (
        "SELECT segment_key, dimension_1 AS country, dimension_2 AS issuer_bank, " + ", ".join(
            f"COALESCE(max(CASE WHEN period = '{p}' THEN approval_rate END), 0.0) AS {p}" for p in weeks)
        + f" FROM seg WHERE segment_type = 'issuer' AND period IN ({', '.join(s(p) for p in weeks)}) GROUP BY 1, 2, 3"))
    factor = (f"CASE WHEN {flags['hot_issuer']} THEN 'hot_issuer' WHEN {flags['high_value']} THEN 'high_value' "
              f"WHEN {flags['evening']} THEN 'evening' ELSE 'other' END")
    wf = [f"""wf0 AS (
  SELECT {factor} AS factor,
         count(*) FILTER (WHERE period_half = '{B_HALF}') AS nb,
         count(*) FILTER (WHERE period_half = '{B_HALF}' AND status = 'approved') AS ab,
         count(*) FILTER (WHERE period_half = '{C_HALF}') AS nc,
         count(*) FILTER (WHERE period_half = '{C_HALF}' AND status = 'approved') AS ac
  FROM enriched GROUP BY 1)""", f"""wft AS (SELECT sum(nb) AS tnb, sum(ab) AS tab, sum(nc) AS tnc, sum(ac) AS tac FROM wf0)""",
          f"""wf1 AS (
  SELECT factor, {safe_rate('nb', '(SELECT tnb FROM wft)')} AS wb, {safe_rate('nc', '(SELECT tnc FROM wft)')} AS wc,
         {safe_rate('ab', 'nb')} AS rb, {safe_rate('ac', 'nc')} AS rc,
         (SELECT {safe_rate('tab', 'tnb')} FROM wft) AS rball, (SELECT {safe_rate('tac', 'tnc')} FROM wft) AS rcall
  FROM wf0)"""]
    steps = " ".join(f"WHEN '{f}' THEN {i + 1}" for i, f in enumerate(("hot_issuer", "high_value", "evening", "other")))
    out["waterfall"] = q(E + wf, (
        f"SELECT CAST(CASE factor {steps} END AS INTEGER) AS step, factor, 'relative' AS measure, "
        "round(((wb + wc) / 2 * (rc - rb) + (wc - wb) * ((rb + rc) / 2 - (rball + rcall) / 2)) * 100.0, 6) "
        "AS contribution_pp FROM wf1 UNION ALL "
        f"SELECT 0, 'Baseline', 'absolute', round((SELECT {safe_rate('tab', 'tnb')} FROM wft) * 100.0, 6) UNION ALL "
        f"SELECT 5, 'Current', 'total', round((SELECT {safe_rate('tac', 'tnc')} FROM wft) * 100.0, 6)"))
    out["amount_box"] = q(E, (
        "SELECT period_half, status, count(amount_usd) AS n, min(amount_usd) AS min, "
        "round(quantile_cont(amount_usd, 0.25), 6) AS q1, round(quantile_cont(amount_usd, 0.5), 6) AS median, "
        "round(quantile_cont(amount_usd, 0.75), 6) AS q3, max(amount_usd) AS max, round(avg(amount_usd), 6) AS mean "
        "FROM enriched GROUP BY period_half, status"))
    out["hourly_pattern"] = q(E, (
        "SELECT hour_of_day, period_half, count(*) AS total_transactions, "
        "count(*) FILTER (WHERE status = 'approved') AS approved_transactions, "
        + safe_rate("count(*) FILTER (WHERE status = 'approved')", "count(*)")
        + " AS approval_rate FROM enriched GROUP BY hour_of_day, period_half"))
    kp = ("kp AS (SELECT arg_max(approval_rate, week_number) AS current_rate, "
          "arg_min(approval_rate, week_number) AS baseline_rate FROM trend)")
    tot = f"COALESCE((SELECT sum({IMPACT}) FROM ins), 0.0)"
    out["kpi_row"] = q(ins + [trend_cte(), kp], (
        "SELECT current_rate, baseline_rate, "
        "CAST(CAST(round((current_rate - baseline_rate) * 100.0 * CAST(1.0 AS DOUBLE)) AS BIGINT) AS INTEGER) AS decline_pp, "
        f"round({tot}, 6) AS total_impact_usd, "
        f"{fixed('current_rate * 100.0', 0)} || '%' AS current_text, {fixed('baseline_rate * 100.0', 0)} || '%' AS baseline_text, "
        f"{fixed('(current_rate - baseline_rate) * 100.0', 0, plus=True)} || 'pp' AS decline_text, "
        f"'~$' || {fixed(f'{tot} / 1000000.0', 1)} || 'M' AS impact_text FROM kp"))
    out["insight_cards"] = q(ins + [f"top AS (SELECT * FROM ins ORDER BY rank LIMIT {C.MAX_CARDS})"], (
        "SELECT rank, severity, upper(severity) AS badge, title, "
        f"{fixed('baseline_rate * 100.0', 0)} || '% -> ' || {fixed('current_rate * 100.0', 0)} || '% (' || "
        f"{fixed('rate_change * 100.0', 0, plus=True)} || 'pp)' AS metric_text, "
        f"'Est. impact: $' || {fixed(f'{IMPACT} / 1000.0', 0)} || 'K/month | ' || format('{{:,}}', affected_transactions)"
        " || ' txns affected' AS impact_text FROM top"))
    out["hourly_daily_rates"] = q(R, " UNION ALL ".join(
        f"SELECT strftime(date_trunc('{u}', timestamp), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS total_transactions, "
        f"count(*) FILTER (WHERE status = 'approved') AS approved_transactions, "
        f"{safe_rate(APPROVED_N, 'count(*)')} "
        f"AS approval_rate, '{u}' AS granularity FROM raw GROUP BY 1" for u in ("hour", "day")))
    dims = Q.RISK_DIMS
    joins = " AND ".join(f"cur.{d} IS NOT DISTINCT FROM hist.{d}" for d in dims)
    out["risk_score"] = q(R + [
        f"rb AS (SELECT * FROM raw WHERE {half_sql()} = '{B_HALF}')",
        f"prior AS (SELECT {safe_rate(APPROVED_N, 'count(*)')} AS p FROM rb)",
        f"hist AS (SELECT {', '.join(dims)}, count(*) AS hist_n, count(*) FILTER (WHERE status = 'approved') "
        f"AS hist_approved FROM rb GROUP BY {', '.join(dims)})",
        f"cur AS (SELECT * FROM raw WHERE {half_sql()} = '{C_HALF}')",
        f"""rs AS (SELECT cur.transaction_id, {', '.join('cur.' + d for d in dims)},
         COALESCE(hist.hist_n, 0) AS hist_n, COALESCE(hist.hist_approved, 0) AS hist_approved,
         (CAST(COALESCE(hist.hist_approved, 0) AS DOUBLE) + CAST(20.0 AS DOUBLE) * (SELECT p FROM prior))
           / (CAST(COALESCE(hist.hist_n, 0) AS DOUBLE) + CAST(20.0 AS DOUBLE)) AS ea
  FROM cur LEFT JOIN hist ON {joins})"""], (
        f"SELECT transaction_id, {', '.join(dims)}, hist_n, hist_approved, round(ea, 6) AS expected_approval, "
        "round(1.0 - ea, 6) AS risk_score FROM rs"))
    win_h, dimc = 6, "country"
    out["alert_windows"] = q(R + [
        f"aw0 AS (SELECT *, date_trunc('hour', timestamp) - to_hours(k) AS ws FROM raw, "
        f"(SELECT unnest(range(0, {win_h})) AS k) t WHERE timestamp IS NOT NULL)",
        f"aw AS (SELECT ws, {dimc}, count(*) AS total_transactions, count(*) FILTER (WHERE status = 'approved') "
        f"AS approved_transactions FROM aw0 GROUP BY ws, {dimc})"], (
        "SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, "
        f"strftime(ws + to_hours({win_h}), '%Y-%m-%d %H:%M:%S') AS window_end, {dimc}, total_transactions, "
        "approved_transactions, CAST(approved_transactions AS DOUBLE) / CAST(total_transactions AS DOUBLE) AS approval_rate "
        f"FROM aw WHERE CAST(approved_transactions AS DOUBLE) / CAST(total_transactions AS DOUBLE) < {s(0.6)} "
        f"AND total_transactions >= 5"))
    for layer, source in (("layer_raw", "weekly_trend"), ("layer_segments", "segments_all"),
                          ("layer_anomalies", "anomalies"), ("layer_view", "headline_trend"),
                          ("insights_json", "insights"), ("cohort_payload", "acquisition_cohorts")):
        out[layer] = out[source]
    out["sample_csv"] = q(R, "SELECT transaction_id, CAST(week_number AS VARCHAR) AS week_number, status, decline_reason "
                             "FROM raw ORDER BY timestamp, transaction_id LIMIT 100")
    whole = ("SELECT * REPLACE (strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp) FROM raw")
    out["layer_raw_rows"] = q(R, whole)
    out["sample_csv_all"] = q(R, whole + " ORDER BY raw.timestamp, transaction_id LIMIT 100")
    null = "CAST(NULL AS INTEGER)"
    out["cohort_payload_all"] = (
        "SELECT 'acquisition_cohorts' AS view, cohort_week, transaction_week AS week, 'all' AS kind, approval_rate AS rate, "
        f"n_transactions AS n, n_customers FROM ({out['acquisition_cohorts']})" + "".join(
            f" UNION ALL SELECT '{view}', {null}, week, '{kind}', {kind}_rate, {kind}_n, NULL FROM ({out[view]})"
            for view, kinds in (("first_time_vs_returning", ("first_time", "returning")),
                                ("recurring_vs_onetime", ("recurring", "onetime"))) for kind in kinds))
    out["segment_drill"] = q(E + [segments_cte(definitions={"drill": ["country", "hour_bucket"]}, declined_only={})],
                             "SELECT * FROM seg")
    out["anomalies_split2"] = q(base_ctes(b, split=2) + [segments_cte()] + anomaly_ctes(
        b_period="weeks_1_2", c_period="weeks_3_6"), f"SELECT {ANOMALY_COLS} FROM an")
    return out | new_rows(b, E, R, seg)


def oracle_sql() -> dict[str, str]:
    e = build("E")
    l_ = build("L")
    out = dict(e)
    # queries bound to E only
    E = base_ctes("E")
    fx = "fx AS (SELECT DISTINCT r_name AS country, fx_rate FROM geo)"
    out["fx_normalised"] = q(base_ctes("E", enriched=False) + [fx], (
        "SELECT transaction_id, raw.country, currency, amount_usd AS amount, fx.fx_rate, "
        "round(amount_usd * fx.fx_rate, 8) AS amount_usd_fx "
        "FROM raw LEFT JOIN fx ON raw.country = fx.country"))
    out["segment_drill_4d"] = q(E + [
        "src AS (SELECT * FROM enriched WHERE NOT COALESCE(is_recurring, FALSE))",
        segments_cte(src="src", definitions={"drill_4d": Q.DRILL_DIMS}, declined_only={})], "SELECT * FROM seg")
    for name in Q.L_VARIANTS:
        out[f"{name}_L"] = l_[name]
    return out
