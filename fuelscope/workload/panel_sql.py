"""SQL text of the daily panel and the features, for a CTE of observations."""

from __future__ import annotations

from ..operators.series import PULSE_WEIGHTS
from ..plans.model import RIDGE
from ..plans.panel import BASE_SIZE, DESIGN, NEEDED
from ..schema import DAILY_AVG, RBOB, RETAIL, RUNS, STOCKS, WTI
from .frames import ny

BY = "PARTITION BY region ORDER BY date"
PAST = f"({BY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
AHEAD = f"({BY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
WEEK = f"({BY} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"


def filled(x: str) -> str:
    return f"coalesce(last_value({x} IGNORE NULLS) OVER {PAST}, first_value({x} IGNORE NULLS) OVER {AHEAD})"


def ewm(x: str, span: int) -> str:
    """Exponential mean of a column without gaps: a fold over the whole past."""
    a = 2.0 / (span + 1)
    return f"list_reduce(list({x}) OVER {PAST}, lambda s, v: {1 - a!r} * s + {a!r} * v)"


def hampel_steps(least: int, tag: str) -> str:
    med = ", ".join(
        f"CASE WHEN count({c}) OVER {WEEK} >= {least} THEN median({c}) OVER {WEEK} END AS m_{c}" for c in ("rbob", "wti")
    )
    mad = ", ".join(
        f"CASE WHEN count(d_{c}) OVER {WEEK} >= {least} THEN median(d_{c}) OVER {WEEK} END AS q_{c}" for c in ("rbob", "wti")
    )
    fix = ", ".join(
        f"CASE WHEN d_{c} > 3.0 * 1.4826 * q_{c} THEN m_{c} ELSE {c} END AS {c}_{tag}" for c in ("rbob", "wti")
    )
    return f"""h{tag}1 AS (SELECT region, date, rbob, wti, {med} FROM p1),
    h{tag}2 AS (SELECT *, abs(rbob - m_rbob) AS d_rbob, abs(wti - m_wti) AS d_wti FROM h{tag}1),
    h{tag}3 AS (SELECT *, {mad} FROM h{tag}2),
    h{tag} AS (SELECT region, date, {fix} FROM h{tag}3)"""


def panel(src: str) -> str:
    label = ny("CAST(label_ts AS TIMESTAMP)")
    pick = ", ".join(
        f"max(v) FILTER (source = '{s}') AS {c}"
        for s, c in ((DAILY_AVG, "aaa"), (RETAIL, "gb"), (RBOB, "rb"), (WTI, "wt"), (STOCKS, "ss"), (RUNS, "rr"))
    )
    return f"""pm AS (SELECT region, source, CASE WHEN source = '{DAILY_AVG}' THEN day - 1 ELSE day END AS date, avg(price) AS v
        FROM {src} WHERE source IN ('{RETAIL}', '{DAILY_AVG}', '{RBOB}', '{WTI}') GROUP BY ALL),
    pw AS (SELECT region, source, date, v FROM (SELECT region, source, CAST({label} AS DATE) AS date,
            CASE WHEN source = '{STOCKS}' THEN surprise ELSE price END AS v, scraped_at, seq
            FROM {src} WHERE source IN ('{STOCKS}', '{RUNS}'))
        QUALIFY row_number() OVER (PARTITION BY region, source, date ORDER BY scraped_at, seq) = 1),
    ps AS (SELECT region, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM pm GROUP BY region),
    pv AS (SELECT region, date, {pick} FROM (SELECT * FROM pm UNION ALL SELECT * FROM pw) GROUP BY region, date),
    p0 AS (SELECT ps.region, ps.date, aaa, gb, rb, wt, ss, rr FROM ps LEFT JOIN pv USING (region, date)),
    p1 AS (SELECT region, date, aaa, gb, {filled('rb')} AS rbob, {filled('wt')} AS wti,
        last_value(ss IGNORE NULLS) OVER {PAST} AS stocks_surprise, last_value(rr IGNORE NULLS) OVER {PAST} AS refinery_runs,
        {filled('coalesce(aaa, gb)')} AS gas_price, coalesce(gb - aaa, 0.0) AS GB_gap FROM p0),
    {hampel_steps(3, 'a')},
    panel AS (SELECT p1.*, {ewm('rbob_a', 3).replace('region', 'p1.region').replace('date', 'p1.date')} AS rbob_sm,
        {ewm('wti_a', 3).replace('region', 'p1.region').replace('date', 'p1.date')} AS wti_sm FROM p1 JOIN ha USING (region, date))"""


def features(src: str) -> str:
    def lag(x: str, n: int) -> str:
        return f"lag({x}, {n}) OVER ({BY})"

    def pulse(x: str) -> str:
        return " + ".join(
            f"{w} * coalesce({lag(x, i) if i else x}, 0)" for i, w in enumerate(PULSE_WEIGHTS)
        )

    return f"""{panel(src)}, {hampel_steps(1, 'b')},
    f0 AS (SELECT * EXCLUDE (wti_sm, rbob_b, wti_b), coalesce(aaa, gas_price) AS Y, {ewm('rbob_b', 5)} AS rb_sm, {ewm('wti_b', 5)} AS wti_sm,
        {ewm('coalesce(aaa, gas_price)', 2)} AS ye FROM panel JOIN hb USING (region, date)),
    f1 AS (SELECT *, tanh((ye - {lag('ye', 7)}) / 7.0 / 0.03) * 0.03 AS AAA_slope7, {lag('Y', 1)} AS AAA_l1,
        {lag('rb_sm * 42.0', 7)} AS rb42_l7, {lag('wti_sm', 7)} AS wti_l7, {lag('rb_sm * 42.0 - wti_sm', 7)} AS crack_l7,
        {pulse('stocks_surprise')} AS stocks_pulse, {pulse('refinery_runs')} AS refinery_pulse FROM f0),
    feats AS (SELECT *, crack_l7 - {lag('crack_l7', 7)} AS d_crack7 FROM f1)"""


def fit(src: str) -> str:
    needed = " AND ".join(f"{c} IS NOT NULL" for c in NEEDED)
    return f"""{features(src)},
    t0 AS (SELECT * REPLACE (coalesce(crack_l7, 0) AS crack_l7, coalesce(d_crack7, 0) AS d_crack7), 1.0 AS one,
        FROM feats WHERE {needed}),
    t1 AS (SELECT t0.* FROM t0 JOIN (SELECT region, max(date) - 180 AS since FROM feats GROUP BY region) USING (region) WHERE date >= since),
    fit AS (SELECT *, exp(-ln(2.0) / 90 * date_diff('day', date, max(date) OVER (PARTITION BY region))) AS w FROM t1)"""


def gram(src: str) -> str:
    sums = []
    for i, a in enumerate(DESIGN):
        sums.append(f"round(sum(w * {a} * Y), 6) AS b_{i}")
        sums += [f"round(sum(w * {a} * {DESIGN[j]}), 6) AS g_{i}_{j}" for j in range(i, len(DESIGN))]
    return f"{fit(src)} SELECT region, count(*) AS n, {', '.join(sums)} FROM fit GROUP BY region"


# Forecast starts: one row per region.
STARTS = """e0 AS (SELECT region, max(date) AS last_date, coalesce(max(date) FILTER (aaa IS NOT NULL), max(date)) AS last_aaa_date,
        arg_max(coalesce(rb_sm * 42.0 - wti_sm, 'nan'), date) AS crack_now, arg_max(stocks_pulse, date) AS stocks_now,
        arg_max(refinery_pulse, date) AS refinery_now, count(aaa) > 0 AS has_aaa FROM feats GROUP BY region),
    e1 AS (SELECT f.region, f.date, CASE WHEN has_aaa THEN aaa ELSE Y END AS s FROM feats f JOIN e0 USING (region)),
    e2 AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY date DESC) AS rn FROM e1 WHERE s IS NOT NULL),
    e3 AS (SELECT region, max(s) FILTER (rn = 1) AS last_value, coalesce((max(s) FILTER (rn = 1) - max(s) FILTER (rn = 7)) / 7.0, 0) AS slope0 FROM e2 GROUP BY region),
    starts AS (SELECT e0.region, last_date, last_aaa_date, last_day(last_aaa_date + 1) AS month_end,
        greatest(7, date_diff('day', last_aaa_date + 1, last_day(last_aaa_date + 1)) + 1) AS days, last_value, slope0, coalesce(f.GB_gap, 0) AS gap_once,
        crack_now, stocks_now, refinery_now FROM e0 JOIN e3 USING (region) LEFT JOIN feats f ON f.region = e0.region AND f.date = e0.last_aaa_date),
    ahead AS (SELECT *, last_aaa_date + h AS date FROM (SELECT *, CAST(unnest(range(1, days + 1)) AS INTEGER) AS h FROM starts))"""

FALLBACK = f"""{STARTS}, forecast AS (SELECT region, date, h, last_value + slope0 * power(0.7, h - 1) AS yhat FROM ahead)"""

RESIDUALS = """r0 AS (SELECT region, date, Y - lag(Y) OVER (PARTITION BY region ORDER BY date) AS resid FROM feats),
    resid AS (SELECT * FROM r0 WHERE resid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY region ORDER BY date DESC) <= 60)"""

POINTS = """q0 AS (SELECT f.*, last_date, month_end, CAST(last_date + CAST(7 - (isodow(last_date) % 7) AS INTEGER) AS DATE) AS next_sunday FROM forecast f JOIN starts USING (region)),
    points AS (SELECT region, next_sunday, coalesce(max(yhat) FILTER (date = next_sunday), max(yhat) FILTER (h = 7)) AS next_sunday_point,
        month_end, max(yhat) FILTER (date = month_end) AS eom_point FROM q0 GROUP BY region, next_sunday, month_end)"""


def elimination(name: str, size: int) -> str:
    """Gauss-Jordan steps over one nested list per region; the penalty keeps the
    pivots away from zero."""
    rows = []
    for i in range(size):
        cells = [
            f"sum(w * {DESIGN[i]} * {DESIGN[j]})" + (f" + {RIDGE}" if i == j and i > 0 else "") for j in range(size)
        ]
        rows.append("[" + ", ".join([*cells, f"sum(w * {DESIGN[i]} * Y)"]) + "]")
    return f"""{name}0 AS (SELECT region, 1 AS k, [{", ".join(rows)}] AS a FROM fit GROUP BY region
        UNION ALL SELECT region, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN p ELSE list_transform(r, lambda x, j: x - r[k] * p[j]) END)
        FROM (SELECT region, k, a, list_transform(a[k], lambda x: x / a[k][k]) AS p FROM {name}0 WHERE k <= {size})),
    {name} AS (SELECT region, list_transform(a, lambda r: r[{size + 1}]) AS beta FROM {name}0 WHERE k = {size + 1})"""


def predicted(beta: str, size: int) -> str:
    return " + ".join(f"{beta}[{i + 1}] * {DESIGN[i]}" for i in range(size))


def chosen(src: str) -> str:
    """Both fits, their errors over the tail, and the coefficients of the winner."""
    return f"""{fit(src)}, {elimination('small', BASE_SIZE)}, {elimination('whole', len(DESIGN))},
    judged AS (SELECT fit.region, abs(Y - ({predicted('s.beta', BASE_SIZE)})) AS es, abs(Y - ({predicted('l.beta', len(DESIGN))})) AS el,
        row_number() OVER (PARTITION BY fit.region ORDER BY date) - 1 AS i, floor(count(*) OVER (PARTITION BY fit.region) * 0.8) AS cut
        FROM fit JOIN small s USING (region) JOIN whole l USING (region)),
    errors AS (SELECT region, avg(es) AS mae_base, avg(el) AS mae_aug FROM judged WHERE i >= cut GROUP BY region),
    chosen AS (SELECT e.region, mae_base, mae_aug, mae_aug <= mae_base * 0.97 AS use_pulses,
        CASE WHEN mae_aug <= mae_base * 0.97 THEN l.beta ELSE list_concat(s.beta, [0.0, 0.0]) END AS beta, l.beta AS b_aug
        FROM errors e JOIN small s USING (region) JOIN whole l USING (region))"""


def recursion(b: list[str]) -> str:
    """Steps c and the recursion y over the days ahead, for coefficients ``b`` that
    may refer to ``chosen``."""
    return f"""l AS (SELECT region, arg_max(rb_sm, date) AS rl, arg_max(wti_sm, date) AS wl FROM feats GROUP BY region),
    c AS (SELECT a.region, a.date, a.h, last_value, {b[1]} AS carry, {b[0]} + {b[2]} * slope0 * power(0.7, h - 1) + {b[3]} * 42.0 * coalesce(f.rb_sm, rl)
        + {b[4]} * coalesce(f.wti_sm, wl) + {b[5]} * crack_now + {b[7]} * CASE WHEN h = 1 THEN gap_once ELSE 0 END
        + {b[8]} * stocks_now + {b[9]} * refinery_now AS c
        FROM ahead a JOIN l USING (region) JOIN chosen USING (region) LEFT JOIN feats f ON f.region = a.region AND f.date = a.date - 7),
    y AS (SELECT region, date, h, c + carry * last_value AS yhat FROM c WHERE h = 1
        UNION ALL SELECT c.region, c.date, c.h, c.c + c.carry * y.yhat FROM y JOIN c ON c.region = y.region AND c.h = y.h + 1)"""
