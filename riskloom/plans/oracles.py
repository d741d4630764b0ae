"""SQL twins of the registered queries, for a second engine on the same tables."""

from __future__ import annotations

from riskloom.constants import (
    DRIFT_FEATURES,
    FEATURE_TEXT,
    MODEL_FEATURES,
    SCORING_BUCKETS,
)
from riskloom.functions.statistics import ERFC
from riskloom.operators.quality import FEATURE_REQUIRED, RAW_REQUIRED
from riskloom.plans.queries import DRIFT_MOMENT, IMPORTANCES

TXN = """
a AS (
  SELECT event_id AS transaction_id, user_id, ts AS event_time, epoch_us(ts) AS us, value AS amount,
         CAST(round(value*100) AS BIGINT) AS cents, CAST(json_extract_string(props,'$.k') AS INT) AS k, event_type FROM events),
b AS (
  SELECT *, CASE event_type WHEN 'click' THEN 'POS' WHEN 'view' THEN 'POS' WHEN 'purchase' THEN 'ECOM'
                            WHEN 'signup' THEN 'ATM' ELSE 'OTHER' END AS channel,
         user_id % 9 AS home, CASE WHEN k < 80 THEN user_id % 9 ELSE CAST(k % 9 AS BIGINT) END AS country, k AS merchant_id FROM a),
txn AS (
  SELECT *, CASE WHEN channel='POS' THEN NULL ELSE k % 10 END AS device_id,
         CASE WHEN k % 20 = 0 THEN NULL
              ELSE amount >= 150 OR (channel='ECOM' AND country<>home AND amount>=50) END AS label,
         least(0.99e0, floor((amount/250e0 + CASE WHEN country<>home THEN 0.2e0 ELSE 0e0 END)*1000)/1000e0) AS score,
         5 + transaction_id % 97 AS latency_ms FROM b)
"""

FEATURES = (
    TXN
    + """
, runs AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, country ORDER BY us, transaction_id) AS nth,
    row_number() OVER (PARTITION BY user_id ORDER BY us, transaction_id) AS pos FROM txn)
, w AS (
  SELECT *, count(*) OVER h1 AS c1, count(*) OVER d1 AS c24, count(*) OVER d7 AS c7,
    coalesce(sum(cents) OVER h1, 0) AS s1, coalesce(sum(cents) OVER d1, 0) AS s24,
    count(*) OVER d30 AS n, sum(cents) OVER d30 AS sm, sum(cents*cents) OVER d30 AS sq,
    count(DISTINCT country) OVER d1 AS uc, count(DISTINCT merchant_id) OVER d1 AS um, count(DISTINCT device_id) OVER d1 AS ud,
    lag(us) OVER o AS lus, lag(country) OVER o AS lc, lag(device_id) OVER o AS ld,
    row_number() OVER (PARTITION BY user_id, merchant_id ORDER BY us, transaction_id) AS rn,
    arg_max(country, nth*1000000 - pos) OVER (PARTITION BY user_id ORDER BY us, transaction_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS home_country
  FROM runs
  WINDOW o   AS (PARTITION BY user_id ORDER BY us, transaction_id),
         h1  AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING),
         d1  AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING),
         d7  AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING),
         d30 AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 2592000000000 PRECEDING AND 1 PRECEDING))
, feat AS (
SELECT transaction_id, user_id, event_time, us, amount, channel, country, label, score, latency_ms, home_country,
  CAST(c1 AS INT) AS user_txn_count_1h, CAST(c24 AS INT) AS user_txn_count_24h, CAST(c7 AS INT) AS user_txn_count_7d,
  CAST(s1 AS DOUBLE)/100 AS user_amount_sum_1h, CAST(s24 AS DOUBLE)/100 AS user_amount_sum_24h,
  CASE WHEN n>=2 AND sm<>0 THEN CAST((2*sm+n) // (2*n) AS DOUBLE)/100 END AS user_avg_amount_30d,
  CASE WHEN n>=2 AND n*sq>sm*sm THEN floor(sqrt(CAST(n*sq-sm*sm AS DOUBLE))/n+0.5e0)/100e0 END AS user_std_amount_30d,
  CASE WHEN n>=2 AND n*sq>sm*sm
       THEN floor((n*cents-sm)/sqrt(CAST(n*sq-sm*sm AS DOUBLE))*10000+0.5e0)/10000e0 END AS amount_zscore,
  coalesce(lc<>country, false) AS country_change_flag, coalesce(ld<>device_id, false) AS device_change_flag,
  CAST(uc AS INT) AS unique_countries_24h, CAST(um AS INT) AS unique_merchants_24h, CAST(ud AS INT) AS unique_devices_24h,
  rn=1 AS user_merchant_first_time, CASE WHEN lus IS NOT NULL THEN least((us-lus) // 60000000, 10080) END AS minutes_since_last_txn,
  country <> home_country AS is_foreign_txn,
  CAST(hour(event_time) AS INT) AS hour_of_day, CAST(isodow(event_time)-1 AS INT) AS day_of_week,
  isodow(event_time) >= 6 AS is_weekend, hour(event_time) < 6 AS is_night,
  CASE channel WHEN 'POS' THEN 0 WHEN 'ECOM' THEN 1 WHEN 'ATM' THEN 2 ELSE -1 END AS channel_encoded
FROM w)
"""
)

HISTORY = [
    "amount_zscore", "user_txn_count_1h", "user_txn_count_24h", "user_txn_count_7d",
    "user_amount_sum_1h", "user_amount_sum_24h", "user_avg_amount_30d", "user_std_amount_30d",
    "country_change_flag", "device_change_flag", "unique_countries_24h", "unique_merchants_24h",
    "unique_devices_24h", "user_merchant_first_time", "minutes_since_last_txn", "is_foreign_txn",
]
CALENDAR = ["hour_of_day", "day_of_week", "is_weekend", "is_night"]

DECISION = "CASE WHEN score >= 0.7e0 THEN 'BLOCK' WHEN score >= 0.3e0 THEN 'REVIEW' ELSE 'APPROVE' END"

SPLIT = (
    TXN
    + """
, lab AS (SELECT * FROM txn WHERE label IS NOT NULL)
, numbered AS (SELECT *, row_number() OVER (ORDER BY us, transaction_id) - 1 AS r, CAST(count(*) OVER () AS DOUBLE) AS total FROM lab)
, split AS (SELECT *, CASE WHEN r >= floor(total*(0.70e0+0.15e0)) THEN 'test' WHEN r >= floor(total*0.70e0) THEN 'val' ELSE 'train' END AS split FROM numbered)
"""
)

ALERT_TABLE = (
    TXN
    + f"""
, decided AS (SELECT *, {DECISION} AS decision,
    CASE k % 5 WHEN 1 THEN 'CONFIRMED_FRAUD' WHEN 2 THEN 'FALSE_POSITIVE' WHEN 3 THEN 'PENDING' WHEN 4 THEN 'UNKNOWN' END AS resolution FROM txn)
, alerts AS (SELECT *, event_time AS created_at FROM decided WHERE decision <> 'APPROVE')
"""
)


def _scoring(source: str, features: bool) -> str:
    """The scoring defaults over a relation with or without history features."""
    given = (lambda c, d: f"coalesce({c}, {d})") if features else (lambda c, d: str(d))
    flag = (lambda c: f"coalesce(CAST({c} AS INT), 0)") if features else (lambda c: "0")
    defaults = {
        "amount": "amount",
        "amount_zscore": given("amount_zscore", "0e0"),
        "user_avg_amount_30d": given("user_avg_amount_30d", "amount"),
        "user_txn_count_1h": f"CAST({given('user_txn_count_1h', 0)} AS INT)",
        "user_txn_count_24h": f"CAST({given('user_txn_count_24h', 1)} AS INT)",
        "user_txn_count_7d": f"CAST({given('user_txn_count_7d', 1)} AS INT)",
        "user_amount_sum_1h": given("user_amount_sum_1h", "amount"),
        "user_amount_sum_24h": given("user_amount_sum_24h", "amount"),
        "country_change_flag": flag("country_change_flag"),
        "device_change_flag": flag("device_change_flag"),
        "unique_countries_24h": f"CAST({given('unique_countries_24h', 1)} AS INT)",
        "unique_merchants_24h": f"CAST({given('unique_merchants_24h', 1)} AS INT)",
        "user_merchant_first_time": flag("user_merchant_first_time"),
        "hour_of_day": "CAST(hour(event_time) AS INT)",
        "day_of_week": "CAST(isodow(event_time)-1 AS INT)",
        "is_weekend": "CAST(isodow(event_time) >= 6 AS INT)",
        "is_night": "CAST(hour(event_time) < 6 AS INT)",
        "minutes_since_last_txn": f"CAST({given('minutes_since_last_txn', 60)} AS INT)",
        "channel_encoded": "CASE upper(channel) WHEN 'ECOM' THEN 1 WHEN 'ATM' THEN 2 ELSE 0 END",
    }
    columns = ", ".join(f"{defaults[n]} AS {n}" for n in MODEL_FEATURES)
    return f"SELECT transaction_id, {columns} FROM {source}"


def _long(values: dict[str, str], source: str, extra: str = "") -> str:
    """(transaction_id, position, feature, value) for the model columns."""
    return " UNION ALL ".join(
        f"SELECT transaction_id{extra}, {i} AS position, '{n}' AS feature, CAST({n} AS DOUBLE) AS value, {e} AS text FROM {source}"
        for i, (n, e) in enumerate(values.items())
    )


def _texts() -> dict[str, str]:
    whole = lambda n: f"CAST(CAST({n} AS BIGINT) AS VARCHAR)"
    tenth = lambda e: f"printf('%.1f', floor(({e})*10e0+0.5e0)/10e0)"
    either = lambda n, yes, no: f"CASE WHEN {n} <> 0 THEN '{yes}' ELSE '{no}' END"
    out = {}
    for n in MODEL_FEATURES:
        label = FEATURE_TEXT[n].replace("'", "''")
        out[n] = f"'{label}: ' || CAST(CAST({n} AS DOUBLE) AS VARCHAR)"
    out["country_change_flag"] = either("country_change_flag", "Country changed from previous transaction", "Same country as previous")
    out["device_change_flag"] = either("device_change_flag", "Different device from previous transaction", "Same device as previous")
    out["user_merchant_first_time"] = either("user_merchant_first_time", "First time shopping at this merchant", "Known merchant")
    out["is_weekend"] = either("is_weekend", "Weekend transaction", "Weekday transaction")
    out["is_night"] = either("is_night", "Night-time transaction (midnight-6am)", "Daytime transaction")
    out["amount"] = "'Transaction amount: $' || format('{:,.2f}', floor(amount*100e0+0.5e0)/100e0)"
    z = "amount_zscore"
    out[z] = (
        f"CASE WHEN {z} > 3 THEN 'Amount is ' || {tenth(z)} || ' std devs above user average (very unusual)' "
        f"WHEN {z} > 2 THEN 'Amount is ' || {tenth(z)} || ' std devs above user average (unusual)' "
        f"WHEN {z} < -2 THEN 'Amount is ' || {tenth(f'abs({z})')} || ' std devs below user average' "
        f"ELSE 'Amount is typical for this user (z-score: ' || {tenth(z)} || ')' END"
    )
    c = "user_txn_count_1h"
    out[c] = f"CASE WHEN {c} > 5 THEN 'High velocity: ' || {whole(c)} || ' transactions in last hour' ELSE {whole(c)} || ' transaction(s) in last hour' END"
    out["user_txn_count_24h"] = f"{whole('user_txn_count_24h')} || ' transaction(s) in last 24 hours'"
    m = "minutes_since_last_txn"
    out[m] = (
        f"CASE WHEN {m} > 10000 THEN 'First transaction in a while' "
        f"WHEN {m} < 5 THEN 'Only ' || {whole(m)} || ' minutes since last transaction (rapid)' "
        f"ELSE {whole(m)} || ' minutes since last transaction' END"
    )
    u = "unique_countries_24h"
    out[u] = f"CASE WHEN {u} > 2 THEN 'Used in ' || {whole(u)} || ' different countries in 24h (suspicious)' ELSE 'Used in ' || {whole(u)} || ' country/countries in 24h' END"
    e = "channel_encoded"
    out[e] = f"'Transaction channel: ' || CASE {e} WHEN 0 THEN 'POS (in-store)' WHEN 1 THEN 'ECOM (online)' WHEN 2 THEN 'ATM' ELSE 'Channel ' || {whole(e)} END"
    out["hour_of_day"] = f"'Transaction at ' || lpad({whole('hour_of_day')}, 2, '0') || ':00'"
    return out


def _contributions() -> str:
    weights = " ".join(f"WHEN '{n}' THEN {w!r}e0" for n, w in IMPORTANCES.items())
    blank = {n: "NULL" for n in MODEL_FEATURES}
    return (
        FEATURES
        + f", inp AS ({_scoring('feat', True)})"
        + f", long AS ({_long(blank, 'inp')})"
        + f""", con AS (SELECT *, floor(CASE feature {weights} END * least(abs(value)/100e0, 1e0) * 10000e0 + 0.5e0)/10000e0 AS contribution FROM long)
, placed AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY contribution DESC, position) - 1 AS rank FROM con)
"""
    )


# --- evaluation ---------------------------------------------------------------------

def _curves(source: str, group: str) -> str:
    """Running counts by descending score; ``group`` is a list of columns or a constant."""
    return f"""
, g AS (SELECT {group} AS grp, score, count(*) FILTER (label) AS pos, count(*) FILTER (NOT label) AS neg
        FROM {source} WHERE label IS NOT NULL GROUP BY 1, 2)
, cum AS (SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, sum(pos) OVER p AS np, sum(neg) OVER p AS nn,
        lead(pos) OVER o AS npos, lead(neg) OVER o AS nneg, row_number() OVER o AS rn
        FROM g WINDOW o AS (PARTITION BY grp ORDER BY score DESC), p AS (PARTITION BY grp))
, corner AS (SELECT *, rn = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg AS kept FROM cum)
, met AS (SELECT grp,
    sum(CAST(neg AS DOUBLE)*(2*tp-pos))/(2e0*max(np)*max(nn)) AS roc_auc,
    sum(CAST(pos AS DOUBLE)*(CAST(tp AS DOUBLE)/(tp+fp) + CASE WHEN rn=1 THEN 1e0 ELSE CAST(tp-pos AS DOUBLE)/(tp-pos+fp-neg) END))/(2e0*max(np)) AS pr_auc,
    coalesce(max(CAST(tp AS DOUBLE)/np) FILTER (kept AND CAST(fp AS DOUBLE)/nn <= 0.01e0), 0e0) AS recall_at_1pct_fpr,
    coalesce(max(CAST(tp AS DOUBLE)/np) FILTER (kept AND CAST(fp AS DOUBLE)/nn <= 0.05e0), 0e0) AS recall_at_5pct_fpr,
    coalesce(max(CAST(tp AS DOUBLE)/np) FILTER (kept AND CAST(fp AS DOUBLE)/nn <= 0.10e0), 0e0) AS recall_at_10pct_fpr
  FROM corner GROUP BY grp)
"""


def _confusion(source: str, threshold: str, group: str) -> str:
    return f"""
, cnt AS (SELECT {group} AS grp,
    count(*) FILTER (label AND score >= {threshold}) AS tp, count(*) FILTER (NOT label AND score >= {threshold}) AS fp,
    count(*) FILTER (NOT label AND score < {threshold}) AS tn, count(*) FILTER (label AND score < {threshold}) AS fn
  FROM {source} WHERE label IS NOT NULL GROUP BY 1)
, conf AS (SELECT grp, tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
    CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0e0 END AS "precision",
    CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0e0 END AS recall,
    CASE WHEN 2*tp+fp+fn > 0 THEN CAST(2*tp AS DOUBLE)/(2*tp+fp+fn) ELSE 0e0 END AS f1,
    CASE WHEN fp+tn > 0 THEN CAST(fp AS DOUBLE)/(fp+tn) ELSE 0e0 END AS fpr,
    CASE WHEN fn+tp > 0 THEN CAST(fn AS DOUBLE)/(fn+tp) ELSE 0e0 END AS fnr FROM cnt)
"""


# --- drift -----------------------------------------------------------------------------

_DRIFT_DEFAULT = {"unique_countries_24h": "1", "unique_merchants_24h": "1", "hour_of_day": "12"}
_FLAGS = ["country_change_flag", "device_change_flag", "user_merchant_first_time", "is_weekend", "is_night", "label"]


def _drift_frame() -> str:
    parts = []
    for n in [*MODEL_FEATURES, "label"]:
        kind = "INT" if n in _FLAGS else "DOUBLE"
        parts.append(f"coalesce(CAST({n} AS {kind}), CAST({_DRIFT_DEFAULT.get(n, '0')} AS {kind})) AS {n}")
    return f", fr AS (SELECT transaction_id, event_time, us, {', '.join(parts)} FROM feat)"


_NAMES = ", ".join(DRIFT_FEATURES)


_MOMENT = f"epoch_us(TIMESTAMP '{DRIFT_MOMENT}')"


def _sets(reference_rows: int | None = None) -> str:
    if reference_rows is None:
        ends = f"""
, refr AS (SELECT * FROM fr WHERE us < {_MOMENT})
, curr AS (SELECT * FROM fr WHERE us >= {_MOMENT})"""
    else:
        ends = f"""
, refr AS (SELECT * FROM fr ORDER BY us, transaction_id LIMIT {reference_rows})
, curr AS (SELECT * FROM fr ORDER BY us DESC, transaction_id DESC LIMIT 1000)"""
    return (
        FEATURES
        + _drift_frame()
        + ends
        + f"""
, long AS (
  SELECT feature, value, false AS is_current FROM (UNPIVOT (SELECT {_NAMES} FROM refr) ON {_NAMES} INTO NAME feature VALUE value)
  UNION ALL
  SELECT feature, value, true FROM (UNPIVOT (SELECT {_NAMES} FROM curr) ON {_NAMES} INTO NAME feature VALUE value))
, edges AS (SELECT feature, CASE WHEN lo=hi THEN lo-0.5e0 ELSE lo END AS lo, CASE WHEN lo=hi THEN hi+0.5e0 ELSE hi END AS hi
  FROM (SELECT feature, min(value) AS lo, max(value) AS hi FROM long WHERE NOT is_current GROUP BY feature))
"""
    )


def _bin(value: str = "value") -> str:
    passed = " + ".join(f"CASE WHEN {value} >= lo + {i}*((hi-lo)/10e0) THEN 1 ELSE 0 END" for i in range(1, 10))
    return f"CASE WHEN {value} >= lo AND {value} <= hi THEN {passed} END"


def _psi_sum(r: str, n: str, c: str, m: str) -> str:
    rp = f"(CASE WHEN {r}=0 THEN 0.0001e0 ELSE CAST({r} AS DOUBLE)/{n} END)"
    cp = f"(CASE WHEN {c}=0 THEN 0.0001e0 ELSE CAST({c} AS DOUBLE)/{m} END)"
    return f"({cp}-{rp})*ln({cp}/{rp})"


PSI = f"""
, binned AS (SELECT long.feature, is_current, {_bin()} AS bin FROM long JOIN edges ON long.feature = edges.feature)
, sizes AS (SELECT feature, count(*) FILTER (NOT is_current) AS n, count(*) FILTER (is_current) AS m FROM binned GROUP BY feature)
, cells AS (SELECT s.feature, n, m, i AS bin FROM sizes s, (SELECT unnest(range(10)) AS i))
, filled AS (SELECT c.feature, c.n, c.m, c.bin, count(*) FILTER (NOT b.is_current) AS r, count(*) FILTER (b.is_current) AS q
  FROM cells c LEFT JOIN binned b ON b.feature=c.feature AND b.bin=c.bin GROUP BY ALL)
, psi AS (SELECT feature, sum({_psi_sum('r', 'n', 'q', 'm')}) AS psi FROM filled GROUP BY feature)
"""


def _erfc(x: str) -> str:
    t = f"(1e0/(1e0+0.5e0*({x})))"
    poly = f"{ERFC[-1]}e0"
    for c in reversed(ERFC[:-1]):
        poly = f"({c}e0 + {t}*{poly})"
    return f"({t}*exp(-({x})*({x}) + {poly}))"


def _tests(reference_rows: int | None = None) -> str:
    half = "(chi2/2)"
    spread = "(2e0/(9*(distinct_values-1)))"
    cube = f"((cbrt(chi2/(distinct_values-1)) - (1 - {spread}))/sqrt({spread}))"
    ks = "sqrt(CAST(n AS DOUBLE)*m/(n+m))*ks_d"
    return (
        _sets(reference_rows)
        + f"""
, vc AS (SELECT feature, value, count(*) FILTER (NOT is_current) AS ref, count(*) FILTER (is_current) AS cur FROM long GROUP BY 1, 2)
, al AS (SELECT *, sum(ref) OVER o AS cr, sum(cur) OVER o AS cc, sum(ref) OVER p AS n, sum(cur) OVER p AS m, lead(value) OVER o AS nv
   FROM vc WINDOW o AS (PARTITION BY feature ORDER BY value), p AS (PARTITION BY feature))
, gap AS (SELECT *, abs(CAST(cr AS DOUBLE)/n - CAST(cc AS DOUBLE)/m) AS gap, CAST(ref AS DOUBLE)/n AS p, CAST(cur AS DOUBLE)/m AS q,
   CAST(ref AS DOUBLE)*m/n AS expected FROM al)
, agg AS (SELECT feature, max(n) AS n, max(m) AS m, count(*) AS distinct_values, max(gap) AS ks_d,
   coalesce(sum(gap*(nv-value)),0)/greatest(sqrt(greatest(sum(ref*value*value)/max(n) - (sum(ref*value)/max(n))*(sum(ref*value)/max(n)), 0e0)), 0.001e0) AS wasserstein,
   sqrt(greatest(sum(CASE WHEN p>0 THEN p*ln(p/((p+q)/2)) ELSE 0e0 END + CASE WHEN q>0 THEN q*ln(q/((p+q)/2)) ELSE 0e0 END)/2, 0e0)) AS js_distance,
   CASE WHEN count(*) FILTER (ref=0) = 0 THEN sum((cur-expected)*(cur-expected)/expected) END AS chi2,
   CAST(arg_min(ref, value) AS DOUBLE)/max(n) AS pr, CAST(arg_min(cur, value) AS DOUBLE)/max(m) AS pc,
   CAST(arg_min(ref+cur, value) AS DOUBLE)/(max(n)+max(m)) AS pool
   FROM gap GROUP BY feature)
, zed AS (SELECT *, CASE WHEN pool > 0 AND pool < 1 THEN (pr-pc)/sqrt(pool*(1-pool)*(1e0/n+1e0/m)) END AS z FROM agg)
, tests AS (SELECT *,
   CASE WHEN {ks} < 0.2e0 THEN 1e0 ELSE greatest(0e0, least(1e0, list_sum(list_transform(range(1,101),
      lambda i: (CASE WHEN i % 2 = 1 THEN 2e0 ELSE -2e0 END)*exp(-2e0*i*i*({ks})*({ks})))))) END AS ks_p,
   CASE WHEN distinct_values < 2 THEN 1e0 WHEN chi2 IS NULL THEN 0e0 WHEN chi2 <= 0 THEN 1e0
     WHEN distinct_values > 101 THEN CASE WHEN {cube} >= 0 THEN {_erfc(f'abs({cube})/1.4142135623730951e0')}/2 ELSE 1 - {_erfc(f'abs({cube})/1.4142135623730951e0')}/2 END
     WHEN distinct_values % 2 = 1 THEN list_sum(list_transform(range(0, (distinct_values-1)//2), lambda i: exp(i*ln({half}) - lgamma(i+1e0) - {half})))
     ELSE {_erfc(f'sqrt({half})')} + coalesce(list_sum(list_transform(range(1, distinct_values//2), lambda i: exp((i-0.5e0)*ln({half}) - lgamma(i+0.5e0) - {half}))), 0e0) END AS chi2_p,
   CASE WHEN z IS NULL THEN 1e0 ELSE {_erfc('abs(z)/1.4142135623730951e0')} END AS z_p FROM zed)
"""
    )


def _half(e: str, digits: int) -> str:
    return f"floor(({e})*1e{digits}+0.5e0)/1e{digits}"


def _report(reference_rows: int | None = None) -> str:
    return (
        _tests(reference_rows)
        + f"""
, mom AS (SELECT feature, avg(value) FILTER (NOT is_current) AS rm, stddev_samp(value) FILTER (NOT is_current) AS rs,
   avg(value) FILTER (is_current) AS cm, stddev_samp(value) FILTER (is_current) AS cs FROM long GROUP BY feature)
, sel AS (SELECT tests.*, rm, rs, cm, cs,
   CASE WHEN n <= 1000 THEN CASE WHEN distinct_values <= 2 THEN 'z' WHEN distinct_values <= 5 THEN 'chi2' ELSE 'ks' END
        WHEN distinct_values <= 5 THEN 'jensenshannon' ELSE 'wasserstein' END AS stattest FROM tests JOIN mom USING (feature))
, sco AS (SELECT *, CASE stattest WHEN 'z' THEN z_p WHEN 'chi2' THEN chi2_p WHEN 'ks' THEN ks_p WHEN 'jensenshannon' THEN js_distance ELSE wasserstein END AS s,
   CASE WHEN n <= 1000 THEN 0.05e0 ELSE 0.1e0 END AS threshold FROM sel)
, report AS (SELECT feature, CASE WHEN n <= 1000 THEN s < threshold ELSE s >= threshold END AS drift_detected,
   {_half('s', 6)} AS drift_score, stattest, threshold,
   {_half('nullif(rm, 0)', 4)} AS reference_mean, {_half('rs', 4)} AS reference_std,
   {_half('nullif(cm, 0)', 4)} AS current_mean, {_half('cs', 4)} AS current_std, n AS reference_rows, m AS current_rows FROM sco)
"""
    )


BY_WINDOW = (
    FEATURES
    + _drift_frame()
    + f"""
, refr AS (SELECT * FROM fr WHERE us < {_MOMENT})
, rl AS (SELECT feature, value FROM (UNPIVOT (SELECT {_NAMES} FROM refr) ON {_NAMES} INTO NAME feature VALUE value))
, edges AS (SELECT feature, n, rm, CASE WHEN lo=hi THEN lo-0.5e0 ELSE lo END AS lo, CASE WHEN lo=hi THEN hi+0.5e0 ELSE hi END AS hi
  FROM (SELECT feature, count(*) AS n, avg(value) AS rm, min(value) AS lo, max(value) AS hi FROM rl GROUP BY feature))
, rb AS (SELECT rl.feature, {_bin()} AS bin, count(*) AS r FROM rl JOIN edges ON rl.feature=edges.feature GROUP BY 1, 2)
, wl AS (SELECT strftime(date_trunc('day', event_time), '%Y-%m-%d %H:%M:%S') AS window_start, feature, value
  FROM (UNPIVOT (SELECT event_time, {_NAMES} FROM fr) ON {_NAMES} INTO NAME feature VALUE value))
, wb AS (SELECT window_start, wl.feature, {_bin()} AS bin, count(*) AS c FROM wl JOIN edges ON wl.feature=edges.feature GROUP BY 1, 2, 3)
, ws AS (SELECT window_start, feature, count(*) AS m, avg(value) AS cm FROM wl GROUP BY 1, 2)
, cells AS (SELECT ws.*, i AS bin FROM ws, (SELECT unnest(range(10)) AS i))
, filled AS (SELECT cells.*, e.n, e.rm, coalesce(rb.r, 0) AS r, coalesce(wb.c, 0) AS c FROM cells JOIN edges e ON e.feature=cells.feature
  LEFT JOIN rb ON rb.feature=cells.feature AND rb.bin=cells.bin
  LEFT JOIN wb ON wb.window_start=cells.window_start AND wb.feature=cells.feature AND wb.bin=cells.bin)
, byw AS (SELECT window_start, feature, max(n) AS reference_rows, max(m) AS current_rows, max(rm) AS rm, max(cm) AS cm,
   sum({_psi_sum('r', 'n', 'c', 'm')}) AS psi FROM filled GROUP BY 1, 2)
"""
)

LATENCY = (
    TXN
    + f"""
, bounds AS (SELECT * FROM (VALUES {', '.join(f'({i}, {0.0 if i == 0 else SCORING_BUCKETS[i - 1]}e0, {b}e0)' for i, b in enumerate(SCORING_BUCKETS))}) v(i, lower, upper))
, obs AS (SELECT date_trunc('hour', event_time) AS h, CAST(latency_ms AS DOUBLE)/1000 AS s FROM txn)
, tot AS (SELECT h, count(*) AS total FROM obs GROUP BY h)
, cumul AS (SELECT h, i, lower, upper, count(*) FILTER (s <= upper) AS upto FROM obs, bounds GROUP BY ALL)
, stair AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY h ORDER BY i), 0) AS before FROM cumul)
, fr AS (SELECT * FROM tot, (VALUES (0.5e0), (0.95e0), (0.99e0)) v(fraction))
, hit AS (SELECT fr.h, fraction, total, min(i) AS i FROM fr LEFT JOIN stair ON stair.h=fr.h AND upto >= fraction*total GROUP BY ALL)
SELECT strftime(hit.h, '%Y-%m-%d %H:%M:%S') AS window_start, fraction,
  floor(coalesce(lower + (upper-lower)*((fraction*total - before)/CAST(upto-before AS DOUBLE)), {SCORING_BUCKETS[-1]}e0)*1e9+0.5e0)/1e9 AS seconds
FROM hit LEFT JOIN stair ON stair.h=hit.h AND stair.i=hit.i
"""
)

ORDERS = """
ord AS (SELECT o_orderkey AS id, o_custkey AS u, epoch_us(o_orderdate) AS us, CAST(round(o_totalprice*100) AS BIGINT) AS cents, o_orderkey % 250 AS mer FROM orders)
"""

RISK = """
SELECT transaction_id, CAST(position AS INT) AS position, factor FROM (
  SELECT transaction_id, unnest(found) AS factor, unnest(range(len(found))) AS position FROM (
    SELECT transaction_id, CASE WHEN len(f) > 0 THEN f WHEN score > 0.3e0 THEN ['Multiple moderate risk factors combined'] ELSE [] END AS found FROM (
      SELECT transaction_id, score, list_filter([
        CASE WHEN amount > 2000 THEN 'High transaction amount ($' || format('{:,.2f}', amount) || ')' END,
        CASE WHEN amount_zscore > 3 THEN 'Amount is unusually high for this user (' || printf('%.1f', floor(amount_zscore*10e0+0.5e0)/10e0) || ' std devs)' END,
        CASE WHEN country_change_flag = 1 THEN 'Different country from previous transaction' END,
        CASE WHEN unique_countries_24h > 2 THEN 'Card used in ' || unique_countries_24h || ' countries in 24 hours' END,
        CASE WHEN user_txn_count_1h > 5 THEN 'High transaction velocity (' || user_txn_count_1h || ' in last hour)' END,
        CASE WHEN minutes_since_last_txn < 5 THEN 'Rapid transaction (' || minutes_since_last_txn || ' minutes since last)' END,
        CASE WHEN device_change_flag = 1 THEN 'New device detected' END,
        CASE WHEN user_merchant_first_time = 1 THEN 'First transaction at this merchant' END,
        CASE WHEN channel_encoded = 1 THEN 'Online transaction (card-not-present)' END,
        CASE WHEN is_night = 1 THEN 'Transaction during night hours (midnight-6am)' END], lambda x: x IS NOT NULL) AS f FROM inp)))
"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def all_oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    feat = lambda cols: _with(FEATURES, f"SELECT transaction_id, {', '.join(cols)} FROM feat")

    # sources and sinks
    o["raw_projection"] = _with(TXN, """
      SELECT 'transactions' AS kafka_topic, CAST(user_id % 3 AS INT) AS kafka_partition, transaction_id AS kafka_offset,
        CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, 'C' || user_id || '_1' AS card_id,
        CAST(merchant_id AS VARCHAR) AS merchant_id, amount, 'USD' AS currency, us AS event_us, us AS ingestion_us, channel,
        CAST(country AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS city, CAST(device_id AS VARCHAR) AS device_id,
        CAST(NULL AS VARCHAR) AS ip_hash, label, true AS has_payload FROM txn""")
    o["raw_dedup"] = _with(TXN, """
      SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(user_id % 3 AS INT) AS kafka_partition, transaction_id AS kafka_offset, 'stored' AS outcome FROM txn
      UNION ALL
      SELECT CAST(transaction_id AS VARCHAR), CAST(user_id % 3 AS INT), transaction_id + 1000000000, 'rejected' FROM txn WHERE transaction_id % 17 = 0""")
    o["feature_upsert"] = _with(FEATURES, """
      SELECT transaction_id, CASE WHEN transaction_id % 5 = 1 THEN amount + 1 ELSE amount END AS amount,
        CASE WHEN transaction_id % 5 = 1 THEN NOT label ELSE label END AS label,
        CASE WHEN transaction_id % 5 = 1 OR transaction_id % 3 = 0 THEN user_txn_count_24h + 100 ELSE user_txn_count_24h END AS user_txn_count_24h,
        amount_zscore,
        CASE WHEN transaction_id % 5 = 1 OR transaction_id % 3 = 0 THEN NOT country_change_flag ELSE country_change_flag END AS country_change_flag
      FROM feat""")
    reason = """CASE k % 20 WHEN 3 THEN 'malformed_json' WHEN 7 THEN 'missing_amount' WHEN 9 THEN 'bad_amount'
        WHEN 11 THEN 'bad_timestamp' WHEN 13 THEN 'amount_not_positive' END"""
    o["quarantine"] = _with(TXN, f"""
      SELECT CAST(user_id % 3 AS INT) AS kafka_partition, transaction_id AS kafka_offset, {reason} AS reason FROM txn WHERE k % 20 IN (3,7,9,11,13)""")
    o["quarantine_stats"] = _with(TXN, f"""
      SELECT CAST(user_id % 3 AS INT) AS kafka_partition, {reason} AS reason, count(*) AS errors FROM txn WHERE k % 20 IN (3,7,9,11,13) GROUP BY 1, 2""")
    o["constraint_violations"] = _with(ALERT_TABLE, """
      SELECT 'decision_known' AS rule, count(*) FILTER (decision NOT IN ('APPROVE','REVIEW','BLOCK')) AS violations FROM alerts
      UNION ALL SELECT 'resolution_known', count(*) FILTER (resolution IS NOT NULL AND resolution NOT IN ('CONFIRMED_FRAUD','FALSE_POSITIVE','PENDING','ESCALATED')) FROM alerts
      UNION ALL SELECT 'transaction_id_set', count(*) FILTER (transaction_id IS NULL) FROM alerts
      UNION ALL SELECT 'score_set', count(*) FILTER (score IS NULL) FROM alerts
      UNION ALL SELECT 'amount_set', count(*) FILTER (amount IS NULL) FROM alerts""")

    # what each column of the raw table is made from
    made_from = {"kafka_topic": "''", "kafka_partition": "user_id", "kafka_offset": "transaction_id", "card_id": "user_id",
                 "currency": "''", "ingestion_time": "event_time", "payload": "transaction_id"}
    checks = [("raw_events", "txn", c) for c in [*RAW_REQUIRED, "device_id"]]
    checks += [("transaction_features", "feat", c) for c in [*FEATURE_REQUIRED, "amount_zscore"]]
    o["required_violations"] = _with(FEATURES, " UNION ALL ".join(
        f"SELECT '{c}_set' AS rule, count(*) FILTER ({made_from.get(c, c)} IS NULL) AS violations, '{t}' AS table_name FROM {source}"
        for t, source, c in checks
    ))
    o["user_sessions"] = _with(TXN + """
      , marked AS (SELECT user_id, us, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) < 21600000000 THEN 0 ELSE 1 END AS starts FROM txn)
      , numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS s FROM marked)""", """
      SELECT user_id, strftime(make_timestamp(min(us)), '%Y-%m-%d %H:%M:%S') AS window_start,
        strftime(make_timestamp(max(us) + 21600000000), '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS events
      FROM numbered GROUP BY user_id, s""")

    # columns
    o["time_channel"] = _with(TXN, """
      SELECT transaction_id, CAST(hour(event_time) AS INT) AS hour_of_day, CAST(isodow(event_time)-1 AS INT) AS day_of_week,
        isodow(event_time) >= 6 AS is_weekend, hour(event_time) < 6 AS is_night,
        CASE channel WHEN 'POS' THEN 0 WHEN 'ECOM' THEN 1 WHEN 'ATM' THEN 2 ELSE -1 END AS channel_encoded,
        CASE channel WHEN 'ECOM' THEN 1 WHEN 'ATM' THEN 2 ELSE 0 END AS scoring_channel_encoded FROM txn""")
    o["rule_risk"] = _with(TXN, """
      SELECT transaction_id, CAST(floor(least(0.25e0, 0.002e0 + CASE WHEN amount*20 >= 2000 THEN 0.01e0 ELSE 0e0 END
        + CASE WHEN amount*20 >= 5000 THEN 0.03e0 ELSE 0e0 END + CASE WHEN channel='ECOM' AND country<>home THEN 0.05e0 ELSE 0e0 END
        + CASE WHEN channel='ATM' AND amount*20 >= 1000 THEN 0.01e0 ELSE 0e0 END)*1e6+0.5e0) AS BIGINT) AS risk_ppm FROM txn""")
    o["decisions"] = _with(TXN, f"SELECT transaction_id, score, {DECISION} AS decision FROM txn")

    # history
    o["features_full"] = feat(["user_id", "amount", "channel", "country", "label", *HISTORY, *CALENDAR, "channel_encoded"])
    o["velocity"] = feat(HISTORY[1:6])
    o["amount_stats"] = feat(["user_avg_amount_30d", "user_std_amount_30d", "amount_zscore"])
    o["behaviour"] = feat(HISTORY[8:14])
    o["recency"] = feat(["minutes_since_last_txn"])
    o["home_country"] = feat(["home_country", "is_foreign_txn"])
    o["history_exact"] = feat(HISTORY)
    o["history_with_ties"] = _with(ORDERS + """
      , pairs AS (SELECT a.id, a.u, a.us, a.cents, a.mer, b.us AS bus, b.cents AS bc, b.mer AS bm, b.id AS bid FROM ord a
         LEFT JOIN ord b ON a.u=b.u AND (b.us < a.us OR (b.us = a.us AND b.id < a.id)))
      , s AS (SELECT id, us, cents,
         count(bid) FILTER (bus >= us-86400000000) AS c24, count(bid) FILTER (bus >= us-604800000000) AS c7,
         coalesce(sum(bc) FILTER (bus >= us-86400000000), 0) AS s24, count(bid) FILTER (bus >= us-2592000000000) AS n,
         sum(bc) FILTER (bus >= us-2592000000000) AS sm, sum(CAST(bc AS HUGEINT)*bc) FILTER (bus >= us-2592000000000) AS sq,
         count(DISTINCT bm) FILTER (bus >= us-86400000000) AS um, count(bid) FILTER (bm = mer) = 0 AS fst, max(bus) AS lus
         FROM pairs GROUP BY id, us, cents)""", """
      SELECT id AS transaction_id, CAST(c24 AS INT) AS user_txn_count_24h, CAST(c7 AS INT) AS user_txn_count_7d, CAST(s24 AS DOUBLE)/100 AS user_amount_sum_24h,
        CASE WHEN n>=2 AND sm<>0 THEN CAST((2*sm+n) // (2*n) AS DOUBLE)/100 END AS user_avg_amount_30d,
        CASE WHEN n>=2 AND n*sq>sm*sm THEN floor(sqrt(CAST(n*sq-sm*sm AS DOUBLE))/n+0.5e0)/100e0 END AS user_std_amount_30d,
        CAST(um AS INT) AS unique_merchants_24h, fst AS user_merchant_first_time, CASE WHEN lus IS NOT NULL THEN least((us-lus)//60000000, 10080) END AS minutes_since_last_txn FROM s""")
    o["idle_reset"] = _with(ORDERS + """
      , l AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 604800000000 THEN 0 ELSE 1 END AS st FROM ord WINDOW w AS (PARTITION BY u ORDER BY us, id))
      , h AS (SELECT *, sum(st) OVER (PARTITION BY u ORDER BY us, id) AS hn FROM l)""", """
      SELECT id AS transaction_id, CAST(hn AS BIGINT) AS history_number, row_number() OVER (PARTITION BY u, hn, mer ORDER BY us, id) = 1 AS first_since_reset FROM h""")
    o["features_with_expiry"] = _with(ORDERS + """
      , l AS (SELECT ord.*, c_nationkey AS nat, CASE WHEN us - lag(us) OVER w <= 604800000000 THEN 0 ELSE 1 END AS st
         FROM ord LEFT JOIN customer ON c_custkey = u WINDOW w AS (PARTITION BY u ORDER BY us, id))
      , h AS (SELECT *, sum(st) OVER (PARTITION BY u ORDER BY us, id) AS hn FROM l)
      , pairs AS (SELECT a.id, a.u, a.hn, a.us, a.cents, a.mer, a.nat, b.us AS bus, b.cents AS bc, b.mer AS bm, b.id AS bid, b.nat AS bnat FROM h a
         LEFT JOIN h b ON a.u=b.u AND a.hn=b.hn AND (b.us < a.us OR (b.us = a.us AND b.id < a.id)))
      , s AS (SELECT id, us, hn, cents, nat,
         count(bid) FILTER (bus >= us-86400000000) AS c24, count(bid) FILTER (bus >= us-604800000000) AS c7,
         coalesce(sum(bc) FILTER (bus >= us-86400000000), 0) AS s24, count(bid) FILTER (bus >= us-2592000000000) AS n,
         sum(bc) FILTER (bus >= us-2592000000000) AS sm, sum(CAST(bc AS HUGEINT)*bc) FILTER (bus >= us-2592000000000) AS sq,
         count(DISTINCT bm) FILTER (bus >= us-86400000000) AS um, count(bid) FILTER (bm = mer) = 0 AS fst, max(bus) AS lus, max(bnat) AS home
         FROM pairs GROUP BY id, us, hn, cents, nat)""", """
      SELECT id AS transaction_id, CAST(hn AS BIGINT) AS history_number, CAST(c24 AS INT) AS user_txn_count_24h, CAST(c7 AS INT) AS user_txn_count_7d, CAST(s24 AS DOUBLE)/100 AS user_amount_sum_24h,
        CASE WHEN n>=2 AND sm<>0 THEN CAST((2*sm+n) // (2*n) AS DOUBLE)/100 END AS user_avg_amount_30d,
        CASE WHEN n>=2 AND n*sq>sm*sm THEN floor(sqrt(CAST(n*sq-sm*sm AS DOUBLE))/n+0.5e0)/100e0 END AS user_std_amount_30d,
        CAST(um AS INT) AS unique_merchants_24h, fst AS user_merchant_first_time, CASE WHEN lus IS NOT NULL THEN least((us-lus)//60000000, 10080) END AS minutes_since_last_txn,
        nat <> home AS is_foreign_txn FROM s""")
    # a history between two pauses takes the user's place
    o["features_with_expiry_daily"] = _with(
        TXN + """
      , paused AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, transaction_id) <= 86400000000 THEN 0 ELSE 1 END AS starts FROM txn)
      , numbered AS (SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY us, transaction_id) AS BIGINT) AS history_number FROM paused)"""
        + FEATURES.removeprefix(TXN).replace("PARTITION BY user_id", "PARTITION BY user_id, history_number").replace("FROM txn)", "FROM numbered)").replace("home_country,\n", "home_country, history_number,\n"),
        f"SELECT transaction_id, history_number, {', '.join(HISTORY)} FROM feat",
    )
    o["features_uncapped"] = feat(HISTORY)
    o["active_users"] = _with(TXN + """
      , us_ AS (SELECT user_id, max(us) AS last_us, count(*) AS transactions FROM txn GROUP BY 1)""", """
      SELECT user_id, last_us, transactions, last_us >= (SELECT max(last_us) FROM us_) - 604800000000 AS tracked,
        row_number() OVER (ORDER BY last_us, user_id) <= 5 AND (SELECT count(*) FROM us_) >= 10 AS evicted FROM us_""")
    o["rolling_scores"] = _with(TXN, """
      SELECT transaction_id, floor(avg(score) OVER w*1e9+0.5e0)/1e9 AS score_mean, max(score) OVER w AS score_max FROM txn
      WINDOW w AS (ORDER BY us, transaction_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""")

    # training frames
    o["labelled_scan"] = _with(FEATURES, f"""
      SELECT transaction_id, user_id, us AS event_us, amount, {', '.join(HISTORY)}, {', '.join(CALENDAR)}, channel, channel_encoded, country, label
      FROM feat WHERE label IS NOT NULL""")
    o["scoring_defaults"] = _with(TXN, _scoring("txn", False))
    o["score_input"] = _with(
        FEATURES
        + f", known AS (SELECT t.transaction_id, t.amount, t.channel, t.event_time, {', '.join(f'f.{c}' for c in HISTORY)} FROM txn t LEFT JOIN (SELECT * FROM feat WHERE label IS NOT NULL) f USING (transaction_id))",
        _scoring("known", True),
    )
    o["time_split"] = _with(SPLIT, "SELECT transaction_id, split FROM split")
    stats = """count(*) AS total_rows, count(*) FILTER (label) AS fraud_count, count(*) FILTER (NOT label) AS legitimate_count,
        CAST(count(*) FILTER (label) AS DOUBLE)/count(label) AS fraud_rate, min(us) AS first_time, max(us) AS last_time"""
    o["split_stats"] = _with(SPLIT, f"SELECT split, {stats} FROM split GROUP BY split")
    o["dataset_stats"] = _with(TXN, f"SELECT {stats}, count(DISTINCT user_id) AS unique_users FROM txn WHERE label IS NOT NULL")
    o["data_stats"] = _with(TXN, "SELECT count(*) AS total_rows, min(transaction_id) AS oldest_transaction, max(transaction_id) AS newest_transaction FROM txn")
    o["data_fingerprint"] = _with(TXN + """
      , h AS (SELECT md5(concat_ws('|', CAST(transaction_id AS VARCHAR), CAST(label AS VARCHAR))) AS h FROM txn WHERE label IS NOT NULL)
      , s AS (SELECT count(*) AS n, sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS a, sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS b FROM h)""",
      "SELECT n AS total_rows, substr(md5(concat_ws('|', CAST(n AS VARCHAR), CAST(a AS VARCHAR), CAST(b AS VARCHAR))), 1, 16) AS fingerprint FROM s")
    o["class_balance"] = _with(TXN, """SELECT count(*) FILTER (NOT label) AS negatives, count(*) FILTER (label) AS positives,
        CASE WHEN count(*) FILTER (label) > 0 THEN CAST(count(*) FILTER (NOT label) AS DOUBLE)/count(*) FILTER (label) ELSE 1e0 END AS positive_weight FROM txn""")
    gaps = ["amount_zscore", "user_avg_amount_30d", "minutes_since_last_txn"]
    flags = [f for f in _FLAGS if f != "label"]
    columns = []
    for n in MODEL_FEATURES:
        if n in flags:
            columns.append(f"CAST({n} AS INT) AS {n}")
        elif n in gaps:
            columns.append(f"coalesce(CAST({n} AS DOUBLE), median(CAST({n} AS DOUBLE)) OVER (PARTITION BY split), 0e0) AS {n}")
        else:
            columns.append(f"CAST({n} AS DOUBLE) AS {n}")
    o["prepared_features"] = _with(
        FEATURES + SPLIT[len(TXN):],
        f"SELECT transaction_id, split, CAST(label AS INT) AS label, {', '.join(columns)} FROM feat JOIN (SELECT transaction_id, split FROM split) USING (transaction_id)",
    )

    # evaluation
    curve = TXN + _curves("txn", "1")
    o["confusion"] = _with(TXN + _confusion("txn", "0.5e0", "1"), "SELECT * EXCLUDE (grp) FROM conf")
    o["pr_curve"] = _with(curve, """SELECT score AS threshold, CAST(tp AS DOUBLE)/(tp+fp) AS "precision", CAST(tp AS DOUBLE)/np AS recall FROM cum
      UNION ALL SELECT NULL, 1e0, 0e0""")
    roc = "SELECT score AS threshold, CAST(fp AS DOUBLE)/nn AS fpr, CAST(tp AS DOUBLE)/np AS tpr FROM corner {} UNION ALL SELECT NULL, 0e0, 0e0"
    o["roc_curve"] = _with(curve, roc.format("WHERE kept"))
    o["roc_curve_all_points"] = _with(curve, roc.format(""))
    o["pr_auc"] = _with(curve, f"SELECT {_half('pr_auc', 9)} AS pr_auc FROM met")
    o["roc_auc"] = _with(curve, f"SELECT {_half('roc_auc', 9)} AS roc_auc FROM met")
    o["recall_at_fpr"] = _with(curve, "SELECT " + ", ".join(f"{_half(n, 9)} AS {n}" for n in ("recall_at_1pct_fpr", "recall_at_5pct_fpr", "recall_at_10pct_fpr")) + " FROM met")
    o["optimal_threshold"] = _with(
        curve
        + """, pts AS (SELECT score AS t, CAST(fp AS DOUBLE)/nn AS fpr, CAST(tp AS DOUBLE)/np AS tpr FROM corner WHERE kept UNION ALL SELECT 9e9, 0e0, 0e0)
           , best AS (SELECT t, fpr AS actual_fpr, tpr AS actual_tpr FROM pts ORDER BY abs(fpr-0.05e0), t DESC LIMIT 1)"""
        + _confusion("txn", "(SELECT t FROM best)", "1"),
        """SELECT t AS optimal_threshold, actual_fpr, actual_tpr, "precision", recall, f1, true_positives, false_positives FROM conf, best""",
    )
    o["lift"] = _with(TXN + """
      , lab AS (SELECT *, row_number() OVER (ORDER BY score DESC, transaction_id) AS r, CAST(floor(count(*) OVER () * 0.10e0) AS BIGINT) AS top FROM txn WHERE label IS NOT NULL)""",
      "SELECT count(*) FILTER (r <= top) AS top_rows, avg(CAST(label AS INT)) FILTER (r <= top)/avg(CAST(label AS INT)) AS lift FROM lab")
    names = ["pr_auc", "roc_auc", "recall_at_1pct_fpr", "recall_at_5pct_fpr", "recall_at_10pct_fpr", "true_positives", "false_positives",
             "true_negatives", "false_negatives", "precision", "recall", "f1", "fpr", "fnr", "lift"]
    wide = ", ".join(f'CAST("{n}" AS DOUBLE) AS "{n}"' for n in names)
    o["evaluation_report"] = _with(
        SPLIT
        + _curves("split", "split")
        + _confusion("split", "0.5e0", "split")
        + f"""
      , lr AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY score DESC, transaction_id) AS rr, floor(count(*) OVER (PARTITION BY split)*0.10e0) AS top FROM split)
      , li AS (SELECT split AS grp, avg(CAST(label AS INT)) FILTER (rr <= top)/avg(CAST(label AS INT)) AS lift FROM lr GROUP BY 1)
      , wide AS (SELECT grp AS split, {wide} FROM met JOIN conf USING (grp) JOIN li USING (grp))""",
        f"SELECT split, metric, {_half('value', 9)} AS value FROM (UNPIVOT wide ON " + ", ".join(f'"{n}"' for n in names) + " INTO NAME metric VALUE value)",
    )
    four = lambda c: f"printf('%.4f', floor({c}*10000e0+0.5e0)/10000e0)"
    o["promotion_gate"] = _with(SPLIT + _curves("split", "split"), f"""
      SELECT grp AS split, pr_auc >= 0.9e0 AND recall_at_5pct_fpr >= 0.4e0 AS promoted,
        CASE WHEN pr_auc >= 0.9e0 AND recall_at_5pct_fpr >= 0.4e0 THEN '✅ Promoted! PR-AUC=' || {four('pr_auc')} || ', Recall@5%FPR=' || {four('recall_at_5pct_fpr')}
        ELSE 'Not promoted: ' || concat_ws('; ', CASE WHEN pr_auc < 0.9e0 THEN 'PR-AUC ' || {four('pr_auc')} || ' < 0.9' END,
          CASE WHEN recall_at_5pct_fpr < 0.4e0 THEN 'Recall@5%FPR ' || {four('recall_at_5pct_fpr')} || ' < 0.4' END) END AS reason FROM met""")
    o["score_norm"] = _with(TXN, "SELECT transaction_id, (score - min(score) OVER ())/nullif(max(score) OVER () - min(score) OVER (), 0e0) AS score_norm FROM txn")

    # explanations and alerts
    o["top_features"] = _with(_contributions(), "SELECT transaction_id, CAST(rank AS INT) AS rank, feature, value, contribution FROM placed WHERE rank < 5")
    o["explanations"] = _with(FEATURES + f", inp AS ({_scoring('feat', True)}), long AS ({_long(_texts(), 'inp')})", "SELECT transaction_id, feature, text AS description FROM long")
    scored = _scoring("feat", True).replace("SELECT transaction_id,", "SELECT transaction_id, score,", 1)
    o["risk_factors"] = _with(FEATURES + f", inp AS ({scored})", RISK)
    o["alerts"] = _with(_contributions(), f"""
      SELECT CAST(t.transaction_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, channel, {DECISION} AS decision,
        'stand-in' AS model_name, '1' AS model_version, CAST(latency_ms AS INT) AS inference_latency_ms, feature AS first_feature,
        amount, floor(score*10000e0+0.5e0)/10000e0 AS score, CASE WHEN score >= 0.7e0 THEN 0.7e0 ELSE 0.3e0 END AS threshold
      FROM txn t JOIN placed p ON p.transaction_id=t.transaction_id AND p.rank=0 WHERE score >= 0.3e0""")
    o["recent_alerts"] = _with(ALERT_TABLE, """
      SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, amount, channel, CAST(country AS VARCHAR) AS country, score, decision,
        strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, resolution FROM alerts ORDER BY alerts.created_at DESC, alerts.transaction_id DESC LIMIT 20""")
    o["alert_stats"] = _with(ALERT_TABLE, """
      SELECT count(*) AS total_alerts, count(*) FILTER (decision='BLOCK') AS blocked, count(*) FILTER (decision='REVIEW') AS review,
        count(*) FILTER (decision='APPROVE') AS approved, count(*) FILTER (resolution IS NULL) AS unresolved,
        floor(avg(score)*1e6+0.5e0)/1e6 AS avg_score, floor(avg(latency_ms)*1e6+0.5e0)/1e6 AS avg_latency_ms,
        count(*) FILTER (created_at > (SELECT max(created_at) FROM alerts) - INTERVAL 1 HOUR) AS alerts_last_hour FROM alerts""")
    o["alert_counts"] = _with(ALERT_TABLE + ", r AS (SELECT * FROM alerts WHERE created_at > (SELECT max(created_at) FROM alerts) - INTERVAL 24 HOUR)", """
      SELECT 'REVIEW' AS decision, count(*) FILTER (decision='REVIEW') AS alerts FROM r UNION ALL SELECT 'BLOCK', count(*) FILTER (decision='BLOCK') FROM r""")
    o["alert_outcomes"] = _with(ALERT_TABLE, """
      SELECT decision, count(*) AS alerts, count(*) FILTER (label) AS fraud, count(*) FILTER (NOT label) AS legitimate, count(*) FILTER (label IS NULL) AS unlabelled,
        CASE WHEN count(label) > 0 THEN CAST(count(*) FILTER (label) AS DOUBLE)/count(label) ELSE 0e0 END AS "precision" FROM alerts GROUP BY decision""")
    o["orphan_features"] = _with(TXN, "SELECT transaction_id, user_id, CASE WHEN transaction_id % 13 = 0 THEN 'orphan' ELSE 'valid' END AS state FROM txn")

    # drift
    drift_names = ", ".join([*MODEL_FEATURES, "label"])
    o["drift_reference"] = _with(_sets(5000), f"SELECT transaction_id, {drift_names} FROM refr")
    o["drift_current"] = _with(_sets(5000), f"SELECT transaction_id, {drift_names} FROM curr")
    o["drift_wasserstein"] = _with(_tests(), f"SELECT feature, distinct_values, {_half('wasserstein', 6)} AS wasserstein FROM tests")
    o["drift_ks"] = _with(_tests(), f"SELECT feature, distinct_values, {_half('ks_d', 6)} AS ks_d, {_half('ks_p', 6)} AS ks_p FROM tests")
    o["drift_js"] = _with(_tests(), f"SELECT feature, distinct_values, {_half('js_distance', 6)} AS js_distance FROM tests")
    o["drift_chi2"] = _with(_tests(), f"SELECT feature, distinct_values, {_half('chi2', 6)} AS chi2, {_half('chi2_p', 6)} AS chi2_p FROM tests")
    o["drift_ztest"] = _with(_tests(), f"SELECT feature, distinct_values, {_half('z', 6)} AS z, {_half('z_p', 6)} AS z_p FROM tests")
    o["psi"] = _with(_sets() + PSI, f"SELECT feature, {_half('psi', 6)} AS psi FROM psi")
    o["drift_simple"] = _with(_sets() + PSI + """
      , mom AS (SELECT feature, avg(value) FILTER (NOT is_current) AS rm, stddev_samp(value) FILTER (NOT is_current) AS rs,
         avg(value) FILTER (is_current) AS cm, stddev_samp(value) FILTER (is_current) AS cs FROM long GROUP BY feature)""", f"""
      SELECT feature, {_half('rm', 6)} AS reference_mean, {_half('cm', 6)} AS current_mean, {_half('cm-rm', 6)} AS mean_diff,
        {_half('CASE WHEN rm <> 0 THEN (cm-rm)/rm*100 ELSE 0e0 END', 6)} AS mean_diff_pct, {_half('rs', 6)} AS reference_std,
        {_half('cs', 6)} AS current_std, {_half('psi', 6)} AS psi, psi > 0.1e0 AS drift_detected FROM mom JOIN psi USING (feature)""")
    o["drift_report"] = _with(_report(), "SELECT * FROM report")
    o["drift_report_small"] = _with(_report(1000), "SELECT * FROM report")
    o["drift_report_n"] = _with(_report(5000), "SELECT * FROM report")
    o["drift_dataset"] = _with(_report(), """
      SELECT count(*) AS features_checked, count(*) FILTER (drift_detected) AS features_drifted, CAST(count(*) FILTER (drift_detected) AS DOUBLE)/count(*) AS share_drifted,
        0.5e0 AS drift_share_threshold, CAST(count(*) FILTER (drift_detected) AS DOUBLE)/count(*) >= 0.5e0 AS dataset_drift,
        max(reference_rows) AS reference_rows, max(current_rows) AS current_rows FROM report""")
    o["drift_by_window"] = _with(BY_WINDOW, f"""
      SELECT window_start, feature, reference_rows, current_rows, {_half('rm', 6)} AS reference_mean, {_half('cm', 6)} AS current_mean,
        {_half('psi', 6)} AS psi, psi > 0.1e0 AS drift_detected FROM byw""")
    o["drift_trend"] = _with(BY_WINDOW, f"""
      SELECT window_start, count(*) AS features_checked, count(*) FILTER (psi > 0.1e0) AS features_drifted,
        CAST(count(*) FILTER (psi > 0.1e0) AS DOUBLE)/count(*) AS share_drifted, CAST(count(*) FILTER (psi > 0.1e0) AS DOUBLE)/count(*) >= 0.5e0 AS dataset_drift,
        max(reference_rows) AS reference_rows, max(current_rows) AS current_rows, {_half('max(psi)', 6)} AS worst_score, arg_max(feature, psi) AS worst_feature
      FROM byw GROUP BY window_start""")

    def active(source: str, user: str, time: str, days: int) -> str:
        return f"""
          WITH s AS (SELECT DISTINCT CAST({time} AS DATE) AS d, {user} AS u FROM {source})
          , days AS (SELECT DISTINCT d FROM s)
          SELECT strftime(a.d, '%Y-%m-%d') AS day, count(DISTINCT u) AS active_users FROM days a JOIN s ON s.d <= a.d AND s.d > a.d - {days} GROUP BY a.d"""

    o["active_users_by_day"] = active("events", "user_id", "ts", 7)
    o["customers_by_day"] = active("orders", "o_custkey", "o_orderdate", 30)
    o["data_order_hash"] = _with(TXN + """
      , r AS (SELECT row_number() OVER (ORDER BY us, transaction_id) - 1 AS pos,
         sha256(CAST(transaction_id AS VARCHAR) || '|' || CASE WHEN label THEN 'true' ELSE 'false' END) AS h FROM txn WHERE label IS NOT NULL)
      , leaf AS (SELECT pos // 1024 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM r GROUP BY pos // 1024)
      , root AS (SELECT CASE WHEN count(*) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM leaf)""", """
      SELECT (SELECT count(*) FROM r) AS total_rows, substr(h, 1, 16) AS data_hash FROM root""")
    o["drift_from_summaries"] = o["drift_simple"]
    o["drift_by_day"] = o["drift_by_window"]
    day = lambda e: f"substr({e}, 1, 10)"
    o["drift_history"] = _with(BY_WINDOW + """
      , f AS (SELECT window_start AS day, feature, psi, psi > 0.1e0 AS d FROM byw)
      , p AS (SELECT *, lag(day) OVER w AS pd, lag(psi) OVER w AS pp, d AND NOT coalesce(lag(d) OVER w, false) AS st FROM f
         WINDOW w AS (PARTITION BY feature ORDER BY day))
      , s AS (SELECT *, sum(CAST(st AS INT)) OVER (PARTITION BY feature ORDER BY day) AS streak, min(CASE WHEN d THEN day END) OVER (PARTITION BY feature ORDER BY day) AS fd FROM p)
      , r AS (SELECT *, min(CASE WHEN d THEN day END) OVER (PARTITION BY feature, streak) AS since,
         count(*) FILTER (d) OVER (PARTITION BY feature, streak ORDER BY day) AS len FROM s)""", f"""
      SELECT {day('day')} AS day, feature, {_half('psi', 6)} AS psi, d AS drift_detected, {day('pd')} AS previous_run, {_half('pp', 6)} AS previous_score,
        {_half('psi-pp', 6)} AS score_change, st AS drift_started, CASE WHEN d THEN {day('since')} END AS drifting_since,
        CASE WHEN d THEN CAST(len AS BIGINT) END AS drifting_runs, {day('fd')} AS first_drift FROM r""")

    # monitoring
    stamp = lambda e: f"strftime({e}, '%Y-%m-%d %H:%M:%S')"
    o["throughput"] = _with(TXN, f"""SELECT {stamp("date_trunc('minute', event_time)")} AS window_start, channel, country, count(*) AS events FROM txn GROUP BY ALL""")
    o["increase_1h"] = _with(TXN + ", st AS (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS s, count(*) AS n FROM txn GROUP BY 1)", f"""
      SELECT {stamp('s - i * INTERVAL 5 MINUTE')} AS window_start, CAST(sum(n) AS BIGINT) AS events FROM st, (SELECT unnest(range(12)) AS i) GROUP BY 1""")
    o["consumer_lag"] = _with(TXN, """
      SELECT 'transactions' AS topic, CAST(user_id % 3 AS INT) AS partition, max(transaction_id)+1 AS end_offset,
        coalesce(max(transaction_id) FILTER (event_time < (SELECT max(event_time) FROM txn) - INTERVAL 1 DAY)+1, 0) AS position,
        max(transaction_id)+1 - coalesce(max(transaction_id) FILTER (event_time < (SELECT max(event_time) FROM txn) - INTERVAL 1 DAY)+1, 0) AS lag
      FROM txn GROUP BY ALL""")
    o["decision_counts"] = _with(TXN + f", d AS (SELECT *, {DECISION} AS decision FROM txn)", f"""
      SELECT {stamp("date_trunc('hour', event_time)")} AS window_start, count(*) FILTER (decision='APPROVE') AS approve, count(*) FILTER (decision='REVIEW') AS review,
        count(*) FILTER (decision='BLOCK') AS block, floor(CAST(count(*) AS DOUBLE)/60*1e6+0.5e0)/1e6 AS decisions_per_minute FROM d GROUP BY 1""")
    o["block_rate"] = _with(TXN + f", d AS (SELECT *, {DECISION} AS decision FROM txn)", f"""
      SELECT {stamp('time_bucket(INTERVAL 5 MINUTE, event_time)')} AS window_start, count(*) AS decisions, CAST(count(*) FILTER (decision='BLOCK') AS DOUBLE)/count(*) AS block_rate FROM d GROUP BY 1""")
    o["latency_quantiles"] = f"WITH {LATENCY.strip()}"
    o["latency_percentiles"] = _with(TXN, """
      SELECT channel, fraction, floor(q*1e6+0.5e0)/1e6 AS quantile FROM (
        SELECT channel, unnest([0.5e0,0.95e0,0.99e0]) AS fraction, unnest(quantile_cont(CAST(latency_ms AS DOUBLE), [0.5,0.95,0.99])) AS q FROM txn GROUP BY channel)""")
    return o
