"""Independent DuckDB SQL for every registered query.

The same fixture rules and operator semantics, written once more as plain
SQL over the driver's tables (views ``events customer nation region``).
Money is exact DECIMAL with the same scales as the Spark side and leaves
as DOUBLE; sums of counts are cast back to BIGINT.
"""

from __future__ import annotations

from decimal import Decimal

# Fixed values, written out here so that a wrong digit in the engine shows:
# number plan, catalog, tariffs and the parameters of the fixture run.
PLANS_OF_COUNTRIES = (
    r"212[67]\d{8}|1\d{10}|44\d{10}|49\d{11}|61\d{9}|86\d{11}|91\d{10}|351\d{9}|55\d{11}|32\d{9}|90\d{10}"
)
PAT = f"^({PLANS_OF_COUNTRIES}|)$"
PAT_STRICT = f"^({PLANS_OF_COUNTRIES})$"
AS_OF, MONTH = "2024-01-02", "2024-02"
FIXTURE_MONTHS = ("2024-01", "2024-02", "2024-03", "2024-04")
DISCOUNT, VAT, FEE = Decimal("0.05"), Decimal("0.20"), Decimal("1")
CATALOG = """
  ('DATA_STD', 'data', 'MB', 'flat'), ('DATA_ULTRA', 'data', 'MB', 'tiered'), ('SMS_STD', 'sms', 'sms', 'flat'),
  ('VOICE_INT', 'voice', 'second', 'flat'), ('VOICE_NAT', 'voice', 'second', 'flat')"""
TARIFFS = """
  ('Gold', 'DATA_STD', 'data', 0.008, 200, NULL, NULL), ('Gold', 'DATA_ULTRA', 'data', 0.003, 250, 1000, 0.001),
  ('Gold', 'SMS_STD', 'sms', 0.075, 1, NULL, NULL), ('Gold', 'VOICE_INT', 'voice', 0.180, 10, NULL, NULL),
  ('Gold', 'VOICE_NAT', 'voice', 0.035, 60, NULL, NULL),
  ('Silver', 'DATA_STD', 'data', 0.010, 100, NULL, NULL), ('Silver', 'DATA_ULTRA', 'data', 0.005, 200, 500, 0.002),
  ('Silver', 'SMS_STD', 'sms', 0.100, 0, NULL, NULL), ('Silver', 'VOICE_INT', 'voice', 0.250, 0, NULL, NULL),
  ('Silver', 'VOICE_NAT', 'voice', 0.050, 30, NULL, NULL),
  ('Titanium', 'DATA_STD', 'data', 0.005, 300, NULL, NULL), ('Titanium', 'DATA_ULTRA', 'data', 0.002, 512, 2048, 0.001),
  ('Titanium', 'SMS_STD', 'sms', 0.050, 3, NULL, NULL), ('Titanium', 'VOICE_INT', 'voice', 0.120, 30, NULL, NULL),
  ('Titanium', 'VOICE_NAT', 'voice', 0.020, 120, NULL, NULL)"""


def _q(s) -> str:
    if s is None:
        return "NULL"
    if isinstance(s, float):
        return str(Decimal(str(s)))
    if isinstance(s, (int, Decimal)):
        return str(s)
    return "'" + str(s).replace("'", "''") + "'"


def _valid(col: str, pattern: str = PAT) -> str:
    return f"regexp_matches({col}, {_q(pattern)})"


RAW_CDR = f"""
raw_src AS (
  SELECT *,
    CASE WHEN event_type = 'signup' THEN 'sms' WHEN event_type = 'view' THEN 'data' ELSE 'voice' END AS kind,
    CASE WHEN event_id % 41 = 0 THEN NULL
         WHEN event_id % 43 = 0 THEN 'X' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(11, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0')
         WHEN event_id % 47 = 0 THEN ''
         ELSE '2126' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(8, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') END AS payer,
    CASE WHEN event_id % 53 = 0 THEN NULL
         WHEN event_id % 59 = 0 THEN 'junk'
         WHEN event_id % 61 = 0 THEN ''
         WHEN event_id % 5 = 0 THEN '44' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(10, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0')
         ELSE '2127' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(8, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') END AS other
  FROM events
),
raw_cdr AS (
  SELECT
    CAST(event_id AS VARCHAR) AS record_ID,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE kind END AS record_type,
    CASE WHEN event_id % 19 = 0 THEN NULL
         ELSE CAST(ts AS TIMESTAMP) + to_days(CAST(31 * (event_id % 3) AS INTEGER)) END AS "timestamp",
    CASE WHEN event_id % 10 < 3 THEN NULL
         ELSE 'CELL_' || lpad(CAST(event_id % 20 + 1 AS VARCHAR), 2, '0') END AS cell_id,
    CASE event_id % 8 WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN '4G' WHEN 3 THEN '5G'
         WHEN 4 THEN 'LTE' WHEN 5 THEN 'NR' WHEN 6 THEN 'UMTS' END AS technology,
    CASE WHEN kind = 'voice' THEN payer END AS caller_id,
    CASE WHEN kind = 'voice' THEN other END AS callee_id,
    CASE WHEN kind = 'voice' THEN CAST(CASE WHEN event_id % 10 = 1 THEN NULL
                                          WHEN event_id % 10 = 2 THEN -(floor(value) + 10)
                                          ELSE floor(value) + 10 END AS INTEGER) END AS duration_sec,
    CASE WHEN kind = 'sms' THEN payer END AS sender_id,
    CASE WHEN kind = 'sms' THEN other END AS receiver_id,
    CASE WHEN kind = 'data' THEN payer END AS user_id,
    CASE WHEN kind = 'data' THEN CASE WHEN event_id % 9 = 0 THEN NULL
                                      ELSE CAST(CAST(value * 10 AS DECIMAL(12,2)) AS DOUBLE) END END AS data_volume_mb,
    CASE WHEN kind = 'data' THEN CAST(CASE WHEN event_id % 10 = 4 THEN NULL
                                         WHEN event_id % 10 = 6 THEN -60
                                         ELSE floor(value) + 60 END AS INTEGER) END AS session_duration_sec,
    CASE WHEN kind = 'data' THEN CASE WHEN event_id % 5 IN (0, 1) THEN 'DATA_ULTRA'
                                      WHEN event_id % 5 = 2 THEN 'DATA_STD'
                                      ELSE 'DATA_PLUS' END END AS product_code
  FROM raw_src
)"""

SUBS = """
subs AS (
  SELECT '2126' || lpad(CAST(c.c_custkey AS VARCHAR), CAST(greatest(8, length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER), '0') AS customer_id,
         c.c_name AS customer_name,
         CAST(DATE '2023-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS activation_date,
         CASE WHEN c.c_custkey % 11 = 5 THEN 'prepaid' ELSE 'postpaid' END AS subscription_type,
         CASE WHEN c.c_custkey % 10 = 7 THEN 'suspended' ELSE 'active' END AS status,
         r.r_name AS region,
         CASE WHEN c.c_custkey % 13 = 3 THEN NULL
              WHEN c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Gold'
              WHEN c.c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'Silver'
              WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Titanium' END AS rate_plan_id
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
eligible AS (
  SELECT customer_id, region, rate_plan_id FROM subs
  WHERE status = 'active' AND subscription_type = 'postpaid'
)"""

DIMS = f"""
catalog AS (
  SELECT * FROM (VALUES {CATALOG}) t(product_code, service_type, unit, rate_type)
),
plans AS (
  SELECT rate_plan_id, product_code, service_type,
         CAST(unit_price AS DECIMAL(6,3)) AS unit_price,
         CAST(free_units AS INTEGER) AS free_units,
         CAST(tier_threshold AS INTEGER) AS tier_threshold,
         CAST(tier_price AS DECIMAL(6,3)) AS tier_price
  FROM (VALUES {TARIFFS})
       t(rate_plan_id, product_code, service_type, unit_price, free_units, tier_threshold, tier_price)
)"""


def _mediated_sql(pattern: str = PAT) -> str:
    callee = f"CASE WHEN {_valid('coalesce(callee_id, ' + _q('UNK') + ')', pattern)} THEN coalesce(callee_id, 'UNK') ELSE 'UNK' END"
    receiver = f"CASE WHEN {_valid('coalesce(receiver_id, ' + _q('UNK') + ')', pattern)} THEN coalesce(receiver_id, 'UNK') ELSE 'UNK' END"
    keep_voice = f"(record_type = 'voice' AND caller_id IS NOT NULL AND coalesce({_valid('caller_id', pattern)}, false) AND coalesce(duration_sec > 0, false))"
    keep_sms = f"(record_type = 'sms' AND sender_id IS NOT NULL AND coalesce({_valid('sender_id', pattern)}, false))"
    keep_data = f"(record_type = 'data' AND user_id IS NOT NULL AND coalesce({_valid('user_id', pattern)}, false))"
    return f"""
admitted AS (
  SELECT * FROM raw_cdr
  WHERE record_type IS NOT NULL AND "timestamp" IS NOT NULL
    AND CAST("timestamp" AS DATE) >= DATE '{AS_OF}'
),
admitted_k AS (
  SELECT *,
    {keep_voice} AS keep_voice, {keep_sms} AS keep_sms, {keep_data} AS keep_data,
    {callee} AS callee_c,
    (TRY_CAST(data_volume_mb AS DECIMAL(18,6)) IS NULL OR session_duration_sec IS NULL OR session_duration_sec < 0) AS review
  FROM admitted
),
mediated AS (
  SELECT record_ID, "timestamp",
    coalesce(cell_id, 'UNK') AS cell_id,
    CASE coalesce(technology, '4G') WHEN 'LTE' THEN '4G' WHEN 'NR' THEN '5G' WHEN 'UMTS' THEN '3G'
         ELSE coalesce(technology, '4G') END AS technology,
    CASE WHEN record_type = 'voice' THEN caller_id END AS caller_id,
    CASE WHEN record_type = 'voice' THEN callee_c END AS callee_id,
    CASE WHEN record_type = 'voice' THEN duration_sec END AS duration_sec,
    CASE WHEN record_type = 'voice' THEN
           CASE WHEN substr(callee_c, 1, 3) = 'UNK' THEN 'VOICE_NAT'
                WHEN substr(callee_c, 1, 3) <> '212' THEN 'VOICE_INT'
                ELSE 'VOICE_NAT' END
         WHEN record_type = 'sms' THEN 'SMS_STD'
         WHEN record_type = 'data' THEN product_code END AS product_code,
    CASE WHEN record_type = 'data' AND review THEN 'needs_review' ELSE 'ready' END AS rating_status,
    CASE WHEN record_type = 'sms' THEN sender_id END AS sender_id,
    CASE WHEN record_type = 'sms' THEN {receiver} END AS receiver_id,
    CASE WHEN record_type = 'data' THEN user_id END AS user_id,
    CASE WHEN record_type = 'data' AND session_duration_sec >= 0 THEN session_duration_sec END AS session_duration_sec,
    CASE WHEN record_type = 'data' THEN TRY_CAST(data_volume_mb AS DECIMAL(18,6)) END AS data_volume_mb,
    record_type
  FROM admitted_k
  WHERE keep_voice OR keep_sms OR keep_data
)"""


def _stable_sum_sql(rows: str, key: str, value: str) -> str:
    """CTEs of a double sum in its defined order: runs of a thousand equal
    values, then ascending in cells of 1e-5, 1e-1, 1e3, 1e7, 1e11."""
    rep = "list_reduce(list_prepend(CAST(0 AS DOUBLE), [{x} FOR i IN range(CAST({n} AS BIGINT))]), lambda a, b: a + b)"
    digits = ["n % 1000", "(n // 1000) % 1000", "(n // 1000000) % 1000", "(n // 1000000000) % 1000"]
    units = ["v", *("CASE WHEN n >= {k} THEN {s} ELSE CAST(0 AS DOUBLE) END".format(
        k=1000**k, s=rep.format(x=f"u{k - 1}", n=1000)) for k in range(1, 4))]
    steps = [f"s0 AS (SELECT {key}, {value} AS v, count(*) AS n FROM {rows} WHERE {value} IS NOT NULL GROUP BY ALL)"]
    inner = "SELECT *, v AS u0 FROM s0"
    for k in range(1, 4):
        inner = f"SELECT *, {units[k]} AS u{k} FROM ({inner})"
    total = " + ".join(["CAST(0 AS DOUBLE)", *(rep.format(x=f"u{k}", n=d) for k, d in enumerate(digits))])
    steps.append(f"l0 AS (SELECT {key}, v, {total} AS s, n FROM ({inner}))")
    fold = "list_reduce(list_prepend(CAST(0 AS DOUBLE), list(s ORDER BY v)), lambda a, b: a + b)"
    for k in range(1, 6):
        width = "1e-5" if k == 1 else "1e4"
        steps.append(
            f"l{k} AS (SELECT {key}, w AS v, {fold} AS s, CAST(sum(n) AS BIGINT) AS n "
            f"FROM (SELECT *, floor(v / CAST({width} AS DOUBLE)) AS w FROM l{k - 1}) GROUP BY {key}, w)"
        )
    steps.append(f"summed AS (SELECT {key}, {fold} AS total, CAST(sum(n) AS BIGINT) AS n FROM l5 GROUP BY {key})")
    return ",\n".join(steps)


_COST_DOUBLE = """
CASE rate_type
  WHEN 'flat' THEN CASE WHEN floor(billable_units) <= fu THEN 0 ELSE (u - fu) * up END
  WHEN 'tiered' THEN CASE WHEN floor(billable_units) <= fu THEN 0
                          WHEN floor(billable_units) <= tt THEN (u - fu) * up
                          ELSE (tt - fu) * up + (u - tt) * tp END END"""


def _rated_sql(name: str, boundary: str) -> str:
    cmp = "floor(billable_units)" if boundary == "whole_units" else "billable_units"
    return f"""
{name}_priced AS (
  SELECT *,
    CAST(CASE rate_type
      WHEN 'flat' THEN CASE WHEN {cmp} <= fu THEN 0 ELSE (billable_units - fu) * up END
      WHEN 'tiered' THEN CASE WHEN {cmp} <= fu THEN 0
                              WHEN {cmp} <= tt THEN (billable_units - fu) * up
                              ELSE (tt - fu) * up + (billable_units - tt) * tp END
    END AS DECIMAL(22,9)) AS cost
  FROM (SELECT *, coalesce(free_units, 0) AS fu, coalesce(tier_threshold, 0) AS tt,
               coalesce(unit_price, CAST(0 AS DECIMAL(6,3))) AS up,
               coalesce(tier_price, CAST(0 AS DECIMAL(6,3))) AS tp
        FROM units)
),
{name} AS (
  SELECT record_ID, record_type, "timestamp", customer_id, rate_plan_id, product_code, rate_type, unit,
         unit_price, free_units, tier_threshold, tier_price, billable_units, cost,
         CASE WHEN cost IS NULL THEN 'unmatched' ELSE 'rated' END AS rating_status,
         (rating_status = 'needs_review') AS review_flag,
         strftime("timestamp", '%Y-%m') AS billing_period
  FROM {name}_priced
)"""


RATING = """
keyed AS (
  SELECT *, CASE record_type WHEN 'voice' THEN caller_id WHEN 'sms' THEN sender_id ELSE user_id END AS customer_id
  FROM mediated
),
with_plan AS (
  SELECT k.*, e.rate_plan_id FROM keyed k JOIN eligible e ON k.customer_id = e.customer_id
),
with_catalog AS (
  SELECT w.*, c.rate_type, c.unit FROM with_plan w LEFT JOIN catalog c ON w.product_code = c.product_code
),
with_tariff AS (
  SELECT w.*, p.unit_price, p.free_units, p.tier_threshold, p.tier_price
  FROM with_catalog w
  LEFT JOIN plans p ON w.rate_plan_id = p.rate_plan_id AND w.product_code = p.product_code
),
units AS (
  SELECT *,
    CASE WHEN record_type = 'voice'
              THEN CAST(ceil(CASE WHEN duration_sec IS NULL OR duration_sec < 0 THEN 0 ELSE duration_sec END) AS DECIMAL(18,6))
         WHEN record_type = 'sms' THEN CAST(1 AS DECIMAL(18,6))
         ELSE coalesce(CAST(data_volume_mb AS DECIMAL(18,6)), CAST(0 AS DECIMAL(18,6))) END AS billable_units
  FROM with_tariff
),""" + _rated_sql("rated", "whole_units") + "," + _rated_sql("rated_exact", "exact")


def _billing_sql() -> str:
    disc, vat, fee = DISCOUNT, VAT, FEE
    months = ", ".join(_q(m) for m in FIXTURE_MONTHS)

    def invoice_cte(name: str, month_expr: str, source: str) -> str:
        return f"""
{name} AS (
  SELECT e.customer_id, e.billing_period, e.region, e.rate_plan_id,
    coalesce(t.voice_total, 0) AS voice_total,
    coalesce(t.sms_total, 0) AS sms_total,
    coalesce(t.data_total, 0) AS data_total,
    coalesce(t.amount_before_tax, 0) AS amount_before_tax,
    coalesce(t.discount_pct, {disc}) AS discount_pct,
    coalesce(t.after_discount, 0) AS after_discount,
    coalesce(t.tax, 0) AS tax,
    coalesce(t.amount_due, 0) AS amount_due
  FROM (SELECT customer_id, region, rate_plan_id, {month_expr} AS billing_period FROM eligible) e
  LEFT JOIN {source} t ON t.customer_id = e.customer_id AND t.billing_period = e.billing_period
)"""

    return f"""
subtotals AS (
  SELECT customer_id, billing_period,
    CAST(sum(CASE WHEN record_type = 'voice' THEN cost ELSE CAST(0 AS DECIMAL(22,9)) END) AS DECIMAL(22,9)) AS voice_total,
    CAST(sum(CASE WHEN record_type = 'sms' THEN cost ELSE CAST(0 AS DECIMAL(22,9)) END) AS DECIMAL(22,9)) AS sms_total,
    CAST(sum(CASE WHEN record_type = 'data' THEN cost ELSE CAST(0 AS DECIMAL(22,9)) END) AS DECIMAL(22,9)) AS data_total,
    CAST(sum(cost) AS DECIMAL(22,9)) AS amount_before_tax
  FROM rated WHERE rating_status = 'rated'
  GROUP BY customer_id, billing_period
),
totals AS (
  SELECT *, round(after_discount + tax + {fee}, 2) AS amount_due
  FROM (SELECT *, after_discount * {vat} AS tax
        FROM (SELECT *, {disc} AS discount_pct, amount_before_tax * (1 - {disc}) AS after_discount
              FROM subtotals))
),""" + invoice_cte("inv_month", _q(MONTH), "totals") + "," + invoice_cte(
        "inv_all", f"unnest([{months}])", "totals"
    )


CHAIN = "WITH " + ",".join([RAW_CDR, SUBS, DIMS, _mediated_sql(), RATING, _billing_sql()]) + "\n"

MONEY_OUT = "CAST({c} AS DOUBLE) AS {c}"


def _d(*cols: str) -> str:
    return ", ".join(MONEY_OUT.format(c=c) for c in cols)


MEDIATED_OUT = (
    'record_ID, "timestamp", cell_id, technology, caller_id, callee_id, duration_sec, product_code, '
    "rating_status, sender_id, receiver_id, user_id, session_duration_sec, "
    "CAST(data_volume_mb AS DOUBLE) AS data_volume_mb, record_type"
)
RAW_OUT = (
    'record_ID, record_type, "timestamp", cell_id, technology, caller_id, callee_id, duration_sec, '
    "sender_id, receiver_id, user_id, data_volume_mb, session_duration_sec, product_code"
)
RATED_OUT = (
    "record_ID, record_type, customer_id, rate_plan_id, product_code, rate_type, "
    "CAST(billable_units AS DOUBLE) AS billable_units, CAST(cost AS DOUBLE) AS cost, "
    "rating_status, review_flag, billing_period"
)
INVOICE_OUT = (
    "customer_id, billing_period, region, rate_plan_id, "
    + _d("voice_total", "sms_total", "data_total", "amount_before_tax", "discount_pct", "after_discount", "tax", "amount_due")
)


def _clean_out(kind: str) -> str:
    cols = {
        "voice": 'record_ID, "timestamp", cell_id, technology, caller_id, callee_id, duration_sec, product_code, rating_status, record_type',
        "sms": 'record_ID, "timestamp", cell_id, technology, product_code, rating_status, sender_id, receiver_id, record_type',
        "data": 'record_ID, "timestamp", cell_id, technology, product_code, rating_status, user_id, session_duration_sec, '
        "CAST(data_volume_mb AS DOUBLE) AS data_volume_mb, record_type",
    }[kind]
    return f"SELECT {cols} FROM mediated WHERE record_type = '{kind}'"


def _split_all() -> str:
    return """SELECT record_ID, record_type, "timestamp", cell_id, technology,
  CASE WHEN record_type = 'voice' THEN caller_id END AS caller_id,
  CASE WHEN record_type = 'voice' THEN callee_id END AS callee_id,
  CASE WHEN record_type = 'voice' THEN duration_sec END AS duration_sec,
  CASE WHEN record_type = 'sms' THEN sender_id END AS sender_id,
  CASE WHEN record_type = 'sms' THEN receiver_id END AS receiver_id,
  CASE WHEN record_type = 'data' THEN user_id END AS user_id,
  CASE WHEN record_type = 'data' THEN data_volume_mb END AS data_volume_mb,
  CASE WHEN record_type = 'data' THEN session_duration_sec END AS session_duration_sec,
  product_code
FROM admitted WHERE record_type IN ('voice', 'sms', 'data')"""


def _half_up_avg(total: str, count: str) -> str:
    n = f"CAST(CAST({total} AS DECIMAL(28,9)) * 1000000000 AS HUGEINT)"
    return (
        f"(CAST(((2 * abs({n}) + 1000 * {count}) // (2000 * {count})) * sign({n}) AS DOUBLE) / CAST(1000000 AS DOUBLE))"
    )


def _key_expr(col: str) -> str:
    return f"CAST((CAST('0x' || substr(md5({col}), 1, 8) AS BIGINT) % 1000) + 1 AS VARCHAR)"


BODIES: dict[str, str] = {
    "decode_json": f"SELECT {RAW_OUT} FROM raw_cdr",
    "decode_json_times": """
SELECT record_ID,
  CASE WHEN CAST(record_ID AS BIGINT) % 4 = 3 THEN date_trunc('second', "timestamp") ELSE "timestamp" END AS "timestamp"
FROM raw_cdr WHERE "timestamp" IS NOT NULL""",
    "encode_decode_roundtrip": f"SELECT {_key_expr('record_ID')} AS key, record_ID, true AS roundtrip_ok FROM raw_cdr",
    "dim_insert_absent": """
SELECT * FROM subs WHERE activation_date < DATE '2023-07-01'
UNION ALL
SELECT customer_id, upper(customer_name) AS customer_name, activation_date, subscription_type, status, region, rate_plan_id
FROM subs WHERE NOT (activation_date < DATE '2023-07-01')""",
    "dim_merge": """
SELECT * FROM subs WHERE activation_date < DATE '2023-07-01'
UNION ALL
SELECT customer_id, upper(customer_name) AS customer_name, activation_date, subscription_type, status, region, rate_plan_id
FROM subs WHERE NOT (activation_date < DATE '2023-07-01')""",
    "product_dim": """
SELECT c.product_code, c.service_type, c.unit, c.rate_type,
  coalesce(t.records, 0) AS records, CAST(coalesce(t.units, 0) AS DOUBLE) AS billable_units
FROM catalog c LEFT JOIN (
  SELECT product_code, count(*) AS records,
    sum(CASE WHEN record_type = 'voice'
             THEN CAST(ceil(CASE WHEN duration_sec IS NULL OR duration_sec < 0 THEN 0 ELSE duration_sec END) AS DECIMAL(18,6))
             WHEN record_type = 'sms' THEN CAST(1 AS DECIMAL(18,6))
             ELSE coalesce(data_volume_mb, CAST(0 AS DECIMAL(18,6))) END) AS units
  FROM mediated GROUP BY product_code) t ON c.product_code = t.product_code""",
    "rate_plan_dim": """
SELECT p.rate_plan_id, p.product_code, p.service_type, CAST(p.unit_price AS DOUBLE) AS unit_price, p.free_units,
  p.tier_threshold, CAST(p.tier_price AS DOUBLE) AS tier_price,
  coalesce(u.records, 0) AS records, CAST(coalesce(u.charged, 0) AS DOUBLE) AS charged
FROM plans p LEFT JOIN (
  SELECT rate_plan_id, product_code, count(*) AS records, sum(cost) AS charged
  FROM rated WHERE rating_status = 'rated' GROUP BY rate_plan_id, product_code) u
ON p.rate_plan_id = u.rate_plan_id AND p.product_code = u.product_code""",
    "filter_required": f'SELECT {RAW_OUT} FROM raw_cdr WHERE record_type IS NOT NULL AND "timestamp" IS NOT NULL',
    "filter_fresh": f"SELECT {RAW_OUT} FROM admitted",
    "split_by_type": _split_all(),
    "clean_voice": _clean_out("voice"),
    "clean_sms": _clean_out("sms"),
    "clean_data": _clean_out("data"),
    "mediated": f"SELECT {MEDIATED_OUT} FROM mediated",
    "msisdn_validity": f"""
SELECT record_ID, record_type, payer, other_party,
  {_valid('payer')} AS payer_valid, {_valid('other_party')} AS other_valid,
  {_valid('payer', PAT_STRICT)} AS payer_valid_strict, {_valid('other_party', PAT_STRICT)} AS other_valid_strict
FROM (SELECT record_ID, record_type, coalesce(caller_id, sender_id, user_id) AS payer,
             coalesce(callee_id, receiver_id) AS other_party FROM raw_cdr)""",
    "technology_mix": "SELECT record_type, technology, count(*) AS records FROM mediated GROUP BY record_type, technology",
    "voice_product": "SELECT record_ID, callee_id, product_code FROM mediated WHERE record_type = 'voice'",
    "review_queue": """
SELECT record_ID, user_id, product_code, CAST(data_volume_mb AS DOUBLE) AS data_volume_mb, session_duration_sec, rating_status
FROM mediated WHERE rating_status = 'needs_review'""",
    "clean_data_export": """
SELECT record_ID, user_id, product_code, rating_status,
  coalesce(CAST(session_duration_sec AS VARCHAR), 'UNK') AS session_duration_sec,
  coalesce(regexp_replace(CAST(data_volume_mb AS VARCHAR), '(\\.\\d+?)0+$', '\\1'), 'UNK') AS data_volume_mb
FROM mediated WHERE record_type = 'data'""",
    "mediation_audit": """
SELECT record_type, admitted, mediated, needs_review, admitted - mediated AS dropped FROM (
  SELECT record_type, count(*) AS admitted,
    count(*) FILTER (WHERE keep_voice OR keep_sms OR keep_data) AS mediated,
    count(*) FILTER (WHERE keep_data AND review) AS needs_review
  FROM admitted_k GROUP BY record_type)""",
    "dedup_cdr": f"SELECT {MEDIATED_OUT}, CAST(0 AS BIGINT) AS batch_id FROM mediated",
    "dedup_cdr_dirty": f"""
SELECT {MEDIATED_OUT}, CAST(0 AS BIGINT) AS batch_id FROM mediated WHERE CAST(record_ID AS BIGINT) % 7 <> 0
UNION ALL SELECT * FROM (
  SELECT DISTINCT {MEDIATED_OUT}, CAST(0 AS BIGINT) AS batch_id
  FROM (SELECT * REPLACE (NULL AS record_ID) FROM mediated WHERE CAST(record_ID AS BIGINT) % 7 = 0))
UNION ALL SELECT * FROM (
  SELECT DISTINCT {MEDIATED_OUT}, CAST(1 AS BIGINT) AS batch_id
  FROM (SELECT * REPLACE (NULL AS record_ID, 'CELL_RE' AS cell_id) FROM mediated WHERE CAST(record_ID AS BIGINT) % 21 = 0))""",
    "stream_dedup": f"SELECT {MEDIATED_OUT} FROM mediated",
    "stream_dedup_state": f"SELECT {MEDIATED_OUT} FROM mediated",
    "stream_mediation": f"SELECT {MEDIATED_OUT}, CAST(0 AS BIGINT) AS batch_id FROM mediated",
    "customer_key": "SELECT record_ID, record_type, customer_id FROM keyed",
    "eligible_customers": "SELECT customer_id, region, rate_plan_id FROM eligible",
    "cdr_with_plan": "SELECT record_ID, customer_id, rate_plan_id, product_code FROM with_plan",
    "cdr_with_catalog": "SELECT record_ID, customer_id, rate_plan_id, product_code, rate_type, unit FROM with_catalog",
    "cdr_with_tariff": f"""
SELECT record_ID, customer_id, rate_plan_id, product_code, rate_type, {_d('unit_price')}, free_units, tier_threshold,
  {_d('tier_price')} FROM with_tariff""",
    "billable_units": "SELECT record_ID, record_type, product_code, CAST(billable_units AS DOUBLE) AS billable_units FROM rated",
    "rated_cost": f"SELECT {RATED_OUT} FROM rated",
    "rated_clustered": f"SELECT {RATED_OUT} FROM rated",
    "rated_store_roundtrip": f"""
SELECT {RATED_OUT} FROM rated
WHERE billing_period NOT IN ('2024-02', '2024-03') OR (billing_period = '2024-02' AND record_type = 'voice')""",
    "rated_cost_exact": f"SELECT {RATED_OUT} FROM rated_exact",
    "rated_flat": f"SELECT {RATED_OUT} FROM rated WHERE rate_type = 'flat'",
    "rated_tiered": f"SELECT {RATED_OUT} FROM rated WHERE rate_type = 'tiered'",
    "rating_status_mix": """
SELECT rating_status, review_flag, product_code, count(*) AS records FROM rated
GROUP BY rating_status, review_flag, product_code""",
    "usage_by_period": """
SELECT billing_period, product_code, count(*) AS records,
  CAST(sum(billable_units) AS DOUBLE) AS total_units, CAST(sum(cost) AS DOUBLE) AS total_cost
FROM rated WHERE rating_status = 'rated' GROUP BY billing_period, product_code""",
    "invoice_subtotals": f"SELECT customer_id, billing_period, {_d('voice_total', 'sms_total', 'data_total', 'amount_before_tax')} FROM subtotals",
    "invoice_totals": f"""
SELECT customer_id, billing_period,
  {_d('voice_total', 'sms_total', 'data_total', 'amount_before_tax', 'discount_pct', 'after_discount', 'tax', 'amount_due')}
FROM totals""",
    "invoice_month": f"SELECT {INVOICE_OUT} FROM inv_month",
    "invoice_all_months": f"SELECT {INVOICE_OUT} FROM inv_all",
    "invoice_bucketed": f"SELECT {INVOICE_OUT} FROM inv_all",
    "invoice_incremental": f"SELECT {INVOICE_OUT} FROM inv_all",
    "top_customers": """
SELECT customer_id, CAST(sum(data_total) AS DOUBLE) AS total_data_usage, CAST(sum(amount_due) AS DOUBLE) AS total_amount_due
FROM inv_month WHERE data_total > 0 GROUP BY customer_id""",
    "report_order": """
SELECT 'customers' AS report, customer_id AS k1, CAST(NULL AS VARCHAR) AS k2,
  row_number() OVER (ORDER BY sum(data_total) DESC, customer_id) AS rank
FROM inv_month WHERE data_total > 0 GROUP BY customer_id
UNION ALL
SELECT 'plans', rate_plan_id, NULL, row_number() OVER (ORDER BY sum(amount_due) DESC, rate_plan_id NULLS LAST)
FROM inv_month GROUP BY rate_plan_id
UNION ALL
SELECT 'regions', region, rate_plan_id,
  row_number() OVER (ORDER BY region NULLS FIRST, sum(amount_due) DESC, rate_plan_id NULLS LAST)
FROM inv_month GROUP BY region, rate_plan_id""",
    "revenue_by_plan": "SELECT rate_plan_id, CAST(sum(amount_due) AS DOUBLE) AS revenue_TTC FROM inv_month GROUP BY rate_plan_id",
    "report_csv_roundtrip": "SELECT rate_plan_id, CAST(sum(amount_due) AS DOUBLE) AS revenue_TTC FROM inv_month GROUP BY rate_plan_id",
    "revenue_by_region_plan": """
SELECT region, rate_plan_id, CAST(sum(amount_due) AS DOUBLE) AS revenue_TTC FROM inv_month GROUP BY region, rate_plan_id""",
    "product_cost": f"""
SELECT product_code, CAST(floor(total * 100) / 100 AS DOUBLE) AS total_cost, record_count,
  {_half_up_avg('total', 'record_count')} AS avg_cost_per_record
FROM (SELECT product_code, sum(cost) AS total, count(*) AS record_count FROM rated
      WHERE rating_status = 'rated' GROUP BY product_code)""",
    "product_cost_double": f"""
SELECT * FROM (WITH charged AS (
  SELECT product_code, CAST({_COST_DOUBLE} AS DOUBLE) AS cost
  FROM (SELECT *, CAST(billable_units AS DOUBLE) AS u, coalesce(free_units, 0) AS fu, coalesce(tier_threshold, 0) AS tt,
               coalesce(CAST(unit_price AS DOUBLE), 0) AS up, coalesce(CAST(tier_price AS DOUBLE), 0) AS tp FROM units)
),
{_stable_sum_sql('charged', 'product_code', 'cost')}
SELECT product_code, CAST(floor(total * 100) / 100 AS DOUBLE) AS total_cost, n AS record_count,
  total / n AS avg_cost_per_record FROM summed)""",
    "dq_keys": """
SELECT 'duplicate_key' AS check_name, 'cdr_feed:record_ID' AS target,
  (SELECT count(*) FROM (SELECT record_ID FROM raw_cdr GROUP BY record_ID HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'null_required', 'cdr_feed:record_type,timestamp',
  (SELECT count(*) FROM raw_cdr WHERE record_type IS NULL OR "timestamp" IS NULL)
UNION ALL SELECT 'duplicate_key', 'subscriptions:customer_id',
  (SELECT count(*) FROM (SELECT customer_id FROM subs GROUP BY customer_id HAVING count(*) > 1))
UNION ALL SELECT 'null_required', 'subscriptions:customer_id,customer_name,activation_date,subscription_type,status',
  (SELECT count(*) FROM subs WHERE customer_id IS NULL OR customer_name IS NULL OR activation_date IS NULL
     OR subscription_type IS NULL OR status IS NULL)
UNION ALL SELECT 'duplicate_key', 'rate_plans:rate_plan_id,product_code',
  (SELECT count(*) FROM (SELECT 1 FROM plans GROUP BY rate_plan_id, product_code HAVING count(*) > 1))
UNION ALL SELECT 'duplicate_key', 'product_catalog:product_code',
  (SELECT count(*) FROM (SELECT 1 FROM catalog GROUP BY product_code HAVING count(*) > 1))""",
    "dq_orphans": """
SELECT 'cdr_product_not_in_catalog' AS check_name, m.product_code AS key, count(*) AS rows
FROM mediated m WHERE m.product_code IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM catalog c WHERE c.product_code = m.product_code) GROUP BY m.product_code
UNION ALL
SELECT 'cdr_payer_not_eligible', k.record_type, count(*)
FROM keyed k WHERE k.customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM eligible e WHERE e.customer_id = k.customer_id) GROUP BY k.record_type
UNION ALL
SELECT 'subscription_plan_unknown', s.rate_plan_id, count(*)
FROM subs s WHERE s.rate_plan_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM plans p WHERE p.rate_plan_id = s.rate_plan_id) GROUP BY s.rate_plan_id
UNION ALL
SELECT 'tariff_product_not_in_catalog', p.product_code, count(*)
FROM plans p WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.product_code = p.product_code) GROUP BY p.product_code
UNION ALL
SELECT 'known_product_without_tariff', product_code, count(*)
FROM rated WHERE rate_type IS NOT NULL AND unit_price IS NULL GROUP BY product_code""",
}


# The same chain over a feed with fine and out-of-range volumes.
FINE_CHAIN = CHAIN.replace("raw_cdr AS (", "plain_cdr AS (", 1).replace(
    "subs AS (",
    """raw_cdr AS (
  SELECT * REPLACE (
    CASE WHEN data_volume_mb IS NULL THEN NULL
         WHEN CAST(record_ID AS BIGINT) % 17 = 0 THEN CAST(1e13 AS DOUBLE)
         WHEN CAST(record_ID AS BIGINT) % 23 = 0 THEN CAST(100.996 AS DOUBLE)
         ELSE CAST(CAST(data_volume_mb AS DECIMAL(18,6))
                   + CAST(CAST(record_ID AS BIGINT) % 1000000 AS DECIMAL(18,6)) * CAST(0.000001 AS DECIMAL(7,6)) AS DOUBLE)
    END AS data_volume_mb)
  FROM plain_cdr
),
subs AS (""",
    1,
)
FINE_BODIES = {
    "billable_units_fine": "SELECT record_ID, record_type, product_code, CAST(billable_units AS DOUBLE) AS billable_units, review_flag FROM rated",
    "rated_cost_fine": f"SELECT {RATED_OUT} FROM rated",
}


def oracle_sql() -> dict[str, str]:
    plain = {name: CHAIN + body.strip() for name, body in BODIES.items()}
    return plain | {name: FINE_CHAIN + body for name, body in FINE_BODIES.items()}
