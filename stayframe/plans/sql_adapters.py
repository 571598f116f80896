"""The adapters of ``stayframe.sources.adapters`` written as DuckDB CTEs, so
oracle statements run straight on the raw parquet views."""

SUBJECTS = """subjects AS (
  SELECT c.c_custkey AS subject_id,
    CASE WHEN c.c_custkey % 50 <> 0 THEN CAST(DATE '1900-01-01' + CAST(c.c_custkey * 37 % 40000 AS INTEGER) AS TIMESTAMP) END AS dob,
    CASE WHEN c.c_custkey % 3 = 0 THEN CAST(DATE '1995-01-01' + CAST(c.c_custkey * 53 % 2500 AS INTEGER) AS TIMESTAMP) END AS dod,
    c.c_mktsegment AS gender_raw, n.n_name AS ethnicity_raw, r.r_name AS region_raw
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

EPISODES = """episodes AS (
  SELECT o_custkey AS subject_id, o_orderkey AS admission_id,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) END AS admittime,
    CASE WHEN o_orderkey % 89 <> 0 THEN o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT))
         + to_hours(CAST(o_orderkey * 7 % 400 - 5 AS BIGINT)) END AS dischtime,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 41 = 0 THEN NULL ELSE 0 END AS expire_flag,
    o_orderpriority AS priority_raw, o_orderstatus AS status_raw
  FROM orders)"""

IDS = "ids AS (SELECT c_custkey AS subject_id FROM customer)"

FIRST_EP = """first_ep AS (
  SELECT subject_id, admission_id, admittime, dischtime FROM (
    SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY admittime, admission_id) AS rn
    FROM episodes WHERE admittime IS NOT NULL AND subject_id IN (SELECT subject_id FROM ids)) t
  WHERE rn = 1)"""

DURATION = """dur AS (
  SELECT *, (epoch_us(dischtime) - epoch_us(admittime)) / 3600000000.0 AS duration_hours
  FROM first_ep WHERE admittime IS NOT NULL AND dischtime IS NOT NULL
    AND epoch_us(dischtime) > epoch_us(admittime))"""

AGED = """aged AS (
  SELECT d.*, s.dob,
    year(d.admittime) - year(s.dob)
      - CASE WHEN month(d.admittime) * 100 + day(d.admittime) < month(s.dob) * 100 + day(s.dob) THEN 1 ELSE 0 END AS age
  FROM dur d LEFT JOIN subjects s USING (subject_id)
  WHERE d.duration_hours >= 54)"""

REASONED = """reasoned AS (
  SELECT *, CASE WHEN age IS NULL THEN 'na_age' WHEN age < 0 THEN 'negative_age'
                 WHEN age < 18 THEN 'under18' WHEN age > 89 THEN 'age90plus' END AS drop_reason
  FROM aged)"""

COHORT = """cohort AS (
  SELECT subject_id, admission_id, admittime, dischtime FROM reasoned WHERE drop_reason IS NULL)"""

SECOND = """second_ep AS (
  SELECT s.subject_id, r.admission_id AS second_admission_id, r.admittime AS second_admittime,
         r.dischtime AS second_dischtime,
         coalesce(r.admission_id IS NOT NULL AND r.admittime IS NOT NULL AND r.dischtime IS NOT NULL
                  AND r.dischtime <= r.admittime, false) AS nonpositive_duration
  FROM (SELECT DISTINCT subject_id FROM cohort) s
  LEFT JOIN (SELECT * FROM (
      SELECT e.*, row_number() OVER (PARTITION BY e.subject_id ORDER BY e.admittime NULLS LAST, e.admission_id) AS rn
      FROM episodes e WHERE e.subject_id IN (SELECT subject_id FROM cohort)) x WHERE rn = 2) r
  ON s.subject_id = r.subject_id)"""

COHORT_CHAIN = [SUBJECTS, EPISODES, IDS, FIRST_EP, DURATION, AGED, REASONED, COHORT]

MEASUREMENTS = """meas AS (
  SELECT user_id AS subject_id, user_id AS admission_id, event_type AS itemid, event_type AS feature_name,
         ts AS charttime, value AS valuenum, event_id AS row_id FROM events)"""

MEAS_COHORT = """mcohort AS (
  SELECT user_id AS subject_id, user_id AS admission_id, min(ts) AS admittime FROM events GROUP BY user_id)"""

DIRTY = """dirty AS (
  SELECT user_id AS subject_id, user_id AS admission_id, event_type AS itemid, ts AS charttime,
         CASE WHEN event_id % 13 <> 0 THEN value END AS valuenum,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
         'u' AS valueuom, event_id AS row_id FROM events)"""

DICTIONARY = """dict AS (
  SELECT * FROM (VALUES ('error', 'Error', 1.0, 150.0), ('click', 'Click', 1.0, 150.0),
                        ('view', 'TempF', 5.0, 120.0), ('signup', 'Signup', 0.0, 200.0))
    t(itemid, feature_name, min_bound, max_bound))"""

INTERVALS = """ivl AS (
  SELECT l.l_suppkey AS subject_id, l.l_suppkey AS admission_id, l.l_shipdate AS startdate,
         l.l_shipdate + to_days(CAST(l.l_quantity AS INTEGER)) AS enddate,
         p.p_name AS drug, p.p_name AS drug_name_generic, l.l_returnflag AS route
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

INTERVAL_COHORT = """icohort AS (
  SELECT s_suppkey AS subject_id, s_suppkey AS admission_id,
         CAST(DATE '1998-01-01' + CAST(s_suppkey AS INTEGER) AS TIMESTAMP) AS admittime FROM supplier)"""

NOTES = """notes AS (
  SELECT conv_id AS subject_id, conv_id AS admission_id,
         CASE WHEN (conv_id + turn) % 11 <> 0 THEN TIMESTAMP '2024-01-01' + to_hours(CAST(turn * 7 AS BIGINT)) END AS charttime,
         CAST(DATE '2024-01-01' + CAST(turn AS INTEGER) AS DATE) AS chartdate,
         role AS category, role AS description, text,
         CASE WHEN (conv_id + turn) % 13 = 0 THEN 1 WHEN (conv_id + turn) % 7 = 0 THEN NULL ELSE 0 END AS iserror,
         turn AS row_id
  FROM conversations)"""

NOTE_COHORT = """ncohort AS (
  SELECT DISTINCT conv_id AS subject_id, conv_id AS admission_id, TIMESTAMP '2024-01-01' AS admittime,
         TIMESTAMP '2024-01-03' AS dischtime FROM conversations)"""

DOC_NOTES = """dnotes AS (
  SELECT doc_id % 150 AS subject_id, doc_id % 150 AS admission_id, source AS category, lang AS description,
         text, doc_id AS row_id FROM documents)"""


def predictions(target: str = "quality") -> str:
    return f"""preds AS (
  SELECT l.doc_id AS subject_id, CAST(l.{target} AS INTEGER) AS y_true, (d.n_chars % 1000) / 1000.0 AS y_pred,
         d.lang AS grp
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
