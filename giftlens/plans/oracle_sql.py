"""DuckDB SQL oracles for the registered queries.

Each string is an independent statement of what the matching Spark query
computes, over the raw tables (``orders``, ``customer``, ...).  The
fixture views are shared CTEs.
"""

from __future__ import annotations

GIFTS = """
gifts AS (
  SELECT o.o_orderkey AS ReceiptSeq, CAST(o.o_custkey AS VARCHAR) AS ID, o.o_orderdate AS Date,
    o.o_totalprice AS Amount, o.o_orderpriority AS Appeal,
    CONCAT('F', CAST(o.o_orderkey % 6 AS VARCHAR)) AS Fund,
    n2.n_name AS AppealDescription, r2.r_name AS FundDescription,
    CASE c.c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN ' M ' WHEN 2 THEN '' END AS Gender,
    c.c_mktsegment AS OccupDesc, CONCAT('R', CAST(c.c_custkey % 7 AS VARCHAR)) AS ReligionCode,
    n.n_name AS Suburb, r.r_name AS State, o.o_orderstatus AS Education,
    CAST(c.c_custkey % 2 AS INT) AS CurrentParent,
    CASE WHEN c.c_custkey % 4 >= 2 THEN 1 ELSE 0 END AS PastParent,
    CASE WHEN c.c_custkey % 8 >= 4 THEN 1 ELSE 0 END AS PastStudent,
    CASE WHEN c.c_custkey % 16 >= 8 THEN 1 ELSE 0 END AS FutureParent
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN nation n2 ON o.o_orderkey % 27 = n2.n_nationkey
  LEFT JOIN region r2 ON o.o_orderkey % 6 = r2.r_regionkey
)"""


def _cat(c: str) -> str:
    return (f"CASE WHEN trim({c}) IS NULL OR trim({c}) IN ('', 'nan') THEN 'Missing' "
            f"ELSE trim({c}) END AS {c}")


CATS = ("Gender", "Suburb", "State", "OccupDesc", "ReligionCode", "Education",
        "Appeal", "Fund", "AppealDescription", "FundDescription")

CLEAN = GIFTS + """,
clean AS (
  SELECT ReceiptSeq, ID, Date, Amount,
    """ + ",\n    ".join(_cat(c) for c in CATS) + """,
    CurrentParent, PastParent, PastStudent, FutureParent,
    CAST(year(Date) AS INTEGER) AS Year, CAST(date_trunc('month', Date) AS DATE) AS MonthPeriod,
    strftime(Date, '%Y-%m') AS Month
  FROM gifts WHERE Amount > 0 AND NOT isnan(Amount)
)"""

MONEY = "CAST(SUM(CAST({x} AS DECIMAL(28,4))) AS DOUBLE)"


def money(x: str = "Amount") -> str:
    return MONEY.format(x=x)


def _trend_year(where: str = "") -> str:
    return f"""
WITH {CLEAN},
t AS (
  SELECT Year, {money()} AS total_amount, COUNT(DISTINCT ID) AS donors, COUNT(*) AS donation_count
  FROM clean WHERE Year IS NOT NULL {where} GROUP BY Year
),
r AS (
  SELECT *, total_amount / donation_count AS avg_amount_per_donation,
    total_amount / donors AS avg_amount_per_donor, donation_count / donors AS avg_donations_per_donor
  FROM t
)
SELECT *,
  (total_amount / LAG(total_amount) OVER (ORDER BY Year) - 1) * 100 AS "YoY_total_growth_%",
  (CAST(donors AS DOUBLE) / LAG(donors) OVER (ORDER BY Year) - 1) * 100 AS "YoY_donor_growth_%",
  (avg_amount_per_donation / LAG(avg_amount_per_donation) OVER (ORDER BY Year) - 1) * 100
    AS "YoY_avg_donation_growth_%"
FROM r ORDER BY Year DESC"""


ORACLE: dict[str, str] = {}

ORACLE["trend_year"] = _trend_year()

ORACLE["trend_year_major"] = _trend_year("AND Amount >= 450000")

ORACLE["trend_month"] = f"""
WITH {CLEAN}
SELECT Month, {money()} AS total_amount, COUNT(DISTINCT ID) AS donors, COUNT(*) AS donation_count,
  {money()} / COUNT(*) AS avg_amount_per_donation,
  {money()} / COUNT(DISTINCT ID) AS avg_amount_per_donor,
  COUNT(*) / COUNT(DISTINCT ID) AS avg_donations_per_donor
FROM clean WHERE MonthPeriod IS NOT NULL GROUP BY Month ORDER BY Month DESC"""


def _dist(col: str, top: int | None) -> str:
    lim = f"LIMIT {top}" if top else ""
    return f"""
WITH {CLEAN}
SELECT {col}, {money()} AS total_amount, COUNT(DISTINCT ID) AS donors, COUNT(*) AS donation_count,
  {money()} / COUNT(*) AS avg_amount_per_donation,
  {money()} / COUNT(DISTINCT ID) AS avg_amount_per_donor
FROM clean WHERE {col} IS NOT NULL GROUP BY {col}
ORDER BY total_amount DESC, donation_count DESC, {col} ASC {lim}"""


ORACLE["dist_gender"] = _dist("Gender", 50)
ORACLE["dist_occupation"] = _dist("OccupDesc", 50)
ORACLE["dist_religion"] = _dist("ReligionCode", 50)
ORACLE["dist_suburb"] = _dist("Suburb", 50)
ORACLE["appeal_performance"] = _dist("Appeal", None)
ORACLE["fund_performance"] = _dist("Fund", None)


ORACLE["category_reports"] = " UNION ALL ".join(
    f"SELECT '{c}' AS report, {c} AS category, * EXCLUDE ({c}) FROM ({_dist(c, top)})"
    for c, top in (("Gender", 3), ("OccupDesc", 3), ("ReligionCode", 3), ("Suburb", 3), ("Appeal", None), ("Fund", None)))
ORACLE["stream_trend_month"] = (f"SELECT Month, total_amount, donation_count, avg_amount_per_donation, "
                                f"TRUE AS donors_within_four_errors FROM ({ORACLE['trend_month']})")
ORACLE["flag_key"] = """
SELECT CAST(c_custkey AS VARCHAR) AS ID, CAST(8 * (c_custkey % 2) + 4 * (c_custkey % 4 >= 2)::INT
  + 2 * (c_custkey % 8 >= 4)::INT + (c_custkey % 16 >= 8)::INT AS INTEGER) AS RelationshipKey
FROM customer"""


def _decade(age: str) -> str:
    low = f"CAST(({age}) - ({age}) % 10 AS BIGINT)"
    return (f"CASE WHEN CAST(ID AS BIGINT) % 9 > 0 THEN "
            f"CONCAT(CAST({low} AS VARCHAR), '-', CAST({low} + 9 AS VARCHAR)) END")


AGED = CLEAN + f""",
aged AS (
  SELECT *, {_decade("CAST(ID AS BIGINT) % 50 + 20")} AS AgeGroup,
    {_decade("CAST(ID AS BIGINT) % 50 + 20 + Year - 1995")} AS AgeGroupAtDonation
  FROM clean
)"""

ORACLE["dist_agegroup"] = f"""
WITH {AGED}
SELECT AgeGroup, {money()} AS total_amount, COUNT(DISTINCT ID) AS donors, COUNT(*) AS donation_count,
  {money()} / COUNT(*) AS avg_amount_per_donation, {money()} / COUNT(DISTINCT ID) AS avg_amount_per_donor
FROM aged WHERE AgeGroup IS NOT NULL GROUP BY AgeGroup"""

ORACLE["relationship_agegroup"] = f"""
WITH {AGED}
SELECT CurrentParent, PastParent, PastStudent, FutureParent, AgeGroupAtDonation,
  COUNT(DISTINCT ID) AS donor_count, COUNT(*) AS donation_count, {money()} AS total_amount,
  {money()} / COUNT(*) AS avg_amount_per_donation, {money()} / COUNT(DISTINCT ID) AS avg_amount_per_donor
FROM aged WHERE AgeGroupAtDonation IS NOT NULL AND CurrentParent IS NOT NULL AND PastParent IS NOT NULL
  AND PastStudent IS NOT NULL AND FutureParent IS NOT NULL
GROUP BY CurrentParent, PastParent, PastStudent, FutureParent, AgeGroupAtDonation"""

ORACLE["relationship_summary"] = f"""
WITH {CLEAN}
SELECT CurrentParent, PastParent, PastStudent, FutureParent,
  COUNT(DISTINCT ID) AS donors, COUNT(*) AS donation_count, {money()} AS total_amount,
  {money()} / COUNT(Amount) AS avg_amount, round(quantile_cont(Amount, 0.5), 6) AS median_amount
FROM clean GROUP BY CurrentParent, PastParent, PastStudent, FutureParent"""

ORACLE["relationship_trend"] = f"""
WITH {CLEAN}
SELECT Year, CurrentParent, PastParent, PastStudent, FutureParent,
  {money()} AS total_amount, COUNT(*) AS donation_count
FROM clean WHERE Year IS NOT NULL
GROUP BY Year, CurrentParent, PastParent, PastStudent, FutureParent"""

# -- dirty receipts ----------------------------------------------------------

DIRTY = """
dirty AS (
  SELECT event_id AS ReceiptSeq,
    CASE event_id % 13 WHEN 0 THEN 'NA' WHEN 1 THEN CONCAT(' 00', CAST(user_id AS VARCHAR), ' ')
         ELSE CONCAT('00', CAST(user_id AS VARCHAR)) END AS ID,
    CASE event_id % 5
      WHEN 0 THEN CONCAT(LPAD(CAST(day(ts) AS VARCHAR), 2, '0'), '/', LPAD(CAST(month(ts) AS VARCHAR), 2, '0'),
                         '/', CAST(year(ts) AS VARCHAR))
      WHEN 1 THEN 'not a date' WHEN 2 THEN NULL
      ELSE CONCAT(CAST(year(ts) AS VARCHAR), '-', LPAD(CAST(month(ts) AS VARCHAR), 2, '0'), '-',
                  LPAD(CAST(day(ts) AS VARCHAR), 2, '0')) END AS Date,
    CASE event_id % 11 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN '-5' WHEN 3 THEN '0' WHEN 4 THEN '12d'
         WHEN 5 THEN 'NaN' WHEN 6 THEN ' 12.5 ' ELSE CAST(value AS VARCHAR) END AS Amount,
    CASE event_id % 12 WHEN 0 THEN 'Y' WHEN 1 THEN ' yes ' WHEN 2 THEN 'T' WHEN 3 THEN '1' WHEN 4 THEN '1.0'
         WHEN 5 THEN 'N' WHEN 6 THEN '' WHEN 7 THEN 'false' WHEN 8 THEN '2' WHEN 9 THEN '2.7'
         WHEN 10 THEN 'maybe' END AS CurrentParent,
    CASE event_id % 6 WHEN 0 THEN ' click' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'nan'
         ELSE event_type END AS Gender
  FROM events
)"""

NA = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
      "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({NA}) THEN NULL ELSE {c} END AS {c}"


NUM_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _num(c: str) -> str:
    v = f"CASE WHEN regexp_matches({c}, '{NUM_RE}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"
    return f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"


def _date(c: str) -> str:
    return (f"COALESCE(try_strptime(trim({c}), '%d/%m/%Y'), try_strptime(trim({c}), '%Y-%m-%d'), "
            f"try_strptime(trim({c}), '%Y-%m-%d %H:%M:%S'), try_strptime(trim({c}), '%d/%m/%Y %H:%M:%S'))")


NULLED = DIRTY + """,
nulled AS (
  SELECT ReceiptSeq, """ + ", ".join(_na(c) for c in ("ID", "Date", "Amount", "CurrentParent", "Gender")) + """
  FROM dirty
)"""

TYPED = NULLED + """,
typed AS (
  SELECT ReceiptSeq, COALESCE(trim(ID), 'nan') AS ID, """ + _date("Date") + """ AS Date,
    """ + _num("Amount") + """ AS Amount, CurrentParent, Gender
  FROM nulled
)"""


def _flag_value(c: str) -> str:
    s = f"lower(trim({c}))"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {s} IN ('1','y','yes','true','t') THEN 1.0 "
            f"WHEN {s} IN ('0','n','no','false','f','') THEN 0.0 ELSE {_num(c)} END")


ORACLE["clean_null_tokens"] = f"WITH {NULLED} SELECT * FROM nulled"
ORACLE["clean_amount_cast"] = f"WITH {NULLED} SELECT ReceiptSeq, {_num('Amount')} AS Amount FROM nulled"
ORACLE["clean_id"] = f"WITH {NULLED} SELECT ReceiptSeq, COALESCE(trim(ID), 'nan') AS ID FROM nulled"
ORACLE["clean_dates"] = f"WITH {NULLED} SELECT ReceiptSeq, {_date('Date')} AS Date FROM nulled"
ORACLE["date_parse_loss"] = f"""
WITH {NULLED}
SELECT 'Date' AS "column", COUNT(Date) - COUNT({_date('Date')}) AS lost FROM nulled"""
ORACLE["temporal_features"] = f"""
WITH {GIFTS}
SELECT ReceiptSeq, CAST(year(Date) AS INTEGER) AS Year, CAST(date_trunc('month', Date) AS DATE) AS MonthPeriod,
  strftime(Date, '%Y-%m') AS Month FROM gifts"""
ORACLE["normalize_categoricals"] = f"""
WITH {GIFTS}
SELECT ReceiptSeq, {", ".join(_cat(c) for c in CATS)} FROM gifts"""
ORACLE["flag_mapping"] = f"""
WITH {TYPED}
SELECT ReceiptSeq, CAST(trunc(COALESCE({_flag_value('CurrentParent')}, 0.0)) AS INTEGER) AS CurrentParent
FROM typed"""
ORACLE["positive_amounts"] = f"WITH {TYPED} SELECT ReceiptSeq, ID, Amount FROM typed WHERE Amount > 0"
ORACLE["flag_anomalies"] = f"""
WITH {TYPED}, v AS (SELECT ID, 'CurrentParent' AS FlagColumn, {_flag_value('CurrentParent')} AS Value FROM typed)
SELECT * FROM v WHERE Value IS NOT NULL AND Value NOT IN (0.0, 1.0)"""
ORACLE["year_slice"] = f"WITH {CLEAN} SELECT ReceiptSeq, ID, Year, Amount FROM clean WHERE Year >= 1996"
ORACLE["preprocess_stats"] = f"""
WITH {TYPED}
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE Amount > 0) AS rows_after,
  COUNT(*) - COUNT(*) FILTER (WHERE Amount > 0) AS rows_removed,
  6 AS cols_before, 9 AS cols_after, 'Month,MonthPeriod,Year' AS new_columns
FROM typed"""
ORACLE["dedup_exact"] = f"WITH {TYPED} SELECT DISTINCT ID, Date, Amount, CurrentParent, Gender FROM typed"
ORACLE["quality_amount"] = f"""
WITH {TYPED}
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE Amount IS NULL) AS null_count,
  COUNT(*) FILTER (WHERE Amount < 0) AS negative_count, COUNT(*) FILTER (WHERE Amount = 0) AS zero_count
FROM typed"""
ORACLE["quality_dates"] = f"""
WITH {TYPED},
t AS (SELECT COUNT(Date) AS valid_dates, MIN(Date) AS min_date, MAX(Date) AS max_date FROM typed),
s AS (SELECT *, floor((epoch_us(max_date) - epoch_us(min_date)) / 86400000000.0) / 365.25 AS span_years FROM t)
SELECT *, CASE WHEN valid_dates = 0 THEN 'error' WHEN span_years < 1 THEN 'warning'
               WHEN span_years > 50 THEN 'warning' ELSE 'ok' END AS severity FROM s"""
ORACLE["quality_flags"] = f"""
WITH {NULLED}
SELECT 'CurrentParent' AS "column",
  COUNT(*) FILTER (WHERE {_num('CurrentParent')} IS NOT NULL AND {_num('CurrentParent')} NOT IN (0.0, 1.0))
    AS invalid_count
FROM nulled"""

# -- RFM ---------------------------------------------------------------------


def _days(a: str, b: str) -> str:
    """Whole elapsed days from a to b."""
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / 86400000000.0) AS BIGINT)"


def _gt(x: str, edges: str, n: int = 4) -> str:
    """Number of (6-decimal rounded) edges strictly below x."""
    return " + ".join(f"CAST({x} > round({edges}[{i}], 6) AS INTEGER)" for i in range(1, n + 1))


def _rfm(source_cte: str, src: str, ref_sql: str) -> str:
    return f"""
WITH {source_cte},
base AS (SELECT * FROM {src} WHERE Date IS NOT NULL),
ref AS (SELECT {ref_sql} AS ref),
m AS (
  SELECT ID, {_days('max(Date)', 'any_value(ref.ref)')} AS Recency, COUNT(Date) AS Frequency,
    {money()} AS Monetary, arg_max(Amount, {{'d': Date, 's': ReceiptSeq}}) AS LastAmount,
    MIN(Date) AS FirstGiftDate, MAX(Date) AS LastGiftDate
  FROM base, ref GROUP BY ID
),
e AS (
  SELECT quantile_cont(-Recency, [0.2, 0.4, 0.6, 0.8]) AS r,
         quantile_cont(Frequency, [0.2, 0.4, 0.6, 0.8]) AS f,
         quantile_cont(Monetary, [0.2, 0.4, 0.6, 0.8]) AS m
  FROM m
),
s AS (
  SELECT m.*,
    CAST(1 + {_gt('-Recency', 'e.r')} AS INTEGER) AS R_score,
    CAST(1 + {_gt('Frequency', 'e.f')} AS INTEGER) AS F_score,
    CAST(1 + {_gt('Monetary', 'e.m')} AS INTEGER) AS M_score
  FROM m, e
)
SELECT *, R_score + F_score + M_score AS RFM_Score,
  CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champion'
       WHEN R_score >= 4 AND F_score >= 3 THEN 'Loyal'
       WHEN R_score <= 2 AND F_score <= 2 AND M_score <= 2 THEN 'At Risk / Lapsed'
       WHEN R_score >= 4 AND M_score >= 4 THEN 'High Potential'
       ELSE 'Regular' END AS RFM_Segment
FROM s"""


RFM = _rfm(CLEAN, "clean", "(SELECT MAX(Date) FROM base) + INTERVAL 1 DAY")
TIMED = """
timed AS (SELECT event_id AS ReceiptSeq, CAST(user_id AS VARCHAR) AS ID, ts AS Date, value AS Amount FROM events)"""

ORACLE["rfm_table"] = RFM
ORACLE["rfm_by_donor_buckets"] = RFM
ORACLE["rfm_scores"] = f"SELECT ID, R_score, F_score, M_score, RFM_Score FROM ({RFM})"
ORACLE["rfm_segment_distribution"] = f"""
SELECT RFM_Segment, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () * 100.0 AS pct
FROM ({RFM}) GROUP BY RFM_Segment"""
ORACLE["rfm_timed"] = _rfm(TIMED, "timed", "TIMESTAMP '2024-02-01 06:00:00'")
ORACLE["lapsed_targets"] = f"""
SELECT ID, Recency, Frequency, Monetary, RFM_Segment FROM ({RFM})
WHERE Recency >= 730 AND Monetary >= 1000000"""

SUMMARY = f"""
WITH {CLEAN},
ref AS (SELECT MAX(Date) + INTERVAL 1 DAY AS ref FROM clean),
b AS (SELECT clean.*, ref.ref,
        Date > ref.ref - INTERVAL 365 DAY AS recent,
        Date <= ref.ref - INTERVAL 365 DAY AND Date > ref.ref - INTERVAL 730 DAY AS prev
      FROM clean, ref)
SELECT ID, MAX(Date) AS LastGiftDate, MIN(Date) AS FirstGiftDate, COUNT(Date) AS Frequency,
  {money()} AS Monetary, {money()} / COUNT(Amount) AS AvgAmount,
  arg_max(Amount, {{'d': Date, 's': ReceiptSeq}}) AS LastAmount,
  {_days('MAX(Date)', 'any_value(ref)')} AS Recency,
  COUNT(*) FILTER (WHERE recent) AS Gifts12,
  CAST(COALESCE(SUM(CAST(Amount AS DECIMAL(18,2))) FILTER (WHERE recent), 0) AS DOUBLE) AS Amt12,
  COUNT(*) FILTER (WHERE prev) AS GiftsPrev12,
  CAST(COALESCE(SUM(CAST(Amount AS DECIMAL(18,2))) FILTER (WHERE prev), 0) AS DOUBLE) AS AmtPrev12
FROM b GROUP BY ID"""

LIST_COLS = ("ID, Recency, Frequency, Monetary, AvgAmount, LastAmount, LastGiftDate, FirstGiftDate, "
             "Gifts12, Amt12, GiftsPrev12, AmtPrev12")
ORACLE["donor_summary"] = SUMMARY
ORACLE["lapsed_12m"] = f"SELECT {LIST_COLS} FROM ({SUMMARY}) WHERE Recency >= 365 AND Monetary >= 1000000"
ORACLE["high_potential_sleeper"] = (f"SELECT {LIST_COLS} FROM ({SUMMARY}) "
                                    "WHERE Recency >= 365 AND Monetary >= 2000000")
ORACLE["upgrade_candidates"] = f"""
WITH s AS ({SUMMARY})
SELECT {LIST_COLS} FROM s
WHERE LastGiftDate >= (SELECT MAX(LastGiftDate) FROM s) - INTERVAL 365 DAY
  AND LastAmount >= 1.5 * AvgAmount AND Frequency >= 2"""
ORACLE["new_donors_90d"] = f"""
WITH s AS ({SUMMARY})
SELECT ID, Recency, Frequency, Monetary, AvgAmount, LastAmount, LastGiftDate, FirstGiftDate, Gifts12, Amt12
FROM s WHERE FirstGiftDate >= (SELECT MAX(FirstGiftDate) FROM s) - INTERVAL 90 DAY"""
ORACLE["donor_spine"] = f"WITH {CLEAN} SELECT DISTINCT ID FROM clean"

# -- panels (naive range-join statement: one join per cutoff condition) ------------

DEMO = ("Gender", "OccupDesc", "ReligionCode", "State", "Education", "CurrentParent",
        "PastParent", "PastStudent")
_DEMO_PACK = "{" + ", ".join(f"'{c}': {c}" for c in DEMO) + "}"
_DEMO_SEL = ", ".join(f"demo.x.{c} AS {c}" for c in DEMO)
_KEY = "{'d': Date, 's': ReceiptSeq}"


def _range(kind: str) -> str:
    if kind in ("redonate", "major"):
        return "mn + INTERVAL 365 DAY AS start, mx - INTERVAL 365 DAY AS stop"
    start = ("CASE WHEN TIMESTAMP '1996-01-01 00:00:00' < mn THEN mn + INTERVAL 365 DAY "
             "ELSE TIMESTAMP '1996-01-01 00:00:00' END AS start")
    stop = "mx - INTERVAL 7 DAY AS stop" if kind == "time" else "mx - INTERVAL 365 DAY AS stop"
    return f"{start}, {stop}"


def _quarter_cuts(kind: str) -> str:
    return f"""
bounds AS (SELECT MIN(Date) AS mn, MAX(Date) AS mx FROM clean),
r AS (SELECT {_range(kind)} FROM bounds),
cut0 AS (
  SELECT i, CAST(last_day(CAST(date_trunc('quarter', start) AS DATE) + to_months(CAST(2 + 6 * i AS INTEGER)))
                 AS TIMESTAMP) + (start - date_trunc('day', start)) AS CutoffDate, stop
  FROM r, range(0, 400) t(i)
),
cuts AS (SELECT i, CutoffDate FROM cut0 WHERE CutoffDate <= stop)"""


def _panel_base(kind: str, cuts: str = "") -> str:
    return f"""
WITH {CLEAN},
{cuts or _quarter_cuts(kind)},
demo AS (SELECT ID, arg_max({_DEMO_PACK}, {_KEY}) AS x FROM clean GROUP BY ID),
f AS (
  SELECT g.ID, c.CutoffDate, {_days('MAX(g.Date)', 'c.CutoffDate')} AS Recency, COUNT(*) AS Frequency,
    {money('g.Amount')} AS Monetary, {money('g.Amount')} / COUNT(*) AS AvgAmount,
    arg_max(g.Amount, {{'d': g.Date, 's': g.ReceiptSeq}}) AS LastAmount
  FROM clean g JOIN cuts c ON g.Date <= c.CutoffDate GROUP BY g.ID, c.CutoffDate
),
feat AS (
  SELECT f.ID, Recency, Frequency, Monetary, AvgAmount, LastAmount, {_DEMO_SEL}, f.CutoffDate
  FROM f LEFT JOIN demo ON demo.ID = f.ID
)"""


def _panel_flag(kind: str, name: str, extra: str, cuts: str = "") -> str:
    return _panel_base(kind, cuts) + f""",
lab AS (
  SELECT DISTINCT g.ID, c.CutoffDate FROM clean g JOIN cuts c
    ON g.Date > c.CutoffDate AND g.Date <= c.CutoffDate + INTERVAL 365 DAY {extra}
)
SELECT feat.*, CASE WHEN lab.ID IS NOT NULL THEN 1 ELSE 0 END AS {name}
FROM feat LEFT JOIN lab ON lab.ID = feat.ID AND lab.CutoffDate = feat.CutoffDate"""


PANEL_REDONATE = _panel_flag("redonate", "ReDonate", "")
PANEL_MAJOR = _panel_flag("major", "MajorGift", "AND g.Amount >= 450000")
PANEL_TIME = _panel_base("time") + f""",
nx AS (
  SELECT g.ID, c.CutoffDate, {_days('c.CutoffDate', 'MIN(g.Date)')} AS DaysToNext
  FROM clean g JOIN cuts c ON g.Date > c.CutoffDate GROUP BY g.ID, c.CutoffDate
)
SELECT feat.*, nx.DaysToNext FROM feat JOIN nx ON nx.ID = feat.ID AND nx.CutoffDate = feat.CutoffDate
WHERE nx.DaysToNext > 0"""
PANEL_PREFERENCE = _panel_base("preference") + """,
nt AS (
  SELECT g.ID, c.CutoffDate, arg_min(g.Fund, {'d': g.Date, 's': g.ReceiptSeq}) AS TargetCategory
  FROM clean g JOIN cuts c ON g.Date > c.CutoffDate AND g.Date <= c.CutoffDate + INTERVAL 365 DAY
  WHERE g.Fund IS NOT NULL GROUP BY g.ID, c.CutoffDate
)
SELECT feat.*, nt.TargetCategory FROM feat JOIN nt ON nt.ID = feat.ID AND nt.CutoffDate = feat.CutoffDate"""

ORACLE["panel_given_cutoffs"] = _panel_flag("redonate", "ReDonate", "", """cuts(CutoffDate) AS (VALUES
  (TIMESTAMP '1999-03-07 12:00:00'), (TIMESTAMP '1996-12-31 00:00:00'), (TIMESTAMP '1998-01-01 00:00:00'),
  (TIMESTAMP '2000-06-30 00:00:00'), (TIMESTAMP '1994-01-01 00:00:00'), (TIMESTAMP '2001-08-01 00:00:00'))""")
ORACLE["panel_redonate"] = PANEL_REDONATE
ORACLE["asof_features"] = f"SELECT * EXCLUDE (ReDonate) FROM ({PANEL_REDONATE})"
ORACLE["panel_major"] = PANEL_MAJOR
ORACLE["panel_time"] = PANEL_TIME
ORACLE["panel_preference"] = PANEL_PREFERENCE
ORACLE["panel_cutoffs"] = _panel_base("redonate") + "\nSELECT i, CutoffDate FROM cuts"
ORACLE["donor_demographics"] = f"WITH {CLEAN}, demo AS (SELECT ID, arg_max({_DEMO_PACK}, {_KEY}) AS x FROM clean GROUP BY ID) SELECT ID, {_DEMO_SEL} FROM demo"
ORACLE["donor_features_asof"] = f"""
WITH {CLEAN},
demo AS (SELECT ID, arg_max({_DEMO_PACK}, {_KEY}) AS x FROM clean GROUP BY ID),
f AS (
  SELECT ID, {_days('MAX(Date)', "TIMESTAMP '1999-06-30 00:00:00'")} AS Recency, COUNT(*) AS Frequency,
    {money()} AS Monetary, {money()} / COUNT(*) AS AvgAmount, arg_max(Amount, {_KEY}) AS LastAmount
  FROM clean WHERE Date <= TIMESTAMP '1999-06-30 00:00:00' GROUP BY ID
)
SELECT f.*, {_DEMO_SEL} FROM f LEFT JOIN demo ON demo.ID = f.ID"""
ORACLE["amount_dataset"] = f"""
WITH {CLEAN},
c AS (SELECT MAX(Date) - INTERVAL 365 DAY AS cut FROM clean),
demo AS (SELECT ID, arg_max({_DEMO_PACK}, {_KEY}) AS x FROM clean GROUP BY ID),
f AS (
  SELECT ID, {_days('MAX(Date)', 'any_value(c.cut)')} AS Recency, COUNT(*) AS Frequency,
    {money()} AS Monetary, {money()} / COUNT(*) AS AvgAmount, arg_max(Amount, {_KEY}) AS LastAmount
  FROM clean, c WHERE Date <= c.cut GROUP BY ID
),
t AS (SELECT ID, round(quantile_cont(Amount, 0.5), 6) AS FutureMedianAmount FROM clean, c WHERE Date > c.cut GROUP BY ID)
SELECT f.*, {_DEMO_SEL}, t.FutureMedianAmount FROM f JOIN t ON t.ID = f.ID LEFT JOIN demo ON demo.ID = f.ID"""


def _summary(src: str, label: str, name: str, numeric: bool = True) -> str:
    if numeric:
        pos = f"COUNT(*) FILTER (WHERE CAST({label} AS DOUBLE) > 0)"
        med = f"round(quantile_cont(CAST({label} AS DOUBLE), 0.5), 6)"
    else:
        pos, med = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
    return f"""
SELECT '{name}' AS dataset, COUNT(*) AS observations, COUNT(DISTINCT CutoffDate) AS cutoffs,
  COUNT(DISTINCT {label}) AS classes, {pos} AS positives, {pos} / COUNT(*) AS positive_rate,
  {med} AS median_label
FROM ({src})"""


ORACLE["panel_summary"] = " UNION ALL ".join([
    _summary(PANEL_REDONATE, "ReDonate", "redonate"),
    _summary(PANEL_MAJOR, "MajorGift", "major"),
    _summary(PANEL_TIME, "DaysToNext", "time"),
    _summary(PANEL_PREFERENCE, "TargetCategory", "preference", numeric=False)])

# -- splits, weights, metrics ---------------------------------------------------------

ORACLE["split_time"] = f"""
WITH p AS ({PANEL_TIME}),
q AS (SELECT quantile_cont(CAST(epoch_us(CutoffDate) AS DOUBLE), 0.8) AS q FROM p)
SELECT ID, CutoffDate, CASE WHEN CAST(epoch_us(CutoffDate) AS DOUBLE) <= q.q THEN 'train' ELSE 'test' END AS split
FROM p, q"""
ORACLE["split_random"] = f"""
WITH a AS ({ORACLE["amount_dataset"]}),
r AS (SELECT ID, row_number() OVER (ORDER BY md5('42:' || ID)) AS k, COUNT(*) OVER () AS n FROM a)
SELECT ID, CASE WHEN k <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM r"""

# Each class gets its share of the test rows, the rest go by largest remainder.
ORACLE["split_random_stratified"] = f"""
WITH a AS ({ORACLE["amount_dataset"]}),
n AS (SELECT Gender, COUNT(*) AS n FROM a GROUP BY Gender),
t AS (SELECT CAST(ceil(SUM(n) * 0.25) AS BIGINT) AS t, CAST(SUM(n) AS BIGINT) AS tot FROM n),
p AS (SELECT Gender, (n * t) // tot AS base, (n * t) % tot AS rem, t FROM n, t),
q AS (SELECT Gender, base, row_number() OVER (ORDER BY rem DESC, Gender) AS pos, t - SUM(base) OVER () AS rest FROM p),
r AS (SELECT ID, Gender, row_number() OVER (PARTITION BY Gender ORDER BY md5('42:' || ID)) AS k FROM a)
SELECT r.ID, r.Gender, CASE WHEN k <= base + CASE WHEN pos <= rest THEN 1 ELSE 0 END
  THEN 'test' ELSE 'train' END AS split
FROM r JOIN q ON r.Gender = q.Gender"""

ORACLE["class_weights"] = f"""
WITH p AS ({PANEL_PREFERENCE}), c AS (SELECT TargetCategory, COUNT(*) AS count FROM p GROUP BY TargetCategory)
SELECT TargetCategory, count, CAST(SUM(count) OVER () AS DOUBLE) / (COUNT(*) OVER () * count) AS weight FROM c"""

PRED = """
pred AS (SELECT doc_id, quality AS label, toxic AS prediction,
               CAST((doc_id * 37) % 101 AS DOUBLE) / 100 AS probability FROM labels)"""


def _per_class(src: str) -> str:
    return f"""
pairs AS (SELECT CAST(label AS VARCHAR) AS y, CAST(prediction AS VARCHAR) AS p, COUNT(*) AS n FROM {src} GROUP BY 1, 2),
cls AS (SELECT y AS c FROM pairs UNION SELECT p FROM pairs),
pc AS (
  SELECT c, COALESCE((SELECT SUM(n) FROM pairs WHERE y = c), 0) AS support,
    COALESCE((SELECT SUM(n) FROM pairs WHERE p = c), 0) AS pred,
    COALESCE((SELECT SUM(n) FROM pairs WHERE y = c AND p = c), 0) AS tp
  FROM cls
),
m AS (
  SELECT *, CASE WHEN pred > 0 THEN tp / pred ELSE 0.0 END AS prec,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM pc
),
m2 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM m)"""


ORACLE["classification_metrics"] = f"""
WITH {PRED}, {_per_class('pred')},
s AS (SELECT probability AS s, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label <> 1) AS neg
      FROM pred GROUP BY probability),
a AS (
  SELECT SUM(pos * ((SELECT COALESCE(SUM(neg), 0) FROM s s2 WHERE s2.s < s.s) + neg * 0.5)) AS num,
    SUM(pos) AS P, SUM(neg) AS N FROM s
)
SELECT 'given' AS model, CASE WHEN P > 0 AND N > 0 THEN round(num / (P * N), 9) END AS auc,
  round(SUM(prec * support) / SUM(support), 9) AS precision, round(SUM(rec * support) / SUM(support), 9) AS recall,
  round(SUM(f1 * support) / SUM(support), 9) AS f1, SUM(support) AS support
FROM m2, a GROUP BY P, N, num"""

CLASS_PAIRS = """
cp AS (SELECT l_returnflag AS label, CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END AS prediction FROM lineitem)"""
ORACLE["multiclass_metrics"] = f"""
WITH {CLASS_PAIRS}, {_per_class('cp')}
SELECT 'given' AS model, 'flag' AS target, round(AVG(f1), 9) AS macro_f1,
  round(SUM(f1 * support) / SUM(support), 9) AS weighted_f1, round(SUM(tp) / SUM(support), 9) AS accuracy,
  COUNT(*) FILTER (WHERE support > 0) AS n_classes
FROM m2"""
ORACLE["regression_metrics"] = """
WITH r AS (SELECT l_extendedprice AS y, l_quantity * 1000 AS p FROM lineitem),
mm AS (SELECT AVG(y) AS m FROM r)
SELECT round(AVG(abs(y - p)), 6) AS MAE, round(1 - SUM((y - p) * (y - p)) / SUM((y - mm.m) * (y - mm.m)), 9) AS R2,
  round(AVG(y), 6) AS mean_actual, round(AVG(p), 6) AS mean_predicted
FROM r, mm"""
RESID = """
res AS (SELECT l_extendedprice / 1000.0 - l_quantity AS r FROM lineitem),
rq AS (SELECT round(quantile_cont(r, 0.2), 6) AS residual_p20, round(quantile_cont(r, 0.5), 6) AS residual_median,
              round(quantile_cont(r, 0.8), 6) AS residual_p80 FROM res)"""
ORACLE["residual_quantiles"] = f"WITH {RESID} SELECT * FROM rq"

GIVEN = f"""
given AS (
  SELECT ID, {money()} / COUNT(Amount) / 250.0 AS pred_amount,
    CASE WHEN COUNT(*) > 1 THEN CAST({_days('MIN(Date)', 'MAX(Date)')} AS DOUBLE) / (COUNT(*) - 1) END
      AS pred_days_to_next,
    CAST((CAST(ID AS BIGINT) * 37) % 101 AS DOUBLE) / 100.0 AS top1_prob
  FROM clean GROUP BY ID
)"""
SCORED = f"""
WITH {CLEAN}, {GIVEN},
b AS (SELECT MIN(COALESCE(pred_amount, 0.0)) AS alo, MAX(COALESCE(pred_amount, 0.0)) AS ahi,
             MAX(pred_days_to_next) AS dmax FROM given),
d AS (SELECT g.*, COALESCE(pred_days_to_next, b.dmax) AS dd, COALESCE(pred_amount, 0.0) AS aa FROM given g, b),
b2 AS (SELECT MIN(dd) AS dlo, MAX(dd) AS dhi FROM d),
n AS (
  SELECT d.*,
    CASE WHEN b.alo IS NULL THEN NULL WHEN b.ahi = b.alo THEN 0.5 ELSE (aa - b.alo) / (b.ahi - b.alo) END AS an,
    CASE WHEN b2.dlo IS NULL THEN NULL WHEN b2.dhi = b2.dlo THEN 0.5 ELSE (dd - b2.dlo) / (b2.dhi - b2.dlo) END AS dn
  FROM d, b, b2
)
SELECT ID, 0.0 + 0.4 * an + 0.4 * (1.0 - dn) + 0.2 * COALESCE(top1_prob, 0.0) AS priority_score,
  CASE WHEN pred_amount >= 1000 AND pred_days_to_next <= 60 AND top1_prob >= 0.7 THEN 'VIP_target'
       WHEN pred_amount >= 500 AND pred_days_to_next <= 120 THEN 'Upgrade_push'
       WHEN pred_days_to_next > 180 THEN 'Reactivation' ELSE 'Nurture' END AS action_bucket
FROM n"""
ORACLE["priority_score"] = f"SELECT ID, priority_score FROM ({SCORED})"
ORACLE["action_bucket"] = f"SELECT ID, action_bucket FROM ({SCORED})"
ORACLE["top3_preference"] = f"""
WITH {CLEAN},
donors AS (SELECT ID, COUNT(*) AS tot FROM clean GROUP BY ID),
funds AS (SELECT 'F' || CAST(i AS VARCHAR) AS c FROM range(0, 6) t(i)),
cnt AS (SELECT ID, Fund, COUNT(*) AS n FROM clean GROUP BY ID, Fund),
p AS (
  SELECT d.ID, f.c, CAST(COALESCE(cnt.n, 0) AS DOUBLE) / d.tot AS prob
  FROM donors d CROSS JOIN funds f LEFT JOIN cnt ON cnt.ID = d.ID AND cnt.Fund = f.c
),
r AS (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY prob DESC, c DESC) AS rn FROM p)
SELECT ID,
  MAX(CASE WHEN rn = 1 THEN c END) AS top1_fund, MAX(CASE WHEN rn = 1 THEN prob END) AS top1_prob,
  MAX(CASE WHEN rn = 2 THEN c END) AS top2_fund, MAX(CASE WHEN rn = 2 THEN prob END) AS top2_prob,
  MAX(CASE WHEN rn = 3 THEN c END) AS top3_fund, MAX(CASE WHEN rn = 3 THEN prob END) AS top3_prob
FROM r WHERE rn <= 3 GROUP BY ID"""


def _band(off: str) -> str:
    return (f"CAST(cut.c + to_microseconds(CAST((pred_days_to_next + {off}) * 86400000000.0 AS BIGINT)) AS DATE)")


ORACLE["next_date_bands"] = f"""
WITH {CLEAN}, {GIVEN}, {RESID},
cut AS (SELECT MAX(Date) AS c FROM clean)
SELECT ID, pred_days_to_next, {_band('0.0')} AS pred_date_point, {_band('rq.residual_p20')} AS pred_date_p20,
  {_band('rq.residual_median')} AS pred_date_p50, {_band('rq.residual_p80')} AS pred_date_p80
FROM given, cut, rq"""

# -- sources and sinks ----------------------------------------------------------------

ORACLE["ingest_csv"] = f"""
WITH {NULLED}
SELECT CAST(ReceiptSeq AS VARCHAR) AS ReceiptSeq, ID, Date, Amount, CurrentParent, Gender FROM nulled"""
ORACLE["extract_wide"] = """
SELECT o.o_orderkey AS ReceiptSeq, CAST(o.o_custkey AS VARCHAR) AS ID, o.o_orderdate AS Date,
  o.o_orderpriority AS Appeal, CONCAT('F', CAST(o.o_orderkey % 6 AS VARCHAR)) AS Fund, o.o_totalprice AS Amount,
  CASE c.c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN ' M ' WHEN 2 THEN '' END AS Gender,
  CAST(c.c_custkey % 2 AS INT) AS CurrentParent,
  CASE WHEN c.c_custkey % 16 >= 8 THEN 1 ELSE 0 END AS FutureParent,
  CASE WHEN c.c_custkey % 4 >= 2 THEN 1 ELSE 0 END AS PastParent,
  CASE WHEN c.c_custkey % 8 >= 4 THEN 1 ELSE 0 END AS PastStudent,
  n.n_name AS Suburb, r.r_name AS State, o.o_orderstatus AS Education, c.c_mktsegment AS OccupDesc,
  CONCAT('R', CAST(c.c_custkey % 7 AS VARCHAR)) AS ReligionCode,
  n2.n_nationkey AS AppealCode, n2.n_name AS AppealDescription,
  r2.r_regionkey AS FundCode, r2.r_name AS FundDescription
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN nation n2 ON o.o_orderkey % 27 = n2.n_nationkey
LEFT JOIN region r2 ON o.o_orderkey % 6 = r2.r_regionkey"""

_CM = ORACLE["classification_metrics"]
_MM = ORACLE["multiclass_metrics"]
_RM = ORACLE["regression_metrics"]
ORACLE["metrics_flatten"] = f"""
SELECT 'classification_metrics.json' AS source_file, accuracy, auc, f1, macro_f1, model, n_classes, precision,
  recall, support, target, weighted_f1, MAE, R2, mean_actual, mean_predicted FROM (
  SELECT model, auc, precision, recall, f1, support, CAST(NULL AS DOUBLE) AS accuracy,
    CAST(NULL AS DOUBLE) AS macro_f1, CAST(NULL AS BIGINT) AS n_classes, CAST(NULL AS VARCHAR) AS target,
    CAST(NULL AS DOUBLE) AS weighted_f1, CAST(NULL AS DOUBLE) AS MAE, CAST(NULL AS DOUBLE) AS R2,
    CAST(NULL AS DOUBLE) AS mean_actual, CAST(NULL AS DOUBLE) AS mean_predicted FROM ({_CM}))
UNION ALL
SELECT 'multiclass_metrics.json', accuracy, NULL, NULL, macro_f1, model, n_classes, NULL, NULL, NULL, target,
  weighted_f1, NULL, NULL, NULL, NULL FROM ({_MM})
UNION ALL
SELECT 'regression_metrics.json', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  MAE, R2, mean_actual, mean_predicted FROM ({_RM})"""

_MANIFEST = ("trend_year", "trend_year_major", "trend_month", "dist_gender", "dist_suburb",
             "appeal_performance", "fund_performance", "relationship_summary", "rfm_table",
             "lapsed_targets", "lapsed_12m", "upgrade_candidates", "new_donors_90d")
_PRIORITY = ("prospecting_playbook", "rfm_table", "lapsed_targets", "high_potential_sleeper",
             "upgrade_candidates", "new_donors_90d", "dist_suburb", "relationship_summary",
             "relationship_agegroup", "relationship_trend", "trend_year", "trend_year_major",
             "trend_month", "dist_gender", "dist_agegroup", "dist_occupation", "dist_religion",
             "appeal_performance", "fund_performance", "lapsed_12m", "propensity_model_comparison",
             "major_gift_model_comparison")
_ORDER = [n for n in _PRIORITY if n in _MANIFEST] + sorted(n for n in _MANIFEST if n not in _PRIORITY)
_NCOLS = {"trend_year": 10, "trend_year_major": 10, "trend_month": 7, "dist_gender": 6, "dist_suburb": 6,
          "appeal_performance": 6, "fund_performance": 6, "relationship_summary": 9, "rfm_table": 12,
          "lapsed_targets": 5, "lapsed_12m": 12, "upgrade_candidates": 12, "new_donors_90d": 10}
ORACLE["report_manifest"] = " UNION ALL ".join(
    f"SELECT '{n}' AS source, COUNT(*) AS rows, {_NCOLS[n]} AS cols, {i} AS position, "
    f"format('{{:,}} rows x {_NCOLS[n]} cols', COUNT(*)) AS note FROM ({ORACLE[n]})"
    for i, n in enumerate(_ORDER))

ORACLE["stream_ingest"] = f"""
WITH {TYPED}
SELECT CAST(ReceiptSeq AS VARCHAR) AS ReceiptSeq, ID, Date, Amount,
  CAST(trunc(COALESCE({_flag_value('CurrentParent')}, 0.0)) AS INTEGER) AS CurrentParent,
  {_cat('Gender')}, CAST(year(Date) AS INTEGER) AS Year, strftime(Date, '%Y-%m') AS Month
FROM typed WHERE Amount > 0"""

ORACLE["quality_report"] = f"""
WITH {TYPED},
t AS (
  SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE Amount IS NULL) AS amount_null,
    COUNT(*) FILTER (WHERE Amount < 0) AS amount_negative, COUNT(*) FILTER (WHERE Amount = 0) AS amount_zero,
    COUNT(Date) AS valid_dates,
    floor((epoch_us(MAX(Date)) - epoch_us(MIN(Date))) / 86400000000.0) / 365.25 AS span,
    COUNT(*) FILTER (WHERE {_num('CurrentParent')} IS NOT NULL AND {_num('CurrentParent')} NOT IN (0.0, 1.0))
      AS flag_cp
  FROM typed
)
SELECT 'rows' AS "check", CAST(NULL AS VARCHAR) AS "column", CAST(rows AS DOUBLE) AS value, 'ok' AS severity FROM t
UNION ALL SELECT 'amount_null', 'Amount', amount_null, CASE WHEN amount_null > 0 THEN 'warning' ELSE 'ok' END FROM t
UNION ALL SELECT 'amount_negative', 'Amount', amount_negative,
  CASE WHEN amount_negative > 0 THEN 'warning' ELSE 'ok' END FROM t
UNION ALL SELECT 'amount_zero', 'Amount', amount_zero, CASE WHEN amount_zero > 0 THEN 'warning' ELSE 'ok' END FROM t
UNION ALL SELECT 'date_span_years', 'Date', span,
  CASE WHEN span < 1 OR span > 50 THEN 'warning' ELSE 'ok' END FROM t
UNION ALL SELECT 'flag_invalid', 'CurrentParent', flag_cp, CASE WHEN flag_cp > 0 THEN 'warning' ELSE 'ok' END FROM t"""
