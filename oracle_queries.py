"""DuckDB oracle SQL for every catalogue query.

Written independently of the Spark plans, from the mapping described in
``regstar.sources.driver_tables``: the claim-shaped sources, dimensions and
facts are CTEs over the driver's Parquet views (``lineitem``, ``orders``,
``customer``, ``supplier``, ``part``, ``nation``), and each query selects from
them. Column names and types match the Spark results.
"""

from __future__ import annotations


# The characters that Python's str.strip removes.
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _clean(x: str) -> str:
    return f"upper(trim({x}, '{_SPACES}'))"


def _in_calendar(x: str) -> str:
    return f"CASE WHEN {x} BETWEEN DATE '1900-01-01' AND DATE '2100-01-01' THEN {x} END"


PRELUDE = f"""
WITH
claim AS (
  SELECT
    'RO' || CAST(o.o_custkey AS VARCHAR) AS ronumber,
    'N' || chr(CAST(65 + c.c_nationkey % 26 AS INTEGER))
      || CASE WHEN c.c_nationkey < 26 THEN '' ELSE CAST(c.c_nationkey // 26 AS VARCHAR) END AS countrycode,
    CAST(o.o_orderdate AS DATE) AS submissiondate,
    CAST(o.o_orderdate AS DATE) + 60 AS expectedresponsedate,
    CASE WHEN l.l_linenumber = 3
         THEN ' ' || lower('CL-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)) || chr(9)
         ELSE 'CL-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)
    END AS claimnumber,
    CASE WHEN l.l_partkey % 29 = 0 THEN 'PRX' ELSE 'PRD' END || CAST(l.l_partkey AS VARCHAR) AS productcodeid,
    'IND-' || c.c_mktsegment AS indicationid,
    CASE l.l_returnflag WHEN 'R' THEN 'REGISTER' WHEN 'A' THEN 'REFUND' ELSE 'OTHER' END AS claimtype,
    CASE WHEN l.l_returnflag = 'R' THEN 'F' || CAST(100 + s.s_nationkey AS VARCHAR) ELSE '' END AS factoryapi,
    CASE WHEN l.l_returnflag = 'R' THEN 'F' || CAST(100 + c.c_nationkey AS VARCHAR) ELSE '' END AS factorybulk,
    CASE WHEN l.l_returnflag = 'R' THEN 'F' || CAST(100 + l.l_partkey % 30 AS VARCHAR) ELSE '' END AS factorypackage,
    CASE WHEN l.l_returnflag = 'R' OR l.l_linenumber = 7 THEN 'null'
         WHEN l.l_tax = 0 THEN NULL
         ELSE CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) || ' CHF'
    END AS drugprice,
    CAST(round(l.l_discount * 100) AS SMALLINT) AS reimbursementprct
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
drugproduct AS (
  SELECT
    CASE WHEN p_partkey % 17 = 0 THEN lower('PRD' || CAST(p_partkey AS VARCHAR)) || ' '
         ELSE 'PRD' || CAST(p_partkey AS VARCHAR) END AS drugproductid,
    p_name AS drugproductname,
    p_type AS family_name,
    CAST(('0x' || substr(md5(p_type), 1, 15)) AS BIGINT) AS drugproductfamilyid
  FROM part
),
family AS (
  SELECT DISTINCT p_type AS drugproductfamilyname,
         CAST(('0x' || substr(md5(p_type), 1, 15)) AS BIGINT) AS drugproductfamilyid
  FROM part
  WHERE NOT starts_with(p_type, 'PROMO')
),
indication_src AS (
  SELECT DISTINCT 'IND-' || c_mktsegment AS indicationid, lower(c_mktsegment) AS indicationdescription
  FROM customer
),
countries AS (
  SELECT n_name AS country_name,
         'N' || chr(CAST(65 + n_nationkey % 26 AS INTEGER))
           || CASE WHEN n_nationkey < 26 THEN '' ELSE CAST(n_nationkey // 26 AS VARCHAR) END AS alpha_2_code,
         CAST(n_nationkey AS VARCHAR) AS numeric_code
  FROM nation
),
factory_files AS (
  SELECT CASE WHEN n_nationkey = 5 THEN 'F' || CAST(100 + n_nationkey AS VARCHAR) || ' '
              ELSE 'F' || CAST(100 + n_nationkey AS VARCHAR) END AS code,
         CASE n_nationkey WHEN 3 THEN ' Plant ' || n_name || '  ' WHEN 7 THEN '"A" \\ Plant ' || n_name
              ELSE 'Plant ' || n_name END AS name,
         CASE n_nationkey WHEN 4 THEN '' WHEN 6 THEN NULL ELSE n_name END AS country,
         1 AS file
  FROM nation WHERE n_nationkey % 25 <= 14
  UNION ALL
  SELECT 'F' || CAST(100 + n_nationkey AS VARCHAR),
         CASE WHEN n_nationkey = 12 THEN lower('Plant ' || n_name) ELSE 'Plant ' || n_name END,
         CASE WHEN n_nationkey = 11 THEN 'ELSEWHERE' ELSE n_name END,
         2
  FROM nation WHERE n_nationkey % 25 >= 10
),
dim_factory AS (
  SELECT {_clean('code')} AS factory_bk, name AS factory_name, country AS factory_country
  FROM (SELECT DISTINCT code, name, country FROM factory_files)
),
response_src AS (
  SELECT DISTINCT
    'CL-' || CAST(r.l_orderkey AS VARCHAR) || '-' || CAST(r.l_linenumber AS VARCHAR) AS claim_number,
    CASE WHEN r.l_orderkey % 97 = 0 THEN 'unknown'
         ELSE strftime(CAST(r.shipped AS DATE), '%Y-%m-%d') END AS response_date,
    o.o_orderstatus AS response
  FROM (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS shipped
        FROM lineitem GROUP BY l_orderkey, l_linenumber) r
  JOIN orders o ON r.l_orderkey = o.o_orderkey
),
dict AS (
  SELECT * FROM (VALUES ('F', 'Approved'), ('O', 'Declined')) AS t(code_from, code_to)
),
dim_response AS (
  SELECT {_clean('claim_number')} AS response_bk,
         TRY_CAST(response_date AS DATE) AS response_date,
         d.code_to AS response
  FROM response_src JOIN dict d ON response_src.response = d.code_from
),
dim_product AS (
  SELECT {_clean('p.drugproductid')} AS product_bk,
         p.drugproductname AS product_name,
         f.drugproductfamilyname AS product_family_name
  FROM drugproduct p LEFT JOIN family f ON p.drugproductfamilyid = f.drugproductfamilyid
),
dim_indication AS (
  SELECT indicationid AS indication_bk, indicationdescription AS indication_description FROM indication_src
),
dim_country AS (
  SELECT alpha_2_code AS country_bk, country_name FROM countries
),
fact_reg AS (
  SELECT
    {_clean('c.claimnumber')} AS claimnumber,
    p.product_bk, p.product_name,
    i.indication_bk,
    fa.factory_bk AS factory_api_bk, fa.factory_name AS factory_api_name,
    fb.factory_bk AS factory_bulk_bk, fb.factory_name AS factory_bulk_name,
    fp.factory_bk AS factory_package_bk, fp.factory_name AS factory_package_name,
    {_in_calendar('r.response_date')} AS response_date,
    {_in_calendar('c.expectedresponsedate')} AS expected_date,
    {_in_calendar('c.submissiondate')} AS submission_date,
    co.country_bk,
    r.response
  FROM claim c
  LEFT JOIN dim_product p ON p.product_bk = {_clean('c.productcodeid')}
  LEFT JOIN dim_response r ON r.response_bk = {_clean('c.claimnumber')}
  LEFT JOIN dim_indication i ON {_clean('i.indication_bk')} = {_clean('c.indicationid')}
  LEFT JOIN dim_country co ON {_clean('co.country_bk')} = {_clean('c.countrycode')}
  LEFT JOIN dim_factory fa ON fa.factory_bk = {_clean('c.factoryapi')}
  LEFT JOIN dim_factory fb ON fb.factory_bk = {_clean('c.factorybulk')}
  LEFT JOIN dim_factory fp ON fp.factory_bk = {_clean('c.factorypackage')}
  WHERE c.claimtype = 'REGISTER'
),
fact_reimb AS (
  SELECT
    {_clean('c.claimnumber')} AS claimnumber,
    p.product_bk, p.product_name,
    c.reimbursementprct AS reimbursement_claimed_prc,
    c.reimbursementprct AS reimbursement_app_prc,
    i.indication_bk,
    {_in_calendar('r.response_date')} AS response_date,
    {_in_calendar('c.expectedresponsedate')} AS expected_date,
    {_in_calendar('c.submissiondate')} AS submission_date,
    co.country_bk,
    r.response,
    TRY_CAST(trim(substring(c.drugprice, 1, length(c.drugprice) - 3)) AS INTEGER) AS drug_price,
    right(c.drugprice, 3) AS drug_price_currency
  FROM claim c
  LEFT JOIN dim_product p ON p.product_bk = {_clean('c.productcodeid')}
  LEFT JOIN dim_response r ON r.response_bk = {_clean('c.claimnumber')}
  LEFT JOIN dim_indication i ON {_clean('i.indication_bk')} = {_clean('c.indicationid')}
  LEFT JOIN dim_country co ON {_clean('co.country_bk')} = {_clean('c.countrycode')}
  WHERE c.claimtype = 'REFUND' AND c.drugprice IS NOT NULL AND c.drugprice <> 'null'
)
"""

ON_TIME = "response = 'Approved' AND response_date <= expected_date"


def _share(num_from: str, total_from: str) -> str:
    return f"""
SELECT on_time, total, CASE WHEN total = 0 THEN NULL ELSE CAST(on_time AS DOUBLE) / CAST(total AS DOUBLE) END AS share
FROM (SELECT (SELECT count(*) FROM {num_from} WHERE {ON_TIME}) AS on_time,
             (SELECT count(*) FROM {total_from}) AS total)
"""


def _share_only(fact: str) -> str:
    return f"""
SELECT CASE WHEN total = 0 THEN NULL ELSE CAST(on_time AS DOUBLE) / CAST(total AS DOUBLE) END AS share
FROM (SELECT (SELECT count(*) FROM {fact} WHERE {ON_TIME}) AS on_time,
             (SELECT count(*) FROM {fact}) AS total)
"""


Q3 = """
, base AS (
  SELECT * FROM fact_reimb
  WHERE response = 'Approved' AND country_bk IN ('NB', 'NC', 'ND', 'NE')
    AND year(response_date) = 1998 AND quarter(response_date) = 4
)
SELECT DISTINCT product_bk, product_name FROM base
WHERE drug_price = (SELECT max(drug_price) FROM base) AND product_bk IS NOT NULL
"""


def _q4(measure: str, also: str = "") -> str:
    return f"""
, base AS (
  SELECT *, {measure} AS measure FROM fact_reimb
  WHERE country_bk = 'NH' AND response_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'{also}
)
SELECT product_bk, product_name, reimbursement_claimed_prc, drug_price FROM base
WHERE measure = (SELECT max(measure) FROM base) AND product_bk IS NOT NULL
"""


Q4A = _q4(
    "CASE WHEN reimbursement_claimed_prc = 0 THEN NULL "
    "ELSE CAST(drug_price AS DOUBLE) / CAST(reimbursement_claimed_prc AS DOUBLE) END"
)
Q4B = _q4("reimbursement_claimed_prc")

_QUERIES = {
    "src_delimited_roundtrip": """
SELECT c.c_custkey, c.c_name, n.n_name AS country_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
    "src_union_all": """
SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey % 25 <= 14
UNION ALL
SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey % 25 >= 10
""",
    "src_union_distinct": """
SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey % 25 <= 14
UNION
SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey % 25 >= 10
""",
    "src_quarantine": PRELUDE + """
, faulty AS (
  SELECT *, left(md5(claim_number), 1) AS fault, CAST(length(claim_number) AS INTEGER) AS amount
  FROM (SELECT claim_number, response_date, response FROM response_src)
)
SELECT claim_number, response_date, response, amount, CAST(NULL AS VARCHAR) AS record FROM faulty WHERE fault > '2'
UNION ALL
SELECT NULL, NULL, NULL, NULL, claim_number || ',' || response_date || ',' || response
  || CASE fault WHEN '0' THEN '' WHEN '1' THEN ',' || amount || ',again' ELSE ',n/a ' || amount END
FROM faulty WHERE fault <= '2'
""",
    "key_map_products": PRELUDE + """
SELECT count(*) AS ids, CAST(1 AS BIGINT) AS lowest, count(*) AS highest,
       count(*) FILTER (product_family_name IS NOT NULL) AS unchanged
FROM dim_product
""",
    "bk_clean": f"""
SELECT p_partkey, raw_brand, {_clean('raw_brand')} AS brand_bk
FROM (
  SELECT p_partkey,
         CASE p_partkey % 5
           WHEN 0 THEN '  ' || lower(p_brand) || chr(9)
           WHEN 1 THEN p_brand
           WHEN 2 THEN NULL
           WHEN 3 THEN chr(160) || chr(8195) || p_brand || chr(28) || chr(133) || chr(12288)
           ELSE chr(10) || upper(p_brand) || ' ' || chr(13)
         END AS raw_brand
  FROM part
)
""",
    "price_parse": """
SELECT l_orderkey, l_linenumber, price_text,
       TRY_CAST(trim(substring(price_text, 1, length(price_text) - 3)) AS INTEGER) AS drug_price,
       right(price_text, 3) AS drug_price_currency
FROM (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 7 THEN 'null'
              WHEN l_tax = 0 THEN NULL
              WHEN l_linenumber = 6 THEN 'n/a ' || l_returnflag || 'EUR'
              WHEN l_linenumber = 5 THEN ' ' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || ' USD'
              WHEN l_linenumber = 4 THEN 'EUR'
              ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || ' CHF'
         END AS price_text
  FROM lineitem
)
WHERE price_text IS NOT NULL AND price_text <> 'null'
""",
    "dim_country": PRELUDE + "SELECT country_bk, country_name FROM dim_country",
    "dim_indication": PRELUDE + "SELECT indication_bk, indication_description FROM dim_indication",
    "dim_factory": PRELUDE + "SELECT factory_bk, factory_name, factory_country FROM dim_factory",
    "dim_response": PRELUDE + "SELECT response_bk, response_date, response FROM dim_response",
    "dim_product": PRELUDE + "SELECT product_bk, product_name, product_family_name FROM dim_product",
    "dim_calendar": PRELUDE + """
SELECT CAST(d - DATE '1900-01-01' AS INTEGER) AS date_id,
       d AS dt,
       strftime(d, '%Y-%m-%d') AS date,
       CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day,
       'Q' || CAST(quarter(d) AS VARCHAR) AS quarter,
       CAST(coalesce(n, 0) AS BIGINT) AS n_claims
FROM (SELECT CAST(x AS DATE) AS d FROM range(DATE '1900-01-01', DATE '2100-01-02', INTERVAL 1 DAY) AS t(x))
LEFT JOIN (SELECT submissiondate AS s, count(*) AS n FROM claim GROUP BY submissiondate) ON d = s
""",
    "join_role_calendar": PRELUDE + """
SELECT claimnumber,
       CAST(year(submission_date) AS INTEGER) AS submission_year,
       'Q' || CAST(quarter(submission_date) AS VARCHAR) AS submission_quarter,
       CAST(year(expected_date) AS INTEGER) AS expected_year,
       'Q' || CAST(quarter(expected_date) AS VARCHAR) AS expected_quarter,
       CAST(year(response_date) AS INTEGER) AS response_year,
       'Q' || CAST(quarter(response_date) AS VARCHAR) AS response_quarter
FROM fact_reg
""",
    "join_role_factory": PRELUDE + """
SELECT claimnumber, factory_api_name, factory_bulk_name, factory_package_name FROM fact_reg
""",
    "fact_registration": PRELUDE + """
SELECT claimnumber, product_bk, indication_bk, factory_api_bk, factory_bulk_bk, factory_package_bk,
       response_date, expected_date, submission_date, country_bk, response
FROM fact_reg
""",
    "fact_reimbursement": PRELUDE + """
SELECT claimnumber, product_bk, reimbursement_claimed_prc, reimbursement_app_prc, indication_bk,
       response_date, expected_date, submission_date, country_bk, response, drug_price, drug_price_currency
FROM fact_reimb
""",
    "q1_claims_per_year": PRELUDE + """
SELECT CAST(year(submission_date) AS INTEGER) AS year, count(*) AS "count"
FROM fact_reg WHERE submission_date IS NOT NULL
GROUP BY 1 ORDER BY 1
""",
    "q1_sql_twin": PRELUDE + """
SELECT count(claimnumber) AS number_of_claims, CAST(year(submission_date) AS INTEGER) AS year
FROM fact_reimb WHERE submission_date IS NOT NULL
GROUP BY 2 ORDER BY 2
""",
    "q2a_on_time_share": PRELUDE + _share("fact_reimb", "fact_reimb"),
    "q2a_sql_twin": PRELUDE + _share_only("fact_reimb"),
    "q2b_share_as_reference": PRELUDE + _share("fact_reg", "fact_reimb"),
    "q2b_share_own_total": PRELUDE + _share("fact_reg", "fact_reg"),
    "q2b_sql_twin": PRELUDE + _share_only("fact_reg"),
    "prices_by_country": PRELUDE + """
SELECT country_bk, drug_price_currency, count(*) AS offers, max(drug_price) AS highest, min(drug_price) AS lowest
FROM fact_reimb
WHERE response = 'Approved' AND year(response_date) = 1998 AND quarter(response_date) = 4
GROUP BY country_bk, drug_price_currency
""",
    "q3_top_price": PRELUDE + Q3,
    "q3_sql_twin": PRELUDE + Q3,
    "q4a_top_amount": PRELUDE + Q4A,
    "q4a_sql": PRELUDE + Q4A,
    "q4b_top_percent": PRELUDE + Q4B,
    "sql_view_question": PRELUDE + Q4B,
    "dq_duplicate_keys": PRELUDE + """
SELECT 'claim' AS source, claimnumber AS key, count(*) AS n_rows FROM claim
GROUP BY claimnumber HAVING count(*) > 1 OR claimnumber IS NULL
UNION ALL
SELECT 'drugproduct', drugproductid, count(*) FROM drugproduct
GROUP BY drugproductid HAVING count(*) > 1 OR drugproductid IS NULL
UNION ALL
SELECT 'drugproductfamily', CAST(drugproductfamilyid AS VARCHAR), count(*) FROM family
GROUP BY drugproductfamilyid HAVING count(*) > 1 OR drugproductfamilyid IS NULL
UNION ALL
SELECT 'indication', indicationid, count(*) FROM indication_src
GROUP BY indicationid HAVING count(*) > 1 OR indicationid IS NULL
""",
    "asof_factory_licences": PRELUDE + f"""
, licence AS (
  SELECT 'F' || CAST(100 + s_nationkey AS VARCHAR) AS key, valid_from, min(s_name) AS licence, arg_min(valid_to, s_name) AS valid_to
  FROM (
    SELECT *, CASE WHEN s_suppkey % 4 = 0 THEN valid_from + 300 ELSE DATE '9999-12-31' END AS valid_to
    FROM (SELECT *, DATE '1992-01-01' + CAST(s_suppkey * 53 % 2200 AS INTEGER) AS valid_from FROM supplier)
  ) GROUP BY 1, 2
), c AS (
  SELECT {_clean('factoryapi')} AS factory, submissiondate AS day FROM claim WHERE claimtype = 'REGISTER'
), valid AS (
  SELECT c.factory, c.day, CASE WHEN c.day < l.valid_to THEN l.licence END AS licence
  FROM c ASOF LEFT JOIN licence l ON c.factory = l.key AND c.day >= l.valid_from
)
SELECT factory, licence, count(*) AS claims, min(day) AS first_day, max(day) AS last_day FROM valid GROUP BY factory, licence
""",
    "dq_nearest_products": PRELUDE + f"""
, known AS (
  SELECT DISTINCT {_clean('drugproductid')} AS known FROM drugproduct WHERE drugproductid IS NOT NULL
), lost AS (
  SELECT k AS key, count(*) AS n_rows FROM (SELECT {_clean('productcodeid')} AS k FROM claim) c
  WHERE k IS NOT NULL AND k NOT IN (SELECT known FROM known) GROUP BY k
), near AS (
  SELECT key, known, levenshtein(key, known) AS distance FROM lost, known WHERE levenshtein(key, known) <= 2
), best AS (
  SELECT key, distance, min(known) AS proposal, count(*) AS nearest FROM near
  WHERE (key, distance) IN (SELECT (key, min(distance)) FROM near GROUP BY key) GROUP BY key, distance
)
SELECT key, n_rows, CAST(distance AS INTEGER) AS distance, proposal, coalesce(nearest, 0) AS nearest
FROM lost LEFT JOIN best USING (key)
""",
    "dq_orphans": PRELUDE + f"""
SELECT 'claim.productcodeid' AS foreign_key, k AS key, count(*) AS n_rows
FROM (SELECT {_clean('productcodeid')} AS k FROM claim) c
WHERE k IS NOT NULL AND k NOT IN (SELECT {_clean('drugproductid')} FROM drugproduct WHERE drugproductid IS NOT NULL)
GROUP BY k
UNION ALL
SELECT 'claim.indicationid', k, count(*)
FROM (SELECT {_clean('indicationid')} AS k FROM claim) c
WHERE k IS NOT NULL AND k NOT IN (SELECT {_clean('indicationid')} FROM indication_src WHERE indicationid IS NOT NULL)
GROUP BY k
UNION ALL
SELECT 'drugproduct.drugproductfamilyid', CAST(drugproductfamilyid AS VARCHAR), count(*)
FROM drugproduct
WHERE drugproductfamilyid IS NOT NULL
  AND drugproductfamilyid NOT IN (SELECT drugproductfamilyid FROM family)
GROUP BY drugproductfamilyid
""",
    "dq_fanout_guard": PRELUDE + f"""
SELECT 'country' AS dimension, k AS key, count(*) AS n_rows
FROM (SELECT {_clean('country_bk')} AS k FROM dim_country) GROUP BY k HAVING count(*) > 1 OR k IS NULL
UNION ALL
SELECT 'factory', k, count(*) FROM (SELECT {_clean('factory_bk')} AS k FROM dim_factory)
GROUP BY k HAVING count(*) > 1 OR k IS NULL
UNION ALL
SELECT 'indication', k, count(*) FROM (SELECT {_clean('indication_bk')} AS k FROM dim_indication)
GROUP BY k HAVING count(*) > 1 OR k IS NULL
UNION ALL
SELECT 'product', k, count(*) FROM (SELECT {_clean('product_bk')} AS k FROM dim_product)
GROUP BY k HAVING count(*) > 1 OR k IS NULL
UNION ALL
SELECT 'response', k, count(*) FROM (SELECT {_clean('response_bk')} AS k FROM dim_response)
GROUP BY k HAVING count(*) > 1 OR k IS NULL
""",
    "dim_factory_latest": PRELUDE + f"""
SELECT DISTINCT {_clean('code')} AS factory_bk, name AS factory_name, country AS factory_country
FROM factory_files f
WHERE file = (SELECT max(g.file) FROM factory_files g WHERE {_clean('g.code')} = {_clean('f.code')})
""",
    "q4_amount_granted": PRELUDE + _q4("drug_price * reimbursement_claimed_prc / 100.0", " AND response = 'Approved'"),
    "dq_unparsable_dates": PRELUDE + """
SELECT response_date, count(*) AS n_rows FROM response_src
WHERE response_date IS NOT NULL AND TRY_CAST(response_date AS DATE) IS NULL GROUP BY response_date
""",
    "dq_key_collisions": PRELUDE + """
SELECT 'country' AS dimension, (SELECT count(*) FROM dim_country) AS n_rows,
       (SELECT count(*) FROM (SELECT DISTINCT alpha_2_code, country_name FROM countries)) AS n_ids
UNION ALL SELECT 'factory', (SELECT count(*) FROM dim_factory),
       (SELECT count(*) FROM (SELECT DISTINCT code, name, country FROM factory_files))
UNION ALL SELECT 'indication', (SELECT count(*) FROM dim_indication),
       (SELECT count(*) FROM (SELECT DISTINCT indicationid, indicationdescription FROM indication_src))
UNION ALL SELECT 'product', (SELECT count(*) FROM dim_product),
       (SELECT count(*) FROM (SELECT DISTINCT drugproductid, drugproductname, drugproductfamilyid FROM drugproduct))
UNION ALL SELECT 'response', (SELECT count(*) FROM dim_response),
       (SELECT count(*) FROM (SELECT DISTINCT claim_number, response_date, response
                              FROM response_src JOIN dict ON response = code_from))
""",
    "dq_unmapped_codes": PRELUDE + """
SELECT response, count(*) AS n_rows FROM response_src
WHERE response IS NULL OR response NOT IN (SELECT code_from FROM dict)
GROUP BY response
""",
}

# Other forms that compute the same rows: builds in SQL text, the same sources
# read from files, questions on the written star.
for _sql_form, _same_as in (
    ("dim_product_sql", "dim_product"),
    ("dim_response_sql", "dim_response"),
    ("fact_registration_sql", "fact_registration"),
    ("fact_reimbursement_sql", "fact_reimbursement"),
    ("src_files_factory", "dim_factory"),
    ("src_files_response", "dim_response"),
    ("star_written_q3", "q3_top_price"),
    ("star_written_q4a", "q4a_top_amount"),
    ("star_clustered_q3", "q3_top_price"),
    ("star_bucketed_q2a", "q2a_on_time_share"),
    ("star_bucketed_q4a", "q4a_top_amount"),
    ("star_version_q3", "q3_top_price"),
    ("star_changes_reimbursement", "fact_reimbursement"),
):
    _QUERIES[_sql_form] = _QUERIES[_same_as]

ORACLE_SQL: dict[str, str] = {k: v.strip() for k, v in _QUERIES.items()}
