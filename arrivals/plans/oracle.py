"""DuckDB SQL equivalents of the driver queries (same keys, same column names).

Spark truncates toward zero where DuckDB's integer cast rounds, so the text ->
int conversion is written as ``TRY_CAST(trunc(TRY_CAST(x AS DOUBLE)) AS
INTEGER)``. Double aggregates are rounded on both sides; HUGEINT sums and
``count_if`` results are cast to BIGINT.
"""

from __future__ import annotations


def x1(e: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({e} AS DOUBLE)) AS INTEGER)"


def day_to_date(e: str) -> str:
    return f"(DATE '1960-01-01' + {x1(e)})"


DAYS = "date_diff('day', DATE '1960-01-01', CAST(o.o_orderdate AS DATE))"

RAW_ARRIVALS = f"""
SELECT CAST(o.o_orderkey AS VARCHAR) || '.0' AS cicid,
       CAST(year(o.o_orderdate) AS VARCHAR) || '.0' AS i94yr,
       CAST(month(o.o_orderdate) AS VARCHAR) || '.0' AS i94mon,
       CAST(c.c_nationkey AS VARCHAR) || '.0' AS i94cit,
       CAST(c.c_custkey % 30 AS VARCHAR) AS i94res,
       o.o_orderpriority AS i94port,
       CAST({DAYS} AS VARCHAR) || '.0' AS arrdate,
       CAST(o.o_custkey % 5 AS VARCHAR) || '.0' AS i94mode,
       CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE 'S' || CAST(c.c_nationkey AS VARCHAR) END AS i94addr,
       CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE CAST({DAYS} + o.o_orderkey % 20 AS VARCHAR) END AS depdate,
       CAST(c.c_nationkey + 20 AS VARCHAR) AS i94bir,
       CAST(o.o_orderkey % 3 + 1 AS VARCHAR) || '.0' AS i94visa,
       CAST(year(o.o_orderdate) - c.c_nationkey - 20 AS VARCHAR) AS biryear,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       substring(o.o_orderpriority, 1, 1) AS airline,
       o.o_orderstatus AS visatype
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

BUILD_FACT = f"""
WITH raw AS ({RAW_ARRIVALS}),
mode_book(code, label) AS (VALUES (1, 'Air'), (2, 'Sea'), (3, 'Land'), (9, 'Not reported')),
visa_book(code, label) AS (VALUES (1, 'Business'), (2, 'Pleasure'), (3, 'Student')),
country AS (SELECT n_nationkey AS code, min(n_name) AS label FROM nation GROUP BY n_nationkey)
SELECT {x1('r.cicid')} AS "ID", {x1('r.i94yr')} AS "year", {x1('r.i94mon')} AS "month",
       cn.label AS native_country, rn.label AS residence_country,
       r.i94port AS port_of_admission, r.i94addr AS arrival_state,
       {day_to_date('r.arrdate')} AS arrival_date, {day_to_date('r.depdate')} AS departure_date,
       v.label AS visa, {x1('r.i94bir')} AS age, {x1('r.biryear')} AS birth_year,
       r.gender, r.airline, m.label AS "Mode", r.visatype
FROM raw r
LEFT JOIN mode_book m ON {x1('r.i94mode')} = m.code
LEFT JOIN visa_book v ON {x1('r.i94visa')} = v.code
LEFT JOIN country cn ON {x1('r.i94cit')} = cn.code
LEFT JOIN country rn ON {x1('r.i94res')} = rn.code
WHERE r.i94addr IS NOT NULL
"""

FACT_DECODED = f"""
WITH raw AS ({RAW_ARRIVALS}),
mode_book(code, label) AS (VALUES (1, 'Air'), (2, 'Sea'), (3, 'Land'), (9, 'Not reported')),
visa_book(code, label) AS (VALUES (1, 'Business'), (2, 'Pleasure'), (3, 'Student')),
port_book(code, label) AS (VALUES ('1-URGENT', 'URGENT, AK'), ('2-HIGH', 'Collapsed (HIGH)'),
  ('3-MEDIUM', 'No PORT Code (3)')),
state_book AS (SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation WHERE n_nationkey <= 20),
country AS (SELECT n_nationkey AS code, CASE n_nationkey WHEN 3 THEN 'INVALID: STATELESS'
  WHEN 5 THEN 'Collapsed (MEXICO)' WHEN 7 THEN 'No Country Code (7)' ELSE n_name END AS label FROM nation)
SELECT r.i94port, p.label AS port_label, r.i94addr, s.label AS state_label, r.i94mode, m.label AS mode_label, r.i94visa, v.label AS visa_label,
       r.i94cit, cn.label AS cit_label, r.i94res, rn.label AS res_label
FROM raw r
LEFT JOIN mode_book m ON {x1('r.i94mode')} = m.code
LEFT JOIN visa_book v ON {x1('r.i94visa')} = v.code
LEFT JOIN country cn ON {x1('r.i94cit')} = cn.code
LEFT JOIN country rn ON {x1('r.i94res')} = rn.code
LEFT JOIN port_book p ON trim(r.i94port) = p.code
LEFT JOIN state_book s ON r.i94addr = s.code
WHERE r.i94addr IS NOT NULL
"""


def _decode_quality(name: str, code: str, label: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, CAST(count_if({code} IS NULL) AS BIGINT) AS n_null_code, "
        f"CAST(count_if({code} IS NOT NULL AND {label} IS NULL) AS BIGINT) AS n_unmatched, "
        f"CAST(count_if(regexp_matches(lower({label}), '^(invalid|collapsed|no country code|no port code)')) AS BIGINT) "
        "AS n_invalid FROM d"
    )


BUILD_DIMENSION_STATE = f"""
WITH raw AS (
  SELECT p_name AS city, p_type AS state, CAST(p_size AS VARCHAR) || '.5' AS median_age,
         CAST(p_size * 100 AS VARCHAR) || '.0' AS male, CAST(p_size * 110 AS VARCHAR) AS female,
         CAST(p_size * 210 AS VARCHAR) AS total,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(p_size * 3 AS VARCHAR) END AS veterans,
         CASE WHEN p_size % 11 = 0 THEN 'x' ELSE CAST(p_size * 5 AS VARCHAR) END AS foreign_born,
         CASE WHEN p_size % 13 = 0 THEN NULL ELSE p_brand END AS household,
         substring(p_type, 1, 2) AS state_code, p_brand AS race, CAST(p_partkey AS VARCHAR) || '.0' AS cnt
  FROM part),
t AS (
  SELECT city AS "City", state AS "State", median_age AS "Median_age", {x1('male')} AS "Male_population",
         {x1('female')} AS "Female_population", {x1('total')} AS "Total_population",
         {x1('veterans')} AS "Number_veterans", {x1('foreign_born')} AS "Foreign_born",
         household AS "Average_household_size", state_code AS "State_code", race AS "Race", {x1('cnt')} AS "Count"
  FROM raw)
SELECT * FROM t
WHERE "Male_population" IS NOT NULL AND "Female_population" IS NOT NULL AND "Number_veterans" IS NOT NULL
  AND "Foreign_born" IS NOT NULL AND "Average_household_size" IS NOT NULL
"""

TEMPERATURE_UNROUNDED = """
WITH raw AS (
  SELECT CASE WHEN c.c_custkey % 2 = 0 THEN lower(n.n_name) ELSE n.n_name END AS country,
         CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE c.c_acctbal END AS t,
         c.c_name AS lat, c.c_mktsegment AS lon
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
g AS (
  SELECT upper(country) AS country, avg(t) AS temperature,
         min(CASE WHEN lat IS NOT NULL THEN struct_pack(lat := lat, lon := lon) END) AS rep
  FROM raw GROUP BY upper(country))
SELECT country AS "Country", temperature AS "Temperature", rep.lat AS "Latitude", rep.lon AS "Longitude" FROM g
"""

BUILD_DIMENSION_COUNTRY = f"""
SELECT "Country", round("Temperature", 4) AS "Temperature", "Latitude", "Longitude" FROM ({TEMPERATURE_UNROUNDED})
"""

BUILD_DIMENSION_FILTERED = """
WITH raw AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS ident, 'small_airport' AS type, s.s_name AS name,
         CAST(s.s_nationkey AS VARCHAR) AS elevation_ft, 'NA' AS continent,
         CASE WHEN n.n_regionkey = 1 THEN 'US' WHEN n.n_regionkey = 2 THEN NULL ELSE 'CA' END AS iso_country,
         CASE WHEN s.s_suppkey % 10 = 0 THEN 'US' ELSE 'US-' || n.n_name END AS iso_region,
         n.n_name AS municipality, 'K' || CAST(s.s_suppkey AS VARCHAR) AS gps_code,
         CAST(NULL AS VARCHAR) AS iata_code, CAST(s.s_suppkey AS VARCHAR) AS local_code,
         CAST(s.s_suppkey AS VARCHAR) || ', ' || CAST(s.s_nationkey AS VARCHAR) AS coordinates
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)
SELECT ident, type, name, elevation_ft, continent, iso_country, substring(iso_region, 4, 10) AS state,
       municipality, gps_code, iata_code, local_code, coordinates
FROM raw WHERE iso_country = 'US'
"""

DOCS_LABELS = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"

DECODED_DOCUMENTS = """
SELECT d.doc_id, d.lang, q.quality, t.toxic
FROM documents d
LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id) q
  ON d.doc_id = q.doc_id
LEFT JOIN (SELECT doc_id, min(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id) t
  ON d.doc_id = t.doc_id
"""

EVENT_BOOK = "(VALUES ('click', 'Click'), ('view', 'Page view'), ('purchase', 'Purchase'), ('signup', 'Sign-up')) AS b(code, label)"

DECODED_EVENTS = f"""
SELECT e.event_id, e.event_type, b.label AS event_label FROM events e LEFT JOIN {EVENT_BOOK} ON e.event_type = b.code
"""

ORDERS_BY_STATE = "orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _non_empty(name: str, source: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM {source}"


def _null_count(col: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, CAST(count_if({col} IS NULL) AS BIGINT) AS null_count, "
        f"count(*) AS row_count FROM j"
    )


NULL_PROFILE_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]

MIXED_TEXT = """
SELECT c_custkey,
       CASE WHEN c_custkey % 5 = 0 THEN CAST(c_nationkey AS VARCHAR) || '.0'
            WHEN c_custkey % 5 = 1 THEN '-' || CAST(c_nationkey AS VARCHAR) || '.7'
            WHEN c_custkey % 5 = 2 THEN 'x' || CAST(c_nationkey AS VARCHAR)
            WHEN c_custkey % 5 = 3 THEN ''
            ELSE CAST(c_custkey AS VARCHAR) || '0000000000' END AS raw_text
FROM customer
"""

SCHEMA_RAW = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CASE WHEN c_custkey % 10 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal, c_mktsegment
FROM customer
"""


def _schema_row(col: str, actual: str, expected: str, bad: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, '{actual}' AS actual_type, '{expected}' AS expected_type, "
        f"{'true' if actual == expected else 'false'} AS type_ok, count({col}) AS n_values, "
        f"CAST(count_if({col} IS NOT NULL AND ({bad}) IS NULL) AS BIGINT) AS n_bad_values FROM r"
    )


def _key_summary(name: str, source: str, keys: list[str]) -> str:
    cols = ", ".join(f'"{k}"' for k in keys)
    null_any = " OR ".join(f'"{k}" IS NULL' for k in keys)
    return f"""
    SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows,
           CAST(coalesce(sum(CASE WHEN has_null = 1 THEN n END), 0) AS BIGINT) AS n_null_key_rows,
           count(*) AS n_distinct_keys, CAST(count_if(n > 1) AS BIGINT) AS n_duplicate_keys
    FROM (SELECT {cols}, count(*) AS n, max(CASE WHEN {null_any} THEN 1 ELSE 0 END) AS has_null
          FROM ({source}) GROUP BY {cols})"""


def _published(name: str, source: str, keys: list[str]) -> list[str]:
    summary, shown = _key_summary(name, source, keys), ", ".join(keys)
    return [
        f"SELECT table_name, '{check}' AS check_name, '{column}' AS column_name, {c} AS n_rows, {c} {test} AS passed "
        f"FROM ({summary})"
        for check, column, c, test in (
            ("rows", "", "n_rows", "> 0"), ("null_keys", shown, "n_null_key_rows", "= 0"),
            ("duplicate_keys", shown, "n_duplicate_keys", "= 0"))
    ]


_ALL_DECODES = " UNION ALL ".join(_decode_quality(*x) for x in (
    ("Mode", "i94mode", "mode_label"), ("visa", "i94visa", "visa_label"),
    ("native_country", "i94cit", "cit_label"), ("residence_country", "i94res", "res_label"),
    ("port", "i94port", "port_label"), ("state", "i94addr", "state_label")))

# The star's tables at link grain: f (fact), by_code and by_name (population), a (airports), t (temperature).
STAR_LINKS = f"""
f AS ({BUILD_FACT}),
state_book AS (SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation WHERE n_nationkey <= 20),
cities AS (
  SELECT p_name AS city, 'S' || CAST(p_size % 25 AS VARCHAR) AS state_code, n.n_name AS state, p_size * 210 AS total
  FROM part JOIN nation n ON p_size % 25 = n.n_nationkey
  WHERE p_size % 7 <> 0 AND p_size % 11 <> 0 AND p_size % 13 <> 0),
by_code AS (SELECT state_code AS k, count(*) AS n_cities, sum(total)::BIGINT AS population
  FROM (SELECT state_code, city, max(total) AS total FROM cities GROUP BY ALL) GROUP BY 1),
by_name AS (SELECT state AS k, count(*) AS n_cities, sum(total)::BIGINT AS population
  FROM (SELECT state, city, max(total) AS total FROM cities GROUP BY ALL) GROUP BY 1),
a AS (SELECT 'S' || CAST(s_nationkey AS VARCHAR) AS k, count(*) AS n_airports FROM supplier GROUP BY 1),
t AS ({TEMPERATURE_UNROUNDED})"""

ORACLE_SQL: dict[str, str] = {
    "arrivals_by_nation_month": """
        SELECT n.n_name AS nation, r.r_name AS region,
               CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
               count(*) AS n_arrivals, round(sum(o.o_totalprice), 2) AS total_price
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY ALL""",
    "scan_csv_header": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "scan_csv_mixed_headers": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "scan_csv_rejects": """
        WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status, o_orderpriority AS priority,
                          CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 51 = 0 THEN 'fields'
                               WHEN o_orderkey % 53 = 0 THEN 'quote' END AS problem,
                          CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',extra'
                               WHEN o_orderkey % 51 = 0 THEN o_orderkey || ',' || o_orderstatus
                               WHEN o_orderkey % 53 = 0 THEN o_orderkey || ',' || o_orderstatus || ',"' || o_orderpriority END AS line
                   FROM orders)
        SELECT CASE WHEN problem IS NULL THEN key END AS key, CASE WHEN problem IS NULL THEN status END AS status,
               CASE WHEN problem IS NULL THEN priority END AS priority, problem, line FROM l""",
    "scan_csv_semicolon": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "scan_by_format": " UNION ALL ".join(
        f"SELECT '{f}' AS format, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
        for f in ("csv", "json", "orc", "parquet")
    ),
    "scan_csv_inferred": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "scan_lookup_quoted": "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name || ', PRC' AS label FROM nation",
    "scan_parquet": "SELECT r_regionkey, r_name FROM region",
    "sink_parquet_overwrite": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "load_append_by_name": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "conform_schema": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS c_comment
        FROM customer""",
    "table_replace": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "refresh_month": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 97 <> 0 AND year(o_orderdate) = 1997 AND month(o_orderdate) = 5 THEN o_totalprice * 2
                    ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority,
               CASE WHEN o_orderkey % 97 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
               CASE WHEN o_orderkey % 97 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS month
        FROM orders""",
    "rename_columns": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, c_acctbal, c_mktsegment
        FROM customer""",
    "drop_columns": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
               l_returnflag, l_shipdate
        FROM lineitem""",
    "select_columns": "SELECT p_partkey, p_brand, p_size FROM part",
    "preview_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "drop_null_single": f"""
        SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM {DOCS_LABELS} WHERE l.quality IS NOT NULL""",
    "drop_null_any": f"""
        SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic, nullif(l.toxic, 1) AS toxic_flag
        FROM {DOCS_LABELS} WHERE l.quality IS NOT NULL AND nullif(l.toxic, 1) IS NOT NULL""",
    "filter_equals": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "decode_left": DECODED_DOCUMENTS,
    "decode_int_text": """
        SELECT o.o_orderkey, o.mode_code, b.label AS mode
        FROM (SELECT o_orderkey, CASE WHEN o_custkey % 7 = 5 THEN 'x' WHEN o_custkey % 7 = 6 THEN NULL
                     ELSE CAST(o_custkey % 7 AS VARCHAR) || '.0' END AS mode_code FROM orders) o
        LEFT JOIN (VALUES (1, 'Air'), (2, 'Sea'), (3, 'Land'), (9, 'Not reported')) AS b(code, label)
          ON TRY_CAST(trunc(TRY_CAST(o.mode_code AS DOUBLE)) AS BIGINT) = b.code""",
    "decode_string_key": DECODED_EVENTS,
    "decode_with_default": f"""
        SELECT e.event_id, e.event_type, coalesce(b.label, 'other') AS event_label
        FROM events e LEFT JOIN {EVENT_BOOK} ON e.event_type = b.code""",
    "decode_role_playing": """
        SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS cust_nation, sn.n_name AS supp_nation
        FROM lineitem l
        LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
        LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
        LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey""",
    "group_avg_first": """
        SELECT segment, round(avg_acctbal, 4) AS avg_acctbal, rep.c_name AS c_name, rep.c_custkey AS c_custkey
        FROM (SELECT upper(c_mktsegment) AS segment, avg(c_acctbal) AS avg_acctbal,
                     min(CASE WHEN c_name IS NOT NULL THEN struct_pack(c_name := c_name, c_custkey := c_custkey) END) AS rep
              FROM customer GROUP BY upper(c_mktsegment))""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "null_profile": "WITH j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM "
    + DOCS_LABELS + ") " + " UNION ALL ".join(_null_count(c) for c in NULL_PROFILE_COLUMNS),
    "aggregate_by_state": """
        SELECT c_nationkey, count(*) AS n_segments, round(sum(acctbal), 2) AS acctbal
        FROM (SELECT c_nationkey, c_mktsegment, max(c_acctbal) AS acctbal FROM customer GROUP BY 1, 2)
        GROUP BY c_nationkey""",
    "aggregate_race_by_state": """
        SELECT c_nationkey, c_mktsegment, round(sum(c_acctbal), 2) AS c_acctbal FROM customer
        GROUP BY c_nationkey, c_mktsegment""",
    "text_to_int": f"SELECT c_custkey, raw_text, {x1('raw_text')} AS as_int FROM ({MIXED_TEXT})",
    "numeric_day_to_date": f"""
        SELECT o.o_orderkey, CAST({DAYS} AS VARCHAR) || '.0' AS day_text, CAST(o.o_orderdate AS DATE) AS arrival_date
        FROM orders o""",
    "recode_case": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'O' THEN 'open'
                                ELSE o_orderstatus END AS status_label,
               CASE code WHEN '2.0' THEN 'see' WHEN '3.0' THEN 'land' WHEN '9.0' THEN 'not reported'
                         ELSE code END AS mode_label,
               CASE code WHEN '2.0' THEN 'Pleasure' WHEN '3.0' THEN 'Student' ELSE code END AS visa_label
        FROM (SELECT o_orderkey, o_orderstatus, CASE o_custkey % 11 WHEN 0 THEN 'x' WHEN 1 THEN ''
                     ELSE CAST(o_custkey % 11 AS VARCHAR) || '.0' END AS code FROM orders)""",
    "normalise_label": """
        SELECT n_nationkey, trim(replace(chr(160) || n_name || ' ' || chr(160) || ' ', chr(160), ' ')) AS label
        FROM nation""",
    "upper_case": "SELECT p_partkey, upper(p_name) AS name_upper FROM part",
    "substring_from": "SELECT p_partkey, substring(p_brand, 7, 10) AS brand_number FROM part",
    "parse_date_pattern": """
        SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') AS DATE) AS order_date
        FROM orders""",
    "star_by_state": f"""
        SELECT c.c_nationkey AS state, d.n_suppliers, d.supplier_acctbal, count(*) AS n_arrivals
        FROM {ORDERS_BY_STATE}
        LEFT JOIN (SELECT s_nationkey, count(*) AS n_suppliers, round(sum(s_acctbal), 2) AS supplier_acctbal
                   FROM supplier GROUP BY s_nationkey) d ON c.c_nationkey = d.s_nationkey
        GROUP BY ALL""",
    "star_by_state_count": f"""
        SELECT o.o_orderkey, c.c_nationkey AS state, d.n_airports
        FROM {ORDERS_BY_STATE}
        LEFT JOIN (SELECT s_nationkey, count(*) AS n_airports FROM supplier GROUP BY s_nationkey) d
          ON c.c_nationkey = d.s_nationkey""",
    "star_by_country": f"""
        WITH f AS (SELECT lower(n.n_name) AS residence_country FROM {ORDERS_BY_STATE}
                   LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
        t AS (SELECT upper(n.n_name) AS country, avg(c.c_acctbal) AS temperature
              FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY upper(n.n_name))
        SELECT f.residence_country, round(t.temperature, 4) AS temperature, count(*) AS n_arrivals
        FROM f LEFT JOIN t ON upper(f.residence_country) = t.country
        GROUP BY ALL""",
    "quality_non_empty": " UNION ALL ".join(
        [_non_empty(t, t) for t in TABLES]
        + [_non_empty("region_atlantis", "(SELECT * FROM region WHERE r_name = 'ATLANTIS')")]
    ),
    "quality_duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "quality_key_summary": """
        SELECT CAST(sum(n) AS BIGINT) AS n_rows,
               CAST(coalesce(sum(CASE WHEN has_null = 1 THEN n END), 0) AS BIGINT) AS n_null_key_rows,
               count(*) AS n_distinct_keys, CAST(count_if(n > 1) AS BIGINT) AS n_duplicate_keys
        FROM (SELECT l_orderkey, l_linenumber, count(*) AS n,
                     max(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 1 ELSE 0 END) AS has_null
              FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "quality_unmatched_codes": f"WITH d AS ({DECODED_DOCUMENTS}) " + " UNION ALL ".join(
        f"""SELECT '{lab}' AS column_name, count(*) AS n_rows,
                   CAST(count_if(doc_id IS NULL) AS BIGINT) AS n_null_code,
                   CAST(count_if(doc_id IS NOT NULL AND {lab} IS NULL) AS BIGINT) AS n_unmatched,
                   CAST(count_if(CAST({lab} AS VARCHAR) LIKE 'INVALID%') AS BIGINT) AS n_invalid
            FROM d"""
        for lab in ("quality", "toxic")
    ),
    "quality_unmatched_code_list": f"""
        SELECT event_type, count(*) AS n_rows FROM ({DECODED_EVENTS})
        WHERE event_type IS NOT NULL AND event_label IS NULL GROUP BY event_type""",
    "schema_report": f"WITH r AS ({SCHEMA_RAW}) " + " UNION ALL ".join([
        _schema_row("c_custkey", "string", "bigint", "TRY_CAST(c_custkey AS BIGINT)"),
        _schema_row("c_name", "string", "string", "c_name"),
        _schema_row("c_nationkey", "string", "int", x1("c_nationkey")),
        _schema_row("c_acctbal", "string", "double", "TRY_CAST(c_acctbal AS DOUBLE)"),
        _schema_row("c_mktsegment", "string", "string", "c_mktsegment"),
    ]),
    "build_fact": BUILD_FACT,
    "build_dimension_state": BUILD_DIMENSION_STATE,
    "build_dimension_country": BUILD_DIMENSION_COUNTRY,
    "build_dimension_filtered": BUILD_DIMENSION_FILTERED,
    "stream_monthly_drops": BUILD_FACT,
    "quality_fact_decodes": f"WITH d AS ({FACT_DECODED}) " + " UNION ALL ".join([
        _decode_quality("Mode", "i94mode", "mode_label"),
        _decode_quality("visa", "i94visa", "visa_label"),
        _decode_quality("native_country", "i94cit", "cit_label"),
        _decode_quality("residence_country", "i94res", "res_label"),
        _decode_quality("port", "i94port", "port_label"),
        _decode_quality("state", "i94addr", "state_label"),
    ]),
    "quality_contract_keys": " UNION ALL ".join([
        _key_summary("immigration", BUILD_FACT, ["ID"]),
        _key_summary("demographics", BUILD_DIMENSION_STATE, ["City", "State_code", "Race"]),
        _key_summary("temperature", TEMPERATURE_UNROUNDED, ["Country"]),
        _key_summary("airports", BUILD_DIMENSION_FILTERED, ["ident"]),
    ]),
    "publish_report": " UNION ALL ".join([
        *_published("immigration", BUILD_FACT, ["ID"]),
        """SELECT 'immigration', 'rejected', 'year, month', CAST(0 AS BIGINT), true""",
        """SELECT 'immigration', 'keys_in_other_months', 'ID', CAST(0 AS BIGINT), true""",
        *_published("demographics", BUILD_DIMENSION_STATE, ["City", "State_code", "Race"]),
        *_published("temperature", TEMPERATURE_UNROUNDED, ["Country"]),
        *_published("airports", BUILD_DIMENSION_FILTERED, ["ident"]),
        *[f"""SELECT 'immigration', '{check}', column_name, {c}, {c} = 0 FROM (
              WITH d AS ({FACT_DECODED}) {_ALL_DECODES})"""
          for check, c in (("unmatched", "n_unmatched"), ("invalid", "n_invalid"))],
    ]),
    "load_tables_checked": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 2 * count(*) AS row_count, count(*) > 0 AS passed FROM ({sql})"
        for name, sql in (("immigration", BUILD_FACT), ("demographics", BUILD_DIMENSION_STATE),
                          ("temperature", TEMPERATURE_UNROUNDED), ("airports", BUILD_DIMENSION_FILTERED))),
    "publish_loads": f"""
        WITH f AS (SELECT * FROM ({BUILD_FACT}) WHERE "ID" IS NOT NULL),
        l AS (SELECT 'odd' AS load, f.*, false AS lost FROM f WHERE month % 2 = 1
              UNION ALL SELECT 'even', f.*, "ID" % 40 = 0 FROM f WHERE month % 2 = 0)
        SELECT load, CAST(count(DISTINCT (year, month)) FILTER (NOT lost) AS INTEGER) AS n_months,
               count(*) FILTER (NOT lost) AS n_rows, count(*) FILTER (lost) AS n_rejected,
               count(*) FILTER (lost) AS n_stored_rejects,
               (SELECT count(*) FROM l WHERE NOT lost) AS n_fact_rows
        FROM l GROUP BY load""",
    "quality_keys_across_months": f"""
        WITH f AS (SELECT "ID", year, month FROM ({BUILD_FACT}) WHERE "ID" IS NOT NULL),
        t AS (SELECT * FROM f UNION ALL SELECT "ID", year, month + 1 FROM f WHERE "ID" % 10 = 0 AND month < 12)
        SELECT CAST("ID" AS BIGINT) AS "ID", count(DISTINCT (year, month)) AS n_months,
               min(100 * year + month) AS first_month, max(100 * year + month) AS last_month
        FROM t GROUP BY "ID" HAVING count(DISTINCT (year, month)) > 1""",
    "star_enriched": f"""
        WITH {STAR_LINKS}
        SELECT 'code' AS linked_by, f."ID", f.arrival_state, c.population AS "Total_population", c.n_cities,
               a.n_airports, round(t."Temperature", 4) AS residence_temperature
        FROM f LEFT JOIN by_code c ON f.arrival_state = c.k LEFT JOIN a ON f.arrival_state = a.k
        LEFT JOIN t ON upper(f.residence_country) = t."Country"
        UNION ALL
        SELECT 'name', f."ID", f.arrival_state, n.population, n.n_cities, a.n_airports, round(t."Temperature", 4)
        FROM f LEFT JOIN state_book s ON f.arrival_state = s.code
        LEFT JOIN by_name n ON coalesce(s.label, 'OTHER') = n.k LEFT JOIN a ON f.arrival_state = a.k
        LEFT JOIN t ON upper(f.residence_country) = t."Country" """,
    "star_state_month": f"""
        WITH {STAR_LINKS}
        SELECT f.arrival_state, f.year, f.month, count(*) AS n_arrivals, max(c.population) AS state_population,
               max(a.n_airports) AS n_airports
        FROM f LEFT JOIN by_code c ON f.arrival_state = c.k LEFT JOIN a ON f.arrival_state = a.k
        GROUP BY ALL""",
    "star_state_month_refreshed": f"""
        WITH {STAR_LINKS}
        SELECT f.arrival_state, f.year, f.month, count(*) AS n_arrivals, max(c.population) AS state_population,
               max(a.n_airports) AS n_airports
        FROM f LEFT JOIN by_code c ON f.arrival_state = c.k LEFT JOIN a ON f.arrival_state = a.k
        GROUP BY ALL""",
    "profile_merged": f"WITH f AS ({BUILD_FACT}) " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count("{c}") AS n_null,
            min(CAST("{c}" AS VARCHAR)) AS least, max(CAST("{c}" AS VARCHAR)) AS greatest, '{t}' AS narrowest_type FROM f"""
        for c, t in (("ID", "int"), ("native_country", "string"), ("residence_country", "string"),
                     ("port_of_admission", "string"), ("arrival_state", "string"), ("arrival_date", "date"),
                     ("departure_date", "date"), ("visa", "string"), ("age", "int"), ("birth_year", "int"),
                     ("gender", "string"), ("airline", "int"), ("Mode", "string"), ("visatype", "string"))),
    "group_avg_merged": """
        SELECT segment, total / n AS avg_acctbal, rep.c_name AS c_name, rep.c_custkey AS c_custkey
        FROM (SELECT upper(c_mktsegment) AS segment, CAST(sum(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(28, 10))) AS DOUBLE) AS total,
                     count(c_acctbal) AS n,
                     min(CASE WHEN c_name IS NOT NULL THEN struct_pack(c_name := c_name, c_custkey := c_custkey) END) AS rep
              FROM customer GROUP BY 1)""",
    "decode_hot_codes": """
        SELECT l_orderkey, l_linenumber, CAST(k AS VARCHAR) AS l_partkey, p_brand AS brand, p_size AS size
        FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS k FROM lineitem)
        LEFT JOIN part ON k = p_partkey""",
}
