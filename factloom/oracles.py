"""DuckDB SQL for the queries of `catalogue`, written on its own from the tables up."""

from __future__ import annotations

COHORT = "Oil & Gas E&P"
PERIOD = "1998-12-31"
D, U, T = "proved_developed_reserves_boe", "proved_undeveloped_reserves_boe", "proved_reserves_boe"
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"

COMPANY = f"""company AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, s_name AS name,
    CASE WHEN s_suppkey % 9 <> 0 THEN 'T' || s_suppkey END AS ticker,
    CASE WHEN n_regionkey <= 2 THEN '{COHORT}' WHEN n_regionkey = 3 THEN 'Oil & Gas Integrated' END AS cohort,
    s_acctbal >= 0 AS is_operator, n_name AS country,
    CASE WHEN s_suppkey % 4 = 0 THEN 'private-filer' ELSE 'listed' END AS listing_status
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
FILING = """filing AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS accession, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
    CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '20-F' ELSE '40-F' END AS form,
    strftime(o_orderdate, '%Y-%m-%d') AS filed_date FROM orders)"""
FACT = f"""line AS (
  SELECT *, CASE l_linenumber % 4 WHEN 1 THEN 'oil' WHEN 2 THEN 'gas' WHEN 3 THEN 'ngl' END AS product,
    md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
      CAST(CAST(round(l_quantity * 100) AS BIGINT) AS VARCHAR), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR),
      CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR), CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR),
      l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS id FROM lineitem),
fact AS (
  SELECT id, lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS cik,
    CASE l_returnflag WHEN 'A' THEN '{D}' WHEN 'N' THEN '{U}' ELSE '{T}' END AS concept_key,
    l_extendedprice AS value, CASE l_linestatus WHEN 'F' THEN 'MBoe' ELSE 'MMcfe' END AS unit,
    CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS unit_rank, product, coalesce(product, '') AS product_key,
    CAST(year(l_shipdate) AS VARCHAR) || '-12-31' AS period_end, CAST(l_orderkey AS VARCHAR) AS accession, 'us-gaap' AS taxonomy,
    CASE l_returnflag WHEN 'A' THEN 'ProvedDevelopedReservesVolume' WHEN 'N' THEN 'ProvedUndevelopedReserveVolume' ELSE 'ProvedDevelopedAndUndevelopedReservesNet' END AS tag
  FROM line),
verification AS (
  SELECT id AS fact_id, CASE WHEN l_discount > 0.05 THEN 'found' ELSE 'not_found' END AS status, 'doc-' || l_orderkey || '.htm' AS document
  FROM line WHERE l_discount > 0.02),
scale AS (
  SELECT id AS fact_id, CAST(1 AS DOUBLE) AS divisor, 'BOE' AS canonical_unit,
    l_extendedprice * CASE l_linestatus WHEN 'F' THEN CAST(1000 AS DOUBLE) ELSE CAST(1000000 AS DOUBLE) / 6000 END AS canonical_value
  FROM line WHERE l_tax < 0.05)"""
CURRENT = """ranked AS (
  SELECT f.*, fl.form, fl.filed_date, row_number() OVER (
    PARTITION BY f.cik, f.concept_key, f.product_key, f.period_end ORDER BY fl.filed_date DESC, f.unit_rank, f.id DESC) AS rn
  FROM fact f JOIN filing fl ON fl.accession = f.accession),
fact_current AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)"""
CHANGED = """unit_discontinuity AS (
  SELECT cik, concept_key, product_key AS product, count(DISTINCT unit) AS distinct_units,
    string_agg(DISTINCT unit, ',' ORDER BY unit) AS units, min(period_end) AS first_period, max(period_end) AS last_period
  FROM fact GROUP BY cik, concept_key, product_key HAVING count(DISTINCT unit) > 1)"""
COLLIDED = """fact_collision AS (
  SELECT f.cik, f.concept_key, f.product_key AS product, f.period_end, count(DISTINCT f.value) AS distinct_values,
    count(DISTINCT f.unit) AS distinct_units, min(f.value) AS min_value, max(f.value) AS max_value, string_agg(DISTINCT f.unit, ',' ORDER BY f.unit) AS units
  FROM fact f JOIN filing fl ON fl.accession = f.accession
  GROUP BY f.cik, f.concept_key, f.product_key, f.period_end, fl.filed_date HAVING count(DISTINCT f.value) > 1)"""
CONSISTENT = f"""wide AS (
  SELECT cik, period_end, product,
    max(value) FILTER (concept_key = '{D}') AS developed_value, max(unit) FILTER (concept_key = '{D}') AS developed_unit,
    max(value) FILTER (concept_key = '{U}') AS undeveloped_value, max(unit) FILTER (concept_key = '{U}') AS undeveloped_unit,
    max(value) FILTER (concept_key = '{T}') AS total_value, max(unit) FILTER (concept_key = '{T}') AS total_unit,
    max(accession) FILTER (concept_key = '{D}') AS developed_accession, max(accession) FILTER (concept_key = '{T}') AS total_accession,
    max(tag) FILTER (concept_key = '{D}') AS developed_tag, max(tag) FILTER (concept_key = '{T}') AS total_tag
  FROM fact_current GROUP BY cik, period_end, product),
reserve_consistency AS (
  SELECT *, CASE WHEN developed_unit = total_unit AND total_value <> 0 THEN developed_value / total_value END AS ratio,
    CASE WHEN developed_unit <> total_unit THEN 'units differ' WHEN total_value = 0 THEN 'total proved is zero'
      WHEN undeveloped_value IS NOT NULL AND undeveloped_unit = developed_unit AND abs(developed_value + undeveloped_value - total_value) > total_value * 0.03 THEN 'components do not sum to total'
      WHEN developed_value > total_value * 1.02 THEN 'developed exceeds total' WHEN developed_value = total_value THEN 'developed equals total' END AS issue
  FROM wide WHERE developed_value IS NOT NULL AND total_value IS NOT NULL)"""
LATEST = """latest AS (SELECT * EXCLUDE (recency) FROM (
  SELECT *, row_number() OVER (PARTITION BY cik, concept_key, product_key ORDER BY period_end DESC, id DESC) AS recency FROM fact_current) WHERE recency = 1)"""
REGISTRY = f"""registry AS (SELECT * FROM (VALUES ('{D}', 'Developed reserves, proved', 0), ('{U}', 'Undeveloped reserves, proved', 1), ('{T}', 'All proved reserves', 2)) AS r(concept_key, label, concept_ord))"""
URL = f"'{ARCHIVE}/' || CAST(CAST(cik AS BIGINT) AS VARCHAR) || '/' || accession || '/' || accession || '-index.htm'"
VIEW = "id, cik, concept_key, value, unit, product, period_end, accession, form, filed_date"
STORE = (COMPANY, FILING, FACT, CURRENT)


def with_(*parts: str, then: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + then


def panel(source: str, where: str, extra: str = "") -> str:
    """Cells dressed for the panel, with their place inside a unit."""
    return with_(
        *STORE, CHANGED, LATEST,
        f"""dressed AS (
  SELECT f.*, c.name, c.ticker, c.cohort, ud.units AS series_units, ud.units IS NOT NULL AS unit_changed, v.status AS verify_status, s.canonical_value, s.canonical_unit,
    max(f.value) OVER (PARTITION BY f.unit, f.cik) AS company_max, max(f.period_end) OVER () AS newest
  FROM {source} f JOIN company c ON c.cik = f.cik
  LEFT JOIN unit_discontinuity ud ON ud.cik = f.cik AND ud.concept_key = f.concept_key AND ud.product = f.product_key
  LEFT JOIN verification v ON v.fact_id = f.id LEFT JOIN scale s ON s.fact_id = f.id
  WHERE c.cohort IS NOT NULL AND {where})""",
        then=f"""SELECT id, cik, name, ticker, cohort, value, unit, product, period_end, accession, form, filed_date, unit_changed, series_units, verify_status, canonical_value, canonical_unit,
  {URL} AS filing_url, row_number() OVER (PARTITION BY unit ORDER BY company_max DESC, cik, value DESC, product_key) AS position{extra} FROM dressed""",
    )


def wide(source: str, where: str) -> str:
    picks = ", ".join(
        f"max(value) FILTER (concept_key = '{k}') AS {k}__value, max(unit) FILTER (concept_key = '{k}') AS {k}__unit, max(period_end) FILTER (concept_key = '{k}') AS {k}__period, "
        f"bool_or(found) FILTER (concept_key = '{k}') AS {k}__verified, max(canonical_value) FILTER (concept_key = '{k}') AS {k}__canonical"
        for k in (D, U, T)
    )
    return with_(*STORE, source, then=f"""SELECT cik, name, ticker, cohort, product_key, count(*) AS n_cells, {picks} FROM (
  SELECT l.*, c.name, c.ticker, c.cohort, coalesce(v.status = 'found', false) AS found, s.canonical_value FROM latest l JOIN company c ON c.cik = l.cik
  LEFT JOIN verification v ON v.fact_id = l.id LEFT JOIN scale s ON s.fact_id = l.id WHERE {where}) GROUP BY cik, name, ticker, cohort, product_key""")


def summary(cohort: str | None) -> str:
    scope = "" if cohort is None else f" WHERE cik IN (SELECT cik FROM company WHERE cohort = '{cohort}')"
    and_ = " WHERE" if cohort is None else scope + " AND"
    of = "" if cohort is None else f" WHERE fact_id IN (SELECT id FROM fact{scope})"
    of_and = " WHERE" if cohort is None else of + " AND"
    name = "CAST(NULL AS VARCHAR)" if cohort is None else f"'{cohort}'"
    return with_(*STORE, CHANGED, COLLIDED, CONSISTENT, then=f"""SELECT {name} AS cohort, (SELECT count(*) FROM company{scope}) AS companies, (SELECT count(*) FROM fact{scope}) AS facts,
  (SELECT count(DISTINCT concept_key) FROM fact{scope}) AS concepts, (SELECT min(period_end) FROM fact{scope}) AS earliest_period, (SELECT max(period_end) FROM fact{scope}) AS latest_period,
  (SELECT count(*) FROM fact_current{scope}) AS cells, (SELECT count(*) FROM filing{scope}) AS filings, (SELECT count(*) FROM unit_discontinuity{scope}) AS unit_discontinuities,
  (SELECT count(*) FROM verification{of}) AS verify_checked, (SELECT count(*) FROM verification{of_and} status = 'found') AS verified, (SELECT count(*) FROM scale{of}) AS comparable,
  (SELECT count(*) FROM fact_collision{scope}) AS collisions, (SELECT count(*) FROM reserve_consistency{and_} issue IS NOT NULL) AS reserve_issues""")


def cited(facts: str, where: str) -> str:
    return with_(*STORE, REGISTRY, then=f"""SELECT f.id, f.cik, c.name, c.ticker, f.concept_key, r.label, f.value, f.unit, f.product, f.period_end, f.accession, f.form, f.tag, f.filed_date, v.status AS verify_status, v.document,
  s.canonical_value, s.canonical_unit, s.divisor AS scale_divisor, {URL.replace("cik", "f.cik").replace("accession", "f.accession")} AS filing_url,
  '{ARCHIVE}/' || CAST(CAST(f.cik AS BIGINT) AS VARCHAR) || '/' || f.accession || '/' || v.document AS document_url
  FROM {facts} f JOIN company c ON c.cik = f.cik LEFT JOIN registry r ON r.concept_key = f.concept_key LEFT JOIN verification v ON v.fact_id = f.id LEFT JOIN scale s ON s.fact_id = f.id WHERE {where}""")


NAMED = "JOIN company c USING (cik)"
VALUES = """value_of AS (SELECT cik, concept_key, unit, period_end, value FROM (
  SELECT f.*, row_number() OVER (PARTITION BY f.cik, f.concept_key, f.tag, f.unit, f.period_end ORDER BY fl.filed_date DESC, f.id DESC) AS rn FROM fact f JOIN filing fl ON fl.accession = f.accession) WHERE rn = 1),
triple AS (SELECT d.cik, d.unit, d.period_end, abs(d.value + u.value - t.value) / abs(t.value) AS error
  FROM value_of d JOIN value_of u USING (cik, unit, period_end) JOIN value_of t USING (cik, unit, period_end)
  WHERE d.concept_key = '%s' AND u.concept_key = '%s' AND t.concept_key = '%s' AND t.value <> 0),
score AS (SELECT cik, unit, count(*) AS tested_periods, count(*) FILTER (error <= 0.03) AS coherent_periods, arg_max(error <= 0.03, period_end) AS latest_ok,
    quantile_cont(error, 0.5) AS median_error, coalesce(string_agg(period_end, ',' ORDER BY period_end) FILTER (error > 0.03), '') AS incoherent FROM triple GROUP BY cik, unit),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY latest_ok DESC, coherent_periods DESC, median_error, tested_periods DESC, unit) AS rn FROM score) WHERE rn = 1)""" % (D, U, T)
FACTOR = "CASE unit WHEN 'MBoe' THEN CAST(1000 AS DOUBLE) ELSE CAST(1000000 AS DOUBLE) / 6000 END"
READINGS = f"""total AS (SELECT *, CASE WHEN product_key = 'oil' THEN CAST(1000 AS DOUBLE) END AS printed, CASE WHEN product_key <> 'ngl' THEN value * 12500 END AS measure, {FACTOR} AS factor FROM fact_current WHERE concept_key = '{T}'),
reading AS (SELECT id, measure, CAST(1 AS DOUBLE) AS divisor, value / 1 * factor AS canonical FROM total UNION ALL SELECT id, measure, printed, value / printed * factor FROM total WHERE printed IS NOT NULL),
viable AS (SELECT *, measure / canonical AS ratio FROM reading WHERE canonical > 0 AND canonical <= 1e11 AND measure / canonical BETWEEN 0.3 AND 120),
chosen AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY ratio NOT BETWEEN 1.5 AND 50, abs(ln(ratio) - ln(sqrt(75))), divisor) AS rn FROM viable)"""
# The regular forms of a short word, by hand: those of "of" are of, ofe, ofed and so on.
PHRASE = {w: f"(?i)(?:^|[^0-9A-Za-z_]){w}(?:e|ed|ely|es|ing|ings|s)?[^0-9A-Za-z_]+thes?(?:[^0-9A-Za-z_]|$)" for w in ("of", "and", "in")}
TEST = " OR ".join(f"regexp_matches(text, '{p}')" for p in PHRASE.values())
LINES = """line_text AS (SELECT doc_id AS document_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"""
SIC = "CASE s_suppkey % 5 WHEN 0 THEN '1311' WHEN 1 THEN '6792' WHEN 2 THEN '2911' WHEN 3 THEN '1381' ELSE '9999' END"

ORACLE_SQL: dict[str, str] = {
    "fact_current": with_(*STORE, then=f"SELECT {VIEW} FROM fact_current"),
    "fact_collision": with_(*STORE, COLLIDED, then="SELECT * FROM fact_collision"),
    "unit_discontinuity": with_(*STORE, CHANGED, then="SELECT * FROM unit_discontinuity"),
    "reserve_consistency": with_(*STORE, CONSISTENT, then="SELECT * FROM reserve_consistency"),
    "fact_verified": with_(*STORE, then=f"SELECT {VIEW}, v.status AS verify_status, v.document AS verify_document FROM fact_current f LEFT JOIN verification v ON v.fact_id = f.id"),
    "fact_canonical": with_(*STORE, then=f"SELECT {VIEW}, v.status AS verify_status, s.canonical_value, s.canonical_unit FROM fact_current f LEFT JOIN verification v ON v.fact_id = f.id LEFT JOIN scale s ON s.fact_id = f.id"),
    "panel": panel("fact_current", f"f.concept_key = '{T}' AND f.period_end = '{PERIOD}'"),
    "panel_product": panel("fact_current", f"f.concept_key = '{D}' AND f.period_end = '{PERIOD}' AND f.product_key = 'oil' AND c.cohort = '{COHORT}'"),
    "panel_latest": panel("latest", f"f.concept_key = '{T}'", ", CAST(substr(newest, 1, 4) AS INT) - CAST(substr(period_end, 1, 4) AS INT) AS periods_behind"),
    "panel_latest_cohort": panel("latest", f"f.concept_key = '{D}' AND f.product_key = 'gas' AND c.cohort = '{COHORT}'", ", CAST(substr(newest, 1, 4) AS INT) - CAST(substr(period_end, 1, 4) AS INT) AS periods_behind"),
    "panel_wide": wide(LATEST, "c.cohort IS NOT NULL"),
    "panel_wide_all": wide(f"latest AS (SELECT * FROM fact_current WHERE period_end = '{PERIOD}')", "true"),
    "unit_groups": with_(*STORE, then=f"SELECT unit, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, unit) AS position FROM fact_current f {NAMED} WHERE cohort IS NOT NULL AND concept_key = '{T}' AND period_end = '{PERIOD}' GROUP BY unit"),
    "column_units": with_(*STORE, LATEST, then="SELECT concept_key, string_agg(DISTINCT unit, ',' ORDER BY unit) AS units FROM latest GROUP BY concept_key"),
    "company_series": with_(*STORE, REGISTRY, then=f"SELECT concept_key, label, value, unit, product, period_end, accession, form, tag, filed_date, {URL} AS filing_url FROM fact_current JOIN registry USING (concept_key) WHERE cik = '0000000001'"),
    "company_history": with_(*STORE, then=f"SELECT f.product_key, f.unit, row_number() OVER (PARTITION BY f.product_key, f.unit ORDER BY f.period_end, f.id) AS point, f.period_end AS period, f.value, s.canonical_value, s.canonical_unit, coalesce(v.status = 'found', false) AS verified, f.accession, f.form, f.filed_date FROM fact_current f LEFT JOIN verification v ON v.fact_id = f.id LEFT JOIN scale s ON s.fact_id = f.id WHERE cik = '0000000001' AND concept_key = '{T}'"),
    "trends": with_(*STORE, f"""point AS (SELECT f.*, c.name, c.ticker, s.canonical_value FROM fact_current f JOIN company c ON c.cik = f.cik JOIN scale s ON s.fact_id = f.id WHERE c.cohort IS NOT NULL AND f.concept_key = '{T}' AND f.period_end LIKE '%-12-31'),
per AS (SELECT cik, name, ticker, count(*) AS points, arg_max(canonical_value, (period_end, product_key, id)) AS last_value, max(period_end) AS last_period FROM point GROUP BY cik, name, ticker)""",
        then="SELECT *, (SELECT count(*) FROM per WHERE points < 2) AS dropped, greatest(0, (SELECT count(*) FROM per WHERE points >= 2) - 12) AS omitted FROM per WHERE points >= 2 ORDER BY last_value DESC, cik LIMIT 12"),
    "summary": summary(None),
    "summary_cohort": summary(COHORT),
    "concepts": with_(*STORE, REGISTRY, then="SELECT concept_key, label, count(*) AS cells, CAST(concept_ord AS INT) AS concept_ord FROM fact_current JOIN registry USING (concept_key) GROUP BY ALL"),
    "periods": with_(*STORE, then="SELECT DISTINCT period_end FROM fact_current"),
    "cohorts": with_(*STORE, then="SELECT cohort, count(*) AS companies, count(*) FILTER (is_operator) AS operators, count(*) FILTER (cik IN (SELECT cik FROM fact)) AS with_facts FROM company WHERE cohort IS NOT NULL GROUP BY cohort"),
    "companies": with_(*STORE, then="SELECT c.cik, c.name, c.ticker, count(f.id) AS cells, count(DISTINCT f.concept_key) AS concepts, max(f.period_end) AS latest_period FROM company c LEFT JOIN fact_current f ON f.cik = c.cik WHERE c.cohort IS NOT NULL GROUP BY c.cik, c.name, c.ticker"),
    "coverage_matrix": with_(*STORE, then="SELECT c.cik, c.name, c.ticker, f.concept_key, max(f.period_end) AS latest_period, nullif(count(f.id), 0) AS cells FROM company c LEFT JOIN fact_current f ON f.cik = c.cik WHERE c.cohort IS NOT NULL GROUP BY c.cik, c.name, c.ticker, f.concept_key"),
    "company_concepts": with_(*STORE, then="SELECT f.cik, string_agg(DISTINCT f.concept_key, ',' ORDER BY f.concept_key) AS concepts FROM fact_current f JOIN company c ON c.cik = f.cik WHERE c.cohort IS NOT NULL GROUP BY f.cik"),
    "dq_discontinuities": with_(*STORE, CHANGED, then=f"SELECT u.*, c.name, c.ticker FROM unit_discontinuity u {NAMED}"),
    "dq_collisions": with_(*STORE, COLLIDED, then=f"SELECT k.*, c.name, c.ticker FROM fact_collision k {NAMED} ORDER BY c.name, k.period_end DESC, k.concept_key, k.product, k.min_value, k.max_value LIMIT 200"),
    "dq_fallback_tags": with_(*STORE, then=f"SELECT f.cik, f.concept_key, f.tag, count(*) AS cells, c.name, c.ticker FROM fact_current f {NAMED} WHERE f.tag = 'ProvedDevelopedReservesVolume' GROUP BY ALL"),
    "dq_reserve_issues": with_(*STORE, CONSISTENT, then=f"SELECT r.*, c.name, c.ticker, {URL.replace('accession', 'developed_accession')} AS developed_url, {URL.replace('accession', 'total_accession')} AS total_url FROM reserve_consistency r {NAMED} WHERE issue IS NOT NULL"),
    "dq_unreached": with_(*STORE, then="SELECT c.cik, count(DISTINCT f.concept_key) AS concepts, max(f.period_end) AS latest_period, c.name FROM company c JOIN fact f ON f.cik = c.cik WHERE c.listing_status = 'private-filer' GROUP BY c.cik, c.name"),
    "reserve_ratios": with_(*STORE, CONSISTENT, then=f"SELECT r.*, c.name, c.ticker FROM reserve_consistency r {NAMED} WHERE r.issue IS NULL AND r.ratio IS NOT NULL AND c.cohort IS NOT NULL"),
    "citation": cited("(SELECT f.*, fl.form, fl.filed_date FROM fact f JOIN filing fl ON fl.accession = f.accession)", "v.status = 'not_found'"),
    "fact_locator": cited("fact_current", "v.status = 'found'"),
    "superseded": with_(*STORE, then="SELECT id, cik, concept_key, rn - 1 AS behind FROM ranked WHERE rn > 1"),
    "semi_exists": with_(*STORE, then=f"SELECT cik, name FROM company c WHERE EXISTS (SELECT 1 FROM fact f WHERE f.cik = c.cik AND concept_key = '{T}' AND unit = 'MBoe')"),
    "anti_not_exists": with_(*STORE, then="SELECT accession, form, filed_date FROM filing fl WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.accession = fl.accession)"),
    "not_in_unverified": with_(*STORE, then="SELECT concept_key, count(*) AS n FROM fact WHERE id NOT IN (SELECT fact_id FROM verification) GROUP BY concept_key"),
    "in_not_found": with_(*STORE, then="SELECT concept_key, unit, count(*) AS n FROM fact WHERE id IN (SELECT fact_id FROM verification WHERE status = 'not_found') GROUP BY concept_key, unit"),
    "nullsafe_crosscheck": with_(*STORE, f"""c AS (SELECT *, value * {FACTOR} AS boe FROM fact_current),
r AS (SELECT a.boe AS d, b.boe AS t FROM c a LEFT JOIN c b ON a.cik = b.cik AND a.period_end = b.period_end AND a.product IS NOT DISTINCT FROM b.product AND b.concept_key = '{T}' WHERE a.concept_key = '{D}')""",
        then="SELECT CASE WHEN t IS NULL THEN 'unchecked' WHEN abs(d - t) / t <= 0.01 THEN 'agree' WHEN abs(log10(d / t) - round(log10(d / t))) < 1e-6 AND round(log10(d / t)) <> 0 THEN 'rescaled' ELSE 'disagree' END AS outcome, count(*) AS n FROM r GROUP BY 1"),
    "insert_idempotent": with_(*STORE, f"""old AS (SELECT * FROM fact WHERE concept_key <> '{T}'), new AS (SELECT *, row_number() OVER (PARTITION BY cik, concept_key, product_key, period_end, unit, accession ORDER BY id) AS rn FROM fact WHERE concept_key <> '{D}'),
after AS (SELECT concept_key, id FROM old UNION ALL SELECT concept_key, id FROM new n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.cik = n.cik AND o.concept_key = n.concept_key AND o.product_key = n.product_key AND o.period_end = n.period_end AND o.unit = n.unit AND o.accession = n.accession))""",
        then="SELECT concept_key, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM after GROUP BY concept_key"),
    "appended_facts": with_(*STORE, f"""old AS (SELECT * FROM fact WHERE concept_key <> '{T}'), new AS (SELECT *, row_number() OVER (PARTITION BY cik, concept_key, product_key, period_end, unit, accession ORDER BY id) AS rn FROM fact WHERE concept_key <> '{D}'),
after AS (SELECT concept_key, id FROM old UNION ALL SELECT concept_key, id FROM new n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.cik = n.cik AND o.concept_key = n.concept_key AND o.product_key = n.product_key AND o.period_end = n.period_end AND o.unit = n.unit AND o.accession = n.accession))""",
        then=f"SELECT concept_key, count(*) AS n, min(id) AS first_id, max(id) AS last_id, true AS kept_files, concept_key = '{T}' AS new_files FROM after GROUP BY concept_key"),
    "merged_companies": with_(*STORE, then="SELECT cik, CASE CAST(cik AS BIGINT) % 50 WHEN 7 THEN name || ' II' ELSE name END AS name, ticker, cohort, CASE CAST(cik AS BIGINT) % 50 WHEN 7 THEN 'Canada' ELSE country END AS country, is_operator FROM company WHERE CAST(cik AS BIGINT) % 50 <> 9 UNION ALL SELECT '9999999999', 'Fresh', 'NEW', NULL, NULL, true"),
    "upsert_refresh": with_(*STORE, then="SELECT cik, CASE listing_status WHEN 'private-filer' THEN name || ' II' ELSE name END AS name, ticker, cohort, CASE listing_status WHEN 'private-filer' THEN 'Canada' ELSE country END AS country, is_operator FROM company UNION ALL SELECT '9999999999', 'Fresh', 'NEW', NULL, NULL, true"),
    "upsert_fill_blanks": with_(*STORE, then="SELECT accession, form, filed_date, CASE form WHEN '10-K' THEN substr(filed_date, 1, 4) || '-12-31' ELSE '1999-06-30' END AS period_end FROM filing"),
    "prune_reinsert": with_(*STORE, VALUES, then="SELECT f.concept_key, count(*) AS n FROM fact f WHERE NOT EXISTS (SELECT 1 FROM best b JOIN triple t ON t.cik = b.cik AND t.unit = b.unit WHERE b.cik = f.cik AND t.period_end = f.period_end AND t.error > 0.03) GROUP BY f.concept_key"),
    "reconcile_cohort": with_(*STORE, then="SELECT CASE WHEN is_operator THEN cohort END AS cohort, count(*) AS n FROM company GROUP BY 1"),
    "serving_copy_counts": with_(*STORE, then="SELECT 'company' AS relation, count(*) AS n FROM company UNION ALL SELECT 'filing', count(*) FROM filing UNION ALL SELECT 'fact', count(*) FROM fact UNION ALL SELECT 'verification', count(*) FROM verification UNION ALL SELECT 'scale', count(*) FROM scale"),
    "companyfacts_flatten": with_(*STORE, then="SELECT f.cik, f.concept_key, f.taxonomy, f.tag, f.value, f.unit, f.period_end, f.accession, fl.form, fl.filed_date AS filed, CASE f.unit WHEN 'MBoe' THEN 1 ELSE 7 END AS unit_rank FROM fact f JOIN filing fl ON fl.accession = f.accession WHERE fl.form IN ('10-K', '20-F')"),
    "coverage_snapshot": with_(*STORE, """keys AS (SELECT unnest(['%s', '%s', '%s', 'standardized_measure', 'production_volume', 'oil_and_gas_revenue', 'capex', 'average_sales_price', 'production_cost_per_boe']) AS concept_key)""" % (D, U, T),
        then="SELECT c.cik, k.concept_key, count(f.id) > 0 AS tagged, count(f.id) AS observations, string_agg(DISTINCT f.unit, '|' ORDER BY f.unit) AS units, max(f.period_end) AS latest_period FROM company c CROSS JOIN keys k LEFT JOIN fact f ON f.cik = c.cik AND f.concept_key = k.concept_key GROUP BY c.cik, k.concept_key"),
    "alias_validation": with_(*STORE, VALUES, then="SELECT c.cik, CASE WHEN b.cik IS NULL THEN 'insufficient' WHEN latest_ok THEN 'validated' WHEN coherent_periods > 0 THEN 'drifted' ELSE 'incoherent' END AS status, unit, tested_periods, coherent_periods, round(median_error, 6) AS median_error, incoherent FROM company c LEFT JOIN best b ON b.cik = c.cik"),
    "unit_conversion": with_(*STORE, then=f"SELECT unit, count(*) AS n, round(max(value / 1 * {FACTOR}), 3) AS most, 'BOE' AS canonical_unit, max(CASE unit WHEN 'MMcfe' THEN 'six thousand cubic feet of gas count as one barrel of oil equivalent' END) AS note FROM fact GROUP BY unit"),
    "scale_candidates": with_(*STORE, READINGS, then="SELECT id, divisor, round(canonical, 3) AS canonical, 'BOE' AS canonical_unit FROM reading"),
    "scale_resolve": with_(*STORE, READINGS, then="SELECT t.id, CASE WHEN t.measure IS NULL THEN 'unavailable' WHEN c.id IS NULL THEN 'ambiguous' ELSE 'resolved' END AS status, c.divisor, round(c.ratio, 6) AS usd_per_boe, coalesce(c.n, 0) AS n_viable FROM total t LEFT JOIN chosen c ON c.id = t.id AND c.rn = 1"),
    "resolve_periods": with_(*STORE, f"""t AS (SELECT id, cik, period_end, product_key, unit, value, value * 12500 AS measure, {FACTOR} AS per FROM fact_current WHERE concept_key = '{T}'),
anchor AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY cik, period_end ORDER BY product_key <> '', id) = 1),
reading AS (SELECT a.*, v.divisor, a.measure / (a.value / v.divisor * a.per) AS ratio FROM anchor a JOIN (VALUES (CAST(1 AS DOUBLE), ''), (CAST(1000 AS DOUBLE), 'oil')) AS v(divisor, only_of) ON only_of = '' OR only_of = product_key),
solved AS (SELECT * FROM reading WHERE ratio BETWEEN 0.3 AND 120 AND value / divisor * per BETWEEN 0 AND 1e11
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ratio BETWEEN 1.5 AND 50 DESC, abs(ln(ratio) - ln(sqrt(75))), divisor) = 1),
read AS (SELECT t.*, t.value / s.divisor * t.per AS canonical FROM t JOIN solved s ON s.cik = t.cik AND s.period_end = t.period_end),
judged AS (SELECT *, bool_or(canonical > 1e11 OR (canonical > 0 AND measure / canonical < 0.3)) OVER (PARTITION BY cik, period_end, unit) AS bad, max(canonical) FILTER (product_key = '') OVER (PARTITION BY cik, period_end) AS whole FROM read)""",
        then="SELECT product_key, 'BOE' AS canonical_unit, count(*) AS n, round(max(canonical), 3) AS most FROM judged WHERE NOT bad AND abs(canonical) <= 1e11 AND (canonical <= 0 OR measure / canonical BETWEEN 0.3 AND 120 OR product_key <> '') AND (product_key = '' OR whole IS NULL OR canonical <= whole * 1.05) GROUP BY product_key"),
    "resolve_direct": with_(*STORE, then="SELECT id, value AS canonical_value, 'USD' AS canonical_unit FROM fact WHERE product_key = 'gas' AND id NOT IN (SELECT fact_id FROM scale)"),
    "production_reserve_life": with_(*STORE, f"""held AS (SELECT cik, period_end, product_key, value * {FACTOR} AS reserve FROM fact_current WHERE concept_key = '{T}'),
read AS (SELECT p.id, h.reserve, d.divisor, p.value / d.divisor * {FACTOR.replace("unit", "p.unit")} AS made FROM fact_current p JOIN held h USING (cik, period_end, product_key) CROSS JOIN (SELECT unnest([CAST(1 AS DOUBLE), CAST(10 AS DOUBLE)]) AS divisor) d WHERE p.concept_key = '{U}')""",
        then="SELECT id, divisor, round(reserve / made, 6) AS reserve_life FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY divisor) AS rn FROM read WHERE reserve / made BETWEEN 0.5 AND 200) WHERE rn = 1"),
    "top_n_filings_per_form": with_(*STORE, then="SELECT cik, form, accession, filed_date FROM (SELECT *, row_number() OVER (PARTITION BY cik, form ORDER BY filed_date DESC, CAST(accession AS BIGINT) DESC) AS rn FROM filing) WHERE rn <= 2"),
    "stratified_sample": with_(*STORE, then="SELECT concept_key, unit, id FROM (SELECT *, row_number() OVER (PARTITION BY concept_key, unit ORDER BY id) AS rn FROM fact) WHERE rn <= 5"),
    "asof_section": "SELECT e.event_id AS id, e.user_id, s.event_id AS signup_id FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON e.user_id = s.user_id AND e.ts >= s.ts",
    "gap_clusters": """WITH e AS (SELECT user_id, epoch_us(ts) AS us FROM events), f AS (SELECT *, coalesce(us - lag(us) OVER (PARTITION BY user_id ORDER BY us) > 43200000000, false) AS jump FROM e),
g AS (SELECT *, sum(CAST(jump AS INT)) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS cluster FROM f)
SELECT user_id, CAST(cluster AS BIGINT) AS cluster, count(*) AS n, min(us) AS first_at, max(us) AS last_at FROM g GROUP BY user_id, cluster""",
    "phrase_hits": with_(LINES, then=f"SELECT document_id, count(*) AS n, min(line_no) AS first_line FROM line_text WHERE {TEST} GROUP BY document_id"),
    "doc_lines": with_(LINES, then="SELECT document_id, count(*) AS lines, max(length(text)) AS longest FROM line_text GROUP BY document_id"),
    "sites_ranked": with_(LINES, f"""label AS (SELECT *, regexp_matches(text, '{PHRASE["and"]}') AS a, regexp_matches(text, '{PHRASE["in"]}') AS i, regexp_matches(text, '{PHRASE["of"]}') AS o FROM line_text WHERE ({TEST}) AND length(text) <= 110),
jump AS (SELECT *, coalesce(line_no - lag(line_no) OVER (PARTITION BY document_id ORDER BY line_no) > 2, false) AS j FROM label),
grouped AS (SELECT *, sum(CAST(j AS INT)) OVER (PARTITION BY document_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS k FROM jump),
site AS (SELECT document_id, min(line_no) AS first_line, max(line_no) AS last_line, count(*) AS label_hits, bool_or(a) AS a, bool_or(i) AS i, bool_or(o) AS o FROM grouped GROUP BY document_id, k)""",
        then="SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY CAST(a AS INT) + CAST(i AS INT) + CAST(o AS INT) DESC, label_hits DESC, last_line - first_line, first_line) AS rank, first_line, last_line, label_hits, concat_ws(',', CASE WHEN a THEN 'and' END, CASE WHEN i THEN 'in' END, CASE WHEN o THEN 'of' END) AS categories, a AND o AS closable FROM site WHERE a OR i OR o"),
    "flatten_pages": r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS flat FROM pages",
    "phrase_counts": "SELECT doc_id, " + " + ".join(f"(length(lower(text)) - length(replace(lower(text), '{p}', ''))) // {len(p)}" for p in ("the", "tion", "er")) + " AS n FROM documents",
    "snippets": "WITH d AS (SELECT doc_id, text, instr(text, 'the') - 1 AS spot FROM documents) SELECT doc_id, CASE WHEN spot - 20 > 0 THEN '…' ELSE '' END || substr(text, greatest(0, spot - 20) + 1, least(length(text), spot + 23) - greatest(0, spot - 20)) || CASE WHEN spot + 23 < length(text) THEN '…' ELSE '' END AS snippet, length(substr(text, 1, spot)) - length(replace(substr(text, 1, spot), chr(10), '')) + 1 AS line FROM d WHERE spot >= 0",
    "primary_ticker": "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey || '-WT' ELSE 'A' || s_suppkey END AS ticker FROM supplier",
    "cohort_for": f"""WITH s AS (SELECT *, {SIC} AS sic FROM supplier)
SELECT s_suppkey, sic, CASE WHEN sic IN ('1311', '6792') THEN '{COHORT}' WHEN sic = '2911' THEN 'Oil & Gas Integrated' END AS cohort,
  CASE sic WHEN '1381' THEN 'SIC 1381 Drilling Oil & Gas Wells: holds no reserves' WHEN '9999' THEN 'SIC 9999 unclassified' ELSE 'sic' END AS reason, sic <> '6792' AND s_suppkey % 7 <> 0 AS is_operator FROM s""",
    "producer_verdict": "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 OR s_suppkey % 9 >= 5 THEN 'producer' WHEN s_suppkey % 6 = 0 THEN 'unknown' ELSE 'non-producer' END AS verdict FROM supplier",
    "listing_status": with_(*STORE, """f AS (SELECT cik, filed_date, CASE CAST(accession AS BIGINT) % 4 WHEN 0 THEN '15-12G' WHEN 1 THEN '8-K' ELSE form END AS form FROM filing),
h AS (SELECT cik, max(filed_date) AS last_filing_date, max(filed_date) FILTER (form IN ('10-K', '20-F', '40-F')) AS p, max(filed_date) FILTER (form = '15-12G') AS g FROM f GROUP BY cik)""",
        then="SELECT cik, CASE WHEN CAST(cik AS BIGINT) % 11 = 0 THEN 'superseded' WHEN CAST(cik AS BIGINT) % 3 = 0 THEN 'listed' WHEN g IS NOT NULL AND (p IS NULL OR p <= g) THEN 'deregistered' ELSE 'private-filer' END AS listing_status, last_filing_date FROM h"),
    "admission": with_(*STORE, "r AS (SELECT cik, CASE WHEN CAST(cik AS BIGINT) % 13 = 0 THEN 'excluded by hand' WHEN ticker IS NULL THEN 'no listed security' WHEN cohort IS NULL THEN 'no cohort' WHEN CAST(cik AS BIGINT) % 5 = 0 THEN 'not a producer' WHEN CAST(cik AS BIGINT) % 7 = 0 THEN 'held: no verdict yet' END AS reason FROM company)",
        then="SELECT cik, CASE WHEN reason IS NULL THEN 'admitted' WHEN reason LIKE 'held%' THEN 'held' ELSE 'excluded' END AS decision, reason FROM r"),
    "ticker_sync": with_(*STORE, "r AS (SELECT ticker AS old, CASE WHEN CAST(cik AS BIGINT) % 5 <> 0 THEN CASE WHEN CAST(cik AS BIGINT) % 6 = 0 THEN 'N' ELSE 'T' END || CAST(cik AS BIGINT) END AS new FROM company)",
        then="SELECT CASE WHEN new IS NULL AND old IS NULL THEN 'unlisted' WHEN new IS NULL THEN 'missing' WHEN old IS NULL THEN 'backfill' WHEN old <> new THEN 'conflict' ELSE 'same' END AS outcome, count(*) AS n FROM r GROUP BY 1"),
    "dedupe_issuers": """WITH RECURSIVE key AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, 'A' || s_suppkey // 3 AS k FROM supplier UNION ALL SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0'), 'B' || s_suppkey // 10 FROM supplier WHERE s_suppkey % 5 <= 1),
edge AS (SELECT DISTINCT a.cik AS a, b.cik AS b FROM key a JOIN key b USING (k)), reach AS (SELECT a AS cik, b AS other FROM edge UNION SELECT r.cik, e.b FROM reach r JOIN edge e ON e.a = r.other)
SELECT cik, min(other) AS issuer, cik = min(other) AS is_primary FROM reach GROUP BY cik""",
    "exhibit_filter": """WITH r AS (SELECT l_orderkey, CAST(floor(l_extendedprice) AS BIGINT) AS size, row_number() OVER (PARTITION BY l_orderkey ORDER BY floor(l_extendedprice) DESC) AS rn FROM lineitem WHERE l_linenumber % 2 = 1 AND l_returnflag IN ('A', 'N') AND floor(l_extendedprice) >= 25000)
SELECT l_orderkey AS accession, count(*) AS n, max(size) AS largest FROM r WHERE rn <= 6 GROUP BY l_orderkey""",
}
_PERIODS = ORACLE_SQL["resolve_periods"].replace("SELECT t.*, t.value / s.divisor", "SELECT t.*, s.divisor AS shared, s.ratio AS of_anchor, t.value / s.divisor")
ORACLE_SQL["resolved_period_rows"] = _PERIODS.replace("SELECT product_key, 'BOE' AS canonical_unit, count(*) AS n, round(max(canonical), 3) AS most FROM judged", "SELECT id, shared AS divisor, round(canonical, 3) AS canonical_value, round(of_anchor, 6) AS usd_per_boe FROM judged").removesuffix(" GROUP BY product_key")
