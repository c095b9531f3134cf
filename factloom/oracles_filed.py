"""DuckDB SQL for the queries of `catalogue_filed`: what the reports and payloads hold, stated from the tables."""

from __future__ import annotations

from factloom.oracles import COHORT, COMPANY, CURRENT, FACT, FILING, LINES, PERIOD, PHRASE, STORE, TEST, VALUES, D, T, U, with_
from factloom.oracles import ORACLE_SQL as CORE
from factloom.registry import BY_KEY, CONCEPTS

SUPPLIED = """s AS (SELECT CAST(s_suppkey AS BIGINT) AS k, s_name AS name, CAST(floor(abs(s_acctbal)) AS BIGINT) + 1000 AS d,
  CAST(floor(abs(s_acctbal)) AS BIGINT) + 1000 + s_suppkey % 7 AS u, 'acc-' || s_suppkey AS accession, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik FROM supplier)"""


def comma(x: str) -> str:
    return "format('{:,}', CAST(" + x + " AS BIGINT))"


TOTAL_OF = "d + u + CASE WHEN k % 4 = 0 THEN 500 ELSE 20 END"
#: The reserve table by rows: label, oil, total.
RESERVE_ROWS = (("Proved developed", D, "d", "d + 10"), ("Proved undeveloped", U, "u", "u + 10"), ("Total proved", T, "d + u", TOTAL_OF))


def union(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


# Lines of a report in order: (page, heading or null, text).
_BUSINESS, _PROPERTIES, _RESULTS = "'Item 1. Business'", "'Item 2. Properties'", "'Item 7. Results'"


def _sales_lines(times: int) -> list[str]:
    d, u = f"d * {times}", f"u * {times}"
    rows = [
        "'2023'", "'2022'", "'Production volumes:'", "'Oil (MBbls)'", comma(d), comma(f"{d} + 1"), "'Natural gas (MMcf)'", comma(f"6 * {u}"), comma(f"6 * {u} + 6"),
        "'Total (MBoe)'", comma(f"(d + u) * {times}"), comma(f"(d + u) * {times} + CASE WHEN k % 5 = 0 THEN {100 * times} ELSE 2 END"), "'Average sales price (excluding hedges):'", "'Oil (per Bbl)'", "'$80.00'", "'$70.00'",
        "'Gas (per Mcf)'", "'3.00'", "'(2.50)'", "'Average production cost per BOE'", "'$9.50'", "'8.25'", "'Oil mix'", "'50%'", "'60%'",
    ]
    return rows


def _page_lines() -> str:
    line = lambda page, section, text: f"struct_pack(page := {page}, section := {section}, text := {text})"
    first = [line(1, "CAST(NULL AS VARCHAR)", f"'Item {n}. {t} .... {p}'") for n, t, p in (("1", "Business", 3), ("1A", "Risk Factors", 9), ("2", "Properties", 12), ("7", "Results", 20))]
    second = [line(2, _BUSINESS, x) for x in ("'Item 1. Business'", "name || ' drills wells & more - ' || k", "'7'")]
    third = [line(3, _PROPERTIES, x) for x in ("'Item 2. Properties'", "'As of December 31, 2023'", "'Oil (MBbls)'", "'Total (MBoe)'", *[c for label, _, oil, total in RESERVE_ROWS for c in (f"'{label}'", comma(oil), comma(total))])]
    fourth = [line(4, _RESULTS, x) for x in ("'Item 7. Results'", *_sales_lines(1))]
    again = "CASE WHEN k % 3 = 0 THEN [" + ", ".join(line(4, _RESULTS, x) for x in _sales_lines(10)) + "] ELSE [] END"
    # The contexts hold the end of their period and the name of a member, which are text of the source too.
    last = [line(4, _RESULTS, x) for x in (f"'2023-12-31 srt:OilReservesMember 2023-12-31 utr:MBoe Marked ' || {comma('d + 10')} || ' and ' || {comma('d')}", "'Page 9'")]
    lines = f"list_concat([{', '.join([*first, *second, *third, *fourth])}], {again}, [{', '.join(last)}])"
    return with_(SUPPLIED, f"l AS (SELECT accession, {lines} AS x FROM s)", "n AS (SELECT accession, unnest(x) AS y, generate_subscripts(x, 1) AS line_no FROM l)", then="SELECT accession, CAST(y.page AS INT) AS page, CAST(line_no AS INT) AS line_no, y.section AS section, y.text AS text FROM n")


def _raw() -> str:
    """A report's source, put together as the reports are."""
    row = lambda *cells: "'<tr>' || " + " || ".join(f"'<td>' || {c} || '</td>'" for c in cells) + " || '</tr>'"
    contents = "".join(f"<p>Item {n}. {t} .... {p}</p>" for n, t, p in (("1", "Business", 3), ("1A", "Risk Factors", 9), ("2", "Properties", 12), ("7", "Results", 20)))
    reserves = " || ".join([row("''", "'Oil (MBbls)'", "'Total (MBoe)'"), *[row(f"'{label}'", comma(oil), comma(total)) for label, _, oil, total in RESERVE_ROWS]])

    def sales(times: int) -> str:
        cells = _sales_lines(times)
        rows = [("''", *cells[:2]), (cells[2],), *[tuple(cells[i : i + 3]) for i in (3, 6, 9)], (cells[12],), *[tuple(cells[i : i + 3]) for i in (13, 16, 19, 22)]]
        return "'<table>' || " + " || ".join(row(*r) for r in rows) + " || '</table>'"

    figure = lambda context, value: f"'<ix:nonFraction name=\"srt:ProvedDevelopedReservesVolume\" contextRef=\"{context}\" unitRef=\"u\" scale=\"3\" id=\"f-{context}\">' || {value} || '</ix:nonFraction>'"
    marks = '<ix:header>silent</ix:header><context id="c1"><period><endDate>2023-12-31</endDate></period></context><context id="c2"><segment><explicitMember dimension="srt:ProductOrServiceAxis">srt:OilReservesMember</explicitMember></segment><period><instant>2023-12-31</instant></period></context><unit id="u"><measure>utr:MBoe</measure></unit>'
    return " || ".join([
        f"'<head><title>gone</title></head>{contents}<hr/><p>Item 1. Business</p><p>'", "name", "' drills&nbsp;wells &amp; more &#8722; '", "k", "'</p><p>7</p><hr><p>Item 2. Properties</p><p>As of December 31, 2023</p><table>'", reserves, "'</table><hr><p>Item 7. Results</p>'",
        sales(1), f"CASE WHEN k % 3 = 0 THEN {sales(10)} ELSE '' END", f"'{marks}<p>Marked '", figure("c1", comma("d + 10")), "' and '", figure("c2", comma("d")), "'</p><p>Page 9</p>'",
    ])


def _cells() -> str:
    parts = []
    for row, (label, _, oil, total) in enumerate(RESERVE_ROWS, 1):
        parts.append(f'SELECT accession, {row} AS "row", 0 AS "column", \'{label}\' AS text, \'\' AS header, \'{label}\' AS row_label FROM s')
        parts += [f"SELECT accession, {row}, {column}, {comma(value)}, '{head}', '{label}' FROM s" for column, value, head in ((1, oil, "Oil (MBbls)"), (2, total, "Total (MBoe)"))]
    return with_(SUPPLIED, then=union(*parts))


def _reserves() -> str:
    return union(*[f"SELECT accession, k, '{key}' AS concept_key, {product} AS product, CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, '2023-12-31' AS period_end, '{label}' AS row_label FROM s" for label, key, oil, total in RESERVE_ROWS for product, value, unit in (("'oil'", oil, "MBbls"), ("CAST(NULL AS VARCHAR)", total, "MBoe"))])


def _production() -> str:
    volume, price, cost = "'production_volume'", "'average_sales_price'", "'production_cost_per_boe'"
    row = lambda key, product, value, unit, year, hedged="CAST(NULL AS BOOLEAN)": f"SELECT accession, {key} AS concept_key, {product} AS product, CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, '{year}-12-31' AS period_end, {hedged} AS is_hedged FROM s"
    none = "CAST(NULL AS VARCHAR)"
    return union(
        row(volume, "'oil'", "d", "MBbls", 2023), row(volume, "'oil'", "d + 1", "MBbls", 2022), row(volume, "'gas'", "6 * u", "MMcf", 2023), row(volume, "'gas'", "6 * u + 6", "MMcf", 2022),
        row(volume, none, "d + u", "MBoe", 2023), row(volume, none, "d + u + CASE WHEN k % 5 = 0 THEN 100 ELSE 2 END", "MBoe", 2022),
        row(price, "'oil'", "80", "USD/bbl", 2023, "false"), row(price, "'oil'", "70", "USD/bbl", 2022, "false"), row(price, "'gas'", "3", "USD/Mcf", 2023, "false"), row(price, "'gas'", "-2.5", "USD/Mcf", 2022, "false"),
        row(cost, none, "9.5", "USD/Boe", 2023), row(cost, none, "8.25", "USD/Boe", 2022),
    )


def _tables() -> str:
    """Volumes in thousands of barrels and of cubic feet times their prices; whether they add up to the total row."""
    one = lambda index, times, where: union(
        f"SELECT accession, {index} AS table_index, '2023-12-31' AS period_end, round(CAST({times} * (d * 80000 + u * 18000) AS DOUBLE), 2) AS implied, true AS closes FROM s{where}",
        f"SELECT accession, {index}, '2022-12-31', round((d * {times} + 1) * 70000.0 - (u * {times} + 1) * 15000.0, 2), abs(2 + (d + u) * {times} - ((d + u) * {times} + CASE WHEN k % 5 = 0 THEN {100 * times} ELSE 2 END)) / ((d + u) * {times} + CASE WHEN k % 5 = 0 THEN {100 * times} ELSE 2 END) <= 0.015 FROM s{where}",
    )
    return with_(SUPPLIED, then=union(one(1, 1, ""), one(2, 10, " WHERE k % 3 = 0")))


SUBMITTED = """sub AS (SELECT cik, accession, CASE CAST(accession AS BIGINT) % 5 WHEN 0 THEN '8-K' WHEN 1 THEN '40-F' WHEN 2 THEN '10-K/A' ELSE '10-K' END AS form, filed_date,
  CASE WHEN CAST(accession AS BIGINT) % 7 <> 0 THEN 'p' || accession || '.htm' END AS primary_doc FROM filing)"""
STORED = """stored AS (SELECT accession, primary_doc AS name FROM sub WHERE CAST(accession AS BIGINT) % 3 = 0 AND primary_doc IS NOT NULL
  UNION ALL SELECT accession, 'ex1.htm' FROM sub WHERE CAST(accession AS BIGINT) % 10 = 0)"""
EXHIBITS = """ex AS (SELECT accession, 'ex' || i || '.htm' AS name FROM sub, (VALUES (1), (2)) AS v(i) WHERE form IN ('8-K', '40-F') AND CAST(accession AS BIGINT) % 1000 * i + 3900 >= 4000)"""


def wanted(forms: str) -> str:
    return f"""wanted AS (SELECT * EXCLUDE (rn) FROM (SELECT *, split_part(form, '/', 1) AS base, row_number() OVER (PARTITION BY cik, split_part(form, '/', 1) ORDER BY filed_date DESC, accession) AS rn
  FROM sub WHERE split_part(form, '/', 1) IN ({forms}) AND filed_date >= '1993-01-01' AND primary_doc IS NOT NULL) WHERE rn <= 2)"""


MEASURED = """tags AS (SELECT cik, CAST(cik AS BIGINT) % 4 AS us_gaap, CAST(cik AS BIGINT) % 3 AS ifrs FROM company WHERE CAST(cik AS BIGINT) % 6 <> 0),
forms AS (SELECT lpad(CAST(CAST(accession AS BIGINT) % 200 + 1 AS VARCHAR), 10, '0') AS cik, form, count(*) AS n, min(CAST(accession AS BIGINT)) AS seen FROM filing GROUP BY ALL),
annual AS (SELECT cik, arg_max(form, (n, -seen)) AS annual_form FROM forms GROUP BY cik),
measured AS (SELECT c.cik, ticker, country, CASE WHEN coalesce(us_gaap, 0) = 0 AND coalesce(ifrs, 0) = 0 THEN 'unknown' WHEN coalesce(us_gaap, 0) >= coalesce(ifrs, 0) THEN 'us-gaap' ELSE 'ifrs-full' END AS taxonomy,
  annual_form, CASE WHEN annual_form = '40-F' THEN 'ni-51-101' WHEN annual_form IS NOT NULL THEN 'subpart-1200' END AS regime
  FROM company c LEFT JOIN tags t ON t.cik = c.cik LEFT JOIN annual a ON a.cik = c.cik WHERE cohort IS NOT NULL)"""
RECENT = """r AS (SELECT cik, CAST(cik AS BIGINT) AS n, accession, filed_date, CASE WHEN CAST(accession AS BIGINT) % 4 = 0 THEN '8-K' ELSE form END AS form FROM filing)"""
PROFILES = """counted AS (SELECT cik, n, count(*) FILTER (form <> '8-K') AS annual_count, max(filed_date) FILTER (form <> '8-K') AS latest_annual, arg_max(form, (filed_date, accession)) FILTER (form <> '8-K') AS annual_form,
  count(*) FILTER (form = '8-K') AS eightk_count, max(filed_date) FILTER (form = '8-K') AS latest_8k FROM r GROUP BY cik, n),
p AS (SELECT cik, n % 10 <> 0 AS ok, n, annual_count, latest_annual, annual_form, eightk_count, latest_8k FROM counted)"""
COVERED = """cover AS (SELECT c.cik, f.concept_key, f.cells > 1 AS tagged, f.latest_period, f.cells FROM company c
  JOIN (SELECT cik, concept_key, max(period_end) AS latest_period, count(*) AS cells FROM fact_current GROUP BY cik, concept_key) f ON f.cik = c.cik WHERE c.cohort IS NOT NULL)"""
# Rank of MBoe and of MMcfe under each concept of the registry, stated by hand.
RANKS = {"proved_developed_reserves_boe": (1, 7), "proved_undeveloped_reserves_boe": (1, 7), "proved_reserves_boe": (1, 7), "standardized_measure": (1, 1), "production_volume": (1, 7), "oil_and_gas_revenue": (1, 1), "capex": (1, 1), "average_sales_price": (5, 5), "production_cost_per_boe": (0, 0)}
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"
MONEY = "CASE WHEN f.unit = 'MBoe' THEN CAST(1000 AS DOUBLE) ELSE CAST(1000000 AS DOUBLE) / 6000 END"

ORACLE_SQL: dict[str, str] = {
    "page_lines": _page_lines(),
    "table_cells": _cells(),
    "marked_figures": with_(SUPPLIED, then=union(
        f"SELECT accession, {comma('d + 10')} AS shown, CAST((d + 10) * 1000 AS DOUBLE) AS value, 'MBoe' AS unit, CAST(NULL AS VARCHAR) AS product, '2023-12-31' AS period_end, 'f-c1' AS element_id FROM s",
        f"SELECT accession, {comma('d')}, CAST(d * 1000 AS DOUBLE), 'MBoe', 'oil', '2023-12-31', 'f-c2' FROM s")),
    "reserve_readings": with_(SUPPLIED, then=f"SELECT * EXCLUDE (k) FROM ({_reserves()})"),
    "reserve_closure": with_(SUPPLIED, then=union(
        "SELECT accession, '2023-12-31' AS period_end, 'oil' AS product, true AS closes FROM s",
        f"SELECT accession, '2023-12-31', NULL, CAST(abs(d + u + 20 - ({TOTAL_OF})) AS DOUBLE) / ({TOTAL_OF}) <= 0.006 FROM s")),
    "matched_figures": with_(SUPPLIED, then=f"""SELECT k AS fact_id, 'r.htm' AS name, {comma('d + 10')} AS shown, CAST((d + 10) * 1000 AS DOUBLE) AS value, 'f-c1' AS element_id
  FROM s WHERE k % 5 <> 0 AND k % 4 <> 2"""),
    "one_reading": with_(SUPPLIED, then=f"SELECT accession, concept_key, product, period_end, unit, value FROM ({_reserves()}) WHERE k % 3 <> 0"),
    "production_readings": with_(SUPPLIED, then=_production()),
    "production_tables": _tables(),
    "chosen_tables": with_(SUPPLIED, then="""SELECT accession, CASE WHEN k % 3 <> 0 THEN 1 WHEN k % 4 = 2 THEN 1 END AS table_index,
  CASE WHEN k % 3 <> 0 THEN 'only one table' WHEN k % 4 = 2 THEN 'reconciles to revenue' WHEN k % 2 = 0 THEN 'no table reconciles to revenue' ELSE 'several tables disagree' END AS reason FROM s"""),
    "prefer_unhedged": with_(SUPPLIED, then=f"SELECT accession, product, period_end, value, is_hedged FROM ({_production()}) WHERE concept_key = 'average_sales_price'"),
    "verify_facts": with_(SUPPLIED, then=union(
        f"SELECT 'm' || k AS fact_id, 'found' AS status, 'markup' AS method, {comma('d + 10')} AS printed, 4 AS page, {_RESULTS} AS section, '#f-c1' AS anchor FROM s",
        # Fewer than three digits that say anything are not searched for.
        f"SELECT 't' || k, 'found', 'text', {comma('d + u')}, 3, {_PROPERTIES}, NULL FROM s WHERE length(rtrim(CAST(d + u AS VARCHAR), '0')) > 2",
        "SELECT 't' || k, 'unverifiable', NULL, NULL, NULL, NULL, NULL FROM s WHERE length(rtrim(CAST(d + u AS VARCHAR), '0')) < 3",
        "SELECT 'n' || k, 'not_found', NULL, NULL, NULL, NULL, NULL FROM s", "SELECT 's' || k, 'unverifiable', NULL, NULL, NULL, NULL, NULL FROM s")),
    "product_volumes": with_(SUPPLIED, then=f"SELECT cik, '{D}' AS concept_key, 'srt' AS taxonomy, 'ProvedDevelopedReservesVolume' AS tag, CAST(d * 1000 AS DOUBLE) AS value, 'MBoe' AS unit, 'oil' AS product, 1 AS unit_rank, 2023 AS fiscal_year, accession, '10-K/A' AS form, 'xbrl:inline' AS extracted_by FROM s WHERE k % 5 <> 0"),
    "index_items": with_(SUPPLIED, then=union(
        "SELECT accession, 'Annual report' AS description, 'main.htm' AS document, '10-K' AS type, d * 10 AS size FROM s", "SELECT accession, 'Other', 'other.htm', 'GRAPHIC', u * 10 FROM s",
        "SELECT accession, 'Index', 'x-index.htm', '10-K', 99999999 FROM s", "SELECT accession, 'Release', 'ex991.htm', 'EX-99.1', CASE WHEN k % 2 = 0 THEN 5000 ELSE 300 END FROM s", "SELECT accession, 'Picture', 'a.jpg', 'EX-99.2', 90000 FROM s")),
    "primary_documents": with_(SUPPLIED, then="SELECT accession, CASE WHEN k % 3 = 0 THEN 'given.htm' WHEN u > d THEN 'other.htm' ELSE CASE WHEN 'other.htm' > 'main.htm' AND u = d THEN 'other.htm' ELSE 'main.htm' END END AS primary_doc FROM s"),
    "sheets": with_(SUPPLIED, then=f"""SELECT accession, 'Item 1. Business ' || name || ' drills&nbsp;wells &amp; more &#8722; ' || k || ' 7' AS second, true AS "none",
  'Item 2. Properties As of December 31, 2023 Oil (MBbls) Total (MBoe) ' || {" || ' ' || ".join(f"'{label} ' || {comma(oil)} || ' ' || {comma(total)}" for label, _, oil, total in RESERVE_ROWS)} AS third FROM s"""),
    "document_index": f"""WITH l AS (SELECT doc_id AS document_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents WHERE doc_id % 5 = 2 AND doc_id % 2 = 0)
SELECT document_id, CAST(line_no AS INT) AS line_no, 'a-' || document_id % 50 AS accession FROM l WHERE regexp_matches(text, '{PHRASE["of"]}') OR regexp_matches(text, '{PHRASE["and"]}')""",
    "phrase_search": """WITH l AS (SELECT doc_id AS document_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
w AS (SELECT document_id, line_no, list_filter(string_split_regex(lower(regexp_replace(text, '[^0-9A-Za-z_]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM l),
n AS (SELECT document_id, line_no, len(list_filter(range(1, len(w)), lambda i: w[i] = 'in' AND w[i + 1] = 'the')) AS a, len(list_filter(w, lambda x: x = 'er')) AS b,
  len(list_filter(range(1, len(w) - 3), lambda i: w[i:i + 4] = ['a', 'b', 'c', 'd', 'e'])) AS c FROM w),
p AS (SELECT document_id, line_no, CAST(unnest([0, 1, 2]) AS INT) AS phrase, unnest([a, b, c]) AS n FROM n)
SELECT document_id, phrase, CAST(sum(n) AS BIGINT) AS n, CAST(min(line_no) AS INT) AS first_line FROM p WHERE n > 0 GROUP BY document_id, phrase""",
    "reindexed_documents": r"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 80 = 3 THEN 'In the end' || chr(10) || text || chr(10) || 'all of the rest' ELSE text END AS text FROM documents WHERE doc_id % 40 <> 3 OR doc_id % 80 = 3),
l AS (SELECT doc_id AS document_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM d)
SELECT document_id, CAST(line_no AS INT) AS line_no, CASE WHEN document_id % 2 = 0 THEN '10-K' ELSE '20-F' END AS form FROM l WHERE regexp_matches(text, '(?i)(^|[^0-9A-Za-z_])(of|in)[^0-9A-Za-z_]+the([^0-9A-Za-z_]|$)')""",
    "corpus_files": with_(SUPPLIED, then=f"SELECT accession, 'r.htm' AS name, length(raw) AS chars, md5(raw) AS md5 FROM (SELECT accession, {_raw()} AS raw FROM s)"),
    "company_numbers": with_(SUPPLIED, then="SELECT DISTINCT CASE k % 4 WHEN 3 THEN '0000000007' ELSE cik END AS cik FROM s WHERE k % 4 <> 0"),
    "cross_check": with_(SUPPLIED, then="""SELECT cik, CASE WHEN k % 3 <> 0 THEN 'oil' END AS product, CASE WHEN k % 11 = 0 THEN 'unchecked' WHEN k % 4 IN (0, 2) THEN 'agree' WHEN k % 4 = 1 THEN 'rescaled' ELSE 'disagree' END AS outcome,
  CASE WHEN k % 11 <> 0 THEN round(CASE k % 4 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 WHEN 2 THEN 1003 ELSE 1500 END / CAST(1000 AS DOUBLE), 6) END AS ratio FROM s"""),
    "first_revenue": with_(FACT, then=f"SELECT cik, period_end, arg_min(value, id) AS revenue FROM fact WHERE concept_key = '{T}' AND product_key <> 'ngl' GROUP BY cik, period_end"),
    "wanted_filings": with_(FILING, SUBMITTED, wanted("'10-K', '8-K'"), then="SELECT cik, accession, form, filed_date FROM wanted"),
    "acquisition_plan": with_(FILING, SUBMITTED, STORED, EXHIBITS, wanted("'10-K', '8-K', '40-F'"), """both_ AS (SELECT cik, accession, primary_doc AS name, 'primary' AS why FROM wanted
  UNION ALL SELECT w.cik, w.accession, e.name, 'exhibit' FROM wanted w JOIN ex e ON e.accession = w.accession WHERE base IN ('40-F', '8-K'))""", then="SELECT b.* FROM both_ b ANTI JOIN stored t ON t.accession = b.accession AND t.name = b.name"),
    "documents_of_filings": with_(FILING, SUBMITTED, STORED, EXHIBITS, """held AS (SELECT DISTINCT accession, name FROM stored),
thin AS (SELECT accession FROM sub LEFT JOIN (SELECT accession, count(*) AS n FROM held GROUP BY accession) USING (accession) WHERE split_part(form, '/', 1) IN ('40-F', '6-K', '8-K') AND coalesce(n, 0) <= 1),
every AS (SELECT * FROM held UNION SELECT e.accession, e.name FROM ex e SEMI JOIN thin t ON t.accession = e.accession UNION SELECT accession, primary_doc FROM sub WHERE primary_doc IS NOT NULL)""", then="""SELECT accession, name,
  CAST(row_number() OVER (PARTITION BY accession ORDER BY CASE WHEN name = primary_doc THEN 0 ELSE 1 END, name) - max(CASE WHEN name = primary_doc THEN 1 ELSE 0 END) OVER (PARTITION BY accession) AS INT) AS doc_rank,
  (accession, name) IN (SELECT (accession, name) FROM held) AS is_stored FROM every JOIN sub USING (accession)"""),
    "payload_misses": with_(COMPANY, then="SELECT cik FROM company WHERE CAST(cik AS BIGINT) % 3 <> 0"),
    "measured_regimes": with_(COMPANY, FILING, MEASURED, then="SELECT * FROM measured"),
    "regime_report": with_(COMPANY, FILING, MEASURED, then="SELECT taxonomy, regime, count(*) AS filers, count(*) FILTER (taxonomy <> 'us-gaap') AS unreachable, count(*) FILTER (regime IS DISTINCT FROM 'subpart-1200') AS not_comparable FROM measured GROUP BY taxonomy, regime"),
    "apply_measured": with_(COMPANY, FILING, MEASURED, then="SELECT c.cik, m.taxonomy AS reporting_taxonomy, m.regime AS disclosure_regime FROM company c LEFT JOIN measured m ON m.cik = c.cik"),
    "apply_tickers": with_(COMPANY, then="SELECT cik, coalesce(ticker, CASE WHEN CAST(cik AS BIGINT) % 5 <> 0 THEN 'N' || CAST(cik AS BIGINT) END) AS ticker FROM company"),
    "apply_listing": with_(COMPANY, then="SELECT cik, CASE WHEN CAST(cik AS BIGINT) % 2 = 0 THEN 'deregistered' ELSE listing_status END AS listing_status, CASE WHEN CAST(cik AS BIGINT) % 2 = 0 THEN '1999-01-01' END AS last_filing_date FROM company"),
    "load_cohort": with_(COMPANY, then="""SELECT cik, CASE WHEN CAST(cik AS BIGINT) % 4 = 0 THEN name || ' Royalty Trust' ELSE name END AS name, CASE WHEN CAST(cik AS BIGINT) % 2 = 0 THEN 'A' || CAST(cik AS BIGINT) ELSE ticker END AS ticker,
  CASE WHEN CAST(cik AS BIGINT) % 4 = 0 THEN false WHEN CAST(cik AS BIGINT) % 2 = 0 THEN true ELSE is_operator END AS is_operator FROM company"""),
    "submission_profiles": with_(FILING, RECENT, PROFILES, then="""SELECT cik, CASE WHEN ok THEN 'Customer ' || n END AS name, CASE WHEN ok THEN 'C' || n ELSE '' END AS tickers, CASE WHEN ok THEN 'Old ' || n ELSE '' END AS former_names,
  CASE WHEN ok THEN n % 4 IN (1, 2) END AS is_foreign, CASE WHEN ok THEN CASE n % 4 WHEN 0 THEN 'USA' WHEN 1 THEN 'Canada' WHEN 2 THEN 'Norway' END END AS country,
  CASE WHEN ok THEN annual_count ELSE 0 END AS annual_count, CASE WHEN ok THEN latest_annual END AS latest_annual, CASE WHEN ok THEN annual_form END AS annual_form, CASE WHEN ok THEN eightk_count ELSE 0 END AS eightk_count, CASE WHEN ok THEN latest_8k END AS latest_8k,
  CASE WHEN NOT ok THEN 'no submissions' END AS error FROM p"""),
    "discovery_report": with_(FILING, RECENT, PROFILES, then="SELECT count(*) AS filers, count(*) FILTER (ok) AS with_ticker, count(*) FILTER (ok AND n % 4 IN (1, 2)) AS is_foreign, count(*) FILTER (ok AND annual_count > 0) AS reporting, count(*) FILTER (NOT ok) AS failed FROM p"),
    "submission_filings": with_(FILING, RECENT, then="SELECT form, count(*) AS n, min(filed_date) AS \"first\", max(filed_date) AS \"last\" FROM r WHERE n % 10 <> 0 GROUP BY form"),
    "ticker_map": with_(SUPPLIED, then="SELECT cik, 'B' || k AS ticker, CAST(2 AS BIGINT) AS n FROM s"),
    "revalidated": with_(SUPPLIED, then="SELECT CASE WHEN k % 7 = 0 THEN 'insufficient' WHEN k % 5 = 0 AND 9000 / CAST(d + u + 9000 AS DOUBLE) > 0.03 THEN 'drifted' ELSE 'validated' END AS status, count(*) AS n FROM s WHERE k % 9 <> 0 GROUP BY ALL"),
    "payload_errors": with_(SUPPLIED, then="SELECT CASE k % 5 WHEN 0 THEN 'malformed JSON' WHEN 1 THEN 'not an object' WHEN 3 THEN 'note of an observation' ELSE 'no text' END AS error, count(*) AS n FROM s GROUP BY 1"),
    "archive_urls": with_(SUPPLIED, then=f"""SELECT k, 'https://data.sec.gov/api/xbrl/companyfacts/CIK' || cik || '.json' AS facts, 'https://data.sec.gov/api/xbrl/companyconcept/CIK' || cik || '/srt/T.json' AS concept,
  'https://data.sec.gov/submissions/CIK' || cik || '.json' AS submissions, '{ARCHIVE}/' || k || '/000024' || k AS dir, CASE WHEN k % 2 = 0 THEN 'a_htm.xml' END AS instance, '/c/0000-24-' || k || '/a.htm' AS path, 2023 AS year,
  CASE WHEN k % 3 <> 0 THEN CASE WHEN k % 2 = 0 THEN 'srt:T' ELSE 'T' END END AS tag FROM s"""),
    "scalar_checks": with_(SUPPLIED, then="""SELECT k, length(rtrim(CAST(k AS VARCHAR), '')) >= 3 OR false AS searchable, CASE k % 3 WHEN 0 THEN CAST(5 AS DOUBLE) WHEN 1 THEN CAST(500 AS DOUBLE) END AS half,
  trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) || ' oil' AS name, k % 2 = 0 AS wrapper, k % 2 = 0 AS model_made, k % 6 <= 3 AS "unambiguous", k % 2 = 0 AND k % 80 <= 40 AS confident,
  CASE WHEN k % 4 <> 0 THEN k % 3 = 0 END AS header FROM s"""),
    "domiciles": with_(SUPPLIED, then="""SELECT k, CASE k % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN false ELSE k % 2 = 1 END AS is_foreign,
  CASE k % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'Canada' WHEN 2 THEN NULL ELSE CASE WHEN k % 2 = 1 THEN 'Norway' END END AS country FROM s"""),
    "registry_ranks": with_(FACT, "named AS (SELECT concept_key, CASE WHEN product_key = 'ngl' THEN 'gallons' ELSE unit END AS unit FROM fact)",
        then="SELECT concept_key, unit, CASE unit WHEN 'MBoe' THEN 1 WHEN 'MMcfe' THEN 7 ELSE " + str(len(BY_KEY[T].units)) + " END AS unit_rank, count(*) AS n FROM named GROUP BY concept_key, unit"),
    "predecessor_names": with_(SUPPLIED, then="SELECT k, CASE WHEN k % 5 = 3 THEN 'Old Petro ' || k || ', Inc' WHEN k % 5 < 3 THEN 'Old Petro ' || k END AS predecessor FROM s"),
    "successions": with_(SUPPLIED, """named AS (SELECT k, cik, CASE WHEN k % 2 = 0 THEN CASE WHEN k % 8 = 0 THEN k WHEN k % 8 = 2 THEN -1 ELSE k + 1 END END AS who FROM s)""", then="""SELECT n.cik, CASE WHEN who IS NULL THEN 'none' WHEN f.k IS NOT NULL AND f.k <> n.k THEN 'resolved' ELSE 'unconfirmed' END AS status,
  CASE WHEN f.k IS NOT NULL AND f.k <> n.k THEN f.cik ELSE n.cik END AS history_cik,
  CASE WHEN who IS NULL THEN 'no 8-K12B filed' WHEN f.k IS NULL THEN 'no single annual filer of that name' WHEN f.k = n.k THEN 'resolved to itself' END AS note
FROM named n LEFT JOIN s f ON f.k = n.who AND f.k > 2"""),
    "needing_history": with_(COMPANY, FACT, then="SELECT c.cik, c.name FROM company c ANTI JOIN (SELECT cik FROM fact WHERE CAST(cik AS BIGINT) % 3 <> 0) f ON f.cik = c.cik"),
    "renamed_issuers": with_(SUPPLIED, """g AS (SELECT k, cik, CASE WHEN k % 3 = 2 THEN k - 1 ELSE k END AS root, CASE WHEN k % 2 = 0 THEN '2020-01-01' END AS latest, k % 5 AS n FROM s)""", then="SELECT cik, lpad(CAST(root AS VARCHAR), 10, '0') AS issuer, row_number() OVER (PARTITION BY root ORDER BY latest DESC NULLS LAST, n DESC, cik) = 1 AS is_primary FROM g"),
    "snapshots": with_(COMPANY, FILING, FACT, CURRENT, """cover AS (SELECT c.cik, f.concept_key, f.cells FROM company c LEFT JOIN (SELECT cik, concept_key, count(*) AS cells FROM fact_current GROUP BY ALL) f ON f.cik = c.cik WHERE cohort IS NOT NULL)""", then="SELECT '2024-01-01' AS taken_at, count(*) AS n, CAST(sum(cells) AS BIGINT) AS cells FROM cover UNION ALL SELECT '2024-02-01', count(*), CAST(sum(cells) AS BIGINT) FROM cover WHERE cells > 2 HAVING count(*) > 0"),
    "replaced_verdicts": with_(FACT, then=f"SELECT status, count(*) AS n, count(document) AS documents FROM (SELECT v.status, v.document FROM verification v JOIN fact f ON f.id = v.fact_id WHERE f.concept_key <> '{D}' UNION ALL SELECT 'again', NULL FROM fact WHERE concept_key = '{D}') GROUP BY status"),
    "cleared_scale": with_(FACT, then="SELECT count(*) AS n, round(max(canonical_value), 2) AS most FROM scale s SEMI JOIN (SELECT id FROM fact WHERE unit <> 'MMcfe') f ON f.id = s.fact_id"),
    "resectioned": with_(FACT, then="""SELECT CASE WHEN f.unit = 'MBoe' THEN CASE WHEN f.product_key <> 'oil' THEN 'Item 7. Results' END WHEN v.status = 'found' THEN 'Item 2. Properties' END AS section, count(*) AS n FROM verification v JOIN fact f ON f.id = v.fact_id GROUP BY ALL"""),
    "backfilled_filings": with_(FILING, "f AS (SELECT accession, CAST(accession AS BIGINT) AS n FROM filing)", then="""SELECT accession, CASE WHEN n % 2 = 0 THEN '1995-12-31' WHEN n % 5 <> 0 AND n % 7 <> 0 THEN '1996-12-31' END AS period_end, CASE WHEN n % 3 = 0 THEN 'kept.htm' WHEN n % 5 <> 0 THEN 'd' || n || '.htm' END AS primary_doc FROM f"""),
    "copied_columns": with_(COMPANY, then="SELECT cik, name, CAST(NULL AS VARCHAR) AS disclosure_regime, is_operator FROM company"),
    "store_faults": with_(COMPANY, FILING, FACT, then=union(
        "SELECT 'company: repeated keys' AS rule, CAST(0 AS BIGINT) AS n", "SELECT 'filing: repeated keys', 0", "SELECT 'fact: repeated keys', (SELECT count(*) FROM (SELECT id FROM fact GROUP BY id HAVING count(*) > 1))", "SELECT 'company: repeated tickers', 0",
        "SELECT 'fact: rows without their accession', count(*) FROM fact WHERE CAST(accession AS BIGINT) % 11 = 0 OR accession NOT IN (SELECT accession FROM filing)", "SELECT 'fact: rows without their cik', count(*) FROM fact WHERE CAST(cik AS BIGINT) % 10 = 0 OR cik NOT IN (SELECT cik FROM company)")),
    "coherent_rows": with_(*STORE, VALUES, then="SELECT f.concept_key, f.unit, count(*) AS n FROM fact f WHERE NOT EXISTS (SELECT 1 FROM best b JOIN triple t ON t.cik = b.cik AND t.unit = b.unit WHERE b.cik = f.cik AND t.period_end = f.period_end AND t.error > 0.03) GROUP BY f.concept_key, f.unit"),
    "alias_records": with_(*STORE, VALUES, then=f"""SELECT c.cik, 'reserves' AS family, k.concept_key, k.tag, CASE WHEN b.cik IS NULL OR CAST(c.cik AS BIGINT) % 5 = 0 THEN 'insufficient' WHEN latest_ok THEN 'validated' WHEN coherent_periods > 0 THEN 'drifted' ELSE 'incoherent' END AS status,
  CASE WHEN k.concept_key <> '*' THEN NULL WHEN h.missing <> '' THEN 'not all three concepts tagged, missing: ' || h.missing ELSE 'no combination shares a unit across all three concepts' END AS note
FROM company c LEFT JOIN best b ON b.cik = c.cik
JOIN (SELECT c.cik, concat_ws(', ', CASE WHEN NOT coalesce(bool_or(f.concept_key = '{D}'), false) THEN '{D}' END, CASE WHEN NOT coalesce(bool_or(f.concept_key = '{T}' AND CAST(c.cik AS BIGINT) % 5 <> 0), false) THEN '{T}' END, CASE WHEN NOT coalesce(bool_or(f.concept_key = '{U}'), false) THEN '{U}' END) AS missing
  FROM company c LEFT JOIN fact f ON f.cik = c.cik AND f.accession IN (SELECT accession FROM filing) GROUP BY c.cik) h ON h.cik = c.cik
JOIN (VALUES ('{D}', 'ProvedDevelopedReservesVolume'), ('{U}', 'ProvedUndevelopedReserveVolume'), ('{T}', 'ProvedDevelopedAndUndevelopedReservesNet'), ('*', NULL)) AS k(concept_key, tag) ON (k.concept_key = '*') = (b.cik IS NULL OR CAST(c.cik AS BIGINT) % 5 = 0)"""),
    "empty_payloads": with_(COMPANY, FACT, then="SELECT c.cik, 'empty payload' AS error FROM company c ANTI JOIN (SELECT cik FROM fact WHERE CAST(cik AS BIGINT) % 4 <> 0) f ON f.cik = c.cik"),
    "resolved_tables": with_(FACT, then=f"""SELECT 'BOE' AS canonical_unit, CASE WHEN f.unit = 'MMcfe' THEN 'six thousand cubic feet of gas count as one barrel of oil equivalent' END AS conversion_note, 'as printed in the table' AS basis, count(*) AS n,
  round(max(value * CASE WHEN product_key = 'gas' THEN 1000000.0 ELSE 1.0 END * {MONEY}), 2) AS most FROM fact f WHERE value * CASE WHEN product_key = 'gas' THEN 1000000.0 ELSE 1.0 END * {MONEY} <= 1e11 GROUP BY ALL"""),
    "interval_of": """WITH e AS (SELECT user_id, event_id, event_type, CAST(floor(epoch(CAST(ts AS TIMESTAMP))) AS BIGINT) AS spot FROM events),
i AS (SELECT user_id, spot AS s, spot + CASE WHEN event_type = 'signup' THEN 72 ELSE 1 END * 3600 AS t, event_id AS span_id FROM e WHERE event_type IN ('signup', 'purchase')),
j AS (SELECT e.event_id, i.span_id, row_number() OVER (PARTITION BY e.event_id ORDER BY CASE WHEN spot BETWEEN s AND t THEN 0 ELSE 1 END, CASE WHEN spot BETWEEN s AND t THEN -s ELSE least(abs(spot - s), abs(spot - t)) END, CASE WHEN spot BETWEEN s AND t THEN -t ELSE s END) AS rn
  FROM e LEFT JOIN i ON i.user_id = e.user_id)
SELECT event_id, span_id FROM j WHERE rn = 1""",
    "outcome_counts": with_(FACT, then="SELECT status, count(*) AS n FROM verification GROUP BY status"),
    "coverage_totals": with_(COMPANY, FILING, FACT, CURRENT, COVERED, then="SELECT concept_key, count(*) FILTER (tagged) AS ever, count(*) FILTER (latest_period >= '1997-12-31') AS \"current\" FROM cover GROUP BY concept_key"),
    "company_coverage": with_(COMPANY, FILING, FACT, CURRENT, COVERED, then="SELECT cik, count(*) AS concepts, count(*) FILTER (tagged) AS tagged, count(*) FILTER (tagged AND latest_period >= '1998-12-31') AS \"current\", count(*) FILTER (tagged) - count(*) FILTER (tagged AND latest_period >= '1998-12-31') AS stale FROM cover GROUP BY cik"),
    "admission_report": f"SELECT decision, reason, count(*) AS n, min(cik) AS example FROM ({CORE['admission']}) GROUP BY decision, reason",
    "producer_evidence": with_(FACT, f"""tagged AS (SELECT cik, string_agg(DISTINCT concept_key, ',' ORDER BY concept_key) AS concepts FROM fact WHERE CAST(cik AS BIGINT) <= 9 AND concept_key IN ('{T}', '{D}') GROUP BY cik),
read_ AS (SELECT lpad(CAST(doc_id % 7 + 1 AS VARCHAR), 10, '0') AS cik, CAST(doc_id AS VARCHAR) AS name, (length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3 + (length(lower(text)) - length(replace(lower(text), 'and', ''))) // 3 AS h FROM documents),
read_by AS (SELECT cik, CAST(sum(h) AS BIGINT) AS hits, count(*) AS documents, arg_max(name, (h, name)) AS best FROM read_ GROUP BY cik)""", then="SELECT coalesce(t.cik, r.cik) AS cik, concepts, hits, documents, best FROM tagged t FULL JOIN read_by r ON r.cik = t.cik"),
    "alias_verdicts": with_(COMPANY, then="SELECT cik, name, CASE CAST(cik AS BIGINT) % 3 WHEN 0 THEN 'drifted' ELSE 'incoherent' END AS status, CAST(cik AS BIGINT) % 4 AS coherent_periods, 'a=T1 | b=T2' AS chosen FROM company WHERE CAST(cik AS BIGINT) % 3 <> 2"),
    "second_look": with_(FACT, """v AS (SELECT fact_id, length(document) % 2 <> 0 AS bare, coalesce(canonical_value > 1e7, false) AS changed FROM verification LEFT JOIN scale USING (fact_id) WHERE status = 'found' AND length(document) % 9 > 0),
g AS (SELECT 'no_header' AS sample_group, fact_id FROM v WHERE bare UNION ALL SELECT 'unit_corrected', fact_id FROM v WHERE changed UNION ALL SELECT 'control', fact_id FROM v WHERE NOT bare AND NOT changed)""", then="SELECT sample_group, fact_id FROM g QUALIFY row_number() OVER (PARTITION BY sample_group ORDER BY fact_id) <= 5"),
    "look_summary": with_(SUPPLIED, then="""SELECT 'g' || k % 3 AS sample_group, count(*) AS n, count(*) FILTER (k % 2 = 0) AS present, CASE WHEN count(*) FILTER (k % 5 <> 0) > 0 THEN count(*) FILTER (k % 5 <> 0 AND k % 3 = 0) END AS header_ok, count(*) FILTER (k % 5 <> 0) AS header_n,
  CASE WHEN count(*) FILTER (k % 4 <> 0) > 0 THEN count(*) FILTER (k % 4 <> 0 AND k % 3 <> 0) END AS folio_ok, count(*) FILTER (k % 4 <> 0) AS folio_n FROM s WHERE k % 7 <> 0 GROUP BY ALL"""),
    "history_nested": with_(FILING, FACT, CURRENT, then=f"SELECT product_key, unit, 'All proved reserves' AS label, count(*) AS points, string_agg(period_end || ':' || accession, ',' ORDER BY period_end, id) AS path FROM fact_current WHERE cik = '0000000001' AND concept_key = '{T}' GROUP BY product_key, unit"),
    "coverage_nested": with_(COMPANY, FILING, FACT, CURRENT, then="""SELECT c.cik, count(f.concept_key) AS n, coalesce(string_agg(f.concept_key || '=' || f.latest_period, ',' ORDER BY f.concept_key), '') AS concepts FROM company c
  LEFT JOIN (SELECT cik, concept_key, max(period_end) AS latest_period FROM fact_current GROUP BY ALL) f ON f.cik = c.cik WHERE cohort IS NOT NULL GROUP BY c.cik"""),
    "event_windows": "SELECT CAST(floor(epoch(CAST(ts AS TIMESTAMP)) / 86400) AS BIGINT) * 86400 AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "service_panel": "SELECT id, cik, unit, value, row_number() OVER (PARTITION BY unit ORDER BY company_max DESC, cik, value DESC, product_key) AS position FROM (" + with_(COMPANY, FILING, FACT, CURRENT, then=f"SELECT f.*, max(value) OVER (PARTITION BY unit, f.cik) AS company_max FROM fact_current f JOIN company c ON c.cik = f.cik WHERE cohort IS NOT NULL AND concept_key = '{T}' AND period_end = '{PERIOD}' AND product_key = 'oil'") + ")",
    "service_questions": with_(COMPANY, FILING, FACT, CURRENT, then=union(
        "SELECT 'concepts' AS question, count(DISTINCT concept_key) AS n FROM fact_current", f"SELECT 'periods', count(DISTINCT period_end) FROM fact_current WHERE concept_key = '{T}'", "SELECT 'companies', count(*) FROM company WHERE cohort IS NOT NULL",
        f"SELECT 'history', count(*) FROM fact_current WHERE cik = '0000000001' AND concept_key = '{T}'", f"SELECT 'coverage', count(*) FROM (SELECT DISTINCT c.cik, f.concept_key FROM company c LEFT JOIN fact_current f ON f.cik = c.cik WHERE cohort = '{COHORT}')",
        "SELECT 'unreached', count(DISTINCT c.cik) FROM company c JOIN fact f ON f.cik = c.cik WHERE listing_status = 'private-filer'")),
    "stem_forms": r"""WITH f AS (SELECT * FROM (VALUES ('price', 'price'), ('price', 'priced'), ('price', 'prices'), ('reserve', 'reserve'), ('reserve', 'reserves'), ('reserve', 'reserved'), ('plan', 'plan'), ('plan', 'plans'), ('plan', 'planned'), ('plan', 'planning'), ('the', 'the')) AS v(word, form))
SELECT word, form, count(d.doc_id) AS n FROM f LEFT JOIN documents d ON regexp_matches(d.text, '(?i)(^|[^0-9A-Za-z_])' || form || '([^0-9A-Za-z_]|$)') GROUP BY word, form""",
}
ORACLE_SQL |= {
    "filers_of_codes": with_(SUPPLIED, then="SELECT CASE k % 2 WHEN 0 THEN '1311' ELSE '6792' END AS sic, cik, CASE WHEN k % 4 <> 0 THEN '10-K' ELSE '20-F' END AS form, CAST(k // 30 * 100 AS INT) AS start FROM s"),
    "candidates": with_(SUPPLIED, then="SELECT cik, CASE k % 3 WHEN 0 THEN '1311' WHEN 1 THEN '6792' ELSE '9999' END AS sic FROM s WHERE (k % 3 < 2 AND k % 4 <> 1) OR k % 11 = 0"),
    "basis_notes": with_(SUPPLIED, then=union(
        f"SELECT cik, '{D}' AS concept_key, 'kept ' || k AS note FROM s", f"SELECT cik, '{T}', CASE k % 3 WHEN 0 THEN 'new ' ELSE 'old ' END || k FROM s", f"SELECT cik, '{T}', 'second' FROM s WHERE k % 6 = 0")),
    "overridden_tags": with_(SUPPLIED, then="SELECT cik, 'capex' AS concept_key, CASE WHEN k % 2 = 0 AND k % 3 <> 0 THEN 'PaymentsToAcquireOilAndGasProperty' ELSE 'PaymentsToAcquirePropertyPlantAndEquipment' END AS tag, CAST(d AS DOUBLE) AS value FROM s"),
    "products_of_units": with_(SUPPLIED, then="""SELECT cik, CASE k % 4 WHEN 0 THEN 'USD/Mcf' WHEN 1 THEN 'USD/bbl' WHEN 2 THEN 'USD/MMBtu' ELSE 'USD' END AS unit, CASE k % 4 WHEN 0 THEN 'gas' WHEN 1 THEN 'oil' WHEN 2 THEN 'gas' END AS product,
  CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 4 ELSE 5 END AS unit_rank FROM s"""),
    "facts_in_order": with_(FILING, FACT, then="""SELECT f.cik, concept_key, f.period_end, product_key, unit_rank, filed_date AS filed, f.accession,
  CAST(row_number() OVER (PARTITION BY f.cik, concept_key ORDER BY f.period_end, product_key, unit_rank, filed_date, f.accession) AS INT) AS seq FROM fact f JOIN filing l ON l.accession = f.accession"""),
    "nearby_units": with_(SUPPLIED, then="SELECT 't' || k AS fact_id, 'MBoe,MBbls' AS units FROM s WHERE length(rtrim(CAST(d + u AS VARCHAR), '0')) > 2"),
    "other_reports": with_(SUPPLIED, then=union(*[
        f"SELECT accession, '{key}' AS concept_key, CAST({product} AS VARCHAR) AS product, CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, '{period}' AS period_end FROM s WHERE k % 3 = {kind}" for kind, key, product, value, unit, period in (
            (0, T, "'oil'", "d", "MBbls", "2022-12-31"), (0, T, "NULL", "d + 5", "MBoe", "2022-12-31"), (0, T, "'oil'", "u", "MBbls", "2023-12-31"), (0, T, "NULL", "u + 6", "MBoe", "2023-12-31"),
            (0, D, "'oil'", "d - 7", "MBbls", "2022-12-31"), (0, D, "NULL", "d - 2", "MBoe", "2022-12-31"), (0, D, "'oil'", "u - 7", "MBbls", "2023-12-31"), (0, D, "NULL", "u - 1", "MBoe", "2023-12-31"),
            (1, D, "'oil'", "d + 5", "MBbls", "2024-12-31"), (1, D, "NULL", "d + 16", "MBoe", "2024-12-31"), (1, U, "'oil'", "7", "MBbls", "2024-12-31"), (1, U, "NULL", "9", "MBoe", "2024-12-31"),
            (2, D, "'oil'", "d + u", "bbl", "2022-12-31"))])),
    "scale_sources": with_(SUPPLIED, then="SELECT k, CASE WHEN k % 2 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(d AS DOUBLE) END AS scale, CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN 0 WHEN k % 3 = 1 THEN 3 END AS declared FROM s"),
    "people_csv": with_(SUPPLIED, then="""SELECT 'c' || k AS cik, name, 'A' || k || '|B' || k AS tickers, CASE WHEN k % 2 = 0 THEN 'x, "y"' END AS note, 1 AS files FROM s"""),
    "hit_documents": with_(LINES, f"""hit AS (SELECT document_id, length(text) <= 110 AS label, line_no FROM line_text WHERE {TEST}),
jump AS (SELECT document_id, coalesce(line_no - lag(line_no) OVER (PARTITION BY document_id ORDER BY line_no) > 80, true) AS j FROM hit WHERE label),
n AS (SELECT document_id, count(*) FILTER (j) AS n_sites FROM jump GROUP BY document_id)""",
        then="SELECT h.document_id, any_value(d.lang) AS lang, count(*) FILTER (NOT label) AS prose_hits, coalesce(any_value(n_sites), 0) AS n_sites FROM hit h JOIN documents d ON d.doc_id = h.document_id LEFT JOIN n ON n.document_id = h.document_id GROUP BY h.document_id"),
    "published_anew": with_(*STORE, then="SELECT *, true AS refused FROM (SELECT 'company' AS relation, count(*) AS n FROM company UNION ALL SELECT 'filing', count(*) FROM filing UNION ALL SELECT 'fact', count(*) FROM fact UNION ALL SELECT 'verification', count(*) FROM verification UNION ALL SELECT 'scale', count(*) FROM scale)"),
}
ORACLE_SQL |= {
    "views_of_an_older_store": with_(*STORE, then="SELECT form, unit, count(*) AS n, CAST(0 AS BIGINT) AS extracted, CAST(0 AS BIGINT) AS in_cohort, max(filed_date) AS latest FROM fact_current f JOIN company c ON c.cik = f.cik GROUP BY form, unit"),
    "resolution_counters": f"SELECT status, count(*) AS n FROM ({CORE['scale_resolve']}) GROUP BY status",
    "current_from_stream": CORE["fact_current"],
}
# The readers say the same when SQL calls them.
ORACLE_SQL |= {sql: ORACLE_SQL[same] for sql, same in {"lines_in_sql": "page_lines", "cells_in_sql": "table_cells", "figures_in_sql": "marked_figures", "reserves_in_sql": "reserve_readings", "production_in_sql": "production_readings"}.items()}
assert {c.key for c in CONCEPTS} == RANKS.keys()
