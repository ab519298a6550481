"""Queries on landed documents, covers, terms and phrases."""

from datetime import date

from pyspark.sql import functions as F

from greenshoe import fixed_values as V
from greenshoe.cases.registry import query
from greenshoe.functions import offering as O
from greenshoe.functions import text as X
from greenshoe.operators.cover import cover_text
from greenshoe.plans import ingest, reports
from greenshoe.plans import terms as T
from greenshoe.sources import filings, landed

DAY = date(1998, 10, 3)
START, END = date(1998, 1, 1), date(1998, 6, 30)
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)

INDEX_COLUMNS = "cik, company_name, filing_date, accession_number, form_type, filing_url"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- the extraction in plain SQL, for checking -----------------------------------------------------


def _type_sql(cover: str) -> str:
    def has(signals, glue):
        return glue.join(f"cast(contains({low}, {_literal(s)}) AS int)" for s in signals)

    low = f"lower({cover})"
    return f"""CASE
  WHEN {has(V.SPAC_SIGNALS, " + ")} >= 2 THEN 'spac'
  WHEN {has(V.FOLLOW_ON_SIGNALS, " + ")} >= 1 THEN 'follow_on'
  WHEN {has(V.IPO_SIGNALS, " + ")} >= 1 THEN 'ipo'
  WHEN regexp_matches({low}, {_literal(V.UNDERWRITING_PATTERN)}) THEN
    CASE WHEN regexp_matches({low}, {_literal(V.NO_MARKET_PATTERN)}) THEN 'ipo' ELSE 'follow_on' END
  ELSE 'unknown' END"""


def _group(pattern: str, group: int = 1) -> str:
    return f"regexp_extract(txt, {_literal(pattern)}, {group}, 'i')"


def _price_sql(group: int) -> str:
    rules = []
    for p in V.PRICE_RANGE_PATTERNS:
        low, high = (f"try_cast({_group(p, g)} AS double)" for g in (1, 2))
        value = low if group == 1 else high
        rules.append(f"WHEN {low} BETWEEN 1 AND 500 AND {low} <= {high} THEN {value}")
    for p in V.SINGLE_PRICE_PATTERNS:
        value = f"try_cast({_group(p)} AS double)"
        rules.append(f"WHEN {value} BETWEEN 0.01 AND 500 THEN {value}")
    return "CASE " + "\n  ".join(rules) + " END"


def _shares_sql() -> str:
    rules = []
    for p in V.SHARE_PATTERNS:
        match = _group(p)
        digits = f"replace({match}, ',', '')"
        number = f"try_cast({digits} AS bigint)"
        rules.append(f"WHEN {match} <> '' AND {digits} = '' THEN -1")
        rules.append(f"WHEN {number} BETWEEN 10000 AND 1000000000 THEN {number}")
    return "CASE " + "\n  ".join(rules) + " END"


def _extracted_sql(covers: str) -> str:
    """Terms of every cover before the fallback, error rows included."""
    return f"""
SELECT * EXCLUDE (t, s, lo, hi, failed), CASE WHEN failed THEN 'unknown' ELSE t END AS offering_type,
  CASE WHEN NOT failed THEN s END AS shares_offered, CASE WHEN NOT failed THEN lo END AS price_low,
  CASE WHEN NOT failed THEN hi END AS price_high,
  CASE WHEN failed THEN 'error' ELSE 'regex' END AS extraction_method
FROM (SELECT *, cover IS NULL OR coalesce(s, 0) = -1 AS failed
FROM (SELECT * EXCLUDE (txt), {_type_sql("cover")} AS t, cast({_shares_sql()} AS bigint) AS s,
  {_price_sql(1)} AS lo, {_price_sql(2)} AS hi
FROM (SELECT *, regexp_replace(cover, '[\\s\\x{{00A0}}]+', ' ', 'g') AS txt FROM {covers}) a) b) c"""


OPEN = """extraction_method = 'regex' AND offering_type = 'ipo' AND price_low IS NULL
  AND shares_offered IS NULL"""

# What the HTML of fx_documents reads as: the block repeats the text of the parts in it.
DOCUMENT_COVERS = """
SELECT cik, accession_number, filing_date, CASE WHEN http_status < 400 THEN
  body || ' ' || tail || ' ' || body || ' ' || tail END AS cover FROM fx_cover_parts"""

ANSWERS = """
SELECT acc AS accession_number, CASE o_custkey % 5 WHEN 0 THEN 'ipo' WHEN 4 THEN NULL
    ELSE 'unknown' END AS offering_type,
  CASE o_custkey % 5 WHEN 0 THEN o_orderkey + 10000 WHEN 4 THEN 20000 END AS shares_offered,
  CASE o_custkey % 5 WHEN 0 THEN 10.5e0 WHEN 1 THEN 7e0 END AS price_low,
  CASE o_custkey % 5 WHEN 0 THEN 12e0 END AS price_high,
  CASE o_custkey % 5 WHEN 2 THEN 'llm_parse_error' WHEN 3 THEN 'error' ELSE 'llm' END
    AS extraction_method
FROM fx_orders WHERE o_orderstatus <> 'O'"""

TERMS = f"""
SELECT x.cik, x.accession_number, x.filing_date,
  CASE WHEN is_open THEN CASE WHEN a.accession_number IS NULL THEN 'unknown' ELSE a.offering_type END
    ELSE x.offering_type END AS offering_type,
  CASE WHEN is_open THEN a.shares_offered ELSE x.shares_offered END AS shares_offered,
  CASE WHEN is_open THEN a.price_low ELSE x.price_low END AS price_low,
  CASE WHEN is_open THEN a.price_high ELSE x.price_high END AS price_high,
  CASE WHEN is_open THEN coalesce(a.extraction_method, 'error') ELSE x.extraction_method END
    AS extraction_method
FROM (SELECT *, {OPEN} AS is_open FROM ({_extracted_sql(f"({DOCUMENT_COVERS}) d")}) e) x
  LEFT JOIN ({ANSWERS}) a ON x.accession_number = a.accession_number"""

DOCUMENTS = ["fx_documents", "fx_cover_parts", "fx_fallback_responses"]


def _covers(t):
    return t["fx_covers"]


def _document_terms(t, mode):
    return ingest.terms_of(t["fx_documents"], t["fx_fallback_responses"], mode)


# --- scans -------------------------------------------------------------------------------------------


@query(
    "daily_filings",
    ["fx_filing_index"],
    f"""SELECT {INDEX_COLUMNS} FROM fx_filing_index WHERE form_type = '424B4'
  AND filing_date = DATE '{DAY}' AND filing_url IS NOT NULL""",
)
def _(t):
    return filings.daily_filings(t["fx_filing_index"], V.PROSPECTUS_FORM, DAY)


@query(
    "filings_in_range",
    ["fx_filing_index"],
    f"""SELECT {INDEX_COLUMNS} FROM fx_filing_index WHERE form_type = 'S-1'
  AND filing_date BETWEEN DATE '{START}' AND DATE '{END}' AND filing_url IS NOT NULL""",
)
def _(t):
    return filings.filings_in_range(t["fx_filing_index"], V.REGISTRATION_FORM, START, END)


@query(
    "explode_attachments",
    ["fx_orders"],
    """SELECT acc AS accession_number, p AS position, CASE p WHEN 0 THEN '424B4' WHEN 1 THEN 'EX-1.1'
  WHEN 2 THEN 'GRAPHIC' ELSE 'EX-99' END AS document_type,
  CASE p WHEN 0 THEN 'PROSPECTUS ' || acc WHEN 1 THEN 'AGREEMENT' END AS description
FROM fx_orders JOIN (VALUES (0), (1), (2), (3)) v(p) ON p <= o_orderkey % 4""",
)
def _(t):
    return filings.attachments(t["fx_filing_index"])


@query(
    "sample_filings",
    ["fx_filing_index"],
    f"""SELECT {INDEX_COLUMNS} FROM fx_filing_index
WHERE form_type = '424B4' AND filing_date BETWEEN DATE '{START}' AND DATE '{END}'
  AND filing_url IS NOT NULL ORDER BY filing_date DESC, accession_number LIMIT 100""",
)
def _(t):
    found = filings.filings_in_range(t["fx_filing_index"], V.PROSPECTUS_FORM, START, END)
    return reports.sample_filings(found, 100)


@query(
    "response_triage",
    ["fx_landed_submissions"],
    """SELECT cik, http_status, CASE WHEN http_status = 404 THEN 'not_found'
  WHEN http_status < 400 THEN 'ok' ELSE 'failed' END AS outcome FROM fx_landed_submissions""",
)
def _(t):
    return landed.triage(t["fx_landed_submissions"]).select("cik", "http_status", "outcome")


METADATA = """
SELECT c.* FROM fx_companies c JOIN fx_landed_submissions s ON c.cik = s.cik
WHERE s.http_status < 400 AND s.body <> '<busy>'"""


@query("company_metadata", ["fx_landed_submissions"], METADATA)
def _(t):
    return landed.company_metadata(t["fx_landed_submissions"])


@query(
    "company_lookup",
    ["fx_landed_submissions", "fx_filing_index"],
    f"""SELECT * FROM ({METADATA}) m WHERE cik IN (SELECT cik FROM fx_filing_index
  WHERE form_type = 'S-1' AND filing_url IS NOT NULL
    AND filing_date BETWEEN DATE '{START}' AND DATE '{END}')""",
)
def _(t):
    found = filings.filings_in_range(t["fx_filing_index"], V.REGISTRATION_FORM, START, END)
    return ingest.company_lookup(found, t["fx_landed_submissions"])


# --- covers ----------------------------------------------------------------------------------------------


@query("document_covers", ["fx_cover_parts"], DOCUMENT_COVERS)
def _(t):
    return landed.document_covers(t["fx_documents"])


@query(
    "normalize_text",
    [],
    """SELECT doc_id, regexp_replace(text, '[\\s\\x{00A0}]+', ' ', 'g') AS normalized
FROM documents""",
)
def _(t):
    normalized = X.normalize_whitespace(F.col("text"))
    return t["documents"].select("doc_id", normalized.alias("normalized"))


@query("text_preview", [], "SELECT doc_id, substring(text, 1, 500) AS preview FROM documents")
def _(t):
    return t["documents"].select("doc_id", F.substring("text", 1, V.PREVIEW_CHARS).alias("preview"))


# --- terms -------------------------------------------------------------------------------------------------


@query(
    "classify_offering",
    ["fx_covers"],
    f"SELECT accession_number, {_type_sql('cover')} AS offering_type FROM fx_covers",
)
def _(t):
    kind = O.offering_type(F.lower("cover"))
    return _covers(t).select("accession_number", kind.alias("offering_type"))


@query(
    "extract_price",
    ["fx_covers"],
    f"SELECT accession_number, price_low, price_high FROM ({_extracted_sql('fx_covers')}) e",
)
def _(t):
    found = T.extract(_covers(t), (T.PRICE,))
    return found.select("accession_number", "price_low", "price_high")


@query(
    "extract_shares",
    ["fx_covers"],
    f"SELECT accession_number, shares_offered, extraction_method FROM ({_extracted_sql('fx_covers')}) e",
)
def _(t):
    found = T.extract(_covers(t), (T.SHARES,))
    return found.select("accession_number", "shares_offered", "extraction_method")


@query("extract_terms", DOCUMENTS, TERMS)
def _(t):
    return _document_terms(t, T.DAILY)


def _backfill(t):
    return ingest.batch(
        t["fx_filing_index"],
        ingest.extract_days(t["fx_documents"], FIRST_DAY, LAST_DAY),
        t["fx_landed_submissions"],
        t["fx_fallback_responses"],
        FIRST_DAY,
        LAST_DAY,
        mode=T.BACKFILL,
    )


@query(
    "backfill_terms",
    [*DOCUMENTS, "fx_filing_index"],
    f"""SELECT * FROM ({TERMS}) t WHERE extraction_method <> 'error' AND accession_number IN (
  SELECT accession_number FROM fx_filing_index WHERE form_type = '424B4'
    AND filing_url IS NOT NULL AND filing_date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}')""",
)
def _(t):
    return _backfill(t)["offering_terms"]


@query(
    "fallback_requests",
    ["fx_cover_parts"],
    f"""SELECT accession_number, {_literal(V.FALLBACK_PROMPT)} || substring(cover, 1, 4000) AS prompt
FROM ({_extracted_sql(f"({DOCUMENT_COVERS}) d")}) e WHERE {OPEN}""",
)
def _(t):
    return T.fallback_requests(T.extract(landed.document_covers(t["fx_documents"])))


@query("fold_fallback", ["fx_orders"], ANSWERS)
def _(t):
    return T.parse_responses(t["fx_fallback_responses"])


@query(
    "type_breakdown",
    DOCUMENTS,
    f"""SELECT offering_type, count(*) AS n FROM ({TERMS}) t
WHERE extraction_method <> 'error' AND offering_type IS NOT NULL
GROUP BY offering_type ORDER BY n DESC, offering_type""",
)
def _(t):
    return reports.type_breakdown(_document_terms(t, T.DAILY))


@query(
    "extraction_rate",
    DOCUMENTS,
    f"""SELECT count(*) AS ipos, round(count(price_low) / count(*), 9) AS price_rate
FROM ({TERMS}) t WHERE offering_type = 'ipo'""",
)
def _(t):
    rate = reports.extraction_rate(_document_terms(t, T.DAILY))
    return rate.withColumn("price_rate", F.round("price_rate", 9))


@query(
    "ipo_listing",
    [*DOCUMENTS, "fx_filing_index"],
    f"""SELECT i.company_name AS company, t.cik, t.accession_number, t.filing_date, t.shares_offered,
  t.price_low
FROM ({TERMS}) t JOIN fx_filing_index i ON t.accession_number = i.accession_number
WHERE t.offering_type = 'ipo'""",
)
def _(t):
    return reports.ipo_listing(_document_terms(t, T.DAILY), t["fx_filing_index"])


@query(
    "run_summary",
    [*DOCUMENTS, "fx_landed_submissions", "fx_filing_index"],
    f"""SELECT 'filings' AS measure, count(*) AS n FROM fx_filing_index
WHERE form_type = '424B4' AND filing_url IS NOT NULL
UNION ALL SELECT 'extracted', count(*) FROM ({TERMS}) t
WHERE extraction_method <> 'error' AND accession_number IN (
  SELECT accession_number FROM fx_filing_index WHERE form_type = '424B4' AND filing_url IS NOT NULL)
UNION ALL SELECT 'companies', count(DISTINCT cik) FROM ({METADATA}) m WHERE cik IN (
  SELECT cik FROM fx_filing_index WHERE form_type = '424B4' AND filing_url IS NOT NULL)""",
)
def _(t):
    batch = _backfill(t)
    return reports.run_summary(
        batch["prospectus_filings"], batch["offering_terms"], batch["companies"]
    )


# --- phrases ---------------------------------------------------------------------------------------------------

PHRASES = """
SELECT *, generate_subscripts(found, 1) AS position, unnest(found) AS phrase FROM (
  SELECT *, regexp_extract_all(cover, '\\$[\\s\\x{00A0}]*[\\d,\\.]+[^\\n]{0,60}') AS found
  FROM fx_covers) q"""


@query("dollar_phrases", ["fx_covers"], f"SELECT accession_number, phrase FROM ({PHRASES}) p")
def _(t):
    phrases = F.explode("dollar_matches").alias("phrase")
    return reports.with_dollar_phrases(_covers(t)).select("accession_number", phrases)


@query(
    "share_phrases",
    ["fx_covers"],
    """SELECT accession_number, unnest(regexp_extract_all(cover,
  '[\\d,]{5,}[\\s\\x{00A0}]+(?:ordinary[\\s\\x{00A0}]+)?(?:class[\\s\\x{00A0}]+[a-z][\\s\\x{00A0}]+)?shares?',
  0, 'i')[1:10]) AS phrase FROM fx_covers""",
)
def _(t):
    phrases = F.explode("share_matches").alias("phrase")
    return reports.with_share_phrases(_covers(t)).select("accession_number", phrases)


@query(
    "phrase_frequency",
    ["fx_covers"],
    f"""SELECT substring(regexp_replace(phrase, '[\\d,]+', '#', 'g'), 1, 70) AS masked, count(*) AS n
FROM ({PHRASES}) p GROUP BY 1 ORDER BY n DESC, masked LIMIT 30""",
)
def _(t):
    return reports.phrase_frequency(reports.with_dollar_phrases(_covers(t)))


@query(
    "distinct_phrases",
    ["fx_covers"],
    f"""SELECT masked, substring(phrase, 1, 80) AS example FROM (SELECT *, row_number() OVER (
  PARTITION BY masked ORDER BY accession_number, position) AS rn
FROM (SELECT *, substring(regexp_replace(phrase, '\\d', '#', 'g'), 1, 60) AS masked
  FROM ({PHRASES}) p) q) r WHERE rn = 1""",
)
def _(t):
    samples = reports.with_dollar_phrases(_covers(t))
    return reports.distinct_phrases(samples, ["accession_number"])


@query(
    "no_dollar_docs",
    ["fx_covers"],
    """SELECT accession_number, substring(cover, 1, 200) AS cover_start FROM fx_covers
WHERE NOT regexp_matches(cover, '\\$[\\s\\x{00A0}]*[\\d,\\.]')""",
)
def _(t):
    samples = reports.without_dollars(reports.with_dollar_phrases(_covers(t)))
    return samples.select(
        "accession_number", F.substring("cover_3000", 1, 200).alias("cover_start")
    )


@query(
    "share_phrase_report",
    ["fx_covers"],
    """SELECT company_name AS company, substring(cover, 1, 800) AS preview,
  array_to_string(regexp_extract_all(substring(cover, 1, 3000),
  '[\\d,]{5,}[\\s\\x{00A0}]+(?:ordinary[\\s\\x{00A0}]+)?(?:class[\\s\\x{00A0}]+[a-z][\\s\\x{00A0}]+)?shares?',
  0, 'i')[1:10], '|') AS share_phrases
FROM fx_covers WHERE contains(lower(company_name), 'er 1') OR contains(lower(company_name), '77')""",
)
def _(t):
    samples = reports.with_dollar_phrases(_covers(t)).withColumnRenamed("company_name", "company")
    report = reports.share_phrase_report(samples, ["ER 1", "77"])
    return report.withColumn("share_phrases", F.array_join("share_phrases", "|"))


@query(
    "cover_samples",
    ["fx_cover_parts"],
    f"""SELECT cast("index" AS int) AS "index", company_name AS company, f.cik, cast(f.filing_date AS varchar) AS filing_date,
  filing_url AS url, substring(cover, 1, 3000) AS cover_3000,
  array_to_string(regexp_extract_all(cover, '\\$[\\s\\x{{00A0}}]*[\\d,\\.]+[^\\n]{{0,60}}'), '|')
    AS dollar_matches
FROM (SELECT *, row_number() OVER (ORDER BY filing_date DESC, accession_number) - 1 AS "index"
  FROM fx_cover_parts) f JOIN ({DOCUMENT_COVERS}) d ON f.accession_number = d.accession_number
WHERE "index" < 100 AND cover IS NOT NULL""",
)
def _(t):
    samples = reports.cover_samples(_covers(t).drop("cover"), t["fx_documents"], 100)
    return samples.withColumn("dollar_matches", F.array_join("dollar_matches", "|"))


@query(
    "failed_samples",
    ["fx_cover_parts"],
    f"""SELECT cast("index" AS int) AS "index", company_name AS company, f.cik, f.accession_number,
  cast(f.filing_date AS varchar) AS filing_date, filing_url AS url
FROM (SELECT *, row_number() OVER (ORDER BY filing_date DESC, accession_number) - 1 AS "index"
  FROM fx_cover_parts) f LEFT JOIN ({DOCUMENT_COVERS}) d ON f.accession_number = d.accession_number
WHERE "index" < 100 AND cover IS NULL""",
)
def _(t):
    return reports.failed_samples(_covers(t).drop("cover"), t["fx_documents"], 100)


# --- web pages -----------------------------------------------------------------------------------------------------


# Walks the tags of every page with a stack of what is open; each string belongs to the blocks that
# are open around it.
PAGE_COVERS = r"""
WITH RECURSIVE tokens AS (
  SELECT page_id, generate_subscripts(found, 1) AS i, unnest(found) AS token FROM (
    SELECT page_id, regexp_extract_all(regexp_replace(html,
      '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '<x>', 'gs'),
      '<[^>]*>|[^<]+') AS found FROM pages) q),
steps AS (
  SELECT page_id, i, token, lower(regexp_extract(token, '^<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS opened,
    lower(regexp_extract(token, '^</([a-zA-Z][a-zA-Z0-9]*)', 1)) AS closed FROM tokens),
walk AS (
  SELECT page_id, cast(0 AS bigint) AS i, cast([] AS varchar[]) AS tags, cast([] AS bigint[]) AS ids,
    '' AS token FROM pages
  UNION ALL
  SELECT s.page_id, s.i,
    CASE WHEN s.opened NOT IN ('', 'br', 'hr', 'img', 'input', 'link', 'meta') THEN w.tags || [s.opened]
      WHEN list_contains(w.tags, s.closed)
        THEN w.tags[:len(w.tags) - list_position(list_reverse(w.tags), s.closed)]
      ELSE w.tags END,
    CASE WHEN s.opened NOT IN ('', 'br', 'hr', 'img', 'input', 'link', 'meta') THEN w.ids || [s.i]
      WHEN list_contains(w.tags, s.closed)
        THEN w.ids[:len(w.tags) - list_position(list_reverse(w.tags), s.closed)]
      ELSE w.ids END, s.token
  FROM walk w JOIN steps s ON s.page_id = w.page_id AND s.i = w.i + 1),
strings AS (
  SELECT page_id, i, ids, tags, trim(replace(replace(replace(replace(replace(replace(token, '&copy;', '©'), '&middot;', '·'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), chr(32) || chr(9) || chr(10) || chr(13) || chr(160)) AS txt
  FROM walk WHERE token NOT LIKE '<%'),
chunks AS (
  SELECT page_id, id, string_agg(txt, ' ' ORDER BY i) AS chunk FROM (
    SELECT page_id, i, txt, unnest(ids) AS id, unnest(tags) AS tag FROM strings WHERE txt <> '') q
  WHERE tag IN ('p', 'div', 'span', 'td') GROUP BY page_id, id),
kept AS (
  SELECT *, sum(length(chunk)) OVER (PARTITION BY page_id ORDER BY id) - length(chunk) AS before
  FROM chunks)
SELECT p.page_id, coalesce(string_agg(chunk, ' ' ORDER BY id) FILTER (before <= 15000), '') AS cover
FROM pages p LEFT JOIN kept k ON p.page_id = k.page_id GROUP BY p.page_id"""


@query("cover_text", [], PAGE_COVERS)
def _(t):
    return t["pages"].select("page_id", cover_text(F.col("html")).alias("cover"))
