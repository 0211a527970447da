"""Landed payload tables derived from the driver tables, one per source format.

Each view has the normaliser input contract ``(source, fetch_key, payload, ord)`` and is a
per-row rewrite of a given table (pages -> HTML sources, events -> item JSON, documents ->
Atom feed entries, part / customer -> API JSON). ``SQL_*`` strings are the same payload
expressions in DuckDB syntax for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .testdata import table

AS_OF = "2024-01-31 00:00:00"  # fixed "now" for the recency rules (test data spans January 2024)

# ---- github: pages with their nav links turned into repo anchors and paragraphs into descriptions
GITHUB_SPARK = ("regexp_replace(replace(html, '<p>', '<p class=\"col-9 color-fg-muted\">'), "
                "'href=\"/([^\"]*)\"', 'href=\"/site/$1\" class=\"Link\"')")
GITHUB_DUCK = ("regexp_replace(replace(html, '<p>', '<p class=\"col-9 color-fg-muted\">'), "
               "'href=\"/([^\"]*)\"', 'href=\"/site/\\1\" class=\"Link\"', 'g')")
LANG_SPARK = "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)"
LANG_DUCK = "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)"

# ---- hn: one item JSON per event; each day is one fetch of the top list
HN_COMMON = ("'{\"id\": ' || CAST(event_id AS STRING) || ', \"url\": \"https://news.example/item/' "
             "|| CAST(event_id AS STRING) || '\", \"title\": \"' || event_type || ' story ' || CAST(user_id AS STRING) "
             "|| '\", \"score\": ' || CAST(CAST(floor(value) AS BIGINT) AS STRING) || ', \"descendants\": ' "
             "|| CAST(user_id AS STRING) || ', \"time\": ' || CAST({epoch} AS STRING) || ', \"type\": \"' "
             "|| CASE WHEN event_type = 'error' THEN 'comment' ELSE 'story' END || '\"' "
             "|| CASE WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN ', \"dead\": true' ELSE '' END || '}'")
HN_SPARK = HN_COMMON.replace("{epoch}", "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
HN_DUCK = HN_COMMON.replace("{epoch}", "CAST(epoch(ts) AS BIGINT)")

# ---- betalist: pages with h2 titles, a tagline paragraph and a startup link inside the article
BETALIST = ("replace(replace(replace(replace(html, '<h1>', '<h2>'), '</h1>', '</h2>'), '<p><b>', "
            "'<p class=\"tagline\"><b>'), '<article>', '<article><a href=\"/startups/p' || CAST(page_id AS STRING) "
            "|| '\">more</a>')")

# ---- devto: one article per row; feed = p_partkey % 5 (feed order), urls repeat across parts
DEVTO = ("'[{\"url\": \"https://dev.example/' || replace(p_name, ' ', '-') || '\", \"title\": \"' || p_name "
         "|| ' notes\", \"description\": \"' || p_type || '\", \"tag_list\": [\"' || lower(p_brand) || '\", \"' "
         "|| lower(p_type) || '\"], \"public_reactions_count\": ' || CAST(p_size AS STRING) || '}]'")
DEVTO_ORD = "(p_partkey % 5) * 1000000000 + p_partkey"

# ---- huggingface: models / spaces / datasets lists
HF_KIND = "CASE p_partkey % 3 WHEN 0 THEN 'model' WHEN 1 THEN 'space' ELSE 'dataset' END"
HF = ("'[{\"id\": \"org' || CAST(p_partkey % 17 AS STRING) || '/' || replace(p_name, ' ', '-') || '\", \"likes\": ' "
      "|| CAST(p_size AS STRING) || CASE WHEN p_size % 4 = 0 THEN '' ELSE ', \"downloads\": ' "
      "|| CAST(p_size * 100 AS STRING) END || '}]'")

# ---- producthunt API pages
PH = ("'{\"data\": {\"posts\": {\"edges\": [{\"node\": {\"name\": \"' || p_name || '\", \"tagline\": \"' || p_type "
      "|| '\", \"url\": \"https://ph.example/p/' || CAST(p_partkey AS STRING) || '\", \"website\": \"' "
      "|| CASE WHEN p_size % 3 = 0 THEN '' ELSE 'https://site' || CAST(p_partkey AS STRING) || '.example' END "
      "|| '\", \"votesCount\": ' || CAST(p_size % 5 * 10 AS STRING) || '}}]}}}'")

# ---- yc: one company per row, batch order = customer key
YC = ("'{\"companies\": [{\"name\": \"' || c_name || '\", \"website\": \"' || CASE WHEN c_custkey % 4 = 0 THEN '' "
      "ELSE 'https://' || lower(replace(c_name, '#', '')) || '.example' END || '\", \"url\": \"https://yc.example/' "
      "|| CAST(c_custkey AS STRING) || '\", \"oneLiner\": \"' || c_mktsegment || '\"}]}'")

# ---- arxiv: one Atom feed per document (whole text as the summary)
ARXIV_COMMON = ("'<feed><entry><title>' || regexp_extract(text, '^[^.]*', 0) || '</title>' || CASE WHEN doc_id % 2 = 0 "
                "THEN '<link href=\"https://arxiv.example/abs/' || CAST(doc_id AS STRING) || '\" rel=\"alternate\" "
                "type=\"text/html\"/>' ELSE '<link rel=\"alternate\" type=\"text/html\" href=\"https://arxiv.example/abs/' "
                "|| CAST(doc_id AS STRING) || '\"/>' END || '<summary>' || text || '</summary><published>' "
                "|| CASE WHEN n_chars % 7 = 0 THEN 'unknown' ELSE '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0') "
                "|| 'T10:00:00Z' END || '</published></entry></feed>'")

# ---- paperswithcode: card layout on even pages, link/h1 layout on odd pages
PWC = ("CASE WHEN page_id % 2 = 0 THEN '<div class=\"paper-card x\"><div><h1><a href=\"/paper/p' "
       "|| CAST(page_id AS STRING) || '\">' || regexp_extract(html, '<h1>([^<]*)</h1>', 1) || '</a></h1>"
       "<p class=\"item-strip-abstract\">' || regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1) "
       "|| '</p></div></div></div>' ELSE '<a href=\"/paper/p' || CAST(page_id AS STRING) || '\"> <h1>' "
       "|| regexp_extract(html, '<h1>([^<]*)</h1>', 1) || '</h1></a>' END")

# ---- producthunt homepage: the nav words as name/tagline/url triples in a data blob
PH_HTML_SPARK = ("'<html><script>window.__NEXT_DATA__ = {\"props\": [' || regexp_replace(regexp_extract(html, "
                 "'<ul>(.*?)</ul>', 1), '<li><a href=\"/([^\"]*)\">([^<]*)</a></li>', "
                 "'{\"name\":\"$2\",\"tagline\":\"about $2\",\"url\":\"/posts/$1\"},') || ']}</script></html>'")


PH_HTML_DUCK = ("'<html><script>window.__NEXT_DATA__ = {\"props\": [' || regexp_replace(regexp_extract(html, "
                "'<ul>(.*?)</ul>', 1), '<li><a href=\"/([^\"]*)\">([^<]*)</a></li>', "
                "'{\"name\":\"\\2\",\"tagline\":\"about \\2\",\"url\":\"/posts/\\1\"},', 'g') || ']}</script></html>'")


def _payloads(df: DataFrame, source: str, payload: str, fetch_key: str, ord_expr: str) -> DataFrame:
    return df.selectExpr(f"'{source}' AS source", f"CAST({fetch_key} AS STRING) AS fetch_key",
                         f"{payload} AS payload", f"CAST({ord_expr} AS BIGINT) AS ord")


def payloads(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    pages = lambda: table(spark, sf_dir, "pages")
    part = lambda: table(spark, sf_dir, "part")
    if source == "github":
        return _payloads(pages(), "github", GITHUB_SPARK, LANG_SPARK, "page_id")
    if source == "hn":
        return _payloads(table(spark, sf_dir, "events"), "hn", HN_SPARK, "CAST(CAST(ts AS DATE) AS STRING)", "event_id")
    if source == "arxiv":
        return _payloads(table(spark, sf_dir, "documents"), "arxiv", ARXIV_COMMON, "source", "doc_id")
    if source == "producthunt":
        return _payloads(part(), "producthunt", PH, "'api'", "p_partkey")
    if source == "producthunt_html":
        return _payloads(pages(), "producthunt", PH_HTML_SPARK, "'home'", "page_id")
    if source == "yc":
        return _payloads(table(spark, sf_dir, "customer"), "yc", YC, "c_nationkey", "c_custkey")
    if source == "betalist":
        return _payloads(pages(), "betalist", BETALIST, "'startups'", "page_id")
    if source == "devto":
        return _payloads(part(), "devto", DEVTO, "p_partkey % 5", DEVTO_ORD)
    if source == "paperswithcode":
        return _payloads(pages(), "paperswithcode", PWC, "'latest'", "page_id")
    if source == "huggingface":
        return _payloads(part(), "huggingface", HF, HF_KIND, "p_partkey")
    raise KeyError(source)


def all_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["github", "hn", "arxiv", "producthunt", "yc", "betalist", "devto", "paperswithcode", "huggingface"]
    out = payloads(spark, sf_dir, names[0])
    for n in names[1:]:
        out = out.unionByName(payloads(spark, sf_dir, n))
    return out
