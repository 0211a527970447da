"""DuckDB text of the domain views, shared by the oracle SQL strings.

These mirror ``ideaweave.sources.testdata`` so the oracle reads the same tables.
"""

IDEAS = """ideas_v AS (
  SELECT doc_id AS idea_id, 'Document ' || doc_id AS title, text AS description, source,
         'doc:' || sha256(text) AS url, lang AS category, '' AS stack
  FROM documents)"""

RAW = """raw_v AS (
  SELECT 'Document ' || doc_id AS title, text AS description, 'doc:' || sha256(text) AS url,
         source, lang AS category, '' AS stack, doc_id AS ingest_ord
  FROM documents)"""

TOKENS = IDEAS + """,
docs_v AS (
  SELECT idea_id, coalesce(title, '') || ' ' || coalesce(category, '') || ' '
         || coalesce(description, '') AS doc
  FROM ideas_v),
tok_v AS (
  SELECT idea_id, list_filter(string_split_regex(lower(doc), '[^a-z0-9]+'), lambda t: length(t) > 2) AS tokens
  FROM docs_v),
n_v AS (SELECT count(*)::DOUBLE AS n FROM documents),
tf_v AS (
  SELECT idea_id, len(tokens) AS n_tokens, term, count(*) AS tf
  FROM (SELECT idea_id, tokens, unnest(tokens) AS term FROM tok_v)
  GROUP BY idea_id, len(tokens), term),
df_v AS (SELECT term, count(*) AS df FROM tf_v GROUP BY term),
vocab_v AS (
  SELECT term, df, ln((SELECT n FROM n_v) / (df + 1)::DOUBLE) AS idf
  FROM df_v WHERE df >= 2 AND df::DOUBLE <= (SELECT n FROM n_v) * 0.8::DOUBLE),
raw_w AS (
  SELECT t.idea_id, t.term, (t.tf::DOUBLE / t.n_tokens) * v.idf AS raw
  FROM tf_v t JOIN vocab_v v USING (term)),
weights_v AS (
  SELECT idea_id, term,
         CASE WHEN sqrt(sum(raw * raw) OVER (PARTITION BY idea_id)) > 0
              THEN raw / sqrt(sum(raw * raw) OVER (PARTITION BY idea_id)) ELSE 0.0 END AS weight
  FROM raw_w)"""

VECTORS = """vec_v AS (
  SELECT vec_id AS idea_id, embedding::DOUBLE[] AS vec, label FROM embeddings)"""

LEDGER = """ledger_v AS (
  SELECT event_id, ts,
         CASE event_type WHEN 'view' THEN 'claude-haiku-4-5-20251001'
                         WHEN 'signup' THEN 'claude-sonnet-4-5-20250929'
                         WHEN 'click' THEN 'claude-opus-4-5-20251101'
                         WHEN 'error' THEN 'unpriced-model-a'
                         WHEN 'purchase' THEN 'unpriced-model-b' END AS model,
         CASE WHEN user_id % 2 = 0 THEN 'constellations' ELSE 'patterns' END AS stage,
         floor(value * 1000)::BIGINT AS input_tokens,
         floor(value * 100)::BIGINT AS output_tokens
  FROM events),
pricing_v AS (
  SELECT * FROM (VALUES ('claude-haiku-4-5-20251001', 0.80::DOUBLE, 4.00::DOUBLE),
                        ('claude-sonnet-4-5-20250929', 3.00::DOUBLE, 15.00::DOUBLE),
                        ('claude-sonnet-4-6-20260514', 3.00::DOUBLE, 15.00::DOUBLE),
                        ('claude-opus-4-5-20251101', 15.00::DOUBLE, 75.00::DOUBLE),
                        ('claude-opus-4-6-20260409', 15.00::DOUBLE, 75.00::DOUBLE))
         AS p(model, input_per_million, output_per_million))"""
