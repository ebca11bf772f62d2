"""DuckDB SQL of the ingest queries, from the raw tables alone."""

from __future__ import annotations

_BATCHES = """
WITH typed AS (
  SELECT batch_id, territory, current_premium, CASE WHEN batch_id >= '1999-01' THEN 'c' ELSE '' END || ypc AS ypc,
    CASE WHEN batch_id >= '1997-01' THEN cgr END AS cgr
  FROM premiums
)
SELECT batch_id, COUNT(*) AS record_count, SUM(territory)::BIGINT AS territories, MIN(ypc) AS least_ypc, MAX(ypc) AS most_ypc,
  CAST(SUM(current_premium) AS DECIMAL(38,4)) AS total_premium, COUNT(cgr) AS cgr_populated
FROM typed GROUP BY batch_id
"""

#: Not over the premiums: taken as they are.
PLAIN = {
    "csv_quoted_scan": """
SELECT doc_id, lang, source, length(nullif(text, ''))::BIGINT AS n_chars, md5(nullif(text, '')) AS text_md5, false AS is_bad
FROM documents
""",
}

SQL = {
    "ingest_to_gold": """
SELECT county, town, gender, COUNT(*) AS record_count, COUNT(NULLIF(birthdate, '')) AS birthdates,
  CAST(SUM(current_premium) AS DECIMAL(38,4)) AS total_premium, SUM(ypc)::BIGINT AS claims, MAX(acs03_total_population) AS population
FROM fact_current GROUP BY county, town, gender
""",
    "schema_widen": _BATCHES,
    "catalog_evolved": _BATCHES,
    "daily_counts_live": """
SELECT CAST(ingested_at AS DATE) AS ingestion_date, COUNT(*) AS record_count FROM fact_legacy GROUP BY 1
""",
    "distinct_sketches": """
WITH named AS (
  SELECT territory_label, 'birthdate' AS name, birthdate AS value FROM fact_legacy
  UNION ALL SELECT territory_label, 'zipcode', zipcode FROM fact_legacy
  UNION ALL SELECT territory_label, 'current_premium', CAST(current_premium AS VARCHAR) FROM fact_legacy
)
SELECT territory_label, name, COUNT(value) AS n_values, COUNT(DISTINCT value) AS n_exact, true AS within FROM named GROUP BY territory_label, name
""",
}
