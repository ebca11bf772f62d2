"""Independent DuckDB SQL for every catalogue key (the correctness oracle)."""

from __future__ import annotations

from actuaria.oracle.prelude import with_prelude
from actuaria.oracle.ingest_sql import PLAIN as _PLAIN
from actuaria.oracle.ingest_sql import SQL as _INGEST
from actuaria.oracle.monitoring_sql import SQL as _MON
from actuaria.oracle.quality_sql import SQL as _DQ
from actuaria.oracle.reporting_sql import SQL as _RPT
from actuaria.oracle.stakeholder_sql import SQL as _STK


_TABLES = {
    "fact_current": "SELECT * FROM fact_current",
    "fact_legacy": "SELECT * FROM fact_legacy",
    "latest_batch": "SELECT * FROM premiums WHERE batch_id = (SELECT MAX(batch_id) FROM premiums)",
    "schema_union": """
SELECT batch_id, COUNT(*) AS record_count,
  COUNT(CASE WHEN batch_id >= '1998-01' THEN cgr END) AS cgr_populated,
  COUNT(CASE WHEN batch_id >= '1998-01' THEN cgr_factor END) AS cgr_factor_populated
FROM premiums
GROUP BY batch_id
""",
}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = dict(_PLAIN)
    for part in (_RPT, _DQ, _MON, _STK, _TABLES, _INGEST):
        for key, text in part.items():
            out[key] = with_prelude(text)
    return out
