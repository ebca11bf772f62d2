"""Fixed values that results must reproduce exactly.

Everything in this module is a literal taken from the query catalogue's
semantics: status texts (with their emoji and double spaces), thresholds,
bucket labels and the reproducible clock.  Keep them together and in the
order the catalogue uses them; the oracle SQL formats the same constants.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# The reproducible clock used instead of NOW()/CURRENT_DATE.
# ---------------------------------------------------------------------------
AS_OF = _dt.datetime(2001, 11, 4, 12, 0, 0)

# ---------------------------------------------------------------------------
# Status strings (emoji and spacing are part of the value).
# ---------------------------------------------------------------------------
NULL_PASS = "✅ PASS - No NULLs"
NULL_WARN = "⚠️  WARNING - <5% NULLs"
NULL_FAIL = "🚨 FAIL - >5% NULLs"

CRITICAL_PASS = "✅ PASS"
CRITICAL_FAIL = "🚨 FAIL - Critical fields have NULLs"

FINGERPRINT_PASS = "✅ PASS - No exact duplicates"
FINGERPRINT_FAIL = "🚨 FAIL - Exact duplicates found"

DUP_ROW_FLAG = "⚠️  DUPLICATE"
DUP_ROW_OK = "✅ OK"

KEY_DUP_PASS = "✅ PASS - No key duplicates"
KEY_DUP_WARN = "⚠️  WARNING - <0.1% duplicates"
KEY_DUP_FAIL = "🚨 FAIL - >0.1% duplicates"

SILVER_DUP_PASS = "✅ PASS"
SILVER_DUP_CHECK = "⚠️  Check source data"

MATCH_PASS = "✅ PASS"
MATCH_WARN = "⚠️  WARNING"
MATCH_FAIL = "🚨 FAIL"

DATE_PASS = "✅ PASS"
DATE_BAD = "⚠️  Invalid dates detected"

BATCH_PASS = "✅ PASS"
BATCH_WARN = "⚠️  WARNING - Small batch"
BATCH_FAIL = "🚨 FAIL - Minimal records"

CV_PASS = "✅ PASS - Consistent batches"
CV_WARN = "⚠️  WARNING - Some variation"
CV_FAIL = "🚨 FAIL - Inconsistent batch sizes"

GRADE_EXCELLENT = "🟢 EXCELLENT"
GRADE_GOOD = "🟡 GOOD"
GRADE_FAIR = "🟠 FAIR"
GRADE_POOR = "🔴 POOR"

FRESH_TODAY = "Fresh (Today)"
FRESH_YESTERDAY = "Fresh (Yesterday)"
FRESH_STALE = "Stale"

ALERT_GENDER_PREFIX = "🚨 ALERT: Gender completeness dropped to "
ALERT_DUPES_PREFIX = "🚨 ALERT: "
ALERT_DUPES_SUFFIX = " duplicate records detected"
ALERT_STALE = "⚠️  WARNING: Data is stale (>24 hours)"
ALERT_NOMINAL = "✅ All systems nominal"

HEALTH_OK = "✅ HEALTHY"
HEALTH_CHECK = "⚠️ CHECK"

PIPELINE_STALE = "🚨 ALERT: Pipeline not run in 24 hours!"
PIPELINE_RECENT = "✅ Pipeline ran recently"

GENDER_LOW = "⚠️  WARNING: Gender completeness below 95%"
GENDER_OK = "✅ Gender data quality OK"

# ---------------------------------------------------------------------------
# Thresholds.
# ---------------------------------------------------------------------------
NULL_WARN_PCT = 5
DUP_WARN_PCT = 0.1
MATCH_PASS_PCT = 99
MATCH_WARN_PCT = 95
BATCH_PASS_ROWS = 1000
BATCH_WARN_ROWS = 100
CV_PASS_MAX = 0.1
CV_WARN_MAX = 0.2
SCORE_PASS = 90
GRADE_EXCELLENT_MIN = 95
GRADE_GOOD_MIN = 85
GRADE_FAIR_MIN = 75
GENDER_ALERT_PCT = 95
DUP_ALERT_GROUPS = 1000
HEALTHY_MIN_ROWS = 95000
BIRTH_MIN = "1920-01-01"
ADULT_YEARS = 18

# ---------------------------------------------------------------------------
# Bucket edges and labels (label, upper bound exclusive).
# ---------------------------------------------------------------------------
MEDIAN_AGE_BANDS = [("Under 30", 30), ("30-40", 40), ("40-50", 50), ("50-60", 60)]
MEDIAN_AGE_REST = "60+"

HOLDER_AGE_BANDS = [("18-25", 25), ("25-35", 35), ("35-45", 45), ("45-55", 55), ("55-65", 65)]
HOLDER_AGE_REST = "65+"
HOLDER_AGE_MIN = 18
HOLDER_AGE_MAX = 100

CLAIM_BUCKETS = [("No Claims", 0), ("1 Claim", 1), ("2 Claims", 2), ("3 Claims", 3)]
CLAIM_BUCKET_REST = ("4+ Claims", 4)

VARIANCE_BANDS = [
    ("Discount >20%", -20),
    ("Discount 10-20%", -10),
    ("Discount 0-10%", 0),
    ("Markup 0-10%", 10),
    ("Markup 10-20%", 20),
]
VARIANCE_REST = "Markup >20%"

PROFIT_TIERS = [("Highly Profitable", 0.75), ("Profitable", 1.0), ("Acceptable Risk", 1.25)]
PROFIT_TIER_REST = "Loss-Making"

UNKNOWN_TERRITORY = "Unknown"
