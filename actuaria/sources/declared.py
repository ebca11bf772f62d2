"""Declared column types of the source files (S3, S18), by role.

Money is decimal, so sums over ingested data are exact.  Columns that a file has
beyond these stay text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 4)


def _schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


PREMIUMS = _schema(
    territory=T.IntegerType(), gender=T.StringType(), birthdate=T.StringType(), ypc=T.IntegerType(), current_premium=_MONEY,
    indicated_premium=_MONEY, selected_premium=_MONEY, underlying_premium=_MONEY, fixed_expenses=_MONEY,
    underlying_total_premium=_MONEY, cgr_factor=T.DecimalType(5, 2), cgr=T.StringType(),
)
TERRITORY = _schema(
    county=T.StringType(), county_code=T.LongType(), territory=T.LongType(), zipcode=T.LongType(), town=T.StringType(), area=T.LongType()
)
DP03 = T.StructType([
    T.StructField("GEO.id2", T.StringType()), T.StructField("HC01_VC03", T.LongType()),
    T.StructField("HC01_VC04", T.DoubleType()), T.StructField("HC01_VC05", T.DoubleType()),
])
DP05 = T.StructType([
    T.StructField("GEO.id2", T.StringType()), T.StructField("HC01_VC03", T.LongType()), T.StructField("HC01_VC04", T.LongType()),
])
BY_ROLE = {"dp03": DP03, "dp05": DP05, "territory": TERRITORY, "premiums": PREMIUMS}


def schemas_for(datasets: Iterable[str]) -> dict[str, T.StructType]:
    """The declared schema of each dataset whose name holds a role's word (CGR files have none)."""
    found = {}
    for name in datasets:
        role = next((r for r in BY_ROLE if r in name.lower() and "cgr" not in name.lower()), None)
        if role:
            found[name] = BY_ROLE[role]
    return found
