"""Explicit schemas for every source; nothing is inferred."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, BOOLEAN = T.StringType(), T.BooleanType()

RAW_RECORD = _struct(
    ("refYear", INT),
    ("refMonth", INT),
    ("reporterCode", INT),
    ("partnerCode", INT),
    ("partner2Code", INT),
    ("netWgt", DOUBLE),
    ("primaryValue", DOUBLE),
    ("isNetWgtEstimated", BOOLEAN),
    ("motCode", INT),
    ("customsCode", STRING),
    ("flowCode", STRING),
    ("cmdCode", STRING),
)

FLOW_ENVELOPE = _struct(("count", LONG), ("data", T.ArrayType(RAW_RECORD)))

PARTNER_AREA = _struct(
    ("PartnerCode", INT),
    ("PartnerDesc", STRING),
    ("PartnerCodeIsoAlpha2", STRING),
    ("PartnerCodeIsoAlpha3", STRING),
)

PARTNER_ENVELOPE = _struct(("results", T.ArrayType(PARTNER_AREA)))

PRICE_POINT = _struct(("period", STRING), ("value", DOUBLE))

PRICE_ENVELOPE = _struct(("response", _struct(("data", T.ArrayType(PRICE_POINT)))))

PARTNER_DIM = _struct(
    ("partnerCode", INT),
    ("partnerName", STRING),
    ("iso2", STRING),
    ("iso3", STRING),
    ("is_special_partner", BOOLEAN),
)

# reporterName holds an ISO3 code, as in the published tables.
REPORTER_DIM = _struct(("reporterCode", INT), ("reporterName", STRING))

DISTANCE_DIM = _struct(
    ("partnerName", STRING),
    ("port", STRING),
    ("nm_to_rotterdam", INT),
    ("confidence", STRING),
)

FLOWS = _struct(
    ("refYear", INT),
    ("refMonth", INT),
    ("reporterCode", INT),
    ("reporterName", STRING),
    ("partnerCode", INT),
    ("partnerName", STRING),
    ("iso2", STRING),
    ("iso3", STRING),
    ("is_special_partner", BOOLEAN),
    ("netWgt", DOUBLE),
    ("primaryValue", DOUBLE),
    ("isNetWgtEstimated", BOOLEAN),
)

MARKET_SHARES = _struct(
    ("refYear", INT),
    ("refMonth", INT),
    ("origin", STRING),
    ("tonnes", DOUBLE),
    ("share_pct", DOUBLE),
)
