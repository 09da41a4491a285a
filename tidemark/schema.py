"""The two table schemas and the field map that drives flattening."""

from typing import NamedTuple

from pyspark.sql import SparkSession, types as T


class Field(NamedTuple):
    source: str  # member of the JSON record
    column: str  # column of the flat table
    type: T.DataType


# NUMERIC without precision is stored as decimal(38,10): 28 integer and 10 fraction digits.
AMOUNT = T.DecimalType(38, 10)

# Member names, column names and types of the source and of the flat table.
ENVELOPE_KEY = "PublicAssistanceFundedProjectsDetails"
KEY_MEMBER = "hash"
REFRESH_MEMBER = "lastRefresh"
PAGE_CAP = 1000
FIELD_MAP = (
    Field("disasterNumber", "disasternumber", T.ShortType()),
    Field("declarationDate", "declarationdate", T.DateType()),
    Field("incidentType", "incidenttype", T.StringType()),
    Field("pwNumber", "pwnumber", T.IntegerType()),
    Field("applicationTitle", "applicationtitle", T.StringType()),
    Field("applicantId", "applicantid", T.StringType()),
    Field("damageCategoryCode", "damagecategorycode", T.StringType()),
    Field("damageCategoryDescrip", "damagecategorydesc", T.StringType()),
    Field("projectStatus", "projectstatus", T.StringType()),
    Field("projectProcessStep", "projectprocessstep", T.StringType()),
    Field("projectSize", "projectsize", T.StringType()),
    Field("county", "county", T.StringType()),
    Field("countyCode", "countycode", T.StringType()),
    Field("stateAbbreviation", "stateabbr", T.StringType()),
    Field("stateNumberCode", "statenumbercode", T.StringType()),
    Field("projectAmount", "projectamount", AMOUNT),
    Field("federalShareObligated", "federalshare", AMOUNT),
    Field("totalObligated", "totalobligated", AMOUNT),
    Field("lastObligationDate", "lastobligation", T.TimestampType()),
    Field("firstObligationDate", "firstobligation", T.TimestampType()),
    Field("mitigationAmount", "mitigationamount", AMOUNT),
    Field("gmProjectId", "gmprojectid", T.LongType()),
    Field("gmApplicantId", "gmapplicantid", T.LongType()),
)

LANDING_SCHEMA = T.StructType(
    [
        T.StructField("hash", T.StringType()),
        T.StructField("raw", T.VariantType()),
        T.StructField("lastrefresh", T.TimestampType()),
    ]
)

FLAT_SCHEMA = T.StructType(
    [T.StructField("hash", T.StringType()), T.StructField("lastrefresh", T.TimestampType())]
    + [T.StructField(f.column, f.type) for f in FIELD_MAP]
    + [T.StructField("raw", T.VariantType())]
)

LANDING_COMMENT = "Landing: raw JSON record and refresh instant, one row per hash."
FLAT_COMMENT = "Flat: typed columns derived from landing by the sync, one row per hash."


def create_tables(spark: SparkSession, landing: str, flat: str) -> None:
    """Create both typed tables in the session catalog unless they exist."""
    for name, schema, comment in (
        (landing, LANDING_SCHEMA, LANDING_COMMENT),
        (flat, FLAT_SCHEMA, FLAT_COMMENT),
    ):
        required = {"raw": " NOT NULL"}
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{required.get(f.name, '')}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet COMMENT '{comment}'")
