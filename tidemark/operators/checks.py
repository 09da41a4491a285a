"""Checks the storage format does not enforce: unique keys, non-null records, castable values."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.schema import FIELD_MAP, REFRESH_MEMBER, Field


def key_violations(table: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return table.groupBy("hash").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_violations(table: DataFrame) -> DataFrame:
    """Rows without a key or without a record."""
    return table.where(F.col("hash").isNull() | F.col("raw").isNull())


def unparsable(texts: DataFrame) -> DataFrame:
    """Pages or lines that are not JSON, whole."""
    return texts.where(F.col("value").isNotNull() & F.try_parse_json("value").isNull())


def _texts(landing: DataFrame, members: list[str]) -> DataFrame:
    """Rows with their members as texts, read in one pass; a record that is no object has none."""
    texts = F.try_variant_get(F.col("raw"), "$", "struct<" + ", ".join(f"`{m}`: string" for m in members) + ">")
    return landing.select("hash", texts.alias("member"))


def _entries(landing: DataFrame, found: list[Column]) -> DataFrame:
    return landing.select("hash", F.explode(F.array_compact(F.array(*found))).alias("bad")).select("hash", "bad.*")


def quarantine(landing: DataFrame) -> DataFrame:
    """Every value that a strict load would refuse: ``(hash, column, value, type)``."""
    found = []
    fields = [f for f in (*FIELD_MAP, Field(REFRESH_MEMBER, "lastrefresh", T.TimestampType())) if not isinstance(f.type, T.StringType)]
    for field in fields:
        text = F.nullif(F.col("member")[field.source], F.lit(""))
        refused = text.isNotNull() & text.try_cast(field.type).isNull()
        entry = F.struct(
            F.lit(field.column).alias("column"),
            text.alias("value"),
            F.lit(field.type.simpleString()).alias("type"),
        )
        found.append(F.when(refused, entry))
    return _entries(_texts(landing, list(dict.fromkeys(f.source for f in fields))), found)


_NUMBER = r"^\s*[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"


def fraction_digits(text: Column) -> Column:
    """Fraction digits that a decimal text's value needs: 12 for 1.5E-11, none for 2.000; NULL if it is no number."""
    whole, fraction, power = (F.regexp_extract(text, _NUMBER, k) for k in (1, 2, 3))
    digits = F.concat(whole, fraction)
    kept = F.rtrim(digits, F.lit("0"))
    exponent = F.coalesce(power.try_cast("int"), F.lit(0))
    needed = F.length(fraction) - exponent - (F.length(digits) - F.length(kept))
    return F.when(text.rlike(_NUMBER) & (digits != ""), F.when(kept == "", 0).otherwise(F.greatest(needed, F.lit(0))))


def _may_need(text: Column, digits: int) -> Column:
    """False only for texts that certainly need no more fraction digits than these: a look at the text, before it is taken apart."""
    point = F.instr(text, ".")
    return text.contains("e") | text.contains("E") | ((point > 0) & (F.length(text) - point > digits))


def rounded_amounts(landing: DataFrame) -> DataFrame:
    """Amounts whose value has more fraction digits than the flat column keeps: ``(hash, column, value)``."""
    found = []
    fields = [f for f in FIELD_MAP if isinstance(f.type, T.DecimalType)]
    for field in fields:
        text = F.nullif(F.col("member")[field.source], F.lit(""))
        entry = F.struct(F.lit(field.column).alias("column"), text.alias("value"))
        found.append(F.when(_may_need(text, field.type.scale) & (fraction_digits(text) > field.type.scale), entry))
    return _entries(_texts(landing, [f.source for f in fields]), found)
