"""Reading members of a JSON record held as a variant."""

from pyspark.sql import Column, functions as F

from tidemark.schema import KEY_MEMBER, REFRESH_MEMBER, Field

# Texts of the non-string JSON values that do not count as a key (zero, false, empty containers).
_EMPTY_NON_STRINGS = ("0", "0.0", "-0.0", "false", "[]", "{}")


def member_text(raw: Column, member: str) -> Column:
    """The member as text; NULL when it is missing, JSON null or the empty string."""
    return F.nullif(F.variant_get(raw, f"$.{member}", "string"), F.lit(""))


def member_texts(raw: Column, members: list[str]) -> Column:
    """All the members as one struct of texts, read in one pass over the record."""
    fields = ", ".join(f"`{m}`: string" for m in members)
    return F.variant_get(raw, "$", f"struct<{fields}>")


def typed(text: Column, field: Field, strict: bool = True) -> Column:
    """A member's text cast to its column type; a bad value raises, or is NULL if not strict."""
    return text.cast(field.type) if strict else text.try_cast(field.type)


def usable_key(raw: Column) -> Column:
    """The record key as text; NULL when it is missing or empty in the JSON sense."""
    text = member_text(raw, KEY_MEMBER)
    kind = F.schema_of_variant(F.variant_get(raw, f"$.{KEY_MEMBER}", "variant"))
    return F.when((kind == "STRING") | ~text.isin(*_EMPTY_NON_STRINGS), text)


def refresh_instant(raw: Column, strict: bool = True) -> Column:
    """The refresh instant of a record, NULL when missing or empty; text that is none raises, or is NULL if not strict."""
    text = member_text(raw, REFRESH_MEMBER)
    return text.cast("timestamp") if strict else text.try_cast("timestamp")
