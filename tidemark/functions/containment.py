"""JSON containment: does a record contain every part of a pattern?

An object contains a pattern object if each pattern member is contained in the member of
that name; an array contains a pattern array if each pattern element is contained in some
element; scalars must be equal, and a number never equals a string. A top-level array also
contains a bare scalar that is one of its elements.
"""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F


def _step(name: str) -> str:
    if "'" in name:
        if '"' in name:
            raise ValueError(f"member name mixes both quote marks: {name}")
        return f'["{name}"]'
    return f"['{name}']"


def _kind(value: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _number(value: Column, path: str, number: int | float | Decimal) -> Column:
    # Variant text drops trailing zeros, so equal decimals have equal text; doubles compare as doubles.
    exact = Decimal(str(number))
    digits = format(exact, "f")
    if "." in digits:
        digits = digits.rstrip("0").rstrip(".")
    if exact == 0:
        digits = "0"
    text = F.try_variant_get(value, path, "string")
    kind = _kind(value, path)
    numeric = (kind == "BIGINT") | kind.startswith("DECIMAL")
    as_double = F.try_variant_get(value, path, "double") == F.lit(float(exact))
    return (numeric & (text == digits)) | (kind.isin("DOUBLE", "FLOAT") & as_double)


def _in_some_element(value: Column, path: str, pattern) -> Column:
    return F.exists(F.try_variant_get(value, path, "array<variant>"), lambda item: _matches(item, "$", pattern))


def _matches(value: Column, path: str, pattern) -> Column:
    if pattern is None:
        return F.is_variant_null(F.try_variant_get(value, path, "variant"))
    if isinstance(pattern, bool):
        return (_kind(value, path) == "BOOLEAN") & (F.try_variant_get(value, path, "boolean") == F.lit(pattern))
    if isinstance(pattern, str):
        # The equality comes first: over stored records it is a scan of that one member.
        return (F.try_variant_get(value, path, "string") == F.lit(pattern)) & (_kind(value, path) == "STRING")
    if isinstance(pattern, (int, float, Decimal)):
        return _number(value, path, pattern)
    if isinstance(pattern, dict):
        members = [_matches(value, path + _step(k), v) for k, v in pattern.items()]
        return _all([_kind(value, path).startswith("OBJECT"), *members])
    if isinstance(pattern, (list, tuple)):
        found = [_in_some_element(value, path, p) for p in pattern]
        return _all([_kind(value, path).startswith("ARRAY"), *found])
    raise TypeError(f"not a JSON value: {pattern!r}")


def contains(raw: Column, pattern) -> Column:
    """True where the variant contains the pattern (a Python dict, list or scalar)."""
    whole = _matches(raw, "$", pattern)
    if not isinstance(pattern, (dict, list, tuple)):
        element = _in_some_element(raw, "$", pattern)
        whole = F.coalesce(whole, F.lit(False)) | F.coalesce(element, F.lit(False))
    return F.coalesce(whole, F.lit(False))
