"""File order along a space-filling curve, so that ranges of several columns skip pages, each column by itself.

A row's value in each column becomes its rank among quantiles of a sample. The ranks of ``HEAD`` come first; those of ``TURNS``
are interleaved bit by bit, and rows lie in the order of the reflected Gray code of these bits: from one cell of the
curve to the next a single bit changes, so a page on a border is wide in one column only. The quantiles decide where
rows lie, never which rows there are.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Columns of flat and bits of their ranks. The first one is looked up most, its ranges stay whole.
HEAD = {"stateabbr": 5}
TURNS = {"declarationdate": 4, "incidenttype": 4, "totalobligated": 4}

#: Expected rows of a sample: some hundred for each range of the finest column.
SAMPLE = 8192

Edges = dict[str, list]


def sampled(rows: DataFrame, n_rows: int, key: str = "hash") -> DataFrame:
    """About ``SAMPLE`` of the rows, by the hash of their key, so that a repeated write orders them alike."""
    share = 1 << 32 if n_rows <= SAMPLE else SAMPLE * (1 << 32) // n_rows
    return rows.where(F.shiftrightunsigned(F.xxhash64(F.lit("curve"), key), 32) < F.lit(share))


def edges(sample: DataFrame) -> Edges:
    """Quantiles of each column: where the ranks go up. A frequent value counts as often as it is one."""
    found = sample.select(*HEAD, *TURNS).collect()
    out = {}
    for column, bits in {**HEAD, **TURNS}.items():
        values = sorted(r[column] for r in found if r[column] is not None)
        n = 1 << bits
        out[column] = [values[k * len(values) // n] for k in range(1, n)] if values else []
    return out


def _rank(column: str, values: list, kind: T.DataType) -> Column:
    """Edges at or below the value; 0 where it is unknown."""
    rank = F.lit(0)
    for value in dict.fromkeys(values):
        rank = rank + F.when(F.col(column) >= F.lit(value).cast(kind), F.lit(values.count(value))).otherwise(0)
    return rank


def along(rows: DataFrame, found: Edges, name: str) -> DataFrame:
    """Add each row's place on the curve as a column."""
    ranks = {c: _rank(c, found[c], rows.schema[c].dataType) for c in found}
    head, code = F.lit(0), F.lit(0)
    for column in HEAD:
        head = head * F.lit(1 << HEAD[column]) + ranks[column]
    turns = [(c, bit) for level in range(max(TURNS.values())) for c, bits in TURNS.items() if (bit := bits - 1 - level) >= 0]
    for column, bit in turns:
        code = code * F.lit(2) + F.shiftright(f"{name}_{column}", bit).bitwiseAND(F.lit(1))
    rows = rows.select("*", head.alias(f"{name}_head"), *(ranks[c].alias(f"{name}_{c}") for c in TURNS))
    rows = rows.select("*", code.alias(f"{name}_code"))
    place = F.col(f"{name}_head")
    for bit in reversed(range(len(turns))):
        # The parity of a bit and those above it undoes the Gray code.
        place = place * F.lit(2) + F.bit_count(F.shiftright(f"{name}_code", bit)).bitwiseAND(F.lit(1))
    rows = rows.withColumn(name, place)
    return rows.drop(f"{name}_head", f"{name}_code", *(f"{name}_{c}" for c in TURNS))
