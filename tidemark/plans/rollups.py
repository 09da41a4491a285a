"""Stored rollups that follow the flat table: what came is added, what was replaced is taken away.

    <root>/rollups/version=<n>/rollup=<name>/*.parquet

A stored rollup belongs to one version. To bring it to a later one, the two commits are compared bucket by bucket. Where only loads
were put on top, their rows are added and the rows at the places they replace are taken away. A bucket that was merged in between is
taken away as it was and added as it is. All other buckets are not read. Sums know from how many values they come, so that a sum
of no values is NULL again, and a group without projects is gone.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.snapshots import PLACE, TABLES, Commit, Snapshots


@dataclass(frozen=True)
class Rollup:
    dimensions: dict[str, Column]
    sums: dict[str, str]  # name of a sum: column of flat


def rollups() -> dict[str, Rollup]:
    """The rollups that are kept, with the columns that ``serve`` gives them."""
    amounts = {"total_obligated": "totalobligated", "federal_share": "federalshare"}
    column = F.col
    return {
        "state_incident": Rollup({"stateabbr": column("stateabbr"), "incidenttype": column("incidenttype")}, amounts),
        "month_state": Rollup({"month": F.trunc("declarationdate", "MM"), "stateabbr": column("stateabbr")}, amounts),
        "status": Rollup(
            {"projectstatus": column("projectstatus"), "projectprocessstep": column("projectprocessstep")}, {"project_amount": "projectamount"}
        ),
        "disaster": Rollup({"disasternumber": column("disasternumber")}, amounts),
    }


def _added(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """Parts of the same groups as one row each. They are reduced in their tasks before the shuffle."""
    sums = [F.sum(c).alias(c) for name in rollup.sums for c in (name, f"n_{name}")]
    return parts.groupBy(*rollup.dimensions).agg(F.sum("projects").alias("projects"), *sums)


def _parts(flat: DataFrame, rollup: Rollup, sign: int) -> DataFrame:
    """What rows of flat contribute, or, with sign -1, what they no longer do."""
    dimensions = [value.alias(name) for name, value in rollup.dimensions.items()]
    values = [
        c
        for name, column in rollup.sums.items()
        for c in (
            (F.col(column) if sign > 0 else -F.col(column)).alias(name),
            F.when(F.col(column).isNotNull(), F.lit(sign)).otherwise(F.lit(0)).cast("long").alias(f"n_{name}"),
        )
    ]
    rows = flat.select(*dimensions, F.lit(sign).cast("long").alias("projects"), *values)
    return _added(rows, rollup).select(*rows.columns)


def _changes(store: Snapshots, old: Commit, new: Commit) -> list[tuple[DataFrame, int]]:
    """Rows of flat with the sign of what they change between two commits."""
    grown, other = {}, []
    for bucket, loads in new.flat.items():
        before = old.flat.get(bucket)
        if before != loads:
            if before and loads[: len(before)] == before:
                grown[bucket] = loads[len(before) :]
            else:
                other.append(bucket)
    other += [b for b in old.flat if b not in new.flat]
    out = []
    if other:
        out += [(store.read("flat", old, other), -1), (store.read("flat", new, other), 1)]
    if grown:
        columns = [*TABLES["flat"].names, "bucket"]
        out.append((store.loads("flat", grown).select(*columns), 1))
        replacing = sorted({x for loads in grown.values() for x in loads} & set(new.late))
        if replacing:
            held = store.loads("flat", {b: new.flat[b] for b in grown}, placed=True)
            # A load's places are at most what a reader may have to leave out, which fits a broadcast.
            out.append((held.join(F.broadcast(store.replaced(replacing)), list(PLACE), "left_semi").select(*columns), -1))
    return out


def _path(store: Snapshots, version: int, name: str) -> str:
    return f"{store.root}/rollups/version={version}/rollup={name}"


def _stored(store: Snapshots, version: int, name: str) -> DataFrame:
    return store.spark.read.parquet(_path(store, version, name))


def stored_versions(store: Snapshots) -> list[int]:
    """Versions whose rollups are all there."""
    done = store.paths("rollups/version=*/rollup=*/_SUCCESS")
    counts: dict[int, int] = {}
    for path in done:
        version = int(path.split("/version=")[1].split("/")[0])
        counts[version] = counts.get(version, 0) + 1
    return sorted(v for v, n in counts.items() if n == len(rollups()))


def refresh(store: Snapshots) -> int:
    """Bring the stored rollups to the newest version, from the newest stored one if there is one; returns that version."""
    head = store.head()
    known = [v for v in stored_versions(store) if v <= head.version]
    if known and known[-1] == head.version:
        return head.version
    base = store.commit(known[-1]) if known else None
    changes = [(store.flat(head), 1)] if base is None else _changes(store, base, head)
    for name, rollup in rollups().items():
        parts = [_parts(rows, rollup, sign) for rows, sign in changes]
        if base is not None:
            parts.append(_stored(store, base.version, name))
        if not parts:
            parts = [_parts(store.flat(head), rollup, 1)]
        # Groups are few beside the rows; a small result is one file.
        kept = _added(reduce(DataFrame.unionByName, parts), rollup).where("projects > 0")
        kept.write.mode("overwrite").parquet(_path(store, head.version, name))
    return head.version


def rollup(store: Snapshots, name: str) -> DataFrame:
    """A rollup of the newest version, brought up to date first."""
    kept = rollups()[name]
    sums = [F.when(F.col(f"n_{x}") > 0, F.col(x)).alias(x) for x in kept.sums]
    return _stored(store, refresh(store), name).select(*kept.dimensions, "projects", *sums)
