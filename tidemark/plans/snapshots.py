"""Versioned landing and flat tables, published together by one commit row.

Both tables are Parquet, split by a hash bucket of the key. A load writes into folders of its own; a
commit row then names, for every bucket of both tables, the loads that hold it. Readers go through
the newest commit, so they see either the whole cycle or nothing of it, and a failed load leaves
only folders that no commit names. A bucket is a base load and the few loads after it. A later load holds new
and changed rows alone; beside it stands where the rows lie that it replaces, so that readers leave those
out without comparing keys, and rows that did not change are not written again.

    <root>/landing/load=<id>/bucket=<n>/*.parquet
    <root>/flat/load=<id>/bucket=<n>/*.parquet
    <root>/replaced/load=<id>/*.parquet          places of rows in earlier loads
    <root>/counted/load=<id>/*.parquet           rows of landing per bucket and hour of refresh
    <root>/commits/version=<n>/*.parquet         one row

There is one writer at a time; a version that is there already is not written again.
"""

import re
import uuid
from contextlib import nullcontext
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions import from_micros
from tidemark.plans import curve, ranges
from tidemark.schema import FLAT_SCHEMA, LANDING_SCHEMA
from tidemark.session import CODEC, TASK_ROWS, broadcast_limit, compiled, prepare, shuffles_deleted, small_splits, whole_variants
from tidemark.sources.paging import page, page_size

TABLES = {"landing": LANDING_SCHEMA, "flat": FLAT_SCHEMA}

# Order inside each file, so that row-group statistics prune the common ranges and slices.
LAYOUT = {"landing": ["lastrefresh"], "flat": ["stateabbr", "declarationdate"]}

# Tables whose records are searched by member: their members are stored as columns too.
SEARCHED = {"landing"}

# Columns looked up by value that the file order does not help: Bloom filters say which row groups lack a value.
LOOKED_UP = {"landing": [], "flat": ["disasternumber", "gmprojectid", "gmapplicantid"]}

# Rows that a reader takes or skips at once, inside a row group: few, so that a range of refreshes reads little else. Flat's
# order serves four columns, each of which gets a share of the pages' number only, so its pages are smaller.
PAGE_ROWS = {"landing": 1000, "flat": 250}

# Where a row lies. File names repeat from bucket to bucket.
PLACE = ("bucket", "file", "row")

# Memory of one place in a broadcast: row header, pointers, map slot, the name of the file.
_PLACE_BYTES = 224

_COMMIT_ROW = (
    "version long, buckets int, landing map<int,array<string>>, flat map<int,array<string>>, synced map<int,string>,"
    " marks map<int,timestamp>, streams map<string,long>, counts map<string,long>, total_sent long, late map<string,long>"
)


@dataclass(frozen=True)
class Commit:
    """What one version of the two tables consists of. Maps go from bucket to load id."""

    version: int = 0
    buckets: int = 0
    landing: dict[int, list[str]] = field(default_factory=dict)  # the base load of a bucket and the loads after it
    flat: dict[int, list[str]] = field(default_factory=dict)
    synced: dict[int, str] = field(default_factory=dict)  # newest landing load each flat bucket reflects
    marks: dict[int, datetime] = field(default_factory=dict)  # latest refresh of each landing bucket
    streams: dict[str, int] = field(default_factory=dict)  # last batch applied per stream
    counts: dict[str, int] = field(default_factory=dict)
    total_sent: int = 0  # by this version and all before it
    late: dict[str, int] = field(default_factory=dict)  # rows that each load after a base replaces

    def with_load(self, table: str, buckets: list[int], load: str, replaced: int | None = None) -> "Commit":
        """A load as the new base of its buckets, or, with the number of rows it replaces, on top of what they hold."""
        held = getattr(self, table)
        held = {**held, **{b: [load] if replaced is None else [*held.get(b, []), load] for b in buckets}}
        commit = replace(self, **{table: held}, late=self.late if not replaced else {**self.late, load: replaced})
        above = {x for name in TABLES for loads in getattr(commit, name).values() for x in loads[1:]}
        return replace(commit, late={x: n for x, n in commit.late.items() if x in above})

    def lagging(self) -> list[int]:
        """Buckets whose landing rows changed since flat last looked at them."""
        return sorted(b for b, loads in self.landing.items() if self.synced.get(b) != loads[-1])

    def mark(self) -> datetime | None:
        """The latest refresh in landing."""
        return max(self.marks.values(), default=None)


class ConcurrentPublish(RuntimeError):
    """The version is there already, so another writer is at work."""


class Snapshots:
    """The tables under ``root``.

    ``buckets`` is fixed by the first load. A bucket is what a merge rewrites, so aim
    at one to four gigabytes each: 64 suits a few hundred gigabytes, some 30,000 suit 100 TB.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.buckets = buckets

    # -- reading ---------------------------------------------------------------------------

    def _commits(self, *versions: int) -> DataFrame:
        """Commit rows: of the given versions, or of all."""
        base = f"{self.root}/commits"
        paths = [f"{base}/version={v}" for v in versions] or [base]
        return self.spark.read.schema(_COMMIT_ROW).option("basePath", base).parquet(*paths)

    def versions(self) -> list[int]:
        """Published versions, from the names of their files; none is opened."""
        try:
            files = self._commits().inputFiles()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted({int(re.search(r"/version=(\d+)/", f)[1]) for f in files})

    def paths(self, pattern: str) -> list[str]:
        """Files under the root that match a pattern."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place)
        return [str(f.getPath()) for f in found or []]

    def head(self) -> Commit:
        """The newest commit; an empty one if nothing was ever published."""
        versions = self.versions()
        return self.commit(versions[-1]) if versions else Commit()

    def commit(self, version: int) -> Commit:
        """A published commit."""
        instants = F.transform_values("marks", lambda _, at: F.unix_micros(at))
        row = self._commits(version).withColumn("marks", instants).first().asDict()
        row["marks"] = {b: from_micros(at) for b, at in (row["marks"] or {}).items()}
        return Commit(**{k: v if v is not None else {} for k, v in row.items()})

    def read(self, table: str, commit: Commit | None = None, buckets: list[int] | None = None, placed: bool = False) -> DataFrame:
        """A table as of a commit (default: the newest), optionally only some buckets.

        Only the folders the commit names are listed. The result has a ``bucket`` column and, if ``placed``, the other
        columns of ``PLACE``. Rows of buckets with one load are passed on as they are. Of the others, those that later
        loads replace are left out where they are read; their places fit a broadcast, or the load would have been merged.
        """
        commit = self.head() if commit is None else commit
        held: dict[int, list[str]] = getattr(commit, table)
        wanted = held if buckets is None else {b: held[b] for b in buckets if b in held}
        columns = [*TABLES[table].names, *(PLACE if placed else PLACE[:1])]
        plain = {b: loads for b, loads in wanted.items() if len(loads) == 1}
        rows = self.loads(table, plain, placed).select(*columns)
        layered = {b: loads for b, loads in wanted.items() if len(loads) > 1}
        if not layered:
            return rows
        replacing = sorted({x for loads in layered.values() for x in loads[1:]} & set(commit.late))
        left = self.loads(table, layered, placed or bool(replacing))
        if replacing:
            left = left.join(F.broadcast(self.replaced(replacing)), list(PLACE), "left_anti")
        return rows.unionByName(left.select(*columns)) if plain else left.select(*columns)

    def replaced(self, loads: list[str]) -> DataFrame:
        """The places of rows that the given loads replace."""
        base = f"{self.root}/replaced"
        return self.spark.read.schema("bucket int, file string, row long").parquet(*(f"{base}/load={x}" for x in loads))

    def loads(self, table: str, wanted: dict[int, list[str]], placed: bool = False) -> DataFrame:
        """All rows, also replaced ones, of the given loads of each bucket, with ``bucket`` and, if ``placed``, ``file`` and ``row``."""
        schema = T.StructType([*TABLES[table].fields, T.StructField("bucket", T.IntegerType())])
        base = f"{self.root}/{table}"
        paths = [f"{base}/load={load}/bucket={b}" for b, loads in sorted(wanted.items()) for load in loads]
        if not paths:
            none = self.spark.createDataFrame([], schema)
            return none.selectExpr("*", "'' AS file", "0L AS row") if placed else none
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        if not placed:
            return rows
        return rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))

    def landing(self, commit: Commit | None = None) -> DataFrame:
        return self.read("landing", commit).drop("bucket")

    def flat(self, commit: Commit | None = None) -> DataFrame:
        return self.read("flat", commit).drop("bucket")

    def register_views(self, landing: str = "landing", flat: str = "flat") -> None:
        """Temporary views over the newest commit, for SQL readers."""
        commit = self.head()
        self.landing(commit).createOrReplaceTempView(landing)
        self.flat(commit).createOrReplaceTempView(flat)

    def fill_tables(self, landing: str, flat: str) -> None:
        """Overwrite catalog tables, such as ``create_tables`` makes, with the newest commit."""
        commit = self.head()
        with small_splits(self.spark):
            for name, rows in ((landing, self.landing(commit)), (flat, self.flat(commit))):
                rows.select(*self.spark.table(name).columns).write.insertInto(name, overwrite=True)

    # -- writing ---------------------------------------------------------------------------

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate once and read it back, so that no later step recomputes it.

        Read through the store's own session: a stream hands its batches over in another one.
        """
        path = f"{self.root}/staged/{name}-{uuid.uuid4().hex}"
        with whole_variants(df.sparkSession), shuffles_deleted(df.sparkSession):
            df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write(self, table: str, df: DataFrame, per_bucket: int | None = None, sample: DataFrame | None = None) -> str:
        """Write rows (with a ``bucket`` column) as a new load and return its id.

        With a ``sample`` of them, they lie along the curve that its quantiles give, else in the order of ``LAYOUT`` alone.

        Columns beyond the table's are written too; only ``read_load`` shows them. ``per_bucket`` is about how many rows a
        bucket gets: Bloom filters are made for as many values, or for those of a task's file, where the default is a megabyte each.
        """
        load = uuid.uuid4().hex
        if sample is None:
            rows = df.sortWithinPartitions("bucket", *LAYOUT[table])
        else:
            placed = curve.along(df, curve.edges(sample), "on_curve")
            rows = placed.sortWithinPartitions("bucket", "on_curve", *LAYOUT[table]).drop("on_curve")
        session = df.sparkSession
        with small_splits(session), shuffles_deleted(session), compiled(session), nullcontext() if table in SEARCHED else whole_variants(session):
            writer = rows.write.partitionBy("bucket").option("parquet.page.row.count.limit", PAGE_ROWS[table]).option("compression", CODEC)
            for column in LOOKED_UP[table]:
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                if per_bucket is not None:
                    writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(max(64, min(per_bucket, 2 * TASK_ROWS))))
            writer.parquet(f"{self.root}/{table}/load={load}")
        return load

    def write_replaced(self, load: str, places: DataFrame) -> None:
        """Write where the rows lie that a load replaces; call it before the commit that names the load."""
        places.select(*PLACE).coalesce(1).write.parquet(f"{self.root}/replaced/load={load}")

    def write_counts(self, load: str, rows: DataFrame, replaced: DataFrame | None = None) -> None:
        """Write how many rows of landing a load adds per bucket and hour, less those that it replaces."""
        counted = ranges.counts(rows, ranges.COUNTED["landing"])
        if replaced is not None:
            counted = counted.unionByName(ranges.counts(replaced, ranges.COUNTED["landing"], -1))
        counted.coalesce(1).write.parquet(f"{self.root}/counted/load={load}")

    def counted(self, commit: Commit) -> DataFrame:
        """``(bucket, at, n)`` of the loads that the buckets of landing hold in a commit."""
        loads = {x for held in commit.landing.values() for x in held}
        if not loads:
            return self.spark.createDataFrame([], ranges.SCHEMA)
        base = f"{self.root}/counted"
        rows = self.spark.read.schema(f"{ranges.SCHEMA}, load string").option("basePath", base).parquet(*(f"{base}/load={x}" for x in sorted(loads)))
        held = self._commits(commit.version).select(F.explode("landing").alias("bucket", "loads"))
        return rows.join(held.select("bucket", F.explode("loads").alias("load")), ["bucket", "load"], "left_semi").drop("load")

    def page(self, skip: int, top: int, columns: tuple[str, ...] = ranges.PAGED_BY) -> DataFrame:
        """One page of the newest landing table in the order of refresh and key, with ``position``.

        The counts of the loads say which hours hold it; only those are read and put in order.
        """
        commit = self.head()
        size = page_size(top)
        span = ranges.span(self.counted(commit), skip, size)
        rows = self.landing(commit).select(*dict.fromkeys([*columns, *ranges.PAGED_BY]))
        if span is None:
            return rows.limit(0).withColumn("position", F.lit(0).cast("long")).select(*columns, "position")
        found = page(rows.where(span.holds(ranges.PAGED_BY[0])), skip - span.before, size, list(ranges.PAGED_BY))
        return found.select(*columns, (F.col("position") + span.before).alias("position"))

    def fits_above(self, commit: Commit, rows: int) -> bool:
        """May a load that replaces so many rows go on top of others, or would readers have too much to leave out?"""
        return (rows + sum(commit.late.values())) * _PLACE_BYTES <= broadcast_limit(self.spark)

    def read_load(self, table: str, load: str, schema: T.StructType) -> DataFrame:
        """One load as it was written, whether or not a commit names it."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/load={load}")

    def publish(self, commit: Commit) -> Commit:
        """Make a commit the newest version. Its single row appears in one file, or not at all."""
        if commit.version in self.versions():
            raise ConcurrentPublish(f"version {commit.version} of {self.root} is there already")
        row = tuple(vars(commit).values())
        # What a writer left that failed before its file was there is overwritten.
        rows = self.spark.createDataFrame([row], _COMMIT_ROW).drop("version").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.root}/commits/version={commit.version}")
        return commit

    def history(self) -> DataFrame:
        """One row per version: its counts, and the running total of records sent."""
        commits = self._commits() if self.versions() else self.spark.createDataFrame([], _COMMIT_ROW)
        names = ("sent", "rejected", "distinct_keys", "inserted", "updated")
        counts = [F.coalesce(F.col("counts")[n], F.lit(0).cast("long")).alias(n) for n in names]
        return commits.select("version", *counts, "total_sent")

    def unreferenced(self, keep: int = 2) -> DataFrame:
        """``(table, load)`` of every folder on disk that none of the newest ``keep`` commits names.

        Also what failed cycles left, and staged intermediates. Nothing here deletes data: the caller
        decides when no reader and no running cycle needs those folders.
        """
        commits = self.versions()[-keep:]
        named = self.spark.createDataFrame([], "table string, load string")
        for table, loads in (*((t, F.flatten(F.map_values(t))) for t in TABLES), ("replaced", F.map_keys("late")), ("counted", F.flatten(F.map_values("landing")))):
            if commits:
                named = named.union(self._commits(*commits).select(F.lit(table), F.explode(loads)))
        found = self.spark.createDataFrame([], "table string, load string")
        for table in (*TABLES, "replaced", "counted", "staged"):
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            try:
                paths = files.load(f"{self.root}/{table}").select("path")
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            folder = F.regexp_extract("path", rf"/{table}/(?:load=)?([^/]+)/", 1)
            found = found.union(paths.select(F.lit(table), folder))
        return found.distinct().join(named.distinct(), ["table", "load"], "left_anti")
