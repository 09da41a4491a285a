"""Page files and JSON lines as records ``(rec VARIANT, ord)``.

``ord`` carries the arrival order as data, because Spark reads files in parallel. A page is
bounded by the source's page cap, so one row per page is safe; a dump without that bound comes
as lines (of pages or of single records), which Spark splits inside a file.
"""

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.schema import ENVELOPE_KEY
from tidemark.session import written
from tidemark.sources.paging import incremental


# Names that Spark gives the files of one write: number of the task, the write's id, number of the file.
_SPARK_PART = r"^part-(\d+)-.*-c(\d+)"

_FILE = "struct<begun: timestamp, landed: timestamp, series: string, place: array<bigint>>"


def _place(name: Column) -> tuple[Column, Column]:
    """The series a file belongs to and its place there: 12 for page-000012.json, -1 for a name without a number.

    The place is the last number of a name, or task and file number of a file that Spark wrote. What
    is left of the name is the series, so the files of one write, or of one day, are one series.
    """
    by_spark = name.rlike(_SPARK_PART)
    digits = F.regexp_extract(name, r"(\d+)\D*$", 1)
    number = F.when(digits != "", digits.cast("long")).otherwise(F.lit(-1))
    places = [F.regexp_extract(name, _SPARK_PART, k).cast("long") for k in (1, 2)]
    place = F.when(by_spark, F.array(*places)).otherwise(F.array(number))
    spark_rest = F.regexp_replace(name, r"^part-\d+-(.*)-c\d+", "$1")
    return F.when(by_spark, spark_rest).otherwise(F.regexp_replace(name, r"\d+(\D*)$", "$1")), place


def _landed(files: DataFrame) -> DataFrame:
    series, place = _place(F.col("_metadata.file_name"))
    return files.select(
        series.alias("series"),
        place.alias("place"),
        F.col("_metadata.file_modification_time").alias("landed"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        "value",
    )


def _ordered(files: DataFrame, by_name: bool) -> DataFrame:
    """``(series, place, file)``: an order over files, which raises where there is none."""
    path = Window.partitionBy("series", "place")
    twins = F.when(F.min("path").over(path) != F.max("path").over(path), F.concat_ws(" and ", F.min("path").over(path), F.max("path").over(path)))
    if by_name:
        file = F.struct(F.lit(None).cast("timestamp").alias("begun"), F.lit(None).cast("timestamp").alias("landed"), "series", "place")
        return files.select("series", "place", file.alias("file"), twins.alias("tied"))
    # Series that overlap in time make a group: a new one begins after all before it have ended. One short row per series.
    before = Window.orderBy("begun", "series").rowsBetween(Window.unboundedPreceding, -1)
    series = files.groupBy("series").agg(F.min("landed").alias("begun"), F.max("landed").alias("ended"))
    ended = F.max("ended").over(before)
    apart = series.withColumn("first", F.when(ended.isNull() | (F.col("begun") > ended), F.col("begun")))
    group = apart.withColumn("group", F.max("first").over(Window.orderBy("begun", "series")))
    alone = F.count(F.lit(1)).over(Window.partitionBy("group")) == 1
    known = files.join(group.select("series", "group", alone.alias("alone")), "series")
    # Within a group files come as they landed; a series of its own may land in any order and comes by place.
    landed = F.when(~F.col("alone"), F.col("landed"))
    at_once = Window.partitionBy("group", "landed")
    in_place = Window.partitionBy("series").orderBy("place")
    unclear = F.when(
        ~F.col("alone") & (F.min("series").over(at_once) != F.max("series").over(at_once)),
        F.concat_ws(" and ", F.min("path").over(at_once), F.max("path").over(at_once)),
    ).when(~F.col("alone") & (F.lag("landed").over(in_place) > F.col("landed")), F.concat_ws(" and ", F.lag("path").over(in_place), F.col("path")))
    file = F.struct(F.col("group").alias("begun"), landed.alias("landed"), "series", "place")
    return known.select("series", "place", file.alias("file"), F.coalesce(twins, unclear).alias("tied"))


def in_sequence(landed: DataFrame, per_line: bool = False, by_name: bool = False) -> DataFrame:
    """Rows of a text scan as pages ``(page_seq, value)``; blank lines are no pages.

    Series come in the order in which they landed, and files by their place in the series. Files of series that overlap in time
    come as they landed, which is how a stream meets them. Two files with one place in one series, files of
    different series that landed at one instant, and a file that overlaps another series and landed before its own predecessor
    have no order, which is an error. ``by_name`` orders series by their names instead, whenever they landed.
    One short row per series, and one per file, is all that this needs to know beforehand.
    """
    files = landed.groupBy("series", "place", "path").agg(F.min("landed").alias("landed"))
    nameless = F.when(F.element_at("place", 1) < 0, F.concat(F.lit("page file name carries no sequence number: "), "series"))
    message = F.coalesce(nameless, F.concat(F.lit("files without an order between them: "), F.col("tied")))
    # Written, so that its size is known: it is sent to where the pages are read if it fits the broadcast limit.
    order = written(_ordered(files, by_name).select("series", "place", "file", message.alias("message")).distinct(), "order")
    checked = F.when(F.col("message").isNull(), F.col("file")).otherwise(F.raise_error(F.col("message")).cast(_FILE))
    order = order.select("series", "place", checked.alias("file"))
    # The generated id only ever compares lines of one split of one file, where it grows with the line.
    lines = landed.drop("landed").withColumn("line", F.monotonically_increasing_id() if per_line else F.lit(0))
    known = lines.join(order, ["series", "place"])
    if not per_line:
        return known.select(F.col("file").alias("page_seq"), "value")
    return known.select(F.struct("file", "split_start", "line").alias("page_seq"), "value").where(F.trim("value") != "")


def read_pages(
    spark: SparkSession, path: str, per_line: bool = False, modified_after: str | None = None, by_name: bool = False
) -> DataFrame:
    """Landed pages as ``(page_seq, value)``: one page per file, or one per line of a file.

    ``modified_after`` (UTC) skips files landed before an instant without opening them.
    """
    reader = spark.read.format("text").option("wholetext", not per_line)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return in_sequence(_landed(reader.load(path)), per_line, by_name)


def page_folder(
    spark: SparkSession, path: str, per_line: bool = False, slack: timedelta | None = None, strict: bool = True, by_name: bool = False
) -> Callable[[datetime | None], DataFrame]:
    """A folder of landed pages as the source of a load cycle; every file is opened.

    With ``slack``, files that landed longer than that before the mark are skipped. Give it only
    where every record lands after its refresh, by clocks that differ by less, and where copies
    of files get new times: a record in a skipped file is never loaded.
    """

    def since(mark: datetime | None) -> DataFrame:
        if mark is None:
            return unwrap(read_pages(spark, path, per_line, by_name=by_name), strict=strict)
        landed = None if slack is None else (mark - slack).strftime("%Y-%m-%dT%H:%M:%S")
        return incremental(unwrap(read_pages(spark, path, per_line, landed, by_name), strict=strict), mark, strict)

    return since


def page_stream(
    spark: SparkSession, path: str, per_line: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """The landed text as an unbounded stream; give each micro-batch to ``in_sequence``."""
    reader = spark.readStream.format("text").option("wholetext", not per_line)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _landed(reader.load(path))


def _parsed(value: str, strict: bool) -> Column:
    return F.parse_json(value) if strict else F.try_parse_json(value)


def unwrap(pages: DataFrame, key: str = ENVELOPE_KEY, strict: bool = True) -> DataFrame:
    """Records of each page, from the array under ``key`` or from a bare array.

    A page without that member gives no records. A page that is not JSON raises, or gives none if not
    strict; ``checks.unparsable`` lists it.
    """
    records = F.coalesce(
        F.try_variant_get("body", f"$.{key}", "array<variant>"),
        F.try_variant_get("body", "$", "array<variant>"),
    )
    bodies = pages.select("page_seq", _parsed("value", strict).alias("body"))
    return bodies.select("page_seq", F.posexplode(records).alias("pos", "rec")).select(
        "rec", F.struct("page_seq", "pos").alias("ord")
    )


def parse_records(texts: DataFrame, ord_column: str, strict: bool = True) -> DataFrame:
    """Rows with one JSON record in ``value`` to records ``(rec, ord)``; a text that is not JSON raises, or is left out.

    The one-element explode keeps later filters above the parse; pushed below it, a filter on
    a member would parse every text a second time.
    """
    parsed = F.array_compact(F.array(_parsed("value", strict)))
    return texts.select(F.explode(parsed).alias("rec"), F.col(ord_column).alias("ord"))


def read_lines(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """JSON-lines files, one record per line, split across tasks inside each file."""
    return parse_records(in_sequence(_landed(spark.read.text(path)), per_line=True), "page_seq", strict)
