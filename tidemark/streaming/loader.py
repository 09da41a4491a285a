"""The load cycle as a stream: every micro-batch of new page files is one published version."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.landing import ARRIVAL
from tidemark.plans.cycle import ingest, publish, sync
from tidemark.plans.snapshots import Commit, Snapshots
from tidemark.sources.pages import in_sequence, page_stream, unwrap


def apply_batch(
    store: Snapshots,
    records: DataFrame,
    stream: str,
    batch_id: int,
    policy: str = ARRIVAL,
    null_is_oldest: bool = False,
    strict: bool = True,
    landing_first: bool = False,
) -> Commit:
    """Apply one micro-batch. A batch the head already holds is not upserted again.

    ``stream`` names the query that counts the batches. The commit row carries the batch id, so tables
    and progress move together: whatever fails before the publish is redone from the
    checkpoint, whatever was published is skipped.
    """
    head = before = commit = store.head()
    counts: dict[str, int] = {}
    new = None
    if commit.streams.get(stream, -1) < batch_id:
        commit, counts, new = ingest(store, head, records, policy, strict)
        commit = replace(commit, streams={**commit.streams, stream: batch_id})
        if landing_first:
            head = commit = publish(store, head, commit, counts)
            counts = {}
    commit, changed = sync(store, commit, null_is_oldest, strict, before, new)
    return publish(store, head, commit, {**counts, **changed})


def start_stream(
    store: Snapshots,
    pages: str,
    checkpoint: str,
    every: str | None = None,
    per_line: bool = False,
    files_per_batch: int | None = None,
    by_name: bool = False,
    **options,
) -> StreamingQuery:
    """Load new page files: once up to the present, or ``every`` interval (e.g. "24 hours").

    Batches take files by landing time; the order inside a batch is that of ``in_sequence``. Progress is
    kept under the query's own id, which a new checkpoint gets anew, whatever its path.
    ``options`` are those of ``apply_batch``.
    """
    pages_ = page_stream(store.spark, pages, per_line, files_per_batch)
    return _started(store, pages_, lambda batch: in_sequence(batch, per_line, by_name), checkpoint, every, options)


def start_source_stream(
    store: Snapshots, source: str, checkpoint: str, every: str | None = None, settings: dict | None = None, **options
) -> StreamingQuery:
    """Load what is refreshed in a registered paged source: once up to the present, or ``every`` interval.

    The checkpoint keeps the mark. ``settings`` are options of the source, ``options`` those of ``apply_batch``.
    """
    pages = store.spark.readStream.format(source).options(**(settings or {})).load()
    return _started(store, pages, lambda batch: batch, checkpoint, every, options)


def _started(store: Snapshots, pages: DataFrame, ordered, checkpoint: str, every: str | None, options: dict) -> StreamingQuery:
    names: list[str] = []

    def step(batch: DataFrame, batch_id: int) -> None:
        if not names:
            names.append(store.spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id)
        apply_batch(store, unwrap(ordered(batch), strict=options.get("strict", True)), names[0], batch_id, **options)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).start()
