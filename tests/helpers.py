import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.schema import ENVELOPE_KEY
from tidemark.sources import parse_records


def utc(*parts) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def records(spark, *rows):
    """Python dicts (or ready JSON text) as records in the given order."""
    texts = [(i, row if isinstance(row, str) else json.dumps(row)) for i, row in enumerate(rows)]
    return parse_records(spark.createDataFrame(texts, "seq long, value string"), "seq")


def page(folder, number: int, *rows, body=None):
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps({ENVELOPE_KEY: list(rows)}) if body is None else body
    (folder / f"page-{number:06d}.json").write_text(text)


def shown(df):
    """Rows as a set of tuples: records as JSON text, instants as ISO text."""
    columns = []
    for f in df.schema:
        kind, value = f.dataType.typeName(), F.col(f.name)
        if kind == "variant":
            value = F.to_json(value)
        elif kind == "timestamp":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        columns.append(value.alias(f.name))
    return {tuple(r) for r in df.select(*columns).collect()}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    """The plan with untruncated scan details."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scanned_rows(df) -> int:
    """Rows that the scans of an executed query gave; what statistics, indexes or filters rule out gives none."""
    df.collect()
    waiting, total = [df._jdf.queryExecution().executedPlan()], 0
    while waiting:
        node = waiting.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if node.nodeName().startswith(("BroadcastExchange", "BroadcastQueryStage")):
            continue
        if not node.children().size() and node.metrics().contains("numOutputRows"):
            total += node.metrics().apply("numOutputRows").value()
        waiting += [node.children().apply(k) for k in range(node.children().size())]
    return total
