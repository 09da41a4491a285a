"""Operator 10: rules first, then gradient-boosted trees on lexical features of the url.

The urls that a rule decides are the labelled ones; the trees are trained on at most ``TRAIN_ROWS`` of
them, those with the smallest hashes, so the same table always gives the same model. Rates of host
suffixes, first path segments and path endings are counted over all labelled urls, but a labelled url is described by the rates
of other folds than its own, and all urls of a host are one fold. So no url's label is among its own features, and the trees
learn how far rates can be trusted on hosts that no label tells about, which are those they judge. ``held_out_error``
trains without one fold and counts the errors in it, with the rates and without them.

Whole urls are read, however long. NULL urls, and urls without ``://``, have an empty host and path and so no rule; the model judges them by what is left.
With labels of one kind only, that kind is every verdict; without labels it is ``allow``. Repeated rows are
judged alike. Only ``page_id`` and ``url`` are read.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import ready, table
from tidemark.session import written

# The rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Bound of the labelled urls that train the trees.
TRAIN_ROWS = 20_000
TREES, DEPTH = 12, 4
#: Weight of the overall rate in the rates of rare suffixes.
SMOOTHING = 20.0

#: Folds of hosts. The last one is kept aside where the error is measured.
FOLDS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUFFIXES = ("host_end", "host_two", "segment", "ending")
LEXICAL = (
    "url_length", "host_length", "path_length", "host_dots", "host_hyphens", "depth", "digit_ratio", "entropy",
    "n_parameters", "longest_word", "has_fragment", "is_secure", *(f"{s}_share" for s in SUFFIXES),
)
FEATURES = (*LEXICAL, *(f"{s}_rate" for s in SUFFIXES))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _count(text: str, characters: str) -> Column:
    """Characters of a set in a text column: what their removal takes away."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]", ""))


def lexical(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, label`` and the features of the url itself."""
    base = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    base = base.withColumns({"rule": rule, "label": verdict, "u": F.coalesce("url", F.lit(""))})
    shares = (
        "aggregate(array_distinct(split(u, '')), 0D, (a, c) -> if(c = '', a, a - (length(u) - length(replace(u, c, '')))"
        " / length(u) * log2((length(u) - length(replace(u, c, ''))) / length(u))))"
    )
    return base.select(
        "page_id",
        "host",
        "path",
        "rule",
        "label",
        F.xxhash64("u").alias("url_hash"),
        F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int").alias("fold"),
        F.length("u").alias("url_length"),
        F.length("host").alias("host_length"),
        F.length("path").alias("path_length"),
        _count("host", ".").alias("host_dots"),
        _count("host", "-").alias("host_hyphens"),
        _count("path", "/").alias("depth"),
        F.when(F.length("u") > 0, _count("u", "0-9") / F.length("u")).otherwise(0.0).alias("digit_ratio"),
        F.when(F.length("u") > 0, F.expr(shares)).otherwise(0.0).alias("entropy"),
        F.when(F.contains("u", F.lit("?")), 1 + _count("u", "&")).otherwise(0).alias("n_parameters"),
        F.coalesce(F.array_max(F.transform(F.split("u", "[^A-Za-z]+"), F.length)), F.lit(0)).alias("longest_word"),
        F.contains("u", F.lit("#")).cast("int").alias("has_fragment"),
        F.startswith("u", F.lit("https")).cast("int").alias("is_secure"),
        F.substring_index("host", ".", -1).alias("host_end"),
        F.substring_index("host", ".", -2).alias("host_two"),
        F.regexp_extract("path", "^/([^/]*)", 1).alias("segment"),
        F.regexp_extract("path", r"([./][A-Za-z]*)$", 1).alias("ending"),
    )


def _by_fold() -> list[Column]:
    """Labelled and blocked rows, as one array each with a number per fold."""
    labelled, blocked = F.col("label").isNotNull(), F.col("label") == "block"
    return [F.array(*(F.count_if(F.col("fold").eqNullSafe(k) & is_one) for k in range(FOLDS))).alias(name) for name, is_one in (("labelled", labelled), ("blocked", blocked))]


def _of_others(counts: Column) -> Column:
    """The sum over the folds that a row may be described by: all, for a labelled row all but its own."""
    own = F.when(F.col("label").isNotNull(), F.get(counts, F.col("fold"))).otherwise(F.lit(0))
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b) - own


def with_rates(rows: DataFrame) -> DataFrame:
    """Add, for each kind of suffix, its smoothed rate of blocked labels in other folds and its share of all rows."""
    whole = rows.agg(*_by_fold(), F.count(F.lit(1)).alias("n")).first()
    n = max(1, whole["n"])
    labelled, blocked = (_of_others(F.array(*(F.lit(x).cast("long") for x in whole[name]))) for name in ("labelled", "blocked"))
    rows = rows.withColumn("rate", F.when(labelled > 0, blocked / labelled).otherwise(0.5))
    for suffix in SUFFIXES:
        counted = rows.groupBy(suffix).agg(*_by_fold(), F.log10((F.count(F.lit(1)) + 1) / n).alias(f"{suffix}_share"))
        rate = (_of_others(F.col("blocked")) + SMOOTHING * F.col("rate")) / (_of_others(F.col("labelled")) + SMOOTHING)
        rows = rows.join(counted, suffix).withColumn(f"{suffix}_rate", rate).drop("labelled", "blocked")
    return rows.drop("rate")


def described(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, label, fold`` and all features, written once."""
    ready(pages.sparkSession)
    return written(with_rates(written(lexical(pages), "urls")), "url-features")


def predicted(rows: DataFrame, labelled: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Add ``prediction``, 1 where trees trained on the labelled rows would block."""
    sample = labelled.select("url_hash", "label", *features).distinct().orderBy("url_hash", "label", *features).limit(TRAIN_ROWS)
    sample = written(sample.withColumn("blocked", (F.col("label") == "block").cast("double")).coalesce(1), "url-sample")
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return rows.withColumn("prediction", F.lit(1.0 if kinds == ["block"] else 0.0))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = GBTClassifier(labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=1, checkpointInterval=-1)
    return trees.fit(assembler.transform(sample)).transform(assembler.transform(rows))


def judged(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict``: the rule's, else that of trees trained on the labelled urls."""
    rows = described(pages)
    scored = predicted(rows, rows.where("label IS NOT NULL"))
    model = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("label", model).alias("verdict"))


def held_out_error(pages: DataFrame) -> dict[str, dict[str, int]]:
    """Urls of the last fold, those of them to block, and errors of trees that saw no label of its hosts.

    One count for trees with the rates (``with_rates``) and one without (``lexical``).
    """
    rows = described(pages)
    known, aside = (rows.where(F.col("label").isNotNull() & test) for test in (F.col("fold") < FOLDS - 1, F.col("fold") == FOLDS - 1))
    out = {}
    for name, features in (("with_rates", FEATURES), ("lexical", LEXICAL)):
        is_block = F.col("label") == "block"
        wrong = (F.col("prediction") > 0.5) != is_block
        out[name] = predicted(aside, known, features).agg(F.count(F.lit(1)).alias("urls"), F.count_if(is_block).alias("to_block"), F.count_if(wrong).alias("errors")).first().asDict()
    return out


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
