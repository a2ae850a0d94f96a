"""URL filters: host rules, and gradient-boosted trees on lexical features for what no rule covers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialised

#: Default bound of the labelled rows that the trees are fitted on.
FIT_ROWS = 50_000
#: Parts of the labelled urls; the rates of one part are counted in the others.
FOLDS = 5

FEATURES = [
    "length", "host_length", "path_length", "depth", "host_depth", "digits", "letters", "upper", "symbols",
    "hyphens", "entropy", "parameters", "query_length", "fragment", "secure", "extension", "last_digits",
    "suffix_rate", "suffix_known", "folder_rate", "folder_known",
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path. Host: after the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower case;
    path: from there up to `?`, `#` or the end. Both are empty for a null or a url without `://`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null when none fits.

    A rule is `host/start of path`. It fits its host and all subdomains. Rules of equal length fit in the
    order of their text. The rules are a short list of the user's and become part of the expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules.items(), key=lambda r: (len(r[0]), r[0]), reverse=False):
        rule_host, _, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character of the text's own letter frequencies."""
    letters = F.array_sort(F.split(text, ""))
    # runs of the sorted letters: (letter, run so far, sum of n log2 n of the runs before)
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s"))

    def nlog(n: Column) -> Column:
        return F.when(n > 0, n * F.log2(n)).otherwise(0.0)

    def step(acc: Column, c: Column) -> Column:
        same = acc["c"] == c
        return F.struct(
            c.alias("c"),
            F.when(same, acc["n"] + 1).otherwise(1.0).alias("n"),
            F.when(same, acc["s"]).otherwise(acc["s"] + nlog(acc["n"])).alias("s"),
        )

    n = F.length(text).cast("double")
    summed = F.aggregate(letters, start, step, lambda acc: acc["s"] + nlog(acc["n"]))
    return F.when(n > 0, F.log2(n) - summed / n).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical_features(urls: DataFrame, url: str = "url") -> DataFrame:
    """Columns `host`, `path`, the keys `suffix` (last label of the host) and `folder` (first part of the path),
    and the features of the text alone."""
    host, path = url_parts(F.col(url))
    text = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    size = F.greatest(F.length(text), F.lit(1))
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    labels = F.split("host", r"\.")
    last = F.element_at(labels, -1)
    parted = urls.withColumn("host", host).withColumn("path", path)
    return parted.select(
        "*",
        last.alias("suffix"),
        F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")).alias("folder"),
        F.length(text).cast("double").alias("length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.size(parts).cast("double").alias("depth"),
        F.size(labels).cast("double").alias("host_depth"),
        (_count(text, "[0-9]") / size).alias("digits"),
        (_count(text, "[A-Za-z]") / size).alias("letters"),
        (_count(text, "[A-Z]") / size).alias("upper"),
        (_count(text, "[^0-9A-Za-z]") / size).alias("symbols"),
        _count(F.col("host"), "-").alias("hyphens"),
        _entropy(text).alias("entropy"),
        F.when(query == "", 0.0).otherwise(_count(query, "&") + 1).alias("parameters"),
        F.length(query).cast("double").alias("query_length"),
        F.contains(text, F.lit("#")).cast("double").alias("fragment"),
        text.startswith("https://").cast("double").alias("secure"),
        F.element_at(F.split(F.coalesce(F.element_at(F.split("path", "/"), -1), F.lit("")), ""), -1).eqNullSafe("l").cast("double").alias("extension"),
        _count(F.coalesce(F.element_at(F.split("path", "/"), -1), F.lit("")), "[0-9]").alias("last_digits"),
    )


def _counts(labelled: DataFrame, key: str) -> DataFrame:
    """Labelled urls per key and fold, and how many of them are blocked."""
    folds = [F.col("fold") == f for f in range(FOLDS)]
    return labelled.groupBy(F.col(key).alias(f"{key}_key")).agg(
        F.array(*[F.coalesce(F.sum(F.when(f, F.col("label"))), F.lit(0.0)) for f in folds]).alias(f"{key}_blocked"),
        F.array(*[F.count_if(f) for f in folds]).alias(f"{key}_n"),
    )


def _rates(key: str, prior: float) -> dict[str, Column]:
    """Smoothed share of blocked urls among the labelled urls of the key, and how many those are (log scale).

    For a labelled url only the other folds count, so the trees cannot read its label from them. Taking out the
    url alone would tell its label: the share would be a little lower for each blocked url of a key. A key
    without such urls has the share of all.
    """
    own = F.col("says").isNotNull()

    def others(column: str) -> Column:
        whole = reduce(add, [F.get(column, F.lit(f)) for f in range(FOLDS)])
        return F.coalesce(whole - F.when(own, F.get(column, F.col("fold"))).otherwise(F.lit(0)), F.lit(0)).cast("double")

    n = others(f"{key}_n")
    share = (others(f"{key}_blocked") + 1.0) / (n + 2.0)
    return {f"{key}_rate": F.when(n > 0, share).otherwise(F.lit(prior)), f"{key}_known": F.log1p(n)}


def filter_urls(
    urls: DataFrame,
    key: str,
    rules: dict[str, str],
    url: str = "url",
    fit_rows: int = FIT_ROWS,
    rounds: int = 15,
    depth: int = 4,
    seed: int = 7,
) -> DataFrame:
    """Verdict `block` or `allow` for every url: of the longest fitting rule, else of boosted trees.

    Labelled urls are those that a rule covers. Suffix and folder statistics are counted over all of
    them, for a labelled url over those of other folds. The trees (Spark's own, trained across the executors) are fitted on at most about `fit_rows`
    labelled rows, chosen by a hash of key and url. Every url is scored.

    Returns `key`, `host`, `path`, `rule` (null: none fits), `verdict` and `score` (the trees' probability
    of `block`; null for all if the labelled urls are of one kind, where the verdict is then that kind).
    Other columns of the input are not read. Null or odd urls have empty parts, fit no rule and are judged by
    the trees; repeated rows stay; without any labelled url everything is allowed.
    """
    spark = urls.sparkSession
    narrow = urls.select(F.col(key).alias("_key"), F.col(url).alias("_url"))
    parts = lexical_features(narrow, "_url")
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "_key", "_url"), F.lit(FOLDS)).cast("int")
    rows = materialised(parts.withColumns({"rule": rule, "says": says, "fold": fold}), "urls")
    labelled = rows.filter("says IS NOT NULL").withColumn("label", (F.col("says") == "block").cast("double"))
    blocked, n = labelled.agg(F.sum("label"), F.count("*")).first()
    prior = (blocked or 0.0) / max(n, 1)
    joined = rows
    for k in ("suffix", "folder"):
        # one row per key; the planner broadcasts it only below its size threshold
        joined = joined.join(_counts(labelled, k), F.col(k) == F.col(f"{k}_key"), "left")
    joined = joined.withColumns({**_rates("suffix", prior), **_rates("folder", prior)})
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)
    out = ["host", "path", "rule"]
    if not n or blocked in (0.0, float(n)):
        other = F.lit("block" if n and blocked else "allow")
        scored = rows.select(F.col("_key").alias(key), *out, F.coalesce("says", other).alias("verdict"), F.lit(None).cast("double").alias("score"))
        return scored
    chosen = F.pmod(F.xxhash64("_key", "_url"), F.lit(1 << 20)) < int(min(1.0, fit_rows / n) * (1 << 20))
    fit = materialised(
        assembled.filter(F.col("says").isNotNull() & chosen).select("features", (F.col("says") == "block").cast("double").alias("label")),
        "url-fit",
    )
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed, stepSize=0.3, cacheNodeIds=False).fit(
        fit.coalesce(spark.sparkContext.defaultParallelism)
    )
    p = vector_to_array("probability")[1]
    return model.transform(assembled).select(
        F.col("_key").alias(key),
        *out,
        F.coalesce("says", F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"),
        p.alias("score"),
    )
