"""Address filter: host rules first, gradient-boosted trees on lexical features elsewhere.

Only DataFrame functions and Spark's own tree learner run here. The trees learn from the
addresses that a rule decides, and judge those that no rule fits. What they learn of a host
suffix comes from the labels of other hosts.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.store import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE_ROWS = 20_000
FOLDS = 5
FEATURES = ("length", "host_length", "host_labels", "depth", "path_length", "digit_share",
            "hyphens", "parameters", "query_length", "escapes", "entropy", "secure",
            "file_ending", "suffix_frequency", "suffix_block_share")


def after_scheme() -> Column:
    return F.coalesce(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), F.lit(""))


def host() -> Column:
    """Between the first ``://`` and the next of ``/?#``, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(after_scheme(), r"^([^/?#]*)", 1), UPPER, LOWER)


def path() -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(), r"^[^/?#]*([^?#]*)", 1)


def rule_fits(rule: str) -> Column:
    name, _, rest = rule.partition("/")
    inside = (F.col("host") == name) | F.endswith(F.col("host"), F.lit("." + name))
    return inside & F.startswith(F.col("path"), F.lit("/" + rest))


def decide(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule = F.when(rule_fits(text), F.lit(text)).otherwise(rule)
        verdict = F.when(rule_fits(text), F.lit(what)).otherwise(verdict)
    return rule, verdict


def occurrences(text: Column, of: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(of)))).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy, in bits, of the characters of a text."""
    n = F.length(text).cast("double")

    def term(char: Column) -> Column:
        share = (n - F.length(F.replace(text, char))) / n
        return -share * F.log2(share)

    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.when(n > 0, F.aggregate(chars, F.lit(0.0), lambda s, c: s + term(c))).otherwise(
        F.lit(0.0))


def lexical(rows: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    return rows.withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "host_labels": occurrences(F.col("host"), "."),
        "depth": occurrences(F.col("path"), "/"),
        "path_length": F.length("path").cast("double"),
        "digit_share": F.when(F.length(url) > 0, digits / F.length(url)).otherwise(F.lit(0.0)),
        "hyphens": occurrences(url, "-"),
        "parameters": F.when(query == "", F.lit(0.0)).otherwise(occurrences(query, "&") + 1),
        "query_length": F.length(query).cast("double"),
        "escapes": occurrences(url, "%"),
        "entropy": entropy(url),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
        "file_ending": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double")})


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """For each ``suffix`` and ``fold``, over all addresses: how frequent the suffix is, and the
    share that rules block in its other folds, drawn to one half where few are labelled.

    A fold holds whole hosts, so the share tells a row nothing of its own host's labels.
    """
    def of(value: Column) -> Column:
        return F.sum(value).over(Window.partitionBy("suffix"))

    labelled, blocked = F.col("labelled"), F.col("blocked")
    folds = rows.groupBy("suffix", "fold").agg(
        F.count("*").cast("double").alias("n"), F.count("label").alias("labelled"),
        F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked"))
    return folds.select(
        "suffix", "fold", F.log1p(of(F.col("n"))).alias("suffix_frequency"),
        ((of(blocked) - blocked + 1) / (of(labelled) - labelled + 2)).alias(
            "suffix_block_share"))


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> GBTClassificationModel | str:
    """Trees fitted on at most ``sample_rows`` labelled rows, those of least address hash.

    Both kinds weigh the same, however many rules block. Without labels of both kinds there is
    nothing to learn: the one kind there is, else "allow", is the verdict for all.
    """
    sample = written(rows.where("label IS NOT NULL").select(*FEATURES, "label", "draw")
                     .orderBy("draw").limit(sample_rows), "sample")
    kinds = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return "block" if 1.0 in kinds else "allow"
    weight = F.when(F.col("label") == 1.0, 0.5 / kinds[1.0]).otherwise(0.5 / kinds[0.0])
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        sample.withColumn("weight", weight * sum(kinds.values())))
    return GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight",
                         maxIter=12, maxDepth=4, seed=7).fit(
        vectors.select("features", "label", "weight"))


def ruled(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``page_id, url, host, path, rule, decided, label, draw``; a rule's verdict is the label."""
    rule, verdict = decide(rules)
    return (pages.select("page_id", F.col("url").cast("string"))
            .withColumn("host", host()).withColumn("path", path())
            .withColumn("rule", rule).withColumn("decided", verdict)
            .withColumn("label", F.when(F.col("decided") == "block", 1.0)
                        .when(F.col("decided") == "allow", 0.0))
            .withColumn("draw", F.xxhash64("url", "page_id")))


def featured(rows: DataFrame) -> DataFrame:
    """``rows`` with their ``FEATURES``."""
    rows = lexical(rows).withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)))
    statistics = suffix_statistics(rows.select("suffix", "fold", "label"))
    return written(rows.join(statistics, ["suffix", "fold"]), "addresses")


def judged(rows: DataFrame, model: GBTClassificationModel | str) -> DataFrame:
    """``rows`` with the model's verdict as ``learned``."""
    if isinstance(model, str):
        return rows.withColumn("learned", F.lit(model))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    return model.transform(vectors.transform(rows)).withColumn(
        "learned", F.when(F.col("prediction") == 1.0, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages(page_id, url)``.

    ``rules`` are (verdict, host and path) as ("block", "example.com/en/"); a rule fits its
    host and all subdomains where the path starts with the rule's, and the longest wins.
    Addresses without a rule get the trees' verdict. A null address, or one without ``://``,
    has empty host and path. Repeated rows are judged alike. Extra columns are ignored; no
    rows give none.
    """
    rows = featured(ruled(pages, rules))
    return judged(rows, train(rows)).select(
        "page_id", "host", "path", "rule", F.coalesce("decided", "learned").alias("verdict"))
