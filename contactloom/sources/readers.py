"""Sources: registries, lists, contact files, items, worker progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import rules, schemas
from contactloom.functions.domains import clean_domain
from contactloom.functions.text import blank_to_null
from contactloom.operators.rank import first_wins, union_sources


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None,
             spread: int | None = None, malformed: str = "PERMISSIVE") -> DataFrame:
    """Headered UTF-8 CSV, plain or gzip.

    A gzip file is one split; ``spread`` redistributes its rows after reading.
    """
    reader = spark.read.option("header", True).option("mode", malformed).option(
        "encoding", "UTF-8").option("multiLine", False).option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(
        paths if isinstance(paths, str) else list(paths))
    # bytes that are no UTF-8 arrive as replacement characters: drop them
    df = df.select(*[F.replace(F.col(f"`{c}`"), F.lit("\ufffd"), F.lit("")).alias(c)
                     if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])
    return df.repartition(spread) if spread else df


def drop_malformed(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """CSV rows with all columns; short rows and repeated header lines are dropped."""
    first = schema.split()[0]
    return (spark.read.option("header", False).option("mode", "DROPMALFORMED")
            .option("columnPruning", False).schema(schema)
            .csv(paths if isinstance(paths, str) else list(paths))
            .where(F.lower(F.col(first)) != first.lower()))


def pick_alias(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-blank of the columns that exist (matched by exact name)."""
    found = [blank_to_null(F.col(f"`{n}`")) for n in dict.fromkeys(names) if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def alias_registry(df: DataFrame, aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Registry rows under canonical names; rows without a dotted domain are dropped."""
    aliases = aliases or rules.ALIASES
    domain = clean_domain(F.lower(F.trim(pick_alias(df, aliases["domain"]))), "anywhere",
                          www=False)
    keep = [c for c in ("source_prio", "seq") if c in df.columns]
    rows = df.select(
        *keep, domain.alias("domain"),
        F.trim(pick_alias(df, aliases["brand"])).alias("brand"),
        pick_alias(df, aliases["tech"]).alias("tech"),
        pick_alias(df, aliases["tags"]).alias("tags"),
        F.coalesce(pick_alias(df, aliases["employees"]), F.lit("11-50")).alias("employees"))
    return rows.where(F.contains("domain", F.lit(".")))


def read_registry(spark: SparkSession, paths: Sequence[str],
                  aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Registries in priority order, under canonical names, with ``source_prio``."""
    return union_sources(*[alias_registry(read_csv(spark, p), aliases) for p in paths])


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``rank,domain`` list; short rows are dropped."""
    return (spark.read.option("header", False).schema(schemas.RANKED).csv(path)
            .where("domain IS NOT NULL").withColumn("domain", F.lower(F.trim("domain"))))


def lines_to_domains(df: DataFrame, line: str = "value") -> DataFrame:
    """Host of every line that looks like one."""
    host = F.split_part(clean_domain(line, "anywhere"), F.lit(","), F.lit(1))
    return (df.withColumn("domain", host)
            .where(F.contains("domain", F.lit(".")) & ~F.contains("domain", F.lit(" "))
                   & ~F.col("domain").rlike("^(url|store|http)")))


def scan_ordered(frames: Sequence[DataFrame], key: str = "email",
                 seq: str = "seq") -> DataFrame:
    """Many files, first row per key in file order and then in row order.

    ``seq`` is the row order inside a file and has to be part of the data: a distributed
    read has no row order of its own.
    """
    stacked = union_sources(*frames, prio="file_prio")
    return first_wins(stacked, [key], ["file_prio", seq])


def read_slices(spark: SparkSession, path: str, numbers: Sequence[int]) -> DataFrame:
    """Slices written by ``write_slices``; the numbers prune partitions."""
    return spark.read.parquet(path).where(F.col("slice").isin(*numbers))


def read_progress(spark: SparkSession, path: str, one_each: bool = True) -> DataFrame:
    """Progress files of the workers, one JSON object each, or one in a line."""
    return spark.read.schema(schemas.PROGRESS).option("multiLine", one_each).json(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ITEM).json(path)


def brand_registry(table: DataFrame, limit: int | None = None, order: str = "seq") -> DataFrame:
    """Curated brand table, the first ``limit`` rows in its own order."""
    return table if limit is None else table.orderBy(order).limit(limit)


def category_tree(spark: SparkSession) -> DataFrame:
    """Category dimension: niche, niche_no, sub_niche, sub_no."""
    rows = [(niche, i, sub, j) for i, (niche, subs) in enumerate(rules.CATEGORY_TREE.items())
            for j, sub in enumerate(subs)]
    return spark.createDataFrame(rows, "niche STRING, niche_no INT, sub_niche STRING, sub_no INT")


def keyword_dim(spark: SparkSession) -> DataFrame:
    """Keyword rule sets as a table: ruleset, prio, niche, term."""
    sets = {"registry": rules.REGISTRY_KEYWORDS, "fallback": rules.FALLBACK_KEYWORDS,
            "harvest": rules.HARVEST_KEYWORDS, "ranked": rules.RANKED_KEYWORDS,
            "inline": rules.INLINE_KEYWORDS}
    rows = [(name, i, niche, term) for name, table in sets.items()
            for i, (niche, terms) in enumerate(table) for term in terms]
    return spark.createDataFrame(rows, "ruleset STRING, prio INT, niche STRING, term STRING")
