"""The corpus pipeline: toxicity, near duplicates, repeated passages, benchmark, mixture.

Each stage takes (spark, docs, sf_dir) and returns documents; run() writes every
stage's result as a work table and reads it again as the next one's docs. All but
the last return the columns of documents.

Null texts and empty texts pass the stages as documents without words; rows without
an id are kept where a stage decides by id, except in mixing, where they draw like
any other row. Extra columns are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, mixing, simhash, substring_dedup, toxicity
from lakeloom.llm.common import fold, scratch, stored
from lakeloom.session import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores below 0.5; learned outside fold 0 of 5 of all labelled documents."""
    lexicon = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    out = toxicity.weighed(docs, lexicon, *(c for c in COLUMNS if c != "text"), back=True)
    x = F.log1p(100.0 * F.col("total") / (F.col("n") + 50.0))
    return out.where(1 / (1 + F.exp(-(lexicon.slope * x + lexicon.offset))) < 0.5).select("row.doc_id", "text", "row.lang", "row.source", "row.n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash class the document of least id; of rows that repeat its id, all."""
    classes = simhash.near_duplicates(docs)
    first = classes.where("doc_id = component_id").select("doc_id").distinct()
    lone = docs.where("doc_id IS NULL").select(*COLUMNS)
    return docs.join(first, "doc_id", "left_semi").select(*COLUMNS).union(lone)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words of 20-word windows seen earlier; one cut to nothing goes."""
    out = substring_dedup.dedup(docs.select(*COLUMNS))
    kept = out.where("n_removed = 0 OR n_removed < n_words")
    return kept.select(
        "doc_id", F.when(F.col("n_removed") > 0, F.rtrim("text")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(F.col("n_removed") > 0, F.length(F.rtrim("text")).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    _, hit, _ = decontaminate.matched(docs, table(spark, sf_dir, "benchmark"))
    keyed = docs.withColumn("key", decontaminate.row_key("doc_id", "text"))
    return keyed.join(hit.select("key").distinct(), "key", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the square root of their sources' sizes, in a global shuffle; copy counts up."""
    return mixing.mix(docs.select(*COLUMNS))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; when a stage's result is written, its work tables and the result before go."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark) as trim:
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), name)
            trim()
    return docs


#: The first stage learns its lexicon, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
