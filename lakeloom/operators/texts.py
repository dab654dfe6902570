"""Words of texts: n-grams, keywords, differences of strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.learning import tf_idf


def ngrams(df: DataFrame, doc: str, text: str, n: int = 2) -> DataFrame:
    """(doc, gram, count) of runs of n words between blanks, joined by one space; shorter texts have none."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")
    held = df.select(doc, words.alias("_w")).where(F.size("_w") >= n)
    grams = F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), lambda i: F.array_join(F.slice("_w", i, n), " "))
    return held.select(doc, F.explode(grams).alias("gram")).groupBy(doc, "gram").agg(F.count("*").alias("count"))


def keywords(df: DataFrame, doc: str, text: str, k: int = 5) -> DataFrame:
    """(doc, word, tf_idf, rank): the k words of each text that weigh most, equal ones by word."""
    w = Window.partitionBy(doc).orderBy(F.desc("tf_idf"), "word")
    return tf_idf(df, doc, text).select(doc, "word", "tf_idf").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def distance(a: Column, b: Column) -> Column:
    """Edits between two strings."""
    return F.levenshtein(a, b)


def similarity(a: Column, b: Column) -> Column:
    """1 less edits over the longer length; 1 of two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)
