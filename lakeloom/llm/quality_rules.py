"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds the measurements and
one failure bit per rule; policies are masks over those bits with a version, so a
new policy or an ablation reads the ledger and never the texts. All of it is
DataFrame expressions: one row in, one row out, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import WORD, let


@dataclass(frozen=True)
class Rule:
    """A named rule; fails(measurement columns) is true where a document fails."""

    name: str
    fails: Column | None = None
    sql: str = ""

    def column(self) -> Column:
        return self.fails if self.fails is not None else F.expr(self.sql)


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject a document under it."""

    version: str
    rules: tuple[str, ...]


#: Thresholds of the rules, over the measurements of measure().
RULES = (
    Rule("few_words", sql="n_words < 50"),
    Rule("repeated_words", sql="100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", sql="10 * n_symbols > n_words"),
    Rule("duplicate_lines", sql="100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", sql="word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("capitals", sql="100 * n_upper > 50 * word_chars"),
)

POLICY = Policy("v1", tuple(r.name for r in RULES))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by the 64-bit hash of their words. Positions of repeated
    windows come from sorting (hash, position) and looking at both neighbours.
    """

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(s: Column) -> Column:
        twin = F.filter(
            s,
            lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twin, lambda e: e["i"]))

    def from_hashes(h: Column) -> Column:
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(tagged, lambda s: let(repeated(s), covered))
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows, from_hashes))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its measurements (long).

    A null or empty text has no words and measures 0 throughout. Repeated ids keep
    their rows. Other columns of docs are left out, so their names can't clash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    per_word = let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    per_line = let(
        lines,
        lambda s: F.struct(
            F.size(s).cast("long").alias("n_lines"),
            (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        ),
    )
    return docs.select(
        F.col(id_col),
        per_word.alias("_w"),
        per_line.alias("_l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    ).select(id_col, "_w.*", "n_symbols", "_l.*", "n_upper")


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements plus fail_bits: bit i is set where rules[i] fails."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits + F.when(rule.column(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    """The policy's rules as bits; an unknown rule is an error."""
    at = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << at[name] for name in policy.rules)


def apply_policy(led: DataFrame, policy: Policy = POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with kept and policy_version; no text is read again."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long"))
    return led.withColumn("kept", hit == 0).withColumn("policy_version", F.lit(policy.version))


def ablation(led: DataFrame, policy: Policy = POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents failing it, failing only it, and kept without it.

    One bitwise aggregation down to the distinct masks (2 to the number of rules at
    most); the rules are then read off those few rows. An empty ledger gives zeros.
    """
    whole = mask(policy, rules)
    masks = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).count()
    at = {r.name: i for i, r in enumerate(rules)}
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << at[n]).cast("long").alias("bit")) for n in policy.rules]))
    one = F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)
    only = F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)
    without = F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("count")).otherwise(0)
    sums = (
        masks.select("bits", "count", names.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(F.sum(one).alias("n_failed"), F.sum(only).alias("n_failed_only_this"), F.sum(without).alias("n_kept_without"))
    )
    every = led.sparkSession.createDataFrame([(n,) for n in policy.rules], "rule string")
    return every.join(F.broadcast(sums), "rule", "left").select(
        "rule", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_failed", "n_failed_only_this", "n_kept_without")]
    )


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The ledger of every document under the production policy."""
    from lakeloom.session import table

    led = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = (F.col("fail_bits").bitwiseAND(F.lit(3).cast("long"))) != 0
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "n_lines", "n_upper", "fail_bits", "policy_version",
    )


def quality_ablation(spark, sf_dir: str) -> DataFrame:
    """What each rule of the production policy rejects, alone and with the others, over all documents."""
    from lakeloom.session import table

    return ablation(ledger(table(spark, sf_dir, "documents")))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id),
ln AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT s) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS s FROM w)
  WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
         CAST(len(regexp_extract_all(t, '\p{Lu}')) AS BIGINT) AS n_upper
  FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id LEFT JOIN ln ON ln.doc_id = w.doc_id),
b AS (
  SELECT *, CAST(
    (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 100 * n_upper > 50 * word_chars THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       fail_bits = 0 AS kept, n_lines, n_upper, fail_bits, 'v1' AS policy_version
FROM b"""

#: The ledger read once more: each rule's bit counted over the masks.
ABLATION_ORACLE = f"""
WITH l AS ({ORACLE}),
r AS (SELECT unnest({[x.name for x in RULES]}) AS rule, unnest({[1 << i for i in range(len(RULES))]}) AS bit)
SELECT rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits = bit) AS n_failed_only_this,
       count(*) FILTER (fail_bits & ~bit = 0) AS n_kept_without
FROM r, l GROUP BY rule"""
