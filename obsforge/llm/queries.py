"""The pN_ queries of the problems tagged llm, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.catalog import load
from obsforge.llm import bpe, leaks, sentences
from obsforge.llm.nearest import nearest

NEAR_US = 12_000_000


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Packets have unique ids within their tables, so the rows are distinct as they are."""
    got = nearest(load(spark, d, "sci_xfi"), {t: load(spark, d, t) for t in ("eng_ceb", "eng_pfw")}, NEAR_US, "spacecraft_id", "timestamp", "id")
    return got.select(F.col("right_name").alias("eng_table"), F.col("right_id").alias("eng_id"), F.col("left_id").alias("sci_id"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_corpus(load(spark, d, "documents"))


def p8_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Documents and tokens per source."""
    docs = load(spark, d, "documents").select("source", "text")
    n = docs.select("source", F.size(bpe.encode_column(docs)).alias("n"))
    return n.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"), F.max("n").alias("longest"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(load(spark, d, "documents"), load(spark, d, "eval_items"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """How many documents contain each leaked item."""
    return p9_found(spark, d).groupBy("item_id").agg(F.count("*").alias("docs"))


def p9_paraphrases(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a passage close to an item's by subsequence, which no common run need show."""
    return leaks.paraphrased(load(spark, d, "documents"), load(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(load(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p3_found, p8_ids, p8_lengths, p9_found, p9_report, p9_paraphrases, p10_found)}

ORACLE = {
    "p3_found": """
WITH s AS (SELECT id, spacecraft_id AS sc, epoch_us(timestamp) AS us FROM sci_xfi),
e AS (SELECT 'eng_ceb' AS eng_table, id, spacecraft_id AS sc, epoch_us(timestamp) AS us FROM eng_ceb
      UNION ALL SELECT 'eng_pfw', id, spacecraft_id, epoch_us(timestamp) FROM eng_pfw),
eb AS (SELECT e.*, us // 12000000 + k AS b FROM e, (VALUES (-1), (0), (1)) AS v(k)),
p AS (SELECT eng_table, eb.id AS eng_id, s.id AS sci_id, abs(eb.us - s.us) AS d
      FROM s JOIN eb ON eb.sc = s.sc AND eb.b = s.us // 12000000 WHERE abs(eb.us - s.us) <= 12000000),
r AS (SELECT *, row_number() OVER (PARTITION BY eng_table, sci_id ORDER BY d, eng_id) AS rn FROM p)
SELECT DISTINCT eng_table, eng_id, sci_id FROM r WHERE rn = 1""",
}
