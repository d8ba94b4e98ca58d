"""A corpus pipeline: quality filter, near duplicates, decontamination, PII, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as
Parquet to the shared folder and reads again as the next stage's documents. All stages but
the last return the columns of documents; the last returns the ids of the byte-level BPE.

Defined results of every stage: an empty table gives an empty table; rows that repeat an
id are judged each by its own text; extra columns, whatever their names, stay as they are
up to the last stage, which returns ``doc_id, ids``. By stage: null and empty texts are
scored as any others and go if they are rejected; they have no near copies, so all their
rows stay (of equal texts with words one row stays, whatever the ids, and a row with an id
before one without); they are never contaminated; they stay as they are where personal data
go; and they have no tokens. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firngrid.llm import byte_bpe, decontamination, jaccard_join, pii
from firngrid.llm.queries import BPE_RANKS, PATTERN, quality_scores
from firngrid.llm.texts import fresh
from firngrid.sources.shared import staged
from firngrid.sources.tables import read_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject, each judged by its own text."""
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    scores = quality_scores(spark, keyed, sf_dir, key)
    rejected = staged(scores.where("score < 0.5").select(key).distinct(), "rejected")
    small = decontamination.small(rejected, rejected.count())
    return keyed.join(small, key, "left_anti").select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, 0.8), that of the least id."""
    return jaccard_join.one_of_each(docs, percent=80, size=5)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the new text."""
    return pii.redact(docs, pii.train(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids``: the tokens of each document."""
    return byte_bpe.encode(docs, BPE_RANKS, PATTERN)


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmarks),
    ("PII", without_personal_data),
    ("byte-level BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


#: A fitted classifier and a trained field have no SQL; tests compare with brute force.
ORACLE_SQL = None
