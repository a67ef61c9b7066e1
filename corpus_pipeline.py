"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

1. quality: documents graded as of low quality go.
2. near_duplicates: one document of each group of near duplicates stays.
3. benchmark: passages of benchmark items are cut out of the texts.
4. secrets: secrets in the texts are masked.
5. encode: texts become pieces of a public vocabulary, with their source bytes.

``n_chars`` follows the text. The first four return the columns of ``documents``. Rows with
null or empty texts pass all stages if their grade lets them; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import quality
from tagloom.llm.common import staged, table
from tagloom.llm.decontamination import decontaminated
from tagloom.llm.ngram_join import one_of_each_group
from tagloom.llm.queries import quality_model
from tagloom.llm.secret_scan import secrets_masked
from tagloom.llm.sentencepiece import encode, model_bytes, tokenizer_path

#: SQL cannot express the first stage (a trained model); stages are tested against brute force.
ORACLE_SQL: str | None = None


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of changed texts."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a grade above the lowest is a half or more."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    graded = quality.grade(docs, model)
    return graded.where(F.col("tails")[0] >= 0.5).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles have a similarity of 0.8 or more."""
    return one_of_each_group(docs, n=5, percent=80)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 10 words of benchmark items."""
    return _measured(decontaminated(docs, table(spark, sf_dir, "benchmark"), length=10))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked."""
    return _measured(secrets_masked(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and source bytes of the pieces of each text."""
    encoded = encode(docs, model_bytes(tokenizer_path("piece_bpe_32k.model")))
    kept = [c for c in docs.columns if c != "text"]
    return encoded.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids", "begins", "ends")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("benchmark", cut_benchmark),
    ("secrets", mask_secrets),
    ("encode", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its rows for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
