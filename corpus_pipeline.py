"""From raw documents to token blocks: five stages, each written as Parquet and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what its
stage keeps, with the columns of ``documents``; the last returns a row per document of the token
files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.llm import decontaminate, mixing, quality, queries, simhash, token_blocks
from folioflow.session import configure, cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject: score at least 0.5. It is fitted on the
    labelled rows of this stage's own input; a score hangs on the text alone."""
    configure(spark)
    model = queries.quality_model(spark, docs, sf_dir)
    scored = quality.score(docs, model, "doc_id", "text", *(F.col(c).alias(f"own_{c}") for c in COLUMNS))
    return scored.filter(F.col("score") >= 0.5).select(*(F.col(f"own_{c}").alias(c) for c in COLUMNS))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: three-word shingles, fingerprints within two bits."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at the square root of their size; a repeated document is repeated in the rows."""
    return mixing.mix(docs.select(*COLUMNS), temperature=0.5, seed=queries.MIX_SEED).select("row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token blocks, written and read back."""
    segments = cut_lineage(token_blocks.encode(docs, queries.tokenizer_path()))
    return token_blocks.read(segments)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_clean),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

# A trained classifier has no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
