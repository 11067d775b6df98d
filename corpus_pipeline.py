"""Training-data pipeline: five stages over ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; its result is written as Parquet and read again, which cuts the
lineage.  All stages but the last return the columns of ``documents``.

Documents are whole texts of any length, so the first stage limits the rows of
an Arrow batch for the session that runs the pipeline; the limit stays, since a
stage's result is only evaluated when it is written.

Null ids and texts, repeated rows, empty tables and further columns are handled
as each operator states; a stage without documents gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, jaccard_join, mixing, token_ids, toxicity
from quarry.llm.common import limit_arrow_rows, table
from quarry.llm.queries import tokenizer_path
from quarry.session import materialize

BATCH_ROWS = 1_000
#: Parts of texts a worker remembers when it encodes: workers outlive the stage, and have the others' work to do.
CACHED_PARTS = 100_000


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar does not score as toxic (at 0.3)."""
    limit_arrow_rows(spark, BATCH_ROWS)
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each component of similar documents."""
    return jaccard_join.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token weights match the target marginals."""
    return mixing.sample(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token archive of what is left, read back: one row per document."""
    return token_ids.token_ids(docs, tokenizer_path(), cached=CACHED_PARTS)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The first stage scores with a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
