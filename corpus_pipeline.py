"""A training corpus from raw documents: quality rules, exact dedup, near-duplicate join, mixing of sources, encoding.

Each stage takes what the stage before it kept, as (spark, docs, sf_dir), and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterglass.llm.bpe import encode_texts
from meterglass.llm.common import register, ship, stored, table
from meterglass.llm.exact_dedup import without_copies
from meterglass.llm.mixing import mixed
from meterglass.llm.ngram_join import without_near_copies
from meterglass.llm.quality import kept_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't far from all references.

    Null, empty and short texts fail; repeated rows are judged each; other columns may be null and have any names; no rows give none.
    """
    ship(spark)
    return kept_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that with the largest id.

    A null text counts as empty; of rows with one text and one id, or none, one stays; no rows give none.
    """
    ship(spark)
    return without_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 80 % of their five-word shingles, that with the smallest id.

    Texts without words are linked with nothing and stay; shorter texts are one shingle; no rows give none.
    """
    ship(spark)
    return without_near_copies(docs, n=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by temperature, under a budget of all tokens, in stream order: some documents go, some appear more than once.

    A text without words counts as one token; null is a source like others; one source is left as it is; no rows give none.
    """
    return mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each appearance, with its ids. Null and empty texts have none; no rows give none."""
    ship(spark)
    return encode_texts(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules), ("exact_dedup", exact_dedup), ("near_duplicates", near_duplicates), ("mixing", mixing), ("encoding", encoding)]

#: The vocabulary's merges and the references' distances aren't SQL; a test holds the rows of all stages against plain code instead
#: (of mixing the quotas, the repeats and the order of the stream, as the permutation's hash is Spark's own).
ORACLE_SQL = None


@register("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
