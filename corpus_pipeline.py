"""From raw documents to token files in five stages, each of which works on what the one before it kept.

All stages but the last return the columns of their input, whatever their names.  In every stage a null text counts as
an empty one, a null doc_id is an id like any other, rows are told apart by doc_id and text, and an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusproof.llm.decontaminate import without_contamination
from corpusproof.llm.jaccard_join import one_of_each
from corpusproof.llm.line_crf import quality_scores
from corpusproof.llm.mixing import label_domains, mixed
from corpusproof.llm.queries import TARGETS
from corpusproof.llm.scratch import removed, written
from corpusproof.llm.token_files import write_token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose line field marginals average to 0.3 or more; the model is fitted on all labels.

    A null or empty text is scored as one empty line; repeated rows are scored alike and stay as often as they come.
    Without labels of both kinds all rows have one score, so that all stay or all go.
    """
    # an own column of the score's name waits under another
    names = [f"own {c}" if c.lower() == "quality_score" else c for c in docs.columns]
    scored = quality_scores(docs.toDF(*names), _table(spark, sf_dir, "labels"))
    return scored.where("quality_score >= 0.3").select(*(F.col(f"`{n}`").alias(c) for n, c in zip(names, docs.columns, strict=True)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, 0.8), told apart by doc_id and text.

    That with the smallest doc_id stays (null last); of rows that repeat id and text, one.  Null and empty texts all stay.
    """
    return one_of_each(docs, k=5, percent=80)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that links with a benchmark item; each row is judged by its own text.

    Null and empty texts stay, repeated rows stay or go together, and an empty benchmark removes nothing.
    """
    return without_contamination(docs, _table(spark, sf_dir, "benchmark"))


def to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: none, once or more.

    Rows that repeat id and text are drawn alike.  Null and empty texts have no words, so they count for no target; they
    are drawn by the rate of their posterior.  Without labels of two domains all rows stay once.
    """
    return mixed(docs, label_domains(_table(spark, sf_dir, "labels")), TARGETS)


def to_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: doc_id, start, n_tokens and ids_crc32 of each.

    Null and empty texts are one end id; null ids come first, repeated rows follow one another; no rows, no files.
    """
    import public_tokenizers

    return write_token_files(docs, public_tokenizers.path("word_bpe_49k.json")).read()


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontaminate", no_benchmark),
    ("mix", to_targets),
    ("tokens", to_token_files),
]
#: SQL can express neither the line field nor the classifier of the mix.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written as Parquet and read again.

    What a stage has stored on its way is removed as soon as its rows are written; the token files stay.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with removed(spark, but=("stage-", "tokens-")):
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
