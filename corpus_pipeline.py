"""A training corpus from raw documents, stage by stage.

Each stage takes the rows that the one before it kept, whole, and writes its own as Parquet in the
shared folder, so a lost executor costs at most the stage that runs. All but the last return the columns
of ``documents``.

1. ``language``: texts without a letter, and texts that are less like any of the languages than letters drawn
   at random are, go. Texts in several languages stay.
2. ``toxicity``: texts that score 0.5 or more go.
3. ``near_duplicates``: of texts linked by a Jaccard similarity of 0.8 or more over shingles of five
   words, directly or through others, the one with the smallest id stays (one without an id only where
   none has one; of rows with one id, any one).
4. ``decontamination``: texts that hold ten words in a row of a benchmark item (or a shorter item) go.
5. ``tokens``: texts become token ids; ``intact`` says that these decode to the very bytes of the text.

Models are learned from the rows that a stage gets, as in the operators' queries. Stages 3 and 4 number the
rows, so null and repeated ids make no difference to what goes; a null text has no letter and goes in the
first stage. Columns that a stage adds for itself have names that no table has, so other columns may have any.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import byte_bpe, jaccard, language, toxicity, winnow
from finlake.llm.common import Workspace, bounded_batches, held_out, workspaces
from finlake.llm.queries import table, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Intermediate tables of stages whose results may not be written yet.
_left: list[Workspace] = []


def drop_left(docs: DataFrame | None = None) -> None:
    """Deletes the intermediate tables of earlier stages, but for those that the frame still reads."""
    read = docs.inputFiles() if docs is not None and _left else []
    for work in list(_left):
        if not any(work.root.rsplit("/", 1)[1] in file for file in read):
            work.drop_all()
            _left.remove(work)


def stage(work: Stage) -> Stage:
    """A stage, which takes what the one before it wrote; so that one's intermediate tables can go."""

    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        drop_left(docs)
        with workspaces() as made:
            out = work(spark, docs, sf_dir)
        _left.extend(made)
        return out

    return run


def fresh() -> str:
    """A column name that no table has."""
    return f"_{uuid.uuid4().hex}"


@stage
def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, found = language.fit(docs), fresh()
    labelled = docs.withColumn(found, language.label("text", model, docs))
    known = (F.col(f"{found}.lang_pred") != language.UNKNOWN) & (F.col(f"{found}.evidence") >= 0)
    return labelled.where(known).drop(found)


@stage
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id", 5, 0))
    model, score = toxicity.fit(docs.select("doc_id", "text").join(labels, "doc_id")), fresh()
    return docs.withColumn(score, toxicity.score("text", model, docs)).where(F.col(score) < 0.5).drop(score)


def numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, written, so that it stays the same in all that reads it; and the number's column."""
    row = fresh()
    return Workspace(spark).save(docs.withColumn(row, F.monotonically_increasing_id())), row


@stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(spark, docs)
    found = jaccard.jaccard_components(rows, doc_id=row, size=5, percent=80)
    named = found.join(rows.select(F.col(row).alias("id"), "doc_id"), "id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", F.col("id").alias(row))).alias("first")
    kept = named.groupBy("component").agg(first).select(f"first.{row}")
    return rows.join(kept, row, "left_semi").drop(row)


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(spark, docs)
    found = winnow.decontaminate(rows, table(spark, sf_dir, "benchmark"), doc_id=row)
    return rows.join(found.where("n_hit > 0").select(row), row, "left_anti").drop(row)


@stage
def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rule, coded = (tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), fresh()
    return docs.withColumn(coded, byte_bpe.round_trip("text", *rule)).select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(f"{coded}.ids") / 4).cast("long").alias("n_tokens"),
        F.col(f"{coded}.ids").alias("token_ids"),
        (F.col(f"{coded}.decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("intact"),
    )


STAGES = [
    ("language", by_language),
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("tokens", as_tokens),
]

#: Languages, scores and tokens are beyond SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of ``documents``. Each stage's result goes once the next one is written, the last when this process ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, step in STAGES:
        work = Workspace(spark)
        docs = work.save(step(spark, docs, sf_dir))
        if before is not None:
            before.drop_all()
        before = work
    drop_left()
    return docs
