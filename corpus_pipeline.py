"""From raw documents to token files: five stages, each written and read again.

    toxicity          documents that are predicted to be toxic go
    near duplicates   one document of each group of near duplicates stays
    decontamination   documents that contain a benchmark passage go
    mixing            documents in training order, as often as their source's target asks for
    token files       ids in files of compressed byte planes, in training order; the rows say where
                      each document is

Each stage works on all that the one before has kept. All but the last return the columns of the
documents, other columns too, whatever their names. Null texts and ids, empty tables, repeated
rows and ties are handled as the operators' modules say.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from greenshoe.llm import (
    decontaminate,
    jaccard_join,
    source_mix,
    token_files,
    toxicity,
)
from greenshoe.llm.queries import IDS_VOCABULARY
from greenshoe.llm.shared import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(docs, Scratch(spark, "pipeline-join"))
    return jaccard_join.one_of_each(docs, found)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    scratch = Scratch(spark, "pipeline-decontaminate")
    found = scratch.save(decontaminate.overlaps(docs, benchmark, scratch), "found")
    scratch.drop("items", "segments")
    return decontaminate.without_contaminated(docs, found)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, order = source_mix.training_plan(docs, Scratch(spark, "pipeline-mix"))
    return source_mix.mixed_documents(docs, order)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """In the order that the mixed documents have in their files, the training order."""
    files = token_files.write_files(
        docs,
        Scratch(spark, "pipeline-tokens"),
        IDS_VOCABULARY,
        order=token_files.stored_order(docs),
    )
    return token_files.read_documents(files)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token_files", write_tokens),
]

# No stage but mixing can be put into SQL: the others learn, hash or tokenize.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if number:
            scratch.drop(STAGES[number - 1][0])
    return docs
