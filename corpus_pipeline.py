"""From raw documents to packed training sequences, stage by stage.

Each stage is one operator of ``tripmart.llm`` applied to all documents that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import use_utc
from tripmart.functions.columns import free_name
from tripmart.llm import ngram_join, packing, surrogates, tiling, toxicity
from tripmart.llm.common import ready, release, stored, table

KEY = "example key"  # of the surrogates; a real run sets its own

ORACLE_SQL = None  # trained weights, tiling, keyed surrogates and packing have no SQL


def _with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a key of their own, and its column; the same whenever the rows are read.

    Ids can be null or repeated, so what a stage decides on is the row. A row of Parquet files is
    known by its file and its place there; rows of any other kind are numbered and written once.
    """
    row = free_name("__row", docs.columns)
    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and docs.inputFiles():
        place = F.concat_ws(":", "_metadata.file_path", "_metadata.row_index")
        return docs.select(*[F.col(f"`{c}`") for c in docs.columns], place.alias(row)), row
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half; documents without text stay."""
    ready(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(spark, model)("text") < 0.5)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 or more, the one with the least id.

    Each row is a document, whether its id is null, repeated or its own: of rows with the same least
    id one stays, and a null id comes after all others. Texts without words link with nothing.
    """
    ready(spark)
    rows, row = _with_row_key(docs)
    classes = ngram_join.ngram_components(rows, width=5, num=80, den=100, id_col=row)
    numbered = classes.select(F.col("doc_id").alias(row), F.col("component_id").alias("class"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    kept = (
        rows.select(row, "doc_id")
        .join(numbered, row)
        .groupBy("class")
        .agg(least.alias("least"))
        .select(F.col("least")[row].alias(row))
    )
    return rows.join(kept, row, "left_semi").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; each row is judged by its own text."""
    ready(spark)
    rows, row = _with_row_key(docs)
    found = tiling.find_passages(rows, table(spark, sf_dir, "benchmark"), id_col=row)
    rejected = found.select(F.col("doc_id").alias(row)).distinct()
    return rows.join(rejected, row, "left_anti").select(docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return surrogates.replace_personal_data(docs, key=KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 tokens and their places in sequences."""
    ready(spark)
    pieces = packing.token_pieces(docs)
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim)


STAGES = [
    ("toxicity", reject_toxic),
    ("near copies", one_of_near_copies),
    ("benchmark decontamination", decontaminate),
    ("personal data", replace_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents of ``sf_dir``; each stage is written and read again.

    What a stage has read is deleted when its own result is written.
    """
    use_utc(ready(spark))
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        before, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if number:
            release(before)
    return docs
