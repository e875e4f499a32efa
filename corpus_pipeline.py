"""Training data from `documents`: five stages, each written as Parquet and read again by the next.

Each stage takes any table with doc_id and text; further columns pass unchanged.
Decisions are made by row, so null and repeated ids are as good as others; null
texts count as empty; an empty table gives an empty one. What that means for each
stage is in its docstring.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklogs.llm import exact_dedup, jaccard_join, packing, secret_scan, toxicity
from sparklogs.llm.common import checkpoint, shared_folder, table, with_row_key, without_ids


#: The key of rows within a stage: ids may be null or repeat.
_ROW = "sparklogs_row"


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model trained on `labels` rejects go; all others stay as they are.

    Null and empty texts score as one blank sentence and stay. Repeated rows have
    one score and stay or go together. Without usable labels nothing goes. Texts of
    any length are scored whole.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space one row stays: that with the most characters, then the smallest id, then any one.

    Null and empty texts are one group, of which one row stays. A null id comes last.
    """
    keyed = with_row_key(docs, _ROW)
    found = exact_dedup.exact_dedup(keyed, row_col=_ROW)
    return without_ids(keyed, found.where("NOT kept").select(F.col("row").alias("id")), _ROW).select(docs.columns)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 the row with the smallest id stays; no id comes last.

    Rows with equal ids, or without, are told apart. Null and empty texts have no
    shingles and all stay.
    """
    keyed = with_row_key(docs, _ROW)
    groups = jaccard_join.jaccard_components(keyed, percent=80, width=5, id_col=_ROW)
    groups = checkpoint(groups.select(F.col("doc_id").alias("row"), "component_id"))
    shared = groups.where("row <> component_id").select("component_id").distinct()
    rows = groups.where("row <> component_id").union(shared.select(F.col("component_id").alias("row"), "component_id"))
    rows = checkpoint(rows.join(keyed.select(F.col(_ROW).alias("row"), F.col("doc_id").cast("long").alias("id")), "row"))
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("row")))
    stay = rows.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return without_ids(keyed, rows.join(stay, "row", "left_anti").select(F.col("row").alias("id")), _ROW).select(docs.columns)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, null texts too.

    Where there is a column n_chars it is counted anew; it is null for null texts.
    """
    clean = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences.

    Null and empty texts have one token. Repeated rows are packed as often as they come.
    """
    return packing.best_fit(packing.tokenised_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", toxic_out),
    ("exact dedup", copies_out),
    ("n-gram jaccard join", near_copies_out),
    ("secret scans", secrets_out),
    ("best-fit packing", packed),
]

#: SQL can't express the trained model, the compressor or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on `documents`; what they hand on lies in the shared folder in spark.checkpoint.dir."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
