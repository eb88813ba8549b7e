"""The training-data pipeline: five stages over the documents table.

Each stage takes what its predecessor kept, as a Parquet table:

1. ``toxicity``          documents that score 0.5 or more go,
2. ``line_dedup``        recurring line templates are taken out of the texts,
3. ``near_duplicates``   of linked documents (five-word shingles, Jaccard at
                         0.8 or more) the one with the smallest id stays,
4. ``decontamination``   documents that hold a benchmark window go,
5. ``packing``           the rest is packed into sequences of 2048 tokens.

All but the last return the columns of their input.  Defined results for nulls,
empty texts, repeated rows and empty tables are those of the operators; a
document whose text becomes empty stays, and of repeated rows that are equal
in id and text the least stays after stage 3 (all, where they have no words).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import table
from vigil.llm.decontaminate import decontaminate
from vigil.llm.neardup import near_duplicates
from vigil.llm.packing import pack
from vigil.llm.templates import drop_lines
from vigil.llm.toxicity import fit, score
from vigil.session import materialize

THRESHOLD = 0.5
SHINGLE = 5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    toxic = score(spark, fit(docs, table(spark, sf_dir, "labels")))
    return docs.where(toxic(F.col("text")) < THRESHOLD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = docs.withColumn("__row_lines", F.col("__lines")) if "__lines" in docs.columns else docs
    out = drop_lines(own).drop("__lines").withColumnRenamed("__row_lines", "__lines")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows as a struct beside the key of their document, so that no column can clash."""
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("own"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = (near_duplicates(docs, k=SHINGLE).where("kept").groupBy("doc_id", "text_hash")
            .agg(F.max("n_shingles").alias("n")).select(F.struct("doc_id", "text_hash").alias("key"), "n"))
    j = _keyed(docs).join(kept, F.col("own").eqNullSafe(F.col("key")))
    wordless = F.when(F.col("n") == 0, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    # of rows alike in id and text the one whose other columns are least as text
    others = F.to_json(F.struct(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "text"]))
    return j.withColumn("one", wordless).groupBy("own", "one").agg(F.min_by("row", others).alias("row")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark"), columns=docs.columns)
    return marked.where("not contaminated").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Not expressible in SQL (learnt scores, sketches, a tokeniser); tests/llm holds a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
