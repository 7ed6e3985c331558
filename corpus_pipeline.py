"""The corpus pipeline: toxicity, exact copies, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in
the shared scratch folder and reads again as the next stage's ``docs``.  All stages but the last
return the columns of ``docs``.  Lists of ids that are dropped or taken grow with the input, so
they meet the documents in merge joins at every size.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhour.llm.chain import document_labels, score_documents
from dockhour.llm.common import written
from dockhour.llm.jaccard import jaccard_components, set_nodes
from dockhour.llm.mixing import mix
from dockhour.llm.naming import exact_groups, text_variant
from dockhour.llm.packing import pack
from dockhour.llm.tokens import vocabulary


# The columns that stages look at; all others travel under names that nothing inside uses.
USED = ("doc_id", "text", "source")


def keeps_columns(stage: Callable) -> Callable:
    """The stage with any further columns, whatever their names, returned unchanged."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"further_column_{i}" for i, c in enumerate(docs.columns) if c not in USED}
        out = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        return out.withColumnsRenamed({new: c for c, new in aside.items()})

    return run_stage


@keeps_columns
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject; null and blank texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(docs, document_labels(labels))
    return scored.filter(~F.col("rejected")).select(*docs.columns)


@keeps_columns
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts; repeated rows become one.

    Empty texts count as equal.  Rows of one id with different texts are different documents.
    """
    groups = written(exact_groups(docs).select("doc_id", "variant", "kept", "times"), "groups")
    keyed = docs.withColumn("_variant", text_variant(F.col("text")))

    def same(other: DataFrame):
        return keyed["doc_id"].eqNullSafe(other["doc_id"]) & (
            keyed["_variant"] == other["variant"])

    dropped = groups.filter(~F.col("kept")).hint("merge")
    kept = keyed.join(dropped, same(dropped), "left_anti")
    repeated = groups.filter("kept AND times > 1")
    if not repeated.isEmpty():
        kept = written(kept, "kept")
        on = kept["doc_id"].eqNullSafe(repeated["doc_id"]) & (
            kept["_variant"] == repeated["variant"])
        kept = kept.join(repeated.hint("merge"), on, "left_anti").unionByName(
            kept.join(repeated.hint("merge"), on, "left_semi")
            .dropDuplicates(["doc_id", "_variant"]))
    return kept.select(*docs.columns)


@keeps_columns
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; five words, similarity 0.8 or more.

    Documents without an id stay where no document with an id is linked to them, one row of each
    component; texts without words are linked to nothing and stay.
    """
    linked = written(jaccard_components(docs, k=5, percent=80, with_root=True), "linked")
    dropped = linked.filter("doc_id <> component_id").select(
        F.col("doc_id").alias("_id")).distinct().hint("merge")
    named = docs.filter("doc_id IS NOT NULL")
    kept = named.join(dropped, named["doc_id"] == dropped["_id"], "left_anti")
    # The key of rows without an id is written, so that it is the same wherever it is read.
    lone = written(docs.filter("doc_id IS NULL").withColumn(
        "_key", F.monotonically_increasing_id()), "no-id")
    if lone.isEmpty():
        return kept
    nodes = written(set_nodes(lone, 5, "_key"), "no-id-nodes")
    open_roots = linked.filter("doc_id IS NULL AND component_id IS NULL AND n_shingles > 0").select(
        "node", "root").distinct().hint("merge")
    stay = nodes.filter("n > 0").join(open_roots, "node").groupBy("root").agg(
        F.min("key").alias("_stay")).select("_stay").unionByName(
        nodes.filter("n = 0").select(F.col("key").alias("_stay"))).hint("merge")
    return kept.unionByName(lone.join(stay, lone["_key"] == stay["_stay"], "left_semi").select(
        *docs.columns))


@keeps_columns
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; repeated rows share the larger number."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "source", "text"))
    taken = (mix(keyed, carry=("_key",)).filter("copies > 0").groupBy("_key", "doc_id")
             .agg(F.max("copies").cast("int").alias("_copies")))
    taken = written(taken.select("_key", F.col("doc_id").alias("_id"), "_copies"), "taken")
    on = (F.col("_key") == F.col("_taken_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    both = keyed.join(taken.withColumnRenamed("_key", "_taken_key").hint("merge"), on)
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(
        *docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of 4096 at most with their sequence and offset."""
    return pack(docs, vocabulary(), end_id=1, capacity=4096)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("source_mix", source_mix), ("packing", packing)]

# A trained classifier and a tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
