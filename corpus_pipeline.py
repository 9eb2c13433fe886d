"""A corpus from raw documents to packed sequences, in stages.

Each stage reads all that its predecessor kept, as a table, and is one operator of ``postroom.llm``;
all but the last return the columns of ``documents``. An operator's verdict is on a row's id and its
text together (``text_hash``), a null id being like any other: rows that share an id go by their own
text, rows without one are judged too.

Defined results, for all stages: an empty table gives no rows; a null text is like an empty one but
comes out null; other columns pass through unread, whatever their names; repeated rows are judged
alike. ``quality``: a null language is a language without trusted texts, held against all languages'
model. ``toxic``: without labels nothing is rejected. ``near_dedup``: of each group the row with the
smallest id stays (rows without an id last), of rows with that id the one whose text hashes lowest,
of repeated rows one; texts without words are one group. ``mixture``: rows without an id share one
chance; without labelled domains all rows stay once. ``packed``: every row is packed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common, mixing, packing, perplexity, simhash, toxicity


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are rejected (doc_id, text_hash). The keys go to
    the documents' tasks while they are counted to be few; beyond that both sides are shuffled."""
    keys = rejected.select(F.col("doc_id").alias("rejected_id"), F.col("text_hash").alias("rejected_hash")).distinct()
    return docs.join(common.small(common.staged(keys, "rejected")), _same_row("rejected"), "left_anti")


def _same_row(name: str) -> Column:
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return F.col("doc_id").eqNullSafe(F.col(f"{name}_id")) & (own == F.col(f"{name}_hash"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    trusted = common.table(spark, sf_dir, "labels").where("quality = 1")
    return _without(docs, perplexity.quality_classifier(docs, trusted).where("not kept"))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network finds toxic go."""
    found = toxicity.toxicity(docs, common.table(spark, sf_dir, "labels"))
    return _without(docs, found.where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    groups = common.staged(simhash.simhash_groups(docs).select("doc_id", "text_hash", "component"), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    first = groups.groupBy("component").agg(F.min(order).alias("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    kept = _without(docs, groups.join(first, "component").where(~same))
    # rows with one id and one text are repeated rows as a rule; those few are told apart by the rest
    again = groups.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    again = again.select(F.col("doc_id").alias("again_id"), F.col("text_hash").alias("again_hash"))
    again = common.small(common.staged(again, "repeated"))
    once, several = kept.join(again, _same_row("again"), "left_anti"), kept.join(again, _same_row("again"), "left_semi")
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    least = several.select("doc_id", "text", F.struct(F.lit(0), *rest).alias("rest")).groupBy("doc_id", F.coalesce("text", F.lit("")).alias("like")).agg(F.min(F.struct("rest", "text")).alias("r"))
    back = {c: F.col(f"r.rest.c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    picked = least.select(*[F.col("doc_id") if c == "doc_id" else F.col("r.text").alias(c) if c == "text" else back[c].alias(c) for c in docs.columns])
    return once.unionByName(picked)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say."""
    return mixing.mix(docs, mixing.trusted_languages(docs, common.table(spark, sf_dir, "labels")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.packed_digests(docs)


STAGES = [("quality", quality), ("toxicity", toxic), ("near_dedup", near_dedup), ("mixture", mixture), ("packing", packed)]
#: The stages train models and follow links between documents, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
