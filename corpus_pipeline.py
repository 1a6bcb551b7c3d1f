"""Corpus pipeline: quality rules, near duplicates, substring dedup, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows
its predecessor kept. Stages one to four return the columns of ``docs``; the last
returns token ids. ``run`` writes each stage as Parquet in the shared folder
(``spark.checkpoint.dir``) and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotplan.llm import jaccard_join, mixing, quality_rules, sentencepiece_lattice, substring_dedup
from slotplan.llm.common import settled, table, touched
from slotplan.operators.quality import keep_where

#: target token shares; the budget is what the clean documents fill without repeats
MIX_TARGETS = {"clean": 0.97, "toxic": 0.02, "junk": 0.01}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what policy v2 keeps. The ledger is measured beside the row, so no join is needed.

    Null, empty and blank texts have no words and go; repeated rows are judged alike and stay
    as often as they came; an empty table stays empty; all columns are carried whole.
    """
    own = [F.col(c) for c in docs.columns]
    tagged = docs.select(F.struct(*own).alias("_row"), F.col("text").alias("_in"))
    judged = quality_rules.apply_policy(quality_rules.ledger(tagged, id_col="_row", text_col="_in"))
    return keep_where(judged, F.col("kept")).select("doc_id.*").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts stays: the smallest id (null last), once.

    Rows are judged by id and text together, so rows that share an id fall apart where
    their texts do, and rows without an id are judged like any other. Null and empty texts
    link with nothing and stay; rows that share id and text stay once where all their
    columns agree; an empty table stays empty; all columns are carried whole, whatever
    their names.
    """
    whole = docs.select(F.struct(*docs.columns).alias("_row"))
    id_, text = F.col("_row")["doc_id"], F.col("_row")["text"]
    rows_in = whole.select("_row", F.xxhash64(id_, text).alias("_key"), id_.alias("_id"))
    linked = jaccard_join.linked_components(whole.select(F.xxhash64(id_, text).alias("_key"), text.alias("_text")), id_col="_key", text_col="_text")
    groups = settled(linked.select(F.col("doc_id").alias("_key"), F.col("component_id").alias("_comp")), "pipeline-groups")
    # of groups with two rows or more only
    many = settled(groups.groupBy("_comp").count().where("count > 1").select("_comp"), "pipeline-many")
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_key").alias("key"))
    rows = settled(groups.join(many, "_comp", "left_semi").distinct()
                   .join(rows_in.select("_key", "_id").distinct(), "_key").select("_comp", "_key", "_id", place.alias("_place")),
                   "pipeline-rows")
    first = settled(rows.groupBy("_comp").agg(F.min("_place").alias("_first")), "pipeline-first")
    drop = settled(rows.join(first, "_comp").where("_place <> _first").select(F.col("_key").alias("_gone"), F.col("_id").alias("_gone_id")), "pipeline-drop")
    # rows that share id and text: those that share all columns stay once
    again = settled(groups.groupBy("_key").count().where("count > 1").select("_key"), "pipeline-again")
    # texts that neither list names stay where they are; only the others are shuffled
    alone, rest = touched(rows_in, drop.select(F.col("_gone").alias("_key")).unionByName(again), "_key")
    kept = rest.join(drop, (F.col("_key") == F.col("_gone")) & F.col("_id").eqNullSafe(F.col("_gone_id")), "left_anti")
    if again.isEmpty():
        return alone.unionByName(kept).select("_row.*")
    return (alone.unionByName(kept.join(again, "_key", "left_anti")).select("_row.*")
            .unionByName(kept.join(again, "_key", "left_semi").select("_row.*").distinct()))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut from the texts; texts without one stay as they are.

    Null texts stay null; every row stays, repeated ones too (their passages repeat, so they
    are cut); an empty table stays empty; other columns are carried whole, ``n_chars`` follows
    the text.
    """
    out = substring_dedup.dedup(docs)
    cols = {c: F.col("row")[c] for c in docs.columns if c != "text"} | {"text": F.col("kept_text")}
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        cols["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(kind)).otherwise(cols["n_chars"])
    return out.select(*[cols[c].alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that expected token shares meet the targets.

    Documents labelled clean, or mainly clean by the model, all stay. Texts without tokens
    count nothing; repeated rows are drawn alike; an empty table stays empty; all columns are
    carried whole.
    """
    labels = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labels, MIX_TARGETS, once="clean")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, one row per row.

    Null and empty texts have no ids and round-trip to empty; repeated rows are encoded alike;
    an empty table gives an empty result; other columns are left out.
    """
    return sentencepiece_lattice.encode(docs, sentencepiece_lattice.load())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", substrings),
    ("mixing", mixture),
    ("sentencepiece", encoding),
]

#: trained models and tokenisation are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
