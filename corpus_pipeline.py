"""The corpus pipeline: documents to packed training sequences.

Each stage takes the rows the one before it kept and returns the columns of
``documents``; the last returns one row per piece of a packed sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabreg.llm import dartminhash, language_id, mixing, packing
from tabreg.llm.common import cut, ship_package, table
from tabreg.llm.queries import tokenizer_path
from tabreg.sources.scratch import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told or whose text isn't in any."""
    ship_package(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of each group of near duplicates."""
    ship_package(spark)
    return dartminhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents drawn for the target shares of source, language and topic."""
    ship_package(spark)
    return mixing.keep_sampled(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 2048 ids; pieces carry their ids."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path(), with_ids=True)


STAGES = [("language_id", identify_language), ("near_duplicates", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack_documents)]

#: The stages fit models and draw signatures that SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each stage's table, and what its own tables were, goes once the next one is written."""
    with Scratch(spark, "pipeline") as run:
        docs, before = table(spark, sf_dir, "documents"), None
        for name, stage in STAGES[:-1]:
            with Scratch(spark, name) as own:
                written = cut(stage(spark, docs, sf_dir), f"stage-{name}")
                own.keep(written)
            if before is not None:
                run.drop(before)
            docs = before = written
        run.keep(docs)
        return STAGES[-1][1](spark, docs, sf_dir)
