"""A corpus from raw documents: quality, near-copies, contamination, secrets, token ids.

Each stage takes the documents that its predecessor kept, all of them, and all but the last return the same columns, other
ones of any name included. ``run`` writes what a stage returns as Parquet in the shared folder and reads it again, so a lost
executor repeats one stage at most; scratch tables of a stage, and what the stage before it returned, go once that is written.

Null and empty texts count as texts without words: all of them have one fingerprint, so one of them stays if the classifier
keeps it. A row without an id is a document like any other. Repeated rows are near-copies of each other: one stays. An empty
table gives an empty result; without labels nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidebars.llm import bpe, decontamination, quality as quality_rules, secret_scan, simhash
from tidebars.llm.frames import documents
from tidebars.llm.queries import BYTE_BPE, coded_digests
from tidebars.session import remove_folder, scratch_dir, scratch_run


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the documents it is given."""
    return quality_rules.keep_good(docs, quality_rules.fit_rules(docs, documents(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays."""
    return simhash.drop_near_copies(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth lies inside benchmark windows go."""
    return decontamination.decontaminate(docs, documents(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; all documents stay."""
    return secret_scan.redact_secrets(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the texts and the texts that the ids stand for, as digests."""
    return coded_digests(bpe.round_trip(docs, public_tokenizers.path(BYTE_BPE)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("contamination", contamination),
    ("secrets", secrets),
    ("token_ids", token_ids),
]

#: A classifier, SimHash and byte-pair merges have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        with scratch_run(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
