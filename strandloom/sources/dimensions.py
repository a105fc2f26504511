"""Dimension tables from CSV files: vocabularies, registry, compilation list, ignore list, thesaurus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.sources.files import Folder


def read_text_table(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False, sep=separator, multiLine=True, escape='"', nullValue="")


def read_vocabularies(spark: SparkSession, folder: str) -> DataFrame:
    """(vocab_key, name, synonym, place) from one CSV a vocabulary, with a column lipdName, maybe synonym, and others; the key is the file's name.

    Each file has its own header. place is the order of listing inside a vocabulary, as a file is read by one task.
    """
    parts = []
    for name in Folder(spark, folder).names(r"^[^._].*\.csv$"):
        lines = read_text_table(spark, f"{folder}/{name}")
        if "lipdName" not in lines.columns:
            raise ValueError(f"{name} has no column lipdName")
        synonym = F.col("synonym") if "synonym" in lines.columns else F.lit(None).cast("string")
        parts.append(lines.select(F.lit(name.removesuffix(".csv")).alias("vocab_key"), F.col("lipdName").alias("name"), synonym.alias("synonym"), F.monotonically_increasing_id().alias("place")))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], "vocab_key string, name string, synonym string, place long")


def read_thesaurus(spark: SparkSession, path: str) -> DataFrame:
    """(id, label, alt, definition, broader) from a JSON-LD file of concepts."""
    schema = "`@graph` array<struct<`@id`: string, `@type`: string, prefLabel: string, altLabel: array<string>, definition: string, broader: string>>"
    graph = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("@graph").alias("c"))
    return graph.where(F.col("c.@type").endswith("Concept")).select(F.col("c.@id").alias("id"), F.col("c.prefLabel").alias("label"), F.coalesce("c.altLabel", F.expr("cast(array() as array<string>)")).alias("alt"), "c.definition", "c.broader")


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """Review items with their proposal and decision flattened."""
    schema = "vocab_key string, value string, datasets array<string>, proposed struct<decision: string, target: string, confidence: string>, decision struct<decision: string, target: string, also_field: string, also_value: string>"
    items = spark.read.schema(schema).json(path)
    return items.select("vocab_key", "value", "datasets", F.col("proposed.decision").alias("proposed"), F.col("proposed.target").alias("proposed_target"), F.col("proposed.confidence").alias("confidence"), F.col("decision.decision").alias("decision"), F.col("decision.target").alias("target"), F.col("decision.also_field").alias("also_field"), F.col("decision.also_value").alias("also_value"))


def write_review(items: DataFrame, path: str) -> None:
    """The nested form of read_review, as JSON lines."""
    nested = items.select("vocab_key", "value", "datasets", F.struct(F.col("proposed").alias("decision"), F.col("proposed_target").alias("target"), "confidence").alias("proposed"), F.struct("decision", "target", "also_field", "also_value").alias("decision"))
    nested.write.mode("error").json(path)
