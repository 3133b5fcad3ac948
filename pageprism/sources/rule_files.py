"""Rule and category files."""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.operators.rules import RuleSet, load_rules


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``file, text`` of every JSON file in a folder."""
    return spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def texts(spark: SparkSession, named: dict[str, str]) -> DataFrame:
    """``file, text`` of rule texts that the driver already holds."""
    return spark.createDataFrame(sorted(named.items()), "file string, text string")


def read_rules(spark: SparkSession, rules_path: str, categories_path: str | None = None) -> RuleSet:
    return load_rules(read_texts(spark, rules_path),
                      read_texts(spark, categories_path) if categories_path else None)


def sample_rules(spark: SparkSession) -> RuleSet:
    """The small rule set that ships with the package."""
    folder = resources.files("pageprism.rules")
    return load_rules(
        texts(spark, {"sample.json": folder.joinpath("sample.json").read_text("utf-8")}),
        texts(spark, {"categories.json": folder.joinpath("categories.json").read_text("utf-8")}))
