"""Queries on the spellings of persons and companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.llm.variants import linked_nodes, pairs
from archiva.session import checkpoint, spread, table


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each node of the person networks, with its canonical form."""
    nodes = spread(table(spark, sf_dir, "red_personas_nodos", "nodo_id", "run_id", "persona", "frecuencia"))
    return linked_nodes(nodes, "nodo_id", "run_id", "persona", "frecuencia", checkpoint)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(p2_classes(spark, sf_dir), "nodo_id", "run_id")


def p2_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons by number of spellings."""
    per = p2_classes(spark, sf_dir).groupBy("run_id", "canonica").agg(F.count("*").alias("formas"))
    return per.groupBy("run_id", "formas").agg(F.count("*").alias("n"))


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes, "p2_spread": p2_spread}
SQL: dict[str, str] = {}
