"""The network of persons named together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiva.functions.text import split_list
from archiva.session import checkpoint


def mentions(df: DataFrame, persons: str = "personas") -> DataFrame:
    """``df`` with persona: a row per mention, repeated ones too."""
    return df.withColumn("persona", F.explode(split_list(F.col(persons)))).drop(persons)


def edges(df: DataFrame, persons: str = "personas") -> DataFrame:
    """persona_a < persona_b and peso, the records that name both. Pairs are made in the record, without a shuffle."""
    p = df.select(F.array_sort(F.array_distinct(split_list(F.col(persons)))).alias("p")).where(F.size("p") > 1)
    one = p.select(F.posexplode("p").alias("i", "persona_a"), F.col("p"))
    two = one.select("persona_a", F.explode(F.slice("p", F.col("i") + F.lit(2), F.size("p"))).alias("persona_b"))
    return two.groupBy("persona_a", "persona_b").agg(F.count("*").alias("peso"))


def edge_records(df: DataFrame, key: str, persons: str = "personas") -> DataFrame:
    """persona_a < persona_b and ``key``: where each edge comes from, a row per record that names both."""
    p = df.select(key, F.array_sort(F.array_distinct(split_list(F.col(persons)))).alias("p")).where(F.size("p") > 1)
    one = p.select(key, F.posexplode("p").alias("i", "persona_a"), F.col("p"))
    return one.select("persona_a", F.explode(F.slice("p", F.col("i") + F.lit(2), F.size("p"))).alias("persona_b"), key)


def top(n: DataFrame, by: str, k: int = 10) -> DataFrame:
    """The k nodes with most of ``by``; ties by name."""
    return n.orderBy(F.desc(by), "persona").limit(k)


def degrees(e: DataFrame) -> DataFrame:
    """persona, grado, grado_ponderado."""
    ends = e.select(F.explode(F.array("persona_a", "persona_b")).alias("persona"), "peso")
    return ends.groupBy("persona").agg(F.count("*").alias("grado"), F.sum("peso").alias("grado_ponderado"))


def nodes(df: DataFrame, e: DataFrame) -> DataFrame:
    """persona, frecuencia (mentions), grado, grado_ponderado, n_tomos, tomos, anio_min, anio_max (0 if unknown)."""
    m = mentions(df.select("personas", "tomo_id", "anio_num"))
    n = m.groupBy("persona").agg(
        F.count("*").alias("frecuencia"), F.array_sort(F.collect_set("tomo_id")).alias("_t"), F.coalesce(F.min("anio_num"), F.lit(0)).alias("anio_min"), F.coalesce(F.max("anio_num"), F.lit(0)).alias("anio_max")
    )
    j = n.join(degrees(e), "persona", "left").fillna(0, ["grado", "grado_ponderado"])
    return j.select("persona", "frecuencia", "grado", "grado_ponderado", F.size("_t").alias("n_tomos"), F.array_join("_t", "; ").alias("tomos"), "anio_min", "anio_max")


def components(vertices: DataFrame, e: DataFrame, most: int = 60) -> DataFrame:
    """persona, componente (its least name): connected components by least labels with shortcuts.

    Each round takes the least label of the neighbours, then the label of that label, so long paths shrink fast; it
    ends when nothing changes. The labels are checkpointed each round, so a lost executor costs little.
    """
    both = e.select(F.col("persona_a").alias("a"), F.col("persona_b").alias("b")).union(e.select("persona_b", "persona_a")).distinct()
    both = checkpoint(both)
    labels = vertices.select(F.col("persona").alias("v"), F.col("persona").alias("c"))
    before = None
    for k in range(most):
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("c").alias("m"))
        labels = labels.join(near, F.col("v") == F.col("a"), "left").select("v", F.least("c", F.coalesce("m", "c")).alias("c"))
        up = labels.select(F.col("v").alias("u"), F.col("c").alias("cc"))
        labels = checkpoint(labels.join(up, F.col("c") == F.col("u"), "left").select("v", F.least("c", F.coalesce("cc", "c")).alias("c")))
        now = labels.agg(F.sum(F.xxhash64("v", "c").cast("decimal(38,0)"))).collect()[0][0]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"labels still change after {most} rounds")
    return labels.select(F.col("v").alias("persona"), F.col("c").alias("componente"))


def stats(df: DataFrame, n: DataFrame, e: DataFrame, comp: DataFrame) -> DataFrame:
    """One row of measures of the network."""
    records = df.select(F.size(F.array_distinct(split_list(F.col("personas")))).alias("k"))
    r = records.agg(F.count("*").alias("contratos"), F.count_if(F.col("k") > 0).alias("contratos_con_personas"), F.count_if(F.col("k") > 1).alias("contratos_con_2_o_mas"))
    a = n.agg(F.count("*").alias("nodos"), F.sum("frecuencia").alias("menciones"), F.max("grado").alias("grado_max"))
    b = e.agg(F.count("*").alias("aristas"), F.sum("peso").alias("peso_total"), F.max("peso").alias("peso_max"))
    c = comp.groupBy("componente").agg(F.count("*").alias("s")).agg(F.count("*").alias("componentes"), F.max("s").alias("gigante"))
    j = r.crossJoin(a).crossJoin(b).crossJoin(c)
    pairs = F.col("nodos") * (F.col("nodos") - 1)
    return j.withColumn("densidad", F.when(F.col("nodos") > 1, 2 * F.col("aristas") / pairs).otherwise(0.0)).withColumn("gigante_pct", F.when(F.col("nodos") > 0, 100 * F.col("gigante") / F.col("nodos")).otherwise(0.0))
