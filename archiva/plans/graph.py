"""Queries on the network of persons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archiva.operators import graph
from archiva.session import table


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "compilado", "personas", "tomo_id", "anio_num")


def q_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edges(_records(spark, sf_dir))


def q_edges_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten heaviest edges; ties by names."""
    return q_edges(spark, sf_dir).orderBy(F.desc("peso"), "persona_a", "persona_b").limit(10)


def q_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _records(spark, sf_dir)
    return graph.nodes(d, graph.edges(d))


def q_nodes_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten persons named most often and the ten with most neighbours, by (a top-k report)."""
    n = q_nodes(spark, sf_dir)
    each = [graph.top(n, by).select(F.lit(by).alias("por"), "persona", F.col(by).cast("bigint").alias("valor")) for by in ("frecuencia", "grado")]
    return each[0].unionByName(each[1])


def q_edge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each edge comes from."""
    return graph.edge_records(table(spark, sf_dir, "compilado", "contrato_idx", "personas"), "contrato_idx")


def q_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degrees(q_edges(spark, sf_dir))


def q_degree_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees by run from the stored edges, against those of the stored nodes."""
    e = table(spark, sf_dir, "red_personas_aristas")
    ends = e.select("run_id", F.explode(F.array("persona_a", "persona_b")).alias("persona"), "peso").groupBy("run_id", "persona").agg(F.count("*").alias("grado"), F.sum("peso").alias("grado_ponderado"))
    n = table(spark, sf_dir, "red_personas_nodos", "run_id", "persona", "nodo_id", F.col("grado").alias("grado_nodo"))
    return n.join(ends, ["run_id", "persona"], "left").select("nodo_id", F.coalesce("grado", F.lit(0)).alias("grado"), F.coalesce("grado_ponderado", F.lit(0)).alias("grado_ponderado"), "grado_nodo")


def q_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _records(spark, sf_dir)
    e = graph.edges(d)
    return graph.components(graph.mentions(d.select("personas")).distinct(), e)


def q_graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _records(spark, sf_dir)
    e = graph.edges(d)
    return graph.stats(d, graph.nodes(d, e), e, graph.components(graph.mentions(d.select("personas")).distinct(), e))


def q_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes, edges and density in millionths."""
    d = _records(spark, sf_dir)
    n = graph.mentions(d.select("personas")).agg(F.count_distinct("persona").alias("nodos"))
    m = graph.edges(d).agg(F.count("*").alias("aristas"))
    pairs = F.col("nodos") * (F.col("nodos") - 1)
    return n.crossJoin(m).withColumn("densidad_ppm", F.when(F.col("nodos") > 1, F.floor(2_000_000 * F.col("aristas") / pairs)).otherwise(F.lit(0)))


QUERIES = {f.__name__: f for f in (q_edges, q_edges_top10, q_edge_records, q_nodes, q_nodes_top10, q_degree, q_degree_tables, q_components, q_graph_stats, q_density)}

_P = r"""p AS (SELECT contrato_idx, tomo_id, anio_num, unnest(list_filter(list_transform(string_split(coalesce(personas, ''), ';'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS persona FROM compilado),
d AS (SELECT DISTINCT contrato_idx, persona FROM p), e AS (SELECT a.persona AS persona_a, b.persona AS persona_b, count(*) AS peso FROM d a JOIN d b ON a.contrato_idx = b.contrato_idx AND a.persona < b.persona GROUP BY 1, 2),
g AS (SELECT persona, count(*) AS grado, sum(peso)::bigint AS grado_ponderado FROM (SELECT persona_a AS persona, peso FROM e UNION ALL SELECT persona_b, peso FROM e) GROUP BY 1)"""
SQL = {
    "q_edges": f"WITH {_P} SELECT * FROM e",
    "q_edges_top10": f"WITH {_P} SELECT * FROM e ORDER BY peso DESC, persona_a, persona_b LIMIT 10",
    "q_edge_records": f"WITH {_P} SELECT a.persona AS persona_a, b.persona AS persona_b, contrato_idx FROM d a JOIN d b USING (contrato_idx) WHERE a.persona < b.persona",
    "q_nodes_top10": f"""WITH {_P}, f AS (SELECT persona, count(*) AS frecuencia FROM p GROUP BY 1) (SELECT 'frecuencia' AS por, persona, frecuencia AS valor FROM f ORDER BY valor DESC, persona LIMIT 10)
  UNION ALL (SELECT 'grado' AS por, f.persona, coalesce(grado, 0)::bigint AS valor FROM f LEFT JOIN g USING (persona) ORDER BY valor DESC, f.persona LIMIT 10)""",
    "q_degree": f"WITH {_P} SELECT * FROM g",
    "q_nodes": f"""WITH {_P}, n AS (SELECT persona, count(*) AS frecuencia, list_sort(list_distinct(list(tomo_id) FILTER (WHERE tomo_id IS NOT NULL))) AS t, coalesce(min(anio_num), 0) AS anio_min, coalesce(max(anio_num), 0) AS anio_max FROM p GROUP BY 1)
  SELECT n.persona, frecuencia, coalesce(grado, 0) AS grado, coalesce(grado_ponderado, 0) AS grado_ponderado, coalesce(len(t), 0)::int AS n_tomos, coalesce(array_to_string(t, '; '), '') AS tomos, anio_min, anio_max FROM n LEFT JOIN g ON n.persona = g.persona""",
    "q_degree_tables": """WITH g AS (SELECT run_id, persona, count(*) AS grado, sum(peso)::bigint AS gp FROM (SELECT run_id, persona_a AS persona, peso FROM red_personas_aristas UNION ALL SELECT run_id, persona_b, peso FROM red_personas_aristas) GROUP BY 1, 2)
  SELECT nodo_id, coalesce(g.grado, 0) AS grado, coalesce(gp, 0) AS grado_ponderado, n.grado AS grado_nodo FROM red_personas_nodos n LEFT JOIN g ON n.run_id = g.run_id AND n.persona = g.persona""",
    "q_components": f"""WITH RECURSIVE {_P}, u AS (SELECT persona_a AS a, persona_b AS b FROM e UNION ALL SELECT persona_b, persona_a FROM e),
  c(v, l) AS (SELECT DISTINCT persona, persona FROM p UNION SELECT u.b, c.l FROM c JOIN u ON u.a = c.v WHERE c.l < u.b)
  SELECT v AS persona, min(l) AS componente FROM c GROUP BY v""",
    "q_density": f"WITH {_P} SELECT nodos, aristas, CASE WHEN nodos > 1 THEN floor(2000000 * aristas / (nodos * (nodos - 1)))::bigint ELSE 0 END AS densidad_ppm FROM (SELECT (SELECT count(DISTINCT persona) FROM p) AS nodos, (SELECT count(*) FROM e) AS aristas)",
}
SQL["q_graph_stats"] = SQL["q_components"].replace("SELECT v AS persona, min(l) AS componente FROM c GROUP BY v", """, k AS (SELECT v AS persona, min(l) AS componente FROM c GROUP BY v), s AS (SELECT count(*) AS s FROM k GROUP BY componente),
  r AS (SELECT contrato_idx, (SELECT count(*) FROM d WHERE d.contrato_idx = q.contrato_idx) AS k FROM compilado q), m AS (SELECT persona, count(*) AS f FROM p GROUP BY 1)
  SELECT *, CASE WHEN nodos > 1 THEN 2 * aristas / (nodos * (nodos - 1)) ELSE 0 END AS densidad, CASE WHEN nodos > 0 THEN 100 * gigante / nodos ELSE 0 END AS gigante_pct FROM (SELECT
  (SELECT count(*) FROM r) AS contratos, (SELECT count(*) FROM r WHERE k > 0) AS contratos_con_personas, (SELECT count(*) FROM r WHERE k > 1) AS contratos_con_2_o_mas, (SELECT count(*) FROM m) AS nodos,
  (SELECT sum(f)::bigint FROM m) AS menciones, coalesce((SELECT max(grado) FROM g), 0) AS grado_max, (SELECT count(*) FROM e) AS aristas, (SELECT sum(peso)::bigint FROM e) AS peso_total, (SELECT max(peso) FROM e) AS peso_max,
  (SELECT count(*) FROM s) AS componentes, (SELECT max(s) FROM s) AS gigante)""")
