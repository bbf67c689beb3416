"""Cluster reports (K3-K9): TEXT, CSV, GRAPH_ML and JSON.

Every report is first a DataFrame of rows with explicit sort keys; writers sort by
those keys (a distributed range sort) and write text/JSON part files whose
concatenation in name order is the report. No report row grows with a cluster:
member lists are cut into lines of at most ``line_points`` ids.

Reports list every cluster of the model, also one without points (``sizes`` from
``cluster_sizes(points, clusters=centers)``). Layouts (the TEXT labels are fixed values: they
follow the layout users of the original know; CSV, GraphML and JSON rows are ours):
  TEXT   VL-<id>{n=<n>}                 cluster header
         \tTop Terms:                   then  \t\t<term> => <weight>
         \tWeight : [props - optional]:  Point:   then  \t<weight> : [distance=<d>]: <id>
  CSV    <cluster_id>,<id>,<id>,...     ids in id order; the cluster id alone if it is empty
  GRAPH  GraphML: one node per cluster (c<id>) and per point (p<id>), one edge per membership
  JSON   one object per row: kind cluster | term | point
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopus.config import DumpConfig
from canopus.operators.topk import cap_points, cluster_sizes, member_lines

FORMATS = ("TEXT", "CSV", "GRAPH_ML", "JSON")


def _num(c, fmt="%.6f"):
    # format_string renders NULL as "null"; reports print NaN
    return F.when(c.isNull(), F.lit("NaN")).otherwise(F.format_string(fmt, c))


def _label(c, substring):
    c = c.cast("string")
    return F.substring(c, 1, substring) if substring is not None and substring >= 0 else c


def report_text(terms: DataFrame, points: DataFrame, sizes: DataFrame, cfg: DumpConfig = DumpConfig(),
                id_col: str = "doc_id") -> DataFrame:
    """``(cluster_id, section, seq, sort_id, line)``; sections 0 header, 1 terms, 2 points."""
    s = lambda v: F.lit(v).cast("int")
    pts = cap_points(points, cfg.max_points, order_col=id_col)
    header = sizes.select("cluster_id", s(0).alias("section"), s(0).alias("seq"), F.lit("").alias("sort_id"),
                          F.concat(F.lit("VL-"), F.col("cluster_id").cast("string"), F.lit("{n="),
                                   F.col("n").cast("string"), F.lit("}")).alias("line"))
    term_head = sizes.select("cluster_id", s(1).alias("section"), s(0).alias("seq"), F.lit("").alias("sort_id"),
                             F.lit("\tTop Terms:").alias("line"))
    term_rows = terms.select("cluster_id", s(1).alias("section"), F.col("rank").cast("int").alias("seq"),
                             F.lit("").alias("sort_id"),
                             F.concat(F.lit("\t\t"), _label(F.col("term"), cfg.substring), F.lit(" => "),
                                      _num(F.col("weight"))).alias("line"))
    pt_head = sizes.select("cluster_id", s(2).alias("section"), s(0).alias("seq"), F.lit("").alias("sort_id"),
                           F.lit("\tWeight : [props - optional]:  Point:").alias("line"))
    pt_rows = pts.select("cluster_id", s(2).alias("section"), s(1).alias("seq"),
                         F.col(id_col).cast("string").alias("sort_id"),
                         F.concat(F.lit("\t"), _num(F.col("weight"), "%.1f"), F.lit(" : [distance="),
                                  _num(F.col("distance")), F.lit("]: "),
                                  _label(F.col(id_col), cfg.substring)).alias("line"))
    return header.unionByName(term_head).unionByName(term_rows).unionByName(pt_head).unionByName(pt_rows)


def report_csv(points: DataFrame, cfg: DumpConfig = DumpConfig(), id_col: str = "doc_id",
               sizes: DataFrame | None = None) -> DataFrame:
    """``(cluster_id, chunk, line)``."""
    pts = cap_points(points, cfg.max_points, order_col=id_col)
    lines = member_lines(pts, cfg.line_points, id_col)
    name = F.col("cluster_id").cast("string")
    out = lines.select("cluster_id", "chunk", F.concat(name, F.lit(","), F.col("members")).alias("line"))
    if sizes is None:
        return out
    return out.unionByName(sizes.where(F.col("n") == 0).select("cluster_id", F.lit(0).cast("long").alias("chunk"), name.alias("line")))


def _xml(c):
    c = c.cast("string")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def report_graph(points: DataFrame, sizes: DataFrame, cfg: DumpConfig = DumpConfig(),
                 id_col: str = "doc_id", terms: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``nodes(node_id, kind, label, n, terms)`` and ``edges(source, target, weight, distance)``;
    ``terms`` of a cluster node are its top terms in rank order, comma-joined."""
    pts = cap_points(points, cfg.max_points, order_col=id_col)
    if terms is not None:
        own = F.array_sort(F.collect_list(F.struct("rank", _label(F.col("term"), cfg.substring).alias("t"))))   # top_n terms
        sizes = sizes.join(terms.groupBy("cluster_id").agg(F.array_join(F.transform(own, lambda x: x["t"]), ",").alias("terms")),
                           "cluster_id", "left")
    else:
        sizes = sizes.withColumn("terms", F.lit(None).cast("string"))
    cnodes = sizes.select(F.concat(F.lit("c"), F.col("cluster_id").cast("string")).alias("node_id"),
                          F.lit("cluster").alias("kind"),
                          F.concat(F.lit("VL-"), F.col("cluster_id").cast("string")).alias("label"),
                          F.col("n").cast("long").alias("n"), "terms")
    pnodes = pts.select(F.concat(F.lit("p"), F.col(id_col).cast("string")).alias("node_id"),
                        F.lit("point").alias("kind"), _label(F.col(id_col), cfg.substring).alias("label"),
                        F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("terms")).distinct()
    edges = pts.select(F.concat(F.lit("c"), F.col("cluster_id").cast("string")).alias("source"),
                       F.concat(F.lit("p"), F.col(id_col).cast("string")).alias("target"),
                       F.col("weight").cast("double").alias("weight"), F.col("distance").cast("double").alias("distance"))
    return cnodes.unionByName(pnodes), edges


GRAPHML_HEAD = [
    '<?xml version="1.0" encoding="UTF-8"?>',
    '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">',
    '<key id="label" for="node" attr.name="label" attr.type="string"/>',
    '<key id="terms" for="node" attr.name="terms" attr.type="string"/>',
    '<key id="weight" for="edge" attr.name="weight" attr.type="double"/>',
    '<key id="distance" for="edge" attr.name="distance" attr.type="double"/>',
    '<graph id="clusters" edgedefault="undirected">',
]
GRAPHML_TAIL = ["</graph>", "</graphml>"]


def graphml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(section, key, line)``: sorting by (section, key) yields a GraphML document."""
    spark = nodes.sparkSession
    head = spark.createDataFrame([(0, f"{i:04d}", t) for i, t in enumerate(GRAPHML_HEAD)], "section int, key string, line string")
    tail = spark.createDataFrame([(3, f"{i:04d}", t) for i, t in enumerate(GRAPHML_TAIL)], "section int, key string, line string")
    n = nodes.select(F.lit(1).alias("section"), F.col("node_id").alias("key"),
                     F.concat(F.lit('<node id="'), _xml(F.col("node_id")), F.lit('"><data key="label">'),
                              _xml(F.col("label")), F.lit("</data>"),
                              F.coalesce(F.concat(F.lit('<data key="terms">'), _xml(F.col("terms")), F.lit("</data>")), F.lit("")),
                              F.lit("</node>")).alias("line"))
    e = edges.select(F.lit(2).alias("section"), F.concat_ws("|", "source", "target").alias("key"),
                     F.concat(F.lit('<edge source="'), _xml(F.col("source")), F.lit('" target="'), _xml(F.col("target")),
                              F.lit('"><data key="weight">'), _num(F.col("weight")), F.lit('</data><data key="distance">'),
                              _num(F.col("distance")), F.lit("</data></edge>")).alias("line"))
    return head.unionByName(n).unionByName(e).unionByName(tail)


def report_json(terms: DataFrame, points: DataFrame, sizes: DataFrame, cfg: DumpConfig = DumpConfig(),
                id_col: str = "doc_id") -> DataFrame:
    """Rows ``(kind, cluster_id, rank, label, value)``: cluster (value = n), term
    (rank, term, weight) and point (label = id, value = distance)."""
    pts = cap_points(points, cfg.max_points, order_col=id_col)
    c = sizes.select(F.lit("cluster").alias("kind"), "cluster_id", F.lit(None).cast("int").alias("rank"),
                     F.concat(F.lit("VL-"), F.col("cluster_id").cast("string")).alias("label"),
                     F.col("n").cast("double").alias("value"))
    t = terms.select(F.lit("term").alias("kind"), "cluster_id", F.col("rank").cast("int").alias("rank"),
                     F.col("term").alias("label"), F.col("weight").cast("double").alias("value"))
    p = pts.select(F.lit("point").alias("kind"), "cluster_id", F.lit(None).cast("int").alias("rank"),
                   F.col(id_col).cast("string").alias("label"), F.col("distance").cast("double").alias("value"))
    return c.unionByName(t).unionByName(p)


def dump_points_lines(points: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Raw clustered-point dump (K8): ``(cluster_id, id, line)``."""
    return points.select("cluster_id", F.col(id_col).cast("string").alias("id"),
                         F.concat(F.lit("Key: "), F.col("cluster_id").cast("string"), F.lit(": Value: "),
                                  _num(F.col("weight"), "%.1f"), F.lit(" : [distance="), _num(F.col("distance")),
                                  F.lit("]: "), F.col(id_col).cast("string")).alias("line"))


def write_lines(rows: DataFrame, path: str, order: list[str], line_col: str = "line") -> None:
    rows.orderBy(*order).select(line_col).write.mode("overwrite").text(path)


def no_points(spark, id_col: str = "doc_id") -> DataFrame:
    return spark.createDataFrame([], f"cluster_id int, {id_col} string, weight double, distance double")


def dump_clusters(fmt: str, out: str, points: DataFrame | None, terms: DataFrame | None = None,
                  cfg: DumpConfig = DumpConfig(), id_col: str = "doc_id", clusters: DataFrame | None = None,
                  evaluation: DataFrame | None = None) -> None:
    """Format dispatch (K7). ``clusters``: any table with the model's cluster ids, so clusters
    without points are listed; ``points`` may be None (then ``clusters`` is needed). With
    ``cfg.evaluate`` the ``evaluation`` report rows go to ``<out>_evaluate`` (E5)."""
    fmt = fmt.upper()
    if points is None:
        if clusters is None:
            raise ValueError("a report without points needs the clusters")
        points = no_points(clusters.sparkSession, id_col)
    if cfg.evaluate and evaluation is None:
        raise ValueError("evaluate=True needs the evaluation rows")
    sizes = cluster_sizes(points, clusters=clusters)
    if fmt == "TEXT":
        if terms is None:
            raise ValueError("TEXT reports need top terms (a dictionary)")
        write_lines(report_text(terms, points, sizes, cfg, id_col), out, ["cluster_id", "section", "seq", "sort_id"])
    elif fmt == "CSV":
        write_lines(report_csv(points, cfg, id_col, sizes), out, ["cluster_id", "chunk"])
    elif fmt == "GRAPH_ML":
        nodes, edges = report_graph(points, sizes, cfg, id_col, terms)
        write_lines(graphml_lines(nodes, edges), out, ["section", "key"])
    elif fmt == "JSON":
        if terms is None:
            raise ValueError("JSON reports need top terms (a dictionary)")
        (report_json(terms, points, sizes, cfg, id_col).orderBy("cluster_id", "kind", "rank", "label")
         .write.mode("overwrite").json(out))
    else:
        raise ValueError(f"Unknown output format: {fmt!r} (expected one of {FORMATS})")
    if cfg.evaluate:
        write_lines(evaluation, f"{out}_evaluate", ["section", "key1", "key2"])
