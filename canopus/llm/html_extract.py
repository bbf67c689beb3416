"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of style paths, kept as counts: pages with the
path, the text blocks found there (by hash, with the pages that have each) and the sequences
of child styles. From them come a path's importances, both entropies to the base of its
pages ``m``:

* content: 1 less the mean over its text occurrences of ``log_m`` of the pages with that
  text. Text of one page has importance 1, text of all pages 0;
* presentation: the entropy of its child sequences;
* composite: ``(1 - g**l) presentation + g**l content``, ``l`` the number of its child
  styles and content that of all text below it, ``g`` 0.9.

A path on at least ``min_pages`` pages is noise if it and all paths below it are under
``threshold``; its branch is removed from every page of the host, inside the article too.
There a page counts once per different body (text of the article element), as a host may
well have many copies of one article; and if the tree would remove the greater part of a
page's article (a host of changed copies), it removes nothing of it. Small hosts give no
such evidence, so elements that HTML itself or their class, id or role call menus, headers,
footers, sidebars, notices, adverts, forms or comments are removed everywhere.

Of what remains, the ``article`` and ``main`` elements with the most text count (and others
with half as much); an article inside another is taken alone if it has over half of its
text, and left out if the text around it has. A page without such elements, or with four
times as much text outside of them, counts whole.

A host of a third of all pages is no group anywhere: the counts are pre-aggregated per task
and key, and only removed paths go back to the pages, by a join on the host (broadcast if
measured to be small).

Defined results: null or empty html has empty text; a null URL belongs to the host "";
repeated rows are extracted each; very long, deep and malformed pages take time in
proportion to their length; ties among elements keep all of them; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopus.session import cut_lineage

from .common import broadcast_if_small
from .html_blocks import Node, hash64, parse
from .url_filter import host_and_path

THRESHOLD = 0.5
MIN_PAGES = 20
GAMMA = 0.9
_PAGE, _TEXT, _SHAPE = 0, 1, 2
_HELD = 200_000   # counts a task holds before it hands them on


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def _chain(nodes: list[Node], i: int) -> Iterator[int]:
    while i > 0:
        yield i
        i = nodes[i].parent


def _bodies(nodes: list[Node], blocks: list[tuple[int, str]]) -> dict[int, int]:
    """A hash of the text of each article or main element."""
    texts: dict[int, list[str]] = {}
    for i, text in blocks:
        texts.setdefault(nodes[i].main, []).append(text)
    return {m: _signed(hash64("\n".join(t))) or 1 for m, t in texts.items() if m}


def style_counts(pages: DataFrame) -> DataFrame:
    """Pre-aggregated observations ``(node, kind, feature, body, n, host, above)`` of ``(host, html)``;
    ``body`` is 0 outside of articles."""
    schema = pa.schema([("node", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("body", pa.int64()), ("n", pa.int64()),
                        ("host", pa.string()), ("above", pa.list_(pa.int64()))])

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        places: dict[int, tuple[str, list[int]]] = {}

        def flush() -> pa.RecordBatch:
            keys, ns = list(counts), list(counts.values())
            own = [places[k[0]] if k[1] == _PAGE else (None, None) for k in keys]
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
                ([k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], [k[3] for k in keys], ns, [h for h, _ in own], [a for _, a in own]),
                schema, strict=True)], schema=schema)
            counts.clear()
            places.clear()
            return out

        for b in batches:
            for host, html in zip(b.column("host").to_pylist(), b.column("html"), strict=True):
                nodes, blocks = parse(html.as_py() or "", host)
                bodies = _bodies(nodes, blocks)
                keys = [_signed(n.key) for n in nodes]
                seen: Counter = Counter()
                for i, text in blocks:
                    seen[keys[i], _TEXT, _signed(hash64(text)), bodies.get(nodes[i].main, 0)] = 1
                for i, n in enumerate(nodes):
                    if i:
                        body = bodies.get(n.main, 0)
                        if keys[i] not in places:
                            places[keys[i]] = host, [keys[j] for j in _chain(nodes, n.parent)]
                        seen[keys[i], _PAGE, 0, body] = 1
                        seen[keys[i], _SHAPE, _signed(n.shape), body] += 1
                for k, n in seen.items():
                    counts[k] = counts[k] + n if not k[3] else max(counts[k], n)   # a body counts once
                if len(counts) > _HELD:
                    yield flush()
        if counts:
            yield flush()

    return pages.mapInArrow(observe, "node bigint, kind int, feature bigint, body bigint, n bigint, host string, above array<bigint>")


def importances(counts: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """``(host, node, pages, importance, branch)`` of the tree's paths; ``branch`` is the largest
    importance of the path and those below it."""
    # each body's features once, then each feature's total (partial sums), then a row per node
    once = counts.groupBy("node", "kind", "feature", "body").agg(
        F.when(F.col("body") == 0, F.sum("n")).otherwise(F.max("n")).alias("n"), F.max("host").alias("host"), F.max("above").alias("above"))
    features = once.where(F.col("kind") != _PAGE).groupBy("node", "kind", "feature").agg(F.sum("n").alias("n"))
    nodes = once.where(F.col("kind") == _PAGE).groupBy("node").agg(
        F.sum("n").alias("pages"), F.max("host").alias("host"), F.max("above").alias("above"))
    sums = features.groupBy("node").agg(
        *(F.sum(F.when(F.col("kind") == k, v)).alias(name) for k, name, v in (
            (_TEXT, "texts", F.col("n")), (_TEXT, "text_logs", F.col("n") * F.log("n")), (_SHAPE, "shapes", F.col("n")),
            (_SHAPE, "shape_logs", F.col("n") * F.log("n")), (_SHAPE, "kinds", F.lit(1)))))
    own = cut_lineage(nodes.join(sums, "node", "left").na.fill(0, ["texts", "shapes", "kinds"]).na.fill(0.0, ["text_logs", "shape_logs"])
                      .withColumn("log_m", F.log(F.greatest("pages", F.lit(2)).cast("double"))), "style_tree")
    content = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("text_logs") / (F.greatest("texts", F.lit(1)) * F.col("log_m")))
    below = (own.where(F.col("texts") > 0).select(F.explode(F.concat(F.array("node"), "above")).alias("node"), content.alias("c"), "texts")
             .groupBy("node").agg((F.sum(F.col("c") * F.col("texts")) / F.sum("texts")).alias("content")))
    shapes = F.greatest("shapes", F.lit(1)).cast("double")
    presentation = F.least(F.lit(1.0), (F.log(shapes) - F.col("shape_logs") / shapes) / F.col("log_m"))
    weight = F.pow(F.lit(gamma), F.col("kinds"))
    rated = own.join(below, "node").withColumn("importance", F.when(F.col("texts") > 0, F.col("content")).otherwise(
        (1 - weight) * presentation + weight * F.col("content")))
    branches = (rated.select(F.explode(F.concat(F.array("node"), "above")).alias("node"), "importance")
                .groupBy("node").agg(F.max("importance").alias("branch")))
    return rated.join(branches, "node").select("host", "node", "pages", "importance", "branch")


def main_blocks(nodes: list[Node], blocks: list[tuple[int, str]], noise: frozenset[int] = frozenset()) -> list[str]:
    """The page's blocks outside removed branches, of its article."""
    blocks = [(i, t) for i, t in blocks if not nodes[i].furniture]
    size: Counter = Counter()   # characters by main element, inside and outside of noise
    quiet: Counter = Counter()
    bad: dict[int, bool] = {}
    for i, text in blocks:
        if i not in bad:
            bad[i] = bool(noise) and any(_signed(nodes[j].key) in noise for j in _chain(nodes, i))
        size[nodes[i].main] += len(text)
        quiet[nodes[i].main] += 0 if bad[i] else len(text)
    kept = [(i, t) for i, t in blocks if not bad[i] or nodes[i].main and 2 * quiet[nodes[i].main] < size[nodes[i].main]]
    # text directly in each main element, and in all of it
    direct: Counter = Counter()
    for i, text in kept:
        direct[nodes[i].main] += len(text)
    inner: dict[int, list[int]] = {}
    total = Counter(direct)
    around = {m: nodes[nodes[m].parent].main for m in {n.main for n in nodes} if m}
    for m in sorted(around, reverse=True):   # an element comes before those in it
        total[around[m]] += total[m]
        inner.setdefault(around[m], []).append(m)
    wanted: set[int] = set()
    look = [0]
    while look:
        m = look.pop()
        parts = [k for k in inner.get(m, ()) if total[k]]
        most = max((total[k] for k in parts), default=0)
        if parts and (4 * most >= direct[0] if m == 0 else 2 * most > total[m]):
            look += [k for k in parts if 2 * total[k] >= most]
        elif parts and m and 2 * direct[m] <= total[m]:   # several parts, none of them the article
            wanted.add(m)
            look += parts
        else:
            wanted.add(m)
    return [t for i, t in kept if nodes[i].main in wanted]


def extract(pages: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``."""
    host = host_and_path(F.col(url_col))[0]
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    noise = importances(cut_lineage(style_counts(rows.select("host", "html")), "style_counts")).where(
        (F.col("branch") < threshold) & (F.col("pages") >= min_pages))
    # a host's paths: as many as its templates have
    noise = cut_lineage(noise.groupBy("host").agg(F.collect_set("node").alias("noise")), "noise_paths")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for own, html, paths in zip(b.column("host").to_pylist(), b.column("html"), b.column("noise"), strict=True):
                texts.append(" ".join(main_blocks(*parse(html.as_py() or "", own), frozenset(paths.as_py() or ()))))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return rows.join(broadcast_if_small(noise), "host", "left").select("page_id", "url", "html", "host", "noise").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
