"""Independent SQL (DuckDB dialect) for the registered queries.

Every query is written from the operator specifications, not generated from the Spark
plans. Views ``documents``, ``embeddings`` (and the other driver tables) must exist.
Shared steps are kept as named CTE blocks so that long chains (vectorise -> k-means ->
report) stay readable.
"""

from __future__ import annotations

from canopus.config import KMeansConfig, VectorizeConfig

WS = r"[ \t\n\x0B\f\r]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stop_pattern(terms, years: bool) -> str:
    """Written from the specification: each literal any number of times, in the given order; or a
    year of 19xx or 20xx with any number of year signs."""
    literals = "".join("(?:" + "".join("\\" + c if c in r".^$*+?()[]{}|\\" else c for c in t) + ")*" for t in terms)
    return f"(?:{literals})" + ("|(?:19|20)[0-9]{2}年*" if years else "")


def tagdocs_ctes(cfg: VectorizeConfig = VectorizeConfig()) -> list[str]:
    drop = 1 if cfg.drop_last_field else 0
    pat = _q(stop_pattern(cfg.stop_terms, cfg.drop_years))
    return [
        f"lines AS (SELECT CAST(doc_id AS VARCHAR) || '|' || regexp_replace(text, {_q(WS)}, '|', 'g') AS value FROM documents)",
        r"fields AS (SELECT string_split(regexp_replace(value, '(?:\|)+\z', ''), '|') AS f FROM lines)",
        f"tagdocs AS (SELECT f[1] AS doc_id, list_filter(list_transform(f[2:len(f)-{drop}], lambda t: lower(t)), "
        f"lambda t: NOT regexp_full_match(t, {pat})) AS tags FROM fields WHERE len(f) >= {cfg.min_fields})",
    ]


def ngram_ctes(cfg: VectorizeConfig, n: int = 2, suffix: str = "") -> list[str]:
    """LLR table ``llr{suffix}(gram, k11, llr)`` for gram size ``n``."""
    s = suffix
    return [
        f"occ{s} AS (SELECT doc_id, array_to_string(tags[i:i+{n - 1}], ' ') AS gram, "
        f"array_to_string(tags[i:i+{n - 2}], ' ') AS head, tags[i+{n - 1}] AS tail "
        f"FROM (SELECT doc_id, tags, unnest(range(1, len(tags) - {n - 2})) AS i FROM tagdocs))",
        f"grams{s} AS (SELECT gram, head, tail, count(*) AS k11 FROM occ{s} GROUP BY gram, head, tail)",
        f"heads{s} AS (SELECT head, count(*) AS head_n FROM occ{s} GROUP BY head)",
        f"tails{s} AS (SELECT tail, count(*) AS tail_n FROM occ{s} GROUP BY tail)",
        f"tot{s} AS (SELECT count(*) AS t FROM occ{s})",
        f"cells{s} AS (SELECT g.gram, g.k11::DOUBLE AS k11, (h.head_n - g.k11)::DOUBLE AS k12, "
        f"(t.tail_n - g.k11)::DOUBLE AS k21, (tot.t - h.head_n - t.tail_n + g.k11)::DOUBLE AS k22 "
        f"FROM grams{s} g JOIN heads{s} h USING (head) JOIN tails{s} t USING (tail), tot{s} tot)",
        f"llr{s} AS (SELECT gram, k11::BIGINT AS k11, greatest(2.0 * ({_cell('k11', 'k11 + k12', 'k11 + k21')} + "
        f"{_cell('k12', 'k11 + k12', 'k12 + k22')} + {_cell('k21', 'k21 + k22', 'k11 + k21')} + "
        f"{_cell('k22', 'k21 + k22', 'k12 + k22')}), 0.0) AS llr FROM cells{s})",
    ]


def _cell(k: str, row: str, col: str) -> str:
    n = "(k11 + k12 + k21 + k22)"
    return f"(CASE WHEN {k} > 0 THEN {k} * ln({k} * {n} / (({row}) * ({col}))) ELSE 0.0 END)"


def _xlogx(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ({x}) * ln({x}) ELSE 0.0 END)"


def _h(*xs: str) -> str:
    total = " + ".join(f"({x})" for x in xs)
    return "(" + _xlogx(total) + " - " + " - ".join(_xlogx(x) for x in xs) + ")"


def vectorize_ctes(cfg: VectorizeConfig = VectorizeConfig()) -> list[str]:
    ctes = tagdocs_ctes(cfg)
    tokens = "SELECT doc_id, unnest(tags) AS term FROM tagdocs"
    if cfg.max_ngram >= 2:
        for n in range(2, cfg.max_ngram + 1):
            ctes += ngram_ctes(cfg, n, f"_{n}")
            tokens += (f" UNION ALL SELECT o.doc_id, o.gram AS term FROM occ_{n} o JOIN llr_{n} l USING (gram) "
                       f"WHERE l.k11 >= {cfg.min_support} AND l.llr >= {cfg.min_llr}")
    if cfg.max_df_sigma is not None and cfg.max_df_sigma >= 0:
        max_df = (f"CAST(trunc(100.0 * {cfg.max_df_sigma} * (SELECT sqrt(sum(df::DOUBLE * df) / (count(*) - 1)) FROM df)"
                  f" / n_docs) AS BIGINT)")
    else:
        max_df = str(int(cfg.max_df_percent))
    ctes += [
        f"doc_terms AS (SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf FROM ({tokens}) GROUP BY doc_id, term)",
        "term_counts AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf FROM doc_terms GROUP BY term)",
        f"dictionary AS (SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, term, cf "
        f"FROM term_counts WHERE cf >= {cfg.min_support})",
        "tf AS (SELECT d.doc_id, k.term_id, d.tf FROM doc_terms d JOIN dictionary k USING (term))",
        "df AS (SELECT term_id, count(*) AS df FROM tf GROUP BY term_id)",
        "stats AS (SELECT count(DISTINCT term_id) AS n_features, count(DISTINCT doc_id) AS n_docs FROM tf)",
        f"thr AS (SELECT n_docs, {max_df} AS max_df, CAST(trunc(CAST(n_docs AS FLOAT) * "
        f"CAST(CAST({max_df} AS FLOAT) / CAST(100 AS FLOAT) AS FLOAT)) AS BIGINT) AS threshold FROM stats)",
        f"pruned AS (SELECT tf.doc_id, tf.term_id, tf.tf, df.df FROM tf JOIN df USING (term_id), thr "
        f"WHERE df.df >= {cfg.min_df} AND df.df <= thr.threshold)",
    ]
    second = f"WHERE 100.0 * df / n_docs <= {float(cfg.max_df_percent)}" if cfg.second_df_filter else ""
    if cfg.scheme == "classic":
        w = f"sqrt(tf) * (1 + ln(n_docs / (greatest(df, {cfg.min_df}) + 1.0)))"
    else:
        w = "tf * ln((n_docs + 1.0) / (df + 1.0))"
    ctes.append(f"tfidf_raw AS (SELECT doc_id, term_id, {w} AS weight FROM pruned, stats {second})")
    ctes.append("tfidf AS (" + _norm_sql(cfg) + ")")
    return ctes


def _norm_sql(cfg: VectorizeConfig) -> str:
    p = cfg.norm
    if p is None:
        return "SELECT doc_id, term_id, weight FROM tfidf_raw"
    if isinstance(p, str):
        norm = "max(abs(weight)) OVER (PARTITION BY doc_id)"
    elif float(p) == 0.0:
        norm = "sum(CASE WHEN weight <> 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY doc_id)"
    elif float(p) == 1.0:
        norm = "sum(abs(weight)) OVER (PARTITION BY doc_id)"
    elif float(p) == 2.0:
        norm = "sqrt(sum(weight * weight) OVER (PARTITION BY doc_id))"
    else:
        norm = f"pow(sum(pow(abs(weight), {float(p)})) OVER (PARTITION BY doc_id), {1.0 / float(p)})"
    if cfg.log_normalize:
        import math
        val = f"ln(1 + weight) / ({math.log(float(p))!r} * nrm)"
    else:
        val = "weight / nrm"
    return (f"SELECT doc_id, term_id, CASE WHEN nrm = 0 THEN weight ELSE {val} END AS weight "
            f"FROM (SELECT *, {norm} AS nrm FROM tfidf_raw)")


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# ----------------------------------------------------------------------------- distances

def sparse_dist(measure: str, x2: str, c2: str, dot: str) -> str:
    if measure == "sq_euclidean":
        return f"greatest({x2} + {c2} - 2.0 * {dot}, 0.0)"
    if measure == "euclidean":
        return f"sqrt(greatest({x2} + {c2} - 2.0 * {dot}, 0.0))"
    if measure == "cosine":
        den = f"(sqrt({x2}) * sqrt({c2}))"
        return (f"(CASE WHEN {den} = 0 THEN (CASE WHEN {x2} = 0 AND {c2} = 0 THEN 0.0 ELSE 1.0 END) "
                f"ELSE 1.0 - {dot} / greatest({den}, {dot}) END)")
    raise ValueError(measure)


def dense_dist(measure: str, a: str, b: str) -> str:
    def zsum(expr):
        return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: {expr}))"
    sq = zsum(f"({a}[i] - {b}[i]) * ({a}[i] - {b}[i])")
    if measure == "sq_euclidean":
        return sq
    if measure == "euclidean":
        return f"sqrt({sq})"
    if measure == "manhattan":
        return zsum(f"abs({a}[i] - {b}[i])")
    if measure == "chebyshev":
        return f"list_max(list_transform(range(1, len({a}) + 1), lambda i: abs({a}[i] - {b}[i])))"
    if measure == "cosine":
        return sparse_dist("cosine", zsum(f"{a}[i] * {a}[i]"), zsum(f"{b}[i] * {b}[i]"), zsum(f"{a}[i] * {b}[i]"))
    raise ValueError(measure)


def shift_sql(measure: str) -> str:
    """Movement of a centre from columns ow / nw of a full outer join (grouped)."""
    if measure == "sq_euclidean":
        return "sum((ow - nw) * (ow - nw))"
    if measure == "euclidean":
        return "sqrt(sum((ow - nw) * (ow - nw)))"
    if measure == "cosine":
        return sparse_dist("cosine", "sum(ow * ow)", "sum(nw * nw)", "sum(ow * nw)")
    raise ValueError(measure)


# ----------------------------------------------------------------------------- k-means

def seeds_sql(ids_table: str, id_col: str, k: int, seed: int) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY h, {id_col}) - 1 AS INTEGER) AS cluster_id, {id_col} FROM "
            f"(SELECT {id_col}, md5(concat_ws('|', '{seed}', CAST({id_col} AS VARCHAR))) AS h FROM {ids_table} "
            f"ORDER BY h, {id_col} LIMIT {k})")


def kmeans_sparse_ctes(cfg: KMeansConfig, pts: str = "tfidf", centers: str | None = None) -> list[str]:
    """Produces ``km_cent`` (cluster_id, term_id, weight), ``km_asg`` (doc_id, cluster_id, d),
    ``km_iters`` (iterations run)."""
    m = cfg.measure
    ctes = [
        f"km_x2 AS (SELECT doc_id, sum(weight * weight) AS x2 FROM {pts} GROUP BY doc_id)",
        *([f"c0 AS (SELECT cluster_id, term_id, weight FROM {centers})"] if centers else [
            f"km_seeds AS ({seeds_sql('km_x2', 'doc_id', cfg.k, cfg.seed)})",
            f"c0 AS (SELECT s.cluster_id, p.term_id, p.weight FROM km_seeds s JOIN {pts} p USING (doc_id))"]),
        "km_ids AS (SELECT DISTINCT cluster_id FROM c0)",
        "stop0 AS (SELECT false AS done, 0 AS iters)",
    ]

    def assign(i, cent):
        d = sparse_dist(m, "x.x2", "coalesce(n.c2, 0.0)", "coalesce(dt.dot, 0.0)")
        return [
            f"n{i} AS (SELECT cluster_id, sum(weight * weight) AS c2 FROM {cent} GROUP BY cluster_id)",
            f"dot{i} AS (SELECT p.doc_id, c.cluster_id, sum(p.weight * c.weight) AS dot FROM {pts} p "
            f"JOIN {cent} c USING (term_id) GROUP BY p.doc_id, c.cluster_id)",
            f"asg{i} AS (SELECT doc_id, cluster_id, d FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY doc_id ORDER BY d, cluster_id) AS rn FROM (SELECT x.doc_id, ids.cluster_id, "
            f"round({d}, 9) AS d FROM km_x2 x CROSS JOIN km_ids ids LEFT JOIN n{i} n ON n.cluster_id = ids.cluster_id "
            f"LEFT JOIN dot{i} dt ON dt.doc_id = x.doc_id AND dt.cluster_id = ids.cluster_id)) WHERE rn = 1)",
        ]

    for i in range(1, cfg.max_iter + 1):
        p = i - 1
        ctes += assign(i, f"c{p}")
        ctes += [
            f"sz{i} AS (SELECT cluster_id, count(*) AS n FROM asg{i} GROUP BY cluster_id)",
            f"new{i} AS (SELECT a.cluster_id, p.term_id, sum(p.weight) / any_value(s.n) AS weight FROM asg{i} a "
            f"JOIN {pts} p USING (doc_id) JOIN sz{i} s USING (cluster_id) GROUP BY a.cluster_id, p.term_id "
            f"UNION ALL SELECT cluster_id, term_id, weight FROM c{p} WHERE cluster_id NOT IN (SELECT cluster_id FROM sz{i}))",
            f"mv{i} AS (SELECT cluster_id, {shift_sql(m)} AS shift FROM (SELECT coalesce(o.cluster_id, w.cluster_id) "
            f"AS cluster_id, coalesce(o.weight, 0.0) AS ow, coalesce(w.weight, 0.0) AS nw FROM c{p} o FULL JOIN new{i} w "
            f"ON o.cluster_id = w.cluster_id AND o.term_id = w.term_id) GROUP BY cluster_id)",
            f"c{i} AS (SELECT * FROM new{i} WHERE NOT (SELECT done FROM stop{p}) "
            f"UNION ALL SELECT * FROM c{p} WHERE (SELECT done FROM stop{p}))",
            f"stop{i} AS (SELECT (SELECT done FROM stop{p}) OR (SELECT max(shift) <= {cfg.delta} FROM mv{i}) AS done, "
            f"CASE WHEN (SELECT done FROM stop{p}) THEN (SELECT iters FROM stop{p}) ELSE {i} END AS iters)",
        ]
    last = cfg.max_iter
    ctes += assign("f", f"c{last}")
    ctes += [f"km_cent AS (SELECT * FROM c{last})", "km_asg AS (SELECT * FROM asgf)",
             f"km_iters AS (SELECT iters FROM stop{last})"]
    return ctes


def kmeans_dense_ctes(cfg: KMeansConfig, pts: str = "emb", centers: str | None = None) -> list[str]:
    """``pts`` has (point_id, vec DOUBLE[]). Produces ``kd_cent`` (cluster_id, center) and
    ``kd_asg`` (point_id, cluster_id, d)."""
    m = cfg.measure
    ctes = [
        *([f"d0 AS (SELECT cluster_id, center FROM {centers})"] if centers else [
            f"kd_seeds AS ({seeds_sql(pts, 'point_id', cfg.k, cfg.seed)})",
            f"d0 AS (SELECT s.cluster_id, p.vec AS center FROM kd_seeds s JOIN {pts} p USING (point_id))"]),
        "dstop0 AS (SELECT false AS done)",
        f"dims AS (SELECT unnest(range(1, (SELECT max(len(vec)) FROM {pts}) + 1)) AS i)",
    ]

    def assign(i, cent):
        return (f"dasg{i} AS (SELECT point_id, cluster_id, d FROM (SELECT *, row_number() OVER "
                f"(PARTITION BY point_id ORDER BY d, cluster_id) AS rn FROM (SELECT p.point_id, c.cluster_id, "
                f"round({dense_dist(m, 'p.vec', 'c.center')}, 9) AS d FROM {pts} p CROSS JOIN {cent} c)) WHERE rn = 1)")

    for i in range(1, cfg.max_iter + 1):
        p = i - 1
        ctes += [
            assign(i, f"d{p}"),
            f"dmean{i} AS (SELECT cluster_id, list(m ORDER BY i) AS center FROM (SELECT a.cluster_id, dims.i, "
            f"avg(p.vec[dims.i]) AS m FROM dasg{i} a JOIN {pts} p USING (point_id) CROSS JOIN dims "
            f"GROUP BY a.cluster_id, dims.i) GROUP BY cluster_id)",
            f"dnew{i} AS (SELECT * FROM dmean{i} UNION ALL SELECT * FROM d{p} "
            f"WHERE cluster_id NOT IN (SELECT cluster_id FROM dmean{i}))",
            f"dmv{i} AS (SELECT max({dense_dist(m, 'o.center', 'w.center')}) AS shift FROM d{p} o "
            f"JOIN dnew{i} w USING (cluster_id))",
            f"d{i} AS (SELECT * FROM dnew{i} WHERE NOT (SELECT done FROM dstop{p}) "
            f"UNION ALL SELECT * FROM d{p} WHERE (SELECT done FROM dstop{p}))",
            f"dstop{i} AS (SELECT (SELECT done FROM dstop{p}) OR (SELECT shift <= {cfg.delta} FROM dmv{i}) AS done)",
        ]
    last = cfg.max_iter
    ctes += [assign("f", f"d{last}"), f"kd_cent AS (SELECT * FROM d{last})", "kd_asg AS (SELECT * FROM dasgf)"]
    return ctes


EMB_CTE = "emb AS (SELECT vec_id AS point_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"


# ----------------------------------------------------------------------------- registry

def _fmt(x: str, spec: str = "%.6f") -> str:
    return f"coalesce(printf('{spec}', {x}), 'NaN')"


def _label_centers_cte() -> list[str]:
    return [EMB_CTE,
            "dims AS (SELECT unnest(range(1, (SELECT max(len(vec)) FROM emb) + 1)) AS i)",
            "lc AS (SELECT label, list(m ORDER BY i) AS center FROM (SELECT label, dims.i, avg(vec[dims.i]) AS m "
            "FROM emb CROSS JOIN dims GROUP BY label, dims.i) GROUP BY label)",
            f"lpairs AS (SELECT a.label AS cluster_id_1, b.label AS cluster_id_2, "
            f"{dense_dist('sq_euclidean', 'a.center', 'b.center')} AS d FROM lc a JOIN lc b ON a.label < b.label)"]


def _intra_ctes(cap: int, measure: str = "sq_euclidean") -> list[str]:
    return [
        f"capped AS (SELECT label AS cluster_id, point_id, vec, row_number() OVER (PARTITION BY label ORDER BY point_id) AS rn "
        f"FROM emb QUALIFY rn <= {cap})",
        f"isizes AS (SELECT label AS cluster_id, count(*) AS n_total, least(count(*), {cap}) AS n_used FROM emb GROUP BY label)",
        f"ipairs AS (SELECT a.cluster_id, {dense_dist(measure, 'a.vec', 'b.vec')} AS d FROM capped a "
        f"JOIN capped b ON a.cluster_id = b.cluster_id AND a.rn < b.rn)",
        "iagg AS (SELECT cluster_id, count(*) AS n_pairs, sum(d) AS s, min(d) AS mn, max(d) AS mx FROM ipairs GROUP BY cluster_id)",
        "intra AS (SELECT s.cluster_id, s.n_total, s.n_used, coalesce(a.n_pairs, 0) AS n_pairs, a.s / nullif(a.n_pairs, 0) AS avg_dist, "
        "a.mn AS min_dist, a.mx AS max_dist, (a.s / nullif(a.n_pairs, 0) - a.mn) / nullif(a.mx - a.mn, 0) AS density "
        "FROM isizes s LEFT JOIN iagg a USING (cluster_id))",
        "inter AS (SELECT count(*) AS n_pairs, max(d) AS max_dist, min(d) AS min_dist, sum(d) / nullif(count(*), 0) AS avg_dist, "
        "(sum(d) / nullif(count(*), 0) - min(d)) / nullif(max(d) - min(d), 0) AS density FROM lpairs)",
    ]


def all_queries(DEFAULT_V, WORKED_V, STOP_V, SIGMA_V, KM_DEFAULT, KM_WORKED, KM_DENSE, DUMP, CAP, EVAL_CAP, EMPTY_WEIGHT, SUBSTRING,
                THRESHOLD) -> dict[str, str]:
    v = vectorize_ctes
    tab = "chr(9)"
    pos = ("SELECT doc_id, CAST(pos AS INTEGER) AS pos, tag FROM (SELECT doc_id, unnest(range(len(tags))) AS pos, "
           "unnest(tags) AS tag FROM tagdocs)")
    tfidf_sel = "SELECT doc_id, term_id, round(weight, 6) AS weight FROM tfidf"
    worked_km = v(WORKED_V) + kmeans_sparse_ctes(KM_WORKED)
    clustered = "clustered AS (SELECT cluster_id, doc_id, 1.0 AS weight, round(d, 6) AS distance FROM km_asg)"
    sizes = ("csizes AS (SELECT c.cluster_id, count(k.doc_id) AS n FROM (SELECT DISTINCT cluster_id FROM model) c "
             "LEFT JOIN clustered k USING (cluster_id) GROUP BY c.cluster_id)")
    top = (f"tt AS (SELECT cluster_id, CAST(rank AS INTEGER) AS rank, term_id, term, weight FROM (SELECT c.cluster_id, "
           f"c.term_id, d.term, round(c.weight, 9) AS weight, row_number() OVER (PARTITION BY c.cluster_id ORDER BY "
           f"round(c.weight, 9) DESC, c.term_id) AS rank FROM model c JOIN dictionary d USING (term_id)) "
           f"WHERE rank <= {DUMP.top_n})")
    model = "model AS (SELECT cluster_id, term_id, weight FROM km_cent)"
    with_empty = (f"model AS (SELECT cluster_id, term_id, weight FROM km_cent UNION ALL SELECT {KM_WORKED.k}, 0, {EMPTY_WEIGHT})")
    rep = worked_km + [clustered, model, sizes, top]
    rep_empty = worked_km + [clustered, with_empty, sizes, top]
    dist_q = lambda m: with_(_label_centers_cte(), f"SELECT e.point_id, round({dense_dist(m, 'e.vec', 'lc.center')}, 6) AS distance "  # noqa: E731
                                                  "FROM emb e JOIN lc USING (label)")
    emb_intra = _label_centers_cte() + _intra_ctes(EVAL_CAP)

    def text(cut: str = "") -> str:
        return " UNION ALL ".join([
            "SELECT cluster_id, 0 AS section, 0 AS seq, '' AS sort_id, 'VL-' || cluster_id || '{n=' || n || '}' AS line FROM csizes",
            f"SELECT cluster_id, 1, 0, '', {tab} || 'Top Terms:' FROM csizes",
            f"SELECT cluster_id, 1, rank, '', {tab} || {tab} || term{cut} || ' => ' || {_fmt('weight')} FROM tt",
            f"SELECT cluster_id, 2, 0, '', {tab} || 'Weight : [props - optional]:  Point:' FROM csizes",
            f"SELECT cluster_id, 2, 1, doc_id, {tab} || {_fmt('weight', '%.1f')} || ' : [distance=' || {_fmt('distance')} "
            f"|| ']: ' || doc_id{cut} FROM clustered"])

    csv = (f"SELECT cluster_id, CAST((rn - 1) // {DUMP.line_points} AS BIGINT) AS chunk, "
           f"CAST(cluster_id AS VARCHAR) || ',' || string_agg(doc_id, ',' ORDER BY doc_id) AS line "
           f"FROM (SELECT cluster_id, doc_id, row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) "
           f"AS rn FROM clustered) GROUP BY cluster_id, chunk "
           f"UNION ALL SELECT cluster_id, 0::BIGINT, CAST(cluster_id AS VARCHAR) FROM csizes WHERE n = 0")

    def nodes(cut: str = "") -> str:
        return (f"SELECT 'c' || c.cluster_id AS node_id, 'cluster' AS kind, 'VL-' || c.cluster_id AS label, n, "
                f"(SELECT string_agg(term{cut}, ',' ORDER BY rank) FROM tt WHERE tt.cluster_id = c.cluster_id) AS terms FROM csizes c "
                f"UNION ALL SELECT 'p' || doc_id, 'point', doc_id{cut}, NULL, NULL FROM clustered")

    json_rows = ("SELECT 'cluster' AS kind, cluster_id, CAST(NULL AS INTEGER) AS rank, 'VL-' || cluster_id "
                 "AS label, CAST(n AS DOUBLE) AS value FROM csizes UNION ALL SELECT 'term', cluster_id, rank, "
                 "term, weight FROM tt UNION ALL SELECT 'point', cluster_id, NULL, doc_id, distance FROM clustered")
    q = {
        "tag_parse": with_(tagdocs_ctes(DEFAULT_V), pos),
        "stop_filter": with_(tagdocs_ctes(STOP_V), pos),
        "term_counts": with_(v(DEFAULT_V), "SELECT term, cf FROM term_counts"),
        "dictionary": with_(v(WORKED_V), "SELECT term_id, term, cf FROM dictionary"),
        "term_frequency": with_(v(WORKED_V), "SELECT doc_id, term_id, tf FROM tf"),
        "document_frequency": with_(v(WORKED_V), "SELECT term_id, df FROM df"),
        "corpus_stats": with_(v(WORKED_V), "SELECT n_features, n_docs FROM stats"),
        "df_sigma": with_(v(WORKED_V), "SELECT count(*) AS n_terms, round(sqrt(sum(df::DOUBLE * df) / (count(*) - 1)), 6) "
                                       "AS sigma_std FROM df"),
        "max_df_threshold": with_(v(DEFAULT_V), "SELECT n_docs, CAST(max_df AS BIGINT) AS max_df, threshold FROM thr"),
        "max_df_threshold_sigma": with_(v(SIGMA_V), "SELECT n_docs, CAST(max_df AS BIGINT) AS max_df, threshold FROM thr"),
        "prune_by_df": with_(v(WORKED_V), "SELECT doc_id, term_id, tf, df FROM pruned"),
        "tfidf": with_(v(WORKED_V), tfidf_sel),
        "tfidf_default": with_(v(DEFAULT_V), tfidf_sel),
        "tfidf_smooth": with_(v(WORKED_V.with_(scheme="smooth")), tfidf_sel),
        "tfidf_norm2": with_(v(WORKED_V.with_(norm=2)), tfidf_sel),
        "tfidf_norm_inf": with_(v(WORKED_V.with_(norm="INF")), tfidf_sel),
        "tfidf_lognorm": with_(v(WORKED_V.with_(norm=2, log_normalize=True)), tfidf_sel),
        "tfidf_sigma": with_(v(SIGMA_V), tfidf_sel),
        "tfidf_bigrams": with_(v(WORKED_V.with_(max_ngram=2)), tfidf_sel),
        "tfidf_trigrams": with_(v(WORKED_V.with_(max_ngram=3)), tfidf_sel),
        "ngrams_llr": with_(tagdocs_ctes(DEFAULT_V) + ngram_ctes(DEFAULT_V, 2),
                            f"SELECT gram, k11, round(llr, 6) AS llr FROM llr WHERE k11 >= {DEFAULT_V.min_support} "
                            f"AND llr >= {DEFAULT_V.min_llr}"),
        "distance_sq_euclidean": dist_q("sq_euclidean"),
        "distance_cosine": dist_q("cosine"),
        "distance_euclidean": dist_q("euclidean"),
        "distance_chebyshev": dist_q("chebyshev"),
        "random_seeds": with_(v(WORKED_V) + kmeans_sparse_ctes(KM_WORKED.with_(max_iter=0)),
                              "SELECT cluster_id, doc_id FROM km_seeds"),
        "assign_sparse": with_(v(WORKED_V) + kmeans_sparse_ctes(KM_WORKED.with_(max_iter=0)),
                               "SELECT doc_id, cluster_id, round(d, 6) AS distance FROM km_asg"),
        "update_centroids": with_(v(WORKED_V) + kmeans_sparse_ctes(KM_WORKED.with_(max_iter=1)),
                                  "SELECT cluster_id, term_id, round(weight, 6) AS weight FROM new1"),
        "assign_dense": with_([EMB_CTE] + kmeans_dense_ctes(KM_DENSE.with_(max_iter=0)),
                              "SELECT point_id, cluster_id, round(d, 6) AS distance FROM kd_asg"),
        "kmeans_dense_3iter": with_([EMB_CTE] + kmeans_dense_ctes(KM_DENSE),
                                    "SELECT cluster_id, point_id, round(d, 4) AS distance FROM kd_asg"),
        "kmeans_sparse_3iter": with_(v(WORKED_V) + kmeans_sparse_ctes(KM_DEFAULT),
                                     "SELECT cluster_id, doc_id, round(d, 4) AS distance FROM km_asg"),
        "kmeans_worked": with_(worked_km, "SELECT cluster_id, doc_id, round(d, 4) AS distance FROM km_asg"),
        "cap_points": f"SELECT cluster_id, point_id FROM (SELECT label AS cluster_id, vec_id AS point_id, row_number() OVER "
                      f"(PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) WHERE rn <= {CAP}",
        "top_terms": with_(rep, "SELECT cluster_id, rank, term_id, term, round(weight, 6) AS weight FROM tt"),
        "members": with_(rep, "SELECT cluster_id, doc_id, row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) - 1 "
                              "AS member_rank FROM clustered"),
        "cluster_sizes": with_(rep, "SELECT cluster_id, n FROM csizes"),
        "intra_stats": with_(emb_intra, "SELECT cluster_id, n_total, n_used, n_pairs, round(avg_dist, 6) AS avg_dist, "
                                        "round(min_dist, 6) AS min_dist, round(max_dist, 6) AS max_dist, "
                                        "round(density, 6) AS density FROM intra"),
        "intra_stats_capped": with_(_label_centers_cte() + _intra_ctes(CAP),
                                    "SELECT cluster_id, n_total, n_used, n_pairs, round(avg_dist, 6) AS avg_dist, round(min_dist, 6) "
                                    "AS min_dist, round(max_dist, 6) AS max_dist, round(density, 6) AS density FROM intra"),
        "intra_avg_full": with_(_label_centers_cte() + _intra_ctes(10**12),
                                "SELECT cluster_id, n_total, n_used, n_pairs, round(avg_dist, 6) AS avg_dist FROM intra"),
        "intra_stats_full": with_(_label_centers_cte() + _intra_ctes(10**12),
                                  "SELECT cluster_id, n_total, n_used, n_pairs, round(avg_dist, 6) AS avg_dist, round(min_dist, 6) AS min_dist, "
                                  "round(max_dist, 6) AS max_dist, round(density, 6) AS density FROM intra"),
        "intra_avg_full_manhattan": with_(_label_centers_cte() + _intra_ctes(10**12, "manhattan"),
                                          "SELECT cluster_id, n_total, n_used, n_pairs, round(avg_dist, 6) AS avg_dist FROM intra"),
        "intra_avg_full_sparse": with_(rep + sparse_eval_ctes(KM_WORKED.measure, 10**12),
                                       "SELECT cluster_id, n_total, n_used, n_pairs, round(avg_dist, 6) AS avg_dist FROM sintra"),
        "kmeans_dense_manhattan": with_([EMB_CTE] + kmeans_dense_ctes(KM_DENSE.with_(measure="manhattan")),
                                        "SELECT cluster_id, point_id, round(d, 4) AS distance FROM kd_asg"),
        "inter_pairs": with_(_label_centers_cte(), "SELECT cluster_id_1, cluster_id_2, round(d, 6) AS distance FROM lpairs"),
        "inter_stats": with_(emb_intra, "SELECT n_pairs, round(max_dist, 6) AS max_dist, round(min_dist, 6) AS min_dist, "
                                        "round(avg_dist, 6) AS avg_dist, round(density, 6) AS density FROM inter"),
        "evaluate_report": with_(emb_intra, " UNION ALL ".join([
            "SELECT 0 AS section, 0 AS key1, 0 AS key2, 'Cluster intra info :' AS line",
            f"SELECT 1, cluster_id, 0, 'ClusterID : ' || cluster_id || ' Intra Average Distance : ' || {_fmt('avg_dist')} "
            f"|| ' Intra Density : ' || {_fmt('density')} FROM intra",
            "SELECT 2, 0, 0, 'Cluster inter info :'",
            f"SELECT 2, 1, 0, 'Maximum Intercluster Distance: ' || {_fmt('max_dist')} FROM inter",
            f"SELECT 2, 2, 0, 'Minimum Intercluster Distance: ' || {_fmt('min_dist')} FROM inter",
            f"SELECT 2, 3, 0, 'Average Intercluster Distance: ' || {_fmt('avg_dist')} FROM inter",
            f"SELECT 2, 4, 0, 'Scaled Inter-Cluster Density: ' || {_fmt('density')} FROM inter",
            f"SELECT 3, cluster_id_1, cluster_id_2, 'The distance between cluster : ' || cluster_id_1 || ' and cluster : ' "
            f"|| cluster_id_2 || ' is ' || {_fmt('d')} FROM lpairs"])),
        "intra_stats_sparse": with_(rep + sparse_eval_ctes(KM_WORKED.measure, EVAL_CAP),
                                    "SELECT cluster_id, n_total, n_used, n_pairs, round(avg_dist, 6) AS avg_dist, round(min_dist, 6) "
                                    "AS min_dist, round(max_dist, 6) AS max_dist, round(density, 6) AS density FROM sintra"),
        "inter_pairs_sparse": with_(rep + sparse_eval_ctes(KM_WORKED.measure, EVAL_CAP),
                                    "SELECT cluster_id_1, cluster_id_2, round(d, 6) AS distance FROM spairs"),
        "inter_stats_sparse": with_(rep + sparse_eval_ctes(KM_WORKED.measure, EVAL_CAP),
                                    "SELECT n_pairs, round(max_dist, 6) AS max_dist, round(min_dist, 6) AS min_dist, "
                                    "round(avg_dist, 6) AS avg_dist, round(density, 6) AS density FROM sinter"),
        "report_text": with_(rep, text()),
        "report_text_empty_cluster": with_(rep_empty, text()),
        "report_text_substring": with_(rep, text(f"[:{SUBSTRING}]")),
        "report_csv": with_(rep, csv),
        "report_csv_empty_cluster": with_(rep_empty, csv),
        "report_graph_nodes": with_(rep, nodes()),
        "report_graph_nodes_empty_cluster": with_(rep_empty, nodes()),
        "report_graph_nodes_substring": with_(rep, nodes(f"[:{SUBSTRING}]")),
        "report_graph_edges": with_(rep, "SELECT 'c' || cluster_id AS source, 'p' || doc_id AS target, weight, distance "
                                         "FROM clustered"),
        "report_json": with_(rep, json_rows),
        "report_json_empty_cluster": with_(rep_empty, json_rows),
        "tag_lines_text": with_(tagdocs_ctes(DEFAULT_V), pos),
        "stage_tagdocs": with_(tagdocs_ctes(DEFAULT_V), pos),
        "stage_vectors": with_(v(WORKED_V), tfidf_sel),
        "stage_seeds": with_(v(WORKED_V) + kmeans_sparse_ctes(KM_WORKED.with_(max_iter=0)),
                             "SELECT cluster_id, term_id, round(weight, 6) AS weight FROM c0"),
        "stage_final_clusters": with_(worked_km, "SELECT cluster_id, term_id, round(weight, 6) AS weight FROM km_cent"),
        "dictionary_text": with_(v(WORKED_V), "SELECT term_id, term FROM dictionary"),
        "dictionary_parquet": with_(v(WORKED_V), "SELECT term_id, term FROM dictionary"),
        "kmeans_threshold": with_(worked_km, f"SELECT cluster_id, doc_id, round(d, 4) AS distance FROM km_asg WHERE 1 / (1 + d) >= {THRESHOLD}"),
        "dump_points": with_(rep, f"SELECT cluster_id, doc_id AS id, 'Key: ' || cluster_id || ': Value: ' || "
                                  f"{_fmt('weight', '%.1f')} || ' : [distance=' || {_fmt('distance')} || ']: ' || doc_id AS line "
                                  f"FROM clustered"),
        "estimate_t": with_([EMB_CTE,
                             f"ns AS (SELECT count(*) // {round(1 / KM_DENSE.canopy_fraction)} AS m FROM emb)",
                             f"smp AS (SELECT point_id, vec, row_number() OVER (ORDER BY md5(concat_ws('|', '{KM_DENSE.seed}', "
                             f"CAST(point_id AS VARCHAR))), point_id) - 1 AS r FROM emb QUALIFY r < (SELECT m FROM ns))",
                             f"cons AS (SELECT {dense_dist('sq_euclidean', 'a.vec', 'b.vec')} AS d FROM smp a JOIN smp b "
                             f"ON b.r = a.r + 1)"],
                            f"SELECT (SELECT m FROM ns) AS n_sample, round(sum(d) / count(*), 6) AS avg_distance, "
                            f"round(sum(d) / count(*) * {KM_DENSE.canopy_factor}, 6) AS t1, "
                            f"round(sum(d) / count(*) * {KM_DENSE.canopy_factor} / 2, 6) AS t2 FROM cons"),
    }
    return q


def sparse_eval_ctes(measure: str, cap: int) -> list[str]:
    """Needs ``clustered`` (cluster_id, doc_id), ``tfidf`` and ``km_cent``. Produces
    ``sintra`` (per cluster), ``spairs`` (centre pairs) and ``sinter`` (1 row)."""
    d = sparse_dist(measure, "a.x2", "b.x2", "coalesce(dt.dot, 0.0)")
    dc = sparse_dist(measure, "a.n2", "b.n2", "coalesce(dt.dot, 0.0)")
    return [
        f"scap AS (SELECT cluster_id, doc_id, row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) AS rn "
        f"FROM clustered QUALIFY rn <= {cap})",
        "scv AS (SELECT c.cluster_id, c.rn, t.term_id, t.weight FROM scap c JOIN tfidf t USING (doc_id))",
        "snrm AS (SELECT cluster_id, rn, sum(weight * weight) AS x2 FROM scv GROUP BY cluster_id, rn)",
        "sdots AS (SELECT a.cluster_id, a.rn AS r1, b.rn AS r2, sum(a.weight * b.weight) AS dot FROM scv a JOIN scv b "
        "ON a.cluster_id = b.cluster_id AND a.term_id = b.term_id AND a.rn < b.rn GROUP BY a.cluster_id, a.rn, b.rn)",
        f"sipairs AS (SELECT a.cluster_id, {d} AS d FROM snrm a JOIN snrm b ON a.cluster_id = b.cluster_id AND a.rn < b.rn "
        f"LEFT JOIN sdots dt ON dt.cluster_id = a.cluster_id AND dt.r1 = a.rn AND dt.r2 = b.rn)",
        f"sisz AS (SELECT cluster_id, count(*) AS n_total, least(count(*), {cap}) AS n_used FROM clustered GROUP BY cluster_id)",
        "siagg AS (SELECT cluster_id, count(*) AS n_pairs, sum(d) AS s, min(d) AS mn, max(d) AS mx FROM sipairs GROUP BY cluster_id)",
        "sintra AS (SELECT s.cluster_id, s.n_total, s.n_used, coalesce(a.n_pairs, 0) AS n_pairs, a.s / nullif(a.n_pairs, 0) AS avg_dist, "
        "a.mn AS min_dist, a.mx AS max_dist, (a.s / nullif(a.n_pairs, 0) - a.mn) / nullif(a.mx - a.mn, 0) AS density "
        "FROM sisz s LEFT JOIN siagg a USING (cluster_id))",
        "scn AS (SELECT cluster_id, sum(weight * weight) AS n2 FROM km_cent GROUP BY cluster_id)",
        "scdots AS (SELECT a.cluster_id AS c1, b.cluster_id AS c2, sum(a.weight * b.weight) AS dot FROM km_cent a "
        "JOIN km_cent b ON a.term_id = b.term_id AND a.cluster_id < b.cluster_id GROUP BY a.cluster_id, b.cluster_id)",
        f"spairs AS (SELECT a.cluster_id AS cluster_id_1, b.cluster_id AS cluster_id_2, {dc} AS d FROM scn a "
        f"JOIN scn b ON a.cluster_id < b.cluster_id LEFT JOIN scdots dt ON dt.c1 = a.cluster_id AND dt.c2 = b.cluster_id)",
        "sinter AS (SELECT count(*) AS n_pairs, max(d) AS max_dist, min(d) AS min_dist, sum(d) / nullif(count(*), 0) AS avg_dist, "
        "(sum(d) / nullif(count(*), 0) - min(d)) / nullif(max(d) - min(d), 0) AS density FROM spairs)",
    ]


def estimate_t_sparse_sql(cfg: VectorizeConfig, km: KMeansConfig) -> str:
    """T1/T2 from consecutive md5-ordered samples of the TF-IDF vectors."""
    d = sparse_dist(km.measure, "a.x2", "b.x2", "coalesce(dt.dot, 0.0)")
    return with_(vectorize_ctes(cfg) + [
        "ids AS (SELECT DISTINCT doc_id FROM tfidf)",
        f"ns AS (SELECT count(*) // {round(1 / km.canopy_fraction)} AS m FROM ids)",
        f"smp AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('|', '{km.seed}', CAST(doc_id AS VARCHAR))), "
        f"doc_id) - 1 AS r FROM ids QUALIFY r < (SELECT m FROM ns))",
        "sv AS (SELECT s.r, t.term_id, t.weight AS w FROM smp s JOIN tfidf t USING (doc_id))",
        "nrm AS (SELECT r, sum(w * w) AS x2 FROM sv GROUP BY r)",
        "dts AS (SELECT a.r, sum(a.w * b.w) AS dot FROM sv a JOIN sv b ON b.r = a.r + 1 AND b.term_id = a.term_id GROUP BY a.r)",
        f"cons AS (SELECT {d} AS d FROM nrm a JOIN nrm b ON b.r = a.r + 1 LEFT JOIN dts dt ON dt.r = a.r)"],
        f"SELECT (SELECT m FROM ns) AS n_sample, round(sum(d) / count(*), 6) AS avg_distance, "
        f"round(sum(d) / count(*) * {km.canopy_factor}, 6) AS t1, "
        f"round(sum(d) / count(*) * {km.canopy_factor} / 2, 6) AS t2 FROM cons")


# ----------------------------------------------------------------------------- canopies

def _founder_ctes(near: str, n: str) -> list[str]:
    """The sequential greedy pass over points numbered from 1 in id order. ``near`` has the
    pairs (r1 < r2) closer than T2. The state is the list of founders so far. Produces
    ``founder(cluster_id, rn)``."""
    return [
        f"prev AS (SELECT r2 AS rn, list(r1) AS before FROM {near} GROUP BY r2)",
        f"steps(rn, founders) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT s.rn + 1, CASE WHEN "
        f"list_has_any(coalesce(p.before, []::BIGINT[]), s.founders) THEN s.founders ELSE list_append(s.founders, s.rn + 1) END "
        f"FROM steps s LEFT JOIN prev p ON p.rn = s.rn + 1 WHERE s.rn < (SELECT {n}))",
        f"founder AS (SELECT CAST(unnest(range(len(founders))) AS INTEGER) AS cluster_id, unnest(founders) AS rn "
        f"FROM steps WHERE rn = (SELECT {n}))",
    ]


def canopy_dense_ctes(cfg: KMeansConfig) -> list[str]:
    """``cano(cluster_id, center)`` over the embeddings."""
    d = dense_dist("sq_euclidean", "a.vec", "b.vec")
    return [
        EMB_CTE,
        f"ns AS (SELECT count(*) // {round(1 / cfg.canopy_fraction)} AS m FROM emb)",
        f"smp AS (SELECT point_id, vec, row_number() OVER (ORDER BY md5(concat_ws('|', '{cfg.seed}', "
        f"CAST(point_id AS VARCHAR))), point_id) - 1 AS r FROM emb QUALIFY r < (SELECT m FROM ns))",
        f"cons AS (SELECT {d} AS d FROM smp a JOIN smp b ON b.r = a.r + 1)",
        f"t AS (SELECT sum(d) / count(*) * {cfg.canopy_factor} AS t1, sum(d) / count(*) * {cfg.canopy_factor} / 2 AS t2 FROM cons)",
        "ord AS (SELECT point_id, vec, row_number() OVER (ORDER BY point_id) AS rn FROM emb)",
        f"pd AS (SELECT a.rn AS r1, b.rn AS r2, {d} AS d FROM ord a JOIN ord b ON a.rn < b.rn)",
        "near AS (SELECT r1, r2 FROM pd, t WHERE d < t2)",
        *_founder_ctes("near", "max(rn) FROM ord"),
        "member AS (SELECT f.cluster_id, f.rn FROM founder f UNION ALL SELECT f.cluster_id, p.r2 FROM founder f "
        "JOIN pd p ON p.r1 = f.rn, t WHERE p.d < t1 UNION ALL SELECT f.cluster_id, p.r1 FROM founder f JOIN pd p ON p.r2 = f.rn, t WHERE p.d < t1)",
        "cdims AS (SELECT unnest(range(1, (SELECT max(len(vec)) FROM emb) + 1)) AS i)",
        "cano AS (SELECT cluster_id, list(v ORDER BY i) AS center FROM (SELECT m.cluster_id, cdims.i, avg(o.vec[cdims.i]) AS v "
        "FROM member m JOIN ord o USING (rn) CROSS JOIN cdims GROUP BY m.cluster_id, cdims.i) GROUP BY cluster_id)",
    ]


def canopy_sparse_ctes(v: VectorizeConfig, cfg: KMeansConfig) -> list[str]:
    """``cano(cluster_id, term_id, weight)`` over the TF-IDF vectors."""
    d = sparse_dist(cfg.measure, "a.x2", "b.x2", "coalesce(dt.dot, 0.0)")
    return vectorize_ctes(v) + [
        "ids AS (SELECT DISTINCT doc_id FROM tfidf)",
        f"ns AS (SELECT count(*) // {round(1 / cfg.canopy_fraction)} AS m FROM ids)",
        "ord AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM ids)",
        "ov AS (SELECT o.rn, t.term_id, t.weight AS w FROM ord o JOIN tfidf t USING (doc_id))",
        "onrm AS (SELECT rn, sum(w * w) AS x2 FROM ov GROUP BY rn)",
        "odot AS (SELECT a.rn AS r1, b.rn AS r2, sum(a.w * b.w) AS dot FROM ov a JOIN ov b ON a.term_id = b.term_id "
        "AND a.rn < b.rn GROUP BY a.rn, b.rn)",
        f"pd AS (SELECT a.rn AS r1, b.rn AS r2, {d} AS d FROM onrm a JOIN onrm b ON a.rn < b.rn "
        f"LEFT JOIN odot dt ON dt.r1 = a.rn AND dt.r2 = b.rn)",
        f"smp AS (SELECT o.rn, row_number() OVER (ORDER BY md5(concat_ws('|', '{cfg.seed}', CAST(o.doc_id AS VARCHAR))), o.doc_id) - 1 "
        f"AS r FROM ord o QUALIFY r < (SELECT m FROM ns))",
        "cons AS (SELECT p.d FROM smp a JOIN smp b ON b.r = a.r + 1 JOIN pd p ON p.r1 = least(a.rn, b.rn) AND p.r2 = greatest(a.rn, b.rn))",
        f"t AS (SELECT sum(d) / count(*) * {cfg.canopy_factor} AS t1, sum(d) / count(*) * {cfg.canopy_factor} / 2 AS t2 FROM cons)",
        "near AS (SELECT r1, r2 FROM pd, t WHERE d < t2)",
        *_founder_ctes("near", "max(rn) FROM ord"),
        "member AS (SELECT f.cluster_id, f.rn FROM founder f UNION ALL SELECT f.cluster_id, p.r2 FROM founder f "
        "JOIN pd p ON p.r1 = f.rn, t WHERE p.d < t1 UNION ALL SELECT f.cluster_id, p.r1 FROM founder f JOIN pd p ON p.r2 = f.rn, t WHERE p.d < t1)",
        "msize AS (SELECT cluster_id, count(*) AS n FROM member GROUP BY cluster_id)",
        "cano AS (SELECT m.cluster_id, o.term_id, sum(o.w) / any_value(s.n) AS weight FROM member m JOIN ov o USING (rn) "
        "JOIN msize s USING (cluster_id) GROUP BY m.cluster_id, o.term_id)",
    ]


def canopy_queries(v: VectorizeConfig, dense: KMeansConfig, sparse: KMeansConfig) -> dict[str, str]:
    recursive = lambda ctes, select: with_(ctes, select).replace("WITH ", "WITH RECURSIVE ", 1)
    return {
        "canopy_centers": recursive(canopy_dense_ctes(dense), "SELECT cluster_id, list_transform(center, lambda x: round(x, 6) + 0.0) AS center FROM cano"),
        "kmeans_canopy": recursive(canopy_dense_ctes(dense) + kmeans_dense_ctes(dense, centers="cano"),
                                   "SELECT cluster_id, point_id, round(d, 4) AS distance FROM kd_asg"),
        "canopy_centers_sparse": recursive(canopy_sparse_ctes(v, sparse), "SELECT cluster_id, term_id, round(weight, 6) AS weight FROM cano"),
        "kmeans_canopy_sparse": recursive(canopy_sparse_ctes(v, sparse) + kmeans_sparse_ctes(sparse, centers="cano"),
                                          "SELECT cluster_id, doc_id, round(d, 4) AS distance FROM km_asg"),
    }
