"""DuckDB oracle SQL for the driver queries (tables are pre-registered views).

Written independently of the Spark code: long (id, j, v) forms, joins on the
inner index and window functions, never the library's outputs.  Shared CTE
fragments are plain strings.
"""

from __future__ import annotations

# --- shared fragments --------------------------------------------------------

E = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings)"
EL = ("el AS (SELECT id, label, CAST(UNNEST(range(len(x))) AS INTEGER) AS j, "
      "UNNEST(x) AS v FROM e)")
ST = "st AS (SELECT j, avg(v) AS m, stddev_samp(v) AS s FROM el GROUP BY j)"
SL = ("sl AS (SELECT el.id, el.label, el.j, CASE WHEN st.s IS NULL OR st.s = 0 THEN 0.0 "
      "ELSE (el.v - st.m) / st.s END AS v FROM el JOIN st USING (j))")
LV = ("lv AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_ix "
      "FROM (SELECT DISTINCT label FROM e))")


def near(k: int, src: str = "sl", out: str = "asg", tag: str = "") -> str:
    """Assignment of every row of ``src`` to the first k ids' vectors.
    Internal CTEs are ck/cl/dd suffixed by ``tag``."""
    ck, cl, dd = f"ck{tag}", f"cl{tag}", f"dd{tag}"
    return (
        f"{ck} AS (SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS cluster "
        f"FROM (SELECT DISTINCT id FROM {src}) QUALIFY row_number() OVER (ORDER BY id) <= {k}), "
        f"{cl} AS (SELECT {ck}.cluster, s.j, s.v AS c FROM {src} s JOIN {ck} USING (id)), "
        f"{dd} AS (SELECT s.id, s.label, {cl}.cluster, sum((s.v - {cl}.c) * (s.v - {cl}.c)) AS d2 "
        f"FROM {src} s JOIN {cl} USING (j) GROUP BY s.id, s.label, {cl}.cluster), "
        f"{out} AS (SELECT id, label, cluster, d2 FROM {dd} "
        f"QUALIFY row_number() OVER (PARTITION BY id ORDER BY d2, cluster) = 1)")


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


BASE = with_(E, EL, ST, SL)
BASE_LV = with_(E, EL, ST, SL, LV)

CNT = ("cnt AS (SELECT a.cluster, lv.label_ix, lv.label, count(*) AS n "
       "FROM asg a JOIN lv USING (label) GROUP BY a.cluster, lv.label_ix, lv.label)")
WIN = ("win AS (SELECT cluster, label_ix AS win_ix FROM cnt "
       "QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label_ix) = 1)")
CELLS = ("cells AS (SELECT w.win_ix AS p_ix, c.label_ix AS a_ix, sum(c.n) AS n "
         "FROM cnt c JOIN win w USING (cluster) GROUP BY w.win_ix, c.label_ix)")
CONF = ("conf AS (SELECT lp.label AS predicted, la.label AS actual, g.p_ix, g.a_ix, "
        "CAST(coalesce(cells.n, 0) AS BIGINT) AS n FROM "
        "(SELECT p.p_ix, l.label_ix AS a_ix FROM (SELECT DISTINCT win_ix AS p_ix FROM win) p "
        "CROSS JOIN lv l) g LEFT JOIN cells USING (p_ix, a_ix) "
        "JOIN lv lp ON lp.label_ix = g.p_ix JOIN lv la ON la.label_ix = g.a_ix)")
CONF_SQ = ("confsq AS (SELECT lp.label AS predicted, la.label AS actual, lp.label_ix AS p_ix, "
           "la.label_ix AS a_ix, CAST(coalesce(cells.n, 0) AS BIGINT) AS n "
           "FROM lv lp CROSS JOIN lv la LEFT JOIN cells "
           "ON cells.p_ix = lp.label_ix AND cells.a_ix = la.label_ix)")

ORDERS = (
    "li AS (SELECT l_orderkey, sum(l_quantity) AS sum_qty, sum(l_extendedprice) AS sum_price, "
    "avg(l_discount) AS avg_disc, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey), "
    "o AS (SELECT o_orderkey AS id, [CAST(o_totalprice AS DOUBLE), CAST(coalesce(sum_qty, 0) AS DOUBLE), "
    "CAST(coalesce(sum_price, 0) AS DOUBLE), CAST(coalesce(avg_disc, 0) AS DOUBLE), CAST(coalesce(n_lines, 0) AS DOUBLE)] AS x "
    "FROM orders LEFT JOIN li ON o_orderkey = l_orderkey), "
    "ol AS (SELECT id, CAST(UNNEST(range(len(x))) AS INTEGER) AS j, UNNEST(x) AS v FROM o), "
    "ost AS (SELECT j, avg(v) AS m, stddev_samp(v) AS s FROM ol GROUP BY j)")

SQL: dict[str, str] = {}

SQL["standardize_stats"] = with_(E, EL, ST) + (
    "SELECT j, round(m, 6) AS mean, round(s, 6) AS sd FROM st")

SQL["standardized_features"] = BASE + "SELECT id, j, round(v, 6) AS v FROM sl"

SQL["standardize_orders"] = "WITH " + ORDERS + (
    " SELECT ol.id, ol.j, round(CASE WHEN ost.s IS NULL OR ost.s = 0 THEN 0.0 "
    "ELSE (ol.v - ost.m) / ost.s END, 6) AS v FROM ol JOIN ost USING (j)")

SQL["one_hot_labels"] = with_(E, LV) + (
    "SELECT e.id, CAST(g.i AS INTEGER) AS label_ix, "
    "CAST(CASE WHEN g.i = lv.label_ix THEN 1 ELSE 0 END AS INTEGER) AS flag "
    "FROM e JOIN lv USING (label) CROSS JOIN (SELECT label_ix AS i FROM lv) g")

SQL["one_hot_decode"] = with_(E, LV, (
    "oh AS (SELECT e.id, g.i, CASE WHEN g.i = lv.label_ix THEN 1 ELSE 0 END AS flag "
    "FROM e JOIN lv USING (label) CROSS JOIN (SELECT label_ix AS i FROM lv) g)")) + (
    "SELECT oh.id, lv.label FROM oh JOIN lv ON lv.label_ix = oh.i WHERE oh.flag = 1")

SQL["train_test_split"] = with_(E) + (
    "SELECT id, row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) "
    "<= floor(0.8 * count(*) OVER ()) AS is_train FROM e")

SQL["nearest_center"] = with_(E, EL, ST, SL, near(10)) + (
    "SELECT id, cluster, round(d2, 6) AS d2 FROM asg")

SQL["kmeans_cost"] = with_(E, EL, ST, SL, near(10)) + (
    "SELECT cluster, CAST(count(*) AS BIGINT) AS n, round(sum(d2), 6) AS within_ss "
    "FROM asg GROUP BY cluster")

SQL["cluster_label_error"] = with_(E, EL, ST, SL, LV, near(10), CNT, (
    "w AS (SELECT cluster, label AS argmax, n AS win_n, sum(n) OVER (PARTITION BY cluster) AS size "
    "FROM cnt QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label_ix) = 1)")) + (
    "SELECT cluster, argmax, CAST(size AS BIGINT) AS size, "
    "round((1 - CAST(win_n AS DOUBLE) / size) * size, 6) AS err, "
    "round(1 - CAST(win_n AS DOUBLE) / size, 6) AS err_rate FROM w")

SQL["cluster_confusion"] = with_(E, EL, ST, SL, LV, near(10), CNT, WIN, CELLS, CONF) + (
    "SELECT predicted, actual, n FROM conf")

SQL["confusion_error_rate"] = with_(E, EL, ST, SL, LV, near(10), CNT, WIN, CELLS, CONF) + (
    "SELECT round(1 - CAST(sum(CASE WHEN predicted = actual THEN n ELSE 0 END) AS DOUBLE) "
    "/ sum(n), 6) AS err FROM conf")

SQL["nearest_wrong_label"] = with_(E, EL, ST, SL, LV, near(10), CNT, WIN, CELLS, CONF_SQ, (
    "z AS (SELECT *, CASE WHEN p_ix = a_ix THEN 0 ELSE n END AS nw, "
    "max(CASE WHEN p_ix = a_ix THEN 0 ELSE n END) OVER (PARTITION BY a_ix) AS mx, "
    "sum(n) OVER (PARTITION BY a_ix) AS tot FROM confsq)")) + (
    "SELECT actual AS target, predicted AS nearest, "
    "round(CASE WHEN tot = 0 THEN NULL ELSE CAST(mx AS DOUBLE) / tot END, 6) AS nearest_ratio "
    "FROM z QUALIFY row_number() OVER (PARTITION BY a_ix ORDER BY nw DESC, p_ix) = 1")

SQL["cluster_spectrum"] = with_(E, EL, ST, SL, near(10), (
    "sz AS (SELECT cluster, count(*) AS size FROM asg GROUP BY cluster)")) + (
    "SELECT CAST(row_number() OVER (ORDER BY size DESC, cluster) AS INTEGER) AS idx, cluster, "
    "CAST(size AS BIGINT) AS size, round(size / sum(size) OVER (), 6) AS share FROM sz")

SQL["cluster_label_variance"] = with_(E, EL, ST, SL, near(10), (
    "m AS (SELECT cluster, label, count(*) AS m FROM asg GROUP BY cluster, label)"), (
    "mm AS (SELECT *, sum(m) OVER (PARTITION BY cluster) AS nn FROM m)")) + (
    "SELECT cluster, CAST(max(nn) AS BIGINT) AS n, round(sum(CASE WHEN nn > 1 THEN "
    "CAST(m AS DOUBLE) * (nn - m) / (nn * (nn - 1)) ELSE 0.0 END), 6) AS label_var "
    "FROM mm GROUP BY cluster")


# --- Lloyd iterations unrolled as chained CTEs -------------------------------

def lloyd_ctes(ks: list[int], iters: int, src: str = "sl", starts: list[str] | None = None) -> list[str]:
    """Models keyed by k; starts = first k ids (or the given CTEs defining
    c0(k, cluster, j, c)); empty clusters keep their centre.
    Produces c0..c{iters} and a0..a{iters} (a_t = assignment to c_t)."""
    kv = ", ".join(f"({k})" for k in ks)
    ctes = list(starts) if starts else [
        f"ks AS (SELECT * FROM (VALUES {kv}) t(k))",
        "rk AS (SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS r "
        f"FROM (SELECT DISTINCT id FROM {src}))",
        "c0 AS (SELECT ks.k, rk.r AS cluster, s.j, s.v AS c FROM ks JOIN rk ON rk.r < ks.k "
        f"JOIN {src} s ON s.id = rk.id)",
    ]
    for t in range(iters + 1):
        ctes.append(
            f"d{t} AS (SELECT c.k, s.id, s.label, c.cluster, sum((s.v - c.c) * (s.v - c.c)) AS d2 "
            f"FROM {src} s JOIN c{t} c USING (j) GROUP BY c.k, s.id, s.label, c.cluster)")
        ctes.append(
            f"a{t} AS (SELECT k, id, label, cluster, d2 FROM d{t} "
            f"QUALIFY row_number() OVER (PARTITION BY k, id ORDER BY d2, cluster) = 1)")
        if t < iters:
            ctes.append(
                f"c{t + 1} AS (SELECT o.k, o.cluster, o.j, coalesce(m.c, o.c) AS c FROM c{t} o "
                f"LEFT JOIN (SELECT a.k, a.cluster, s.j, avg(s.v) AS c FROM a{t} a JOIN {src} s USING (id) "
                f"GROUP BY a.k, a.cluster, s.j) m USING (k, cluster, j))")
    return ctes


SQL["kmeans_lloyd"] = with_(E, EL, ST, SL, *lloyd_ctes([4], 3)) + (
    "SELECT cluster, CAST(count(*) AS BIGINT) AS n, round(sum(d2), 6) AS within_ss "
    "FROM a3 GROUP BY cluster")

SQL["kmeans_sse_curve"] = with_(E, EL, ST, SL, *lloyd_ctes([2, 4, 8], 2)) + (
    "SELECT CAST(k AS INTEGER) AS k, round(sum(d2) / count(*), 6) AS within_ss_mean "
    "FROM a2 GROUP BY k")

SQL["cluster_label_error_curve"] = with_(E, EL, ST, SL, LV, *lloyd_ctes([2, 4, 8], 2), (
    "kc AS (SELECT a.k, a.cluster, lv.label_ix, count(*) AS n FROM a2 a JOIN lv USING (label) "
    "GROUP BY a.k, a.cluster, lv.label_ix)"), (
    "kw AS (SELECT k, cluster, n AS win_n, sum(n) OVER (PARTITION BY k, cluster) AS size FROM kc "
    "QUALIFY row_number() OVER (PARTITION BY k, cluster ORDER BY n DESC, label_ix) = 1)")) + (
    "SELECT CAST(k AS INTEGER) AS k, round(sum((1 - CAST(win_n AS DOUBLE) / size) * size) "
    "/ sum(size), 6) AS err FROM kw GROUP BY k")

# --- cumulative distance histograms ------------------------------------------

HIST_TAIL = (
    ", prm AS (SELECT 2 * avg(d) AS top, 2 * avg(d) / 499 AS w FROM dist), "
    "bn AS (SELECT cls, CASE WHEN d <= top THEN least(499, greatest(1, CAST(ceil(d / w) AS INTEGER))) "
    "ELSE 500 END AS bin FROM dist, prm), "
    "hc AS (SELECT cls, bin, count(*) AS c FROM bn GROUP BY cls, bin), "
    "hs AS (SELECT cls, count(*) AS size FROM dist GROUP BY cls), "
    "hg AS (SELECT cls, size, CAST(UNNEST(range(1, 500)) AS INTEGER) AS bin FROM hs) "
    "SELECT cls AS \"class\", bin, round((bin - 0.5) * w, 6) AS mid, "
    "round(sum(coalesce(c, 0)) OVER (PARTITION BY cls ORDER BY bin "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / size, 6) AS cum_prob "
    "FROM hg LEFT JOIN hc USING (cls, bin) CROSS JOIN prm")

SQL["distance_histogram"] = with_(E, EL, ST, SL, near(4), (
    "dist AS (SELECT a.id, a.cluster AS cls, sum(abs(s.v - c.c)) AS d FROM asg a "
    "JOIN sl s USING (id) JOIN cl c ON c.cluster = a.cluster AND c.j = s.j "
    "GROUP BY a.id, a.cluster)")) + HIST_TAIL

SQL["event_value_histogram"] = with_(
    "ev AS (SELECT event_type AS cls, CAST(value AS DOUBLE) AS value FROM events)",
    "evm AS (SELECT cls, avg(value) AS center FROM ev GROUP BY cls)",
    "dist AS (SELECT cls, abs(value - center) AS d FROM ev JOIN evm USING (cls))") + HIST_TAIL

# --- exact silhouettes on Euclidean distances --------------------------------

SV = "sv AS (SELECT id, list(v ORDER BY j) AS x FROM sl GROUP BY id)"
PAIRS = ("pd AS (SELECT a.id AS i, b.id AS o, list_distance(a.x, b.x) AS d FROM sv a "
         "JOIN sv b ON a.id <> b.id)")


def silhouette_sql(asg: str, keys: str) -> str:
    """Per-row silhouette from pair distances; ``keys`` partitions models."""
    kk = f"{keys}, " if keys else ""
    jk = f" AND x.{keys} = y.{keys}" if keys else ""
    return (
        f"sz AS (SELECT {kk}cluster, count(*) AS n FROM {asg} GROUP BY {kk}cluster), "
        f"ps AS (SELECT {('x.' + keys + ', ') if keys else ''}x.id, x.cluster, y.cluster AS oc, "
        f"sum(p.d) AS sd FROM {asg} x JOIN pd p ON p.i = x.id JOIN {asg} y ON y.id = p.o{jk} "
        f"GROUP BY {('x.' + keys + ', ') if keys else ''}x.id, x.cluster, y.cluster), "
        f"md AS (SELECT ps.*, CASE WHEN ps.oc = ps.cluster THEN ps.sd / (z.n - 1) "
        f"ELSE ps.sd / z.n END AS m FROM ps JOIN sz z ON z.cluster = ps.oc"
        f"{(' AND z.' + keys + ' = ps.' + keys) if keys else ''}), "
        f"own AS (SELECT {kk}a.id, a.cluster, z.n AS n_own FROM {asg} a JOIN sz z USING ({kk}cluster)), "
        f"nb AS (SELECT {kk}id, oc AS neighbour, m AS b FROM md WHERE oc <> cluster "
        f"QUALIFY row_number() OVER (PARTITION BY {kk}id ORDER BY m, oc) = 1), "
        f"aa AS (SELECT {kk}id, m AS a FROM md WHERE oc = cluster), "
        f"sil AS (SELECT {('own.' + keys + ', ') if keys else ''}own.id, own.cluster, nb.neighbour, "
        f"CASE WHEN own.n_own <= 1 OR nb.b IS NULL THEN 0.0 "
        f"WHEN greatest(coalesce(aa.a, 0), nb.b) = 0 THEN 0.0 "
        f"ELSE (nb.b - coalesce(aa.a, 0)) / greatest(coalesce(aa.a, 0), nb.b) END AS s "
        f"FROM own LEFT JOIN nb USING ({kk}id) LEFT JOIN aa USING ({kk}id))")


SQL["pairwise_silhouette"] = with_(E, EL, ST, SL, near(4), SV, PAIRS, silhouette_sql("asg", "")) + (
    "SELECT id, cluster, neighbour, round(s, 6) AS s FROM sil")

SQL["silhouette_by_k"] = with_(E, EL, ST, SL, SV, PAIRS, (
    "kk AS (SELECT * FROM (VALUES (2), (4)) t(k))"), (
    "rk AS (SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS r "
    "FROM (SELECT DISTINCT id FROM sl))"), (
    "kc AS (SELECT kk.k, rk.r AS cluster, s.j, s.v AS c FROM kk JOIN rk ON rk.r < kk.k "
    "JOIN sl s ON s.id = rk.id)"), (
    "kd AS (SELECT c.k, s.id, c.cluster, sum((s.v - c.c) * (s.v - c.c)) AS d2 FROM sl s "
    "JOIN kc c USING (j) GROUP BY c.k, s.id, c.cluster)"), (
    "ka AS (SELECT k, id, cluster FROM kd "
    "QUALIFY row_number() OVER (PARTITION BY k, id ORDER BY d2, cluster) = 1)"),
    silhouette_sql("ka", "k")) + (
    "SELECT CAST(k AS INTEGER) AS k, round(avg(s), 6) AS avg_width FROM sil GROUP BY k")

# --- Gram, covariance, reconstruction error ----------------------------------

SQL["covariance_matrix"] = with_(E, EL) + (
    "SELECT a.j AS i, b.j AS j, round(covar_samp(a.v, b.v), 6) AS cov "
    "FROM el a JOIN el b ON a.id = b.id GROUP BY a.j, b.j")

SQL["gram_matrix"] = BASE + (
    "SELECT a.j AS i, b.j AS j, round(sum(a.v * b.v), 6) AS v "
    "FROM sl a JOIN sl b ON a.id = b.id GROUP BY a.j, b.j")

SQL["recon_error_axis"] = BASE + (
    ", sq AS (SELECT j, sum(v * v) AS s FROM sl GROUP BY j), "
    "nn AS (SELECT count(DISTINCT id) AS n FROM sl) "
    "SELECT CAST(d.d AS INTEGER) AS dims, round(sum(CASE WHEN sq.j >= d.d THEN sq.s ELSE 0 END), 6) "
    "AS err_total, round(sum(CASE WHEN sq.j >= d.d THEN sq.s ELSE 0 END) / max(nn.n), 6) AS err_mean "
    "FROM range(1, 65) d(d) CROSS JOIN sq CROSS JOIN nn GROUP BY d.d")


def _zero_fix(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)`` so −0.0 prints as 0.0."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("round")
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            k += 1
            if depth == 0:
                break
        out.append(sql[i:j] + "(round" + _zero_fix(sql[j + 5:k]) + " + 0.0)")
        i = k


def finalize(sql: dict[str, str]) -> dict[str, str]:
    return {k: _zero_fix(v) for k, v in sql.items()}


# --- hashed-sign random projections --------------------------------------------

def sign_rows(dims: list[int], runs: int, p: int = 64) -> str:
    dv = ", ".join(f"({d})" for d in dims)
    return (
        f"pr AS (SELECT CAST(dd.d AS INTEGER) AS dims, CAST(rr.r AS INTEGER) AS run, "
        f"CAST(ii.i AS INTEGER) AS i, CAST(jj.j AS INTEGER) AS j, "
        f"CASE WHEN substr(md5('42:' || rr.r || ':' || ii.i || ':' || jj.j), 1, 1) < '8' "
        f"THEN 1.0 ELSE -1.0 END / sqrt(dd.d) AS r "
        f"FROM (VALUES {dv}) dd(d) CROSS JOIN range({runs}) rr(r) CROSS JOIN range({p}) ii(i) "
        f"CROSS JOIN range({max(dims)}) jj(j) WHERE jj.j < dd.d)")


PROJ_ERR = (
    "pz AS (SELECT pr.dims, pr.run, s.id, pr.j, sum(s.v * pr.r) AS z FROM sl s JOIN pr ON pr.i = s.j "
    "GROUP BY pr.dims, pr.run, s.id, pr.j), "
    "rec AS (SELECT pz.dims, pz.run, pz.id, pr.i, sum(pz.z * pr.r) AS xh FROM pz JOIN pr "
    "ON pr.dims = pz.dims AND pr.run = pz.run AND pr.j = pz.j GROUP BY pz.dims, pz.run, pz.id, pr.i), "
    "perr AS (SELECT rec.dims, rec.run, sum((s.v - rec.xh) * (s.v - rec.xh)) AS err FROM rec "
    "JOIN sl s ON s.id = rec.id AND s.j = rec.i GROUP BY rec.dims, rec.run)")

SQL["sign_projection"] = with_(E, EL, ST, SL, sign_rows([4], 1)) + (
    "SELECT s.id, pr.j, round(sum(s.v * pr.r), 6) AS v FROM sl s JOIN pr ON pr.i = s.j "
    "GROUP BY s.id, pr.j")

SQL["projection_error"] = with_(E, EL, ST, SL, sign_rows([2, 4], 10), PROJ_ERR) + (
    "SELECT dims, run, round(err, 6) AS err FROM perr")

SQL["projection_running_best"] = with_(E, EL, ST, SL, sign_rows([4], 20), PROJ_ERR) + (
    "SELECT run, round(err, 6) AS err, round(min(err) OVER (ORDER BY run ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS best_err FROM perr")

SQL["cluster_projected"] = with_(E, EL, ST, SL, LV, sign_rows([4], 1), (
    "zl AS (SELECT s.id, s.label, pr.j, sum(s.v * pr.r) AS v FROM sl s JOIN pr ON pr.i = s.j "
    "GROUP BY s.id, s.label, pr.j)"), near(10, src="zl"), CNT, (
    "w AS (SELECT cluster, label AS argmax, n AS win_n, sum(n) OVER (PARTITION BY cluster) AS size "
    "FROM cnt QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label_ix) = 1)")) + (
    "SELECT cluster, argmax, CAST(size AS BIGINT) AS size, "
    "round((1 - CAST(win_n AS DOUBLE) / size) * size, 6) AS err FROM w")

# --- symmetric uncertainty (ntile(5) equal-frequency bins) --------------------

def H(cells: str, keys: str, c: str = "c") -> str:
    return f"SELECT {keys}, ln(sum({c})) - sum({c} * ln({c})) / sum({c}) AS h FROM {cells} GROUP BY {keys}"


SUC = (
    "bn AS (SELECT id, label, j, ntile(5) OVER (PARTITION BY j ORDER BY v, id) AS bin FROM el), "
    "bc AS (SELECT j, bin, label, count(*) AS c FROM bn GROUP BY j, bin, label), "
    f"hx AS ({H('(SELECT j, bin, sum(c) AS c FROM bc GROUP BY j, bin)', 'j')}), "
    f"hy AS ({H('(SELECT j, label, sum(c) AS c FROM bc GROUP BY j, label)', 'j')}), "
    f"hxy AS ({H('bc', 'j')}), "
    "suc AS (SELECT j, CASE WHEN hx.h + hy.h > 0 THEN 2 * (hx.h + hy.h - hxy.h) / (hx.h + hy.h) "
    "ELSE 0.0 END AS su FROM hx JOIN hy USING (j) JOIN hxy USING (j))")

SUP = (
    "bp AS (SELECT id, j, ntile(5) OVER (PARTITION BY j ORDER BY v, id) AS bin FROM el), "
    "pc AS (SELECT a.j AS i, b.j AS j, a.bin AS bi, b.bin AS bj, count(*) AS c FROM bp a "
    "JOIN bp b ON a.id = b.id AND a.j < b.j GROUP BY a.j, b.j, a.bin, b.bin), "
    f"hi AS ({H('(SELECT i, j, bi, sum(c) AS c FROM pc GROUP BY i, j, bi)', 'i, j')}), "
    f"hj AS ({H('(SELECT i, j, bj, sum(c) AS c FROM pc GROUP BY i, j, bj)', 'i, j')}), "
    f"hij AS ({H('pc', 'i, j')}), "
    "sup AS (SELECT i, j, CASE WHEN hi.h + hj.h > 0 THEN 2 * (hi.h + hj.h - hij.h) / (hi.h + hj.h) "
    "ELSE 0.0 END AS su FROM hi JOIN hj USING (i, j) JOIN hij USING (i, j))")

SQL["symmetric_uncertainty"] = with_(E, EL, SUC) + "SELECT j, round(su, 6) AS su FROM suc"

SQL["feature_pair_uncertainty"] = with_(E, EL, SUP) + "SELECT i, j, round(su, 6) AS su FROM sup"

SQL["cfs_merit_greedy"] = with_(E, EL, SUC, SUP, (
    "sc1 AS (SELECT * FROM suc)"), (
    "sym AS (SELECT i, j, su FROM sup UNION ALL SELECT j AS i, i AS j, su FROM sup)"), (
    "s1 AS (SELECT j AS f1, su AS m1 FROM sc1 QUALIFY row_number() OVER (ORDER BY su DESC, j) = 1)"), (
    "c2 AS (SELECT c.j AS f2, (a.su + c.su) / sqrt(2 + 2.0 * p.su) AS m2 FROM s1 "
    "JOIN sc1 a ON a.j = s1.f1 JOIN sc1 c ON c.j <> s1.f1 JOIN sym p ON p.i = s1.f1 AND p.j = c.j)"), (
    "s2 AS (SELECT * FROM c2 QUALIFY row_number() OVER (ORDER BY m2 DESC, f2) = 1)"), (
    "c3 AS (SELECT c.j AS f3, (a.su + b.su + c.su) / sqrt(3 + 2.0 * (p12.su + p13.su + p23.su)) AS m3 "
    "FROM s1 CROSS JOIN s2 JOIN sc1 a ON a.j = s1.f1 JOIN sc1 b ON b.j = s2.f2 "
    "JOIN sc1 c ON c.j <> s1.f1 AND c.j <> s2.f2 JOIN sym p12 ON p12.i = s1.f1 AND p12.j = s2.f2 "
    "JOIN sym p13 ON p13.i = s1.f1 AND p13.j = c.j JOIN sym p23 ON p23.i = s2.f2 AND p23.j = c.j)"), (
    "s3 AS (SELECT * FROM c3 QUALIFY row_number() OVER (ORDER BY m3 DESC, f3) = 1)")) + (
    "SELECT 1 AS step, f1 AS j, round(m1, 6) AS merit FROM s1 UNION ALL "
    "SELECT 2 AS step, f2 AS j, round(m2, 6) AS merit FROM s2 UNION ALL "
    "SELECT 3 AS step, f3 AS j, round(m3, 6) AS merit FROM s3")

SQL["cfs_recon_error"] = with_(E, EL, ST, SL, SUC, SUP, (
    "sc1 AS (SELECT * FROM suc)"), (
    "sym AS (SELECT i, j, su FROM sup UNION ALL SELECT j AS i, i AS j, su FROM sup)"), (
    "s1 AS (SELECT j AS f1, su AS m1 FROM sc1 QUALIFY row_number() OVER (ORDER BY su DESC, j) = 1)"), (
    "c2 AS (SELECT c.j AS f2, (a.su + c.su) / sqrt(2 + 2.0 * p.su) AS m2 FROM s1 "
    "JOIN sc1 a ON a.j = s1.f1 JOIN sc1 c ON c.j <> s1.f1 JOIN sym p ON p.i = s1.f1 AND p.j = c.j)"), (
    "s2 AS (SELECT * FROM c2 QUALIFY row_number() OVER (ORDER BY m2 DESC, f2) = 1)"), (
    "c3 AS (SELECT c.j AS f3, (a.su + b.su + c.su) / sqrt(3 + 2.0 * (p12.su + p13.su + p23.su)) AS m3 "
    "FROM s1 CROSS JOIN s2 JOIN sc1 a ON a.j = s1.f1 JOIN sc1 b ON b.j = s2.f2 "
    "JOIN sc1 c ON c.j <> s1.f1 AND c.j <> s2.f2 JOIN sym p12 ON p12.i = s1.f1 AND p12.j = s2.f2 "
    "JOIN sym p13 ON p13.i = s1.f1 AND p13.j = c.j JOIN sym p23 ON p23.i = s2.f2 AND p23.j = c.j)"), (
    "s3 AS (SELECT * FROM c3 QUALIFY row_number() OVER (ORDER BY m3 DESC, f3) = 1)"), (
    "sel AS (SELECT f1 AS j FROM s1 UNION ALL SELECT f2 FROM s2 UNION ALL SELECT f3 FROM s3)"), (
    "sq AS (SELECT j, sum(v * v) AS s FROM sl GROUP BY j)")) + (
    "SELECT CAST((SELECT count(*) FROM sel) AS INTEGER) AS dims, round(sum(s), 6) AS err_total, "
    "round(sum(s) / (SELECT count(DISTINCT id) FROM sl), 6) AS err_mean "
    "FROM sq WHERE j NOT IN (SELECT j FROM sel)")

# --- soft assignments: softmax(−d²) to the first 4 rows -------------------------

SOFT = (
    "zz AS (SELECT id, label, cluster, exp(min(d2) OVER (PARTITION BY id) - d2) AS e FROM dd), "
    "zp AS (SELECT id, label, cluster, e / sum(e) OVER (PARTITION BY id) AS z FROM zz), "
    "cs AS (SELECT cluster, label, sum(z) AS s FROM zp GROUP BY cluster, label), "
    "cmx AS (SELECT cluster, label, s / sum(s) OVER (PARTITION BY cluster) AS p FROM cs)")

SQL["soft_class_matrix"] = with_(E, EL, ST, SL, near(4), SOFT) + (
    "SELECT cluster, label, round(p, 6) AS p FROM cmx")

SQL["soft_label_confusion"] = with_(E, EL, ST, SL, LV, near(4), SOFT, (
    "pl AS (SELECT zp.id, cmx.label AS plabel, sum(zp.z * cmx.p) AS prob FROM zp "
    "JOIN cmx USING (cluster) GROUP BY zp.id, cmx.label)"), (
    "pred AS (SELECT pl.id, lv.label_ix AS p_ix FROM pl JOIN lv ON lv.label = pl.plabel "
    "QUALIFY row_number() OVER (PARTITION BY pl.id ORDER BY prob DESC, lv.label_ix) = 1)"), (
    "act AS (SELECT e.id, lv.label_ix AS a_ix FROM e JOIN lv USING (label))"), (
    "sc AS (SELECT p_ix, a_ix, count(*) AS n FROM pred JOIN act USING (id) GROUP BY p_ix, a_ix)")) + (
    "SELECT lp.label AS predicted, la.label AS actual, CAST(coalesce(sc.n, 0) AS BIGINT) AS n "
    "FROM lv lp CROSS JOIN lv la LEFT JOIN sc ON sc.p_ix = lp.label_ix AND sc.a_ix = la.label_ix")

# --- EM, spherical common variance (EII), G = 2, 3 iterations ------------------

def em_eii(iters: int, G: int = 2, p: int = 64, src: str = "sl") -> list[str]:
    """EM iterations; r{iters} holds the posteriors under the final parameters."""
    ctes = [
        f"g0 AS (SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS g "
        f"FROM (SELECT DISTINCT id FROM {src}) QUALIFY row_number() OVER (ORDER BY id) <= {G})",
        f"mu0 AS (SELECT g0.g, s.j, s.v AS mu FROM {src} s JOIN g0 USING (id))",
        f"pi0 AS (SELECT g, 1.0 / {G} AS pi FROM g0)",
        "var0 AS (SELECT 1.0 AS var)",
        f"nn AS (SELECT count(DISTINCT id) AS n FROM {src})",
    ]
    for t in range(iters + 1):
        u = t + 1
        ctes += [
            f"ed{t} AS (SELECT s.id, m.g, sum((s.v - m.mu) * (s.v - m.mu)) AS d2 FROM {src} s "
            f"JOIN mu{t} m USING (j) GROUP BY s.id, m.g)",
            f"lr{t} AS (SELECT ed.id, ed.g, ln(q.pi) - 0.5 * ({p} * ln(2 * pi()) + {p} * ln(v.var)) "
            f"- ed.d2 / (2 * v.var) AS l FROM ed{t} ed JOIN pi{t} q USING (g) CROSS JOIN var{t} v)",
            f"lm{t} AS (SELECT id, g, exp(l - max(l) OVER (PARTITION BY id)) AS e FROM lr{t})",
            f"r{t} AS (SELECT id, g, e / sum(e) OVER (PARTITION BY id) AS r FROM lm{t})",
        ]
        if t == iters:
            break
        ctes += [
            f"ng{t} AS (SELECT g, sum(r) AS ng FROM r{t} GROUP BY g)",
            f"mu{u} AS (SELECT r.g, s.j, sum(r.r * s.v) / max(n.ng) AS mu FROM r{t} r "
            f"JOIN {src} s USING (id) JOIN ng{t} n USING (g) GROUP BY r.g, s.j)",
            f"pi{u} AS (SELECT g, ng / (SELECT n FROM nn) AS pi FROM ng{t})",
            f"var{u} AS (SELECT sum(r.r * d.d2) / ((SELECT n FROM nn) * {p}) AS var FROM r{t} r "
            f"JOIN (SELECT s.id, m.g, sum((s.v - m.mu) * (s.v - m.mu)) AS d2 FROM {src} s "
            f"JOIN mu{u} m USING (j) GROUP BY s.id, m.g) d USING (id, g))",
        ]
    return ctes


SQL["em_spherical"] = with_(E, EL, ST, SL, *em_eii(3)) + (
    "SELECT q.g AS component, round(q.pi, 6) AS weight, round(v.var, 6) AS var "
    "FROM pi3 q CROSS JOIN var3 v")

# --- class scatter, contributions, learning-curve statistics ---------------------

SQL["class_scatter"] = with_(E, EL, ST, SL, (
    "sa AS (SELECT * FROM sl)"), (
    "cm AS (SELECT label, j, avg(v) AS m FROM sa GROUP BY label, j)"), (
    "gm AS (SELECT j, avg(v) AS m FROM sa GROUP BY j)"), (
    "cn AS (SELECT label, count(DISTINCT id) AS n FROM sa GROUP BY label)"), (
    "wi AS (SELECT a.j AS i, b.j AS j, sum((a.v - ca.m) * (b.v - cb.m)) AS w FROM sa a "
    "JOIN sa b ON a.id = b.id JOIN cm ca ON ca.label = a.label AND ca.j = a.j "
    "JOIN cm cb ON cb.label = a.label AND cb.j = b.j GROUP BY a.j, b.j)"), (
    "bw AS (SELECT ca.j AS i, cb.j AS j, sum(cn.n * (ca.m - ga.m) * (cb.m - gb.m)) AS b "
    "FROM cm ca JOIN cm cb ON ca.label = cb.label JOIN cn ON cn.label = ca.label "
    "JOIN gm ga ON ga.j = ca.j JOIN gm gb ON gb.j = cb.j GROUP BY ca.j, cb.j)")) + (
    "SELECT i, j, round(w, 6) AS within, round(b, 6) AS \"between\" FROM wi JOIN bw USING (i, j)")

SQL["cumulative_contribution"] = with_(E, EL, ST, SL, LV, (
    "cm AS (SELECT lv.label_ix AS comp, s.j AS feature, avg(s.v) AS m FROM sl s JOIN lv USING (label) "
    "GROUP BY lv.label_ix, s.j)"), (
    "nm AS (SELECT comp, sqrt(sum(m * m)) AS nrm FROM cm GROUP BY comp)"), (
    "mv AS (SELECT cm.feature, cm.comp, cm.m / nm.nrm AS v FROM cm JOIN nm USING (comp))")) + (
    "SELECT feature, CAST(comp + 1 AS INTEGER) AS ind, round(sum(v * v) OVER (PARTITION BY feature "
    "ORDER BY comp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value FROM mv")

SQL["loss_curve_stats"] = with_(E, EL, ST, SL, near(10), (
    "sp AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) "
    "<= floor(0.8 * count(*) OVER ()) AS is_train FROM e)"), (
    "mk AS (SELECT dd.id, dd.label, kk.k AS idx, min(dd.d2) AS e FROM dd JOIN range(1, 11) kk(k) "
    "ON dd.cluster < kk.k GROUP BY dd.id, dd.label, kk.k)"), (
    "prun AS (SELECT mk.label, CASE WHEN sp.is_train THEN 'Train' ELSE 'Test' END AS stage, mk.idx, "
    "avg(mk.e) AS error FROM mk JOIN sp USING (id) GROUP BY mk.label, sp.is_train, mk.idx)")) + (
    "SELECT stage, CAST(idx AS INTEGER) AS idx, round(avg(error), 6) AS err_mean, "
    "round(stddev_samp(error), 6) AS err_sd FROM prun GROUP BY stage, idx")


# --- scalable bindings: orders ⋈ lineitem (O) and part (P) ---------------------

ORD = (
    "li AS (SELECT l_orderkey, sum(l_quantity) AS sum_qty, sum(l_extendedprice) AS sum_price, "
    "avg(l_discount) AS avg_disc, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey), "
    "o AS (SELECT o_orderkey AS id, o_orderpriority AS label, [CAST(o_totalprice AS DOUBLE), "
    "CAST(coalesce(sum_qty, 0) AS DOUBLE), CAST(coalesce(sum_price, 0) AS DOUBLE), CAST(coalesce(avg_disc, 0) AS DOUBLE), "
    "CAST(coalesce(n_lines, 0) AS DOUBLE)] AS x FROM orders LEFT JOIN li ON o_orderkey = l_orderkey), "
    "ol AS (SELECT id, label, CAST(UNNEST(range(len(x))) AS INTEGER) AS j, UNNEST(x) AS v FROM o), "
    "ost AS (SELECT j, avg(v) AS m, stddev_samp(v) AS s FROM ol GROUP BY j), "
    "osl AS (SELECT ol.id, ol.label, ol.j, CASE WHEN ost.s IS NULL OR ost.s = 0 THEN 0.0 "
    "ELSE (ol.v - ost.m) / ost.s END AS v FROM ol JOIN ost USING (j)), "
    "lv AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_ix "
    "FROM (SELECT DISTINCT label FROM o))")

PRT = (
    "pp AS (SELECT p_partkey AS id, p_type AS label, [CAST(p_size AS DOUBLE), "
    "CAST(p_retailprice AS DOUBLE)] AS x FROM part), "
    "pl AS (SELECT id, label, CAST(UNNEST(range(len(x))) AS INTEGER) AS j, UNNEST(x) AS v FROM pp), "
    "pst AS (SELECT j, avg(v) AS m, stddev_samp(v) AS s FROM pl GROUP BY j), "
    "psl AS (SELECT pl.id, pl.label, pl.j, CASE WHEN pst.s IS NULL OR pst.s = 0 THEN 0.0 "
    "ELSE (pl.v - pst.m) / pst.s END AS v FROM pl JOIN pst USING (j)), "
    "lv AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_ix "
    "FROM (SELECT DISTINCT label FROM pp))")

C1_TAIL = (
    "w AS (SELECT cluster, label AS argmax, n AS win_n, sum(n) OVER (PARTITION BY cluster) AS size "
    "FROM cnt QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label_ix) = 1)")

SQL["kmeans_orders_lloyd"] = with_(ORD, *lloyd_ctes([5], 3, src="osl")) + (
    "SELECT cluster, CAST(count(*) AS BIGINT) AS n, round(sum(d2), 6) AS within_ss "
    "FROM a3 GROUP BY cluster")

SQL["orders_cluster_label_error"] = with_(ORD, *lloyd_ctes([5], 3, src="osl"), (
    "asg AS (SELECT id, label, cluster FROM a3)"), CNT, C1_TAIL) + (
    "SELECT cluster, argmax, CAST(size AS BIGINT) AS size, "
    "round((1 - CAST(win_n AS DOUBLE) / size) * size, 6) AS err, "
    "round(1 - CAST(win_n AS DOUBLE) / size, 6) AS err_rate FROM w")

SQL["orders_split"] = with_(ORD) + (
    "SELECT id, row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) "
    "<= floor(0.8 * count(*) OVER ()) AS is_train FROM o")

def silhouette_squared_sql(src: str, k: int) -> str:
    """Per-row widths on squared distances from cluster moments about the mean; ``src`` is
    standardised, so the moments need no shift.  Every row form is a list, so each part is read once."""
    return ", ".join([
        near(k, src=src),
        f"rv AS (SELECT id, list(v ORDER BY j) AS x, sum(v * v) AS xsq FROM {src} GROUP BY id)",
        f"cs AS (SELECT a.cluster, s.j, sum(s.v) AS sx FROM asg a JOIN {src} s USING (id) GROUP BY a.cluster, s.j)",
        "cv AS (SELECT cluster, list(sx ORDER BY j) AS sx FROM cs GROUP BY cluster)",
        "cq AS (SELECT a.cluster, count(*) AS n, sum(r.xsq) AS q FROM asg a JOIN rv r USING (id) GROUP BY a.cluster)",
        "tt AS (SELECT r.id, cv.cluster AS oc, greatest(cq.n * r.xsq - 2 * list_inner_product(r.x, cv.sx) + cq.q, 0) AS t, cq.n "
        "FROM rv r CROSS JOIN cv JOIN cq USING (cluster))",
        "md AS (SELECT tt.id, a.cluster, tt.oc, tt.n, CASE WHEN tt.oc = a.cluster THEN "
        "(CASE WHEN tt.n > 1 THEN tt.t / (tt.n - 1) ELSE 0.0 END) ELSE tt.t / tt.n END AS m FROM tt JOIN asg a USING (id))",
        "sb AS (SELECT id, any_value(cluster) AS cluster, arg_min(oc, struct_pack(m := m, oc := oc)) FILTER (oc <> cluster) AS neighbour, "
        "min(m) FILTER (oc <> cluster) AS b, max(m) FILTER (oc = cluster) AS a, max(n) FILTER (oc = cluster) AS n_own FROM md GROUP BY id)",
    ]) + (
        " SELECT id, cluster, neighbour, round(CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0 "
        "WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END, 6) AS s FROM sb")


SQL["silhouette_squared_orders"] = "WITH " + ORD + ", " + silhouette_squared_sql("osl", 5)
SQL["silhouette_squared_e"] = with_(E, EL, ST, SL).rstrip() + ", " + silhouette_squared_sql("sl", 4)

SQL["part_cluster_confusion"] = with_(PRT, near(6, src="psl"), CNT, WIN, CELLS, CONF) + (
    "SELECT predicted, actual, n FROM conf")

SQL["spectrum_by_algo"] = with_(E, EL, ST, SL, sign_rows([4], 1), (
    "zl AS (SELECT s.id, s.label, pr.j, sum(s.v * pr.r) AS v FROM sl s JOIN pr ON pr.i = s.j "
    "GROUP BY s.id, s.label, pr.j)"), near(10), near(10, src="zl", out="asgz", tag="2"), (
    "sz AS (SELECT 'N/A' AS algo, cluster, count(*) AS size FROM asg GROUP BY cluster "
    "UNION ALL SELECT 'RCA' AS algo, cluster, count(*) AS size FROM asgz GROUP BY cluster)")) + (
    "SELECT algo, CAST(row_number() OVER (PARTITION BY algo ORDER BY size DESC, cluster) AS INTEGER) "
    "AS idx, cluster, CAST(size AS BIGINT) AS size, "
    "round(size / sum(size) OVER (PARTITION BY algo), 6) AS share FROM sz")

SQL["label_variance_sweep"] = with_(E, EL, ST, SL, *lloyd_ctes([5, 10], 2), (
    "m AS (SELECT k, cluster, label, count(*) AS m FROM a2 GROUP BY k, cluster, label)"), (
    "mm AS (SELECT *, sum(m) OVER (PARTITION BY k, cluster) AS nn FROM m)")) + (
    "SELECT CAST(k AS INTEGER) AS k, cluster, CAST(max(nn) AS BIGINT) AS n, round(sum(CASE WHEN nn > 1 "
    "THEN CAST(m AS DOUBLE) * (nn - m) / (nn * (nn - 1)) ELSE 0.0 END), 6) AS label_var "
    "FROM mm GROUP BY k, cluster")


def kmeans_err(asg: str, tag: str) -> str:
    """Majority-label confusion error of an assignment (C2 → C4) as CTE ``ke{tag}``."""
    return (
        f"cnt{tag} AS (SELECT a.cluster, lv.label_ix, count(*) AS n FROM {asg} a JOIN lv USING (label) "
        f"GROUP BY a.cluster, lv.label_ix), "
        f"win{tag} AS (SELECT cluster, label_ix AS win_ix FROM cnt{tag} "
        f"QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label_ix) = 1), "
        f"ke{tag} AS (SELECT 1 - CAST(sum(CASE WHEN w.win_ix = c.label_ix THEN c.n ELSE 0 END) AS DOUBLE) "
        f"/ sum(c.n) AS err FROM cnt{tag} c JOIN win{tag} w USING (cluster))")


def em_err_sql(src: str, p: int) -> str:
    """Label error of the argmax of (EII posterior x class matrix), as a scalar subquery."""
    return (
        "(WITH " + ", ".join(em_eii(3, 4, p, src)) + ", "
        "zp AS (SELECT r.id, e.label, r.g AS cluster, r.r AS z FROM r3 r JOIN e USING (id)), "
        "cs AS (SELECT cluster, label, sum(z) AS s FROM zp GROUP BY cluster, label), "
        "cm AS (SELECT cluster, label, s / sum(s) OVER (PARTITION BY cluster) AS p FROM cs), "
        "pl AS (SELECT zp.id, cm.label AS plabel, sum(zp.z * cm.p) AS prob FROM zp JOIN cm USING (cluster) GROUP BY zp.id, cm.label), "
        "pd AS (SELECT pl.id, pl.plabel FROM pl JOIN lv ON lv.label = pl.plabel "
        "QUALIFY row_number() OVER (PARTITION BY pl.id ORDER BY prob DESC, lv.label_ix) = 1) "
        "SELECT 1 - CAST(count_if(pd.plabel = e.label) AS DOUBLE) / count(*) FROM pd JOIN e USING (id))")


SQL["error_table_cells"] = with_(E, EL, ST, SL, LV, sign_rows([4], 1), (
    "zl AS (SELECT s.id, s.label, pr.j, sum(s.v * pr.r) AS v FROM sl s JOIN pr ON pr.i = s.j "
    "GROUP BY s.id, s.label, pr.j)"),
    near(10), near(10, src="zl", out="asgz", tag="z"), kmeans_err("asg", "a"), kmeans_err("asgz", "b")) + (
    f"SELECT 'N/A' AS reduction, round({em_err_sql('sl', 64)}, 6) AS em, (SELECT round(err, 6) FROM kea) AS kmeans UNION ALL "
    f"SELECT 'RCA' AS reduction, round({em_err_sql('zl', 4)}, 6) AS em, (SELECT round(err, 6) FROM keb) AS kmeans")


def hashed_start_ctes(k: int, runs: int, seed: int = 42, src: str = "sl") -> list[str]:
    """c0 keyed by run: the k rows with the smallest md5('seed-run:' || id), then id."""
    rv = ", ".join(f"({r})" for r in range(runs))
    return [
        f"rr AS (SELECT * FROM (VALUES {rv}) t(run))",
        f"rk AS (SELECT rr.run, d.id, CAST(row_number() OVER (PARTITION BY rr.run ORDER BY "
        f"md5('{seed}-' || rr.run || ':' || CAST(d.id AS VARCHAR)), d.id) - 1 AS INTEGER) AS r "
        f"FROM rr CROSS JOIN (SELECT DISTINCT id FROM {src}) d)",
        f"c0 AS (SELECT rk.run AS k, rk.r AS cluster, s.j, s.v AS c FROM rk JOIN {src} s "
        f"ON s.id = rk.id WHERE rk.r < {k})",
    ]


SETTLED = 30  # unrolled passes; the fits on the driver tables settle in fewer, and settled centres stay


def settled_sql(iters: int) -> str:
    return f"(SELECT max(abs(a.c - b.c)) <= 1e-9 FROM c{iters} a JOIN c{iters - 1} b USING (k, cluster, j))"


SQL["kmeans_confusion_fitted"] = with_(
    E, EL, ST, SL, LV, *lloyd_ctes([], SETTLED, starts=hashed_start_ctes(10, 5)), (
        f"cost AS (SELECT k, sum(d2) AS tot FROM a{SETTLED} GROUP BY k)"), (
        "best AS (SELECT k FROM cost ORDER BY tot, k LIMIT 1)"), (
        f"asg AS (SELECT id, label, cluster FROM a{SETTLED} WHERE k = (SELECT k FROM best))"),
    CNT, WIN, CELLS, CONF) + f"SELECT predicted, actual, n, {settled_sql(SETTLED)} AS converged FROM conf"


def hashed_grid_ctes(ks: list[int], runs: int, seed: int = 42, src: str = "sl") -> list[str]:
    """c0 for every (k, run) model, keyed m = 10·k + run: the first k rows of run's md5 order."""
    rv = ", ".join(f"({r})" for r in range(runs))
    kv = ", ".join(f"({k})" for k in ks)
    return [
        f"rr AS (SELECT * FROM (VALUES {rv}) t(run))",
        f"kk AS (SELECT * FROM (VALUES {kv}) t(k))",
        f"rk AS (SELECT rr.run, d.id, CAST(row_number() OVER (PARTITION BY rr.run ORDER BY "
        f"md5('{seed}-' || rr.run || ':' || CAST(d.id AS VARCHAR)), d.id) - 1 AS INTEGER) AS r "
        f"FROM rr CROSS JOIN (SELECT DISTINCT id FROM {src}) d)",
        f"c0 AS (SELECT kk.k * 10 + rk.run AS k, rk.r AS cluster, s.j, s.v AS c FROM rk "
        f"JOIN kk ON rk.r < kk.k JOIN {src} s ON s.id = rk.id)",
    ]


def best_run_ctes(iters: int) -> list[str]:
    """Best run per k (lowest total within-SS, then lowest run) → ka(k, id, label, cluster, d2)."""
    return [
        f"mc AS (SELECT k AS m, sum(d2) AS tot FROM a{iters} GROUP BY k)",
        "bm AS (SELECT m // 10 AS kk, m FROM mc "
        "QUALIFY row_number() OVER (PARTITION BY m // 10 ORDER BY tot, m % 10) = 1)",
        f"ka AS (SELECT b.kk AS k, a.id, a.label, a.cluster, a.d2 FROM a{iters} a JOIN bm b ON a.k = b.m)",
    ]


SQL["kmeans_silhouettes"] = with_(
    E, EL, ST, SL, *lloyd_ctes([], SETTLED, starts=hashed_grid_ctes([4], 5)), *best_run_ctes(SETTLED),
    SV, PAIRS, silhouette_sql("ka", "k")) + (
    f"SELECT id, cluster, neighbour, round(s, 6) AS s, {settled_sql(SETTLED)} AS converged FROM sil")

SQL["kmeans_clusters"] = with_(
    E, EL, ST, SL, LV, *lloyd_ctes([], SETTLED, starts=hashed_grid_ctes([2, 4, 8], 5)), *best_run_ctes(SETTLED),
    SV, PAIRS, silhouette_sql("ka", "k"), (
        "kc AS (SELECT a.k, a.cluster, lv.label_ix, count(*) AS n FROM ka a JOIN lv USING (label) "
        "GROUP BY a.k, a.cluster, lv.label_ix)"), (
        "kw AS (SELECT k, cluster, n AS win_n, sum(n) OVER (PARTITION BY k, cluster) AS size FROM kc "
        "QUALIFY row_number() OVER (PARTITION BY k, cluster ORDER BY n DESC, label_ix) = 1)"), (
        "le AS (SELECT k, sum((1 - CAST(win_n AS DOUBLE) / size) * size) / sum(size) AS label_err "
        "FROM kw GROUP BY k)"), (
        "ws AS (SELECT k, sum(d2) / count(*) AS within_ss FROM ka GROUP BY k)"), (
        "sa AS (SELECT k, avg(s) AS avg_s FROM sil GROUP BY k)")) + (
    "SELECT CAST(ws.k AS INTEGER) AS k, round(sa.avg_s, 6) AS avg_s, round(ws.within_ss, 6) AS within_ss, "
    "round(le.label_err, 6) AS label_err, 'E' AS test, " + settled_sql(SETTLED) + " AS converged FROM ws JOIN sa USING (k) JOIN le USING (k)")


# --- small operators on their own ------------------------------------------------------

SQL["row_reductions"] = with_(E) + (
    "SELECT id, round(list_sum(x), 6) AS total, round(list_min(x), 6) AS least, round(list_max(x), 6) AS most FROM e")

SQL["selected_columns"] = (
    "SELECT CAST(p_partkey AS BIGINT) AS id, CAST(p_size AS INTEGER) AS size, "
    "round(CAST(p_retailprice AS DOUBLE) / p_size, 6) AS unit FROM part")

SQL["priority_codes"] = (
    "SELECT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code, "
    "concat_ws('-', 'P', CAST(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS VARCHAR)) AS name, count(*) AS n "
    "FROM orders GROUP BY 1, 2")

SQL["delimited_round_trip"] = (
    "SELECT * FROM (SELECT row_number() OVER (ORDER BY p_partkey) AS id, CAST(p_partkey AS BIGINT) AS key, "
    "CAST(p_size AS INTEGER) AS size, round(CAST(p_retailprice AS DOUBLE), 6) AS price FROM part) WHERE id <> 392")

SQL["split_label_counts"] = with_(E) + (
    "SELECT CASE WHEN t THEN 'Train' ELSE 'Test' END AS side, label, count(*) AS n FROM (SELECT label, "
    "row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) <= floor(0.8 * count(*) OVER ()) AS t FROM e) GROUP BY t, label")

SQL["systematic_sample"] = (
    "SELECT id FROM (SELECT CAST(o_orderkey AS BIGINT) AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders) WHERE r % 7 = 0")

SQL["axis_min_dimension"] = with_(E, EL, ST, (
    "cu AS (SELECT j, sum(s * s) OVER (ORDER BY j) AS cum, sum(s * s) OVER () AS tot FROM st)")) + (
    "SELECT CAST(min(j) + 1 AS INTEGER) AS dims FROM cu WHERE cum > 0.9 * tot")

SQL["pca_power_sums"] = with_(E, EL, (
    "c AS (SELECT a.j AS i, b.j AS j, covar_samp(a.v, b.v) AS c FROM el a JOIN el b ON a.id = b.id GROUP BY a.j, b.j)"), (
    "c2 AS (SELECT a.i, b.j, sum(a.c * b.c) AS c FROM c a JOIN c b ON a.j = b.i GROUP BY a.i, b.j)")) + (
    "SELECT 1 AS power, round(sum(c), 6) AS total FROM c WHERE i = j UNION ALL "
    "SELECT 2 AS power, round(sum(c), 6) AS total FROM c2 WHERE i = j UNION ALL "
    "SELECT 3 AS power, round(sum(a.c * b.c), 6) AS total FROM c2 a JOIN c b ON a.j = b.i AND a.i = b.j")

SQL["projection_best"] = with_(E, EL, ST, SL, sign_rows([2, 4], 10), PROJ_ERR) + (
    "SELECT dims, run, round(err, 6) AS err FROM perr QUALIFY row_number() OVER (PARTITION BY dims ORDER BY err, run) = 1")

SQL["projection_error_stats"] = with_(E, EL, ST, SL, sign_rows([2, 4], 10), PROJ_ERR) + (
    "SELECT dims, round(avg(err), 6) AS err_mean, round(stddev_samp(err), 6) AS err_sd FROM perr GROUP BY dims")

SQL["rca_sign_curve"] = with_(E, EL, ST, SL, sign_rows([2, 4], 10), PROJ_ERR) + (
    "SELECT CAST(run + 1 AS INTEGER) AS iter, round(min(err) OVER (PARTITION BY dims ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) / (SELECT count(*) FROM e), 6) AS err, dims, 'E' AS test FROM perr")

SQL["em_spherical_components"] = with_(E, EL, ST, SL, *em_eii(3)) + (
    "SELECT CAST(g AS INTEGER) AS component, CAST(j AS INTEGER) AS j, round(mu, 6) AS mean FROM mu3")


def eii_bic_sql(G: int, p: int = 64) -> str:
    """One row (numClusters, bic over n, family) from 3 iterations of the common-variance mixture."""
    return (
        "SELECT * FROM (WITH " + ", ".join(em_eii(3, G, p)) + ", "
        "ll AS (SELECT id, max(l) + ln(sum(exp(l - mx))) AS ll FROM (SELECT id, l, max(l) OVER (PARTITION BY id) AS mx FROM lr3) GROUP BY id) "
        f"SELECT {G} AS \"numClusters\", round((2 * sum(ll) - {G - 1 + G * p + 1} * ln(count(*))) / count(*), 6) AS bic, 'EII' AS family FROM ll)")


SQL["em_spherical_bic"] = with_(E, EL, ST, SL) + eii_bic_sql(2) + " UNION ALL " + eii_bic_sql(3)


# --- nets: two descent steps unrolled ---------------------------------------------------

def net_ctes(seeds: list[int], steps: int, hidden: int, rate: float = 0.6, p: int = 64) -> list[str]:
    """w1_t / w2_t: weights before step t (i = p and h = hidden are the biases), a_t / o_t: activations, e_t: the squared error."""
    sv = ", ".join(f"({k})" for k in seeds)
    w = ("(CAST('0x' || substr(md5(s.seed || ':' || ({k})), 1, 8) AS BIGINT) / 4294967296.0 * 2 - 1) * 0.3")
    out = [
        f"sd AS (SELECT * FROM (VALUES {sv}) t(seed))",
        "nc AS (SELECT count(*) AS c FROM lv)",
        "tg AS (SELECT e.id, lv.label_ix AS y FROM e JOIN lv USING (label))",
        f"xi AS (SELECT id, j AS i, v FROM sl UNION ALL SELECT DISTINCT id, {p} AS i, 1.0 AS v FROM sl)",
        f"w1_0 AS MATERIALIZED (SELECT s.seed, i.i, h.h, {w.format(k=f'i.i * {hidden} + h.h')} AS w "
        f"FROM sd s CROSS JOIN range({p + 1}) i(i) CROSS JOIN range({hidden}) h(h))",
        f"w2_0 AS MATERIALIZED (SELECT s.seed, h.h, lv.label_ix AS c, {w.format(k=f'{(p + 1) * hidden} + h.h * (SELECT c FROM nc) + lv.label_ix')} AS w "
        f"FROM sd s CROSS JOIN range({hidden + 1}) h(h) CROSS JOIN lv)",
    ]
    for t in range(steps + 1):
        out += [
            f"h_{t} AS MATERIALIZED (SELECT w.seed, x.id, w.h, 1 / (1 + exp(-sum(x.v * w.w))) AS a FROM xi x JOIN w1_{t} w USING (i) GROUP BY w.seed, x.id, w.h)",
            f"a_{t} AS MATERIALIZED (SELECT * FROM h_{t} UNION ALL SELECT s.seed, tg.id, {hidden} AS h, 1.0 AS a FROM sd s CROSS JOIN tg)",
            f"o_{t} AS MATERIALIZED (SELECT seed, id, c, o, o - CASE WHEN c = y THEN 1.0 ELSE 0.0 END AS e, y FROM (SELECT a.seed, a.id, w.c, "
            f"1 / (1 + exp(-sum(a.a * w.w))) AS o FROM a_{t} a JOIN w2_{t} w USING (seed, h) GROUP BY a.seed, a.id, w.c) JOIN tg USING (id))",
        ]
        if t < steps:
            out += [
                f"g2_{t} AS (SELECT o.seed, a.h, o.c, sum(o.e * o.o * (1 - o.o) * a.a) AS g FROM o_{t} o JOIN a_{t} a USING (seed, id) GROUP BY o.seed, a.h, o.c)",
                f"d1_{t} AS (SELECT o.seed, o.id, w.h, sum(o.e * o.o * (1 - o.o) * w.w) AS d FROM o_{t} o JOIN w2_{t} w USING (seed, c) "
                f"WHERE w.h < {hidden} GROUP BY o.seed, o.id, w.h)",
                f"g1_{t} AS (SELECT d.seed, x.i, d.h, sum(d.d * a.a * (1 - a.a) * x.v) AS g FROM d1_{t} d JOIN a_{t} a USING (seed, id, h) "
                f"JOIN xi x USING (id) GROUP BY d.seed, x.i, d.h)",
                f"w1_{t + 1} AS MATERIALIZED (SELECT seed, i, h, w.w - {rate} * g.g / (SELECT count(*) FROM tg) AS w FROM w1_{t} w JOIN g1_{t} g USING (seed, i, h))",
                f"w2_{t + 1} AS MATERIALIZED (SELECT seed, h, c, w.w - {rate} * g.g / (SELECT count(*) FROM tg) AS w FROM w2_{t} w JOIN g2_{t} g USING (seed, h, c))",
            ]
    return out


SQL["mlp_descent_steps"] = with_(E, EL, ST, SL, LV, *net_ctes([1, 2], 2, 4)) + " UNION ALL ".join(
    f"SELECT CAST(seed AS INTEGER) AS seed, {t} AS step, round(sum(s), 6) AS sse, CAST(count_if(top <> y) AS BIGINT) AS wrong FROM (SELECT seed, id, sum(e * e) AS s, any_value(y) AS y, "
    f"arg_max(c, (o, -c)) AS top FROM o_{t} GROUP BY seed, id) GROUP BY seed" for t in range(3))


# --- supervised cuts: the first of every feature ------------------------------------------

def _bits(c: str, n: str) -> str:
    """Rows times class entropy as n log2 n - sum c log2 c over the classes of a group."""
    return f"({n} * log2({n}) - sum(CASE WHEN {c} > 0 THEN {c} * log2({c}) ELSE 0 END))"


SQL["supervised_first_cuts"] = with_(E, EL, ST, SL, near(2), (
    "tot AS (SELECT cluster, count(*) AS t, sum(count(*)) OVER () AS n FROM asg GROUP BY cluster)"), (
    "val AS (SELECT j, v, lead(v) OVER (PARTITION BY j ORDER BY v) AS nv FROM (SELECT DISTINCT j, v FROM sl))"), (
    "own AS (SELECT j, v, cluster, count(*) AS c FROM sl JOIN asg USING (id) GROUP BY j, v, cluster)"), (
    "cell AS (SELECT g.j, g.v, g.nv, tot.cluster, tot.t, tot.n, coalesce(own.c, 0) AS c FROM val g CROSS JOIN tot "
    "LEFT JOIN own ON own.j = g.j AND own.v = g.v AND own.cluster = tot.cluster)"), (
    "cum AS (SELECT j, v, nv, cluster, t, n, sum(c) OVER (PARTITION BY j, cluster ORDER BY v) AS l FROM cell)"), (
    "side AS (SELECT *, t - l AS r, sum(l) OVER (PARTITION BY j, v) AS nl FROM cum)"), (
    "cost AS (SELECT j, v, nv, any_value(n) AS n, " + _bits("l", "any_value(nl)") + " AS gl, " + _bits("r", "(any_value(n) - any_value(nl))") + " AS gr, "
    + _bits("t", "any_value(n)") + " AS gt, any_value(nl) AS nl, count(*) AS k, count_if(l > 0) AS kl, count_if(r > 0) AS kr FROM side WHERE nv IS NOT NULL GROUP BY j, v, nv)"), (
    "best AS (SELECT * FROM (SELECT *, min(gl + gr) OVER (PARTITION BY j) AS least FROM cost) WHERE gl + gr <= least + 1e-9 * n "
    "QUALIFY row_number() OVER (PARTITION BY j ORDER BY v) = 1)")) + (
    "SELECT j, round(v + (nv - v) / 2, 6) AS cut FROM best "
    "WHERE gt - gl - gr > log2(n - 1) + log2(pow(3, k) - 2) - (k * gt / n - kl * gl / nl - kr * gr / (n - nl))")


# --- scaling and stored models -----------------------------------------------------------

SQL["mds_power_sums"] = with_(E, EL, ST, SL, (
    "ce AS (SELECT id, j, v - avg(v) OVER (PARTITION BY j) AS v FROM sl)"), (
    "co AS (SELECT a.j, b.j AS k, sum(a.v * b.v) / (SELECT count(*) FROM e) AS c FROM ce a JOIN ce b USING (id) GROUP BY a.j, b.j)")) + (
    "SELECT 1 AS power, round(sum(c) FILTER (WHERE j = k), 6) AS total FROM co UNION ALL SELECT 2 AS power, round(sum(c * c), 6) AS total FROM co")

SQL["stored_model_scores"] = with_(E, EL, ST, SL, *lloyd_ctes([4], 3)) + "SELECT id, cluster, round(d2, 6) AS d2 FROM a3"


# --- identities of fitted models, file sources ---------------------------------------------

SQL["side_file_tables"] = " UNION ALL ".join(
    f"SELECT '{source}' AS source, {j} AS j, count(*) AS n, round(sum(CAST({c} AS DOUBLE)), 2) AS total, count(*) AS counted FROM part"
    for source in ("table", "lines") for j, c in enumerate(("p_size", "p_retailprice")))

SQL["gmm_total_variance"] = with_(E, EL, ST, SL, "tv AS (SELECT sum(s) AS total FROM (SELECT var_pop(v) AS s FROM sl GROUP BY j))") + (
    "SELECT family, round(total, 3) AS total FROM tv CROSS JOIN (VALUES ('EII'), ('VII'), ('EEI'), ('VVI'), ('EEE'), ('VVV')) f(family)")

SQL["ica_source_covariance"] = (
    "SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j, CASE WHEN a.i = b.j THEN 1.0 ELSE 0.0 END::DOUBLE AS c FROM range(4) a(i) CROSS JOIN range(4) b(j)")
