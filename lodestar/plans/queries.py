"""Driver query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (or data Spark derives from them), so its
work grows with them.  Doubles are rounded to 6 decimals at output only.
Each name has a DuckDB twin in :mod:`lodestar.plans.oracles` unless the
operator is iterative/numerical (then pytest holds its invariants).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.operators import kmeans as KM
from lodestar.operators import prep, scoring
from lodestar.plans.common import SEED, e_levels, near, r6, std_e
from lodestar.session import ensure_checkpoint_dir
from lodestar.sources import tables


# --- preparation -----------------------------------------------------------

def standardize_stats(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.features_embeddings(spark, sf)
    st = prep.stats_frame(e)
    return st.select("j", r6("mean").alias("mean"), r6("sd").alias("sd"))


def standardized_features(spark: SparkSession, sf: str) -> DataFrame:
    long = prep.to_long(std_e(spark, sf))
    return long.select("id", "j", r6("v").alias("v"))


def _std_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Standardised orders; the lineitem aggregate ⋈ orders runs once, into the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return prep.standardize(tables.features_orders(spark, sf).checkpoint())


def standardize_orders(spark: SparkSession, sf: str) -> DataFrame:
    return prep.to_long(_std_orders(spark, sf)).select("id", "j", r6("v").alias("v"))


def one_hot_labels(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.features_embeddings(spark, sf)
    lv, c = e_levels(e)
    return prep.one_hot_long(prep.with_label_ix(e, lv), c)


def one_hot_decode(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.features_embeddings(spark, sf)
    lv, c = e_levels(e)
    wide = prep.one_hot(prep.with_label_ix(e, lv), c).select("id", "y")
    dec = prep.one_hot_decode(wide, "y", "label_ix")
    return dec.join(lv, "label_ix").select("id", "label")


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.features_embeddings(spark, sf)
    return prep.train_test_split(e, 0.8, SEED)


# --- nearest centre and scoring ---------------------------------------------

def nearest_center(spark: SparkSession, sf: str) -> DataFrame:
    a, _ = near(std_e(spark, sf), 10)
    return a.select("id", "cluster", r6("d2").alias("d2"))


def kmeans_cost(spark: SparkSession, sf: str) -> DataFrame:
    a, _ = near(std_e(spark, sf), 10)
    return KM.cost_table(a).select("cluster", F.col("n").cast("bigint").alias("n"),
                                   r6("within_ss").alias("within_ss"))


def cluster_label_error(spark: SparkSession, sf: str) -> DataFrame:
    s = std_e(spark, sf)
    a, _ = near(s, 10)
    lv, _ = e_levels(s)
    t = scoring.cluster_predict_err(a, lv)
    return t.select("cluster", "argmax", "size", r6("err").alias("err"),
                    r6("err_rate").alias("err_rate"))


def cluster_confusion(spark: SparkSession, sf: str) -> DataFrame:
    s = std_e(spark, sf)
    a, _ = near(s, 10)
    lv, c = e_levels(s)
    return scoring.cluster_confusion(a, lv, c).select("predicted", "actual", "n")


def confusion_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    s = std_e(spark, sf)
    a, _ = near(s, 10)
    lv, c = e_levels(s)
    conf = scoring.cluster_confusion(a, lv, c)
    return scoring.confusion_error(conf).select(r6("err").alias("err"))


def nearest_wrong_label(spark: SparkSession, sf: str) -> DataFrame:
    s = std_e(spark, sf)
    a, _ = near(s, 10)
    lv, c = e_levels(s)
    conf = scoring.cluster_confusion(a, lv, c, square=True)
    return scoring.nearest_wrong(conf).select("target", "nearest",
                                              r6("nearest_ratio").alias("nearest_ratio"))


def cluster_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    a, _ = near(std_e(spark, sf), 10)
    return scoring.cluster_spectrum(a).select("idx", "cluster", "size", r6("share").alias("share"))


def cluster_label_variance(spark: SparkSession, sf: str) -> DataFrame:
    a, _ = near(std_e(spark, sf), 10)
    return scoring.cluster_label_variance(a).select("cluster", "n", r6("label_var").alias("label_var"))


QUERIES = {
    "standardize_stats": standardize_stats,
    "standardized_features": standardized_features,
    "standardize_orders": standardize_orders,
    "one_hot_labels": one_hot_labels,
    "one_hot_decode": one_hot_decode,
    "train_test_split": train_test_split,
    "nearest_center": nearest_center,
    "kmeans_cost": kmeans_cost,
    "cluster_label_error": cluster_label_error,
    "cluster_confusion": cluster_confusion,
    "confusion_error_rate": confusion_error_rate,
    "nearest_wrong_label": nearest_wrong_label,
    "cluster_spectrum": cluster_spectrum,
    "cluster_label_variance": cluster_label_variance,
}


# --- iterative k-means (U oracles: first ids as starts, fixed iterations) ----

def kmeans_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    s = std_e(spark, sf)
    m = KM.lloyd(s, [KM.first_rows(s, 4)], max_iter=3)[0]
    a = KM.assign(s, m.centers)
    return KM.cost_table(a).select("cluster", F.col("n").cast("bigint").alias("n"),
                                   r6("within_ss").alias("within_ss"))


def kmeans_sse_curve(spark: SparkSession, sf: str) -> DataFrame:
    s = std_e(spark, sf)
    c = KM.sse_curve(s, [2, 4, 8], SEED, runs=1, max_iter=2, init="first")
    return c.select("k", r6("within_ss_mean").alias("within_ss_mean"))


def cluster_label_error_curve(spark: SparkSession, sf: str) -> DataFrame:
    s = std_e(spark, sf)
    best = KM.kmeans_grid(s, [2, 4, 8], SEED, runs=1, max_iter=2, init="first")
    errs = _X().label_errors(s, {k: m.centers for k, m in best.items()})
    df = spark.createDataFrame(sorted(errs.items()), "k INT, err DOUBLE")
    return df.select("k", r6("err").alias("err"))


# --- distance histograms ------------------------------------------------------

def distance_histogram(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import histogram as H
    s = std_e(spark, sf)
    centers = KM.first_rows(s, 4)
    a = KM.assign(s, centers, passthrough=("id", "x"))
    d = H.distances_to_own_center(a, centers)
    h = H.cumulative_histogram(d, 500)
    return h.select("class", "bin", r6("mid").alias("mid"), r6("cum_prob").alias("cum_prob"))


def event_value_histogram(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import histogram as H
    v = tables.features_events(spark, sf)
    v1 = v.select("label", F.col("x")[0].alias("value"))
    means = v1.groupBy(F.col("label").alias("of")).agg(F.avg("value").alias("center"))
    d = v1.join(means, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("label").alias("class"), F.abs(F.col("value") - F.col("center")).alias("d"))
    h = H.cumulative_histogram(d, 500)
    return h.select("class", "bin", r6("mid").alias("mid"), r6("cum_prob").alias("cum_prob"))


# --- silhouettes ---------------------------------------------------------------

def pairwise_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import silhouette as SH
    s = std_e(spark, sf)
    centers = KM.first_rows(s, 4)
    a = KM.assign(s, centers, passthrough=("id", "x"))
    per = SH.silhouette_exact(a)
    return per.select("id", "cluster", "neighbour", r6("s").alias("s"))


def silhouette_by_k(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import silhouette as SH
    s = std_e(spark, sf)
    a = KM.assign_many(s, {k: KM.first_rows(s, k) for k in (2, 4)}, passthrough=("id", "x"))
    w = SH.silhouette_many(a).groupBy("model").agg(F.avg("s").alias("avg_width"))
    return w.select(F.col("model").cast("int").alias("k"), r6("avg_width").alias("avg_width"))


# --- Gram / covariance / reconstruction error ---------------------------------

def covariance_matrix(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    e = tables.features_embeddings(spark, sf)
    st = prep.column_stats(e)
    mo = LA.moments(e, len(st.mean), shift=st.mean)
    return LA.matrix_frame(spark, mo.covariance(), "cov").select("i", "j", r6("cov").alias("cov"))


def gram_matrix(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    s = std_e(spark, sf)
    p = tables.dims(s)
    return LA.matrix_frame(spark, LA.gram(s, p), "v").select("i", "j", r6("v").alias("v"))


def recon_error_axis(spark: SparkSession, sf: str) -> DataFrame:
    import numpy as np
    from lodestar.operators import linalg as LA
    s = std_e(spark, sf)
    p = tables.dims(s)
    mo = LA.moments(s, p)
    S = mo.gram()
    rows = []
    for d in range(1, p + 1):
        M = np.diag([1.0] * d + [0.0] * (p - d))
        err = LA.recon_error(S, M)
        rows.append((d, err, err / mo.n))
    df = spark.createDataFrame(rows, "dims INT, err_total DOUBLE, err_mean DOUBLE")
    return df.select("dims", r6("err_total").alias("err_total"), r6("err_mean").alias("err_mean"))


QUERIES.update({
    "kmeans_lloyd": kmeans_lloyd,
    "kmeans_sse_curve": kmeans_sse_curve,
    "cluster_label_error_curve": cluster_label_error_curve,
    "distance_histogram": distance_histogram,
    "event_value_histogram": event_value_histogram,
    "pairwise_silhouette": pairwise_silhouette,
    "silhouette_by_k": silhouette_by_k,
    "covariance_matrix": covariance_matrix,
    "gram_matrix": gram_matrix,
    "recon_error_axis": recon_error_axis,
})


# --- random projections -------------------------------------------------------

def sign_projection(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    R = RD.sign_matrix(tables.dims(s), 4, SEED, 0)
    return LA.project_long(s, R).select("id", "j", r6("v").alias("v"))


def projection_error(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    S = LA.gram(s, tables.dims(s))
    e = RD.projection_errors(spark, S, [2, 4], 10, SEED, family="sign")
    return e.select("dims", "run", r6("err").alias("err"))


def projection_running_best(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    S = LA.gram(s, tables.dims(s))
    e = RD.running_best(RD.projection_errors(spark, S, [4], 20, SEED, family="sign"))
    return e.select("run", r6("err").alias("err"), r6("best_err").alias("best_err"))


def cluster_projected(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    R = RD.sign_matrix(tables.dims(s), 4, SEED, 0)
    z = LA.project(s, R, passthrough=("id", "label"))
    a, _ = near(z, 10)
    lv, _ = e_levels(s)
    t = scoring.cluster_predict_err(a, lv)
    return t.select("cluster", "argmax", "size", r6("err").alias("err"))


# --- feature selection statistics -------------------------------------------------

def symmetric_uncertainty(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import select as SEL
    e = tables.features_embeddings(spark, sf)
    su = SEL.su_feature_class(SEL.discretize(e, 5))
    return su.select("j", r6("su").alias("su"))


def feature_pair_uncertainty(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import select as SEL
    e = tables.features_embeddings(spark, sf)
    su = SEL.su_feature_pairs(SEL.discretize(e, 5, label=None), tables.dims(e), 5)
    return SEL.su_pairs_frame(spark, su).select("i", "j", r6("su").alias("su"))


def _cfs_greedy(spark: SparkSession, sf: str, steps: int):
    """Greedy merit over every feature of E."""
    import numpy as np
    from lodestar.functions.caching import cached
    from lodestar.operators import select as SEL
    e = tables.features_embeddings(spark, sf)
    with cached(SEL.discretize(e, 5)) as binned:
        su = {r["j"]: r["su"] for r in SEL.su_feature_class(binned).collect()}
        p = len(su)
        return SEL.greedy_forward(np.array([su[j] for j in range(p)]), SEL.su_feature_pairs(binned, p, 5), steps)


def cfs_merit_greedy(spark: SparkSession, sf: str) -> DataFrame:
    df = spark.createDataFrame(_cfs_greedy(spark, sf, 3), "step INT, j INT, merit DOUBLE")
    return df.select("step", "j", r6("merit").alias("merit"))


# --- soft assignments and EM ----------------------------------------------------------

def _soft(spark: SparkSession, sf: str):
    s = std_e(spark, sf)
    soft = KM.soft_assign(s, KM.first_rows(s, 4))
    return s, soft


def soft_class_matrix(spark: SparkSession, sf: str) -> DataFrame:
    s, soft = _soft(spark, sf)
    m = scoring.soft_class_matrix(soft, 4)
    return m.select("cluster", "label", r6("p").alias("p"))


def soft_label_confusion(spark: SparkSession, sf: str) -> DataFrame:
    s, soft = _soft(spark, sf)
    lv, c = e_levels(s)
    return scoring.soft_label_confusion(soft, lv, 4, c).select("predicted", "actual", "n")


def em_spherical(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import mixture as MX
    s = std_e(spark, sf)
    start = MX.init_from_centers(KM.first_rows(s, 2), "EII", var=1.0)
    m = MX.em(s, [start], max_iter=3, tol=0.0, reg=0.0)[0]
    rows = [(g, float(m.weights[g]), float(m.covs[g, 0])) for g in range(m.G)]
    df = spark.createDataFrame(rows, "component INT, weight DOUBLE, var DOUBLE")
    return df.select("component", r6("weight").alias("weight"), r6("var").alias("var"))


# --- class scatter, contributions, learning-curve statistics -------------------------

def class_scatter(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    lv, c = e_levels(s)
    sc = RD.class_scatter(prep.with_label_ix(s, lv), tables.dims(s), c)
    w = LA.matrix_frame(spark, sc.within, "within")
    b = LA.matrix_frame(spark, sc.between, "between")
    return w.join(b, ["i", "j"]).select("i", "j", r6("within").alias("within"),
                                        r6("between").alias("between"))


def cumulative_contribution(spark: SparkSession, sf: str) -> DataFrame:
    """M18 with M = unit class-centroid directions (p x classes, level order)."""
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    lv, _ = e_levels(s)
    long = (prep.with_label_ix(s, lv).select(F.col("label_ix").alias("j"), F.posexplode("x").alias("i", "v"))
            .groupBy("j", "i").agg(F.avg("v").alias("m")))
    norm = F.sqrt(F.sum(F.col("m") * F.col("m")).over(Window.partitionBy("j")))
    m_long = long.select(F.col("i").cast("int").alias("i"), "j", (F.col("m") / norm).alias("v"))
    return RD.contributions_frame(m_long).select("feature", "ind", r6("value").alias("value"))


def loss_curve_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A4 over a learning-curve-shaped table: run = label, stage = split side,
    idx = k, error = mean over the run's rows of the min d² to the first k start rows."""
    s = std_e(spark, sf)
    mins = KM.center_distances(s, KM.first_rows(s, 10), out="m", running_min=True)
    split = prep.train_test_split(s, 0.8, SEED)
    rows = mins.join(split, "id")
    long = rows.select("label", F.when(F.col("is_train"), "Train").otherwise("Test").alias("stage"),
                       F.posexplode("m").alias("pos", "e"))
    per_run = long.groupBy("label", "stage", "pos").agg(F.avg("e").alias("error"))
    st = per_run.groupBy("stage", (F.col("pos") + 1).cast("int").alias("idx")).agg(
        F.avg("error").alias("err_mean"), F.stddev_samp("error").alias("err_sd"))
    return st.select("stage", "idx", r6("err_mean").alias("err_mean"), r6("err_sd").alias("err_sd"))


QUERIES.update({
    "sign_projection": sign_projection,
    "projection_error": projection_error,
    "projection_running_best": projection_running_best,
    "cluster_projected": cluster_projected,
    "symmetric_uncertainty": symmetric_uncertainty,
    "feature_pair_uncertainty": feature_pair_uncertainty,
    "cfs_merit_greedy": cfs_merit_greedy,
    "soft_class_matrix": soft_class_matrix,
    "soft_label_confusion": soft_label_confusion,
    "em_spherical": em_spherical,
    "class_scatter": class_scatter,
    "cumulative_contribution": cumulative_contribution,
    "loss_curve_stats": loss_curve_stats,
})


# --- rows-only numerical pipelines (invariants in pytest) ----------------------------
# Small grids; the reference's sweep sizes are the same calls with larger lists.

def _X():
    from lodestar.plans import experiments
    return experiments


def pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _X().pca_scores(std_e(spark, sf), 2).select("id", "label", "j", r6("v").alias("v"))


def pca_explained(spark: SparkSession, sf: str) -> DataFrame:
    ev = _X().pca_explained(spark, std_e(spark, sf))
    return ev.select("component", r6("eigenvalue").alias("eigenvalue"), r6("share").alias("share"),
                     r6("cum_share").alias("cum_share"))


def min_dimension(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import reduce as RD
    ev = _X().pca_explained(spark, std_e(spark, sf))
    return RD.min_dimension_frame(ev, 0.90).select(F.col("dims").cast("int").alias("dims"))


def pca_recon_error(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().pca_recon_error(spark, std_e(spark, sf), "E")
    return e.select("dims", r6("err").alias("err"), "test")


def pca_contribution(spark: SparkSession, sf: str) -> DataFrame:
    c = _X().pca_contributions(spark, std_e(spark, sf))
    return c.select("feature", "ind", r6("value").alias("value"))


def mds_points(spark: SparkSession, sf: str) -> DataFrame:
    """Classical scaling in two dimensions, placed from 100 farthest-first landmarks; ``share`` is its fit."""
    from lodestar.operators import manifold as MF
    s = std_e(spark, sf)
    m = MF.mds_fit(s, 100)
    z = MF.place(s, m, 2)
    return z.select("id", "label", F.posexplode("z").alias("j", "v"), F.lit(m.share(2)).alias("share")).select(
        "id", "label", F.col("j").cast("int").alias("j"), r6("v").alias("v"), r6("share").alias("share"))


def mds_power_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Power sums of the scaling's eigenvalues per row, which the full matrix fixes."""
    from lodestar.operators import manifold as MF
    s = std_e(spark, sf)
    lam = MF.mds_fit(s, 100).eigenvalues / s.count()
    df = spark.createDataFrame([(k, float((lam ** k).sum())) for k in (1, 2)], "power INT, total DOUBLE")
    return df.select("power", r6("total").alias("total"))


def kernel_pca(spark: SparkSession, sf: str) -> DataFrame:
    """Two kernel components through 256 landmarks; ``residual`` is the mean kernel mass beyond their span."""
    from lodestar.operators import manifold as MF
    s = std_e(spark, sf)
    m = MF.kernel_pca_fit(s, 256, 0.01)
    z = MF.place(s, m, 2)
    return z.select("id", "label", F.posexplode("z").alias("j", "v"), F.lit(m.residual).alias("residual")).select(
        "id", "label", F.col("j").cast("int").alias("j"), r6("v").alias("v"), r6("residual").alias("residual"))


def stored_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A k-means is fitted, stored, loaded and then scores every row."""
    import uuid
    from lodestar.sources import models as ST
    s = std_e(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4()}"
    ST.save(spark, KM.lloyd(s, [KM.first_rows(s, 4)], max_iter=3)[0], path)
    return KM.assign(s, ST.load(spark, path).centers).select("id", "cluster", r6("d2").alias("d2"))


def ica_sources(spark: SparkSession, sf: str) -> DataFrame:
    z = _X().ica_sources(std_e(spark, sf), 2, SEED)
    return z.select("id", "label", "j", r6("v").alias("v"), "ica_converged")


def ica_recon_error(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().ica_recon_error(spark, std_e(spark, sf), [2, 4, 8], SEED, "E")
    return e.select("dims", r6("err").alias("err"), "test")


def rca_haar_best(spark: SparkSession, sf: str) -> DataFrame:
    c = _X().rca_error_curve(spark, std_e(spark, sf), [4], 20, SEED, family="haar")
    return c.select("iter", r6("err").alias("err"), "dims", "test")


def rca_error_curve(spark: SparkSession, sf: str) -> DataFrame:
    c = _X().rca_error_curve(spark, std_e(spark, sf), [2, 4, 8], 10, SEED, family="haar")
    return c.select("iter", r6("err").alias("err"), "dims", "test")


def rca_projected(spark: SparkSession, sf: str) -> DataFrame:
    _, proj = _X().rca_best_projection(spark, std_e(spark, sf), 2, 20, SEED)
    return proj.select("id", "label", F.posexplode("x").alias("j", "v")).select(
        "id", "label", F.col("j").cast("int").alias("j"), r6("v").alias("v"))


def gmm_bic_curve(spark: SparkSession, sf: str) -> DataFrame:
    """All fourteen families on the whole standardised table, fitted until the likelihood settles."""
    from lodestar.operators import mixture as MX
    t = MX.bic_table(spark, _X().mixture_grid(std_e(spark, sf), [2, 3, 4], MX.FAMILIES, SEED))
    return t.select("numClusters", "family", r6("bic").alias("bic"), "converged")


def gmm_best_bic(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import mixture as MX
    models = _X().mixture_grid(std_e(spark, sf), [2, 3, 4], MX.FAMILIES, SEED)
    t = MX.bic_table(spark, models)
    b = scoring.best_bic(t, max(m.n for m in models)).join(t.drop("bic"), ["numClusters", "family"], "left")
    return b.select("numClusters", r6("bic").alias("bic"), "family", "converged")


def gmm_components(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import mixture as MX
    m = _X().mixture_grid(std_e(spark, sf), [3], ["VVV"], SEED)[0]
    return MX.components_frame(spark, m).select("component", r6("weight").alias("weight"),
                                                 "mean", "cov", "converged")


def em_confusion(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import mixture as MX
    s = std_e(spark, sf)
    m = _X().mixture_grid(s, [4], ["VVI"], SEED)[0]
    lv, c = e_levels(s)
    return scoring.soft_label_confusion(MX.posterior(s, m), lv, m.G, c).select(
        "predicted", "actual", "n", F.lit(m.converged).alias("converged"))


def lda_scores(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    lv, c = e_levels(s)
    p = tables.dims(s)
    sc = RD.class_scatter(prep.with_label_ix(s, lv), p, c)
    D = RD.lda_directions(sc, 2)
    z = LA.project(s, D, passthrough=("id", "label"), out="z")
    return z.select("id", "label", F.posexplode("z").alias("j", "v")).select(
        "id", "label", F.col("j").cast("int").alias("j"), r6("v").alias("v"))


def rff_pca(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    z = RD.rff_map(s, tables.dims(s), 128, 0.1, SEED)
    return _X().pca_scores(z, 2).select("id", "label", "j", r6("v").alias("v"))


def reduced_kmeans_error(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().reduced_kmeans_error(spark, std_e(spark, sf), 4, [10], SEED, runs=8)
    return e.select("k", r6("err").alias("err"), "dims", "algo", "ica_converged")


def reduced_sse_curve(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().reduced_sse_curve(spark, std_e(spark, sf), 4, [4, 8, 12], SEED, runs=3)
    return e.select("k", r6("within_ss_mean").alias("within_ss_mean"), "algo", "ica_converged")


def kmeans_clusters(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().kmeans_clusters(spark, std_e(spark, sf), [2, 4, 8], SEED, 5, 100, "E")
    return e.select("k", r6("avg_s").alias("avg_s"), r6("within_ss").alias("within_ss"),
                    r6("label_err").alias("label_err"), "test", "converged")


def kmeans_sweep(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().kmeans_sweep(spark, std_e(spark, sf), [2, 5, 10, 20], SEED, runs=50)
    return e.select("k", r6("lloyd").alias("lloyd"), r6("cost").alias("cost"), r6("label_err").alias("label_err"), "converged")


def kmeans_silhouettes(spark: SparkSession, sf: str) -> DataFrame:
    per = _X().kmeans_silhouettes(std_e(spark, sf), 4, SEED, runs=5, iters=100)
    return per.select("id", "cluster", "neighbour", r6("s").alias("s"), "converged")


def kmeans_confusion_fitted(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import kmeans_sweep as KS
    s = std_e(spark, sf)
    m = KS.sweep(s, [10], SEED, runs=5)[10]
    lv, c = e_levels(s)
    return scoring.cluster_confusion(KM.assign(s, m.centers), lv, c).select("predicted", "actual", "n", F.lit(m.converged).alias("converged"))


RUNS = range(1, 21)  # seeds of the repeated nets


def mlp_learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().net_learning_curve(spark, std_e(spark, sf), SEED, iters=100)
    return e.select("idx", r6("error").alias("error"), "stage")


def mlp_error_by_dims(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().net_error_by_dims(spark, std_e(spark, sf), [2, 5, 10, 15, 20, 25], RUNS, SEED, 15)
    return e.select("dims", "algo", "stage", r6("error").alias("error"), r6("error_sd").alias("error_sd"), "ica_converged")


def mlp_on_clusters(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().net_on_clusters(spark, std_e(spark, sf), 10, RUNS, SEED, 15)
    return e.select("inputs", "type", "stage", r6("error").alias("error"), r6("error_sd").alias("error_sd"), "converged")


def mlp_descent_steps(spark: SparkSession, sf: str) -> DataFrame:
    """M27 step by step: squared error and wrong rows of two nets before, after one and after two plain
    descent steps on every row from md5 weights."""
    from lodestar.operators import backprop as BP
    s = std_e(spark, sf)
    lv, c = e_levels(s)
    p = tables.dims(s)
    fits = BP.train(prep.with_label_ix(s, lv).withColumn("fold", F.lit(0)), [BP.Net((), seed, tuple(range(p))) for seed in (1, 2)], c, 2,
                    hidden=4, method="descent")
    rows = [(f.net.seed, step, sse, wrong) for f in fits for step, stage, sse, wrong, _ in f.curve if stage == "Train"]
    return spark.createDataFrame(rows, "seed INT, step INT, sse DOUBLE, wrong BIGINT").select("seed", "step", r6("sse").alias("sse"), "wrong")


def cfs_selection(spark: SparkSession, sf: str) -> DataFrame:
    """M25 best-first subset and M26 / X5 error of dropping the rest (total and per row)."""
    import numpy as np
    from lodestar.operators import linalg as LA
    from lodestar.operators import select as SEL
    s = std_e(spark, sf)
    p = tables.dims(s)
    keep = _X().cfs_subset(s, p)
    mo = LA.moments(s, p)
    tot, per = SEL.dropped_feature_error(np.diag(mo.gram()), keep, mo.n)
    rows = [(len(keep), [int(j) for j in keep], tot, per)]
    df = spark.createDataFrame(rows, "dims INT, keep ARRAY<INT>, err_total DOUBLE, err_mean DOUBLE")
    features = F.concat_ws(",", F.transform("keep", lambda v: v.cast("string")))  # F4 paste(collapse=)
    return df.select("dims", features.alias("features"), r6("err_total").alias("err_total"),
                     r6("err_mean").alias("err_mean"))


def supervised_first_cuts(spark: SparkSession, sf: str) -> DataFrame:
    """The first accepted description-length cut of every feature against the nearer of two centres."""
    from lodestar.operators import supervised_cuts as CUT
    s = std_e(spark, sf)
    a = KM.assign(s, KM.first_rows(s, 2), passthrough=("id", "x"))
    cuts = CUT.entropy_cuts(a, 2, ix="cluster", depth=1)
    rows = [(j, float(v)) for j, own in enumerate(cuts) for v in own]
    return spark.createDataFrame(rows, "j INT, cut DOUBLE").select("j", r6("cut").alias("cut"))


def scala_sweep(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().scala_sweep(spark, std_e(spark, sf), [0, 4, 8], [5, 10], SEED)
    return e.select("dims", "k", r6("cost").alias("cost"), "cluster", "n", r6("label_var").alias("label_var"))


def silhouette_squared_e(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import silhouette as SH
    s = std_e(spark, sf)
    a = KM.assign(s, KM.first_rows(s, 4), passthrough=("id", "x"))
    return SH.silhouette_squared(a).select("id", "cluster", "neighbour", r6("s").alias("s"))


QUERIES.update({
    "pca_scores": pca_scores,
    "pca_explained": pca_explained,
    "min_dimension": min_dimension,
    "pca_recon_error": pca_recon_error,
    "pca_contribution": pca_contribution,
    "mds_points": mds_points,
    "mds_power_sums": mds_power_sums,
    "kernel_pca": kernel_pca,
    "stored_model_scores": stored_model_scores,
    "ica_sources": ica_sources,
    "ica_recon_error": ica_recon_error,
    "rca_haar_best": rca_haar_best,
    "rca_error_curve": rca_error_curve,
    "rca_projected": rca_projected,
    "gmm_bic_curve": gmm_bic_curve,
    "gmm_best_bic": gmm_best_bic,
    "gmm_components": gmm_components,
    "em_confusion": em_confusion,
    "lda_scores": lda_scores,
    "rff_pca": rff_pca,
    "reduced_kmeans_error": reduced_kmeans_error,
    "reduced_sse_curve": reduced_sse_curve,
    "kmeans_clusters": kmeans_clusters,
    "kmeans_confusion_fitted": kmeans_confusion_fitted,
    "kmeans_silhouettes": kmeans_silhouettes,
    "kmeans_sweep": kmeans_sweep,
    "mlp_learning_curve": mlp_learning_curve,
    "mlp_error_by_dims": mlp_error_by_dims,
    "mlp_on_clusters": mlp_on_clusters,
    "mlp_descent_steps": mlp_descent_steps,
    "supervised_first_cuts": supervised_first_cuts,
    "cfs_selection": cfs_selection,
    "scala_sweep": scala_sweep,
    "silhouette_squared_e": silhouette_squared_e,
})


# --- scalable bindings: orders ⋈ lineitem (O), part (P) ---------------------------

def kmeans_orders_lloyd(spark: SparkSession, sf: str) -> DataFrame:
    o = _std_orders(spark, sf)
    m = KM.lloyd(o, [KM.first_rows(o, 5)], max_iter=3)[0]
    return KM.cost_table(KM.assign(o, m.centers)).select(
        "cluster", F.col("n").cast("bigint").alias("n"), r6("within_ss").alias("within_ss"))


def orders_cluster_label_error(spark: SparkSession, sf: str) -> DataFrame:
    o = _std_orders(spark, sf)
    m = KM.lloyd(o, [KM.first_rows(o, 5)], max_iter=3)[0]
    t = scoring.cluster_predict_err(KM.assign(o, m.centers), prep.levels(o))
    return t.select("cluster", "argmax", "size", r6("err").alias("err"), r6("err_rate").alias("err_rate"))


def orders_split(spark: SparkSession, sf: str) -> DataFrame:
    return prep.train_test_split(tables.features_orders(spark, sf), 0.8, SEED)


def silhouette_squared_orders(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import silhouette as SH
    o = _std_orders(spark, sf)
    a = KM.assign(o, KM.first_rows(o, 5), passthrough=("id", "x"))
    return SH.silhouette_squared(a).select("id", "cluster", "neighbour", r6("s").alias("s"))


def part_cluster_confusion(spark: SparkSession, sf: str) -> DataFrame:
    pt = prep.standardize(tables.features_part(spark, sf))
    a, _ = near(pt, 6)
    lv, c = e_levels(pt)
    return scoring.cluster_confusion(a, lv, c).select("predicted", "actual", "n")


def spectrum_by_algo(spark: SparkSession, sf: str) -> DataFrame:
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    z = LA.project(s, RD.sign_matrix(tables.dims(s), 4, SEED, 0), passthrough=("id", "label"))
    a1, _ = near(s, 10)
    a2, _ = near(z, 10)
    both = (a1.select(F.lit("N/A").alias("algo"), "cluster")
            .unionByName(a2.select(F.lit("RCA").alias("algo"), "cluster")))
    return scoring.cluster_spectrum(both, algo="algo").select("algo", "idx", "cluster", "size",
                                                             r6("share").alias("share"))


def reduced_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster sizes of fitted k-means on the input and all four reductions."""
    return _X().reduced_spectrum(spark, std_e(spark, sf), 4, 10, SEED, runs=4).select(
        "algo", "idx", "cluster", "size", r6("share").alias("share"), "ica_converged")


def error_table_cells(spark: SparkSession, sf: str) -> DataFrame:
    """X9 / P20 cells with given models: k-means on the first 10 rows as centres, EM as 3
    iterations of a common-variance mixture from the first 4 rows, on E and its sign projection."""
    from lodestar.operators import linalg as LA
    from lodestar.operators import mixture as MX
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    lv, c = e_levels(s)
    z = LA.project(s, RD.sign_matrix(tables.dims(s), 4, SEED, 0), passthrough=("id", "label"))
    cells = None
    for red, data in (("N/A", s), ("RCA", z)):
        a, _ = near(data, 10)
        km = scoring.confusion_error(scoring.cluster_confusion(a, lv, c))
        m = MX.em(data, [MX.init_from_centers(KM.first_rows(data, 4), "EII", 1.0)], max_iter=3, tol=0.0, reg=0.0)[0]
        em = scoring.confusion_error(scoring.soft_label_confusion(MX.posterior(data, m), lv, 4, c))
        part = (km.select(F.lit(red).alias("reduction"), F.lit("kmeans").alias("method"), "err")
                .unionByName(em.select(F.lit(red).alias("reduction"), F.lit("em").alias("method"), "err")))
        cells = part if cells is None else cells.unionByName(part)
    t = prep.report_table(cells, "reduction", "method", "err", ["em", "kmeans"])
    return t.select("reduction", r6("em").alias("em"), r6("kmeans").alias("kmeans"))


def reduced_error_table(spark: SparkSession, sf: str) -> DataFrame:
    """Error of a fitted mixture and of fitted k-means on the input and all four reductions."""
    t = _X().reduced_error_table(spark, std_e(spark, sf), 4, 10, 4, "VVI", SEED, runs=2)
    return t.select("reduction", r6("em").alias("em"), r6("kmeans").alias("kmeans"), "converged", "ica_converged")


def label_variance_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """X25 at dims = 0: per k and cluster, size and summed label variance."""
    s = std_e(spark, sf)
    best = KM.kmeans_grid(s, [5, 10], SEED, runs=1, max_iter=2, init="first")
    out = None
    for k, m in sorted(best.items()):
        v = scoring.cluster_label_variance(KM.assign(s, m.centers)).select(
            F.lit(k).cast("int").alias("k"), "cluster", "n", r6("label_var").alias("label_var"))
        out = v if out is None else out.unionByName(v)
    return out


QUERIES.update({
    "kmeans_orders_lloyd": kmeans_orders_lloyd,
    "orders_cluster_label_error": orders_cluster_label_error,
    "orders_split": orders_split,
    "silhouette_squared_orders": silhouette_squared_orders,
    "part_cluster_confusion": part_cluster_confusion,
    "spectrum_by_algo": spectrum_by_algo,
    "reduced_spectrum": reduced_spectrum,
    "error_table_cells": error_table_cells,
    "reduced_error_table": reduced_error_table,
    "label_variance_sweep": label_variance_sweep,
})


def cfs_recon_error(spark: SparkSession, sf: str) -> DataFrame:
    """Error of keeping only the 3 features that greedy merit chooses among all —
    Σ x² over every dropped feature of standardised E, total and per row."""
    import numpy as np
    from lodestar.operators import linalg as LA
    from lodestar.operators import select as SEL
    keep = [j for _, j, _ in _cfs_greedy(spark, sf, 3)]
    s = std_e(spark, sf)
    mo = LA.moments(s, tables.dims(s))
    tot, per = SEL.dropped_feature_error(np.diag(mo.gram()), keep, mo.n)
    df = spark.createDataFrame([(len(keep), tot, per)], "dims INT, err_total DOUBLE, err_mean DOUBLE")
    return df.select("dims", r6("err_total").alias("err_total"), r6("err_mean").alias("err_mean"))


QUERIES["cfs_recon_error"] = cfs_recon_error


def reduced_em_bic(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().reduced_em_bic(spark, std_e(spark, sf), 4, [2, 4], ["VVI", "VVV"], SEED)
    return e.select("algo", "numClusters", "family", r6("bic").alias("bic"), "converged", "ica_converged")


QUERIES["reduced_em_bic"] = reduced_em_bic


def mlp_cluster_learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().net_cluster_learning_curve(spark, std_e(spark, sf), 10, RUNS, SEED, iters=200)
    return e.select("idx", "stage", "algo", "inputs", r6("err_mean").alias("err_mean"),
                    r6("err_sd").alias("err_sd"), "converged")


QUERIES["mlp_cluster_learning_curve"] = mlp_cluster_learning_curve


def mlp_learning_by_dims(spark: SparkSession, sf: str) -> DataFrame:
    e = _X().net_learning_by_dims(spark, std_e(spark, sf), [5, 10, 15], SEED, iters=100)
    return e.select("idx", r6("error").alias("error"), "stage", "dims")


QUERIES["mlp_learning_by_dims"] = mlp_learning_by_dims


# --- small operators on their own ------------------------------------------------------

def row_reductions(spark: SparkSession, sf: str) -> DataFrame:
    """Sum, least and greatest entry of every vector."""
    from lodestar.functions import vectors as V
    e = tables.features_embeddings(spark, sf)
    return e.select("id", r6(V.row_sum("x")).alias("total"), r6(F.array_min("x")).alias("least"), r6(F.array_max("x")).alias("most"))


def selected_columns(spark: SparkSession, sf: str) -> DataFrame:
    """P2 columns by list, P3 columns dropped by membership, P5 all renamed, P7 one removed."""
    t = tables.read_table(spark, sf, "part")
    wanted = [c for c in ("p_partkey", "p_type", "p_size", "p_retailprice") if c in t.columns]
    unwanted = {"p_type"}
    t = t.select(*wanted)
    t = t.select(*[c for c in t.columns if c not in unwanted])
    t = t.toDF("id", "size", "price").withColumn("unit", F.col("price") / F.col("size")).drop("price")
    return t.select(F.col("id").cast("bigint").alias("id"), F.col("size").cast("int").alias("size"), r6("unit").alias("unit"))


def priority_codes(spark: SparkSession, sf: str) -> DataFrame:
    """F2 substring, F3 string to int, F4 paste: orders per leading digit of the priority."""
    from lodestar.sources import text
    o = tables.read_table(spark, sf, "orders")
    return (o.groupBy(text.number_at("o_orderpriority", 1, 1).alias("code")).agg(F.count("*").alias("n"))
            .select("code", F.concat_ws("-", F.lit("P"), F.col("code").cast("string")).alias("name"), "n"))


def delimited_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Part written as header-less tab-separated files in key order, read
    back with a declared schema and line numbers, one line dropped by its number."""
    import uuid

    from pyspark.sql import types as T

    from lodestar.sources import text
    folder = f"{ensure_checkpoint_dir(spark)}/tsv-{uuid.uuid4()}"
    p = tables.read_table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_retailprice").cast("double").alias("p_retailprice"))
    p.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").write.option("sep", "\t").csv(folder)
    schema = text.schema_of(["key", "size", "price"], [T.LongType(), T.IntegerType(), T.DoubleType()])
    back = text.read_headerless(spark, folder, "\t", schema)
    return back.filter(F.col("id") != text.FAULTS_OUTLIER_ROW).select("id", "key", "size", r6("price").alias("price"))


def split_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per label of the training (semi join) and test (anti join) side."""
    e = tables.features_embeddings(spark, sf)
    tr, te = prep.split_frames(e, prep.train_test_split(e, 0.8, SEED))
    side = lambda df, name: df.groupBy("label").agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "label", "n")
    return side(tr, "Train").unionByName(side(te, "Test"))


def systematic_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Every 7th order by key."""
    o = tables.read_table(spark, sf, "orders").select(F.col("o_orderkey").cast("bigint").alias("id"))
    return prep.systematic_sample(o, 7)


def axis_min_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """M16, O2 on the coordinate axes: how many coordinates of E hold over 90 % of the variance, in order."""
    from lodestar.operators import reduce as RD
    st = prep.stats_frame(tables.features_embeddings(spark, sf))
    ev = st.select((F.col("j") + 1).alias("component"), (F.col("sd") * F.col("sd")).alias("eigenvalue"))
    return RD.min_dimension_frame(ev, 0.90).select(F.col("dims").cast("int").alias("dims"))


def pca_power_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Σ λ, Σ λ², Σ λ³ of the principal components of E, which must equal tr C, tr C², tr C³."""
    from lodestar.operators import reduce as RD
    e = tables.features_embeddings(spark, sf)
    lam = RD.pca_fit(e, tables.dims(e)).eigenvalues
    df = spark.createDataFrame([(k, float((lam ** k).sum())) for k in (1, 2, 3)], "power INT, total DOUBLE")
    return df.select("power", r6("total").alias("total"))


def projection_best(spark: SparkSession, sf: str) -> DataFrame:
    """The best of 10 sign projections per dims."""
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    best = RD.best_run(RD.projection_errors(spark, LA.gram(s, tables.dims(s)), [2, 4], 10, SEED, family="sign"))
    return best.select("dims", "run", r6("err").alias("err"))


def projection_error_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and sd of the projection error over runs."""
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    e = RD.projection_errors(spark, LA.gram(s, tables.dims(s)), [2, 4], 10, SEED, family="sign")
    return e.groupBy("dims").agg(F.avg("err").alias("m"), F.stddev_samp("err").alias("s")).select(
        "dims", r6("m").alias("err_mean"), r6("s").alias("err_sd"))


def rca_sign_curve(spark: SparkSession, sf: str) -> DataFrame:
    """X18 with sign projections: running best error per row."""
    c = _X().rca_error_curve(spark, std_e(spark, sf), [2, 4], 10, SEED, family="sign")
    return c.select("iter", r6("err").alias("err"), "dims", "test")


def em_spherical_components(spark: SparkSession, sf: str) -> DataFrame:
    """Component means after 3 iterations of the common-variance mixture."""
    import numpy as np
    from lodestar.operators import linalg as LA
    from lodestar.operators import mixture as MX
    s = std_e(spark, sf)
    m = MX.em(s, [MX.init_from_centers(KM.first_rows(s, 2), "EII", var=1.0)], max_iter=3, tol=0.0, reg=0.0)[0]
    df = LA.matrix_frame(spark, np.asarray(m.means), "mean")
    return df.select(F.col("i").alias("component"), "j", r6("mean").alias("mean"))


def em_spherical_bic(spark: SparkSession, sf: str) -> DataFrame:
    """Best BIC per number of components over n, a failed family skipped."""
    from lodestar.operators import mixture as MX
    s = std_e(spark, sf)
    starts = [MX.init_from_centers(KM.first_rows(s, g), "EII", var=1.0) for g in (2, 3)]
    failed = [MX.init_from_centers(KM.first_rows(s, g), "EEE", var=-1.0) for g in (2, 3)]  # no covariance: null BIC
    models = MX.em(s, starts + failed, max_iter=3, tol=0.0, reg=0.0)
    b = scoring.best_bic(MX.bic_table(spark, models), models[0].n)
    return b.select("numClusters", r6("bic").alias("bic"), "family")


QUERIES.update({f.__name__: f for f in (
    row_reductions, selected_columns, priority_codes, delimited_round_trip, split_label_counts, systematic_sample, axis_min_dimension,
    pca_power_sums, projection_best, projection_error_stats, rca_sign_curve, em_spherical_components, em_spherical_bic)})


# --- identities that SQL can check for fitted models, and the file sources ---------------

def side_file_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Part as a comma table whose column names stand in a side file and as
    space-separated lines; read, split, cut, transposed and summed per column."""
    import uuid

    from pyspark.sql import types as T

    from lodestar.functions.vectors import head
    from lodestar.operators.linalg import transpose_long
    from lodestar.sources import text
    folder = f"{ensure_checkpoint_dir(spark)}/side-{uuid.uuid4()}"
    p = tables.read_table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_retailprice").cast("double").alias("p_retailprice"), "p_type")
    p.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").write.csv(f"{folder}/table")
    spark.createDataFrame([(c,) for c in p.columns], "value STRING").coalesce(1).write.text(f"{folder}/names")
    p.select(F.concat_ws(" ", "p_size", F.col("p_retailprice").cast("string")).alias("value")).write.text(f"{folder}/lines")
    names = text.read_names(spark, f"{folder}/names")
    scan, n = text.materialize(text.read_headerless(spark, f"{folder}/table", ",", text.schema_of(
        names, [T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()])))
    inputs = text.split_inputs_labels(scan, names[:3], names[:1])
    cut = prep.drop_vector_index(inputs, 0).select("id", head("x", 2).alias("x"))
    parts = {"table": cut, "lines": text.read_space_vectors(spark, f"{folder}/lines")}
    out = None
    for name, df in parts.items():
        long = transpose_long(prep.to_long(df).select(F.col("id").alias("i"), "j", "v"))  # column numbers become rows
        sums = long.groupBy("i").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total")).select(F.lit(name).alias("source"), F.col("i").alias("j"), "n", "total")
        out = sums if out is None else out.unionByName(sums)
    return out.withColumn("counted", F.lit(n))


def gmm_total_variance(spark: SparkSession, sf: str) -> DataFrame:
    """M8: what a family's covariances leave within components and its means spread between them add up to
    the data's total variance, whatever the fit."""
    import numpy as np
    s = std_e(spark, sf)
    rows = []
    for m in _X().mixture_grid(s, [3], ["EII", "VII", "EEI", "VVI", "EEE", "VVV"], SEED, iters=10):
        mean = m.weights @ m.means
        within = sum(w * np.trace(m.full(g)) for g, w in enumerate(m.weights))
        rows.append((m.family, float(within + m.weights @ ((m.means - mean) ** 2).sum(axis=1))))
    return spark.createDataFrame(rows, "family STRING, total DOUBLE").select("family", F.round("total", 3).alias("total"))


def ica_source_covariance(spark: SparkSession, sf: str) -> DataFrame:
    """The independent components have unit covariance, whatever rotation FastICA found."""
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    s = std_e(spark, sf)
    z = RD.ica_sources(s, RD.ica_fit(s, tables.dims(s), 4, SEED))
    cov = LA.moments(z, 4).covariance(ddof=0)
    return LA.matrix_frame(spark, cov, "c").select("i", "j", r6("c").alias("c"))


def pca_wide(spark: SparkSession, sf: str) -> DataFrame:
    """M13, M14 without a p x p matrix: the first five components of the standardised embeddings and their squares side by side."""
    from lodestar.operators import reduce as RD
    e = std_e(spark, sf).select("id", F.concat("x", F.transform("x", lambda v: v * v)).alias("x"))
    m = RD.pca_wide(e, 5, SEED)
    df = spark.createDataFrame([(k + 1, float(v), float(v / m.total), m.converged) for k, v in enumerate(m.eigenvalues)],
                               "component INT, eigenvalue DOUBLE, share DOUBLE, converged BOOLEAN")
    return df.select("component", r6("eigenvalue").alias("eigenvalue"), r6("share").alias("share"), "converged")


QUERIES.update({"pca_wide": pca_wide, "side_file_tables": side_file_tables, "gmm_total_variance": gmm_total_variance, "ica_source_covariance": ica_source_covariance})
