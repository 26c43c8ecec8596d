"""Experiment pipelines (X2-X26): reductions, re-clustering, mixtures, nets.

Each function composes operators into one of the reference's result tables.
Grids are parameters.  Every sweep cell shares scans with its siblings where the
operator allows it (multi-model Lloyd, multi-mixture EM, Gram-identity error
curves, one scoring pass for all models).  Frames that several scans read are cached
for the span of the call and released after it.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import map_rows
from lodestar.functions.caching import cached
from lodestar.operators import backprop as BP
from lodestar.operators import cftree as CF
from lodestar.operators import kmeans as KM
from lodestar.operators import kmeans_sweep as KS
from lodestar.operators import linalg as LA
from lodestar.operators import mixture as MX
from lodestar.operators import prep, scoring
from lodestar.operators import reduce as RD
from lodestar.operators import select as SEL
from lodestar.operators import silhouette as SH
from lodestar.operators import supervised_cuts as CUT
from lodestar.sources import tables


# --- PCA (X12-X14, M13-M18) -----------------------------------------------------

def pca_scores(df: DataFrame, d: int = 2) -> DataFrame:
    """(id, label, j, v): first d principal-component scores with the class."""
    p = tables.dims(df)
    model = RD.pca_fit(df, p)
    z = RD.pca_transform(df, model, d, out="z")
    return z.select("id", "label", F.posexplode("z").alias("j", "v")).withColumn(
        "j", F.col("j").cast("int"))


def pca_explained(spark: SparkSession, df: DataFrame) -> DataFrame:
    model = RD.pca_fit(df, tables.dims(df))
    return spark.createDataFrame(RD.explained(model),
                                 "component INT, eigenvalue DOUBLE, share DOUBLE, cum_share DOUBLE")


def pca_recon_error(spark: SparkSession, df: DataFrame, test: str) -> DataFrame:
    """(dims, err = per-row error, test) for d = 1..p (X13, M17 via the Gram identity)."""
    p = tables.dims(df)
    model = RD.pca_fit(df, p)
    mo = LA.moments(df, p, shift=model.mean)
    S = mo.g  # centred Gram
    rows = [(d, e / mo.n, test) for d, e in RD.recon_errors(S, model.rotation, range(1, p + 1))]
    return spark.createDataFrame(rows, "dims INT, err DOUBLE, test STRING")


def pca_contributions(spark: SparkSession, df: DataFrame) -> DataFrame:
    model = RD.pca_fit(df, tables.dims(df))
    m_long = LA.matrix_frame(spark, model.rotation, "v")
    return RD.contributions_frame(m_long)


# --- ICA (X15, X16) ----------------------------------------------------------------

def ica_sources(df: DataFrame, d: int, seed: int) -> DataFrame:
    model = RD.ica_fit(df, tables.dims(df), d, seed)
    z = RD.ica_sources(df, model, out="z")
    return z.select("id", "label", F.posexplode("z").alias("j", "v"), F.lit(model.converged).alias("ica_converged")).withColumn(
        "j", F.col("j").cast("int"))


def ica_recon_error(spark: SparkSession, df: DataFrame, dims, seed: int, test: str) -> DataFrame:
    p = tables.dims(df)
    st = prep.column_stats(df, "x", p)
    mo = LA.moments(df, p, shift=np.nan_to_num(st.mean))
    rows = [(int(d), RD.ica_recon_error(mo.g, model) / mo.n, test)
            for d, model in zip(dims, RD.ica_fit_many(df, p, dims, seed, max_iter=50))]  # the error follows from the whitening alone
    return spark.createDataFrame(rows, "dims INT, err DOUBLE, test STRING")


# --- random projections (X17-X19) ---------------------------------------------------

def rca_error_curve(spark: SparkSession, df: DataFrame, dims, runs: int, seed: int,
                    family: str = "haar", test: str = "E") -> DataFrame:
    """(iter, err = running best / n, dims, test)."""
    p = tables.dims(df)
    mo = LA.moments(df, p)
    errs = RD.projection_errors(spark, mo.g, dims, runs, seed, family=family)
    best = RD.running_best(errs)
    return best.select((F.col("run") + 1).cast("int").alias("iter"),
                       (F.col("best_err") / F.lit(float(mo.n))).alias("err"),
                       "dims", F.lit(test).alias("test"))


def rca_best_projection(spark: SparkSession, df: DataFrame, d: int, runs: int, seed: int,
                        family: str = "haar") -> tuple[np.ndarray, DataFrame]:
    """Winner of ``runs`` projections, regenerated from its (seed, run)."""
    p = tables.dims(df)
    mo = LA.moments(df, p)
    errs = RD.projection_errors(spark, mo.g, [d], runs, seed, family=family)
    win = RD.best_run(errs).collect()[0]
    gen = RD.haar_matrix if family == "haar" else RD.sign_matrix
    R = gen(p, d, seed, int(win["run"]))
    return R, LA.project(df, R, passthrough=("id", "label"))


# --- reductions feeding re-clustering (X6, X8-X10) --------------------------------

def cfs_subset(df: DataFrame, p: int) -> list[int]:
    """The features that correlation-based selection keeps (M25), on supervised cuts; a feature without a cut says
    nothing about the class."""
    df = df.select("x", "label")  # the nets' rows hold a level index already
    lv = prep.levels(df)
    cuts = CUT.entropy_cuts(prep.with_label_ix(df, lv), lv.count())
    with cached(CUT.discretize_by(df, cuts, keep=("label",))) as binned:
        su_c = np.zeros(p)
        for r in SEL.su_feature_class(binned).collect():
            su_c[r["j"]] = r["su"]
        return SEL.best_first(su_c, SEL.su_feature_pairs(binned, p, 1 + max(map(len, cuts), default=0)))


def reductions(spark: SparkSession, df: DataFrame, d: int, seed: int, runs: int = 20, ica_iters: int = 200) -> dict[str, tuple[DataFrame, int, bool | None]]:
    """{algo: (Features(id, x, label), width, settled)}: the input itself, its first d principal and
    independent components, its best of ``runs`` random projections to d, its CFS features.
    ``settled`` tells whether FastICA converged; the others have no fit to stop: null."""
    from lodestar.functions.vectors import select_idx
    p = tables.dims(df)
    R, rca = rca_best_projection(spark, df, d, runs, seed)
    keep = cfs_subset(df, p) or [0]
    ica = RD.ica_fit(df, p, d, seed, max_iter=ica_iters)
    return {
        "N/A": (df, p, None),
        "PCA": (RD.pca_transform(df, RD.pca_fit(df, p), d), d, None),
        "ICA": (RD.ica_sources(df, ica), d, ica.converged),
        "RCA": (rca, d, None),
        "CFS": (df.select("id", select_idx("x", keep).alias("x"), "label"), len(keep), None),
    }


def label_errors(df: DataFrame, models: dict) -> dict[int, float]:
    """{key: label error} of every model of {key: centres}, from one scan."""
    long = KM.assign_many(df, models, passthrough=("label",))
    counts = long.groupBy("model", "cluster", "label").agg(F.count("*").alias("n"))
    best = counts.groupBy("model", "cluster").agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    rows = best.groupBy("model").agg((1 - F.sum("top") / F.sum("n")).alias("err")).collect()  # one row per model
    return {int(r["model"]): float(r["err"]) for r in rows}


def reduced_kmeans_error(spark: SparkSession, df: DataFrame, d: int, ks, seed: int,
                         runs: int = 50, iters: int = 100) -> DataFrame:
    """(k, err, dims, algo, ica_converged): label error of k-means on each reduction."""
    lv = prep.levels(df)
    parts, p = [], tables.dims(df)
    for algo, (red, width, settled) in reductions(spark, df, d, seed).items():
        with cached(red) as red:
            best = KM.kmeans_grid(red, ks, seed, runs=runs, max_iter=iters)
            for k, e in sorted(label_errors(red, {k: m.centers for k, m in best.items()}).items()):
                # The unreduced result is a reference line spanning dims 1 .. p
                parts += [(k, e, at, algo, settled) for at in ((1, p) if algo == "N/A" else (width,))]
    return spark.createDataFrame(parts, "k INT, err DOUBLE, dims INT, algo STRING, ica_converged BOOLEAN")


def reduced_sse_curve(spark: SparkSession, df: DataFrame, d: int, ks, seed: int,
                      runs: int = 50, iters: int = 100) -> DataFrame:
    """(k, within_ss_mean, algo, ica_converged) per reduction (X8 SSE curves)."""
    out = []
    for algo, (red, _, settled) in reductions(spark, df, d, seed).items():
        with cached(red) as red:
            best = KM.kmeans_grid(red, ks, seed, runs=runs, max_iter=iters)
            out += [(int(k), float(m.cost / m.sizes.sum()), algo, settled) for k, m in sorted(best.items())]
    return spark.createDataFrame(out, "k INT, within_ss_mean DOUBLE, algo STRING, ica_converged BOOLEAN")


def reduced_em_bic(spark: SparkSession, df: DataFrame, d: int, Gs, families, seed: int,
                   iters: int = 100) -> DataFrame:
    """(algo, numClusters, family, bic, converged, ica_converged): mixtures on the input and on every
    reduction (X8 EM half, X11)."""
    rows = []
    for algo, (red, _, settled) in reductions(spark, df, d, seed).items():
        with cached(red) as red:
            rows += [(algo, m.G, m.family, m.bic(), m.converged, settled) for m in mixture_grid(red, Gs, families, seed, iters)]
    return spark.createDataFrame(rows, "algo STRING, numClusters INT, family STRING, bic DOUBLE, converged BOOLEAN, ica_converged BOOLEAN")


def reduced_error_table(spark: SparkSession, df: DataFrame, d: int, k: int, G: int, family: str, seed: int,
                        runs: int = 10, iters: int = 100) -> DataFrame:
    """(reduction, em, kmeans, converged, ica_converged): label error of a fitted mixture and of k-means on the input
    and every reduction (X9)."""
    lv = prep.levels(df)
    c, rows = lv.count(), []
    for algo, (red, _, settled) in reductions(spark, df, d, seed).items():
        with cached(red) as red:
            m = KM.kmeans(red, k, seed, runs=runs, max_iter=iters)
            km = scoring.confusion_error(scoring.cluster_confusion(KM.assign(red, m.centers), lv, c)).first()["err"]
            mix = mixture_grid(red, [G], [family], seed, iters)[0]
            em = None if mix.failed else scoring.confusion_error(scoring.soft_label_confusion(MX.posterior(red, mix), lv, G, c)).first()["err"]
            rows.append((algo, em, km, mix.converged, settled))
    return spark.createDataFrame(rows, "reduction STRING, em DOUBLE, kmeans DOUBLE, converged BOOLEAN, ica_converged BOOLEAN")


def reduced_spectrum(spark: SparkSession, df: DataFrame, d: int, k: int, seed: int, runs: int = 10, iters: int = 100) -> DataFrame:
    """(algo, idx, cluster, size, share, ica_converged): cluster sizes of k-means on the input and every reduction."""
    out, ica = None, None
    for algo, (red, _, settled) in reductions(spark, df, d, seed).items():
        with cached(red) as red:
            m = KM.kmeans(red, k, seed, runs=runs, max_iter=iters)
        ica = settled if algo == "ICA" else ica
        part = KM.assign(red, m.centers).select(F.lit(algo).alias("algo"), "cluster")
        out = part if out is None else out.unionByName(part)
    return scoring.cluster_spectrum(out, algo="algo").withColumn("ica_converged", F.when(F.col("algo") == "ICA", F.lit(ica)))


# --- k-means sweeps (X2-X4) ------------------------------------------------------------

def kmeans_clusters(spark: SparkSession, df: DataFrame, ks, seed: int, runs: int, iters: int,
                    test: str) -> DataFrame:
    """(k, avg_s, within_ss, label_err, test, converged) (X2); all k share one distance pass and one scoring pass."""
    best = KS.sweep(df, ks, seed, runs=runs, max_iter=iters)
    centres = {k: m.centers for k, m in best.items()}
    err = label_errors(df, centres)
    with cached(KM.assign_many(df, centres, passthrough=("id", "x"))) as a:
        width = {r["model"]: r["w"] for r in SH.silhouette_many(a).groupBy("model").agg(F.avg("s").alias("w")).collect()}
    rows = [(int(k), float(width[k]), float(m.cost / m.sizes.sum()), err[k], test, m.converged) for k, m in sorted(best.items())]
    return spark.createDataFrame(rows, "k INT, avg_s DOUBLE, within_ss DOUBLE, label_err DOUBLE, test STRING, converged BOOLEAN")


def kmeans_sweep(spark: SparkSession, df: DataFrame, ks, seed: int, runs: int = 50) -> DataFrame:
    """(k, lloyd, cost, label_err, converged): the reference's sweep at its number of starts; total within-SS of the
    best start before and after exchange steps on it (X2, M2)."""
    ks = list(ks)
    with cached(df) as df:
        plain = KS.sweep(df, ks, seed, runs=runs)
        best = KS.exchange(df, [plain[k] for k in ks])
        err = label_errors(df, {k: m.centers for k, m in zip(ks, best)})
    rows = [(int(k), float(plain[k].cost), float(m.cost), err[k], m.converged) for k, m in zip(ks, best)]
    return spark.createDataFrame(rows, "k INT, lloyd DOUBLE, cost DOUBLE, label_err DOUBLE, converged BOOLEAN")


def kmeans_silhouettes(df: DataFrame, k: int, seed: int, runs: int, iters: int) -> DataFrame:
    """Per-row silhouette of a fitted k-means (X3, M2 + M7)."""
    m = KS.sweep(df, [k], seed, runs=runs, max_iter=iters)[k]
    return SH.silhouette_exact(KM.assign(df, m.centers, passthrough=("id", "x", "label"))).withColumn("converged", F.lit(m.converged))


# --- mixtures (X7, X11, M10) --------------------------------------------------------------

def mixture_grid(df: DataFrame, Gs, families, seed: int, iters: int = 100, start: str = "tree") -> list[MX.Mixture]:
    """All (G, family) mixtures fitted together, from the merged leaves of one clustering-feature tree
    or (``start="kmeans"``) from a k-means per G."""
    p, Gs = tables.dims(df), list(Gs)
    with cached(df) as df:
        st = prep.column_stats(df, "x", p)
        var = float(np.nanmean(st.sd ** 2))
        if start == "tree":
            own = CF.tree_starts(df, Gs)
        else:
            own = {G: (m.sizes / m.sizes.sum(), m.centers) for G, m in KM.kmeans_grid(df, Gs, seed, runs=1, max_iter=100).items()}
        starts = []
        for G in Gs:
            for fam in families:
                starts.append(MX.init_from_centers(own[G][1], fam, var))
                starts[-1].weights = np.maximum(own[G][0], 1e-12)
        return MX.em(df, starts, max_iter=iters, tol=1e-6)


# --- nets (X20-X24) ---------------------------------------------------------------------

RCA_RUNS = 20  # random projections of which the best feeds a net


@contextmanager
def net_split(df: DataFrame, lv: DataFrame, seed: int, f: float = 0.8):
    """The labelled rows with ``label_ix`` and ``fold`` (0 train, 1 test), cached while the block runs:
    reductions and every training step read them."""
    labelled = prep.with_label_ix(df, lv)
    train, test = prep.split_frames(labelled, prep.train_test_split(labelled, f, seed))
    with cached(train.withColumn("fold", F.lit(0)).unionByName(test.withColumn("fold", F.lit(1)))) as rows:
        yield rows


def _fitted_on(rows: DataFrame, fit_on: str) -> DataFrame:
    if fit_on not in ("all", "train"):
        raise ValueError(f"reductions are fitted on 'all' or 'train' rows, not on {fit_on!r}")
    return rows.where("fold = 0") if fit_on == "train" else rows


def _widened(rows: DataFrame, maps: list[tuple]) -> DataFrame:
    """x followed by x @ M - shift of every (M, shift), in one pass."""
    M = np.concatenate([m for m, _ in maps], axis=1)
    shift = np.concatenate([s for _, s in maps])
    keep = ["id", "label_ix", "fold"]
    schema = ", ".join([f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep] + ["x ARRAY<DOUBLE>"])
    return map_rows(rows, ["x"], lambda b: {"x": np.concatenate((b["x"], b["x"] @ M - shift), axis=1)}, schema, passthrough=keep)


def reduced_net_inputs(spark: SparkSession, rows: DataFrame, dims, seed: int, algos=("PCA", "ICA", "RCA", "CFS"), fit_on: str = "all"):
    """(frame, cells): the inputs and all their reductions side by side in one vector, and one cell
    (algo, width, entries of the vector, FastICA converged) per reduction; 'N/A' is the input itself.
    ``fit_on="train"`` fits every reduction on the training rows alone (D12)."""
    p, source = tables.dims(rows), _fitted_on(rows, fit_on)
    cells, maps, at = [("N/A", p, tuple(range(p)), None)], [], p

    def add(algo, M, mean, settled=None):
        nonlocal at
        maps.append((M, np.zeros(M.shape[1]) if mean is None else mean @ M))
        cells.append((algo, M.shape[1], tuple(range(at, at + M.shape[1])), settled))
        at += M.shape[1]

    if "PCA" in algos:
        pca = RD.pca_fit(source, p)
        for d in dims:
            add("PCA", pca.rotation[:, :d], pca.mean)
    if "ICA" in algos:
        for model in RD.ica_fit_many(source, p, dims, seed):
            add("ICA", model.unmixing, model.mean, model.converged)
    if "RCA" in algos:
        wins = RD.best_run(RD.projection_errors(spark, LA.moments(source, p).g, dims, RCA_RUNS, seed, family="haar")).collect()
        for d, run in sorted((w["dims"], w["run"]) for w in wins):
            add("RCA", RD.haar_matrix(p, d, seed, run), None)
    if "CFS" in algos:
        keep = cfs_subset(source, p) or [0]
        cells.append(("CFS", len(keep), tuple(keep), None))
    return _widened(rows, maps) if maps else rows, cells


def _trained(frame: DataFrame, cells, seeds, classes: int, steps: int) -> list[BP.Fit]:
    """All cells and seeds trained together; a net's tag is its cell's place."""
    nets = [BP.Net((k,), int(s), cell[2]) for k, cell in enumerate(cells) for s in seeds]
    return BP.train(frame, nets, classes, steps)


def _mean_sd(raw: DataFrame, *keys: str, value: str = "err", mean: str = "error", sd: str = "error_sd") -> DataFrame:
    return raw.groupBy(*keys).agg(F.avg(value).alias(mean), F.stddev_samp(value).alias(sd))


def net_learning_curve(spark: SparkSession, df: DataFrame, seed: int, iters: int = 100) -> DataFrame:
    """(idx, error, stage): the reference net on the raw inputs; ``error`` is the squared error."""
    lv = prep.levels(df)
    with net_split(df, lv, seed) as rows:
        fits = _trained(rows, [("N/A", 0, tuple(range(tables.dims(rows))), None)], [seed], lv.count(), iters)
    return spark.createDataFrame([(idx, sse, stage) for _, _, idx, stage, sse in BP.stacked(fits)], "idx INT, error DOUBLE, stage STRING")


def net_error_by_dims(spark: SparkSession, df: DataFrame, dims, seeds, seed: int, max_iter: int = 15, fit_on: str = "all") -> DataFrame:
    """(dims, algo, error, error_sd, stage, ica_converged) over repeated fits, on the input and on every
    reduction (X22, M29, A17)."""
    lv = prep.levels(df)
    with net_split(df, lv, seed) as rows:
        frame, cells = reduced_net_inputs(spark, rows, dims, seed, fit_on=fit_on)
        errs = BP.final_errors(_trained(frame, cells, seeds, lv.count(), max_iter))
    table = [(cells[k][1], cells[k][0], run, stage, err, cells[k][3]) for k, run, stage, err in errs]
    raw = spark.createDataFrame(table, "dims INT, algo STRING, run INT, stage STRING, err DOUBLE, ica_converged BOOLEAN")
    return _mean_sd(raw, "dims", "algo", "stage", "ica_converged")


def net_learning_by_dims(spark: SparkSession, df: DataFrame, dims, seed: int, iters: int = 100, fit_on: str = "all") -> DataFrame:
    """(idx, error, stage, dims): squared-error curves on the first d principal
    components and on the raw inputs ('N/A') (X21, M13 + M27 + M28)."""
    lv = prep.levels(df)
    with net_split(df, lv, seed) as rows:
        frame, cells = reduced_net_inputs(spark, rows, dims, seed, algos=("PCA",), fit_on=fit_on)
        curves = BP.stacked(_trained(frame, cells, [seed], lv.count(), iters))
    name = lambda k: "N/A" if cells[k][0] == "N/A" else str(cells[k][1])
    return spark.createDataFrame([(idx, sse, stage, name(k)) for k, _, idx, stage, sse in curves], "idx INT, error DOUBLE, stage STRING, dims STRING")


def cluster_net_inputs(spark: SparkSession, rows: DataFrame, k: int, seed: int, family: str = "VVI", runs: int = 4, iters: int = 100, fit_on: str = "all"):
    """(frame, cells): the raw inputs, one-hot k-means clusters and posteriors of a fitted mixture side by side
    in one vector, and one cell (algo, inputs, entries of the vector, mixture converged) per input set (X23, X24);
    the last is null where no mixture is behind it."""
    p, source = tables.dims(rows), _fitted_on(rows, fit_on)
    centres = KM.kmeans(source, k, seed, runs=runs, max_iter=100).centers
    mix = mixture_grid(source, [k], [family], seed, iters)[0]
    if mix.failed:
        raise ValueError(f"the mixture of {k} components broke down; its posteriors cannot feed a net")
    keep = ["id", "label_ix", "fold"]

    dens = MX.Densities(mix)

    def fn(b):
        near, _ = KM.nearest(b["x"], centres)
        return {"x": np.concatenate((b["x"], np.eye(k)[near], MX.responsibilities(b["x"], mix, dens)[0]), axis=1)}

    schema = ", ".join([f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep] + ["x ARRAY<DOUBLE>"])
    raw, hot, soft = (tuple(range(a, b)) for a, b in ((0, p), (p, p + k), (p + k, p + 2 * k)))
    cells = [("kmeans", "Clusters", hot, None), ("kmeans", "Both", hot + raw, None), ("em", "Clusters", soft, mix.converged),
             ("em", "Both", soft + raw, mix.converged), ("raw", "N/A", raw, None)]
    return map_rows(rows, ["x"], fn, schema, passthrough=keep), cells


def net_on_clusters(spark: SparkSession, df: DataFrame, k: int, seeds, seed: int, max_iter: int = 15, fit_on: str = "all") -> DataFrame:
    """(inputs, type, stage, error, error_sd, converged): repeated nets on each of :func:`cluster_net_inputs`."""
    lv = prep.levels(df)
    with net_split(df, lv, seed) as rows:
        frame, cells = cluster_net_inputs(spark, rows, k, seed, fit_on=fit_on)
        errs = BP.final_errors(_trained(frame, cells, seeds, lv.count(), max_iter))
    table = [(cells[j][1], cells[j][0], stage, run, err, cells[j][3]) for j, run, stage, err in errs]
    raw = spark.createDataFrame(table, "inputs STRING, type STRING, stage STRING, run INT, err DOUBLE, converged BOOLEAN")
    return _mean_sd(raw, "inputs", "type", "stage", "converged")


def net_cluster_learning_curve(spark: SparkSession, df: DataFrame, k: int, seeds, seed: int, iters: int = 200, fit_on: str = "all") -> DataFrame:
    """(idx, stage, algo, inputs, err_mean, err_sd, converged): squared-error curves on each of
    :func:`cluster_net_inputs`, mean / sd over runs (X23, A4)."""
    lv = prep.levels(df)
    with net_split(df, lv, seed) as rows:
        frame, cells = cluster_net_inputs(spark, rows, k, seed, fit_on=fit_on)
        curves = BP.stacked(_trained(frame, cells, seeds, lv.count(), iters))
    table = [(idx, stage, cells[j][0], cells[j][1], run, sse, cells[j][3]) for j, run, idx, stage, sse in curves]
    raw = spark.createDataFrame(table, "idx INT, stage STRING, algo STRING, inputs STRING, run INT, err DOUBLE, converged BOOLEAN")
    return _mean_sd(raw, "idx", "stage", "algo", "inputs", "converged", mean="err_mean", sd="err_sd")


# --- Scala main (X25): PCA dims x MLlib k-means, cost and label spread ----------------

def scala_sweep(spark: SparkSession, df: DataFrame, dims, ks, seed: int) -> DataFrame:
    """(dims, k, cost, cluster, n, label_var): dims 0 means no reduction."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    p = tables.dims(df)
    rows = []
    with cached(df.withColumn("v", array_to_vector("x"))) as vec:
        full = PCA(k=p, inputCol="v", outputCol="pc").fit(vec)  # fit once, slice per dims
        for d in dims:
            data = vec if d == 0 else full.transform(vec).withColumn("x", F.slice(vector_to_array("pc"), 1, d))
            with cached(data.select("id", "x", "label")) as data:
                fits = {k: KM.mllib_kmeans(data, k, seed) for k in ks}
                centres = {k: np.array(model.clusterCenters()) for k, (model, _) in fits.items()}
                long = KM.assign_many(data, centres, passthrough=("label",))
                m = long.groupBy("model", "cluster", "label").agg(F.count("*").alias("m"))
                n = F.sum("m").over(Window.partitionBy("model", "cluster"))  # counts only
                term = F.when(F.col("n") > 1, F.col("m") * (F.col("n") - F.col("m")) / (F.col("n") * (F.col("n") - 1))).otherwise(0.0)
                var = m.withColumn("n", n).groupBy("model", "cluster").agg(F.first("n").alias("n"), F.sum(term).alias("v"))
                rows += [(int(d), int(r["model"]), float(fits[r["model"]][1]), int(r["cluster"]), int(r["n"]), float(r["v"]))
                         for r in var.collect()]  # one row per cluster
    return spark.createDataFrame(rows, "dims INT, k INT, cost DOUBLE, cluster INT, n BIGINT, label_var DOUBLE")
