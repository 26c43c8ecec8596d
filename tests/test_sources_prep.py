import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from core_helpers import SF0001, SF001, collect_matrix, features_from
from lodestar.functions.ranking import exact_group_rank, exact_rank, ntile_expr
from lodestar.operators import prep
from lodestar.sources import text, tables


def write_faults(folder, rows=1941, seed=1):
    """Files shaped like the steel-plates data: 27 inputs and 7 exclusive labels, tab-separated,
    names in a side file with CR/LF line ends."""
    rng = np.random.default_rng(seed)
    names = [f"In_{k}" for k in range(27)] + text.FAULT_LABELS
    (folder / "names").write_bytes("\r\n".join(names).encode() + b"\r\n")
    lab = rng.integers(0, 7, rows)
    ints, dbls = rng.integers(0, 1000, (rows, 14)), rng.random((rows, 13))
    lines = ["\t".join([*map(str, ints[k]), *(f"{v:.6f}" for v in dbls[k]), *("1" if j == lab[k] else "0" for j in range(7))]) for k in range(rows)]
    (folder / "data.tsv").write_text("\n".join(lines) + "\n")
    return str(folder / "data.tsv"), str(folder / "names"), ints, lab


def test_faults_reader(spark, tmp_path):
    data, names, ints, lab = write_faults(tmp_path)
    df = text.read_faults(spark, data, names)
    assert len(df.columns) == 35  # id + 34 named
    assert df.count() == 1940 and df.filter("id = 392").count() == 0
    rows = {r["id"]: r["In_3"] for r in df.select("id", "In_3").collect()}
    assert all(rows[k] == ints[k - 1, 3] for k in rows)
    sums = df.agg(*[F.sum(c).alias(c) for c in text.FAULT_LABELS]).collect()[0].asDict()
    assert sums == {c: int(sum(lab[i] == k for i in range(1941) if i != 391)) for k, c in enumerate(text.FAULT_LABELS)}
    f = text.faults_features(df)
    assert f.filter(F.size("x") != 27).count() == 0
    got = {r["id"]: r["label"] for r in f.select("id", "label").collect()}
    assert all(got[k] == text.FAULT_LABELS[lab[k - 1]] for k in got)


def test_line_numbers_follow_files_and_splits(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("a0\na1\n")
    (folder / "b.csv").write_text("".join(f"b{k}\n" for k in range(2000)))
    (folder / "c.csv").write_text("c0\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")  # b.csv becomes several splits
    try:
        df = text.read_headerless(spark, str(folder), ",", text.schema_of(["v"], [text.T.StringType()]))
        got = [r["v"] for r in df.orderBy("id").collect()]
        ids = sorted(r["id"] for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == ["a0", "a1"] + [f"b{k}" for k in range(2000)] + ["c0"] and ids == list(range(1, 2004))


def test_headerless_csv_and_ids(spark, tmp_path):
    path = tmp_path / "letters.data"
    rows = ["A,1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,0", "B,0,0,0,0,0,0,0,0,0,0,0,0,0,0,0,1",
            "A,15,15,15,15,15,15,15,15,15,15,15,15,15,15,15,15"]
    path.write_text("\n".join(rows) + "\n")
    df = text.read_letters(spark, str(path))
    got = df.orderBy("id").collect()
    assert [r["id"] for r in got] == [1, 2, 3]
    assert [r["Letter"] for r in got] == ["A", "B", "A"]
    f = text.letters_features(df)
    assert f.filter(F.size("x") != 16).count() == 0


def test_space_vectors(spark, tmp_path):
    path = tmp_path / "blobs.txt"
    path.write_text("".join(f"{v} {v} {v}\n" for v in ("0.0", "0.1", "0.2", "9.0", "9.1", "9.2")))
    df = text.read_space_vectors(spark, str(path))
    ids, X = collect_matrix(df)
    assert X.shape == (6, 3)
    assert list(ids) == [1, 2, 3, 4, 5, 6]


def test_null_label_is_a_level(spark):
    from lodestar.operators import scoring
    df = features_from(spark, np.zeros((4, 1)), labels=["a", None, "b", None])
    lv = prep.levels(df)
    assert [r["label"] for r in lv.orderBy("label_ix").collect()] == ["a", "b", None]
    assert prep.with_label_ix(df, lv).count() == 4
    a = df.withColumn("cluster", F.lit(0))
    t = scoring.cluster_predict_err(a, lv).collect()[0]
    assert t["size"] == 4 and t["argmax"] is None and np.isclose(t["err_rate"], 0.5)
    conf = scoring.cluster_confusion(a, lv, 3)
    assert conf.agg(F.sum("n")).first()[0] == 4 and np.isclose(scoring.confusion_error(conf).first()["err"], 0.5)


@pytest.mark.parametrize("vectors", [[[1.0], [2.0, 3.0, 4.0]], [[1.0, 2.0], None, None, [3.0, 4.0]], [[1.0, None], [2.0, 3.0]]])
def test_null_and_ragged_vectors_are_refused(spark, vectors):
    from lodestar.operators import kmeans as KM
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "id BIGINT, x ARRAY<DOUBLE>, label INT").coalesce(1)
    with pytest.raises(Exception, match="numeric kernel"):
        KM.assign(df, np.zeros((2, 2))).collect()


def test_orders_without_lines_are_kept(spark):
    o = tables.read_table(spark, SF001, "orders")
    f = tables.features_orders(spark, SF001)
    assert f.count() == o.count()
    li = tables.read_table(spark, SF001, "lineitem").select("l_orderkey").distinct()
    bare = {r["o_orderkey"] for r in o.join(li, o.o_orderkey == li.l_orderkey, "left_anti").collect()}
    zero = {r["id"] for r in f.filter(F.col("x")[4] == 0).collect()}
    assert bare == zero and bare


def test_split_is_exact_on_repeated_ids(spark):
    for ids in ([1] * 20, [k // 4 for k in range(20)], [None] * 3 + list(range(17))):
        df = spark.createDataFrame([(i,) for i in ids], "id BIGINT").repartition(3)
        got = prep.train_test_split(df, 0.35, 5)
        assert got.count() == 20 and got.filter("is_train").count() == 7


def test_number_at(spark):
    df = spark.createDataFrame([("1-URGENT",), ("km50",), (None,)], "s STRING")
    assert [r[0] for r in df.select(text.number_at("s", 1, 1)).collect()] == [1, None, None]
    assert [r[0] for r in df.select(text.number_at("s", 3, 2)).collect()] == [None, 50, None]


def test_standardize_moments_and_constant_column(spark):
    X = np.array([[1.0, 5.0, 2.0], [2.0, 5.0, 4.0], [3.0, 5.0, 9.0], [4.0, 5.0, 1.0]])
    df = features_from(spark, X)
    out = prep.standardize(df)
    _, Z = collect_matrix(out)
    assert np.allclose(Z[:, 0].mean(), 0) and np.isclose(Z[:, 0].std(ddof=1), 1)
    assert np.allclose(Z[:, 1], 0.0)  # constant column → 0.0 (documented choice)
    assert np.allclose(Z[:, 2], (X[:, 2] - X[:, 2].mean()) / X[:, 2].std(ddof=1))


def test_split_exact_disjoint_and_layout_independent(spark):
    e = tables.features_embeddings(spark, SF0001)
    a = prep.train_test_split(e, 0.8, 42)
    b = prep.train_test_split(e.repartition(7), 0.8, 42)
    n = e.count()
    ra = {r["id"]: r["is_train"] for r in a.collect()}
    rb = {r["id"]: r["is_train"] for r in b.collect()}
    assert ra == rb
    assert sum(ra.values()) == int(np.floor(0.8 * n))
    tr, te = prep.split_frames(e, a)
    assert tr.count() + te.count() == n
    assert tr.join(te, "id").count() == 0
    # test share 0: everything trains
    assert prep.train_test_split(e, 1.0, 1).filter("is_train").count() == n


def test_exact_rank_matches_window(spark):
    e = tables.features_embeddings(spark, SF0001)
    long = prep.to_long(e, d=3)
    ranked = exact_group_rank(long, ["j"], [F.col("v"), F.col("id")], name="r", size_name="gn")
    mine = ranked.select("id", "j", ntile_expr("r", "gn", 5).alias("b")).toPandas()
    con = duckdb.connect()
    ref = con.execute(f"""
        WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM '{SF0001}/embeddings.parquet'),
        el AS (SELECT id, CAST(UNNEST(range(len(x))) AS INTEGER) AS j, UNNEST(x) AS v FROM e)
        SELECT id, j, ntile(5) OVER (PARTITION BY j ORDER BY v, id) AS b FROM el WHERE j < 3""").df()
    m = mine.merge(ref, on=["id", "j"], suffixes=("_s", "_d"))
    assert len(m) == len(ref) and (m.b_s == m.b_d).all()
    g = exact_rank(e.select("id"), [F.col("id").desc()], name="r").orderBy("r").collect()
    assert [r["id"] for r in g][:3] == sorted([r["id"] for r in g], reverse=True)[:3]


def test_one_hot_round_trip_and_levels(spark):
    df = features_from(spark, np.zeros((5, 1)), labels=["b", "a", "c", "a", "b"])
    lv = prep.levels(df)
    assert [r["label"] for r in lv.orderBy("label_ix").collect()] == ["a", "b", "c"]
    oh = prep.one_hot(prep.with_label_ix(df, lv), 3)
    dec = prep.one_hot_decode(oh, "y", "dec")
    assert dec.filter(F.col("dec") != F.col("label_ix")).count() == 0
    long = prep.one_hot_long(prep.with_label_ix(df, lv), 3)
    assert long.count() == 15 and long.agg(F.sum("flag")).collect()[0][0] == 5


def test_argmax_first_wins(spark):
    df = spark.createDataFrame([(1, [0.2, 0.5, 0.5]), (2, [1.0, 1.0, 0.0])], "id INT, v ARRAY<DOUBLE>")
    got = {r["id"]: r["label_ix"] for r in prep.argmax_decode(df, "v").collect()}
    assert got == {1: 1, 2: 0}


def test_systematic_sample(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "id")
    got = [r["id"] for r in prep.systematic_sample(df, 30).orderBy("id").collect()]
    assert got == [1, 31, 61, 91]


def test_orders_binding_unique_ids(spark):
    o = tables.features_orders(spark, SF001)
    assert o.count() == o.select("id").distinct().count()


def test_split_multilevel_prefix_path(spark):
    import hashlib
    df = spark.range(0, 5000).withColumnRenamed("id", "id")
    got = {r["id"]: r["is_train"] for r in prep.train_test_split(df, 0.37, 9).collect()}
    order = sorted(range(5000), key=lambda i: (hashlib.md5(f"9:{i}".encode()).hexdigest(), i))
    want = {i: (k < int(0.37 * 5000)) for k, i in enumerate(order)}
    assert got == want


def test_sinks_round_trip_and_materialize(spark, tmp_path):
    from lodestar.operators import kmeans as KM
    from lodestar.sources import sinks
    df = features_from(spark, np.arange(12.0).reshape(6, 2), labels=[0, 1, 0, 1, 0, 1])
    cached, n = text.materialize(df)
    assert n == 6
    run = str(tmp_path / "run")
    paths = sinks.write_results({"features": cached, "sizes": cached.groupBy("label").count()}, run)
    assert set(paths) == {"features", "sizes"}
    back = sinks.read_result(spark, run, "features")
    assert sorted(map(tuple, collect_matrix(back)[1])) == sorted(map(tuple, collect_matrix(df)[1]))
    sinks.write_result(cached, run, "features")          # overwrite is idempotent
    assert sinks.read_result(spark, run, "features").count() == 6
    model, _ = KM.mllib_kmeans(cached, 2, seed=1, max_iter=5)
    from pyspark.ml.clustering import KMeansModel
    loaded = KMeansModel.load(sinks.write_model(model, run, "km"))
    assert np.allclose(sorted(map(tuple, loaded.clusterCenters())), sorted(map(tuple, model.clusterCenters())))


def test_drop_vector_index_transpose_and_pinv(spark):
    from lodestar.operators import linalg as LA
    from lodestar.operators import reduce as RD
    df = features_from(spark, np.arange(12.0).reshape(4, 3))
    _, X = collect_matrix(prep.drop_vector_index(df, 1))
    assert np.allclose(X, np.arange(12.0).reshape(4, 3)[:, [0, 2]])
    m = np.array([[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]])
    t = LA.transpose_long(LA.matrix_frame(spark, m)).collect()
    assert {(r["i"], r["j"]): r["v"] for r in t} == {(j, i): m[i, j] for i in range(2) for j in range(3)}
    q = RD.haar_matrix(5, 2, 1, 0)
    assert np.allclose(RD.pinv(q) @ q, np.eye(2))
