import pytest

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Small documents frame from (doc_id, text) pairs, with the columns of ``documents``."""
    def make(pairs):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make


@pytest.fixture
def tables(tmp_path):
    """Writes frames as ``<name>.parquet`` and returns the folder that queries take."""
    def make(**frames):
        for name, df in frames.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return make
