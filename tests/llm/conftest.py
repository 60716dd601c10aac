import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """The folder for intermediate tables, as a cluster would name it."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark.conf.get("spark.checkpoint.dir")


EXTRA = ("digest string, keep string, rows int, clean string, ids string, blob string, path string, content string, u int, id int, "
         "row string, hash string, sha string, order string, quality double, place string, kept_id long, of_words string, key long, node long")


@pytest.fixture
def docs(spark, shared):
    """Documents from (doc_id, text) pairs, with columns whose names clash with inner ones."""
    def make(pairs):
        names = [c.split()[0] for c in EXTRA.split(", ")]
        rows = [(i, t, *[None] * len(names)) for i, t in pairs]
        return spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}").repartition(3)
    return make


@pytest.fixture(scope="session")
def real(spark, shared):
    """All documents of the smallest table as (doc_id, text) pairs."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


LONG = " ".join(f"word{i % 977} and" for i in range(40_000))
EDGES = [(1, ""), (2, None), (None, "Lone row"), (None, "Lone row"), (3, LONG), (4, "same TEXT"), (4, "same TEXT"),
         (5, "Same text"), (6, " \t\n"), (7, "x" * 50_000), (8, "aé\U0001f600b İK"), (9, None), (10, "\x0b\x85  q")]


@pytest.fixture
def edges():
    return EDGES
