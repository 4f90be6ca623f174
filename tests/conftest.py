import pytest

from tests.compare import duck, spark_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(4)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SF)


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def rows(df, *order):
    """Rows as dictionaries, sorted."""
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df):
    """The physical plan as text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
