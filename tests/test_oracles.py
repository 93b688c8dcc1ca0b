"""Every registered query against its SQL, on the smallest data set."""

import pytest

import __spark_entry__ as app
import check


@pytest.fixture(scope="module")
def con(smoke):
    return check.duck(smoke)


# Queries of the training-text package are tested with it.
NAMES = [name for name in app.queries()
         if not (app.training_text and name in {*app.training_text.QUERIES, "pipeline"})]


def test_every_query_has_sql():
    assert set(NAMES) <= set(app.oracle_sql()) <= set(app.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, smoke, con, name):
    df = app.queries()[name](spark, smoke)
    found = con.execute(app.oracle_sql()[name])
    verdict = check.compare([tuple(r) for r in df.collect()], df.columns, found.fetchall(),
                            [c[0] for c in found.description])
    assert verdict is None, verdict


def test_entry(spark):
    assert len(app.entry(spark).take(1)) == 1
