"""Every query of the reference's operators against its SQL, and the others for rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import connect, same
from tidegrid.plans import catalogue

SF = "/root/testdata/sf0.001"
TIED = ["troughs", "views_after_trough", "own_range_features", "relative_rule", "relative_rule_switched", "rule_class_two_sets"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    same(catalogue.QUERIES[name](spark, SF), con, catalogue.ORACLE_SQL[name])


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory):
    """A folder whose events hold many equal means of unlike values, and a connection that adds them exactly."""
    folder = str(tmp_path_factory.mktemp("tied"))
    rng = np.random.default_rng(6)
    rows = []
    for user in range(600):
        low = rng.integers(1000, 7000)
        for day in range(30):
            for kind in ("view", "click", "purchase"):
                if rng.random() < 0.6:
                    middle, off = low + 990 * rng.integers(8), rng.integers(1, 900, rng.integers(3))
                    rows += [(user, day, kind, float(middle + x) / 100) for x in (0, *off, *-off)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "event_id long, user_id long, day int, event_type string, value double")
    ts = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, day, 0, 0, event_id / 1e5)").alias("ts")
    props = F.concat(F.lit('{"k": '), (F.col("value") * 10 % 90).cast("int").cast("string"), F.lit("}")).alias("props")
    df.select("event_id", ts, "user_id", "event_type", "value", props).coalesce(1).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * REPLACE (value::DECIMAL(18, 2) AS value) FROM '{folder}/events.parquet/*.parquet'")
    return folder, con


@pytest.mark.parametrize("name", TIED)
def test_equal_means_are_equal(spark, tied, name):
    folder, con = tied
    if name == "own_range_features":
        # Places are rounded to four digits, and a tie of binary fractions may fall either way; days are whole.
        df = catalogue.QUERIES[name](spark, folder)
        cols = ", ".join(df.columns)
        want = con.sql(f"SELECT {cols} FROM ({catalogue.ORACLE_SQL[name]}) ORDER BY k").fetchall()
        got = [tuple(r) for r in df.orderBy("k").collect()]
        assert np.allclose(np.array(got, float), np.array(want, float), rtol=0, atol=1.01e-4, equal_nan=True)
        return
    same(catalogue.QUERIES[name](spark, folder), con, catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
