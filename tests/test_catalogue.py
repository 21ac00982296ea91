"""Every registered query of the plans against its SQL."""

import math

import duckdb
import pytest

from lexiform.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(frame):
    cols = sorted(frame.columns)

    def value(x):
        if x is None or isinstance(x, float) and math.isnan(x) or str(x) in ("nan", "<NA>", "NaT"):
            return "-"
        if isinstance(x, float) or type(x).__name__.startswith("float"):
            return f"{float(x):.5f}"
        return f"{float(x):.5f}" if type(x).__name__.startswith(("int", "Decimal")) else str(x)

    return cols, sorted(tuple(value(x) for x in r) for r in frame[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = plain(catalogue.queries()[name](spark, sf_dir).toPandas())
    assert got == plain(con.sql(catalogue.oracle_sql()[name]).df())


def test_flagship_has_a_row_for_each_contract(spark, sf_dir):
    assert catalogue.flagship(spark, sf_dir).count() == 1500
