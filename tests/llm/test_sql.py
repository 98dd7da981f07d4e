"""The numbered operators' queries against their SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from limes.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = queries.queries()[name](spark, DATA).toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    plain = lambda x: None if pd.isna(x) else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    rows = lambda df: sorted(str([plain(x) for x in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
