"""A query's rows against those of SQL that DuckDB runs over the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        path = path + "/*.parquet" if os.path.isdir(path) else path
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return None if v is None or str(v) in ("<NA>", "NaT") else v


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(repr(tuple(plain(v) for v in r)) for r in df[columns].astype(object).itertuples(index=False))


def same(spark, query, sql, sf_dir):
    left, right = rows(query(spark, sf_dir).toPandas()), rows(connect(sf_dir).execute(sql).df())
    assert left[0] == right[0]
    assert left[1] == right[1]
