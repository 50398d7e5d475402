"""Spark result against DuckDB result, as sorted rows with columns by name."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) if r[i] is not None else "" for i in order) for r in rows)


def assert_same(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(names)
    assert len(actual) == len(expected), f"{len(actual)} rows, expected {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not different, f"{len(different)} rows differ, e.g. {different[:3]}"
