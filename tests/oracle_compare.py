"""Compare a Spark result with DuckDB's, by sorted rows over name-sorted columns."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return db


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, folder, name, query, sql):
    df = query(spark, folder)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connect(folder).execute(sql)
    right = rows_of([d[0] for d in result.description], result.fetchall())
    assert left[0] == right[0], f"{name}: columns {left[0]} != {right[0]}"
    only_spark = sorted(set(left[1]) - set(right[1]))
    only_sql = sorted(set(right[1]) - set(left[1]))
    assert left[1] == right[1], (
        f"{name}: {len(left[1])} vs {len(right[1])} rows; spark only {only_spark[:3]}; sql only {only_sql[:3]}"
    )
    return len(left[1])
