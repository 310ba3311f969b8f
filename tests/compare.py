"""Compare a query with its SQL, row by row as bags."""

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def sql_rows(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in found.fetchall())


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())
