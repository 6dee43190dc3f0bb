"""Run an operator's DuckDB SQL over the rows of a Spark table."""

import duckdb


def rows_of(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in found.fetchall()), key=str)


def rows(df, *columns):
    names = sorted(columns or df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)
