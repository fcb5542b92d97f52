"""Compare a Spark result with the SQL oracle: columns, rows, values."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return f"{round(value, 6) + 0.0:.6f}"
        return repr(value)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    want_columns, want = canonical([d[0] for d in result.description], result.fetchall())
    got_columns, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if got_columns != want_columns:
        found.append(f"columns {got_columns} against {want_columns}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} against {len(want)}")
    if got != want:
        wrong = [(g, w) for g, w in zip(got, want) if g != w]
        found.append(f"{len(wrong)} rows differ, first {wrong[:1]}"[:600])
    return found
