"""Compare a query with its SQL on the same tables, ignoring row and column order."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


KINDS = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


def _cell(v):
    return repr(float(v)) if isinstance(v, float) else repr(v)


def difference(df, con, sql):
    """None when equal, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    if kinds != dict(df.dtypes):
        return f"types {sorted(set(df.dtypes) ^ set(kinds.items()))}"
    order = sorted(names)
    want = sorted(tuple(_cell(row[names.index(c)]) for c in order) for row in result.fetchall())
    got = sorted(tuple(_cell(r[c]) for c in order) for r in df.collect())
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2]
    absent = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} vs {len(want)} rows; only here {extra}; only there {absent}; columns {order}"
