"""Runs a registered query in Spark and its SQL in DuckDB, and compares the rows."""

from __future__ import annotations

from collections import Counter

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con



def spark_rows(df) -> tuple[list[str], Counter, dict[str, str]]:
    names = sorted(df.columns)
    rows = Counter(tuple(row[n] for n in names) for row in df.collect())
    return names, rows, {f.name: f.dataType.simpleString() for f in df.schema.fields}


def duck_rows(con, sql: str) -> tuple[list[str], Counter, dict[str, str]]:
    done = con.execute(sql)
    columns = [d[0] for d in done.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(row[i] for i in order) for row in done.fetchall())
    kinds = {d[0]: str(d[1]) for d in done.description}
    return [columns[i] for i in order], rows, kinds


# Spark type -> DuckDB type.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def compare(spark, con, sf_dir: str, name: str) -> list[str]:
    """Differences between the two results; none when they agree."""
    names, rows, kinds = spark_rows(queries()[name](spark, sf_dir))
    want_names, want, want_kinds = duck_rows(con, oracle_sql()[name])
    if names != want_names:
        return [f"columns {names} against {want_names}"]
    found = []
    for column, kind in kinds.items():
        expected = TYPES.get(kind, kind.upper().replace(",", ", ") if kind.startswith("decimal") else kind)
        if expected.replace(" ", "") != want_kinds[column].replace(" ", ""):
            found.append(f"type of {column}: {kind} against {want_kinds[column]}")
    if rows != want:
        missing, extra = want - rows, rows - want
        found.append(
            f"{sum(rows.values())} rows against {sum(want.values())}; "
            f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
        )
    return found
