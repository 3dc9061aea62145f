"""Run SQL in DuckDB over the test tables and compare with a Spark result."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def run(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        cursor = connection.execute(sql)
        return [column[0] for column in cursor.description], cursor.fetchall()


def order(rows, names):
    position = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in position) for row in rows), key=repr)


def assert_same(df, sql: str, sf_dir: str) -> int:
    names, expected = run(sql, sf_dir)
    assert sorted(df.columns) == sorted(names)
    actual = order([tuple(row) for row in df.collect()], df.columns)
    expected = order(expected, names)
    assert len(actual) == len(expected)
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
    return len(actual)
