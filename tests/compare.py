"""Run registered queries next to their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def canonical(table: pa.Table) -> list[tuple]:
    """Rows as sortable text, columns by name. Values keep their type: 1 is not 1.0."""
    columns = [table[c].to_pylist() for c in sorted(table.column_names)]
    return sorted(tuple(map(repr, row)) for row in zip(*columns))


def compare(got: pa.Table, expected: pa.Table) -> str | None:
    """None when equal, else what differs."""
    if sorted(got.column_names) != sorted(expected.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(expected.column_names)}"
    if got.num_rows != expected.num_rows:
        return f"rows {got.num_rows} != {expected.num_rows}"
    for left, right in zip(canonical(got), canonical(expected)):
        if left != right:
            return f"values {left} != {right}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from bikeflow.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    spark = build_session("local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            got = run(spark, sf)
            types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
            frame = got.toArrow()
            verdict = f"rows only, {frame.num_rows}"
            if name in sql:
                relation = con.sql(sql[name])
                sql_types = dict(zip(relation.columns, map(str, relation.types)))
                difference = compare(frame, relation.to_arrow_table())
                bad += difference is not None
                verdict = f"ok, {frame.num_rows}" if difference is None else f"DIFFERENT {difference}"
                pairs = {(types.get(c), sql_types.get(c)) for c in types}
                odd = pairs - {
                    ("string", "VARCHAR"), ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"),
                    ("boolean", "BOOLEAN"), ("timestamp_ntz", "TIMESTAMP"), ("date", "DATE"),
                }
                if odd:
                    verdict += f" types {odd}"
        except Exception as failure:
            bad += 1
            verdict = f"FAILED {type(failure).__name__}: {str(failure)[:600]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {verdict}", flush=True)
    print("different or failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
