"""Compare registered queries with their SQL: python tests/check_queries.py [folder] [name ...]"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in records]
    return sorted(found, key=lambda r: tuple((v is not None, v or "") for v in r)), sorted(names)


def compare(spark, folder, name, query, sql):
    start = time.time()
    frame = query(spark, folder)
    got, names = rows([tuple(r) for r in frame.collect()], frame.columns)
    took = time.time() - start
    if sql is None:
        return f"{name:28} rows {len(got):7}            {took:6.1f}s", True
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = con.execute(sql)
    want, wanted = rows(result.fetchall(), [d[0] for d in result.description])
    ok = names == wanted and got == want
    text = f"{name:28} rows {len(got):7} {'ok' if ok else 'DIFFERENT':10} {took:6.1f}s"
    if not ok:
        text += f"\n   columns {names} {wanted} rows {len(got)} {len(want)}"
        extra, missing = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        text += f"\n   spark only {str(extra)[:600]}\n   sql only   {str(missing)[:600]}"
    return text, ok


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    sqls, bad = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            text, ok = compare(spark, folder, name, query, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            text, ok = f"{name:28} ERROR {str(e)[:900]}", False
        print("CHECK", text, flush=True)
        bad += [] if ok else [name]
    print("CHECK failed:", bad)


if __name__ == "__main__":
    main()
