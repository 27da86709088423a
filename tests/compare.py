"""Run registered queries beside their SQL: python -m tests.compare SF_DIR [NAME...]"""

import os
import sys

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(df):
    df = df[sorted(df.columns)]
    for c in df.columns:
        if df[c].dtype.kind in "fiub":
            df[c] = df[c].astype(float).round(6)
        else:
            df[c] = df[c].map(lambda x: None if x is None or x != x else str(x))
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def differences(spark_df, sql, sf_dir):
    """None if both give the same rows, else what differs."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    want, got = con.execute(sql).df(), spark_df.toPandas()
    if sorted(want.columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    if len(want) != len(got):
        return f"{len(got)} and {len(want)} rows"
    a, b = normal(got), normal(want)
    for c in a.columns:
        bad = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        if bad.any():
            return f"{bad.sum()} of {len(a)} in {c}: {a[bad].head(2).to_dict('records')} and {b[bad].head(2).to_dict('records')}"
    return None


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or sorted(sql):
        began = time.time()
        try:
            found = differences(queries[name](spark, sys.argv[1]), sql[name], sys.argv[1])
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {'same' if found is None else found} ({time.time() - began:.1f} s)", flush=True)
