"""Run registered queries against their oracles: check_queries.py SF_DIR [name ...]."""

import os
import sys
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from compare import compare, connect

if __name__ == "__main__":
    sf_dir, *names = sys.argv[1:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    found, sql = entry.queries(), entry.oracle_sql()
    print("without oracle:", sorted(found.keys() - sql.keys()), "oracle only:", sorted(sql.keys() - found.keys()))
    for name in names or found:
        start = time.time()
        try:
            df = found[name](spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else f"no oracle, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
