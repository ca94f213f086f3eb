"""Run all (or the named) registered queries against DuckDB: python tests/check_oracles.py [sf] [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from exactsync.queries import ORACLES, QUERIES  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name])
        except Exception as e:
            problem = f"{name}: {type(e).__name__} {str(e)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s", problem or f"{name} ok", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
