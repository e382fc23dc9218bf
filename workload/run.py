"""Run all or some queries on one folder and print their times."""

import sys
import time
import traceback

from murmur.session import get_spark
from workload.queries import QUERIES


def main(folder: str, names: list[str]) -> None:
    spark = get_spark("murmur-run", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.murmur.readPartitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        start = time.time()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            print(f"{name:24s} {time.time() - start:6.2f}s", flush=True)
        except Exception as e:
            print(f"{name:24s} FAILED {type(e).__name__}", str(e)[:600], flush=True)
            if names:
                traceback.print_exc()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
