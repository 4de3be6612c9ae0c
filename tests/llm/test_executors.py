"""All queries run where executors have no installation of the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import sys
sys.path.insert(0, {root!r})  # the driver's path only
from onomata.session import local_session
spark = local_session(cores=4, shuffle_partitions=4, memory="3g")
from pyspark.sql import functions as F

def installed(batches):
    import importlib.util
    for batch in batches:
        yield batch.assign(id=int(importlib.util.find_spec("onomata") is not None))

assert spark.range(4).mapInPandas(installed, "id bigint").agg(F.sum("id")).first()[0] == 0
from onomata.llm import queries
for name, query in queries.queries().items():
    n = query(spark, "/root/testdata/sf0.001").count()
    assert n > 0, name
    print("ran", name)
spark.stop()
"""


def test_queries_without_the_package_on_executors(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    assert run.stdout.count("ran op") == 13
