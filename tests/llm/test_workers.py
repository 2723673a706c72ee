"""Tasks on workers that have no copy of this repository, as on a cluster where only the driver was given one."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
from pyspark.sql import SparkSession

spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

def there(batches):
    import importlib.util
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_pydict({"there": [importlib.util.find_spec("quotelens") is not None]})

assert not any(r.there for r in spark.range(4).mapInArrow(there, "there boolean").collect()), "workers see the repository"
sys.path.insert(0, sys.argv[1])
import corpus_pipeline
from quotelens.llm import queries

for name, query in [*queries.QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_every_query_runs_on_workers_without_the_repository(tmp_path):
    (tmp_path / "job.py").write_text(SCRIPT)
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != REPO]
    done = subprocess.run(
        [sys.executable, str(tmp_path / "job.py"), str(REPO), f"file://{tmp_path}/shared"], cwd=tmp_path,
        env=os.environ | {"PYTHONPATH": os.pathsep.join(paths)}, capture_output=True, text=True, timeout=900,
    )
    assert done.returncode == 0, done.stdout[-500:] + done.stderr[-3000:]
    assert done.stdout.count("ran ") == 14
