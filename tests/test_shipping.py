import os
import subprocess
import sys
import zipfile
from pathlib import Path

from cdcflow.session import clear_scratch, materialize

REPO = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.addPyFile(sys.argv[1])
from cdcflow.operators.pgoutput import relations, tag_messages
body = b"R" + (7).to_bytes(4, "big") + b"s" + bytes(1) + b"t" + bytes(1) + b"f" + (0).to_bytes(2, "big")
rows = spark.createDataFrame([("x", 1, body)], "slot string, pos long, msg binary")
print("TABLE", relations(tag_messages(rows)).first().table)
"""


def test_the_package_reaches_executors_as_a_zip(tmp_path):
    """What ``--py-files`` or ``addPyFile`` does, from a folder that does not hold the package."""
    zipped = tmp_path / "cdcflow.zip"
    with zipfile.ZipFile(zipped, "w") as z:
        for f in sorted((REPO / "cdcflow").rglob("*.py")):
            z.write(f, f.relative_to(REPO))
    (tmp_path / "run.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "run.py", str(zipped)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "TABLE t" in out.stdout, out.stderr[-2000:]


def test_scratch_goes_when_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("cdcflow.session._SCRATCH", {})
    monkeypatch.setattr("cdcflow.session.shared_dir", lambda spark: str(tmp_path))
    materialize(spark.range(3).toDF("i"), "kept")
    assert len(os.listdir(tmp_path)) == 1 and clear_scratch(spark) == 1 and os.listdir(tmp_path) == []
