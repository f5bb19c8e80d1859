"""Operators on workers that can't import the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})  # the driver's path alone
from footfall.session import local_session
from footfall.llm.queries import QUERIES

spark = local_session(2)

def importable(batches):
    for batch in batches:
        try:
            import footfall.llm
        except ImportError:
            continue
        yield batch

assert spark.range(1).mapInArrow(importable, "id long").count() == 0
for name in sys.argv[1:]:
    assert QUERIES[name](spark, {FOLDER!r}).count() > 0, name
print("all ran")
"""


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="provided tables not found")
def test_workers_need_no_package(tmp_path):
    names = ["op1_lm_scoring", "op2_secret_scan", "op3_sentencepiece", "op4_quality_rules", "op6_quality_classifier", "op8_decontamination", "op9_rans_output"]
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    done = subprocess.run([sys.executable, str(script), *names], cwd=tmp_path, env=_clean(), capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def _clean():
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK", "SPARK_ENV"))}
    env["PYTHONPATH"] = os.pathsep.join(p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != ROOT)
    return env
