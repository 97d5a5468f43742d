"""Code that runs in Python workers must not need this package there."""

import subprocess
import sys

from pyspark import cloudpickle

from tidewell.operators import dedup
from tidewell.streaming import state


def test_worker_code_loads_without_the_package(tmp_path):
    made = (dedup._bloom_pass(10, 0.01), dedup._without_copies, state.FirstOfDay(["a"]), state.BloomShard(10, 0.01))
    path = tmp_path / "code.bin"
    path.write_bytes(cloudpickle.dumps(made))
    script = f"import pickle; print(len(pickle.load(open({str(path)!r}, 'rb'))))"
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "4", done.stderr
