import re
import subprocess
import sys
from pathlib import Path

SCRIPT = Path(__file__).with_name("llm_retry_check.py")


def test_repeated_tasks_change_no_result(tmp_path):
    done = subprocess.run(
        [sys.executable, SCRIPT, "/root/testdata/sf0.001", str(tmp_path)], capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(re.search(r"failed attempts: (\d+)", done.stdout).group(1)) >= 24
