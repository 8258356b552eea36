"""Hot user (a third of all events): exact results, and no task reads the hot group whole."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_user_is_combined_map_side():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_check.py"),
                          "/root/testdata/sf0.01"], capture_output=True, text=True, timeout=600)
    report = json.loads(out.stdout.strip().splitlines()[-1])
    assert report["equal"]
    # no task of any shuffle stage reads as many rows as the hot user has events
    assert max(report["max_task_reads"].values()) < report["hot_events"]
