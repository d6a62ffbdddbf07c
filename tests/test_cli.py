"""Stages as separate processes (each with its own in-memory catalog)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _cli(tmp, *args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    cmd = [sys.executable, "-m", "viewlog", "--master", "local[2]", "--root", f"{tmp}/tables", *args]
    return subprocess.run(cmd, cwd=tmp, env=env, capture_output=True, text=True, timeout=600)


def test_cli_stages_across_processes(tmp_path):
    tmp = str(tmp_path)
    for day in ("20220403", "20220404"):
        d = f"{tmp}/src/source_file={day}"
        os.makedirs(d)
        with open(f"{d}/log.json", "w") as f:
            for i in range(12):
                rec = {"_source": {"Contract": f"c{i % 3}", "Mac": "m", "TotalDuration": i, "AppName": "VOD"}}
                f.write(json.dumps(rec) + "\n")
    r = _cli(tmp, "run", "--source", f"{tmp}/src", "--batch", "20220403:8:2024-04-03")
    assert r.returncode == 0, r.stderr[-2000:]
    assert r.stdout.count(" ok ") == 4
    # A new process: the checkpoint and tables are found again on storage.
    r = _cli(tmp, "bronze", "--source", f"{tmp}/src", "--rows", "100", "--run-date", "2024-04-04")
    assert r.returncode == 0, r.stderr[-2000:]
    assert "'rows': 16" in r.stdout  # 4 left in the first file, 12 in the second
    r = _cli(tmp, "silver", "--run-date", "2024-04-04")
    assert r.returncode == 0 and "'rows': 6" in r.stdout, r.stderr[-2000:]  # 3 contracts x 2 files
