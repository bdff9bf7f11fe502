import json
import os
import subprocess
import sys
from pathlib import Path

from helpers import event, song, write_logs, write_lines, write_song

from playmart.schemas import column_names

REPO = Path(__file__).resolve().parent.parent


def run(*args, cwd):
    settings = "--conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell"
    env = {**os.environ, "PYTHONPATH": str(REPO), "PYSPARK_SUBMIT_ARGS": settings}
    done = subprocess.run(
        [sys.executable, "-m", "playmart", *args], cwd=cwd, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def write_inputs(tmp_path):
    write_song(tmp_path / "songs", "TRAAAAA", song())
    write_logs(tmp_path / "logs", "2018-11-12", event(), event(userId=9, gender="M", level="free"))


def test_load_then_report(tmp_path):
    write_inputs(tmp_path)
    write_lines(tmp_path / "paths.json", [json.dumps({"jsonpaths": [f"$['{c}']" for c in column_names("staging_events")]})])
    root = "mart"  # relative to the working directory
    run("reset", "--root", root, cwd=tmp_path)
    run(
        "load",
        "--root",
        root,
        "--logs",
        str(tmp_path / "logs"),
        "--songs",
        str(tmp_path / "songs"),
        "--event-paths",
        str(tmp_path / "paths.json"),
        cwd=tmp_path,
    )
    assert (tmp_path / "mart" / "songplays").is_dir()
    check(run("report", "--root", root, cwd=tmp_path))


def test_arrivals_then_report(tmp_path):
    write_inputs(tmp_path)
    root = str(tmp_path / "mart")
    run("arrivals", "--root", root, "--logs", str(tmp_path / "logs"), "--songs", str(tmp_path / "songs"), cwd=tmp_path)
    check(run("report", "--root", root, "--incremental", cwd=tmp_path))


def test_report_prints_every_group_in_full(tmp_path):
    write_song(tmp_path / "songs", "TRAAAAA", song())
    levels = [f"level {i:02} {'x' * 40}" for i in range(30)]
    write_logs(tmp_path / "logs", "2018-11-12", *[event(level=level) for level in levels])
    root, out = str(tmp_path / "mart"), tmp_path / "out"
    run("arrivals", "--root", root, "--logs", str(tmp_path / "logs"), "--songs", str(tmp_path / "songs"), cwd=tmp_path)
    shown = run("report", "--root", root, "--incremental", "--out", str(out), cwd=tmp_path)
    assert all(level in shown for level in levels)
    written = [json.loads(line) for f in (out / "plays_by_level").glob("part-*") for line in f.read_text().splitlines()]
    assert sorted(r["level"] for r in written) == levels


def check(shown):
    cells = [[c.strip() for c in line.strip("|").split("|")] for line in shown.splitlines() if line.startswith("|")]
    assert ["2", "2"] in cells
    assert ["paid", "1"] in cells and ["free", "1"] in cells
    assert ["F", "1"] in cells and ["M", "1"] in cells
