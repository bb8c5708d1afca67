"""End-to-end reports: text in, one ordered text file out."""

import os

import pytest

from ratelens.plans import runner
from tests.test_edge_fixture import EDGE_R1, EDGE_R2, EDGE_R3, EDGE_R4


def read_report(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    out = []
    for p in parts:
        with open(os.path.join(path, p), encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


def test_genre_report_file(spark, edge_dir, tmp_path):
    out = str(tmp_path / "r2")
    runner.run_genre_report(spark, edge_dir, out, os.path.join(edge_dir, "movies.txt"))
    assert read_report(out) == EDGE_R2
    with pytest.raises(Exception):  # the output directory must not exist
        runner.run_genre_report(spark, edge_dir, out, os.path.join(edge_dir, "movies.txt"))


def test_movie_report_single_file(spark, edge_dir, tmp_path):
    out = str(tmp_path / "r1")
    runner.run_movie_report(spark, edge_dir, out, os.path.join(edge_dir, "movies.txt"),
                            single_file=True)
    parts = [p for p in os.listdir(out) if p.startswith("part-")]
    lines = read_report(out)
    assert len(parts) == 1 and len(lines) == 10
    assert lines[0].startswith("Alpha Redux (2011)\t") and lines[-1].endswith(
        "among movies with at least 5 ratings.")


def test_cli_usage_error_exits_2():
    from ratelens.__main__ import main
    with pytest.raises(SystemExit) as e:
        main(["movies", "only-one-arg"])
    assert e.value.code == 2


@pytest.mark.parametrize("report,expected,with_users", [
    ("movies", EDGE_R1, False), ("genres", EDGE_R2, False),
    ("gender", EDGE_R3, True), ("age", EDGE_R4, True)])
def test_cli_reports(spark, edge_dir, tmp_path, report, expected, with_users):
    from ratelens.__main__ import main
    out = str(tmp_path / report)
    args = [report, edge_dir, out, os.path.join(edge_dir, "movies.txt")]
    if with_users:
        args.append(os.path.join(edge_dir, "users.txt"))
    assert main(args) == 0
    assert read_report(out) == expected
    assert main(args + ["--overwrite", "--single-file"]) == 0
    assert read_report(out) == expected
