"""Command line: ``python -m ratelens <report> <args>``, or
``spark-submit scripts/ratelens_report.py <report> <args>``.

  movies  <input_ratings> <output> <movies_file>
  genres  <input_ratings> <output> <movies_file>
  gender  <input_ratings> <output> <movies_file> <users_file>
  age     <input_ratings> <output> <movies_file> <users_file>

A wrong argument count prints usage and exits with status 2; an existing
output directory is an error unless ``--overwrite`` is given.
"""

from __future__ import annotations

import argparse
import sys

from ratelens.plans import runner
from ratelens.session import build_session

_REPORTS = {
    "movies": (runner.run_movie_report, ["input_ratings", "output", "movies_file"]),
    "genres": (runner.run_genre_report, ["input_ratings", "output", "movies_file"]),
    "gender": (runner.run_gender_report,
               ["input_ratings", "output", "movies_file", "users_file"]),
    "age": (runner.run_age_report, ["input_ratings", "output", "movies_file", "users_file"]),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ratelens")
    sub = parser.add_subparsers(dest="report", required=True)
    for name, (_, args) in _REPORTS.items():
        p = sub.add_parser(name)
        for a in args:
            p.add_argument(a)
        p.add_argument("--overwrite", action="store_true")
        p.add_argument("--single-file", action="store_true")
    ns = parser.parse_args(argv)
    fn, args = _REPORTS[ns.report]
    spark = build_session(app_name=f"ratelens-{ns.report}", checkpoints=False)
    fn(spark, *[getattr(ns, a) for a in args],
       mode="overwrite" if ns.overwrite else "errorifexists", single_file=ns.single_file)
    return 0


if __name__ == "__main__":
    sys.exit(main())
