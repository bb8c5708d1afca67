"""Golden outputs of the four reports (opt-in).

Set RATELENS_GOLDEN_INPUT to a directory holding movies.txt, users.txt and
the rating files, and RATELENS_GOLDEN_R1 .. RATELENS_GOLDEN_R4 to the
expected report files; each report must match line for line, in order.
"""

import os

import pytest

from ratelens.plans import runner
from tests.test_runner import read_report

INPUT = os.environ.get("RATELENS_GOLDEN_INPUT")
CASES = {
    "R1": (runner.run_movie_report, False),
    "R2": (runner.run_genre_report, False),
    "R3": (runner.run_gender_report, True),
    "R4": (runner.run_age_report, True),
}


@pytest.mark.parametrize("single_file", [True, False])
@pytest.mark.parametrize("report", sorted(CASES))
def test_golden(spark, tmp_path, report, single_file):
    expected_path = os.environ.get(f"RATELENS_GOLDEN_{report}")
    if not INPUT or not expected_path:
        pytest.skip("golden inputs not configured")
    fn, with_users = CASES[report]
    out = str(tmp_path / report)
    args = [os.path.join(INPUT, "movies.txt")]
    if with_users:
        args.append(os.path.join(INPUT, "users.txt"))
    fn(spark, INPUT, out, *args, single_file=single_file)
    with open(expected_path, encoding="utf-8") as f:
        expected = f.read().splitlines()
    assert read_report(out) == expected
