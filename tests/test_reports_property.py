"""Property test: the four reports, text in and text out, against a plain
line-by-line model of the report rules on random inputs."""

import math
import uuid
from collections import defaultdict
from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratelens.plans import runner
from tests.test_parse_property import jdouble, jint, jsplit, jtrim
from tests.test_runner import read_report


def fmt(x: float) -> str:
    if math.isnan(x):
        return "NaN"
    if math.isinf(x):
        return "\u221e" if x > 0 else "-\u221e"  # the pattern's infinity symbol
    return str(Decimal(x).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN))


def last_wins(pairs):
    out = {}
    for k, v in pairs:
        out[k] = v
    return out


def parse_lines(lines, min_fields, require_user):
    for raw in lines:
        line = jtrim(raw)
        if not line:
            continue
        p = jsplit(line)
        if len(p) < min_fields:
            continue
        u, m, r = jint(p[0]), jint(p[1]), jdouble(p[2])
        if m is None or r is None or (require_user and u is None):
            continue
        yield u, m, r


def movie_maps(lines):
    full, short, genres = [], [], []
    for raw in lines:
        line = jtrim(raw)
        first, last = line.find(","), line.rfind(",")
        second = line.find(",", first + 1) if first >= 0 else -1
        if not line or first < 0 or second < 0:
            continue
        i = jint(line[:first])
        if i is None:
            continue
        full.append((i, jtrim(line[first + 1:last])))
        short.append((i, jtrim(line[first + 1:second])))
        genres.append((i, jtrim(line[last + 1:])))
    return last_wins(full), last_wins(short), last_wins(genres)


def user_maps(lines):
    gender, age = [], []
    for raw in lines:
        line = jtrim(raw)
        if not line:
            continue
        p = jsplit(line)
        i = jint(p[0]) if p else None
        if i is None:
            continue
        if len(p) >= 2 and jtrim(p[1]):
            gender.append((i, jtrim(p[1])[0]))
        if len(p) >= 3 and jint(p[2]) is not None:
            age.append((i, jint(p[2])))
    return last_wins(gender), last_wins(age)


def model_reports(all_lines, movie_lines, user_lines):
    full, short, genres = movie_maps(movie_lines)
    gender, age = user_maps(user_lines)
    # R1
    acc = defaultdict(list)
    for _, m, r in parse_lines(all_lines, 4, False):
        acc[m].append(r)
    r1, best, best_avg = [], "", -math.inf
    for m in sorted(acc):
        avg = sum(acc[m]) / len(acc[m])
        title = full.get(m, f"UnknownMovie({m})")
        r1.append(f"{title}\tAverage rating: {fmt(avg)} (Total ratings: {len(acc[m])})")
        if len(acc[m]) >= 5 and avg > best_avg:
            best, best_avg = title, avg
    if best:
        r1.append(f"{best} is the highest rated movie with an average rating of "
                  f"{fmt(best_avg)} among movies with at least 5 ratings.")
    # R2
    acc = defaultdict(list)
    for _, m, r in parse_lines(all_lines, 3, False):
        g = genres.get(m)
        if not g:
            continue
        for tok in g.split("|"):
            tok = jtrim(tok)
            if tok:
                acc[tok].append(r)
    r2 = [f"{g}\tAvg: {fmt(sum(v) / len(v))}, Count: {len(v)}"
          for g, v in sorted(acc.items(), key=lambda kv: kv[0].encode("utf-8"))]
    # R3 and R4
    rows3, rows4 = defaultdict(list), defaultdict(list)
    for u, m, r in parse_lines(all_lines, 3, True):
        if m in short and u in gender:
            rows3[m].append((gender[u], r))
        if m in short and u in age:
            a = age[u]
            rows4[m].append(("0-18" if a < 18 else "18-35" if a < 35 else "35-50" if a < 50
                             else "50+", r))
    r3 = []
    for m in sorted(rows3):
        if not short[m]:
            continue
        males = [r for g, r in rows3[m] if g == "M"]
        females = [r for g, r in rows3[m] if g == "F"]
        ma = sum(males) / len(males) if males else 0.0
        fa = sum(females) / len(females) if females else 0.0
        r3.append(f"{short[m]}\tMale: {fmt(ma)}, Female: {fmt(fa)}")
    r4 = []
    for m in sorted(rows4):
        if not short[m]:
            continue
        cells = []
        for label in ("0-18", "18-35", "35-50", "50+"):
            vals = [r for g, r in rows4[m] if g == label]
            cells.append(f"{label}: " + (fmt(sum(vals) / len(vals)) if vals else "NA"))
        r4.append(short[m] + "\t" + "\t".join(cells))
    return r1, r2, r3, r4


_id = st.one_of(st.integers(1, 12).map(str), st.sampled_from(["x", " 3 ", "+4", "5.0", ""]))
_rating = st.one_of(st.integers(-4, 20).map(lambda v: str(v / 4)),
                    st.sampled_from(["NaN", "nan", "five", "4.0d", "1e0", "Infinity",
                                     "-Infinity"]))
_title = st.text(alphabet="ab ,|()", max_size=6)
_genres = st.lists(st.sampled_from(["Drama", "War", " ", "", "drama", "Sci-Fi"]), max_size=3)
_gender = st.sampled_from(["M", "F", "X", "Male", "f", "", " "])
_age = st.one_of(st.integers(-3, 70).map(str), st.just("abc"))


@st.composite
def inputs(draw):
    ratings = [", ".join([draw(_id), draw(_id), draw(_rating)]
                         + draw(st.lists(st.just("100"), max_size=2)))
               for _ in range(draw(st.integers(20, 80)))]
    movies = [f"{draw(_id)}, {draw(_title)}, {'|'.join(draw(_genres))}"
              for _ in range(draw(st.integers(3, 15)))]
    users = [", ".join([draw(_id), draw(_gender), draw(_age)][:draw(st.integers(1, 3))])
             for _ in range(draw(st.integers(3, 15)))]
    return ratings, movies, users


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=inputs())
def test_reports_match_model(spark, tmp_path_factory, data):
    ratings, movies, users = data
    d = tmp_path_factory.mktemp("in" + uuid.uuid4().hex[:6])
    for name, lines in (("ratings_1.txt", ratings), ("movies.txt", movies),
                        ("users.txt", users)):
        (d / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    out = tmp_path_factory.mktemp("out" + uuid.uuid4().hex[:6])
    mv, us = str(d / "movies.txt"), str(d / "users.txt")
    runner.run_movie_report(spark, str(d), str(out / "r1"), mv)
    runner.run_genre_report(spark, str(d), str(out / "r2"), mv)
    runner.run_gender_report(spark, str(d), str(out / "r3"), mv, us)
    runner.run_age_report(spark, str(d), str(out / "r4"), mv, us)
    got = [read_report(str(out / r)) for r in ("r1", "r2", "r3", "r4")]
    all_lines = ratings + movies + users  # the ratings input is the whole directory
    assert got == list(model_reports(all_lines, movies, users))
