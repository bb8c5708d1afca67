"""Property test: the Spark row rules against a plain model of the Java rules.

The model is written from the documented Java behaviour: ``String.trim``
removes characters up to U+0020, ``split(",")`` drops trailing empty
strings, ``Integer.parseInt`` takes an optional sign and digits within the
int range, ``Double.parseDouble`` follows the grammar documented for
``Double.valueOf``.  (Non-ASCII digits, which Java also reads, are left out:
a documented difference.)
"""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratelens.sources import parse_ratings

_DIGITS = r"(\d+)"
_EXP = r"[eE][+-]?\d+"
_HEX = r"0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?\d+"
_DEC = rf"(\d+\.?\d*({_EXP})?|\.\d+({_EXP})?)"
_JAVA_DOUBLE = re.compile(rf"^[+-]?(NaN|Infinity|(({_DEC})|({_HEX}))[fFdD]?)$")
_JAVA_INT = re.compile(r"^[+-]?[0-9]+$")


def jtrim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and s[i] <= " ":
        i += 1
    while j > i and s[j - 1] <= " ":
        j -= 1
    return s[i:j]


def jsplit(s: str) -> list[str]:
    parts = s.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def jint(s: str):
    s = jtrim(s)
    if not _JAVA_INT.match(s):
        return None
    v = int(s)
    return v if -2**31 <= v < 2**31 else None


def jdouble(s: str):
    s = jtrim(s)
    if not _JAVA_DOUBLE.match(s):
        return None
    sign = -1.0 if s.startswith("-") else 1.0
    body = s.lstrip("+-")
    if body == "NaN":
        return math.nan
    if body == "Infinity":
        return sign * math.inf
    if body[-1] in "fFdD":
        body = body[:-1]
    if body[:2] in ("0x", "0X"):
        return sign * float.fromhex(body)
    return sign * float(body)


def model(lines, min_fields, require_user):
    out = []
    for raw in lines:
        line = jtrim(raw)
        if not line:
            continue
        parts = jsplit(line)
        if len(parts) < min_fields:
            continue
        user = jint(parts[0])
        movie = jint(parts[1])
        rating = jdouble(parts[2])
        if movie is None or rating is None or (require_user and user is None):
            continue
        out.append((user, movie, rating))
    return out


def norm(rows):
    return sorted(((u, m, "nan" if isinstance(r, float) and math.isnan(r) else r)
                   for u, m, r in rows), key=repr)


_pad = st.text(alphabet=" \t\x0b\x01\x7f\u00a0\u2003", max_size=2)
_int_txt = st.one_of(
    st.integers(-3_000_000_000, 3_000_000_000).map(str),
    st.integers(0, 99).map(lambda v: f"+{v}"),
    st.sampled_from(["", "x", "5.0", "5L", "0x10", "1_0", "--1", "+", "007"]))
_dbl_txt = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(repr),
    st.integers(-50, 50).map(lambda v: f"{v / 4}"),
    st.sampled_from(["NaN", "-NaN", "nan", "Infinity", "-Infinity", "inf", "INF",
                     "1e1", "1e1f", "4.0d", "4.0D", ".5", "5.", ".", "e5", "1e", "0x1p3",
                     "0x1.8p1", "0x10", "1,5", "five", "Infinityd", "+.5e-1", "1e400"]))


@st.composite
def rating_line(draw):
    fields = [draw(_int_txt), draw(_int_txt), draw(_dbl_txt)]
    fields += draw(st.lists(st.sampled_from(["", " ", "964982703", "x"]), max_size=3))
    n = draw(st.integers(0, len(fields)))
    fields = fields[:n] if draw(st.booleans()) else fields
    return ",".join(draw(_pad) + f + draw(_pad) for f in fields)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(rating_line(), min_size=50, max_size=300),
       min_fields=st.sampled_from([3, 4]), require_user=st.booleans())
def test_parse_matches_java_model(spark, lines, min_fields, require_user):
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = [tuple(r) for r in parse_ratings(df, min_fields, require_user).collect()]
    assert norm(got) == norm(model(lines, min_fields, require_user))


def movie_model(lines):
    out = []
    for raw in lines:
        line = jtrim(raw)
        if not line:
            continue
        first = line.find(",")
        last = line.rfind(",")
        second = line.find(",", first + 1) if first >= 0 else -1
        if first < 0 or second < 0:
            continue
        ident = jint(line[:first])
        if ident is None:
            continue
        out.append((ident, jtrim(line[first + 1:last]), jtrim(line[first + 1:second]),
                    jtrim(line[last + 1:])))
    return out


_word = st.text(alphabet="ab |()19\t", min_size=0, max_size=6)


@st.composite
def movie_line(draw):
    ident = draw(_int_txt)
    parts = draw(st.lists(_word, min_size=0, max_size=4))
    return draw(_pad) + ",".join([ident] + parts) + draw(_pad)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(movie_line(), min_size=30, max_size=200))
def test_movie_parse_matches_java_model(spark, lines):
    from ratelens.sources import parse_movies
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = sorted(tuple(r) for r in parse_movies(df, dedup=False).collect())
    assert got == sorted(movie_model(lines))
