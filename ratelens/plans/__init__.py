"""Reports (typed and rendered) and the text sink."""

from ratelens.plans.reports import (
    age_lines,
    age_stats,
    best_movie,
    gender_lines,
    gender_stats,
    genre_lines,
    genre_stats,
    movie_lines,
    movie_stats,
)
from ratelens.plans.sinks import write_lines

__all__ = ["age_lines", "age_stats", "best_movie", "gender_lines", "gender_stats",
           "genre_lines", "genre_stats", "movie_lines", "movie_stats", "write_lines"]
