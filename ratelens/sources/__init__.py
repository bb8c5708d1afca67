"""Inputs: text lines, ratings facts, dimensions, test-table adapters."""

from ratelens.sources.dimensions import parse_keyed, parse_movies, parse_users
from ratelens.sources.ratings import parse_ratings
from ratelens.sources.text_lines import line_position, read_lines

__all__ = ["parse_keyed", "parse_movies", "parse_users", "parse_ratings",
           "line_position", "read_lines"]
