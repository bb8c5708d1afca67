"""ratelens: ratings reports as Spark DataFrame plans.

Layers:

* ``functions`` - column expressions with the exact text/number rules of the
  reports (whitespace trim, field split, tolerant number parsing, 0.00 format).
* ``sources``   - text and parquet ingest: ratings facts, movie and user
  dimensions (last valid line wins), and adapters from the test tables.
* ``operators`` - joins (size-checked broadcast, salted shuffle join for hot
  keys), aggregates, token explode, top-1, distributed ordinal positions.
* ``plans``     - the four reports (typed and rendered) and the text sink.
* ``streaming`` - the same parse and per-item aggregation on a file stream.

Every public function takes and returns DataFrames; nothing is collected on
the driver except bounded scalars (a size check, a bounded hot-key list).
"""

from ratelens.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
