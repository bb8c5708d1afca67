"""Launcher for spark-submit: the command line of ``ratelens.__main__``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratelens.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
