"""Launcher for the command-line jobs: ``spark-submit run_job.py <job> ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyroute.jobs import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
