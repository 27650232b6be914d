"""Launcher for spark-submit (which runs a file, not a module):

    spark-submit --py-files pipewright.zip tools/cli.py run --sources s3://bucket/sources --out s3://bucket/tables
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pipewright.__main__ import main  # noqa: E402

if __name__ == "__main__":
    raise SystemExit(main())
