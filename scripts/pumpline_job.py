"""Launcher for spark-submit:

  spark-submit --py-files pumpline.zip scripts/pumpline_job.py build --raw RAW --out OUT
"""

import sys

from pumpline.__main__ import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
