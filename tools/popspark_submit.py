"""spark-submit launcher: ``spark-submit --py-files popspark.zip tools/popspark_submit.py <command> ...``."""

import sys

from popspark.__main__ import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
