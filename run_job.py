"""spark-submit launcher: ``spark-submit run_job.py <command> …`` (see
``marketlake/__main__.py`` for the commands)."""

import sys

from marketlake.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
