"""spark-submit launcher: ``spark-submit --py-files fuelsight.zip run_job.py daily --signals ... --out ...``."""

import sys

from fuelsight.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
