"""spark-submit entry point for the command line in ``tradelake.__main__``.

    zip -r tradelake.zip tradelake
    spark-submit --py-files tradelake.zip scripts/tradelake_job.py run --source order ...
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelake.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main()
