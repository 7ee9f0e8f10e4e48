"""spark-submit launcher for the pipeline command line.

    spark-submit --py-files fleetframe.zip submit.py run --source <dir> --root <dir>

(``fleetframe.zip``: ``zip -r fleetframe.zip fleetframe``.)  Same arguments
as ``python -m fleetframe``.
"""

from fleetframe.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
