"""spark-submit launcher: ``spark-submit run_job.py {ingest|refresh|report} ...``.

The driver imports the package from this folder; executors need no copy of
it (the only Python that runs in tasks is shipped with the query).
"""

from cardlake.plans.cli import main

if __name__ == "__main__":
    main()
