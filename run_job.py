"""For ``spark-submit --py-files contrail.zip run_job.py publish|land|process``."""

from contrail.jobs import main

main()
