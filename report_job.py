"""Script for spark-submit: `spark-submit report_job.py -i INPUT [-o OUT_DIR]`."""

from lexiband.__main__ import main

main()
