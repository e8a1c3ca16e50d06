"""spark-submit entry of the gated daily job (ship the package with --py-files).

    spark-submit --py-files vacanta.zip daily_job.py --bronze B --silver S --gold G
"""

from vacanta.plans.daily import main

if __name__ == "__main__":
    raise SystemExit(main())
