"""spark-submit entry: ``spark-submit --py-files audience_engine.zip run_job.py --plays ... --out ...``."""

from audience_engine.__main__ import main

if __name__ == "__main__":
    main()
