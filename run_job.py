"""Entry point for spark-submit; see ``clickmart/jobs.py``."""

from clickmart.jobs import main

if __name__ == "__main__":
    main()
