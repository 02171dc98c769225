"""Entry point for spark-submit."""

import sys

from aeroline.plans.job import main

if __name__ == "__main__":
    sys.exit(1 if main() else 0)
