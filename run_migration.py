"""Launcher for spark-submit:

    spark-submit --py-files registrar.zip run_migration.py \
        --input /shared/dumps/2021-06 --dims /shared/target-dims --target /shared/target
"""

import sys

from registrar.cli import main

if __name__ == "__main__":
    sys.exit(main())
