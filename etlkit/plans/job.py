"""Command line entry: ``spark-submit --py-files ... etlkit/plans/job.py --source-table ...``."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from etlkit.plans.etl import EtlJob
from etlkit.session import build_session
from etlkit.sources.tables import MODES, TableStore

logger = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Load one table into another.")
    p.add_argument("--source-table", required=True)
    p.add_argument("--target-table", required=True)
    p.add_argument("--filter-condition", help="SQL condition on the source rows")
    p.add_argument("--mode", choices=MODES, default="overwrite")
    p.add_argument("--partition-by", help="date or timestamp column for daily partitions")
    p.add_argument("--app-name", default="etlkit-job")
    p.add_argument("--required-column", action="append", dest="required_columns")
    return p


def main(argv: Sequence[str] | None = None) -> int:
    """Run the job; 0 on success, 1 on failure."""
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    try:
        store = TableStore(build_session(args.app_name))
        EtlJob(store, args.required_columns or ["id"]).run(
            args.source_table, args.target_table, args.filter_condition, args.mode,
            args.partition_by)
    except Exception as error:
        logger.error("job failed: %s", error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
