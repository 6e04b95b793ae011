"""Run a job: ``python -m logweir JOB SOURCE OUT``, or on a cluster
``spark-submit --py-files logweir.zip logweir/__main__.py JOB SOURCE OUT``.
"""

from __future__ import annotations

import argparse

from logweir.plans import access_log, cdn, employees, words
from logweir.session import build_session

JOBS = {
    "cdn": cdn.run,
    "access-log": access_log.run,
    "access-log-all": lambda spark, source, out: access_log.run(spark, source, out, keep_all=True),
    "employees": employees.run,
    "page-views": words.run_page_views,
    "words": words.run,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="logweir")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("source", help="file, folder or glob to read")
    parser.add_argument("out", help="folder to write, which must not exist")
    parser.add_argument("--master", help="Spark master, when not set by spark-submit")
    args = parser.parse_args(argv)
    result = JOBS[args.job](build_session(f"logweir-{args.job}", args.master), args.source, args.out)
    if result is not None:
        print(result)


if __name__ == "__main__":
    main()
