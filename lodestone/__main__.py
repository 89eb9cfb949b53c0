"""Command line: ``python -m lodestone list`` and ``run NAME --data DIR [--out PATH]``."""

from __future__ import annotations

import argparse

from lodestone.plans.queries import QUERIES
from lodestone.session import build_session, clean


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lodestone", description="Run named queries over a folder of Parquet tables.")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all queries")
    run = commands.add_parser("run", help="run one query")
    run.add_argument("name", choices=sorted(QUERIES))
    run.add_argument("--data", required=True, help="folder with <table>.parquet")
    run.add_argument("--out", help="where to write Parquet; without it, the first rows are printed")
    run.add_argument("--rows", type=int, default=20, help="rows to print")
    given = parser.parse_args(arguments)
    if given.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = build_session(f"lodestone {given.name}")
    result = QUERIES[given.name](spark, given.data)
    if given.out:
        result.write.mode("errorifexists").parquet(given.out)
    else:
        result.show(given.rows, truncate=80)
    clean(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
