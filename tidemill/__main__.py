"""Command line: run a declared flow, ask SQL of tables, or list what tables hold.

    python -m tidemill run flow.yml --warehouse s3a://lake/tables --checkpoint s3a://lake/checkpoints
    python -m tidemill query "SELECT COUNT(*) FROM market" --table market=s3a://lake/market
    python -m tidemill overview --table market=s3a://lake/market --table news=s3a://lake/news
"""

from __future__ import annotations

import argparse
from pathlib import Path

from .functions.text import register_functions
from .operators.overview import overview
from .plans.flow import run_flow
from .session import build_session
from .sinks.files import stdout_pretty
from .sources.tables import parquet_scan


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemill")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run a flow")
    run.add_argument("flow", type=Path)
    run.add_argument("--warehouse", help="folder the landed tables go under")
    run.add_argument("--checkpoint", help="folder the streams keep their progress in")
    run.add_argument("--every", help="trigger interval; without it topics are drained and the run ends")
    for name, text in (("query", "run SQL over tables"), ("overview", "count and list tables")):
        command = commands.add_parser(name, help=text)
        if name == "query":
            command.add_argument("sql")
        command.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
        command.add_argument("--rows", type=int, default=20, help="rows to print")
    return parser


def main(argv: list[str] | None = None) -> None:
    options = arguments().parse_args(argv)
    spark = build_session()
    if options.command == "run":
        done = run_flow(
            spark, options.flow, warehouse=options.warehouse, checkpoint=options.checkpoint, every=options.every
        )
        done["finish"]()
        return
    tables = {}
    for pair in options.table:
        name, path = pair.split("=", 1)
        tables[name] = parquet_scan(spark, path, view=name)
    if options.command == "query":
        register_functions(spark)
        stdout_pretty(spark.sql(options.sql), options.rows)
    else:
        stdout_pretty(overview(tables), options.rows)


if __name__ == "__main__":
    main()
