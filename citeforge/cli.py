"""``python -m citeforge.cli COMMAND FOLDER [INPUT]``: see ``COMMANDS``."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from citeforge import reports
from citeforge.api import Engine
from citeforge.config import summary
from citeforge.session import build_session
from citeforge.sources.exports import discover


def _check(engine: Engine, _: str) -> list[dict]:
    return engine.validate()


def _report(engine: Engine, path: str) -> object:
    if path.endswith((".json", ".txt")):
        engine.report(path, path.rsplit(".", 1)[1])
        return path
    return engine.reports(path)


#: What each command does with the folder of tables and its input.
COMMANDS: dict[str, Callable[[Engine, str], object]] = {
    "create": lambda e, x: e.build(discover(x)),  # exports to tables
    "add": lambda e, x: e.add(discover(x)),  # further exports
    "recover": lambda e, x: e.recover_dois(e.spark.read.parquet(x)),  # missing DOIs from a table of works
    "link": lambda e, x: e.link_patents(e.spark.read.parquet(x)),  # a table of patent records to the papers
    "resume": lambda e, x: e.link_patents(e.spark.read.parquet(x), resume=True),  # only papers not linked yet
    "analyse": lambda e, _: {n: reports.rows(d) for n, d in e.innovation().items()},  # the linked patents
    "check": _check,
    "info": lambda e, _: e.info(),
    "report": _report,  # one file (.json, .txt) or a folder of all reports
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="citeforge")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("folder", help="where the tables are")
    parser.add_argument("input", nargs="?", default="", help="folder of exports, table to read, or the report's place")
    parser.add_argument("--config")
    args = parser.parse_args(argv)
    engine = Engine(build_session(), args.folder, args.config)
    print(summary(engine.conf), file=sys.stderr)
    result = COMMANDS[args.command](engine, args.input)
    for path, error in engine.failed.items():
        print(f"left out {path}: {error}", file=sys.stderr)
    print(json.dumps(result, indent=2, default=str))
    return int(args.command == "check" and not all(r["passed"] for r in result))


if __name__ == "__main__":
    sys.exit(main())
