"""Command line: ``python -m paytrail.cli evidence --profile smoke --output FOLDER``."""

from __future__ import annotations

import argparse
import json
import os
import sys

from . import session
from .plans import evidence

KEY_VARIABLE = "PAYTRAIL_TOKEN_KEY"


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="paytrail")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("evidence", help="generate payments, take them in, and check every failure scenario")
    run.add_argument("--profile", choices=sorted(evidence.PROFILES), default="smoke")
    run.add_argument("--output", required=True)
    run.add_argument("--master", default=None)
    run.add_argument("--registry", default=None, help="source registry, JSON; the shipped one if not given")
    run.add_argument("--rules", default=None, help="posting rules, JSON; the shipped ones if not given")
    use = parser.parse_args(args)
    key = os.environ.get(KEY_VARIABLE, "").encode()
    if len(key) < 32:
        print(f"{KEY_VARIABLE} must hold at least 32 bytes", file=sys.stderr)
        return 2
    spark = session.build(use.master)
    session.require(spark)
    summary = evidence.run(spark, use.profile, os.path.abspath(use.output) if "://" not in use.output else use.output, key, registry_file=use.registry, rules_file=use.rules)
    print(json.dumps({k: summary[k] for k in ("profile", "records_per_second", "scenarios_passed", "sealed_sha256")}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
