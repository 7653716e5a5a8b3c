"""python -m litloom [--config FILE] [--base DIR] [--resume] STEP…: runs steps."""

from __future__ import annotations

import argparse
import logging

from litloom.config import load
from litloom.plans.steps import STEPS, Context, run_steps
from litloom.session import get_session


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="litloom", description="Literature analytics on Spark.")
    parser.add_argument("steps", nargs="+", help=f"all, {', '.join(STEPS)}")
    parser.add_argument("--config", help="a JSON file of settings")
    parser.add_argument("--base", help="the folder that paths start from")
    parser.add_argument("--master", help="the Spark master, where spark-submit doesn't give it")
    parser.add_argument("--resume", action="store_true", help="leave what an earlier run has finished from the same inputs and settings")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.WARNING)
    logging.getLogger("litloom").setLevel(logging.INFO)
    config = load(given.config, **({"base": given.base} if given.base else {}))
    run_steps(Context(get_session(master=given.master, conf=config.session), config, resume=given.resume), given.steps)


if __name__ == "__main__":
    main()
