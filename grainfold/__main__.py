"""``python -m grainfold JOB ARGUMENT... [--option value]``: run one job."""

from __future__ import annotations

import argparse
import inspect
import typing

from pyspark.sql import SparkSession

from grainfold.plans import jobs
from grainfold.session import drop_written

JOBS = {
    name.replace("_", "-"): job
    for name, job in vars(jobs).items()
    if inspect.isfunction(job) and job.__module__ == jobs.__name__ and not name.startswith("_")
}


def parser() -> argparse.ArgumentParser:
    """One subcommand per job; parameters with a default become options."""
    top = argparse.ArgumentParser(prog="grainfold")
    commands = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=(job.__doc__ or name).strip())
        hints = typing.get_type_hints(job)
        for parameter in list(inspect.signature(job).parameters.values())[1:]:
            kinds = [k for k in (typing.get_args(hints[parameter.name]) or [hints[parameter.name]])
                     if k is not type(None)]
            if parameter.default is parameter.empty:
                command.add_argument(parameter.name, type=kinds[0])
            else:
                option = "--" + parameter.name.replace("_", "-")
                command.add_argument(option, type=kinds[0], default=parameter.default)
    return top


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    """Run the job that the arguments name, in a session of the caller."""
    options = vars(parser().parse_args(arguments))
    JOBS[options.pop("job")](spark, **options)


def main(arguments: list[str] | None = None) -> None:
    parser().parse_args(arguments)  # wrong arguments end before a session starts
    spark = SparkSession.builder.appName("grainfold").getOrCreate()
    try:
        run(spark, arguments)
    finally:
        drop_written(spark)


if __name__ == "__main__":
    main()
