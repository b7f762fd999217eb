"""Command line: ``python -m chronolex prepare|train|all|publish|label|check CONFIG [...]``; CONFIG is a JSON file of ``lifecycle.Run``'s settings."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from chronolex.operators.labels import FileLabeler
from chronolex.plans import lifecycle
from chronolex.sources import readers, writers


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="chronolex", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    for name in ("prepare", "train", "all", "publish"):
        step = steps.add_parser(name)
        step.add_argument("config", help="settings as JSON, on any Hadoop path")
        if name in ("train", "all"):
            step.add_argument("--answers", nargs="*", default=[], help="files with label answers, one for each batch")
        if name == "publish":
            step.add_argument("target")
    label = steps.add_parser("label", help="label the descriptions of an existing model")
    label.add_argument("descriptions")
    label.add_argument("out")
    label.add_argument("--answers", nargs="+", required=True)
    label.add_argument("--terms", type=int, default=50)
    label.add_argument("--batch-size", type=int)
    steps.add_parser("check", help="check the environment")
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName("chronolex").getOrCreate()
    if given.step == "check":
        print(json.dumps(lifecycle.check_environment(spark)))
        return 0
    if given.step == "label":
        lifecycle.label(spark, given.descriptions, given.out, FileLabeler(spark, *given.answers), given.terms, given.batch_size)
        return 0
    run = lifecycle.Run(**writers.read_json(spark, given.config))
    if not readers.listing(spark, run.inputs, run.prefix, run.suffix):
        parser.error("no input files")
    if given.step in ("prepare", "all"):
        lifecycle.prepare(spark, run)
    if given.step in ("train", "all"):
        lifecycle.train(spark, run, FileLabeler(spark, *given.answers) if given.answers else None)
    if given.step == "publish":
        lifecycle.publish(spark, run, given.target)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
