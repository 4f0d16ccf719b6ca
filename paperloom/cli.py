"""python -m paperloom.cli COMMAND: the stages of a corpus from the command line."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from paperloom.config import load_config
from paperloom.plans.pipeline import Corpus

COMMANDS = {
    "init-data": "Create the folders and an example manifest.",
    "scan-pdfs": "Add rows for new files to the manifest and fill known ones.",
    "validate-manifest": "Check file names, metadata, hashes and duplicates.",
    "preflight-pdfs": "Inspect the files before conversion.",
    "process": "Convert the files into Markdown and JSON.",
    "chunk": "Make chunks of the converted papers.",
    "report": "Write the quality report.",
    "defense-prep": "Write overview and term indexes.",
    "export-llm": "Write packs and rows for retrieval.",
    "build-index": "Make or update the vector index.",
    "query": "Search the vector index.",
    "run-all": "All stages from init-data to export-llm.",
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="paperloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    for name, text in COMMANDS.items():
        one = commands.add_parser(name, help=text)
        one.add_argument("--config", "-c", default="config/config.yaml")
        if name == "init-data":
            one.add_argument("--force-manifest", action="store_true")
        if name == "query":
            one.add_argument("question")
            one.add_argument("--n-results", type=int, choices=range(1, 21), default=5, metavar="1..20")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    asked = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("paperloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    stage = getattr(Corpus(spark, load_config(asked.config)), asked.command.replace("-", "_"))
    extra = {"init-data": lambda: {"force_manifest": asked.force_manifest}, "query": lambda: {"question": asked.question, "n_results": asked.n_results}}
    done = stage(**extra.get(asked.command, dict)())
    print(*done.messages, sep="\n")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
