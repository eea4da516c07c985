"""Command line: python -m spanloom.cli get-year 200 --corpus DIR. The corpus folder holds Parquet tables segments, annotations, chapters and roster."""

from __future__ import annotations

import argparse
import json
import sys

COMMANDS = {
    "list-chapters": (["--work", "--book"], []),
    "get-chapter": ([], ["doc"]),
    "get-segment": ([], ["seg_id"]),
    "search-text": (["--work", "--book", "--limit"], ["query"]),
    "list-persons": (["--limit", "--min-mentions", "--name-contains", "--alive-in-year"], []),
    "get-person": ([], ["person_id"]),
    "find-mentions": (["--limit"], ["person_id"]),
    "resolve-name": (["--context-chapter"], ["name"]),
    "statistics": ([], []),
    "get-year": (["--work"], ["year"]),
    "list-years": (["--first", "--last"], []),
    "resource": ([], ["uri"]),
}
#: Batch jobs of plans.jobs and their places on the command line; the first is the folder they work on.
JOB_PLACES = {
    "extract-dates": ["folder"], "extract-persons": ["folder"], "extract-bio-subjects": ["folder"], "find-ambiguous": ["folder", "out"], "merge-decisions": ["folder", "decisions"],
    "publish-site": ["folder", "out"], "check": ["root"], "segment-hashes": ["root"],
}
JOB_OPTIONS = {"extract-dates": ["--only"], "extract-persons": ["--only"], "extract-bio-subjects": ["--limit"], "find-ambiguous": ["--only"], "segment-hashes": ["--update"]}
NUMBERS = {"limit", "min_mentions", "alive_in_year", "year", "first", "last"}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="spanloom", description=__doc__)
    subs = out.add_subparsers(dest="command", required=True)
    for name, (options, places) in COMMANDS.items():
        sub = subs.add_parser(name)
        sub.add_argument("--corpus", required=True)
        sub.add_argument("--output", choices=["json", "text"], default="json")
        for p in places:
            sub.add_argument(p, type=int if p in NUMBERS else str)
        for o in options:
            sub.add_argument(o, type=int if o[2:].replace("-", "_") in NUMBERS else str)
    for name, places in JOB_PLACES.items():
        sub = subs.add_parser(name)
        sub.add_argument("--output", choices=["json", "text"], default="json")
        for p in places:
            sub.add_argument(p)
        for o in JOB_OPTIONS.get(name, []):
            sub.add_argument(o, type=int if o == "--limit" else str, nargs="+" if o == "--only" else None)
    return out


def main(argv: list[str] | None = None, spark=None) -> int:
    from pyspark.sql import SparkSession

    from .plans.service import Corpus, QueryError

    args = vars(parser().parse_args(argv))
    command, folder, output = args.pop("command"), args.pop("corpus", None), args.pop("output")
    spark = spark or SparkSession.builder.getOrCreate()
    if command in JOB_PLACES:
        from .plans.jobs import JOBS

        rows = JOBS[command](spark, **{k: v for k, v in args.items() if v is not None}).collect()
        for row in rows:
            print(json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str) if output == "json" else "\t".join(map(str, row)))
        return 1 if command == "check" and rows else 0
    corpus = Corpus(*(spark.read.parquet(f"{folder}/{t}") for t in ("segments", "annotations", "chapters", "roster")))
    try:
        rows = getattr(corpus, command.replace("-", "_"))(**{k: v for k, v in args.items() if v is not None})
        for row in rows.toLocalIterator():
            got = row.asDict(recursive=True)
            print(json.dumps(got, ensure_ascii=False, default=str) if output == "json" else "\t".join(map(str, got.values())))
        return 0
    except QueryError as e:
        print(json.dumps(e.envelope(), ensure_ascii=False), file=sys.stderr)
        return 2
    except Exception as e:  # noqa: BLE001  an answer is rows or an envelope
        print(json.dumps(QueryError("internal", f"{type(e).__name__}: {str(e)[:200]}").envelope(), ensure_ascii=False), file=sys.stderr)
        return 3


if __name__ == "__main__":
    sys.exit(main())
