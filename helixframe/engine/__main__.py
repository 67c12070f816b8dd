"""Command line: ``python -m helixframe.engine parse|prep|cluster|shards|merge|report``."""

from __future__ import annotations

import argparse
import pathlib
import sys

from pyspark.sql import SparkSession

from helixframe.engine import cluster, documents, parse
from helixframe.engine.settings import from_toml
from helixframe.operators import scheduling
from helixframe.sources import attempts, bundles, inputs


def arguments(argv: list[str]) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="helixframe.engine", description="Structure files to tables, and tables to clusters.")
    top.add_argument("--config", help="TOML file with the tables settings and clustering")
    top.add_argument("--set", action="append", default=[], metavar="TABLE.NAME=VALUE", help="a setting over the file's")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, about in (("parse", "structure files of a folder to tables"), ("prep", "case documents, or the target of a parse run, to prep tables"), ("cluster", "prep tables to clusters")):
        job = jobs.add_parser(name, help=about)
        job.add_argument("source")
        job.add_argument("target")
        if name == "parse":
            job.add_argument("--resume", action="store_true")
        if name == "cluster":
            job.add_argument("--run", help="the target of the parse run whose atoms the structures are taken from")
    shards = jobs.add_parser("shards", help="files of a folder in shards of like size")
    shards.add_argument("source")
    shards.add_argument("target")
    shards.add_argument("--count", type=int, default=1)
    merge = jobs.add_parser("merge", help="the targets of runs over shards as one")
    merge.add_argument("target")
    merge.add_argument("sources", nargs="+")
    report = jobs.add_parser("report", help="the summary of a finished run")
    report.add_argument("source")
    return top.parse_args(argv)


def overrides(given: list[str]) -> dict:
    """``settings.model=2`` and the like, values as TOML."""
    import tomllib

    out: dict = {}
    for item in given:
        name, _, value = item.partition("=")
        table, _, key = name.partition(".")
        try:
            out.setdefault(table, {})[key] = tomllib.loads(f"x = {value}")["x"]
        except tomllib.TOMLDecodeError:
            out.setdefault(table, {})[key] = value
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """One job; 0 if all of it succeeded."""
    args = arguments(sys.argv[1:] if argv is None else argv)
    text = pathlib.Path(args.config).read_text(encoding="utf-8") if args.config else ""
    parsing, clustering = from_toml(text, overrides(args.set))
    spark = spark or SparkSession.builder.appName("helixframe").getOrCreate()
    if args.job == "parse":
        summary = parse.run(spark, args.source, args.target, parsing, resume=args.resume)["summary"].first()
        print(summary.asDict())
        return int(summary["failure_count"] > 0)
    if args.job == "prep":
        made = attempts.Attempts(spark, args.source).commits()
        source = documents.cases(parse.tables_of(spark, args.source), parsing.assembly_mode) if made else args.source
        print(bundles.build_prep(spark, source, args.target))
    elif args.job == "cluster":
        atoms = documents.atoms(parse.tables_of(spark, args.run)) if args.run else None
        print({name: rows.count() for name, rows in cluster.run(spark, args.source, args.target, clustering, atoms=atoms).items()})
    elif args.job == "merge":
        print(parse.merged_shards(spark, args.sources, args.target)["summary"].first().asDict())
    elif args.job == "shards":
        scheduling.shard_plan(inputs.expanded(spark, args.source), args.count).write.mode("overwrite").partitionBy("shard").text(args.target)
    else:
        print(parse.rebuilt(spark, args.source).first().asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main())
