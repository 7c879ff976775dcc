"""Command line: build a graph, validate it, repair it."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .operators import repairs, report
from .plans import guide, pipeline, project, store
from .session import session


def is_local(target: str) -> bool:
    return "://" not in target or target.startswith("file:") or "localhost" in target or "127.0.0.1" in target


def confirm(target: str, ask=input) -> None:
    """Ask before work on a target that is not local; a refusal ends with 0, no answer with 1."""
    if is_local(target):
        return
    try:
        answer = ask(f"{target} is not local. Go on? [y/N] ")
    except EOFError:
        sys.exit(1)
    if answer.strip().lower() not in ("y", "yes"):
        sys.exit(0)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="kgloom")
    sub = out.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build", help="project tables to a graph and clean it up")
    build.add_argument("tables")
    build.add_argument("-o", "--output", required=True)
    build.add_argument("--full", action="store_true", help="repair and validate too")
    build.add_argument("--dry-run", action="store_true")
    build.add_argument("--resume", action="store_true", help="go on from the last whole stage")
    pages = sub.add_parser("pages", help="build a graph from a table of pages and one of terms")
    pages.add_argument("pages", help="Parquet with page_id, url, html")
    pages.add_argument("--terms", required=True, help="Parquet with label, name, definition")
    pages.add_argument("-o", "--output", required=True)
    pages.add_argument("--full", action="store_true", help="repair and validate too")
    pages.add_argument("--resume", action="store_true", help="go on from the last whole stage")
    sub.add_parser("status", help="list the versions of a graph").add_argument("graph")
    promote = sub.add_parser("promote", help="make a whole version the current one")
    promote.add_argument("graph")
    promote.add_argument("version")
    check = sub.add_parser("validate", help="check a graph and write a report")
    check.add_argument("graph")
    check.add_argument("--version", default="clean")
    check.add_argument("-o", "--output", default="validation_report.md")
    check.add_argument("--fix", action="store_true")
    check.add_argument("--fix-chunk-ids", action="store_true")
    check.add_argument("--fix-entities", action="store_true")
    check.add_argument("--dry-run", action="store_true")
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    if args.command == "build":
        confirm(args.output)
        graph = project.graph(spark, args.tables)
        if args.dry_run:
            repairs.preview(graph).show(truncate=False)
            return 0
        pipeline.run(graph, args.output, args.full, args.resume).show(truncate=False)
        return 0
    if args.command == "pages":
        confirm(args.output)
        terms = spark.read.parquet(args.terms)
        held = store.Store(spark, args.output)
        if args.resume and "raw" in held.versions():
            graph = held.load("raw")
        else:
            glossary = terms.where("definition is not null").select(F.col("name").alias("term"), "definition")
            graph = guide.from_pages(spark.read.parquet(args.pages), guide.dictionary(terms), glossary=glossary).graph
        pipeline.run(graph, args.output, args.full, args.resume).show(truncate=False)
        return 0
    held = store.Store(spark, args.graph)
    if args.command == "status":
        for version, whole, current in held.status():
            print(f"{version}  {'whole' if whole else 'not whole'}{'  current' if current else ''}")
        return 0
    confirm(args.graph)
    if args.command == "promote":
        held.promote(args.version)
        return 0
    graph = held.load(args.version)
    chosen = repairs.ALL if args.fix else [*(repairs.CHUNKS_ONLY if args.fix_chunk_ids else []), *(repairs.ENTITIES_ONLY if args.fix_entities else [])]
    if chosen and args.dry_run:
        repairs.preview(graph).show(truncate=False)
    elif chosen:
        held.forget(["repaired"])
        graph = held.save("repaired", repairs.apply(graph, chosen))
    summary, text = report.generate(graph)
    report.save(text, args.output)
    return 0 if all(r["ok"] for r in summary.where("required").collect()) else 2


if __name__ == "__main__":
    sys.exit(main())
