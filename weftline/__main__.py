"""Command line.

``transform NAME IN OUT`` shapes a dump; ``demo IN OUT`` keeps a demonstration set of plans of one organisation; ``index IN OUT`` builds the works
index from shaped tables; ``match INDEX PLANS OUT`` links plans to works by weighted entities; ``search INDEX PLANS OUT`` ranks works by
the clauses of a search and writes one document a plan; ``versions MATCHES OUT`` extracts the works among matches; ``audit TABLE`` counts
what breaks the rules of a table with a DOI.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from weftline.operators import audit, index, match, normalise, searching
from weftline.sources import readers, registries, sinks


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="weftline", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for each in positional:
            p.add_argument(each)
        return p

    command("transform", "name", "source", "target")._actions[1].choices = sorted(registries.TRANSFORMS)
    demo = command("demo", "source", "target")
    demo.add_argument("--ror", required=True)
    demo.add_argument("--name", required=True)
    command("index", "source", "target").add_argument("--audit", action="store_true", help="check unique DOIs before the export")
    for name in ("match", "search"):
        p = command(name, "index", "plans", "target")
        p.add_argument("--most", type=int, default=100, help="works of each plan")
        p.add_argument("--threshold", type=int, default=3, help="least weight of a match")
    command("versions", "matches", "target")
    command("audit", "table").add_argument("--rows", type=int, default=0, help="least number of rows")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"weftline {args.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "transform":
        schema, shape = registries.TRANSFORMS[args.name]
        read = readers.json_document if args.name == "ror" else readers.json_lines
        for table, df in shape(read(spark, args.source, schema)).items():
            sinks.export(df, f"{args.target}/{args.name.partition('-')[0]}.{table}")
    elif args.command == "demo":
        raw = readers.json_lines(spark, args.source, registries.PLANS)
        sinks.json_gz(registries.of_institution(raw, F.col("institutions"), args.ror, args.name), args.target)
    elif args.command == "index":
        needed = {n for m in index.MODELS.values() for n in m.needs} - set(index.MODELS)
        tables = {n: spark.read.parquet(f"{args.source}/{n}") for n in sorted(needed)}
        works = index.build(tables, ["works_index.works"], f"{args.target}/models")["works_index.works"]
        if args.audit:
            audit.audited(works, [audit.unique_values("doi")]).show()
        sinks.export(works, f"{args.target}/works")
    elif args.command == "match":
        works, plans = normalise.works(spark.read.parquet(args.index)), normalise.plans(spark.read.parquet(args.plans))
        p = match.entities(plans, ["plan_id", "project_start", "project_end"], normalise.PLAN_KINDS)
        w = match.entities(works, ["work_id", "publication_date"], normalise.WORK_KINDS)
        sinks.json_gz(match.matches_by_plan(match.entity_matches(p, w, threshold=args.threshold, k=args.most)), args.target)
    elif args.command == "search":
        works, plans = searching.prepared_works(spark.read.parquet(args.index)), searching.prepared_plans(spark.read.parquet(args.plans))
        found = searching.related_works(plans, works, k=args.most)
        found.groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("match_rank", "work_id", "score", "score_max"))).alias("works")).write.mode("overwrite").json(args.target)
    elif args.command == "versions":
        sinks.export(sinks.work_versions(spark.read.parquet(args.matches)), args.target)
    else:
        audit.audited(spark.read.parquet(args.table), [audit.number_of_rows(args.rows), audit.unique_values("doi")]).show(truncate=False)


if __name__ == "__main__":
    main()
