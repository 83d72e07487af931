"""Command line for the layer jobs (run with spark-submit or python -m lakemart).

    python -m lakemart bronze  --source user_info1=feed1.csv --source user_info2=feed2.csv --out /data/raw
    python -m lakemart silver  --info /data/raw/user_info1 --activity /data/raw/user_info2 --out /data/silver/user_info_cleaned
    python -m lakemart gold    --silver /data/silver/user_info_cleaned --returns /data/gold/predictive_returns
    python -m lakemart page    --mart /data/gold/predictive_returns --page 1 --page-size 50
    python -m lakemart report  --mart /data/gold/predictive_returns
    python -m lakemart split   --input wide.csv --left feed1.csv --right feed2.csv --id user_id --id last_purchase_date
    python -m lakemart wordcount --input /input --output /output

The master, shuffle partitions and checkpoint folder come from the submit
configuration; nothing is hard-coded.
"""

from __future__ import annotations

import argparse
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakemart")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("bronze", help="dated CSV feeds -> date-partitioned Parquet (append)")
    b.add_argument("--source", action="append", required=True, help="name=path, repeatable")
    b.add_argument("--out", required=True, help="bronze root; one dataset per source name")
    b.add_argument("--date-column", default="last_purchase_date")
    b.add_argument("--schema", default=None,
                   help="DDL of the feed columns (skips the type-inference pass over the data)")
    s = sub.add_parser("silver", help="join, validate, rank, mean, dedup, normalise")
    s.add_argument("--info", required=True)
    s.add_argument("--activity", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--key", default="user_id")
    s.add_argument("--rank-method", choices=["ranged", "window"], default="ranged")
    s.add_argument("--start", default=None, help="first silver day to rewrite (yyyy-MM-dd)")
    s.add_argument("--end", default=None, help="last silver day to rewrite (yyyy-MM-dd)")
    s.add_argument("--dedup-first", action="store_true", help="one row per user before the rank")
    s.add_argument("--income-scale", type=int, default=None,
                   help="decimals of income_level; takes the global mean from an exact sum")
    g = sub.add_parser("gold", help="segmentation table + returns Parquet mart")
    g.add_argument("--silver", required=True)
    g.add_argument("--returns", required=True)
    g.add_argument("--database", default="gold")
    g.add_argument("--database-location", default=None, help="location when the database is created")
    g.add_argument("--segmentation-path", default=None,
                   help="store the segmentation table as an external table at this path")
    pg = sub.add_parser("page", help="one page of a mart as JSON")
    pg.add_argument("--mart", required=True)
    pg.add_argument("--page", type=int, default=1)
    pg.add_argument("--page-size", type=int, default=50)
    pg.add_argument("--page-size-max", type=int, default=200)
    r = sub.add_parser("report", help="age profile over the whole mart as JSON")
    r.add_argument("--mart", required=True)
    sp = sub.add_parser("split", help="one wide CSV -> two CSV that share the id columns")
    sp.add_argument("--input", required=True)
    sp.add_argument("--left", required=True)
    sp.add_argument("--right", required=True)
    sp.add_argument("--id", action="append", required=True, help="id column, repeatable")
    sp.add_argument("--seed", type=int, default=42)
    w = sub.add_parser("wordcount", help="text files -> word<TAB>count lines")
    w.add_argument("--input", required=True)
    w.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from lakemart.session import build_session
    _run(build_session(app_name=f"lakemart-{args.job}"), args)
    return 0


def _run(spark, args) -> None:
    if args.job == "bronze":
        from lakemart.plans.bronze import load_feeds
        sources = dict(item.split("=", 1) for item in args.source)
        print(json.dumps(load_feeds(spark, sources, args.out, args.date_column, args.schema)))
    elif args.job == "silver":
        from lakemart.plans.silver import build_silver
        build_silver(spark, args.info, args.activity, args.out, key=args.key, rank_method=args.rank_method,
                     income_scale=args.income_scale, start=args.start, end=args.end, dedup_first=args.dedup_first)
    elif args.job == "gold":
        from lakemart.plans.gold import build_gold
        build_gold(spark, args.silver, args.returns, args.database,
                   db_location=args.database_location, segmentation_path=args.segmentation_path)
    elif args.job == "page":
        from lakemart.plans.serve import page_response
        print(json.dumps(page_response(spark, args.mart, args.page, args.page_size,
                                       page_size_max=args.page_size_max), default=str))
    elif args.job == "report":
        from lakemart.plans.serve import age_report
        mart = spark.read.parquet(args.mart)
        print(json.dumps({k: [r.asDict() for r in v.collect()] for k, v in age_report(mart).items()},
                         default=str))
    elif args.job == "split":
        from lakemart.plans.split import split_csv
        split_csv(spark, args.input, args.left, args.right, args.id, args.seed)
    elif args.job == "wordcount":
        from lakemart.plans.wordcount import run_word_count
        run_word_count(spark, args.input, args.output)


if __name__ == "__main__":
    sys.exit(main())
