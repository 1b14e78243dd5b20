"""Command line: the menu entries and the standalone jobs.

    python -m trendstats categories CATEGORIES_JSON
    python -m trendstats [--explain] menu CHOICE INPUT CATEGORIES_JSON --ids 10,24 [--k 10] [--year 2018] --out DIR
    python -m trendstats menu CHOICE STATE CATEGORIES_JSON --state --named ...   # stored rollup, files of exact names
    python -m trendstats merge-batch BATCH INPUT STATE [--buckets 1024]
    python -m trendstats route INPUT OUT                                          # accepted and rejected rows
    python -m trendstats views-count INPUT OUT [--categories JSON]
    python -m trendstats likes-count INPUT OUT [--categories JSON]
    python -m trendstats views-sort INPUT OUT [--categories JSON]
    python -m trendstats category-count INPUT [--categories JSON]
    python -m trendstats topk-views K INPUT OUT
    python -m trendstats topk-likes K INPUT OUT
    python -m trendstats date-range RANGE INPUT OUT [--as-of YYYY-MM-DD]
    python -m trendstats filter-by-category ID INPUT OUT
    python -m trendstats stream-totals INPUT_DIR OUT CHECKPOINT [--once] [--every "1 minute"]

INPUT is a CSV file, directory or glob; ``--mode line`` selects the
line-exact parser. Counts and summaries (a row per category at most) are
shown whole; everything else goes only to OUT.
"""

from __future__ import annotations

import argparse
import sys

from trendstats.schema import FOCUS_IDS, TRENDING_DATE_FORMAT
from trendstats.session import get_session


def _ids(text: str | None):
    if text is None:
        return None
    return [int(x) for x in text.split(",") if x.strip()]


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="trendstats")
    p.add_argument("--master", default=None)
    p.add_argument("--mode", default="csv", choices=["csv", "line"])
    p.add_argument("--date-format", default=TRENDING_DATE_FORMAT, help="pattern of the trending date")
    p.add_argument("--explain", action="store_true", help="print the formatted plan of a menu entry instead of running it")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("categories")
    s.add_argument("categories")
    s.add_argument("--ids", default=None, help="show the chosen ids: known ones numbered, unknown ones listed")

    s = sub.add_parser("menu")
    s.add_argument("choice", type=int)
    s.add_argument("input")
    s.add_argument("categories")
    s.add_argument("--ids", default="0")
    s.add_argument("--k", type=int, default=None)
    s.add_argument("--year", type=int, default=2018)
    s.add_argument("--out", default=None)
    s.add_argument("--state", action="store_true", help="INPUT is a stored rollup (merge-batch)")
    s.add_argument("--named", action="store_true", help="write files of exact names, as one commit")

    s = sub.add_parser("merge-batch")
    s.add_argument("batch", help="name of the batch, say its day; merged once")
    s.add_argument("input")
    s.add_argument("state")
    s.add_argument("--buckets", type=int, default=1024)

    s = sub.add_parser("route")
    s.add_argument("input")
    s.add_argument("out")

    focus = ",".join(str(i) for i in FOCUS_IDS)
    for name in ("views-count", "likes-count", "views-sort"):
        s = sub.add_parser(name)
        s.add_argument("input")
        s.add_argument("out")
        s.add_argument("--categories", default=None)
        s.add_argument("--ids", default=focus)

    s = sub.add_parser("category-count")
    s.add_argument("input")
    s.add_argument("--categories", default=None)
    s.add_argument("--ids", default=focus)

    for name in ("topk-views", "topk-likes"):
        s = sub.add_parser(name)
        s.add_argument("k", type=int)
        s.add_argument("input")
        s.add_argument("out")
        s.add_argument("--ids", default=focus)

    s = sub.add_parser("date-range")
    s.add_argument("range")
    s.add_argument("input")
    s.add_argument("out")
    s.add_argument("--as-of", default=None)
    s.add_argument("--ids", default=focus)

    s = sub.add_parser("stream-totals")
    s.add_argument("input_dir")
    s.add_argument("out")
    s.add_argument("checkpoint")
    s.add_argument("--ids", default=focus)
    s.add_argument("--once", action="store_true", help="process the files present, then stop")
    s.add_argument("--every", default="1 minute", help="trigger interval when running continuously")

    s = sub.add_parser("filter-by-category")
    s.add_argument("category_id", type=int)
    s.add_argument("input")
    s.add_argument("out")
    return p


def main(argv: list[str] | None = None, stop: bool = True) -> int:
    args = build_parser().parse_args(argv)
    spark = get_session(master=args.master)
    from trendstats import operators as op
    from trendstats.operators import incremental
    from trendstats.plans import jobs, menu
    from trendstats.sources import read_categories

    def show(df, rows: int) -> None:
        """Print a result that has at most ``rows`` rows, all of them."""
        df.show(max(1, rows), truncate=False)

    options = {"mode": args.mode, "trending_date_format": args.date_format}
    ids = _ids(getattr(args, "ids", None))
    if args.cmd == "categories":
        cats = read_categories(spark, args.categories)
        if ids:
            show(op.selected_categories(spark, ids, cats), len(ids))
            show(op.unknown_categories(spark, ids, cats), len(ids))
        else:
            show(op.list_categories(cats), cats.count())
    elif args.cmd == "menu" and args.explain:
        from trendstats.sources import read_trending

        cats = read_categories(spark, args.categories)
        videos = incremental.read_videos(spark, args.input) if args.state else op.rollup_videos(read_trending(spark, args.input, **options))
        menu.menu_query(spark, args.choice, videos, cats, ids, args.k, args.year).explain("formatted")
    elif args.cmd == "menu":
        if args.out is None and args.choice != 2:
            print("this entry needs --out: its result may be large", file=sys.stderr)
            return 2
        df = menu.run_menu(
            spark, args.choice, args.input, args.categories, ids, args.out, args.k, args.year,
            state=args.state, named=args.named, **options,
        )
        if args.choice == 2:
            show(df, len(ids) if ids and ids != [0] else read_categories(spark, args.categories).count())
    elif args.cmd == "merge-batch":
        from trendstats.sources import read_trending

        touched = incremental.merge_batch(spark, args.state, read_trending(spark, args.input, **options), args.batch, args.buckets)
        print(f"{args.batch}: {len(touched)} buckets written")
    elif args.cmd == "route":
        from trendstats.schema import METRICS
        from trendstats.sinks import write_routed
        from trendstats.sources import read_trending

        for name, n in write_routed(read_trending(spark, args.input, **options), args.out, METRICS, need_date=True).items():
            print(f"{name}: {n}")
    elif args.cmd == "views-count":
        show(jobs.views_count(spark, args.input, args.out, args.categories, ids, **options), 1)
    elif args.cmd == "likes-count":
        show(jobs.likes_count(spark, args.input, args.out, args.categories, ids, **options), 1)
    elif args.cmd == "views-sort":
        show(jobs.views_sort(spark, args.input, args.out, args.categories, ids, **options), 1)
    elif args.cmd == "category-count":
        counts, summary = jobs.category_count(spark, args.input, args.categories, ids, **options)
        show(counts, len(ids))
        show(summary, 1)
    elif args.cmd in ("topk-views", "topk-likes"):
        metric = args.cmd.split("-")[1]
        show(jobs.topk_records(spark, metric, args.k, args.input, args.out, ids, **options), len(ids) + 1)
    elif args.cmd == "date-range":
        show(jobs.date_range(spark, args.range, args.input, args.out, args.as_of, ids, **options), len(ids) + 1)
    elif args.cmd == "stream-totals":
        from trendstats.streaming import start_category_totals

        query = start_category_totals(
            spark, args.input_dir, args.out, args.checkpoint, ids,
            available_now=args.once, processing_time=None if args.once else args.every,
        )
        query.awaitTermination()
    elif args.cmd == "filter-by-category":
        show(jobs.filter_by_category(spark, args.category_id, args.input, args.out, **options), 1)
    if stop:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
