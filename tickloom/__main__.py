"""Runs one layer: ``python -m tickloom <step> --base <folder>``."""

from __future__ import annotations

import argparse

from tickloom import build_session
from tickloom.plans import jobs


def source(text: str) -> tuple[str, str]:
    kind, _, path = text.partition("=")
    if kind not in ("lines", "array") or not path:
        raise argparse.ArgumentTypeError("expected lines=<path> or array=<path>")
    return kind, path


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tickloom", description=__doc__)
    parser.add_argument("--base", required=True, help="folder of the stored layers")
    steps = parser.add_subparsers(dest="step", required=True)
    ingest = steps.add_parser("ingest", help="load raw messages")
    ingest.add_argument("--ticks", type=source, action="append", default=[])
    ingest.add_argument("--news", type=source, action="append", default=[])
    ingest.add_argument("--batch", help="a batch loaded again replaces itself")
    clean = steps.add_parser("clean", help="type, deduplicate and name")
    clean.add_argument("--merge-spellings", action="store_true")
    floor = steps.add_parser("correct", help="raise too low prices of an entity")
    floor.add_argument("entity")
    floor.add_argument("price", type=float)
    analyse = steps.add_parser("analyse", help="volatility, trend, alerts, news")
    analyse.add_argument("--known-only", action="store_true")
    models = steps.add_parser("model", help="fit and forecast")
    models.add_argument("--penalty", choices=["mllib", "ridge_sum"], default="mllib")
    steps.add_parser("summary", help="show the main findings")
    report = steps.add_parser("report", help="write the report as one JSON document")
    report.add_argument("out")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.step == "ingest":
        jobs.ingest_raw(spark, args.ticks, args.news, args.base, args.batch)
    elif args.step == "clean":
        jobs.build_clean(spark, args.base, args.merge_spellings)
    elif args.step == "correct":
        jobs.correct_floor(spark, args.base, args.entity, args.price).show()
    elif args.step == "analyse":
        jobs.build_analysis(spark, args.base, args.known_only)
    elif args.step == "model":
        jobs.build_models(spark, args.base, args.penalty)
    elif args.step == "summary":
        for title, table in jobs.summary(spark, args.base).items():
            print(title)
            table.show(truncate=False)
    else:
        jobs.export_report(spark, args.base, args.out)


if __name__ == "__main__":
    main()
