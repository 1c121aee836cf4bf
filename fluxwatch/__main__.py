"""Command line: ``spark-submit`` or ``python -m fluxwatch <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from fluxwatch.plans import programs


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fluxwatch")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *names: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for n in names:
            sub.add_argument(n)
        return sub

    job("train", "data", "out")
    job("bandwidth", "packets", "out")
    job("series-models", "series", "out")
    job("convert", "packets", "out").add_argument("--by-label", action="store_true")
    export = job("export-flows", "folder")
    export.add_argument("--servers")
    export.add_argument("--out")
    for sub in (job("detect", "source", "out"), job("score", "source", "model", "out")):
        sub.add_argument("--topic", help="read this topic; source then names the servers")
        sub.add_argument("--once", action="store_true", help="process what is there and stop")
    return parser


def main() -> None:
    given = arguments().parse_args()
    spark = SparkSession.builder.appName(f"fluxwatch-{given.job}").getOrCreate()
    options = vars(given)
    name = options.pop("job").replace("-", "_")
    if "once" in options and options.pop("once"):
        options["trigger"] = None
    result = getattr(programs, name)(spark, **options)
    if name in ("detect", "score"):
        for query in result if isinstance(result, list) else [result]:
            query.awaitTermination()
    elif result is not None:
        print(result) if isinstance(result, dict) else result.show(100, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
