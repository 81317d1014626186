"""``python -m linkrank INPUT OUTPUT``: dump in, results out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from linkrank.plans.run import Config, publish_ranking


def main() -> None:
    parser = argparse.ArgumentParser(prog="linkrank", description=__doc__)
    parser.add_argument("input", help="dump file or folder")
    parser.add_argument("output", help="folder that gets results/")
    parser.add_argument("--iterations", type=int, default=Config.iterations)
    parser.add_argument("--damping", type=float, default=Config.damping)
    parser.add_argument("--threshold-factor", type=float, default=Config.threshold_factor)
    parser.add_argument("--graph-format", choices=("parquet", "text"), default=Config.graph_format)
    parser.add_argument("--inlinks", action="store_true", help="publish the inlink lists too")
    parser.add_argument("--keep", type=int, nargs="*", default=Config.keep, metavar="I",
                        help="iterations to publish beside the last one")
    parser.add_argument("--start", help="ranks or rank matrix to go on from")
    parser.add_argument("--start-format", choices=("parquet", "text"), default=Config.start_format)
    parser.add_argument("--done", type=int, default=0, help="iterations that led to --start")
    parser.add_argument("--run", help="name of the run: run again, it does what is left")
    parser.add_argument("--clear", action="store_true", help="remove the run's tables at the end")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("linkrank").getOrCreate()
    config = Config(
        input=args.input,
        output=args.output,
        iterations=args.iterations,
        damping=args.damping,
        threshold_factor=args.threshold_factor,
        graph_format=args.graph_format,
        write_inlinks=args.inlinks,
        keep=tuple(args.keep),
        start=args.start,
        start_format=args.start_format,
        done=args.done,
        run=args.run,
        clear=args.clear,
    )
    published = publish_ranking(spark, config)
    print(f"{published.n} pages; results in {config.output}/results")
    spark.stop()


if __name__ == "__main__":
    main()
