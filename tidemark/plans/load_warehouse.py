"""Load job: the curated daily facts and baselines into catalog tables."""

import argparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.batch_baseline import BASELINE, DAILY
from tidemark.session import build_session
from tidemark.sinks.files import load_table


def load_warehouse(
    spark: SparkSession,
    curated: str,
    prefix: str = "",
    location: str | None = None,
    provider: str = "parquet",
    **options,
) -> dict[str, DataFrame]:
    """Replace the tables of both curated results and return them by name.

    ``prefix`` goes before the tables' names, for instance a database with its dot;
    ``location`` keeps their files below a folder of its own. ``provider`` and ``options``
    are those of a warehouse connector where its jar is present.
    """
    return {
        name: load_table(
            spark, f"{curated}/{name}", prefix + name,
            f"{location}/{name}" if location else None, provider, **options,
        )
        for name in (DAILY, BASELINE)
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--curated", required=True, help="output folder of the batch job")
    parser.add_argument("--prefix", default="", help="put before the tables' names")
    parser.add_argument("--location", help="folder of the tables' files")
    parser.add_argument("--provider", default="parquet")
    args = parser.parse_args(argv)
    spark = build_session("load-warehouse")
    load_warehouse(spark, args.curated, args.prefix, args.location, args.provider)
    spark.stop()


if __name__ == "__main__":
    main()
