"""Command line: load landing files into the tables.

    spark-submit ... -m fieldrank LANDING ROOT --quality-key KEY [--date D | --stream CHECKPOINT]
"""

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from fieldrank.plans.daily import Chain, Tables, run_daily, verification
from fieldrank.sources.landing import record_rules
from fieldrank.streaming.ingest import ingest_available


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fieldrank", description=__doc__)
    parser.add_argument("landing", help="folder of landing files")
    parser.add_argument("root", help="folder of the tables")
    parser.add_argument("--quality-key", required=True, help="measurement used as quality")
    parser.add_argument("--date", type=dt.date.fromisoformat, help="load this date only")
    parser.add_argument("--stream", metavar="CHECKPOINT", help="load files not seen before")
    parser.add_argument("--lines", action="store_true", help="one envelope per line")
    parser.add_argument("--whole", action="store_true", help="a file replaces older ones of its date")
    parser.add_argument("--strict", action="store_true", help="stop at input that cannot be loaded")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("fieldrank").getOrCreate()
    tables = Tables(options.root)
    chain = Chain(
        record_rules(options.quality_key), whole_files=options.whole,
        on_reject="fail" if options.strict else "record",
    )
    multi_line = not options.lines
    if options.stream:
        ingest_available(spark, options.landing, tables, chain, options.stream, multi_line)
    else:
        load = run_daily(spark, options.landing, tables, chain, options.date, multi_line)
        print(f"{load.rows} rows on {len(load.dates)} dates, {load.rejected} rejects")
        if load.dates:
            print(verification(spark, tables, load.dates))


if __name__ == "__main__":
    main()
