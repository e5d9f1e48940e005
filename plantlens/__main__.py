"""Materialise the silver and gold layers.

    python -m plantlens --test-tables /root/testdata/sf0.01 --out /shared/lake
    python -m plantlens --raw /shared/raw --out /shared/lake --database plant

``--raw`` reads ``raw_<name>`` parquet folders (the raw sink's layout);
``--test-tables`` projects the raw stand-ins from the shared test tables.
"""

from __future__ import annotations

import argparse

from plantlens.plans.layers import DEFAULT_AS_OF, from_raw_folder, from_test_tables, materialize
from plantlens.session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="plantlens")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="folder holding raw_<name> parquet folders")
    src.add_argument("--test-tables", help="folder of the shared test tables")
    ap.add_argument("--out", required=True, help="shared folder for the written layers")
    ap.add_argument("--database", default=None)
    ap.add_argument("--as-of", default=DEFAULT_AS_OF)
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit when submitted to a cluster")
    ap.add_argument("--small-dimensions", action="store_true",
                    help="the spec table and price list are small enough to broadcast")
    ap.add_argument("--salt-buckets", type=int, default=0, help="salt joins that fall back to a shuffle")
    ap.add_argument("--pre-aggregate", action="store_true", help="combine loads before the product fan-out")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    layers = (from_raw_folder(spark, a.raw, a.as_of) if a.raw
              else from_test_tables(spark, a.test_tables, a.as_of))
    layers.salt_buckets, layers.pre_aggregate = a.salt_buckets, a.pre_aggregate
    layers.small_dimensions = layers.small_dimensions or a.small_dimensions
    for table, name in materialize(layers, a.out, a.database).items():
        print(f"{table}\t{name}")


if __name__ == "__main__":
    main()
