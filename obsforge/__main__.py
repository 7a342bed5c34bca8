"""python -m obsforge list | explain QUERY --data DIR | run QUERY --data DIR [--out PATH] [--format parquet|csv|json] [--master URL]"""

from __future__ import annotations

import argparse
import os
import sys

from obsforge.errors import MissingTable, UnknownQuery
from obsforge.plans import registry
from obsforge.session import build_session, ship_package
from obsforge.tasks import task


def find(name: str):
    known = registry.queries()
    if name not in known:
        raise UnknownQuery(f"{name}; known are {', '.join(sorted(known))}")
    return known[name]


@task("write")
def write(df, path: str, form: str) -> None:
    df.write.mode("errorifexists").format(form).save(path)


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="obsforge", description=__doc__)
    sub = parser.add_subparsers(dest="what", required=True)
    sub.add_parser("list")
    for what in ("run", "explain"):
        p = sub.add_parser(what)
        p.add_argument("query")
        p.add_argument("--data", required=True)
        p.add_argument("--master", default=os.environ.get("SPARK_MASTER", "local[*]"))
        if what == "run":
            p.add_argument("--out")
            p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    a = parser.parse_args(args)
    if a.what == "list":
        for name, f in sorted(registry.queries().items()):
            print(f"{name:32}{(f.__doc__ or '').strip().splitlines()[0] if f.__doc__ else ''}")
        return 0
    query = find(a.query)
    if "://" not in a.data and not os.path.isdir(a.data):
        raise MissingTable(a.data)
    spark = build_session(a.master)
    ship_package(spark)
    df = query(spark, a.data)
    if a.what == "explain":
        df.explain("formatted")
    elif a.out:
        write(df, a.out, a.format)
    else:
        df.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
