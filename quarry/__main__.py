"""python -m quarry list | run NAME SF_DIR [--out FOLDER] | explain NAME SF_DIR"""

from __future__ import annotations

import argparse

from quarry.plans import catalog
from quarry.session import local_session


def main() -> None:
    cli = argparse.ArgumentParser(prog="quarry", description=__doc__)
    cli.add_argument("command", choices=["list", "run", "explain"])
    cli.add_argument("name", nargs="?")
    cli.add_argument("sf_dir", nargs="?")
    cli.add_argument("--out", help="folder for Parquet; else the first rows are printed")
    args = cli.parse_args()
    if args.command == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return
    if args.name not in catalog.QUERIES or not args.sf_dir:
        cli.error("a known name and a folder of tables are needed")
    df = catalog.QUERIES[args.name](local_session(), args.sf_dir)
    if args.command == "explain":
        df.explain("formatted")
    elif args.out:
        df.write.parquet(args.out)
    else:
        df.show(20, truncate=False)


if __name__ == "__main__":
    main()
