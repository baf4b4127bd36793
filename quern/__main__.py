"""Command line for the four programs: prints every row of every result, tab
separated, or writes them as parquet when ``--out`` is given.

  python -m quern numbers FILE [--fraction F] [--seed S]
  python -m quern words SALTS FILE [--seed S]
  python -m quern kmedian FILE K L ITER [--seed S]
  python -m quern kmeans FILE K ITER [--seed S]
"""

from __future__ import annotations

import argparse

from quern.plans import programs
from quern.session import local_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="quern")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("numbers")
    a.add_argument("file")
    a.add_argument("--fraction", type=float, default=0.5)
    b = sub.add_parser("words")
    b.add_argument("salts", type=int)
    b.add_argument("file")
    c = sub.add_parser("kmedian")
    c.add_argument("file")
    c.add_argument("k", type=int)
    c.add_argument("L", type=int)
    c.add_argument("iters", type=int)
    d = sub.add_parser("kmeans")
    d.add_argument("file")
    d.add_argument("k", type=int)
    d.add_argument("iters", type=int)
    for p in (a, b, c, d):
        p.add_argument("--seed", type=int, default=0)
        p.add_argument("--out", default=None, help="folder to write every result to, as parquet")
        p.add_argument("--master", default="*", help="local cores when no cluster session is configured")
    args = ap.parse_args(argv)
    spark = local_session(args.master)
    if args.cmd == "numbers":
        res = programs.number_statistics(spark, args.file, args.fraction, args.seed)
    elif args.cmd == "words":
        res = programs.word_statistics(spark, args.file, args.salts, args.seed)
    elif args.cmd == "kmedian":
        res = programs.kmedian_program(spark, args.file, args.k, args.L, args.iters, args.seed)
    else:
        res = programs.kmeans_program(spark, args.file, args.k, args.iters, args.seed)
    for name, df in res.items():
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        else:
            print(f"== {name}\t" + "\t".join(df.columns))
            for row in df.toLocalIterator():  # one partition at a time
                print(*row, sep="\t")


if __name__ == "__main__":
    main()
