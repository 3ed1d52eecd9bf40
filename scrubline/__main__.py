"""Command line: ``python -m scrubline``."""

from __future__ import annotations

import argparse
from pathlib import Path

from scrubline.plans import prepare
from scrubline.session import build_session
from scrubline.sources import JdbcTarget


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="scrubline", description=prepare.__doc__)
    parser.add_argument("--apps", nargs="+", required=True, help="CSV files of the app table")
    parser.add_argument("--reviews", nargs="+", required=True, help="CSV files of the reviews")
    parser.add_argument("--out", required=True, help="folder that all executors share")
    parser.add_argument("--relative-error", type=float, help="rank error of the median")
    parser.add_argument("--single-line", action="store_true", help="no line breaks in quotes")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-file", type=Path)
    parser.add_argument("--jdbc-connections", type=int, default=16)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    target = None
    if args.jdbc_url:
        secret = args.jdbc_password_file
        target = JdbcTarget(
            args.jdbc_url,
            args.jdbc_driver,
            args.jdbc_user,
            secret.read_text().strip() if secret else None,
            args.jdbc_connections,
        )
    spark = build_session()
    results = prepare(
        spark,
        args.apps,
        args.reviews,
        args.out,
        target,
        args.relative_error,
        multi_line=not args.single_line,
    )
    for name, frame in results.items():
        print(f"\n{name} (whole table: below {args.out})")
        frame.show(20, truncate=40)
    spark.stop()


if __name__ == "__main__":
    main()
