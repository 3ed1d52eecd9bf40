"""Loading the cleaned tables into a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from scrubline.sources.jdbc import JdbcTarget, load_table
from scrubline.sources.ledger import JdbcLanding, load_once, once_view


def load_tables(
    tables: Mapping[str, DataFrame], target: JdbcTarget, staging: str, suffix: str = ""
) -> dict[str, int]:
    """Load each frame into the table of its name and ``suffix``; returns the row counts.

    Each is staged below ``staging`` first, a folder all executors share: slow
    database writers hold up no cleaning work, and repeating a load does not
    repeat the cleaning.  With a suffix such as ``_loading`` readers keep the old
    tables until the caller renames the new ones, all of them complete.
    """
    return {
        name: load_table(df, target, f"{name}{suffix}", f"{staging}/{name}")
        for name, df in tables.items()
    }


def load_tables_once(
    tables: Mapping[str, DataFrame], target: JdbcTarget, staging: str
) -> dict[str, str]:
    """Load each frame so that every row counts once, whatever is repeated.

    Returns the SQL of a view for each table: create it once in the database; it shows
    the former load until the manifest of the next one arrives.
    """
    views = {}
    for name, df in tables.items():
        load_once(
            df,
            JdbcLanding(target, name),
            f"{staging}/{name}",
            target.connections,
            target.rows_per_file,
        )
        views[name] = once_view(name, df.columns)
    return views
