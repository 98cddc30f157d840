"""The last step of a job: its lists go to the list store and to outside stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from viewloom.sinks.outside import publish_to
from viewloom.sinks.versions import ListStore


def publish_job(
    lists: DataFrame,
    store: ListStore,
    run: str,
    roots: Sequence[str] = (),
    more_than: int = 0,
    keep_longer: bool = False,
    fields: Sequence[str] = ("payload",),
) -> int:
    """Publish a job's lists (list_key, rank, ``fields``) and return the store's version.

    The gates are those of ``ListStore.publish``. The outside stores then get, for every key of the job, the list that the store
    holds now, so they never hold a list that a gate refused. A run that ended between the two is completed by running it
    again: the store has it already, and the outside stores take what they lack.
    """
    rows = lists.select("list_key", "rank", *fields)
    version = store.publish(rows, run, more_than, keep_longer)
    if roots:
        current = store.read(version).join(rows.select("list_key").distinct(), "list_key", "left_semi")
        publish_to(current, roots, run)
    return version
