"""Stages over a graph, each a pure function; each leaves a whole version in a store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Graph
from ..operators import checks, cleanup, community, industry, linking, repairs
from ..sources import preflight
from . import store


def backfilled(graph: Graph) -> Graph:
    return graph.with_(edges=graph.edges.unionByName(linking.mention_backfill(graph)))


def named(graph: Graph) -> Graph:
    return graph.with_(nodes=cleanup.normalize_names(graph.nodes))


# Create edges, clean up, merge: (name, function) in order.
POST_PROCESS = [
    ("backfilled", backfilled),
    ("named", named),
    ("same_label", cleanup.deduplicate_by_name),
    ("across_labels", cleanup.deduplicate_across_labels),
    ("industries", industry.consolidate),
    ("clean", cleanup.run_cleanup),
]


def analyse(graph: Graph) -> DataFrame:
    """node, community."""
    return community.communities(community.semantic_edges(graph))


def stages(graph: Graph, full: bool = False) -> list[tuple[str, Callable[[Graph | None], Graph]]]:
    """Name and function of each stage; the name is that of the version it makes."""
    out = [("raw", lambda _: graph), *POST_PROCESS]
    return [*out, ("repaired", repairs.apply)] if full else out


def run(graph: Graph, path: str, full: bool = False, resume: bool = False) -> DataFrame:
    """preflight, post-processing, repairs if full, each saved whole; the last version becomes the
    current one.  Returns the summary of checks of that version, so after repairs all checks run
    again.  A resumed run starts behind the last whole stage."""
    preflight.run(graph.chunks)
    held = store.Store(graph.nodes.sparkSession, path)
    steps = stages(graph, full)
    if not resume:
        held.forget([name for name, _ in stages(graph, True)])
    last = held.run(steps, resume)
    held.promote(steps[-1][0])
    return checks.summary(last)


def totals(graph: Graph) -> DataFrame:
    return graph.nodes.agg(F.count("*").alias("nodes"))
