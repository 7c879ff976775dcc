"""The validation report in Markdown."""

from __future__ import annotations

import os
import time
from pathlib import Path

from pyspark.sql import DataFrame

from ..model import Graph
from . import census

# What to do about a check that fails.
ADVICE = {
    "orphan_chunks": "Link chunks without an article, or delete them.",
    "orphan_entities": "Review entities without any edge.",
    "duplicate_entities": "Merge entities with the same label and name.",
    "missing_embeddings": "Embed the chunks that have no vector.",
    "industries": "Consolidate industries by the taxonomy.",
    "missing_chunk_ids": "Run the chunk id repair.",
    "missing_chunk_index": "Run the chunk index repair.",
    "plural_pairs": "Merge plurals into singulars.",
    "generic_entities": "Delete entities with vague names.",
    "invalid_patterns": "Review relationships outside the schema.",
    "degenerate_chunks": "Delete very short chunks that nothing mentions.",
    "truncated_titles": "Run the webinar title repair.",
    "unmentioned_entities": "Backfill mentions.",
    "ghost_entities": "Review entities that are only mentioned.",
    "mislabeled_challenges": "Relabel challenges that describe success.",
    "near_duplicates": "Review names that contain one another.",
    "missing_definitions": "Fill definitions from the glossary.",
}
HEALTHY = "The graph is healthy: nothing to do."


def recommendations(rows: list) -> list[str]:
    return [ADVICE[r["check"]] for r in rows if not r["ok"] and r["check"] in ADVICE] or [HEALTHY]


def to_markdown(rows: list, samples: dict[str, list], title: str = "Graph validation report", cap: int = 10) -> str:
    """From summary rows (bounded: one per check) and capped samples."""
    passed = all(r["ok"] for r in rows if r["required"])
    lines = [f"# {title}", "", f"**Status**: {'PASSED' if passed else 'FAILED'}", "", "| Check | Value | OK |", "| --- | --- | --- |"]
    lines += [f"| {r['check']} | {r['value']} | {'yes' if r['ok'] else 'no'} |" for r in sorted(rows, key=lambda r: r["check"])]
    for name, found in sorted(samples.items()):
        if found:
            lines += ["", f"## {name.replace('_', ' ').capitalize()}", "", *[f"- {', '.join(str(v) for v in r)}" for r in found[:cap]]]
            if len(found) > cap:
                lines.append(f"- and {len(found) - cap} more")
    return "\n".join([*lines, "", "## Recommendations", "", *[f"- {t}" for t in recommendations(rows)], ""])


def generate(graph: Graph) -> tuple[DataFrame, str]:
    """The summary and the report.  Two actions beside the census: the counts, and all samples."""
    rows = census.summary(graph).collect()  # one row per check
    samples: dict[str, list] = {}
    for r in census.samples(graph).collect():  # eleven rows per check at most
        samples.setdefault(r["check"], []).append(tuple(r["row"]))
    summary = graph.nodes.sparkSession.createDataFrame(rows, "check string, value long, ok boolean, required boolean")
    return summary, to_markdown(rows, samples)


def save(text: str, path: str) -> str | None:
    """Write a report on the driver; an earlier one is kept under its time of change."""
    target, old = Path(path), None
    if target.exists():
        stamp = time.strftime("%Y-%m-%dT%H%M%S", time.gmtime(os.path.getmtime(target)))
        old = target.with_name(f"{target.stem}_{stamp}{target.suffix}")
        target.rename(old)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)
    return str(old) if old else None
