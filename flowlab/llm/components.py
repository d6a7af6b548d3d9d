"""Connected components of a link table, by rounds of joins and grouped minima.

Each vertex holds a label, at first its own id. In a round every vertex learns the smallest label
among its neighbours, gives it to its former label's vertex (hooking) and to itself, and then takes
its label's label (shortcut). Labels only fall, and the rounds end when none does; their number grows
with the logarithm of the longest chain. Every round is written to the shared folder, so lineage
stays short and a lost executor costs tasks, not rounds.

Only grouped minima see a vertex's links, with partial sums first: a vertex with very many links is
no hot group. Links and labels are joined by sorting: broadcast, they would all pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.sources.storage import durable

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest id reachable."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = durable(both, "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label"))
    labels = durable(labels, "labels")
    for _ in range(MOST_ROUNDS):
        near = both.join(labels.hint("merge"), both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        seen = labels.join(near.hint("merge"), labels["id"] == near["a"]).select("id", "label", "near")
        hooks = seen.select("id", F.least("label", "near").alias("new")).union(
            seen.select(F.col("label").alias("id"), "near")
        )
        hooked = hooks.groupBy("id").agg(F.min("new").alias("label"))
        up = hooked.select(F.col("id").alias("up"), F.col("label").alias("above"))
        short = hooked.join(up.hint("merge"), hooked["label"] == up["up"], "left")
        new = durable(short.select("id", F.least("label", "above").alias("label")), "labels")
        old = labels.withColumnRenamed("label", "old")
        changed = new.join(old.hint("merge"), "id").filter("label <> old").limit(1).count()
        labels = new
        if not changed:
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"labels still change after {MOST_ROUNDS} rounds")
