"""Near-duplicate embeddings by NN-descent.

1. Equal vectors are one class, represented by the smallest id.
2. A first neighbour graph comes from random hyperplanes: the signs of a vector's projections are a
   sort key, and each run of a fixed number of rows in key order is compared in full. Runs have a
   fixed size whatever the data, so a dense region is many runs and no hot bucket.
3. Rounds of neighbours-of-neighbours joins refine it: around every vector a sample of its neighbours
   and of those that have it as a neighbour is compared in full. Pairs that are new and near go into
   the lists of both.
4. A list holds the nearest few, and is enlarged as long as it is saturated: every neighbour above
   the threshold stays in it. Saturated lists also join in samples that
   grow with their length.
5. When a round finds hardly any new pair above the threshold, recall is audited: sampled vectors
   are compared with all, block after block until 200 of them had a link or all were asked. So where
   few vectors have a link many are asked, and without any link all. Below the wanted recall, more
   hyperplanes and rounds with larger samples follow; if these do not reach it, all are compared with
   all, so no result is below it.
6. All pairs above the threshold that were ever found are links; only verified cosines count.

Cosines are computed in double precision. Sampling decides only where to look, never which found
pair counts. Vectors of different lengths are never compared.

Rows: a vector that is null, empty or zero, or that holds a null or non-finite component, links with
nothing; so does a row with a null id, whose component is null. Rows with equal ids are vectors of
their own. Other columns do not matter. An empty table gives an empty result. ``recall`` is null where
no vector has a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.components import components
from flowlab.sources.storage import durable, new_folder

#: Hashes that order the vectors of an audit, numbers in a block of them at most (collected, and sent
#: to every task), and vectors of a block that are compared at a time.
HASHES = 1 << 40
ASKED_NUMBERS = 1 << 21
TILE = 400


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    neighbours: int = 10  # length of a list that is not saturated
    orders: int = 12  # sort keys from random hyperplanes, before the first round and before each retry
    planes: int = 48  # hyperplanes of one key
    run: int = 256  # rows of a run
    sample: int = 20  # neighbours compared around a vector
    saturated_sample: int = 64  # at least, around a vector whose list is saturated
    tile: int = 512  # vectors of a sample that are one side of a comparison
    settled: float = 0.005  # share of new links below which the rounds end
    rounds: int = 6  # at most, between audits
    audited: int = 400  # vectors compared with all in the first block of an audit
    audited_linked: int = 200  # vectors with a link that an audit must see, unless it asked all vectors
    recall: float = 0.98
    audits: int = 4
    seed: int = 42


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of length one in double precision."""
    rows = flat.astype(np.float64).reshape(-1, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # first by the largest part: no overflow
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _stack(vectors: pa.Array, dim: int) -> np.ndarray:
    return unit_rows(vectors.flatten().to_numpy(zero_copy_only=False), dim)


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, dim, size) of each distinct usable vector."""
    values = F.col("vector")
    usable = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
        .filter(F.col("id").isNotNull() & values.isNotNull())
        .filter(F.coalesce(usable, F.lit(False)) & F.exists(values, lambda v: v != 0))
        .groupBy("vector")
        .agg(F.min("id").alias("id"), F.count("*").alias("size"))
        .select("id", "vector", F.size("vector").alias("dim"), "size")
    )


def near_in_runs(points: DataFrame, attempt: int, s: Settings) -> DataFrame:
    """(a, b, cosine): the nearest few and all links of every vector within its runs."""
    kind = points.schema["vector"].dataType.simpleString()
    id_type = points.schema["id"].dataType.simpleString()
    powers = 1 << np.arange(s.planes, dtype=np.int64)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                units = _stack(part.column("vector"), dim)
                random = np.random.default_rng((s.seed, attempt, dim))
                for order in range(s.orders):
                    signs = units @ random.standard_normal((dim, s.planes)) > 0
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(units), order, np.int32)),
                            part.column("dim"),
                            pa.array(signs @ powers),
                            part.column("id"),
                            part.column("vector"),
                        ],
                        ["order", "dim", "key", "id", "vector"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            mark = batch.column("order").to_numpy().astype(np.int64) << 32 | batch.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(mark)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(start, end - start)
                if waiting and not _alike(waiting[-1], part):
                    yield from runs(waiting)
                    waiting = []
                waiting.append(part)
                if sum(p.num_rows for p in waiting) >= 16 * s.run:
                    yield from runs(waiting)
                    waiting = []
        if waiting:
            yield from runs(waiting)

    def runs(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        dim = rows.column("dim")[0].as_py()
        units = _stack(rows.column("vector"), dim)
        for start in range(0, len(units), s.run):
            yield _near_pairs(rows.column("id").slice(start, s.run), units[start : start + s.run], None, s)

    tasks = max(1, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        points.select("id", "vector", "dim")
        .mapInArrow(keys, f"order int, dim int, key bigint, id {id_type}, vector {kind}")
        .repartitionByRange(tasks, "order", "dim", "key", "id")
        .sortWithinPartitions("order", "dim", "key", "id")
        .mapInArrow(compare, f"a {id_type}, b {id_type}, cosine double")
    )


def _alike(one: pa.RecordBatch, other: pa.RecordBatch) -> bool:
    return all(one.column(c)[0].as_py() == other.column(c)[0].as_py() for c in ("order", "dim"))


def _near_pairs(ids: pa.Array, units: np.ndarray, worst: np.ndarray | None, s: Settings) -> pa.RecordBatch:
    """Pairs (a, b) that are links or that improve a's list: above its worst cosine if known, else a
    place among the nearest."""
    cosines = units @ units.T
    np.fill_diagonal(cosines, -2.0)
    if worst is None:
        keep = cosines >= s.threshold
        if len(ids) > s.neighbours:
            bar = np.partition(cosines, -s.neighbours, axis=1)[:, [-s.neighbours]]
            keep |= cosines >= bar
        else:
            keep |= cosines > -2.0
    else:
        keep = (cosines >= s.threshold) | (cosines > worst[:, None])
        np.fill_diagonal(keep, False)
    a, b = np.nonzero(keep)
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(a)), ids.take(pa.array(b)), pa.array(cosines[a, b])], ["a", "b", "cosine"]
    )


def lists(pairs: DataFrame, s: Settings) -> DataFrame:
    """(a, b, cosine, place): per a the nearest few, and all links of a saturated list."""
    nearest = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    once = pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    placed = once.withColumn("place", F.row_number().over(nearest))
    return placed.filter((F.col("place") <= s.neighbours) | (F.col("cosine") >= s.threshold))


def refine(points: DataFrame, graph: DataFrame, turn: int, s: Settings, attempt: int = 0) -> DataFrame:
    """(a, b, cosine) found by comparing, around each vector, a sample of its neighbours.

    Around n vectors that are all near each other, samples of 2 sqrt(n) hold nearly all of their pairs.
    So the sample of a saturated list grows with the root of its length, and doubles with each attempt.
    """
    id_type = points.schema["id"].dataType.simpleString()
    both = graph.select(F.col("a").alias("v"), F.col("b").alias("u")).union(graph.select("b", "a")).distinct()
    worst = graph.filter(F.col("place") == s.neighbours).select(F.col("a").alias("id"), F.col("cosine").alias("worst"))
    # how many neighbours a vector has, and whether its list is saturated, decides its sample
    degrees = both.groupBy("v").agg(F.count("*").alias("degree"))
    saturated = F.greatest(F.lit(s.saturated_sample), 2 * F.sqrt("degree")) * 2**attempt
    size = F.when(F.col("worst") >= s.threshold, saturated).otherwise(s.sample)
    sizes = degrees.join(worst.withColumnRenamed("id", "v"), "v", "left").select(
        "v", (size / F.col("degree")).alias("share"), F.ceil(F.least(size, "degree") / s.tile).cast("int").alias("tiles")
    )
    draw = F.pmod(F.xxhash64("v", "u", F.lit(s.seed), F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
    chosen = both.join(sizes, "v").filter(draw < F.col("share"))
    # a large sample is cut into tiles, and any two tiles are a group of their own
    tile = F.pmod(F.xxhash64("u", "v", F.lit(s.seed + 1)), F.col("tiles")).cast("int")
    chosen = chosen.select("v", "u", "tiles", tile.alias("one"))
    chosen = chosen.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    chosen = chosen.filter("tiles = 1 OR one <> other").select(
        "v", "u", F.least("one", "other").alias("one"), F.greatest("one", "other").alias("other")
    )
    members = points.select(F.col("id").alias("u"), "vector", "dim").join(
        worst.withColumnRenamed("id", "u"), "u", "left"
    )
    around = (
        chosen.join(members, "u")
        .groupBy("v", "one", "other")
        .agg(F.collect_list(F.struct("u", "worst", "dim", "vector")).alias("members"))
        .select("members")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column("members"):
                found = group.values
                if len(found) < 2:
                    continue
                bars = found.field("worst").to_numpy(zero_copy_only=False)
                units = _stack(found.field("vector"), found.field("dim")[0].as_py())
                yield _near_pairs(found.field("u"), units, np.where(np.isnan(bars), -2.0, bars), s)

    return around.mapInArrow(join, f"a {id_type}, b {id_type}, cosine double")


def true_links(points: DataFrame, low: int, high: int, s: Settings) -> DataFrame:
    """(a, b) for every link of the vectors whose hash is in [low, high), which are compared with all."""
    place = F.pmod(F.xxhash64("id", "vector", F.lit(s.seed)), F.lit(HASHES))
    block = points.filter((place >= low) & (place < high)).select("id", "vector", "dim").toArrow().combine_chunks()
    asked = {d: block.filter(pc.equal(block["dim"], d)) for d in pc.unique(block["dim"]).to_pylist()}
    queries = {d: (t["id"].combine_chunks(), t["vector"].combine_chunks()) for d, t in asked.items()}
    id_type = points.schema["id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in queries:
                    continue
                part = batch.filter(pa.array(dims == dim))
                ids, units = part.column("id"), _stack(part.column("vector"), dim)
                for start in range(0, len(queries[dim][0]), TILE):
                    names, vectors = (x.slice(start, TILE) for x in queries[dim])
                    x, y = np.nonzero(_stack(vectors, dim) @ units.T >= s.threshold)
                    columns = [names.take(pa.array(x)), ids.take(pa.array(y))]
                    pairs = pa.RecordBatch.from_arrays(columns, ["a", "b"])
                    yield pairs.filter(pc.not_equal(pairs.column("a"), pairs.column("b")))

    return points.select("id", "vector", "dim").mapInArrow(compare, f"a {id_type}, b {id_type}")


def ask(
    points: DataFrame, links: DataFrame, s: Settings, *, everything: bool = False
) -> tuple[float | None, DataFrame | None]:
    """Recall over blocks of vectors in the order of a hash; and, if all were asked, the true links.

    Recall is the mean share of their links that vectors have, or the share of all links of these
    vectors if it is smaller: neither many small groups nor one large one can hide the other. Blocks go
    on until enough vectors with a link were seen or all vectors were asked; None if none has a link.
    A block is bounded, the rows that it is compared with are all.
    """
    size = points.agg(F.count("*").alias("rows"), F.coalesce(F.sum("dim"), F.lit(0)).alias("numbers")).first()
    step = -(-HASHES * s.audited // max(1, size.rows))
    most = max(1, HASHES * ASKED_NUMBERS // max(1, size.numbers))
    known = links.select("a", "b", F.lit(1).alias("found"))
    path = new_folder(points.sparkSession, "true")
    low, linked, share, found, wanted = 0, 0, 0.0, 0, 0
    while low < HASHES and (everything or linked < s.audited_linked):
        high = min(HASHES, low + min(step, most))
        block = f"{path}/block={low}"
        true = true_links(points, low, high, s)
        true.write.parquet(block)
        true = points.sparkSession.read.schema(true.schema).parquet(block)
        shares = true.join(known, ["a", "b"], "left").groupBy("a")
        shares = shares.agg(F.count("found").alias("found"), F.count("*").alias("wanted"))
        seen = shares.agg(
            F.count("*").alias("linked"),
            *(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("found", "wanted")),
            F.coalesce(F.sum(F.col("found") / F.col("wanted")), F.lit(0.0)).alias("share"),
        ).first()
        low, linked, share, step = high, linked + seen.linked, share + seen.share, 2 * step
        found, wanted = found + seen.found, wanted + seen.wanted
    every = points.sparkSession.read.schema(true.schema).parquet(f"{path}/block=*") if low == HASHES else None
    return (min(share / linked, found / wanted) if linked else None), every


def audit(points: DataFrame, links: DataFrame, s: Settings) -> float | None:
    """The recall alone, see ``ask``."""
    return ask(points, links, s)[0]


def links(points: DataFrame, s: Settings) -> tuple[DataFrame, float | None]:
    """(a, b) in both directions, and the recall that the last audit measured; None without any link.

    Where the last attempt stays below the wanted recall, the result is that of an audit of all vectors:
    every link, at the price of all cosines. So it is where an audit had to ask all vectors.
    """
    graph: DataFrame | None = None
    turn = 0
    for attempt in range(s.audits):
        pairs = near_in_runs(points, attempt, s)
        graph = durable(lists(pairs if graph is None else pairs.union(graph.select("a", "b", "cosine")), s), "graph")
        count = graph.filter(F.col("cosine") >= s.threshold).count()
        for _ in range(s.rounds):
            turn += 1
            pairs = refine(points, graph, turn, s, attempt).union(graph.select("a", "b", "cosine"))
            graph = durable(lists(pairs, s), "graph")
            before, count = count, graph.filter(F.col("cosine") >= s.threshold).count()
            if count - before <= s.settled * count:
                break
        kept = graph.filter(F.col("cosine") >= s.threshold).select("a", "b")
        recall, every = ask(points, kept, s)
        if recall is None or recall >= s.recall:
            return kept, recall
        if every is not None:
            return every, 1.0
    return ask(points, kept, s, everything=True)[1], 1.0


def near_duplicates(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """(id, n_links, component_id, kept, recall) per row of ``vectors``."""
    points = durable(classes(vectors, id_col, vector_col), "points")
    found, recall = links(points, settings)
    found = durable(found, "links")
    sizes = points.select(F.col("id").alias("b"), "size")
    linked = found.join(sizes, "b").groupBy("a").agg(F.sum("size").alias("others"))
    joined = components(found)
    per_class = (
        points.join(linked, points["id"] == linked["a"], "left")
        .join(joined.withColumnRenamed("id", "c"), F.col("id") == F.col("c"), "left")
        .select(
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    named = F.when(F.col("id").isNotNull(), F.col("vector"))
    return (
        rows.withColumn("vector", named)
        .join(per_class, "vector", "left")
        .select(
            "id",
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .select("*", (F.col("id") == F.col("component_id")).alias("kept"), F.lit(recall).cast("double").alias("recall"))
    )
