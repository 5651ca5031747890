"""Approximate nearest neighbours by largest inner product: NN-descent builds a graph, queries search it greedily.

Equal vectors are one node; a node keeps its ``k + 1`` smallest ids, which is all that a result can need. A node's links
lead to those with the largest inner product with it, whatever the norms. A code holds the direction in half precision
and the norm, in single precision, as a share of the largest component of all; how near another node is to an owner is
the cosine times the other's norm, since the owner's own norm changes no order.

The graph begins with the nearest of each node in two blocks, one of nodes on the same side of random planes, one
random. Then each round joins every node's neighbours, forward and backward, with each other (pairs of two old links were
joined before and are skipped): whoever is nearer than a member's last neighbour is proposed to that member, and the best
``LINKS`` stay. Long vectors are near to very many nodes, so a node's backward links are dealt anew in every round into
groups of about ``CROWD``, each joined with itself and with the node's forward links: a round's work follows the number of
links, and no group is unbounded. The rounds end when few links are new. These are the method's own bounds: a result is approximate, and
recall is measured in the tests.

A query starts at its own node, then opens its ``OPEN`` best unopened candidates, looks at their neighbours, and so on
for ``HOPS`` rounds. What it has found at the end is scored anew in double precision on the original vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.words import lists
from plinth.runtime import cut, discard

LINKS, PROPOSED, ROUNDS = 36, 16, 8
BLOCK, PIVOTS, CROWD = 256, 256, 64
OPEN, HOPS, KEPT = 32, 4, 120
SETTLED = 0.02  # of all links new in a round: the graph is done

_NODE = "id long, code binary, links array<long>, near array<float>, fresh array<boolean>"


def _codes(column) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms of coded vectors."""
    raw = column.combine_chunks().to_pylist() if isinstance(column, pa.ChunkedArray) else column.to_pylist()
    return _opened(raw)


def _opened(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    held = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
    return held[:, :-4].copy().view(np.float16).astype(np.float32), held[:, -4:].copy().view(np.float32).ravel()


def _ragged(column) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(column.value_lengths().to_numpy())[:-1]) if len(column) else []


def _coded(dims: int, top: float, planes: np.ndarray):
    """Vectors -> codes, and the side of each plane as a number."""

    def run(batches):
        for batch in batches:
            rows = np.zeros((batch.num_rows, dims))
            for row, own in zip(rows, _ragged(batch.column(1))):
                row[:len(own)] = own
            rows /= top
            largest = np.abs(rows).max(axis=1, initial=0)[:, None]
            rows /= np.where(largest > 0, largest, 1)
            size = np.sqrt((rows ** 2).sum(axis=1, keepdims=True))
            rows /= np.where(size > 0, size, 1)
            side = ((rows @ planes) > 0) @ (1 << np.arange(planes.shape[1]))
            norms = (size * largest).astype(np.float32)
            codes = [a.tobytes() + b.tobytes() for a, b in zip(rows.astype(np.float16), norms)]
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "code": pa.array(codes, type=pa.binary()), "side": side.astype(np.int64)})

    return run


def _best(owner: np.ndarray, other: np.ndarray, near: np.ndarray, keep: int):
    """The nearest ``keep`` distinct others of each owner: owners, counts, others, nearness."""
    order = np.lexsort((other, owner))
    owner, other, near = owner[order], other[order], near[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, near = owner[new], other[new], near[new]
    order = np.lexsort((other, -near, owner))
    owner, other, near = owner[order], other[order], near[order]
    first = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1)) if len(owner) else np.empty(0, np.int64)
    counts = np.diff(first, append=len(owner))
    inside = np.arange(len(owner)) - np.repeat(first, counts) < keep
    return owner[first], np.minimum(counts, keep), other[inside], near[inside]


def _proposals(owner, other, near, keep):
    found = _best(owner, other, near, keep)
    return pa.table({"id": pa.array(found[0], pa.int64()), "others": lists(found[2], found[1], pa.int64()),
                     "near": lists(found[3].astype(np.float32), found[1], pa.float32())})


def _in_block(table):
    """Members of one block -> the nearest others of each."""
    ids, (rows, norms) = table.column("id").to_numpy(), _codes(table.column("code"))
    near = rows @ rows.T * norms
    np.fill_diagonal(near, -np.inf)
    keep = min(LINKS // 2, len(ids) - 1)
    best = np.argpartition(-near, keep - 1, axis=1)[:, :keep] if keep > 0 else np.empty((len(ids), 0), dtype=np.int64)
    return _proposals(np.repeat(ids, keep), ids[best].ravel(), np.take_along_axis(near, best, axis=1).ravel(), LINKS)


def _joined(table):
    """Neighbours of some pivots -> the members' proposals: nearer than their floor, with at least one new link."""
    pivot = table.column("pivot").to_numpy()
    order = np.argsort(pivot, kind="stable")
    pivot, member = pivot[order], table.column("member").to_numpy()[order]
    fresh = table.column("fresh").to_numpy(zero_copy_only=False)[order]
    floor = table.column("floor").to_numpy()[order]
    codes, norms = (x[order] for x in _codes(table.column("code")))
    found = [], [], []
    for lo, hi in zip(*(lambda e: (e[:-1], e[1:]))(np.flatnonzero(np.diff(pivot, prepend=pivot[0] - 1, append=pivot[-1] + 1)))):
        own, at = np.unique(member[lo:hi], return_index=True)
        new = np.zeros(len(own), dtype=bool)
        np.logical_or.at(new, np.searchsorted(own, member[lo:hi]), fresh[lo:hi])
        if len(own) < 2 or not new.any():
            continue
        rows = codes[lo:hi][at]
        near = rows @ rows.T * norms[lo:hi][at]
        near[~(new[:, None] | new[None]) | (near <= floor[lo:hi][at][:, None])] = -np.inf
        np.fill_diagonal(near, -np.inf)
        keep = min(PROPOSED, len(own) - 1)
        best = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
        value = np.take_along_axis(near, best, axis=1)
        good = value > -np.inf
        found[0].append(np.broadcast_to(own[:, None], best.shape)[good])
        found[1].append(own[best][good])
        found[2].append(value[good])
    if not found[0]:
        found = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.float32)]
    return _proposals(*(np.concatenate(x) for x in found), LINKS)


def _merged(batches):
    """Nodes with proposals -> nodes with the best links; a link is fresh if it wasn't there before."""
    for batch in batches:
        out = [], [], []
        for links, near, others, more in zip(*(_ragged(batch.column(i)) for i in range(2, 6))):
            _, _, other, value = _best(np.zeros(len(links) + len(others)), np.concatenate([links, others]), np.concatenate([near, more]), LINKS)
            out[0].append(other)
            out[1].append(value)
            out[2].append(~np.isin(other, links))
        counts = np.array([len(x) for x in out[0]], dtype=np.int64)
        flat = [np.concatenate(x) if x else np.empty(0) for x in out]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), lists(flat[0].astype(np.int64), counts, pa.int64()),
             lists(flat[1].astype(np.float32), counts, pa.float32()), lists(flat[2].astype(bool), counts, pa.bool_())],
            names=["id", "code", "links", "near", "fresh"],
        )


def _taken(nodes: DataFrame, proposals: DataFrame) -> DataFrame:
    """Nodes after a round, as a written table."""
    gathered = proposals.groupBy("id").agg(F.flatten(F.collect_list("others")).alias("others"), F.flatten(F.collect_list("near")).alias("more"))
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return cut(
        nodes.join(gathered, "id", "left")
        .select("id", "code", "links", "near", none("others", "array<long>"), none("more", "array<float>"))
        .mapInArrow(_merged, _NODE)
    )


def build_graph(vectors: DataFrame) -> tuple[DataFrame, int, float]:
    """NN-descent graph of ``vectors(id, vector array<double>)`` with distinct ids: nodes, dimensions, largest component."""
    largest = F.array_max(F.transform("vector", F.abs))
    seen = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(largest)).first()
    n, dims, top = seen[0], seen[1] or 0, seen[2] or 1.0
    planes = np.random.default_rng(7).standard_normal((dims, max(1, (n // BLOCK).bit_length())))
    coded = cut(vectors.select("id", "vector").mapInArrow(_coded(dims, top, planes), "id long, code binary, side long"))
    # A side that many nodes share is split, so that no block outgrows BLOCK by much.
    shares = coded.groupBy("side").count().select("side", F.ceil(F.col("count") / BLOCK).alias("shares"))
    blocks = -(-n // BLOCK) or 1
    near = coded.join(shares, "side").select(
        "id", "code", F.concat_ws("/", F.lit("p"), "side", F.pmod(F.xxhash64("id"), F.col("shares"))).alias("block")
    ).unionByName(coded.select(
        "id", "code", F.concat_ws("/", F.lit("r"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))).alias("block")
    ))
    empty = coded.select(
        "id", "code", F.array().cast("array<long>").alias("links"), F.array().cast("array<float>").alias("near"),
        F.array().cast("array<boolean>").alias("fresh"),
    )
    nodes = _taken(empty, near.groupBy("block").applyInArrow(_in_block, "id long, others array<long>, near array<float>"))
    discard(coded)
    pivots = -(-n // PIVOTS) or 1
    for turn in range(ROUNDS):
        floor = F.when(F.size("links") < LINKS, F.lit(float("-inf"))).otherwise(F.element_at("near", -1)).cast("float").alias("floor")
        linked = nodes.select("id", "code", floor, F.explode(F.arrays_zip("links", "fresh")).alias("x"))
        backward = linked.select(F.col("x.links").alias("pivot"), F.col("id").alias("member"), "code", "floor", "x.fresh")
        forward = linked.select(F.col("id").alias("pivot"), F.col("x.links").alias("member"), "x.fresh").join(
            nodes.select(F.col("id").alias("member"), "code", floor), "member"
        ).select("pivot", "member", "code", "floor", "fresh")
        crowds = backward.groupBy("pivot").count().where(F.col("count") > CROWD).select(
            "pivot", F.ceil(F.col("count") / CROWD).alias("shares"))
        shares = F.coalesce("shares", F.lit(1))
        group = lambda share: F.xxhash64("pivot", share).alias("pivot")
        rest = "member", "code", "floor", "fresh"
        around = backward.join(crowds, "pivot", "left").select(
            group(F.pmod(F.xxhash64("member", F.lit(turn)), shares)), *rest
        ).unionByName(forward.join(crowds, "pivot", "left").withColumn(
            "share", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1))
        ).select(group(F.col("share")), *rest)).withColumn("block", F.pmod("pivot", F.lit(pivots)))
        found = around.groupBy("block").applyInArrow(_joined, "id long, others array<long>, near array<float>")
        last, nodes = nodes, _taken(nodes, found)
        discard(last)
        new, all_ = nodes.agg(F.sum(F.size(F.filter("fresh", lambda x: x))), F.sum(F.size("links"))).first()
        if (new or 0) <= SETTLED * (all_ or 1):
            break
    return nodes, dims, top


def _looked(batches):
    """Opened nodes with a query's code -> the nearness of their neighbours to the query."""
    for batch in batches:
        queries, _ = _codes(batch.column(1))
        found = [], []
        for query, links, raw in zip(queries, _ragged(batch.column(2)), batch.column(3).to_pylist()):
            rows, norms = _opened(raw)
            found[0].append(links)
            found[1].append(rows @ query * norms)
        counts = np.array([len(x) for x in found[0]], dtype=np.int64)
        flat = [np.concatenate(x) if x else np.empty(0) for x in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), lists(flat[0].astype(np.int64), counts, pa.int64()), lists(flat[1].astype(np.float32), counts, pa.float32())],
            names=["id", "others", "more"],
        )


def _advanced(batches):
    """States with what was looked at -> states: best candidates, which of them were opened, what to open now."""
    for batch in batches:
        out = [], [], [], []
        for own, links, near, opened, others, more in zip(batch.column(0).to_numpy(), *(_ragged(batch.column(i)) for i in range(2, 7))):
            _, _, ids, value = _best(np.zeros(len(links) + len(others)), np.concatenate([links, others]), np.concatenate([near, more]), KEPT + 1)
            ids, value = ids[ids != own][:KEPT].astype(np.int64), value[ids != own][:KEPT]
            ask = ids[~np.isin(ids, opened)][:OPEN]
            for column, x in zip(out, (ids, value, np.union1d(opened, ask), ask)):
                column.append(x)
        make = lambda k, kind, dtype: lists(
            np.concatenate(out[k]).astype(dtype) if out[k] else np.empty(0, dtype), np.array([len(x) for x in out[k]], dtype=np.int64), kind)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), make(0, pa.int64(), np.int64), make(1, pa.float32(), np.float32),
             make(2, pa.int64(), np.int64), make(3, pa.int64(), np.int64)],
            names=["id", "code", "links", "near", "opened", "ask"],
        )


_STATE = "id long, code binary, links array<long>, near array<float>, opened array<long>, ask array<long>"


def _search(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """Candidates of the nodes in ``asked(id)``: ``id, links``, by greedy search from the nodes themselves."""
    edges = nodes.select("id", F.posexplode("links").alias("p", "other")).join(
        nodes.select(F.col("id").alias("other"), "code"), "other"
    )
    graph = cut(edges.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("p", "other", "code"))).alias("x")).select(
        F.col("id").alias("node"), F.col("x.other").alias("found"), F.col("x.code").alias("codes")
    ))
    none = lambda kind: F.array().cast(kind)
    state = nodes.join(asked, "id", "left_semi").select(
        "id", "code", none("array<long>").alias("links"), none("array<float>").alias("near"),
        none("array<long>").alias("opened"), F.array("id").alias("ask"),
    )
    state = cut(state)
    for _ in range(HOPS + 1):
        opening = state.select("id", "code", F.explode("ask").alias("node")).join(graph, "node").select("id", "code", "found", "codes")
        seen = opening.mapInArrow(_looked, "id long, others array<long>, more array<float>").groupBy("id").agg(
            F.flatten(F.collect_list("others")).alias("others"), F.flatten(F.collect_list("more")).alias("more")
        )
        joined = state.join(seen, "id", "left").select(
            "id", "code", "links", "near", "opened", F.coalesce("others", none("array<long>")).alias("others"),
            F.coalesce("more", none("array<float>")).alias("more"),
        )
        last, state = state, cut(joined.mapInArrow(_advanced, _STATE))
        discard(last)
    discard(graph)
    return state.select("id", "links")


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest found for each id of ``queries(id)``, itself excepted: ``query_id, rank, vec_id, score``.

    ``vectors`` holds ``id long, vector array<double>`` with unique non-null ids and finite components, not all zero
    (``plinth.llm.vectors.usable``); shorter vectors count as padded with zeros. Scores are inner products in double
    precision, ties go to the smaller id. With fewer candidates, all that are found are returned.
    """
    by_vector = Window.partitionBy("vector").orderBy("id")
    ranked = vectors.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1)
    groups = cut(ranked.groupBy("vector").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")))
    points = groups.select(F.col("rep").alias("id"), "vector")
    nodes, _, _ = build_graph(points)
    wanted = cut(vectors.join(queries.select("id"), "id", "left_semi").join(groups.select("vector", "rep"), "vector").select("id", "vector", "rep"))
    found = _search(nodes, wanted.select(F.col("rep").alias("id")).distinct())
    candidates = found.select(F.col("id").alias("rep"), F.explode(F.array_union(F.array("id"), "links")).alias("other"))
    other = groups.select(F.col("rep").alias("other"), F.col("vector").alias("v"), "ids")
    product = F.aggregate(F.zip_with("vector", "v", lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    scored = wanted.select(F.col("id").alias("query_id"), "vector", "rep").join(candidates, "rep").join(other, "other").select(
        "query_id", product.alias("score"), F.explode("ids").alias("vec_id")
    ).where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
