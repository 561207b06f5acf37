"""Near copies among embeddings: a navigable small-world graph per shard, every shard searched for every vector.

Vectors are dealt to shards by the hash of their id. Each shard gets a graph, and each two shards meet once: the vectors
of the later one are searched in the earlier one's graph, a block at a time (a shard's own in its own graph). A graph is
sent once for ``CHUNK`` shards of queries. A search's beam is widened until it holds a vector below the threshold, for
each vector by itself, so no number of partners is too many; and the beams of a whole block start wider until an audit
passes. Pairs found are verified by their exact cosine, and groups are the connected components.

The audit is never empty. Near copies may be too rare for a sample to hold any, so ``PROBES`` vectors of the graph are
disturbed to a cosine of just the threshold, the hardest pairs that have to be found, and searched along with the block;
with the true pairs of a sample of the block (a vector and itself left out) they must be found to ``AUDIT_RECALL``.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.components import components, cut, discard
from plinth.llm.hnsw import Graph
from plinth.llm.words import mix

THRESHOLD = 0.95
SHARD = 8192
BLOCK = 1024
BEAM = 16
AUDIT_RECALL = 0.97
AUDIT = 16
PROBES = 64
CHUNK = 4
PARTITIONS = 20_000


def _build(table: pa.Table) -> pa.Table:
    ids = np.asarray(table.column("vec_id").combine_chunks())
    flat = np.asarray(table.column("embedding").combine_chunks().flatten(), np.float32).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    graph = Graph.build(ids[order], flat[order] / np.linalg.norm(flat[order].astype(float), axis=1, keepdims=True).astype(np.float32))
    vectors, links = pickle.dumps((ids[order][graph.order], graph.vectors), protocol=5), pickle.dumps(graph.links, protocol=5)
    return pa.table({"dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "vectors": pa.array([vectors], pa.binary()), "links": pa.array([links], pa.binary())})


def probes(graph: Graph, threshold: float, seed: int, count: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, unit vectors at a cosine of ``threshold`` to them), drawn anew for each seed."""
    n, dim = graph.vectors.shape
    nodes = np.argsort(mix(np.arange(n, dtype=np.uint64) + np.uint64(seed & 0xFFFFFFFFFFFF)), kind="stable")[:count]
    own = graph.vectors[nodes].astype(float)
    aside = np.random.default_rng(seed & 0xFFFFFFFFFFFF).normal(size=own.shape)
    aside -= np.einsum("nd,nd->n", aside, own)[:, None] * own
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = min(1.0, threshold + 1e-5)
    out = cosine * own + np.sqrt(1 - cosine**2) * np.divide(aside, size, out=np.zeros_like(aside), where=size > 1e-9)
    return nodes, (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


def found_pairs(
    graph: Graph, queries: np.ndarray, sample: np.ndarray, threshold: float, beam: int = BEAM, target: float = AUDIT_RECALL, planted: tuple[np.ndarray, np.ndarray] | None = None, own: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, node) of all pairs with a cosine of ``threshold`` or more that the searches find, and the beam they began with.

    The audit counts the sample's true pairs and the ``planted`` ones (nodes and probes). own: each query's own node in
    this graph, whose match with itself proves nothing, or -1.
    """
    n, some = len(graph.vectors), len(queries)
    exact = np.zeros((n, some), bool)
    exact[:, sample] = graph.vectors @ queries[sample].T >= threshold
    if own is not None:
        exact[own[own >= 0], np.flatnonzero(own >= 0)] = False
    if planted is not None:
        nodes, vectors = planted
        queries = np.concatenate([queries, vectors])
        exact = np.concatenate([exact, np.zeros((n, len(nodes)), bool)], axis=1)
        exact[nodes, some + np.arange(len(nodes))] = True
    true = int(exact.sum())
    while beam < n:
        rest, width = np.arange(len(queries)), beam
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while rest.size and width < n:
            nodes, score = graph.search(queries[rest], width)
            full = score[:, -1] >= threshold
            r, c = np.nonzero((score >= threshold) & ~full[:, None])
            found.append((rest[r], nodes[r, c]))
            rest, width = rest[full], width * 4
        if rest.size:
            c, r = np.nonzero(graph.vectors @ queries[rest].T >= threshold)
            found.append((rest[r], c))
        q, v = (np.concatenate(x) for x in zip(*found, strict=True))
        if exact[v, q].sum() >= target * true:
            mine = q < some
            return q[mine], v[mine], beam
        beam *= 2
    v, q = np.nonzero(graph.vectors @ queries[:some].T >= threshold)
    return q, v, n


def _search(table: pa.Table, threshold: float) -> pa.Table:
    """Edges between the vectors of one shard (the row with links) and those of others; only as many as hold what was found together."""
    links = table.column("links").to_pylist()
    at = next(k for k, x in enumerate(links) if x is not None)
    ids, vectors = pickle.loads(table.column("vectors")[at].as_py())
    graph, shard = Graph(vectors, pickle.loads(links[at]), 0), table.column("shard")[0].as_py()
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for k, other in enumerate(table.column("other").to_pylist()):
        if k == at:
            continue
        others, queries = pickle.loads(table.column("vectors")[k].as_py())
        for begin in range(0, len(others), BLOCK):
            mine, block = others[begin : begin + BLOCK], queries[begin : begin + BLOCK]
            sample = np.argsort(mix(mine.astype(np.int64).view(np.uint64)), kind="stable")[: max(AUDIT, len(mine) // 64)]
            own = begin + np.arange(len(mine)) if other == shard else None
            q, v, _ = found_pairs(graph, block, sample, threshold, planted=probes(graph, threshold, int(mine[0]) + other), own=own)
            sure = np.einsum("nd,nd->n", block[q].astype(float), vectors[v].astype(float)) >= threshold
            for x, y in zip(mine[q[sure]].tolist(), ids[v[sure]].tolist(), strict=True):
                p, r = find(x), find(y)
                if p != r:
                    root[max(p, r)] = min(p, r)
                    kept.append((x, y))
    return pa.table({"a": pa.array([x for x, _ in kept], pa.int64()), "b": pa.array([y for _, y in kept], pa.int64())})


def embedding_near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard_size: int = SHARD, id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = CHUNK) -> DataFrame:
    """(vec_id, keep_id) of every vector that has a near copy; keep_id is the least id of its group, also in its own row.

    Near copies have a cosine of ``threshold`` or more. Vectors of different lengths aren't compared. Null, empty, zero
    and non-finite vectors, and rows without id, have no copies. Rows that repeat an id and a vector count once; an id with
    several vectors is one item, which is a near copy of whatever any of them is near to. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<float>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.where("vec_id is not null and size(embedding) > 0").where(fine).withColumn("dim", F.size("embedding"))
    rows = cut(rows.dropDuplicates(["vec_id", "embedding"]), "vectors")
    counts = cut(rows.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(shard_size)).cast("int").alias("shards")), "counts")
    many = F.ceil(F.col("shards") / chunk)
    shards, meetings = counts.agg(F.coalesce(F.sum("shards"), F.lit(1)), F.coalesce(F.sum(F.col("shards") * many), F.lit(1))).first()
    dealt = rows.join(counts, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
    # The work is in the groups, not in their bytes: a number of partitions keeps adaptive execution from joining them.
    built = dealt.repartition(min(int(shards), PARTITIONS), "dim", "shard").groupBy("dim", "shard").applyInArrow(_build, "dim int, shard int, vectors binary, links binary")
    graphs = cut(built, "graphs")
    lone = F.lit(None).cast("binary")
    queries = graphs.select("dim", F.explode(F.sequence(F.lit(0), "shard")).alias("shard"), F.floor(F.col("shard") / chunk).cast("int").alias("chunk"), F.col("shard").alias("other"), "vectors", lone.alias("links"))
    last = F.floor((F.col("shards") - 1) / chunk).cast("int")
    kept = graphs.join(counts, "dim").select("dim", "shard", F.explode(F.sequence(F.floor(F.col("shard") / chunk).cast("int"), last)).alias("chunk"), F.lit(-1).alias("other"), "vectors", "links")
    both = kept.unionByName(queries).repartition(min(int(meetings), PARTITIONS), "dim", "shard", "chunk")
    edges = cut(both.groupBy("dim", "shard", "chunk").applyInArrow(lambda table: _search(table, threshold), "a long, b long"), "cosine")
    found = components(edges, "groups")
    discard(rows, counts, graphs, edges)
    return found.select(F.col("id").alias("vec_id"), F.col("root").alias("keep_id"))
