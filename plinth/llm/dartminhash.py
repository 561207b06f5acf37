"""Near-duplicate documents by DartMinHash signatures of weighted word shingles.

A document is a weighted set: its shingles of ``SHINGLE`` words, each as heavy as it is frequent. In scripts without
spaces, and in unbroken runs of more than ``LONG_WORD`` bytes, each character is a word. Every element owns a
fixed random pattern of darts over the plane (weight, rank), one on average in each unit of area; the darts that fall
below the element's weight count. A dart also names one of ``COORDINATES`` coordinates, and the earliest dart of each
coordinate is kept. Two documents then agree in a coordinate with the probability of their weighted Jaccard similarity.
Darts are only thrown below the rank at which all coordinates are expected to be hit; documents that leave one empty
throw again, twice as far.

Signatures are cut into bands for candidates; identical signatures are collapsed first, equal candidate lists next, and
what is left is verified on the whole signatures. Groups are the connected components.

A band that more than ``LIST`` signatures share is never one list. Each of its members is first held against the
band's least member, a join of one row per signature; then only members that are still in different components are
compared, in blocks of ``BLOCK``, so no link between them is lost and no task or row holds the whole band.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.components import components, cut, discard, text_version
from plinth.llm.repetition import LONG_WORD
from plinth.llm.words import mix, ranges, slices, tokenise

SHINGLE = 3
BANDS, ROWS = 40, 4
COORDINATES = BANDS * ROWS
#: Similarity from which documents count as near copies; the signatures' estimate errs by 0.04.
THRESHOLD = 0.5
#: Members of a band that one task compares, and half of what it compares of a longer one.
LIST, BLOCK = 8192, 4096
_DARTS = 7.0
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Upper ends of the Poisson(1) distribution: how many darts a cell of area 1 holds.
_POISSON = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 25)]))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def weighted_shingles(column: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, element, weight) of each distinct shingle of each row, by row. Texts of fewer words are one shingle."""
    words = tokenise(column, signs=True, lower=True, split_over=LONG_WORD, characters=True)
    n = len(words.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    hashes, left = words.hashes(), words.first[1:][words.row] - np.arange(n)
    element = hashes.copy()
    for k in range(1, width):
        element *= _GOLD
        element[: n - k] += np.where(left[: n - k] > k, hashes[k:], np.uint64(0))
    begins = (left >= width) | (np.arange(n) == words.first[words.row])
    row, element = words.row[begins], mix(element[begins])
    code, own = pd.factorize(mix(element + row.astype(np.uint64) * _GOLD))
    weight = np.bincount(code, minlength=len(own)).astype(float)
    at = np.empty(len(own), np.int64)
    at[code[::-1]] = np.arange(len(code))[::-1]
    return row[at], element[at], weight


def _throw(row: np.ndarray, element: np.ndarray, weight: np.ndarray, reach: np.ndarray, rows: int, coordinates: int) -> np.ndarray:
    """Earliest dart of each row and coordinate, as (rank, dart) in one number; the largest number where none fell."""
    best = np.full(rows * coordinates, np.iinfo(np.uint64).max, np.uint64)
    level, live = 0, np.arange(len(row))
    while live.size:
        low, height = (0.0, 1.0) if level == 0 else (2.0 ** (level - 1), 2.0 ** (level - 1))
        live = live[weight[live] > low]
        cells = np.ceil(reach[row[live]] * height).astype(np.int64)
        for part in np.array_split(live, max(1, int(cells.sum() // 2_000_000))):
            count = np.ceil(reach[row[part]] * height).astype(np.int64)
            who, cell = np.repeat(part, count), ranges(count)
            seed = mix(element[who] + mix(cell.astype(np.uint64) + np.uint64(level << 40)))
            darts = np.searchsorted(_POISSON, _unit(mix(seed + _GOLD)), side="right")
            who, cell, seed = np.repeat(who, darts), np.repeat(cell, darts), np.repeat(seed, darts)
            dart = mix(seed + (ranges(darts).astype(np.uint64) + np.uint64(2)) * _GOLD)
            rank = (cell + _unit(dart)) / height
            inside = rank < reach[row[who]]
            who, dart, rank = who[inside], mix(dart[inside]), rank[inside]
            if level or (weight[who] < 1).any():
                inside = low + height * _unit(mix(dart + _GOLD)) < weight[who]
                who, dart, rank = who[inside], dart[inside], rank[inside]
            place = row[who] * coordinates + (dart % np.uint64(coordinates)).astype(np.int64)
            value = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | dart >> np.uint64(32)
            np.minimum.at(best, place, value)
        level += 1
    return best.reshape(rows, coordinates)


def signatures(column: pa.Array, coordinates: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """(rows, uint32 matrix) for the rows that have words."""
    row, element, weight = weighted_shingles(column)
    total = np.bincount(row, weight, len(column))
    has = np.flatnonzero(total)
    place = np.full(len(column), -1)
    place[has] = np.arange(len(has))
    row = place[row]
    reach = _DARTS * coordinates / total[has]
    best = _throw(row, element, weight, reach, len(has), coordinates)
    none = np.uint64(np.iinfo(np.uint64).max)
    while (short := np.flatnonzero((best == none).any(axis=1))).size:
        reach[short] *= 2
        again = np.full(len(has), -1)
        again[short] = np.arange(len(short))
        own = again[row] >= 0
        best[short] = _throw(again[row[own]], element[own], weight[own], reach[short], len(short), coordinates)
    return has, best.astype(np.uint32)


def _sign(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        has, sign = signatures(batch.column("text"), bands * rows)
        if not len(has):
            continue
        key = _keys(sign, bands, rows)
        whole = key[:, 0].copy()
        for k in range(1, bands):
            whole = mix(whole * _GOLD + key[:, k])
        blob = pa.Array.from_buffers(pa.binary(), len(has), [None, pa.py_buffer(np.arange(0, sign.nbytes + 1, bands * rows * 4, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(sign))])
        own = [batch.column(k).take(pa.array(has)) for k in ("doc_id", "version")]
        yield pa.RecordBatch.from_arrays([*own, pa.array(whole.view(np.int64)), blob], names=["doc_id", "version", "whole", "sign"])


def _keys(sign: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The bands' keys of each signature."""
    wide = sign.astype(np.uint64)
    key = np.zeros((len(sign), bands), np.uint64)
    for k in range(rows):
        key = mix(key * _GOLD + wide[:, k::rows][:, :bands] + np.uint64(1))
    return mix(key + np.arange(bands, dtype=np.uint64))


def _banded(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """(whole, bands): keys follow from signatures, so they are made where they are needed and neither kept nor moved along."""
    for batch in batches:
        if batch.num_rows:
            key = _keys(_matrix(batch.column("sign").to_pylist()), bands, rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, bands, dtype=np.int32)), pa.array(key.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("whole"), lists], names=["whole", "bands"])


def _matrix(signs: pd.Series | list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signs), np.uint32).reshape(len(signs), -1)


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Edges that join all similar members of one candidate list: breadth first, each member is compared until it is joined."""
    ids = pdf["whole"].to_numpy()
    sign = _matrix(pdf["sign"])
    rest, edges = np.argsort(ids), []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            near = (sign[rest] == sign[one]).mean(axis=1) >= threshold
            edges += [(ids[one], ids[other]) for other in rest[near]]
            front += list(rest[near])
            rest = rest[~near]
    return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def _star(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Edges between members and the leader of their band."""
    for batch in batches:
        table = batch.to_pandas()
        if len(table):
            near = (_matrix(table["sign"]) == _matrix(table["lead_sign"])).mean(axis=1) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(near)) for k in ("whole", "leader")], names=["a", "b"])


def _across(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Edges between the rest (side 0) and another block (side 1; the rest itself where it's one block), one for each two components."""
    rest, other = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    other = other if len(other) else rest
    if not len(rest):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sign, ids, labels = _matrix(other["sign"]), other["whole"].to_numpy(), other["label"].to_numpy()
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for one, label, own in zip(rest["whole"].tolist(), rest["label"].tolist(), _matrix(rest["sign"]), strict=True):
        for k in np.flatnonzero(((sign == own).mean(axis=1) >= threshold) & (labels != label)).tolist():
            found.setdefault((label, int(labels[k])), (one, int(ids[k])))
    return pd.DataFrame(list(found.values()), columns=["a", "b"], dtype="int64")


def _hot_edges(members: DataFrame, signs: DataFrame, edges: DataFrame, threshold: float, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """(edges, tables they read) that join the similar members of hot bands, given the edges found elsewhere. members: (band, whole); signs: (whole, sign).

    A signature is held against the leader of its longest band only. The bands whose members are in one component then are
    done. In the others the members outside the band's largest component are compared with all, block by block.
    """
    sizes = members.groupBy("band").agg(F.count("*").alias("n"), F.min("whole").alias("leader"))
    leaders = cut(sizes.join(signs.select(F.col("whole").alias("leader"), F.col("sign").alias("lead_sign")), "leader"), "leaders")
    best = members.join(leaders.select("band", "n"), "band").groupBy("whole").agg(F.min_by("band", F.struct(-F.col("n"), "band")).alias("band"))
    held = best.join(leaders.select("band", "leader", "lead_sign"), "band").where("whole <> leader").join(signs, "whole")
    star = cut(held.select("whole", "leader", "sign", "lead_sign").mapInArrow(partial(_star, threshold=threshold), "a long, b long"), "star")
    labels = components(edges.unionByName(star), "labels").select(F.col("id").alias("whole"), "root")
    named = cut(members.join(labels, "whole", "left").select("band", "whole", F.coalesce("root", "whole").alias("label")), "named")
    counts = named.groupBy("band", "label").agg(F.count("*").alias("n"))
    shape = counts.groupBy("band").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all")).where("top.n < all")
    shape = cut(shape.select("band", F.col("top.label").alias("main"), F.ceil(F.col("top.n") / block).cast("int").alias("mains"), F.ceil((F.col("all") - F.col("top.n")) / block).cast("int").alias("rests")), "shape")
    open_ = named.join(shape, "band").join(signs, "whole")
    own = F.pmod(F.xxhash64("whole"), F.when(F.col("label") == F.col("main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    open_ = open_.withColumn("own", own)
    left, right = F.col("own"), F.sequence(F.lit(0), F.col("rests") - 1)

    def place(kind: str, i: Column, j: Column, side: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    main = F.transform(right, lambda i: place("main", i, left, 1))
    rest = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda j: place("main", left, j, 0)),
        F.transform(right, lambda k: F.when(k >= left, place("rest", left, k, 0)).otherwise(place("rest", k, left, 1))),
    )
    spread = open_.withColumn("at", F.explode(F.when(F.col("label") == F.col("main"), main).otherwise(rest))).select("band", "at.*", "whole", "label", "sign")
    more = spread.groupBy("band", "kind", "i", "j").applyInPandas(lambda pdf: _across(pdf, threshold), "a long, b long")
    return star.unionByName(cut(more, "across")), [leaders, star, named, shape]


def _groups(docs: DataFrame, threshold: float, bands: int, rows: int, id_col: str, text_col: str, longest: int, block: int) -> DataFrame:
    """(doc_id, version, whole, keep): every row that has words and a near copy, and the least (doc_id, whole) of its group."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).where("doc_id is not null and text is not null")
    signed = cut(texts.withColumn("version", text_version(F.col("text"))).mapInArrow(partial(_sign, bands=bands, rows=rows), "doc_id long, version int, whole long, sign binary"), "darts")
    # Equal keys mean equal signatures and bands, so any row stands for its group.
    alone = cut(signed.select("whole", "sign").dropDuplicates(["whole"]), "alone")
    banded = alone.mapInArrow(partial(_banded, bands=bands, rows=rows), "whole long, bands array<long>").select("whole", F.explode("bands").alias("band"))
    hot = cut(banded.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > longest).select("band"), "hot")
    some = bool(hot.head(1))
    calm = banded.join(hot, "band", "left_anti") if some else banded
    lists = (
        calm.groupBy("band").agg(F.array_sort(F.collect_set("whole")).alias("ids")).where("size(ids) > 1")
        .groupBy("ids").agg(F.lit(1).alias("one")).select(F.xxhash64("ids").alias("list"), F.col("ids"))
    )
    members = lists.select("list", F.explode("ids").alias("whole")).join(alone.select("whole", "sign"), "whole")
    edges = members.groupBy("list").applyInPandas(lambda pdf: _verify(pdf, threshold), "a long, b long")
    working = [signed, alone, hot]
    if some:
        edges = cut(edges, "edges")
        more, read = _hot_edges(banded.join(hot, "band", "left_semi"), alone.select("whole", "sign"), edges, threshold, block)
        edges, working = edges.unionByName(more), [*working, edges, *read]
    roots = components(edges, "near").select(F.col("id").alias("whole"), "root")
    placed = signed.select("doc_id", "version", "whole").join(roots, "whole", "left").withColumn("root", F.coalesce("root", "whole"))
    groups = placed.groupBy("root").agg(F.min(F.struct("doc_id", "whole")).alias("keep"), F.max(F.struct("doc_id", "whole")).alias("last")).where("keep <> last").drop("last")
    found = cut(placed.join(groups, "root").select("doc_id", "version", "whole", "keep"), "copies")
    discard(*working)
    return found


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", longest: int = LIST, block: int = BLOCK) -> DataFrame:
    """(doc_id, keep_id) of every document that has a near copy; keep_id is the least doc_id of its group, also in its own row.

    Two documents are near copies if the weighted Jaccard similarity of their 3-word shingles (letters and digits only,
    ASCII case folded) is estimated at ``threshold`` or more; groups are the connected components. Documents that are
    null, empty or without words are no copies of anything. Rows that repeat a doc_id with the same words count once;
    rows that share a doc_id but not their words are documents of their own, so an id can be in several groups, or in one
    by two texts. Rows without doc_id are left out. An empty table gives an empty result, and other columns are ignored.
    """
    return _groups(docs, threshold, bands, rows, id_col, text_col, longest, block).select("doc_id", F.col("keep.doc_id").alias("keep_id")).distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, longest: int = LIST, block: int = BLOCK) -> DataFrame:
    """Documents without the near copies of a document with a lower id; all columns stay. Rows with a null id stay too.

    Each row goes or stays by its own text: of rows that share an id but not their words one can go and one stay.
    """
    found = _groups(docs, threshold, bands, rows, id_col, text_col, longest, block)
    gone = found.where("doc_id <> keep.doc_id or whole <> keep.whole").select(F.col("doc_id").alias("__near_copy"), F.col("version").alias("__near_version")).distinct()
    own = (docs[id_col].cast("long") == gone["__near_copy"]) & (text_version(docs[text_col].cast("string")) == gone["__near_version"])
    return docs.join(gone, own, "left_anti")
