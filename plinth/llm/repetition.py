"""Quality rules from a suffix array: how much of a text is made of repeats of itself.

For every document a suffix array over its words is built by prefix doubling, neighbouring suffixes give the
longest-common-prefix intervals, and these the maximal repeated word sequences. The union of their spans gives the
covered fraction; a document is rejected if that fraction or its longest repeat is above a limit. ``min_repeated`` spares
documents with fewer repeated words than it names; the query and the pipeline set it to 0, so both limits hold at every
length there.

Defined results: a null or empty text, or one without words, has 0 words, fraction 0.0, longest repeat 0 and is kept.
Equal rows get equal results each. Text without spaces is judged too: of the scripts that have none, each character is a
unit that counts half a word; an unbroken run of more than ``LONG_WORD`` bytes falls into characters that count
1/``LONG_WORD`` of a word a byte, so a run of 64 bytes counts as 1 word and one of 65 as 1.016: nothing jumps at that
size. Other columns are passed through or ignored, whatever their names are.

Common prefixes are found by binary search over prefix hashes and then compared word by word where they begin anew (the
irreducible ones, whose lengths sum up to 2 n log n at most; each of the others follows from the one before it), so no
collision of hashes can invent a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from plinth.llm.words import mix, prefix_hash, ranges, slices, span_hash, tokenise

MIN_WORDS = 6
MAX_FRACTION = 0.5
MAX_LONGEST = 0.35
#: Fewer repeated words than this are no evidence against a short text, unless a caller sets ``min_repeated``.
MIN_REPEATED = 24
#: Bytes of an unbroken run that count as one word.
LONG_WORD = 64


def suffix_order(ids: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions sorted by the suffix ids[p:end[p]].

    ids are at least 1 and documents have disjoint, ascending ids, so the order also goes by document. The first sort
    takes three words at once; then only ties are sorted again, by the rank of what follows (prefix doubling).
    """
    n = len(ids)
    bits = np.uint64(max(1, int(ids.max()).bit_length()))
    width = 3 if int(bits) * 3 <= 64 else 2
    padded = np.concatenate([ids, np.zeros(width, ids.dtype)]).astype(np.uint64)
    key = padded[:n].copy()
    at = np.arange(n)
    for k in range(1, width):
        key <<= bits
        key |= np.where(at + k < end, padded[k : n + k], np.uint64(0))
    order = np.argsort(key)
    held = key[order]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(held[1:], held[:-1], out=new[1:])
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0
    heads = np.maximum.accumulate(np.where(new, at, 0))
    rank[order] = heads + 1
    same = ~new
    tied = same.copy()
    tied[:-1] |= same[1:]
    slot = np.flatnonzero(tied)
    step = width
    while slot.size:
        p = order[slot]
        follow = p + step
        second = rank[np.where(follow < end[p], follow, n)]
        lead = rank[p]
        again = np.lexsort((second, lead))
        p, lead, second = p[again], lead[again], second[again]
        order[slot] = p
        fresh = np.empty(len(p), bool)
        fresh[0] = True
        fresh[1:] = (lead[1:] != lead[:-1]) | (second[1:] != second[:-1])
        rank[p] = np.maximum.accumulate(np.where(fresh, slot, 0)) + 1
        same = ~fresh
        tied = same.copy()
        tied[:-1] |= same[1:]
        slot = slot[tied]
        step *= 2
    return order


def common_prefix(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes a and b, at most ``most``: binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (open_ := low < high).any():
        middle = np.where(open_, (low + high + 1) // 2, low)
        equal = span_hash(prefix, a, a + middle) == span_hash(prefix, b, b + middle)
        low = np.where(open_ & equal, middle, low)
        high = np.where(open_ & ~equal, middle - 1, high)
    return low


def verified_prefix(ids: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """``length`` made exact. (a, b) are neighbours among sorted suffixes that claim ``length`` equal words; floor: the first word of each pair's document.

    A pair whose preceding words are equal too goes on from the pair one word before it, which is among the neighbours as
    well; only the others are compared, in one flat array.
    """
    inner = (a > floor) & (b > floor)
    follows = inner & (ids[np.maximum(a, 1) - 1] == ids[np.maximum(b, 1) - 1])
    out = length.copy()
    fresh = np.flatnonzero(~follows)
    wrong = False
    for part in np.array_split(fresh, max(1, int(length[fresh].sum() // 4_000_000))):
        size = length[part]
        step = ranges(size)
        differ = ids[np.repeat(a[part], size) + step] != ids[np.repeat(b[part], size) + step]
        if differ.any():
            wrong = True
            at = np.repeat(np.arange(len(part)), size)[differ]
            first = size.copy()
            np.minimum.at(first, at, step[differ])
            out[part] = first
    if wrong:
        order = np.argsort(b)
        head = np.maximum.accumulate(np.where(follows[order], 0, np.arange(len(order))))
        source = order[head]
        chained = np.maximum(out[source] - (b[order] - b[source]), 0)
        out[order] = np.where(follows[order], np.minimum(out[order], chained), out[order])
    return out


def batch_repeats(column: pa.Array, min_words: int) -> dict[str, np.ndarray]:
    """Per row: words, fraction of the words' bytes inside repeats of min_words words or more, words of the longest, units in repeats."""
    words = tokenise(column, split_over=LONG_WORD, characters=True, weigh=True)
    rows, n = len(words.first) - 1, len(words.start)
    fraction, longest, repeated = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    sums = np.concatenate([[0.0], np.cumsum(words.weight)])
    count = sums[words.first[1:]] - sums[words.first[:-1]]
    if n:
        hashes = words.hashes()
        ids = pd.factorize(mix(hashes + words.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))[0] + 1
        end = words.first[1:][words.row]
        order = suffix_order(ids, end)
        prefix = prefix_hash(hashes)
        a, b = order[:-1], order[1:]
        most = np.minimum(end[a] - a, end[b] - b)
        # No word weighs more than 1, so a repeat that weighs min_words has as many words or more.
        near = np.flatnonzero((words.row[a] == words.row[b]) & (most >= min_words))
        a, b, most = a[near], b[near], most[near]
        alike = span_hash(prefix, a, a + min_words) == span_hash(prefix, b, b + min_words)
        a, b, most = a[alike], b[alike], most[alike]
        length = verified_prefix(ids, a, b, common_prefix(prefix, a, b, most), words.first[words.row[a]])
        heavy = sums[a + length] - sums[a] >= min_words - 1e-6
        a, b, length = a[heavy], b[heavy], length[heavy]
        np.maximum.at(longest, words.row[a], sums[a + length] - sums[a])
        edge = np.zeros(n + 1, np.int64)
        for p in (a, b):
            np.add.at(edge, p, 1)
            np.add.at(edge, p + length, -1)
        covered = np.cumsum(edge[:-1]) > 0
        repeated = np.bincount(words.row, covered, rows)
        size = (words.end - words.start).astype(float)
        total = np.bincount(words.row, size, rows)
        inside = np.bincount(words.row, size * covered, rows)
        fraction = np.divide(inside, total, out=np.zeros(rows), where=total > 0)
    return {"words": count, "fraction": fraction, "longest": longest, "repeated": repeated}


def _whole(values: np.ndarray) -> np.ndarray:
    return np.rint(values).astype(np.int64)


def _keeps(found: dict[str, np.ndarray], max_fraction: float, max_longest: float, min_repeated: int) -> np.ndarray:
    mild = (found["fraction"] <= max_fraction) & (found["longest"] <= max_longest * found["words"] + 1e-6)
    return mild | (found["repeated"] < min_repeated)


def _score(batches: Iterator[pa.RecordBatch], min_words: int, max_fraction: float, max_longest: float, min_repeated: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = batch_repeats(batch.column("text"), min_words)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(_whole(found["words"])), pa.array(found["fraction"]), pa.array(_whole(found["longest"])), pa.array(_keeps(found, max_fraction, max_longest, min_repeated))],
            names=["doc_id", "n_words", "repeated_fraction", "longest_repeat", "kept"],
        )


def repetition_scores(docs: DataFrame, min_words: int = MIN_WORDS, max_fraction: float = MAX_FRACTION, max_longest: float = MAX_LONGEST, id_col: str = "doc_id", text_col: str = "text", min_repeated: int = MIN_REPEATED) -> DataFrame:
    """(doc_id, n_words, repeated_fraction, longest_repeat, kept), one row per document; no shuffle.

    n_words and longest_repeat are in words, to whole ones; ``kept`` is false where repeated_fraction is above ``max_fraction`` or longest_repeat
    above ``max_longest`` times n_words, and at least ``min_repeated`` words are repeated. What ``min_repeated`` spares can
    be told from the figures: it is kept though one of them is above its limit.
    """
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        partial(_score, min_words=min_words, max_fraction=max_fraction, max_longest=max_longest, min_repeated=min_repeated),
        "doc_id long, n_words long, repeated_fraction double, longest_repeat long, kept boolean",
    )


def _filter(batches: Iterator[pa.RecordBatch], text: str, min_words: int, max_fraction: float, max_longest: float, min_repeated: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text):
        kept = batch.filter(pa.array(_keeps(batch_repeats(batch.column(text), min_words), max_fraction, max_longest, min_repeated)))
        if kept.num_rows:
            yield kept


def drop_repetitive(docs: DataFrame, min_words: int = MIN_WORDS, max_fraction: float = MAX_FRACTION, max_longest: float = MAX_LONGEST, text_col: str = "text", min_repeated: int = MIN_REPEATED) -> DataFrame:
    """The documents that ``repetition_scores`` keeps, with all their columns; no join and no shuffle."""
    return docs.mapInArrow(partial(_filter, text=text_col, min_words=min_words, max_fraction=max_fraction, max_longest=max_longest, min_repeated=min_repeated), docs.schema)
