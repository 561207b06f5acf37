"""Passages that repeat across a corpus, by a hash-compared suffix sort.

A passage is a run of ``MIN_WORDS`` words (white space aside) that occurs at two places or more. In scripts without
spaces, and in unbroken runs of more than ``LONG_WORD`` bytes, each character is a word. Every window of that
many words is assigned to its anchor: the leftmost word position in it whose ``GRAM``-word hash is least. Equal windows
have equal anchors, so suffixes need only be compared with those whose anchor has the same hash, and anchors whose hash
occurs once are dropped before any text moves. For the others the text around the anchor goes to the anchor's bucket.
There the suffixes that start at the windows are sorted by mergesort. A comparison finds the common extension by binary
search over prefix polynomial hashes, so it takes a logarithmic number of steps; neighbours in the sorted order that
agree in ``MIN_WORDS`` words are repeats, and their words are compared byte by byte before they count. A bucket of more
than ``BUCKET`` contexts is no single task's work: its windows are counted by a digest of 128 bits of their words, with
partial aggregation, which gives the same repeats and first places.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plinth.llm.components import cut, discard, text_version
from plinth.llm.repetition import LONG_WORD
from plinth.llm.words import Words, mix, prefix_hash, ranges, slices, span_hash, tokenise

MIN_WORDS = 50
GRAM = 16
#: Contexts of one anchor that one task sorts; above it the bucket is counted by digest.
BUCKET = 20_000


def _windows(words: Words, min_words: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, its hash, first window, last window) by word position, for all windows of the batch."""
    none = np.zeros(0, np.int64)
    n = len(words.start)
    if n < min_words:
        return none, none.astype(np.uint64), none, none
    prefix = prefix_hash(words.hashes())
    at = np.arange(n - gram + 1)
    value = mix(span_hash(prefix, at, at + gram))
    # Leftmost minimum of the min_words - gram + 1 values from each position on, by doubling.
    width, reach, where = min_words - gram + 1, 1, at
    least = value
    while reach < width:
        step = min(reach, width - reach)
        smaller = least[step:] < least[:-step]
        least, where = np.where(smaller, least[step:], least[:-step]), np.where(smaller, where[step:], where[:-step])
        reach += step
    window = np.flatnonzero(words.first[1:][words.row[: len(where)]] - at[: len(where)] >= min_words)
    if not window.size:
        return none, none.astype(np.uint64), none, none
    where = where[window]
    fresh = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
    last = np.concatenate([window[fresh[1:] - 1], window[-1:]])
    return where[fresh], value[where[fresh]], window[fresh], last


def _packed(version: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Version and word position in one number, which a shuffle carries at the price of a position."""
    return version.astype(np.int64) << 32 | at.astype(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch], min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = tokenise(batch.column("text"), split_over=LONG_WORD, characters=True)
        anchor, value, _, _ = _windows(words, min_words, gram)
        if anchor.size:
            row = words.row[anchor]
            place = _packed(np.asarray(batch.column("version"))[row], anchor - words.first[row])
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), batch.column("doc_id").take(pa.array(row)), pa.array(place)], names=["gram", "doc_id", "place"])


def _spaced(words: Words, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, size of each) of the words low..high-1 with a space after each, so that plain white space tells them apart."""
    count = high - low
    at = np.repeat(low, count) + ranges(count)
    size = words.end[at] - words.start[at] + 1
    text = words.data[np.minimum(np.repeat(words.start[at], size) + ranges(size), len(words.data) - 1)]
    text[np.cumsum(size) - 1] = 32
    return text, np.add.reduceat(size, np.cumsum(count) - count) if len(count) else count


def _contexts(batches: Iterator[pa.RecordBatch], min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The text around the wanted anchors; their positions come as -1 - position where the bucket is hot."""
    for batch in slices(batches, "text"):
        words = tokenise(batch.column("text"), split_over=LONG_WORD, characters=True)
        anchor, value, low, high = _windows(words, min_words, gram)
        if not anchor.size:
            continue
        wanted = batch.column("places")
        counts = np.diff(np.asarray(wanted.offsets))
        marked = np.asarray(wanted.flatten())
        hot = marked < 0
        places = np.repeat(words.first[:-1], counts) + np.where(hot, -1 - marked, marked)
        some = np.isin(anchor, places)
        anchor, value, low, high = anchor[some], value[some], low[some], high[some]
        hot = np.isin(anchor, places[hot])
        row, first = words.row[anchor], words.first[words.row[anchor]]
        if ((words.start[1:] == words.end[:-1]) & (words.row[1:] == words.row[:-1])).any():
            text, size = _spaced(words, low, high + min_words)
        else:
            begin, end = words.start[low], words.end[high + min_words - 1]
            size = end - begin
            text = words.data[np.repeat(begin, size) + ranges(size)]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        context = pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(value.view(np.int64)), batch.column("doc_id").take(pa.array(row)), pa.array(_packed(np.asarray(batch.column("version"))[row], low - first)), pa.array((anchor - low).astype(np.int32)), pa.array(hot), context],
            names=["gram", "doc_id", "place", "lead", "hot", "context"],
        )


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Number of equal words from a and b on, at most ``most``, by binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), most)
    for _ in range(int(most).bit_length()):
        middle = (low + high + 1) // 2
        equal = span_hash(prefix, a, a + middle) == span_hash(prefix, b, b + middle)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        high = np.maximum(low, high)
    return low


def _before(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray, place: np.ndarray, whole: np.ndarray, prefix: np.ndarray, word: np.ndarray, length: int) -> np.ndarray:
    """Whether suffix x sorts before y (or is equal, where ``or_equal``), looking at ``length`` words."""
    out = or_equal.copy()
    other = np.flatnonzero(whole[x] != whole[y])
    a, b = place[x[other]], place[y[other]]
    shared = np.minimum(common_extension(prefix, a, b, length), length - 1)
    out[other] = word[a + shared] < word[b + shared]
    return out


def merge_sort(group: np.ndarray, place: np.ndarray, whole: np.ndarray, prefix: np.ndarray, word: np.ndarray, length: int) -> np.ndarray:
    """Stable order of the suffixes at ``place`` within each group (groups are contiguous).

    Bottom-up mergesort of all groups at once: each element's place in a merged run is its own index plus its rank in the
    neighbouring run, which is found by binary search with hash-compared suffixes.
    """
    n = len(place)
    order = np.arange(n)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([begin, [n]]))
    run = 1
    while (big := size > run).any():
        slot = np.repeat(begin[big], size[big]) + ranges(size[big])
        offset = slot - np.repeat(begin[big], size[big])
        total = np.repeat(size[big], size[big])
        pair = offset // (2 * run) * (2 * run)
        left = offset - pair < run
        low = np.where(left, np.minimum(pair + run, total), pair)
        high = np.where(left, np.minimum(pair + 2 * run, total), np.minimum(pair + run, total))
        base, start = slot - offset, low.copy()
        item = order[slot]
        live = np.flatnonzero(low < high)
        while live.size:
            middle = (low[live] + high[live]) // 2
            other = order[base[live] + middle]
            # A left element goes before equal right ones, a right one after equal left ones.
            goes = _before(other, item[live], ~left[live], place, whole, prefix, word, length)
            low[live] = np.where(goes, middle + 1, low[live])
            high[live] = np.where(goes, high[live], middle)
            live = live[low[live] < high[live]]
        own = np.where(left, offset - pair, offset - pair - run)
        order[base + pair + own + low - start] = item
        run *= 2
    return order


def bucket_repeats(gram: np.ndarray, doc: np.ndarray, place: np.ndarray, lead: np.ndarray, context: pa.Array, min_words: int) -> pd.DataFrame:
    """Repeats among contexts that come sorted by (gram, doc, place): doc_id, version, start, end in words, whether it's the first place, and the document of that."""
    version, low = (place >> 32).astype(np.int32), (place & 0xFFFFFFFF).astype(np.int32)
    words = tokenise(context)
    hashes = words.hashes()
    prefix = prefix_hash(hashes)
    count = np.maximum(np.diff(words.first) - min_words + 1, 0)
    member, window = np.repeat(np.arange(len(doc)), count), ranges(count)
    bucket = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]]))
    code = bucket[member] * (2 * min_words) + lead[member] - window
    order = np.argsort(code, kind="stable")
    code = code[order]
    same = np.concatenate([[False], code[1:] == code[:-1], [False]])
    some = order[same[1:] | same[:-1]]
    group = code[same[1:] | same[:-1]]
    member, window = member[some], window[some]
    suffix = words.first[member] + window
    whole = span_hash(prefix, suffix, suffix + min_words)
    order = merge_sort(group, suffix, whole, prefix, hashes, min_words)
    member, window, whole = member[order], window[order], whole[order]
    fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (whole[1:] != whole[:-1])]) if len(order) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    alone = fresh & np.concatenate([fresh[1:], [True]])[: len(order)]
    found = pd.DataFrame({"member": member, "window": window, "first": member[head], "at": window[head]})[~alone].sort_values(["member", "first", "window"])
    m, w, f, a = (found[k].to_numpy() for k in ("member", "window", "first", "at"))
    if not len(m):
        return pd.DataFrame({"doc_id": doc[:0], "version": version[:0], "start": low[:0], "end": low[:0], "kept": np.zeros(0, bool), "first_doc_id": doc[:0]})
    cuts = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (f[1:] != f[:-1]) | (w[1:] != w[:-1] + 1) | (a[1:] - w[1:] != a[:-1] - w[:-1])]))
    m, f, w0, a0, span = m[cuts], f[cuts], w[cuts], a[cuts], np.diff(np.concatenate([cuts, [len(w)]])) + min_words - 1
    x, y = words.first[m] + w0, words.first[f] + a0
    text = words.data.tobytes()
    true = np.fromiter((i == j or text[p:q] == text[r:s] or text[p:q].split() == text[r:s].split() for i, j, p, q, r, s in zip(m.tolist(), f.tolist(), words.start[x].tolist(), words.end[x + span - 1].tolist(), words.start[y].tolist(), words.end[y + span - 1].tolist(), strict=True)), bool, len(m))
    out = pd.DataFrame({"doc_id": doc[m], "version": version[m], "start": low[m] + w0, "end": low[m] + w0 + span, "kept": m == f, "first_doc_id": doc[f]})
    # What a row repeats of itself at the very same place (rows with one doc_id and text twice) is kept, as the first is.
    out["kept"] |= (doc[m] == doc[f]) & (version[m] == version[f]) & (low[m] + w0 == low[f] + a0)
    return out[true]


def _repeats(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Buckets come whole: rows are sorted by gram, and the last gram of a batch waits for the next one."""
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("kept", pa.bool_()), ("first_doc_id", pa.int64())])

    def work(table: pa.Table) -> pa.RecordBatch:
        gram, doc, place, lead = (np.asarray(table.column(k)) for k in ("gram", "doc_id", "place", "lead"))
        found = bucket_repeats(gram, doc, place, lead, table.column("context").combine_chunks(), min_words)
        return pa.RecordBatch.from_pandas(found, schema, preserve_index=False)

    held: pa.Table | None = None
    for batch in slices(batches, "context", 1 << 20):
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        gram = np.asarray(held.column("gram"))
        tail = int(np.searchsorted(gram, gram[-1]))
        if tail:
            yield work(held.slice(0, tail))
            held = held.slice(tail)
    if held is not None:
        yield work(held)


def _digests(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, place, digest) of each window of the contexts."""
    for batch in slices(batches, "context", 1 << 20):
        words = tokenise(batch.column("context"))
        count = np.maximum(np.diff(words.first) - min_words + 1, 0)
        member, window = np.repeat(np.arange(batch.num_rows), count), ranges(count)
        first = words.first[member] + window
        text = words.data.tobytes()
        digest = [blake2b(b" ".join(text[a:b].split()), digest_size=16).digest() for a, b in zip(words.start[first].tolist(), words.end[first + min_words - 1].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(member)), pa.array(np.asarray(batch.column("place"))[member] + window), pa.array(digest, pa.binary())], names=["doc_id", "place", "digest"])


def _counted(contexts: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """The repeats of hot buckets, window by window: what ``_repeats`` gives, before spans are merged; and the table of repeated digests, to be discarded.

    The digests are written, so Spark knows their size and broadcasts them only if that is small.
    """
    windows = contexts.select("doc_id", "place", "context").mapInArrow(partial(_digests, min_words=min_words), "doc_id long, place long, digest binary")
    one = windows.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "place")).alias("first")).where("n > 1").drop("n")
    one = cut(one, "digests")
    start = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    kept = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("place") == F.col("first.place"))
    return windows.join(one, "digest").select("doc_id", F.shiftright("place", 32).cast("int").alias("version"), start.alias("start"), (start + min_words).alias("end"), kept.alias("kept"), F.col("first.doc_id").alias("first_doc_id")), one


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(doc_id, version, start_word, end_word, kept, first_doc_id): the spans of each document that repeat ``min_words`` words or more of the corpus.

    Spans are counted in white-space separated words (characters where text is unbroken), end excluded; overlapping spans of one kind are merged. ``kept``
    is true for the first place of a passage (least doc_id, then version, then position) and false for its repeats, whose
    words ``drop_repeated_passages`` removes; first_doc_id is the least document with a first place in the span. A document
    that repeats itself counts too. Null and empty texts, and texts of fewer words, have no spans. Rows with equal
    doc_id and text are one document's; rows with one doc_id and different texts are documents of their own, which
    ``version`` (a hash of the text) tells apart. Rows without doc_id have no spans. An empty table gives an empty
    result; other columns are ignored.
    """
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).where("doc_id is not null and text is not null").withColumn("version", text_version(F.col("text")))
    anchors = cut(texts.mapInArrow(partial(_anchors, min_words=min_words, gram=gram), "gram long, doc_id long, place long"), "anchors")
    often = cut(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "often")
    hot = F.col("n") > bucket
    pos = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    wanted = anchors.join(often, "gram").select("doc_id", F.shiftright("place", 32).cast("int").alias("version"), F.when(hot, -1 - pos).otherwise(pos).alias("pos"))
    places = wanted.groupBy("doc_id", "version").agg(F.collect_list("pos").alias("places"))
    contexts = texts.join(places, ["doc_id", "version"]).mapInArrow(partial(_contexts, min_words=min_words, gram=gram), "gram long, doc_id long, place long, lead int, hot boolean, context string")
    some = bool(often.where(hot).head(1))
    working = [anchors, often]
    if some:
        contexts = cut(contexts, "contexts")
        working.append(contexts)
    calm = contexts.where("not hot").drop("hot")
    spans = calm.repartition("gram").sortWithinPartitions("gram", "doc_id", "place").mapInArrow(partial(_repeats, min_words=min_words), "doc_id long, version int, start int, end int, kept boolean, first_doc_id long")
    if some:
        counted, digests = _counted(contexts.where("hot"), min_words)
        working.append(digests)
        spans = spans.unionByName(counted)
    order = W.partitionBy("doc_id", "version", "kept").orderBy("start", "end")
    island = spans.withColumn("fresh", (F.col("start") > F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))).cast("int")).withColumn("island", F.sum(F.coalesce("fresh", F.lit(0))).over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = island.groupBy("doc_id", "version", "kept", "island").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("first_doc_id").alias("first_doc_id"))
    found = cut(merged.select("doc_id", "version", "start_word", "end_word", "kept", "first_doc_id"), "spans")
    discard(*working)
    return found


def _remove(batches: Iterator[pa.RecordBatch], text: str, length: str | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text):
        words = tokenise(batch.column(text), split_over=LONG_WORD, characters=True)
        spans = batch.column("__spans")
        touched = np.flatnonzero(np.diff(np.asarray(spans.offsets)) > 0)
        values = batch.column(text).to_pylist() if touched.size else None
        sizes = batch.column(length).to_pylist() if length and touched.size else None
        keep = np.ones(batch.num_rows, bool)
        for r in touched:
            raw = words.data[words.offsets[r] : words.offsets[r + 1]].tobytes()
            start = words.start[words.first[r] : words.first[r + 1]] - words.offsets[r]
            parts, at = [], 0
            for span in sorted((s["start"], s["end"]) for s in spans[int(r)].as_py()):
                parts.append(raw[at : start[span[0]]])
                at = start[span[1]] if span[1] < len(start) else len(raw)
            values[r] = b"".join([*parts, raw[at:]]).decode()
            keep[r] = bool(values[r].strip())
            if sizes:
                sizes[r] = len(values[r])
        columns = []
        for name in names:
            column = batch.column(name)
            if touched.size and name == text:
                column = pa.array(values, column.type)
            elif touched.size and name == length:
                column = pa.array(sizes, column.type)
            columns.append(column)
        yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))


def drop_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", bucket: int = BUCKET) -> DataFrame:
    """The documents without the words of repeated passages (see ``repeated_passages``); first places stay.

    All columns stay as they are, but for the text and, if there is one, ``length_col``, its length in characters. A
    document of which no word is left goes; rows with null or repeated ids are kept or cut each by its own text.
    """
    found = repeated_passages(docs, min_words, gram, id_col, text_col, bucket).where("not kept")
    spans = found.groupBy(F.col("doc_id").alias("__span_doc"), F.col("version").alias("__span_version")).agg(F.collect_list(F.struct(F.col("start_word").alias("start"), F.col("end_word").alias("end"))).alias("__spans"))
    own = (docs[id_col].cast("long") == spans["__span_doc"]) & (text_version(docs[text_col].cast("string")) == spans["__span_version"])
    both = docs.join(spans, own, "left").drop("__span_doc", "__span_version")
    length = length_col if length_col in docs.columns else None
    return both.mapInArrow(partial(_remove, text=text_col, length=length, names=docs.columns), docs.schema)
