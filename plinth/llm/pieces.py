"""Sampled SentencePiece segmentation by forward filtering and backward sampling, and lossless decoding.

Pieces of the model hold a space sign only at their beginning, so a text falls into segments (a run of spaces and what
follows it up to the next space) whose lattices are independent. For each distinct segment the forward filter sums over
all segmentations ending at each position; for each occurrence the segmentation is then drawn backwards, piece by piece.
The random numbers are hashes of the row's key and the position in the text, so a row always gets the same pieces,
wherever and in whatever company it is encoded. All segments of a batch are worked on at once. Long segments (text
without spaces) are cut before every character that no piece spans: all paths meet there, so the parts are independent.
Equal segments share a lattice; their bytes are compared, not only their hashes.

A piece of rank r among the model's merges weighs ``(r + 2) ** -alpha``: a large alpha gives the best segmentation, 0
draws all alike. A character that isn't in the vocabulary becomes its UTF-8 bytes, and so does a literal U+2581, which
the model uses as its space sign; that keeps decoding lossless.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from plinth.llm.words import mix, powers, prefix_hash, ranges, slices, span_hash, string_buffers

ALPHA = 0.5
SEED = 17
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 19
#: Segments of more bytes are cut where all paths of their lattice meet, which changes no probability and no draw.
LONG = 64


def default_model() -> str:
    """The public model's path; any SentencePiece model with byte fallback will do."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Model:
    """Tables of a model: the hash of each piece's text, its log weight and its bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        size = m.get_piece_size()
        kinds = [m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(size)]
        self.byte_id = np.full(256, -1, np.int32)
        texts: list[bytes] = [b""] * size
        plain: list[int] = []
        for i in range(size):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                texts[i] = bytes([int(piece[3:5], 16)])
            elif not kinds[i]:
                if "▁" in piece.lstrip("▁"):
                    raise ValueError(f"piece {i} holds a space sign after its beginning")
                texts[i] = piece.replace("▁", " ").encode()
                plain.append(i)
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte fallback")
        self.size = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        ids = np.array(plain)
        prefix = prefix_hash(self.bytes.astype(np.uint64) + np.uint64(1))
        key = mix(span_hash(prefix, self.begin[ids], self.begin[ids] + self.size[ids]))
        order = np.argsort(key)
        self.key, self.id = key[order], ids[order].astype(np.int32)
        if (self.key[1:] == self.key[:-1]).any():
            raise ValueError("two pieces have the same text")
        scores = np.array([m.get_score(i) for i in range(size)])
        self.weight = -np.log(2.0 + np.maximum(0, -scores))
        self.may = np.zeros(1 << 20, bool)
        self.may[(self.key & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.longest = int(self.size[ids].max())
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(t) for t in (texts[i].decode() for i in plain) if len(t) == 1]] = True
        self.known[0x2581] = False


@lru_cache(maxsize=4)
def model(path: str) -> Model:
    return Model(path)


def _code_points(data: np.ndarray, lead: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The characters that begin at ``lead`` and take ``width`` bytes."""
    out = data[lead].astype(np.int64) & np.array([0, 0x7F, 0x1F, 0x0F, 0x07])[width]
    for k in (1, 2, 3):
        more = width > k
        out[more] = out[more] << 6 | (data[lead[more] + k] & 0x3F)
    return out


def _arcs(m: Model, text: np.ndarray, inner: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, length, piece) of every piece that lies within a segment. inner, left: bytes of the segment before and from each byte on."""
    total = len(text)
    prefix = prefix_hash(text.astype(np.uint64) + np.uint64(1))
    at = np.flatnonzero((text & 0xC0) != 0x80)
    ends_char = np.ones(total + 1, bool)
    ends_char[:total] = (text & 0xC0) != 0x80
    inverse = powers(total + 1, np.uint64(pow(int(_GOLD), -1, 2**64)))
    starts, lengths, pieces = [], [], []
    for length in range(1, m.longest + 1):
        at = at[left[at] >= length]
        if not at.size:
            break
        p = at[ends_char[at + length]] if length < total else at
        key = mix((prefix[p + length] - prefix[p]) * inverse[p])
        some = m.may[(key & np.uint64((1 << 20) - 1)).astype(np.int64)]
        p, key = p[some], key[some]
        place = np.minimum(np.searchsorted(m.key, key), len(m.key) - 1)
        hit = m.key[place] == key
        starts.append(p[hit])
        lengths.append(np.full(int(hit.sum()), length, np.int64))
        pieces.append(m.id[place[hit]])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lengths, pieces))


def _cuts(m: Model, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where these segments can be cut: before characters that no piece of the lattice spans, so that every path passes."""
    inner = ranges(size)
    at = np.repeat(begin, size) + inner
    text = data[at]
    start, length, _ = _arcs(m, text, inner, np.repeat(size, size) - inner)
    edge = np.bincount(start + 1, minlength=len(text) + 1) - np.bincount(start + length, minlength=len(text) + 1)
    free = (np.cumsum(edge[: len(text)]) == 0) & ((text & 0xC0) != 0x80) & (inner > 0)
    return at[free]


def _lattice(m: Model, data: np.ndarray, begin: np.ndarray, size: np.ndarray, alpha: float) -> tuple[np.ndarray, ...]:
    """For distinct segments: where each node's arcs begin (node = byte of a segment's end, counted over all), and for each arc its length, piece and cumulative probability."""
    total = int(size.sum())
    inner = ranges(size)
    start, length, piece = _arcs(m, data[np.repeat(begin, size) + inner], inner, np.repeat(size, size) - inner)
    last = start + length - 1
    depth = inner[last] + 1
    order = np.argsort((depth * total + last) * (m.longest + 1) + length)
    start, length, piece, last, depth = (x[order] for x in (start, length, piece, last, depth))
    score = alpha * m.weight[piece]
    forward = np.full(total, -np.inf)
    steps = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]]))
    node = np.concatenate([[True], last[1:] != last[:-1]])
    for a, b in zip(steps[:-1], steps[1:], strict=True):
        before = start[a:b] - 1
        value = score[a:b] + np.where(inner[start[a:b]] == 0, 0.0, forward[before])
        score[a:b] = value
        heads = np.flatnonzero(node[a:b])
        count = np.diff(np.concatenate([heads, [b - a]]))
        most = np.maximum.reduceat(value, heads)
        with np.errstate(invalid="ignore"):
            part = np.add.reduceat(np.exp(value - np.repeat(most, count)), heads)
        forward[last[a:b][heads]] = np.where(np.isfinite(most), most + np.log(part), -np.inf)
    fine = np.isfinite(score) & np.isfinite(forward[last])
    start, length, piece, last, score = (x[fine] for x in (start, length, piece, last, score))
    chance = np.exp(score - forward[last])
    order = np.argsort(last * (m.longest + 1) + m.longest - length)
    length, piece, last, chance = (x[order] for x in (length, piece, last, chance))
    sums = np.cumsum(chance)
    first = np.searchsorted(last, np.arange(total + 1))
    inside = sums - np.concatenate([[0.0], sums])[first[last]]
    final = np.concatenate([last[1:] != last[:-1], [True]])
    inside[final] = 2.0
    return first, length.astype(np.int32), piece, inside


def _segments(head: np.ndarray, spelt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, size) of the segments that pieces can spell."""
    start = np.flatnonzero(head)
    size = np.diff(np.concatenate([start, [len(head)]]))
    normal = ~spelt[start]
    return start[normal], size[normal]


def _distinct(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each segment, a segment of each code). Equal codes have equal bytes: what only has an equal hash gets a code of its own."""
    code, keys = pd.factorize(mix(span_hash(prefix_hash(data.astype(np.uint64) + np.uint64(1)), start, start + size)))
    sample = np.empty(len(keys), np.int64)
    sample[code[::-1]] = np.arange(len(code))[::-1]
    like = sample[code]
    wrong = size[like] != size
    same = np.flatnonzero(~wrong & (like != np.arange(len(code))))
    step = ranges(size[same])
    differ = data[np.repeat(start[same], size[same]) + step] != data[np.repeat(start[like[same]], size[same]) + step]
    if differ.any():
        wrong[np.repeat(same, size[same])[differ]] = True
    odd = np.flatnonzero(wrong)
    code[odd] = len(sample) + np.arange(len(odd))
    return code, np.concatenate([sample, odd])


class Encoder:
    def __init__(self, path: str, alpha: float = ALPHA, seed: int = SEED) -> None:
        self.model, self.alpha, self.seed = model(path), alpha, seed

    def encode(self, keys: np.ndarray, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets by row, whether each row decodes to its text)."""
        m = self.model
        raw, offs = string_buffers(column)
        rows = len(offs) - 1
        filled = np.diff(offs) > 0
        ahead = np.cumsum(filled) - filled
        begin = offs[:-1] + ahead
        end = offs[1:] + ahead + filled
        n = int(end[-1]) if rows else 0
        if not n:
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64), np.ones(rows, bool)
        data = np.empty(n, np.uint8)
        body = np.ones(n, bool)
        body[begin[filled]] = False
        data[~body] = 32
        data[body] = raw
        # Segments begin at runs of spaces, at rows, and around characters that only bytes can spell.
        space = data == 32
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[begin[filled]] = True
        spelt = np.zeros(n, bool)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        value = data[lead]
        width = 1 + (value >= 0xC0) + (value >= 0xE0) + (value >= 0xF0)
        odd = np.flatnonzero((width > 1) | ~m.known[np.minimum(value, 127)])
        lead, width = lead[odd], width[odd]
        strange = ~m.known[_code_points(data, lead, width)]
        lead, width = lead[strange], width[strange]
        head[lead] = True
        after = lead + width
        head[after[after < n]] = True
        spelt[np.repeat(lead, width) + ranges(width)] = True
        tokens = np.full(n, -1, np.int32)
        tokens[spelt] = m.byte_id[data[spelt]]
        start, size = _segments(head, spelt)
        long = size > LONG
        if long.any():
            head[_cuts(m, data, start[long], size[long])] = True
            start, size = _segments(head, spelt)
        if start.size:
            code, sample = _distinct(data, start, size)
            first, length, piece, upto = _lattice(m, data, start[sample], size[sample], self.alpha)
            base = (np.cumsum(size[sample]) - size[sample])[code]
            row = np.searchsorted(end, start, side="right")
            seed = mix(mix(keys.astype(np.int64).view(np.uint64) + np.uint64(self.seed)) + _GOLD)[row]
            shift = start - begin[row]
            left, live = size.copy(), np.arange(len(start))
            while live.size:
                u = mix(seed[live] + (shift[live] + left[live]).astype(np.uint64) * _GOLD)
                u = (u >> np.uint64(11)).astype(np.float64) * 2.0**-53
                arc = first[base[live] + left[live] - 1]
                wait = np.flatnonzero(u >= upto[arc])
                while wait.size:
                    arc[wait] += 1
                    wait = wait[u[wait] >= upto[arc[wait]]]
                left[live] -= length[arc]
                tokens[start[live] + left[live]] = piece[arc]
                live = live[left[live] > 0]
        where = np.flatnonzero(tokens >= 0)
        ids = tokens[where]
        offsets = np.concatenate([np.searchsorted(where, begin), [len(ids)]])
        return ids, offsets, self._lossless(ids, offsets, data, begin, end)

    def _lossless(self, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        m = self.model
        size = m.size[ids]
        decoded = m.bytes[np.repeat(m.begin[ids], size) + ranges(size)]
        at = np.concatenate([[0], np.cumsum(size)])[offsets]
        if len(decoded) == len(data) and (at[:-1] == begin).all() and np.array_equal(decoded, data):
            return np.ones(len(begin), bool)
        return np.array([np.array_equal(decoded[a:b], data[c:d]) for a, b, c, d in zip(at[:-1], at[1:], begin, end, strict=True)], bool)


def decode_ids(path: str, ids: pa.ListArray) -> pa.Array:
    """The text of each list of piece ids; null for null."""
    m = model(path)
    texts = []
    for one in ids:
        if not one.is_valid:
            texts.append(None)
            continue
        flat = np.asarray(one.values, np.int64)
        size = m.size[flat]
        texts.append(m.bytes[np.repeat(m.begin[flat], size) + ranges(size)].tobytes().decode("utf-8", "replace")[1:])
    return pa.array(texts, pa.string())


def _encode(batches: Iterator[pa.RecordBatch], path: str, alpha: float, seed: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path, alpha, seed)
    for batch in slices(batches, "text", _SLICE):
        keys = np.asarray(batch.column("doc_id").fill_null(0))
        ids, offsets, lossless = encoder.encode(keys, batch.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(np.diff(offsets).astype(np.int32)), pa.array(lossless)], names=["doc_id", "pieces", "n_pieces", "lossless"])


def sample_pieces(docs: DataFrame, path: str | None = None, alpha: float = ALPHA, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pieces, n_pieces, lossless): one sampled segmentation of each text, and whether decoding it gave the text.

    Null and empty texts have no pieces and are lossless (null decodes to the empty text); rows with a null key are
    encoded with key 0. Rows with equal key and text get equal pieces. A very long text is encoded whole, with or without
    spaces; a run that has no place to cut (one letter a million times) takes a step a byte. An empty table gives an empty
    result. Other columns are ignored; no shuffle.
    """
    where = path or default_model()
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        partial(_encode, path=where, alpha=alpha, seed=seed), "doc_id long, pieces array<int>, n_pieces int, lossless boolean"
    )


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), decode_ids(path, batch.column("pieces"))], names=["doc_id", "text"])


def decode_pieces(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of what ``sample_pieces`` gave."""
    return encoded.select("doc_id", "pieces").mapInArrow(partial(_decode, path=path or default_model()), "doc_id long, text string")
