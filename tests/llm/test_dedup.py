from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plinth.llm import components, dartminhash, embedding_dedup, suffix_dedup
from plinth.llm.hnsw import Graph
from plinth.llm.words import tokenise

WORDS = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmnpr"]
DOC = "doc_id long, text string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, share):
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split())


def tokens(text):
    return [w.lower() for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text)]


def shingles(text):
    w = tokens(text)
    return collections.Counter(tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))) if w else collections.Counter()


def weighted_jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / max(1, sum(max(a[k], b[k]) for k in keys))


def groups(ids, alike):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in alike:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    found = collections.defaultdict(list)
    for i in ids:
        found[find(i)].append(i)
    return {i: r for r, m in found.items() if len(m) > 1 for i in m}


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (3, 2), (None, 4)] + [(k, k + 1) for k in range(100, 140)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["id"]: r["root"] for r in got} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {k: 100 for k in range(100, 141)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(3)
    base = prose(rng, 300) + " " + "same words here " * 15
    texts = [base, *(edited(rng, base, s) for s in (0.02, 0.1, 0.3)), prose(rng, 20), "one", base.upper() + "!"]
    has, sign = dartminhash.signatures(pa.array(texts), 2000)
    assert list(has) == list(range(len(texts)))
    sets = [shingles(t) for t in texts]
    for a in range(len(texts)):
        for b in range(a):
            assert (sign[a] == sign[b]).mean() == pytest.approx(weighted_jaccard(sets[a], sets[b]), abs=0.05)
    assert (sign[0] == sign[6]).all()
    # A row's signature doesn't depend on its company.
    assert (dartminhash.signatures(pa.array(texts[2:3]), 2000)[1][0] == sign[2]).all()


def near_table():
    rng = random.Random(11)
    rows, k = [], 0
    for _ in range(40):
        base = prose(rng, rng.randrange(40, 200))
        rows.append((k, base))
        for c in range(rng.choice([0, 0, 1, 2, 12])):
            k += 1
            rows.append((k, base if c % 3 == 0 else edited(rng, base, 0.04)))
        k += 1
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_table()
    sets = {i: shingles(t) for i, t in rows}
    true = [(a, b) for a in sets for b in sets if b < a and weighted_jaccard(sets[a], sets[b]) >= dartminhash.THRESHOLD]
    got = {r["doc_id"]: r["keep_id"] for r in dartminhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert sum(a in got and got[a] == got.get(b) for a, b in true) >= 0.95 * len(true)
    loose = groups(sets, [(a, b) for a in sets for b in sets if b < a and weighted_jaccard(sets[a], sets[b]) >= dartminhash.THRESHOLD - 0.15])
    assert set(got) <= set(loose)


def test_near_duplicates_of_odd_rows(spark):
    long = prose(random.Random(1), 20000)
    rows = [(1, None, "x"), (2, "", "x"), (3, " .!? ", "y"), (4, "", "y"), (5, "short", "z"), (6, "short", "z"), (7, long, None), (8, long, None), (None, "short", "n"), (9, "alone in here with words", "q"), (9, "alone in here with words", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, band string").withColumnRenamed("band", "sign")
    got = {r["doc_id"]: r["keep_id"] for r in dartminhash.near_duplicates(df).collect()}
    assert got == {5: 5, 6: 5, 7: 7, 8: 7}
    kept = dartminhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 9, 9]
    assert dartminhash.near_duplicates(df.limit(0)).count() == 0


def brute_windows(rows, length):
    seen = collections.defaultdict(list)
    for i, text in sorted({r for r in rows if r[1] is not None and r[0] is not None}):
        w = text.split()
        for k in range(len(w) - length + 1):
            seen[tuple(w[k : k + length])].append((i, k))
    out = collections.defaultdict(lambda: (set(), set()))
    for places in seen.values():
        if len(places) > 1:
            for n, (i, k) in enumerate(sorted(places)):
                out[i][n > 0].update(range(k, k + length))
    return dict(out)


def spans(df):
    out = collections.defaultdict(lambda: (set(), set()))
    for r in df.collect():
        out[r["doc_id"]][not r["kept"]].update(range(r["start_word"], r["end_word"]))
    return dict(out)


def passages():
    rng = random.Random(7)
    shared = [prose(rng, n) for n in (12, 20, 35, 60)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(shared), prose(rng, rng.randrange(0, 30))]
        rows.append((i, "  \n".join(parts)))
    return [*rows, (60, shared[3]), (61, shared[3]), (62, "tick tock " * 40), (63, None), (64, ""), (65, "few words")]


def test_repeated_passages_against_brute_force(spark):
    rows = passages()
    got = spans(suffix_dedup.repeated_passages(spark.createDataFrame(rows, DOC), min_words=12, gram=5))
    assert got == brute_windows(rows, 12)


def test_repeats_in_one_bucket_are_sorted_right():
    """Many suffixes with one anchor: the merge sort has several levels to do."""
    rng = random.Random(2)
    core = prose(rng, 6)
    rows = [(i, f"{prose(rng, 5)} {rng.choice(['x y', 'x z', 'w'])} {core} {rng.choice(['p q r', 'p q', 's'])} {prose(rng, 1)} tail end here now") for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    words = suffix_dedup.tokenise(batch.column("text"))
    order = suffix_dedup.merge_sort(np.zeros(200, int), words.first[:-1], suffix_dedup.span_hash(p := suffix_dedup.prefix_hash(words.hashes()), words.first[:-1], words.first[:-1] + 8), p, words.hashes(), 8)
    keys = [tuple(words.hashes()[f : f + 8].tolist()) for f in words.first[:-1]]
    assert [keys[o] for o in order] == sorted(keys) and sorted(order) == list(range(200))


def test_removal_keeps_first_places(spark):
    rows = [(i, t, "s", len(t or "")) for i, t in passages()]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars int")
    got = {r["doc_id"]: r for r in suffix_dedup.drop_repeated_passages(df, 12, 5).collect()}
    brute = brute_windows([r[:2] for r in rows], 12)
    for i, text, _, _ in rows:
        gone = brute.get(i, ((), set()))[1]
        want = [w for k, w in enumerate((text or "").split()) if k not in gone]
        assert (got[i]["text"] or "").split() == want if i in got else not want
        if i in got:
            assert got[i]["n_chars"] == len(got[i]["text"] or "")
    again = suffix_dedup.repeated_passages(spark.createDataFrame([(i, r["text"]) for i, r in got.items()], DOC), 12, 5)
    assert again.where("not kept").count() <= 2  # only what removal itself brought together
    assert suffix_dedup.repeated_passages(df.limit(0), 12, 5).count() == 0
    twice = spark.createDataFrame([(1, prose(random.Random(4), 30))] * 2, DOC)
    assert suffix_dedup.drop_repeated_passages(twice, 12, 5).count() == 2


def unbroken(rng, n, low=0x4E00, high=0x9F00):
    return "".join(chr(rng.randrange(low, high)) for _ in range(n))


def test_words_of_unbroken_text():
    def words(text, **how):
        w = tokenise(pa.array([text, text]), split_over=64, characters=True, **how)
        found = [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end, strict=True)]
        assert found[: len(found) // 2] == found[len(found) // 2 :]
        return found[: len(found) // 2]

    assert words("ab你好,x é。世 ไท", signs=True) == ["ab", "你", "好", "x", "é", "世", "ไ", "ท"]
    assert words("ab你好,x é。世") == ["ab", "你", "好", ",x", "é", "。", "世"]
    assert words("é" * 33) == ["é"] * 33 and words("é" * 32) == ["é" * 32] and words("“a” b…", signs=True) == ["a", "b"]


def test_near_copies_of_unbroken_text(spark):
    rng = random.Random(21)
    rows, want = [], {}
    for k, one in enumerate([unbroken(rng, 200), unbroken(rng, 200, 0xE01, 0xE2F), unbroken(rng, 400, 0x61, 0x7B)]):
        rows += [(10 * k, one), (10 * k + 1, one[:100] + "x" + one[101:]), (10 * k + 2, unbroken(rng, 200))]
        want |= {10 * k: 10 * k, 10 * k + 1: 10 * k}
    assert {r["doc_id"]: r["keep_id"] for r in dartminhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()} == want


def test_repeated_passages_of_unbroken_text(spark):
    rng = random.Random(22)
    for shared, low, high in ((unbroken(rng, 80), 0x4E00, 0x9F00), (unbroken(rng, 80, 0x61, 0x7B), 0x61, 0x7B), (unbroken(rng, 80, 0x3C9, 0x3CF), 0x61, 0x7B)):
        rows = [(k, unbroken(rng, 90 + k, low, high) + shared + unbroken(rng, 70 + k, low, high)) for k in range(3)] + [(9, prose(rng, 80))]
        df = spark.createDataFrame(rows, DOC)
        want = brute_windows([(k, t if k == 9 else " ".join(t)) for k, t in rows], 50)
        assert spans(suffix_dedup.repeated_passages(df)) == want and set(range(92, 172)) <= want[2][1]
        texts = {r["doc_id"]: r["text"] for r in suffix_dedup.drop_repeated_passages(df).collect()}
        assert texts == {k: t if k == 9 else "".join(c for at, c in enumerate(t) if at not in want[k][1]) for k, t in rows}


def vectors(n=900, dim=16, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for group in (range(0, 60), range(100, 104), range(200, 202)):
        for k in group:
            x[k] = x[group[0]] + rng.normal(size=dim) * 0.05
    return x


def test_graph_recall():
    x = vectors(600).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = Graph.build(np.arange(600), x)
    y = x[g.order]
    inner = y @ y.T
    true = np.argsort(-inner, axis=1)[:, :10]
    found, _ = g.search(y, 48)
    assert np.mean([len(set(found[i, :10]) & set(true[i])) / 10 for i in range(600)]) > 0.9


def test_embedding_groups_against_brute_force(spark):
    x = vectors()
    rows = [(k, [float(v) for v in row], 0) for k, row in enumerate(x)]
    odd = [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [float("nan")] * 16, 0), (2004, [1.0, 2.0], 0), (2005, [2.0, 4.0], 0), (None, rows[0][1], 0), rows[0], (2006, [1.0, None] * 8, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, shard int")
    y = np.array([r[1] for r in rows], np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(y @ y.T >= 0.95, 1))
    want = groups(range(len(y)), zip(a.tolist(), b.tolist(), strict=True)) | {2004: 2004, 2005: 2004}
    got = {r["vec_id"]: r["keep_id"] for r in embedding_dedup.embedding_near_duplicates(df, shard_size=250).collect()}
    assert got == want
    assert embedding_dedup.embedding_near_duplicates(df.limit(0)).count() == 0


class ShortSighted(Graph):
    """Finds nothing with a narrow beam, as a badly connected graph might."""

    def search(self, queries, beam):
        nodes, score = super().search(queries, beam)
        return (nodes, score) if beam >= 20 else (np.full_like(nodes, -1), np.full_like(score, -2))


def test_beams_widen_until_the_audit_passes():
    x = vectors(700).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    good = Graph.build(np.arange(700), x)
    true = (good.vectors @ good.vectors.T >= 0.4).sum()
    q, _, beam = embedding_dedup.found_pairs(good, good.vectors, np.arange(700), 0.4, beam=2, target=0.97)
    assert beam == 2 and len(q) >= 0.97 * true  # each full beam widens by itself
    poor = ShortSighted(good.vectors, good.links, 0)
    q, _, beam = embedding_dedup.found_pairs(poor, good.vectors, np.arange(700), 0.4, beam=2, target=0.97)
    assert beam == 32 and len(q) >= 0.97 * true


def test_hot_bands_lose_no_link(spark):
    """Bands of more members than one task may compare: stars, then blocks of what isn't joined yet."""
    rng = random.Random(31)
    base = prose(rng, 120)
    rows = [(k, edited(rng, base, 0.03)) for k in range(40)] + [(100 + k, prose(rng, 60)) for k in range(10)]
    tail = base.split()
    rows += [(200 + k, " ".join([*tail[:70], *prose(rng, 50).split()])) for k in range(12)]
    df = spark.createDataFrame(rows, DOC)
    want = {tuple(r) for r in dartminhash.near_duplicates(df, bands=60, rows=2).collect()}
    assert {tuple(r) for r in dartminhash.near_duplicates(df, bands=60, rows=2, longest=3, block=4).collect()} == want and len(want) >= 40


def test_blocks_are_compared_whole(spark):
    """Of all pairs between components in a hot band, none is left out, whatever the blocks."""
    rng = np.random.default_rng(3)
    signs = rng.integers(0, 3, (60, 8)).astype(np.uint32)
    rows = [(k, signs[k].tobytes()) for k in range(60)]
    table = spark.createDataFrame(rows, "whole long, sign binary")
    members = table.select(F.lit(7).cast("long").alias("band"), "whole")
    none = spark.createDataFrame([], "a long, b long")
    true = [(a, b) for a in range(60) for b in range(a) if (signs[a] == signs[b]).mean() >= 0.7]
    for block in (3, 100):
        edges, _ = dartminhash._hot_edges(members, table, none, 0.7, block)
        got = [(r["a"], r["b"]) for r in edges.collect()]
        assert {(max(p), min(p)) for p in got} <= set(true)
        assert groups(range(60), got) == groups(range(60), true)


def test_rows_that_share_an_id(spark):
    """Each row goes or stays by its own text, in near-dedup and in suffix dedup."""
    rng = random.Random(41)
    a, b, p = prose(rng, 80), prose(rng, 80), prose(rng, 60)
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b + " end"), (None, a)], DOC)
    assert {tuple(r) for r in dartminhash.near_duplicates(df).collect()} == {(1, 1), (2, 1), (2, 2), (3, 2)}
    assert sorted((r["doc_id"] or 0, r["text"]) for r in dartminhash.drop_near_duplicates(df).collect()) == sorted([(0, a), (1, a), (2, b)])
    lead = prose(rng, 20)
    for rows in ([(1, p), (2, f"{lead} {p}"), (2, "short text")], [(1, p), (2, p), (2, prose(rng, 120))]):
        kept = sorted((r["doc_id"], " ".join(r["text"].split())) for r in suffix_dedup.drop_repeated_passages(spark.createDataFrame(rows, DOC)).collect())
        want = [(1, p), (2, lead), (2, "short text")] if rows[2][1] == "short text" else [(1, p), rows[2]]
        assert kept == sorted(want)


def test_hot_buckets_give_the_same_spans(spark):
    """Anchors that too many contexts share are counted by digest, with the same repeats and first places."""
    rows = [*passages(), (3, "another text of the same id"), (60, passages()[60][1])]
    df = spark.createDataFrame(rows, DOC)
    want = {tuple(r) for r in suffix_dedup.repeated_passages(df, min_words=12, gram=5).collect()}
    for bucket in (1, 3):
        assert {tuple(r) for r in suffix_dedup.repeated_passages(df, min_words=12, gram=5, bucket=bucket).collect()} == want


class Blind(Graph):
    """Never finds anything."""

    def search(self, queries, beam):
        return np.full((len(queries), beam), -1), np.full((len(queries), beam), -2.0, np.float32)


def test_a_blind_graph_fails_its_audit():
    """Another shard's vectors with few true pairs, none of them in the sample: the probes tell."""
    x = vectors(900).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    good = Graph.build(np.arange(400), x[:400])
    queries = np.concatenate([x[400:], good.vectors[:10]])
    sample = np.arange(16)
    assert not (good.vectors @ queries[sample].T >= 0.95).any()
    planted = embedding_dedup.probes(good, 0.95, 3)
    assert np.einsum("nd,nd->n", good.vectors[planted[0]], planted[1]) == pytest.approx(0.95, abs=1e-4)
    true = set(zip(*np.nonzero(queries @ good.vectors.T >= 0.95), strict=True))
    blind = Blind(good.vectors, good.links, 0)
    for graph, beam in ((good, None), (blind, 400)):
        q, v, began = embedding_dedup.found_pairs(graph, queries, sample, 0.95, planted=planted)
        assert set(zip(q, v, strict=True)) == true and len(true) >= 10
        assert began == beam or beam is None and began < 400
    # A vector's match with itself is no evidence.
    own = np.arange(16)
    assert embedding_dedup.found_pairs(blind, good.vectors[:16], sample, 0.99999, planted=None, own=own)[2] == embedding_dedup.BEAM


def test_embeddings_across_shards(spark):
    """Pairs across many small shards, each two of which meet once, and ids with several vectors."""
    x = vectors(300, seed=9)
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    far = [float(v) for v in np.random.default_rng(1).normal(size=16)]
    rows += [(250, rows[0][1]), (600, far), (601, far), (601, rows[299][1]), rows[1]]
    y = np.array([r[1] for r in rows], np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(y @ y.T >= 0.95, 1))
    ids = [r[0] for r in rows]
    want = groups(set(ids), [(ids[i], ids[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for chunk in (1, 3):
        got = {r["vec_id"]: r["keep_id"] for r in embedding_dedup.embedding_near_duplicates(df, shard_size=40, chunk=chunk).collect()}
        assert got == want and want[250] == 0 and want[601] == 299


def test_keys_of_bands_are_not_kept(spark, monkeypatch):
    """Keys follow from the signatures; only these are written, and moved to find equal ones."""
    kept = []
    monkeypatch.setattr(dartminhash, "cut", lambda df, tag: kept.append((tag, df.columns)) or components.cut(df, tag))
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(30)), "s") for k in range(6)]
    rows += [(10, rows[0][1] + " and more", "s"), (11, rows[1][1], "s")]
    found = dartminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {tuple(r) for r in found.collect()} == {(0, 0), (10, 0), (1, 1), (11, 1)}
    assert ("alone", ["whole", "sign"]) in kept and not any("bands" in columns for _, columns in kept)
