from __future__ import annotations

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plinth.llm import licenses, mixing, pieces, repetition

TEXT = "doc_id long, text string"


def brute_repeats(text, least):
    """Longest repeat of every suffix by comparing all pairs."""
    w = text.split()
    n = len(w)
    covered, longest = [False] * n, 0
    for a in range(n):
        for b in range(a + 1, n):
            k = 0
            while b + k < n and w[a + k] == w[b + k]:
                k += 1
            if k >= least:
                longest = max(longest, k)
                for p in (*range(a, a + k), *range(b, b + k)):
                    covered[p] = True
    size = sum(len(x.encode()) for x in w)
    return n, sum(len(x.encode()) for x, c in zip(w, covered, strict=True) if c) / size if size else 0.0, longest


def test_repetition_against_brute_force():
    rng = random.Random(9)
    texts = [None, "", " \n ", "word", "ab " * 50, "é à " * 20 + "end", " ".join(rng.choice("abc") for _ in range(80))]
    texts += [" ".join(rng.choice(["x", "y", "zz", "long"]) for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    got = repetition.batch_repeats(pa.array(texts), 4)
    for k, t in enumerate(texts):
        n, fraction, longest = brute_repeats(t or "", 4)
        assert (got["words"][k], got["longest"][k]) == (n, longest) and got["fraction"][k] == pytest.approx(fraction)


def test_repetition_rules(spark):
    rng = random.Random(1)
    clean = " ".join(f"w{rng.randrange(5000)}" for _ in range(400))
    rows = [(1, clean), (2, "spam and eggs again now then " * 40), (3, "a" * 500), (4, None), (5, ""), (6, clean + " " + " ".join(clean.split()[:60])), (7, "one line here twice over again\n" * 2), (8, clean * 50), (1, clean)]
    df = spark.createDataFrame(rows, TEXT).withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(1))
    got = {r["doc_id"]: r["kept"] for r in repetition.repetition_scores(df).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: True, 6: True, 7: True, 8: False}
    kept = repetition.drop_repetitive(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 4, 5, 6, 7]
    assert repetition.repetition_scores(df.limit(0)).count() == 0


def test_limits_hold_for_short_documents(spark, tmp_path):
    import corpus_pipeline
    from plinth.llm.queries import op2_quality_rules

    page = "The and attion to thanedble the, anea. Eriner thanea."
    rows = [(1, f"{page}\nHaanon a ansh.\n{page}"), (2, page), (3, "one two three four five six seven " * 2)]
    df = spark.createDataFrame(rows, TEXT)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert [r["doc_id"] for r in op2_quality_rules(spark, str(tmp_path)).collect()] == [2]
    assert [r["doc_id"] for r in corpus_pipeline.quality_rules(spark, df, "").collect()] == [2]


ODD = ["Hello  world", "\thi\r\nyo ﬁ ½ é  ", " lead", "a▁b", "", None, "   ", "日本語テキスト😀 ok", "a" * 3000, "▁", "x", "ends   here", "\x00\x01"]


def test_pieces_round_trip():
    import sentencepiece

    path = pieces.default_model()
    e = pieces.Encoder(path)
    ids, offsets, fine = e.encode(np.arange(len(ODD)), pa.array(ODD))
    assert fine.all()
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
    assert pieces.decode_ids(path, lists).to_pylist() == [t or "" for t in ODD]
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for t, one in zip(ODD, lists.to_pylist(), strict=True):
        if t and "▁" not in t:
            assert library.decode(one) == t


def test_pieces_have_the_lattice_distribution():
    path = pieces.default_model()
    m = pieces.model(path)
    known = {bytes(m.bytes[m.begin[i] : m.begin[i] + m.size[i]]): i for i in m.id.tolist()}

    def ways(b):
        if not b:
            yield ()
        for k in range(1, len(b) + 1):
            if b[:k] in known:
                for rest in ways(b[k:]):
                    yield (known[b[:k]], *rest)

    every = list(ways(b" there"))
    weight = np.array([math.exp(0.5 * m.weight[list(w)].sum()) for w in every])
    weight /= weight.sum()
    n = 20000
    ids, offsets, _ = pieces.Encoder(path, 0.5).encode(np.arange(n), pa.array(["there"] * n))
    seen = collections.Counter(tuple(ids[offsets[i] : offsets[i + 1]].tolist()) for i in range(n))
    assert set(seen) <= set(every)
    assert max(abs(seen[w] / n - p) for w, p in zip(every, weight, strict=True)) < 0.015
    best, _, _ = pieces.Encoder(path, 50.0).encode(np.zeros(1, int), pa.array(["there"]))
    assert tuple(best.tolist()) == every[int(weight.argmax())]


def test_pieces_depend_on_key_and_text_alone(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "null key"), (3, "a▁b")]
    df = spark.createDataFrame(rows, TEXT).withColumn("pieces", F.lit(1))
    one = sorted(((r["doc_id"] or -1, tuple(r["pieces"])) for r in pieces.sample_pieces(df).collect()))
    other = sorted(((r["doc_id"] or -1, tuple(r["pieces"])) for r in pieces.sample_pieces(df.repartition(3)).collect()))
    assert one == other and one.count(next(x for x in one if x[0] == 3)) == 2
    back = {r["doc_id"]: r["text"] for r in pieces.decode_pieces(pieces.sample_pieces(df)).collect()}
    assert back == {k: t or "" for k, t in rows}
    assert pieces.sample_pieces(df.limit(0)).count() == 0
    assert all(r["lossless"] for r in pieces.sample_pieces(df).collect())


def test_license_bands():
    assert licenses.collision_probability(0.4) > 0.99 and licenses.collision_probability(0.5) > 0.999


def brute_licenses(text):
    import re

    v = [w.lower() for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text)]
    grams = [tuple(v[k : k + 2]) for k in range(len(v) - 1)]
    out = set()
    for t, (_, template) in enumerate(licenses.TEMPLATES):
        w = [x.lower() for x in re.findall(r"[0-9A-Za-z]+", template)]
        own = {tuple(w[k : k + 2]) for k in range(len(w) - 1)}
        if any(len(own & set(grams[k : k + len(w) - 1])) >= licenses.CONTAINMENT * len(own) for k in range(max(1, len(grams)))):
            out.add(t)
    return out


def test_licenses_against_brute_force(spark):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in "bdfgklm" for b in ("an", "el", "or")] + ["the", "license", "of", "under", "is"]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(0, None), (1, ""), (2, "License"), (3, filler(3000))]
    for k in range(120):
        _, t = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        w = t.split()
        if k % 3 == 1:
            w[rng.randrange(len(w))] = "CHANGED"
        rows.append((10 + k, f"{filler(rng.randrange(0, 80))} {' '.join(w).upper() if k % 5 == 0 else ' '.join(w)} {filler(rng.randrange(0, 80))}"))
    got = collections.defaultdict(set)
    for r in licenses.license_scan(spark.createDataFrame(rows, TEXT).withColumn("license", F.lit("x"))).collect():
        got[r["doc_id"]].add(r["template"])
    true = [(i, t) for i, text in rows for t in brute_licenses(text or "")]
    assert sum(t in got[i] for i, t in true) >= 0.97 * len(true) and len(true) > 100
    assert not got[0] and not got[1] and not got[2] and not got[3]
    assert licenses.license_scan(spark.createDataFrame([], TEXT)).count() == 0


def mixed(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("slot", F.lit(1))
    return df, mixing.mix_schedule(df, **how).collect()


def test_mix_holds_its_weights(spark):
    rng = random.Random(3)
    rows = [(k, "w " * rng.randrange(1, 60), "ab"[k % 7 == 0] + "x") for k in range(3000)]
    _, got = mixed(spark, rows, weights={"ax": 0.7, "bx": 0.3}, block_tokens=200)
    assert {r["doc_id"] for r in got} == set(range(3000))
    per = collections.defaultdict(dict)
    for r in got:
        per[r["slot"]][r["source"]] = True
    cut = max(s for s in per if any(r["slot"] == s and r["epoch"] > 0 for r in got) or True)
    slots = sorted(per)[: int(cut * 0.9)]
    share = sum("ax" in per[s] for s in slots) / len(slots)
    assert share == pytest.approx(0.7, abs=0.02)
    for start in range(0, len(slots) - 50, 50):  # any stretch is close, not only the whole
        assert sum("ax" in per[s] for s in slots[start : start + 50]) == pytest.approx(35, abs=4)
    # The rarer source begins again, and an epoch plays every block once.
    assert max(r["epoch"] for r in got if r["source"] == "bx") >= 1
    assert collections.Counter(r["doc_id"] for r in got if r["source"] == "ax").most_common(1)[0][1] == 1


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y z", None), (3, "x y z", None), (None, "q", "b"), (4, "w " * 5000, "c"), (5, "t", "d")]
    df, got = mixed(spark, rows, block_tokens=100)
    assert sorted((r["doc_id"] or 0) for r in got if r["epoch"] == 0) == [0, 1, 2, 3, 3, 4, 5]
    out = mixing.mixed_documents(df, block_tokens=100)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == {None, 1, 2, 3, 4, 5}
    assert mixing.mix_schedule(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0
    _, only = mixed(spark, rows, weights={"c": 1.0}, block_tokens=100)
    assert {r["doc_id"] for r in only} == {None, 1, 2, 3, 4, 5}


def thue_morse(n):
    out = [0]
    while len(out) < n:
        out += [1 - x for x in out]
    return "".join("ab"[x] for x in out[:n])


def swapped(text):
    return text.translate({97: 98, 98: 97})


def test_nothing_jumps_at_a_size():
    """A byte more makes no other document, at the size from which runs are taken apart and at any other."""
    texts = [f"{'x' * 64} {'y' * n}" for n in (63, 64, 65, 66)] + ["ab" * n for n in (31, 32, 33, 34)]
    got = repetition.batch_repeats(pa.array(texts), repetition.MIN_WORDS)
    assert not got["fraction"].any() and not got["longest"].any()
    assert got["words"] == pytest.approx([2, 2, 129 / 64 + 0, 130 / 64, 1, 1, 66 / 64, 68 / 64])
    # Runs without spaces are judged all the same: six words' worth of repeats is a repeat.
    runs = repetition.batch_repeats(pa.array(["x" * 400, "abc" * 4000, "数" * 13, "数" * 11]), repetition.MIN_WORDS)
    assert list(runs["fraction"]) == [1, 1, 1, 0] and runs["words"] == pytest.approx([6.25, 187.5, 6.5, 5.5])


def test_colliding_hashes_invent_no_repeat():
    """Thue-Morse sequences and their complements have equal polynomial hashes modulo a power of two."""
    one, other = " ".join(thue_morse(2048)), " ".join(swapped(thue_morse(2048)))
    text = f"{one} q {other}"
    found = repetition.batch_repeats(pa.array([text]), 6)
    w = text.split()
    longest = 0
    for shift in range(1, len(w)):
        run = 0
        for x, y in zip(w, w[shift:]):
            run = run + 1 if x == y else 0
            longest = max(longest, run)
    assert found["longest"][0] == longest
    encoder = pieces.Encoder(pieces.default_model())
    for n in (1024, 2048, 4096, 8192):
        texts = [thue_morse(n), swapped(thue_morse(n))]
        ids, offsets, lossless = encoder.encode(np.arange(2), pa.array(texts))
        assert lossless.all() and pieces.decode_ids(pieces.default_model(), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))).to_pylist() == texts


def test_long_text_without_spaces():
    """Cut where all paths meet, a long run gets the very pieces that it gets whole."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("日本語の文章はこのように空白なしで書かれる") for _ in range(2000)), "".join(rng.choice("etaoinshrdlu") for _ in range(2000)), "é" * 300 + "a" * 300]
    encoder = pieces.Encoder(pieces.default_model())
    whole, cut = pieces.LONG, []
    try:
        for limit in (1 << 30, whole, 1):
            pieces.LONG = limit
            cut.append(encoder.encode(np.arange(3), pa.array(texts)))
    finally:
        pieces.LONG = whole
    for ids, offsets, lossless in cut[1:]:
        assert np.array_equal(ids, cut[0][0]) and np.array_equal(offsets, cut[0][1]) and lossless.all()
    big = "".join(rng.choice("漢字仮名交文章本日語") for _ in range(300_000))
    assert encoder.encode(np.arange(1), pa.array([big]))[2].all()


def test_wrapped_templates_are_found(spark):
    """Fillers between the lines of a template make windows sparse; whatever brute force verifies, the bands retrieve."""
    rng = random.Random(17)
    rows, key = [], 0
    for name, text in licenses.TEMPLATES:
        for gap in (6, 9, 14):
            w = text.split()
            parts = [" ".join(w[k : k + gap]) for k in range(0, len(w), gap)]
            rows.append((key, f" {' '.join(f'zq{rng.randrange(99)}' for _ in range(1))} ".join(parts)))
            key += 1
    rows += [(None, rows[0][1]), (0, rows[0][1]), (0, rows[0][1]), (500, "nothing of the kind")]
    df = spark.createDataFrame(rows, TEXT)
    got = {(r["doc_id"], r["template"]) for r in licenses.license_scan(df).collect()}

    def pairs(text):
        w = "".join(c.lower() if c.isalnum() and c.isascii() else " " for c in text).split()
        return set(zip(w, w[1:]))

    want = {(k, t) for k, text in rows for t, (_, template) in enumerate(licenses.TEMPLATES) if len(pairs(text) & pairs(template)) >= licenses.CONTAINMENT * len(pairs(template))}
    assert len(want & got) >= 0.97 * len(want) and got <= want
    assert licenses.license_scan(df.where("doc_id is null")).count() > 0
    twice = licenses.license_scan(df.where("doc_id = 0"))
    assert twice.count() == 3 * twice.distinct().count()


def test_mix_without_weights(spark):
    rows = [(k, f"w{k} " * 30, "ab"[k % 2]) for k in range(20)]
    for weights in ({}, {"elsewhere": 1.0}, {"a": 0.0}):
        df, got = mixed(spark, rows, weights=weights, block_tokens=100)
        assert sorted(r["doc_id"] for r in got) == list(range(20)) and {r["epoch"] for r in got} == {0}
        assert mixing.mixed_documents(df, weights=weights, block_tokens=100).count() == 20
    slots = {r["slot"]: (r["block"], r["source"]) for r in got}
    assert sorted(slots) == list(range(len(slots))) and [slots[s] for s in sorted(slots)] == sorted(slots.values())
    with pytest.raises(ValueError, match="negative"):
        mixing.mix_schedule(df, weights={"a": -1.0})


def test_mixed_documents_keep_the_schedule(spark):
    """Each row is played as its own source is, in the order of the slots; ids that repeat across sources aren't mixed up."""
    rows = [(k, f"a{k} " * 40, "big") for k in range(60)] + [(k, f"b{k} " * 40, "small") for k in range(10)] + [(3, "a3 " * 40, "big"), (4, "other text " * 20, "big"), (None, "n " * 40, "small")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("epoch", F.lit("mine"))
    how = {"weights": {"big": 0.5, "small": 0.5}, "block_tokens": 200}
    plan = sorted(mixing.mix_schedule(df, **how).collect(), key=lambda r: (r["slot"], r["offset"]))
    out = mixing.mixed_documents(df, **how)
    got = [(r["doc_id"], r["source"]) for r in out.collect()]
    assert collections.Counter(got) == collections.Counter((r["doc_id"], r["source"]) for r in plan) and out.columns == df.columns
    lone = {p for p in got if p != (3, "big") and p != (4, "big")}
    assert [p for p in got if p in lone] == [(r["doc_id"], r["source"]) for r in plan if (r["doc_id"], r["source"]) in lone]
    times = collections.Counter(s for _, s in got)
    assert times["small"] / 11 > 4 and times["big"] == 62


def moves(df, column):
    """How many shuffles of a plan move a column."""
    nodes, found = [df._jdf.queryExecution().executedPlan().initialPlan()], 0
    while nodes:
        node = nodes.pop()
        output, children = node.output(), node.children()
        found += node.nodeName() == "Exchange" and any(output.apply(k).name() == column for k in range(output.size()))
        nodes += [children.apply(k) for k in range(children.size())]
    return found


def test_mixed_documents_move_texts_once(spark, monkeypatch):
    """In many parts, with lists too large to be broadcast by themselves: one shuffle of texts, the order of the slots, and one block in several parts."""
    rows = [(k, f"a{k} " * (1 + k % 90), "big") for k in range(400)] + [(k, f"b{k} " * 40, "small") for k in range(12)]
    rows += [(1000 + k, "数" * 3000, "run") for k in range(40)] + [(7, "own text " * 9, "big"), (None, "n " * 40, "small"), (2000, None, "big"), (2001, "late " * 30, "unweighted")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "PART_BYTES", 4096, raising=False)
    how = {"weights": {"big": 0.5, "small": 0.3, "run": 0.2}, "block_tokens": 200}
    plan = mixing.mix_schedule(df, **how).collect()
    text = collections.defaultdict(set)
    for i, t, s in rows:
        text[i, s].add(t)
    at = {(r["doc_id"], r["source"], r["epoch"], r["n_tokens"]): (r["slot"], r["offset"]) for r in plan}
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = mixing.mixed_documents(df, **how)
        got = out.withColumn("part", F.spark_partition_id()).collect()
        assert moves(out, "text") == 1
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert collections.Counter((r["doc_id"], r["source"]) for r in got) == collections.Counter((r["doc_id"], r["source"]) for r in plan)
    assert all(r["text"] in text[r["doc_id"], r["source"]] for r in got)
    seen, places = collections.Counter(), []
    for r in got:
        n = len((r["text"] or "").split())
        places.append(at[r["doc_id"], r["source"], seen[r["doc_id"], r["source"], n], n])
        seen[r["doc_id"], r["source"], n] += 1
    assert places == sorted(places)
    assert len({r["part"] for r in got}) > 12 and len({r["part"] for r in got if r["source"] == "run"}) > 2
