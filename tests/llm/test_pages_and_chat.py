from __future__ import annotations

import json
import math

import pytest
import zstandard
from pyspark.sql import functions as F

from plinth.llm import chat, site_style, warc

PAGE = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGE).withColumn("data", F.lit("mine"))


def test_warc_round_trip(spark, tmp_path):
    rows = [(k, f"http://h/{k}", f"<p>{'é' * k}</p>" * 40) for k in range(60)] + [(100, None, None), (None, "http://n", ""), (101, "http://big\r\nX: y", "z" * 300_000), (5, "http://h/5", "again")]
    bundles = warc.warc_bundles(pages(spark, rows).coalesce(1), frame_bytes=5000, bundle_bytes=8000)
    got = bundles.collect()
    assert len(got) > 1 and sum(r["n_records"] for r in got) == len(rows)
    seen = []
    for r in got:
        table = warc.read_seek_table(r["data"])
        whole = b""
        for e in r["entries"]:
            raw = warc.read_record(r["data"], e["frame"], e["record_offset"], e["record_size"])
            headers, block = warc.parse_record(raw)
            assert table[e["frame"]][:2] == (e["frame_offset"], e["frame_size"]) and int(headers["Content-Length"]) == len(block)
            seen.append((e["page_id"], block.decode()))
            whole += raw
        # A plain decoder reads the bundle through and skips the seek table.
        assert zstandard.ZstdDecompressor().stream_reader(r["data"], read_across_frames=True).read() == whole
    assert sorted(seen, key=str) == sorted(((i, h or "") for i, _, h in rows), key=str)
    names = [r["bundle"] for r in warc.write_bundles(bundles, str(tmp_path)).collect()]
    assert sorted(names) == sorted(p.name for p in tmp_path.iterdir()) and names == [r["bundle"] for r in got]
    assert warc.record_index(bundles).count() == len(rows) and warc.warc_bundles(pages(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(warc.record(1, "u", "abc").replace(b"abc", b"abd"))


def test_parser():
    root = site_style.parse('<!doctype html><head><title>t</title></head><body class=x><!-- c --><script>var a="<p>no</p>"</script><p>one<p>two &amp; <b>three<br>four<ul><li>a<li>b</ul></div></body>')
    assert site_style.page_text(root, frozenset())[0].split("\n") == ["one", "two & three", "four", "a", "b"]
    for odd in ("", "<", "<p", "</p>", "<!--", "<a href='x", "<" * 500, "<div>" * 500 + "deep", "\x00"):
        site_style.page_text(site_style.parse(odd), frozenset())


def site(n, host="h"):
    nav, foot = "<nav><a href='/'>Home</a><a href='/x'>About us</a></nav>", "<footer>Copyright by us. All rights.</footer>"
    return [(k, f"https://{host}.org/{k}", f"<html><body>{nav}<article><h1>Title {k}</h1><p>Story {k} tells of things {k * 7}.</p></article>{foot}</body></html>") for k in range(n)]


def test_style_tree_against_the_formula(spark):
    """One element, by hand: footer texts of 10 pages in 2 variants, 6 and 4."""
    rows = [(k, "https://a/", f"<body><p>x{k}</p><footer>{'one' if k < 6 else 'two'}</footer></body>") for k in range(10)]
    df = spark.createDataFrame([(1, h) for _, _, h in rows], "site long, html string")
    got = {r["place"] & 0xFFFFFFFFFFFFFFFF: r["importance"] for r in site_style.style_tree(df).collect()}
    root = site_style.parse(rows[0][2])
    list(site_style.place_nodes(root, 1))
    leaf = root.children[0].children[1].children[0]
    content = 1 - (6 * math.log(5) + 4 * math.log(3)) / math.log(10) / 10
    assert got[leaf.place] == pytest.approx(content)
    footer = root.children[0].children[1]
    assert got[footer.place] == pytest.approx(0.9 * content)  # one style: no entropy of presentation
    assert got[root.children[0].children[0].children[0].place] == pytest.approx(1.0)


def test_site_text(spark):
    rows = [*site(30), *[(100 + k, u, h) for k, u, h in site(2, "small")], (200, None, "<p>free</p>"), (201, "relative/x", ""), (202, "https://h.org/z", None), (2**60 + 1, "x", "y"), (None, None, None)]
    df = pages(spark, rows)
    got = {r["page_id"]: r for r in site_style.site_text(df).collect()}
    assert len(got) == len(rows) and got[2**60 + 1]["text"] == "y" and got[None]["text"] == ""
    for k in range(30):
        assert got[k]["text"].split("\n") == [f"Title {k}", f"Story {k} tells of things {k * 7}."] and got[k]["removed"] >= 2
    assert "Home" in got[100]["text"] and got[200]["text"] == "free" and got[201]["text"] == "" and got[202]["text"] == ""
    assert site_style.site_text(df.limit(0)).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    rows = [(k, "https://c.org/", "<body><article><p>The same story in full, told at some length here.</p></article></body>") for k in range(12)]
    assert {r["text"] for r in site_style.site_text(pages(spark, rows)).collect()} == {"The same story in full, told at some length here."}


def test_small_articles_lose_their_large_menus(spark):
    menu = "<nav>" + "".join(f"<a href='/{k}'>Section number {k}</a>" for k in range(20)) + "</nav>"
    rows = [(k, f"https://m.org/{k}", f"<body>{menu}<article><p>Brief {k}.</p></article></body>") for k in range(20)]
    copies = [(100 + k, "https://m.org/c", f"<body>{menu}<section><p>One story told over and over.</p></section></body>") for k in range(8)]
    got = {r["page_id"]: r["text"] for r in site_style.site_text(pages(spark, rows + copies)).collect()}
    assert [got[k] for k in range(20)] == [f"Brief {k}." for k in range(20)]
    assert all("One story told over and over." in got[k] for k in range(100, 108))


RECORDS = [
    ({"messages": [{"role": "System", "content": "s"}, {"role": "user", "content": "q"}, {"role": "assistant", "content": None}, {"role": "assistant", "content": ""}], "extra": {"a": 1}}, "messages", [("system", "s"), ("user", "q"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "share", [("user", "q"), ("assistant", "a")]),
    ({"data": {"turns": [{"speaker": "Bot", "text": "a"}]}}, "nested", [("assistant", "a")]),
    ({"prompt": "q", "completion": "a"}, "prompt", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "completion": "a"}, "prompt", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "a"}, "instruction", [("user", "do\n\nthis"), ("assistant", "a")]),
    ({"instruction": "do", "input": "", "output": "a"}, "instruction", [("user", "do"), ("assistant", "a")]),
    ({"question": "q", "answer": "a", "id": 4}, "question", [("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "chosen": "a", "rejected": "b"}, "preference", [("user", "q"), ("assistant", "a")]),
    ({"something": "else"}, "unmapped", []), ([], "unmapped", []), ({"messages": []}, "unmapped", []),
    ({"messages": [{"role": "user", "content": None}]}, "empty", []),
]


def test_layouts(spark):
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(RECORDS)] + [(90, "{broken"), (91, None), (92, ""), (93, json.dumps({"prompt": "x" * 200_000, "completion": "y"})), (3, json.dumps(RECORDS[3][0]))]
    df = spark.createDataFrame(rows, "conv_id long, raw string").withColumn("role", F.lit("mine"))
    got = chat.canonical_turns(df).collect()
    for k, (_, mapping, turns) in enumerate(RECORDS):
        own = sorted((r for r in got if r["conv_id"] == k), key=lambda r: (r["turn"] is None, r["turn"]))
        assert {r["mapping"] for r in own} == {mapping}
        assert [(r["role"], r["content"]) for r in own if r["turn"] is not None] == (turns if k != 3 else sorted(turns * 2, key=turns.index))
    assert {r["conv_id"]: r["mapping"] for r in got if r["conv_id"] in (90, 91, 92)} == {90: "invalid", 91: "invalid", 92: "invalid"}
    assert len(next(r for r in got if r["conv_id"] == 93 and r["turn"] == 0)["content"]) == 200_000
    assert chat.canonical_turns(df.limit(0)).count() == 0
    prints = chat.fingerprints()
    assert all(prints[r["fingerprint"]] == r["mapping"] for r in got if r["mapping"] not in ("unmapped", "invalid", "empty"))


def test_every_layout_comes_back(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"{c}/{t}") for c in range(25) for t in range(2 if c % 2 else 4)] + [(40, 0, "system", "s"), (40, 1, "user", "u"), (40, 2, "assistant", "a"), (43, 0, "user", None), (43, 1, "assistant", "a"), (44, 0, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r["conv_id"], r["turn"], r["role"], r["content"]) for r in chat.canonical_turns(chat.raw_records(df)).collect())
    want = sorted([(c, t, r, x) for c, t, r, x in rows if c < 43] + [(43, 0, "assistant", "a"), (44, 0, "user", "x")])
    assert got == want


def test_bundles_against_a_plain_grouping(spark):
    """Frames, bundles and places as a few lines of Python over the same rows have them."""
    rows = [(k % 17 if k % 5 else None, f"http://h/{k % 3}" if k % 7 else None, "z" * (k * 37 % 900) if k % 4 else None) for k in range(120)]
    got = warc.warc_bundles(pages(spark, rows).coalesce(1), frame_bytes=2000, bundle_bytes=900).collect()
    frames, now, size = [], [], 0
    for row in rows:
        raw = warc.record(*row)
        now.append((row, size, raw))
        size += len(raw)
        if size >= 2000:
            frames, now, size = [*frames, now], [], 0
    frames = [*frames, now] if now else frames
    want, bundle, offset, number = [], 0, 0, 0
    for frame in frames:
        packed = zstandard.ZstdCompressor(level=warc.LEVEL, write_checksum=True, write_content_size=True).compress(b"".join(raw for _, _, raw in frame))
        want += [(bundle, row[0], number, offset, len(packed), at, len(raw)) for row, at, raw in frame]
        offset, number = offset + len(packed), number + 1
        if offset >= 900:
            bundle, offset, number = bundle + 1, 0, 0
    assert [(n, e["page_id"], e["frame"], e["frame_offset"], e["frame_size"], e["record_offset"], e["record_size"]) for n, r in enumerate(got) for e in r["entries"]] == want


def test_records_are_found_by_identifier(spark):
    rows = [(1, "http://a", "x"), (1, "http://a", "y"), (1, "http://b", "x"), (None, None, "x"), (None, "", "x"), (1, "http://a", "x"), (2, None, None)]
    bundles = warc.warc_bundles(pages(spark, rows), frame_bytes=300)
    ids = {warc.identified(*r)[0]: r for r in rows}
    assert len(ids) == 6 and {r["record_id"] for r in warc.record_index(bundles).collect()} == set(ids)
    found = warc.find_records(bundles, spark.createDataFrame([(i,) for i in ids], "record_id string")).collect()
    assert len(found) == 7
    for r in found:
        headers, block = warc.parse_record(bytes(r["record"]))
        assert headers["WARC-Record-ID"] == f"<{r['record_id']}>" and block.decode() == (ids[r["record_id"]][2] or "")


OVERLAPS = [
    ({"prompt": "q", "prompt_id": "7", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "share", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"system": "s", "conversations": [{"from": "system", "value": "own"}, {"from": "human", "value": "q"}]}, "share", [("system", "own"), ("user", "q")]),
    ({"system": "s", "prompt": "q", "chosen": "a", "rejected": "b"}, "preference", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "chosen": [{"role": "assistant", "content": "a"}], "rejected": []}, "preference_turns", [("user", "q"), ("assistant", "a")]),
    ({"chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "prompt": "q"}, "preference_turns", [("user", "q"), ("assistant", "a")]),
    ([{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "bare", [("user", "q"), ("assistant", "a")]),
    ([{"from": "human", "value": "q"}], "bare_share", [("user", "q")]),
    ({"system": "s", "question": "q", "answer": "a", "prompt": "p"}, "question", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "completion": "a", "chosen": "c"}, "prompt", [("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "context": "this", "response": "a", "category": "x"}, "context", [("user", "do\n\nthis"), ("assistant", "a")]),
    ({"conversation": [{"role": "user", "content": "q"}]}, "conversation", [("user", "q")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "look"}, {"type": "text", "text": "here"}, {"type": "image", "id": 3}, "plain"]}, {"role": "assistant", "content": [{"type": "text"}]}]}, "messages", [("user", 'look\n\nhere\n\n{"id":3,"type":"image"}\n\nplain')]),
]


def test_layouts_that_overlap(spark):
    """Fields of another layout, or of none, cost no content."""
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(OVERLAPS)] + [(None, json.dumps(OVERLAPS[0][0]))] * 2
    df = spark.createDataFrame(rows, "conv_id long, raw string").withColumn("turn", F.lit("mine"))
    got = chat.canonical_turns(df).collect()
    for k, (_, mapping, turns) in enumerate(OVERLAPS):
        own = sorted((r for r in got if r["conv_id"] == k), key=lambda r: r["turn"])
        assert {r["mapping"] for r in own} == {mapping} and [(r["role"], r["content"]) for r in own] == turns
    assert sum(r["conv_id"] is None for r in got) == 4
    prints = chat.fingerprints()
    assert all(prints[r["fingerprint"]] == r["mapping"] for r in got)


def test_layouts_are_counted(spark):
    rows = [('{"messages":[{"role":"user","content":"x"}],"id":1}',), ('{"id":2.5,"messages":[{"content":"y","role":"user"}]}',), ('{"odd":[1,2]}',), ("{",), (None,)]
    got = {(r["schema"], r["mapping"]): r["n"] for r in chat.layouts(spark.createDataFrame(rows, "raw string")).collect()}
    assert got == {("OBJECT<id, messages: ARRAY<OBJECT<content, role>>>", "messages"): 2, ("OBJECT<odd: ARRAY<>>", "unmapped"): 1, (None, "invalid"): 2}


def test_records_without_an_id(spark):
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "b"), (3, 0, "system", "only"), (9, 0, "system", "only")], "conv_id long, turn long, role string, text string")
    got = sorted((r["conv_id"] or 0, r["turn"], r["role"], r["content"]) for r in chat.canonical_turns(chat.raw_records(df)).collect())
    assert got == [(0, 0, "user", "a"), (0, 0, "user", "b"), (3, 0, "system", "only"), (9, 0, "system", "only")]


def brute_importance(pages, gamma=site_style.GAMMA, least=site_style.MIN_PAGES):
    """{(path of tags and positions with the styles chosen): (importance, most)}, from the trees themselves."""
    chosen, texts, held, above = {}, {}, {}, {}
    for page in pages:
        stack = [(site_style.parse(page), ())]
        while stack:
            node, at = stack.pop()
            held[at] = held.get(at, 0) + 1
            for f in set(node.features):
                texts.setdefault(at, {}).setdefault(f, []).append(1)
            if node.children:
                style = tuple(c.sign for c in node.children)
                chosen.setdefault(at, {}).setdefault(style, []).append(1)
                for k, child in enumerate(node.children):
                    above[(*at, style, k)] = at
                    stack.append((child, (*at, style, k)))
    out = {}
    for at in sorted((a for a in held if held[a] >= least), key=len, reverse=True):
        m, log = held[at], math.log(held[at])
        styles = {s: len(n) for s, n in chosen.get(at, {}).items()}
        found = [len(n) for n in texts.get(at, {}).values()]
        content = 1 - sum(n * math.log(max(min(n, m) - 1, 1)) / log for n in found) / sum(found) if found else None
        own, most = 0.0, 0.0
        if styles:
            presentation = -sum(n / m * math.log(n / m) / log for n in styles.values())
            inner = 0.0
            for s, n in styles.items():
                children = [out[(*at, s, k)] for k in range(len(s)) if (*at, s, k) in out]
                inner += n / m * (sum(i for i, _ in children) / len(children) if n >= least else 1.0)
                most = max([most, *(x for _, x in children), *([1.0] if n < least else [])])
            weight = gamma ** len(styles)
            own = min(1.0, max(0.0, (1 - weight) * presentation + weight * inner))
            own = max(own, content) if content is not None else own
        elif content is not None:
            own = min(1.0, max(0.0, content))
        out[at] = own, max(most, own)
    return out


def varied(n):
    html = []
    for k in range(n):
        ads = "".join(f"<p class=ad>Buy number {k % 3} now.</p>" for _ in range(k % 2))
        html.append(f"<body><nav><a href='/{k % 2}'>Home</a><b>x</b></nav>{ads}<div><article><h1>T{k}</h1><p>Story {k}. More {k}.</p></article>{'<ul><li>a<li>b</ul>' if k % 3 else '<i>only here</i>'}</div><footer>One.</footer></body>")
    return html


def test_importance_against_brute_force(spark):
    """Every shared place of a site of varied pages, in one task and depth by depth."""
    html = varied(20)
    want = sorted((round(i, 6), round(x, 6)) for i, x in brute_importance(html).values())
    df = spark.createDataFrame([(1, h) for h in html], "site long, html string")
    for limit in (site_style.SITE_PLACES, 3):
        got = sorted((round(r["importance"], 6), round(r["most"], 6)) for r in site_style.style_tree(df, site_places=limit).collect())
        assert got == want and len(got) > 15


def test_sites_with_much_noise(spark):
    """Branches to remove as a list or by a join of places: the same texts."""
    rows = [(k, "https://v.org/", h) for k, h in enumerate(varied(20))] + [(50, "https://v.org/", None), (3, "https://v.org/", varied(20)[3]), (60, None, "<p>x")]
    want = sorted(tuple(r) for r in site_style.site_text(pages(spark, rows)).collect())
    assert sorted(tuple(r) for r in site_style.site_text(pages(spark, rows), site_places=3, site_noise=0).collect()) == want
    assert any(r[3] for r in want) and len(want) == len(rows)


def test_deep_pages(spark):
    """No depth is too great, for the tree's shape and for the number of jobs; what a page lost and got back is told."""
    def page(k, depth):
        return "<body>" + "<div>" * depth + f"<p>Story {k} of {k * 3}.</p><p>Same on all of them.</p>" + "</div>" * depth + "<footer>Foot. Note.</footer></body>"

    for depth in (199, 201, 400):
        root = site_style.parse(page(1, depth))
        assert max(d for _, _, d in site_style.place_nodes(root, 1)) == depth + 3
    rows = [(k, f"https://d{d}.org/{k}", page(k, d)) for d in (10, 250) for k in range(1000 * d, 1000 * d + 6)]
    got = {r["page_id"]: r for r in site_style.site_text(pages(spark, rows)).collect()}
    for k, _, _ in rows:
        assert got[k]["text"] == f"Story {k} of {k * 3}." and got[k]["restored"] == 0 and got[k]["removed"] >= 2
    copies = [(k, "https://c.org/", page(1, 2)) for k in range(8)]
    assert {(r["removed"], r["restored"] > 0) for r in site_style.site_text(pages(spark, copies)).collect()} == {(0, True)}
