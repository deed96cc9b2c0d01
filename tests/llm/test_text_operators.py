"""License scan, HTML extraction, decontamination and packing."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from threadline.llm import decontaminate, html_text, license_scan, packing

from .conftest import corpus

# ---- license scan


def test_license_statements_and_inheritance(spark):
    files = [
        (1, "a/LICENSE", "Some project\nReleased under the MIT License.\n"),
        (2, "a/b/c/x.py", "import os\nprint(1)"),
        (3, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (4, "a/b/y.py", "Licensed under the Apache License, Version 2.0.\ncode here"),
        (5, "a/z.py", "nothing"),
        (6, "top.py", "a licence is not stated here, version 3 of the public story"),
        (7, "a/b/c/d/e/q.py", None),
        (8, None, ""),
        (9, "d/only.txt", "Licensed under CC BY-NC 4.0."),
        (10, "d/other.txt", "words"),
        (10, "d/other.txt", "words"),
        (11, "d/e/f.txt", "Licensed under CC BY 4.0."),
    ]
    df = spark.createDataFrame([(i, p, t, "noise", 1) for i, p, t in files],
                               "doc_id long, path string, text string, key string, salt int")
    got = {}
    for r in license_scan.scan(df).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.how, r.from_dir))
    assert got == {
        1: [("MIT", "file", None)], 2: [("GPL-3.0", "inherited", "a/b")], 3: [("GPL-3.0", "file", None)],
        4: [("Apache-2.0", "header", None)], 5: [("MIT", "inherited", "a")], 6: [(None, "none", None)],
        7: [("GPL-3.0", "inherited", "a/b")], 8: [(None, "none", None)], 9: [("CC-BY-NC-4.0", "file", None)],
        10: [("CC-BY-NC-4.0", "inherited", "d")] * 2, 11: [("CC-BY-4.0", "file", None)]}


def test_license_cosine_against_brute_force(spark):
    rng = random.Random(4)
    words = sorted({w for _, v in license_scan._template_vectors(license_scan.TEMPLATES).values() for w in v})
    texts = []
    for k in range(40):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line = rng.choice(license_scan.TEMPLATES)[1].split() if rng.random() < 0.7 else rng.choices(words, k=6)
            for _ in range(rng.randint(0, 5)):
                line.insert(rng.randint(0, len(line)), rng.choice(["zzz", "qqq", rng.choice(words)]))
            lines.append(" ".join(line))
        texts.append((k, f"p{k}/f", "\n".join(lines)))
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(texts, "doc_id long, path string, text string")).collect()}
    brk = re.compile(license_scan.WORD_BREAK)
    lines = {(k, n): [w for w in brk.split(x.lower()) if w] for k, _, t in texts for n, x in enumerate(re.split("[\n\r]+", t))}
    df = {w: sum(w in x for x in lines.values()) for w in words}

    def idf(w):
        return math.log((1 + len(lines)) / (1 + df.get(w, 0))) + 1 if w in df else math.log(1 + len(lines)) + 1
    for k, _, _ in texts:
        best = 0
        for (d, _), x in lines.items():
            if d != k or not x:
                continue
            norm = sum((x.count(w) * idf(w)) ** 2 for w in set(x) if w in df) + sum(idf(w) ** 2 for w in x if w not in df)
            for _, v in license_scan._template_vectors(license_scan.TEMPLATES).values():
                dot = sum(x.count(w) * tf * idf(w) ** 2 for w, tf in v.items())
                best = max(best, dot / (norm * sum((f * idf(w)) ** 2 for w, f in v.items())) ** 0.5)
        if abs(best - license_scan.THRESHOLD) > 1e-6:
            assert (got[k].n_statements > 0) == (best >= license_scan.THRESHOLD)
        if got[k].n_statements:
            assert got[k].score == pytest.approx(best, abs=1e-6)


def test_license_wrapped_and_inside_one_line(spark):
    notice = {k: t for k, t in license_scan.TEMPLATES if len(t) > 100}
    prose = "some plain words of a story that goes on and on without an end " * 8
    bsd = notice["BSD-3-Clause"].split()
    files = [
        (1, "a/x.c", "# " + " ".join(bsd[:9]) + "\n#   " + " ".join(bsd[9:]) + "\n\nint main() {}\n" + prose),
        (2, "b/x.txt", prose + notice["MIT"] + " " + prose),
        (3, "c/readme", "\n * ".join(notice["GPL-3.0"].split())),
        (4, "c/other", "nothing"),
        (5, "d/x", prose + "\n" + prose),
        (6, "e/x", f"{prose}\n" + "\n".join(notice["MIT"].split(", ")) + f"\n{prose}\n{notice['MIT']}"),
        (7, "f/x", prose + (notice["BSD-3-Clause"] + " ") * 3),
        (8, "g/LICENSE", "Redistribution and use\nin source and binary\nforms with or without modification\nare permitted"),
    ] + [(100 + k, f"n/{k}", prose + f"\nwords {k}") for k in range(40)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.how, r.n_statements) for r in license_scan.scan(df).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {
        1: ("BSD-3-Clause", "header", 1), 2: ("MIT", "header", 1), 3: ("GPL-3.0", "file", 1), 4: ("GPL-3.0", "inherited", 0),
        5: (None, "none", 0), 6: ("MIT", "header", 2), 7: ("BSD-3-Clause", "header", 3), 8: ("BSD-3-Clause", "file", 1)}
    assert all(got[100 + k] == (None, "none", 0) for k in range(40))


def test_license_words_around_long_runs(spark):
    """A run of any length between two words: spaces, rules of signs, letters outside a-z, dots."""
    n = 300_000
    files = [
        (1, "a/x", "Released under" + " " * n + "the MIT License."),
        (2, "b/x", "Licensed under the Apache License, Version" + " =" * n + "2.0."),
        (3, "c/x", "Released under the MIT License" + "." * n),
        (4, "d/x", "éç, " * n + "\n" + "許" * n + "\nReleased under the MIT License."),
        (5, "e/x", "." * n + " é " * n),
    ]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.how, r.score, r.n_statements) for r in license_scan.scan(df).collect()}
    assert got == {1: ("MIT", "file", 1.0, 1), 2: ("Apache-2.0", "file", 1.0, 1), 3: ("MIT", "file", 1.0, 1),
                   4: ("MIT", "file", 1.0, 1), 5: (None, "none", None, 0)}


# ---- HTML


PAGE = ('<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li>menu</ul></nav>'
        '<article><h1>Head &amp; line</h1><p><b>one<br>two<p>three &lt;x&gt;&nbsp; four</p><div class="ad">buy</div>'
        '<section id="comments"><p>me too</p></section></article><aside>side</aside><footer>foot</footer></body></html>')


def test_marked_article():
    assert [t for t, _ in html_text.main_blocks(PAGE)[0]] == ["Head & line", "one two", "three <x> four"]


@pytest.mark.parametrize("source,want", [
    (None, []), ("", []), ("just text", ["just text"]), ("<p>a<p>b", ["a", "b"]), ("<p", ["<p"]), ("a < b", ["a < b"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<!-- x --><p>a<!-- b", ["a"]), ("<script>x", []),
    ("<main><p>in</p></main><p>out</p>", ["in"]), ("<div id='content'><p>in</p></div><p>out</p>", ["in"]),
    ("<p>a<form>b<input></form>c", ["a", "c"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1 2", "3"]),
    ("<article class=comment>c</article><article><header><h2>H</h2><i>by</i></header>t<footer>f</footer></article>", ["H", "t"]),
    ("<p>&#233;&eacute;&amp;amp;</p>", ["éé&amp;"]), ("<div style='display: none'>no</div><p>yes", ["yes"]),
    ("<p>x</b></i>y</section>z", ["xyz"]), ("<textarea><p>no</textarea><p>yes", ["yes"])])
def test_markup_cases(source, want):
    assert [t for t, _ in html_text.main_blocks(source)[0]] == want


def test_template_subtrees_go_and_others_stay(spark):
    shell = "<html><body><div class='x'><p>Site motto</p></div><div>{}</div><p>{}</p><div><p>Thanks for reading</p></div></body></html>"
    pages = [(k, f"http://H.example/p{k}", shell.format(f"story {k}", "twice" if k < 2 else f"end {k}")) for k in range(8)]
    pages += [(100 + k, "https://other.example:80/x", shell.format("only", "copies of one page")) for k in range(9)]
    pages += [(200, None, None), (201, "no url", "<p>Site motto"), (0, "http://h.example/again", "<p>repeated id")]
    df = spark.createDataFrame([(i, u, h, "n") for i, u, h in pages], "page_id long, url string, html string, sig string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect())
    want = [(k, f"story {k}\n\n" + ("twice" if k < 2 else f"end {k}")) for k in range(8)]
    want += [(100 + k, "Site motto\n\nonly\n\ncopies of one page\n\nThanks for reading") for k in range(9)]
    want += [(200, ""), (201, "Site motto"), (0, "repeated id")]
    assert got == sorted((i, t, len(t)) for i, t in want)


def test_template_subtrees_inside_marked_main_text(spark):
    shells = {"main": "<main><p>{0}</p><div><p>Share this with friends</p></div><section>More on {1}</section></main><p>out</p>",
              "role": "<div role=main><ul><li>Our shops</ul><p>{0}</p></div>",
              "content": "<div id=content><p>Read by many</p><p>{0}</p></div><div class=entry><p>Ask our staff</p></div>",
              "article": "<article><h1>Daily</h1><p>{0}</p><p>Same words</p><div><p>Join the club</p></div></article>"}
    pages = [(h, k, shell.format(f"{h} {k}", k)) for h, shell in shells.items() for k in range(6)]
    # copies of one page with other menus and adverts count once
    copy = "<nav>{0}</nav><{1}><div><p>One story</p></div><p>its end</p><div class=ad>{0}</div></{1}>"
    pages += [(f"copy-{tag}", k, copy.format(k, tag)) for tag in ("main", "article") for k in range(6)]
    df = spark.createDataFrame([(h, f"http://{h}.example/{k}", x) for h, k, x in pages], "h string, url string, html string")
    got = {(r.url.split("/")[2].split(".")[0], r.page_id): r.text for r in html_text.extract(
        df.selectExpr("cast(substring_index(url, '/', -1) as long) page_id", "url", "html")).collect()}
    want = {}
    for k in range(6):
        want |= {("main", k): f"main {k}\n\nMore on {k}", ("role", k): f"role {k}", ("content", k): f"content {k}",
                 ("article", k): f"Daily\n\narticle {k}\n\nSame words"}
        want |= {(f"copy-{tag}", k): "One story\n\nits end" for tag in ("main", "article")}
    assert got == want


def test_template_does_not_depend_on_host_size(spark):
    pages = [(n * 1000 + k, f"http://h{n}.example/{k}", f"<div><p>story {k}</p></div>" + "<div>Section bar</div>" * (k < 4)
              + "<div>Rare</div>" * (k < 3)) for n in (10, 300) for k in range(n)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == {
        n * 1000 + k: f"story {k}" + "\n\nRare" * (k < 3) for n in (10, 300) for k in range(n)}


# ---- decontamination


def words(t):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]


def test_decontaminate_shuffle_form_salts_places(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    passage = "one two three four five six seven eight nine ten"  # in two thirds of the rows, and a very long item
    rows = [(i, f"w{i} {passage} x{i}" if i % 3 else f"w{i} none") for i in range(600)]
    bench = spark.createDataFrame([("a", passage), ("b", " ".join(f"q{k}" for k in range(20_000)))], "item_id string, text string")
    rows.append((600, " ".join(f"q{k}" for k in range(30_000))))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.decontaminate(docs(rows), bench).collect()}
    assert got == {i: (12, 10, 1) if i % 3 else (2, 0, 0) for i in range(600)} | {600: (30_000, 20_000, 1)}
    plan = decontaminate.matches(docs(rows), bench)._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan and "[\0" not in plan


@pytest.mark.parametrize("windows,anchors", [(None, None), (0, None), (0, 0)])
def test_decontaminate(spark, docs, windows, anchors, monkeypatch):
    if windows is not None:
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", windows)
    if anchors is not None:
        monkeypatch.setattr(decontaminate, "BROADCAST_ANCHORS", anchors)
    rows = corpus(11)
    rng = random.Random(2)
    items = [(k, " ".join(words(t)[5:5 + rng.choice([3, 9, 10, 25])]).upper()) for k, (_, t) in enumerate(rows[:25])]
    items += [(100, None), (101, "..."), (102, "Éa b, É-c"), (7, items[7][1]), (None, items[3][1]), (103, items[3][1]), (104, "th")]
    rows += [(3000, "xx éa b é c yy Éa B, É c"), (3001, "x" * 50_000 + " th")]
    want = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for k, x in items:
            x = words(x)
            n = min(len(x), 10)
            for s in range(len(x) - n + 1 if x else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == x[s:s + n]:
                        hit.update(range(p, p + n))
                        found.add("" if k is None else str(k))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    d = docs(rows)
    bench = spark.createDataFrame([(k, t, "a") for k, t in items], "item_id long, text string, anchor string")
    got = decontaminate.decontaminate(d, bench).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    clean = decontaminate.clean_rows(d, bench)
    assert clean.columns == d.columns
    assert sorted(repr(r.doc_id) for r in clean.collect()) == sorted(repr(w[0]) for w in want if not w[5])


def test_decontaminate_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs([]), none).count() == 0
    assert [r.contaminated for r in decontaminate.decontaminate(docs([(1, "a b"), (2, None)]), none).collect()] == [False, False]


# ---- packing


def check_bins(lengths, bins, offsets, caps, allowed):
    for b in range(len(caps)):
        at = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert at and at[0][0] == 0
        assert all(o + n == p for (o, n), (p, _) in zip(at, at[1:]))  # one after the other
        used = sum(n for _, n in at)
        assert caps[b] == min(c for c in allowed if c >= used)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    rng = np.random.default_rng(seed)
    allowed = (16, 32, 64, 128)
    lengths = rng.integers(1, 129, rng.integers(1, 300))
    bins, offsets, caps = packing.best_fit(lengths, allowed)
    check_bins(lengths, bins, offsets, caps, allowed)
    # against a slow best fit that scans all bins
    room, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        fits = [(r, b) for b, r in enumerate(room) if r >= lengths[i]]
        if fits:
            assert room[bins[i]] == min(fits)[0]
            b = bins[i]
        else:
            b = len(room)
            assert bins[i] == b
            rest = [x for x in np.argsort(-lengths, kind="stable").tolist()]
            rest = rest[rest.index(i) + 1:]
            cost = {c: (c + c * c / packing.ATTENTION + packing.BIN_COST)
                    / (lengths[i] + min(c - lengths[i], sum(lengths[x] for x in rest if lengths[x] <= c - lengths[i])))
                    for c in allowed if c >= lengths[i]}
            room.append(min(cost, key=lambda c: (cost[c], c)))
        room[b] -= lengths[i]
        want[i] = b
    assert lengths.sum() / caps.sum() > 0.6


def test_pack_documents_keeps_every_word(spark, docs, monkeypatch):
    rows = corpus(13) + [(5000, "w " * 300)]
    got = packing.pack_documents(docs(rows), capacities=(16, 64), shard_rows=40).collect()
    need = sorted((n + 1 if n else 0) for n in (len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows))
    total = {}
    for r in got:
        total.setdefault((r.doc_id is None, r.doc_id), []).append(r)
    assert sum(r.length for r in got) == sum(need)
    assert sum(r.piece == 0 for r in got) == len(rows)
    shards = {}
    for r in got:
        assert (r.bin is None) == (r.length == 0)
        if r.length:
            shards.setdefault(r.shard, []).append(r)
    assert len(shards) > 1
    for part in shards.values():
        caps = {r.bin: r.capacity for r in part}
        check_bins(np.array([r.length for r in part]), np.array([r.bin for r in part]), np.array([r.offset for r in part]),
                   [caps[b] for b in range(len(caps))], (16, 64))
    assert packing.pack_documents(docs([])).count() == 0
    assert [tuple(r)[:4] for r in packing.pack_documents(docs([(None, None)])).collect()] == [(None, 0, 0, 0)]


def test_markup_is_read_once_and_never_leaks():
    import time

    odd = "<script>if (a<b) { f() } // don't</script><article class=\"x\"><p>Body one</p><p>It's two</p></article>"
    assert [t for t, _ in html_text.main_blocks(odd)[0]] == ["Body one", "It's two"]
    quotes = "<article><p title=\"a > b\" data-x='>'>One</p><p class=it's>Two</p><p title=>Three</p></article>"
    assert [t for t, _ in html_text.main_blocks(quotes)[0]] == ["One", "Two", "Three"]
    assert [t for t, _ in html_text.main_blocks("<article><p>Text</p></article>a <b class=")[0]] == ["Text"]
    for hard in ("a <b " * 200_000, "<b>" * 50_000 + "</x>" * 50_000, "<p title='" * 60_000, '<a href="x' * 60_000 + ">", "<!--" * 100_000):
        begin = time.time()
        html_text.main_blocks(hard)
        assert time.time() - begin < 5


def test_a_form_around_the_page_is_no_form_to_drop():
    page = "<html><body><form action='/x'><div><h1>Title</h1><p>A page wrapped in one form.</p></div></form></body></html>"
    assert [t for t, _ in html_text.main_blocks(page)[0]] == ["Title", "A page wrapped in one form."]
    asked = "<html><body><p>Text that is much longer than the form below it.</p><form><label>Name</label><input></form></body></html>"
    assert [t for t, _ in html_text.main_blocks(asked)[0]] == ["Text that is much longer than the form below it."]


def test_pages_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).collect() == []


def test_packing_does_not_depend_on_the_partitioning(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "EQUAL_RUN", 8)
    rows = [(i % 50, "w " * (i % 23)) for i in range(300)] + [(None, "a b c")] * 100 + [(7, "same text here")] * 100
    got = [sorted(map(tuple, packing.pack_documents(docs(rows[::step]).repartition(parts), capacities=(16, 64), shard_rows=40).collect()), key=repr)
           for step, parts in ((1, 1), (-1, 7))]
    assert got[0] == got[1] and len(got[0]) == 500
    per = {}
    for r in got[0]:
        per[r[4]] = per.get(r[4], 0) + 1
    assert max(per.values()) < 200  # two groups of 100 equal rows are spread over shards
