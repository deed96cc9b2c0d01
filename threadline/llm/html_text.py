"""HTML extraction by site template removal.

Each page is parsed once into elements.  Every element subtree with text
gets a hash (tag, class, id, texts and children).
Spark counts, per host, on how many different pages a subtree hash occurs; a subtree
that recurs on at least ``MIN_PAGES`` pages, whatever the size of the host,
is part of the site template and is deleted wherever it occurs on that host.
Around this, markup says what is never main text: navigation, headers, footers,
side boxes, notices, adverts, forms, scripts, styles and reader comments, by tag,
role and class or id words.  Where a page marks its main text (``article``, ``main``
or a content id/class), text outside it is not main text either; inside it the
recurring subtrees are deleted as on other pages.  Inside an ``article`` just
``CONTAINERS`` can be template: its own paragraphs, headings and quotes are kept
even when other pages repeat them.

Counts are aggregated before the shuffle and per (host, subtree), so a host with a
third of all pages is no hot group; the deletions come back as one short list per
page.  Copies of a page count as one page: equal html, or, where the main text is
marked, equal main text under the markup rules (a copy may have other menus or adverts).

Defined cases: null html is an empty page with text ''; a null url has the host
''; unclosed or truncated markup is closed at the end; repeated page ids get a row
each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.llm.common import checkpointed, documents, small_batches, when_small

MIN_PAGES = 4
BROADCAST_ROWS = 100_000

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"[>\"']")
VALUE = re.compile(r"=\s*\Z")
ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody tfoot thead title tr ul script style".split())
CLOSES_P = BLOCK - {"body", "html", "head", "title", "option", "optgroup", "legend", "caption", "tbody", "tfoot", "thead",
                    "tr", "script", "style"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select body html article section div main nav aside footer header form".split())
DROP_TAGS = frozenset(
    "script style noscript template svg math canvas iframe object form nav footer header aside button select textarea "
    "input head title dialog menu search noembed noframes".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidebars footer header masthead comment comments disqus cookie cookies consent notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "widget widgets toolbar pagination pager login search".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu".split())
CONTENT_WORDS = frozenset("content article post entry story maincontent articlebody".split())
#: Elements that can be template inside an article.
CONTAINERS = frozenset("article section div center ul ol dl table figure details fieldset address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class _Tags:
    """Markup of a page from left to right, each character looked at a bounded number of times.

    A quote counts behind an equals sign and where it is closed; a comment or section without
    an end runs to the end of the page, what no ``>`` follows is no tag.
    """

    def __init__(self, source: str):
        self.source = source
        self.last = {c: source.rfind(c) for c in (">", '"', "'", "-->", "]]>")}

    def _find(self, what: str, at: int) -> int:
        """Place behind the next ``what``; the end of the page if there is none."""
        return self.source.find(what, at) + len(what) if self.last[what] >= at else len(self.source)

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, stop, end tag, name, attributes) of the next markup; comments and declarations have no name."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            if source.startswith("<!--", start):
                return start, self._find("-->", start + 4), False, "", ""
            if source.startswith("<![CDATA[", start):
                return start, self._find("]]>", start + 9), False, "", ""
            if source.startswith(("<!", "<?"), start):
                return start, self._find(">", start + 2), False, "", ""
            if (m := NAME.match(source, start + 1)) and self.last[">"] >= m.end():
                end = self._tag_end(m.end())
                return start, end, bool(m[1]), m[2].lower(), source[m.end():end - 1]
            at = start + 1
        return None

    def _tag_end(self, at: int) -> int:
        source = self.source
        while self.last[">"] >= at:
            m = STOP.search(source, at)
            if m[0] == ">":
                return m.end()
            at = m.end()
            if self.last[m[0]] >= at and VALUE.search(source, max(0, m.start() - 40), m.start()):
                at = source.find(m[0], at) + 1
        return len(source)


class _Page:
    """Elements in document order and the events start, end and text."""

    __slots__ = ("tag", "parent", "drop", "words", "role", "events", "digest", "count", "wrapper")

    def __init__(self, source: str):
        self.tag, self.parent, self.drop, self.words, self.role = ["#root"], [-1], [False], [frozenset()], [""]
        self.digest: list[bytes] = [b""]
        self.events: list[tuple] = []
        self.count: dict[str, int] = {}
        self.wrapper: set[int] = set()
        self._parse(source)

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        values = {}
        if attrs and not attrs.isspace():
            for m in ATTRIBUTE.finditer(attrs):
                values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        words = frozenset(w for k in ("class", "id") if k in values
                          for w in re.split(r"[^a-z0-9]+", html.unescape(values[k]).lower()) if w)
        role = values.get("role", "").strip().lower()
        hidden = "hidden" in values or values.get("aria-hidden") == "true" or \
            "display:none" in values.get("style", "").replace(" ", "").lower()
        self.tag.append(tag)
        self.parent.append(parent)
        self.words.append(words)
        self.role.append(role)
        self.drop.append(hidden or tag in DROP_TAGS or role in DROP_ROLES or not DROP_WORDS.isdisjoint(words))
        self.digest.append(b"")
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        stack = [0]
        parts: list[list[bytes]] = [[]]
        events = self.events

        def close(n: int) -> None:
            while len(stack) > n:
                e, p = stack.pop(), parts.pop()
                self.count[self.tag[e]] -= 1
                if p:
                    label = f"{self.tag[e]} {' '.join(sorted(self.words[e]))}".encode()
                    self.digest[e] = xxhash.xxh64_digest(label + b"\0" + b"\1".join(p))
                    parts[-1].append(self.digest[e])
                events.append(("e", e))

        def text(piece: str) -> None:
            if piece:
                piece = html.unescape(piece)
                events.append(("t", stack[-1], piece))
                if norm := " ".join(piece.split()):
                    parts[-1].append(norm.encode("utf-8", "replace"))

        tags, count = _Tags(source), self.count

        def top(wanted, scope) -> int | None:
            """Place of the topmost open element of a wanted kind, above any of ``scope``."""
            if any(count.get(x) for x in wanted):
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] in wanted:
                        return i
                    if self.tag[stack[i]] in scope:
                        break
            return None

        at = 0
        while (found := tags.next(at)) is not None:
            start, stop, ends, tag, attrs = found
            text(source[at:start])
            at = stop
            if not tag:
                continue
            if ends:
                if (i := top((tag,), ())) is not None:
                    close(i)
                continue
            if tag in CLOSES_P and (i := top(("p",), SCOPE)) is not None:
                close(i)
            if tag in SELF_CLOSING and (i := top(SELF_CLOSING[tag], SCOPE)) is not None:
                close(i)
            if tag in VOID:
                events.append(("v", tag))
                continue
            e = self._open(tag, attrs, stack[-1])
            stack.append(e)
            count[tag] = count.get(tag, 0) + 1
            parts.append([])
            events.append(("s", e))
            if tag in RAW:
                raw_end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                stop = raw_end.start() if raw_end else len(source)
                if tag == "title":
                    text(source[at:stop])
                at = raw_end.end() if raw_end else len(source)
                close(len(stack) - 1)
        text(source[at:])
        close(1)
        self._keep_wrapping_forms()

    def _keep_wrapping_forms(self) -> None:
        """A form that holds half of the page's letters or more wraps the page; it is no form to drop."""
        if not any(t == "form" for t in self.tag):
            return
        size = [0] * len(self.tag)
        for ev in self.events:
            if ev[0] == "t" and self.tag[ev[1]] not in RAW:
                size[ev[1]] += len(ev[2].strip())
        for e in range(len(self.tag) - 1, 0, -1):
            size[self.parent[e]] += size[e]
        self.wrapper = {e for e in range(1, len(self.tag)) if self.tag[e] == "form" and 2 * size[e] >= size[0] > 0}
        for e in self.wrapper:
            self.drop[e] = not DROP_WORDS.isdisjoint(self.words[e])

    def roots(self) -> list[int]:
        """The elements that mark the main text; none if the page marks nothing."""
        n = len(self.tag)
        lost = [False] * n
        for e in range(1, n):
            tag_drop = self.tag[e] in DROP_TAGS and e not in self.wrapper or not {"comment", "comments", "disqus"}.isdisjoint(self.words[e])
            lost[e] = lost[self.parent[e]] or tag_drop
        for found in (lambda e: self.tag[e] == "article", lambda e: self.tag[e] == "main" or self.role[e] == "main",
                      lambda e: self.tag[e] in ("div", "section", "td") and not CONTENT_WORDS.isdisjoint(self.words[e])):
            inside = [False] * n
            out = []
            for e in range(1, n):
                hit = not lost[e] and self.digest[e] != b"" and found(e)
                if hit and not inside[self.parent[e]]:
                    out.append(e)
                inside[e] = inside[self.parent[e]] or hit
            if out:
                return out
        return []

    def blocks(self) -> tuple[list[tuple[str, list[int]]], list[int], bool]:
        """Blocks of main text with the hashes of the subtrees above them that can be template, the hashes of such
        subtrees outside the marked main text, and whether the page marks its main text."""
        n = len(self.tag)
        roots = set(self.roots())
        keep, inside, article = [False] * n, [False] * n, [False] * n
        keep[0] = not roots
        for e in range(1, n):
            p = self.parent[e]
            inside[e] = inside[p] or e in roots
            if e in roots:
                keep[e] = True
            elif self.tag[e] in ("html", "body"):
                keep[e] = keep[p]
            elif self.tag[e] == "header" and inside[e] or self.tag[e] in HEADINGS and keep[p] is None:
                keep[e] = None if self.tag[e] == "header" and keep[p] else bool(keep[p] is None)
            else:
                # None: in the header of an article, of which just headings stay
                keep[e] = keep[p] if keep[p] is None else keep[p] and not self.drop[e]
        number = [0] * n  # 0: can not be template
        for e in range(1, n):
            p, tag = self.parent[e], self.tag[e]
            article[e] = article[p] or tag == "article"
            if self.digest[e] and tag not in ("html", "body", "head") and (not article[e] or article[p] and tag in CONTAINERS):
                number[e] = int.from_bytes(self.digest[e], "little", signed=True)
        seen = [number[e] for e in range(1, n) if number[e] and not inside[e]]

        out: list[tuple[str, list[int]]] = []
        run: list[str] = []
        home = -1

        def flush() -> None:
            nonlocal home
            line = " ".join("".join(run).split())
            run.clear()
            if line:
                above, e = [], home
                while e > 0 and (inside[e] or not roots):
                    if number[e]:
                        above.append(number[e])
                    e = self.parent[e]
                out.append((line, above))
            home = -1

        for ev in self.events:
            if ev[0] == "t":
                if keep[ev[1]]:
                    if home < 0:
                        home = ev[1]
                        while home and self.tag[home] not in BLOCK:
                            home = self.parent[home]
                    run.append(ev[2])
            elif ev[0] == "v":
                if ev[1] == "hr":
                    flush()
                else:
                    run.append(" ")
            elif self.tag[ev[1]] in BLOCK:
                flush()
            elif self.tag[ev[1]] in ("td", "th"):
                run.append(" ")
        flush()
        return out, seen, bool(roots)


def main_blocks(source: str | None):
    """(blocks, outside, marked): see :meth:`_Page.blocks`."""
    return _Page(source or "").blocks()


_PARSED = ("page_id long, url string, host string, sig long, "
           "blocks array<struct<text: string, above: array<bigint>>>, seen array<struct<h: bigint, holds: int>>")


def _keys(pages: DataFrame, url_col: str, html_col: str):
    host = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#:]*)", 1)
    return F.lower(host).alias("host"), F.xxhash64(html_col).alias("sig")


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every page with its blocks and the hashes of its subtrees (holds: a block lies in the subtree).

    Copies of a page have one sig: that of the html, or of the blocks where the main text is marked.
    """
    small_batches(pages.sparkSession, 500)
    block = pa.list_(pa.struct([("text", pa.string()), ("above", pa.list_(pa.int64()))]))
    subtree = pa.list_(pa.struct([("h", pa.int64()), ("holds", pa.int32())]))

    def rows(batches):
        for b in batches:
            blocks, seen, sig = [], [], []
            for same, source in zip(b.column("sig").to_pylist(), b.column("html").to_pylist()):
                made, outside, marked = main_blocks(source)
                if marked:
                    main = "\n\n".join(t for t, _ in made).encode("utf-8", "replace")
                    same = int.from_bytes(xxhash.xxh64_digest(main), "little", signed=True)
                sig.append(same)
                holds = {h for _, above in made for h in above}
                blocks.append([{"text": t, "above": a} for t, a in made])
                seen.append([{"h": h, "holds": int(h in holds)} for h in sorted(holds.union(outside))])
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), b.column("host"), pa.array(sig, pa.int64()), pa.array(blocks, block),
                 pa.array(seen, subtree)], names=["page_id", "url", "host", "sig", "blocks", "seen"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        *_keys(pages, url_col, html_col), F.col(html_col).alias("html")).mapInArrow(rows, _PARSED)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_pages: int = MIN_PAGES) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    found = parsed(pages, id_col, url_col, html_col)
    site = F.xxhash64("host").alias("site")
    # a row per subtree and different page
    subtrees = checkpointed(found.select(site, "sig", F.explode("seen").alias("s")).groupBy("site", "sig", "s.h")
                            .agg(F.max("s.holds").alias("holds")))
    template = (subtrees.groupBy("site", "h").agg(F.count("*").alias("n"), F.max("holds").alias("used"))
                .where((F.col("n") >= min_pages) & (F.col("used") == 1)).select("site", "h"))
    cut = checkpointed(subtrees.where("holds = 1").join(template, ["site", "h"])
                       .groupBy("site", "sig").agg(F.collect_set("h").alias("cut")))
    kept = F.filter("blocks", lambda b: ~F.arrays_overlap(b["above"], F.coalesce("cut", F.array().cast("array<bigint>"))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n\n")
    return (found.select("page_id", "url", site, "sig", "blocks").join(when_small(cut, BROADCAST_ROWS), ["site", "sig"], "left")
            .select("page_id", "url", text.alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))


def op4_html_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(documents(spark, sf_dir, "pages"))
