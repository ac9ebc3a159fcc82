"""Main text of HTML pages by union-free wrapper inference per host.

A page's token tree is folded to a union-free regular expression: neighbours of
equal label and like content become a repeated group, as do runs of several
elements that repeat. Two expressions are aligned level by level; what only one of
them has becomes optional, runs of different lengths become repeated groups, and
text that differs becomes a text slot. The aligned expression of a host is its
wrapper; its slots count pages, characters and characters in links.

Wrappers are folded up without holding a host's pages: every task aligns the pages
it reads, host by host, and sends one wrapper per host; these are aligned in two
shuffles, first by host and a salt, then by host, each streaming over sorted rows
with one wrapper held. The wrapper says which element is the article and what
in it is boilerplate, and this decision, a few hundred bytes, joins the host's
pages, whose text is then read off by aligning each page with it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm.html_tree import Element, parse
from retailcast.llm.textvec import frugal
from retailcast.session import materialize

#: Items of an expression. Text: [TEXT, hash of the one text it always held or None, count, characters, in links];
#: element: [ELEMENT, label, marks, count, items]; group of several items: [GROUP, "", marks, count, items].
TEXT, ELEMENT, GROUP = 0, 1, 2
OPTIONAL, REPEATED = 1, 2
#: Longest run of elements that is looked for as a repeated group.
RUN = 5
#: A level with more items is folded by label, and with more labels by tag: wrappers stay small, no page is left out.
WIDE = 40
#: Hosts' items that a task holds before it sends what it has.
HELD = 200_000
SALTS = 16
SHIPPED, PIECES = 16 << 20, 400
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold running text, and those that the search for the article doesn't enter.
PROSE = HEADINGS | frozenset("p pre blockquote td th li dd dt figcaption".split())
CLOSED = PROSE - {"td", "th"} | {"ul", "ol", "dl"}


# -- expressions --------------------------------------------------------------

def expression(node: Element) -> list:
    """The folded items of an element's content."""
    items = []
    for kid in node.kids:
        if isinstance(kid, tuple):
            items.append([TEXT, zlib.crc32(kid[0].encode("utf-8", "replace")) + len(kid[0]) * 2**32, 1, len(kid[0]), kid[1]])
        elif not kid.out:
            items.append([ELEMENT, kid.label, 0, 1, expression(kid)])
    return fold(items)


def alike(a: list, b: list) -> bool:
    """Whether two items can stand for the same token: equal label and, with content, like content."""
    if a[0] != b[0] or a[1] != b[1]:
        return a[0] == b[0] == TEXT
    if a[0] == TEXT:
        return True
    mine, other = {k[1] if k[0] else "" for k in a[4]}, {k[1] if k[0] else "" for k in b[4]}
    if a[0] == GROUP or not mine or not other:
        return bool(mine & other) or (not mine and not other) or "|p" in a[1]
    both = len(mine & other)
    return both * 2 >= len(mine | other) or both == min(len(mine), len(other))


def joined(a: list, b: list) -> list:
    """The item that covers two items that are alike."""
    if a[0] == TEXT:
        return [TEXT, a[1] if a[1] == b[1] else None, a[2] + b[2], a[3] + b[3], a[4] + b[4]]
    return [a[0], a[1], a[2] | b[2], a[3] + b[3], align(a[4], b[4])]


def marked(item: list, mark: int) -> list:
    return item if item[0] == TEXT else [item[0], item[1], item[2] | mark, item[3], item[4]]


def into_group(group: list, item: list) -> list | None:
    """The group with ``item`` behind it: its last item repeated, or one more turn that holds only
    ``item``; None where none of its items is like it."""
    if alike(group[4][-1], item):
        return [GROUP, "", group[2] | REPEATED, group[3], [*group[4][:-1], marked(joined(group[4][-1], item), REPEATED)]]
    for i, own in enumerate(group[4]):
        if alike(own, item):
            kids = [joined(own, item) if k == i else marked(x, OPTIONAL) for k, x in enumerate(group[4])]
            return [GROUP, "", group[2] | REPEATED, group[3], kids]
    return None


def fold(items: list) -> list:
    """Neighbours that repeat, alone or as runs of up to RUN items, as repeated groups."""
    out: list = []
    for item in items:
        out.append(item)
        changed = True
        while changed and len(out) > 1:
            changed = False
            if out[-2][0] == GROUP and out[-1][0] == ELEMENT:
                grown = into_group(out[-2], out[-1])
                if grown:
                    out[-2:] = [grown]
                    changed = True
                    continue
            if out[-1][0] and alike(out[-2], out[-1]):
                out[-2:] = [marked(joined(out[-2], out[-1]), REPEATED)]
                changed = True
                continue
            if out[-1][0] == out[-2][0] == TEXT:
                out[-2:] = [joined(out[-2], out[-1])]
                changed = True
                continue
            for k in range(2, min(RUN, len(out) // 2) + 1):
                if all(alike(a, b) for a, b in zip(out[-2 * k:-k], out[-k:], strict=True)):
                    turn = [joined(a, b) for a, b in zip(out[-2 * k:-k], out[-k:], strict=True)]
                    out[-2 * k:] = [[GROUP, "", REPEATED, 1, turn]]
                    changed = True
                    break
    return narrow(out) if len(out) > WIDE else out


def narrow(items: list) -> list:
    """A long level as one repeated group with an item for each label, or for each tag if the labels are many."""
    flat = []
    for item in items:
        flat += item[4] if item[0] == GROUP else [item]
    for by_tag in (False, True):
        by: dict = {}
        for item in flat:
            key = item[0] and item[1]
            if by_tag and item[0]:
                tag = item[1].split("|")[0]
                key = tag if len(tag) <= 10 and tag.isalnum() else "x"
                item = [ELEMENT, f"{key}|", *item[2:]]
            by[key] = joined(by[key], item) if key in by else item
        if len(by) <= WIDE:
            break
    return [[GROUP, "", REPEATED, 1, [marked(x, OPTIONAL) for x in by.values()]]]


def align(a: list, b: list) -> list:
    """The items that cover two item lists: the longest common sequence, the rest optional."""
    if len(a) == len(b) and all(alike(x, y) for x, y in zip(a, b, strict=True)):
        return [joined(x, y) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    like = [[alike(x, y) or (GROUP in (x[0], y[0]) and x[0] != y[0] and TEXT not in (x[0], y[0]) and
                             any(alike(k, y if x[0] == GROUP else x) for k in (x if x[0] == GROUP else y)[4])) for y in b] for x in a]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], 1 + best[i + 1][j + 1] if like[i][j] else 0)
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and like[i][j] and best[i][j] == 1 + best[i + 1][j + 1]:
            x, y = a[i], b[j]
            if x[0] == y[0]:
                out.append(joined(x, y))
            else:
                out.append(into_group(*((x, y) if x[0] == GROUP else (y, x))))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append(marked(a[i], OPTIONAL))
            i += 1
        else:
            out.append(marked(b[j], OPTIONAL))
            j += 1
    return fold(out)


def size(items: list) -> int:
    return sum(1 if x[0] == TEXT else 1 + size(x[4]) for x in items)


def notation(items: list) -> str:
    """An expression as text: (a b)+ repeats, x? is optional, # is a text slot, 'text' a text all pages share."""
    parts = []
    for x in items:
        if x[0] == TEXT:
            parts.append("'text'" if x[1] is not None and x[2] > 1 else "#")
            continue
        inside = notation(x[4])
        body = f"({inside})" if x[0] == GROUP else x[1].split("|")[0] + (f"<{inside}>" if inside else "")
        parts.append(body + ("+" if x[2] & REPEATED else "") + ("?" if x[2] & OPTIONAL else ""))
    return " ".join(parts)


# -- the article's place ------------------------------------------------------

def tag_of(item: list) -> str:
    return item[1].split("|")[0] if item[0] == ELEMENT else ""


def prose(items: list, pages: int) -> tuple[int, int]:
    """(characters outside links, characters inside) of the slots; text that three or more pages share counts as none."""
    plain = linked = 0
    for x in items:
        if x[0] == TEXT:
            if not (pages >= 3 and x[1] is not None and x[2] >= 3):
                plain, linked = plain + x[3] - x[4], linked + x[4]
        else:
            a, b = prose(x[4], pages)
            plain, linked = plain + a, linked + b
    return plain, linked


def _found(items: list, tags: tuple[str, ...]) -> list:
    """The topmost elements with one of the tags (or that role)."""
    out = []
    for x in items:
        if x[0] != TEXT:
            out += [x] if tag_of(x) in tags else _found(x[4], tags)
    return out


def chosen(items: list, pages: int) -> list:
    """The elements that hold the article: ``article`` or ``main`` if they hold text of some
    weight, else the deepest element with three fifths of the text of each one around it."""
    weight = {}

    def of(x: list) -> int:
        if id(x) not in weight:
            weight[id(x)] = prose([x], pages)[0]
        return weight[id(x)]

    within = [x for x in _found(items, ("main",)) if of(x)] or items
    total = sum(of(x) for x in within)
    articles = [x for x in _found(within, ("article",)) if of(x)]
    if articles and sum(of(x) for x in articles) * 5 >= total:
        most = max(of(x) for x in articles)
        return [x for x in articles if of(x) * 5 >= most]
    level = within
    while True:
        inner = [x for x in level if x[0] != TEXT]
        top = max(inner, key=of, default=None)
        total = sum(of(x) for x in level)
        if top is None or tag_of(top) in CLOSED or not of(top) or of(top) * 5 < 3 * total:
            return level
        if top[2] & REPEATED or not any(x[0] != TEXT for x in top[4]):
            return [top]
        level = top[4]


def decision(items: list, pages: int) -> str:
    """The wrapper as JSON with, for each item, whether the article starts there (1), it is boilerplate (2) or neither (0)."""
    starts = chosen(items, pages)
    main, own = {id(x) for x in starts}, sum(prose([x], pages)[0] for x in starts)

    def written(x: list, inside: bool, prose_around: bool) -> list:
        start = id(x) in main
        inside = inside or start
        state = int(start)
        if x[0] == TEXT:
            shared = pages >= 3 and x[1] is not None and x[2] >= 3 and own > 0
            return [TEXT, "", 2 if inside and shared and not prose_around else state, []]
        if inside and not (start and len(main) == 1) and x[0] == ELEMENT and tag_of(x) not in PROSE:
            plain, linked = prose(x[4], 0)
            small = tag_of(x) == "form" and prose(x[4], pages)[0] * 2 < own
            state = 2 if small or linked * 2 > plain + linked else state
        around = prose_around or tag_of(x) in PROSE
        return [x[0], x[1], state, [written(k, inside, around) for k in x[4]]]
    return json.dumps([written(x, False, False) for x in items], separators=(",", ":"), ensure_ascii=False)


# -- reading a page with a wrapper ---------------------------------------------

def _flat(items: list) -> list:
    out = []
    for x in items:
        out += _flat(x[3]) if x[0] == GROUP else [x]
    return out


def _state_of_group(items: list) -> list:
    """The items with the marks of their groups handed down."""
    out = []
    for x in items:
        out += _state_of_group([[k[0], k[1], k[2] or x[2], k[3]] for k in x[3]]) if x[0] == GROUP else [[x[0], x[1], x[2], x[3]]]
    return out


def _matched(kid, wanted: list, at: int) -> int:
    """The wrapper item that a page's element or text stands for: from ``at`` on, then from the start; -1 if none."""
    order = [*range(at, len(wanted)), *range(at)]
    if isinstance(kid, tuple):
        return next((i for i in order if wanted[i][0] == TEXT), -1)
    same = [i for i in order if wanted[i][0] == ELEMENT and wanted[i][1] == kid.label]
    if len(same) > 1:                   # by what they hold
        mine = {"" if isinstance(k, tuple) else k.label for k in kid.kids}

        def likeness(i: int) -> float:
            other = {k[1] if k[0] else "" for k in _flat(wanted[i][3])}
            return len(mine & other) / max(len(mine | other), 1)
        same.sort(key=likeness, reverse=True)       # stable: the nearest of the best
    if same:
        return same[0]
    return next((i for i in order if wanted[i][0] == ELEMENT and wanted[i][1] == kid.tag + "|"), -1)


def blocks(node: Element, wanted: list, inside: bool) -> Iterator[str]:
    """The article's blocks of a page's element, read with the wrapper's items ``wanted``."""
    wanted, at = _state_of_group(wanted), 0
    for kid in node.kids:
        found = _matched(kid, wanted, at)
        state = 0
        if found >= 0:
            at, state = found, wanted[found][2]
        if state == 2 or (not isinstance(kid, tuple) and kid.out):
            continue
        if isinstance(kid, tuple):
            if inside or state == 1:
                yield kid[0]
        else:
            yield from blocks(kid, wanted[found][3] if found >= 0 else [], inside or state == 1)


def article(page: str | None, wrapper: list) -> str:
    tree = parse(page)
    text = "\n".join(blocks(tree, wrapper, False))
    if text or not tree.kids:
        return text
    own = expression(tree)                              # a page unlike its host's others
    return "\n".join(blocks(tree, json.loads(decision(own, 1)), False))


# -- on Spark -------------------------------------------------------------------

WRAPPER = "host string, pages long, wrapper string"


def _send(held: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([n for n, _ in held.values()], pa.int64()),
                                       pa.array([json.dumps(x, separators=(",", ":"), ensure_ascii=False) for _, x in held.values()])], ["host", "pages", "wrapper"])


@frugal
def _page_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of the pages of a task; sent early when many are held."""
    held: dict = {}
    room = HELD
    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            items = expression(parse(page.as_py()))
            if host in held:
                n, old = held[host]
                held[host] = n + 1, align(old, items)
            else:
                held[host] = 1, items
                room -= size(items)
            if room < 0:
                yield _send(held)
                held, room = {}, HELD
    if held:
        yield _send(held)


@frugal
def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of rows sorted by host; one is held at a time."""
    host, pages, items, out = None, 0, None, {}
    for batch in batches:
        for h, n, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if items is not None and h != host:
                out[host] = pages, items
                pages, items = 0, None
                if len(out) == 500:
                    yield _send(out)
                    out = {}
            host, pages = h, pages + n
            items = json.loads(w) if items is None else align(items, json.loads(w))
    if items is not None:
        out[host] = pages, items
    if out:
        yield _send(out)


@frugal
def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [decision(json.loads(w), n) for n, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())], ["_host", "_pages", "decision"])


@frugal
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        texts = []
        for page, made in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
            if made not in known:
                if len(known) > 1_000:
                    known.clear()
                known[made] = json.loads(made)
            texts.append(article(page.as_py(), known[made]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def host_of(url):
    """Lower-cased host with its port; a null or relative url has the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def host_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, pages, wrapper) of every host."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    first = rows.mapInArrow(_page_wrappers, WRAPPER).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = first.repartition("host", "_salt").sortWithinPartitions("host", "_salt", "wrapper").select("host", "pages", "wrapper").mapInArrow(_aligned, WRAPPER)
    return some.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_aligned, WRAPPER)


def with_decisions(rows: DataFrame, made: DataFrame) -> DataFrame:
    """``rows`` (with their host as ``_of``) and the decision of their host."""
    held, total = made.agg(F.sum(F.octet_length("decision") + F.octet_length("_host")), F.sum("_pages")).first()
    if (held or 0) <= SHIPPED:
        return rows.join(F.broadcast(made), F.col("_of") == F.col("_host"), "left")
    share = F.ceil(F.col("_pages") * F.lit(PIECES) / F.lit(total)).cast("long")
    hot = made.filter(share > 1).select("_host", share.alias("n")).collect()             # fewer than PIECES hosts
    pieces = F.lit(1).cast("long")
    if hot:
        known = F.create_map(*[F.lit(x) for r in hot for x in (r["_host"], r["n"])])
        pieces = F.coalesce(known[F.col("_of")], pieces)
    rows = rows.withColumn("_piece", F.pmod(F.xxhash64("page_id", "html"), pieces))
    made = made.withColumn("_own", F.explode(F.sequence(F.lit(0).cast("long"), share - 1)))
    return rows.join(made, (F.col("_of") == F.col("_host")) & (F.col("_piece") == F.col("_own")), "left")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row: the blocks of the article, joined by newlines.

    Character references are decoded, white space inside a block becomes one space, empty blocks
    are left out; a ``br`` is white space. A null or empty page, and one without an article, has
    the empty text. Broken markup, very long or deeply nested pages and pages of hosts with one
    page take part like all others; repeated rows and null ids and urls stay (null urls share one
    host). An empty table gives none; other columns are ignored.
    """
    made = materialize(host_wrappers(pages, url_col, html_col).mapInArrow(_decided, "_host string, _pages long, decision string"), "wrappers")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("_of"))
    kinds = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, text string, n_chars long"
    return with_decisions(rows, made).select("page_id", "url", "html", "decision").mapInArrow(_read, kinds)
