"""Main text of web pages by differencing each page with the page nearest by URL.

A page becomes lines, one for each block of text, in three kinds. Lines of an ``article``
or ``main`` element are its text. Lines of elements that are never text (menus, headers,
footers, sidebars, notices, adverts, forms, comments) are template lines: their words
differ from page to page, so they are told by their element and go. All other lines are
open: they are aligned with those of the nearest page of the same host by longest common
subsequence, and the shared ones are deleted; those left are text as well, also on a page
that has an article or main element.
"""

from __future__ import annotations

import html
import json
import re

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored
from clickloom.llm.url_digests import host_and_path

# HTML element names, and words in class, id and role that mark template parts.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "object")
TEMPLATE = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head")
MARKS = frozenset("""
ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
nav navbar navigation menu breadcrumb breadcrumbs header masthead footer contentinfo sidebar aside
complementary widget notice notices cookie cookies consent gdpr alert popup modal overlay newsletter
subscribe subscription signup login search form comment comments respond replies disqus share sharing
social related recommended toolbar pagination pager skip
""".split())
INLINE = frozenset("""
a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
MARKED = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORDS = re.compile(r"[a-z]+")


def _is_template(name: str, attributes: str) -> bool:
    if name in TEMPLATE:
        return True
    if name in ("article", "main", "body", "html") or not attributes:
        return False
    return any(word in MARKS for value in MARKED.findall(attributes) for word in WORDS.findall(value.lower()))


def page_lines(page: str) -> tuple[list[str], list[str], bool]:
    """Article lines, open lines, and whether there is an article or main element."""
    lines, has_article = ordered_lines(page)
    return [x for kind, x in lines if kind == "text"], [x for kind, x in lines if kind == "open"], has_article


def ordered_lines(page: str) -> tuple[list[tuple[str, str]], bool]:
    """``(kind, line)`` in the order of the page, the kinds being text and open, and whether
    there is an article or main element.

    Character references are decoded, white space becomes one space, lines are trimmed
    and empty ones left out. Unclosed elements end with their parent; an ``article`` or
    ``main`` tag ends unclosed template parts other than comments.
    """
    lines: list[tuple[str, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, str]] = []  # (element, state): text, open or template
    has_article = False
    at, state, kind = 0, "open", "open"  # kind: of the text in parts

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((kind, text))

    for token in iter(lambda: TOKEN.search(page, at), None):
        if token.start() > at and state != "template":
            parts.append(page[at:token.start()])
            kind = state
        at = token.end()
        closing, name, attributes = token[1] or token[4], token[2] or token[5], token[3] or token[6] or ""
        if not name:
            continue
        name = name.lower()
        if name in RAW and not closing:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        template = not closing and _is_template(name, attributes)
        if name in INLINE:
            parts.append(" " if name == "br" else "")
            if name in VOID or not template and all(open_name != name for open_name, _ in stack):
                continue
        else:
            close()
            if stack and stack[-1] == ("p", "template"):
                stack.pop()  # the next block ends an open paragraph
        if closing:
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if place is not None:
                del stack[place:]
        elif name in ("article", "main") and state != "text":
            comments = "comment" in attributes.lower()
            has_article |= not comments
            stack.append((name, "template" if comments else "text"))
        elif name not in VOID and (name != "p" or template):
            stack.append((name, "template" if template else stack[-1][1] if stack else "open"))
        state = stack[-1][1] if stack else "open"
    if at < len(page) and state != "template":
        parts.append(page[at:])
        kind = state
    close()
    return [line for line in lines if line[0] != "template"], has_article


def shared_lines(ours: list[str], theirs: list[str]) -> set[int]:
    """Places in ``ours`` of a longest common subsequence with ``theirs``.

    Bit-parallel: one integer with a bit per line of ``ours`` for each line of ``theirs``.
    """
    places: dict[str, int] = {}
    for k, line in enumerate(ours):
        places[line] = places.get(line, 0) | 1 << k
    full = (1 << len(ours)) - 1
    rows, now = [], full
    for line in theirs:
        met = now & places.get(line, 0)
        now = ((now + met) | (now - met)) & full
        rows.append(now)
    shared, row, place = set(), len(theirs), len(ours)
    while row and place:
        if rows[row - 1] >> (place - 1) & 1:
            place -= 1
        else:
            row -= 1
            if not row or rows[row - 1] >> (place - 1) & 1:
                place -= 1
                shared.add(place)
    return shared


def _parsed(batches):
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        blobs = [pack.compress(json.dumps(ordered_lines(page or "")[0]).encode("utf-8", "surrogatepass"))
                 for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "host", "path")), pa.array(blobs, pa.binary())],
            ["page_id", "url", "host", "path", "lines"])


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def _row(part, kind, run, here, path=None, text=None, lines=None):
    return (part, kind, run, here["page_id"], here["url"], here["host"], path, text, lines)


def _differenced(batches):
    """Pages come in the order of host and path, as runs of neighbours with equal host and lines.

    The nearest page of another class is, for all pages of a run, the last page of the run
    before or the first of the run after. Runs between two others are done here; pages of the
    first and the last run wait, as their neighbours may lie in other partitions, and the edges
    of the partition tell these what they have to know. The pages of a run wait without lines.
    """
    unpack = zstandard.ZstdDecompressor()
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    before = run = None  # the last page of the run before; the first and last page, and all, of this one
    count = 0

    def ended(after):
        """Rows of the run that ends before the page ``after``."""
        first, last, pages = run
        place = (PART_FIRST if count == 1 else 0) | (PART_LAST if after is None else 0)
        if not place:
            texts = {}
            for page in pages:
                near = _nearest(page["path"], before, after, page["host"])
                which = 0 if near is None else 1 if near is before else 2
                if which not in texts:
                    texts[which] = _main_text(_unpacked(first, unpack), _unpacked(near, unpack))
                yield _row(part, "done", 0, page, text=texts[which])
            return
        for page in pages:
            yield _row(part, "wait", place, page, path=page["path"])
        yield _row(part, "first", place, first, path=first["path"], lines=first["lines"])
        yield _row(part, "last", place, last, path=last["path"], lines=first["lines"])
        if place == PART_FIRST and after is not None:
            yield _row(part, "next", place, after, path=after["path"], lines=after["lines"])
        if place == PART_LAST and before is not None:
            yield _row(part, "before", place, before, path=before["path"], lines=before["lines"])

    for batch in batches:
        for page in batch.to_pylist():
            small = {k: page[k] for k in ("page_id", "url", "host", "path")}
            if not page["host"]:
                out.append(_row(part, "done", 0, page, text=_main_text(_unpacked(page, unpack), None)))
            elif run is not None and _same(run[0], page):
                run = (run[0], {**small, "lines": run[0]["lines"]}, run[2])
                run[2].append(small)
            else:
                if run is not None:
                    out.extend(ended(page))
                    before = run[1]
                count += 1
                run = (page, page, [small])
            if len(out) >= 256:
                yield _batch(out)
                out = []
    if run is not None:
        out.extend(ended(None))
    for a in range(0, len(out), 4096):
        yield _batch(out[a:a + 4096])


PART_FIRST, PART_LAST = 1, 2
ROWS = ("part long, kind string, run long, page_id long, url string, host string, path string, "
        "text string, lines binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([x[k] for x in rows], kind) for k, kind in enumerate(kinds)],
        [column.split()[0] for column in ROWS.split(", ")])


def _same(x, y) -> bool:
    """Whether two pages of a host are of one class; equal lines are packed into equal bytes."""
    return x["host"] == y["host"] and x["lines"] == y["lines"]


def _nearest(path: str, before, after, host):
    near = [x for x in (before, after) if x is not None and x["host"] == host]
    return max(near, key=lambda x: _common(x["path"], path), default=None)


def _unpacked(page, unpack):
    return None if page is None else json.loads(unpack.decompress(page["lines"]))


def _beyond(edges: list[dict]) -> dict:
    """For each waiting run, by partition and place: its lines, the page before and the page after."""
    parts: dict[int, dict] = {}
    for edge in edges:
        parts.setdefault(edge["part"], {})[edge["run"], edge["kind"]] = edge
    order, both, known = sorted(parts), PART_FIRST | PART_LAST, {}
    back = None, None  # the last page so far, and the last one of another class than it
    for part in order:
        p = parts[part]
        head = both if (both, "first") in p else PART_FIRST
        first = p[head, "first"]
        other = back[1] if back[0] is not None and _same(back[0], first) else back[0]
        known[part, head] = [first, other, None]
        if head == both:
            back = p[both, "last"], other
        else:
            known[part, PART_LAST] = [p[PART_LAST, "first"], p[PART_LAST, "before"], None]
            back = p[PART_LAST, "last"], p[PART_LAST, "before"]
    ahead = None, None
    for part in reversed(order):
        p = parts[part]
        tail = both if (both, "first") in p else PART_LAST
        first = p[tail, "first"]
        other = ahead[1] if ahead[0] is not None and _same(ahead[0], first) else ahead[0]
        known[part, tail][2] = other
        if tail == both:
            ahead = first, other
        else:
            known[part, PART_FIRST][2] = p[PART_FIRST, "next"]
            ahead = p[PART_FIRST, "first"], p[PART_FIRST, "next"]
    return known


def _main_text(own: list, other: list | None) -> str:
    """Article lines, and the open lines that the other page does not share, in their order."""
    loose = [line for kind, line in own if kind == "open"]
    gone = shared_lines(loose, [line for kind, line in other if kind == "open"]) if other and loose else set()
    kept = iter([k not in gone for k in range(len(loose))])
    return "\n".join(line for kind, line in own if kind == "text" or next(kept))


def main_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages(page_id, url, html)``.

    Pages of a host with equal lines are one class. The nearest page is the last one before or
    the first one after, in the order of host, path and ``page_id``, that is of another class:
    the one whose path shares the longer prefix (ties: the one before). The order is cut into
    range partitions, so a host of any size is spread over tasks; pages at the edges of a
    partition are settled in a second step, so no result depends on where the cuts lie. Null
    and empty pages give an empty text; a page without a host, or whose host has no other
    class, has no neighbour and keeps its open lines. Repeated rows are kept.
    """
    host, path = host_and_path(F.col("url"))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"),
                         path.alias("path"), F.col("html").cast("string").alias("html"))
    parsed = keyed.mapInArrow(_parsed, "page_id long, url string, host string, path string, lines binary")
    rows = stored(parsed.repartitionByRange("host", "path", "page_id")
                  .sortWithinPartitions("host", "path", "page_id")
                  .mapInArrow(_differenced, ROWS), "page-differences")
    edges = rows.where("kind not in ('done', 'wait')").select("part", "run", "kind", "host", "path", "lines")
    known = pages.sparkSession.sparkContext.broadcast(_beyond(edges.toArrow().to_pylist()))

    def settled(batches):
        unpack, texts = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            found = []
            for page in batch.to_pylist():
                own, before, after = known.value[page["part"], page["run"]]
                near = _nearest(page["path"], before, after, page["host"])
                which = page["part"], page["run"], 0 if near is None else 1 if near is before else 2
                if which not in texts:
                    texts[which] = _main_text(_unpacked(own, unpack), _unpacked(near, unpack))
                found.append(texts[which])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])

    waited = (rows.where("kind = 'wait'").select("part", "run", "page_id", "url", "host", "path")
              .mapInArrow(settled, "page_id long, url string, text string"))
    return rows.where("kind = 'done'").select("page_id", "url", "text").unionByName(waited).withColumn(
        "n_chars", F.length("text").cast("long"))
