"""Main text of web pages by deducing each host's page templates.

The tokens of a page are its elements and its text blocks, each told apart by its path. Tokens of a host
that occur equally often on the same pages are one equivalence class. A class with enough pages
is a template if it has structure: elements, in their order on the page, that enclose text which is not
the class's own. So a host may have several templates, each with the pages that carry it. The text blocks of a
template's class are fixed; what its elements enclose otherwise are its slots, and among these
lies the main text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import written

#: Fewest pages of a template.
LEAST_PAGES = 5
#: A text block on this share of a host's pages is fixed, whatever class it is in, if the host has ten pages.
SHARE, MANY_PAGES = 0.95, 10
#: The main region holds at least this share of the text in slots.
MAIN_SHARE = 0.6
#: Fixed blocks that make up more than this share of a page's region are the page's own text: pages that
#: are copies of each other have their text in common, too.
FIXED_SHARE = 0.5

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "template tfoot th thead tr ul".split()
)
#: Elements that never hold main text.
APART = frozenset("head nav header footer aside form script style template noscript button select textarea title iframe svg canvas menu dialog object video audio".split())
#: Words in class, id and role that mark what is not main text.
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu submenu breadcrumb "
    "breadcrumbs sidebar aside rail widget widgets footer header masthead topbar toolbar cookie cookies consent gdpr notice notices alert alerts "
    "popup modal overlay comment comments reply replies respond disqus newsletter subscribe subscription signup login search share sharing social "
    "related recommended recommendations pagination pager copyright skip complementary contentinfo".split()
)
CENTRE = frozenset("article main".split())
#: A marked element with this share of a page's text is a wrapper, if nothing else tells.
WRAPPER_SHARE = 0.9
#: Elements that are parts of a text, not the place of a whole one.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr td th address summary caption".split())

# a start tag to its end, with quoted attributes; and as it is read where no quote ends any more
_OPEN = re.compile(r"<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>")
_OPEN_PLAIN = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*+)>")
_CLOSE = re.compile(r"</([a-zA-Z][^\s/>]*)[^>]*+>")
_CUT_OFF = re.compile(r"<[a-zA-Z/][^<>]*+\Z")
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-zA-Z]+")


class Element(NamedTuple):
    name: str
    path: str  # names and classes from the root
    apart: bool  # it or an ancestor never holds main text
    marked: tuple[int, ...]  # the marked elements around it, by number


class Block(NamedTuple):
    path: str
    text: str
    apart: bool
    linked: int  # characters inside links


class Tag(NamedTuple):
    start: int
    end: int
    opened: str
    attributes: str
    closed: str


def tags(page: str) -> Iterator[Tag]:
    """The tags of a page (comments and declarations without a name), each character looked at a few times at most."""
    at, last, pattern = 0, page.rfind(">"), _OPEN
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield Tag(start, at, "", "", "")
            continue
        if start > last:  # no tag ends any more: a tag cut off at the end of the page is none
            cut = _CUT_OFF.search(page, start)
            if cut:
                yield Tag(cut.start(), len(page), "", "", "")
            return
        after = page[start + 1 : start + 2]
        if after in ("!", "?"):
            at = page.find(">", start) + 1
            yield Tag(start, at, "", "", "")
        elif after == "/":
            found = _CLOSE.match(page, start)
            at = found.end() if found else start + 1
            if found:
                yield Tag(start, at, "", "", found[1].lower())
        else:
            found = pattern.match(page, start)
            if not found and after.isascii() and after.isalpha() and pattern is _OPEN:
                # every end that follows stands in quotes; later tags would be searched as far again
                pattern = _OPEN_PLAIN
                found = pattern.match(page, start)
            at = found.end() if found else start + 1
            if found:
                yield Tag(start, at, found[1].lower(), found[2], "")
                if found[1].lower() in RAW:
                    end = _raw_end(found[1].lower()).search(page, at)
                    at = end.end() if end else len(page)


_RAW_ENDS: dict[str, re.Pattern] = {}


def _raw_end(name: str) -> re.Pattern:
    return _RAW_ENDS.setdefault(name, re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.I))


def parse(page: str) -> tuple[list[Block], list[str]]:
    """The text blocks of a page in order, and the paths of its elements.

    Tolerates what browsers do: unclosed and stray tags, quotes inside scripts, a page that ends anywhere.
    """
    stack = [Element("", "", False, ())]
    open_names: Counter = Counter()
    open_blocks = [0]  # places of block elements in the stack
    blocks: list[tuple[Block, tuple[int, ...]]] = []
    paths: list[str] = []
    centred: set[int] = set()  # marked elements around an article, a main element or a first heading
    marks = 0
    text: list[str] = []
    linked = at = 0

    def flush():
        nonlocal linked
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            holder = stack[open_blocks[-1]]
            blocks.append((Block(holder.path, joined, stack[-1].apart, linked), stack[-1].marked))
        text.clear()
        linked = 0

    def cut(place: int):
        for element in stack[place:]:
            open_names[element.name] -= 1
        del stack[place:]
        while open_blocks[-1] >= place:
            open_blocks.pop()

    def take(end: int):
        nonlocal linked
        if end > at:
            text.append(page[at:end])
            if open_names["a"] > 0:
                linked += len(page[at:end].strip())

    for tag in tags(page):
        take(tag.start)
        at = tag.end
        name = tag.opened
        if name:
            if name == "br":
                text.append(" ")
                continue
            if name in BLOCK:
                flush()
                place = _implied_end(stack, open_blocks, name)
                if place:
                    cut(place)
            if name in VOID or (tag.attributes.endswith("/") and name in ("svg", "path", "use")):
                continue
            element, marked = _element(stack[-1], name, tag.attributes, marks)
            marks += marked
            if name in CENTRE or name == "h1":
                centred.update(element.marked)
            if name in BLOCK:
                paths.append(element.path)
            if name in RAW:
                end = _raw_end(name).search(page, at)
                at = end.end() if end else len(page)
                continue
            if name in BLOCK:
                open_blocks.append(len(stack))
            stack.append(element)
            open_names[name] += 1
        elif tag.closed:
            name = tag.closed
            if name in BLOCK:
                flush()
            if open_names[name] > 0:
                place = len(stack) - 1
                while stack[place].name != name:
                    place -= 1
                cut(place)
            elif name == "br":
                text.append(" ")
    take(len(page))
    flush()
    return _without_wrappers(blocks, centred), paths


def _without_wrappers(blocks: list[tuple[Block, tuple[int, ...]]], centred: set[int]) -> list[Block]:
    """The blocks with what their marked elements decide.

    A class name like `sidebar` sets an element apart, unless the element is plainly a wrapper of the main text: it
    encloses an article, a main element or the page's heading, or, where nothing does, nearly all text.
    """
    free = [(b, marked) for b, marked in blocks if not b.apart]
    total = sum(len(b.text) for b, _ in free)
    wrappers = set(centred)
    if not centred:
        while True:
            left = [m[0] for m in (tuple(x for x in marked if x not in wrappers) for _, marked in free) if m]
            outside = sum(len(b.text) for b, marked in free if not any(x not in wrappers for x in marked))
            if not left or outside >= (1 - WRAPPER_SHARE) * total:
                break
            # the outermost mark with the most text is a wrapper
            mass: Counter = Counter()
            for b, marked in free:
                for x in marked:
                    if x not in wrappers:
                        mass[x] += len(b.text)
                        break
            wrappers.add(max(mass, key=lambda x: (mass[x], -x)))
    return [b._replace(apart=b.apart or any(x not in wrappers for x in marked)) for b, marked in blocks]


def _implied_end(stack: list[Element], open_blocks: list[int], name: str) -> int:
    """The place of the element that a new block ends: an open paragraph, or a list item, cell or row before it; or 0."""
    ends = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}.get(name, ())
    passed = ("p", "td", "th") if name == "tr" else ("p",)
    place = 0
    for k in range(len(open_blocks) - 1, 0, -1):
        at = open_blocks[k]
        if stack[at].name in ends:
            return at
        if stack[at].name == "p":
            place = at
        if stack[at].name not in passed or not ends:
            return place
    return place


def _element(parent: Element, name: str, attributes: str, marks: int) -> tuple[Element, bool]:
    """A new element, and whether its class, id or role marks it as something else than main text."""
    found = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _MARK.finditer(attributes)] if attributes else []
    named = " ".join(sorted(v for k, v in found if k == "class"))
    words = {w.lower() for _, v in found for w in _WORD.findall(v)}
    deep = parent.path.count("/") >= 60
    marked = bool(words & APART_WORDS) and name not in ("html", "body", *CENTRE) and not deep
    # the heading of an article may stand in its own header
    inside = any(part.split(".")[0] in CENTRE for part in parent.path.split("/"))
    apart = name in APART and not (name == "header" and inside and not marked)
    step = f"{name}.{named if len(named) < 100 else xxhash.xxh64_hexdigest(named)}" if named else name
    path = parent.path if deep else f"{parent.path}/{step}"
    return Element(name, path, parent.apart or apart, parent.marked + (marks,) if marked else parent.marked), marked


def _token(path: str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text}") - (1 << 63)


_STATS = "host string, token long, vector long, pages long, path string, is_block boolean, apart boolean, chars long, place double"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host and token of a batch: its part of the occurrence vector, as an order-free digest."""
    for batch in batches:
        seen: dict = {}
        for host, key, page in zip(batch.column("host").to_pylist(), batch.column("key").to_pylist(), batch.column("html"), strict=True):
            blocks, paths = parse(page.as_py())
            counts: dict = {}
            for place, path in enumerate(paths):
                counts.setdefault(_token(path), [0, path, False, False, 0, place / len(paths)])[0] += 1
            for place, block in enumerate(blocks):
                entry = counts.setdefault(_token(block.path, block.text), [0, block.path, True, block.apart, 0, place / len(blocks)])
                entry[0] += 1
                entry[4] += len(block.text) - min(block.linked, len(block.text))
            for token, (n, path, is_block, apart, chars, place) in counts.items():
                entry = seen.setdefault((host, token), [0, 0, path, is_block, apart, 0, 0.0])
                entry[0] ^= xxhash.xxh64_intdigest(f"{key}:{n}") - (1 << 63)
                entry[1] += 1
                entry[5] += chars
                entry[6] += place
        if seen:
            rows = [(host, token, *entry) for (host, token), entry in seen.items()]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _STATS.split(", ")])


def main_region(masses: dict[str, int]) -> str:
    """The path of the element that holds the main text, from the characters of text in slots by path.

    An article or main element with text wins; else it is the deepest element with
    MAIN_SHARE of all text.
    """
    total = sum(masses.values())
    if not total:
        return ""
    under: dict[str, int] = {}
    for path, chars in masses.items():
        steps = path.split("/")
        for i in range(2, len(steps) + 1):
            prefix = "/".join(steps[:i])
            under[prefix] = under.get(prefix, 0) + chars
    centre = [p for p in under if p.rsplit("/", 1)[-1].split(".")[0] in CENTRE and under[p] > 0]
    if centre:
        # the outermost one with the most text
        return max(centre, key=lambda p: (under[p], -p.count("/"), p))
    wide = [p for p in under if under[p] >= MAIN_SHARE * total and p.rsplit("/", 1)[-1].split(".")[0] not in PARTS]
    return max(wide, key=lambda p: (p.count("/"), under[p], p), default="")


class Template(NamedTuple):
    """A class of tokens: one of them to know its pages by, its fixed blocks, the text in its slots by path."""

    marker: int
    pages: int
    fixed: frozenset[int]
    region: str


def _inside(path: str, top: str) -> bool:
    return path == top or path.startswith(top + "/")


def extract(page: str, templates: list[Template], everywhere: frozenset[int]) -> str:
    """The main text: blocks in the region's slots, without what stands apart or is fixed.

    `templates` are those of the page's host, of which the page has those whose marker it has; of those that hold
    most of the page's text the one with the fewest pages tells the region. `everywhere` are blocks of nearly all pages.
    """
    blocks, paths = parse(page)
    tokens = {_token(path) for path in paths}
    carried = sorted((t for t in templates if t.marker in tokens), key=lambda t: (t.pages, t.marker))
    open_blocks = [(b, _token(b.path, b.text)) for b in blocks if not b.apart]
    fixed = everywhere.union(*(t.fixed for t in carried))
    slots = [(b, token) for b, token in open_blocks if token not in fixed]
    total = sum(len(b.text) for b, _ in slots)
    held = [(sum(len(b.text) for b, _ in slots if _inside(b.path, t.region)), t.region) for t in carried if t.region]
    # the first that holds most of the page's text in slots, else the one that holds most
    region = next((r for n, r in held if n >= MAIN_SHARE * total), max(held, key=lambda x: x[0], default=(0, ""))[1])
    if not total or not region:  # no template, or another layout than the host's
        region = main_region(_masses(b for b, _ in slots or open_blocks))
    here = [(b, token) for b, token in open_blocks if _inside(b.path, region) or not region]
    # blocks that are fixed only in a class of pages may be what these pages have in common as copies
    for known in (fixed, everywhere):
        chosen = [b.text for b, token in here if token not in known]
        if sum(map(len, chosen)) >= (1 - FIXED_SHARE) * sum(len(b.text) for b, _ in here):
            return "\n".join(chosen)
    return "\n".join(chosen or [b.text for b, _ in here])


def _masses(blocks) -> dict[str, int]:
    masses: dict[str, int] = {}
    for b in blocks:
        masses[b.path] = masses.get(b.path, 0) + max(len(b.text) - b.linked, 0)
    return masses


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts: dict = {}
        out = []
        for host, page, templates, fixed in zip(
            batch.column("host").to_pylist(), batch.column("html"), batch.column("templates"), batch.column("everywhere"), strict=True
        ):
            if host not in hosts:
                known = [
                    Template(t["marker"], t["pages"], frozenset(t["fixed"] or ()), main_region({m["path"]: m["chars"] for m in t["masses"] or ()}))
                    for t in templates.as_py() or ()
                ]
                hosts[host] = known, frozenset(fixed.as_py() or ())
            out.append(extract(page.as_py(), *hosts[host]))
        text = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text, pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])


#: SQL: a path and all paths above it.
_ABOVE = "transform(sequence(2, size(split(path, '/'))), n -> array_join(slice(split(path, '/'), 1, n), '/'))"


def deduced_templates(tokens: DataFrame) -> DataFrame:
    """(host, marker, pages, fixed, masses) of every valid class, from the tokens of all hosts.

    Classes with fewer than LEAST_PAGES pages leave before they are collected. A class is valid if
    one of its elements encloses text in slots: blocks that no class of so many pages has.
    """
    often = tokens.where(F.col("pages") >= LEAST_PAGES)
    classes = often.groupBy("host", "vector", "pages").agg(
        F.collect_list(F.when(F.col("is_block") & ~F.col("apart"), F.col("token"))).alias("fixed"),
        F.array_sort(F.collect_list(F.when(~F.col("is_block"), F.struct("place", "path", "token")))).alias("elements"),
    ).where("size(elements) > 0")
    # the first element on the page stands for all: they are on the same pages
    classes = written(classes.select("host", "pages", F.element_at("elements", 1)["token"].alias("marker"), "fixed", "elements"), "classes")
    slots = tokens.where("is_block and not apart").where(F.col("pages") < LEAST_PAGES).groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    slots = slots.select("host", "path", "chars", F.explode(F.expr(_ABOVE)).alias("above"))
    structure = classes.select("host", "marker", F.explode("elements").alias("e")).select("host", "marker", F.col("e.path").alias("above"))
    held = slots.join(structure, ["host", "above"]).select("host", "marker", "path", "chars").distinct()
    masses = held.groupBy("host", "marker").agg(F.array_sort(F.collect_list(F.struct("path", "chars"))).alias("masses"))
    return classes.drop("elements").join(masses, ["host", "marker"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Tokens of a host whose occurrence vectors over its pages are equal form a class; the vector is a
    digest that is added up in any order, so a host's pages never meet in one task. Classes with enough pages
    whose elements enclose slots are the host's templates (see `deduced_templates`). A page has the templates whose
    tokens it has: their text blocks are fixed, and the main region is the element whose slots hold the text. All
    blocks of the region are kept but fixed ones and those that stand apart by element (menus, headers, footers,
    sidebars, forms). A class name that tells such a thing (notices, adverts, comments) decides only for elements that
    do not enclose the main text.

    A page without template is judged on its own slots; where fixed blocks are most of a region, pages are copies,
    and the blocks are kept. Of regions with equal text the outermost, then the last by path, is taken. Null and
    empty pages have an empty text; a null URL counts as a host of its own; repeated rows are repeated
    results. Of other columns none is read. Very long and hostile pages (tags that never end, very deep nesting)
    take time in proportion to their length; paths are told apart down to depth 60.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    base = pages.select("page_id", "url", F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = base.select("host", F.monotonically_increasing_id().alias("key"), "html")
    tokens = keyed.mapInArrow(_occurrences, _STATS).groupBy("host", "token").agg(
        F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.min("path").alias("path"),
        F.first("is_block").alias("is_block"), F.bool_and("apart").alias("apart"), F.sum("chars").alias("chars"), (F.sum("place") / F.sum("pages")).alias("place"),
    )
    tokens = written(tokens, "tokens")
    sizes = base.groupBy("host").agg(F.count("*").alias("all_pages"))
    common = tokens.where(F.col("is_block") & ~F.col("apart") & (F.col("pages") >= SHARE * MANY_PAGES)).join(sizes, "host")
    common = common.where((F.col("pages") >= SHARE * F.col("all_pages")) & (F.col("all_pages") >= MANY_PAGES))
    everywhere = common.groupBy("host").agg(F.collect_list("token").alias("everywhere"))
    templates = deduced_templates(tokens).groupBy("host").agg(F.collect_list(F.struct("marker", "pages", "fixed", "masses")).alias("templates"))
    # a table of its own: Spark sees its size, and splits hot hosts if it is too large to be broadcast
    plan = written(templates.join(everywhere, "host", "full").select("host", "templates", "everywhere"), "templates")
    return base.join(plan, "host", "left").select("page_id", "url", "host", "html", "templates", "everywhere").mapInArrow(
        _extract, T.StructType([*base.select("page_id", "url").schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    )
