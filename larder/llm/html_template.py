"""Main text of web pages by template deduction from equivalence classes.

Every page becomes a row of tokens: tags with their path, and the texts of its
blocks. Pages of a host with their article in the same region are one layout. Over the
pages of a layout, and of the whole host, a token has an occurrence vector, how often
it occurs on each page. Tokens with the same vector form an equivalence class if they
are on enough pages of different content.

Pages are parsed once; what follows reads their tokens and blocks.

A second look at every page checks the classes. A class is valid if its tokens come in
one order on all pages and if it lies in the same slot, between the same two tokens, of
the class around it. A class that is not falls apart into the tokens of each region, and
these into single ones, which are held to the same rules. The valid classes nest and are
the template; what is left between their tokens are slots, and the main text is the
slots of the region that holds the article. Marked articles are a sign for that region.

Occurrence vectors never travel: each page adds a hash of its identity and count, so
equal sums are equal vectors, and a host's pages meet only in partial aggregates.
"""

from __future__ import annotations

import html as entities
import pickle
import re
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import by_batches, col, stored

#: Fixed values of HTML: elements without content, with raw text, and that begin a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: An open element of the first kind ends where one of the second begins.
CLOSES = {
    "p": BLOCK - {"html", "body"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option", "optgroup"},
    "head": {"body"},
}
#: Elements that never hold the article's text.
SIDE = set(
    "nav footer aside script style noscript template iframe svg math canvas object embed video "
    "audio button select option textarea input menu dialog head map datalist title".split()
)
SIDE_ROLES = set("navigation banner contentinfo complementary search menu menubar dialog alert".split())
#: Words in one class or id name of regions beside the article.
SIDE_NAME = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|"
    r"footer|foot|masthead|topbar|toolbar|sidebar\w*|side|widget\w*|rail|related|recommend\w*|"
    r"share|sharing|social|comments?|commentlist|disqus|respon[ds]e?s?|replies|cookies?|consent|gdpr|"
    r"notice|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search\w*|"
    r"pagination|pager|skip|hidden)(?:$|[_-])",
    re.I,
)
#: Parts of a name that say what a region has or is like, not what it is.
MODIFIER = re.compile(
    r"(?:^|[_-])(?:has|have|no|not|non|with|without|is|are|can|js|open|opened|closed?|on|off|enabled?|disabled?|"
    r"active|inactive|visible|allowed|loaded|ready)(?:$|[_-])",
    re.I,
)
#: A region beside the article by its name only, or a form, is none with this share of the page's text or more.
NAMED_SHARE, FORM_SHARE = 0.9, 0.5
MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main)[_-]?(?:body|content|text)(?:$|[\s_-])", re.I)

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+))")


#: Paths of blocks of prose, and of headings among them.
PROSE = re.compile(r"/(?:p|h[1-6]|blockquote|pre)(?:\.[^/]*)?$")
HEADING = re.compile(r"/h[1-6](?:\.[^/]*)?$")


@dataclass
class Region:
    """An open element: its place in the page's tree and what it says of its content.

    ``side`` is certain, by elements, roles and hidden attributes. ``weak`` has number
    and depth of the open regions that are beside the article by name only or as forms;
    ``inner`` of them, the last ones, lie inside the innermost marked element. ``top`` is
    the depth of the outermost one.
    """

    tag: str
    path: str
    side: bool
    main: bool
    weak: tuple[tuple[int, int], ...] = ()
    inner: int = 0
    article: int = 0
    top: int = 0


@dataclass
class Block:
    """A run of text between block borders."""

    path: str
    text: str
    side: bool
    main: bool
    linked: int
    regions: tuple[str, ...]
    weak: tuple[tuple[int, int], ...] = ()
    inner: int = 0
    article: int = 0
    certain: bool = False
    top: int = 0
    number: int = 0

    @property
    def own(self) -> int:
        """The length of a text that is not mostly links."""
        return len(self.text) if 2 * self.linked < len(self.text) else 0

    @property
    def content(self) -> bool:
        """Whether it can be an article's: prose may be a link as a whole, lists of links may not."""
        return self.own > 0 or bool(PROSE.search(self.path))


@dataclass
class Page:
    """A page's tokens in order (number, the region's number, a path token's path) and its blocks."""

    tokens: list[tuple[int, int, str | None]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


    def packed(self) -> bytes:
        """The page as bytes, for tables that this module writes and reads."""
        blocks = [tuple(getattr(b, name) for name in FIELDS) for b in self.blocks]
        return pickle.dumps((self.tokens, blocks), protocol=5)

    @classmethod
    def unpacked(cls, data: bytes) -> Page:
        tokens, blocks = pickle.loads(data)
        return cls(tokens, [Block(*values) for values in blocks])


#: The fields of a block, in order.
FIELDS = list(Block.__dataclass_fields__)


def number_of(token: str) -> int:
    """A token's number, of 63 bits."""
    return xxhash.xxh64_intdigest(token) >> 1


@lru_cache(1 << 14)
def path_number(path: str) -> int:
    """The number of a path token; paths repeat."""
    return number_of(path)


@lru_cache(1 << 12)
def beside(names: str) -> bool:
    """Whether a class or id is that of a region beside the article, name by name."""
    return any(SIDE_NAME.search(name) and not MODIFIER.search(name) for name in names.split())


def settle(blocks: list[Block], shares: list[float]) -> None:
    """Decide by the page's texts which regions of uncertain kind are beside the article.

    One that holds its share of the page's text is a wrapper. What is marked as article
    inside such a region counts where the page has no article outside of them: with
    one, marked elements inside are comments or teasers.
    """
    open_ = [b for b in blocks if not b.side]
    total, held = sum(b.own for b in open_), [0] * len(shares)
    for block in open_:
        for number, _ in block.weak:
            held[number] += block.own
    for block in open_:
        last = block.weak[len(block.weak) - block.inner :]
        block.weak = tuple(w for w in block.weak if held[w[0]] < max(shares[w[0]] * total, 1))
        block.inner = sum(w in block.weak for w in last)
        block.side = bool(block.weak)
    marked = [b for b in open_ if b.main and not b.side]
    inside = [b for b in open_ if b.main and b.side and not b.inner]
    if not inside or any(b.article for b in marked):
        return
    one = len({b.article for b in inside}) == 1
    if not marked or (one and sum(b.own for b in inside) > sum(b.own for b in marked)):
        for block in inside:
            block.side = False


def parse(source: str | None) -> Page:
    """Tags and blocks of a page; broken markup is read as browsers mostly do."""
    page = Page()
    text = source or ""
    stack: list[Region] = [Region("", "", False, False)]
    piece: list[str] = []
    shares: list[float] = []
    linked, links, articles = 0, 0, 0
    n, at = len(text), 0

    def flush() -> None:
        nonlocal linked
        words = " ".join(entities.unescape("".join(piece)).split()) if piece else ""
        if words:
            top = stack[-1]
            regions = tuple(r.path for r in stack[1:])
            number = number_of(f"{top.path}#{xxhash.xxh64_hexdigest(words)}")
            signs = (top.weak, top.inner, top.article, top.side, top.top, number)
            block = Block(top.path, words, top.side, top.main, linked, regions, *signs)
            page.tokens.append((number, path_number(top.path), None))
            page.blocks.append(block)
        piece.clear()
        linked = 0

    while at < n:
        lt = text.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            piece.append(text[at:lt])
            linked += lt - at if links else 0
            at = lt
            continue
        if text.startswith("<!--", at):
            end = text.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        if text.startswith(("<!", "<?"), at):
            end = text.find(">", at)
            at = n if end < 0 else end + 1
            continue
        found = TAG.match(text, at)
        if not found:
            if re.match(r"</?[a-zA-Z]", text[at : at + 3]):
                end = text.find(">", at)
                if end < 0:
                    break  # the page ends inside a tag
                at = end + 1
                continue
            piece.append("<")
            at += 1
            continue
        at = found.end()
        closing, tag, rest = found[1] == "/", found[2].lower(), found[3]
        if tag in BLOCK:
            flush()
        elif tag == "br":
            piece.append("\n")
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if tag not in BLOCK and any(r.tag in BLOCK for r in stack[depth + 1 :]):
                        break  # an inline end tag does not close blocks
                    links -= sum(r.tag == "a" for r in stack[depth:])
                    del stack[depth:]
                    break
            continue
        while len(stack) > 1:
            open_ = next((r for r in reversed(stack) if r.tag in BLOCK or r.tag == "head"), None)
            if open_ is None or tag not in CLOSES.get(open_.tag, ()):
                break
            depth = max(i for i, r in enumerate(stack) if r is open_)
            links -= sum(r.tag == "a" for r in stack[depth:])
            del stack[depth:]
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)} if "=" in rest else {}
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
        names = re.sub(r"\d+", "0", names)
        path = f"{stack[-1].path}/{tag}" + (f".{names}" if names else "")
        page.tokens.append((path_number(path), path_number(stack[-1].path), path))
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(text, at)
            at = n if end is None else end.start()
            close = text.find(">", at)
            at = n if close < 0 else close + 1
            continue
        role = attributes.get("role", "").lower()
        above = stack[-1]
        marks = tag == "article" or role == "article" or bool(MAIN_NAMES.search(names))
        starts = marks or tag == "main" or role == "main"
        main = above.main or starts
        side = above.side or tag in SIDE or role in SIDE_ROLES
        if "hidden" in rest.lower():
            bare = ATTRIBUTE.sub(" ", rest).lower().replace("/", " ").split()
            side = side or "hidden" in attributes or "hidden" in bare
        side = side or (tag == "header" and not main)
        weak, inner = above.weak, 0 if starts else above.inner
        if tag in ("article", "main", "body", "html"):
            side = above.side
        elif tag == "form" or role == "form" or beside(names):
            weak = (*weak, (len(shares), len(stack) - 1))
            inner += main
            shares.append(NAMED_SHARE if beside(names) else FORM_SHARE)
        articles += marks
        article = articles if marks else above.article
        top = above.top or (len(stack) if starts else 0)
        stack.append(Region(tag, path, side, main, weak, inner, article, top))
        links += tag == "a"
    flush()
    settle(page.blocks, shares)
    return page


def host_of(url: str | None) -> str:
    """The host in lower case, without user and port; empty if there is none."""
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


#: Elements that can be the region of an article as a whole.
HOLDER = re.compile(r"/(?:div|section|article|main|td|body|html)[^/#]*$")
#: The layout that stands for all pages of a host; layouts by a mark begin with the sign.
ALL, MARKED = "*", "="


def layout_of(page: Page) -> str:
    """Where the page has its article: its mark, else the deepest region with most of the text."""
    marked = next((b for b in page.blocks if b.main and not b.side), None)
    if marked:
        return MARKED + marked.regions[marked.top - 1]
    held: dict[str, int] = {}
    total = 0
    for block in page.blocks:
        if not block.side:
            total += block.own
            for path in set(block.regions):
                held[path] = held.get(path, 0) + block.own
    most = [p for p, n in held.items() if n and 10 * n >= 7 * total and HOLDER.search(p)]
    return max(most, key=lambda p: (p.count("/"), p), default="")


def extract(page: Page, template: set[int], main_path: str | None) -> str:
    """The page's slots in the region of the article, one line for each block.

    That region is what the page itself marks as article, unless the template of its
    layout gives another one, else the region of the template, else the whole page.
    Texts of the template are no slots wherever they are. Beside the region nothing
    counts, and outside a marked article blocks of links are not content. The names of
    regions around the template's one do not matter.
    """

    def freed(b: Block) -> bool:
        """In the template's region, with uncertain regions only around it."""
        if b.certain or main_path not in b.regions:
            return False
        return all(depth <= b.regions.index(main_path) for _, depth in b.weak)

    blocks = [b for b in page.blocks if not b.side or freed(b)]
    marked = any(b.main and not b.side for b in blocks)
    slots = [b for i, b in enumerate(blocks) if b.number not in template or heads(blocks, i, template)]
    inside = [b for b in slots if b.content and main_path in b.regions]
    found = any(b.own for b in inside)
    if marked and (not found or main_path is None or layout_of(page) == MARKED + main_path):
        return "\n".join(b.text for b in slots if b.main and not b.side)
    return "\n".join(b.text for b in (inside if found else [b for b in slots if b.content]))


def heads(blocks: list[Block], at: int, template: set[int]) -> bool:
    """Whether a text of the template is the heading, in the same region, of one that is not.

    Articles of a host often have the same headings; what they head is the article's.
    """
    if not HEADING.search(blocks[at].path):
        return False
    for block in blocks[at + 1 :]:
        if block.regions[:-1] != blocks[at].regions[:-1]:
            return False
        if not HEADING.search(block.path):
            return block.number not in template
    return False


def parsed(pages: DataFrame, key: str, url: str, source: str) -> DataFrame:
    """Every page once: ``key``, ``url``, ``host``, ``layout``, ``identity`` and the page as bytes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for address, content in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            page = parse(content)
            identity = xxhash.xxh64_intdigest(f"{address}\0{content}") >> 1
            rows.append((host_of(address), layout_of(page), identity, page.packed()))
        columns = list(zip(*rows, strict=True))
        types = [pa.string(), pa.string(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)

    names = ["key", "url", "host", "layout", "identity", "page"]
    slim = pages.select(
        col(key).alias("key"), col(url).cast("string").alias("url"), col(source).cast("string").alias("html")
    )
    kind = slim.schema["key"].dataType.simpleString()
    shape = f"key {kind}, url string, host string, layout string, identity long, page binary"
    return stored(slim.mapInArrow(by_batches(work, 128), shape), "pages")


TOKENS = "host string, layout string, path string, number long, up long, rest long, page_hash long, n long, slot long"


def occurrences(pages: DataFrame) -> DataFrame:
    """One row for each distinct token of a page: its host, layout, count and text weight.

    Texts have a number and no ``path``. ``rest`` is the page's longest text besides the
    token's own; copies of a page and pages that share their article have it in common.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for host, layout, identity, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = Page.unpacked(data)
            counts: dict[int, list] = {}
            for number, above, path in page.tokens:
                known = counts.get(number)
                if known is None:
                    counts[number] = [1, 0, above, path]
                else:
                    known[0] += 1
            for block in page.blocks:
                if not block.side and block.own:
                    for path in block.regions:
                        counts[path_number(path)][1] += len(block.text)
            open_ = [b for b in page.blocks if not b.side] or page.blocks
            texts = sorted({b.text for b in open_}, key=lambda t: (len(t), t))[-2:]
            rests = [number_of(t) for t in reversed(texts)] + [0, 0]
            longest = {b.number for b in page.blocks if b.text == texts[-1]}
            for number, (n, slot, up, path) in counts.items():
                mark = xxhash.xxh64_intdigest(f"{identity} {n}") >> 16
                rows.append((host, layout, path, number, up, rests[number in longest], mark, n, slot))
        columns = list(zip(*rows, strict=True)) or [()] * 9
        types = [pa.string()] * 3 + [pa.int64()] * 6
        names = [part.split()[0] for part in TOKENS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return pages.select("host", "layout", "identity", "page").mapInArrow(by_batches(work, 128), TOKENS)


#: Bits of each of the two sketches that tell how many different contents a token is with.
SKETCH = 128


def sketch_bits(i: int) -> Column:
    """A quarter of the two sketches of ``rest``, each with bits of its own."""
    place = f"(shiftright(rest, {7 * (i // 2)}) & 127)"
    return F.expr(f"if(shiftright({place}, 6) = {i % 2}, shiftleft(1L, cast({place} & 63 as int)), 0L)")


def equivalence_classes(pages: DataFrame, least_pages: int, least_share: float) -> DataFrame:
    """The tokens of candidate classes: ``host``, ``layout``, ``class`` and ``part``.

    A token's vector is summed up by its pages, its total and the sum of its page
    hashes; a class is the tokens of a layout with one vector, a part those of them in
    one region. A token counts if it is on ``least_pages`` pages and the share
    ``least_share`` of the layout's, and if these are no copies: two sketches of the
    longest other texts must show as many contents as pages are asked for, and half the
    share of the contents that the layout shows.
    """
    seen = occurrences(pages)
    for i in range(4):
        seen = seen.withColumn(f"bits{i}", sketch_bits(i))
    seen = seen.withColumn("low", F.col("page_hash").bitwiseAND(F.lit((1 << 24) - 1)))
    seen = seen.withColumn("high", F.shiftright("page_hash", 24))
    sums = ["total", "low", "high", "slot"]
    merged = [F.max("path").alias("path"), F.max("up").alias("up")]
    merged += [F.bit_or(f"bits{i}").alias(f"bits{i}") for i in range(4)]
    by_layout = seen.withColumnRenamed("n", "total").groupBy("host", "layout", "number").agg(
        F.count(F.lit(1)).alias("pages"), *[F.sum(c).alias(c) for c in sums], *merged
    )
    by_layout = stored(by_layout, "layouts")
    by_host = by_layout.groupBy("host", "number").agg(*[F.sum(c).alias(c) for c in ["pages", *sums]], *merged)
    both = by_layout.unionByName(by_host.withColumn("layout", F.lit(ALL)))
    ones = [F.bit_count(f"bits{i}") for i in range(4)]
    tokens = both.withColumn("contents", F.greatest(ones[0] + ones[1], ones[2] + ones[3]))
    # What is on too few pages is a slot on any host that can have a template; most texts are.
    tokens = stored(tokens.where((F.col("pages") >= least_pages) & (F.col("contents") >= least_pages)), "tokens")
    tokens = tokens.withColumn("spread", -F.log(1 - F.least("contents", F.lit(SKETCH - 1)) / F.lit(SKETCH)))
    sizes = tokens.groupBy("host", "layout").agg(
        *[F.max(c).alias(f"all_{c}") for c in ("pages", "spread")],
        F.max(F.when(F.col("path").isNotNull(), F.col("slot"))).alias("all_slot"),
    )
    frequent = tokens.join(stored(sizes, "hosts"), ["host", "layout"])
    frequent = frequent.where(F.col("pages") >= least_share * F.col("all_pages"))
    frequent = frequent.where(F.col("spread") >= least_share / 2 * F.col("all_spread"))
    one = F.xxhash64("pages", "total", "low", "high")
    return frequent.select(
        "host", "layout", "path", "number", "slot", "all_slot", one.alias("class"), F.xxhash64(one, "up").alias("part")
    )


def units(page: Page, known: dict[int, tuple[int, int]], sizes: dict[int, int]) -> dict[int, int]:
    """For each class, part and token on the page a number of its order and its slot.

    ``known`` has class and part of each token and ``sizes`` how many tokens they have. The
    number is below zero where the tokens do not come in one order, round by round, or
    a token of the class around them comes in between.
    """
    rows: dict[int, list[int]] = {}
    around: dict[int, list[tuple[int, int]]] = {}
    above: dict[int, int] = {}
    for number, up, _ in page.tokens:
        above[number] = up
        if number not in known:
            continue
        kind, part = known[number]
        region = above[number]
        while region in above and known.get(region, (kind,))[0] == kind:
            region = above[region]
        holder = known[region][0] if region in known else 0
        slot = (holder, len(rows.get(holder, ())) % sizes.get(holder, 1))
        for unit in (kind, part, number):
            rows.setdefault(unit, []).append(number)
            around.setdefault(unit, []).append(slot)
    got = {}
    for unit, row in rows.items():
        size = sizes[unit]
        first = row[:size]
        whole = len(set(first)) == size and row == first * (len(row) // size)
        # Parts and classes are whole only within one slot; each of their rounds is.
        slots = set(around[unit])
        got[unit] = number_of(f"{first} {slots.pop()}") if whole and len(slots) == 1 else -1
    return got


def read_layouts(rows: list[dict]) -> tuple[dict[str, dict[int, tuple[int, int]]], dict[str, dict[int, int]]]:
    """By layout the class and part of each token, and the sizes of classes, parts and tokens."""
    known: dict[str, dict[int, tuple[int, int]]] = {}
    sizes: dict[str, dict[int, int]] = {}
    for row in rows:
        known.setdefault(row["layout"], {})[row["number"]] = (row["class"], row["part"])
        size = sizes.setdefault(row["layout"], {})
        for unit in (row["class"], row["part"]):
            size[unit] = size.get(unit, 0) + 1
        size[row["number"]] = 1
    return known, sizes


def with_host(pages: DataFrame, table: DataFrame, weight: Column, broadcast_bytes: int) -> DataFrame:
    """The pages with their host's row, sent to them if the rows have few bytes, else joined."""
    size = table.agg(F.sum(weight + F.length("host") + 64)).first()[0] or 0
    return pages.join(F.broadcast(table) if size <= broadcast_bytes else table, "host", "left")


def valid_tokens(pages: DataFrame, tokens: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The tokens of classes, parts of classes, or single ones, that are valid on all pages."""
    shown = F.struct("layout", "number", "class", "part")
    by_host = stored(tokens.groupBy("host").agg(F.collect_list(shown).alias("tokens")), "classes")
    joined = with_host(pages, by_host, F.size("tokens") * 64, broadcast_bytes).where("tokens is not null")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[str, tuple] = {}
        got: dict[tuple[str, str, int], tuple[int, int]] = {}
        rows = zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)
        for i, (host, own, data) in enumerate(rows):
            if host not in known:
                known[host] = read_layouts(batch.column(3)[i].as_py())
            page = Page.unpacked(data)
            tokens, sizes = known[host]
            made, of = {}, None
            for layout in (own, ALL):
                if layout in tokens:
                    if of is None or tokens[layout] != tokens[of]:
                        made, of = units(page, tokens[layout], sizes[layout]), layout
                    for unit, value in made.items():
                        least, most = got.get((host, layout, unit), (value, value))
                        got[host, layout, unit] = (min(least, value), max(most, value))
        rows = [(*key, *ends) for key, ends in got.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["host", "layout", "unit", "least", "most"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    shape = "host string, layout string, unit long, least long, most long"
    checked = joined.select("host", "layout", "page", "tokens").mapInArrow(by_batches(work, 128), shape)
    checked = checked.groupBy("host", "layout", "unit").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    valid = checked.where("least >= 0 and least = most").select("host", "layout", "unit")
    units_of = tokens.withColumn("unit", F.explode(F.array_distinct(F.array("class", "part", "number"))))
    return units_of.join(valid, ["host", "layout", "unit"], "left_semi").drop("unit").distinct()


def templates(pages: DataFrame, least_pages: int, least_share: float, broadcast_bytes: int) -> DataFrame:
    """One row for each host: by layout the text tokens of its template, and the article's region.

    The region is the layout's mark if that has a fifth of the unlinked text outside
    side regions, else the deepest holding element of the template that has most of it.
    """
    tokens = stored(equivalence_classes(pages, least_pages, least_share), "candidates")
    nested = valid_tokens(pages, tokens, broadcast_bytes)
    mark = (F.concat(F.lit(MARKED), "path") == F.col("layout")) & (F.col("slot") * 5 >= F.col("all_slot"))
    holds = (F.col("slot") * 10 >= F.col("all_slot") * 7) & F.col("path").rlike(HOLDER.pattern)
    holds = (mark | holds) & (F.col("slot") > 0)
    depth = F.size(F.split("path", "/"))
    by_layout = nested.groupBy("host", "layout").agg(
        F.collect_set(F.when(F.col("path").isNull(), F.col("number"))).alias("texts"),
        F.max_by("path", F.when(holds, F.struct(mark, depth, F.col("slot"), F.col("path")))).alias("region"),
    )
    return by_layout.groupBy("host").agg(F.collect_list(F.struct("layout", "texts", "region")).alias("layouts"))


def main_text(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    source: str = "html",
    least_pages: int = 3,
    least_share: float = 0.5,
    broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """``key``, ``url``, ``text``, ``n_chars`` (code points) and ``host`` of every page.

    Templates go to the pages by broadcast if they take ``broadcast_bytes`` at most,
    measured first, and otherwise by a join on the host that adaptive execution may
    split. Pages are parsed whole.

    NULL and empty pages have an empty text. Pages without a host share the host of
    empty name; pages of hosts with too few pages have no template but their own
    tags. Repeated pages stay repeated, NULL keys stay NULL, an empty table gives an
    empty result, and other columns are not read, whatever their names.
    """
    pages = parsed(pages, key, url, source)
    made = stored(templates(pages, least_pages, least_share, broadcast_bytes), "templates")
    weight = F.aggregate(
        "layouts",
        F.lit(0).cast("long"),
        lambda a, t: a + F.size(t["texts"]) * 8 + F.length(t["layout"]) + F.length(F.coalesce(t["region"], F.lit(""))),
    )
    joined = with_host(pages, made, weight, broadcast_bytes)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = {name: batch.column(name) for name in ("key", "url", "host")}
        known: dict[str, dict[str, tuple[set[int], str | None]]] = {}
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("host", "layout", "page")), strict=True)
        for i, (name, layout, data) in enumerate(rows):
            if name not in known:
                own = batch.column("layouts")[i].as_py() or ()
                known[name] = {r["layout"]: (set(r["texts"]), r["region"]) for r in own}
            page, host = Page.unpacked(data), known[name]
            texts, region = host.get(layout, (set(), None))
            others, region_of_all = host.get(ALL, (set(), None))
            if region is None and not layout.startswith(MARKED):
                region = region_of_all
            out.append(extract(page, texts | others, region))
        sizes = pa.array([len(t) for t in out], pa.int64())
        arrays = [keep["key"], keep["url"], pa.array(out, pa.string()), sizes, keep["host"]]
        return pa.RecordBatch.from_arrays(arrays, ["key", "url", "text", "n_chars", "host"])

    kind = pages.schema["key"].dataType.simpleString()
    shape = f"key {kind}, url string, text string, n_chars long, host string"
    got = joined.select("key", "url", "host", "layout", "page", "layouts").mapInArrow(by_batches(work, 128), shape)
    return got.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars", "host")
