"""Main text of web pages by deducing a template from pages of one host.

Tokens are opening tags with the tags around them (their path) and text blocks with their path. Tokens that occur
equally often on every page of a host have the same occurrence vector and form an equivalence class. A text is part of
the template if a tag of its class stands around it: the class is nested. Such blocks go on every page, inside of
articles as well; what is left are the slots. Names of tags and classes then choose among the slots: the text of a page
is what stands in those of its article, or without an article in all that do not lead through menus, notices and the like.
"""

from __future__ import annotations

import bisect
import html as entities
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import known, shared_dir, sized, stored

# fixed values: elements of HTML by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
HIDDEN = frozenset("script style template noscript head title iframe object svg math canvas select option datalist textarea".split())
#: Elements that stand around the article.
AROUND = frozenset("nav footer aside form menu dialog button header".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr img".split())
#: Elements that end an open paragraph.
BLOCK = frozenset(
    "address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " main menu nav ol p pre section table ul".split())
#: Closed by another one of its kind.
SIBLING = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Class names, ids and roles of what is not the article, as whole names or joined with each other and with ``STRUCTURE``.
MARKS = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|"
    r"comments?|disqus|replies|reply|respond|reviews?|sidebar|side|nav|navbar|navigation|menu|breadcrumbs?|topbar|toolbar|masthead|"
    r"footer|copyright|legal|share|sharing|social|related|recommend\w*|trending|popular|widget|login|signup|search|pagination|pager|tags?|hidden|"
    r"complementary|contentinfo", re.I)
STRUCTURE = re.compile(
    r"site|main|bar|box|block|list|items?|area|container|wrap|wrapper|inner|outer|section|links?|buttons?|icons?|posts?|articles?|stories|"
    r"slot|unit|top|bottom|form|cloud|message|\d+", re.I)
#: The header of the site; that of an article or a section is part of it.
HEADER = re.compile(r"(?:site|top)?[-_]?header", re.I)


def is_mark(hints: str) -> bool:
    """Whether one of the names says that an element is not the article; ``tag-x`` or ``with-sidebar`` do not."""
    for name in hints.split():
        parts = [x for x in re.split("[-_]+", name) if x]
        marks = [MARKS.fullmatch(x) is not None for x in parts]
        if HEADER.fullmatch(name) or any(marks) and all(m or STRUCTURE.fullmatch(x) for m, x in zip(marks, parts, strict=True)):
            return True
    return False


#: Elements nested deeper stand beside each other, as browsers do it.
DEPTH = 512
#: A tag's name, and what follows up to its end; quoted values may hold a >.
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>")
_UPTO = re.compile(r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_START = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "select")}
_DIGITS = re.compile(r"\d+")


class Scanner:
    """Tags of a page from left to right, in time linear in the page.

    ``next(at)`` is ``(start, end, name, closing, attributes)`` of the first token from ``at``, without a name for comments,
    declarations and tags whose quotes do not end; none if there is no other one.
    """

    def __init__(self, page: str):
        self.page = page
        #: Tags whose rest was read in vain, to a quote that does not end or the page's end: from, to, and their quoted values.
        self.failed: list[tuple[int, int, list[int], list[int]]] = []

    def next(self, at: int) -> tuple[int, int, str | None, bool, str] | None:
        page = self.page
        start = page.find("<", at)
        gt = page.find(">", start) if start >= 0 else -1
        while start >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, (end + 3 if end >= 0 else len(page)), None, False, ""
            if gt < 0:
                # only a comment can still begin
                start = page.find("<!--", start + 1)
                continue
            if gt < start:
                gt = page.find(">", start)
                continue
            if page[start + 1:start + 2] in ("!", "?"):
                return start, gt + 1, None, False, ""
            m = _NAME.match(page, start)
            if m:
                rest = None if self._hopeless(m.end()) else _REST.match(page, m.end())
                if rest:
                    return start, rest.end(), m.group(2).lower(), bool(m.group(1)), page[m.end():rest.end() - 1]
                self._give_up(m.end())
                return start, gt + 1, None, False, ""
            start = page.find("<", start + 1)
        return None

    def _hopeless(self, at: int) -> bool:
        """Whether a tag that failed was outside of quotes here: from there on both read the same."""
        for first, last, starts, ends in self.failed:
            if first <= at <= last:
                k = bisect.bisect_right(starts, at) - 1
                if k < 0 or at >= ends[k]:
                    return True
        return False

    def _give_up(self, at: int) -> None:
        if not self._hopeless(at):
            last = _UPTO.match(self.page, at).end()
            spans = [m.span() for m in _QUOTED.finditer(self.page, at, last)]
            self.failed.append((at, last, [s for s, _ in spans], [e for _, e in spans]))


class Stack:
    """Open elements ``(name, path, marked)``, with how many there are of each name."""

    def __init__(self) -> None:
        self.items: list[tuple[str, tuple[int, ...], int]] = []
        self.count: defaultdict[str, int] = defaultdict(int)

    def cut(self, size: int) -> None:
        while len(self.items) > size:
            self.count[self.items.pop()[0]] -= 1

    def push(self, item: tuple[str, tuple[int, ...], int]) -> None:
        self.items.append(item)
        self.count[item[0]] += 1

    def last(self, name: str) -> int:
        """Place of the innermost element of a name that is open."""
        k = len(self.items) - 1
        while self.items[k][0] != name:
            k -= 1
        return k

    def inside_article(self) -> bool:
        return self.count["article"] + self.count["main"] > 0


def blocks(page: str) -> tuple[list[tuple[tuple[int, ...], str, int, bool]], list[tuple[int, ...]]]:
    """Text blocks ``(path, text, marked, in_article)`` in order, and the paths of all opening tags.

    A path is the chain of elements around, each as a hash of all up to it, so that its last entry tells it from others.
    ``marked`` is 2 if the path leads through something that is not the article, and 1 if only the name of an element
    around the article or outside of one says so: such an element may hold the article. Text of inline elements belongs to
    the block around them; references are decoded, white space is one space, empty blocks are left out.
    """
    out: list[tuple[tuple[int, ...], str, int, bool]] = []
    tags: list[tuple[int, ...]] = []
    paths: dict[tuple[int, str], tuple[int, ...]] = {}
    stack, scanner = Stack(), Scanner(page)
    held: list[str] = []
    place: tuple[tuple[int, ...], int, bool] = ((), 0, False)
    at, size = 0, len(page)

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append((place[0], text, place[1], place[2]))
            held.clear()

    def add(text: str) -> None:
        nonlocal place
        if not text:
            return
        top = stack.items[-1] if stack.items else ("", (), 0)
        here = (top[1], top[2], stack.inside_article())
        if held and here != place:
            flush()
        if not held:
            if not text.strip():
                return
            place = here
        held.append(text)

    def below(path: tuple[int, ...], signature: str) -> tuple[int, ...]:
        parent = path[-1] if path else 0
        found = paths.get((parent, signature))
        if found is None:
            found = paths[parent, signature] = (*path[:DEPTH - 1], _key(f"{parent}/{signature}"))
        return found

    while at < size:
        token = scanner.next(at)
        if token is None:
            # a tag that the page's end cuts off is no text
            cut = _START.search(page, max(at, page.rfind(">", at) + 1))
            add(page[at:cut.start()] if cut else page[at:])
            break
        start, end, name, closing, attributes = token
        add(page[at:start])
        at = end
        if name is None:
            continue
        if closing:
            if name not in INLINE:
                flush()
            if stack.count[name]:
                stack.cut(stack.last(name))
            continue
        if name not in INLINE:
            flush()
        if name == "body" and stack.count["head"]:
            # the head ends here at the latest
            stack.cut(next(k for k, s in enumerate(stack.items) if s[0] == "head"))
        if name in SIBLING and stack.items:
            for k in range(len(stack.items) - 1, -1, -1):
                if stack.items[k][0] in SIBLING[name]:
                    stack.cut(k)
                    break
                if stack.items[k][0] not in INLINE:
                    break
        elif name in BLOCK and stack.count["p"]:
            k = stack.last("p")
            if not any(s[0] in BLOCK for s in stack.items[k + 1:]):
                stack.cut(k)
        stack.cut(DEPTH - 1)
        inside_article = stack.inside_article()
        # the header of an article is part of it
        signature, mark = name, 2 * (name in AROUND and not (name == "header" and inside_article))
        if attributes:
            values = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(attributes)}
            hints = " ".join(values[a] for a in ("class", "id", "role") if values.get(a))
            if hints:
                signature = f"{name}.{_DIGITS.sub('0', hints.strip().replace(' ', '.'))}"
                if name not in ("html", "body", "main", "article") and not (name == "header" and inside_article) and is_mark(hints):
                    mark = max(mark, 1 + inside_article)
            if "hidden" in _ATTRIBUTE.sub("", attributes).split() or "display:none" in values.get("style", "").replace(" ", "") or values.get("aria-hidden") == "true":
                mark = 2
        above = stack.items[-1] if stack.items else ("", (), 0)
        path = below(above[1], signature) if name not in INLINE else above[1]
        if name not in INLINE:
            tags.append(path)
        if name in HIDDEN:
            # the content of these is skipped to their end, or to the end of the page
            if name in _RAW_END:
                over = _RAW_END[name].search(page, at)
                at = over.end() if over else size
                continue
            mark = 2
        if name in VOID or attributes.endswith("/"):
            continue
        stack.push((name, path, max(above[2], mark)))
    flush()
    return out, tags


def _key(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    return (zlib.crc32(raw) | (zlib.adler32(raw) & 0x7FFFFFFF) << 32) or 1


def _block_key(path: tuple[int, ...], text: str) -> int:
    return _key(f"{path[-1] if path else 0}\0{text}")


#: Entries of paths that one batch of tokens holds at most, but for the last row's own.
PATH_ENTRIES = 1 << 19


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each token of a page and how often it is there; block 0 is the tag of the path itself.

    A page is known by its texts, so copies are one page. ``other`` is the page's longest text besides the token. Path 0
    is a tag around every page; ``above`` are the paths around a text, its own included.
    """
    names = ["host", "page", "path", "block", "n", "other", "inside", "above"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for host, text in zip(*[batch.column(k).to_pylist() for k in range(2)], strict=True):
            found, tags = blocks(text)
            page = _key("\0".join(b[1] for b in found))
            rows += [(host, page, path, 0, n, 0, False, None) for path, n in Counter([0, *(t[-1] for t in tags)]).items()]
            longest = sorted({(len(b[1]), _key(b[1])) for b in found}, reverse=True)[:2]
            first, second = [k for _, k in [*longest, (0, 0), (0, 0)][:2]]
            inside = {b[0]: b[3] for b in found}
            for (path, words), n in Counter((b[0], b[1]) for b in found).items():
                other = first if _key(words) != first else second
                rows.append((host, page, path[-1] if path else 0, _block_key(path, words), n, other, inside[path], [0, *path]))
                held += len(path)
                if held >= PATH_ENTRIES:
                    yield flush(rows)
                    rows, held = [], 0
        yield flush(rows)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(known(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def template_blocks(tokens: DataFrame, least: int = 2, sure: int = 3) -> DataFrame:
    """``host, fixed``: the keys of the text blocks of each host that are part of its template.

    A block is on ``least`` pages, inside an article on ``sure``, and on half of the host's pages or on pages that differ
    in their longest text: what a few near copies share is no template. An occurrence vector is summed up as a hash of
    its (page, count) entries, so no vector and no host is gathered: a hot host is one partial sum per task and token.
    What is collected per host are blocks of its template.
    """
    vectors = tokens.groupBy("host", "path", "block").agg(
        F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).alias("vector"), F.count("*").alias("support"),
        F.max("inside").alias("inside"), (F.min("other") != F.max("other")).alias("differ"), F.max("above").alias("above"))
    vectors = stored(vectors.where((F.col("support") >= least) | (F.col("path") == 0)), "vectors")
    tags = vectors.where((F.col("block") == 0) & (F.col("support") >= least))
    around = tags.groupBy("host", "vector", "support").agg(F.collect_set("path").alias("tags"))
    pages = vectors.where((F.col("block") == 0) & (F.col("path") == 0)).select("host", F.col("support").alias("pages"))
    texts = vectors.where((F.col("block") != 0) & (F.col("support") >= F.when(F.col("inside"), sure).otherwise(least)))
    texts = texts.join(pages, "host").where(F.col("differ") | (2 * F.col("support") >= F.col("pages")))
    fixed = texts.join(around, ["host", "vector", "support"]).where(F.arrays_overlap("above", "tags"))
    return fixed.groupBy("host").agg(F.collect_set("block").alias("fixed"))


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, fixed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            found, _ = blocks(page)
            # an article in an element of a doubtful name only if there is no other one
            article = next((x for x in ([b for b in found if b[3] and b[2] == m] for m in (0, 1)) if x), None) or [b for b in found if not b[2]]
            known_ = set(fixed or ())
            # where all is fixed, the pages of the host are copies of each other
            slots = [b for b in article if _block_key(b[0], b[1]) not in known_] if known_ else article
            texts.append("\n".join(b[1] for b in slots or article))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page", "url", "text"])


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", least: int = 2) -> DataFrame:
    """``id, url, text`` of each row: the article's blocks in order, joined by line ends, empty if there are none.

    Null pages are empty, null or odd urls belong to a host without name. A host with fewer than ``least`` different
    pages has no template: its slots are chosen by names alone. Rows of equal texts are one page of the host, and repeat
    in the result. An empty table gives no rows.
    """
    shared_dir(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_column}`").alias("page"), F.col(f"`{url}`").alias("url"), known(F.col(f"`{html}`")).alias("html"))
    named = rows.select(host_of(F.col("url")).alias("host"), "html")
    tokens = named.mapInArrow(_tokens, "host string, page bigint, path bigint, block bigint, n int, other bigint, inside boolean, above array<bigint>").distinct()
    fixed = stored(template_blocks(tokens, least), "fixed").select(F.col("host").alias("_host"), "fixed")
    kind = pages.schema[id_column].dataType.simpleString()
    joined = rows.join(sized(fixed, 20_000), host_of(F.col("url")) == F.col("_host"), "left").select("page", "url", "html", "fixed")
    out = joined.mapInArrow(_choose, f"page {kind}, url {pages.schema[url].dataType.simpleString()}, text string")
    return out.select(F.col("page").alias(id_column), F.col("url").alias(url), "text")
