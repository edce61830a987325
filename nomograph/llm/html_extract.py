"""Main text of web pages: nearest-URL page differencing over the lines that structure leaves, checked by the page's marks.

A page's lines are its blocks of text. Elements that are menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles or reader comments by tag, role or class go. The lines left, of every page, are aligned by longest common
subsequence with those of its partner: shared lines are the site's, the others the page's own. The partner is the page of
the nearest URL path on the same host that shares some of its distinct lines but not all: one that shares all is a copy,
one that shares none has another layout. The nearest has the longest common beginning of the path; of equals those before
in the order of (path, digest) come first, the closer first. Without a partner all lines are the page's own. The result
depends on the host's pages alone, not on how rows are dealt.

The page's own lines are its text, after one check: if the page marks its article (article, main, or the role main), the
lines inside are its text, shared passages too. Differencing sets aside a mark that is the site's: one of which the
partner has every line, while the page's own lines outside hold more characters.

Equal pages count once. All are ranked by host, path and digest; blocks of consecutive ranks, with NEAR neighbours at
their ends, find the partners that are close. What they leave open is searched through an index of the lines that several
pages hold: for each line and each block of ranks of a level, the combined hash of the pages that hold it. Where these
hashes differ among a page's lines, the block has a page that shares some of them but not all; the search goes outwards
from level to level and then down, a join for each. No task holds a host. Lines travel as hashes of host and line; only
if many pages' texts differ from their marks are texts shuffled.

Differencing alone can't decide marked articles: there menus and adverts differ from page to page, while
articles share passages and whole copies. extract(structure=False) shows what it gives alone.

Defined cases: null and empty html give the text '' and 0; a null url is a host of its own; repeated rows give
equal results; an empty table gives an empty result; pages of any length are read whole; other columns are
ignored. Unclosed, stray and misnested tags are accepted: text is never lost to them. After a tag with a quote that is
never closed, quotes no longer hide a >.
"""

from __future__ import annotations

import math
import re
from collections.abc import Hashable, Iterator, Sequence
from html import unescape
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nomograph.llm.common import cut, no_table, pick, small_batches, table

#: Bytes to broadcast at most of what differencing decided against the marks.
BROADCAST_BYTES = 16 << 20
#: Neighbours before and after that a block of ranks looks at, ranks in a block, and blocks that make up one of the index's next level.
NEAR, BLOCK, FAN = 16, 512, 8
_QUOTED = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in _RAW}
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead tr ul".split())
_GAP = frozenset("br td th img wbr input".split())
_GONE = frozenset("head nav header footer aside form button select datalist menu dialog template svg math object canvas audio video search".split())
#: Words of class and id that name page furniture.
_FURNITURE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices alert sidebar sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist reply replies respond disqus share sharing social related recommended newsletter subscribe subscription popup modal overlay widget widgets login signup search pagination pager toolbar skip".split())
#: Words that leave a class such as ad-slot or post-comments what its other words say. Others (has-sidebar, comments-open) may say the opposite.
_NEUTRAL = frozenset("site page main global primary secondary top bottom left right upper lower inner outer mobile desktop sticky fixed slot box bar block area section container wrap wrapper row col column list item items link links unit group holder panel region body content title text form button buttons icon icons post article entry story js the".split())
#: Words of class and id that name the content.
_CONTENT = frozenset("article content entry story post main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
_WORDS = re.compile(r"[^a-z]+")
_HEADING = re.compile(r"h[1-6]\Z")
#: Tags whose start ends an open element of the same group.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def _names(attributes: str) -> dict[str, list[str]]:
    """The words, separated by spaces, of the element's class, id and role; of an attribute given twice the first counts."""
    found: dict[str, list[str]] = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        if (name := name.lower()) in ("class", "id", "role"):
            found.setdefault(name, value.strip("\"'").lower().split())
    return found


def _mark(tag: str, attributes: str) -> int:
    """2 for an element that marks the article, 1 for one whose class or id names the content, else 0."""
    if tag in ("article", "main"):
        return 2
    if not attributes or tag in ("html", "body") or tag not in _BLOCK:
        return 0
    names = _names(attributes)
    if "main" in names.get("role", ()):
        return 2
    for token in (*names.get("class", ()), *names.get("id", ())):
        words = set(_WORDS.split(token))
        if not _CONTENT.isdisjoint(words) and _FURNITURE.isdisjoint(words):
            return 1
    return 0


def _furniture(tag: str, attributes: str) -> int:
    """2 for furniture by tag, role, or a whole class or id; 1 for furniture by a word within a class or id, unless the element is marked; else 0."""
    if tag in _GONE:
        return 2
    if not attributes or tag in ("html", "body"):
        return 0
    names = _names(attributes)
    tokens = [*names.get("class", ()), *names.get("id", ())]
    if not _ROLES.isdisjoint(names.get("role", ())) or not _FURNITURE.isdisjoint(tokens):
        return 2
    for token in tokens:
        words = {w for w in _WORDS.split(token) if w}
        if not _FURNITURE.isdisjoint(words) and words <= _FURNITURE | _NEUTRAL:
            return 0 if _mark(tag, attributes) else 1
    return 0


def tokens(html: str) -> Iterator[tuple[str, str, str, str]]:
    """The page in order: text, and the tag that follows it as slash, name and attributes (no name at the end, or where a comment or declaration goes). Each character is read a bounded number of times."""
    start = at = 0
    last, plain = html.rfind(">"), False
    while (i := html.find("<", at)) >= 0:
        if html[i + 1 : i + 2] in ("!", "?"):
            if html.startswith("<!--", i):
                end = html.find("-->", i + 4) + 3
            elif html.startswith("<![CDATA[", i):
                end = html.find("]]>", i + 9) + 3
            else:
                end = html.find(">", i) + 1 if i < last else i  # without an end it is text
            if end == i:
                at = i + 1
                continue
            yield html[start:i], "", "", ""
            start = at = end if end > i else len(html)  # a comment that isn't closed takes the rest
            continue
        m = None
        if i < last:  # beyond, no tag can end
            m = None if plain else _QUOTED.match(html, i)
            if m is None and (m := _PLAIN.match(html, i)) is not None:
                plain = True
        if m is None:
            at = i + 1
            continue
        yield html[start:i], m[1], m[2].lower(), m[3]
        start = at = m.end()
        if not m[1] and m[2].lower() in _RAW:
            end_tag = _ENDS[m[2].lower()].search(html, at)
            start = at = end_tag.end() if end_tag else len(html)
    yield html[start:], "", "", ""


class _Open:
    """The open elements, and where in them the last of each kind stands, so that no tag costs a walk through all."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, int]] = []  # tag, whether it is furniture, its mark, and what gone was before
        self.places: dict[str, list[int]] = {}  # by tag
        self.blocks: list[int] = []
        self.frames: list[int] = []  # blocks other than paragraphs
        self.furniture: list[int] = []

    def push(self, tag: str, bad: int, rank: int, gone: int) -> None:
        at = len(self.stack)
        self.stack.append((tag, bad, rank, gone))
        for places in self._of(tag, bad):
            places.append(at)

    def pop(self) -> tuple[str, int, int, int]:
        element = self.stack.pop()
        for places in self._of(element[0], element[1]):
            places.pop()
        return element

    def _of(self, tag: str, bad: int) -> Iterator[list[int]]:
        yield self.places.setdefault(tag, [])
        if tag in _BLOCK:
            yield self.blocks
            if tag != "p":
                yield self.frames
        if bad:
            yield self.furniture

    def last(self, *kinds: list[int]) -> int:
        return max([k[-1] for k in kinds if k], default=-1)

    def ended_by(self, tag: str) -> int:
        """How many elements stay open after this end tag. An inline one doesn't close blocks; nothing but the end of the article or page closes furniture from inside."""
        at = self.last(self.places.get(tag, []))
        bars = ([] if tag in _BLOCK else [self.blocks]) + ([] if tag in ("article", "main", "body", "html") else [self.furniture])
        return at if at >= 0 and at >= self.last(*bars) else len(self.stack)

    def implied_by(self, tag: str) -> int:
        """How many elements stay open when this start tag ends an element of its group."""
        at = self.last(*[self.places[t] for t in _CLOSES.get(tag, ()) if t in self.places])
        return at if at >= 0 and at >= self.last(self.frames, self.furniture) else len(self.stack)


def blocks_of(html: str | None, structure: bool = True) -> tuple[list[str], list[bool]]:
    """The page's lines without furniture, and of each whether it is inside what the page marks as its article. Without structure, all lines, unmarked."""
    everything: list[str] = []
    ranks: list[int] = []  # of each line: 1 inside content by name, 2 inside a marked article, 3 both
    elements = _Open()
    gone, depth = 0, [0, 0, 0]  # whether furniture is open (2; 1 if by words within names alone), and open elements by mark
    buffer: list[str] = []

    def flush() -> None:
        nonlocal buffer
        if buffer:
            line = " ".join("".join(buffer).split())
            if line:
                everything.append(line)
                ranks.append((depth[1] > 0) + 2 * (depth[2] > 0))
            buffer = []

    def keep(n: int) -> None:
        nonlocal gone
        while len(elements.stack) > n:
            _, _, rank, gone = elements.pop()
            depth[rank] -= 1

    for text, slash, tag, attributes in tokens(html or ""):
        if text and not gone:
            buffer.append(unescape(text) if "&" in text else text)
        if not tag:
            continue
        if slash:
            if tag in _BLOCK:
                flush()
            keep(elements.ended_by(tag))
            continue
        if tag in _RAW:
            continue
        if tag in _BLOCK:
            flush()
        elif tag in _GAP and not gone:
            buffer.append(" ")
        keep(elements.implied_by(tag))
        if tag in _VOID or attributes.rstrip().endswith("/") and tag not in _BLOCK:
            continue
        bad = 0 if gone == 2 or not structure else _furniture(tag, attributes)
        if bad and tag == "header" and depth[2] and not _furniture("div", attributes):
            bad = 0  # an article's own heading
        rank = 0 if gone == 2 or bad or not structure else _mark(tag, attributes)
        if bad or rank:
            flush()
        now = 0 if rank else max(gone, bad)  # words within names don't drop what a mark inside keeps
        if gone and rank == 1:
            rank = 0  # kept, but it doesn't speak for the page
        elements.push(tag, bad if bad > gone else 0, rank, gone)
        gone, depth[rank] = now, depth[rank] + 1
    flush()
    best = 2 if any(rank & 2 for rank in ranks) else 1
    return everything, [rank & best > 0 for rank in ranks]


def lines_of(html: str | None, structure: bool = True) -> tuple[list[str], bool]:
    """The page's lines without furniture, and whether they are those of a marked article. Without structure, all lines, unmarked."""
    lines, marked = blocks_of(html, structure)
    best = [line for line, inside in zip(lines, marked, strict=True) if inside]
    return (best, True) if best else (lines, False)


def common_lines(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[int]:
    """Positions in a of a longest common subsequence of a and b, which are lines or their hashes. One row of the table is one number, a bit for each line of a
    (Hyyrö's bit-parallel form); rows are kept at intervals and made again in between, so that memory stays small."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    common = set(x) & set(y)
    kept = [i for i, line in enumerate(x) if line in common]
    x, y = [x[i] for i in kept], [line for line in y if line in common]
    where: dict[Hashable, list[int]] = {}
    for i, line in enumerate(x):
        where.setdefault(line, []).append(i)
    masks, full = {line: _bits(places, len(x)) for line, places in where.items()}, (1 << len(x)) - 1

    def rows(row: int, lines: list[Hashable]) -> Iterator[int]:
        for line in lines:
            u = row & masks[line]
            row = (row + u | row - u) & full
            yield row

    step, row, marks = math.isqrt(len(y)) + 1, full, []
    for k, row_after in enumerate(rows(full, y)):
        if k % step == 0:
            marks.append(row)  # the row before y[k]
        row = row_after
    i, j, middle, block, low = len(x), len(y), [], [], len(y)
    while i and j:
        if j - 1 < low:
            low = (j - 1) // step * step
            block = [marks[low // step], *rows(marks[low // step], y[low:j])]  # the rows before y[low], after it, ...
        if block[j - low] >> (i - 1) & 1:
            i -= 1
        elif j - 1 and not block[j - 1 - low] >> (i - 1) & 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            middle.append(head + kept[i])
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def _bits(places: list[int], n: int) -> int:
    data = bytearray(n // 8 + 1)
    for i in places:
        data[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(data, "little")


def own_lines(lines: list[str], partner: list[str] | None) -> list[str]:
    """The page's lines without those that it shares with its partner."""
    shared = set(common_lines(lines, partner)) if partner else set()
    return [line for i, line in enumerate(lines) if i not in shared]


def chosen(sizes: list[int], shared: set[int]) -> tuple[list[int], bool]:
    """Positions of the lines that are the page's text, and whether they are just those inside its mark. sizes: each line's characters, negative inside the mark; shared: positions of the lines that the partner has too."""
    inside = [i for i, n in enumerate(sizes) if n < 0]
    own = [i for i in range(len(sizes)) if i not in shared]
    stands = bool(inside) and (any(i not in shared for i in inside) or sum(sizes[i] for i in own) <= -sum(sizes[i] for i in inside))
    return (inside, True) if stands else (own, own == inside)


def _close(block: pa.Table) -> pa.Table:
    """For each page of the block itself the rank of its partner; -1 if it has none, -2 if a page out of sight may be nearer."""
    block = block.sort_by("rank")
    ranks, host, path, mine = (block[c].to_pylist() for c in ("rank", "host", "path", "mine"))
    sets, out = [frozenset(x) for x in block["hashes"].to_pylist()], []
    for at in range(len(ranks)):
        if not mine[at]:
            continue
        near = lambda x: len(commonprefix([path[x], path[at]]))  # noqa: B023, E731
        found, unseen = [], []  # (-length of the common beginning, side) and rank of the first on a side; the most that a side out of sight can offer
        for side, step in ((0, -1), (1, 1)):
            x, limit = at + step, len(path[at])
            while 0 <= x < len(ranks) and host[x] == host[at] and abs(ranks[x] - ranks[at]) <= NEAR:
                limit = near(x)
                if 0 < len(sets[at] & sets[x]) < len(sets[at]):
                    found.append(((-limit, side), ranks[x]))
                    break
                x += step
            else:
                if not (0 <= x < len(ranks) and host[x] != host[at]):
                    unseen.append((-limit, side))
        best = min(found, default=None)
        if best is None:
            out.append((ranks[at], -2 if unseen else -1))
        else:
            out.append((ranks[at], best[1] if all(best[0] < u for u in unseen) else -2))
    return pa.table({"rank": pa.array([r for r, _ in out], pa.int64()), "partner": pa.array([x for _, x in out], pa.int64())})


def ranked(pages: DataFrame) -> DataFrame:
    """pages: host, path, digest, hashes and sizes of its lines in order, and open (whether a row wants a partner). Each distinct page once, with its rank in the order of host, path and digest. From a checkpoint."""
    keys = ["host", "path", "digest"]
    each = pages.groupBy(*keys).agg(F.any_value("hashes").alias("hashes"), F.any_value("sizes").alias("sizes"), F.bool_or("open").alias("open"))
    ordered = cut(each.repartitionByRange(*keys).sortWithinPartitions(*keys)).withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))  # as many rows as partitions
    starts = cut(counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    placed = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.select((F.col("start") + F.col("_id").bitwiseAND((1 << 33) - 1)).alias("rank"), *keys, "hashes", "sizes", "open")


def _hashes() -> Column:
    """Hashes of the lines, each together with its host."""
    return F.transform("lines", lambda x: F.xxhash64("host", x)).alias("hashes")


def _digest() -> Column:
    return F.sha2(F.array_join("lines", "\n"), 256).alias("digest")


def close_partners(pages: DataFrame) -> DataFrame:
    """pages as ranked. rank and partner of the open ones, as _close gives them. A block's task holds BLOCK pages and the neighbours at its ends, as hashes."""
    block = F.floor(F.col("rank") / BLOCK)
    seen = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor((F.col("rank") + d * (NEAR + 1)) / BLOCK)))
    rows = pages.select("rank", "host", "path", "hashes", "open", block.alias("own"), F.explode(seen).alias("block")).where("block >= 0")
    rows = rows.withColumn("mine", F.col("open") & (F.col("own") == F.col("block")))
    return rows.groupBy("block").applyInArrow(lambda t: _close(t), "rank long, partner long")


def far_partners(pages: DataFrame, left: DataFrame) -> DataFrame:
    """pages as ranked; left: rank. For each page of left the nearest page before and after it that shares some of its lines but not all: rank, partner.

    Only lines that several pages hold are looked up: with a line of its own (alone) a page has none whose every line another shares, and with no other lines it has no partner."""
    lines = lambda df: df.select("rank", F.explode(F.array_distinct("hashes")).alias("line"))
    every = lines(pages.join(left, "rank", "left_semi"))
    held = lines(pages).join(every.select("line").distinct(), "line", "left_semi")
    several = cut(held.groupBy("line").agg(F.count("*").alias("n")).where("n > 1").select("line"))
    mine = every.join(several.withColumn("known", F.lit(True)), "line", "left")
    alone = mine.groupBy("rank").agg(F.bool_or(F.col("known").isNull()).alias("alone"), F.bool_or("known").alias("known")).where("known").select("rank", "alone")
    mine = cut(mine.where("known").select("rank", "line").join(alone, "rank"))
    held = cut(lines(pages).join(several, "line", "left_semi"))
    levels = max(1, math.ceil(math.log(max(2, pages.agg(F.max("rank")).first()[0] + 1), FAN)))
    hashes = [held.groupBy("line", F.floor(F.col("rank") / FAN**k).alias("block")).agg(F.bit_xor(F.xxhash64("rank")).alias("h")) for k in range(levels)]

    def nearest(asked: DataFrame, level: int) -> DataFrame:
        """asked: rank, side, block. Of each page's blocks on a side the nearest that has a page of the kind looked for: there its lines lie in different pages."""
        found = asked.join(mine, "rank").join(hashes[level], ["line", "block"], "left").groupBy("rank", "side", "block", "alone")
        found = found.agg(F.min(F.coalesce("h", F.lit(0))).alias("low"), F.max(F.coalesce("h", F.lit(0))).alias("high")).where("low <> high OR alone AND low <> 0")
        return found.groupBy("rank", "side").agg(F.min(F.abs(F.col("block") - F.floor(F.col("rank") / FAN**level))).alias("away")).select("rank", "side", (F.floor(F.col("rank") / FAN**level) + F.col("away") * F.col("side")).alias("block"))

    todo = cut(mine.select("rank").distinct().select("rank", F.explode(F.array(F.lit(-1), F.lit(1))).alias("side")))
    hits: list[DataFrame] = []
    for k in range(levels):  # outwards: the other blocks of the same block of the next level
        own = F.floor(F.col("rank") / FAN**k)
        first = F.floor(own / FAN) * FAN
        asked = todo.select("rank", "side", F.explode(F.sequence(first, first + FAN - 1)).alias("block")).where((F.col("block") - own) * F.col("side") > 0)
        hits.append(cut(nearest(asked, k)))
        todo = cut(todo.join(hits[k], ["rank", "side"], "left_anti"))
        if todo.isEmpty():
            break
    for k in range(len(hits) - 1, 0, -1):  # and down
        children = hits[k].select("rank", "side", F.explode(F.sequence(F.col("block") * FAN, F.col("block") * FAN + FAN - 1)).alias("block"))
        hits[k - 1] = cut(hits[k - 1].unionByName(nearest(children, k - 1)))
    return hits[0].select("rank", F.col("block").alias("partner"))


def decided(pages: DataFrame) -> DataFrame:
    """pages: host, path, digest, hashes, sizes, open. host, path and digest of every distinct page with an open row, the positions of the lines that are its text (kept), and whether they are just those inside its mark (as_marked)."""
    known = ranked(pages)
    partners = cut(close_partners(known))
    left = partners.where("partner = -2").select("rank")
    partners = partners.where("partner >= 0")
    if not left.isEmpty():
        partners = partners.unionByName(far_partners(known, left))
    other = known.select(F.col("rank").alias("partner"), F.col("path").alias("other_path"), F.col("hashes").alias("other"))
    sides = partners.join(other, "partner").groupBy("rank").agg(F.collect_list(F.struct((F.col("partner") > F.col("rank")).alias("after"), F.col("other_path").alias("path"), F.col("other").alias("hashes"))).alias("sides"))
    rows = known.where("open").join(sides, "rank", "left").select("host", "path", "digest", "hashes", "sizes", "sides")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            found = []
            for path, mine, sizes, sides in zip(*[batch.column(k).to_pylist() for k in (1, 3, 4, 5)], strict=True):
                best = min(sides or [], key=lambda s: (-len(commonprefix([s["path"], path])), s["after"]), default=None)  # noqa: B023
                found.append(chosen(sizes, set(common_lines(mine, best["hashes"])) if best else set()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array([x for _, x in found], pa.bool_())], ["host", "path", "digest", "kept", "as_marked"])

    return rows.mapInArrow(run, "host string, path string, digest string, kept array<int>, as_marked boolean")


def _text() -> Column:
    return F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n\n").alias("text")


def differenced(pages: DataFrame) -> DataFrame:
    """pages: host, path, lines, open. host, path, digest and text of every distinct page with an open row, by differencing alone."""
    pages = pages.withColumn("digest", _digest())
    found = decided(pages.select("host", "path", "digest", _hashes(), F.transform("lines", F.length).alias("sizes"), "open"))
    texts = pages.groupBy("host", "path", "digest").agg(F.any_value("lines").alias("lines"))
    return found.join(texts, ["host", "path", "digest"]).select("host", "path", "digest", _text())


def extract(pages: DataFrame, structure: bool = True) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html). Without structure, differencing alone decides.

    Pages are read twice, so that lines needn't be kept: once for the differencing, and once for the texts."""
    small_batches(pages.sparkSession)
    address = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"
    rows = pick(pages, "page_id", "url", "html").select(
        "page_id", "url", F.coalesce(F.lower(F.regexp_extract("url", address, 1)), F.lit("")).alias("host"), F.coalesce(F.regexp_extract("url", address, 2), F.lit("")).alias("path"), "html"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_table()
        for batch in batches:
            found = [blocks_of(html, structure) for html in batch.column(4).to_pylist()]
            sizes = [[-len(line) if inside else len(line) for line, inside in zip(*x, strict=True)] for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([x for x, _ in found], pa.list_(pa.string())), pa.array(sizes, pa.list_(pa.int32()))], ["page_id", "url", "host", "path", "lines", "sizes"])

    parsed = rows.mapInArrow(read, "page_id long, url string, host string, path string, lines array<string>, sizes array<int>")
    # equal lines under other marks are another page
    digest = F.sha2(F.concat(F.array_join("lines", "\n"), F.lit("\0"), F.array_join(F.transform("sizes", lambda n: F.signum(n).cast("string")), "")), 256)
    parsed = parsed.withColumn("digest", digest)
    others = cut(decided(parsed.select("host", "path", "digest", _hashes(), "sizes", F.lit(True).alias("open"))).where("NOT as_marked").drop("as_marked"))
    size = others.agg(F.coalesce(F.sum(F.length("host") + F.length("path") + 200 + 4 * F.size("kept")), F.lit(0))).first()[0]
    inside = F.filter(F.transform("sizes", lambda n, i: F.when(n < 0, i)), lambda i: i.isNotNull())
    if size:
        parsed = parsed.join(F.broadcast(others) if size <= BROADCAST_BYTES else others, ["host", "path", "digest"], "left")
        parsed = parsed.withColumn("kept", F.coalesce("kept", inside))
    else:
        parsed = parsed.withColumn("kept", inside)
    return parsed.select("page_id", "url", _text()).withColumn("n_chars", F.length("text").cast("long"))


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
