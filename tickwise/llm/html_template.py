"""Main text of web pages by equivalence classes of template tokens.

1. Every page is cut into markup tokens, differentiated by the containers they
   stand in (a hash of the path of tags, classes and ids with digits masked, so
   that depth costs nothing), and text regions (the text after a container token).
2. Over the pages of a host each token has an occurrence vector (its count in
   every page).  Tokens with the same vector form an equivalence class; the
   vector is compared by an order-free hash, combined map-side.  A class is
   valid when its tokens keep one order in the pages (their mean places differ)
   and it stands in at least half of the host's pages.  The text regions of
   valid classes are the template's slots.
3. A block of text that stands word for word in the same place on nine tenths of
   a host's pages is template text, also inside article and main.
4. A region is chrome when its
   path goes through navigation, header, footer, aside or form elements or a
   container (not html or body) with a class, id or role that is such a name, ends
   in one (site-menu) or adds a word for a box to one (comments-area); an article
   or main below ends the mark.
5. On a page with text of its own in an article or main, that text is extracted
   block by block.  On any other page, whatever its host's other pages have, a
   slot is content unless most of its text is in links or it repeats from page
   to page; regions in no template (rare pages, hosts of one page) follow the
   same rules with the page as its own template.

Templates are bounded: a token in half of a host's pages is one of at most
twice as many as a page has.  A host with a third of all pages is combined
map-side and its template is one small row.

Pages that leave nothing to extract since their host repeats all of it (copies of
one page) are read by themselves.

Defined results: null and empty html give an empty text; a page without url
belongs to the host ``''``; repeated rows give equal rows; broken markup never
fails (an unclosed tag ends with the page); extra columns are not read.
"""

from __future__ import annotations

import html as html_refs
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import small_side, stage
from tickwise.session import ship_package

# Fixed values of HTML: elements without content, raw-text elements, blocks and containers.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select canvas audio video button".split())
TO_END = frozenset("script style textarea title".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
CONTAINERS = frozenset("address article aside body details dialog div dl fieldset figure footer form header main menu nav ol section table ul html".split())
CHROME_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
ROOTS = frozenset(("html", "body"))
CHROME_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu "
    "modal navbar navigation nav newsletter notice notices pagination popup promo promoted promotion related recommended reply replies respond share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets complementary contentinfo search").split())

#: Words for a box in compound names, and words that say that a container has chrome beside its content.
BOX_WORDS = frozenset("area bar block box container inner item items links list outer panel section thread wrap wrapper".split())
LAYOUT_WORDS = frozenset("and has no with without".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"

#: Share of a host's pages a template token stands in; largest share of text in links of a content slot.
SUPPORT = 0.5
LINK_SHARE = 0.5
#: Distinct texts per page below which a slot without landmarks counts as repeated, and pages needed to say so.
DISTINCT_SHARE = 0.5
REPEAT_PAGES = 5
#: Share of a host's pages (REPEAT_PAGES at least) on which a block stands in one slot to be template text.
FIXED_SHARE = 0.9


def is_chrome(name: str) -> bool:
    """Whether a class, id or role names chrome: a chrome word, a compound that ends in one, or one followed by a word for a box."""
    if name in CHROME_WORDS:
        return True
    parts = re.split(r"[-_]+", name.strip("-_"))
    if len(parts) < 2 or not LAYOUT_WORDS.isdisjoint(parts):
        return False
    return parts[-1] in CHROME_WORDS or parts[-1] in BOX_WORDS and parts[-2] in CHROME_WORDS


class Region:
    """Text between two container tokens: its key, whether its path is chrome or inside main content, its blocks."""

    __slots__ = ("key", "chrome", "main", "blocks", "chars", "link_chars")

    def __init__(self, key: str, chrome: bool, main: bool):
        self.key, self.chrome, self.main, self.blocks, self.chars, self.link_chars = key, chrome, main, [], 0, 0


def parse(page: str) -> tuple[list[str], list[Region]]:
    """Container tokens in page order and text regions with their blocks."""
    tokens, stack = [], []  # stack: (tag, hash of the path, chrome, main)
    standing: dict[str, int] = {}  # open containers by tag
    regions = [Region("^", False, False)]
    pending: list[str] = []
    in_link, at, low = False, 0, None

    def flush() -> None:
        if pending:
            block = " ".join(html_refs.unescape("".join(pending)).split())
            if block:
                regions[-1].blocks.append(block)
            pending.clear()

    def text(s: str) -> None:
        if s:
            pending.append(s)
            n = len(s.strip())
            regions[-1].chars += n
            if in_link:
                regions[-1].link_chars += n

    def enter(token: str) -> None:
        tokens.append(token)
        chrome, main = (stack[-1][2], stack[-1][3]) if stack else (False, False)
        regions.append(Region(token, chrome, main))

    while m := _TAG.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue  # a comment or declaration; the text around it is one block
        tag, closing, attrs = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW and not closing:
            if not attrs.endswith("/"):
                low = page.lower() if low is None else low
                end = low.find(f"</{tag}", at)
                close = page.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else len(page) if tag in TO_END else at
            continue
        if tag == "br":
            pending.append(" ")
        if tag == "a":
            in_link = not closing
        if tag in BLOCKS:
            flush()
        if tag not in CONTAINERS:
            continue
        if closing:
            if standing.get(tag):
                while True:
                    open_tag, path = stack.pop()[:2]
                    standing[open_tag] -= 1
                    if open_tag == tag:
                        break
                enter(f"{path}>")
        else:
            given = [(n.lower(), (a or b or c).lower()) for n, a, b, c in _ATTR.findall(attrs)] if "=" in attrs else []
            marks = " ".join(v for _, v in given)
            named = any(is_chrome(m) for m in marks.split())
            sig = tag + ("." + ".".join(sorted(set(re.sub(r"\d+", "#", marks).split()))) if marks else "")
            above = stack[-1] if stack else ("", "", False, False)
            landmark = tag in MAIN_TAGS or any(n == "role" and "main" in v.split() for n, v in given)
            main = above[3] or landmark
            if landmark:  # ends a chrome mark from above, unless it is an article in an article (a comment) or named as chrome itself
                chrome = above[2] and tag == "article" and (named or standing.get("article", 0) > 0)
            else:
                chrome = above[2] or tag in CHROME_TAGS or named and tag not in ROOTS
            path = xxhash.xxh64_hexdigest(f"{above[1]}/{sig}")
            stack.append((tag, path, chrome, main))
            standing[tag] = standing.get(tag, 0) + 1
            enter(path)
    text(page[at:])
    flush()
    return tokens, regions


def mark(key: str, block: str) -> int:
    """Hash of a block of text in a slot."""
    return xxhash.xxh64_intdigest(f"{key}\n{block}") >> 1


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and (host, token, text of its region): pages, hashes of the occurrence vector, places and text figures.

    Rows without a token count the pages of a host on which a block (its mark in ``said``) stands.
    """
    for batch in batches:
        seen, stood = {}, {}
        for host_name, page_id, page in zip(*[batch.column(c).to_pylist() for c in ("host", "page_id", "html")]):
            tokens, regions = parse(page or "")
            count, place, texts = {"^": 1}, {"^": 0.0}, {}
            for i, t in enumerate(tokens):
                count[t] = count.get(t, 0) + 1
                place.setdefault(t, (i + 1) / (len(tokens) + 1))
            for r in regions:
                e = texts.setdefault(r.key, [[], 0, 0, False, False])
                e[0] += r.blocks
                e[1:] = [e[1] + r.chars, e[2] + r.link_chars, e[3] or r.chrome, e[4] or r.main]
            for t, b in {(t, b) for t, e in texts.items() for b in e[0]}:
                k = host_name, mark(t, b)
                stood[k] = stood.get(k, 0) + 1
            for t, n in count.items():
                blocks, *figures = texts[t]
                h = xxhash.xxh64_intdigest(f"{page_id}|{n}")
                said = xxhash.xxh64_intdigest("\n".join(blocks)) >> 1
                e = seen.setdefault((host_name, t, said), [0, 0, 0, n, n, 0.0, 0, 0, False, False])
                e[:] = [e[0] + 1, e[1] + (h >> 32), e[2] + (h & 0xFFFFFFFF), min(e[3], n), max(e[4], n), e[5] + place[t],
                        e[6] + figures[0], e[7] + figures[1], e[8] or figures[2], e[9] or figures[3]]
        if seen:
            nothing = (None,) * (len(_OBSERVED) - 4)
            cols = list(zip(*[(*k, *v) for k, v in seen.items()], *[(h, None, m, n, *nothing) for (h, m), n in stood.items()]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, _OBSERVED)], names=[n for n, _ in _OBSERVED])


_OBSERVED = [("host", pa.string()), ("token", pa.string()), ("said", pa.int64()), ("df", pa.int64()), ("v1", pa.int64()), ("v2", pa.int64()),
             ("lo", pa.int64()), ("hi", pa.int64()), ("place", pa.float64()), ("chars", pa.int64()), ("link_chars", pa.int64()),
             ("chrome", pa.bool_()), ("main", pa.bool_())]
_OBSERVED_DDL = ("host string, token string, said long, df long, v1 long, v2 long, lo long, hi long, place double, chars long, link_chars long, "
                 "chrome boolean, main boolean")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def observed(pages: DataFrame) -> DataFrame:
    ship_package(pages.sparkSession)
    seen = pages.select(host(F.col("url")).alias("host"), F.col("page_id").cast("string").alias("page_id"), "html").mapInArrow(_observe, _OBSERVED_DDL)
    return stage(seen, "html-seen")


def token_classes(seen: DataFrame) -> DataFrame:
    """One row per template token: host, token, its class (v1, v2), occurrences, mean place and the figures of its slot."""
    tokens = seen.where("token IS NOT NULL").groupBy("host", "token").agg(
        *[F.sum(c).alias(c) for c in ("df", "v1", "v2", "place", "chars", "link_chars")], F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.max("chrome").alias("chrome"), F.max("main").alias("main"), F.approx_count_distinct("said").alias("texts"))
    tokens = stage(tokens, "html-tokens")
    size = tokens.where("token = '^'").select("host", F.col("df").alias("pages"))
    return tokens.join(size, "host").where(F.col("df") >= F.col("pages") * SUPPORT)


def fixed_blocks(seen: DataFrame) -> DataFrame:
    """(host, fixed): marks of the blocks that stand word for word in one slot on nearly all pages of a host."""
    size = seen.where("token = '^'").groupBy("host").agg(F.sum("df").alias("pages")).where(F.col("pages") >= REPEAT_PAGES)
    blocks = seen.where("token IS NULL").groupBy("host", "said").agg(F.sum("df").alias("df"))
    fixed = blocks.join(small_side(stage(size, "html-sizes"), 64), "host").where(F.col("df") >= F.col("pages") * FIXED_SHARE)
    return fixed.groupBy("host").agg(F.sort_array(F.collect_list("said")).alias("fixed"))


def templates(pages: DataFrame) -> DataFrame:
    """One row per host: the slots of its valid classes with their verdict (for pages without landmarks) and its fixed blocks."""
    seen = observed(pages)
    t = token_classes(seen).withColumn("place", F.col("place") / F.col("df"))
    klass = ["host", "v1", "v2", "df", "lo", "hi"]
    # an equivalence class is valid when no two of its tokens share a place
    valid = t.groupBy(*klass).agg(F.countDistinct("place").alias("places"), F.count("*").alias("n")).where("places = n")
    prose = F.col("link_chars") <= F.col("chars") * LINK_SHARE
    repeated = (F.col("df") >= REPEAT_PAGES) & (F.col("texts") < F.col("df") * DISTINCT_SHARE)
    slot = F.struct("token", (prose & ~repeated).alias("content"))
    slots = t.join(valid.select(*klass), klass, "left_semi").where("chars > 0 AND NOT chrome").groupBy("host").agg(F.collect_list(slot).alias("slots"))
    return slots.join(fixed_blocks(seen), "host", "full").select(
        "host", F.coalesce("slots", F.array().cast("array<struct<token:string,content:boolean>>")).alias("slots"),
        F.coalesce("fixed", F.array().cast("array<long>")).alias("fixed"))


def main_text(page: str, slots: dict[str, bool], fixed: frozenset = frozenset()) -> str:
    """Blocks of the content regions without the host's fixed blocks.

    Landmarks decide on a page that has text of its own in one; elsewhere the
    template's verdict does where it has the slot, and the page's links where not.
    """
    _, regions = parse(page)
    open_regions = [r for r in regions if not r.chrome and r.blocks]
    own = [(r, [b for b in r.blocks if mark(r.key, b) not in fixed] if fixed else r.blocks) for r in open_regions]
    marked = any(r.main and blocks for r, blocks in own)
    out = []
    for r, blocks in own:
        if r.main if marked else slots.get(r.key, r.link_chars <= r.chars * LINK_SHARE):
            out += blocks
    if not out:  # the host says the same on every page (copies of one page): the page is its own template
        landmarks = any(r.main for r in open_regions)
        out = [b for r in open_regions if (r.main if landmarks else r.link_chars <= r.chars * LINK_SHARE) for b in r.blocks]
    return "\n\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, known = [], {}
        lists = [batch.column(c).to_pylist() for c in ("html", "keys", "flags", "fixed")]
        for page, *told in zip(*lists):
            k = tuple(tuple(x or ()) for x in told)
            template = known.get(k)
            if template is None:
                template = known[k] = dict(zip(k[0], k[1])), frozenset(k[2])
            texts.append(main_text(page or "", *template))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    t = stage(templates(pages).select(F.col("host").alias("_host"), F.transform("slots", lambda s: s["token"]).alias("keys"),
                                      F.transform("slots", lambda s: s["content"]).alias("flags"), "fixed"), "html-templates")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    joined = rows.join(small_side(t, 4096), F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "keys", "flags", "fixed")
    id_type = pages.schema["page_id"].dataType.simpleString()
    out = joined.mapInArrow(_extract, f"page_id {id_type}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
