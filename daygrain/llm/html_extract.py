"""HTML extraction by deduction of each host's template from equivalence classes of tokens.

A page is a sequence of tokens: each start tag and each block of text, told apart by its
path of open elements. A token's *occurrence vector* is how often it stands on each page of
the host. Tokens with equal vectors form an equivalence class; classes on enough pages are
template candidates. Vectors are compared by hashes that Spark aggregates, so no host is
gathered anywhere. On a page, a class is valid if its tokens stand in one order, turn by
turn, and it nests with the classes found valid before: its turns lie within single gaps
of theirs. Valid classes are the template; what text remains are the slots.

The template decides on every page. The slots inside an article (or main) element are the
text, where a page has one, else all slots. Copies of a page count as one page of the host. Elements that by name, role or class hold menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles or comments are no slots on any page.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, staged, table

#: Pages and share of a host's pages that a template token stands on at least.
MIN_PAGES, MIN_SHARE = 3, 0.6
#: Tokens of all templates up to which they are broadcast (16 bytes each), and beyond it the copies of a host's template.
MOST_TOKENS, SALTS = 1 << 20, 16

RAW = "script|style|title|textarea|noscript|iframe|template|svg|annotation-xml|annotation|object|select|xmp"
# As in a browser, a quote counts only behind an equals sign, and a tag that isn't closed takes the rest of the page:
# every pattern matches where it begins to, so that a page is read once.
ATTRIBUTES = r"(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))|[^>])*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?![a-z0-9:-]){ATTRIBUTES}(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attributes>{ATTRIBUTES})(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"(?:^|(?<=[\s\"'/]))(?:([a-z:-]++)\s*+=\s*+(\"[^\"]*+\"?|'[^']*+'?|[^\s\"'>]++)|(hidden)(?=[\s/]|$))", re.IGNORECASE
)
BLANK = re.compile(r"\s+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Elements that end when one of the same set begins inside them.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"},
}
#: tag -> the elements that end where it begins.
CLOSES = {tag: [k for k, v in CLOSED_BY.items() if tag in v] for tag in CLOSED_BY}
INLINE_P = BLOCK - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot"}

DROPPED = set("nav footer aside form button dialog menu label input head audio video canvas".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NAMES = (
    "ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|sidebar|side|aside|"
    "nav|navbar|navigation|menu|breadcrumb|breadcrumbs|footer|masthead|cookie|cookies|consent|gdpr|notice|notices|"
    "alert|popup|modal|overlay|newsletter|subscribe|subscription|share|sharing|social|related|recommended|comment|"
    "comments|disqus|reply|replies|widget|login|signin|signup|search|pagination|pager|skip|toolbar|copyright|legal|"
    "disclaimer|tags|form"
)
NAMED = re.compile(rf"(?:^|[\s_-])(?:{NAMES})(?:$|[\s_-])", re.IGNORECASE)
HEADED = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.IGNORECASE)
ARTICLE = {"article", "main"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: In an article only boxes go by their name, and only if it is a whole one: "share", "share-buttons", not "notice-of-motion".
BOXES = set("div section aside ul ol".split())
WHOLE = re.compile(
    rf"(?:^|\s)(?:{NAMES})(?:[_-](?:bar|block|box|button|buttons|container|form|inner|links?|list|module|section|thread|unit|"
    r"widget|wrapper|wrap))*(?:$|\s)",
    re.IGNORECASE,
)
#: Ids that a section of an article is dropped for; others are anchors of its text.
REMARKS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|reply|replies)(?:$|[\s_-])", re.IGNORECASE)


@dataclass
class Block:
    text: str
    token: int
    inside: bool  # of an article or main
    heading: bool


def _token(path: int, text: str = "") -> int:
    body = b"%d\0%s" % (path, text.encode("utf-8", "surrogatepass"))
    return (zlib.crc32(body) << 31) ^ zlib.crc32(body[::-1])


def _holds_boilerplate(tag: str, attributes: str, inside: bool) -> bool:
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, value, hidden in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if hidden or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
        if name in ("class", "id") and tag not in ARTICLE:
            # in an article, most names tell what the text is about
            if inside and tag not in BOXES or inside and tag == "section" and name == "id" and not REMARKS.search(value):
                continue
            if (WHOLE if inside else NAMED).search(value) or not inside and HEADED.search(value):
                return True
    return False


class Elements:
    """The open elements of a page: tag, dropped, inside an article, path. Each tag's places are at hand."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool, int]] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)

    def push(self, tag: str, dropped: bool, inside: bool, path: int) -> None:
        self.places[tag].append(len(self.stack))
        self.stack.append((tag, dropped, inside, path))

    def pop_to(self, n: int) -> None:
        while len(self.stack) > n:
            self.places[self.stack.pop()[0]].pop()

    def last(self, tags, stop=()) -> int:
        """The place of the innermost open element of ``tags``, or -1 if there is none inside those of ``stop``."""
        found, barrier = (max((p[-1] for t in names if (p := self.places.get(t))), default=-1) for names in (tags, stop))
        return found if found > barrier else -1

    def top(self) -> tuple[bool, bool, int]:
        return self.stack[-1][1:] if self.stack else (False, False, 0)


def parse(page: str) -> tuple[list[int], list[Block]]:
    """All tokens of a page in order, and the blocks of text that no boilerplate element holds. Linear in the page."""
    tokens: list[int] = []
    blocks: list[Block] = []
    elements = Elements()
    held: list[str] = []

    def flush() -> None:
        if held:
            text = BLANK.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                dropped, inside, path = elements.top()
                token = _token(path, text)
                tokens.append(token)
                if not dropped:
                    blocks.append(Block(text, token, inside, elements.last(HEADINGS) >= 0))

    for m in TOKEN.finditer(page):
        text, tag = m["text"], m["tag"]
        if text is not None:
            held.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        # text under an element that is dropped must not run on into its surroundings
        starts_block = tag in BLOCK
        if m["end"]:
            at = elements.last((tag,))
            if starts_block or at >= 0 and elements.stack[at][1]:
                flush()
            if at >= 0:
                elements.pop_to(at)
            continue
        dropped, inside, _ = elements.top()
        attributes = m["attributes"]
        drops = not dropped and _holds_boilerplate(tag, attributes, inside)
        if starts_block or drops:
            flush()
        if tag in INLINE_P and (at := elements.last(("p",), ("table", "td", "th", "div", "section", "article"))) >= 0:
            elements.pop_to(at)
        elif tag in CLOSED_BY and (at := elements.last(CLOSES[tag], ("ul", "ol", "dl", "table"))) >= 0:
            elements.pop_to(at)
        dropped, inside, path = elements.top()
        path = _token(path, tag)
        tokens.append(path)
        if tag == "br" or tag == "hr":
            held.append(" ")
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            elements.push(tag, dropped or drops, inside or tag in ARTICLE and not (dropped or drops), path)
    flush()
    return tokens, blocks


def valid_tokens(tokens: list[int], classes: dict[int, int]) -> set[int]:
    """Tokens of the template: of classes that are ordered on this page and nest with the larger ones."""
    places = defaultdict(list)
    for at, t in enumerate(tokens):
        if (c := classes.get(t)) is not None:
            places[c].append(at)
    found: set[int] = set()
    cuts: list[list[int]] = []
    for _, at in sorted(places.items(), key=lambda x: (-len({tokens[i] for i in x[1]}), x[1][0])):
        row = [tokens[i] for i in at]
        width = len(set(row))
        turns = [row[i : i + width] for i in range(0, len(row), width)]
        if any(turn != turns[0] for turn in turns):
            continue
        spans = [(at[i], at[min(i + width, len(at)) - 1]) for i in range(0, len(at), width)]
        if all(_nests(spans, cut) for cut in cuts):
            found.update(row)
            if len(spans) == 1:
                cuts.append(at)
    return found


def _nests(spans: list[tuple[int, int]], cut: list[int]) -> bool:
    """Whether each span lies in one gap of ``cut``, or holds all of it in one of its own gaps."""
    from bisect import bisect

    return all(bisect(cut, a) == bisect(cut, b) or a < cut[0] and cut[-1] < b for a, b in spans)


def main_text(page: str | None, classes: dict[int, int]) -> str:
    """The slots' text of a page, blocks parted by an empty line.

    In an article, a heading that the template repeats is kept where slots follow it: it is
    the title of a part of the text.
    """
    if not page:
        return ""
    tokens, blocks = parse(page)
    template = valid_tokens(tokens, classes) if classes else set()
    has_article = any(b.inside for b in blocks)
    text, titles = [], []
    for b in blocks:
        if b.inside < has_article:
            continue
        if b.token not in template:
            text += [*titles, b.text]
            titles = []
        else:
            titles = [*titles, b.text] if b.inside and b.heading else []
    return "\n\n".join(text)


def host_of(url: str) -> F.Column:
    """Lower-cased host of a URL; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens: array of (token, class)) from pages (host, html)."""

    def count(batches: Batches) -> Batches:
        for batch in batches:
            seen: dict[tuple[str, int | None], list[int]] = {}
            for host, content, page in zip(*[c.to_pylist() for c in batch.columns]):
                # the token None counts the pages of the host
                for token, n in [(None, 1), *Counter(parse(page)[0]).items()]:
                    body = b"%d %d" % (content, n)
                    mark = (zlib.crc32(body) << 31) ^ zlib.crc32(body[::-1])
                    held = seen.setdefault((host, token), [0, 0])
                    held[0] ^= mark
                    held[1] += 1
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([v[0] for v in seen.values()], pa.int64()),
                    pa.array([v[1] for v in seen.values()], pa.int64()),
                ],
                names=["host", "token", "vector", "n"],
            )

    # copies of a page are one page: they tell nothing of what the host's pages have in common
    distinct = pages.where("html <> ''").select("host", "html").distinct()
    parsed = distinct.select("host", F.xxhash64("html").alias("content"), "html").mapInArrow(
        count, "host string, token long, vector long, n long"
    )
    vectors = staged(parsed.groupBy("host", "token").agg(F.bit_xor("vector").alias("vector"), F.sum("n").alias("n")), "vectors")
    sizes = vectors.where("token IS NULL").select("host", F.col("n").alias("pages"))
    frequent = vectors.where(F.col("token").isNotNull() & (F.col("n") >= MIN_PAGES)).join(sizes, "host")
    frequent = frequent.where(F.col("n") >= MIN_SHARE * F.col("pages"))
    return frequent.groupBy("host").agg(F.collect_list(F.struct("token", F.xxhash64("vector", "n").alias("class"))).alias("tokens"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", most: int = MOST_TOKENS) -> DataFrame:
    """key, url, text and n_chars (code points) of every row of ``pages``.

    A null or empty page has empty text. Pages without a host are one host's. Equal rows
    are pages of their own. Unclosed and misnested elements end where a browser would end
    them, near enough. A page of any length is read once, in time that grows with it. An empty table gives no
    rows, other columns play no part. Templates of up to ``most`` tokens in all are broadcast, more are
    joined by host and salt, so that the pages of a large host are spread.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"), host_of(url).alias("host"))
    found = staged(templates(rows), "templates")
    if (found.agg(F.sum(F.size("tokens"))).first()[0] or 0) <= most:
        joined = rows.join(F.broadcast(found), "host", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = found.select("host", "tokens", salts.alias("salt"))
        spread = rows.withColumn("salt", F.pmod(F.xxhash64("key", "url", F.length("html")), F.lit(SALTS)).cast("int"))
        joined = spread.join(salted, ["host", "salt"], "left")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts, known = [], {}
            bodies, hosts, tokens = (batch.column(c) for c in ("html", "host", "tokens"))
            for n, (body, host) in enumerate(zip(bodies.to_pylist(), hosts.to_pylist())):
                if host not in known:
                    known[host] = {t["token"]: t["class"] for t in tokens[n].as_py() or ()}
                texts.append(main_text(body, known[host]))
            columns = [batch.column("key"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(map(len, texts), pa.int64())], names=[key, "url", "text", "n_chars"])

    kind = rows.schema["key"].dataType.simpleString()
    columns = joined.select("key", "url", "html", "host", "tokens")
    return columns.mapInArrow(run, f"`{key}` {kind}, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
