"""Main text of web pages: the maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score positive and tags negative; a
linear scan finds the contiguous run with the highest sum, which is the content.
Weights are learned from labelled pages: pages whose own markup names the content
(``article`` or ``main``). A tag's weight is its log odds of being inside the content
(never above ``TAG_MOST``, which is also what tags score in parts
that are not content); a word's weight depends on the block it stands in (the tag and
class of its innermost block) and is the log odds of that block (never below
``WORD_LEAST``). Weights are fitted on at most ``MAX_LABELLED`` pages, lowest hash of the
id first; every page is scored.

Inside the run, text of blocks that are not content (navigation, forms, adverts,
comments and the like, by tag, role, or a class name or id that names such a part) is left
out. The outermost ``article`` or ``main`` is content also in a part marked by class or id,
unless it is so marked itself, or another one stands in no such part.

Where the page itself names its content, that is the region, whole: nothing in it has a
negative score, so the run reaches from its first word to its last, and what stands between two
such regions scores nothing and is left out. Elsewhere link words have a weight of their own (menus are
links), and elements that no labelled page shows have the weight of their prior.

Tags are read as browsers read them: a quote counts after ``=`` only, and a tag that never ends
takes the rest of the page. Reading is linear in the page, however broken.

Defined cases: null or empty html has no text; a page cut off anywhere is read as far
as it goes; unclosed and stray tags are tolerated; repeated rows and null ids are
answered row by row; extra columns are not read; without labelled pages the priors in
``PRIOR`` decide.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import lowest, small_batches

MAX_LABELLED = 2000
TAG_MOST, WORD_LEAST = -0.05, 0.001

# Fixed lists: HTML elements by role, and class words of what is not content.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "select")
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
          "strike strong sub sup time tt u var wbr "
                    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mspace").split())
VOID = "area base br col embed hr img input link meta param source track wbr".split()
CHROME_TAGS = ("nav header footer aside form button dialog menu fieldset "
               "script style textarea title noscript template iframe svg object select head").split()
CHROME_WORDS = ("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                "cookie cookies consent disclaimer disqus footer form header login masthead menu modal nav navbar "
                "navigation newsletter notice notices notification pagination pager popup promo promoted promotion "
                "related reply replies respond share sharing sidebar signup skip social sponsor sponsored "
                "subscribe subscription toolbar warning widget").split()
CHROME_ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu")
CONTENT_TAGS = ("article", "main")
# Fixed lists: a class name of several words ("ad-slot") names a part that is not content by its last
# word, or by its first if that is one of STRONG_WORDS; not after a word of NEGATED, nor before one of LAYOUT.
STRONG_WORDS = ("ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies "
                "disqus footer menu nav navbar navigation newsletter pagination promo reply replies sidebar sponsor sponsored "
                "subscribe subscription").split()
NEGATED = "has no not with without hide hidden show is".split()
LAYOUT = "layout page".split()
#: Pseudo-counts (inside, outside) added to what labelled pages show. ``a``: words in links.
PRIOR = {"p": (8, 1), "a": (1, 3), "div": (2, 1), "section": (2, 1),
         **dict.fromkeys("h1 h2 h3 h4 h5 h6 blockquote pre br figure figcaption details summary dl dt dd".split(), (4, 1)),
         **dict.fromkeys("ul ol li table caption thead tbody tfoot tr td th hr address center".split(), (2, 1))}
#: What elements score that neither labelled pages nor the priors know.
UNKNOWN_TAG = -0.25

# Every alternative that can start ends, by the end of the page at the latest, so nothing is scanned twice.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
                   r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)|([^<]++|<)", re.DOTALL)
#: Every attribute in turn, so that nothing is found inside a name or a value.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]++)))?")
CLASS_WORD = re.compile(r"[a-z]+")
#: Character references by number: leading zeros, and digits beyond any character, are not read.
LONG_NUMBER = re.compile(r"&#(?:(x)0*([0-9a-f]{1,8})[0-9a-f]*+|0*([0-9]{1,8})[0-9]*+)", re.IGNORECASE)
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
             "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
BLOCK_ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
                   "p pre section table ul".split())


class Token:
    """A tag (name, closing or not) or a piece of text; ``block``: the block it stands in;
    ``chrome``: inside what is not content; ``inside``: within the labelled content;
    ``wrapped``: which stands in a part marked by class."""

    __slots__ = ("name", "closing", "text", "block", "chrome", "inside", "wrapped")

    def __init__(self, name: str, closing: bool, text: str, block: str, chrome: bool, inside: bool, wrapped: bool):
        self.name, self.closing, self.text, self.block, self.chrome = name, closing, text, block, chrome
        self.inside, self.wrapped = inside, wrapped

    @property
    def key(self) -> str:
        return ("/" if self.closing else "") + self.name


def names_chrome(name: str) -> bool:
    """Whether a class name or id (lower case) names a part that is not content."""
    if name in CHROME_WORDS:
        return True
    parts = CLASS_WORD.findall(name)
    if len(parts) < 2 or parts[0] in NEGATED or parts[-1] in LAYOUT:
        return False
    return parts[-1] in CHROME_WORDS or parts[0] in STRONG_WORDS


def _describe(name: str, attributes: str) -> tuple[str, bool, bool]:
    """The block name (tag with class words), whether its tag or role is not content, and
    whether a class name or id says so."""
    chrome, words, names = name in CHROME_TAGS, [], []
    if attributes:
        for kind, a, b, c in ATTRIBUTE.findall(attributes):
            kind, value = kind.lower(), (a or b or c).lower()
            if kind == "role":
                chrome = chrome or value in CHROME_ROLES
            elif kind in ("class", "id"):
                words += CLASS_WORD.findall(value)
                names += value.split()
    marked = [w for w in words if w in CHROME_WORDS]
    return ".".join([name, *sorted(set(marked))]), chrome, any(map(names_chrome, names))


class _Open:
    """An open element: its innermost block, whether it lies in non-content (by tag or
    role; by class) or labelled content (``wrapped``: that in a part marked by class), and
    whether it is a p or inline tags within one."""

    __slots__ = ("name", "block", "by_tag", "by_class", "inside", "wrapped", "in_p")

    def __init__(self, name: str, block: str, by_tag: bool, by_class: bool, inside: bool, wrapped: bool, in_p: bool):
        self.name, self.block, self.by_tag, self.by_class = name, block, by_tag, by_class
        self.inside, self.wrapped, self.in_p = inside, wrapped, in_p

    @property
    def chrome(self) -> bool:
        return self.by_tag or self.by_class


def tokens(page: str | None) -> Iterator[Token]:
    page = page or ""
    stack, names, at = [_Open("", "", False, False, False, False, False)], Counter(), 0

    def close() -> None:
        names[stack.pop().name] -= 1

    while m := TOKEN.match(page, at):
        at = m.end()
        text, top = m[4], stack[-1]
        if text is not None:
            yield Token("", False, text, top.block, top.chrome, top.inside, top.wrapped)
            continue
        closing, name, attributes = m[1], m[2], m[3]
        if name is None:
            continue  # a comment or declaration
        name = name.lower()
        if closing:
            if names[name] > 0:
                while stack[-1].name != name:
                    close()
                chrome = stack[-1].chrome
                close()
            else:
                chrome = top.chrome
            top = stack[-1]
            yield Token(name, True, "", top.block, chrome, top.inside, top.wrapped)
            continue
        while stack[-1].name in CLOSED_BY.get(name, ()) or stack[-1].in_p and name in BLOCK_ENDS_P:
            close()
        top = stack[-1]
        block, by_tag, marked = _describe(name, attributes)
        by_tag = by_tag or top.by_tag
        if name in CONTENT_TAGS:
            by_class = top.by_class and (top.inside or marked)
        else:
            by_class = top.by_class or marked and name not in ("body", "html")
        chrome = by_tag or by_class
        wrapped = top.wrapped if top.inside else name in CONTENT_TAGS and top.by_class
        yield Token(name, False, "", top.block, chrome, top.inside, top.wrapped)
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        names[name] += 1
        inline = name in INLINE
        stack.append(_Open(name, top.block if inline and not chrome and name != "a" else block, by_tag, by_class,
                           top.inside or name in CONTENT_TAGS, wrapped, name == "p" or inline and top.in_p))


def count_features(page: str | None) -> Counter:
    """(feature, inside) -> times, on a labelled page: tags once each, words by block.
    Parts that are not content by their tag or class teach nothing about the others."""
    found: Counter = Counter()
    for t in tokens(page):
        if t.chrome:
            continue
        if t.name:
            found[f"t:{t.key}", t.inside] += 1
        elif n := len(t.text.split()):
            found[f"w:{t.block}", t.inside] += n
    return found


class Weights:
    def __init__(self, counts: dict[str, tuple[float, float]]):
        for name, (a, b) in PRIOR.items():
            for key in (f"t:{name}", f"t:/{name}", f"w:{name}"):
                c, d = counts.get(key, (0, 0))
                counts[key] = (c + a, d + b)
        odds = {k: log((a + 0.5) / (b + 0.5)) for k, (a, b) in counts.items()}
        self.tags = {k[2:]: min(v, TAG_MOST) for k, v in odds.items() if k.startswith("t:")}
        self.words = {k[2:]: max(v, WORD_LEAST) for k, v in odds.items() if k.startswith("w:")}

    def score(self, t: Token) -> float:
        if not t.name:
            n = len(t.text.split())
            return n * (WORD_LEAST if t.chrome else self.words.get(t.block, 0.5)) if n else 0.0
        if t.chrome or t.name in INLINE:
            return min(TAG_MOST, self.tags.get(t.key, TAG_MOST))
        return self.tags.get(t.key, UNKNOWN_TAG)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the contiguous run with the highest sum (the first, shortest such)."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def named_region(parts: list[Token]) -> list[bool] | None:
    """Which tokens stand in the content that the page names itself; None if it names none with
    words. Content in a part marked by class counts if there is no other."""
    for also_wrapped in (False, True):
        region = [t.inside and not t.chrome and (also_wrapped or not t.wrapped) for t in parts]
        if any(r and t.text.strip() for r, t in zip(region, parts, strict=True)):
            return region
    return None


def decode(text: str) -> str:
    return html.unescape(LONG_NUMBER.sub(r"&#\1\2\3", text)) if "&" in text else text


def main_text(page: str | None, weights: Weights) -> str:
    parts = list(tokens(page))
    region = named_region(parts)
    if region is None:
        lo, hi = best_run([weights.score(t) for t in parts])
    else:
        lo, hi = best_run([weights.score(t) if r and not t.name else 0.0 for t, r in zip(parts, region, strict=True)])
    blocks, now = [], []
    for i in range(lo, hi):
        t = parts[i]
        if not t.name:
            if not t.chrome and (region is None or region[i]):
                now.append(t.text)
        elif t.name == "br":
            now.append("\n")
        elif t.name not in INLINE:
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    return " ".join(clean for b in blocks if (clean := " ".join(decode(b).split())))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for page in batch.column("html"):
            total.update(count_features(page.as_py()))
        if total:
            names, inside = zip(*total, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(inside), pa.array(list(total.values()), pa.int64())], ["feature", "inside", "n"])


def learn_weights(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> Weights:
    labelled = pages.filter(F.col("html").rlike(r"(?i)<(?:article|main)[\s>]")).select("page_id", "html")
    sample = lowest(labelled, F.xxhash64("page_id", "html"), max_labelled).select("html")
    # Features are tags and fixed class words, so their number is bounded by the sample's markup.
    rows = (sample.mapInArrow(_features, "feature string, inside boolean, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("b")).collect())
    return Weights({r["feature"]: (r["a"], r["b"]) for r in rows})


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    small_batches(pages.sparkSession)
    weights = pages.sparkSession.sparkContext.broadcast(learn_weights(pages))

    @F.arrow_udf("string")
    def text_of(page: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), weights.value) for p in page], pa.string())

    found = pages.select("page_id", "url", text_of("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
