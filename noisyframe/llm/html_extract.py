"""Main text of web pages by two-pass block rules.

A page falls into blocks at its block-level tags and line breaks stay inside one.
First pass, each block by itself:

* boilerplate if it lies in a navigation, footer, side or similar element, in one whose
  class, id or role says so, in a page header, or is hidden;
* boilerplate if most of it is link text;
* content if it is long and dense in stop words, or long enough to be prose at all
  (``PROSE_CHARS``) and hardly linked;
* else ambiguous: short, of middling density, or in a language whose stop words
  aren't known.

What a wrapper's class, id or tag says ends at an article or main element inside it, as
``<div class="page with-sidebar"><main>`` is no side bar; only what is hidden or a menu,
footer or side element by its tag or role stays so.  A class says something by
one of its names as a whole (``sidebar``), by a name that ends with a word of the list
(``site-footer``) or starts with one before a word for a part (``sidebar-left``), but not
where a negation, ``has`` or ``with`` makes it a property of the page (``no-sidebar``), nor
where a word of the text's own structure (``content``, ``article``, ``post``) stands beside it
in the same attribute.  A form outside of any article that holds one, or ``PROSE_CHARS`` of
long blocks, wraps the page and says nothing; other forms are boilerplate.

Second pass: ambiguous blocks inherit the label of their nearest decided
neighbours.  If both agree, that label; if not, the nearer one's, and at equal
distance boilerplate.  The border of an article (or main) element parts neighbours;
blocks in one take content at equal distance, and are content if that
element has no decided block.  On a page where nothing is decided as content, the longest run
of neighbouring unlinked ambiguous blocks outside any boilerplate is it, from
``SHORT_CHARS`` on.  What an article holds in a side or similar
element is no neighbour of its text.

Character references are decoded, white space in a block becomes one space, blocks
are joined by one space in page order.  Nothing is capped.

A limit of the method: outside of any article, an undecided paragraph right beside boilerplate
takes its label, as at equal distance.

Defined cases: null or empty html gives an empty text.  Broken markup: unclosed
elements end with their parent, unmatched end tags are ignored, a tag that the end
of the page cuts off is dropped.  Every row of pages gives a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

# Element names, class words and stop words.
BREAKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul""".split())
SKIPPED = frozenset("""script style title noscript template textarea select option datalist button svg iframe object
canvas audio video""".split())
NOT_CONTENT = frozenset("nav footer aside menu dialog".split())
FIELDS = frozenset("input button label select textarea fieldset legend".split())
ARTICLE = frozenset("article main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
BAD_WORDS = frozenset("""ad ads advert adverts advertisement advertisements adsense banner sponsor sponsored promo
promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice popup
modal overlay newsletter subscribe signup share sharing social related recommended recommendations comment comments
respond disqus widget toolbar pagination pager login masthead""".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
PAGE_WORDS = frozenset("has no not with without hide hides show shows is".split())
PART_WORDS = frozenset("""area bar block bottom box button buttons card column container element form head icons inner
item items label left link links list menu message nav outer panel right section text title top unit widget wrap wrapper
""".split())
TEXT_WORDS = frozenset("content article post entry story main page single wrapper container layout body text".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from or an they which you were
her she will would there their we him been has when who more no if out so said what up its about into than them can
der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie
nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man
de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la les ou avec son lui nous
comme mais on sa cette ces aux elle leur ont ses été
de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya
entre cuando todo esta ser son dos también fue había era muy años hasta desde""".split())
LINK_DENSITY = 0.5
SHORT_CHARS, LONG_CHARS, PROSE_CHARS = 70, 200, 400
DENSE, THIN = 0.30, 0.10

_TAIL = re.compile(r"<[!/?a-zA-Z][^<>]*\Z")
_SPLIT = re.compile(r"[^a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CONTENT, BOILERPLATE, AMBIGUOUS = 1, 0, -1
MAYBE, SURE = 1, 2


class _Blocks(HTMLParser):
    """Blocks of a page: [text, link characters, boilerplate by its element, article number]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool, int]] = []
        # tag, skipped, boilerplate (SURE or only by its class), article, form
        self.open: list[tuple[str, bool, int, int, int]] = [("", False, 0, 0, 0)]
        self.form_of: list[int] = []        # of each block
        self.forms, self.wrappers = 0, set()
        self.parts: list[str] = []
        self.link, self.linked, self.articles = False, 0, 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, _, bad, article, form = self.open[-1]
                self.blocks.append((text, self.linked, bool(bad), 0 if bad else article))
                self.form_of.append(form)
            self.parts = []
        self.link, self.linked = False, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BREAKS:
            self.flush()
        if tag == "a":
            self.link = True
        if tag in VOID or tag == "p" and not attrs:
            return
        _, skipped, bad, article, form = self.open[-1]
        # a page header is boilerplate, an article's is not; a form in an article is
        if tag in NOT_CONTENT or tag == "header" and not article or tag == "form" and article:
            bad = SURE
        elif tag == "form":
            self.forms += 1
            form = self.forms
        if attrs and tag not in ("html", "body"):
            bad = max(bad, _says_boilerplate(dict(attrs), article, tag))
        if tag in ARTICLE and bad != SURE:
            self.articles += 1
            self.wrappers.add(form)
            article, bad, form = self.articles, 0, 0
        if tag in BREAKS or tag in SKIPPED or tag in FIELDS or bad != self.open[-1][2]:
            if bad != self.open[-1][2]:
                self.flush()
            # what labels a field of a form is no text
            self.open.append((tag, skipped or tag in SKIPPED or tag in FIELDS, bad, article, form))

    def handle_endtag(self, tag: str) -> None:
        if tag in BREAKS:
            self.flush()
        if tag == "a":
            self.link = False
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                if self.open[i][2] != self.open[i - 1][2]:
                    self.flush()
                del self.open[i:]
                return
            if tag == "p" and self.open[i][0] in BREAKS:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def whole(self) -> list[tuple[str, int, bool, int]]:
        """The blocks, those of forms that don't wrap the page marked as boilerplate."""
        prose: dict[int, int] = {}
        for (text, linked, bad, _), form in zip(self.blocks, self.form_of, strict=True):
            if not bad and len(text) >= LONG_CHARS and linked <= THIN * len(text):
                prose[form] = prose.get(form, 0) + len(text)
        open_ = self.wrappers | {0} | {f for f, n in prose.items() if n >= PROSE_CHARS}
        return [b if form in open_ else (*b[:2], True, 0) for b, form in zip(self.blocks, self.form_of, strict=True)]

    def handle_data(self, data: str) -> None:
        if not self.open[-1][1]:
            self.parts.append(data)
            if self.link:
                self.linked += len(data)


def _says_boilerplate(attrs: dict, article: int, tag: str) -> int:
    """SURE where the element is hidden or says so by its role, MAYBE by its class or id."""
    if "hidden" in attrs or (attrs.get("role") or "").lower() in BAD_ROLES or (
            attrs.get("aria-hidden") or "").lower() == "true" or _HIDDEN.search(attrs.get("style") or ""):
        return SURE
    if tag in ARTICLE or tag == "form":
        return 0
    names = [[w for w in _SPLIT.split(name) if w] for name in
             f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()]
    if any(TEXT_WORDS & set(words) and not BAD_WORDS & set(words) for words in names):
        return 0
    listed = BAD_WORDS if article else BAD_WORDS | HEADER_WORDS
    for words in names:
        if words and words[0] not in PAGE_WORDS and (words[-1] in listed or words[0] in listed and set(words[1:]) <= PART_WORDS):
            return MAYBE
    return 0


def _stop_density(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(block: tuple[str, int, bool, int]) -> int:
    text, linked, bad, article = block
    if bad or linked > LINK_DENSITY * len(text):
        return BOILERPLATE
    if len(text) < SHORT_CHARS:
        return BOILERPLATE if not article and "©" in text else AMBIGUOUS
    density = _stop_density(text)
    if density >= DENSE and len(text) >= LONG_CHARS or density >= THIN and article:
        return CONTENT
    if len(text) >= PROSE_CHARS and linked <= THIN * len(text):
        return CONTENT
    return AMBIGUOUS


def longest_run(blocks: list[tuple[str, int, bool, int]], labels: list[int]) -> list[int]:
    """Places of the longest run of ambiguous, hardly linked blocks, if it has enough characters."""
    best, size, run, held = [], SHORT_CHARS - 1, [], 0
    for i, (text, linked, _, _) in enumerate([*blocks, ("", 0, True, 0)]):
        if i < len(blocks) and labels[i] == AMBIGUOUS and linked <= THIN * len(text) and "©" not in text:
            run, held = [*run, i], held + len(text)
        elif run:
            if held > size:
                best, size = run, held
            run, held = [], 0
    return best


def second_pass(labels: list[int], articles: list[int]) -> list[int]:
    """Ambiguous blocks take the label of their nearest decided neighbours."""
    n = len(labels)
    before, after = [None] * n, [None] * n
    for order, found in ((range(n), before), (range(n - 1, -1, -1), after)):
        nearest: dict[int, int] = {}        # by article; 0 for the blocks outside of any
        for i in order:
            found[i] = nearest.get(articles[i])
            if labels[i] != AMBIGUOUS:
                nearest[articles[i]] = i
    out = list(labels)
    for i in range(n):
        if labels[i] == AMBIGUOUS:
            near = [k for k in (before[i], after[i]) if k is not None]
            default = CONTENT if articles[i] else BOILERPLATE
            if not near:
                out[i] = default
            elif len(near) == 1 or labels[near[0]] == labels[near[1]]:
                out[i] = labels[near[0]]
            elif i - near[0] == near[1] - i:
                out[i] = default
            else:
                out[i] = labels[min(near, key=lambda k: abs(k - i))]
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Blocks()
    page.feed(_TAIL.sub("", html))
    page.close()
    page.flush()
    blocks = page.whole()
    first = [first_pass(b) for b in blocks]
    labels = second_pass(first, [b[3] for b in blocks])
    if CONTENT not in labels:
        for i in longest_run(blocks, first):
            labels[i] = CONTENT
    return " ".join(b[0] for b, label in zip(blocks, labels, strict=True) if label == CONTENT)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
                        ).mapInArrow(run, "page_id long, url string, text string, n_chars long")


QUERY = "op10_html_extract"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
