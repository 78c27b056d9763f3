"""Main text of web pages as the maximum-scoring run of words and tags.

A page is a sequence of tags and words. Tags cost and words earn, each by a
weight learned from labelled pages: the log-odds of lying inside the content,
for a tag by its name, for a word by the element around it. A linear scan finds
the contiguous run with the highest sum; its text, without boilerplate elements
nested in it, is the main text.

Labelled pages are a bounded sample of pages that mark their content themselves
(exactly one ``article`` or ``main`` element). The learned weights serve pages
with and without such marks.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import ship

SAMPLE = 2_000

#: Elements of HTML by their role.
UNSEEN = frozenset("script style noscript template svg math iframe object embed canvas audio video head title".split())
BOILERPLATE = frozenset("nav aside footer form button select textarea dialog menu".split())
INLINE = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = ("article", "main")
#: Words of class, id and role attributes that name boilerplate.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement advertising alert announcement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
    "footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related "
    "reply replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|math|textarea|title)\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)>"
    r"|<[!?][^>]*>|[^<]+|<",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)


class Token(NamedTuple):
    """A tag (``text`` None) or a stretch of text, with the element it stands in and whether that is boilerplate."""

    name: str
    text: str | None
    within: str
    dropped: bool
    opens: bool


#: Elements whose class says something about the page or their own part of the content, not about boilerplate.
_WHOLE = frozenset(("html", "body", *CONTENT))
_TITLED = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())


def _element(name: str, rest: str, in_content: bool) -> tuple[str, bool]:
    """The element as a feature (its name and telling class words), and whether it is boilerplate by name.

    Inside the content, and on headings, a header is the title's and not the site's.
    """
    words = {w for found in _NAMES.findall(rest) for w in re.split(r"[^a-z0-9]+", "".join(found).lower()) if w}
    telling = set() if name in _WHOLE else words & BOILERPLATE_NAMES
    if in_content or name in _TITLED:
        telling -= {"header"}
    telling = sorted(telling)
    return ".".join([name, *telling]), name in BOILERPLATE or bool(telling)


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page in order; comments, scripts, styles and other unseen elements are left out."""
    out: list[Token] = []
    stack: list[tuple[str, str, bool]] = []  # name, feature of the nearest telling element, boilerplate
    in_content = 0
    for m in _TOKEN.finditer(page):
        name = m["name"]
        within, dropped = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        if name is None:
            text = m[0]
            if m["raw"] is None and not text.startswith(("<!", "<?")):
                out.append(Token("", text, within, dropped, False))
            continue
        name = name.lower()
        if m["close"]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if depth >= 0:
                in_content -= sum(s[0] in CONTENT for s in stack[depth:])
                del stack[depth:]
                within, dropped = (stack[-1][1], stack[-1][2]) if stack else ("", False)
            out.append(Token(name, None, within, dropped, False))
            continue
        if name in _CLOSES_P:
            open_p = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE), -1)
            if open_p >= 0 and stack[open_p][0] == "p":
                del stack[open_p:]
                within, dropped = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        feature, boilerplate = _element(name, m["rest"], in_content > 0)
        # A header inside the content holds its title; elsewhere it belongs to the site.
        boilerplate |= name == "header" and not in_content or name in UNSEEN
        out.append(Token(feature, None, within, dropped or boilerplate, True))
        if name not in VOID and not m["rest"].rstrip().endswith("/"):
            own = feature if name not in INLINE or not within else within
            if dropped and not boilerplate:
                own = within
            stack.append((name, own, dropped or boilerplate))
            in_content += name in CONTENT
    return out


def _units(found: list[Token]):
    """(feature, count) of each token as the model sees it."""
    for t in found:
        if t.text is None:
            yield ("tag:" + t.name if t.opens else "end:" + t.name), 1
        else:
            yield ("in:" + t.within), len(t.text.split())


def content_span(found: list[Token]) -> tuple[int, int] | None:
    """The marked content of a labelled page as a range of tokens; None where it isn't marked exactly once."""
    for name in CONTENT:
        starts = [k for k, t in enumerate(found) if t.text is None and t.opens and t.name.split(".")[0] == name]
        ends = [k for k, t in enumerate(found) if t.text is None and not t.opens and t.name == name]
        if len(starts) == 1 and len(ends) == 1 and starts[0] < ends[0]:
            return starts[0] + 1, ends[0]
    return None


class Weights(NamedTuple):
    """Weight of each feature, and the weights of words and tags that no labelled page showed."""

    known: dict[str, float]
    word: float
    tag: float

    def of(self, feature: str, dropped: bool) -> float:
        if feature in self.known:
            return self.known[feature]
        if feature.startswith("in:"):
            return -self.word if dropped else self.word
        return self.tag


def learn(counts: dict[str, tuple[int, int]]) -> Weights:
    """Weights from the counts (inside, outside) of each feature: words earn and tags cost by their log-odds."""
    inside, outside = (max(1, sum(c[k] for f, c in counts.items() if f.startswith("in:"))) for k in (0, 1))
    known = {}
    for feature, (a, b) in counts.items():
        odds = math.log((a + 0.5) / (inside + 1)) - math.log((b + 0.5) / (outside + 1))
        if feature.startswith("in:"):
            known[feature] = max(-4.0, min(4.0, odds))
        else:
            # A tag never earns; tags that are rare inside the content cost most.
            known[feature] = -max(0.05, min(4.0, -odds if b else 0.05))
    return Weights(known, 1.0, -0.5)


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the highest sum as a half-open range; the first and shortest of equals, empty if none is positive."""
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, best_range = total, (start, k + 1)
    return best_range


def main_text(page: str | None, weights: Weights) -> str:
    """The text of the best run: references decoded, white space made single spaces, blocks joined by one."""
    found = tokens(page or "")
    # Boilerplate inside an article must not cut it in two, so its words add up by the logarithm of their number only.
    size = lambda t, n: math.log1p(n) if t.dropped and t.text is not None else n
    start, end = best_run([size(t, n) * weights.of(f, t.dropped) for t, (f, n) in zip(found, _units(found))])
    parts = []
    for t in found[start:end]:
        if t.text is None:
            if t.name.split(".")[0] not in INLINE:
                parts.append(" ")
        elif not t.dropped:
            parts.append(entities.unescape(t.text))
    return " ".join("".join(parts).split())


def fit(pages: DataFrame, sample: int = SAMPLE, page_id: str = "page_id", html: str = "html") -> Weights:
    """Weights from about ``sample`` pages at most, chosen by a hash of their ids among those that mark their content.

    Only the counts of features reach the driver: element names and telling class words, few by nature.
    """
    ship(pages.sparkSession)

    @F.arrow_udf("array<struct<feature:string,inside:long,outside:long>>")
    def counted(column: pa.Array) -> pa.Array:
        rows = []
        for page in column.to_pylist():
            found = tokens(page or "")
            span = content_span(found)
            inside, outside = Counter(), Counter()
            if span:
                for k, (feature, n) in enumerate(_units(found)):
                    (inside if span[0] <= k < span[1] else outside)[feature] += n
            rows.append([{"feature": f, "inside": inside[f], "outside": outside[f]} for f in {**inside, **outside}])
        return pa.array(rows, pa.list_(pa.struct([("feature", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])))

    marked = pages.filter(F.col(html).rlike("(?i)<(article|main)[ >]") & F.col(page_id).isNotNull())
    n = marked.count()
    share = int((1 << 30) * min(1.0, sample / max(n, 1))) + 1
    chosen = marked.filter(F.pmod(F.xxhash64(page_id), F.lit(1 << 30)) < share)
    rows = (
        chosen.select(F.inline(counted(F.col(html)))).groupBy("feature")
        .agg(F.sum("inside").alias("a"), F.sum("outside").alias("b")).collect()
    )
    return learn({r["feature"]: (r["a"], r["b"]) for r in rows})


def text_column(weights: Weights, html: str | Column) -> Column:
    @F.arrow_udf("string")
    def of_pages(column: pa.Array) -> pa.Array:
        return pa.array([main_text(page, weights) for page in column.to_pylist()], pa.string())

    return of_pages(html)


def extract(pages: DataFrame, sample: int = SAMPLE, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """All columns of the pages with ``text``, the main text, and ``n_chars``, its code points; columns of those names are replaced.

    A null or empty page, and one without content, gives an empty text. Where no
    page marks its content, every word earns and every tag costs the same.
    Repeated rows are kept; an empty table gives an empty result.
    """
    weights = fit(pages, sample, page_id, html)
    return pages.withColumn("text", text_column(weights, F.col(html))).withColumn("n_chars", F.length("text").cast("long"))
