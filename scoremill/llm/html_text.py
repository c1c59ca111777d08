"""Main text of web pages as the maximum-scoring run of their tokens.

A page is words and tags. Words score positive and tags negative to begin with; pages whose markup names the
article label their own tokens, and every token class (a tag, or a word in a kind of container) gets the
logarithm of how much commoner it is inside the article than outside. One linear scan (Kadane) finds the
contiguous run of highest score; what is excluded within an article neither adds to the run nor breaks it. The run
says where the article is, not where it ends: a list in it scores like a menu. So it is extended to the article element
that holds it or, where there is none, to the least container that does, but for those parts of that container that are
mostly links. The words of the extended run outside excluded containers are the text.

A container is excluded by its element or role, or by a class or id whose parts all name what is not the article.
Forms, and names with such a part beside other words ("has-sidebar"), are excluded only outside an article, and
not if they wrap the page's article (``let_back``).
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoremill.llm.common import in_arrow, no_nulls

# Element names of the HTML standard, by what they do to the text around them.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = ("script", "style", "template", "textarea", "title", "noscript", "iframe", "svg", "math", "noembed",
       "noframes", "object", "canvas", "video", "audio", "xmp")
CONTAINERS = frozenset("html head body main article section div nav header footer aside form ul ol li dl table "
                       "figure blockquote select button fieldset dialog menu details center".split())
EXCLUDED = frozenset("head nav footer aside form select button dialog menu fieldset".split())
EXCLUDED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Parts of class and id names that mark what is not the article.
EXCLUDED_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                           "cookie cookies consent notice notices gdpr nav navbar navigation menu breadcrumb breadcrumbs "
                           "sidebar aside footer masthead comment comments commentlist disqus reply replies share sharing "
                           "social related newsletter subscribe subscription popup modal login signup search toolbar "
                           "pagination pager widget response responses discussion discussions feedback talkback".split())
# Parts of names that say nothing about the content by themselves.
NEUTRAL = frozenset("post posts entry user global top bottom left right inner outer primary secondary list links link "
                    "items item box block bar button buttons icons icon area section panel form header title".split())
KNOWN = CONTAINERS | INLINE | frozenset("p h1 h2 h3 h4 h5 h6 br hr pre img tr td th thead tbody tfoot caption figcaption dt "
                                        "dd address summary meta link input option picture source".split())
WORD, TAG, INLINE_TAG = 1.0, -0.75, -0.25
LEAST_SHARE = 0.02       # of a class's tokens, counted as seen on either side: no weight is beyond what that allows
LINKED = 0.5             # share of linked words from which a part of a container is a menu

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?(?:/>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_named = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_parts = re.compile(r"[a-z0-9]+")


VISIBLE, WEAK, STRONG = 0, 1, 2


def _exclusion(name: str, attributes: str, within_article: bool) -> int:
    """How a container is excluded; a weak exclusion ends where it would take the article."""
    if name == "form":
        return STRONG if within_article else WEAK
    if name in EXCLUDED or (name == "header" and not within_article):
        return STRONG
    if name in ("html", "body", "article", "main"):
        return VISIBLE
    found = VISIBLE
    for kind, *values in _named.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if kind.lower() == "role":
            if value.strip() in EXCLUDED_ROLES:
                return STRONG
            continue
        for one in value.split():
            parts = set(_parts.findall(one))
            if not EXCLUDED_NAMES.isdisjoint(parts):
                if parts <= EXCLUDED_NAMES | NEUTRAL:
                    return STRONG
                found = VISIBLE if within_article else WEAK
    return found


class _Container:
    """An open container: its place in the page, and the words in it, without what is excluded within."""
    __slots__ = ("name", "parent", "exclusion", "words")

    def __init__(self, name: str, parent: int, exclusion: int):
        self.name, self.parent, self.exclusion, self.words = name, parent, exclusion, 0


def let_back(containers: list[_Container]) -> None:
    """Ends the exclusion of what wraps the article; ``words`` are those directly in each container.

    The article is a <main>, or the largest <article>, if none of either is visible already. Its wrappers are let
    back in where their exclusion is weak, and strong ones if it is a <main> or has more words than all that is
    visible. Without one, a weakly excluded container is let back if it has more words than all that is visible
    without any, and within one that is let back, more than what is visible there.
    """
    hidden = []  # whether excluded by itself or what it is in
    for c in containers:
        hidden.append(c.exclusion != VISIBLE or (c.parent >= 0 and hidden[c.parent]))
    if not any(hidden):
        return
    for c in reversed(containers):
        if c.exclusion == VISIBLE and c.parent >= 0:
            containers[c.parent].words += c.words
    visible = containers[0].words

    def around(c: _Container) -> list[_Container]:
        out = []
        while c.parent >= 0:
            c = containers[c.parent]
            out.append(c)
        return out

    named = [i for i, c in enumerate(containers) if c.name in ("article", "main") and c.words]
    if named and all(hidden[i] for i in named):
        label = containers[max(named, key=lambda i: (containers[i].name == "main", containers[i].words))]
        for c in around(label):
            if c.exclusion == WEAK or label.name == "main" or label.words > visible:
                c.exclusion = VISIBLE
        return
    back = set()
    for c in sorted((c for c in containers if c.exclusion == WEAK), key=lambda c: -c.words):
        wrappers = around(c)
        if c.exclusion == WEAK and not any(w.exclusion == STRONG for w in wrappers) and c.words > max(
                (w.words for w in wrappers if w in back), default=visible):
            for w in wrappers:
                w.words += c.words
            for w in (c, *wrappers):
                if w.exclusion == WEAK:
                    w.exclusion = VISIBLE
                    back.add(w)


class _Token(NamedTuple):
    """A run of words or a tag: its class, text, container, whether in an article, and whether in a link."""
    name: str
    text: str | None
    container: int
    inside: bool
    linked: bool


def parsed(page: str) -> tuple[list[_Container], list[bool], list[_Token]]:
    """The page's containers, which of them are excluded, and its tokens in order."""
    containers = [_Container("body", -1, VISIBLE)]  # the page itself, then each container as it opens
    seen: list[_Token] = []
    at: list[int] = [0]
    articles, linked = 0, False
    for found in _token.finditer(page):
        text = found["text"]
        if text is not None:
            containers[at[-1]].words += _count(text)
            seen.append(_Token("", text, at[-1], articles > 0, linked))
            continue
        name = found["name"]
        if name is None:
            if found["raw"] or found.lastgroup is None:
                seen.append(_Token("tag-hidden", None, at[-1], articles > 0, linked))
            continue
        name, closing = name.lower(), bool(found["close"])
        if name == "a" or name in CONTAINERS:
            linked = name == "a" and not closing
        if closing and name in CONTAINERS:
            if any(containers[i].name == name for i in at[1:]):
                while True:
                    last = containers[at.pop()].name
                    articles -= last == "article"
                    if last == name:
                        break
        inside = articles > 0
        if not closing and name in CONTAINERS and not found["attributes"].rstrip().endswith("/"):
            if name == "li" and containers[at[-1]].name == "li":
                at.pop()
            containers.append(_Container(name, at[-1], _exclusion(name, found["attributes"], inside)))
            at.append(len(containers) - 1)
            articles += name == "article"
        seen.append(_Token(f"tag-{name if name in KNOWN else 'other'}", None, at[-1], inside, linked))
    let_back(containers)
    excluded: list[bool] = []
    for c in containers:
        excluded.append(c.exclusion != VISIBLE or (c.parent >= 0 and excluded[c.parent]))
    return containers, excluded, [t if t.text is None else t._replace(
        name="word-excluded" if excluded[t.container] else f"word-{containers[t.container].name}") for t in seen]


def _count(text: str | None) -> int:
    return 1 if text is None else len((entities.unescape(text) if "&" in text else text).split())


def class_counts(page: str) -> dict[str, list[int]]:
    """How many tokens of each class lie inside and outside the article; empty without just one."""
    seen, articles = Counter(), 0
    for name, text, _, inside, _ in parsed(page)[2]:
        seen[name, inside] += _count(text)
        articles += name == "tag-article" and not inside
    if articles not in (1, 2) or not any(inside for _, inside in seen):  # it opens, and may be closed
        return {}
    return {n: [seen[n, True], seen[n, False]] for n, _ in seen}


def _prior(name: str) -> float:
    if name.startswith("word-"):
        return WORD
    return INLINE_TAG if name == "tag-hidden" or name[4:] in INLINE else TAG


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """A class's prior score, moved by its log-odds of lying inside the labelled articles."""
    out = {}
    for name, (inside, outside) in counts.items():
        if name == "word-excluded":
            continue
        seen = LEAST_SHARE * (inside + outside) + 1
        out[name] = _prior(name) + math.log((inside + seen) / (outside + seen))
    return out


def learned(pages: DataFrame) -> dict[str, float]:
    """Weights from every page that labels its article. There are at most a few hundred classes."""
    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        total: dict[str, list[int]] = {}
        for page in batch.column("html").to_pylist():
            for name, (inside, outside) in class_counts(page).items():
                sums = total.setdefault(name, [0, 0])
                sums[0] += inside
                sums[1] += outside
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([a for a, _ in total.values()], pa.int64()),
             pa.array([b for _, b in total.values()], pa.int64())], ["name", "inside", "outside"])
    rows = (in_arrow(pages.select(no_nulls("html").alias("html")), each, "name string, inside bigint, outside bigint")
            .groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect())
    return weights({r["name"]: (r["inside"], r["outside"]) for r in rows})


def best_run(excluded: list[bool], seen: list[_Token], scores: dict[str, float]) -> tuple[int, int]:
    """Where the contiguous run of highest score begins and ends."""
    best, run, total, begin = 0.0, (0, 0), 0.0, 0
    for i, t in enumerate(seen):
        score = scores.get(t.name, _prior(t.name)) if not excluded[t.container] else 0.0 if t.inside else INLINE_TAG
        if total <= 0:
            total, begin = 0.0, i
        total += score * (_count(t.text) if t.text is not None else 1)
        if total > best:
            best, run = total, (begin, i + 1)
    return run


def holder(containers: list[_Container], inside: set[int]) -> int:
    """The outermost article round the least container that holds all of ``inside``, or that container."""
    def path(i: int) -> list[int]:
        out = [i]
        while containers[i].parent >= 0:
            i = containers[i].parent
            out.append(i)
        return out[::-1]

    paths = [path(i) for i in inside]
    common = 0
    while all(len(p) > common and p[common] == paths[0][common] for p in paths):
        common += 1
    least = paths[0][:common]
    return next((i for i in least if containers[i].name == "article"), least[-1])


def extended(containers: list[_Container], excluded: list[bool], seen: list[_Token], run: tuple[int, int]) -> list[_Token]:
    """The tokens of the run and of the container that holds it, but for its parts that are mostly links."""
    low, high = run
    inside = {t.container for t in seen[low:high] if t.text is not None and not excluded[t.container] and t.text.strip()}
    if not inside:
        return []
    whole = holder(containers, inside)
    if containers[whole].name in ("body", "html"):
        return seen[low:high]
    part = [-1] * len(containers)  # the container directly in ``whole`` that holds each one; ``whole`` for itself
    part[whole] = whole
    for i, c in enumerate(containers):
        if i != whole and c.parent >= 0 and part[c.parent] >= 0:
            part[i] = i if c.parent == whole else part[c.parent]
    menus: set[int] = set()
    if containers[whole].name != "article":
        words, linked = Counter(), Counter()
        for t in seen:
            if t.text is not None and part[t.container] not in (-1, whole) and not excluded[t.container]:
                words[part[t.container]] += _count(t.text)
                linked[part[t.container]] += _count(t.text) * t.linked
        menus = {p for p, n in words.items() if linked[p] > LINKED * n}
    return [t for i, t in enumerate(seen) if low <= i < high or (part[t.container] >= 0 and part[t.container] not in menus)]


def main_text(page: str, scores: dict[str, float]) -> str:
    """The text of the best run, extended: blocks in page order, white space in them made one space."""
    containers, excluded, seen = parsed(page)
    blocks, block = [], []
    for t in extended(containers, excluded, seen, best_run(excluded, seen, scores)):
        if t.text is not None:
            if not excluded[t.container]:
                block.append(entities.unescape(t.text))
        elif t.name[4:] not in INLINE and t.name != "tag-hidden":
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    return " ".join(" ".join(b.split()) for b in blocks if b.strip())


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", scores: dict[str, float] | None = None) -> DataFrame:
    """One row a page: ``page_id, url, text, n_chars`` (code points).

    Null or empty html, and pages without words in a positive run, give an empty text. Pages are read
    whole. Rows that repeat are answered one by one; no rows give no rows; other columns are not read.
    """
    narrow = pages.select(F.col(key).alias("page_id"), "url", no_nulls(html).alias("html"))
    scores = learned(narrow) if scores is None else scores

    def each(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        texts = [main_text(page, scores) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    kinds = dict(narrow.dtypes)
    return in_arrow(narrow, each, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")


# For the pages of the tables, whose article is one element without others in it that are left out.
ORACLE_SQL = r"""
SELECT page_id, url, text, length(text) AS n_chars FROM (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
    '</?(a|b|em|i|span|strong)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g'),
    '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM pages)
"""
