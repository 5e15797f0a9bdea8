"""A page as a row of text blocks, with the tags between them.

Reads markup the way browsers do as far as blocks need it: raw text of scripts and styles is skipped to its
end tag, quoted attributes may hold ``>``, paragraphs and list items end where the next begins, end tags
close what was left open inside.  Every step goes forward in the page, so time grows with its length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Names of HTML.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr br input rp rt ruby".split()
)
#: Elements that never hold main text.
APART = frozenset(
    "nav header footer aside form menu dialog button select noscript template svg math object canvas audio "
    "video map fieldset datalist".split()
)
SECTIONS = APART | frozenset("article main section ul ol dl table figure blockquote address".split())
#: Start tags that end an open element of the given names, unless one of the last ones is in between.
ENDED_BY_NEXT = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Parts of class, id and role names that sites give to what is not main text.
BOILERPLATE_NAMES = frozenset(
    "ad ads adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline "
    "comment comments commentlist complementary consent contentinfo cookie cookies copyright disclaimer "
    "discussion disqus feedback footer form gdpr header legal login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pager pagination paywall popup promo promotion "
    "recommended related replies reply respond search share sharebar sharing sidebar sidebars signup "
    "skip social sponsor sponsored subscribe subscription teaser teasers toolbar trending widget widgets".split()
)
CONTENT_NAMES = frozenset("article articlebody body content entry main maintext post prose story text".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_HOLDERS = re.compile(r"<(article|main)[\s>]", re.IGNORECASE)
_RAW_ENDS = {tag: re.compile(f"</{tag}", re.IGNORECASE) for tag in RAW}
_NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z0-9]+")
_HUMPS = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Class names that speak of a page's layout, not of the element.
_STATES = ("has", "with", "without", "no", "is", "not", "js", "wp")


@dataclass
class Block:
    text: str
    words: int
    features: tuple[str, ...]
    apart: bool
    labelled: bool
    before: list[str] = field(default_factory=list)
    within: list[str] = field(default_factory=list)


@dataclass
class _Level:
    tag: str
    features: tuple[str, ...]
    #: 2 for good, 1 until an article or main element begins inside.
    apart: int
    labelled: bool
    in_article: bool
    #: Elements opened in this one, by tag and attributes: most repeat.
    inner: dict[tuple[str, str], _Level] = field(default_factory=dict)


def _names(attributes: str) -> set[str]:
    found = set()
    for groups in _NAMES.findall(attributes):
        for token in "".join(groups).split():
            parts = [p for p in _PARTS.split(_HUMPS.sub("-", token).lower()) if p]
            if parts and parts[0] not in _STATES:
                found.update(parts)
    return found


def _size_feature(words: int) -> str:
    for most in (2, 5, 10, 20, 40):
        if words <= most:
            return f"words:{most}"
    return "words:more"


class _Reader:
    def __init__(self, page: str):
        self.page = page
        opened = [tag.lower() for tag in _HOLDERS.findall(page)]
        holders = [tag for tag in ("article", "main") if opened.count(tag) == 1]
        #: The element that tells main text on pages that say so: the only one of its kind.
        self.holder = holders[0] if holders else None
        self.stack = [_Level("", (), 0, False, False)]
        self.blocks: list[Block] = []
        self.tags: list[str] = []
        self.before: list[str] = []
        self.runs: list[str] = []
        self.linked = self.plain = 0
        self.in_link = False

    def end_block(self) -> None:
        if not self.runs:
            if self.tags:
                self.before += self.tags
                self.tags = []
            return
        text = " ".join("".join(self.runs).split())
        if text:
            level, words = self.stack[-1], text.count(" ") + 1
            # A block counts as linked if most of its characters are.
            kind = f"tag:{level.tag}{'+a' if self.linked > self.plain else ''}"
            ends = ("ends:sentence",) if text[-1] in ".!?…。！？:;\"'”’»)" else ()
            self.blocks.append(
                Block(text, words, (*level.features, kind, _size_feature(words), *ends), level.apart > 0,
                      level.labelled and not level.apart, self.before, self.tags)
            )
            self.before = []
        else:
            self.before += self.tags
        self.tags, self.runs, self.linked, self.plain = [], [], 0, 0

    def text(self, raw: str) -> None:
        run = unescape(raw) if "&" in raw else raw
        self.runs.append(run)
        size = len(run) - run.count(" ")
        if self.in_link:
            self.linked += size
        else:
            self.plain += size

    def push(self, tag: str, attributes: str) -> None:
        above = self.stack[-1]
        level = above.inner.get((tag, attributes))
        if level is None:
            level = above.inner[tag, attributes] = self.inner(above, tag, attributes)
        self.stack.append(level)

    def inner(self, above: _Level, tag: str, attributes: str) -> _Level:
        names = _names(attributes) if attributes and tag not in ("body", "html") else set()
        named = bool(names & BOILERPLATE_NAMES) and tag != "main" and not names & {"main", "articlebody"}
        apart = 2 if tag in APART and tag != "form" else int(named or tag == "form")
        outer = above.features
        if tag == self.holder and not named:
            # What a form or a name around main text says does not count.
            apart, outer = (2, outer) if above.apart == 2 else (0, ())
        else:
            if tag == "article" and above.in_article:
                apart = 2  # an article in an article is a comment or a teaser
            apart = max(apart, above.apart)
        own = [f"in:{tag}"] if tag in SECTIONS else []
        own += [f"name:{name}" for name in sorted(names)]
        features = outer + tuple(f for f in own if f not in outer)
        in_article = above.in_article or tag == "article"
        return _Level(tag, features, apart, above.labelled or tag == self.holder, in_article)

    def pop_to(self, tags: set[str], unless: set[str]) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag in tags:
                del self.stack[at:]
                return
            if self.stack[at].tag in unless:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.runs.append(" ")
        elif tag == "a":
            self.in_link = True
        if tag in INLINE:
            self.tags.append(tag)
            return
        self.end_block()
        self.before.append(tag)
        if self.stack[-1].tag == "p":
            del self.stack[-1]
        if tag in ENDED_BY_NEXT:
            self.pop_to(*ENDED_BY_NEXT[tag])
        # Depth beyond any sane page is not followed, so that a level's work stays small.
        if tag not in VOID and len(self.stack) < 512:
            self.in_link = False
            self.push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in INLINE:
            self.tags.append("/" + tag)
            return
        self.end_block()
        self.before.append("/" + tag)
        self.pop_to({tag}, set())

    def read(self) -> list[Block]:
        page, at, tag_form = self.page, 0, _TAG
        while True:
            opened = page.find("<", at)
            if opened < 0:
                self.text(page[at:])
                break
            if opened > at:
                self.text(page[at:opened])
            following = page[opened + 1 : opened + 2]
            if following in ("!", "?"):
                if page.startswith("<!--", opened):
                    ended = page.find("-->", opened + 2)
                    at = len(page) if ended < 0 else ended + 3
                else:
                    ended = page.find(">", opened)
                    at = len(page) if ended < 0 else ended + 1
                continue
            match = tag_form.match(page, opened)
            if match is None and (following.isalpha() or following == "/") and following:
                if tag_form is _TAG and _PLAIN_TAG.match(page, opened):
                    tag_form = _PLAIN_TAG  # a quote without its end: quotes are not trusted from here on
                    match = tag_form.match(page, opened)
                if match is None:
                    if page.find(">", opened) < 0 and (following.isalpha() or following == "/"):
                        break  # a tag cut off with the page
                    if following == "/":
                        at = page.find(">", opened) + 1
                        continue
            if match is None:
                self.text("<")
                at = opened + 1
                continue
            at, tag = match.end(), match[2].lower()
            if match[1]:
                self.end(tag)
            else:
                self.start(tag, match[3])
                if tag in RAW:
                    ended = _RAW_ENDS[tag].search(page, at)
                    at = ended.start() if ended else len(page)
        self.end_block()
        return self.blocks


def read_blocks(page: str) -> tuple[list[Block], list[str], str | None]:
    """The blocks of a page, the tags behind the last one, and the element that holds main text, if one does."""
    reader = _Reader(page)
    return reader.read(), reader.before, reader.holder
