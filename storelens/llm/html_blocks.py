"""Text blocks of a web page, each with the zone that the markup puts it in."""

from __future__ import annotations

import html
import re

DROP, OTHER, MAIN = 0, 1, 2

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?:[!?][^>]*|(/?)([a-zA-Z][^\s/>]*)([^>]*))(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
NAME = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")

# Elements whose text is never shown, elements beside the article, and elements that
# do not break a line of text.
SILENT = {"script", "style", "template", "noscript", "iframe", "object", "svg", "math", "canvas", "textarea", "title"}
BESIDE = {"nav", "header", "footer", "aside", "form", "head", "select", "button", "menu", "dialog", "fieldset"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# closed by their like or by their parent's end
LOOSE = {"p", "li", "dt", "dd", "td", "th", "tr", "option", "tbody", "thead", "tfoot", "colgroup"}
# Parts of class names, ids and roles beside the article; a page's frame may carry the
# second kind, so an article inside it counts all the same.
NEVER = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promoted",
    "comment", "comments", "respond", "disqus", "cookie", "cookies", "consent", "newsletter", "subscribe",
    "popup", "modal", "alert", "notice", "notices", "share", "sharing", "social", "related", "recommended",
    "breadcrumb", "breadcrumbs", "pagination", "search", "login", "signup",
}
FRAME = {
    "nav", "navbar", "navigation", "menu", "sidebar", "header", "masthead", "banner", "footer", "contentinfo",
    "complementary", "toolbar", "widget", "widgets",
}
MAIN_ROLES = {"main", "article"}


def _zone(tag: str, attributes: str, above: tuple[int, bool]) -> tuple[int, bool]:
    """Zone of an element, and whether an article inside it can still count."""
    zone, open_to_main = above
    if tag in ("html", "body"):
        return zone, open_to_main
    names: set[str] = set()
    roles: set[str] = set()
    if attributes and "=" in attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            (roles if key.lower() == "role" else names).update(NAME.findall(value.lower()))
    if tag in BESIDE or (zone == DROP and not open_to_main):
        return DROP, False
    # a page has one main element, so its class says what page it is, not that it is beside the text
    if (names | roles) & NEVER and tag != "main":
        return DROP, False
    if tag in ("article", "main") or roles & MAIN_ROLES:
        return MAIN, True
    if (names | roles) & FRAME:
        return DROP, zone != MAIN
    return above


def blocks(page: str) -> list[tuple[str, int]]:
    """Blocks of text in page order, with white space as one space, and their zones; none is empty."""
    made: list[tuple[str, int]] = []
    stack: list[tuple[str, tuple[int, bool]]] = [("", (OTHER, True))]
    parts: list[str] = []
    at, end = 0, len(page)

    def close(zone: int) -> None:
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                made.append((text, zone))

    while at < end:
        token = TOKEN.search(page, at)
        if token is None:
            parts.append(page[at:])
            break
        if token.start() > at:
            parts.append(page[at : token.start()])
        at = token.end()
        tag = token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if token[1]:
            opened = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if tag not in INLINE or opened and stack[opened][1] != stack[opened - 1][1]:
                close(stack[-1][1][0])
            if opened:
                del stack[opened:]
            continue
        if tag in SILENT:
            if not token[3].endswith("/"):
                closing = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = closing.end() if closing else end
            continue
        zone = _zone(tag, token[3], stack[-1][1]) if "=" in token[3] or tag not in INLINE else stack[-1][1]
        if tag in INLINE and zone == stack[-1][1]:
            if any(name == tag for name, _ in stack):  # inside one that is beside the article: count it
                stack.append((tag, zone))
            continue
        close(stack[-1][1][0])
        if tag not in VOID and not token[3].endswith("/") and (tag not in LOOSE or zone != stack[-1][1]):
            stack.append((tag, zone))
    close(stack[-1][1][0])
    return made
