"""Listing cards from HTML by selectors.

A card source is a config: where the cards live (optional scope element),
which element is a card, and which elements inside it hold the title, the
company and the tags. The extractor is one function for every such source.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from .htmltree import Node, parse

Pred = "callable[[Node], bool]"


def tag_class_contains(tag: str, part: str):
    return lambda n: n.tag == tag and any(part in c for c in n.classes())


def tag_class(tag: str, cls: str):
    return lambda n: n.tag == tag and cls in n.classes()


def tag_is(tag: str):
    return lambda n: n.tag == tag


def attr_eq(name: str, value: str, tag: str | None = None):
    return lambda n: (tag is None or n.tag == tag) and n.attrs.get(name) == value


def id_is(value: str):
    return lambda n: n.attrs.get("id") == value


@dataclass
class CardSource:
    name: str
    card: object                       # predicate for the card element
    title: object
    company: object
    tags: object
    scope: object | None = None        # first element holding the cards; absent -> no cards
    tags_within: object | None = None  # first element inside the card holding the tags
    default_title: str = "Unknown"
    default_company: str = "Unknown"
    max_tags: int | None = None
    extra: dict = field(default_factory=dict)


def extract_cards(html: str, src: CardSource):
    """Yield ``(position, href, title, company, tag_list, error)`` per card.

    Element text is every text piece stripped and joined without separator.
    A card that fails gives a row with ``error`` set and the rest empty."""
    root = parse(html)
    scope = root
    if src.scope is not None:
        scope = root.find(src.scope)
        if scope is None:
            return
    for i, card in enumerate(n for n in scope.iter() if src.card(n)):
        try:
            href = card.attrs.get("href")
            t = card.find(src.title)
            title = t.get_text(strip=True) if t is not None else src.default_title
            c = card.find(src.company)
            company = c.get_text(strip=True) if c is not None else src.default_company
            holder = card
            if src.tags_within is not None:
                holder = card.find(src.tags_within)
            tags = [x.get_text(strip=True) for x in holder.find_all(src.tags)] if holder is not None else []
            if src.max_tags is not None:
                tags = tags[: src.max_tags]
            yield i, href, title, company, tags, None
        except Exception as e:  # one bad card never stops the page
            yield i, None, None, None, None, f"{type(e).__name__}: {e}"


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (card selectors of sources B
# and C).
SOURCE_B = CardSource(
    name="B",
    card=tag_class_contains("a", "posting-list-item"),
    title=tag_class("h3", "posting-title__position"),
    company=tag_class("h4", "company-name"),
    tags=tag_class("span", "posting-tag"),
    tags_within=tag_is("nfj-posting-item-tiles"),
    default_title="Unknown Title",
    default_company="Unknown",
    max_tags=5,
)

def _of_linked_card(n: Node) -> bool:
    if not SOURCE_B.title(n):
        return False
    card = n.parent
    while card is not None and card.tag != "a":
        card = card.parent
    if card is None or "href" not in card.attrs:
        raise ValueError("card without a link")
    return True


# Source B for a reader that refuses cards without a link (they become rejects, E15).
LINKED_B = replace(SOURCE_B, name="B", title=_of_linked_card)

SOURCE_C = CardSource(
    name="C",
    scope=id_is("main-offers-listing"),
    card=attr_eq("data-test", "list-item-offer", tag="a"),
    title=id_is("offer-title"),
    company=attr_eq("data-test", "text-employerName"),
    tags=attr_eq("data-test", "chip-expectedTechnology"),
    default_title="Unknown",
    default_company="Unknown",
)
