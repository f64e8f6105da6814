"""Extractor registry (X1): the one plug-in point.

A source is a name, a URL predicate, a per-URL row limit and an extractor
``DataFrame[page_id, url, html] -> DataFrame[listings]``. HTML card sources
need only a selector config (``functions.cards.CardSource``). Routing takes
the first source whose predicate holds, in registration order, else the
fallback source -- the reference's substring routing for its three sites.

The card extractor is also offered as a Python UDTF for SQL ``LATERAL`` use:
``SELECT p.page_id, c.* FROM pages p, LATERAL extract_cards(p.html, 'C') c``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cards as C


@dataclass
class Source:
    name: str
    matches: Callable[[Column], Column] | None   # URL -> boolean column; None for the fallback
    limit: int
    extract: Callable[[DataFrame], DataFrame]


class Registry:
    def __init__(self):
        self._sources: list[Source] = []
        self._fallback: Source | None = None

    def register(self, source: Source, fallback: bool = False) -> "Registry":
        if fallback:
            self._fallback = source
        else:
            self._sources.append(source)
        return self

    def register_cards(self, config: C.CardSource, url_part: str, limit: int) -> "Registry":
        """A new HTML card site from selectors alone."""
        from ..operators import extract as X

        return self.register(Source(config.name, lambda u: u.contains(url_part), limit,
                                    lambda pages: X.extract_html_source(pages, config)))

    def sources(self) -> list[Source]:
        return self._sources + ([self._fallback] if self._fallback else [])

    def source_of(self, url: Column) -> Column:
        expr = None
        for s in self._sources:
            expr = F.when(s.matches(url), F.lit(s.name)) if expr is None else expr.when(s.matches(url), s.name)
        fb = F.lit(self._fallback.name if self._fallback else None)
        return fb if expr is None else expr.otherwise(fb)

    def limit_of(self, source: Column) -> Column:
        expr = None
        for s in self.sources():
            expr = F.when(source == s.name, s.limit) if expr is None else expr.when(source == s.name, s.limit)
        return expr

    def max_limit(self) -> int:
        return max(s.limit for s in self.sources())

    def extract(self, routed: DataFrame) -> DataFrame:
        """``routed``: pages with a ``source`` column (and any key columns,
        passed through to every listing). One filtered branch per source, then
        a union by name; the source name lands in ``route``."""
        from ..operators import extract as X

        keys = [c for c in routed.columns if c not in ("page_id", "url", "html", "source")]
        parts = [s.extract(routed.where(F.col("source") == s.name).select("page_id", "url", "html", *keys)
                           .withColumn("route", F.lit(s.name))).drop("source")
                 for s in self.sources()]
        return X.unify(*parts).drop("source")


def default_registry() -> Registry:
    """The reference's three sites: B and C by URL substring, A for the rest."""
    from ..operators import extract as X
    from ..operators.routing import DEFAULT_LIMIT, SOURCE_B_HOST, SOURCE_C_HOST, SOURCE_C_LIMIT

    r = Registry()
    r.register_cards(C.SOURCE_B, SOURCE_B_HOST, DEFAULT_LIMIT)
    r.register_cards(C.SOURCE_C, SOURCE_C_HOST, SOURCE_C_LIMIT)
    r.register(Source("A", None, DEFAULT_LIMIT, X.extract_source_a), fallback=True)
    return r


def register_card_udtf(spark: SparkSession, name: str = "extract_cards"):
    """Register the card extractor as a SQL table function:
    ``extract_cards(html, source)`` -> rows of (pos, href, title, company,
    tags, error) for source 'B' or 'C'. Rows travel in Arrow batches; a page that fails as a whole gives one row with its error (E16)."""
    from pyspark.sql.functions import udtf

    configs = {"B": C.SOURCE_B, "C": C.SOURCE_C}

    @udtf(returnType="pos int, href string, title string, company string, tags array<string>, error string", useArrow=True)
    class ExtractCards:
        def eval(self, html: str, source: str):
            if html is None or source not in configs:
                return
            try:
                yield from C.extract_cards(html, configs[source])
            except Exception as e:
                yield None, None, None, None, None, f"{type(e).__name__}: {e}"

    spark.udtf.register(name, ExtractCards)
    return ExtractCards


def lateral_cards(pages: DataFrame, source: str, name: str = "extract_cards") -> DataFrame:
    """X1 in SQL: the listings of ``pages`` (page_id, url, html) of one card source, the table function joined laterally."""
    from ..operators import extract as X

    register_card_udtf(pages.sparkSession, name)
    rows = pages.sparkSession.sql(
        f"""select p.page_id, p.url, c.pos, c.href, c.title as raw_title, c.company, c.tags as tag_list, c.error, 'card' as kind, :source as source
            from {{pages}} p, lateral {name}(p.html, :source) c""", args={"source": source}, pages=pages)
    return X.html_card_listings(rows)
