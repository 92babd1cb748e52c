"""URL expressions: link extraction, normalisation, validation, dates and hashes."""

from __future__ import annotations

import html as html_entities
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



class UrlRules(NamedTuple):
    """What makes a URL an article.

    `marker_site` pages are articles when the path holds `marker` exactly once
    and the `suffix`; with `marker_decides` a marker page failing that test is
    rejected at once, otherwise the dated rule still gets its turn.
    """

    external: tuple[str, ...]
    domains: tuple[str, ...]
    nav_parts: tuple[str, ...]
    nav_endings: tuple[str, ...]
    marker_site: str
    marker: str
    suffix: str
    marker_decides: bool
    dated_names: tuple[str, ...]
    dated_pattern: str
    longer_than: int


# URL rules.
STRICT_RULES = UrlRules(
    external=(
        "facebook.com", "twitter.com", "wa.me", "linkedin.com",
        "t.co", "bit.ly", "tinyurl.com", "mailto:", "javascript:",
        "instagram.com", "pinterest.com", "reddit.com",
    ),
    domains=(
        "ivpressonline.com", "calexicochronicle.com",
        "holtvilletribune.com", "thedesertreview.com",
    ),
    nav_parts=(
        "/users/", "/login", "/signup", "/search", "/category/",
        "/tag/", "/author/", "/page/", "/feed", "/rss", "/xml",
        "/quicknews/", "/waterandpower/", "/weather/", "/sports/", "/opinion/",
        "/obituaries/", "/classifieds/", "/subscribe", "/contact",
        "/about", "/advertising", "/staff", "/submit", "/e-edition",
    ),
    nav_endings=(
        "/news/", "/news", "/local/", "/local", "/education", "/county", "/border/", "/crime",
    ),
    marker_site="ivpressonline.com",
    marker="article_",
    suffix=".html",
    marker_decides=True,
    dated_names=("chronicle", "tribune", "desert"),
    dated_pattern=r"/20\d{2}/\d{2}/\d{2}/",
    longer_than=40,
)

DATED_RULES = STRICT_RULES._replace(
    external=("facebook.com", "twitter.com", "wa.me", "linkedin.com"),
    domains=("ivpressonline.com", "calexicochronicle.com", "holtvilletribune.com"),
    nav_parts=(
        "/users/", "/login", "/signup", "/search", "/category/",
        "/tag/", "/author/", "/page/", "/feed", "/rss",
    ),
    nav_endings=(),
    marker_decides=False,
    dated_names=("chronicle", "tribune"),
)

ARTICLE_PARTS = ("article_", ".html")
REPLAY_PREFIX = "https://web.archive.org/web/"
# End of fixed values.

_HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b.*?(?:</\1\s*>|\z)"
# A quote opens a value only right after `=`; anywhere else it is part of a name or of a bare value.
_ATTRIBUTE = r"""(?<=["'\s/])[^\s/>][^\s/=>]*+(?:\s*+=++\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^>\s]*+))?+"""
_LINK_TAG = rf"""(?i)<a(?=[\s/])((?:[\s/]*+{_ATTRIBUTE})*+[\s/]*+)>"""


@F.pandas_udf(T.StringType())
def _unescape(value: pd.Series) -> pd.Series:
    return value.map(html_entities.unescape, na_action="ignore")


# Keeps Spark from pushing filters below the function and calling it twice.
_unescape_once = _unescape.asNondeterministic()


def hrefs(html: Column) -> Column:
    """`href` values of all `<a>` tags in document order, as written."""
    visible = F.regexp_replace(html, _HIDDEN, "")
    tags = F.regexp_extract_all(visible, F.lit(_LINK_TAG), F.lit(1))

    def href(tag: Column) -> Column:
        attributes = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(0))
        named = F.filter(attributes, lambda a: a.rlike(r"(?i)^href\s*(=|$)"))
        value = F.regexp_extract(F.try_element_at(named, F.lit(-1)), r"(?s)^[^=]*=+\s*(.*)$", 1)
        return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")

    return F.filter(F.transform(tags, href), lambda h: h.isNotNull())


def decode_entities(value: Column) -> Column:
    """Character references decoded; only values with `&` leave the JVM."""
    return F.coalesce(_unescape_once(F.when(value.contains("&"), value)), value)


def absolutize(href: Column, base: Column) -> Column:
    """Site-relative hrefs get the base, absolute ones stay, others give NULL."""
    return F.when(href.startswith("/"), F.concat(base, href)).when(href.startswith("http"), href)


def unwrap_replay(href: Column, domain: str) -> Column:
    """The original URL inside an archive replay link of `domain`, else the href."""
    inner = F.regexp_extract(href, r"""/web/[0-9]+/(https?://[^"']+)""", 1)
    wrapped = href.contains("/web/") & href.contains(domain) & (inner != "")
    return F.when(wrapped, inner).otherwise(href)


def with_scheme(href: Column) -> Column:
    """`https://` in front of links that are not absolute yet."""
    return F.when(href.startswith("http"), href).otherwise(
        F.concat(F.lit("https://"), F.regexp_replace(href, "^/+", ""))
    )


def quoted(word: str) -> str:
    """A regex for exactly `word`."""
    return r"\Q" + word + r"\E"


def matches_any(text: Column, patterns: list[str]) -> Column:
    """True where any of the patterns occurs; an empty list occurs nowhere."""
    return text.rlike("|".join(patterns)) if patterns else F.lit(False)


def is_article(url: Column, rules: UrlRules = STRICT_RULES) -> Column:
    """True where the URL is an article page under `rules`."""
    u = F.lower(url)
    off_limits = [quoted(w) for w in rules.external + rules.nav_parts]
    off_limits += [quoted(w) + r"(?:\$|\z)" for w in rules.nav_endings]
    in_scope = ~matches_any(u, off_limits) & matches_any(u, list(map(quoted, rules.domains)))
    has_marker = u.contains(rules.marker_site) & u.contains(rules.marker) & u.contains(rules.suffix)
    single = u.contains("/" + rules.marker) & (F.regexp_count(u, F.lit(quoted(rules.marker))) == 1)
    dated = (
        matches_any(u, list(map(quoted, rules.dated_names)))
        & u.rlike("(?U)" + rules.dated_pattern)
        & (F.length(url) > rules.longer_than)
    )
    if rules.marker_decides:
        shaped = F.when(has_marker, single).otherwise(dated)
    else:
        shaped = (has_marker & single) | dated
    return in_scope & shaped


def is_marked_article(url: Column, domain: str | None = None) -> Column:
    """The loose test: marker and suffix (and domain) occur anywhere."""
    marked = url.contains(ARTICLE_PARTS[0]) & url.contains(ARTICLE_PARTS[1])
    return marked if domain is None else marked & url.contains(domain)


def url_date(url: Column) -> Column:
    """Date of the first `/YYYY/MM/DD/` in the URL; NULL if absent or no such day."""
    digits = F.regexp_extract(url, r"/(\d{4}/\d{2}/\d{2})/", 1)
    day = F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyy/MM/dd")).cast("date")
    return F.when(F.substring(digits, 1, 4) != "0000", day)


def url_hash(url: Column) -> Column:
    return F.md5(url.cast("binary"))


def replay_url(timestamp: Column, url: Column) -> Column:
    """Archive replay address of one capture."""
    return F.concat(F.lit(REPLAY_PREFIX), timestamp, F.lit("/"), url)


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://([^/?#]+)", 1)


def base_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)
