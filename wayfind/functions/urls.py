"""URLs as columns: result links, post ids, eligibility, request addresses. No Python runs on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The engine's host and request parameters, and the path rules of each site.
ENGINE = "https://www.google.com"
ENGINE_HOST = "google.com"
REQUEST = {"hl": "vi", "gl": "vn", "pws": "0", "filter": "0", "num": "10"}
TIME_TOKENS = {"past_hour": "qdr:h", "past_24_hours": "qdr:d", "past_week": "qdr:w", "past_month": "qdr:m"}
FACEBOOK_DENIED = ["/events/", "/marketplace/", "/album/", "/albums/", "/media/", "/picture.php", "/login/", "/share/", "/checkpoint/", "/photo/", "/photos/"]
FACEBOOK_ALLOWED = ["/posts/", "/pfbid", "/reel/", "/watch/", "/hashtag/", "/search/"]
OTHER_SITES = {
    "instagram": (["instagram.com", "ig"], ["/explore/", "/stories/", "/accounts/"], ["/p/", "/reel/", "/tv/"]),
    "x": (["x.com", "twitter"], ["/explore", "/search"], ["/status/"]),
    "tiktok": (["tiktok.com", "tiktok", "tt"], ["/tag/", "/discover", "/search"], ["/video/"]),
    "threads": (["threads.com", "threads.net", "threads"], ["/search", "/explore"], ["/post/"]),
}

ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def parts(url: Column) -> Column:
    """A URL and its host, protocol, path and query, to be parsed once and read often; all but the URL are null if it cannot be parsed."""
    part = lambda name: F.try_parse_url(url, F.lit(name))
    return F.struct(url.alias("url"), part("HOST").alias("host"), part("PROTOCOL").alias("protocol"), part("PATH").alias("path"), part("QUERY").alias("query"))


def param(own: Column, name: str) -> Column:
    """A decoded query parameter of parts(); null if absent or blank."""
    raw = F.regexp_extract(own["query"], f"(?:^|&){name}=([^&]*)", 1)
    value = F.coalesce(F.try_url_decode(raw), raw)
    return F.when(value != "", value)


def absolute(raw: Column) -> Column:
    """A result link as a full URL: relative ones are of the engine; null if blank."""
    full = F.when(raw.rlike(ABSOLUTE), raw).when(raw.startswith("//"), F.concat(F.lit("https:"), raw)).when(raw.startswith("/"), F.concat(F.lit(ENGINE), raw)).otherwise(F.concat(F.lit(ENGINE + "/"), raw))
    return F.when(raw != "", full)


def unwrapped(own: Column) -> Column:
    """P27 from the parts() of an absolute link: the engine's redirects opened, its other pages and other protocols null, fragments dropped (not from opened targets)."""
    target = F.coalesce(param(own, "q"), param(own, "url"))
    opened = F.when(target.rlike(ABSOLUTE) & F.try_parse_url(target, F.lit("HOST")).isNotNull(), target)
    plain = F.when(F.lower(own["protocol"]).isin("http", "https") & own["host"].isNotNull(), F.regexp_replace(own["url"], "#.*$", ""))
    engine = own["host"].endswith(ENGINE_HOST)
    return F.when(engine & (own["path"] == "/url"), opened).when(~engine, plain)


def unwrap(raw: Column) -> Column:
    """The target of a result link."""
    return unwrapped(parts(absolute(raw)))


def post_id(url: Column, site: Column) -> Column:
    """The id of a post in a URL of the site; null if it has none or cannot be parsed. The host is not checked."""
    return post_id_of(parts(url), site)


def post_id_of(own: Column, site: Column) -> Column:
    """P28 from the parts() of a URL."""
    path = own["path"]
    cut = lambda pattern, group: F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))
    numbers = F.filter(F.split(path, "/"), lambda s: s.rlike("^[0-9]{10,}$"))
    facebook = F.coalesce(param(own, "story_fbid"), param(own, "v"), param(own, "fbid"), cut("(pfbid[a-zA-Z0-9]+)", 1), F.try_element_at(numbers, F.lit(-1)))
    found = F.when(site == "facebook.com", facebook).when(site == "instagram.com", cut("/(p|reel|tv)/([^/?]+)", 2)).when(site == "x.com", cut("/status/([0-9]+)", 1)).when(site == "tiktok.com", cut("/video/([0-9]+)", 1)).when(site.isin("threads.com", "threads.net"), cut("/post/([^/?]+)", 1))
    return F.when(own["host"].isNotNull(), found)


def _any(text: Column, needles: list[str]) -> Column:
    return F.greatest(*(text.contains(n) for n in needles), F.lit(False))


def eligible(url: Column, site: Column) -> Column:
    """Whether a URL may be a post of the site: denied paths first, then allowed ones; an unknown site allows all, an unparsable URL is taken whole as a path."""
    return eligible_of(parts(url), site)


def eligible_of(own: Column, site: Column) -> Column:
    """P29 from the parts() of a URL."""
    url, known = own["url"], own["host"].isNotNull()
    path = F.lower(F.when(known, F.coalesce(F.nullif(own["path"], F.lit("")), F.lit("/"))).otherwise(url))
    query = F.lower(F.when(known, F.coalesce(own["query"], F.lit(""))).otherwise(F.lit("")))
    has = lambda needle: path.contains(needle)
    story = query.contains("story_fbid=")
    denied = _any(path, FACEBOOK_DENIED) | (has("/story.php") & query.contains("fbid=")) | (has("/permalink.php") & query.contains("fbid=") & ~story) | query.contains("set=a.")
    allowed = _any(path, FACEBOOK_ALLOWED) | (has("/groups/") & has("/permalink/")) | ((has("/story.php") | has("/permalink.php")) & url.contains("story_fbid"))
    out = F.when(site.isin("facebook.com", "fb"), ~denied & allowed)
    for names, no, yes in OTHER_SITES.values():
        ok = ~_any(path, no) & _any(path, yes)
        out = out.when(site.isin(names), ok & ~path.isin("/reels/", "/reels") if "ig" in names else ok)
    return out.otherwise(True)


def request_url(query: Column, start: Column, time_filter: Column) -> Column:
    """The engine's address of a result page."""
    fixed = "".join(f"&{k}={v}" for k, v in REQUEST.items())
    token = F.try_element_at(F.create_map(*(x for k, v in TIME_TOKENS.items() for x in (F.lit(k), F.lit(v)))), time_filter)
    return F.concat(F.lit(f"{ENGINE}/search?q="), F.url_encode(query), F.lit(f"{fixed}&start="), start.cast("string"), F.coalesce(F.concat(F.lit("&tbs="), F.url_encode(token)), F.lit("")))
