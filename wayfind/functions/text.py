"""Query text as columns: terms, groups, budgets, ad signals, masking."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Site aliases, exclusions in a site's queries, word lists and patterns that results depend on.
SITE_ALIASES = {"facebook": "facebook.com", "fb": "facebook.com", "instagram": "instagram.com", "ig": "instagram.com", "twitter": "x.com", "x": "x.com", "tiktok": "tiktok.com", "tt": "tiktok.com", "threads": "threads.com", "th": "threads.com"}
SITE_EXCLUSIONS = {
    "facebook.com": ["-inurl:photo", "-inurl:photos"],
    "instagram.com": ["-inurl:explore", "-inurl:stories", "-inurl:accounts"],
    "tiktok.com": ["-inurl:tag", "-inurl:discover", "-inurl:search", "-site:shop.tiktok.com"],
}
NEGATIVES = ["combo", "booking", "hotline", "liên hệ", "zalo", "sđt", "inbox", "ib", "tour", "báo giá"]
NEGATIVES_BY_SITE = {"tiktok.com": ["combo", "booking", "hotline", "liên hệ", "zalo", "sđt", "inbox", "tour", "báo giá"]}
NOISY_ALIASES = ["Bà Nà Hills", "Vinpearl Nha Trang", "thác Datanla", "Landmark 81"]
LEGACY_SITES = ["facebook.com", "instagram.com", "tiktok.com"]
LEGACY_INTENT = "du lịch"
ALIASES_BY_TIER = {"A": 4, "B": 3, "C": 2}
PHRASES_REVIEW = ["kinh nghiệm", "trải nghiệm", "vừa đi", "đáng đi", "lịch trình"]
PHRASES_QUESTION = ["cho mình hỏi", "có nên"]
PHRASES_EXTENDED = ["đánh giá", "chia sẻ", "tư vấn", "ăn gì", "chuyến đi"]
WORD_BUDGET = 32
#: An ASCII word boundary; the JVM's \b takes all letters for word characters.
B = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
AD_LETTERS = r"[\x{1D400}-\x{1D7FF}]"
#: The first bytes of all these letters in UTF-8.
AD_LETTERS_START = bytes([0xF0, 0x9D])
AD_PRICE = rf"[0-9]{{2,}}\s?(k|tr|đ|vnđ|vnd|nghìn|triệu|ngàn){B}"
AD_PHONE = r"0(?<![0-9]0)[0-9]{8,10}(?![0-9])"
AD_TERMS = ["voucher", "combo", "khuyến mãi", "khuyến mại", "inbox", "booking", "đặt phòng", "đặt tour", "liên hệ", "ưu đãi", "giảm giá", "đặt ngay", "pass phòng", "còn phòng", "nhận đặt", "hotline", "giá rẻ", "zalo", "sđt", "báo giá"]
#: Parts that several of these terms share, none of them ASCII.
AD_PARTS = ["đặt", "giá", "phòng", "khuyến m"]
AD_BOUNDED = {"deal": rf"{B}deal{B}", "sale": rf"{B}sale{B}", "ib": rf"ib{B}"}
SAFE_LABEL = r"(?i)^[a-z][a-z0-9_-]{0,63}$"

#: White space at the ends of terms, beyond the blank: a set of characters, and the same as a pattern.
SPACES = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def table(rows: dict[str, object]) -> Column:
    """A literal map; lists become arrays."""
    return F.create_map(*(x for k, v in rows.items() for x in (F.lit(k), strings(v) if isinstance(v, list) else F.lit(v))))


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def normalize_site(site: Column) -> Column:
    """Canonical domain of a site alias; an unknown one as it is, lower-cased and trimmed."""
    return canonical_site(trimmed(F.lower(site)))


def canonical_site(own: Column) -> Column:
    """P1 of a lower-cased, trimmed alias."""
    return F.coalesce(F.try_element_at(table(SITE_ALIASES), own), own)


def unique_terms(terms: Column) -> Column:
    """Trimmed terms in order, each once, blanks left out."""
    return F.array_distinct(F.filter(F.transform(terms, trimmed), lambda t: t != ""))


def _composed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Canonical composition; Spark has no function for it. Apply it to dimensions, not to fact rows."""
    return F.pandas_udf(_composed, "string")(text)


def quote_term(term: Column) -> Column:
    """P4."""
    return F.concat(F.lit('"'), F.replace(term, F.lit('"'), F.lit('\\"')), F.lit('"'))


def or_group(terms: Column) -> Column:
    """P5."""
    return F.concat(F.lit("("), F.array_join(F.transform(terms, quote_term), " OR "), F.lit(")"))


def negative_terms(terms: Column) -> Column:
    """-word, -"several words"; a term that is negative already stays."""
    return F.array_join(F.transform(terms, lambda t: F.when(t.startswith("-"), t).when(t.rlike(SPACE), F.concat(F.lit("-"), quote_term(t))).otherwise(F.concat(F.lit("-"), t))), " ")


def word_count(query: Column) -> Column:
    """Words between white space, brackets and quotes not counted."""
    bare = trimmed(F.regexp_replace(query, r'[()"]', ""))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, rf"{SPACE}+")))


def exclusions(site: Column) -> Column:
    """Exclusion words of a canonical site."""
    return F.coalesce(F.try_element_at(table(SITE_EXCLUSIONS), site), strings([]))


def overhead_words(site: Column) -> Column:
    """Site operator, exclusions and two date words."""
    return F.lit(3) + F.size(exclusions(site))


def fits_budget(body: Column, site: Column, budget: int = WORD_BUDGET) -> Column:
    return word_count(body) + overhead_words(site) <= budget


def negatives_for(site: Column, default: Column, by_site: Column | None = None) -> Column:
    """The negatives of a site if it has its own, else the profile's."""
    return default if by_site is None else F.coalesce(F.try_element_at(by_site, site), default)


def bodies(site: Column, names: Column, intents: Column, literal: Column, negatives: Column, budget: int = WORD_BUDGET) -> Column:
    """P10: one query body per intent group, or one with the literal; null unless all fit the budget.

    names, negatives: array<string>; intents: array<array<string>>, null or empty for the literal.
    """
    minus = negative_terms(negatives)
    tail = F.when(minus == "", F.lit("")).otherwise(F.concat(F.lit(" "), minus))
    places = unique_terms(names)
    by_intent = F.transform(intents, lambda own: F.concat(or_group(places), F.lit(" "), or_group(unique_terms(own)), tail))
    one = F.array(F.concat(or_group(places), F.lit(" "), quote_term(literal), tail))
    made = F.when(F.size(places) == 0, None).when(F.coalesce(F.size(intents), F.lit(-1)) > 0, by_intent).when(literal.isNotNull() & (literal != ""), one)
    return F.when(F.forall(made, lambda body: fits_budget(body, site, budget)), made)


def runs(items: Column, n: Column) -> Column:
    """Consecutive runs of n items."""
    return F.when(F.size(items) == 0, F.array().cast("array<array<string>>")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / n).cast("int")), lambda i: F.slice(items, i * n.cast("int") + 1, n.cast("int"))))


def fitted_groups(site: Column, names: Column, intents: Column, literal: Column, negatives: Column, budget: int = WORD_BUDGET) -> Column:
    """The split into the largest runs, down to pairs, of which every one fits; null if none does."""
    sizes = F.sequence(F.size(names), F.least(F.lit(2), F.size(names)), F.lit(-1))
    tries = F.transform(sizes, lambda n: runs(names, n))
    return F.try_element_at(F.filter(tries, lambda groups: F.forall(groups, lambda g: bodies(site, g, intents, literal, negatives, budget).isNotNull())), F.lit(1))


def legacy_text(site: Column, tier: Column, aliases: Column) -> Column:
    """Aliases less the noisy ones, as many as the tier allows, with fixed intent and negatives; null elsewhere."""
    own = F.slice(unique_terms(F.array_except(aliases, strings(NOISY_ALIASES))), F.lit(1), table(ALIASES_BY_TIER)[tier])
    text = F.concat(or_group(own), F.lit(f' "{LEGACY_INTENT}" '), negative_terms(strings(NEGATIVES)))
    return F.when(site.isin(LEGACY_SITES) & (F.size(own) > 0), text)


def search_text(site: Column, text: Column) -> Column:
    """Text with the exclusions of its site."""
    return trimmed(F.concat(trimmed(text), F.lit(" "), F.array_join(exclusions(site), " ")))


def compose(site: Column, text: Column, date_from: Column, date_to: Column, time_filter: Column, mode: Column) -> Column:
    """The complete query; a relative filter takes no dates, rolling mode only the lower one."""
    base = F.concat(F.lit("site:"), site, F.lit(" "), search_text(site, text))
    after = F.concat(base, F.lit(" after:"), F.date_format(date_from, "yyyy-MM-dd"))
    return F.when(time_filter != "custom", base).when(mode == "rolling", after).otherwise(F.concat(after, F.lit(" before:"), F.date_format(date_to, "yyyy-MM-dd")))


def ad_flag(title: Column, snippet: Column) -> Column:
    """Signs of advertising in title or snippet; blank text has none.

    The text is lower-cased once. Terms are searched as plain strings, those with other letters than
    ASCII's only in texts that have some, several with a common part only where that is found, and
    patterns only where a plain search has found what they begin with: a pattern of all terms would try
    each at every character.
    """
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(snippet, F.lit("")))
    parts = {part: [x for x in AD_TERMS if part in x] for part in AD_PARTS}
    alone = [x for x in AD_TERMS if not any(x in own for own in parts.values())]

    def any_of(terms: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, terms, F.lit(False))

    def signs(low: Column) -> Column:
        plain = any_of([low.contains(x) for x in alone if x.isascii()])
        bounded = any_of([low.contains(part) & low.rlike(pattern) for part, pattern in AD_BOUNDED.items()])
        other = any_of([low.contains(x) for x in alone if not x.isascii()] + [low.contains(part) & any_of([low.contains(x) for x in own]) for part, own in parts.items()])
        return plain | bounded | low.rlike(AD_PRICE) | (low.contains("0") & low.rlike(AD_PHONE)) | ((F.octet_length(low) > F.char_length(low)) & other)

    worded = F.get(F.transform(F.array(F.lower(text)), signs), F.lit(0))
    return worded | (F.contains(text.cast("binary"), F.lit(bytearray(AD_LETTERS_START))) & text.rlike(AD_LETTERS))


def mask_credentials(text: Column) -> Column:
    """User and password of every URL in a text replaced by stars."""
    return F.regexp_replace(text, r"([A-Za-z][A-Za-z0-9+.-]*://)[^/@\s]+@", "$1***@")


def safe_label(label: Column) -> Column:
    """A label that may be reported, else null."""
    return F.when(label.rlike(SAFE_LABEL), label)


def phrases(tier: Column) -> Column:
    """Intent phrases of a tier."""
    core = PHRASES_REVIEW + PHRASES_QUESTION
    return F.when(tier == "A", strings(core + PHRASES_EXTENDED)).when(tier == "B", strings(core)).otherwise(strings(PHRASES_REVIEW))


def local_time(ts: Column, zone: str = "Asia/Ho_Chi_Minh", offset: str = "+07:00") -> Column:
    """A UTC timestamp as local ISO text with a fixed offset."""
    return F.concat(F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit(offset))
