"""Titles and labels, image and article addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address heads of articles and images, and the two forms of a reference to an article.
ARTICLE_BASE = "https://en.wikipedia.org/wiki/"
IMAGE_BASE = "https://commons.wikimedia.org/wiki/Special:FilePath/"
ADDRESS_FORM = r"^<https://([a-z\-]+)\.wikipedia\.org/wiki/(.+)>$"
LITERAL_FORM = r'^"?([a-z\-]{2,12}):(.+?)"?(?:\^\^<[^>]*>)?$'


def label_of(title: Column) -> Column:
    return F.translate(title, "_", " ")


def title_of(label: Column) -> Column:
    return F.translate(label, " ", "_")


def article_url(title: Column) -> Column:
    """Not percent-encoded."""
    return F.concat(F.lit(ARTICLE_BASE), title)


def image_url(page_image: Column, entity_image: Column) -> Column:
    """The page's own image, else the entity's, else empty."""
    own = F.when(page_image != "", F.concat(F.lit(IMAGE_BASE), title_of(page_image)))
    return F.coalesce(own, entity_image, F.lit(""))


def wiki_reference(value: Column) -> Column:
    """struct<lang, title> of a map feature's reference to an article; null if it has none.

    Either an address (its title percent-encoded) or ``lang:Title``, perhaps
    quoted and with a data type.  Spaces become underscores and the first
    character upper case.  A plus sign stays a plus sign.
    """
    address, literal = ADDRESS_FORM, LITERAL_FORM
    is_address = value.rlike(address)
    decoded = F.try_url_decode(F.replace(F.regexp_extract(value, address, 2), F.lit("+"), F.lit("%2B")))
    lang = F.when(is_address, F.regexp_extract(value, address, 1)).otherwise(F.regexp_extract(value, literal, 1))
    raw = F.when(is_address, F.coalesce(decoded, F.regexp_extract(value, address, 2))).otherwise(F.regexp_extract(value, literal, 2))
    title = title_of(F.trim(raw))
    title = F.concat(F.upper(F.substring(title, 1, 1)), F.substring(title, 2, 2147483647))
    return F.when((lang != "") & (title != ""), F.struct(lang.alias("lang"), title.alias("title")))
