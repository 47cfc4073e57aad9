"""What a reader of the map sees: title case, popup text, circle sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stay lower case within a title; the circle's scale.
SMALL_WORDS = ("a", "an", "the", "and", "or", "but", "nor", "for", "of", "to", "in", "on", "at", "by", "from", "with", "de", "la", "le", "du", "van", "von")
RADIUS_STOPS = ((0.0, 2.5), (280.0, 20.0))


def title_case(s: Column) -> Column:
    """Each word begun with a capital, but for small words after the first."""

    def one(w: Column, i: Column) -> Column:
        keep = (w == "") | ((i > 0) & w.isin(*SMALL_WORDS))
        return F.when(keep, w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2147483647)))

    return F.array_join(F.transform(F.split(s, " "), one), " ")


def people(n: Column) -> Column:
    """1.2M pop, 3.4K pop, 560 pop."""
    short = lambda unit, name: F.format_string(f"%.1f{name} pop", F.round(n / float(unit), 1))
    return F.when(n >= 10**6, short(10**6, "M")).when(n >= 10**3, short(10**3, "K")).otherwise(F.concat(n.cast("string"), F.lit(" pop")))


def popup_text(instance_of: Column, gt_type: Column, country: Column, population: Column, page_len: Column, inlinks: Column, elevation: Column) -> Column:
    """The line of facts below a title.  The class, or else the place's type; the country unless the class names it; what is there of the rest."""
    kind = F.nullif(F.coalesce(F.nullif(instance_of, F.lit("")), gt_type), F.lit(""))
    named = F.contains(F.lower(F.coalesce(instance_of, F.lit(""))), F.lower(country))
    where = F.when((country != "") & ~named, country)
    size = F.when(page_len > 0, F.format_string("%.1f KB", F.round(page_len / 1024.0, 1)))
    linked = F.concat(F.format_number(inlinks, 0), F.lit(" inlinks"))
    high = F.when(elevation.isNotNull(), F.concat(F.lit("elev "), F.format_number(elevation, 0), F.lit(" m")))
    return F.concat_ws(" · ", kind, where, F.when(population.isNotNull(), people(population)), size, linked, high)


def circle_radius(inlinks: Column) -> Column:
    """Linear in the root of the links between the stops, level beyond them."""
    (x0, r0), (x1, r1) = RADIUS_STOPS
    x = F.least(F.lit(x1), F.greatest(F.lit(x0), F.sqrt(inlinks.cast("double"))))
    return F.lit(r0) + (x - x0) / (x1 - x0) * (r1 - r0)
