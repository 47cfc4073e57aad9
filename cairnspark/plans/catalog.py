"""Name -> query and name -> SQL for the engine's own operators over the driver's tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display, geo, months, rdf, titles
from ..operators import assemble, entities, extents, inlinks, labels, pages, views
from ..sinks import files, geoparquet
from ..sources import caches, elevation, footers, insert_dump, links, osm_tsv, pageviews, triples
from ..sources import labels as label_source
from ..staging import shared_path
from . import build as building
from . import checks, reports, serve
from . import stand_in as S

QUERIES: dict = {}
SQL: dict[str, str] = {}

A, P = f"({S.oracle(S.ARTICLES)})", f"({S.oracle(S.POINTS)})"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ── views and sizes ─────────────────────────────────────────────

@query(f"""
WITH v AS ({S.oracle(S.VIEWS)}), g AS ({S.VIEW_PAGES}),
t AS (
  SELECT page_id, month, sum(views) AS views FROM (
    SELECT g.page_id, v.month, v.views FROM v JOIN g ON v.page_id = g.page_id
    UNION ALL SELECT g.page_id, v.month, v.views FROM v JOIN g ON v.page_id IS NULL AND v.title = g.title
  ) GROUP BY page_id, month
), grid AS (SELECT p.page_id, m.month FROM (SELECT DISTINCT page_id FROM t) p, (SELECT DISTINCT month FROM v) m)
SELECT page_id, CAST(round_even(median(coalesce(views, 0)), 0) AS INT) AS views FROM grid LEFT JOIN t USING (page_id, month) GROUP BY page_id
""")  # fmt: skip
def median_views(spark, sf_dir):
    return views.median_views(S.frame(spark, sf_dir, S.VIEWS), S.frame(spark, sf_dir, S.VIEW_PAGES))


@query(f"""
WITH f AS ({S.FEATURES}), g AS ({S.FEATURE_PAGES}), h AS (
  SELECT page_id, osm_type, osm_id, extent_km, area_km2 FROM g JOIN f USING (qid)
  UNION ALL SELECT page_id, osm_type, osm_id, extent_km, area_km2 FROM g JOIN f ON wiki_lang = 'en' AND wiki_title = title
  UNION ALL SELECT page_id, osm_type, osm_id, extent_km, area_km2 FROM g JOIN f ON osm_type = 'relation' AND osm_id = osm_relation
)
SELECT page_id, extent_km::DOUBLE AS extent_km, area_km2::DOUBLE AS area_km2, osm_type || '/' || osm_id AS osm_source
FROM h WHERE extent_km > 0 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY extent_km DESC, osm_id, osm_type) = 1
""")  # fmt: skip
def largest_extent(spark, sf_dir):
    out = extents.largest_extent(S.frame(spark, sf_dir, S.FEATURE_PAGES), S.frame(spark, sf_dir, S.FEATURES))
    return out.withColumns({c: F.col(c).cast("double") for c in ("extent_km", "area_km2")})


@query("""
SELECT page_id, round(greatest((xmax - xmin) * 111.32::DOUBLE * cos(radians((ymin + ymax) / 2)), (ymax - ymin) * 110.57::DOUBLE), 6) AS extent_km,
       xmax - xmin > 180 AS antimeridian
FROM (SELECT page_id, lon AS xmin, lat AS ymin, lon + (page_id % 50) / 10.0::DOUBLE AS xmax, lat + (page_id % 30) / 10.0::DOUBLE AS ymax FROM """ + P + """)
""")  # fmt: skip
def extent_km(spark, sf_dir):
    p = S.frame(spark, sf_dir, S.POINTS)
    box = F.col("lon"), F.col("lat"), F.col("lon") + (F.col("page_id") % 50) / F.lit(10.0), F.col("lat") + (F.col("page_id") % 30) / F.lit(10.0)
    return p.select("page_id", F.round(geo.extent_km(*box), 6).alias("extent_km"), geo.crosses_antimeridian(box[0], box[2]).alias("antimeridian"))


# ── serving ─────────────────────────────────────────────────────

@query(f"SELECT page_id, label, instance_of, country, inlink_count, lon, lat FROM {A} ORDER BY inlink_count DESC, page_id LIMIT 20")
def most_notable(spark, sf_dir):
    top = serve.most_notable(S.articles(spark, sf_dir))
    number = lambda k: F.regexp_extract("point", r"POINT \((\S+) (\S+)\)", k).cast("double")
    return top.select("page_id", "label", "instance_of", "country", "inlink_count", number(1).alias("lon"), number(2).alias("lat"))


@query(f"""
SELECT page_id, label, instance_of, country, inlink_count FROM {A}
WHERE lon BETWEEN 1.7 AND 33.0 AND lat BETWEEN 40.4 AND 59.3 ORDER BY inlink_count DESC, page_id LIMIT 20
""")  # fmt: skip
def bbox_topk(spark, sf_dir):
    return serve.in_box(S.articles(spark, sf_dir), 1.7, 40.4, 33.0, 59.3)


@query(f"SELECT description, image_url, gt_type, page_len, elevation, instance_of, country, population FROM {A} WHERE page_id = 77 LIMIT 1")
def point_lookup(spark, sf_dir):
    return serve.details(S.articles(spark, sf_dir), 77)


@query(f"SELECT page_id, label, country FROM {A} WHERE label = (SELECT min(label) FROM {A} WHERE page_id = 12)")
def label_lookup(spark, sf_dir):
    a = S.articles(spark, sf_dir)
    label = a.where("page_id = 12").agg(F.min("label")).first()[0]
    return serve.by_label(a, label or "").select("page_id", "label", "country")


@query(f"""
SELECT lower(label) AS label, lon, lat FROM {A} WHERE lower(label) >= 'customer 0000001' AND lower(label) < 'customer 0000001~'
ORDER BY inlink_count DESC, lower(label), lon LIMIT 8
""")  # fmt: skip
def prefix_search(spark, sf_dir):
    return serve.search(files.search_index(S.articles(spark, sf_dir)), "Customer 0000001").select("label", "lon", "lat")


@query(f"SELECT lower(label) AS label, lon, lat, inlink_count FROM {A}")
def search_index(spark, sf_dir):
    return files.search_index(S.articles(spark, sf_dir)).orderBy("label", "lon", "lat")


SMALL = "(" + ", ".join(f"'{w}'" for w in display.SMALL_WORDS) + ")"


@query(f"""
SELECT p_partkey, array_to_string(list_transform(string_split(s, ' '),
         lambda w, i: CASE WHEN w = '' OR (i > 1 AND w IN {SMALL}) THEN w ELSE upper(substr(w, 1, 1)) || substr(w, 2) END), ' ') AS title
FROM (SELECT p_partkey, concat('the ', p_name, ' of  the ', lower(p_type)) AS s FROM part)
""")  # fmt: skip
def title_case(spark, sf_dir):
    s = F.concat(F.lit("the "), F.col("p_name"), F.lit(" of  the "), F.lower("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", display.title_case(s).alias("title"))


@query(f"""
SELECT page_id, concat_ws(' · ',
  CASE WHEN instance_of <> '' THEN instance_of WHEN gt_type <> '' THEN gt_type END,
  CASE WHEN country <> '' AND NOT contains(lower(instance_of), lower(country)) THEN country END,
  CASE WHEN population >= 1000000 THEN printf('%.1fM pop', round(population / 1000000.0::DOUBLE, 1)) WHEN population >= 1000 THEN printf('%.1fK pop', round(population / 1000.0::DOUBLE, 1))
       WHEN population IS NOT NULL THEN population || ' pop' END,
  CASE WHEN page_len > 0 THEN printf('%.1f KB', round(page_len / 1024.0::DOUBLE, 1)) END,
  format('{{:,}}', inlink_count) || ' inlinks', 'elev ' || format('{{:,}}', elevation) || ' m') AS popup
FROM {A}
""")  # fmt: skip
def popup_text(spark, sf_dir):
    return serve.popups(S.articles(spark, sf_dir)).select("page_id", "popup")


@query(f"SELECT page_id, round(2.5::DOUBLE + least(280, greatest(0, sqrt(inlink_count))) / 280 * 17.5::DOUBLE, 9) AS radius FROM {P}")
def circle_radius(spark, sf_dir):
    return S.frame(spark, sf_dir, S.POINTS).select("page_id", F.round(display.circle_radius(F.col("inlink_count")), 9).alias("radius"))


@query(f"""
SELECT page_id, '{{"type":"Feature","properties":{{"page_id":' || page_id || ',"label":"' || label || '","inlink_count":' || inlink_count || ',"instance_of_qid":"' || instance_of_qid || '"}}}}' AS feature, lon, lat
FROM {A}
""")  # fmt: skip
def geojson_features(spark, sf_dir):
    made = files.features(S.articles(spark, sf_dir)).select("value", F.from_json("value", "geometry struct<type: string, coordinates: array<double>>, properties struct<page_id: int>").alias("j"))
    rest = F.regexp_replace("value", r'"geometry":\{.*?\},', "")
    return made.select("j.properties.page_id", rest.alias("feature"), F.get("j.geometry.coordinates", F.lit(0)).alias("lon"), F.get("j.geometry.coordinates", F.lit(1)).alias("lat"))


# ── entities, pages, labels ─────────────────────────────────────

@query("""
SELECT user_id::BIGINT AS user_id, arg_min(cents, event_id) FILTER (event_type = 'view') AS first_view, arg_min(cents, event_id) FILTER (event_type = 'click') AS first_click,
       arg_max(cents, event_id) FILTER (event_type = 'signup') AS last_signup, arg_max(cents, event_id) FILTER (event_type = 'error') AS last_error,
       2.5::DOUBLE AS lat, 1.5::DOUBLE AS lon
FROM (SELECT *, round(value * 100)::BIGINT AS cents FROM events) GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase') > 0
""")
def entity_pivot(spark, sf_dir):
    """Events as triples: a view is a class, a click a country, a signup a population, an error a gazetteer number, a purchase a place."""
    e = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    of = {"view": (rdf.INSTANCE_OF, "<http://www.wikidata.org/entity/Q", ">"), "click": (rdf.COUNTRY, "<http://www.wikidata.org/entity/Q", ">"), "signup": (rdf.POPULATION, '"+', '"'), "error": (rdf.GEONAMES, '"', '"')}
    prop = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(p)) for t, (p, _, _) in of.items()], F.lit(rdf.POINT))
    value = F.coalesce(*[F.when(F.col("event_type") == t, F.concat(F.lit(a), cents, F.lit(z))) for t, (_, a, z) in of.items()], F.lit('"Point(1.5 2.5)"'))
    wanted = e.where(F.col("event_type").isin(*of, "purchase"))
    made = entities.entities(wanted.select(F.col("event_id").alias("seq"), F.concat(F.lit("Q"), "user_id").alias("qid"), prop.alias("prop"), value.alias("value")))
    number = lambda c: F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).cast("long")
    return made.select(
        F.expr("bigint(substr(qid, 2))").alias("user_id"), number("instance_of_qid").alias("first_view"), number("country").alias("first_click"),
        F.col("population").alias("last_signup"), number("geonames_id").alias("last_error"), "lat", "lon",
    )


@query("SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY o_orderkey) AS priorities FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey")
def ordered_list(spark, sf_dir):
    listed = entities.in_order(F.col("o_orderpriority"), F.col("o_orderkey"), F.col("o_orderstatus") != "F")
    out = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(listed.alias("l"))
    return out.where(F.size("l") > 0).select("o_custkey", F.array_join("l", "|").alias("priorities"))


@query("""
SELECT c_custkey AS page_id, c_name AS qid, coalesce('https://commons.wikimedia.org/wiki/Special:FilePath/' || image, c_mktsegment, '') AS image_url, coalesce(description, '') AS description
FROM customer JOIN (
  SELECT user_id, arg_max(props, event_id) FILTER (event_type = 'view') AS image, arg_max(props, event_id) FILTER (event_type = 'click') AS description
  FROM (SELECT user_id, event_id, event_type, replace(props, ' ', '_') AS props FROM events WHERE props <> '') GROUP BY user_id
) ON user_id = c_custkey
""")  # fmt: skip
def page_props_pivot(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    props = e.select(F.col("user_id").alias("page_id"), F.col("event_type").alias("propname"), F.translate("props", " ", "_").alias("value"), F.col("event_id").alias("seq"))
    # every page has its entity under its own number
    ids = e.select(F.col("user_id").alias("page_id"), F.lit("entity").alias("propname"), F.concat(F.lit("Q"), "user_id").alias("value"), F.col("event_id").alias("seq"))
    known = table(spark, sf_dir, "customer").select(F.concat(F.lit("Q"), "c_custkey").alias("qid"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("p18_image"))
    wide = pages.page_properties(props.unionByName(ids), {"entity": "qid", "view": "page_image", "click": "description"})
    return pages.with_entities(wide, known).select("page_id", F.col("name").alias("qid"), "image_url", "description")


@query("""
SELECT l_orderkey AS page_id, coalesce(arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey)) FILTER (l_linestatus = 'O'), arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey))) AS gt_type
FROM lineitem WHERE l_quantity > 5 GROUP BY l_orderkey
""")
def primary_first(spark, sf_dir):
    # compared field by field: no key is so large that it runs into the next
    seq = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    globe, primary = F.when(F.col("l_quantity") > 5, "earth").otherwise("moon"), (F.col("l_linestatus") == "O").cast("int")
    return pages.place_types(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id"), globe.alias("globe"), primary.alias("is_primary"), F.col("l_returnflag").alias("gt_type"), seq.alias("seq")))


@query("""
SELECT o_orderkey AS page_id, c_name AS title, CAST(floor(o_totalprice) AS INT) AS page_len
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'
""")
def article_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    raw = o.select(
        F.col("o_orderkey").alias("page_id"), F.when(F.col("o_orderpriority") != "5-LOW", 0).alias("ns"), F.col("c_name").alias("title"),
        (F.col("o_orderstatus") == "P").cast("int").alias("is_redirect"), F.floor("o_totalprice").cast("int").alias("page_len"),
    )
    return pages.articles(raw)


@query("""
SELECT c_custkey AS page_id, coalesce(n, 0)::INT AS inlink_count
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def inlink_count(spark, sf_dir):
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page_id"), F.col("c_name").alias("title"))
    targets = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("target_id"), "o_custkey")
    named = targets.join(own.select(F.col("page_id").alias("o_custkey"), "title"), "o_custkey").select("target_id", "title")
    found = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("target_id"))
    return inlinks.with_inlinks(own, inlinks.inlink_counts(found, named, own)).select("page_id", "inlink_count")


LABELLED = "SELECT 'Q' || n_nationkey AS qid, n_name AS label FROM nation WHERE n_nationkey > 4"


def _nation_labels(spark, sf_dir, more_than: int) -> DataFrame:
    return table(spark, sf_dir, "nation").where(F.col("n_nationkey") > more_than).select(F.concat(F.lit("Q"), "n_nationkey").alias("qid"), F.col("n_name").alias("label"))


@query(f"""
SELECT c_custkey, coalesce(a.label, '') AS instance_of, coalesce(b.label, '') AS country
FROM (SELECT c_custkey, 'Q' || c_nationkey AS x, 'Q' || (c_custkey % 40) AS y FROM customer) LEFT JOIN ({LABELLED}) a ON a.qid = x LEFT JOIN ({LABELLED}) b ON b.qid = y
""")  # fmt: skip
def label_resolution(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Q"), "c_nationkey").alias("instance_of"), F.concat(F.lit("Q"), F.col("c_custkey") % 40).alias("country"))
    return labels.resolved(rows, _nation_labels(spark, sf_dir, 4), "instance_of", "country")


@query(f"SELECT DISTINCT 'Q' || k AS qid FROM (SELECT s_nationkey AS k FROM supplier UNION SELECT s_suppkey % 50 FROM supplier) WHERE 'Q' || k NOT IN (SELECT qid FROM ({LABELLED}))")
def labels_to_fetch(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Q"), "s_nationkey").alias("a"), F.concat(F.lit("Q"), F.col("s_suppkey") % 50).alias("b"))
    return labels.to_fetch(labels.wanted(rows, "a", "b"), _nation_labels(spark, sf_dir, 4))


@query(f"SELECT DISTINCT 'Q' || s_nationkey AS qid FROM supplier WHERE 'Q' || s_nationkey IN (SELECT qid FROM ({LABELLED}))")
def labels_known(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Q"), "s_nationkey").alias("a"))
    return labels.known(labels.wanted(rows, "a"), _nation_labels(spark, sf_dir, 4))


@query("""
SELECT coalesce(a.qid, b.qid) AS qid, coalesce(b.label, a.label) AS label
FROM (SELECT 'Q' || n_nationkey AS qid, n_name AS label FROM nation WHERE n_nationkey > 4) a FULL JOIN (SELECT 'Q' || r_regionkey * 4 AS qid, r_name AS label FROM region) b ON a.qid = b.qid
""")
def label_cache_merge(spark, sf_dir):
    new = table(spark, sf_dir, "region").select(F.concat(F.lit("Q"), F.col("r_regionkey") * 4).alias("qid"), F.col("r_name").alias("label"))
    return labels.merged(_nation_labels(spark, sf_dir, 4), new)


@query("""
SELECT 'c' || c_custkey AS x, 'Q' || q.o_custkey AS qid, w.p AS wp, c_name AS env, c_acctbal AS area
FROM customer JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') q ON q.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS p FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY o_custkey) w ON w.o_custkey = c_custkey
UNION ALL
SELECT 'c' || c_custkey, NULL, w.p, c_name, c_acctbal
FROM customer JOIN (SELECT o_custkey, max(o_orderstatus) AS p FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY o_custkey) w ON w.o_custkey = c_custkey
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def not_exists(spark, sf_dir):
    from ..sources.osm_tsv import feature_families

    x = lambda c: F.concat(F.lit("c"), c).alias("x")
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    urgent = o.where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct().select(x("o_custkey"), F.concat(F.lit("Q"), "o_custkey").alias("qid"))
    low = o.where("o_orderpriority = '5-LOW'").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("wp")).select(x("o_custkey"), "wp")
    return feature_families(c.select(x("c_custkey")), urgent, low, c.select(x("c_custkey"), F.col("c_name").alias("env")), c.select(x("c_custkey"), F.col("c_acctbal").alias("area")))


# ── parsing ─────────────────────────────────────────────────────

@query("""
SELECT page_id, link, count(*) AS n
FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS link FROM pages) GROUP BY page_id, link
""")
def html_link_extract(spark, sf_dir):
    found = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("link"))
    return found.groupBy("page_id", "link").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS lang,
       regexp_extract(url, '/(\\d+)', 1)::BIGINT AS number FROM pages
""")
def url_parts(spark, sf_dir):
    part = lambda form: F.regexp_extract("url", form, 1)
    return table(spark, sf_dir, "pages").select("page_id", part(r"^https?://([^/]+)").alias("host"), part(r"^https?://[^/]+/([a-z]{2})/").alias("lang"), part(r"/(\d+)").try_cast("long").alias("number"))


@query("""
SELECT p_partkey, 'en' AS lang, upper(substr(t, 1, 1)) || substr(t, 2) AS title FROM (SELECT p_partkey, replace(p_name, ' ', '_') || '+' || p_size AS t FROM part)
""")
def wiki_titles(spark, sf_dir):
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    address = F.concat(F.lit("<https://en.wikipedia.org/wiki/"), F.replace(name, F.lit(" "), F.lit("%20")), F.lit("+"), size, F.lit(">"))
    literal = F.concat(F.lit('"en:'), name, F.lit("+"), size, F.lit('"'))
    w = titles.wiki_reference(F.when(F.col("p_partkey") % 2 == 0, address).otherwise(literal))
    return table(spark, sf_dir, "part").select("p_partkey", w.alias("w")).select("p_partkey", "w.lang", "w.title")


@query("""
SELECT CASE WHEN user_id % 4 <> 3 THEN user_id::INT END AS page_id, CASE WHEN user_id % 4 = 3 THEN event_type || '_' || user_id END AS title, sum(floor(value))::BIGINT AS views
FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY 1, 2
""")
def page_lines(spark, sf_dir):
    # five fields without a page for some users, a talk page for an event type, a number that is none for another
    user = F.col("user_id").cast("string")
    title = F.concat(F.when(F.col("event_type") == "error", "Talk:").otherwise(""), F.col("event_type"), F.lit("_"), user)
    n = F.when(F.col("event_type") == "signup", F.lit("x")).otherwise(F.floor("value").cast("string"))
    six = F.concat_ws(" ", F.lit("en.wikipedia"), title, user, F.lit("desktop"), n, F.lit("A1"))
    five = F.concat_ws(" ", F.lit("en.wikipedia"), title, F.lit("mobile"), n, F.lit("A1"))
    e = table(spark, sf_dir, "events")
    lines = e.select(F.when(F.col("user_id") % 4 == 3, five).otherwise(six).alias("value")).unionByName(e.select(F.concat(F.lit("fr.wikipedia x 1 desktop "), user, F.lit(" A1")).alias("value")))
    return pageviews.views(lines)



@query("SELECT p_partkey AS target_id, p_name || '''s),(' || p_brand AS title FROM part WHERE p_size % 2 = 0")
def insert_links(spark, sf_dir):
    name = F.concat(F.col("p_name"), F.lit(r"\'s),("), F.col("p_brand"))
    one = F.concat(F.lit("("), F.col("p_partkey"), F.lit(","), F.when(F.col("p_size") % 2 == 0, "0").otherwise("1"), F.lit(",'"), name, F.lit("')"))
    lines = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 20).alias("g")).agg(F.concat(F.lit("INSERT INTO `linktarget` VALUES "), F.array_join(F.collect_list(one), ","), F.lit(";")).alias("value"))
    return links.link_targets(lines)


@query("""
SELECT c_custkey AS id, c_name || chr(10) || '\\''"),(' || chr(9) AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance, c_nationkey::BIGINT AS nation FROM customer
""")
def insert_dump_roundtrip(spark, sf_dir):
    text = F.concat(F.lit("'"), F.col("c_name"), F.lit("\\n\\\\\\'\\\"),(\\t'"))
    number = F.when(F.col("c_custkey") % 3 == 0, F.lit("NULL")).otherwise(F.col("c_acctbal").cast("string"))
    one = F.concat(F.lit("("), F.concat_ws(",", F.col("c_custkey").cast("string"), text, number, F.col("c_nationkey").cast("string")), F.lit(")"))
    c = table(spark, sf_dir, "customer")
    many = c.where("c_custkey % 2 = 0").groupBy((F.col("c_custkey") % 10).alias("g")).agg(F.concat(F.lit("INSERT INTO `t` VALUES "), F.array_join(F.collect_list(one), ","), F.lit(";")).alias("value")).select("value")
    single = c.where("c_custkey % 2 = 1").select(F.concat(one, F.lit(",")).alias("value"))
    rows = insert_dump.tuples(many.unionByName(single), "t")
    return insert_dump.columns(rows, 4, id=(0, "long"), name=(1, "string"), balance=(2, "double"), nation=(3, "long")).drop("seq")


# ── quality ─────────────────────────────────────────────────────

@query(f"""
SELECT count(*) AS n, count(*) FILTER (qid <> '') AS with_qid, count(*) FILTER (instance_of <> '') AS with_class, count(*) FILTER (country <> '') AS with_country,
       count(population) AS with_population, count(*) FILTER (geonames_id <> '') AS with_geonames, count(*) FILTER (image_url <> '') AS with_image,
       count(*) FILTER (len(related_images) > 0) AS with_related, count(*) FILTER (gt_type <> '') AS with_type, count(pageviews_month) AS with_views,
       count(extent_km) AS with_extent, count(area_km2) AS with_area, max(inlink_count) AS top_links, min(elevation)::INT AS lowest, max(elevation)::INT AS highest,
       round(avg(elevation), 6) AS mean_elevation, round(avg(page_len), 6) AS mean_len, max(page_len) AS longest
FROM {A}
""")  # fmt: skip
def coverage_counts(spark, sf_dir):
    out = checks.profile(S.articles(spark, sf_dir))
    return out.withColumns({"lowest": F.col("lowest").cast("int"), "highest": F.col("highest").cast("int"), "mean_elevation": F.round("mean_elevation", 6), "mean_len": F.round("mean_len", 6)})


@query("""
SELECT lang AS value, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents) AS percent FROM documents GROUP BY lang ORDER BY n DESC, value NULLS LAST LIMIT 15
""")
def breakdown(spark, sf_dir):
    return checks.breakdown(table(spark, sf_dir, "documents"), "lang", 15)


@query(f"""
SELECT t AS tier, count(*) FILTER (inlink_count >= greatest(t, 1)) AS n FROM {P}, (VALUES (0), (50), (500), (2000), (5000)) v(t) GROUP BY t
""")  # fmt: skip
def inlink_tiers(spark, sf_dir):
    return checks.tiers(S.frame(spark, sf_dir, S.POINTS))


BOUNDS = checks.Bounds(rows=(1000, 10_000_000))


def _known_sql(values: dict, column: str, missing: str) -> str:
    """A named article's value within its range."""
    return ",\n".join(f"  ('{label}: {column} within {low:g} to {high:g}', coalesce((SELECT max({column}) BETWEEN {low} AND {high} FROM a WHERE label = '{label}'), {missing}))" for label, (low, high) in values.items())


KNOWN = ",\n".join([_known_sql(BOUNDS.known_views, "pageviews_month", "false"), _known_sql(BOUNDS.known_extent, "extent_km", "true"), _known_sql(BOUNDS.known_elevation, "elevation", "true")])


@query(f"""
WITH a AS (SELECT * FROM {A}), n AS (SELECT count(*) AS n FROM a)
SELECT * FROM (VALUES
  ('rows within bounds', (SELECT n BETWEEN 1000 AND 10000000 FROM n)),
  ('no geometry is null', true),
  ('coordinates in range', NOT EXISTS (SELECT 1 FROM a WHERE NOT (lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90))),
  ('instance_of covers enough', (SELECT count(*) FILTER (instance_of <> '') > max(n) * 0.3 FROM a, n)),
  ('country covers enough', (SELECT count(*) FILTER (country <> '') > max(n) * 0.3 FROM a, n)),
  ('instance_of has no raw identifiers', NOT EXISTS (SELECT 1 FROM a WHERE regexp_full_match(instance_of, 'Q[0-9]+'))),
  ('country has no raw identifiers', NOT EXISTS (SELECT 1 FROM a WHERE regexp_full_match(country, 'Q[0-9]+'))),
  ('some article has many inlinks', (SELECT max(inlink_count) > 10000 FROM a)),
  ('enough articles have inlinks', (SELECT count(*) FILTER (inlink_count > 0) > max(n) * 0.5 FROM a, n)),
  ('elevation is never null', NOT EXISTS (SELECT 1 FROM a WHERE elevation IS NULL)),
  ('elevation is not too low', (SELECT min(elevation) > -12000 FROM a)),
  ('elevation is not too high', (SELECT max(elevation) < 9000 FROM a)),
  ('instance_of_qid covers enough', (SELECT count(*) FILTER (instance_of_qid <> '') > max(n) * 0.3 FROM a, n)),
  ('instance_of_qid is well formed', NOT EXISTS (SELECT 1 FROM a WHERE instance_of_qid <> '' AND NOT regexp_full_match(instance_of_qid, 'Q[0-9]+'))),
  ('instance_of implies instance_of_qid', NOT EXISTS (SELECT 1 FROM a WHERE instance_of <> '' AND instance_of_qid = '')),
  ('enough articles have views', (SELECT count(pageviews_month) > max(n) * 0.5 FROM a, n)),
  ('some articles have no views', (SELECT count(pageviews_month) < max(n) FROM a, n)),
  ('extent, area and source agree', NOT EXISTS (SELECT 1 FROM a WHERE (extent_km IS NULL) <> (osm_source IS NULL) OR (area_km2 IS NOT NULL AND extent_km IS NULL))),
  ('extent and area are plausible', NOT EXISTS (SELECT 1 FROM a WHERE extent_km <= 0 OR extent_km > 20000 OR area_km2 <= 0)),
{KNOWN}
) v(name, passed)
""")  # fmt: skip
def consistency_checks(spark, sf_dir):
    return checks.run_checks(S.articles(spark, sf_dir), BOUNDS)


@query(f"SELECT label FROM (VALUES ('Paris'), ('Customer 000000000 12')) e(label) WHERE label NOT IN (SELECT label FROM {A})")
def missing_labels(spark, sf_dir):
    return checks.missing_labels(S.articles(spark, sf_dir), spark.createDataFrame([("Paris",), ("Customer 000000000 12",)], "label string"))


@query(f"""
SELECT page_id, label, coalesce(pageviews_month, 0) AS rank, inlink_count FROM {A}
WHERE instance_of IN ('mountain', 'Lake', 'city park') AND instance_of <> 'city park' ORDER BY rank DESC, inlink_count DESC, page_id LIMIT 40
""")  # fmt: skip
def natural_class_topk(spark, sf_dir):
    a = S.articles(spark, sf_dir)
    return reports.natural_top(a, a.select("page_id", F.col("pageviews_month").alias("views")).where("views is not null"), 40)


@query(f"""
WITH f AS ({S.FEATURES}), a AS (SELECT page_id, qid, replace(label, ' ', '_') AS title FROM {A}), h AS (
  SELECT page_id FROM a JOIN f USING (qid) WHERE extent_km > 0 UNION SELECT page_id FROM a JOIN f ON wiki_lang = 'en' AND wiki_title = title AND extent_km > 0
)
SELECT (SELECT count(*) FROM a) AS n, (SELECT count(*) FROM h) AS matched
""")  # fmt: skip
def extent_report(spark, sf_dir):
    features = S.frame(spark, sf_dir, S.FEATURES)
    return reports.extent_coverage(S.articles(spark, sf_dir), features, S.frame(spark, sf_dir, S.VIEWS))["overall"]


# ── map and geometry ────────────────────────────────────────────

@query(f"""
WITH RECURSIVE h AS (
  SELECT page_id, 15 AS k, least(65535, greatest(0, floor((lon + 180) / 360 * 65536)))::BIGINT AS x, least(65535, greatest(0, floor((lat + 90) / 180 * 65536)))::BIGINT AS y, 0::BIGINT AS d FROM {P}
  UNION ALL
  SELECT page_id, k - 1, CASE WHEN ry = 0 THEN ty ELSE tx END, CASE WHEN ry = 0 THEN tx ELSE ty END, d + s * s * xor(3 * rx, ry)
  FROM (
    SELECT page_id, k, d, s, rx, ry, CASE WHEN ry = 0 AND rx = 1 THEN s - 1 - x % s ELSE x % s END AS tx, CASE WHEN ry = 0 AND rx = 1 THEN s - 1 - y % s ELSE y % s END AS ty
    FROM (SELECT *, (1::BIGINT << k) AS s, (x >> k) & 1 AS rx, (y >> k) & 1 AS ry FROM h WHERE k >= 0)
  )
)
SELECT page_id, d AS hilbert FROM h WHERE k = -1
""")  # fmt: skip
def hilbert_key(spark, sf_dir):
    return S.frame(spark, sf_dir, S.POINTS).select("page_id", geo.hilbert(F.col("lon"), F.col("lat")).alias("hilbert"))


TILE = """'Copernicus_DSM_COG_10_' || CASE WHEN floor(lat) >= 0 THEN 'N' ELSE 'S' END || lpad(abs(floor(lat))::INT::VARCHAR, 2, '0') || '_00_'
  || CASE WHEN floor(lon) >= 0 THEN 'E' ELSE 'W' END || lpad(abs(floor(lon))::INT::VARCHAR, 3, '0') || '_00_DEM'"""


@query(f"SELECT {TILE} AS tile, count(*) AS n, max(page_id) AS last_page FROM {P} GROUP BY tile")
def tile_groups(spark, sf_dir):
    tile = geo.dem_tile(F.col("lat"), F.col("lon"))
    return S.frame(spark, sf_dir, S.POINTS).groupBy(tile.alias("tile")).agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last_page"))


@query(f"""
SELECT z, x, y, page_id, inlink_count FROM (
  SELECT 4 AS z, least(15, greatest(0, floor((lon + 180) / 360 * 16)))::INT AS x,
         least(15, greatest(0, floor((1 - ln(tan(r) + 1 / cos(r)) / pi()) / 2 * 16)))::INT AS y, page_id, inlink_count
  FROM (SELECT *, radians(least(85.05112878::DOUBLE, greatest(-85.05112878::DOUBLE, lat))) AS r FROM {P})
) QUALIFY row_number() OVER (PARTITION BY z, x, y ORDER BY inlink_count DESC, page_id) <= 10
""")  # fmt: skip
def tile_topn(spark, sf_dir):
    return files.tile_selection(S.frame(spark, sf_dir, S.POINTS), 4, 10).select("z", "x", "y", "page_id", "inlink_count")


@query("""
SELECT strftime(DATE '2026-10-01' - to_months(b::INT), '%Y-%m') AS month, b::INT AS back FROM range(1, 13) r(b)
""")
def recent_months(spark, sf_dir):
    return months.months_before(spark, 12, datetime.date(2026, 10, 17))


@query("SELECT strftime(DATE '2026-10-01' - to_months(b::INT), '%Y-%m') AS month, b::INT AS back FROM range(0, 5) r(b)")
def months_to_now(spark, sf_dir):
    return months.months_before(spark, 5, datetime.date(2026, 10, 17), current=True)


# ── triples and literals ────────────────────────────────────────

WIKIDATA = "http://www.wikidata.org"


def _triple_lines(spark, sf_dir) -> DataFrame:
    """seq, value: eight properties of every customer, one that is not wanted, and a line that is no triple."""
    s = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    globe = F.when(k % 11 == 0, "<http://www.wikidata.org/entity/Q405> ").when(k % 11 == 1, "<http://www.wikidata.org/entity/Q2> ").otherwise("")
    point = s('"', globe, "Point(", k % 400 - 200, " ", k % 90, '.25)"^^<http://www.opengis.net/ont/geosparql#wktLiteral>')
    values = [
        ("P625", point), ("P31", s(f"<{WIKIDATA}/entity/Q", n, ">")), ("P17", F.when(k % 5 == 0, F.lit("_:blank")).otherwise(s(f"<{WIKIDATA}/entity/Q", n + 100, ">"))),
        ("P1082", s('"+', k * 3, '"^^<http://www.w3.org/2001/XMLSchema#decimal>')), ("P1566", s('"', k, '"')), ("P402", F.when(k % 3 == 0, F.lit('"none"')).otherwise(s('"', k * 7, '"'))),
        ("P18", s("<http://commons.example/", k, ".jpg>")), ("P6802", s("<https://commons.example/", k, "-b.jpg>")), ("P569", s('"', k, '"')),
    ]
    rows = F.array(*[F.struct(F.lit(p).alias("p"), v.alias("v")) for p, v in values], F.struct(F.lit("").alias("p"), F.lit("# no triple").alias("v")))
    c = table(spark, sf_dir, "customer").select(k, F.posexplode(rows).alias("i", "r"))
    line = F.when(F.col("r.p") == "", F.col("r.v")).otherwise(s(f"<{WIKIDATA}/entity/Q", k, f"> <{WIKIDATA}/prop/direct/", F.col("r.p"), "> ", F.col("r.v"), " ."))
    return c.select((k * 10 + F.col("i")).alias("seq"), line.alias("value"))


TRIPLE_VALUES = """
SELECT c_custkey AS k, c_nationkey AS n, c_custkey % 400 - 200 AS lon0, (c_custkey % 90) AS lat0, c_custkey % 11 <> 0 AND abs(c_custkey % 400 - 200) <= 180 AS placed FROM customer
"""


@query("""
SELECT 'Q' || c_custkey AS qid, p AS prop, count(*) AS n, max(c_custkey * 10 + i)::BIGINT AS last_seq
FROM customer, (VALUES ('P625', 0), ('P31', 1), ('P17', 2), ('P1082', 3), ('P1566', 4), ('P402', 5), ('P18', 6), ('P6802', 7)) v(p, i) GROUP BY ALL
""")
def triples_parse(spark, sf_dir):
    return triples.triples(_triple_lines(spark, sf_dir)).groupBy("qid", "prop").agg(F.count(F.lit(1)).alias("n"), F.max("seq").cast("long").alias("last_seq"))


@query(f"""
SELECT 'Q' || k AS subject, CASE WHEN placed THEN lat0 + 0.25::DOUBLE END AS lat, CASE WHEN placed THEN lon0::DOUBLE END AS lon, 'Q' || n AS class,
       CASE WHEN k % 5 <> 0 THEN 'Q' || (n + 100) END AS country, (k * 3)::BIGINT AS population, k::VARCHAR AS geonames,
       CASE WHEN k % 3 <> 0 THEN (k * 7)::BIGINT END AS relation, 'https://commons.example/' || k || '.jpg' AS image
FROM ({TRIPLE_VALUES})
""")
def rdf_literals(spark, sf_dir):
    t, v = triples.triples(_triple_lines(spark, sf_dir)), F.col("value")
    of = lambda p, c: F.max(F.when(F.col("prop") == p, c))
    wide = t.groupBy("qid").agg(
        of(rdf.POINT, rdf.point(v)).alias("place"), of(rdf.INSTANCE_OF, rdf.entity(v)).alias("class"), of(rdf.COUNTRY, rdf.entity(v)).alias("country"), of(rdf.POPULATION, rdf.whole_number(v)).alias("population"),
        of(rdf.GEONAMES, rdf.quoted_text(v)).alias("geonames"), of(rdf.OSM_RELATION, rdf.digits(v)).alias("relation"), of(rdf.IMAGE, rdf.secure_uri(v)).alias("image"),
    )
    return wide.select(F.col("qid").alias("subject"), "place.lat", "place.lon", "class", "country", "population", "geonames", "relation", "image")


@query(f"""
SELECT 'Q' || k AS qid, lat0 + 0.25::DOUBLE AS lat, lon0::DOUBLE AS lon, 'Q' || n AS instance_of, 'Q' || n AS instance_of_qid, CASE WHEN k % 5 <> 0 THEN 'Q' || (n + 100) ELSE '' END AS country,
       (k * 3)::BIGINT AS population, k::VARCHAR AS geonames_id, CASE WHEN k % 3 <> 0 THEN (k * 7)::BIGINT END AS osm_relation, 'https://commons.example/' || k || '.jpg' AS p18_image,
       'https://commons.example/' || k || '-b.jpg' AS related
FROM ({TRIPLE_VALUES}) WHERE placed
""")
def entity_table(spark, sf_dir):
    made = entities.entities(triples.triples(_triple_lines(spark, sf_dir)))
    return made.withColumn("related", F.array_join("related_images", "|")).drop("related_images")


# ── link tables, map features, labels ───────────────────────────

@query("SELECT l_partkey::BIGINT AS target_id, count(*) AS n FROM lineitem WHERE l_linenumber % 3 <> 0 GROUP BY 1")
def page_link_targets(spark, sf_dir):
    one = F.concat(F.lit("("), F.col("l_orderkey"), F.lit(","), F.when(F.col("l_linenumber") % 3 == 0, "2").otherwise("0"), F.lit(","), F.col("l_partkey"), F.lit(")"))
    lines = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 64).alias("g")).agg(F.concat(F.lit("INSERT INTO `pagelinks` VALUES "), F.array_join(F.collect_list(one), ","), F.lit(";")).alias("value"))
    return links.page_links(lines).groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))


def _feature_lines(spark, sf_dir) -> DataFrame:
    """value: a header, and a line for each part; some of other objects, without an envelope, or too short."""
    s = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    k, size = F.col("p_partkey"), F.col("p_size")
    kind = F.when(k % 7 == 0, "node").when(k % 2 == 0, "way").otherwise("relation")
    wiki = F.when(k % 4 == 0, s("<https://en.wikipedia.org/wiki/Lake%20", k, ">")).when(k % 4 == 1, s('"de:see ', k, '"')).otherwise(F.lit(""))
    west = F.when(k % 13 == 0, F.lit(-179)).otherwise(size - 25)
    east = F.when(k % 13 == 0, F.lit(179)).otherwise(size - 24)
    box = F.when(k % 9 == 0, F.lit("")).otherwise(s('"POLYGON((', west, " ", size, ".5,", east, " ", size, ".5,", east, " ", size + 2, ".5))", '"^^<http://www.opengis.net/ont/geosparql#wktLiteral>'))
    area = F.when(k % 5 == 0, F.lit('"0"')).when(k % 5 == 1, F.lit('"x"')).otherwise(s('"', size * 1000000, '"^^<http://www.w3.org/2001/XMLSchema#double>'))
    entity = F.when(k % 3 == 0, F.lit("")).otherwise(s(f"<{WIKIDATA}/entity/Q", k, ">"))
    full = F.concat_ws("\t", s("<https://www.openstreetmap.org/", kind, "/", k, ">"), entity, wiki, box, area)
    return table(spark, sf_dir, "part").select(F.when(k % 17 == 0, s("<https://www.openstreetmap.org/way/", k, ">\tQ1")).otherwise(full).alias("value"))


@query("""
SELECT osm_type, p_partkey::BIGINT AS osm_id, CASE WHEN p_partkey % 3 <> 0 THEN 'Q' || p_partkey END AS qid,
       CASE p_partkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' END AS wiki_lang, CASE p_partkey % 4 WHEN 0 THEN 'Lake_' || p_partkey WHEN 1 THEN 'See_' || p_partkey END AS wiki_title,
       xmin, ymin, xmax, ymax, xmax - xmin > 180 AS antimeridian,
       CASE WHEN xmax - xmin <= 180 THEN round(greatest((xmax - xmin) * 111.32::DOUBLE * cos(radians((ymin + ymax) / 2)), (ymax - ymin) * 110.57::DOUBLE), 3) END AS extent_km,
       CASE WHEN p_partkey % 5 > 1 THEN p_size::DOUBLE END AS area_km2
FROM (
  SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'way' ELSE 'relation' END AS osm_type, CASE WHEN p_partkey % 13 = 0 THEN -179 ELSE p_size - 25 END::DOUBLE AS xmin,
         CASE WHEN p_partkey % 13 = 0 THEN 179 ELSE p_size - 24 END::DOUBLE AS xmax, p_size + 0.5::DOUBLE AS ymin, p_size + 2.5::DOUBLE AS ymax FROM part
) WHERE p_partkey % 7 <> 0 AND p_partkey % 9 <> 0 AND p_partkey % 17 <> 0
""")
def map_features(spark, sf_dir):
    out = osm_tsv.features(_feature_lines(spark, sf_dir))
    return out.withColumns({"extent_km": F.round(F.col("extent_km").cast("double"), 3), "area_km2": F.col("area_km2").cast("double")})


@query("""
SELECT p_partkey, w AS xmin, w + (p_partkey % 3) AS xmax, -p_size::DOUBLE AS ymin, p_size / 2.0::DOUBLE AS ymax FROM (SELECT *, -(p_partkey % 50) - 0.5::DOUBLE AS w FROM part) WHERE p_partkey % 10 <> 0
""")
def wkt_envelope(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    west = -(k % 50) - F.lit(0.5)
    wkt = F.when(k % 10 == 0, "EMPTY 7").otherwise(F.format_string('"LINESTRING(%s %s,%s -%s)"^^<http://www.opengis.net/1.0/4326>', west, F.col("p_size") / F.lit(2.0), west + k % 3, F.col("p_size")))
    return p.select("p_partkey", geo.envelope(wkt).alias("b")).where("b is not null").select("p_partkey", "b.xmin", "b.xmax", "b.ymin", "b.ymax")


@query("SELECT 'Q' || n_nationkey AS qid, n_name AS label FROM nation WHERE n_nationkey % 4 <> 0")
def label_file(spark, sf_dir):
    pair = F.concat(F.lit('"'), F.when(F.col("n_nationkey") % 8 == 0, "P").otherwise("Q"), F.col("n_nationkey"), F.lit('": '), F.when(F.col("n_nationkey") % 8 == 4, F.lit("17")).otherwise(F.concat(F.lit('"'), "n_name", F.lit('"'))))
    text = table(spark, sf_dir, "nation").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(pair), ", "), F.lit("}")).alias("value"))
    return label_source.parse_labels(text)


@query("SELECT 'Q' || c_custkey AS qid, true AS within FROM customer")
def label_batches(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.concat(F.lit("Q"), "c_custkey").alias("qid"))
    made = label_source.batches(keys)
    return made.select(F.explode("keys").alias("qid"), (F.size("keys") <= label_source.BATCH).alias("within"))


@query("""
SELECT c_custkey, replace(t, '_', ' ') AS label, 'https://en.wikipedia.org/wiki/' || t AS url, CASE WHEN c_custkey % 2 = 0 THEN 'https://commons.wikimedia.org/wiki/Special:FilePath/' || t WHEN c_custkey % 3 = 0 THEN '' ELSE 'https://x/' || c_custkey END AS image
FROM (SELECT c_custkey, c_mktsegment || '_' || c_custkey AS t FROM customer)
""")
def page_addresses(spark, sf_dir):
    title = F.concat_ws("_", "c_mktsegment", F.col("c_custkey").cast("string"))
    own = F.when(F.col("c_custkey") % 2 == 0, F.replace(title, F.lit("_"), F.lit(" "))).otherwise("")
    other = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("https://x/"), "c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", titles.label_of(title).alias("label"), titles.article_url(title).alias("url"), titles.image_url(own, other).alias("image"))


# ── geometry, elevation, files ──────────────────────────────────

@query(f"SELECT page_id, lon, lat, 21 AS bytes FROM {P}")
def wkb_roundtrip(spark, sf_dir):
    made = S.frame(spark, sf_dir, S.POINTS).select("page_id", geo.wkb_point(F.col("lon"), F.col("lat")).alias("g"))
    return made.select("page_id", geo.wkb_xy(F.col("g")).alias("p"), F.octet_length("g").alias("bytes")).select("page_id", F.col("p.x").alias("lon"), F.col("p.y").alias("lat"), "bytes")


def _height(tile: str, points: list[tuple[float, float]]) -> list[float]:
    """A raster's stand-in: the south-west corner and the place tell the height; some tiles are not there."""
    if "_S" in tile:
        raise OSError("no such tile")
    return [abs(int(lon)) * 10 + int(lat) + 0.7 for lon, lat in points]


@query(f"""
SELECT page_id, CASE WHEN floor(lat) < 0 THEN 0 ELSE trunc(abs(trunc(CASE WHEN lon = floor(lon) THEN lon + 0.001 ELSE lon END)) * 10 + trunc(CASE WHEN lat = floor(lat) THEN lat + 0.001 ELSE lat END)) END::SMALLINT AS elevation FROM {P}
""")
def elevations(spark, sf_dir):
    return elevation.sample_elevations(S.frame(spark, sf_dir, S.POINTS), _height)


def _written_articles(spark, sf_dir) -> tuple[str, list[str]]:
    """The stand-in's articles as GeoParquet in the shared folder: the folder, its files."""
    path = shared_path(spark, "articles")
    made = geoparquet.write_geoparquet(S.articles(spark, sf_dir).withColumn("area_km2", F.col("area_km2").cast("float")).select(*S.ARTICLE_COLUMNS), path, geoparquet.build_metadata(["2026-08", "2026-09"], 2, None), row_group=5000, parts=4)
    return path, [f"{path}/{r['file']}" for r in made.collect()]


@query(f"SELECT page_id, qid, label, inlink_count, extent_km::DOUBLE AS extent_km, lon, lat FROM {A}")
def geoparquet_roundtrip(spark, sf_dir):
    back = spark.read.parquet(_written_articles(spark, sf_dir)[0])
    return back.select("page_id", "qid", "label", "inlink_count", F.col("extent_km").cast("double").alias("extent_km"), geo.wkb_xy(F.col("geometry")).alias("p"), "bbox").select(
        "page_id", "qid", "label", "inlink_count", "extent_km", F.col("p.x").alias("lon"), F.col("bbox.ymin").alias("lat"),
    )


@query(f"SELECT page_id, label, instance_of, country, inlink_count FROM {A} WHERE lon BETWEEN -60 AND 33 AND lat BETWEEN -20 AND 59.5 ORDER BY inlink_count DESC, page_id LIMIT 20")
def bbox_topk_of_files(spark, sf_dir):
    return serve.in_box(spark.read.parquet(_written_articles(spark, sf_dir)[0]), -60, -20, 33, 59.5)


@query("""
SELECT * FROM (VALUES ('geo metadata is there', true), ('primary column is geometry', true), ('geometry is WKB', true), ('bbox covers the geometry', true), ('bbox column is there', true),
  ('pageviews_month is INT32', true), ('months are on record', true), ('extent_km is FLOAT', true), ('area_km2 is FLOAT', true), ('osm_source is BYTE_ARRAY', true)) v(name, passed)
""")
def footer_checks(spark, sf_dir):
    return checks.file_checks(spark, _written_articles(spark, sf_dir)[1])


@query("""
SELECT * FROM (VALUES ('pageviews_months', '2026-08,2026-09'), ('pageviews_months_wanted', '2'), ('osm_extent_extract', '')) v(key, value)
""")
def footer_values(spark, sf_dir):
    return footers.key_values(spark, _written_articles(spark, sf_dir)[1]).where("key like '%months%' or key = 'osm_extent_extract'").select("key", "value").distinct()


@query("""
SELECT * FROM (VALUES ('page_id', 'INT32'), ('label', 'BYTE_ARRAY'), ('population', 'INT64'), ('extent_km', 'FLOAT'), ('bbox.xmin', 'DOUBLE'), ('elevation', 'INT32')) v(name, type)
""")
def footer_columns(spark, sf_dir):
    return footers.columns(spark, _written_articles(spark, sf_dir)[1]).select("name", "type").distinct().where(F.col("name").isin("page_id", "label", "population", "extent_km", "bbox.xmin", "elevation"))


@query("SELECT month, page_id, title, views FROM (SELECT '2026-09' AS month, CASE WHEN user_id % 4 <> 3 THEN user_id::INT END AS page_id, CASE WHEN user_id % 4 = 3 THEN 'p' || user_id END AS title, sum(floor(value))::BIGINT AS views FROM events GROUP BY ALL)")
def month_read(spark, sf_dir):
    """A month's file, written sorted, read back in one scan, kept as a cache and read from there."""
    e, user = table(spark, sf_dir, "events"), F.col("user_id").cast("string")
    line = F.concat_ws(" ", F.lit("en.wikipedia"), F.concat(F.lit("p"), user), F.when(F.col("user_id") % 4 == 3, "null").otherwise(user), F.lit("desktop"), F.floor("value").cast("string"), F.lit("A1"))
    others = spark.createDataFrame([("de.wikipedia Z 1 desktop 9 A9",), ("fr.wikipedia A 1 desktop 9 A9",)], "value string")
    path = shared_path(spark, "month")
    e.select(line.alias("value")).unionByName(others).orderBy("value").write.text(path)
    cache = f"{path}-cache"
    files.write_cache(pageviews.read_month(spark, path, "2026-09"), cache)
    return caches.read_months(spark, [cache])


@query("SELECT 'Q' || c_custkey AS qid, 1.5::DOUBLE AS lat, c_mktsegment AS instance_of, c_mktsegment AS instance_of_qid, '' AS country, NULL::BIGINT AS osm_relation FROM customer")
def old_entity_cache(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Q"), "c_custkey").alias("qid"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), F.col("c_mktsegment").alias("instance_of"), F.lit(None).cast("string").alias("country"),
        F.lit(7).cast("long").alias("population"), F.lit("").alias("geonames_id"), F.lit("").alias("p18_image"), F.lit(None).cast("array<string>").alias("related_images"),
    )
    path = shared_path(spark, "entities")
    files.write_cache(old, path)
    return caches.read_entities(spark, path).select("qid", "lat", "instance_of", "instance_of_qid", "country", "osm_relation")


# ── reports, paging, the build ──────────────────────────────────

REPORT = f"""
a AS (SELECT page_id, qid, replace(label, ' ', '_') AS title, label, instance_of, inlink_count FROM {A}), f AS ({S.FEATURES}), h AS (
  SELECT page_id, osm_type, osm_id, extent_km, area_km2 FROM a JOIN f USING (qid) UNION ALL SELECT page_id, osm_type, osm_id, extent_km, area_km2 FROM a JOIN f ON wiki_lang = 'en' AND wiki_title = title
), b AS (SELECT * FROM h WHERE extent_km > 0 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY extent_km DESC, osm_id, osm_type) = 1),
v AS ({S.oracle(S.VIEWS)}), t AS (
  SELECT page_id, month, sum(views) AS views FROM (SELECT a.page_id, month, v.views FROM v JOIN a ON v.page_id = a.page_id UNION ALL SELECT a.page_id, month, v.views FROM v JOIN a ON v.page_id IS NULL AND v.title = a.title) GROUP BY 1, 2
), m AS (
  SELECT p.page_id, CAST(round_even(median(coalesce(views, 0)), 0) AS INT) AS views FROM (SELECT DISTINCT page_id FROM t) p CROSS JOIN (SELECT DISTINCT month FROM v) x LEFT JOIN t ON t.page_id = p.page_id AND t.month = x.month GROUP BY p.page_id
), n AS (
  SELECT a.page_id, label, coalesce(views, 0) AS rank, inlink_count FROM a LEFT JOIN m USING (page_id) WHERE instance_of IN ('mountain', 'Lake') ORDER BY rank DESC, inlink_count DESC, a.page_id LIMIT 50
)
"""


def _report(spark, sf_dir) -> dict[str, DataFrame]:
    return reports.extent_coverage(S.articles(spark, sf_dir), S.frame(spark, sf_dir, S.FEATURES), S.frame(spark, sf_dir, S.VIEWS), 50)


@query(f"WITH {REPORT} SELECT n.page_id, label, rank, inlink_count, extent_km::DOUBLE AS extent_km, area_km2::DOUBLE AS area_km2, osm_type || '/' || osm_id AS osm_source FROM n LEFT JOIN b USING (page_id)")
def natural_extents(spark, sf_dir):
    return _report(spark, sf_dir)["natural"].withColumns({c: F.col(c).cast("double") for c in ("extent_km", "area_km2")})


@query(f"WITH {REPORT} SELECT count(*) AS n, count(extent_km) AS with_extent, count(area_km2) AS with_area FROM n LEFT JOIN b USING (page_id)")
def natural_summary(spark, sf_dir):
    return _report(spark, sf_dir)["summary"]


@query(f"WITH {REPORT} SELECT label, views FROM a LEFT JOIN m USING (page_id) WHERE label IN ('Mount Rushmore', 'Black Hills')")
def named_views(spark, sf_dir):
    return reports.view_coverage(S.articles(spark, sf_dir), S.frame(spark, sf_dir, S.VIEWS))["named"]


@query(f"WITH {REPORT} SELECT count(*) AS n, count(views) AS with_views FROM a LEFT JOIN m USING (page_id)")
def view_report(spark, sf_dir):
    return reports.view_coverage(S.articles(spark, sf_dir), S.frame(spark, sf_dir, S.VIEWS))["overall"]


@query(f"SELECT page_id, label FROM {A} ORDER BY label, page_id LIMIT 25 OFFSET 50")
def offset_page(spark, sf_dir):
    return serve.page_of(S.articles(spark, sf_dir), ["label", "page_id"], 25, 50).select("page_id", "label")


@query("SELECT count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed FROM (" + SQL["consistency_checks"] + ")")
def check_tally(spark, sf_dir):
    return checks.tally(checks.run_checks(S.articles(spark, sf_dir), BOUNDS))


@query(f"""
WITH e AS (SELECT * FROM ({TRIPLE_VALUES}) WHERE placed), p AS (
  SELECT o_orderkey::INT AS page_id, 'Q' || o_custkey AS qid, 'P_' || o_orderkey AS title, floor(o_totalprice)::INT AS page_len FROM orders WHERE o_orderstatus <> 'P'
), l AS (SELECT l_orderkey AS page_id, count(*)::INT AS inlink_count FROM lineitem GROUP BY 1), g AS (
  SELECT l_orderkey AS page_id, arg_min(l_returnflag, l_linenumber) AS gt_type FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL) GROUP BY 1
)
SELECT p.page_id, p.qid, replace(title, '_', ' ') AS label, coalesce(n_name, '') AS instance_of, 'Q' || n AS instance_of_qid, coalesce(gt_type, '') AS gt_type, page_len, coalesce(inlink_count, 0) AS inlink_count,
       lon0::DOUBLE AS lon, lat0 + 0.25::DOUBLE AS lat, 'https://commons.example/' || k || '.jpg' AS image_url, (k * 3)::BIGINT AS population, 7::SMALLINT AS elevation
FROM p JOIN e ON p.qid = 'Q' || e.k LEFT JOIN nation ON n_nationkey = n AND n_nationkey > 4 LEFT JOIN l USING (page_id) LEFT JOIN g USING (page_id)
""")
def built_articles(spark, sf_dir):
    """The whole build: triples of customers, a page for each order, links and place types of line items."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    page = F.col("o_orderkey").cast("int").alias("page_id")
    title = F.concat(F.lit("P_"), "o_orderkey")
    types = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("gt_type"))
    inputs = building.Inputs(
        triples=triples.triples(_triple_lines(spark, sf_dir)),
        page_props=o.select(page, F.lit(pages.QID).alias("propname"), F.concat(F.lit("Q"), "o_custkey").alias("value"), F.col("o_orderkey").alias("seq")),
        geo_tags=types.select(F.col("l_orderkey").cast("int").alias("page_id"), F.lit("earth").alias("globe"), F.lit(0).alias("is_primary"), "gt_type", F.col("l_linenumber").alias("seq")),
        pages=o.select(page, F.lit(0).alias("ns"), title.alias("title"), (F.col("o_orderstatus") == "P").cast("int").alias("is_redirect"), F.floor("o_totalprice").cast("int").alias("page_len")),
        link_targets=o.select(F.col("o_orderkey").alias("target_id"), title.alias("title")), page_links=li.select(F.col("l_orderkey").alias("target_id")),
        labels=_nation_labels(spark, sf_dir, 4), views=S.frame(spark, sf_dir, S.VIEWS), features=S.frame(spark, sf_dir, S.FEATURES), sampler=lambda tile, points: [7.9] * len(points),
    )
    made = assemble.spatially_sorted(building.build(inputs))
    return made.select("page_id", "qid", "label", "instance_of", "instance_of_qid", "gt_type", "page_len", "inlink_count", F.col("bbox.xmin").alias("lon"), F.col("bbox.ymin").alias("lat"), "image_url", "population", "elevation")
