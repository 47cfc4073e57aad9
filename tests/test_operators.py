import json
import struct

import duckdb
import pytest
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cairnspark.operators import assemble, entities, extents, inlinks, pages, views
from cairnspark.plans import build, checks, reports, serve
from cairnspark.schemas import ARTICLE
from cairnspark.sinks import files, geoparquet
from cairnspark.sources import footers, insert_dump, links, osm_tsv, pageviews, triples
from cairnspark.streaming import monthly

W = "http://www.wikidata.org"


def triple(q, p, value):
    return f"<{W}/entity/{q}> <{W}/prop/direct/{p}> {value} ."


def entity(q):
    return f"<{W}/entity/{q}>"


TRIPLES = [
    triple("Q1", "P31", entity("Q50")), triple("Q1", "P31", entity("Q51")), triple("Q1", "P625", '"Point(2 48)"^^<w>'), triple("Q1", "P625", '"Point(2.5 48.5)"^^<w>'),
    triple("Q1", "P1082", '"12"'), triple("Q1", "P1082", '"many"'), triple("Q1", "P17", entity("Q60")), triple("Q1", "P18", "<http://c/a.jpg>"),
    triple("Q1", "P6802", "<http://c/2.jpg>"), triple("Q1", "P6802", "<http://c/1.jpg>"), triple("Q1", "P402", '"77"'),
    triple("Q2", "P31", entity("Q50")), triple("Q3", "P625", f'"<{W}/entity/Q405> Point(1 1)"^^<w>'), triple("Q4", "P625", '"Point(-70 -30)"^^<w>'),
    triple("Q1", "P1566", '"998"'), triple("Q4", "P31", entity("Q99")),
]


def lines(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "seq long, value string")


def test_entities(spark):
    got = {r["qid"]: r for r in entities.entities(triples.triples(lines(spark, TRIPLES))).collect()}
    assert set(got) == {"Q1", "Q4"}
    q = got["Q1"]
    assert (q["lat"], q["lon"], q["instance_of"], q["instance_of_qid"], q["country"], q["population"]) == (48.5, 2.5, "Q50", "Q50", "Q60", 12)
    assert (q["geonames_id"], q["osm_relation"], q["p18_image"], q["related_images"]) == ("998", 77, "https://c/a.jpg", ["https://c/2.jpg", "https://c/1.jpg"])
    assert (got["Q4"]["country"], got["Q4"]["population"], got["Q4"]["related_images"]) == ("", None, [])


def test_page_properties(spark):
    rows = [(1, 1, "wikibase_item", "Q1"), (2, 1, "wikibase_item", "Q2"), (3, 1, "page_image_free", "a b.jpg"), (4, 1, "page_image_free", ""), (5, 1, "other", "x"), (6, 2, "wikibase-shortdesc", "d")]
    got = {r["page_id"]: tuple(r)[1:] for r in pages.page_properties(spark.createDataFrame(rows, "seq long, page_id int, propname string, value string")).collect()}
    assert got == {1: ("Q2", "a b.jpg", None), 2: (None, None, "d")}


def test_place_types(spark):
    rows = [(1, 1, "earth", 0, "city"), (2, 1, "earth", 1, "landmark"), (3, 1, "earth", 1, "mountain"), (4, 2, "moon", 1, "crater"), (5, 3, "earth", None, "edu"), (6, 3, "earth", 0, "isle"), (7, 4, "earth", 1, "")]
    got = pages.place_types(spark.createDataFrame(rows, "seq long, page_id int, globe string, is_primary int, gt_type string"))
    assert sorted(map(tuple, got.collect())) == [(1, "landmark"), (3, "edu")]


def test_articles(spark):
    rows = [(1, 0, "A", 0, 5), (2, 1, "B", 0, 5), (3, 0, "C", 1, 5), (4, None, "D", 0, 5), (5, 0, "E", None, None), (6, 0, "", 0, 1)]
    got = pages.articles(spark.createDataFrame(rows, "page_id int, ns int, title string, is_redirect int, page_len int"))
    assert sorted(map(tuple, got.collect())) == [(1, "A", 5), (5, "E", 0)]


def test_inlinks_count_self_links_and_repeats(spark):
    own = spark.createDataFrame([(1, "A"), (2, "B")], "page_id int, title string")
    targets = spark.createDataFrame([(10, "A"), (11, "A"), (12, "Z")], "target_id long, title string")
    found = spark.createDataFrame([(10,), (10,), (11,), (12,), (99,)], "target_id long")
    assert sorted(map(tuple, inlinks.with_inlinks(own, inlinks.inlink_counts(found, targets, own)).select("page_id", "inlink_count").collect())) == [(1, 3), (2, 0)]


def test_median_views(spark):
    rows = [("m1", 1, None, 2), ("m2", 1, None, 3), ("m1", None, "B", 3), ("m1", 2, None, 1), ("m2", 2, None, 3), ("m1", 3, None, 2**40), ("m2", 3, None, 2**40), ("m1", 9, None, 5)]
    p = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], "page_id int, title string")
    v = spark.createDataFrame(rows, "month string, page_id int, title string, views long")
    assert dict(map(tuple, views.median_views(v, p).collect())) == {1: 2, 2: 4, 3: 2**31 - 1}
    more = v.unionByName(spark.createDataFrame([("m3", None, "x", 1)], v.schema))
    assert dict(map(tuple, views.median_views(more, p).collect())) == {1: 2, 2: 3, 3: 2**31 - 1}
    assert views.median_views(v.limit(0), p).count() == 0


def test_largest_extent(spark):
    features = [
        ("way", 5, "Q1", None, None, 3.0, 1.0), ("relation", 4, None, "en", "A", 3.0, 2.0), ("way", 4, "Q1", None, None, 3.0, 9.0), ("way", 1, "Q2", None, None, None, 5.0),
        ("relation", 70, None, None, None, 8.0, None), ("way", 70, None, None, None, 99.0, None), ("way", 8, None, "de", "A", 50.0, 1.0), ("way", 9, "Q3", None, None, 0.0, 1.0),
    ]
    f = spark.createDataFrame(features, "osm_type string, osm_id long, qid string, wiki_lang string, wiki_title string, extent_km float, area_km2 float")
    p = spark.createDataFrame([(1, "Q1", "A", None), (2, "Q2", "B", None), (3, "", "C", 70), (4, "Q3", "D", None)], "page_id int, qid string, title string, osm_relation long")
    assert sorted(map(tuple, extents.largest_extent(p, f).collect())) == [(1, 3.0, 2.0, "relation/4"), (3, 8.0, None, "relation/70")]


def test_build_end_to_end(spark, tmp_path):
    props = r"INSERT INTO `page_props` VALUES (10,'wikibase_item','Q1',NULL),(10,'wikibase-shortdesc','it\'s',NULL),(11,'wikibase_item','Q4',NULL),(12,'wikibase_item','Q2',NULL),(13,'wikibase_item','Q1',NULL);"
    tags = "INSERT INTO `geo_tags` VALUES (1,10,'earth',1,48.5,2.5,1000,'city',NULL,'FR');"
    page = r"INSERT INTO `page` VALUES (10,0,'Lake_O\'X',0,0,0.1,'','',1,2048,'w',NULL),(11,0,'Plain',0,0,0.1,'','',1,0,'w',NULL),(13,1,'Talk',0,0,0.1,'','',1,5,'w',NULL);"
    inputs = build.Inputs(
        triples=triples.triples(lines(spark, TRIPLES)),
        page_props=insert_dump.page_props(insert_dump.tuples(lines(spark, [props]), "page_props")),
        geo_tags=insert_dump.geo_tags(insert_dump.tuples(lines(spark, [tags]), "geo_tags")),
        pages=insert_dump.pages(insert_dump.tuples(lines(spark, [page]), "page")),
        link_targets=links.link_targets(lines(spark, [r"INSERT INTO `linktarget` VALUES (5,0,'Lake_O\'X');"])),
        page_links=links.page_links(lines(spark, ["INSERT INTO `pagelinks` VALUES (10,0,5),(11,0,5),(11,3,5);"])),
        labels=spark.createDataFrame([("Q50", "lake"), ("Q60", "France")], "qid string, label string"),
        views=pageviews.views(lines(spark, ["en.wikipedia Lake_O'X 10 desktop 7 A7"])).select(F.lit("2026-01").alias("month"), "page_id", "title", "views"),
        features=osm_tsv.features(lines(spark, ["<https://www.openstreetmap.org/way/3>\tQ1\t\tPOLYGON((2 48,2.1 48,2.1 48.1))\t5e6"])),
        sampler=lambda tile, points: [123.9] * len(points),
    )
    out = build.build(inputs).cache()
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in ARTICLE]
    got = {r["page_id"]: r for r in out.collect()}
    assert set(got) == {10, 11}
    a, b = got[10], got[11]
    assert (a["label"], a["description"], a["instance_of"], a["instance_of_qid"], a["country"]) == ("Lake O'X", "it's", "lake", "Q50", "France")
    assert (a["gt_type"], a["page_len"], a["inlink_count"], a["pageviews_month"], a["elevation"], a["osm_source"]) == ("city", 2048, 2, 7, 123, "way/3")
    assert a["wikipedia_url"].endswith("/Lake_O'X") and a["image_url"] == "https://c/a.jpg"
    assert struct.unpack("<bIdd", bytes(a["geometry"])) == (1, 1, 2.5, 48.5)
    # a class without an English label keeps its identifier only
    assert (b["instance_of"], b["instance_of_qid"], b["pageviews_month"], b["osm_source"], b["related_images"]) == ("", "Q99", None, None, [])

    result = {r["name"]: r["passed"] for r in checks.run_checks(out, checks.Bounds(rows=(1, 5))).collect()}
    assert result["instance_of implies instance_of_qid"] and result["extent, area and source agree"] and not result["some article has many inlinks"]
    assert not result["Mount Rushmore: pageviews_month within 10000 to 1e+06"] and result["Lake Superior: extent_km within 500 to 700"]
    assert "enough articles have views" not in {r["name"] for r in checks.run_checks(out.drop("pageviews_month")).collect()}

    assert checks.missing_labels(out).count() == len(checks.WELL_KNOWN)

    parts = reports.extent_coverage(out, inputs.features, inputs.views, 10)
    assert tuple(parts["overall"].first()) == (2, 1) and tuple(parts["summary"].first()) == (1, 1, 1)
    seen = reports.view_coverage(out, inputs.views, ["Lake O'X", "Plain"])
    assert tuple(seen["overall"].first()) == (2, 1) and sorted(map(tuple, seen["named"].collect())) == [("Lake O'X", 7), ("Plain", None)]


def points(spark, n=300):
    return spark.range(n).select(
        F.col("id").cast("int").alias("page_id"), F.concat(F.lit("P_"), "id").alias("title"), ((F.col("id") * 7919) % 36000 / 100.0 - 180).alias("lon"),
        ((F.col("id") * 104729) % 18000 / 100.0 - 90).alias("lat"), (F.col("id") % 50).cast("int").alias("inlink_count"),
    )


def test_geoparquet(spark, tmp_path):
    made = assemble.assemble(points(spark))
    out = tmp_path / "articles"
    files_ = geoparquet.write_geoparquet(made, str(out), {"pageviews_months": "2026-01"}, row_group=40, parts=3).collect()
    assert sum(r["n"] for r in files_) == 300 and not [p for p in out.iterdir() if p.name.startswith("_")]
    first = pq.ParquetFile(out / sorted(r["file"] for r in files_)[0])
    meta = {k.decode(): v.decode() for k, v in first.metadata.metadata.items()}
    geo = json.loads(meta["geo"])
    assert geo["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"] and meta["pageviews_months"] == "2026-01"
    assert first.metadata.row_group(0).num_rows == 40 and first.metadata.row_group(0).column(0).compression == "ZSTD"
    back = spark.read.parquet(str(out))
    assert back.count() == 300 and sorted(map(str, back.select("page_id", "geometry", "bbox").collect())) == sorted(map(str, made.select("page_id", "geometry", "bbox").collect()))
    assert all(r["passed"] for r in checks.file_checks(spark, [str(out / r["file"]) for r in files_]).collect())
    assert duckdb.sql(f"SELECT count(*) FROM '{out}/*.parquet' WHERE bbox.xmin BETWEEN 0 AND 90").fetchall()[0][0] == back.where("bbox.xmin BETWEEN 0 AND 90").count()
    one = str(out / files_[0]["file"])
    geoparquet.add_metadata(one, {"extra": "1"})
    again = pq.ParquetFile(one)
    assert again.metadata.metadata[b"extra"] == b"1" and b"geo" in again.metadata.metadata and again.metadata.row_group(0).num_rows == 40


def test_extract_with_metadata(spark, tmp_path):
    rows = spark.createDataFrame([("2026-01", None, "b", 1), ("2026-01", 7, None, 2), ("2026-01", 3, None, 2)], "month string, page_id int, title string, views long")
    made = geoparquet.write_extract(rows.coalesce(1), str(tmp_path / "m"), {"source": "x", "complete": "true"}, ["month"]).collect()
    path = str(tmp_path / "m" / made[0]["file"])
    assert sum(r["n"] for r in made) == 3 and footers.is_complete(path) and pq.ParquetFile(path).metadata.metadata[b"source"] == b"x"
    geoparquet.add_metadata(path, geoparquet.build_metadata(["2025-12", "2026-01"], 12, None))
    assert footers.recorded_months(path) == ["2025-12", "2026-01"]


def test_box_reaches_the_scan(spark, tmp_path):
    geoparquet.write_geoparquet(assemble.assemble(points(spark)), str(tmp_path / "a"), parts=2)
    plan = serve.in_box(spark.read.parquet(str(tmp_path / "a")), 0, 0, 10, 10)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(bbox.xmin,0.0)" in plan and "TakeOrderedAndProject" in plan and "related_images" not in plan.split("ReadSchema")[1]


def test_search(spark, tmp_path):
    rows = [("Paris", 1.0, 2.0, 50), ("Parma", 1.0, 2.0, 60), ("Paré", 1.0, 2.0, 70), ("Lyon", 1.0, 2.0, 80)]
    index = spark.createDataFrame(rows, "label string, lon double, lat double, inlink_count int").withColumn("label", F.lower("label"))
    assert [r["label"] for r in serve.search(index, "PAR").collect()] == ["parma", "paris"]
    assert [r["label"] for r in serve.begins_with(index, "par").collect()] == ["paré", "parma", "paris"]
    assert serve.search(index, "  ").count() == 0 and serve.search(index, "x' OR 1=1").count() == 0
    files.write_search_index(assemble.assemble(points(spark)), str(tmp_path / "s"))
    labels = [r["label"] for r in spark.read.parquet(str(tmp_path / "s")).collect()]
    assert sorted(labels) == sorted(f"p {i}" for i in range(300))
    plan = serve.search(spark.read.parquet(str(tmp_path / "s")), "p 1")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(label,p 1)" in plan and "LessThan(label,p 1~)" in plan


def test_features_and_caches(spark, tmp_path):
    files.write_features(assemble.assemble(points(spark, 3)), str(tmp_path / "f"))
    rows = [json.loads(x["value"]) for x in spark.read.text(str(tmp_path / "f")).collect()]
    assert {r["properties"]["page_id"] for r in rows} == {0, 1, 2} and rows[0]["geometry"]["type"] == "Point"
    small = spark.range(3)
    files.write_cache(small, str(tmp_path / "c"))
    files.write_cache(spark.range(9), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 3
    files.write_cache(spark.range(9), str(tmp_path / "c"), force=True)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 9
    old, new = (spark.createDataFrame(r, "qid string, label string") for r in ([("Q1", "a"), ("Q2", "ü")], [("Q2", "c"), ("Q3", 'd"')]))
    assert files.write_label_cache(old, new, str(tmp_path / "l.json")) == 3
    assert json.loads((tmp_path / "l.json").read_text()) == {"Q1": "a", "Q2": "c", "Q3": 'd"'}


def test_monthly_ingest_adds_new_whole_files_only(spark, tmp_path):
    source, out, seen = (str(tmp_path / x) for x in ("in", "out", "seen"))
    (tmp_path / "in").mkdir()
    add = lambda name, *rows: (tmp_path / "in" / name).write_text("\n".join([*rows, ""]))
    later = "fr.wikipedia A 1 desktop 9 A9"
    add("pageviews-202601.txt", "en.wikipedia A 1 desktop 3 A3", later)
    monthly.ingest_months(spark, source, out, seen)
    add("pageviews-202602.txt", "en.wikipedia A 1 desktop 5 A5", "en.wikipedia B null desktop 1 A1", later)
    add("pageviews-202603.txt", "en.wikipedia A 1 desktop 70 A5")  # ends within the project
    add("pageviews-202604.txt", later)  # has nothing of it
    monthly.ingest_months(spark, source, out, seen)
    add("pageviews-202601-b.txt", "en.wikipedia A 1 desktop 4 A4", "en.wikipedia C 2 desktop 6 A6", later)  # more of a month that is there
    monthly.ingest_months(spark, source, out, seen)
    monthly.ingest_months(spark, source, out, seen)
    got = sorted(map(str, (tuple(r) for r in monthly.months(spark, out).select("month", "page_id", "views").collect())))
    assert got == sorted(map(str, [("2026-01", 1, 7), ("2026-01", 2, 6), ("2026-02", 1, 5), ("2026-02", None, 1)]))
    assert sorted(r[0] for r in monthly.refused(spark, out).collect()) == ["pageviews-202603.txt", "pageviews-202604.txt"]


def test_tally_and_require(spark):
    results = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "name string, passed boolean")
    assert tuple(checks.tally(results).first()) == (1, 2) and checks.require(results.where("name = 'a'")) == 1
    with pytest.raises(checks.ChecksFailed, match="2 of 3: b; c"):
        checks.require(results)
