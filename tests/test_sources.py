import bz2
import datetime
import gzip
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cairnspark.sources import caches, elevation, footers, insert_dump, labels, links, osm_tsv, pageviews, triples


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq long, value string")


def test_insert_tuples(spark):
    whole = r"INSERT INTO `t` VALUES (1,'it\'s),(a','x\\n\n\t\r\0\b\Z',NULL,-2.5),(2,'','NULL',NULL,bare);"
    rows = insert_dump.tuples(lines(spark, "CREATE TABLE `t`;", whole, "INSERT INTO `t` VALUES", "(3,'ü;','\"\\\"',7,1),", "(4);"), "t").orderBy("seq").collect()
    assert [r["fields"] for r in rows] == [
        ["1", "it's),(a", "x\\n\n\t\r\0\b\x1a", None, "-2.5"], ["2", "", "NULL", None, "bare"], ["3", "ü;", '""', "7", "1"], ["4"],
    ]
    typed = insert_dump.columns(insert_dump.tuples(lines(spark, whole), "t"), 5, id=(0, "int"), n=(4, "double")).orderBy("id").collect()
    assert [(r["id"], r["n"]) for r in typed] == [(1, -2.5), (2, None)]
    assert insert_dump.columns(insert_dump.tuples(lines(spark, "(1,2);"), "t"), 3, id=(0, "int")).count() == 0


def test_insert_long_strings(spark):
    long = "x" * 20_000 + r"\'" * 500
    rows = insert_dump.tuples(lines(spark, f"INSERT INTO `t` VALUES (1,'{long}'),(2,'y');"), "t").orderBy("seq").collect()
    assert [len(r["fields"][1]) for r in rows] == [20_500, 1]


def test_dump_file_with_broken_utf8(spark, tmp_path):
    with gzip.open(tmp_path / "p.sql.gz", "wb") as f:
        f.write(b"-- dump\nINSERT INTO `page` VALUES (1,0,'A\xff_b',0,0,0.5,'','',3,99,'wikitext',NULL);\n")
    row = insert_dump.pages(insert_dump.read_dump(spark, str(tmp_path / "p.sql.gz"), "page")).first()
    assert (row["page_id"], row["ns"], row["title"], row["is_redirect"], row["page_len"]) == (1, 0, "A�_b", 0, 99)


def test_links(spark):
    targets = links.link_targets(lines(spark, r"INSERT INTO `linktarget` VALUES (1,0,'O\'Hare),(5,0,'),(2,1,'Talk'),(3,0,'B');"))
    assert sorted(map(tuple, targets.collect())) == [(1, "O'Hare),(5,0,"), (3, "B")]
    assert sorted(r[0] for r in links.page_links(lines(spark, "INSERT INTO `pagelinks` VALUES (1,0,7),(2,4,7),(7,0,7);")).collect()) == [7, 7]


def test_triples(spark):
    w = "http://www.wikidata.org"
    rows = triples.triples(lines(spark, f"<{w}/entity/Q1> <{w}/prop/direct/P31> <{w}/entity/Q5> .", f"<{w}/entity/Q1> <{w}/prop/direct/P99> <{w}/entity/Q5> .", "broken", f'<{w}/entity/Q1> <{w}/prop/direct/P1082> "+3"^^<x> .')).orderBy("seq").collect()
    assert [(r["qid"], r["prop"], r["value"]) for r in rows] == [("Q1", "P31", f"<{w}/entity/Q5>"), ("Q1", "P1082", '"+3"^^<x>')]


VIEWS = ["de.wikipedia Z 1 desktop 9 A9", "en.wikipedia A 1 desktop 3 C3", "en.wikipedia A 1 mobile-web 4 D4", "en.wikipedia B null desktop 2 A2", "en.wikipedia B mobile 5 A5",
         "en.wikipedia Talk:A 3 desktop 9 A9", "en.wikipedia - 4 desktop 9 A9", "en.wikipedia C 5 desktop x A1", "en.wikipedia D 6", "en.wikipedia.m A 1 desktop 50 A1"]


def test_pageviews(spark, tmp_path):
    path = tmp_path / "pageviews-202601.bz2"
    path.write_bytes(bz2.compress("\n".join(VIEWS + ["fr.wikipedia A 1 desktop 1 A1"]).encode()))
    rows = pageviews.read_month(spark, str(path), "2026-01").collect()
    assert sorted((r["page_id"] or 0, r["title"] or "", r["views"]) for r in rows) == [(0, "B", 7), (1, "", 7)]
    path.write_bytes(bz2.compress("\n".join(VIEWS[:-1]).encode()))
    with pytest.raises(pageviews.PartialMonth):
        pageviews.read_month(spark, str(path), "2026-01")


def test_map_features(spark, tmp_path):
    osm, sep = "https://www.openstreetmap.org", "\t"
    rows = [
        ["?x", "?qid", "?wp", "?env", "?area"],
        [f"<{osm}/way/7>", '"Q5"', "<https://en.wikipedia.org/wiki/Lake%20X>", '"POLYGON((0 0,1 0,1 2))"^^<w>', '"3000000"^^<d>'],
        [f"<{osm}/relation/8>", "", '"en:pond"', '"POLYGON((-170 0,170 0,170 2))"', '"0"'],
        [f"<{osm}/node/9>", '"Q6"', "", '"POINT(1 1)"', ""],
        [f"<{osm}/way/10>", '"Q7"', "", "", "1"], [f"<{osm}/way/11>", "Q8"], [f"<{osm}/way/12>", "", "", '"POINT(1 1)"', "x"],
    ]
    (tmp_path / "a.tsv").write_text("\n".join(sep.join(r) for r in rows))
    got = {r["osm_id"]: r for r in osm_tsv.read_answers(spark, str(tmp_path)).collect()}
    assert set(got) == {7, 8, 12}
    assert (got[7]["qid"], got[7]["wiki_lang"], got[7]["wiki_title"], got[7]["area_km2"], round(got[7]["extent_km"], 2)) == ("Q5", "en", "Lake_X", 3.0, 221.14)
    assert (got[8]["qid"], got[8]["wiki_title"], got[8]["antimeridian"], got[8]["extent_km"], got[8]["area_km2"]) == (None, "Pond", True, None, None)
    assert got[12]["extent_km"] == 0
    (tmp_path / "b.tsv").write_text("<html>busy</html>\n")
    with pytest.raises(osm_tsv.UnexpectedAnswer):
        osm_tsv.read_answers(spark, str(tmp_path))


def test_paged():
    data = [f"row{i}" for i in range(7)]
    answers = list(osm_tsv.paged(lambda limit, offset: "\n".join(["?x\t?y", *data[offset : offset + limit]]), page=3))
    assert [len(a.splitlines()) - 1 for a in answers] == [3, 3, 1]


def test_labels(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps({"Q1": "one", "P2": "x", "Q3": "", "Q4": 5, "Q5": {"a": "b"}, "Q6": "true"}))
    assert sorted(map(tuple, labels.read_labels(spark, str(tmp_path / "l.json")).collect())) == [("Q1", "one"), ("Q6", "true")]
    (tmp_path / "l.json").write_text("{broken")
    assert labels.read_labels(spark, str(tmp_path / "l.json")).count() == 0
    keys = spark.range(120).select(F.format_string("Q%03d", "id").alias("qid"))
    made = labels.batches(keys, size=50).collect()
    assert sorted(k for r in made for k in r["keys"]) == [f"Q{i:03d}" for i in range(120)] and max(len(r["keys"]) for r in made) <= 50


def test_footers_and_caches(spark, tmp_path):
    def save(name, **flags):
        t = pa.table({"month": ["2026-01"], "page_id": pa.array([1], pa.int32()), "title": pa.array([None], pa.string()), "views": pa.array([3], pa.int64())})
        pq.write_table(t.replace_schema_metadata({k: str(v) for k, v in flags.items()}), tmp_path / name)

    save("2026-01.parquet", source="x", complete="true")
    save("2025-12.parquet", complete="false")
    save("2025-11.parquet")
    (tmp_path / "2025-10.parquet").write_text("no parquet")
    with pytest.warns(UserWarning):
        have = caches.month_paths(str(tmp_path), 5, datetime.date(2026, 2, 9))
    assert list(have) == ["2025-11", "2026-01"]
    assert caches.read_months(spark, list(have.values())).count() == 2
    assert ("source", "x") in {(r["key"], r["value"]) for r in footers.key_values(spark, [have["2026-01"]]).collect()}
    assert {r["name"]: r["type"] for r in footers.columns(spark, [have["2026-01"]]).collect()}["page_id"] == "INT32"
    save("extent-2025-12.parquet")
    assert caches.newest(str(tmp_path), datetime.date(2026, 2, 9)).endswith("extent-2025-12.parquet")
    assert caches.newest(str(tmp_path), datetime.date(2027, 2, 9)) is None


def test_old_entity_cache(spark, tmp_path):
    old = "qid string, lat double, lon double, instance_of string, country string, population long, geonames_id string, p18_image string, related_images array<string>"
    spark.createDataFrame([("Q1", 1.0, 2.0, "Q9", None, None, "", "", None)], old).write.parquet(str(tmp_path / "e"))
    row = caches.read_entities(spark, str(tmp_path / "e")).first()
    assert (row["instance_of_qid"], row["osm_relation"], row["country"], row["related_images"]) == ("Q9", None, "", [])


def test_elevation(spark):
    def sampler(tile, points):
        if "N01" in tile:
            raise OSError("no such tile")
        return [10.9 * (1 if lon == 2.001 else -1) for lon, lat in points]

    points = spark.createDataFrame([(1, 5.5, 2.0), (2, 5.5, 2.5), (3, 1.5, 2.5)], "page_id int, lat double, lon double")
    assert sorted(map(tuple, elevation.sample_elevations(points, sampler).collect())) == [(1, 10), (2, -10), (3, 0)]


def test_order_of_lines_holds_with_any_number_of_splits(spark, tmp_path):
    """Of splits far beyond a thousand and of several files, the order is that of paths and places."""
    place = lambda path, start, line: (path, start, line)
    rows = [(place("a", 0, 1 << 50), "INSERT INTO `t` VALUES (1,'x'),(2,'y');"), (place("a", 1 << 40, 0), "(3,'z');"), (place("b", 0, 0), "(4,'w');")]
    lines_ = spark.createDataFrame(rows, "seq struct<file: string, start: long, line: long>, value string")
    assert [r["fields"][0] for r in insert_dump.tuples(lines_, "t").orderBy("seq").collect()] == ["1", "2", "3", "4"]
    for name, text in (("2.sql", "(3,'a');"), ("1.sql", "(1,'b');\n(2,'c');")):
        (tmp_path / name).write_text(text)
    assert [r["fields"][0] for r in insert_dump.read_dump(spark, str(tmp_path), "t").orderBy("seq").collect()] == ["1", "2", "3"]


def test_page_numbers_beyond_their_type_are_none(spark):
    rows = pageviews.views(lines(spark, "en.wikipedia A 99999999999 desktop 3 C3", "en.wikipedia B 2147483647 desktop 1 C3")).collect()
    assert sorted((r["page_id"] or 0, r["title"], r["views"]) for r in rows) == [(0, "A", 3), (2147483647, None, 1)]


def test_available_months(spark, tmp_path):
    for name in ("pageviews-202601.bz2", "2026-02.parquet", "notes.txt", "_202603.tmp"):
        (tmp_path / name).write_text("x")
    assert sorted(map(tuple, caches.available_months(spark, str(tmp_path)).collect())) == [("2026-01", "pageviews-202601.bz2"), ("2026-02", "2026-02.parquet")]
