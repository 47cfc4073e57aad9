import datetime
import struct

from pyspark.sql import functions as F

from cairnspark.functions import display, geo, months, rdf, titles


def column(spark, values, kind, made):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", made(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_points(spark):
    wkt = "^^<http://www.opengis.net/ont/geosparql#wktLiteral>"
    values = [
        '"Point(2.5 48.25)"' + wkt,
        '"<http://www.wikidata.org/entity/Q405> Point(1 1)"' + wkt,
        '"<http://www.wikidata.org/entity/Q2> Point(-1 90)"' + wkt,
        '"Point(0 90.5)"' + wkt, '"Point(180 -90)"' + wkt, '"Point(x y)"' + wkt, "no point", None,
    ]
    got = column(spark, values, "string", rdf.point)
    assert [None if p is None else tuple(p) for p in got] == [(48.25, 2.5), None, (90.0, -1.0), None, (-90.0, 180.0), None, None, None]


def test_literals(spark):
    assert column(spark, ['"+12"', '"12.5"^^<d>', '"-3"', '"x"', '"99999999999999999999"'], "string", rdf.whole_number) == [12, 12, -3, None, None]
    assert column(spark, ['"123"', '"12a"', "<u>"], "string", rdf.digits) == [123, None, None]
    assert column(spark, ["<http://a/http://b>", "<https://c>", "x"], "string", rdf.secure_uri) == ["https://a/http://b", "https://c", None]
    assert column(spark, ["<http://www.wikidata.org/entity/Q7>", '"Q7"'], "string", rdf.entity) == ["Q7", None]


def test_wiki_reference(spark):
    values = [
        "<https://en.wikipedia.org/wiki/Saint-%C3%89tienne%20x>", "<https://de.wikipedia.org/wiki/A+B>", '"en:lake x"', "en:lake", '"fr:élan"^^<s>',
        '"en: "', "nothing", "", None,
    ]
    got = column(spark, values, "string", titles.wiki_reference)
    assert [None if v is None else tuple(v) for v in got] == [("en", "Saint-Étienne_x"), ("de", "A+B"), ("en", "Lake_x"), ("en", "Lake"), ("fr", "Élan"), None, None, None, None]


def test_envelope_and_extent(spark):
    values = ['"POLYGON((1 2,3 4,1 4))"^^<d25>', '"POLYGON((1e-05 2,1 3))"', "POINT(5)", ""]
    got = column(spark, values, "string", geo.envelope)
    assert [None if v is None else tuple(v) for v in got] == [(1.0, 2.0, 3.0, 4.0), (1e-05, 2.0, 1.0, 3.0), None, None]
    made = lambda v: geo.extent_km(v[0], v[1], v[2], v[3])
    assert [None if x is None else round(x, 3) for x in column(spark, [[0.0, 0.0, 1.0, 0.5], [-170.0, 0.0, 170.0, 1.0]], "array<double>", made)] == [111.319, None]
    assert column(spark, ['"2000000"^^<x>', '"0"', '"-5"', "x", '"5e5"'], "string", geo.area_km2) == [2.0, None, None, None, 0.5]


def test_well_known_binary(spark):
    values = [0.0, 1.0, -1.0, 2.3522, 48.8566, -179.99999999, 1e-7, 90.0, 0.1 + 0.2, 5e-324 * 0, 2.0**-10, 4.0, 7.999999999999999, -0.5]
    got = column(spark, values, "double", lambda v: geo.wkb_point(v, -v))
    for v, b in zip(values, got, strict=True):
        order, kind, x, y = struct.unpack("<bIdd", bytes(b))
        assert (order, kind, x, y) == (1, 1, v, -v)
    back = column(spark, values, "double", lambda v: geo.wkb_xy(geo.wkb_point(v, -v)))
    assert [tuple(p) for p in back] == [(v, -v) for v in values]
    assert column(spark, [b"", b"\x01\x02\x00\x00\x00", None], "binary", geo.wkb_xy) == [None, None, None]


def test_dem_tile(spark):
    got = column(spark, [[48.85, 2.35], [-0.5, -0.5], [0.0, 0.0], [-33.9, 151.2]], "array<double>", lambda v: geo.dem_tile(v[0], v[1]))
    assert [g.removeprefix("Copernicus_DSM_COG_10_").removesuffix("_DEM") for g in got] == ["N48_00_E002_00", "S01_00_W001_00", "N00_00_E000_00", "S34_00_E151_00"]
    assert column(spark, [3.0, 3.5], "double", geo.off_the_edge) == [3.001, 3.5]


def test_hilbert_neighbours_are_close(spark):
    step = 360 / 256
    df = spark.range(256 * 256).select((F.col("id") % 256).alias("x"), F.floor(F.col("id") / 256).alias("y"))
    keyed = df.select("x", "y", geo.hilbert((F.col("x") + 0.5) * step - 180, (F.col("y") + 0.5) * step / 2 - 90, 8).alias("d")).orderBy("d").collect()
    assert [r["d"] for r in keyed] == list(range(256 * 256))
    assert all(abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) == 1 for a, b in zip(keyed, keyed[1:]))


def test_display(spark):
    assert column(spark, ["the lake of the woods", "of mice", "a  b", ""], "string", display.title_case) == ["The Lake of the Woods", "Of Mice", "A  B", ""]
    assert column(spark, [5, 1000, 1_250_000, 999], "long", display.people) == ["5 pop", "1.0K pop", "1.3M pop", "999 pop"]
    assert column(spark, [0, 280 * 280, 10**9, 140 * 140], "long", display.circle_radius) == [2.5, 20.0, 20.0, 11.25]


def test_months(spark):
    day = datetime.date(2026, 3, 31)
    assert months.month_names(4, day) == ["2025-11", "2025-12", "2026-01", "2026-02"]
    assert months.month_names(3, day, current=True) == ["2026-03", "2026-02", "2026-01"]
    for current in (False, True):
        assert [r["month"] for r in months.months_before(spark, 12, day, current).orderBy("back" if current else F.desc("back")).collect()] == months.month_names(12, day, current)
