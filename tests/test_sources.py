"""Readers and writers on small files written under a fresh staging folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from metrolens.session import staging_path
from metrolens.sources import profile, read_csv, read_geojson, split_fields
from metrolens.operators import union_all


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)
    return os.path.join(path, name)


def _local(spark, name):
    p = staging_path(spark, name)
    return p[len("file:"):] if p.startswith("file:") else p


FEATURES = [
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90001", "POP20": 5}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": 90001, "POP20": "12"}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90002", "POP20": 0}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "", "POP20": 7}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": None, "POP20": 7}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"POP20": 7}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90003", "POP20": None}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90003"}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": 0, "POP20": 3}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90004", "POP20": "0"}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90005", "POP20": 0.5}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90006", "POP20": 0.0}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": False, "POP20": 4}},
    {"type": "Feature", "geometry": {"type": "Polygon"}, "properties": {"ZCTA20": "90007", "POP20": []}},
]


def test_geojson_layouts(spark):
    doc = {"type": "FeatureCollection", "features": FEATURES}
    base = _local(spark, "geojson-fixture")
    pretty = _write(base + "/pretty", "a.geojson", json.dumps(doc, indent=2))
    single = _write(base + "/single", "a.geojson", json.dumps(doc))
    lines = '{"type": "FeatureCollection", "features": [\n' + ",\n".join(json.dumps(f) for f in FEATURES) + "\n]}\n"
    per_line = _write(base + "/lines", "a.geojson", lines)
    expected = [("90001", 5), ("90001", 12), ("90004", 0), ("90005", 0)]
    cases = [(pretty, "document"), (single, "document"), (per_line, "lines"), (single, "lines")]
    cases += [(pretty, "split"), (single, "split"), (per_line, "split")]
    for path, layout in cases:
        got = sorted(tuple(r) for r in read_geojson(spark, path, layout=layout).collect())
        assert got == expected, (path, layout)


def _small_splits(spark, size):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    return old


def test_geojson_split_layout_across_many_blocks(spark):
    # Features cross block boundaries, strings hold brackets, quotes and
    # escapes, several features share a line, one feature spans many blocks,
    # and a root-level crs object and bbox sit beside the features.
    from metrolens.sources import read_features

    rng_props = [{"ZCTA20": f"9{i:04d}", "POP20": i, "note": ("}{][\\\"," * (i % 4)) + "x"} for i in range(120)]
    feats = [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [i, -i]}, "properties": p} for i, p in enumerate(rng_props)]
    feats[7]["geometry"] = {"type": "Polygon", "coordinates": [[[j, j + 0.5] for j in range(300)]]}
    head = '{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x{"}},\n "bbox": [0, 1],\n "features": [\n'
    body = []
    for i, f in enumerate(feats):
        text = json.dumps(f, indent=2) if i % 3 else json.dumps(f)
        body.append(text)
    # Features 0..2 on one line; the rest one after another.
    text = head + ", ".join(body[:3]) + ",\n" + ",\n".join(body[3:]) + "\n]}\n"
    base = _local(spark, "geojson-split")
    path = _write(base, "big.geojson", text)
    props = "struct<ZCTA20:string, POP20:string, note:string>"
    want = sorted((f["properties"]["ZCTA20"], f["properties"]["note"], f["geometry"]["type"]) for f in feats)
    old = _small_splits(spark, 512)
    try:
        df = read_features(spark, path, props, layout="split")
        got = sorted((r.properties.ZCTA20, r.properties.note, r.geometry.type) for r in df.collect())
        blocks = spark.read.text(path).select("_metadata.file_block_start").distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert blocks > 50
    assert got == want
    doc = sorted(
        (r.properties.ZCTA20, r.properties.note, r.geometry.type) for r in read_features(spark, path, props, "document").collect()
    )
    assert doc == want


def test_split_fields_rules(spark):
    base = _local(spark, "split-fixture")
    path = _write(base, "income.csv", "Zip;Name;Income\n\n 90001 ;A;$1,000\n90002;B\n90003;C;\n   \n90004;D;$5;extra\n")
    got = sorted(tuple(r) for r in split_fields(spark, path, ";", 3, keep=[0, 2], names=["z", "m"]).collect())
    assert got == [("90001", "$1,000"), ("90003", ""), ("90004", "$5")]


def test_csv_union_by_name_with_trimmed_headers(spark):
    base = _local(spark, "csv-fixture")
    a = _write(base + "/a", "a.csv", "AREA ,TIME OCC\n1,0830\n")
    b = _write(base + "/b", "b.csv", "AREA,TIME OCC\n2,1200\n")
    dfs = [read_csv(spark, p, infer_schema=False) for p in (a, b)]
    assert dfs[0].columns == ["AREA", "TIME OCC"]
    got = sorted(tuple(r) for r in union_all(dfs).collect())
    assert got == [("1", "0830"), ("2", "1200")]


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a int, b string")
    got = {r.column_name: (r.data_type, r.row_count, r.null_count) for r in profile(df).collect()}
    assert got == {"a": ("int", 3, 1), "b": ("string", 3, 1)}


def test_convert_csv_to_parquet_normalizes_names(spark):
    from metrolens.sources.parquet import convert_csv_to_parquet

    base = _local(spark, "convert-fixture")
    a = _write(base + "/a", "a.csv", "DR_NO,TIME OCC,Premis Desc\n1,0830,STREET\n")
    b = _write(base + "/b", "b.csv", "DR_NO,TIME OCC,Premis Desc\n2,1200,HOUSE\n")
    schema = "`DR_NO` bigint, `TIME OCC` string, `Premis Desc` string"
    out = convert_csv_to_parquet(spark, [a, b], schema, staging_path(spark, "converted"), ["premis_desc"], True)
    assert sorted(out.columns) == ["dr_no", "premis_desc", "time_occ"]
    assert sorted((r.dr_no, r.time_occ, r.premis_desc) for r in out.collect()) == [(1, "0830", "STREET"), (2, "1200", "HOUSE")]


def test_geojson_profile_mixed_types(spark):
    from metrolens.sources import profile_geojson

    base = _local(spark, "profile-fixture")
    lines = '{"type": "FeatureCollection", "features": [\n' + ",\n".join(json.dumps(f) for f in FEATURES) + "\n]}\n"
    path = _write(base, "a.geojson", lines)
    got = {(r.kind, r.name, r.value_type): r.features for r in profile_geojson(spark, path, layout="lines").collect()}
    assert got[("feature_type", "Feature", None)] == 14
    assert got[("geometry_type", "Polygon", None)] == 14
    # ZCTA20: strings in features 1, 3, 4, 7, 8, 10, 11, 12, 14; numbers in 2 and 9; null in 5; absent in 6.
    assert got[("property", "ZCTA20", "STRING")] == 9
    assert got[("property", "ZCTA20", "BIGINT")] == 2
    assert got[("property", "ZCTA20", "VOID")] == 1
    assert got[("property", "ZCTA20", "BOOLEAN")] == 1
    # POP20: whole numbers in 1, 3, 4, 5, 6, 9, 13; strings in 2 and 10; null in 7; absent in 8.
    assert got[("property", "POP20", "BIGINT")] == 7
    assert got[("property", "POP20", "STRING")] == 2
    assert got[("property", "POP20", "VOID")] == 1


def test_split_fields_skips_each_files_header(spark):
    base = _local(spark, "split-multi")
    a = _write(base, "a.csv", "Zip;Name;Income\n90001;A;$1\n")
    b = _write(base, "b.csv", "\nZip;Name;Income\n90002;B;$2\n")
    got = sorted(tuple(r) for r in split_fields(spark, [a, b], ";", 3, keep=[0, 2]).collect())
    assert got == [("90001", "$1"), ("90002", "$2")]


def test_geojson_profile_same_over_all_layouts(spark):
    from metrolens.sources import profile_geojson

    base = _local(spark, "profile-layouts")
    doc = {"type": "FeatureCollection", "features": FEATURES}
    pretty = _write(base + "/pretty", "a.geojson", json.dumps(doc, indent=2))
    lines = _write(base + "/lines", "a.geojson", '{"type": "FeatureCollection", "features": [\n' + ",\n".join(json.dumps(f) for f in FEATURES) + "\n]}\n")

    def prof(path, layout):
        return sorted(tuple(r) for r in profile_geojson(spark, path, layout=layout).collect())

    want = prof(lines, "lines")
    assert prof(pretty, "document") == want
    assert prof(pretty, "split") == want


def _feature(i):
    return {"type": "Feature", "geometry": {"type": "Point"}, "properties": {"ZCTA20": str(90000 + i), "POP20": i + 1}}


@pytest.mark.parametrize("layout", ["document", "lines", "split"])
@pytest.mark.parametrize("cut", [0.5, 0.98, "footer"])
def test_cut_off_geojson_fails(spark, layout, cut):
    base = _local(spark, "geojson-cut-off")
    doc = {"type": "FeatureCollection", "features": [_feature(i) for i in range(50)]}
    lines = '{"type": "FeatureCollection", "features": [\n' + ",\n".join(map(json.dumps, doc["features"])) + "\n]}\n"
    text = lines if layout == "lines" else json.dumps(doc, indent=1)
    assert read_geojson(spark, _write(base + "/whole", "a.geojson", text), layout=layout).count() == 50
    end = text.rindex("]") if cut == "footer" else int(len(text) * cut)
    path = _write(base + "/part", "a.geojson", text[:end])
    with pytest.raises(Exception, match="cut off|not closed|neither|JSON|malformed|Malformed"):
        read_geojson(spark, path, layout=layout).collect()


def test_geojson_in_another_layout_fails(spark):
    base = _local(spark, "geojson-layout")
    pretty = _write(base, "a.geojson", json.dumps({"type": "FeatureCollection", "features": [_feature(1)]}, indent=1))
    other = _write(base + "/other", "b.geojson", json.dumps({"type": "Topology", "features": [_feature(1)]}))
    with pytest.raises(Exception, match="neither a feature"):
        read_geojson(spark, pretty, layout="lines").collect()
    for layout in ("document", "lines"):
        with pytest.raises(Exception, match="FeatureCollection|neither a feature"):
            read_geojson(spark, other, layout=layout).collect()


@pytest.mark.parametrize("text", ["x" * 1_000_000, '\\"{' * 300_000])
def test_geojson_split_takes_long_strings(spark, text):
    base = _local(spark, "geojson-long")
    features = [_feature(1), _feature(2)]
    features[0]["properties"]["note"] = text
    path = _write(base, "a.geojson", json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = sorted(tuple(r) for r in read_geojson(spark, path, layout="split").collect())
    assert got == [("90001", 2), ("90002", 3)]


def test_geojson_split_reads_the_features_member_only(spark):
    base = _local(spark, "geojson-members")
    doc = {
        "type": "FeatureCollection",
        "meta": {"sample": _feature(90), "list": [_feature(91)]},
        "old": [_feature(92)],
        "features": [_feature(i) for i in range(40)],
        "after": [_feature(93)],
    }
    path = _write(base, "a.geojson", json.dumps(doc, indent=1))
    want = sorted((str(90000 + i), i + 1) for i in range(40))
    for size in (1 << 20, 300):
        old = _small_splits(spark, size)
        try:
            got = sorted(tuple(r) for r in read_geojson(spark, path, layout="split").collect())
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        assert got == want
    assert sorted(tuple(r) for r in read_geojson(spark, path, layout="document").collect()) == want


def test_geojson_split_by_shuffle_above_the_broadcast_bound(spark, monkeypatch):
    from metrolens.sources import json_split

    monkeypatch.setattr(json_split, "MAX_BROADCAST_BLOCKS", 0)
    base = _local(spark, "geojson-shuffled")
    doc = {"type": "FeatureCollection", "features": [_feature(i) for i in range(60)]}
    path = _write(base, "a.geojson", json.dumps(doc, indent=1))
    old = _small_splits(spark, 500)
    try:
        got = sorted(tuple(r) for r in read_geojson(spark, path, layout="split").collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted((str(90000 + i), i + 1) for i in range(60))


def test_split_fields_keeps_lines_with_any_character(spark):
    base = _local(spark, "split-odd")
    odd = "".join(map(chr, [1, 0, 2, 0x85, 0x2028]))
    path = _write(base, "a.csv", f"Zip;Name;Income\n1;a\u0001b;$5;x\n2;{odd};$6\n\u00013;c;$7\n4;\"d;$8\n")
    got = sorted(tuple(r) for r in split_fields(spark, path, ";", 3, keep=[0, 2]).collect())
    assert got == [("\u00013", "$7"), ("1", "$5"), ("2", "$6"), ("4", "$8")]


def test_csv_header_must_name_the_schema(spark):
    base = _local(spark, "csv-header")
    _write(base, "a.csv", "x,y\n1,2\n")
    _write(base, "b.csv", "y,x\n3,4\n")
    with pytest.raises(Exception, match="header|Header"):
        read_csv(spark, base, schema="x int, y int").collect()
    assert read_csv(spark, base + "/a.csv", schema="x int, y int").collect() == [(1, 2)]
    assert read_csv(spark, base, schema="x int, y int", check_header=False).count() == 2


def test_samples(spark):
    from metrolens.sources import sample_lines, sample_rows

    base = _local(spark, "samples")
    path = _write(base, "a.txt", "\n".join("z" * (i % 300) for i in range(400)))
    got = sample_lines(spark, path, n=250, width=200).collect()
    assert len(got) == 250 and max(len(r.value) for r in got) == 200
    assert sample_rows(spark.range(50), 7).count() == 7


ODD_KEYS = {"fea}tures": [{"a": 1}], "b[": {"x": {"y": [1, {"z": "}"}]}}, "c\\": [[1, [2]], {"k": "\\"}], 'q"': 3}


def _odd_document():
    """Strings with brackets, quotes and escapes, keys that hold braces, a feature over many
    blocks, and other members with nested arrays before and after the features."""
    features = [_feature(i) for i in range(60)]
    for i, f in enumerate(features):
        f["properties"]["note"] = ('}{][\\",\n' * (i % 5)) + "x" * (i % 7) + "\\" * (i % 3) + "é"
    features[9]["geometry"] = {"type": "Polygon", "coordinates": [[[j, j + 0.5] for j in range(400)]]}
    features[20]["properties"]["note"] = "no brace " * 300
    doc = {"type": "FeatureCollection", **ODD_KEYS, "crs": {"name": "x{", "old": [[_feature(900)]]}}
    doc |= {"features": features, "after": [[list(range(300)), [_feature(901)]], _feature(902)], "end": {}}
    return doc


@pytest.mark.parametrize("text,size", [("one", 150), ("one", 1 << 20), ("indented", 400), ("followed", 300)])
def test_geojson_on_one_line_splits(spark, size, text):
    from metrolens.sources import read_features
    from metrolens.sources.json_split import read_records

    doc = _odd_document()
    rendered = json.dumps(doc, indent=1) if text == "indented" else json.dumps(doc)
    path = _write(_local(spark, "geojson-one"), "a.geojson", rendered + (" \r\n\t" if text == "followed" else ""))
    want = sorted((f["properties"]["ZCTA20"], f["properties"]["note"]) for f in doc["features"])
    old = _small_splits(spark, size)
    try:
        df = read_features(spark, path, "struct<ZCTA20:string, note:string>", "split")
        got = sorted((r.properties.ZCTA20, r.properties.note) for r in df.collect())
        tasks = read_records(spark, [path]).rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want
    assert tasks > (20 if size < 1000 else 0)


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_geojson_on_one_line_cut_anywhere_fails(spark, size):
    base = _local(spark, "geojson-one-cut")
    doc = json.dumps({"type": "FeatureCollection", "features": [_feature(i) for i in range(12)], "z": {"a": "b}"}})
    cuts = [len(doc) - 1, len(doc) - 2, len(doc) - 4, len(doc) // 2, doc.index("}") + 1, doc.index("}"), 40]
    old = _small_splits(spark, size)
    try:
        for i, cut in enumerate(cuts):
            path = _write(f"{base}/{i}", "a.geojson", doc[:cut])
            with pytest.raises(Exception, match="cut off"):
                read_geojson(spark, path, layout="split").collect()
        for i, text in enumerate([doc + doc, doc + " x", doc + "}", "[" + doc + "]", doc + " {}"]):
            path = _write(f"{base}/more{i}", "a.geojson", text)
            with pytest.raises(Exception, match="cut off|text behind|does not begin"):
                read_geojson(spark, path, layout="split").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _collection(n, head='"type": "FeatureCollection", ', tail="", extra=""):
    features = ",\n".join(
        '{"type": "Feature", "geometry": {"type": "Point"}, "properties": {"ZCTA20": "9%04d", "POP20": %d, "t": "a}\\"{["}}' % (i % 50, i)
        for i in range(1, n + 1)
    )
    return "{" + head + '"crs": {"type": "name", "properties": {"name": "x"}}, "features": [' + features + extra + "]" + tail + "}\n"


def test_a_large_document_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    from metrolens.sources import geojson, read_features

    props = "struct<ZCTA20:string, POP20:bigint, t:string>"
    path = tmp_path / "d"
    path.mkdir()
    (path / "a.json").write_text(_collection(3000, extra=", null"))
    (path / "b.json").write_text(_collection(2, head="", tail=', "type": "FeatureCollection"'))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        whole = read_features(spark, str(path), props)
        want = sorted(map(repr, whole.collect()))
        assert len(want) == 3003
        for size in (10_000, 10):  # one file of two, both
            monkeypatch.setattr(geojson, "WHOLE", size)
            got = read_features(spark, str(path), props)
            assert sorted(map(repr, got.collect())) == want
            assert got.rdd.getNumPartitions() > 2
        for bad in (
            _collection(9, head=""),
            _collection(9, head='"type": "Feature", '),
            _collection(9, extra=", 5"),
            _collection(9, extra=", [{}]"),
            _collection(9).replace('"features": [', '"other": ['),
            _collection(9)[:-3],
        ):
            (tmp_path / "bad.json").write_text(bad)
            monkeypatch.setattr(geojson, "WHOLE", 10)
            with pytest.raises(Exception):
                read_features(spark, str(tmp_path / "bad.json"), "string").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
