import json
import os

from pyspark.sql import functions as F

from enrichkit.operators.nested import drop, flatten, flatten_countries, narrow, rename, with_columns
from enrichkit.schemas import raw_country_schema
from enrichkit.sources.documents import read_documents

DOCS = [
    {"name": {"common": "Aland", "official": "Aland Islands"}, "cca2": "AX", "cca3": "ALA",
     "capital": ["Mariehamn"], "region": "Europe", "subregion": "Northern Europe",
     "area": 1580.0, "population": 29458, "latlng": [60.116667, 19.9],
     "currencies": {"EUR": {"name": "Euro", "symbol": "E"}}},
    {"name": None, "cca2": "XX", "cca3": "XXX", "capital": None, "region": None,
     "subregion": "", "area": 0, "population": 5, "latlng": [1.0], "currencies": None},
    {"name": {"common": "Sao Tome", "official": "São Tomé"}, "cca3": "STP", "capital": [],
     "area": -1.0, "population": 1.5, "latlng": [1.0, 2.0, 3.0], "currencies": {},
     "extra_field": 1},
    {"name": {"common": "Two", "official": "Two"}, "cca3": "TWO", "capital": ["A", "B"],
     "area": None, "population": 10, "latlng": None,
     "currencies": {"ZZZ": None, "AAA": {"name": "Alpha", "symbol": "A"}}},
]


def _write(tmp_table, lines=True):
    path = tmp_table("docs").replace("file:", "")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w", encoding="utf-8") as f:
        if lines:
            f.write("\n".join(json.dumps(d, ensure_ascii=False) for d in DOCS))
        else:
            json.dump(DOCS, f, ensure_ascii=False, indent=2)
    return path


def _check(rows):
    by_code = {r["country_code_3"]: r for r in rows}
    a = by_code["ALA"]
    assert a["common_name"] == "Aland" and a["capital_city"] == "Mariehamn"
    assert (a["latitude"], a["longitude"]) == (60.116667, 19.9)
    assert a["currency_code"] == "EUR" and a["currency_name"] == "Euro"
    assert a["population_density"] == 29458 / 1580.0
    x = by_code["XXX"]
    assert x["common_name"] is None and x["capital_city"] is None and x["subregion"] == ""
    assert x["latitude"] is None and x["population_density"] is None  # area 0
    s = by_code["STP"]
    assert s["population"] is None  # 1.5 is not a LONG -> NULL (PERMISSIVE)
    assert s["official_name"] == "São Tomé" and s["capital_city"] is None
    assert s["latitude"] is None and s["currency_code"] is None and s["population_density"] is None
    t = by_code["TWO"]
    assert t["capital_city"] == "A" and t["currency_code"] == "ZZZ" and t["currency_name"] is None
    assert t["population_density"] is None


def test_flatten_json_lines(spark, tmp_table):
    df = flatten_countries(read_documents(spark, _write(tmp_table), raw_country_schema()))
    assert df.columns[-1] == "population_density" and len(df.columns) == 14
    _check(df.collect())


def test_flatten_multiline_array(spark, tmp_table):
    raw = read_documents(spark, _write(tmp_table, lines=False), raw_country_schema(), multi_line=True)
    _check(flatten_countries(raw).collect())


def test_scan_with_field_subset_prunes(spark, tmp_table):
    raw = read_documents(spark, _write(tmp_table), raw_country_schema(), fields=["cca3", "area"])
    assert raw.columns == ["cca3", "area"]
    assert raw.count() == 4


def test_truncated_multiline_file_gives_corrupt_record(spark, tmp_table):
    path = tmp_table("bad").replace("file:", "")
    os.makedirs(path)
    with open(os.path.join(path, "x.json"), "w") as f:
        f.write(json.dumps(DOCS)[:-20])
    raw = read_documents(
        spark, path, raw_country_schema(), multi_line=True, corrupt_column="_corrupt"
    )
    rows = raw.collect()
    assert len(rows) == 1 and rows[0]["_corrupt"] is not None


def test_generic_projection_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, s string, v double")
    out = flatten(df, [("key", "id"), ("twice", F.col("v") * 2)])
    assert out.columns == ["key", "twice"] and out.first()["twice"] == 4.0
    out = narrow(drop(with_columns(rename(df, {"s": "label"}), {"w": F.lit(1)}), "v"), "label", "w")
    assert out.columns == ["label", "w"]


def test_landing_sink_keeps_non_ascii_unescaped(spark, tmp_table):
    from enrichkit.sources.documents import write_documents

    path = tmp_table("land")
    df = spark.createDataFrame([("São Tomé", None)], "name string, capital string")
    write_documents(df, path)
    local = path.replace("file:", "")
    text = "".join(
        open(os.path.join(local, f), encoding="utf-8").read()
        for f in os.listdir(local) if f.endswith(".json")
    )
    assert '"name":"São Tomé"' in text and "capital" not in text
    back = spark.read.schema("name string, capital string").json(path).collect()
    assert [tuple(r) for r in back] == [("São Tomé", None)]


def test_multiline_scan_can_be_spread(spark, tmp_table):
    raw = read_documents(
        spark, _write(tmp_table, lines=False), raw_country_schema(), multi_line=True, partitions=4
    )
    assert raw.rdd.getNumPartitions() == 4
    _check(flatten_countries(raw).collect())
