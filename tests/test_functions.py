import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import similarity as sim
from tessera.functions.text import clean_names, skeleton
from tessera.sources.tsv import read_tsv, write_tsv

GOLDEN = [
    ("Alto  + B3ta Company", {"name_clean": "alto and beta co", "name_core": "alto beta", "name_key": "alto beta", "name_skel": "alt bt", "name_nospace": "altobeta", "name_legal": "co", "is_domain": 0}),
    ("Harbor 5olar Pvt Ltd.", {"name_clean": "harbor solar pvt ltd", "name_core": "harbor solar", "name_skel": "hrbr slr", "name_legal": "ltd pvt"}),
    ("Wendell Quincy Maxton Inc.", {"name_core": "wendell quincy maxton", "name_skel": "vndl knk mkstn", "name_legal": "inc"}),
    ("Brillo Co trading as Paper Lantern Guild", {"name_clean": "brillo co", "name_core": "brillo", "name_skel": "brl", "name_alt": "paper lantern guild"}),
    ("M/s Copperline Castings Limited Private", {"name_clean": "copperline castings ltd pvt", "name_core": "copperline castings", "name_legal": "ltd pvt"}),
    ("northpier.com", {"name_core": "northpier", "name_skel": "nrtpr", "is_domain": 1, "name_legal": ""}),
    ("Odell's Bakery L.L.C.", {"name_core": "odells bakery", "name_legal": "llc"}),
    ("dba Asset", {"name_clean": "asset", "name_alt": ""}),
    ("Société Générale", {"name_clean": "ste generale", "is_nonlatin": 0}),
    ("दुकान", {"name_clean": "dukaan", "is_nonlatin": 1}),
    ("బజార్ 中", {"name_clean": "bjaar", "is_nonlatin": 1}),
    ("the co", {"name_core": "co", "name_key": "co"}),
    ("", {"name_clean": "", "name_core": "", "name_skel": "", "is_domain": 0}),
    (None, {"name_clean": "", "name_core": "", "name_alt": "", "is_nonlatin": 0}),
]


def test_names(spark):
    rows = spark.createDataFrame([(i, n, i) for i, (n, _) in enumerate(GOLDEN)], "i int, business_name string, __text int")
    got = {r["i"]: r.asDict() for r in clean_names(rows).collect()}
    for i, (name, want) in enumerate(GOLDEN):
        assert {k: got[i][k] for k in want} == want, name
    assert clean_names(rows.where("false")).count() == 0
    with pytest.raises(ValueError):
        clean_names(rows.withColumn("NAME_core", F.lit(1)))


def test_skeletons(spark):
    got = spark.createDataFrame([("raam",), ("ram",), ("maarketting",), ("marketing",), ("80th",)], "w string").select(skeleton(F.col("w")))
    assert [r[0] for r in got.collect()] == ["rm", "rm", "mrktng", "mrktng", "80th"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_scores_against_definitions(a, b):
    assert sim.common(a, b) == lcs(a, b)
    assert all(0 <= f(a, b) <= 100.000001 for f in sim.SCORERS.values())
    assert all(f(a, b) == pytest.approx(f(b, a)) for n, f in sim.SCORERS.items() if n != "jaro_winkler")
    want = duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
    if a and b:
        assert sim.jaro_winkler(a, b) == pytest.approx(100 * want)


def test_scores_by_hand(spark):
    assert sim.ratio("", "") == 100 and sim.token_set_ratio("", "a") == 0 and sim.partial_ratio("power", "ipower com") == 100
    assert sim.token_sort_ratio("b a", "a b") == 100 and sim.token_set_ratio("a b", "b a c") == 100
    got = spark.createDataFrame([("ab", "ab"), (None, "x"), (None, None)], "a string, b string").select(sim.score("ratio", "a", "b"))
    assert [r[0] for r in got.collect()] == [100, 0, 100]


def test_tsv(spark, tmp_path):
    rows = [("S1-1", 'a "b" c'), ("S1-2", "NULL"), ("S1-3", "")]
    write_tsv(spark.createDataFrame(rows, "id string, name string"), f"file://{tmp_path}/t", ["id"])
    assert [tuple(r) for r in read_tsv(spark, f"file://{tmp_path}/t", ["id", "name"]).orderBy("id").collect()] == rows


def test_queries(spark):
    from tessera import catalog

    sf = "/root/testdata/sf0.001"
    names = {r["entity_id"]: r for r in catalog.queries()["er_name_forms"](spark, sf).collect()}
    assert len(names) == catalog.queries()["er_raw"](spark, sf).count() and all(r["name_core"] for r in names.values())
    core = {int(k[1]) * 10**10 + int(k[3:]): r["name_core"] for k, r in names.items()}
    got = catalog.er_name_scores(spark, sf).collect()
    assert len(got) == catalog.queries()["er_candidates_union"](spark, sf).count()
    for r in got:
        assert r["core_ratio"] == pytest.approx(200 * lcs(core[r["s1"]], core[r["cand"]]) / len(core[r["s1"]] + core[r["cand"]]), abs=1e-5)
