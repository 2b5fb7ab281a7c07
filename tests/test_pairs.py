from pyspark.sql import functions as F

from tessera import catalog
from tessera.functions.address import clean_addresses
from tessera.functions.pairs import RECORD_COLUMNS, string_features
from tessera.functions.text import clean_names

LEFT = [("Alto Company", "815 Cedar St, Marlow, Texas"), ("Acme dba Bolt", "12A Main Road, 59000 Lille"), ("", ""), ("north.com", "5 Oak Lane, Near Mall")]
RIGHT = [("Alto Co", "00815 Cedar Street, Ohio"), ("Bolt", "12 Main Rd"), ("", ""), ("Other Ltd", "")]


def test_by_hand(spark):
    def cleaned(rows, side):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, business_name string, business_address string")
        return clean_addresses(clean_names(df)).select("i", *(F.col(c).alias(f"{side}_{c}") for c in RECORD_COLUMNS))

    out = string_features(cleaned(LEFT, "a").join(cleaned(RIGHT, "b"), "i"))
    assert len(out.columns) == 49
    got = {r["i"]: r.asDict() for r in out.collect()}
    want = {
        0: {"n_set": 100.0, "legal_eq": 1, "state_conf": 1, "house_eq": 1, "house_numdiff": 0.0, "house_numeq": 1, "num_jacc": 1.0, "key_first_eq": 1, "post_miss": 1, "lm_any": 0, "len_a": 4, "ntok_a": 1},
        1: {"alt_best": 100.0, "has_alt": 1, "house_part": 1, "house_conf": 1, "house_numreldiff": 0.0, "num_jacc": 0.5, "num_common": 1, "post_miss": 1},
        2: {"n_set": 0.0, "n_ratio": 100.0, "num_jacc": -1.0, "num_common": 0, "house_numdiff": -1.0, "house_miss": 1, "amiss_a": 1, "key_first_eq": 0, "ntok_a": 0, "has_alt": 0},
        3: {"dom_a": 1, "dom_b": 0, "amiss_b": 1, "lm_any": 1, "house_miss": 1, "house_numreldiff": -1.0, "legal_miss": 1},
    }
    for i, features in want.items():
        assert {k: got[i][k] for k in features} == features, i
        assert None not in got[i].values()


def test_whole_query(spark):
    out = catalog.queries()["er_string_features"](spark, "/root/testdata/sf0.001").cache()
    assert out.count() == out.select("cand", "s1").distinct().count() > 0
