import pytest

from tessera.functions.address import ADDRESS_COLUMNS, clean_addresses

# (address, clean, house, postcode, state, numbers, landmark, missing)
CASES = [
    ("00815 Cedar Saint, Marlow, Texas", "815 cedar st marlow", "815", "", "tx", "815", "", 0),
    ("42 19th Street, Denver, CO", "42 19th st denver", "42", "", "co", "42 19", "", 0),
    ("PUNE â\u0080\u0093 411 038, Near City Mall, MH", "pune 411038", "", "411038", "mh", "411038", "near city mall", 0),
    ("తెలంగాణ, Lake View, Flat No 303 2Nd Block, Warangal, 7-221/9", "lake view 303 2nd block warangal 72219", "303", "", "tg", "303 2 7 221 9", "", 0),
    ("", "", "", "", "", "", "", 1),
    (None, "", "", "", "", "", "", 1),
    ("  ", "", "", "", "", "", "", 1),
    ("12345 Main Road, Ohio, India", "12345 main rd", "12345", "", "oh", "12345", "", 0),
    ("12 rue de l'Église, 59000 Lille, Nord", "12 rue leglise 59000 lille", "12", "59000", "hdf", "12 59000", "", 0),
    ("3 rue de l’Église", "3 rue leglise", "3", "", "", "3", "", 0),
    ("Shop 7 opp. City Mall, Texas, Ohio", "shop 7", "7", "", "tx", "7", "opp city mall", 0),
    ("9" * 60 + " Lane", "9" * 60 + " ln", "9" * 60, "", "", "9" * 60, "", 0),
]


def test_addresses(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, business_address string")
    got = {r["i"]: tuple(r[c] for c in ADDRESS_COLUMNS) for r in clean_addresses(df).collect()}
    for i, (text, clean, house, postcode, state, numbers, landmark, missing) in enumerate(CASES):
        assert got[i] == (clean, house, postcode, state, numbers, landmark, missing), text


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([], "business_address string, other int")
    out = clean_addresses(df)
    assert out.columns == ["business_address", "other", *ADDRESS_COLUMNS] and out.count() == 0
    with pytest.raises(ValueError):
        clean_addresses(df.withColumnRenamed("other", "State"))
