"""Operators on records and pairs against brute force and cases worked by hand."""
import math
import os

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera import streaming
from tessera.functions import similarity as sim
from tessera.functions import translit
from tessera.functions.address import clean_addresses
from tessera.functions.text import clean_names
from tessera.operators import blocking, decision, features, models, reports, validation
from tessera.sources import sinks


def cleaned(spark, rows):
    df = spark.createDataFrame(rows, "key long, source int, country string, business_name string, business_address string")
    return clean_addresses(clean_names(df))


def test_tokens_by_hand(spark):
    got = blocking.token_sets(cleaned(spark, [(1, 1, "x", "Alto Beta Co", "12 Oak Street, 59000 Lille"), (2, 2, "x", None, "")])).collect()
    assert {r.key for r in got} == {1}
    by = {p: {r.token for r in got if r["pass"] == p} for p in ("name", "addr", "combo")}
    assert by["name"] == {"n_alto", "n_beta", "k_alt", "k_bt", "kk_alt_bt", "z_altobeta"}
    assert by["addr"] == {"a_oak", "a_lille", "h_12", "p_59000", "d_12", "d_59000", "ha_12_oak", "ha_12_lille", "ha_59000_oak", "ha_59000_lille"}
    assert by["combo"] == {"kk_alt_bt", "z_altobeta", "hk_12_alt", "hk_12_bt", "hk_59000_alt", "hk_59000_bt", "pk_59000_alt", "pk_59000_bt", "ak_oak_alt", "ak_oak_bt", "ak_lille_alt", "ak_lille_bt"}


def expected(p):
    """How many of the probabilities, largest first, have the highest expected F0.5; 0 if none is better."""
    p = sorted((min(max(x, 1e-6), 1 - 1e-6) for x in p), reverse=True)
    total, none = sum(p), math.prod(1 - x for x in p)
    ef = [round(1.25 * sum(p[:k]) / (0.25 * total + k), 9) for k in range(1, len(p) + 1)]
    return ef.index(max(ef)) + 1 if ef and max(ef) > none else 0


def test_the_grid_is_that_of_every_parameter(spark):
    r = np.random.default_rng(1)
    pairs = [(1000 + i, int(r.integers(0, 25)), ("a", "b")[i % 2], int(r.integers(0, 2)), float(round(r.random(), 2))) for i in range(120)]
    country = {}
    pairs = [(c, s, country.setdefault(s, k), y, p) for c, s, k, y, p in pairs]
    info = [(s, country.get(s, "a"), int(s % 3)) for s in range(30)]
    best = spark.createDataFrame(pairs, "cand long, s1 long, country string, label int, prob double")
    about = spark.createDataFrame(info, "s1 long, country string, n_true int")
    got = {(x.method, x.param, x.country): (x.tp, x.n_pred, round(x.f, 9)) for x in decision.grid(best, about).collect()}
    want = {}
    for method, params in decision.PARAMS.items():
        for t in params:
            for k in ("a", "b"):
                sums = [0, 0, 0.0]
                for s, c, n in info:
                    if c != k:
                        continue
                    mine = sorted(((p, -cand, y) for cand, s1, _, y, p in pairs if s1 == s and p >= t), reverse=True)
                    if method == "expected":
                        mine = mine[: expected([m[0] for m in mine])]
                    tp, found = sum(m[2] for m in mine), len(mine)
                    sums = [sums[0] + tp, sums[1] + found, sums[2] + (1.25 * tp / (0.25 * n + found) if n + found else 1.0)]
                want[method, t, k] = (sums[0], sums[1], round(sums[2], 9))
    assert got == want
    rules = decision.choose(decision.grid(best, about), about)
    top = max(round(sum(want[m, t, k][2] for k in "ab") / len(info), 9) for m, ts in decision.PARAMS.items() for t in ts)
    assert round(rules.where("scope = 'all'").first().f05, 9) == top
    kept = decision.apply(best.withColumn("country", F.lit("unseen")), rules)
    one = rules.where("scope = 'all'").first()
    assert (kept.agg(F.sum("label")).first()[0] or 0, kept.count()) == tuple(sum(want[one.method, one.param, k][i] for k in "ab") for i in (0, 1))
    none = best.limit(0)
    assert decision.apply(none, decision.choose(decision.grid(none, about.limit(0)), about.limit(0))).count() == 0


def test_partner_relative_and_second_best(spark):
    cand = spark.createDataFrame([(21, 1, 0.9), (22, 1, 0.7), (22, 2, 0.8), (23, 3, 0.5)], "cand long, s1 long, score double")
    got = {(r.cand, r.s1): (r.partner, r.partner_score) for r in features.partner_keys(cand).collect()}
    assert got == {(21, 1): (22, 0.7), (22, 1): (21, 0.9), (22, 2): (None, 0.0), (23, 3): (None, 0.0)}
    rows = spark.createDataFrame([(21, 1, 90.0, 50.0, 80.0), (21, 2, 90.0, 50.0, 70.0), (21, 3, 60.0, 100.0, 10.0)], "cand long, s1 long, n_set double, a_set double, nosp_partial double")
    got = {r.s1: (r.comb, r.n_set_rel, r.a_set_rel, r.comb_rel, r.nosp_partial_rel, r.comb_rank) for r in features.relative(rows).collect()}
    assert got == {1: (74.0, 0.0, -50.0, -2.0, 0.0, 2), 2: (74.0, 0.0, -50.0, -2.0, -10.0, 2), 3: (76.0, -30.0, 0.0, 0.0, -70.0, 1)}
    scored = spark.createDataFrame([(21, 1, 0.9), (21, 2, 0.6), (21, 3, 0.2), (22, 1, 0.4)], "cand long, s1 long, prob double")
    got = {(r.cand, r.s1): (r.c_rank, r.c_second, r.s_n, r.s_gap, r.s_n50, r.share_s) for r in features.stack_features(scored).collect()}
    assert got[21, 3] == (3, 0.6, 1, 0.0, 0, 1.0) and got[22, 1] == (1, 0.0, 2, 0.5, 1, round(0.4 / 1.3, 6)) and got[21, 1][1] == 0.6


def test_partial_ratio_is_the_best_window():
    r = np.random.default_rng(2)
    for _ in range(400):
        a, b = ("".join(r.choice(list("abcd "), r.integers(0, 9))) for _ in range(2))
        x, y = sorted((a, b), key=len)
        n = len(x)
        if not n:
            want = 100.0 if not y else 0.0
        else:
            sides = [(x, y)] + ([(y, x)] if len(y) == n else [])
            want = max(sim.ratio(p, q[max(0, i) : i + n]) for p, q in sides for i in range(1 - n, len(q)))
        assert sim.partial_ratio(a, b) == pytest.approx(want), (a, b)


def test_dictionary(spark):
    names = spark.createDataFrame([(k, "dukaan bada 7", 1) for k in range(20, 24)] + [(k, "shop big 7", 0) for k in range(4)] + [(24, "dukaan", 1), (4, "two words", 0)], "key long, name_core string, native int")
    truth = spark.createDataFrame([(20 + i, i) for i in range(5)], "cand long, s1 long")
    learnt = translit.learn(truth, names)
    assert {(r.src, r.dst, r.n) for r in learnt.collect()} == {("dukaan", "shop", 4), ("bada", "big", 4)}
    clean = cleaned(spark, [(1, 2, "x", "दुकान Group", ""), (2, 2, "x", "dukaan", "")])
    got = {r.key: r for r in translit.translate(clean, learnt).collect()}
    assert (got[1].name_core, got[1].name_key, got[1].name_skel, got[1].name_nospace) == ("shop group", "shop", "sp grp", "shopgroup") and got[2].name_core == "dukaan"


def test_files_are_checked(spark, tmp_path):
    records = spark.createDataFrame([("S1-1", 1, 1), ("S1-2", 2, 1), ("S2-1", 21, 2), ("S3-1", 31, 3)], "entity_id string, key long, source int")
    head = "Source1_entity_id\tmatched_entity_ids \n"
    files = {"good": head + "S1-1\tS2-1,S3-1\n\nS1-2\t\n", "comma": "source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", "empty": "", "head": "id\tmatched_entity_ids\nS1-1\t\n", "bad": head + "S1-1\tS2-1,S2-1,S1-2,X-9,S2-7\nS1-1\tS3-1\nno tab here\nS1-9\t\n"}
    for name, text in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.tsv").write_text(text)
    cand = spark.createDataFrame([(1, 21), (1, 31)], "s1 long, cand long")
    found = lambda n: {(r.finding, r.example) for r in validation.file_findings(spark, str(tmp_path / n), records=records, candidates=cand).collect()}
    whole = {("missing row", "S1-1"), ("missing row", "S1-2")}  # of a file whose header is wrong no row counts
    assert found("good") == set()
    assert found("comma") == {("comma-separated", "part.tsv")} | whole and found("empty") == {("empty file", "part.tsv")} | whole and found("head") == {("wrong header", "part.tsv")} | whole
    assert found("bad") == {
        ("malformed row", "no tab here"), ("duplicate row", "S1-1"), ("duplicate id", "S1-1"), ("source 1 id", "S1-2"), ("bad prefix", "X-9"), ("unknown id", "X-9"), ("unknown id", "S2-7"), ("unknown row", "S1-9"), ("missing row", "S1-2"),
        ("not a candidate", "S1-1 X-9"), ("not a candidate", "S1-1 S2-7"), ("not a candidate", "S1-1 S1-2"),
    }
    many = spark.createDataFrame([("x", f"e{i}") for i in range(7)], "finding string, example string")
    assert [tuple(r) for r in validation.summary(many).collect()] == [("x", 7, "e0, e1, e2, e3, e4")]


def test_sinks(spark, tmp_path):
    path = lambda n: str(tmp_path / n)
    sinks.write_id_lists(spark.createDataFrame([("S1-10", "S2-1"), ("S1-9", None)], "source1_entity_id string, matched_entity_ids string"), path("lists"))
    lines = [x for f in sorted(os.listdir(path("lists"))) if f.endswith(".csv") for x in open(f"{path('lists')}/{f}").read().splitlines()]
    assert [x for x in lines if not x.startswith("source1")] == ["S1-9\t", "S1-10\tS2-1"]
    sinks.write_by_country(spark.createDataFrame([(1, "a"), (2, "b")], "k int, country string"), path("by"))
    assert [r.k for r in sinks.read_country(spark, path("by"), "b").collect()] == [2]
    models.write_json(spark, {"a": [1, "é\n"]}, path("json"))
    assert models.read_json(spark, path("json")) == {"a": [1, "é\n"]}
    text = reports.markdown("T", {"one": spark.createDataFrame([(1, None)], "a int, b string")})
    assert text == "# T\n\n## one\n\n| a | b |\n|---|---|\n| 1 |  |\n"


def test_trees_know_what_they_are_shown(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(i, i % 300, "x", i % 5, int(a + b > 1), float(a), float(b)) for i, (a, b) in enumerate(r.random((1500, 2)))]
    table = spark.createDataFrame(rows, "cand long, s1 long, country string, fold int, label int, a double, b double")
    s = models.Settings(trees=6, depth=3, bins=32, least_rows=5, columns_share="all")
    oof, found = models.cross_validated(table, s, folds=5)
    got = oof.toPandas()
    assert len(got) == 1500 and got.cand.is_unique and ((got.prob > 0.5) == (got.label == 1)).mean() > 0.85
    assert len(found.folds) == 5 and sum(w for _, w in found.importance()) == pytest.approx(1) and {c for c, _ in found.importance()} == {"a", "b"}
    found.save(spark, str(tmp_path / "m"))
    again = models.ensemble(table, models.Models.load(spark, str(tmp_path / "m"))).toPandas().set_index("cand").prob
    assert np.allclose(again.sort_index(), models.ensemble(table, found).toPandas().set_index("cand").prob.sort_index())
    flat, none = models.cross_validated(table.withColumn("label", F.lit(0)), s, folds=5)
    assert not none.folds and flat.where("prob <> 0").count() == 0


def test_models_learn_from_all_pairs(spark, monkeypatch):
    class Shown(Exception):
        pass

    def fit(train, valid, columns, s):
        raise Shown(train.count(), valid.count())

    monkeypatch.setattr(models, "fit", fit)
    pairs = spark.range(8_000_000).selectExpr("id AS cand", "id AS s1", "'x' AS country", "CAST(id % 5 AS int) AS fold", "CAST(id % 3 = 0 AS int) AS label", "CAST(id AS double) AS a")
    with pytest.raises(Shown) as shown:
        models.cross_validated(pairs)
    assert shown.value.args == (6_400_000, 1_600_000)


def test_borders_are_those_of_all_rows(spark):
    def by_hand(values, bins):
        kinds, counts = np.unique(values, return_counts=True)
        middle = ((kinds[1:] + kinds[:-1]) / 2).tolist()
        if len(kinds) <= bins:
            return middle
        upto, out = counts.cumsum(), []
        for k in range(1, len(kinds)):  # whole numbers: the target is (borders so far + 1) * rows / bins
            target = (len(out) + 1) * len(values)
            if abs(upto[k - 1] * bins - target) < abs(upto[k] * bins - target):
                out.append(middle[k - 1])
        return out

    r = np.random.default_rng(5)
    n = 30_000
    columns = {"even": r.random(n), "heavy": np.where(r.random(n) < 0.7, 0.25, r.random(n).round(3)), "skew": np.exp(r.normal(size=n) * 3).round(2), "signs": r.normal(size=n), "few": r.integers(0, 6, n) * 1.0, "same": np.ones(n)}
    table = spark.createDataFrame(np.stack(list(columns.values()), axis=1).tolist(), list(columns))
    for bins in (2, 7, 32, 255):
        assert models.borders(table, list(columns), bins) == [by_hand(v, bins) for v in columns.values()]
    near = spark.createDataFrame([(x,) for x in (1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 2), math.inf)], "a double")
    assert [r["_bin0"] for r in models._bins(["a"], models.borders(near, ["a"], 9))[0].transform(near).collect()] == [0, 1, 1, 2]


def test_few_rows_are_learnt_from_as_by_the_learner_alone(spark):
    r = np.random.default_rng(6)
    rows = [(i, i, "x", i % 5, int(a + b * b > 0.9), float(a), float(round(b, 1))) for i, (a, b) in enumerate(r.random((6000, 2)))]
    table = spark.createDataFrame(rows, "cand long, s1 long, country string, fold int, label int, a double, b double").cache()
    s = models.Settings(trees=3, depth=4, bins=32, rows_share=1.0, least_rows=5, columns_share="all")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(table.withColumn("own", F.expr("fold = 2")).withColumn("label", F.expr("double(label)")))
    alone = GBTClassifier(featuresCol="x", maxIter=3, maxDepth=4, maxBins=32, stepSize=0.1, featureSubsetStrategy="all", minInstancesPerNode=5, validationIndicatorCol="own", validationTol=0.0, seed=42).fit(vectors)
    want = {p.cand: round(p.probability[1], 6) for p in alone.transform(vectors).where("own").collect()}
    train, own = table.where("fold <> 2"), table.where("fold = 2")
    got = {p.cand: p.prob for p in models._with_prob(own, models.fit(train, own, ["a", "b"], s), "prob").collect()}
    assert got == pytest.approx(want, abs=2e-6) and len(set(got.values())) > 5


def test_bins_come_from_all_pairs(spark):
    pairs = spark.range(300_000).selectExpr("id AS cand", "id AS s1", "'x' AS country", "CAST(id % 5 AS int) AS fold", "CAST(id % 60001 = 7 AS int) AS label", "CAST(id % 60001 = 7 AS double) AS a")
    oof, _ = models.cross_validated(pairs, models.Settings(trees=2, depth=2, bins=32, rows_share=1.0, least_rows=1, columns_share="all"))
    assert oof.where("label = 0").agg(F.max("prob")).first()[0] < oof.where("label = 1").agg(F.min("prob")).first()[0]


def test_a_stream_is_blocked_like_a_table(spark, tmp_path):
    rows = [("S1-1", 1, 1, "x", "Alto Beta Co", "12 Oak Street"), ("S2-1", 21, 2, "x", "Beta Alto", "12 Oak St"), ("S3-1", 31, 3, "x", "Gamma", "9 Elm")]
    schema = "entity_id string, key long, source int, country string, business_name string, business_address string"
    raw = spark.createDataFrame(rows, schema)
    raw.where("source > 1").write.parquet(str(tmp_path / "in"))
    index = blocking.token_sets(clean_addresses(clean_names(raw.where("source = 1"))))
    plan = lambda t: t.where("source > 1").alias("q").join(t.where("source = 1").alias("s"), ["country", "pass", "token"]).select(F.col("q.key").alias("cand"), F.col("s.key").alias("s1")).distinct()
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = streaming.link_stream(stream, index, plan, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    assert {(r.cand, r.s1) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(21, 1)}
