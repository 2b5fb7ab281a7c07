"""Cross-entropy differences against a brute force, over one chunk and many, and odd input."""
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import common, ngram_lm

DIR = "/root/testdata/sf0.001"


def brute(rows, target, probes=None):
    """Losses by the definition; rows (id, text), target(id); probes are texts counted in neither model."""
    def words(t):
        w = [x for x in re.split(rb"[^a-z0-9\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())) if x]
        return [*w, "END"] if t else []

    n = Counter(w for _, t in rows for w in words(t) if w != "END")
    known = {w for w, k in n.items() if k >= ngram_lm.LEAST_COUNT}
    size = len(known) + 2
    seq = lambda t: [w if w in known or w == "END" else "UNK" for w in words(t)]
    grams = lambda s: Counter(g for k in (1, 2, 3) for i in range(len(s)) for g in [tuple((["PAD"] * 2 + s)[i + 3 - k : i + 3])])

    def counted(texts):
        c = Counter()
        for s in texts:
            c += grams(s)
            if s:
                c["PAD",] += 1
                c["PAD", "PAD"] += 1
            c["N"] += len(s)
        return c

    models = [counted(seq(t) for i, t in rows if bool(target(i)) == x) for x in (False, True)]
    out = []
    for i, t in rows if probes is None else probes:
        s, loss = seq(t), []
        for x in (False, True):
            own = counted([s]) if probes is None and bool(target(i)) == x else Counter()
            c = lambda g: models[x][g] - own[g]  # noqa: B023,E731
            total = 0.0
            padded = ["PAD", "PAD", *s]
            for k in range(2, len(padded)):
                a, b, w = padded[k - 2 : k + 1]
                p = (c((w,)) + ngram_lm.MU / size) / (c("N") + ngram_lm.MU)
                p = (c((b, w)) + ngram_lm.MU * p) / (c((b,)) + ngram_lm.MU)
                p = (c((a, b, w)) + ngram_lm.MU * p) / (c((a, b)) + ngram_lm.MU)
                total -= math.log2(p)
            loss.append(total / max(len(s), 1))
        out.append((i, len(s), loss[1], loss[0]))
    return out


def same(got, want):
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, round(r.target_loss, 8), round(r.background_loss, 8)) for r in got)
    want = sorted((i if i is not None else -1, n, round(t, 8), round(b, 8)) for i, n, t, b in want)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-6 and abs(g[3] - w[3]) < 1e-6


def test_losses_are_those_of_the_definition(spark, monkeypatch):
    docs = common.table(spark, DIR, "documents").limit(40).union(common.table(spark, DIR, "documents").limit(3)).select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, lambda i: i % 3 == 0)
    same(ngram_lm.score(docs, F.col("doc_id") % 3 == 0).collect(), want)
    same(ngram_lm.score(docs, F.col("doc_id") % 3 == 0, chunk_bytes=1, bucket_tokens=500).collect(), want)
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", 100)
    same(ngram_lm.score(docs, F.col("doc_id") % 3 == 0).collect(), want)
    probes = [(1, "of the qqq"), (2, ""), (None, None), (3, rows[5][1]), (3, " ")]
    got = ngram_lm.score(docs, F.col("doc_id") % 3 == 0, scored=spark.createDataFrame(probes, "doc_id int, text string"))
    assert dict(got.dtypes)["doc_id"] == "int"
    same(got.collect(), brute(rows, lambda i: i % 3 == 0, probes))


def test_odd_input(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, " ", "s"), (4, "a " * 3000, "s"), (4, "É é 中文", "s"), (None, "a a-a", "s"), (5, "y" * 20000, "s")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, Tokens string")
    got = ngram_lm.score(odd, F.lit(None).cast("boolean")).collect()
    same(got, brute([r[:2] for r in rows], lambda i: False))
    assert sum(r.n_tokens == 0 and r.score == 0 for r in got) == 2
    assert ngram_lm.score(odd.limit(0), F.lit(True)).count() == 0


def test_words_and_their_order_count(spark):
    r = np.random.default_rng(5)
    words = [f"w{i:03d}" for i in range(300)]
    texts = [" ".join(words[k : k + 9]) for k in r.integers(0, 290, 200)] + [" ".join(words[k : k + 9][::-1]) for k in r.integers(0, 290, 200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    probe = spark.createDataFrame([(0, " ".join(words[50:58])), (1, " ".join(words[50:58][::-1]))], "doc_id long, text string")
    got = {x.doc_id: x for x in ngram_lm.score(docs, F.col("doc_id") < 200, scored=probe).collect()}
    assert got[0].score < got[1].score - 1
    assert len(ngram_lm.learn_vocabulary(docs, "text", F.lit(False), 50).hashes) <= 50


def test_numbers_are_packed_without_loss():
    for kind in (np.int64, np.int32, np.uint32):
        a = np.random.default_rng(0).integers(0, 2**31 - 1, 1000).astype(kind)
        assert (ngram_lm.unpacked(ngram_lm.packed(a), kind) == a).all()
        assert len(ngram_lm.unpacked(ngram_lm.packed(a[:0]), kind)) == 0
