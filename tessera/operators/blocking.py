"""Token sets of cleaned records, one for each blocking pass, and the best pairs by their cosine."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import skeleton

#: Skeletons of a name, and of these the ones that go with address words; words and numbers of an address that are combined.
SKELETONS, WITH_WORDS, WORDS, NUMBERS = 5, 3, 4, 3
#: Of a block: tokens of each side, about, and pairs by one token that are held at once.
BLOCK, PAIRS = 250_000, 300_000


def _split(c: str) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def _crossed(prefix: str, a: Column, b: Column) -> Column:
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat_ws("_", F.lit(prefix), x, y))))


def token_sets(clean: DataFrame) -> DataFrame:
    """(country, key, source, pass, token) of the cleaned records: name words, skeletons and pairs of these; address words, numbers and codes;
    and combinations of both sides that are rare. A record without a token of a pass has no row there; equal tokens of a pass count once."""
    names = {n: F.col(f"__tessera_{n}") for n in ("words", "sk", "sorted", "aw", "nums")}
    words, sk, ordered, aw, nums = names.values()
    put = lambda df, n, c: df.withColumn(f"__tessera_{n}", c)
    base = clean.select("country", "key", "source", "name_core", "name_alt", "name_nospace", "addr_clean", "house_no", "postcode", "numbers")
    out = put(base, "words", F.filter(F.concat(_split("name_core"), _split("name_alt")), lambda w: F.length(w) >= 2))
    skeletons = F.transform(F.filter(words, lambda w: ~w.rlike("^[0-9]+$")), skeleton)
    out = put(out, "sk", F.slice(F.filter(F.array_distinct(skeletons), lambda s: F.length(s) >= 2), 1, SKELETONS))
    out = put(out, "sorted", F.array_sort(sk))
    out = put(out, "aw", F.filter(_split("addr_clean"), lambda w: (F.length(w) >= 3) & ~w.rlike("[0-9]")))
    out = put(out, "nums", F.slice(F.filter(_split("addr_clean"), lambda w: w.rlike("[0-9]")), 1, NUMBERS))
    none = F.array().cast("array<string>")
    prefixed = lambda p, a: F.transform(a, lambda x: F.concat(F.lit(p + "_"), x))
    one = lambda p, c: F.when(c != "", F.array(F.concat(F.lit(p + "_"), c))).otherwise(none)
    pairs = F.flatten(F.transform(ordered, lambda x, i: F.transform(F.filter(ordered, lambda _, j: j > i), lambda y: F.concat_ws("_", F.lit("kk"), x, y))))
    joined = F.when(F.length("name_nospace") >= 4, F.array(F.concat(F.lit("z_"), "name_nospace"))).otherwise(none)
    first = F.slice(aw, 1, WORDS)
    passes = {
        "name": F.concat(prefixed("n", words), prefixed("k", sk), pairs, joined),
        "addr": F.concat(prefixed("a", aw), one("h", F.col("house_no")), one("p", F.col("postcode")), prefixed("d", F.filter(_split("numbers"), lambda d: F.length(d) >= 2)), _crossed("ha", nums, first)),
        "combo": F.concat(pairs, joined, _crossed("hk", nums, sk), F.when(F.col("postcode") != "", F.transform(sk, lambda k: F.concat_ws("_", F.lit("pk"), "postcode", k))).otherwise(none), _crossed("ak", first, F.slice(sk, 1, WITH_WORDS))),
    }
    sets = F.array(*(F.struct(F.lit(p).alias("pass"), F.array_distinct(a).alias("tokens")) for p, a in passes.items()))
    return out.select("country", "key", "source", F.inline(sets)).select("country", "key", "source", "pass", F.explode("tokens").alias("token"))


def _chunks(reached: np.ndarray, starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of records that begin at starts, with up to most pairs or one record each; reached: pairs before each token."""
    at, before = 0, reached[starts]
    while at < len(starts) - 1:
        end = max(at + 1, int(np.searchsorted(before, before[at] + most, "right")) - 1)
        yield at, end
        at = end


def _best_of_block(top: int, prune: float, pairs: int):
    """Of each record of source 2 or 3 in a block, the pairs that can be among its best: at most top, and none below prune of the block's best."""

    def run(t: pa.Table) -> pa.Table:
        column = lambda c: t.column(c).combine_chunks()
        token = pa.chunked_array([column("token")]).dictionary_encode().combine_chunks()
        codes, keys, w, is_q = token.indices.to_numpy(), column("key").to_numpy(), column("w").to_numpy(), column("source").to_numpy() > 1
        own = np.flatnonzero(~is_q)
        own = own[np.argsort(codes[own], kind="stable")]
        first = np.concatenate(([0], np.cumsum(np.bincount(codes[own], minlength=len(token.dictionary)))))
        s_keys, s_at = np.unique(keys[own], return_inverse=True)
        s_w = w[own]
        asked = np.flatnonzero(is_q)
        asked = asked[first[codes[asked] + 1] > first[codes[asked]]]
        asked = asked[np.argsort(keys[asked], kind="stable")]
        n = first[codes[asked] + 1] - first[codes[asked]]
        reached = np.concatenate(([0], np.cumsum(n)))
        q_keys, q_first = np.unique(keys[asked], return_index=True)
        starts = np.concatenate((q_first, [len(asked)]))
        out = [(keys[:0], keys[:0], w[:0])]
        for a, b in _chunks(reached, starts, pairs):
            rows = slice(starts[a], starts[b])
            row = np.repeat(np.arange(starts[a], starts[b]), n[rows])
            at = first[codes[asked[row]]] + np.arange(reached[starts[a]], reached[starts[b]]) - reached[row]
            pair = np.repeat(np.repeat(np.arange(b - a), np.diff(starts[a : b + 1])), n[rows]) * len(s_keys) + s_at[at]
            order = np.argsort(pair)
            pair, part = pair[order], (w[asked[row]] * s_w[at])[order]
            new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            large = np.add.reduceat(part, new) * 1e8
            score = (np.floor(large) + (large - np.floor(large) >= 0.5)) / 1e8
            q, s = np.divmod(pair[new], len(s_keys))
            heads = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
            best = np.repeat(np.maximum.reduceat(score, heads), np.diff(np.concatenate((heads, [len(q)]))))
            kept = np.flatnonzero(score >= prune * best)
            kept = kept[np.lexsort((s[kept], -score[kept], q[kept]))]  # s is in the order of the keys
            heads = np.flatnonzero(np.concatenate(([True], q[kept][1:] != q[kept][:-1])))
            nth = np.arange(len(kept)) - np.repeat(heads, np.diff(np.concatenate((heads, [len(kept)]))))
            kept = kept[nth < top]
            out.append((q_keys[a + q[kept]], s_keys[s[kept]], score[kept]))
        found = dict(zip(("cand", "s1", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True))
        return pa.table({"_block": pa.array(np.full(len(found["s1"]), column("_block")[0].as_py()), pa.int64())} | found)

    return run


def best_pairs(weights: DataFrame, top: int, prune: float) -> DataFrame:
    """(country, pass, cand, s1, score, rank): of each record of source 2 or 3 and pass the top source 1 records by cosine, without those below
    prune of the best. Records of both sides are dealt into blocks, and each two blocks of a country and pass meet in one place, so that the pairs by
    single tokens, many times the tokens, are summed where they are made; only each block's best are moved."""
    rows = weights.where("token IS NOT NULL").select("country", "pass", "key", "source", "token", "w")
    counts = rows.groupBy("country", "pass").agg(F.sum((F.col("source") > 1).cast("long")).alias("nq"), F.sum((F.col("source") == 1).cast("long")).alias("ns")).where("country IS NOT NULL AND nq > 0 AND ns > 0")
    sizes, n = [], 0
    for c in counts.collect():  # a row for each country and pass
        bq, bs = -(-c["nq"] // BLOCK), -(-c["ns"] // BLOCK)
        sizes.append((c["country"], c["pass"], n, bq, bs))
        n += bq * bs
    spark = weights.sparkSession
    of = spark.createDataFrame(sizes, "country string, pass string, _from long, _bq long, _bs long")
    is_q = F.col("source") > 1
    own = F.pmod(F.xxhash64("key"), F.when(is_q, F.col("_bq")).otherwise(F.col("_bs")))
    others = F.sequence(F.lit(0).cast("long"), F.when(is_q, F.col("_bs")).otherwise(F.col("_bq")) - 1)
    blocks = F.transform(others, lambda x: F.col("_from") + F.when(is_q, own * F.col("_bs") + x).otherwise(x * F.col("_bs") + own))
    dealt = rows.where("source >= 1").join(F.broadcast(of), ["country", "pass"]).select(F.explode(blocks).alias("_block"), "key", "source", "token", "w")
    found = dealt.groupBy("_block").applyInArrow(_best_of_block(top, prune, PAIRS), "_block long, cand long, s1 long, score double")
    at = (F.col("_block") >= F.col("_from")) & (F.col("_block") < F.col("_from") + F.col("_bq") * F.col("_bs"))
    record = Window.partitionBy("country", "pass", "cand")
    ranked = found.join(F.broadcast(of), at).select("country", "pass", "cand", "s1", "score", F.row_number().over(record.orderBy(F.desc("score"), "s1")).alias("_rn"))
    ranked = ranked.where(F.col("_rn") <= top).withColumn("_top", F.max("score").over(record))
    return ranked.where((F.col("_rn") == 1) | (F.col("score") >= prune * F.col("_top"))).select("country", "pass", "cand", "s1", "score", (F.col("_rn") - 1).alias("rank"))
