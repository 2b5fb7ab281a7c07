"""Benchmark decontamination with DataFrame functions only.

The hashes of the test items' windows (runs of WIDTH words; an item of fewer is one window) are broadcast in blocks of a bounded size; every
window of every document, of all lengths in one pass, is looked up there by its hash. Only windows that are found go on: their words are taken from
the document again and compared with the item's word by word. A word inside any verified window is hit; documents that are hit, or the
spans of their hit words, can be removed.

Nulls count as empty texts, which have no words and can't be hit; items without words have no window. Rows that repeat an id
are judged by their own texts. Without documents or items nothing is hit; other columns are ignored.
"""
from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise

WIDTH = 10
#: Hashes of windows in a broadcast (of some 24 bytes each, in the JVM); documents are read once for each such block.
BLOCK_WINDOWS = 2_000_000
#: Characters of the windows, and documents that are found, up to which they are broadcast for the comparison; beyond, both are joined by their keys.
BROADCAST_CHARACTERS, BROADCAST_DOCUMENTS = 64 << 20, 500_000
#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), GAP), "")


def windows_of(w: Column, width: Column | int) -> Column:
    """All runs of width words, in order; none if there are fewer."""
    n = F.lit(width) if isinstance(width, int) else width
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.slice(w, i, n))).otherwise(F.array().cast("array<array<string>>"))


def hashed(codes: Sequence[Column]) -> Column:
    """The hash of a window from its words' hashes; nulls at its end don't count."""
    return F.xxhash64(*codes)


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(window, hash, length, items) of each distinct window, with the sorted ids of its items as strings."""
    w = items.select(F.col(item_col).cast("string").alias("_item"), words(F.col(text_col)).alias("_words")).where(F.size("_words") > 0)
    each = w.select("_item", F.explode(windows_of(F.col("_words"), F.least(F.size("_words"), F.lit(width)))).alias("_window"))
    return each.groupBy("_window").agg(F.array_sort(F.collect_set("_item")).alias("_items")).select(F.col("_window").alias("_test"), hashed([F.xxhash64(F.get("_window", F.lit(j))) if j == 0 else F.when(F.size("_window") > j, F.xxhash64(F.get("_window", F.lit(j)))) for j in range(width)]).alias("_hash"), F.size("_window").alias("_length"), "_items")


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(_id, _mark, spans, items) of each document that is hit; _mark is a hash of its text."""
    tests = materialise(item_windows(items, item_col, item_text_col, width), "windows")
    lengths = [r["_length"] for r in tests.select("_length").distinct().orderBy("_length").collect()]  # width values at most
    size = tests.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.array_join("_test", " "))).alias("c")).first()
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_mark"), words(F.col(text_col)).alias("_words"))
    empty = source.where(F.lit(False)).select("_id", "_mark", F.array().cast("array<struct<begin:int,end:int>>").alias("_spans"), F.array().cast("array<string>").alias("_items"))
    if not lengths:
        return empty
    codes = source.where(F.size("_words") > 0).select("_id", "_mark", F.transform("_words", lambda w: F.xxhash64(w)).alias("_codes"))
    # a row for each place, with the hashes of the words from there on; null beyond the text
    shifted = F.arrays_zip(*(F.slice("_codes", j + 1, F.size("_codes")).alias(f"c{j}") for j in range(lengths[-1])))
    places = codes.select("_id", "_mark", F.posexplode(shifted).alias("at", "_next")).withColumn("at", F.col("at") + 1)
    window = lambda n: F.when(F.col(f"_next.c{n - 1}").isNotNull(), hashed([F.col(f"_next.c{j}") for j in range(n)]))
    if len(lengths) == 1:
        windows = places.select("_id", "_mark", F.lit(lengths[0]).alias("n"), "at", window(lengths[0]).alias("hash"))
    else:
        windows = places.select("_id", "_mark", "at", F.inline(F.array(*(F.struct(F.lit(n).alias("n"), window(n).alias("hash")) for n in lengths))))
    windows = windows.where("hash IS NOT NULL")
    blocks = max(1, -(-size["n"] // block_windows))
    found = None
    for k in range(blocks):
        keys = tests.where(F.pmod("_hash", F.lit(blocks)) == k).select(F.col("_hash").alias("hash")).distinct()
        part = (windows.where(F.pmod("hash", F.lit(blocks)) == k) if blocks > 1 else windows).join(F.broadcast(keys), "hash", "left_semi")  # about block_windows rows
        found = part if found is None else found.unionByName(part)
    by_doc = materialise(found.groupBy("_id", "_mark").agg(F.collect_set(F.struct("n", "at", "hash")).alias("_found")), "found")  # bounded by the document
    keyed = by_doc.select(F.col("_id").alias("_i"), F.col("_mark").alias("_m"))
    if keyed.count() <= BROADCAST_DOCUMENTS:
        keyed = F.broadcast(keyed)
    texts = source.join(keyed, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")), "left_semi").dropDuplicates(["_id", "_mark"])
    again = texts.join(by_doc.select(F.col("_id").alias("_i"), F.col("_mark").alias("_m"), "_found"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")))
    read = again.select("_id", "_mark", F.inline(F.transform("_found", lambda f: F.struct(f["hash"].alias("_hash"), f["at"].alias("_at"), f["n"].alias("_n"), F.slice(F.col("_words"), f["at"], f["n"]).alias("_window")))))
    if (size["c"] or 0) <= BROADCAST_CHARACTERS:
        tests = F.broadcast(tests)
    got = read.join(tests, "_hash").where(F.col("_window") == F.col("_test")).select("_id", "_mark", F.struct((F.col("_at") - 1).alias("begin"), (F.col("_at") - 1 + F.col("_n")).alias("end")).alias("_span"), "_items")
    return got.groupBy("_id", "_mark").agg(F.array_sort(F.collect_set("_span")).alias("_spans"), F.collect_set("_items").alias("_sets")).select("_id", "_mark", "_spans", F.array_sort(F.array_distinct(F.flatten("_sets"))).alias("_items"))


def _covered(spans: Column) -> Column:
    """Places in any of the sorted spans: each span adds what lies beyond the one before, as all have been begun in order."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    step = lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["begin"], a["reach"]))).alias("n"), F.greatest(a["reach"], s["end"]).alias("reach"))
    return F.aggregate(spans, start, step, lambda a: a["n"])


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, items) of each row of docs."""
    h = hits(docs, items, id_col, text_col, item_col, item_text_col, width)
    base = docs.select(F.col(id_col), F.xxhash64(text_col).alias("_m"), F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    joined = base.join(h, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_m") == F.col("_mark")), "left")
    found = F.coalesce("_items", F.array().cast("array<string>"))
    n_hit = F.coalesce(_covered(F.col("_spans")), F.lit(0)).cast("long")
    return joined.select(id_col, "n_words", n_hit.alias("n_hit"), F.size(found).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", found), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), found.alias("items"))


def remove_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """docs without those that are hit."""
    h = hits(docs, items, id_col, text_col, **names).select("_id", "_mark")
    return docs.join(h, docs[id_col].eqNullSafe(h["_id"]) & (F.xxhash64(docs[text_col]) == h["_mark"]), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """docs with the hit words, and what stands before each of them, taken out of their texts. Other texts stay as they are."""
    i, m, s = fresh(docs, "_tessera_id", "_tessera_mark", "_tessera_spans")
    h = hits(docs, items, id_col, text_col, **names).select(F.col("_id").alias(i), F.col("_mark").alias(m), F.col("_spans").alias(s))
    text = F.col(text_col)
    gap = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    parts = F.regexp_extract_all(text, F.lit(f"([{gap}]*[^{gap}]+)"), 1)
    clean = F.filter(parts, lambda x, k: ~F.exists(F.col(s), lambda r: (k >= r["begin"]) & (k < r["end"])))
    tail = F.regexp_extract(text, f"([{gap}]*)\\z", 1)
    joined = docs.join(h, docs[id_col].eqNullSafe(h[i]) & (F.xxhash64(docs[text_col]) == h[m]), "left")
    return joined.withColumn(text_col, F.when(F.col(s).isNull(), text).otherwise(F.concat(F.array_join(clean, ""), tail))).select(*docs.columns)
