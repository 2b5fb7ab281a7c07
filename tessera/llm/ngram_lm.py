"""Cross-entropy difference of two matched n-gram models.

Tokens are words (as in words.py) and an end mark after each text that isn't empty. Both models share one closed vocabulary:
the words that occur at least LEAST_COUNT times in all documents, an unknown token for all others, and the end mark. Where more
than VOCABULARY words occur so often, the count that a word needs is raised until they fit. The target documents make the target
model and all other documents the background model, so the two are disjoint; they are matched in vocabulary, order, counting and
smoothing. Every run of three tokens of every document is counted. With c for counts, h for a run's beginning and h' for h without
its first token,

    p(w | h) = (c(h w) + MU p(w | h')) / (c(h) + MU),   p(w) = (c(w) + MU / size) / (n + MU)

A document's own counts are left out of the model that it is part of. Its score is the mean over its tokens of the target's loss
less the background's, in bits: the lower, the liker to the target.

The counts grow with the corpus, so no machine holds them. Documents are packed into chunks of tokens, which are written once.
A chunk asks for each distinct run of its own once: runs are dealt into buckets by a hash of their first two tokens, a bucket
counts what all chunks ask for and answers every chunk in the chunk's own order, and a chunk scores its documents from the answers.
What is moved is a chunk's distinct runs, packed by differences, and never a row for each token; a common run comes once from each
chunk. Vocabulary and word counts are broadcast; VOCABULARY bounds them.

Nulls count as empty texts; a text without tokens has a score of 0. Without target documents the target model is uniform. Rows that
repeat an id are scored by their own texts, and an empty table gives none. Other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, materialise, record_batches
from .words import mix, word_hashes

ORDER = 3
#: Of a token in a run. A run of ORDER tokens is a whole number of 63 bits.
BITS = 21
PAD, END, UNKNOWN, WORDS = 0, 1, 2, 3
VOCABULARY = (1 << BITS) - WORDS
LEAST_COUNT = 2
#: Weight of the shorter run's probability, in tokens.
MU = 4.0
#: Bytes of text in a chunk, and tokens of the corpus for each bucket: they bound what a task holds.
CHUNK_BYTES, BUCKET_TOKENS = 8 << 20, 1_000_000
#: Tokens whose losses are reckoned at a time, in whole texts.
BLOCK_TOKENS = 200_000
BACKGROUND, TARGET, NEITHER = 0, 1, 2

_LOW = (1 << BITS) - 1
_ALL, _TEXTS = 0, 1  # in place of words: all words, all texts with tokens


def packed(a: np.ndarray) -> bytes:
    """Whole numbers by planes of their bytes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Vocabulary:
    """Words by their hashes; tokens are numbered by falling frequency. counts[token] and n hold (background, target)."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, words: np.ndarray, texts: np.ndarray):
        order = np.lexsort((hashes, -counts.sum(1)))
        by_hash = np.argsort(hashes[order], kind="stable")
        self.hashes, self.token = hashes[order][by_hash], (by_hash + WORDS).astype(np.int32)
        special = np.zeros((WORDS, 2), np.int64)
        special[UNKNOWN], special[END] = words - counts.sum(0), texts
        self.counts = np.concatenate([special, counts[order]])
        self.size, self.n = len(hashes) + 2, words + texts

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The token of each word and end, and how many each text has."""
        h, at = word_hashes(texts)
        u, inverse = np.unique(h, return_inverse=True)
        found = np.full(len(u), UNKNOWN, np.int32)
        if len(self.hashes):
            place = np.minimum(np.searchsorted(self.hashes, u), len(self.hashes) - 1)
            known = self.hashes[place] == u
            found[known] = self.token[place[known]]
        ends = np.array([len(t) > 0 for t in texts], bool)
        lengths = np.diff(at) + ends
        out = np.full(lengths.sum(), END, np.int32)
        word = np.ones(len(out), bool)
        word[np.cumsum(lengths)[ends] - 1] = False
        out[word] = found[inverse]
        return out, lengths.astype(np.int64)


def learn_vocabulary(docs: DataFrame, text_col: str, target: Column, most: int = VOCABULARY) -> Vocabulary:
    """The words that occur LEAST_COUNT times or more; where these are more than most, those above a higher count."""
    def run(it):
        for b in record_batches(it, 16 << 20):
            texts, chosen = as_bytes(b.column(0)), np.array(b.column(1).to_pylist(), bool)
            h, at = word_hashes(texts)
            u, inverse = np.unique(h, return_inverse=True)
            n = np.bincount(inverse, minlength=len(u))
            t = np.bincount(inverse, np.repeat(chosen, np.diff(at)), len(u)).astype(np.int64)
            some = np.array([len(x) > 0 for x in texts], bool)
            u = np.concatenate([np.array([_ALL, _TEXTS], np.uint64), u])
            n, t = np.concatenate([[len(h), some.sum()], n]), np.concatenate([[t.sum(), (some & chosen).sum()], t])
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array((n - t).astype(np.int64)), pa.array(t.astype(np.int64))], ["word", "b", "t"])

    source = docs.select(F.col(text_col).alias("_text"), F.coalesce(target, F.lit(False)).alias("_target"))
    counted = source.mapInArrow(run, "word long, b long, t long").groupBy("word").agg(F.sum("b").alias("b"), F.sum("t").alias("t")).withColumn("n", F.col("b") + F.col("t"))
    found = materialise(counted.where((F.col("n") >= LEAST_COUNT) | F.col("word").isin(_ALL, _TEXTS)), "lm-words")
    totals = {r["word"]: np.array([r["b"], r["t"]], np.int64) for r in found.where(F.col("word").isin(_ALL, _TEXTS)).collect()}
    words = found.where(~F.col("word").isin(_ALL, _TEXTS))
    step = F.floor(F.log2("n") * 8)  # counts by steps of an eighth of a power of 2
    sizes = {r["s"]: r["k"] for r in words.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()}
    whole, least = sum(sizes.values()), -1
    for s in sorted(sizes):
        if whole <= most:
            break
        whole, least = whole - sizes[s], s
    t = words.where(step > least).select("word", "b", "t").toArrow()  # at most `most` rows
    nothing = np.zeros(2, np.int64)
    return Vocabulary(t["word"].to_numpy().view(np.uint64), np.stack([t["b"].to_numpy(), t["t"].to_numpy()], 1), totals.get(_ALL, nothing), totals.get(_TEXTS, nothing))


def chunked(docs: DataFrame, vocabulary, chunk_bytes: int) -> DataFrame:
    """(chunk, ids, roles, lengths, tokens) of the rows (_id, _text, _role, _scored), many rows in one: everything packed."""
    def run(it):
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def emit():
            rows = pa.Table.from_batches([pa.RecordBatch.from_arrays([b.column(0)], ["id"]) for b, _, _ in held])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_table(rows)
            marks = np.concatenate([np.array(b.column(2).to_pylist(), np.int32) * 2 + np.array(b.column(3).to_pylist(), np.int32) for b, _, _ in held])
            lengths, tokens = np.concatenate([x for _, _, x in held]), np.concatenate([x for _, x, _ in held])
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | n], pa.int64()), *(pa.array([x], pa.binary()) for x in (zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes()), packed(marks), packed(lengths), packed(tokens)))], ["chunk", "ids", "marks", "lengths", "tokens"])

        for b in record_batches(it):
            held.append((b, *vocabulary.value.tokens(as_bytes(b.column(1)))))
            held[-1] = (b.drop_columns(["_text"]).add_column(1, "_text", pa.nulls(b.num_rows)), *held[-1][1:])
            size += b.nbytes
            if size >= chunk_bytes:
                yield emit()
                held, size, n = [], 0, n + 1
        if held:
            yield emit()

    return docs.mapInArrow(run, "chunk long, ids binary, marks binary, lengths binary, tokens binary")


def runs(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs that end at each token of each text and one more, after the end mark, whose first two tokens are the text's last
    two; zeros stand before and after a text. Also each run's text, and which runs are the ones after a text's end."""
    some = lengths > 0
    counts = lengths + some
    owner = np.repeat(np.arange(len(lengths)), counts)
    last = np.zeros(len(owner), bool)
    last[np.cumsum(counts)[some] - 1] = True
    a = np.full(len(owner), PAD, np.int64)
    a[~last] = tokens
    place = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
    before = [np.where(place >= j, np.concatenate([np.zeros(min(j, len(a)), np.int64), a[: max(len(a) - j, 0)]]), PAD) for j in (2, 1)]
    return before[0] << 2 * BITS | before[1] << BITS | a, owner, last


def dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted distinct runs: the order that has each bucket's runs together, sorted, and where each bucket's begin."""
    to = (mix((keys >> BITS).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    return order, np.searchsorted(to[order], np.arange(buckets + 1))


def _asked(buckets: int):
    """From a chunk: (bucket, chunk, n, keys, background, target) for each bucket that it has runs of."""
    def run(it):
        for b in it:
            for i in range(b.num_rows):
                marks, lengths, tokens = (unpacked(b.column(c)[i].as_py(), k) for c, k in (("marks", np.int32), ("lengths", np.int64), ("tokens", np.int32)))
                keys, owner, _ = runs(tokens, lengths)
                role = (marks[owner] >> 1).astype(np.int8)
                order = np.argsort(keys)
                keys, role = keys[order], role[order]
                first = np.flatnonzero(np.diff(keys, prepend=-1))
                u = keys[first]
                n = [np.add.reduceat(role == r, first, dtype=np.uint32) if len(first) else np.empty(0, np.uint32) for r in (BACKGROUND, TARGET)]
                del keys, owner, role
                order, at = dealt(u, buckets)
                full = np.flatnonzero(np.diff(at))
                parts = [order[at[k] : at[k + 1]] for k in full]
                column = lambda values, kind=pa.binary(): pa.array(values, kind)
                yield pa.RecordBatch.from_arrays(
                    [column(full, pa.int64()), column([b.column("chunk")[i].as_py()] * len(full), pa.int64()), column([packed(np.diff(u[p], prepend=0)) for p in parts]), column([packed(n[0][p]) for p in parts]), column([packed(n[1][p]) for p in parts])],
                    ["bucket", "chunk", "keys", "background", "target"],
                )

    return run


def _answered(t: pa.Table) -> pa.Table:
    """A bucket's counts, to each chunk in the order that it asked: of the whole run and of its first two tokens, in either model."""
    keys = [np.cumsum(unpacked(x, np.int64)) for x in t["keys"].to_pylist()]
    offsets = np.cumsum([0, *map(len, keys)])
    u, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    first = np.flatnonzero(np.diff(u >> BITS, prepend=-1))
    sizes = np.diff(first, append=len(u))
    out = []
    for side in ("background", "target"):
        whole = np.bincount(inverse, np.concatenate([unpacked(x, np.uint32) for x in t[side].to_pylist()]), len(u)).astype(np.int64)
        out += [whole[inverse], np.repeat(np.add.reduceat(whole, first), sizes)[inverse]]
    answers = [[packed(np.minimum(x[a:b], 0xFFFFFFFF).astype(np.uint32)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)] for x in out]
    return pa.table([t["chunk"], t["bucket"], *(pa.array(x, pa.binary()) for x in answers)], names=["chunk", "bucket", "b3", "b2", "t3", "t2"])


def _own(values: np.ndarray, owner: np.ndarray, kinds: int) -> np.ndarray:
    """How often each value, a number below kinds, occurs in its own text."""
    _, inverse, n = np.unique(owner * np.int64(kinds) + values, return_inverse=True, return_counts=True)
    return n[inverse]


def losses(tokens: np.ndarray, lengths: np.ndarray, roles: np.ndarray, counts: dict[str, np.ndarray], vocabulary: Vocabulary) -> dict[int, np.ndarray]:
    """-log2 p of each token in either model. counts: b3, b2, t3, t2 of each of the runs of runs()."""
    keys, owner, last = runs(tokens, lengths)
    at = np.flatnonzero(~last)
    three, pair = (np.unique(x, return_inverse=True)[1] for x in (keys, keys >> BITS))
    own3, own2 = _own(three, owner, len(keys) + 1)[at], _own(pair, owner, len(keys) + 1)
    next2, own2, who = own2[at + 1], own2[at], owner[at]
    own1 = _own(tokens.astype(np.int64), who, 1 << BITS)
    start = np.concatenate([[True], who[1:] != who[:-1]]) if len(at) else np.empty(0, bool)
    before = np.concatenate([[0], tokens[:-1]])[: len(at)]  # and in a text's first place its number of texts: that of the run of zeros
    own_before = np.where(start, 1, np.concatenate([[0], own1[:-1]])[: len(at)])
    out = {}
    for role, side in ((BACKGROUND, "b"), (TARGET, "t")):
        mine = (roles[who] == role).astype(np.int64)
        length = lengths[who]
        c3, c2, c2n = (counts[side + "3"][at] - mine * own3, counts[side + "2"][at] - mine * own2, counts[side + "2"][at + 1] - mine * next2)
        c1 = vocabulary.counts[tokens, role] - mine * own1
        h1 = np.where(start, c2, vocabulary.counts[before, role] - mine * own_before)
        n = vocabulary.n[role] - mine * length
        p = (c1 + MU / vocabulary.size) / (n + MU)
        p = (c2n + MU * p) / (h1 + MU)
        out[role] = -np.log2((c3 + MU * p) / (c2 + MU))
    return out


def score(docs: DataFrame, target: Column, id_col: str = "doc_id", text_col: str = "text", scored: DataFrame | None = None, chunk_bytes: int = CHUNK_BYTES, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score) of each row of docs, or of scored, whose texts are then counted in neither
    model. target marks the target documents among docs; losses are means in bits."""
    spark = docs.sparkSession
    bounded_batches(spark)
    words = learn_vocabulary(docs, text_col, target)
    vocabulary = spark.sparkContext.broadcast(words)
    buckets = max(8, -(-int(words.n.sum()) // bucket_tokens))
    kind = dict((docs if scored is None else scored).dtypes)[id_col]
    role = F.when(F.coalesce(target, F.lit(False)), TARGET).otherwise(BACKGROUND)
    rows = lambda df, r, s: df.select(F.col(id_col).cast(kind).alias("_id"), F.col(text_col).alias("_text"), r.alias("_role"), F.lit(s).alias("_scored"))
    source = rows(docs, role, scored is None)
    if scored is not None:
        source = source.unionByName(rows(scored, F.lit(NEITHER), True))
    chunks = materialise(chunked(source, vocabulary, chunk_bytes), "lm-chunks")
    asked = chunks.select("chunk", "marks", "lengths", "tokens").mapInArrow(_asked(buckets), "bucket long, chunk long, keys binary, background binary, target binary")
    answered = asked.groupBy("bucket").applyInArrow(_answered, "chunk long, bucket long, b3 binary, b2 binary, t3 binary, t2 binary")
    head = f"`{id_col}` {kind}, n_tokens long, target_loss double, background_loss double"

    def scores(c: pa.Table, answers: pa.Table) -> pa.Table:
        ids = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(c["ids"][0].as_py())).read_all()["id"]
        marks, lengths, tokens = (unpacked(c[x][0].as_py(), k) for x, k in (("marks", np.int32), ("lengths", np.int64), ("tokens", np.int32)))
        keys = runs(tokens, lengths)[0]
        u, inverse = np.unique(keys, return_inverse=True)
        order, _ = dealt(u, buckets)
        place = np.empty(len(u), np.int32)  # of each run in what is answered
        place[order] = np.arange(len(u), dtype=np.int32)
        place = place[inverse]
        del keys, u, inverse, order
        answers = answers.sort_by("bucket")
        counts = {}
        for x in ("b3", "b2", "t3", "t2"):
            if len(place):
                counts[x] = np.concatenate([unpacked(v, np.uint32) for v in answers[x].to_pylist()])[place]
            else:
                counts[x] = np.empty(0, np.uint32)
        del place
        begins, begin_runs = np.concatenate([[0], np.cumsum(lengths)]), np.concatenate([[0], np.cumsum(lengths + (lengths > 0))])
        cuts = np.unique(np.concatenate([np.searchsorted(begins, np.arange(0, begins[-1], BLOCK_TOKENS), "right") - 1, [0, len(lengths)]]))
        means: dict[int, list[np.ndarray]] = {BACKGROUND: [], TARGET: []}
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            n = lengths[i:j]
            some = {x: v[begin_runs[i] : begin_runs[j]].astype(np.int64) for x, v in counts.items()}
            found = losses(tokens[begins[i] : begins[j]], n, marks[i:j] >> 1, some, vocabulary.value)
            owner = np.repeat(np.arange(len(n)), n)
            for r, loss in found.items():
                means[r].append(np.bincount(owner, loss, len(n)) / np.maximum(n, 1))
        target_loss, background_loss = (pa.array(np.concatenate(means[r]) if means[r] else np.empty(0), pa.float64()) for r in (TARGET, BACKGROUND))
        out = pa.table([ids, pa.array(lengths), target_loss, background_loss], names=[id_col, "n_tokens", "target_loss", "background_loss"])
        return out.filter(pa.array((marks & 1).astype(bool)))

    out = chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(scores, head)
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))
