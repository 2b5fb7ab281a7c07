"""The corpus operators against brute force, round trips and edge cases: nulls, empty and long texts, ties, repeats, empty tables."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import audio, bagminhash, common, decontaminate, html_paths, pieces, quality_pu, queries, token_counts, toxicity, warc, words

public_tokenizers = pytest.importorskip("public_tokenizers")
DIR = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "A a-a é É", "x " * 3000, "y" * 20000, "'re don't '", "\n\n", "▁ x", "İΣς 中文 ½ 😀 \x00"]
DOCS = "doc_id long, text string, Score string, _text string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "s", None) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], (None, "null id", "s", None)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_token_counts(spark, odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    for r in token_counts.count_tokens(odd, path).join(odd, "doc_id").collect():
        assert r.n_tokens == len(t.encode(r.text or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(none, path).count() == 0
    texts = ["<|endoftext|>a <|startoftext|>", "''s 'll'x 're'rx", "a1b2'v 'l"]
    assert token_counts.counter(path).count(texts).tolist() == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_what_is_remembered_of_tokens_is_bounded(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    c = token_counts.Counter(path)
    monkeypatch.setattr(token_counts.Counter, "KEEP", 50)
    monkeypatch.setattr(type(c.machine.m), "KEEP", 40, raising=False)
    r = np.random.default_rng(5)
    texts = [" ".join("".join(r.choice(list("abcdeimnorst'1"), r.integers(1, 9))) for _ in range(300)) for _ in range(3)]
    t = Tokenizer.from_file(path)
    for _ in range(2):
        assert c.count(texts).tolist() == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
        assert len(c.known) <= 50 and len(c.older) <= 50
        assert len(c.machine.m.known) <= 40 and len(c.machine.m.older) <= 40


def test_state_maps_compose():
    r = np.random.default_rng(0)
    maps = r.integers(0, 7, (50, 7)).astype(np.uint8)
    got, state = token_counts.compose_scan(maps), np.arange(7)
    for i in range(50):
        state = maps[i][state]
        assert (got[i] == state).all()


def test_pieces(spark, odd, none):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.encode_documents(odd, path).withColumn("back", pieces.decode_column(path, "piece_ids")).collect()
    for r in got:
        assert r.piece_ids == sp.encode(r.text or "")
        assert r.back == (r.text or "").replace("▁", " ")
    assert pieces.encode_documents(none, path).count() == 0


def test_the_shortest_path_is_the_library_s(monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, p = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces(path)
    r = np.random.default_rng(3)
    signs = list("abcdeeeiiinnorstuABZ   .,'-\n\t019éñß中😀▁")
    texts = ["", *("".join(r.choice(signs, r.integers(1, 120))) for _ in range(400)), "y" * 3000, "ab" * 90 + " " * 70 + "q"]
    want = [sp.encode(t) for t in texts]
    for block, keep, long in ((1 << 20, 10**6, 64), (50, 300, 5)):  # all at once; long texts in pieces, words forgotten, many searched one by one
        monkeypatch.setattr(p, "BLOCK", block)
        monkeypatch.setattr(p, "KEEP", keep)
        monkeypatch.setattr(p, "LONG", long)
        ids, n = p.encode_all(texts)
        ends = np.cumsum(n)
        assert [ids[a:b].tolist() for a, b in zip(ends - n, ends, strict=True)] == want
        assert p.decode_all(ids, np.concatenate([[0], ends])) == [t.replace("▁", " ") for t in texts]
    names = p.lattice.names
    a, b = (r.integers(2, len(names), 5000) for _ in range(2))
    fit = p.lattice.fits(a, b)
    assert (fit == [p.lattice.m.fits(names[x], names[y]) for x, y in zip(a, b, strict=True)]).all() and (fit == p.lattice.fits(a, b)).all()


def test_a_part_is_looked_up_once(monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, p = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces(path)
    texts = ["the cat sat on the mat " * 40, "ä" * 3000 + " the cat", "b" * 100 + "▁" + "c" * 100 + " the"] + ["x" * (70 + i) for i in range(1500)]  # more long parts than places
    for _ in range(2):
        ids, n = p.encode_all(texts)
        ends = np.cumsum(n)
        assert [ids[a:b].tolist() for a, b in zip(ends - n, ends, strict=True)] == [sp.encode(t) for t in texts]
        assert sorted(p.known.values()) == list(range(len(p.known))) and not p.known.new and not p.known.longs
        assert all(w.isascii() and len(w) <= p.LONG for w in p.known)  # blanks take one byte


def test_audio(spark, odd, none):
    for r in audio.features(audio.encode(odd)).join(odd.select("doc_id", "text"), "doc_id").collect():
        t = (r.text or "").encode()
        assert r.n_bytes == len(t) and len(r.samples) % 64 == 0 and r.samples[: len(t)] == t and not any(r.samples[len(t) :])
        stored = audio.read_tensors(r.tensors)
        assert audio.read_wav(r.media)[0] == r.samples and stored.schema.field("tensor").type == pa.fixed_shape_tensor(pa.float32(), [audio.FRAMES, audio.BANDS])
        x = (np.frombuffer(r.samples, np.uint8).astype(np.float32) - 128) / 128
        frames = brute_log_mel(brute_resample(x, audio.RATE, audio.TARGET), audio.TARGET)
        got = audio.tensor_values(stored).reshape(-1, audio.BANDS)
        assert np.abs(got[: len(frames)] - frames).max() < 0.05 and (got[len(frames) :] == audio.FLOOR).all()
        begin, end = stored["begin"].to_pylist(), stored["end"].to_pylist()
        assert begin[0] == 0 and abs(end[-1] - len(x) / audio.RATE) < 0.05 and all(p < q for p, q in zip(begin, end, strict=True))
        assert [(s.begin, s.end) for s in r.segments] == brute_segments(got[: len(frames)], len(x) / audio.RATE)
    assert audio.features(audio.store(audio.encode(none))).count() == 0
    x = np.sin(2 * np.pi * 440 * np.arange(8000) / 8000)
    y = audio.resample(x, 8000, 6000)
    assert np.abs(y[50:-50] - np.sin(2 * np.pi * 440 * np.arange(6000) / 6000)[50:-50]).max() < 1e-2


def brute_resample(x, rate, target):
    """Zeros between the samples, the whole low-pass filter, and every so-many-th value of the result."""
    g = math.gcd(rate, target)
    up, down = target // g, rate // g
    n = 2 * audio.TAPS * max(up, down) + 1
    h = np.sinc((np.arange(n) - n // 2) / max(up, down)) * np.hanning(n + 2)[1:-1]
    wide = np.zeros(len(x) * up)
    wide[::up] = x
    return np.convolve(wide, h * up / h.sum())[n // 2 :: down][: -(-len(x) * up // down)]


def brute_log_mel(x, rate):
    """Each window by a Fourier sum and each band by its triangle, from the definitions."""
    frames = max(1, 1 + -(-max(0, len(x) - audio.WINDOW) // audio.HOP))
    x = np.concatenate([x, np.zeros((frames - 1) * audio.HOP + audio.WINDOW - len(x))]) if len(x) < (frames - 1) * audio.HOP + audio.WINDOW else x
    k = np.arange(audio.WINDOW // 2 + 1)
    wave = np.exp(-2j * np.pi * np.outer(np.arange(audio.WINDOW), k) / audio.WINDOW)
    mel = np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), audio.BANDS + 2)
    edge = 700 * (10 ** (mel / 2595) - 1) / (rate / 2) * (audio.WINDOW // 2)
    tri = np.array([[max(0.0, min((i - a) / (b - a), (c - i) / (c - b))) for i in k] for a, b, c in zip(edge, edge[1:], edge[2:], strict=False)])
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(audio.WINDOW) / (audio.WINDOW - 1))
    power = np.array([np.abs((x[i * audio.HOP : i * audio.HOP + audio.WINDOW] * window) @ wave) ** 2 for i in range(frames)])
    return np.maximum(np.log(power @ tri.T + 1e-6), audio.FLOOR)


def brute_segments(frames, length):
    """One frame after the other: loud above the upper limit, and from there both ways as far as the lower one."""
    e = frames.mean(1)
    if not e.std() > 1e-6:
        return []
    z, out, i = (e - e.mean()) / e.std(), [], 0
    while i < len(z):
        j = i
        while j < len(z) and z[j] >= audio.LOWER:
            j += 1
        if any(z[i:j] > audio.UPPER):
            step = audio.HOP / audio.TARGET
            out.append((i * step, min(length, (j - 1) * step + audio.WINDOW / audio.TARGET)))
        i = j + 1
    return out


def brute_classes(rows):
    bags, parent = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, t in rows:
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        n = min(5, len(w))
        bags[i] = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else (t or "")
        parent[i] = i
    ids = sorted(bags)
    for a in ids:
        for b in ids:
            if a < b:
                x, y = bags[a], bags[b]
                same = x == y if isinstance(x, str) or isinstance(y, str) else sum((x & y).values()) >= 0.8 * sum((x | y).values())
                if same:
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, odd, none):
    docs = common.table(spark, DIR, "documents").limit(120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: r.class_id for r in bagminhash.classes(docs).collect()} == brute_classes(rows)
    got = {r.doc_id: r.class_id for r in bagminhash.classes(odd).collect() if r.doc_id is not None}
    assert got == brute_classes(list(enumerate(ODD)))
    kept = bagminhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == 1 and kept.where("doc_id = 4").count() == 1
    assert bagminhash.classes(none).count() == 0 and bagminhash.keep_one(none).count() == 0


def test_batches_are_bounded_by_bytes(spark):
    def sizes(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    row = 1 << 20
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    bagminhash.classes(spark.createDataFrame([], DOCS))  # operators set the bound themselves
    got = spark.range(0, 20, 1, 1).select(F.expr(f"unhex(repeat('ab', {row}))").alias("x")).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 20 and max(r.size for r in got) <= common.BATCH_BYTES + 2 * row


def test_patterns_are_counted_in_small_slices():
    texts = [f"{w} " * 100_000 + "shared" for w in ("alpha", "bravo", "delta")]
    got = list(toxicity._patterns([pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1, 0, 0])], ["_text", "_toxic"])]))
    count = Counter()
    for b in got:
        for r in b.to_pylist():
            count[r["pattern"]] += np.array([r["toxic"], r["clean"]])
    assert len(got) == 3 and count[" shared "].tolist() == [1, 2] and count[" alpha "].tolist() == [1, 0] and count[" delta "].tolist() == [0, 1]


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = [b"one two " * 9, b"", b"x" * 100, b"Three  four"]
    whole = words.word_hashes(texts)
    monkeypatch.setattr(words, "_BLOCK", 16)
    assert all(np.array_equal(a, b) for a, b in zip(whole, words.word_hashes(texts), strict=True))


def test_signatures_are_unbiased():
    r, estimates, true = np.random.default_rng(1), [], []
    for _ in range(30):
        e = np.unique(r.integers(0, 2**63, 50).astype(np.uint64))
        a, b = r.integers(1, 9, len(e)), r.integers(1, 9, len(e))
        s = bagminhash.signatures([(e, a), (e, b)], 1024)
        estimates.append((s[0] == s[1]).mean())
        true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(estimates) - np.mean(true)) < 0.01


def test_large_mixed_buckets_lose_no_link(spark):
    r = np.random.default_rng(2)
    base, rows = [f"w{i}" for i in range(60)], []
    for i in range(150):
        w = list(base)
        for k in r.choice(60, int(r.integers(0, 5)), replace=False):
            w[k] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    got = {x.doc_id: x.class_id for x in bagminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_long_texts_are_counted_and_compared_whole(spark):
    a, b = np.array([5, 9], np.uint64), np.array([5, 9 + 2**32], np.uint64)
    assert bagminhash.similarity(a.tobytes(), b.tobytes()) == 1 / 3 and bagminhash.similarity(a.tobytes(), a.tobytes()) == 1
    assert len(bagminhash.bag(np.arange(20, dtype=np.uint64))[2]) == 8 * 16
    n = 40000  # members of one group, more than 16 bits count
    members = (np.arange(n, dtype=np.uint64) * np.uint64(bagminhash.PARTS) << np.uint64(32)).tobytes()
    sketches = spark.createDataFrame([(1, members), (2, members)], "_node long, _members binary")
    shared = spark.createDataFrame([(7, 1, n), (7, 2, n)], "_band long, _node long, _size int")
    got = bagminhash._between(shared, spark.createDataFrame([], "_node long, _root long"), sketches, 0.8).collect()
    assert len(got) == 2 and all(r._common == n and r._parts[0] == n for r in got)


def test_one_row_of_each_class_stays(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(30))
    rows = [(1, text("a")), (2, text("b")), (2, text("c")), (2, text("a")), (None, text("a")), (None, text("d")), (None, text("d")), (3, text("c")), (3, text("c"))]
    got = bagminhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in got) == [(0, "d"), (1, "a"), (2, "b"), (2, "c")]


def test_kept_texts_move_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bagminhash.keep_one(common.table(spark, DIR, "documents").limit(50))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan[: plan.index("SortMergeJoin")]
    assert "row_number()" in above and "Exchange" not in above


def test_decontamination(spark, odd, none, monkeypatch):
    items = spark.createDataFrame([("b", "One two three four five six seven eight nine TEN eleven"), ("a", "short item"), ("c", None), ("d", "--")], "item_id string, text string")
    text = "x one two, three four five six seven eight nine ten; ELEVEN z. Short -- item!"
    docs = spark.createDataFrame([(1, text), (1, "clean"), (2, None), (None, "a short item"), (3, "short items")], "doc_id long, text string")
    got = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.report(docs, items).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {(1, 15): (13, 2, sha("a,b")), (1, 1): (0, 0, sha("")), (2, 0): (0, 0, sha("")), (None, 3): (2, 1, sha("a")), (3, 2): (0, 0, sha(""))}
    assert sorted(r.text or "" for r in decontaminate.remove_documents(docs, items).collect()) == ["", "clean", "short items"]
    assert sorted(r.text or "" for r in decontaminate.remove_spans(docs, items).collect()) == ["", "a", "clean", "short items", "x z!"]
    for block, characters, documents in ((1, 0, 0), (1, 10**9, 0), (2, 0, 10**9)):  # blocks of windows, and both sides of the switches
        monkeypatch.setattr(decontaminate, "BROADCAST_CHARACTERS", characters)
        monkeypatch.setattr(decontaminate, "BROADCAST_DOCUMENTS", documents)
        again = {(r._id, tuple(map(tuple, r._spans)), tuple(r._items)) for r in decontaminate.hits(docs.union(docs), items, block_windows=block).collect()}
        assert again == {(1, ((1, 11), (2, 12), (13, 15)), ("a", "b")), (None, ((1, 3),), ("a",))}
    assert decontaminate.report(odd, items).count() == odd.count()
    assert decontaminate.report(none, items).count() == 0 and decontaminate.report(docs, items.limit(0)).where("contaminated").count() == 0


def test_warc(spark):
    rows = [(1, "http://a", "<p>x"), (2, None, "<p>x"), (3, "u", None), (4, "u", ""), (None, "u", "<p>x"), (5, "u", "é" * 2_000_000), (6, "u\r\nX: 1", "\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    for i, _, html in rows:
        b = (html or "").encode()
        first = {2: 1, None: 1, 4: 3}.get(i)
        assert got[i] == (len(b), warc.base32_sha1(b), "revisit" if first else "response", first)
    folder = common.scratch(spark, "t")
    r = warc.write(pages, folder).where("page_id = '6'").first()
    with open(f"{folder.removeprefix('file://')}/{r.bundle}", "rb") as f:
        headers, block = warc.BundleReader(pa.PythonFile(f)).record(r.frame, r.offset)
    assert headers["X-Page-ID"] == "6" and block.endswith(b"\r\n\r\nWARC/1.1")
    assert warc.round_trip(pages.limit(0)).count() == 0
    odd = spark.createDataFrame([("a\r\nb%41", "u", "x", "c"), ("z", "u", "x", "d"), ("z", "v", "x", "e"), (None, "u", "y", "f"), (None, "u", "y", "f")], "page_id string, url string, html string, URL_ string")
    want = sorted([("a\r\nb%41", "response", ""), ("z", "revisit", "a\r\nb%41"), ("z", "revisit", "a\r\nb%41"), ("", "response", ""), ("", "response", "")])
    for rows in (0, 10**6):  # both sides of the switch
        folder = common.scratch(spark, "t")
        index = warc.write(odd, folder, broadcast_rows=rows)
        assert sorted((r.page_id or "", r.record_type, r.refers_to or "") for r in warc.read(spark, folder, index).collect()) == want
        assert index.select("record_id").distinct().count() == 4


def test_main_text(spark):
    page = "<body><nav><a href=x>Home</a></nav><div class=ad>Buy now, cheap.</div><article><h1>T&amp;t</h1><p><b>One,\n two.<br>x<p>Three&nbsp;four.</p><div class='comments'><p>Nice, I agree.</div></article><footer>&copy; z, w.</footer>"
    assert html_paths.main_text(page) == "T&t\n\nOne, two. x\n\nThree four."
    assert html_paths.main_text("") == "" and html_paths.main_text("<script>a</script>") == ""
    pages = spark.createDataFrame([(1, None, None), (2, "u", page)], "page_id long, url string, html string")
    assert {r.page_id: r.n_chars for r in html_paths.extract(pages).collect()} == {1: 0, 2: len(html_paths.main_text(page))}


def test_main_text_of_divided_pages():
    long, short = "<p>One long paragraph, with words; and more of them. Then some, again.</p>" * 17, "<p>A shorter part, which ends the text. It stands apart.</p>" * 3
    got = html_paths.main_text(f"<body><ul class=menu><li><a href=x>Home</a></ul><h1>Title</h1><div>{long}</div><div>{short}</div><div><a href=y>Next page</a></div></body>")
    assert got.startswith("Title\n\nOne long") and got.count("A shorter part") == 3 and got.count("One long") == 17 and "Home" not in got and "Next" not in got
    assert html_paths.main_text(f"<body><h1>Title</h1><div>{long}</div></body>").startswith("Title")
    got = html_paths.main_text(f"<body><article>{'<p>First, of two. Yes.</p>' * 6}</article><article>{'<p>Second, of two. Yes.</p>' * 4}</article></body>")
    assert got.count("First") == 6 and got.count("Second") == 4


def test_main_text_with_marked_parts():
    parts = """<p>Before, it begins. So.</p><h2 id="discussion">Discussion</h2><p id="search">We search, and find. Here.</p>
    <section id="related-work"><h3>Related work</h3><p>Others did this, before. Long ago.</p></section><p class="notice">Note this, please. It counts.</p>
    <p><span class="notice">Note:</span> the rest, of a paragraph. Fine.</p><p>Seen <span hidden>unseen</span> here, at last. Yes.</p>"""
    aside = '<div class="share"><a href=x>Share</a> <a href=y>Post</a></div><div class="comments"><p>Nice, I agree. Really.</p></div>'
    for tag in ("article", "main", "div"):
        got = html_paths.main_text(f"<body><{tag}>{parts}{aside}</{tag}></body>")
        for x in ("Before", "Discussion", "We search", "Related work", "Others did", "Note this", "Note: the rest", "Seen here"):
            assert x in got, (tag, x)
        assert not any(x in got for x in ("Share", "Nice", "unseen"))


def test_folding_and_exceptions():
    lex = toxicity.Lexicon({" idio": 3.0, " scum ": 2.0}, ("scum bag of chips",))
    assert [m[2] for m in lex.matches(toxicity.fold("You 1d10t, SCUM! idio scum bag of chips"))] == [3.0, 2.0]
    assert toxicity.fold("ｉｄіоt") == " idiot " and toxicity.fold("1999 b2b") == " 1999 b2b "


def test_a_group_of_copies_counts_once(spark):
    r = np.random.default_rng(4)
    prose = lambda n=60: [f"w{k}" for k in r.integers(0, 3000, n)]
    texts = [(" ".join([*prose(), "grolbak"]), 1) for _ in range(30)] + [(" ".join(prose()), 0) for _ in range(200)]
    hot = [*prose(200), "the", "grolbak", "river", *prose(200)]
    texts += [(" ".join([*hot, f"v{i % 7}"]), 0) for i in range(300)] + [(" ".join(prose()), 1)] * 300
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(texts)], "doc_id long, toxic int")
    lexicon = toxicity.train(docs, labels)
    assert " grolbak " in lexicon.entries or any(" grolbak".startswith(x) for x in lexicon.entries)
    assert lexicon.matches(toxicity.fold("so a grolbak it is")) and lexicon.score(["so a grolbak it is"])[0] > lexicon.score(["so it is"])[0]
    once = toxicity.merged(toxicity.sample(docs, labels, 20000, "doc_id", "text"))
    assert once.count() == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(230)) + 2  # and one of each group of copies


def test_learnt_scores(spark, odd, none):
    docs, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    net, prior = quality_pu.train(docs, labels)
    assert 0.6 < prior < 0.98
    lexicon = toxicity.train(docs, labels)
    out = docs.join(labels, "doc_id").where(common.held_out("doc_id")).select("quality", "toxic", quality_pu.score_column(net, "text").alias("q"), toxicity.score_column(lexicon, "text").alias("t")).toPandas()
    assert ((out.q >= 0.3) == (out.quality == 1)).mean() > 0.85 and ((out.t >= 0.5) == (out.toxic == 1)).mean() > 0.8
    for column in (quality_pu.score_column(net, "text"), toxicity.score_column(lexicon, "text")):
        assert odd.select(column.alias("s")).where("s BETWEEN 0 AND 1").count() == odd.count()
    empty = labels.limit(0)
    assert quality_pu.train(none, empty)[0].score(np.zeros((1, quality_pu.N_FEATURES)))[0] == 0.5
    assert toxicity.train(none, empty).entries == {}
    assert [r.h for r in spark.range(50).select(common.held_out("id").alias("h")).collect()] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)]


def test_the_pipeline_decodes_what_it_encodes(spark, odd):
    import corpus_pipeline

    out = corpus_pipeline.encoded(spark, odd, DIR).collect()
    assert len(out) == odd.count() and all(r.round_trip is True for r in out)


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage on a table with nulls, empty texts, repeated rows and clashing names, against plain Python."""
    import corpus_pipeline
    import sentencepiece

    base = common.table(spark, DIR, "documents").limit(70).toPandas()
    rows = [(int(r.doc_id), r.text, r.lang, r.source, int(r.n_chars), "k") for r in base.itertuples()]
    rows += [rows[3], (900, None, None, None, None, None), (901, "", "en", "s", 0, None), (None, rows[5][1], "en", "s", 1, "n"), (902, rows[7][1] + " Added words here.", "en", "s", 2, "n"), (3, "Another text with the id three, quite unlike it. " * 4, "en", "s", 3, "n")]
    bench = [(r.item_id, r.text) for r in common.table(spark, DIR, "benchmark").collect()]
    rows.append((903, "Before it. " + bench[0][1] + " After it.", "en", "s", 4, "b"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Piece_ids string").write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        common.table(spark, DIR, t).write.parquet(str(tmp_path / f"{t}.parquet"))
    docs, d = common.table(spark, str(tmp_path), "documents"), str(tmp_path)
    key = lambda r: (r[0] if r[0] is not None else -1, r[1] or "", r[5] or "")
    plain = lambda df: sorted(key(tuple(r)) for r in df.collect())
    net, _ = quality_pu.train(docs, common.table(spark, d, "labels"))
    good = [r for r, s in zip(rows, net.score(quality_pu.features([(r[1] or "").encode() for r in rows])), strict=True) if s >= quality_pu.THRESHOLD]
    assert plain(corpus_pipeline.quality(spark, docs, d)) == sorted(map(key, good))
    lexicon = toxicity.train(docs, common.table(spark, d, "labels"))
    calm = [r for r, s in zip(rows, lexicon.score([r[1] or "" for r in rows]), strict=True) if s < toxicity.THRESHOLD]
    assert plain(corpus_pipeline.clean(spark, docs, d)) == sorted(map(key, calm))
    classes = brute_classes(list(enumerate(r[1] for r in rows)))
    once = corpus_pipeline.dedup(spark, docs, d)
    kept = plain(once)
    of_text = {(r[1] or ""): classes[i] for i, r in enumerate(rows)}
    assert sorted(of_text[t] for _, t, _ in kept) == sorted(set(classes.values()))  # one row of each class, none lost
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(classes[i], []).append(r[0] if r[0] is not None else 10**9)
    assert all((i if i >= 0 else 10**9) == min(least[of_text[t]]) for i, t, _ in kept)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[i : i + min(10, len(w))]) for _, t in bench for w in [words(t)] if w for i in range(len(w) - min(10, len(w)) + 1)}
    hit = lambda w: any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
    assert plain(corpus_pipeline.decontaminated(spark, docs, d)) == sorted(key(r) for r in rows if not hit(words(r[1]))) and hit(words(rows[-1][1]))
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    out = corpus_pipeline.encoded(spark, docs, d)
    assert out.columns[:6] == docs.columns and sorted(tuple(r[6]) for r in out.collect()) == sorted(tuple(sp.encode(r[1] or "")) for r in rows)
    whole = corpus_pipeline.run(spark, d)
    assert 0 < whole.count() < len(rows) and whole.where("round_trip").count() == whole.count()
    empty = docs.limit(0)
    assert all(stage(spark, empty, d).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, DIR)
    assert [n for n, _ in corpus_pipeline.STAGES] and 0 < out.count() < 200 and "piece_ids" in out.columns
    assert queries.queries().keys() == {f.__name__ for f in queries.queries().values()}


def test_quality_counts_all_rows(spark):
    """Scale and counts of outputs equal plain loops over nulls, empty texts, repeated ids and rows without an id."""
    rows = [(i, f"Row {i} says, that {'x ' * (i % 7)}is so." * (1 + i % 3)) for i in range(60)] + [(None, "no id"), (None, None), (7, ""), (7, "other text")] + [(9, "hot")] * 50
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2 if i % 3 else None) for i in range(40)] + [(9, 1), (None, 1)], "doc_id int, quality int")
    x = quality_pu.features([(t or "").encode() for _, t in rows])
    stored, known = quality_pu.feature_rows(docs), quality_pu.labelled(labels)
    mean, deviation = quality_pu.moments(stored)
    assert np.allclose(mean, x.mean(0, dtype=float), rtol=1e-5, atol=1e-6) and np.allclose(deviation, x.std(0, dtype=float), rtol=1e-4, atol=1e-4)
    net = quality_pu.Network(quality_pu.N_FEATURES, seed=3)
    net.mean, net.scale = mean, deviation + np.float32(1e-3)
    quality = {r._id: r._q for r in known.collect()}
    held = {r.doc_id for r in docs.where(common.held_out("doc_id")).collect()}
    left_out = {3, 4, 5}
    kinds = [None if i in held or i in left_out else quality.get(i, "u") for i, _ in rows]
    z, p, u = quality_pu.output_counts(stored, known, net, spark.createDataFrame([(i,) for i in left_out], "_id int"))
    assert (p.sum(), u.sum()) == (kinds.count(1), kinds.count("u")) and None not in quality
    outputs = net.forward(net.scaled(x))[1]
    for n, kind in ((p, 1), (u, "u")):
        assert np.allclose(np.sort(np.repeat(z, n.astype(int))), np.sort(outputs[[k == kind for k in kinds]]), atol=1 / quality_pu.BINS)
    assert quality_pu.estimate_prior(np.array([0.0, 0, 500]), np.array([300.0, 0, 200])) == 0.4
    assert 1 < quality_pu.valley(np.arange(5.0), np.array([0.0, 0, 0, 9, 9]), np.array([9.0, 9, 0, 3, 3]), 0.4) < 3
