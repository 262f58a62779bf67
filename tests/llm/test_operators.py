"""The numbered operators on edge cases (nulls, empty and long texts, ties,
repeated rows, empty tables, clashing column names) against brute force."""

import hashlib
import math
import os
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from threadloom.llm import (bpe, exact_dedup, fragments, html_text, licenses, mincut, near_dup, packing, quality, textbuf,
                            token_cache, topk, url_rules)
from threadloom.llm.fragments import TokenizerFile
from threadloom.llm.store import Scratch

os.environ["TOKENIZERS_PARALLELISM"] = "false"

WORDS = TokenizerFile.read(public_tokenizers.path("word_bpe_49k.json"))
BYTES = TokenizerFile.read(public_tokenizers.path("byte_bpe_50k.json"))
LONG = "lorem Ipsum, dolor's sit 42 amet. " * 6000
TEXTS = [(1, None), (2, ""), (3, "  \n\t "), (4, "Hello, World."), (5, "Hello, World."), (5, "Hello, World."),
         (6, "hello, world."), (7, LONG), (8, LONG), (9, "a\u00e9\u0301\u0130. <|endoftext|> <|startoftext|>x 's !'s"),
         (None, "Hello, World."), (None, "only without id"), (10, "\u65e5\u672c\u8a9e\U0001F600'll \u3000  x")]


@pytest.fixture(scope="module")
def docs(spark):
    """With columns that clash with those the operators add."""
    return spark.createDataFrame([(i, t, "z", 7, True) for i, t in TEXTS],
                                 "doc_id long, text string, n_tokens string, n_bytes long, kept boolean").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def library_ids(file):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(file.text)
    return t, [t.encode(x or "", add_special_tokens=False).ids for _, x in TEXTS]


def test_scratch_is_released(spark, docs, tmp_path):
    where = []
    for i, run in enumerate([near_dup.near_duplicates, exact_dedup.exact_dedup]):
        with Scratch(spark, "released") as scratch:
            run(docs, scratch=scratch).write.parquet(f"{tmp_path}/{i}")
            assert os.listdir(scratch.root)
        where.append(scratch.root)
        assert spark.read.parquet(f"{tmp_path}/{i}").count() == len(TEXTS)
    with pytest.raises(ZeroDivisionError), Scratch(spark, "failed") as scratch:
        scratch.keep(docs, "rows")
        where.append(scratch.root)
        raise ZeroDivisionError
    assert not any(map(os.path.exists, where))


# 1 ------------------------------------------------------------------------
def test_html(spark):
    pages = [
        (1, None, ""), (2, "", ""), (3, "<nav>Menu</nav>", ""), (4, "just some plain words without any tag at all here.",
                                                                 "just some plain words without any tag at all here."),
        (5, "<body><header><p>Site name</p></header><div class='ad'>Buy now, it is the best thing you can get.</div><article>"
            "<h1>Title</h1><p>One &amp; two\n three.<br>Four<p>Five <a href=x>six</a> &lt;b&gt;<script>var p='</p>';</script></p>"
            "</article><aside>More</aside><div id='comments'><p>I liked this long article very much, thanks.</p></div>"
            "<form>Your name <input></form><footer>&copy; us</footer>", "Title\nOne & two three. Four\nFive six <b>"),
        (5, "<p " * 3000, None), (6, "<p>" + "word " * 50000, ("word " * 50000).strip())]
    df = spark.createDataFrame([(i, None, h, "x") for i, h, _ in pages], "page_id long, url string, html string, text string")
    got = {(r.page_id, r.n_chars): r.text for r in html_text.extract_text(df).collect()}
    assert len(got) == len(pages) and all(n == len(t) for (_, n), t in got.items())
    for i, _, want in pages:
        assert want is None or got[(i, len(want))] == want
    assert html_text.extract_text(df.where("false")).count() == 0


def test_unclosed_tags_are_scanned_once():
    import time
    w = html_text.Weights()
    for page in ("<p " * 350_000, "a > b " + "<p " * 350_000, "<script>x</script " * 60_000, "<!-- " * 200_000, "<p>" + "</p " * 250_000):
        began = time.process_time()
        html_text.blocks_of(page, w)
        assert time.process_time() - began < 2, page[:9]
    cases = {"a<b": "a<b", "x <!-- > y": "x ", "x <!-- > --> y <!-- z": "x  y ", "<p>x</p> <? y": "x", "a > b <i": "a > b <i", "a<!b>c<!d": "ac"}
    for page, want in cases.items():
        assert "".join("".join(b.parts) for b in html_text.blocks_of(page, w)).strip() == want.strip(), page


def test_cut_beats_the_sign_on_mixed_pages():
    """Pages without telling tags: short lines between paragraphs are content, sentences between
    links are not.  The cut, with the weights of production, against the sign of each block's score."""
    import dataclasses
    rng = random.Random(11)
    alone = dataclasses.replace(html_text.Weights(), adjacent=0.0, siblings=0.0)
    hit, said, true = Counter(), Counter(), 0

    def words(n):
        return " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))

    for _ in range(200):
        parts, want = [], set()
        for kind in (False, True, False):
            for i in range(rng.randint(3, 7)):
                odd = 0 < i and rng.random() < 0.3
                if kind:
                    line = words(rng.randint(1, 3)) if odd else words(rng.randint(12, 40)) + "."
                    parts.append(f"<div>{line}</div>" if odd else f"<p>{line}</p>")
                    want.add(line)
                else:
                    line = words(rng.randint(7, 9)) + "." if odd else words(2)
                    parts.append(f"<div>{line}</div>" if odd else f"<div><a href=x>{line}</a></div>")
        true += len(want)
        page = "<html><body>" + "".join(parts) + "</body></html>"
        for name, w in (("cut", html_text.Weights()), ("sign", alone)):
            got = set(html_text.main_text(page, w).split("\n")) - {""}
            hit[name] += len(got & want)
            said[name] += len(got)
    f1 = {name: 2 * hit[name] / (said[name] + true) for name in said}
    assert f1["cut"] > 0.9 and f1["cut"] > f1["sign"] + 0.2, f1


def test_minimum_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 7)
        score = [rng.choice([-2.0, -0.5, 0.0, 0.7, 3.0]) + rng.random() for _ in range(n)]
        edges = [(i, j, rng.random() * 2) for i in range(n) for j in range(i) if rng.random() < 0.6]

        def cost(kept):
            return (sum(x for x, k in zip(score, kept) if x > 0 and not k) - sum(x for x, k in zip(score, kept) if x < 0 and k)
                    + sum(w for i, j, w in edges if kept[i] != kept[j]))

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(mincut.source_side(score, edges)) == pytest.approx(best)


# 2 ------------------------------------------------------------------------
def brute_near(texts, percent=75):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for _, t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(lower))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for k, (i, _) in enumerate(texts):
        ids = [texts[m][0] for m in range(len(texts)) if group[m] == group[k] and texts[m][0] is not None]
        c = (min(ids) if ids else None) if sets[k] else i
        out.append((i, len(sets[k]), c, i is not None and i == c))
    return sorted(out, key=repr)


def test_near_duplicates(spark, docs, none):
    assert rows(near_dup.near_duplicates(docs)) == brute_near(TEXTS)
    assert near_dup.near_duplicates(none).count() == 0
    other = "quite another text of more than five words"
    twice = [(1, TEXTS[3][1]), (5, TEXTS[3][1]), (5, other), (7, other + " here"), (7, "x y z"), (5, "x y z")]  # ids with several texts
    df = spark.createDataFrame(twice, "doc_id long, text string")
    assert rows(near_dup.near_duplicates(df)) == brute_near(twice)
    marked = near_dup.near_duplicates(df, mark=F.col("text").cast("binary")).collect()
    assert {(r.doc_id, r.mark.decode()) for r in marked} == set(twice) and len({r.class_id for r in marked}) == 3
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = []
    for i in range(120):  # a loose chain of variants, and texts that share a passage
        if i % 2:
            base[rng.randrange(60)] = rng.choice(vocabulary)
            texts.append((i, " ".join(base)))
        else:
            texts.append((i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(near_dup.near_duplicates(df, near_dup.Settings(tile=7))) == brute_near(texts)


# 3 ------------------------------------------------------------------------
@pytest.mark.parametrize("how", [exact_dedup.Fingerprint(), exact_dedup.Fingerprint(primes=(7, 5), bases=(3, 2), chunk=5)])
def test_exact_dedup(docs, none, how):
    """The second fingerprint collides for different texts."""
    got = exact_dedup.exact_dedup(docs, how).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        same = [i for i, t in TEXTS if hashlib.sha256((t or "").encode()).hexdigest() == r.text_sha256]
        ids = [i for i in same if i is not None]
        assert r.doc_id in same and r.group_size == len(same) and r.keep_id == (max(ids) if ids else None)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({t or "" for _, t in TEXTS})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.exact_dedup(none, how).count() == 0
    assert rows(exact_dedup.exact_dedup(docs, how, bound=0)) == rows(exact_dedup.exact_dedup(docs, how))  # no filter at the scan


def test_colliding_texts_of_many_chunks(spark):
    """All texts of a length share one fingerprint; they differ in any chunk."""
    weak = exact_dedup.Fingerprint(primes=(2, 2), bases=(1, 1), chunk=4)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ac") for _ in range(n)) for n in (3, 4, 9, 12) for _ in range(40)]  # (odd bytes)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert exact_dedup.collisions(df, weak).count() >= 3
    for r in exact_dedup.exact_dedup(df, weak).collect():
        same = [i for i, t in enumerate(texts) if t == texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))


def test_only_repeated_texts_are_compared(spark):
    from threadloom.llm.store import only_wanted
    df = spark.createDataFrame([(i, f"text {i // 2 if i < 10 else i}") for i in range(400)], "doc_id long, text string")
    df = df.withColumn("mark", F.xxhash64("text"))
    marks = df.groupBy("mark").count().where("count > 1").select("mark")
    assert only_wanted(df, marks, "mark").count() == 10 and only_wanted(df, marks, "mark", 4).count() == 400


def test_fingerprint_of_a_huge_text_in_bounded_memory():
    import tracemalloc
    data = np.full(64 << 20, 97, np.uint8)
    tracemalloc.start()
    got = exact_dedup.fingerprints(data, np.array([0, len(data)]), exact_dedup.Fingerprint())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] != 0 and peak < 100 << 20


def test_collisions_are_found(docs):
    weak = exact_dedup.Fingerprint(primes=(7, 5), bases=(3, 2), chunk=5)
    texts = docs.select(F.explode(F.array([F.lit(f"text {i:03d}") for i in range(60)])).alias("text")).distinct()
    assert exact_dedup.collisions(texts, weak).count() > 0
    assert exact_dedup.collisions(docs).count() == 0


def test_fingerprints_compose():
    how = exact_dedup.Fingerprint(chunk=16)
    whole = bytes(range(256)) * 3

    def of(raw):
        x = int(exact_dedup.fingerprints(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), how)[0])
        return x >> 31, x & 0x7FFFFFFF

    for cut in (0, 1, 16, 100, 767):
        assert how.combine(of(whole[:cut]), of(whole[cut:]), len(whole) - cut) == of(whole)


# 4 ------------------------------------------------------------------------
def test_packing(docs, none):
    got = packing.pack(docs, WORDS, window=64, with_ids=True).collect()
    _, ids = library_ids(WORDS)
    want = sorted(x + [2] for x in ids)
    sequences, texts = {}, []
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.start == 0, r.ids))
    stream = b""
    for s in range(len(sequences)):
        at = 0
        for offset, length, first, raw in sorted(sequences[s], key=lambda x: x[0]):
            assert offset == at
            at, stream = at + length, stream + raw
            if first:
                texts.append(b"")
            texts[-1] += raw
        assert at == 64 or s == len(sequences) - 1
    assert sorted(np.frombuffer(t, "<u4").tolist() for t in texts) == want
    assert packing.pack(none, WORDS).count() == 0


# 5 ------------------------------------------------------------------------
def test_bpe(docs, none):
    t, ids = library_ids(BYTES)
    want = sorted(((i, len(x), ",".join(map(str, x)), t.decode(x, skip_special_tokens=False))
                   for (i, _), x in zip(TEXTS, ids)), key=repr)
    got = bpe.encode_decode(docs, BYTES, full=True).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in got), key=repr) == want
    assert all(hashlib.sha256(r.ids.encode()).hexdigest() == r.ids_sha256
               and hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256 for r in got)
    assert bpe.encode_decode(none, BYTES).count() == 0


@pytest.mark.parametrize("file", [WORDS, BYTES])
def test_fragments_equal_the_library(file):
    import pyarrow as pa
    from threadloom.llm import fragments
    from tokenizers import Tokenizer
    rng = random.Random(11)
    signs = list("abcXYZ 's't'll''  \n\t.,!?<|>0189\u00e9\u00fc\u00df\u00f1 \u3000\u4e2d\u0301\u0130\u00c5\U0001F600\u200b\x1c\x85\u03a3\u03c2") + [
        "<|endoftext|>", "<|startoftext|>", "<|StartOfText|>", " 's", "don't", "word ", "The "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    want = [e.ids for e in Tokenizer.from_str(file.text).encode_batch(texts, add_special_tokens=False)]
    column = pa.array(texts, pa.large_string())
    if file is WORDS:
        ids, off = fragments.word_ids(fragments.encoder(file.text), column)
        got = [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
    else:
        ids, _, first = bpe.encode_texts(fragments.encoder(file.text, bpe.ByteEncoder), column)
        parts = ids.to_pylist()
        got = [[int(x) for x in "".join(parts[a:b]).split(",")[1:]] for a, b in zip(first[:-1], first[1:])]
    assert got == want


# 6 ------------------------------------------------------------------------
def test_top_k(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(130)]
    vectors += [(200 + i, [0.5] * 8) for i in range(30)] + [(20, [0.5] * 8), (20, [0.5] * 8)]  # ties, a repeated id
    odd = [(300, None), (320, [None] * 8), (340, [float("nan")] * 8), (360, [float("inf")] * 8), (380, []), (400, [1.0, 2.0]),
           (401, [1.0, -2.0])]
    df = spark.createDataFrame([(i, v, 3) for i, v in vectors + odd], "vec_id long, embedding array<double>, score int")
    whole = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors + odd[-2:]]
    want = []
    for a, (qi, q) in enumerate(whole):
        if qi % 20 == 0:
            best = sorted((-int(q @ v), i) for b, (i, v) in enumerate(whole) if a != b and len(v) == len(q))[:7]
            want += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert rows(topk.top_k(df, k=7)) == sorted(want, key=repr)
    assert topk.top_k(df.where("false")).count() == 0


def test_top_k_of_large_components(spark):
    """Products beyond 62 bits do not stop the run: exact up to 64 bits, then the limit."""
    rng = random.Random(5)
    sizes = [1.0, 1.0, 1.0, 1e3, 1e3, 3e6, 3e7, 1e9, 1e300]
    vectors = [(i, [rng.uniform(-1, 1) * rng.choice(sizes) for _ in range(5)]) for i in range(90)]
    vectors += [(100 + i, [1e12, -1e12, 1e12, -1e12, rng.uniform(-1, 1)]) for i in range(10)]  # what cancels
    vectors += [(120 + i, [1e12, 1e12, 1e12, 1e12, rng.uniform(-1, 1)]) for i in range(10)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    end = 1 << 63
    whole = [(i, [max(-end, min(end - 1, math.floor(64 * x))) if abs(x) < 1e290 else (end - 1 if x > 0 else -end) for x in v])
             for i, v in vectors]
    want, limits, middle = [], 0, 0
    for qi, q in whole:
        if qi % 20 == 0:
            scores = {i: max(-topk.LIMIT, min(topk.LIMIT, sum(x * y for x, y in zip(q, v)))) for i, v in whole if i != qi}
            want += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(sorted((-s, i) for i, s in scores.items())[:60])]
            limits += sum(abs(s) == topk.LIMIT for s in scores.values())
            middle += sum(abs(s) < 1 << 62 for s in scores.values())
    assert limits > 100 and middle > 50
    assert rows(topk.top_k(df, k=60)) == sorted(want, key=repr)


def test_top_k_copies_no_block_for_a_pair(spark, monkeypatch):
    """What is handed to workers is bounded by QUERY_BYTES, however many blocks queries and vectors have."""
    from pyspark import SparkContext

    from threadloom.llm.store import Scratch
    rng = random.Random(3)
    vectors = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(6 if i % 3 else 4)]) for i in range(900)]
    vectors += [(i, [0.25] * 6) for i in range(900, 1000)] + vectors[:40]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    whole = [(i, (np.floor(64 * np.array(v))).astype(int)) for i, v in vectors]
    want = []
    for a, (qi, q) in enumerate(whole):
        if qi % 20 == 0:
            best = sorted((-int(q @ v), i) for b, (i, v) in enumerate(whole) if a != b and len(v) == len(q))[:9]
            want += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(best)]

    plans, handed, keep, broadcast = [], [], Scratch.keep, SparkContext.broadcast
    monkeypatch.setattr(Scratch, "keep", lambda self, df, *a, **b: plans.append(df._jdf.queryExecution().toString()) or keep(self, df, *a, **b))
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, x: handed.append(x) or broadcast(self, x))
    monkeypatch.setattr(topk, "QUERY_BYTES", 1500, raising=False)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    assert rows(topk.top_k(df, k=9)) == sorted(want, key=repr)
    assert not [x for x in plans if "explode" in x or "Broadcast" in x]
    assert 0 < max(sum(len(q.rid) * (64 + 2 * q.dim) for q in own) for own in handed) < 3 * 1500
    monkeypatch.setattr(topk, "GROUP_BYTES", 300)
    assert rows(topk.top_k(df, k=9)) == sorted(want, key=repr)


# 7 ------------------------------------------------------------------------
def quality_tables(spark):
    rng = random.Random(9)
    good = [f"tion{i}" for i in range(60)]
    texts = []
    for i in range(400):
        words = [rng.choice(good) for _ in range(rng.randint(5, 60))]
        texts.append((i, " ".join(words) if i % 5 else " ".join(w.upper() + "!!" for w in words)))
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(0, 400, 2)] + [(None, 1), (3, None)],
                                   "doc_id long, quality int")
    return texts, labels


def test_quality(spark):
    texts, labels = quality_tables(spark)
    odd = [(1000, None), (1001, ""), (None, texts[1][1]), (1, texts[1][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in texts + odd], "doc_id long, text string, kept int").repartition(3)
    got = quality.draw(df, labels).collect()
    assert len(got) == 404 and set(got[0].asDict()) == {"doc_id", "text", "n_ngrams", "log_weight", "gumbel_key", "kept"}
    for r in got:
        clean = bool(r.text) and "!!" not in r.text
        assert r.kept == clean, r
    assert quality.draw(df.where("false"), labels).count() == 0
    free = quality.draw(df, labels.where("quality = 0")).collect()
    assert all(r.kept == bool(r.text) for r in free)  # nothing to compare with: all with words


def brute_quality(texts, labels):
    """{doc_id: (n_ngrams, log_weight, key, kept)} by plain loops; the word hash alone is shared."""
    size = quality.BUCKETS

    def spark_hash(*values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    def word(w):
        return int(textbuf.word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]), textbuf.WORDS_AND_SIGNS)[0][0])

    def grams(text):
        hashes = [word(w) for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", text.encode())]
        pairs = [size if a == b else size + 1 + int(textbuf.mix(
            np.array([(a * int(quality._PAIR) + b) % (1 << 64)], np.uint64))[0]) % (size - 1) for a, b in zip(hashes, hashes[1:])]
        return [h % size for h in hashes] + pairs

    own = {i: grams(t) for i, t in texts}
    fold = {i: spark_hash(i) % 5 for i in labels}
    raw = Counter(g for x in own.values() for g in x)
    good = Counter(g for i, x in own.items() if labels.get(i) and fold[i] for g in x)

    def ratio(g):
        part = range(size) if g < size else range(size, 2 * size)
        return (math.log((good[g] + 1) / (sum(good[b] for b in part) + size))
                - math.log((raw[g] + 1) / (sum(raw[b] for b in part) + size)))

    known = {g: ratio(g) for g in raw}
    total = {i: sum(known[g] for g in x) for i, x in own.items()}
    held = sorted((total[i] / len(own[i]), labels[i]) for i in labels if not fold[i] and own[i])
    edges = sorted({s for s, _ in held})
    cuts = [(edges[0] - 1, 1)] + [((a + b) / 2, b - a) for a, b in zip(edges, edges[1:])] + [(edges[-1] + 1, 1)]
    n_good = sum(g for _, g in held)

    def loss(cut):
        return (3 * sum(g and s < cut for s, g in held) / n_good
                + sum(not g and s >= cut for s, g in held) / (len(held) - n_good))

    least = min(loss(c) for c, _ in cuts)
    cut = max(((gap, c) for c, gap in cuts if loss(c) <= least + 1e-12), key=lambda x: x[0])[1]
    weight = {i: total[i] - cut * len(own[i]) for i in own}
    key = {i: w - math.log(-math.log((spark_hash("gumbel", i) % ((1 << 52) - 1) + 1) / 2 ** 52)) for i, w in weight.items()}
    k = sum(w > 0 for w in weight.values())
    drawn = set(sorted((i for i in own if own[i]), key=lambda i: (-key[i], i))[:k])
    return {i: (len(own[i]), weight[i], key[i], i in drawn) for i in own}


def test_quality_equals_brute_force(spark):
    """Texts of all mixtures, so that the noise decides some of them."""
    rng = random.Random(4)
    texts = [(i, " ".join(f"Bad{rng.randint(0, 9)}!" if rng.random() < i % 11 / 10 else f"good{rng.randint(0, 9)}"
                          for _ in range(rng.randint(1, 9)))) for i in range(500)]
    labels = {i: i % 11 < 5 for i in range(0, 500, 2)}
    table = spark.createDataFrame([(i, int(g)) for i, g in labels.items()], "doc_id long, quality int")
    got = quality.draw(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), table).collect()
    want = brute_quality(texts, labels)
    assert len(got) == len(want)
    for r in got:
        n, weight, key, kept = want[r.doc_id]
        assert (r.n_ngrams, r.kept) == (n, kept)
        assert r.log_weight == pytest.approx(weight, abs=1e-8) and r.gumbel_key == pytest.approx(key, abs=1e-8)
    assert 0 < sum(r.kept != (r.log_weight > 0) for r in got) < 250


def test_kth(spark):
    keys = [(i, float(i // 7)) for i in range(500)]
    df = spark.createDataFrame(keys, "doc_id long, key double")
    order = sorted(keys, key=lambda r: (-r[1], r[0]))
    for k in (1, 8, 250, 500):
        got = quality.kth(df, k)
        assert (got.key, got.doc_id) == (order[k - 1][1], order[k - 1][0])
        assert df.where(got.drawn(F.col("key"))).count() == k


# 8 ------------------------------------------------------------------------
def test_licenses(spark):
    mit = "\n".join(f"# {w[0]}" for k, w in licenses.SENTENCES.items() if k.startswith("mit-") and k != "mit-notice")
    cases = [
        (1, None, "", 0), (2, "", "", 0), (3, "No license here.", "", 0), (4, "Released under the MIT License.", "MIT", 1),
        (5, "a | b |\nLICENSED UNDER the Apache\nlicense, Version 2.0. More text. Licensed under CC BY-NC 4.0. End", "Apache-2.0,CC-BY-NC-4.0", 2),
        (6, "MIT License\n" + mit, "MIT", 1), (7, "x. " * 5000 + "All rights reserved. Released under the MIT License.", "MIT", 1),
        (7, "Released under the MIT License. Released under the MIT License.", "MIT", 2)]
    df = spark.createDataFrame([(i, t, 1) for i, t, _, _ in cases], "doc_id long, text string, licenses int")
    got = sorted(((r.doc_id, r.licenses, r.n_matches) for r in licenses.scan_licenses(df).collect()), key=repr)
    assert got == sorted(((i, want, n) for i, _, want, n in cases), key=repr)
    found = {r.doc_id: r for r in licenses.scan_licenses(df.where("doc_id = 5 OR length(text) > 9000")).collect()}
    assert [(m.license, m.sentence, m.sentences) for m in found[5].matches] == [("Apache-2.0", 1, 1), ("CC-BY-NC-4.0", 3, 1)]
    assert found[7].has_unmatched and found[7].matches[0].sentence == 5001
    assert licenses.scan_licenses(df.where("false")).count() == 0


def brute_licenses(text):
    """Sentence by sentence, rule by rule, in plain Python."""
    known = {licenses.normal_sentence(w): name for name, ways in licenses.SENTENCES.items() for w in ways}
    text = re.sub(r"(?m)^[ \t]*(?:(?:#+|//+|\*+)[ \t]*)?\(?[0-9]{1,2}[.)][ \t]+", "", text or "")
    pieces = re.split(r"(?<=[.!?:])\s+|\n+", re.sub(r"\n[ \t]*(?:#+|//+|\*+)?[ \t]*(?=[a-z])", " ", text))
    ids = [known.get(licenses.normal_sentence(s)) for s in pieces]
    out, i, missed = [], 0, False
    while i < len(ids):
        fit = next(((name, len(want)) for name, want in licenses.RULES if ids[i:i + len(want)] == want), None)
        missed = missed or (fit is None and ids[i] is not None)
        if fit:
            out.append((fit[0], i, fit[1]))
        i += fit[1] if fit else 1
    return out, missed


def test_licenses_equal_brute_force(spark):
    rng = random.Random(8)
    known = [w for ways in licenses.SENTENCES.values() for w in ways]
    assert all(len(re.split(r"(?<=[.!?:])\s+|\n+", w)) == 1 for w in known)  # each is one sentence
    assert len({licenses.normal_sentence(w) for w in known}) == len(known)
    texts = []
    for i in range(400):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                name, ids = rng.choice(licenses.RULES)
                whole = [rng.choice(licenses.SENTENCES[k]) for k in ids]
                parts += [f"{n}. {s}" for n, s in enumerate(whole, 1)] if kind < 0.1 else whole
            else:
                parts.append(rng.choice(known) if kind < 0.7 else rng.choice(["Some words here.", "License: see below", "1.", "v. 2.0."]))
        lead = rng.choice(["", "# ", "// ", " * "])
        text = rng.choice(["\n", "\n\n"]).join(lead + (p if rng.random() < 0.7 else p.upper()) for p in parts)
        if rng.random() < 0.3:  # wrapped before words in lower case
            text = re.sub(r" (?=[a-z])", lambda m: "\n" + lead if rng.random() < 0.2 else " ", text)
        texts.append((i, text))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r.doc_id: ([tuple(m) for m in r.matches], r.has_unmatched) for r in licenses.scan_licenses(df).collect()}
    want = {i: brute_licenses(t) for i, t in texts}
    assert got == want
    assert {name for name, _ in licenses.RULES} == {m[0] for found, _ in want.values() for m in found}


# 9 ------------------------------------------------------------------------
def brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/", "http://a.www.example.com/en/q",
            "http://example.com/en", "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://com", "http://a.com?x/",
            "http://b.com#/en/", "ftp://x.org/\u00e9", "a://b://c.com/", "http://com./", "http://" + "s." * 300 + "com/" + "p" * 5000]
    df = spark.createDataFrame([(i % 9, u, "h", "v") for i, u in enumerate(urls + urls[:4])],
                               "page_id long, url string, host string, verdict string")
    got = rows(url_rules.judge_urls(df, url_rules.rule_table(spark)).drop("page_id"))
    assert got == sorted((brute_rule(u, url_rules.CONTRACT_RULES) for u in urls + urls[:4]), key=repr)
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "net", "a.net", "b.net"]
    rules = sorted({(rng.choice(hosts), "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 3)))): rng.choice(["allow", "block"])
                    for _ in range(25)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{rng.choice(['', 'x.'])}{rng.choice(hosts)}/{''.join(rng.choice('ab/') for _ in range(5))}" for _ in range(200)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (len(r.rule or ""), r.verdict if r.rule else "allow") for r in
           url_rules.judge_urls(df, url_rules.rule_table(spark, rules), sweeps=5).collect()}
    assert got == {i: (len(w[2] or ""), w[3]) for i, w in ((i, brute_rule(u, rules)) for i, u in enumerate(urls))}
    empty = url_rules.rule_table(spark).where("false")
    assert {r.verdict for r in url_rules.judge_urls(df, empty).collect()} == {"allow"}
    assert url_rules.judge_urls(df.where("false"), url_rules.rule_table(spark)).count() == 0


def test_many_url_rules_are_in_one_sweep_each(spark, tmp_path):
    """200,000 rules, a third of the urls on one host, one url many times."""
    hosts = "concat('h', id % 9973, CASE WHEN id % 4 = 0 THEN '.net' WHEN id % 4 = 1 THEN '.a.net' ELSE '.com' END)"
    rules = spark.range(200_000).selectExpr(f"{hosts} AS host", "concat('/', id % 7, '/', substr(md5(string(id)), 1, id % 3)) AS path",
                                            "CASE WHEN id % 5 < 2 THEN 'block' ELSE 'allow' END AS verdict")
    host = "CASE WHEN id % 3 = 0 THEN 'h8.net' ELSE concat('x.h', id * 31 % 9973, CASE WHEN id % 2 = 0 THEN '.a.net' ELSE '.com' END) END"
    path = "CASE WHEN id % 9 = 0 THEN '/1/' ELSE concat('/', id % 7, '/', md5(string(id))) END"
    urls = spark.range(3000).selectExpr("id AS page_id", f"concat('http://', {host}, {path}) AS url")
    scratch = Scratch(spark, "many-rules")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge_urls(urls, rules, sweeps=12, scratch=scratch).collect()}
    laid = spark.read.parquet(scratch.path("laid"))
    assert laid.where("rid IS NULL").groupBy("key").count().where("count > 1").isEmpty()
    sizes = [r["count"] for r in laid.groupBy("sweep").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 3 * sum(sizes) / 12
    known: dict[tuple[str, str], str] = {}
    for r in rules.collect():
        known[r.host, r.path] = max(r.verdict, known.get((r.host, r.path), ""))
    for r in urls.collect():
        name, path = re.fullmatch(r"http://([^/]*)(.*)", r.url).groups()
        ways = [(len(name[i:] + path[:j]), name[i:] + path[:j], known[name[i:], path[:j]])
                for i in [0] + [m.end() for m in re.finditer(r"\.", name)] for j in range(len(path) + 1) if (name[i:], path[:j]) in known]
        _, rule, verdict = max(ways, default=(0, None, "allow"))
        assert got[r.page_id] == (rule, verdict), r.url


# 10 -----------------------------------------------------------------------
def test_token_counts(spark, docs, none):
    cache = Scratch(spark, "test").path("cache")
    _, ids = library_ids(WORDS)
    want = sorted(((i, len((t or "").encode()), len(x), len(x) > 5) for (i, t), x in zip(TEXTS, ids)), key=repr)
    for _ in range(2):  # the second time all are hits
        got = token_cache.count_tokens(docs, cache, WORDS, limit=5)
        assert rows(got.select("doc_id", "n_bytes", "n_tokens", "over_limit")) == want
        assert sorted(got.columns) == sorted(["doc_id", "text", "kept", "n_bytes", "n_tokens", "over_limit"])
        assert spark.read.parquet(cache).count() == len({(t or "").strip(" \t\n\x0b\x0c\r") for _, t in TEXTS})
    assert token_cache.count_tokens(none, cache, WORDS).count() == 0


@pytest.mark.parametrize("bound", [None, 0])
def test_partly_known_contents(spark, docs, bound):
    """Half the contents are cached: the others alone are encoded, once each."""
    cache = Scratch(spark, "test").path("cache")
    token_cache.fill_cache(docs.where("doc_id < 6"), cache, WORDS)
    before = spark.read.parquet(cache).count()
    token_cache.fill_cache(docs, cache, WORDS, bound=bound)
    after = spark.read.parquet(cache)
    assert before < after.count() == after.select("digest").distinct().count()
    assert after.count() == len({(t or "").strip(" \t\n\x0b\x0c\r") for _, t in TEXTS})


def test_known_texts_stay_at_the_scan(spark, docs):
    """The missing digests filter the scan, below the exchange of the texts."""
    missing = Scratch(spark, "test").keep(
        docs.where("doc_id = 7").select(F.unhex(F.sha2(token_cache.normalised("text"), 256)).alias("digest")), "missing")
    found = token_cache.misses(docs, missing)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Aggregate [digest", 1)
    assert "LeftSemi" in below and "strategy=broadcast" in below
    assert [r.text for r in found.collect()] == [LONG.strip()]


def test_word_hashes_over_windows(monkeypatch):
    import pyarrow as pa
    texts = ["", "a b", "A  B\n", "x" * 50, " ", "b a b"]
    data, off = textbuf.buffers(pa.array(texts, pa.large_string()))
    one, at = textbuf.word_hashes(data, off)
    monkeypatch.setattr(textbuf, "WINDOW_BYTES", 3)
    two, _ = textbuf.word_hashes(data, off)
    assert one.tolist() == two.tolist() and np.diff(at).tolist() == [0, 2, 2, 1, 0, 3]
    assert one[:2].tolist() == one[2:4].tolist() and len(set(one.tolist())) == 3


def test_words_with_signs_and_accents_are_encoded_together(monkeypatch):
    """Plain words of either case with signs behind are no texts of their own, and ids are the library's."""
    enc, alone = fragments.WordEncoder(WORDS.text), []
    old = fragments.Encoder.encode_new
    monkeypatch.setattr(fragments.Encoder, "encode_new", lambda self, new: alone.extend(new) or old(self, new))
    words = [f"{a}{b}{c}" for a in ("étre", "Ölfeld", "ÀÉÞ", "TIANTH", "ston") for b in ("quiz", "éz", "Ba") for c in ("", ".", ",", "!!", "$$$", "'", "|>", "_-~")]
    odd = ["don't", "a1.", "x<|endoftext|>.", "İz.", "Ÿ", "e\u0301.", "÷a", ".b", "'s'", "a..b", "", "’."]
    texts = [" ".join(words), *odd, " ".join(odd + words), "\t" + "\n".join(words[::-1]) + " "]
    for _ in range(2):  # the second time from the memo
        ids, off = fragments.word_ids(enc, pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [
            e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(alone) < 30
