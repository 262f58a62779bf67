"""The alignment against whole-text encoding by both libraries, and the hash behind its counts."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from threadloom.llm import alignment, perfect_hash
from threadloom.llm.bpe import byte_alphabet
from threadloom.llm.fragments import TokenizerFile

A = TokenizerFile.read(public_tokenizers.path("byte_bpe_50k.json"))
B = alignment.PieceModel.read(public_tokenizers.path("piece_bpe_32k.model"))


def brute(texts):
    """Rows without doc_id, by whole texts and every link."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(A.text)
    t.encode_special_tokens = True
    sp = SentencePieceProcessor(model_proto=B.content)
    alphabet = byte_alphabet()

    def sides(text):
        if not text:
            return None
        e = t.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(alphabet[c] for c in x)) for i, x in zip(e.ids, e.tokens)]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
             for i in sp.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else None

    def groups(a, b):
        ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in (a, b)]
        common = sorted(set(ends[0]) & set(ends[1]))
        out = [([], []) for _ in common]
        for side, (s, e) in enumerate(zip((a, b), ends)):
            for (i, _), end in zip(s, e):
                out[bisect_left(common, end)][side].append(i)
        return out

    found = [(lambda s: groups(*s) if s else [])(sides(x)) for x in texts]
    links = [[(p, q) for g in gs for p in g[0] for q in g[1]] for gs in found]
    count = Counter(pair for own in links for pair in set(own))
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for gs, own in zip(found, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in gs)
        out.append((sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(own),
                    sum(count[x] == best[x[0]] for x in own), sum(count[x] for x in own),
                    hashlib.sha256(text.encode()).hexdigest() if gs else "", text))
    return out


def texts_of(rng, n):
    signs = list("abcXYZ 's't'll''  \n\t.,!?<|>0189éüß 　中́İ\U0001F600​\x1c\x85   \x00\x7f") + [
        "<|endoftext|>", "<s>", "</s>", "<0x41>", " word", " the", "don't ", "   ", " \n ", "ing "]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("at_once", [alignment.PAIRS_AT_ONCE, 300])
def test_alignment(spark, at_once, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD_PAIRS", 64)
    rng = random.Random(7)
    texts = [None, "", " ", "  ", "\n", "a ▁ b", "▁", "word ", "Hello, World.", "Hello, World.", "x" * 3000,
             "lorem Ipsum, dolor's sit 42 amet. " * 3000, "日本語 " * 50, "<|endoftext|> <s>"] + texts_of(rng, 300)
    want = sorted(((i % 290, *r) for i, r in enumerate(brute(texts))), key=repr)
    df = spark.createDataFrame([(i % 290, t, 3, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, n_a long, groups string").repartition(3)
    got = alignment.align(df, A, B, full=True, pairs_at_once=at_once)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_empty_tables_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_a for r in alignment.align(df, A, B).collect()) == [0, 2]
    assert alignment.align(df.where("false"), A, B).count() == 0


def test_query_on_the_smallest_table(spark):
    from threadloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d.doc_id, *r[:-1]) for d, r in zip(docs, brute([d.text for d in docs])))
    assert sorted(map(tuple, QUERIES["op11_alignment"](spark, sf).collect())) == want


def test_tasks_hold_few_slices_and_few_links(spark, monkeypatch):
    """A written file holds FILE_SLICES slices at most, and links take no numbers of their own all at once."""
    import glob
    import tracemalloc

    import pyarrow as pa
    import pyarrow.parquet as pq

    from threadloom.llm.store import Scratch
    rng = random.Random(4)
    texts = [t * 3 for t in texts_of(rng, 200)] + ["x" * 3000, "", None]
    monkeypatch.setattr(alignment, "SLICE_BYTES", 800)
    monkeypatch.setattr(alignment, "PART_FRAGMENTS", 7, raising=False)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    with Scratch(spark, "test") as scratch:
        got = sorted(map(tuple, alignment.align(df, A, B, scratch=scratch).collect()))
        path = scratch.path("coded").removeprefix("file://")
        slices = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert got == sorted((i, *r[:-1]) for i, r in enumerate(brute(texts)))
    assert sum(slices) > 20 and max(slices) <= 4

    who = alignment.Aligner(A.text, B.content)
    words = pa.array([" ".join("".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(40_000)), "x" * 3000], pa.large_string())
    c = who.code(words)
    g = who.align(c)
    tracemalloc.start()
    whole = who.pairs(c, g)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    links = int((g.n_a * g.n_b).sum())
    assert links > 300_000 and most < 8 * 8 * links, (most, links)
    monkeypatch.setattr(alignment, "PART_LINKS", 50, raising=False)
    assert all(x.tolist() == y.tolist() for x, y in zip(whole, who.pairs(c, g)))


def test_tree_sum(spark, monkeypatch):
    from threadloom.llm.store import Scratch
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    rng = np.random.default_rng(1)
    parts = rng.integers(0, 300, (20, 2, 10))
    rows = [(c, t, bytearray(alignment._narrow(parts[t, c]))) for t in range(20) for c in range(2)]
    got = alignment.tree_sum(spark.createDataFrame(rows, "chunk long, task long, vector binary"), Scratch(spark, "test"), "x")
    assert {r.chunk: alignment._wide(bytes(r.vector)).tolist() for r in got.collect()} == {
        c: parts[:, c].sum(axis=0).tolist() for c in range(2)}


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(-2 ** 62, 2 ** 62, 5000))
    shards = perfect_hash.shard_hash(keys) % 7
    rows = []
    for s in range(7):
        order, sizes, bits = perfect_hash.build_shard(keys[shards == s])
        rows.append((s, order.tobytes(), sizes, bits))
    index = perfect_hash.PairIndex.of(0, 7, rows)
    assert sorted(index.find(keys).tolist()) == list(range(len(keys)))
    assert (index.find(np.setdiff1d(rng.integers(-2 ** 62, 2 ** 62, 5000), keys)) == -1).all()
    part = perfect_hash.PairIndex.of(2, 7, rows[2:5])
    inside = (shards >= 2) & (shards < 5)
    assert sorted(part.find(keys[inside]).tolist()) == list(range(inside.sum())) and (part.find(keys[~inside]) == -1).all()
    assert len(perfect_hash.PairIndex.of(0, 1, []).find(keys)) == len(keys)
