"""Byte BPE against its library, the filter audit and the ranked search against brute force."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest

from tabreg.llm import byte_bpe, catalog, filter_audit, ranked_search

SF = "/root/testdata/sf0.001"
RANKS = catalog.tokenizer("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LONG = " ".join(f"word{i % 977} X{i}" for i in range(6000))
ODD = ["", None, "a", "!!!", "The quick brown fox", "the quick  brown\n\nfox ", "Ünïcödé — ﬁne 中文 ٣", "don't I'LL we've 'sno",
       "<|endoftext|>", "\x1c\x1d\x00 odd", "a" * 30000, " " * 5000, LONG, "\U0001e030꟎\U00011de0 new letters", "!!!", "!!!"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = SCHEMA + ", id long, ids string, n long, mask string, part int, rank string, score string, length int, copies int, decoded int"


def odd_docs(spark, extra=False):
    rows = [(i, t, None if i % 3 else "en", "s" if i % 2 else None, None) for i, t in enumerate(ODD)]
    rows += [(3, "!!!", "en", "s", 3), (None, "no id", "en", "s", 1), (None, None, None, None, None), (None, "!!!", "x", "s", 1),
             (4, ODD[4], "en", None, 1), (-5, "", "en", "t", 0)]
    if extra:
        rows = [r + (1, "x", 2, "m", 3, "r", "s", 4, 5, 6) for r in rows]
    return spark.createDataFrame(rows, CLASH if extra else SCHEMA)


@pytest.fixture(scope="module")
def library():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


# ---------------------------------------------------------------- byte BPE

def test_encoding_equals_the_library_on_every_character(library):
    codec = byte_bpe.ByteBpe(RANKS, PATTERN, byte_bpe.other_classes(), memo=1000)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(7)
    texts = ["".join(every), "a" * 50000 + " " * 3000 + "ab" * 20000]
    texts += ["".join(rng.choices(every, k=150)) for _ in range(60)]
    texts += ["".join(rng.choices("ab c'sdT  \n\té中文12 ªº²", k=150)) for _ in range(60)]
    for text in texts:
        ids = np.frombuffer(codec.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_whole_matches_and_ties_follow_the_ranks(tmp_path):
    import tiktoken
    tokens = [bytes([b]) for b in range(256)] + [b"aa", b"xyz", b"bc", b"ab", b"aaa"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    lib = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    codec = byte_bpe.ByteBpe(str(path), r"\w+", {})
    for text in ("xyz", "xyzz", "aaaa", "aaaaa", "abc", "aabcc", "aaab"):    # xyz has no merge path
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == lib.encode_ordinary(text), text
    (tmp_path / "gap.tiktoken").write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(tmp_path / "gap.tiktoken"))


@pytest.mark.parametrize("extra", [False, True])
def test_bpe_on_odd_rows(spark, library, extra):
    docs = odd_docs(spark, extra)
    ids = byte_bpe.encode(docs, RANKS, PATTERN)
    out = byte_bpe.decode(ids, RANKS, PATTERN).collect()
    want = sorted(((r["doc_id"], tuple(library.encode_ordinary(r["text"] or "")), (r["text"] or "").encode())
                   for r in docs.collect()), key=repr)
    assert sorted(((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in out), key=repr) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in out)
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), RANKS, PATTERN), RANKS, PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert {r["k"]: r["decoded"] for r in byte_bpe.decode(nulls, RANKS, PATTERN).collect()} == {1: None, 2: b""}
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([([70000],)], "ids array<int>"), RANKS, PATTERN).collect()


def test_bpe_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = catalog.QUERIES["op11_byte_bpe"](spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# ---------------------------------------------------------------- filter audit

def brute_audit(rows, labels):
    """rows of (id, text, part); labels of (id, quality, toxic)"""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails = []
    for i, t, part in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {n for n, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search("[#$%&*|]", t), i is not None and i > least[t])) if bad}
        fails.append((part or "", f, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        mine, shapley = [x for x in fails if x[0] == part], collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                shapley[f] += len(gone)
                left = [x for x in left if f not in x[1]]
                out[part, order, step] = [len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                                          sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audited(docs, labels):
    out = filter_audit.audit(docs, labels).collect()
    assert len(out) == len({(r["part"], r["filter_order"], r["step"]) for r in out})
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in out}


@pytest.mark.parametrize("extra", [False, True])
def test_audit_on_odd_rows(spark, extra):
    docs = odd_docs(spark, extra).repartition(3)
    labels = [(0, 1, 0), (3, 1, 1), (3, 0, None), (7, None, 1), (None, 1, 1), (99, 1, 1), (15, 1, 0)]
    want = brute_audit([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], labels)
    assert audited(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")) == want
    assert filter_audit.audit(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_audit_of_copies_over_ranges_and_blocks(spark, monkeypatch):
    """Hot exact copies, long shared beginnings and blocks of a few texts."""
    monkeypatch.setattr(filter_audit, "BLOCK_BYTES", 5000)
    rng, rows = random.Random(3), []
    for i in range(1500):
        base = "The common licence text " * 30 + str(rng.randrange(40)) if i % 3 else "hot copy " * 40
        rows.append((i * 7919 % 1500, base if i % 5 else f"{rng.random()} {base}", f"s{i % 2}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9)
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 1500, 3)]
    lengths = filter_audit.with_prefix_lengths(docs.selectExpr("cast(text as binary) text"), 2000).select("length").distinct().collect()
    assert len(lengths) > 2                                    # prefixes do adapt
    assert audited(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")) == brute_audit(rows, labels)


def test_trie_holds_every_text():
    rng, texts = random.Random(5), {b"", b"a", b"ab", b"abc", b"abd", b"b" * 1000, b"b" * 999}
    texts |= {bytes(rng.choices(b"ab", k=rng.randrange(12))) for _ in range(500)}
    trie = filter_audit.RadixTrie()
    for t in sorted(texts, key=hash):
        trie.terminal(t).held = t
    assert [(t, n.held) for t, n in trie.terminals()] == [(t, t) for t in sorted(texts)]


# ---------------------------------------------------------------- ranked search

def brute_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(docs, items, k=20):
    """(id, text) of documents and items to (item, rank, id, score)"""
    vectors = [(i if i is not None else (1 << 63) - 1, brute_terms(t)) for i, t in docs]
    vectors = [(i, collections.Counter(t), len(t)) for i, t in vectors if t]
    n, total = len(vectors), sum(v[2] for v in vectors)
    df = collections.Counter(t for _, c, _ in vectors for t in c)
    out = []
    for item, text in items:
        terms, scored = brute_terms(text), []
        for i, c, length in vectors:
            m = 75 + 25 * length * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(docs, items, **options):
    return sorted(tuple(r) for r in ranked_search.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("extra", [False, True])
def test_search_on_odd_rows(spark, extra):
    docs = odd_docs(spark, extra)
    items = [(1, "the QUICK fox, the fox"), (2, None), (3, "!!"), (4, "Ünïcödé word5 x17 x17 中文"), (5, LONG), (None, "a no id"), (6, "zzzz")]
    table = spark.createDataFrame([(*i, 1, "s") for i in items], "item_id long, text string, place int, score string")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(map(tuple, ranked_search.search(docs, table).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    assert got == sorted(brute_search(plain, [i for i in items if i[0]]) + [(None, *r[1:]) for r in brute_search(plain, [(0, "a no id")])], key=repr)
    assert ranked_search.search(docs.limit(0), table).count() == 0
    assert ranked_search.search(docs, table.limit(0)).count() == 0


def test_search_with_ties_blocks_and_copies(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(400)]
    rows += [(1000 - i, "w1 w2 w3") for i in range(300)] + [(7, "w1 w2 w3"), (7, "w1 w2 w3")]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(30)] + [(90, "w1 w2"), (91, "w3")]
    monkeypatch.setattr(ranked_search, "CELLS", 600)          # several item blocks, small document blocks
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs, spark.createDataFrame(items, "item_id long, text string")) == brute_search(rows, items)
    assert found(docs, spark.createDataFrame(items, "item_id long, text string"), k=3) == brute_search(rows, items, 3)


def test_tree_prunes_and_large_integers_stay_exact():
    rng = np.random.default_rng(2)
    topics = rng.integers(0, 10, 3000)
    docs = np.zeros((3000, 100), np.int64)
    docs[np.arange(3000)[:, None], topics[:, None] * 10 + rng.integers(0, 10, (3000, 5))] = rng.integers(1, 10 ** 6, (3000, 5))
    items = np.zeros((50, 100), np.int64)
    for row in range(50):
        items[row, row % 10 * 10:row % 10 * 10 + 10] = rng.integers(1, 10 ** 4, 10)
    for scale, kind in ((1, np.float64), (10 ** 6, np.int64)):      # the second passes 2^53
        search = ranked_search.Search((items * scale).astype(kind), 20)
        for lo in range(0, 3000, 500):
            search.block(docs[lo:lo + 500].astype(kind), np.arange(lo, lo + 500))
        assert search.scored < 50 * 3000 / 2
        scores = (items * scale) @ docs.T
        want = sorted((i, d, int(scores[i, d])) for i in range(50) for d in np.lexsort((np.arange(3000), -scores[i]))[:20])
        assert sorted(search.results()) == want
