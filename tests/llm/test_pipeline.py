"""The pipeline's stages against brute force on small tables."""

import collections
import hashlib
import itertools
import os
import re

import numpy as np

import corpus_pipeline as P
from tabreg.llm import catalog, mixing, secret_scan, toxicity
from tabreg.llm.base import cut_lineage

SF = "/root/testdata/sf0.001"


def brute_one_of_each(rows):
    """Rows (id, text): the first of every group under links of equal texts or Jaccard 0.8 of word 5-grams."""
    rows = list(dict.fromkeys(rows))

    def grams(text):
        words = re.findall(r"\w+", (text or "").lower())
        n = min(5, len(words))
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()

    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if (rows[i][1] or "") == (rows[j][1] or "") or (a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9):
            root[find(j)] = find(i)
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    return [min(g, key=order) for g in groups.values()]


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    return ([m for m in ASSIGN.finditer(text) if len(m[1]) >= 6] + [m for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
            + [m for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def weak_part(text):
    return any(re.search(pattern, text) for pattern, _ in secret_scan.WEAK.values())


def brute_score(model, text):
    """The vote of the nearest examples by cosines computed one by one, through the calibration."""
    q, cosines = model.vector(text), np.zeros(len(model.index.hashes))
    for t, (at, w) in model.index.postings.items():
        if t in q:
            for place, weight in zip(at, w):
                cosines[place] += q[t] * weight
    near = sorted(((-c, i) for i, c in enumerate(cosines) if c > 0))[:model.settings.neighbours]
    total = -sum(c for c, _ in near)
    return model.score(-sum(c * model.index.labels[i] for c, i in near) / (total + model.settings.prior))


def brute_draw(docs):
    """Rows whose hash falls below the probability of their cell, cells raked by plain loops."""
    rows = docs.withColumn("topic", mixing.document_margins(docs)["topic"]).collect()
    cell = lambda r: (r["source"], r["lang"], r["topic"])
    size = lambda r: len(re.findall(r"[^ \t\n\r]+", r["text"] or ""))
    tokens = collections.Counter()
    for r in rows:
        tokens[cell(r)] += size(r)
    budget = mixing.SHARE * sum(tokens.values())
    cells = [c for c, n in tokens.items() if n]
    weight = {c: tokens[c] * mixing.SHARE for c in cells}
    targets = []
    for at, (name, power) in enumerate(mixing.POWERS.items()):
        by = collections.Counter()
        for c in cells:
            by[c[at]] += tokens[c]
        norm, full, factor = sum(n ** power for n in by.values()), set(), budget
        while True:
            over = {k for k, n in by.items() if n ** power / norm * factor >= n - 1e-9}
            if over == full or len(over) == len(by):
                break
            full = over
            factor = (budget - sum(by[k] for k in full)) / sum(by[k] ** power / norm for k in by if k not in full)
        targets.append({k: min(n, n ** power / norm * factor) for k, n in by.items()})
    for _ in range(200):
        for at, target in enumerate(targets):
            for level, goal in target.items():
                mine = [c for c in cells if c[at] == level]
                lo, hi = 0.0, 1e12                        # the factor whose capped sum meets the goal
                for _ in range(100):
                    mid = (lo * hi) ** 0.5 if lo > 0 else hi / 1e6
                    lo, hi = (mid, hi) if sum(min(tokens[c], weight[c] * mid) for c in mine) < goal - 1e-9 else (lo, mid)
                for c in mine:
                    weight[c] = min(tokens[c], weight[c] * hi)
    kept = []
    for r in rows:
        key = str(r["doc_id"]) if r["doc_id"] is not None else "null:" + hashlib.md5((r["text"] or "").encode()).hexdigest()
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16 ** 13
        p = weight[cell(r)] / tokens[cell(r)] if tokens[cell(r)] else 1.0
        if u < p:
            kept.append(tuple(r)[:-1])
    return kept


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, "password=abcdefgh now", "en", "s", 21)],
                                  docs.schema)
    docs = cut_lineage(docs.unionByName(extra).unionByName(extra))
    seen = {}
    for name, stage in P.STAGES:
        out = cut_lineage(stage(spark, docs, SF))
        if name != "packing":
            assert out.columns == docs.columns
            seen[name] = docs, out
            docs = out
    before, after = ([tuple(r) for r in x.select("doc_id", "text").collect()] for x in seen["near_duplicates"])
    assert sorted(map(repr, after)) == sorted(map(repr, brute_one_of_each(before)))
    before, after = seen["secrets"]
    assert before.count() == after.count()
    was = {(r["doc_id"], i): r["text"] for i, r in enumerate(before.orderBy("doc_id", "text").collect())}
    now = {(r["doc_id"], i): r["text"] for i, r in enumerate(after.orderBy("doc_id", "text").collect())}
    plain = [k for k, t in was.items() if not brute_secrets(t or "") and not weak_part(t or "")]
    assert len(plain) > 50 and all(was[k] == now.get(k, was[k]) or k[0] is None for k in plain)
    texts_now = {r["doc_id"]: r["text"] for r in after.collect()}
    assert not any(brute_secrets(t or "") for t in texts_now.values())
    assert [(r["text"], r["n_chars"]) for r in after.filter("doc_id = 9002").collect()] == [("[SECRET] now", 12)]
    before, after = seen["mixing"]
    assert sorted(map(repr, (tuple(r) for r in after.collect()))) == sorted(map(repr, brute_draw(before)))
    before, after = seen["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = [r["text"] for r in before.collect()]
    clean = [t for t in texts if brute_score(model, t or "") < P.TOXIC_FROM]
    assert sorted(map(repr, clean)) == sorted(repr(r["text"]) for r in after.collect())
    ids = collections.defaultdict(dict)
    for r in out.collect():
        ids[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(catalog.tokenizer("word_bpe_49k.json"))
    for r in docs.collect():
        if r["doc_id"] is not None:
            assert sum((v for _, v in sorted(ids[r["doc_id"]].items())), []) == t.encode(r["text"] or "", add_special_tokens=False).ids + [1]


def test_entry_works_without_the_subpackage():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as E; "
            "q = E.queries(); assert 'pipeline' not in q and not any(n.startswith('op2_') for n in q) and len(q) > 60")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert os.system(f"cd {root} && python -c \"{code}\"") == 0
