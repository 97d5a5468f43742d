"""Block search, Merkle manifests and the filter audit against plain versions, on awkward rows."""

import hashlib
import itertools
import math
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from tidewell.llm import block_search, expected, filter_audit, merkle, queries
from tidewell.llm.common import Scratch

NEW = ["op11_block_search", "op12_merkle_manifest", "op13_filter_audit"]


@pytest.mark.parametrize("name", NEW)
def test_query_agrees_with_sql(spark, small, name):
    assert differences(queries.QUERIES[name](spark, small), connect(small), expected.EXPECTED[name]) is None


def nearest(data, k):
    """Plain version: {(query, rank, key, score)} with counts."""
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(np.array(v, float)).all() and any(v) for _, v in data]
    out = Counter()
    for q, (key, x) in enumerate(data):
        if not ok[q] or key is None or key % 20:
            continue
        found = []
        for c, (other, y) in enumerate(data):
            if c != q and ok[c] and len(x) == len(y):
                score = 0.0
                for a, b in zip(x, y):
                    score += a * b
                found.append((-(-math.inf if math.isnan(score) else score), other is None, other or 0, other, score))
        for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out[key, rank, f[3], "nan" if math.isnan(f[4]) else f[4]] += 1
    return out


@pytest.mark.parametrize("cells, group_rows, groups", [(1 << 20, 8192, 64), (40, 7, 5)])
def test_block_search(spark, monkeypatch, cells, group_rows, groups):
    for name, value in (("QUERY_CELLS", cells), ("GROUP_ROWS", group_rows), ("GROUPS", groups)):
        monkeypatch.setattr(block_search, name, value)
    rng = np.random.default_rng(8)
    center = rng.normal(size=8)
    vectors = [rng.normal(size=8).tolist() for _ in range(60)]
    vectors += [(center + rng.normal(size=8) * 1e-4).tolist() for _ in range(40)]  # closer than the codes can tell
    vectors += [center.tolist()] * 60  # more copies than any list holds
    vectors += [None, [], [0.0] * 8, [1.0, None] * 4, [math.nan] * 8, [math.inf] * 8]
    vectors += [[1.0, 2.0], [2.0, 1.0], [5e-324, 0.0], [1e300, 1e300], [1e300, -1e300], [3.0]]
    data = [(i if i % 13 else None, v) for i, v in enumerate(vectors)]
    data += [(20, vectors[20]), (40, center.tolist()), (40, center.tolist()), (7, vectors[3]), (180, [4.0]), (200, [1e300, 1e299]), (220, [0.0] * 8)]
    rows = [(i, v, 1, 0.5) for i, v in data]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double").repartition(3)
    wanted = F.col("vec_id") % 20 == 0
    for k in (5, 50):
        got = Counter(
            (r.query_id, r.rank, r.vec_id, "nan" if math.isnan(r.score) else r.score) for r in block_search.search(Scratch(spark, "t"), df, wanted, k=k).collect()
        )
        assert got == nearest(data, k)
    assert block_search.search(Scratch(spark, "t"), df.where("false"), wanted).count() == 0


def test_bounds_hold_for_long_vectors():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-127, 128, (3, 2500)).astype(np.float32), rng.integers(-127, 128, (4, 2500)).astype(np.float32)
    assert (block_search.products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h("".join(row[i : i + 2])) for i in range(0, len(row), 2)])
    return levels


def plain_path(levels, at):
    out = []
    for row in levels[:-1]:
        other = at ^ 1
        out.append((other < at, row[other] if other < len(row) else None))
        at //= 2
    return out


SIZES = {None: 1, "": 2, "a": 37, "b": 3, "é": 64, "z": 33}


@pytest.fixture(scope="module")
def leaves(spark):
    rows = [(g, None if i == 0 else i // 2, f"{g}-{i // 3}", i, "clash") for g, n in SIZES.items() for i in range(n)]
    df = spark.createDataFrame(rows, "lang string, doc_id long, text string, n long, path string").repartition(5)
    return df.select(merkle.tree_name(F.col("lang")).alias("tree"), merkle.leaf(F.col("lang"), F.col("text")).alias("hash"), "lang", "doc_id", "text", "n", "path")


@pytest.mark.parametrize("levels", [2, 8])
def test_manifest(spark, leaves, levels):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    manifest = merkle.Manifest(Scratch(spark, "t"), leaves, ["doc_id"], levels)
    got = manifest.proofs().collect()
    trees = {}
    for r in leaves.collect():
        assert r.hash == h(field(r.lang) + field(r.text))
        trees.setdefault(r.lang, []).append((-1 if r.doc_id is None else r.doc_id, r.hash))
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: plain_tree([x for _, x in sorted(trees[g])]) for g in order}
    top = plain_tree([built[g][-1][0] for g in order])
    assert manifest.root == top[-1][0]
    want = Counter()
    for k, g in enumerate(order):
        for i, x in enumerate(built[g][0]):
            want[g, x, built[g][-1][0], str(plain_path(built[g], i) + plain_path(top, k))] += 1
    assert Counter((r.lang, r.hash, r.subroot, str([(s.left, s.hash) for s in r.path])) for r in got) == want


def test_proofs_of_some_rows(spark, leaves):
    manifest = merkle.Manifest(Scratch(spark, "t"), leaves, ["doc_id"], 2)
    wanted = spark.createDataFrame([("=a", 36), ("=a", 5), ("-", 0), ("=é", 63), ("=none", 3), ("=a", 500)], "tree string, pos long")
    every = {(r.tree, r.pos): r.asDict(True) for r in manifest.proofs().collect()}
    some = manifest.proofs(wanted)
    assert Counter((r.tree, r.pos) for r in some.collect()) == Counter([("=a", 36), ("=a", 5), ("-", 0), ("=é", 63)])
    assert all(r.asDict(True) == every[r.tree, r.pos] for r in some.collect())
    checked = some.select((merkle.folded(F.col("hash"), F.col("path")) == manifest.root).alias("ok"), merkle.folded(F.lit("x"), F.col("path")).alias("x"))
    assert all(r.ok and r.x != manifest.root for r in checked.collect())


def test_manifest_of_nothing(spark, leaves):
    none = merkle.Manifest(Scratch(spark, "t"), leaves.where("false"), ["doc_id"])
    assert none.root is None and none.proofs().count() == 0
    one = merkle.Manifest(Scratch(spark, "t"), leaves.where("lang IS NULL"), ["doc_id"])
    (row,) = one.proofs().collect()
    assert row.hash == row.subroot == one.root and row.path == []


def plain_audit(docs, labels):
    import re

    fails = []
    for key, text, _ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        own = text or ""
        fails.append(
            {n for n, bad in zip("ABCD", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", own)) > 3 * len(own), re.search("[#$%&*|]", own))) if bad}
            | ({"E"} if key is not None and any(k is not None and k < key and (t or "") == own for k, t, _ in docs) else set())
        )
    good, toxic = ({k for k, *flags in labels if k is not None and flags[at] == 1} for at in (0, 1))
    rows = {}
    for part in {p or "" for _, _, p in docs}:
        own = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f,
                ]
        for (p, _, _), row in rows.items():
            if p == part:
                row[-1] = shapley[row[-1]]
    return rows


@pytest.mark.parametrize("salts", [1, 256])
def test_audit(spark, monkeypatch, salts):
    monkeypatch.setattr(filter_audit.later_copies, "__defaults__", (salts,))
    long = " ".join(f"w{i}é" for i in range(210))
    texts = [long, long + " $", "A" + long, "WORDS " * 250, "a b " * 150, None, "", "short", long.upper(), long + " |&", "x " * 40_000, " \n\t "]
    docs = [(i if i % 7 else None, texts[(i * i + i // 5) % len(texts)], (None, "", "en", "de")[i % 4]) for i in range(120)]
    docs += [(3, texts[0], "en"), (3, texts[0], "en"), (200, long + " only", "one")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(100)] + [(4, 1, 0), (4, None, None), (None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, lang string, part string, kept int").repartition(4)
    marks = spark.createDataFrame([(k, a, None if b is None else int(b)) for k, a, b in labels], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(Scratch(spark, "t"), df, marks).collect()
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == plain_audit(docs, labels)
    assert len(got) == 4 * 600
    assert filter_audit.audit(Scratch(spark, "t"), df.where("false"), marks).count() == 0
