"""The pipeline's stages on awkward documents, and as a whole."""

import hashlib

import corpus_pipeline
from tidewell.llm import near_copies, simhash
from tidewell.llm.common import Scratch


def prose(k):
    """Four lines of words that no other number has."""
    words = [hashlib.md5(f"{k}-{j}".encode()).hexdigest()[:7].translate(str.maketrans("0123456789", "ghijklmnop")) for j in range(48)]
    return "\n".join(" ".join(words[j : j + 12]).capitalize() + "." for j in range(0, 48, 12))


def made(spark):
    rows = [(k, prose(k), "en", f"s{k % 3}", len(prose(k)), "x") for k in range(12)]
    rows += [(20, prose(3), "en", "s1", 5, "copy"), (3, prose(3), "en", "s1", 5, "again"), (21, None, None, None, None, None), (22, "", None, "s0", 0, "")]
    rows += [(None, prose(50), "en", None, 3, "no id"), (23, "Home | News | Log in | Help\n" * 9, "en", "s0", 3, "nav")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


def test_stages(spark):
    scratch, docs = Scratch(spark, "t"), made(spark)
    kept = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.keep(stage(spark, docs, ""), f"s{number}")
        kept.append(docs.collect())
        if number < 4:
            assert docs.columns == made(spark).columns, name
    clean, near, cut, mix, last = kept
    assert {r.doc_id for r in clean} == {*range(12), 20, None}
    assert sorted((r.doc_id for r in near), key=str) == sorted([*range(12), None], key=str)
    assert len(cut) == len(near) and all(r.n_chars == len(r.text) and r.text for r in cut)
    assert {r.doc_id for r in mix} <= {r.doc_id for r in cut}
    assert all(r.round_trip for r in last)


def test_stages_on_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, made(spark).where("false"), "").count() == 0


def test_near_copies_of_five_words(spark, monkeypatch):
    """Links are those of brute force: Jaccard 0.8 of runs of five words, also in large buckets."""
    texts = []
    for k in range(12):
        words = prose(k).split()
        long = words + prose(100 + k).split() + prose(200 + k).split()
        texts += [long, long[:60] + ["new"] + long[61:], long[:30] + ["other"] + long[31:100] + ["more"] + long[101:]]
        texts += [long[:90] + prose(300 + k).split()[:30], long[10:] + ["end"] * (k % 3)]
    texts += [["short", "text"], ["Short", "text"], []]
    sets = [{tuple(w.lower() for w in t[i : i + 5]) for i in range(max(1, len(t) - 4))} if t else set() for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    want = {min(i for i, g in enumerate(group) if g == x) for x in group}
    assert 12 < len(want) < 40
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for size in (256, 2):
        monkeypatch.setattr(near_copies, "BLOCK", size)
        assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == want


def test_close_fingerprints_are_near_copies(spark):
    """Fingerprints within three bits link, whatever the sets say: a passage that fills two texts with unlike ends."""
    body = prose(7).split()[:13] * 60
    texts = [body + prose(60 + k).split()[:12] for k in range(3)] + [prose(70).split(), prose(71).split()]
    sets = [{tuple(w.lower() for w in t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    prints = [simhash.print_of(" ".join(t).encode(), near_copies.WORDS) for t in texts]
    for a in range(3):
        for b in range(a):
            assert 10 * len(sets[a] & sets[b]) < 5 * len(sets[a] | sets[b])
            assert ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= simhash.RADIUS
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == {0, 3, 4}


def test_texts_of_equal_sets_link_by_each_fingerprint(spark):
    """Texts of one set of shingles may have far fingerprints; what either is close to is linked."""
    a, b = prose(80).split()[:13], prose(81).split()[:13]
    both = [a * 60 + b * 2 + a * 2, a * 2 + b * 60 + a * 2]
    texts = [a * 60 + prose(82).split()[:12], *both, b * 60 + prose(83).split()[:12], prose(84).split()]
    prints = [simhash.print_of(" ".join(t).encode(), near_copies.WORDS) for t in texts]
    far = [[((x ^ y) % (1 << 64)).bit_count() > simhash.RADIUS for y in prints] for x in prints]
    sets = [frozenset(tuple(t[i : i + 5]) for i in range(len(t) - 4)) for t in [[w.lower() for w in t] for t in texts]]
    assert sets[1] == sets[2] and far[1][2] and not far[0][1] and not far[2][3] and far[0][3]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == {0, 4}
