"""Each operator against a plain version, on small tables with awkward rows."""

import hashlib
import itertools
import math
import os
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import connect, differences
from pyspark.sql import functions as F

from tidewell.llm import common, expected, langid, mixing, nn_descent, notices, pieces, pitman_yor, quality, queries, simhash, suffixes, warc
from tidewell.llm.common import Scratch

SHARED = " ".join(f"shared{i} passage" for i in range(40))
NOTICE = "Released under the MIT License."
TEXTS = [
    (1, f"A first text. {SHARED} And so on."),
    (2, f"Another one, longer. {SHARED} It ends elsewhere."),
    (3, f"Another one, longer. {SHARED} It ends elsewhere."),  # a copy
    (3, f"Another one, longer. {SHARED} It ends elsewhere."),  # the same row again
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "One line.\nOne line.\nHome | News | Shop | Log in\nAccept all cookies to go on.\n" + "Prose follows here, with words enough. " * 3),
    (8, f"Released undr the MIT Lcense. {NOTICE} CC BY-NC, cc by nc."),
    (9, "née élan 日本語 " * 30),
    (10, "word " * 30_000),
    (None, "a text without an id " * 10),
    (11, "12 34 !!"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if n % 2 else None, None if n % 5 == 0 else f"s{n % 3}", 7, "clash") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, kept string").repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def bytes_of(text):
    return (text or "").encode()


@pytest.mark.parametrize("name", sorted(expected.EXPECTED))
def test_query_agrees_with_sql(spark, small, name):
    assert differences(queries.QUERIES[name](spark, small), connect(small), expected.EXPECTED[name]) is None


def test_notices(docs, none):
    rows = {r.doc_id: r for r in notices.scan(docs).collect()}
    for doc_id, text in TEXTS:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (k, label) for phrase, label in notices.PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
        ]
        row = rows[doc_id]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert row.first_word == min((k for k, _ in places), default=None)
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
    spans = [(s.label, s.first_word, s.edits) for s in rows[8].spans if s.label == "mit"]
    assert ("mit", 0, 2) in spans and rows[8].labels == "cc-by-nc,mit" and rows[8].score == 1.0
    assert rows[1].labels == "" and notices.scan(none).count() == 0


def test_seeds_lose_no_notice():
    scanner, rng = notices.Scanner(), np.random.default_rng(5)
    for notice, label in notices.NOTICES:
        edits = notices.edits_allowed(notice)
        for _ in range(10):
            chars = list(notice)
            for at in rng.choice(np.arange(1, len(chars) - 1), edits, replace=False):
                chars[at] = "q"
            assert label in scanner.scan(f"some words {''.join(chars)} more words".encode())[5].split(",")


def test_all_kinds_of_edits_are_found():
    """Letters changed, left out and put in, against the regex over the whole text."""
    scanner, rng = notices.Scanner(), np.random.default_rng(7)
    for notice, label in notices.NOTICES:
        edits = notices.edits_allowed(notice)
        for kind in ("insert", "delete", "mixed"):
            for _ in range(4):
                chars = list(notice)
                for k in range(edits):
                    at = int(rng.integers(1, len(chars) - 1))
                    act = kind if kind != "mixed" else ("insert", "delete", "change")[k % 3]
                    chars[at : at + (act != "insert")] = [] if act == "delete" else ["é" if k % 2 else "q"]
                # As the scan compares texts: one space between words, an edit that empties a word may need one more.
                text = f" {' '.join(f'some words {''.join(chars)} more words and {notice} end'.split())} "
                (plan,) = [p for p in scanner.plans if p[0] == notice and p[1] == label and not p[2]]
                want = [(label, text.count(" ", 0, m.start()) - 1, sum(m.fuzzy_counts)) for m in plan[4].finditer(text)]
                words = text.encode()
                found = [(s["label"], s["first_word"], s["edits"]) for s in scanner.scan(words)[7]]
                assert want and set(want) <= set(found), (notice, text)


def test_many_notices_in_one_text_take_linear_time():
    import time

    scanner, seconds = notices.Scanner(), []
    for n in (20_000, 80_000):
        start = time.process_time()
        row = scanner.scan(b"cc by nc " * n)
        seconds.append(time.process_time() - start)
        assert (row[0], row[1], row[2], row[3]) == (3 * n, n, 0, 3 * n - 3)
    assert seconds[1] < 8 * seconds[0] + 1, seconds


def test_warc_round_trip(spark, tmp_path):
    big = "x" * 1500 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a\r\nb", big), (2, None, big), (5, "u", big), (5, "u", big), (3, "u", "small"), (4, "u", "small"), (6, "u", None), (None, "u", "é" * 600), (7, "u", "é" * 600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(warc.resolve(warc.from_pages(pages)), str(tmp_path / "a"), per_file=2)
    read = warc.join_originals(warc.read(spark, str(tmp_path / "a"))).collect()
    got = Counter((r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in read)
    want = Counter()
    for page_id, _, html in rows:
        body = bytes_of(html)
        top = max([p for p, _, h in rows if h == html and p is not None], default=None)
        back = len(body) >= 1000 and top is not None and page_id != top
        want[page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if back else "response", top if back else None] += 1
    assert got == want
    assert all(r.actual_digest == r.digest and hashlib.sha1(r.payload).hexdigest() == r.digest for r in read if r.record_type == "response")
    warc.write(warc.resolve(warc.from_pages(pages.where("false"))), str(tmp_path / "b"))
    assert warc.read(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_archives_are_read_in_parts(step):
    import gzip

    made, want = b"", []
    for i, body in enumerate([b"", b"x" * 50, b"a\r\n\r\nWARC/1.1\r\n\r\n", b"\r\n\r\n"]):
        digest = hashlib.sha1(body).hexdigest()
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(body)}\r\n\r\n"
        made += gzip.compress(head.encode() + body + b"\r\n\r\n")  # a member each
        want.append((i, body, digest))
    got = [(r[0], r[7], r[6]) for r in warc.parse(warc.inflated(made, step))]
    assert got == want
    whole = gzip.decompress(made)
    for broken in (whole[:-3], whole[:-60], whole.replace(b"Length: 50", b"Length: 49"), b"no" + whole):
        with pytest.raises(ValueError):
            list(warc.parse(iter([broken])))
    with pytest.raises(ValueError, match="cut"):
        list(warc.parse(warc.inflated(made[:-12], step)))


def test_a_wrong_payload_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 1500), (2, "u", "x" * 1500), (3, "u", "y")], "page_id long, url string, html string")
    resolved = warc.resolve(warc.from_pages(pages))
    forged = resolved.withColumn("payload", F.when(F.col("page_id") == 2, F.lit("z" * 1500)).otherwise(F.col("payload")))
    warc.write(forged, str(tmp_path / "a"))
    read = {r.page_id: r for r in warc.join_originals(warc.read(spark, str(tmp_path / "a"))).collect()}
    assert [read[i].actual_digest == read[i].digest for i in (1, 2, 3)] == [False, False, True]
    assert read[1].actual_digest == hashlib.sha1(b"z" * 1500).hexdigest()


def test_pitman_yor(spark, docs, none):
    score = lambda d: pitman_yor.score(Scratch(spark, "t"), d, pitman_yor.held_out(F.col("doc_id")), burn=1, samples=2)
    rows = score(docs).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, bytes_of(t).lower().split() + [b""]) for i, t in TEXTS]
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter(
        (i, held(i), len(ws), sum(w in counts for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens
    )
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(r.score < 0 and r.spelled_score <= r.score + 1e-9 for r in rows)
    assert score(none).count() == 0
    # Nothing to learn from: the one document is held out.
    alone = score(spark.createDataFrame([(next(i for i in range(99) if held(i)), "a b")], "doc_id long, text string")).first()
    assert (alone.n_tokens, alone.n_known, alone.base_score, alone.score) == (3, 0, 0.0, 0.0)


def test_pitman_yor_is_a_distribution():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 100, rng.integers(0, 4)).astype(np.uint8)) for _ in range(50)]
    cells, starts = pitman_yor.spelled(words)
    model = pitman_yor.Spelling()
    for number in range(3):
        model = model.seated(*np.unique(cells, return_counts=True), number)
    for context in np.unique(cells // pitman_yor.ALPHABET).tolist() + [5]:
        assert abs(np.exp(model.log(context * pitman_yor.ALPHABET + np.arange(pitman_yor.ALPHABET))).sum() - 1) < 1e-9
    assert (np.diff(starts) == [len(w) + 1 for w in words]).all()
    keys, base = np.arange(3, dtype=np.uint64), np.array([0.3, 0.3, 0.3])
    tables = pitman_yor.seat(np.array([1, 2, 1000]), 1.0, 0.5, 0.0, base, keys, 1)
    assert tables[0] == 1 and 1 <= tables[1] <= 2 and 1 <= tables[2] < 1000
    # A dish has the same seats whichever others come with it.
    assert tables[2] == pitman_yor.seat(np.array([1000]), 1.0, 0.5, 0.0, base[2:], keys[2:], 1)[0]


def test_pitman_yor_draws():
    keys = np.arange(20_000, dtype=np.uint64)
    for n, share in ((4, 0.3), (40, 0.9), (1000, 0.4), (1000, 0.001)):
        got = pitman_yor.drawn(np.full(len(keys), n), np.full(len(keys), share), keys, 3, 5)
        assert got.min() >= 0 and got.max() <= n and (got == np.rint(got)).all()
        assert abs(got.mean() - n * share) < 5 * math.sqrt(n * share * (1 - share) / len(keys))
        assert abs(got.var() / (n * share * (1 - share)) - 1) < 0.1


def test_pitman_yor_knows_which_word_follows(spark, monkeypatch):
    """Of a text the order counts; after every context all next words sum to 1, however the rows are batched."""
    learned = [(i, t) for i, t in enumerate(["the cat sat on the mat", "the dog sat on the log", "a cat saw the dog"] * 12) if zlib.crc32(str(i).encode()) % 7 != 2]
    fresh = iter(i for i in range(100, 9999) if zlib.crc32(str(i).encode()) % 7 == 2)
    words = sorted({w for _, t in learned for w in t.split()})
    asked = ["the cat sat on the mat", "mat the on sat cat the"]
    words.append("zzz")  # all unknown words are one event
    texts = dict.fromkeys(asked + [""] + words + [f"{a} {b}" for a in words for b in words])
    tests = {t: next(fresh) for t in texts}
    docs = spark.createDataFrame(learned + [(i, t) for t, i in tests.items()], "doc_id long, text string")
    run = lambda d: {r.doc_id: r.score for r in pitman_yor.score(Scratch(spark, "t"), d, pitman_yor.held_out(F.col("doc_id"))).collect()}
    got = run(docs.repartition(3, "doc_id"))
    assert got[tests[asked[0]]] > got[tests[asked[1]]] + 1
    # With h(a) = 1 / P(end | a), P(b | a) is p("a b") / p("a") * h(b) / h(a). If each context's words and end sum to 1,
    # h solves a linear system, and the first words and the empty text sum to 1 by it.
    p = lambda t: 10 ** got[tests[t]]
    step = np.array([[p(f"{a} {b}") / p(a) for b in words] for a in words])
    h = np.linalg.solve(np.eye(len(words)) - step, np.ones(len(words)))
    assert (h > 1).all() and abs(sum(p(w) * x for w, x in zip(words, h)) + p("") - 1) < 1e-6
    monkeypatch.setattr(pitman_yor, "PART", 20)  # many parts
    again = run(docs.repartition(1))
    assert all(abs(again[i] - s) < 1e-9 for i, s in got.items())


def test_pitman_yor_codes_texts(spark):
    """The vectors of a batch agree with plain Python, also where texts end in spaces, are empty or fill a slice."""
    texts = ["A b\x0ba  c ", "", None, "  ", "b\n\na Ab", "é\u00a0é É", "x" * 40 + " a " * 500_000, "a"]
    docs = spark.createDataFrame([(i, i % 3 == 1, t) for i, t in enumerate(texts)], "id long, held boolean, text string").coalesce(1)
    (row,) = pitman_yor.coded(docs).collect()
    words = bytes(row.words).split(b" ")
    want = [bytes_of(t).lower().split() + [b""] for t in texts]
    tokens = pitman_yor.tokens_of(bytes(row.tokens), np.array(row.lengths))
    assert [words[i] for i in tokens] == [w for ws in want for w in ws] and row.lengths == [len(ws) for ws in want]
    assert (np.diff(pitman_yor.keys_of(words).astype(object)) > 0).all() and words[row.end] == b""
    learned = Counter(w for i, ws in enumerate(want) if i % 3 != 1 for w in ws)
    assert np.frombuffer(row.counts, np.int64).tolist() == [learned[w] for w in words]


def test_pitman_yor_sends_each_pair_that_may_recur():
    rng = np.random.default_rng(7)
    lengths, held = rng.integers(1, 9, 300), rng.random(300) < 0.2
    tokens = rng.integers(1, 200, lengths.sum()).astype(np.uint32)
    tokens[np.cumsum(lengths) - 1] = 0
    n = rng.integers(0, 3, 200) + np.bincount(tokens[np.repeat(~held, lengths)], minlength=200)
    pairs = pitman_yor.Pairs(np.arange(200, dtype=np.uint32), n, 0, held, lengths, tokens, 7, 10)
    plain = list(zip([0, *tokens[:-1].tolist()], tokens.tolist()))
    learned = Counter(p for p, out in zip(plain, np.repeat(held, lengths)) if not out)
    found = list(zip(pairs.left.tolist(), pairs.right.tolist()))
    assert [found[i] for i in pairs.tokens] == plain and len(set(found)) == len(found)
    assert pairs.counts.tolist() == [learned[p] for p in found]
    left_out = {p for p in found if min(n[p[0]], n[p[1]]) == 0 or min(n[p[0]], n[p[1]]) == learned[p] == 1}
    assert left_out and set(found[pairs.bounds[-1] :]) == left_out
    # A context of few customers is whole in one part, others are spread.
    parts = {u: {k for k, (a, z) in enumerate(zip(pairs.bounds, pairs.bounds[1:])) if u in pairs.left[a:z]} for u in range(200)}
    assert all(len(k) <= 1 for u, k in parts.items() if n[u] < 10) and len(parts[0]) > 1


def test_pitman_yor_keeps_arrays(spark):
    """Tables between stages have a row per batch and part, not one per word or pair."""
    scratch = Scratch(spark, "t")
    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 97}" for j in range(60))) for i in range(40)], "doc_id long, text string").coalesce(2)
    assert pitman_yor.score(scratch, docs, pitman_yor.held_out(F.col("doc_id")), burn=1, samples=1).count() == 40
    kept = [os.path.join(scratch.path, name) for name in os.listdir(scratch.path)]
    assert kept and all(spark.read.parquet(path).count() <= 4 for path in kept if os.listdir(path))


def cut(texts, depth=100):
    """Plain version: {(id, text): (bytes removed, spans, what is left)}, ids and texts in order."""
    seen, out = set(), {}
    for doc_id, text in texts:
        b = bytes_of(text)
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - depth + 1):
            window = b[s : s + depth]
            gone[s : s + depth] |= window in seen
            seen.add(window)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[doc_id, text] = (int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]))
    return out


@pytest.mark.parametrize("crowd, batch, piece", [(2000, 8 << 20, 1 << 19), (2, 1 << 12, 300)])
def test_repeats(spark, docs, none, monkeypatch, crowd, batch, piece):
    for name, value in (("CROWD", crowd), ("BATCH", batch), ("PIECE", piece)):
        monkeypatch.setattr(suffixes, name, value)
    want = cut(sorted({(i, t) for i, t in TEXTS}, key=lambda x: (x[0] is not None, x[0] or 0)))
    rows = suffixes.cut_repeats(Scratch(spark, "t"), docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        removed, spans, left = want[r.doc_id, r.text]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(bytes_of(r.text)), removed, spans, hashlib.sha256(left).hexdigest()), r.doc_id
    assert suffixes.cut_repeats(Scratch(spark, "t"), none).count() == 0


def test_repeats_of_equal_rows(spark, monkeypatch):
    """Rows equal in key and text do not repeat each other, in one batch or in several."""
    one, other, third = ("".join(f"{c}{i} " for i in range(80)) for c in "xyz")
    texts = [(1, one), (1, one), (1, one), (1, other), (2, f"new {other} end"), (3, third), (None, third + "null"), (None, third + "null"), (4, one)]
    want = cut(sorted(set(texts), key=lambda x: (x[0] is not None, x[0] or 0)))
    assert want[1, one][0] == want[1, other][0] == 0 < want[4, one][0]
    for crowd, parts in ((2000, 1), (1, 1), (1, 5)):
        monkeypatch.setattr(suffixes, "CROWD", crowd)
        rows = suffixes.cut_repeats(Scratch(spark, "t"), spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert (r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id, r.text], r.doc_id


def test_repeats_of_random_texts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    parts = ["".join(rng.choice(list("abcdé "), n)) for n in (90, 100, 101, 150, 400)] + ["ab" * 120]
    texts = [(i, "".join(rng.choice(parts, rng.integers(1, 5)))) for i in range(60)]
    monkeypatch.setattr(suffixes, "PIECE", 200)
    want = cut(texts)
    for r in suffixes.cut_repeats(Scratch(spark, "t"), spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect():
        assert (r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id, r.text]


def test_language(spark, none, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("held", langid.held_out(F.col("doc_id")))
    rows = langid.identify(docs.where("held"), langid.train(docs.where("NOT held"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? \n"), (4, "the of and"), (4, "the of and")], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(odd, langid.train(docs)).collect()]
    assert sorted(got) == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert {r.lang_pred for r in langid.identify(odd, langid.train(docs.where("false"))).collect()} == {"und"}


def test_language_lengths_are_plain_ppm(spark):
    texts = [("aa", "abab abba"), ("bb", "baab bbbb cab")]
    model = langid.train(spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string"))
    counts = {lang: Counter() for lang, _ in texts}
    for lang, text in texts:
        b = langid.folded(text.encode())
        for i in range(langid.DEPTH, len(b)):
            for length in range(langid.DEPTH + 1):
                counts[lang][b[i - length : i], b[i]] += 1

    def bits(lang, context, byte):
        own = {s: n for (c, s), n in counts[lang].items() if c == context}
        total, kinds = sum(own.values()), len(own)
        if byte in own:
            return -math.log2(own[byte] / (total + kinds))
        escape = -math.log2(kinds / (total + kinds)) if own else 0
        return escape + (bits(lang, context[1:], byte) if context else 8)

    for text in ("abba cab", "zz ab", "é b"):
        b = langid.folded(text.encode())
        want = [sum(bits(lang, b[i - langid.DEPTH : i], b[i]) for i in range(langid.DEPTH, len(b))) for lang in model.langs]
        assert np.allclose(model.lengths([text.encode()])[0], want, atol=1e-3)


def plain_print(text):
    words = bytes_of(text).lower().split()
    grams = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_components(spark):
    """Stars, paths, cliques and loose edges against a plain union."""
    rng = np.random.default_rng(12)
    edges = [(0, i) for i in range(1, 40)] + [(i, i + 1) for i in range(100, 130)] + [(int(a), int(b)) for a, b in rng.integers(200, 260, (40, 2))]
    edges += [(300, 300), (390, 301), (390, 302), (390, 303), (391, 390)] + [(a, b) for a in range(400, 408) for b in range(400, 408)]
    group = {n: n for e in edges for n in e}
    for a, b in edges:
        low, high = sorted((group[a], group[b]))
        group = {n: low if g == high else g for n, g in group.items()}
    found = common.components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in found} == {n: group[n] for n in linked} and len(found) == len(linked)
    assert common.components(Scratch(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_prints(docs):
    for r in simhash.fingerprints(docs).collect():
        assert r.fp % (1 << 64) == plain_print(r.text)


@pytest.mark.parametrize("shard", [1024, 3])
def test_simhash_components(spark, shard):
    rng = np.random.default_rng(4)
    values = []
    for center in rng.integers(0, 1 << 63, 12):
        values += [int(center) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4))) for _ in range(12)]
    values += [0, 0, 1, (1 << 64) - 1]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    ids = [int(i) for i in rng.permutation(len(values))]
    prints = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.clusters(Scratch(spark, "t"), prints, shard=shard).collect()}
    group = list(range(len(values)))
    for a, b in itertools.combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= 3:
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
    for k, fp in enumerate(signed):
        assert got[fp] == min(i for i, g in zip(ids, group) if g == group[k])
    assert simhash.clusters(Scratch(spark, "t"), prints.where("false")).count() == 0


def test_nn_descent(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(30, 16))
    rows = []
    for k, c in enumerate(centers):
        for _ in range(1 + k % 7 * 4):
            rows.append((c + rng.normal(size=16) * 0.3 * np.linalg.norm(c) / 4).tolist())
    rows += [rows[0], rows[0], [2 * x for x in rows[0]], None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 0.0], [2.0, 0.0]]
    data = [(i if i % 50 else None, v, 1) for i, v in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, n_links int")
    got = nn_descent.link(Scratch(spark, "t"), df).collect()
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for v in rows]
    group, links = list(range(len(rows))), [0] * len(rows)
    for a, b in itertools.combinations([i for i, o in enumerate(ok) if o], 2):
        x, y = np.array(rows[a]), np.array(rows[b])
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
            links[a] += 1
            links[b] += 1
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
    want = Counter()
    for k, (i, _, _) in enumerate(data):
        ids = [data[j][0] for j, g in enumerate(group) if g == group[k] and data[j][0] is not None]
        low = min(ids) if ids else None
        want[i, links[k], low, i == low] += 1
    assert sum(links) > 500
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    assert nn_descent.link(Scratch(spark, "t"), df.where("false")).count() == 0


def test_large_buckets_are_compared_in_full(spark, monkeypatch):
    """A bucket of many blocks, and the neighbours of a hub, lose no pair; a pair of several tables is given once."""
    monkeypatch.setattr(nn_descent, "CHUNK", 8)
    rng = np.random.default_rng(9)
    x = rng.normal(size=12) + 0.3 * rng.normal(size=(60, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, bytearray(v.tobytes()), 0.01 * (i % 3)) for i, v in enumerate(x)], "n long, v binary, rho double")
    threshold = math.acos(0.95)
    got = [(r.a, r.b, r.link) for r in nn_descent.together(nn_descent.bucketed(nodes, 0, 12, 1), threshold).collect()]
    angle = np.arccos(np.clip(x @ x.T, -1, 1))
    want = {
        (a, b, bool(angle[a, b] <= threshold + 0.01 * (a % 3 + b % 3) + 1e-6))
        for a, b in itertools.combinations(range(60), 2) if angle[a, b] <= nn_descent.REACH * threshold
    }
    assert len(got) == len(set(got)) and set(got) <= want and len(got) > 0.99 * len(want)
    hub = spark.createDataFrame([(0, i, 0.1) for i in range(1, 60)], "a long, b long, angle double")
    found = {(r.a, r.b, r.link) for r in nn_descent.around(nodes, hub, 60, threshold).collect()}
    assert found == want


def test_a_search_that_misses_links_is_an_error(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(nn_descent, "ATTEMPTS", 1)
    monkeypatch.setattr(nn_descent, "recall", lambda *_: 0.5)
    with pytest.raises(RuntimeError, match="links were found"):
        nn_descent.link(Scratch(spark, "t"), df)


def test_mixing(spark, docs, none):
    sized = docs.withColumn("size", mixing.size_of(F.col("text")))
    rows = mixing.allot(Scratch(spark, "t"), sized).collect()
    again = mixing.allot(Scratch(spark, "t"), sized.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(TEXTS)
    total = sum(r.size for r in rows)
    per = {r.source: (r.source_size, r.target) for r in rows}
    assert sum(s for s, _ in per.values()) == total
    assert abs(sum(t for _, t in per.values()) - total) < 1e-6 * total
    assert all(t <= 3 * s for s, t in per.values()) and all(0 <= r.copies <= 3 for r in rows)
    assert mixing.emit(mixing.allot(Scratch(spark, "t"), sized)).count() == sum(r.copies for r in rows)
    assert mixing.allot(Scratch(spark, "t"), none).count() == 0


def test_mixing_comes_near_its_targets(spark):
    rows = [(i, f"s{i % 4}", 1 + i * i % 977) for i in range(4000)]
    out = mixing.allot(Scratch(spark, "t"), spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    for name in {r.source for r in out}:
        own = [r for r in out if r.source == name]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) < 0.01 * own[0].target


def test_quality(docs, none):
    rows = quality.assess(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        many = Counter(windows)
        cover = {j for k, w in enumerate(windows) if many[w] > 1 for j in range(k, k + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 20 or 100 * len(cover) > 30 * len(words)) and not (r.kept and r.base_failed)
        if r.doc_id == 7:
            assert r.clean_text.startswith("One line.\nOne line.\nProse") and r.n_lines_removed == 2
        if r.doc_id in (1, 2):
            assert r.kept and r.clean_text == r.text
    assert quality.assess(none).count() == 0


def test_pieces(docs, none):
    rows = pieces.sample_segmentations(docs, k=3).collect()
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    by = {}
    for r in rows:
        assert r.round_trip and sp.decode(r.ids) == (r.text or "")
        assert r.n_pieces == len(r.ids) and r.log_prob <= 1e-9 and r.log_inclusion <= 0
        by.setdefault((r.doc_id, r.text), {})[r.rank] = (tuple(r.ids), r.perturbed)
    for (doc_id, text), found in by.items():
        # Two spaces, and nothing else to choose in number 6.
        assert len(found) == (2 if doc_id == 6 else 3 if text else 1) and len({i for i, _ in found.values()}) == len(found)
        assert [found[k][1] for k in sorted(found)] == sorted((p for _, p in found.values()), reverse=True)
    assert pieces.sample_segmentations(none).count() == 0


def test_cutting_long_chunks_changes_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    vocab = pieces.vocabulary()
    texts = ["".join(rng.choice(list("abcdefgh日é𝄞"), 3000)), "".join(rng.choice(list("theand of"), 500)), "日本語" * 300, "x"]
    found = {}
    for long in (2, 64, 1 << 40):
        monkeypatch.setattr(pieces, "LONG", long)
        found[long] = [[(tuple(ids.tolist()), round(p, 6)) for ids, p, _, _ in s] for s in pieces.sample(vocab, texts, [1, 2, 3, 4], 3)]
    assert found[2] == found[64] == found[1 << 40]
    text = "".join(rng.choice(list("abcdefghijklmnop"), 100_000))
    for ids, *_ in pieces.sample(vocab, [text], [9], 2)[0]:
        assert pieces.decode(vocab, ids).decode() == " " + text


def test_pieces_are_drawn_without_replacement():
    vocab, text, n = pieces.vocabulary(alpha=0.3), "the 日", 6000
    lattices = pieces.Lattices(vocab, [" the", " 日"])

    def paths(node, end):
        if node == end:
            yield 0.0, ()
            return
        for e in range(lattices.first[node], lattices.first[node + 1]):
            for p, rest in paths(node + int(lattices.span[e]), end):
                yield p + float(lattices.log_p[e]), (e, *rest)

    every = {}
    for (p, a), (q, b) in itertools.product(*(list(paths(h, e)) for h, e in zip(lattices.heads, lattices.ends))):
        every[tuple(pieces.spelled_out(vocab, lattices, [np.array(a + b)])[0].tolist())] = math.exp(p + q)
    assert abs(sum(every.values()) - 1) < 1e-9
    found = pieces.sample(vocab, [text] * n, list(range(n)), 2)
    first = Counter(tuple(s[0][0].tolist()) for s in found)
    second = Counter(tuple(s[1][0].tolist()) for s in found)
    for ids, p in every.items():
        after = sum(q * p / (1 - q) for other, q in every.items() if other != ids)
        for share, count in ((p, first[ids]), (after, second[ids])):
            assert abs(count - n * share) < 5 * math.sqrt(n * share) + 5
    # Weighted by inclusion, the samples estimate sums over all segmentations.
    estimate = np.mean([sum(math.exp(lp - lq) for _, lp, _, lq in s) for s in found])
    assert abs(estimate - 1) < 0.05
    everything = pieces.sample(vocab, ["日"], [1], 50)[0]
    assert len({tuple(s[0].tolist()) for s in everything}) == len(everything) and math.isclose(sum(math.exp(s[1]) for s in everything), 1)


def test_pieces_need_little_memory():
    vocab, rng = pieces.vocabulary(), np.random.default_rng(3)
    letters = np.array(list("etaoinshrdlu日"))
    words = ["".join(rng.choice(letters, n)) for n in rng.integers(2, 12, 20_000)]
    texts = [" ".join(rng.choice(words, 500)) for _ in range(400)]
    tracemalloc.start()
    found = pieces.sample(vocab, texts, list(range(400)), 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 36 * sum(map(len, texts))
    # Neither do samples depend on which texts are walked at once.
    alone = pieces.sample(vocab, texts[300:302], [300, 301], 2)
    for some, other in zip(found[300:302], alone):
        assert [(a[0].tolist(), *np.round(a[1:], 6)) for a in some] == [(b[0].tolist(), *np.round(b[1:], 6)) for b in other]
