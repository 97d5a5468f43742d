import itertools
import random

import pytest

from tidewell.functions import lexicon


def brute(run, words):
    """The best of all segmentations, in the order that the module states."""

    def every(i):
        if i == len(run):
            yield ()
            return
        ends = [i + len(w) for w in words if run.startswith(w, i)] or [i + 1]
        for end in ends:
            for rest in every(end):
                yield (end, *rest)

    def rank(ends):
        cut = [run[a:b] for a, b in zip((0, *ends), ends)]
        return sum(words.get(w, 0) for w in cut), -len(ends), ends

    best = max(every(0), key=rank)
    return [run[a:b] for a, b in zip((0, *best), best)]


def test_segments_are_those_of_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        words = {"".join(rng.choice("天地人和") for _ in range(rng.randint(1, 4))): rng.randint(-3, 9) for _ in range(12)}
        tree = lexicon.Lexicon(words.items())
        for size in (0, 1, 5, 11):
            run = "".join(rng.choice("天地人和山") for _ in range(size))
            assert tree.segment(run) == brute(run, words)


def test_many_entries(spark):
    """100,000 entries, with rows of awkward text; runs of other scripts stay whole."""
    rng = random.Random(5)
    chars = [chr(0x4E00 + i) for i in range(60)]
    words = {"".join(p): rng.randint(1, 50) for p in itertools.islice(itertools.product(chars, repeat=3), 100_000)}
    words |= {"".join(p): rng.randint(1, 50) for p in itertools.product(chars[:20], repeat=2)}
    runs = ["".join(rng.choice(chars) for _ in range(9)) for _ in range(30)]
    texts = [(i, f"Shop {r}，{r[::-1]} Été9") for i, r in enumerate(runs)] + [(30, None), (31, ""), (32, "!? 12a"), (32, "!? 12a")]
    table = spark.createDataFrame([*words.items(), ("", 5), (None, 5), ("Upper", None)], "word string, weight int")
    df = spark.createDataFrame(texts, "id int, text string").repartition(3)
    got = {}
    for r in lexicon.with_words(df, "text", table).collect():
        got.setdefault(r.id, []).append(r.keyword)
    want = {i: ["shop", *brute(r, _some(words, r)), *brute(r[::-1], _some(words, r[::-1])), "été9"] for i, r in enumerate(runs)}
    want[32] = ["12a", "12a"]
    assert got == want
    assert lexicon.with_words(df.filter("false"), "text", table).count() == 0


def _some(words, run):
    return {run[a:b]: words[run[a:b]] for a in range(len(run)) for b in range(a + 1, len(run) + 1) if run[a:b] in words}


def test_a_lexicon_too_large_is_refused(spark, monkeypatch):
    monkeypatch.setattr(lexicon, "MOST_BYTES", 10)
    words = spark.createDataFrame([("abc", 1)], "word string, weight int")
    with pytest.raises(ValueError, match="more than"):
        lexicon.with_words(words, "word", words)
