"""Line-first cleaning of documents.

Each line is judged by itself: punctuation, navigation, boilerplate. Failing lines go, and a
document that loses too large a share of its word characters goes as a whole. Counts of the base
rule (words, symbols, repeated lines and word windows) come from the same pass.

Lines and words are found and hashed in numpy for about a megabyte of text at a time; equal lines and word
windows are equal 64-bit hashes within one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewell.llm.common import Hasher, as_bytes, mixed, powers, runs, slices, SLICE

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOST = 0.5  # share of word characters that failing lines may take
MAX_PUNCTUATION = 0.15  # of a line's characters other than spaces
MIN_SEPARATORS, MIN_SEPARATOR_SHARE = 3, 0.2  # of a line's words
SHORT_LINE = 4  # words; shorter lines need a final mark
BOILERPLATE_WORDS = 40  # longer lines are prose that mentions the phrase

# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "back to top",
    "click here to",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more »",
    "share on facebook",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "this site uses cookies",
)

SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(n, T.LongType()) for n in ("n_lines", "n_lines_removed")]
    + [T.StructField("lost", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    + [T.StructField("clean_text", T.StringType())]
)


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACE = _flags(b" \t\n\x0b\x0c\r")
SYMBOL = _flags(b"#*$%&|<>")
PUNCTUATION = _flags(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
LAST_MARK = _flags(b".!?:;\"')") | _flags(bytes(range(128, 192)))  # or any character beyond ASCII
SEPARATOR = _flags(b"|>/-:") | _flags("»•·".encode())
POINT = ~_flags(bytes(range(128, 192)))  # bytes that begin a code point


def judge(texts: list[bytes], table=None) -> dict[str, list]:
    """The columns of SCHEMA for some texts."""
    out: dict[str, list] = {n: [] for n in SCHEMA.names}
    for first, last, joined, starts in slices(texts):
        n, buf = last - first, np.frombuffer(joined, np.uint8)
        space = SPACE[buf]
        ws, we = runs(~space)
        doc = np.searchsorted(starts, ws, "right") - 1
        sums = lambda flags: np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        ends = np.minimum(starts[1:], len(buf))
        points, symbols = sums(~space & POINT[buf]), sums(SYMBOL[buf])
        n_words = np.bincount(doc, minlength=n)
        per_doc = lambda s: s[ends] - s[starts[:-1]]
        hasher = Hasher(buf, table)

        # Lines: the joining line feeds end the documents' last lines.
        ls = np.concatenate(([0], np.flatnonzero(buf == 10) + 1))
        le = np.concatenate((ls[1:] - 1, [len(buf)]))
        ldoc = np.searchsorted(starts, ls, "right") - 1
        lwords = np.searchsorted(ws, le) - np.searchsorted(ws, ls)
        full = np.flatnonzero(lwords)
        key = hasher.ranges(ls[full], le[full]) ^ mixed(ldoc[full].astype(np.uint64) + np.uint64(1))
        once = np.unique(key, return_index=True)[1]
        again = np.ones(len(full), bool)
        again[once] = False
        n_dup = np.bincount(ldoc[full[again]], minlength=n)

        # Windows of words found twice or more.
        n_repeat = np.zeros(n, np.int64)
        if len(ws) >= WINDOW:
            word, m = hasher.ranges(ws, we), len(ws) - WINDOW + 1
            window = mixed(doc[:m].astype(np.uint64) + np.uint64(1))
            for j, odd in enumerate(range(3, 3 + 2 * WINDOW, 2)):
                window = mixed(window * np.uint64(odd) + word[j : j + m])
            inside = np.flatnonzero(doc[:m] == doc[WINDOW - 1 :])
            order = inside[np.argsort(window[inside])]
            same = window[order[1:]] == window[order[:-1]]
            twice = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) else order
            cover = np.zeros(len(ws) + 1, np.int64)
            cover[:-1] += np.bincount(twice, minlength=len(ws))
            cover[WINDOW:] -= np.bincount(twice, minlength=len(ws))[: len(ws) + 1 - WINDOW]
            n_repeat = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)

        # Verdicts on lines.
        solid, marks = sums(~space), sums(PUNCTUATION[buf])
        size = np.maximum(solid[le] - solid[ls], 1)
        bad = (marks[le] - marks[ls]) > MAX_PUNCTUATION * size
        lw = np.searchsorted(ws, le[full]) - 1  # the line's last word
        ended = np.ones(len(ls), bool)
        ended[full] = LAST_MARK[buf[we[lw] - 1]]
        bad |= (lwords < SHORT_LINE) & ~ended
        odd_bytes = sums(~SEPARATOR[buf])
        parts = sums(odd_bytes[we] == odd_bytes[ws])  # words made of separators alone
        n_parts = parts[np.searchsorted(ws, le)] - parts[np.searchsorted(ws, ls)]
        bad |= (n_parts >= MIN_SEPARATORS) & (n_parts >= MIN_SEPARATOR_SHARE * lwords)
        low = joined.lower()
        for phrase in BOILERPLATE:
            at = low.find(at_bytes := phrase.encode())
            while at >= 0:
                k = np.searchsorted(ls, at, "right") - 1
                bad[k] |= lwords[k] <= BOILERPLATE_WORDS
                at = low.find(at_bytes, at + 1)
        bad &= lwords > 0
        lchars = points[le] - points[ls]
        lost = np.bincount(ldoc, weights=lchars * bad, minlength=n)
        chars = per_doc(points)
        share = lost / np.maximum(chars, 1)
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
        removed = np.bincount(ldoc, weights=bad, minlength=n).astype(np.int64)
        columns = {
            "n_words": n_words, "word_chars": chars, "n_symbols": per_doc(symbols), "n_dup_lines": n_dup,
            "n_repeat_words": n_repeat, "n_lines": np.bincount(ldoc, minlength=n), "n_lines_removed": removed,
            "lost": share, "base_failed": failed, "kept": ~failed & (share <= MAX_LOST),
        }
        for name, values in columns.items():
            out[name].extend(values.tolist())
        firsts = np.searchsorted(ldoc, np.arange(n + 1))
        for i in range(n):
            text = texts[first + i]
            if removed[i]:
                rows = range(firsts[i], firsts[i + 1])
                text = b"\n".join(joined[ls[k] : le[k]] for k in rows if not bad[k])
            out["clean_text"].append(text)
    return out


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with the counts, the verdict ``kept`` and the text of the lines that stay.

    A null text has no words and one empty line; it fails, as does any text under twenty words.
    Repeated rows are judged alike, very long texts whole. Columns with the names of results are
    replaced by these.
    """
    kept_columns = [c for c in docs.columns if c not in SCHEMA.names]
    if text not in kept_columns:
        raise ValueError(f"{text} is the name of a result")
    schema = T.StructType([docs.schema[c] for c in kept_columns] + SCHEMA.fields)
    at = kept_columns.index(text)
    wide = [pa.float64() if n == "lost" else pa.bool_() if n in ("base_failed", "kept") else pa.string() if n == "clean_text" else pa.int64() for n in SCHEMA.names]

    def work(batches):
        ready = powers(2 * SLICE)
        for batch in batches:
            got = judge(as_bytes(batch.column(at)), ready)
            new = [pa.array(got[n], pa.binary()).cast(t) if t == pa.string() else pa.array(got[n], t) for n, t in zip(SCHEMA.names, wide)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *SCHEMA.names])

    return docs.select(*kept_columns).mapInArrow(work, schema)
