"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

A window is ``DEPTH`` bytes of one text. A byte goes if some window over it also starts earlier.

Suffixes are ordered by most-significant-digit passes, only to the window's depth, and a group of
one leaves after each pass. Only anchored suffixes take part: of the ``DIGIT``-byte strings in a
window the one with the smallest hash is its anchor. Equal windows have equal anchors at equal
offsets, so every repeated window is found from its anchor, and anchors are far fewer than bytes.

1. First digit: the anchor's own ``DIGIT`` bytes. Anchors alone with theirs are done.
2. Second digit: all bytes of the windows that the anchor stands for. In a group all but the
   earliest place are repeats as a whole.
3. Where a first digit has several second ones, their earliest places are ordered window by window.

Digits are 64-bit hashes; a group's key is two of them at least, 128 bits. Repeats inside a batch of
texts are settled in the batch, so a text copied everywhere sends one row per batch, not per copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import Hasher, Scratch, as_bytes, mixed, powers, runs

DEPTH, DIGIT = 100, 32
BATCH = 8 << 20  # bytes of text whose repeats are settled together
CROWD = 2000  # places of a first digit that one task takes together
PIECE = 1 << 19  # bytes hashed at once; longer texts are cut with an overlap of a window
_PLACE = np.uint64((1 << 22) - 1)

_ROW = ["d", "h", "p", "a", "b"]
_WINDOWS = ["g", "salt", "d", "h", "p", "a", "region", "at"]


def anchors_of(buf: np.ndarray, depth: int, digit: int, ready=None) -> tuple:
    """(anchor, first window, last window, first digit, hasher) over all windows of ``buf``."""
    hasher = Hasher(buf, ready)
    at = np.arange(len(buf) - digit + 1)
    grams = hasher.ranges(at, at + digit)
    low = (grams & ~_PLACE) | at.astype(np.uint64)  # ties go to the left
    span, width = depth - digit + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    place = (low & _PLACE).astype(np.int64)  # of each window
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:], [len(place)])) - 1
    return place[first], first, last, grams, hasher


def _pieces(texts: list[bytes], depth: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """(joined, [(text, offset in text, start in joined)]); pieces of long texts overlap."""
    parts, where, size = [], [], 0
    for i, text in enumerate(texts):
        for a in range(0, len(text) - depth + 1, PIECE):
            part = text[a : a + PIECE + depth - 1]
            if size and size + len(part) > PIECE:
                yield b"".join(parts), where
                parts, where, size = [], [], 0
            where.append((i, a, size))
            parts.append(part)
            size += len(part)
    if parts:
        yield b"".join(parts), where


def _earliest(keys: list[np.ndarray], place: list[np.ndarray]) -> np.ndarray:
    """True where a row is the first by ``place`` among those with equal keys."""
    order = np.lexsort([*reversed(place), *reversed(keys)])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for k in keys:
            new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), bool)
    out[order] = new
    return out


def _gathered(batches, text_at: int) -> Iterator[tuple[list, list[bytes]]]:
    """Arrow batches put together to about BATCH bytes of text: (other columns, texts)."""
    held, texts, size = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            new = as_bytes(part.column(text_at))
            held.append(part)
            texts += new
            size += sum(map(len, new))
            if size >= BATCH:
                yield held, texts
                held, texts, size = [], [], 0
    if texts:
        yield held, texts


def _numbers(parts: list[pa.RecordBatch], at: int) -> np.ndarray:
    return np.concatenate([p.column(at).to_numpy(zero_copy_only=False) for p in parts])


def anchors(docs: DataFrame, depth: int, digit: int) -> DataFrame:
    """(g, x, d, h, p, a, b, sure) of ``docs`` (d, h, text): digits, place, windows p-a..p+b.

    ``sure`` rows repeat an earlier row of their batch; their digits are of no further use.
    """

    def work(batches):
        ready = powers(2 * PIECE)
        for held, texts in _gathered(batches, 2):
            d, h = _numbers(held, 0), _numbers(held, 1)
            cols: list[list[np.ndarray]] = [[] for _ in range(7)]
            for joined, where in _pieces(texts, depth):
                p, lo, hi, grams, hasher = anchors_of(np.frombuffer(joined, np.uint8), depth, digit, ready)
                w = np.array(where)
                ends = np.concatenate((w[1:, 2], [len(joined)]))
                # An anchor stands for windows of its own text only.
                k = np.searchsorted(w[:, 2], p, "right") - 1
                lo, hi = np.maximum(lo, w[k, 2]), np.minimum(hi, ends[k] - depth)
                ok = lo <= hi
                p, lo, hi, k = p[ok], lo[ok], hi[ok], k[ok]
                x = hasher.ranges(lo, hi + depth) ^ mixed((p - lo).astype(np.uint64))
                i = w[k, 0]
                for c, v in zip(cols, (grams[p], x, d[i], h[i], p - w[k, 2] + w[k, 1], p - lo, hi - p)):
                    c.append(v)
            if not cols[0]:
                continue
            g, x, dd, hh, p, a, b = (np.concatenate(c) for c in cols)
            sure = ~_earliest([g, x], [dd, hh, p])
            # Short numbers for keys, so that copies do not all go where their first one goes.
            g = np.where(sure, (dd * 31 + p).view(np.uint64) & np.uint64(0xFFFF), g)
            x[sure] = 0
            for s in range(0, len(g), 100_000):
                e = s + 100_000
                values = [g[s:e].view(np.int64), x[s:e].view(np.int64), dd[s:e], hh[s:e], p[s:e], a[s:e], b[s:e], sure[s:e]]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["g", "x", *_ROW, "sure"])

    schema = "g long, x long, d long, h long, p long, a long, b long, sure boolean"
    return docs.select("d", "h", "text").mapInArrow(work, schema)


def windows(docs: DataFrame, depth: int) -> DataFrame:
    """(g, salt, d, h, p, a, region, at) for the windows of chosen anchors of ``docs``.

    ``docs`` has d, h, text and ``chosen``, a list of (g, p, a, b, parts). An anchor goes out as the
    region of bytes that its windows cover. Only if its first digit is at more places than one task
    shall take (parts > 1), its windows are dealt out by their digit over so many salts; ``at`` then
    lists those of one salt, as pairs of offset and digit. A row with neither is a window from p
    that repeats an earlier one of its batch.
    """

    def work(batches):
        for held, texts in _gathered(batches, 2):
            d, h = _numbers(held, 0), _numbers(held, 1)
            picked = [c for part in held for c in part.column(3).to_pylist()]
            cols: list[list[np.ndarray]] = [[] for _ in range(7)]
            plain = [(d[i], h[i], text, r) for i, (text, rows) in enumerate(zip(texts, picked)) for r in rows if r["parts"] == 1]
            for start in range(0, len(plain), 10_000):
                some = plain[start : start + 10_000]
                values = [[x[3]["g"] for x in some], [0] * len(some), [x[0] for x in some], [x[1] for x in some]]
                values += [[x[3]["p"] for x in some], [x[3]["a"] for x in some]]
                region = [x[2][x[3]["p"] - x[3]["a"] : x[3]["p"] + x[3]["b"] + depth] for x in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.int64()) for v in values] + [pa.array(region, pa.binary()), pa.nulls(len(some), pa.binary())], _WINDOWS
                )
            for i, (text, rows) in enumerate(zip(texts, picked)):
                rows = sorted((r for r in rows if r["parts"] > 1), key=lambda r: r["p"])
                buf, k = np.frombuffer(text, np.uint8), 0
                while k < len(rows):  # stretches of at most about a piece
                    m, begin = k + 1, rows[k]["p"]
                    while m < len(rows) and rows[m]["p"] - begin < PIECE:
                        m += 1
                    start = min(r["p"] - r["a"] for r in rows[k:m])
                    stop = max(r["p"] + r["b"] for r in rows[k:m]) + depth
                    hasher = Hasher(buf[start:stop])
                    p, a, b, g, parts = (np.array([r[c] for r in rows[k:m]], np.int64) for c in ("p", "a", "b", "g", "parts"))
                    n = a + b + 1
                    at = np.repeat(p - a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    offset = np.repeat(p, n) - at
                    key = hasher.ranges(at - start, at - start + depth) ^ mixed(offset.astype(np.uint64) + np.uint64(1))
                    salt = (key % np.repeat(parts, n).astype(np.uint64)).astype(np.int64)
                    values = (np.repeat(g, n), key, np.full(len(at), d[i]), np.full(len(at), h[i]), np.repeat(p, n), offset, salt)
                    for c, v in zip(cols, values):
                        c.append(v)
                    k = m
            if not cols[0]:
                continue
            g, w, dd, hh, p, offset, salt = (np.concatenate(c) for c in cols)
            sure = ~_earliest([g, w], [dd, hh, p - offset])
            none = pa.nulls(int(sure.sum()), pa.binary())
            zero = np.zeros(len(none), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(v[sure]) for v in (g, salt, dd, hh, p - offset)] + [pa.array(zero), none, none], _WINDOWS)
            g, w, dd, hh, p, offset, salt = (v[~sure] for v in (g, w, dd, hh, p, offset, salt))
            order = np.lexsort((salt, p, hh, dd, g))
            g, w, dd, hh, p, offset, salt = (v[order] for v in (g, w, dd, hh, p, offset, salt))
            new = np.ones(len(g), bool)
            for v in (g, dd, hh, p, salt):
                new[1:] &= v[1:] == v[:-1]
            new[1:] = ~new[1:]
            firsts = np.flatnonzero(new)
            pairs = np.stack([offset.astype(np.uint64), w], axis=1)
            at = [pairs[s:e].tobytes() for s, e in zip(firsts, [*firsts[1:], len(g)])]
            values = [pa.array(v[firsts]) for v in (g, salt, dd, hh, p)] + [pa.array(np.zeros(len(firsts), np.int64))]
            yield pa.RecordBatch.from_arrays([*values, pa.nulls(len(firsts), pa.binary()), pa.array(at, pa.binary())], _WINDOWS)

    schema = "g long, salt long, d long, h long, p long, a long, region binary, at binary"
    return docs.select("d", "h", "text", "chosen").mapInArrow(work, schema)


def _later(rows: DataFrame, depth: int) -> DataFrame:
    """(d, h, s, e): runs of windows of ``rows`` (as from ``windows``) that an earlier place has too."""

    def settle(held):
        g, _, d, h, p, a, region, at = zip(*held)
        buf = np.frombuffer(b"".join(r or b"" for r in region), np.uint8)
        sizes = np.array([len(r or b"") for r in region])
        whole = np.maximum(sizes - depth + 1, 0)  # windows of regions
        dealt = np.array([len(x or b"") // 16 for x in at])
        row = np.concatenate((np.repeat(np.arange(len(held)), whole), np.repeat(np.arange(len(held)), dealt)))
        starts = np.repeat(np.cumsum(sizes) - sizes, whole)
        nth = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        key = Hasher(buf).ranges(starts + nth, starts + nth + depth)
        offset = np.repeat(np.array(a, np.int64), whole) - nth
        key = key ^ mixed(offset.astype(np.uint64) + np.uint64(1))
        pairs = np.frombuffer(b"".join(x or b"" for x in at), np.uint64).reshape(-1, 2)
        key = np.concatenate((key, pairs[:, 1]))
        offset = np.concatenate((offset, pairs[:, 0].astype(np.int64)))
        g, d, h, p = (np.array(c, np.int64)[row] for c in (g, d, h, p))
        s = p - offset
        later = ~_earliest([g, key], [d, h, s])
        d, h, s = d[later], h[later], s[later]
        order = np.lexsort((s, h, d))
        d, h, s = d[order], h[order], s[order]
        new = np.ones(len(s), bool)
        new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (s[1:] > s[:-1] + depth)
        firsts = np.flatnonzero(new)
        ends = s[np.concatenate((firsts[1:], [len(s)])) - 1] + depth if len(s) else s
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (d[firsts], h[firsts], s[firsts], ends)], ["d", "h", "s", "e"])

    def work(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= 5_000 and row[:2] != held[-1][:2]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    dealt = rows.repartition("g", "salt").sortWithinPartitions("g", "salt").select(*_WINDOWS)
    return dealt.mapInArrow(work, "d long, h long, s long, e long")


def _cut(docs: DataFrame, columns: list[str], text: str, as_text: bool) -> DataFrame:
    """Take the marked ranges (marks: array of (s, e)) out of every text."""
    at, marks_at = columns.index(text), len(columns)
    new = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    new.append(("kept", T.StringType() if as_text else T.BinaryType()))
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(n, t) for n, t in new])
    kinds = [pa.int64()] * 3 + [pa.string(), pa.string() if as_text else pa.binary()]

    def work(batches):
        for batch in batches:
            rows = []
            for text, marks in zip(as_bytes(batch.column(at)), batch.column(marks_at).to_pylist()):
                spans: list[list[int]] = []
                for s, e in sorted((m["s"], m["e"]) for m in marks or ()):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                ends = [0, *(x for span in spans for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])) if spans else text
                digest = hashlib.sha256(kept).hexdigest()
                kept_as = kept.decode(errors="ignore") if as_text else kept
                rows.append((len(text), len(text) - len(kept), len(spans), digest, kept_as))
            values = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:marks_at], *values], schema.names)

    return docs.select(*columns, "marks").mapInArrow(work, schema)


def cut_repeats(
    scratch: Scratch, docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, digit: int = DIGIT,
    as_text: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and kept (what is left).

    "Earlier" goes by key, then by a hash of the text, then by place. A null key comes before all
    others; a null text is empty. Rows equal in key and text are one document listed more than
    once: they get equal results and do not repeat each other. Texts shorter than a window stay
    whole. ``kept`` holds bytes, or with ``as_text`` a string without characters that were cut in two.
    Columns with the names of results are replaced; names beginning with an underscore are reserved.
    """
    new = {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"}
    columns = [c for c in docs.columns if c not in new]
    # Ids are unique as a rule; then the hash of the text is left out of all rows.
    d = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    known = docs.select(d.alias("d")).groupBy("d").count().where("count > 1").select(F.col("d").alias("_d"), F.lit(1).alias("_many"))
    known = scratch.keep(known, "repeated-ids")
    wide = docs.select(*columns, d.alias("_d")).join(known, "_d", "left")
    wide = wide.withColumn("_h", F.when(F.col("_many") == 1, F.xxhash64(F.coalesce(F.col(text), F.lit("")))).otherwise(F.lit(0)))
    slim = wide.where(F.octet_length(text) >= depth).select(F.col("_d").alias("d"), F.col("_h").alias("h"), F.col(text).alias("text"), "_many")
    # Rows of one place would take each other for earlier ones; one of them stands for all.
    slim = slim.where("_many IS NULL").drop("_many").unionByName(slim.where("_many = 1").drop("_many").dropDuplicates(["d", "h"]))

    # First digit: groups of one leave.
    rows = anchors(slim, depth, digit)
    groups = rows.where("NOT sure").groupBy("g").count().where("count > 1").select("g", F.lit(1).alias("many"))
    left = rows.join(groups, "g", "left").where("sure OR many = 1").drop("many")
    left = scratch.keep(left, "first-digit")

    # Second digit: in each group all but the earliest place repeat.
    first = left.where("NOT sure").groupBy("g", "x").agg(F.min(F.struct(*_ROW)).alias("first"))
    first = scratch.keep(first.select("g", "x", "first.*"), "second-digit")
    later = first.select("g", "x", F.struct("d", "h", "p").alias("first"))
    later = left.where("NOT sure").join(later, ["g", "x"]).where(F.struct("d", "h", "p") != F.col("first"))
    marks = left.where("sure").select(*_ROW).unionByName(later.select(*_ROW))
    marks = scratch.keep(marks.select("d", "h", F.expr("p - a AS s"), (F.expr("p + b") + depth).alias("e")), "whole")
    scratch.drop("first-digit")

    # Window by window where a first digit has several second ones.
    several = first.groupBy("g").count().where("count > 1")
    several = several.select("g", F.ceil(F.col("count") / CROWD).cast("long").alias("parts"))
    chosen = first.join(several, "g").groupBy("d", "h")
    chosen = chosen.agg(F.collect_list(F.struct("g", "p", "a", "b", "parts")).alias("chosen"))
    single = scratch.keep(windows(slim.join(chosen, ["d", "h"]), depth), "windows")
    scratch.drop("second-digit")
    alone = "region IS NULL AND at IS NULL"
    marks = marks.unionByName(_later(single.where(f"NOT ({alone})"), depth))
    marks = marks.unionByName(single.where(alone).select("d", "h", F.col("p").alias("s"), (F.col("p") + depth).alias("e")))
    marks = scratch.keep(_merged(marks), "marks")
    scratch.drop("windows", "whole")

    marks = marks.select(F.col("d").alias("_d"), F.col("h").alias("_h"), "marks")
    return _cut(wide.join(marks, ["_d", "_h"], "left"), columns, text, as_text)


def _merged(marks: DataFrame) -> DataFrame:
    """(d, h, marks): the ranges of each text; those of one text are fewer than its bytes."""
    return marks.groupBy("d", "h").agg(F.collect_list(F.struct("s", "e")).alias("marks"))
