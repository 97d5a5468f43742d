"""Keyword rows and banned-word checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import text as tx

# The filter that candidates pass before they are joined with the words has about so many bits a word, as a
# power of two between these; the larger one is 64 MB.
PER_WORD = 32
LEAST_BITS, MOST_BITS = 22, 29
BLOCK = 1 << 15  # bits of the filter that are put together at once
# Characters of a text that are looked at together; longer texts overlap by the longest word.
PIECE = 1 << 18
# Texts that a task of the search looks at together, and candidates after which it hands them on.
TEXTS, CANDIDATES = 64, 1 << 15


def explode_keywords(
    df: DataFrame, column: str, alias: str = "keyword", lexicon: Iterable[str] = ()
) -> DataFrame:
    """One row per word of a text column."""
    return df.withColumn(alias, F.explode(tx.keywords(F.col(column), lexicon)))


def words_check(df: DataFrame, words: DataFrame, column: str = "word") -> DataFrame:
    """Flag each row by whether its word is banned."""
    banned = words.select(F.col("word").alias("_w")).distinct()
    return (
        df.join(banned, F.col(column) == F.col("_w"), "left")
        .withColumn("banned", F.col("_w").isNotNull() & (F.col(column) != ""))
        .drop("_w")
    )


def moderate_exact(df: DataFrame, words: DataFrame) -> DataFrame:
    """First check: the text after the last comma is a banned word."""
    marked = words_check(df.withColumn("_last", tx.last_token(F.col("commentTxt"))), words, "_last")
    return marked.select(
        *[F.col(c).alias("msg" if c == "commentTxt" else c) for c in df.columns],
        F.col("banned").cast("int").alias("is_violation"),
        F.when(F.col("banned"), "P0").otherwise("").alias("violation_grade"),
        F.when(F.col("banned"), F.col("_last")).otherwise("").alias("violation_msg"),
    )


def moderate_contains(df: DataFrame, words: DataFrame, keys: Sequence[str] = ("order_id",)) -> DataFrame:
    """Second check: texts not flagged so far that hold a banned word anywhere.

    They get grade ``P1`` and the words found, in order of first appearance; ``is_violation``
    stays 0. ``keys`` must identify a row of ``df``. Texts and words are joined in the same way
    however many words there are.
    """
    listed = words.select("word").filter("word <> ''").distinct()
    hits = _found(df.filter("is_violation = 0"), listed, keys)
    same = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        same = part if same is None else same & part
    checked = df.join(hits, same, "left").drop(*[f"_k_{k}" for k in keys])
    hit = F.coalesce(F.size("_found") > 0, F.lit(False))
    return checked.withColumns(
        {
            "violation_grade": F.when(hit, "P1").otherwise(F.col("violation_grade")),
            "violation_msg": F.when(hit, F.array_join("_found", ", ")).otherwise(
                F.col("violation_msg")
            ),
        }
    ).drop("_found")


def _in_order(hits: Column) -> Column:
    """Words of (position, word) entries, by position; at one position by word."""
    return F.transform(F.array_sort(hits), lambda h: h["word"])


def _hashes(codes: np.ndarray, length: int, sums: np.ndarray, down: np.ndarray, bits: int) -> np.ndarray:
    """A hash of each stretch of so many code points; its first bits are the best mixed ones."""
    n = len(codes) - length + 1
    return ((sums[length:] - sums[:n]) * down[:n]) >> np.uint64(64 - bits)


def _sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of code points times powers of an odd number, and powers of its inverse."""
    base, back = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    up, down = (np.multiply.accumulate(np.full(len(codes) + 1, x, np.uint64)) for x in (base, back))
    values = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:-1]))), down


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def filter_bits(words: int) -> int:
    """The power of two that a filter for so many words has as its size."""
    return min(MOST_BITS, max(LEAST_BITS, (max(1, words) * PER_WORD - 1).bit_length()))


def _filter_of(listed: DataFrame) -> tuple[list[int], int, np.ndarray]:
    """The words' lengths, the filter's size as a power of two, and its bits, eight to a byte.

    Words become places of bits in the tasks that read them, and a block's bits are put together on Spark, so
    the driver gets the filter and never the words.
    """
    counted = listed.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n")).collect()
    size = filter_bits(sum(r["n"] for r in counted))

    def work(batches):
        for batch in batches:
            spots = np.array([_hashes(c, len(c), *_sums(c), size)[0] for c in map(_codes, batch.column(0).to_pylist())], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spots // BLOCK), pa.array((spots % BLOCK).astype(np.int32))], ["block", "spot"])

    def join(table: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK, bool)
        bits[table.column("spot").to_numpy()] = True
        return pa.table({"block": table.column("block").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    spots = listed.select("word").mapInArrow(work, "block long, spot int")
    rows = spots.groupBy("block").applyInArrow(join, "block long, bits binary").toArrow()
    bits = np.zeros((1 << size) // 8, np.uint8)
    for block, some in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
        bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(some, np.uint8)
    return sorted(r["length"] for r in counted), size, bits


def _passing(bits: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Places whose bit is set."""
    return np.flatnonzero(bits[spots >> np.uint64(3)] & (np.uint8(128) >> (spots & np.uint64(7)).astype(np.uint8)))


def _found(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _found): banned words per row.

    Every stretch of a text that has the length of some word is a candidate if the filter lets its hash
    pass. Candidates, once per text with their first place, are joined with the words. The filter drops
    no word, and grows with their number up to ``MOST_BITS``; beyond, it lets more others by.
    """
    by = [f"_k_{k}" for k in keys]
    lengths, size, bits = _filter_of(listed)
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def work(batches):
        bits = shared.value
        for batch in (b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS)):
            rows, places, found = [], [], []

            def taken() -> pa.RecordBatch:
                kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[: len(by)]]
                out = pa.RecordBatch.from_arrays([*kept, pa.array(places, pa.int64()), pa.array(found, pa.string())], [*by, "at", "word"])
                for entries in (rows, places, found):
                    entries.clear()
                return out

            for row, text in enumerate(batch.column(len(by)).to_pylist()):
                seen: set[str] = set()
                for start in range(0, len(text) if lengths else 0, PIECE):
                    piece = text[start : start + PIECE + lengths[-1] - 1]
                    codes = _codes(piece)
                    sums, down = _sums(codes)
                    for length in lengths:
                        if length <= len(codes):
                            for at in _passing(bits, _hashes(codes, length, sums, down, size)).tolist():
                                word = piece[at : at + length]
                                if word not in seen:
                                    seen.add(word)
                                    rows.append(row)
                                    places.append(start + at + 1)
                                    found.append(word)
                        if len(found) >= CANDIDATES:
                            yield taken()
            yield taken()

    texts = df.filter("msg <> ''").select(*[F.col(k).alias(f"_k_{k}") for k in keys], "msg")
    schema = T.StructType([*texts.schema.fields[: len(by)], T.StructField("at", T.LongType()), T.StructField("word", T.StringType())])
    return (
        texts.mapInArrow(work, schema)
        .join(listed, "word")
        .groupBy(*by)
        .agg(F.collect_list(F.struct("at", "word")).alias("_hits"))
        .select(*by, _in_order(F.col("_hits")).alias("_found"))
    )


def ban_list(df: DataFrame, words: DataFrame) -> DataFrame:
    """Both checks in a row, on comments without duplicates; the result keeps ``order_id``."""
    base = df.select(
        "order_id",
        F.col("user_id"),
        F.col("info_consignee").alias("consignee"),
        "ts_ms",
        "ds",
        "commentTxt",
    )
    return moderate_contains(moderate_exact(base, words), words, ("order_id", "ts_ms"))
