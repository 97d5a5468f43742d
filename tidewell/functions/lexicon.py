"""Words of unbroken text by a lexicon: a prefix tree and the best segmentation by weights.

A run of text is cut where the sum of its words' weights is greatest; of equal sums the one with fewer
words counts, then the one whose first word is longer, and so on. At a place where no word of the lexicon
begins, the character stands alone and weighs nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HAN_RUN = r"\p{Han}+"
# Letters and digits of other scripts, as ``text.WORD_RUN`` has them.
OTHER_RUN = r"[[\p{L}\p{N}]--\p{Han}]+"
# Bytes of lexicon that are sent to the tasks; more is an error, not a cut.
MOST_BYTES = 64 << 20


class Lexicon:
    """A prefix tree over words with whole-number weights."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        # A node is a dict from character to node; the key None holds the weight of the word that ends there.
        self.root: dict = {}
        for word, weight in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            if word:
                node[None] = max(weight, node.get(None, weight))

    def segment(self, run: str) -> list[str]:
        n = len(run)
        # Best sum from a place on, how few words it takes (negative), and where its first word ends.
        best: list[tuple[int, int, int]] = [(0, 0, n)] * (n + 1)
        for i in range(n - 1, -1, -1):
            node, found = self.root.get(run[i]), None
            j = i + 1
            while node is not None:
                if None in node:
                    total, words, _ = best[j]
                    option = (total + node[None], words - 1, j)
                    if found is None or option > found:
                        found = option
                node = node.get(run[j]) if j < n else None
                j += 1
            best[i] = found or (best[i + 1][0], best[i + 1][1] - 1, i + 1)
        out, i = [], 0
        while i < n:
            out.append(run[i : best[i][2]])
            i = best[i][2]
        return out


def with_words(
    df: DataFrame, column: str, lexicon: DataFrame, alias: str = "keyword", runs: str | None = None
) -> DataFrame:
    """One row per word of a text column, lower case and in order, by a lexicon (``word``, ``weight``).

    Runs of Han characters, or what the pattern ``runs`` matches, are cut by the lexicon; other runs of letters and
    digits are words as they are. Lexicon words are taken in lower case; empty and null ones do not
    count, and of one word's weights the greatest does. Null texts have no words. The tree goes to every task, so
    a lexicon of more than ``MOST_BYTES`` is refused.
    """
    known = lexicon.select(F.lower("word").alias("word"), F.col("weight").cast("bigint").alias("weight"))
    known = known.filter("word <> '' AND weight IS NOT NULL").groupBy("word").agg(F.max("weight").alias("weight"))
    size = known.agg(F.sum(F.octet_length("word") + 8)).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"a lexicon of {size} bytes is more than the {MOST_BYTES} that tasks may hold")
    shared = df.sparkSession.sparkContext.broadcast([(r["word"], r["weight"]) for r in known.collect()])
    pattern = f"(?V1)({runs or HAN_RUN})|{OTHER_RUN}"
    place = df.columns.index(column)
    schema = df.withColumn(alias, F.lit(""))

    def work(batches):
        lexicon, find = Lexicon(shared.value), regex.compile(pattern)
        for batch in batches:
            take, words = [], []
            for i, text in enumerate(batch.column(place).to_pylist()):
                for m in find.finditer((text or "").lower()):
                    own = lexicon.segment(m.group()) if m.group(1) else [m.group()]
                    take += [i] * len(own)
                    words += own
            kept = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(words, pa.string())], [*batch.schema.names, alias])

    return df.mapInArrow(work, schema.schema)
