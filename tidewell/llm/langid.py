"""Language identification by prediction with partial matching.

Each language has a context tree of bytes: at every context of up to ``DEPTH`` bytes it counts the
bytes that followed. A byte's code length comes from the longest context the language knows; a byte
unseen there costs the escape (distinct followers over followers plus distinct ones, method C) and
is looked up one byte shorter, down to a uniform choice of 256. A text goes to the language that
codes it shortest. The statistics are frozen, so the length of a byte depends on its context alone
and all lengths are worked out once, in one table of known contexts by byte values.

Training takes the ``TRAIN_DOCS`` documents per language, or about so many: each labelled document
is in by a hash of its id. That bound also bounds the table that is broadcast; prediction reads
every text as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import as_bytes, slices

DEPTH = 3
TRAIN_DOCS = 4000  # per language
CHUNK = 1 << 19
# Letters A-Z become lower case; digits, marks and white space become spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def folded(text: bytes) -> bytes:
    """Words of letters between single spaces, after ``DEPTH`` spaces of context."""
    return b" " * DEPTH + b" ".join(text.translate(_FOLD).split()) + b" "


def _grams(code: np.ndarray) -> np.ndarray:
    """DEPTH bytes of context and the byte that follows, as one number."""
    out = np.zeros(len(code) - DEPTH, np.uint32)
    for j in range(DEPTH + 1):
        out = out << np.uint32(8) | code[j : len(code) - DEPTH + j]
    return out


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n): how often each byte follows each context, summed over ``docs``."""

    def work(batches):
        for batch in batches:
            texts, langs = as_bytes(batch.column(0)), batch.column(1).to_pylist()
            for name in sorted(set(langs)):
                own = [folded(t) for t, l in zip(texts, langs) if l == name]
                for first, last, joined, _ in slices(own, CHUNK):
                    # A line feed joins the texts; grams over it are left out.
                    code = np.frombuffer(joined, np.uint8).astype(np.uint32)
                    grams = _grams(code)
                    bad = np.zeros(len(code), bool)
                    bad[code == 10] = True
                    crossing = np.convolve(bad, np.ones(DEPTH + 1, np.int8))[DEPTH : len(code)] > 0
                    values, n = np.unique(grams[~crossing], return_counts=True)
                    rows = [pa.array([name] * len(values)), pa.array(values.astype(np.int64)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(rows, ["lang", "gram", "n"])

    rows = docs.select(text, lang).mapInArrow(work, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Code lengths, in bits, of every byte after every known context, for all languages at once."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        gram = gram.astype(np.uint32)
        seen = np.unique(np.concatenate([gram >> np.uint32(8 * j) & np.uint32(255) for j in range(DEPTH + 1)] + [np.array([32], np.uint32)]))
        self.symbols = np.full(256, len(seen), np.uint32)  # the last symbol: any byte never seen
        self.symbols[seen] = np.arange(len(seen))
        size = self.size = len(seen) + 1
        digits = [self.symbols[gram >> np.uint32(8 * j) & np.uint32(255)].astype(np.int64) for j in range(DEPTH + 1)]
        symbol, context = digits[0], digits[1:]  # nearest byte of context first
        # States: every context of every length that some language knows; shorter ones first.
        self.ids = [np.zeros(1, np.int32)]
        keys, total = [np.zeros(len(gram), np.int64)], 1
        for length in range(1, DEPTH + 1):
            key = sum(context[j] * size**j for j in range(length))
            keys.append(key)
            known = np.unique(key)
            ids = np.full(size**length, -1, np.int32)
            ids[known] = total + np.arange(len(known))
            self.ids.append(ids)
            total += len(known)
        # A context not known is treated as its longest known ending.
        for length in range(1, DEPTH + 1):
            ids, shorter = self.ids[length], self.ids[length - 1]
            miss = np.flatnonzero(ids < 0)
            ids[miss] = shorter[miss % size ** (length - 1)]
        bits = np.full((total, size, len(langs)), 8.0, np.float32)
        for l in range(len(langs)):
            own = lang == l
            last = np.full((1, size), 8.0)
            tables = [last]
            first_state = 0
            for length in range(DEPTH + 1):
                key, sym, c = keys[length][own], symbol[own], n[own]
                known = np.flatnonzero(np.bincount(keys[length], minlength=size**length)) if length else np.zeros(1, np.int64)
                row = np.searchsorted(known, key)
                count = np.zeros((len(known), size))
                np.add.at(count, (row, sym), c)
                total_n, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
                below = tables[-1][0] if length == 0 else bits[self.ids[length - 1][known % size ** (length - 1)], :, l].astype(np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    hit = -np.log2(count / (total_n + kinds))
                    escape = np.where(total_n > 0, -np.log2(kinds / (total_n + kinds)), 0.0)
                value = np.where(count > 0, hit, escape + below)
                bits[first_state : first_state + len(known), :, l] = value
                first_state += len(known)
        self.bits = bits.reshape(total * size, len(langs))

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits per text and language."""
        out = np.zeros((len(texts), len(self.langs)))
        ids, size = self.ids[DEPTH], self.size
        for first, last, joined, starts in slices([folded(t) for t in texts], CHUNK):
            whole = np.frombuffer(joined, np.uint8)
            for a in range(DEPTH, len(whole), CHUNK):
                code = self.symbols[whole[a - DEPTH : a + CHUNK]]
                n = len(code) - DEPTH
                key = np.zeros(n, np.uint32)
                for j in range(DEPTH):  # the oldest byte is the highest digit
                    key = key * np.uint32(size) + code[j : j + n]
                cost = self.bits[ids[key].astype(np.int64) * size + code[DEPTH:]]
                # Each text begins with its context, and its line feed is not its own.
                i0, i1 = np.searchsorted(starts, [a, a + n], "right")
                inside = np.maximum(starts[i0 - 1 : i1] + DEPTH, a)
                ends = np.minimum(starts[i0 : i1 + 1], len(whole) + 1)[: len(inside)] - 1
                sums = np.zeros((n + 1, cost.shape[1]))
                np.cumsum(cost, axis=0, dtype=np.float64, out=sums[1:])
                ends = np.clip(ends, None, a + n)
                for k, (s, e) in enumerate(zip(inside, ends)):
                    if s < e and i0 - 1 + k < last - first:
                        out[first + i0 - 1 + k] += sums[e - a] - sums[s - a]
        return out


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = TRAIN_DOCS) -> Model:
    """Fit on about ``per_lang`` documents of each language with a label (all, if there are fewer)."""
    docs = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    share = docs.groupBy(lang).agg(F.least(F.lit(1.0), per_lang / F.count("*")).alias("_share"))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(1 << 20)) / (1 << 20)
    names = share.collect()
    langs = sorted(r[lang] for r in names)
    if not langs:
        return Model([], *[np.zeros(0, np.int64)] * 3)
    part = F.element_at(F.create_map(*[F.lit(v) for r in names for v in (r[lang], r["_share"])]), F.col(lang))
    rows = counts(docs.where(draw < part), text, lang).toArrow()
    at = {name: i for i, name in enumerate(langs)}
    codes = np.array([at[x] for x in rows.column(0).to_pylist()], np.int64)
    return Model(langs, codes, rows.column(1).to_numpy(), rows.column(2).to_numpy())


def held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with lang_pred and score, from the text alone.

    Null texts and texts without a letter are ``und`` with score 0, as are all texts if nothing
    could be learned. The score is the share of the winner's probability of the text among all
    languages'; ties go to the language that sorts first. Repeated rows get equal results.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = keep.index(text)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    # Plain arrays: a broadcast would name the class, and workers may not have this package.
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def work(batches):
        model = Model.__new__(Model)
        model.__dict__.update(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                letters, texts = part.column(len(keep)).to_pylist(), as_bytes(part.column(at))
                names, scores = ["und"] * len(texts), [0.0] * len(texts)
                if model.langs:
                    bits = model.lengths(texts)
                    best = bits.argmin(1)
                    share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                    for i, ok in enumerate(letters):
                        if ok:
                            names[i], scores[i] = model.langs[best[i]], float(share[i])
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(names), pa.array(scores, pa.float64())], schema.names)

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter")
    return docs.select(*keep, letter).mapInArrow(work, schema)
