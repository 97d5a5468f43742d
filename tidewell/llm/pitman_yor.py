"""A hierarchical Pitman-Yor language model: words after a word, words, and their spelling.

Each word is a context with a restaurant of the words that follow it; the end of a text is the context
of the first word of one. All contexts share a parent, the restaurant of words, whose base is a model of
spelling: the bytes of a word (and its end) come from restaurants of contexts of two, one and no bytes, each
sharing its parent with all contexts that end alike, down to a uniform choice. A table of a
restaurant is a customer of its parent.

Seating is sampled by Gibbs sweeps, on Spark for all dishes of a level at once, given the other dishes' tables of
the sweep before. First every pair of words has one table, and ``BURN`` sweeps seat words and spelling. Given
those, the contexts are seated ``PAIR_BURN`` and ``PAIR_SAMPLES`` times; given their last tables, words and
spelling are seated ``SAMPLES`` times more. Predictive probabilities are averaged over all pairs of a
sample of the contexts and one of the words. Draws follow from a dish's key and the sweep, not from
the rows it meets. Customers after the first 32 of a dish are seated in blocks of up to a sixteenth of
those present, by a normal law where ten or more new tables are expected.

A pair that occurs once always has one table, so only pairs that occur more often are seated. How many
occur once follows from the counts of the words.

A word not seen in training is one event, as in the base score, so both speak of the same outcomes:
its probability is that of a new table with a spelling of none of the known words. The score that
also spells unknown words out is given beside it.

Counts cover the whole corpus. Texts are coded in batches of about ``BATCH`` bytes: a batch's row holds
its dictionary, in order of the words' 64-bit hashes, and its tokens as places in it. Everything else travels as arrays,
one a batch or part and the part it goes to. Words are dealt by ranges of their hashes and numbered; a batch sends
each word once. A batch's distinct pairs of numbers, with their counts, go to parts by context, those of a context of more than
a quarter of ``PART`` customers also by a salt of the next word; a part finds those that occur more often than their batch knows,
and what becomes of them goes the same way back, where a pair is known by its place in the order of the batch. A part has
all pairs of its contexts and seats them in one pass. Only of contexts with salts it has to hear from other parts; these are seated
alone first, to sum their tables after each sweep. The driver holds those sums, of four contexts a part at most, the number
of words of each part, and the spelling counts: at most 257**3 of them whatever the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import SLICE, Hasher, Scratch, as_bytes, mixed, powers, release, runs, slices

BATCH = 16 << 20
BURN, SAMPLES = 3, 4
PAIR_BURN, PAIR_SAMPLES = 1, 2
PART = 1 << 20  # tokens per part of the pairs
NO_PAIR = 0xFFFFFFFF
PAIR_STRENGTH = 1.0  # of the restaurant of a context
STRENGTH = 10.0  # of the word restaurant; its discount follows from the counts
SPELL_STRENGTH, SPELL_DISCOUNT = 1.0, 0.5
EDGE, ALPHABET = 256, 257  # before the first byte and after the last


def held_out(key: Column, parts: int = 7, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def coded(docs: DataFrame) -> DataFrame:
    """Batches of ``docs`` (id, held, text): ids, held, lengths, tokens, words by order of their keys, counts, the place of the end."""
    schema = "batch long, ids array<long>, held array<boolean>, lengths array<long>, tokens binary, words binary, counts binary, end long"

    def work(batches):
        number = TaskContext.get().partitionId() << 24
        table = powers(SLICE + 1)

        def flush():
            hashes, names = [], []  # of each token; where it stands
            for first, last, data, bounds in slices(texts):
                data = data.lower()
                plain = np.frombuffer(data, np.uint8)
                starts, ends = runs(~((plain == 32) | ((plain >= 9) & (plain <= 13))))
                # The end is a word of no bytes after each text.
                n = np.searchsorted(starts, bounds[1:])
                starts, ends = np.insert(starts, n, bounds[1:] - 1), np.insert(ends, n, bounds[1:] - 1)
                lengths.append(np.diff(n, prepend=0) + 1)
                hashes.append(Hasher(plain, table).ranges(starts, ends))
                names.append((data, starts, ends))
            hashes = np.concatenate(hashes)
            order = np.argsort(hashes)
            new = np.concatenate(([True], hashes[order[1:]] != hashes[order[:-1]]))
            place = np.empty(len(order), np.uint32)
            place[order] = np.cumsum(new) - 1
            some = np.sort(order[new])  # one place of each word
            words, begin = [], 0
            for data, starts, ends in names:
                of = some[slice(*np.searchsorted(some, (begin, begin + len(starts))))] - begin
                words += [data[a:z] for a, z in zip(starts[of].tolist(), ends[of].tolist())]
                begin += len(starts)
            by_key = np.argsort(keys_of(words), kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[place[some[by_key]]] = np.arange(len(words))
            words = [words[i] for i in by_key.tolist()]
            tokens, sizes = rank[place], np.concatenate(lengths)
            counts = np.bincount(tokens[np.repeat(~np.array(held, bool), sizes)], minlength=len(words))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
                    pa.array([sizes]), *(pa.array([x], pa.binary()) for x in (pa.compress(tokens.tobytes(), "zstd", asbytes=True), b" ".join(words), counts.tobytes())),
                    pa.array([words.index(b"")], pa.int64()),
                ],
                ["batch", "ids", "held", "lengths", "tokens", "words", "counts", "end"],
            )

        texts, ids, held, lengths, size = [], [], [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for key, out, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), as_bytes(part.column(2))):
                    texts.append(text)
                    ids.append(key)
                    held.append(out)
                    size += len(text)
                    if size >= BATCH:
                        yield flush()
                        number += 1
                        texts, ids, held, lengths, size = [], [], [], [], 0
        if ids:
            yield flush()

    return docs.select("id", "held", "text").mapInArrow(work, schema)


def tokens_of(blob: bytes, lengths: np.ndarray) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, 4 * int(lengths.sum()), "zstd", asbytes=True), np.uint32)


def keys_of(words) -> np.ndarray:
    """Hashes of words, as the function xxhash64 of Spark has them but without a sign."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary cells that hold ``values`` from each of ``ends`` to the next."""
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def cells_of(column, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def joined(arrays: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays])


def steps(places: np.ndarray) -> np.ndarray:
    """Ascending places as steps, which are small."""
    return np.diff(places.astype(np.uint32), prepend=np.uint32(0))


def walked(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint32)


KINDS = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def table_of(schema: str, rows: list[tuple]) -> pa.Table:
    """Rows of numbers and of arrays, which become binary cells."""
    plain = lambda x: x.tobytes() if isinstance(x, np.ndarray) else x
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    return pa.table([pa.array([plain(x) for x in col], KINDS[kind]) for col, kind in zip(zip(*rows), kinds)], names=list(names))


def dealt(batches: DataFrame, parts: int) -> DataFrame:
    """(part, batch, keys, words, counts): the words of each batch by range of keys."""

    def work(rows):
        for batch in rows:
            for number, words, counts in zip(*(column.to_pylist() for column in batch.columns)):
                words = words.split(b" ")
                keys = keys_of(words)
                part = (keys >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)
                bounds = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
                filled = np.flatnonzero(np.diff(bounds))
                ends = np.append(bounds[filled], len(keys))
                names = pa.array([b" ".join(words[a:z]) for a, z in zip(ends, ends[1:])], pa.binary())
                columns = pa.array(filled), pa.array(np.full(len(filled), number)), packed(keys, ends), names, packed(np.frombuffer(counts, np.int64), ends)
                yield pa.RecordBatch.from_arrays(list(columns), ["part", "batch", "keys", "words", "counts"])

    return batches.select("batch", "words", "counts").mapInArrow(work, "part long, batch long, keys binary, words binary, counts binary")


def numbered(words: DataFrame) -> DataFrame:
    """Per part one row of its words in order of their keys (keys, words, n), with their ``size``, customers and kinds, and a row per
    batch: the places of its words in that order (``steps``) and their counts."""
    schema = "part long, batch long, keys binary, words binary, n binary, steps binary, size long, total long, kinds long, whole boolean"

    def work(rows: pa.Table) -> pa.Table:
        keys = cells_of(rows.column("keys"), np.uint64)
        ends = np.cumsum([0] + [len(x) for x in keys])
        keys, n = np.concatenate(keys), np.concatenate(cells_of(rows.column("counts"), np.int64))
        words = [w for blob in rows.column("words").to_pylist() for w in blob.split(b" ")]
        order = np.argsort(keys)
        new = np.concatenate(([True], keys[order[1:]] != keys[order[:-1]]))
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.cumsum(new) - 1
        n = np.add.reduceat(n[order], np.flatnonzero(new))
        first = order[new]
        part = rows.column("part")[0].as_py()
        text = b" ".join([words[i] for i in first.tolist()])
        out = [(part, None, keys[first], text, n, None, len(n), int(n.sum()), int((n > 0).sum()), True)]
        for batch, a, z in zip(rows.column("batch").to_pylist(), ends, ends[1:]):
            out.append((part, batch, None, None, n[rank[a:z]], steps(rank[a:z]), None, None, None, False))
        return table_of(schema, out)

    return words.groupBy("part").applyInArrow(work, schema)


class Pairs:
    """The distinct pairs of a batch in order of part, context and next word.

    ``bounds`` are those of the parts. After the last come pairs that need not be sent: one side is not learned, or it
    is learned once, and that is the pair here.
    """

    def __init__(self, ids: np.ndarray, n: np.ndarray, end: int, held: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, parts: int, floor: int):
        # Each text ends with the end, which is before the first word of the next.
        bits = int(len(ids)).bit_length()
        code = np.empty(len(tokens), np.int64)
        code[:1], code[1:] = end, tokens[:-1]
        code <<= bits
        code |= tokens
        room = int(len(tokens)).bit_length()
        if 2 * bits + room < 64:  # a plain sort is faster
            code <<= room
            code |= np.arange(len(tokens))
            code.sort()
            order = (code & ((1 << room) - 1)).astype(np.int32)
            code >>= room
        else:
            order = np.argsort(code)
            code = code[order]
        new = np.concatenate((code[:1] == code[:1], code[1:] != code[:-1]))
        of = np.empty(len(order), np.int32)
        of[order] = np.cumsum(new, dtype=np.int32) - 1
        del order
        code = code[new]
        left, right = (code >> bits).astype(np.int32), (code & ((1 << bits) - 1)).astype(np.int32)
        del code
        counts = np.bincount(of[np.repeat(~held, lengths)], minlength=len(left)).astype(np.uint32)
        least = np.minimum(n[left], n[right])
        salts = (n // floor + 1).astype(np.uint64)
        wide = ids.astype(np.uint64)
        part = (mixed(mixed(wide + np.uint64(1))[left] + wide[right] % salts[left]) % np.uint64(parts)).astype(np.uint16 if parts < 65535 else np.int64)
        part[(least == 0) | ((least == 1) & (counts == 1))] = parts
        order = np.argsort(part, kind="stable")
        self.left, self.right, self.counts = left[order], right[order], counts[order]
        self.bounds = np.searchsorted(part[order], np.arange(parts + 1))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.tokens = place[of]


def crowd() -> int:
    """Contexts of so many customers go to one part, others to more."""
    return max(1, PART // 4)


def numbers(offsets: np.ndarray) -> type:
    """The type of words' numbers."""
    return np.uint32 if offsets[-1] < 1 << 32 else np.uint64


def named(words: pa.Table, offsets: np.ndarray) -> np.ndarray:
    """The numbers of a batch's words, of which each part (part, steps) tells places; parts in order."""
    kind = numbers(offsets)
    places = zip(words.column("part").to_pylist(), cells_of(words.column("steps"), np.uint32))
    return np.concatenate([walked(x).astype(kind) + kind(offsets[part]) for part, x in places])


def crowded(vocabulary: DataFrame, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the words that are contexts in more than one part; there are at most four a part."""
    floor = crowd()

    def work(batches):
        for batch in batches:
            for part, n in zip(*(column.to_pylist() for column in batch.columns)):
                at = np.flatnonzero(np.frombuffer(n, np.int64) >= floor)
                yield pa.RecordBatch.from_arrays([pa.array(at + offsets[part])], ["id"])

    got = vocabulary.where("whole").select("part", "n").mapInArrow(work, "id long").toArrow()
    return np.sort(got.column(0).to_numpy()).astype(numbers(offsets))


def sent(batches: DataFrame, vocabulary: DataFrame, offsets: np.ndarray, parts: int) -> DataFrame:
    """(part, batch, u, runs, w, c): the pairs of each batch by part; a context ``u`` has a run of next words ``w``."""
    floor = crowd()

    def work(rows: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("part")
        ids = named(words, offsets)
        n = np.concatenate(cells_of(words.column("n"), np.int64))
        number, held, lengths, tokens, end = (rows.column(k)[0].as_py() for k in ("batch", "held", "lengths", "tokens", "end"))
        lengths = np.array(lengths)
        pairs = Pairs(ids, n, end, np.array(held), lengths, tokens_of(tokens, lengths), parts, floor)
        filled = np.flatnonzero(np.diff(pairs.bounds))
        ends = pairs.bounds[np.append(filled, parts)]
        left = pairs.left[: ends[-1]]
        new = np.concatenate((left[:1] == left[:1], left[1:] != left[:-1]))
        new[ends[:-1]] = True
        first = np.flatnonzero(new)
        starts = np.searchsorted(first, ends)
        counts = pairs.counts[: ends[-1]]
        if counts.max(initial=0) < 256:
            counts = counts.astype(np.uint8)
        sizes = np.diff(np.append(first, ends[-1])).astype(np.uint32)
        blobs = packed(ids[left[first]], starts), packed(sizes, starts), packed(ids[pairs.right[: ends[-1]]], ends), packed(counts, ends)
        return pa.table([pa.array(filled), pa.array(np.full(len(filled), number)), *blobs], names=["part", "batch", "u", "runs", "w", "c"])

    rows = batches.select("batch", "held", "lengths", "tokens", "end")
    back = vocabulary.where("NOT whole").select(F.col("batch").alias("of"), "part", "steps", "n")
    return rows.groupBy("batch").cogroup(back.groupBy("of")).applyInArrow(work, "part long, batch long, u binary, runs binary, w binary, c binary")


def gathered(pairs: DataFrame, kind: type) -> DataFrame:
    """Per part one row without a batch, of the pairs that occur more than once (u, w, c) and their words (``ids``, with the
    customers that pairs have beyond one table each, ``less``), and a row per batch: the places in its order (``spot``, as steps)
    of pairs whose count it cannot know, and which of the former each is (``pair``)."""
    schema = "part long, batch long, spot binary, pair binary, u binary, w binary, c binary, ids binary, less binary, n long, n2 long, whole boolean"

    def work(rows: pa.Table) -> pa.Table:
        w = cells_of(rows.column("w"), kind)
        c = [np.frombuffer(x, np.uint8 if len(x) == len(y) else np.uint32) for x, y in zip(rows.column("c").to_pylist(), w)]
        u = [np.repeat(x, n) for x, n in zip(cells_of(rows.column("u"), kind), cells_of(rows.column("runs"), np.uint32))]
        ends = np.cumsum([0] + [len(x) for x in w])
        u, w, c = np.concatenate(u), np.concatenate(w), np.concatenate(c).astype(np.int64)
        if kind is np.uint32:
            order = np.argsort(u.astype(np.uint64) << np.uint64(32) | w)
        else:
            order = np.lexsort((w, u))
        su, sw = u[order], w[order]
        new = np.concatenate(([True], (su[1:] != su[:-1]) | (sw[1:] != sw[:-1])))
        total = np.add.reduceat(c[order], np.flatnonzero(new))
        often = total > 1
        of = np.empty(len(order), np.int32)
        of[order] = np.cumsum(new, dtype=np.int32) - 1
        name = np.where(often, np.cumsum(often) - 1, NO_PAIR).astype(np.uint32)
        su, sw, n = su[new][often], sw[new][often], total[often]
        ids = np.unique(np.concatenate((su, sw)))
        less = np.bincount(np.searchsorted(ids, sw), n - 1, len(ids)).astype(np.int64)
        part = rows.column("part")[0].as_py()
        out = [(part, None, None, None, su, sw, n, ids, less, int(n.sum()), int((n == 2).sum()), True)]
        for batch, a, z in zip(rows.column("batch").to_pylist(), ends, ends[1:]):
            at = of[a:z]
            spot = np.flatnonzero((total[at] > 1) | (total[at] != c[a:z]))
            pair = name[at[spot]]
            out.append((part, batch, steps(spot), np.diff(pair, prepend=np.uint32(0)), *[None] * 7, False))
        return table_of(schema, out)

    return pairs.groupBy("part").applyInArrow(work, schema)


def told(pairs: DataFrame, offsets: np.ndarray, *values: str) -> DataFrame:
    """(part, of, steps, values): the words (``ids``) of each part ``of`` of the pairs by part of the words, with 8 bytes of each of ``values``."""
    kind = numbers(offsets)

    def work(rows):
        for batch in rows:
            for of, ids, *blobs in zip(*(column.to_pylist() for column in batch.columns)):
                ids = np.frombuffer(ids, kind)
                bounds = np.searchsorted(ids, offsets.astype(kind))
                bounds[-1] = len(ids)
                filled = np.flatnonzero(np.diff(bounds))
                ends = np.append(bounds[filled], len(ids))
                place = (ids - np.repeat(offsets[filled].astype(kind), np.diff(ends))).astype(np.uint32)
                step = np.diff(place, prepend=np.uint32(0))
                step[ends[:-1]] = place[ends[:-1]]
                columns = pa.array(filled), pa.array(np.full(len(filled), of)), packed(step, ends), *(packed(np.frombuffer(b, np.int64), ends) for b in blobs)
                yield pa.RecordBatch.from_arrays(list(columns), ["part", "of", "steps", *values])

    rows = pairs.select("part", "ids", *values)
    return rows.mapInArrow(work, "part long, of long, steps binary" + "".join(f", {v} binary" for v in values))


def customers(vocabulary: DataFrame, less: DataFrame) -> DataFrame:
    """Per part of the words its words (keys, words, n), their customers ``c``, which are the tables that contexts have for them,
    and the customers ``left`` beyond the tables that they have as contexts, if ``less`` tells; and how many there are."""
    schema = "part long, keys binary, words binary, n binary, c binary, left binary, total long, n1 long, n2 long"

    def work(rows: pa.Table, less: pa.Table) -> pa.Table:
        part, keys, words, n = (rows.column(k)[0].as_py() for k in ("part", "keys", "words", "n"))
        c = np.frombuffer(n, np.int64).copy()
        left = np.zeros(len(c))
        for at, x in zip(cells_of(less.column("steps"), np.uint32), cells_of(less.column("less"), np.int64)):
            c[walked(at)] -= x
        if "left" in less.column_names:
            for at, x in zip(cells_of(less.column("steps"), np.uint32), cells_of(less.column("left"), np.float64)):
                left[walked(at)] += x
        return table_of(schema, [(part, keys, words, n, c, left, int(c.sum()), int((c == 1).sum()), int((c == 2).sum()))])

    whole = vocabulary.where("whole").select("part", "keys", "words", "n")
    return whole.groupBy("part").cogroup(less.groupBy("part")).applyInArrow(work, schema)


def worded(asked: DataFrame, values: DataFrame) -> DataFrame:
    """(of, part, steps, n, x, y): the values of (part, n, x, y) for the words that ``asked`` (part, of, steps) names."""

    def work(rows: pa.Table, values: pa.Table) -> pa.Table:
        columns = [np.frombuffer(values.column(c)[0].as_py(), np.int64) for c in ("n", "x", "y")]
        at = [walked(x) for x in cells_of(rows.column("steps"), np.uint32)]
        blobs = [pa.array([c[i].tobytes() for i in at], pa.binary()) for c in columns]
        return pa.table([*(rows.column(k) for k in ("of", "part", "steps")), *blobs], names=["of", "part", "steps", "n", "x", "y"])

    schema = "of long, part long, steps binary, n binary, x binary, y binary"
    return asked.groupBy("part").cogroup(values.groupBy("part")).applyInArrow(work, schema)


def paired(groups: DataFrame, answers: DataFrame) -> DataFrame:
    """Per part its pairs (u, w, c) and what their words (ids) were answered: n, log_p, keys."""
    schema = "part long, u binary, w binary, c binary, ids binary, n binary, log_p binary, keys binary"

    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("part")
        blobs = [b"".join(answers.column(k).to_pylist()) for k in ("n", "x", "y")]
        return table_of(schema, [(*(column[0].as_py() for column in rows.columns), *blobs)])

    whole = groups.where("whole").select("part", "u", "w", "c", "ids")
    return whole.groupBy("part").cogroup(answers.groupBy("of")).applyInArrow(work, schema)


class Seats:
    """The pairs of a part, or those of some contexts, and their seats after so many sweeps.

    ``shared`` are contexts that other parts have pairs of as well; ``sums`` has for each sweep so far the customers
    that all pairs of these have beyond their tables.
    """

    def __init__(self, u, w, c, ids, n, log_p, keys, discount: float, shared: np.ndarray, sums: list[np.ndarray], sweeps: int):
        self.c, self.of, after = c, np.searchsorted(ids, u), np.searchsorted(ids, w)
        self.at = after
        place = np.searchsorted(shared, ids)
        there = np.flatnonzero(shared[np.minimum(place, len(shared) - 1)] == ids) if len(shared) else np.zeros(0, np.int64)
        total, names = n[self.of], mixed(keys)[self.of] + keys[after]
        base = np.exp(np.maximum(log_p, -700))[after]
        self.t, self.sum_t = np.ones(len(c), np.int64), np.zeros(len(c), np.int64)
        for number in range(sweeps):
            less = np.bincount(self.of, c - self.t, len(ids))
            if len(there):
                less[there] = sums[number][place[there]]
            # A context of ``total`` customers has ``total`` tables less c - t for each of its pairs.
            self.t = seat(c, PAIR_STRENGTH, discount, total - less[self.of] - self.t, base, names, 1000 + number).astype(np.int64)
            if number >= PAIR_BURN:
                self.sum_t += self.t


def _parts(batches, kind: type):
    """(part, [u, w, c, ids, n, log_p, keys]) of rows of ``paired``."""
    for batch in batches:
        for part, *blobs in zip(*(column.to_pylist() for column in batch.columns)):
            yield part, [np.frombuffer(b, k) for b, k in zip(blobs, (kind, kind, np.int64, kind, np.int64, np.float64, np.uint64))]


def shared_less(pairs: DataFrame, discount: float, shared: np.ndarray, sums: list[np.ndarray]) -> np.ndarray:
    """For contexts that many parts have pairs of, the customers beyond tables after as many sweeps as there are ``sums``."""
    kind = shared.dtype.type

    def work(batches):
        for _, (u, w, c, *words) in _parts(batches, kind):
            place = np.searchsorted(shared, u)
            some = shared[np.minimum(place, len(shared) - 1)] == u
            seats = Seats(u[some], w[some], c[some], *words, discount, shared, sums, len(sums))
            less = np.bincount(place[some], seats.c - seats.t, len(shared)).astype(np.int64)
            at = np.flatnonzero(less)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(less[at])], ["place", "less"])

    got = pairs.mapInArrow(work, "place long, less long").groupBy("place").agg(F.sum("less").alias("less")).toArrow()
    less = np.zeros(len(shared))
    less[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return less


def seated_pairs(pairs: DataFrame, discount: float, shared: np.ndarray) -> DataFrame:
    """Per part, after all sweeps: of each pair its customers less the discounted tables, averaged over samples (``x``), and of its words
    (ids) the customers beyond tables of pairs that end with them (``less``, last sweep) and begin with them (``left``, averaged)."""
    kind, sums, sweeps = shared.dtype.type, [], PAIR_BURN + PAIR_SAMPLES
    if len(shared):
        for _ in range(sweeps):
            sums.append(shared_less(pairs, discount, shared, sums))
    schema = "part long, x binary, ids binary, less binary, left binary"

    def work(batches):
        for part, (u, w, c, ids, *words) in _parts(batches, kind):
            seats = Seats(u, w, c, ids, *words, discount, shared, sums, sweeps)
            tables = seats.sum_t / PAIR_SAMPLES
            less = np.bincount(seats.at, c - seats.t, len(ids)).astype(np.int64)
            row = part, c - discount * tables, ids, less, np.bincount(seats.of, c - tables, len(ids)).astype(np.float64)
            yield from table_of(schema, [row]).to_batches()

    return pairs.mapInArrow(work, schema)


def returned(groups: DataFrame, pairs: DataFrame, once: float) -> DataFrame:
    """(of, part, spots, own): for batch ``of`` the values ``x`` of (part, x), or ``once`` for a pair that occurs once."""

    def work(rows: pa.Table, values: pa.Table) -> pa.Table:
        x = np.append(np.frombuffer(values.column("x")[0].as_py(), np.float64), once)
        own = [x[np.minimum(walked(n), len(x) - 1)].tobytes() for n in cells_of(rows.column("pair"), np.uint32)]
        return pa.table([rows.column("batch"), rows.column("part"), rows.column("spot"), pa.array(own, pa.binary())], names=["of", "part", "spots", "own"])

    rows = groups.where("NOT whole").select("part", "batch", "spot", "pair")
    return rows.groupBy("part").cogroup(pairs.select("part", "x").groupBy("part")).applyInArrow(work, "of long, part long, spots binary, own binary")


def uniform(keys: np.ndarray, seed: int, step: int, which: int) -> np.ndarray:
    """Numbers between 0 and 1 that follow from keys, seed and step."""
    salt = (np.uint64(seed) << np.uint64(40)) + (np.uint64(step) << np.uint64(1)) + np.uint64(which)
    bits = mixed(mixed(keys) + mixed(np.atleast_1d(salt)))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def drawn(n: np.ndarray, share: np.ndarray, keys: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Binomial draws: by their sums up to a mean of ten, by a normal law beyond."""
    low = np.minimum(share, 1 - share)
    mean, u = n * low, uniform(keys, seed, step, 0)
    turn = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * uniform(keys, seed, step, 1))
    out = np.clip(np.rint(mean + turn * np.sqrt(mean * (1 - low))), 0, n)
    few = np.flatnonzero(mean < 10)
    count, chance, odds = np.zeros(len(few)), (1 - low[few]) ** n[few], low[few] / (1 - low[few])
    below, more = chance.copy(), np.arange(len(few))
    while len(more := more[(u[few[more]] > below[more]) & (count[more] < n[few[more]])]):
        chance[more] *= (n[few[more]] - count[more]) / (count[more] + 1) * odds[more]
        count[more] += 1
        below[more] += chance[more]
    out[few] = count
    return np.where(share > 0.5, n - out, out)


def seat(c: np.ndarray, strength, discount: float, others, base: np.ndarray, keys: np.ndarray, seed: int) -> np.ndarray:
    """Tables that ``c`` customers of each dish open, seated one after another (later in blocks)."""
    strength, others = np.broadcast_to(strength, c.shape), np.broadcast_to(others, c.shape)
    tables = np.minimum(c, 1).astype(np.float64)
    live, k = np.flatnonzero(c > 1), 1
    while len(live):
        step = max(1, k // 16)
        new = (strength[live] + discount * (others[live] + tables[live])) * base[live]
        share = new / (k - discount * tables[live] + new)
        if step == 1:
            tables[live] += uniform(keys[live], seed, k, 0) < share
        else:
            tables[live] += drawn(np.minimum(step, c[live] - k), share, keys[live], seed, k)
        k += step
        live = live[c[live] > k]
    return tables


def usual_discount(once: float, twice: float) -> float:
    """The usual estimate from how many dishes have one customer and two."""
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


class Spelling:
    """Restaurants over the bytes of words: contexts of two, one and no bytes."""

    def __init__(self):
        none = np.zeros(0)
        self.cells = np.zeros(0, np.int64)
        self.c2 = self.t2 = none
        self.p1 = np.full((ALPHABET, ALPHABET), 1 / ALPHABET)
        self.contexts, self.total2, self.tables2 = np.zeros(0, np.int64), none, none

    def seated(self, cells: np.ndarray, c2: np.ndarray, seed: int) -> Spelling:
        """New seats for ``c2`` customers at ``cells`` (context and byte), given the present ones."""
        order = np.argsort(cells)
        cells, c2 = cells[order], c2[order]
        new, s, d = Spelling(), SPELL_STRENGTH, SPELL_DISCOUNT
        context, byte = cells // ALPHABET, cells % ALPHABET
        near = context % ALPHABET
        new.contexts, row = np.unique(context, return_inverse=True)
        # Tables of the same context before this sweep, less those of the dish itself.
        others = self._of(self.contexts, self.tables2, context) - self._of(self.cells, self.t2, cells)
        t2 = seat(c2, s, d, others, self.p1[near, byte], cells.astype(np.uint64), seed)
        new.cells, new.c2, new.t2 = cells, c2.astype(np.float64), t2
        new.total2, new.tables2 = np.bincount(row, c2), np.bincount(row, t2)
        c1 = np.zeros((ALPHABET, ALPHABET))
        np.add.at(c1, (near, byte), t2)
        p0 = np.full(ALPHABET, 1 / ALPHABET)
        # Keys beyond those of longer contexts.
        keys = np.arange(ALPHABET**2 + ALPHABET, dtype=np.uint64) + np.uint64(ALPHABET**3)
        for turn in range(2):  # both parents, seated twice so that each has seen the other
            t1 = seat(c1.ravel().astype(np.int64), s, d, 0.0, np.tile(p0, ALPHABET), keys, 2 * seed + turn).reshape(c1.shape)
            c0 = t1.sum(0)
            t0 = seat(c0.astype(np.int64), s, d, 0.0, np.full(ALPHABET, 1 / ALPHABET), keys[ALPHABET**2 :], 2 * seed + turn)
            p0 = (c0 - d * t0 + (s + d * t0.sum()) / ALPHABET) / (s + c0.sum())
        new.p1 = (c1 - d * t1 + (s + d * t1.sum(1, keepdims=True)) * p0) / (s + c1.sum(1, keepdims=True))
        return new

    @staticmethod
    def _of(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0.0)

    def log(self, cells: np.ndarray) -> np.ndarray:
        """Natural log of each byte's probability in its context."""
        s, d = SPELL_STRENGTH, SPELL_DISCOUNT
        context = cells // ALPHABET
        own = self._of(self.cells, self.c2 - d * self.t2, cells)
        total, tables = self._of(self.contexts, self.total2, context), self._of(self.contexts, self.tables2, context)
        return np.log((own + (s + d * tables) * self.p1[context % ALPHABET, cells % ALPHABET]) / (s + total))


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(cells, starts): for each byte of each word, and its end, context and byte as one number."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    # Two edge symbols before a word, one after.
    starts = np.concatenate(([0], np.cumsum(lengths + 3)))
    code = np.full(starts[-1], EDGE, np.int64)
    at = np.arange(lengths.sum()) + np.repeat(starts[:-1] + 2 - (np.cumsum(lengths) - lengths), lengths)
    code[at] = np.frombuffer(b"".join(words), np.uint8)
    cells = (code[:-2] * ALPHABET + code[1:-1]) * ALPHABET + code[2:]
    keep = np.arange(lengths.sum() + len(words)) + np.repeat(2 * np.arange(len(words)), lengths + 1)
    return cells[keep], np.concatenate(([0], np.cumsum(lengths + 1)))


def distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells in order, and which of them each is."""
    place = np.zeros(ALPHABET**3, bool)
    place[cells] = True
    values = np.flatnonzero(place)
    row = np.empty(ALPHABET**3, np.int32)  # memory is taken where cells are
    row[values] = np.arange(len(values), dtype=np.int32)
    return values, row[cells]


MASS = 1 << 40  # known words' share of the spelling model is summed in these units


class Sweep:
    """The state after a sweep: tables of the word restaurant and the spelling model.

    ``known`` is the share of the spelling model that known words have; the next sweep finds it.
    """

    def __init__(self, number: int, tables: float, spelling: Spelling):
        self.number, self.tables, self.spelling, self.known = number, tables, spelling, 0.0

    def seats(self, c: np.ndarray, log_base: np.ndarray, discount: float, keys: np.ndarray) -> np.ndarray:
        """Tables of each word in the next sweep."""
        return seat(c, STRENGTH, discount, self.tables, np.exp(np.maximum(log_base, -700)), keys, self.number)


def _rows(batches, size: int = 100_000):
    """(part, words, c, keys) of rows of ``customers``, so many words at a time."""
    for batch in batches:
        for part, words, c, keys in zip(*(batch.column(i).to_pylist() for i in range(4))):
            words, c, keys = words.split(b" "), np.frombuffer(c, np.int64), np.frombuffer(keys, np.uint64)
            for a in range(0, len(words), size):
                yield part, words[a : a + size], c[a : a + size], keys[a : a + size]


def sweep(types: DataFrame, state: Sweep, discount: float) -> Sweep:
    """One Gibbs sweep over all words (rows of ``customers``)."""
    shared = types.sparkSession.sparkContext.broadcast(_plain(state))

    def work(batches):
        state = _state(shared.value)
        for _, words, c, keys in _rows(batches):
            known = np.flatnonzero(c > 0)
            if not len(known):
                continue
            words, c, keys = [words[i] for i in known.tolist()], c[known], keys[known]
            cells, starts = spelled(words)
            values, row = distinct(cells)
            log_base = np.add.reduceat(state.spelling.log(values)[row], starts[:-1])
            tables, base = state.seats(c, log_base, discount, keys), np.exp(log_base)
            n = np.bincount(row, np.repeat(tables, np.diff(starts))).astype(np.int64)
            cells = pa.array(np.concatenate((values, [-1, -2])))
            sums = [int(tables.sum()), round(float(base.sum()) * MASS)]
            yield pa.RecordBatch.from_arrays([cells, pa.array(np.concatenate((n, sums)))], ["cell", "n"])

    rows = types.select("part", "words", "c", "keys").mapInArrow(work, "cell long, n long")
    got = rows.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toArrow()
    cells, n = got.column(0).to_numpy(), got.column(1).to_numpy()
    whole = cells >= 0
    shared.unpersist()
    state.known = min(1.0, float(n[cells == -2].sum()) / MASS)
    return Sweep(state.number + 1, float(n[cells == -1].sum()), state.spelling.seated(cells[whole], n[whole], state.number + 1))


def _plain(state: Sweep) -> tuple:
    # Plain arrays: a broadcast names classes, and workers may not have this package.
    return state.number, state.tables, vars(state.spelling)


def _state(plain: tuple) -> Sweep:
    spelling = Spelling.__new__(Spelling)
    spelling.__dict__.update(plain[2])
    return Sweep(plain[0], plain[1], spelling)


def valued(types: DataFrame, states: list[Sweep], discount: float, total: int, beside: str) -> DataFrame:
    """(part, n, x, y): natural logs ``x`` of the predictive probabilities of words (rows of ``customers``) averaged over sweeps, and the column ``beside``.

    ``states`` are consecutive; all but the first are samples. The seats of a sweep follow from the
    state before it and are drawn again.
    """
    shared = types.sparkSession.sparkContext.broadcast([_plain(s) for s in states])
    schema = "part long, n binary, x binary, y binary"

    def work(batches):
        states = [_state(s) for s in shared.value]

        def logs(words, c, keys):
            # In logs: long words have tiny bases.
            mean = np.full(len(words), -np.inf)
            known = np.flatnonzero(c > 0)
            cells, starts = spelled(words)
            values, row = distinct(cells)
            base = np.add.reduceat(states[0].spelling.log(values)[row], starts[:-1])
            for before, after in zip(states, states[1:]):
                tables = np.zeros(len(words))
                if len(known):
                    tables[known] = before.seats(c[known], base[known], discount, keys[known])
                base = np.add.reduceat(after.spelling.log(values)[row], starts[:-1])
                own = np.log(np.maximum(c - discount * tables, 0), out=np.full(len(c), -np.inf), where=c - discount * tables > 0)
                p = np.logaddexp(own, np.log(STRENGTH + discount * after.tables) + base) - np.log(STRENGTH + total)
                mean = np.logaddexp(mean, p)
            return mean - np.log(len(states) - 1)

        for batch in batches:
            for i in range(batch.num_rows):
                part, *_, n, y = (column[i].as_py() for column in batch.columns)
                x = np.concatenate([logs(*row) for _, *row in _rows([batch.slice(i, 1)])])
                yield from table_of(schema, [(part, n, x, y)]).to_batches()

    return types.select("part", "words", "c", "keys", "n", F.col(beside).alias("y")).mapInArrow(work, schema)


def score(
    scratch: Scratch, docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", burn: int = BURN, samples: int = SAMPLES
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, spelled_score, perplexity).

    The model learns from rows where ``held`` is false. A null text is empty: its one token is the
    end. Without training rows every word is the one unknown event, with probability 1. Rows are scored one by
    one, also those that repeat. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), held.alias("held"), F.col(text).alias("text"))
    batches = scratch.keep(coded(rows), "batches", compression="zstd")
    tokens = batches.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    parts = -(-tokens // PART) or 1
    # Words are numbered by part, and in it by key.
    vocabulary = scratch.keep(numbered(dealt(batches, parts)), "words", by=("whole",), compression="zstd")
    sizes = np.zeros((parts, 3), np.int64)
    for row in vocabulary.where("whole").select("part", "size", "total", "kinds").toLocalIterator():
        sizes[row["part"]] = row[1:]
    total, kinds = int(sizes[:, 1].sum()), int(sizes[:, 2].sum())
    offsets = np.concatenate(([0], np.cumsum(sizes[:, 0])))
    shared = crowded(vocabulary, offsets)

    # Batches know the counts of pairs that occur nowhere else.
    groups = scratch.keep(gathered(sent(batches, vocabulary, offsets, parts), numbers(offsets)), "groups", by=("whole",), compression="zstd")
    release(scratch.spark)
    sizes = groups.where("whole").agg(F.sum("n").alias("n"), F.sum("n2").alias("n2")).first()
    pair_discount = usual_discount(total - (sizes["n"] or 0), sizes["n2"] or 0)

    first = told(groups.where("whole"), offsets, "less")
    start = scratch.keep(customers(vocabulary, first), "customers-0", compression="zstd")
    sizes = start.agg(F.sum("total").alias("n"), F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).first()
    discount = usual_discount(sizes["n1"] or 0, sizes["n2"] or 0)

    states = [Sweep(0, 0.0, Spelling())]
    for _ in range(max(1, burn)):
        states.append(sweep(start, states[-1], discount))
    parent = valued(start, states[-2:], discount, sizes["n"] or 0, "keys")
    pairs = scratch.keep(paired(groups, worded(first.drop("less"), parent)), "pairs", compression="zstd")
    scratch.drop("customers-0", "groups/whole=true")
    seats = scratch.keep(seated_pairs(pairs, pair_discount, shared), "seats", compression="zstd")
    scratch.drop("pairs")

    final = scratch.keep(customers(vocabulary, told(seats, offsets, "less", "left")), "customers-1", compression="zstd")
    served = final.agg(F.sum("total")).first()[0] or 0
    states = states[-1:]
    for _ in range(samples + 1):  # the last one tells the share of known words before it
        states.append(sweep(final, states[-1], discount))
    states = states[:-1]
    unknown = np.mean([(STRENGTH + discount * s.tables) / (STRENGTH + served) * max(1 - s.known, 1e-12) for s in states[1:]])
    unknown = float(np.log(unknown))
    known = scratch.keep(valued(final, states, discount, served, "left"), "valued", compression="zstd")

    scratch.drop("customers-1", "words/whole=true")
    release(scratch.spark)
    home = scratch.keep(returned(groups, seats, 1 - pair_discount), "own", compression="zstd")
    scratch.drop("groups", "seats")
    release(scratch.spark)
    asked = vocabulary.where("NOT whole").select("part", F.col("batch").alias("of"), "steps")
    values = worded(asked, known).unionByName(home, allowMissingColumns=True)
    schema = T.StructType(
        [T.StructField(key, T.LongType()), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "spelled_score", "perplexity")]
    )
    ln10, floor = float(np.log(10)), crowd()

    def work(part: pa.Table, right: pa.Table) -> pa.Table:
        word = right.filter(pc.is_valid(right.column("steps"))).sort_by("part")
        c, log_p, left = (np.concatenate(cells_of(word.column(m), t)) for m, t in {"n": np.int64, "x": np.float64, "y": np.float64}.items())
        # What a context leaves to its parent.
        back = np.where(c > 0, np.log((PAIR_STRENGTH + pair_discount * (c - left)) / (PAIR_STRENGTH + c)), 0.0)
        lengths, held = (np.array(part.column(name)[0].as_py()) for name in ("lengths", "held"))
        end, tokens = part.column("end")[0].as_py(), tokens_of(part.column("tokens")[0].as_py(), lengths)
        pairs = Pairs(named(word, offsets), c, end, held, lengths, tokens, parts, floor)
        before, after, tokens = pairs.left, pairs.right, pairs.tokens
        own = np.where(pairs.counts == 1, 1 - pair_discount, 0.0)
        known = right.filter(pc.is_valid(right.column("own"))).select(["part", "spots", "own"])
        for number, spots, x in zip(*(column.to_pylist() for column in known.columns)):
            own[pairs.bounds[number] + walked(np.frombuffer(spots, np.uint32)).astype(np.int64)] = np.frombuffer(x, np.float64)
        own = np.log(own, out=np.full(len(own), -np.inf), where=own > 0) - np.log(PAIR_STRENGTH + c[before])
        sums = lambda v: np.add.reduceat(v[tokens], np.cumsum(lengths) - lengths)
        mixture = lambda base: sums(np.logaddexp(own, back[before] + base[after])) / ln10
        scores = mixture(np.where(c > 0, log_p, unknown))
        return pa.table(
            [
                pa.array(part.column("ids")[0].as_py(), pa.int64()), pa.array(held, pa.bool_()),
                pa.array(lengths), pa.array(sums((c > 0).astype(np.int64)[after])), pa.array(np.full(len(lengths), total, np.int64)),
                pa.array(sums(np.log10((c + 1) / (total + kinds + 1))[after])), pa.array(scores), pa.array(mixture(log_p)),
                pa.array(10 ** np.minimum(-scores / lengths, 300)),
            ],
            names=schema.names,
        )

    slim = batches.select("batch", "ids", "held", "lengths", "tokens", "end")
    return slim.groupBy("batch").cogroup(values.groupBy("of")).applyInArrow(work, schema)
