"""Sampled SentencePiece segmentations without replacement, and their decoding.

The pieces of a SentencePiece model span a lattice over each text; a segmentation is a path. The k
samples of a text are the k paths of largest log probability plus Gumbel noise. They are found by
A* search from the root down: the noise of a set of paths is drawn at once (it is a Gumbel variable at the
log of the set's mass), and a set is split into the path that has the maximum and, at each piece of
it, the rest that turns off there; a rest's maximum is a Gumbel variable below that of the set. The
best rest is the next sample. Its bound left over after k samples gives the inclusion scores.

A piece never has a space after another character and never a line feed, so the lattice is a chain
of small ones, each shared by all equal chunks of a batch of texts; they are built, summed backwards
and walked in numpy for all at once. All noise is hashed from the row's key, the sample and the
place in the text: samples do not depend on batches, tasks or reruns.

Models with merge ranks for scores (BPE) have no probabilities. Pieces get weights by Zipf's law on
the rank, ``1 / (rank + 20)`` to the power ``alpha``. Characters without a piece are spelled in bytes.
"""

from __future__ import annotations

import heapq
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import Hasher, as_bytes, mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 1.0
BATCH = 5 << 19  # bytes of text that share lattices
TOGETHER = 1 << 17  # chunks of a batch that are walked at once
SPACE = "▁"
LONG = 64  # characters of a chunk that is cut into parts
WINDOW = 128  # places of a path that are looked at first
_CHUNK = re.compile(r" *[^ \n]+| +|\n")
_LOUDEST = 37.0  # above any Gumbel noise made from 53 random bits

RESULT = T.StructType(
    [T.StructField("rank", T.IntegerType()), T.StructField("n_pieces", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in ("log_prob", "perturbed", "log_inclusion")]
    + [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
)


def vocabulary(model_file: str = MODEL, alpha: float = ALPHA) -> dict:
    """The model's pieces as plain arrays: hashes, ids, log weights, bytes, and the byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    byte_ids = np.zeros(256, np.int64)
    text, usable = [b""] * n, []
    for i, name in enumerate(names):
        if sp.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            text[i] = bytes([int(name[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            text[i] = name.replace(SPACE, " ").encode()
            usable.append(i)
            if re.search(r"[^ ] |\n.|.\n", name.replace(SPACE, " ")):
                raise ValueError(f"piece {name!r} does not end where chunks end")
    weights = -alpha * np.log(20 + np.minimum([-sp.get_score(i) for i in range(n)], 2.0 * n))
    weights[byte_ids] = -alpha * np.log(20 + n)
    strings = [text[i].decode() for i in usable]
    lengths = np.array([len(s) for s in strings])
    codes = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    ends = np.cumsum(lengths)
    hashes = Hasher(codes).plain(ends - lengths, ends)
    order = np.argsort(hashes)
    seen = np.zeros(1 << 20, np.uint8)  # by first bits: 1 for pieces, 2 for what they begin with
    sums = Hasher(codes)
    for size in range(1, int(lengths.max())):
        long = (ends - lengths)[lengths > size]
        seen[sums.plain(long, long + size) >> np.uint64(44)] |= 2
    seen[hashes >> np.uint64(44)] |= 1
    firsts, at, most = np.unique(hashes[order] >> np.uint64(44), return_index=True, return_counts=True)
    slots = np.zeros(1 << 20, np.int32)  # the first piece with these first bits
    slots[firsts] = at
    sizes = np.array([len(t) for t in text])
    return {
        "hashes": hashes[order], "seen": seen, "slots": slots, "most": int(most.max()), "ids": np.array(usable, np.int32)[order], "weights": weights, "byte_ids": byte_ids,
        "longest": int(lengths.max()), "sizes": sizes, "starts": np.cumsum(sizes) - sizes, "text": np.frombuffer(b"".join(text), np.uint8),
    }


def decode(vocab: dict, ids: np.ndarray) -> bytes:
    """Bytes that pieces spell, with the space that every text begins with."""
    sizes = vocab["sizes"][ids]
    at = np.repeat(vocab["starts"][ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return vocab["text"][at].tobytes()


class Lattices:
    """The lattices of distinct chunks. A node is a place in a chunk; edges leave it, longest first."""

    def __init__(self, vocab: dict, chunks: list[str]):
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(codes))  # characters to the chunk's end
        sums = Hasher(codes)
        starts, spans, ids = [], [], []
        at = np.arange(len(codes))
        for span in range(1, vocab["longest"] + 1):
            at = at[left[at] >= span]
            keys = sums.plain(at, at + span)
            # Bit 0: some piece has this hash's first bits; bit 1: some piece may begin so.
            state = vocab["seen"][keys >> np.uint64(44)]
            maybe = np.flatnonzero(state & 1)
            some, keys = at[maybe], keys[maybe]
            at = at[state > 1]
            # Pieces with the same first bits stand side by side.
            row = vocab["slots"][keys >> np.uint64(44)]
            hit = vocab["hashes"][row] == keys
            for _ in range(1, vocab["most"]):
                miss = np.flatnonzero(~hit)
                row[miss] = np.minimum(row[miss] + 1, len(vocab["hashes"]) - 1)
                hit[miss] = vocab["hashes"][row[miss]] == keys[miss]
            starts.append(some[hit].astype(np.int32))
            spans.append(np.full(hit.sum(), span, np.int32))
            ids.append(vocab["ids"][row[hit]])
        # What is not needed any more goes at once: a worker's memory is that of its largest moment.
        del sums, left, at, keys, state, maybe, some, row, hit
        lone = np.ones(len(codes), bool)
        lone[starts[0]] = False
        lone = np.flatnonzero(lone).astype(np.int32)  # spelled in bytes
        starts.append(lone)
        spans.append(np.ones(len(lone), np.int32))
        ids.append(np.full(len(lone), -1, np.int32))
        # Edges of a node side by side, longest first.
        count = np.zeros(len(codes) + 1, np.int32)
        for x in starts:
            count[x] += 1
        self.first = np.concatenate(([0], np.cumsum(count[:-1], dtype=np.int32)))
        size = int(self.first[-1])
        self.start, self.span, self.id = (np.empty(size, np.int32) for _ in range(3))
        free = self.first[:-1].copy()
        while starts:
            x, n, i = starts.pop(), spans.pop(), ids.pop()
            to = free[x]
            self.start[to], self.span[to], self.id[to] = x, n, i
            free[x] += 1
        del x, n, i, to, free, count
        # Parts: chunks, and long chunks cut where no piece crosses. Paths are the same, but parts are
        # worked on side by side.
        inside = np.repeat(lengths > LONG, lengths)
        if inside.any():
            wide = np.flatnonzero(self.span > 1)
            crossed = np.zeros(len(codes) + 1, np.int64)
            np.add.at(crossed, self.start[wide] + 1, 1)
            np.add.at(crossed, self.start[wide] + self.span[wide], -1)
            inside &= np.cumsum(crossed)[:-1] == 0
            del wide, crossed
        inside[ends - lengths] = True
        self.heads = np.flatnonzero(inside)  # first node of a part
        self.ends = np.append(self.heads[1:], len(codes))
        lengths = self.ends - self.heads
        left = np.repeat(self.ends, lengths)
        left -= np.arange(len(codes))
        self.parts = np.append(np.searchsorted(self.heads, ends - np.diff(ends, prepend=0)), len(self.heads))  # first part of a chunk
        byte_count = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        weight = vocab["weights"][self.id]
        spelled = np.flatnonzero(self.id < 0)
        weight[spelled] = byte_count[self.start[spelled]] * vocab["weights"][vocab["byte_ids"][0]]
        self.codes = codes
        # Log mass of all paths to the part's end, from the last characters to the first.
        mass = np.zeros(len(codes) + 1)
        # (Short keys sort faster.)
        short = np.int16 if lengths.max(initial=0) < 1 << 15 else np.int64
        deepest = np.argsort(left.astype(short), kind="stable").astype(np.int32)
        levels = np.searchsorted(left[deepest], np.arange(1, int(lengths.max(initial=0)) + 2))
        goal = self.start + self.span
        final = self.span == left[self.start]
        del left
        for a, b in zip(levels, levels[1:]):
            nodes = deepest[a:b]
            if not len(nodes):
                break
            n = self.first[nodes + 1] - self.first[nodes]
            cuts = np.cumsum(n, dtype=np.int64) - n
            edges = np.repeat(self.first[nodes] - cuts, n) + np.arange(n.sum())
            value = weight[edges] + np.where(final[edges], 0.0, mass[goal[edges]])
            top = np.maximum.reduceat(value, cuts)
            mass[nodes] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, n)), cuts))
        del deepest
        after = mass[goal]
        after[final] = 0.0
        weight += after
        del goal, final, after
        weight -= mass[self.start]
        self.log_p = weight
        sums = np.zeros(size + 1)
        np.exp(weight, out=sums[1:])
        np.cumsum(sums[1:], out=sums[1:])
        self.upto = sums[1:]  # chances of a node's edges, summed up
        self.upto -= sums[self.first[self.start]]
        last = self.first[1:] - 1
        self.upto[last] = 2.0  # the last edge takes what rounding leaves
        self.lone = (self.first[1:] - self.first[:-1] == 1)[self.start]

    def parts_of(self, chunks: np.ndarray) -> np.ndarray:
        """The parts of some chunks, in order."""
        first, n = self.parts[chunks], self.parts[chunks + 1] - self.parts[chunks]
        return first if len(first) == n.sum() else np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())

    def walk(self, nodes: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of a path from each node to its end, one path after another, and paths' lengths."""
        order = np.argsort(nodes, kind="stable")  # equal chunks together
        nodes, ends, seeds = nodes[order], ends[order], seeds[order]
        live, steps = np.arange(len(nodes)), []
        count = np.zeros(len(nodes), np.int64)
        begin = nodes.copy()
        while len(live):
            at = nodes[live]
            u = uniform(seeds[live] + (at - begin[live]).astype(np.uint64))
            edge = self.first[at]
            more = np.flatnonzero(u > self.upto[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] > self.upto[edge[more]]]
            steps.append((live.astype(np.int32), edge.astype(np.int32)))
            count[live] += 1
            nodes[live] = at + self.span[edge]
            live = live[nodes[live] < ends[live]]
        lengths = np.empty(len(order), np.int64)
        lengths[order] = count
        offset = (np.cumsum(lengths) - lengths)[order]
        out = np.empty(lengths.sum(), np.int32)
        for k, (live, edge) in enumerate(steps):
            out[offset[live] + k] = edge
            steps[k] = None
        return out, lengths


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1, neither included, hashed from 64-bit values."""
    return ((mixed(x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


_ALL = (1 << 64) - 1


def _mixed(x: int) -> int:
    """``mixed`` for one number."""
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & _ALL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
    return x ^ x >> 31


def _seed(row: int, sample: int) -> np.uint64:
    return np.uint64(_mixed(row * 1_000_003 + sample & _ALL))


def _one(row: int, sample: int) -> float:
    """``uniform`` of a seed."""
    return ((_mixed(int(_seed(row, sample)) * 0x9E3779B97F4A7C15 & _ALL) >> 12) + 0.5) / (1 << 52)


class Search:
    """Samples of one text: paths found and the agenda of rests."""

    def __init__(self, row: int):
        self.row = row
        self.paths: list[tuple[np.ndarray, float, float]] = []  # edges, log_prob, perturbed
        self.agenda: list[tuple] = []  # (-bound, path, place, edges taken there, log mass before)

    def pop(self, lattices: Lattices) -> tuple[int, int, int, float] | None:
        """(path, place, edge to take there, perturbed value) of the best rest; what is left stays."""
        if not self.agenda:
            return None
        value, path, place, taken, before = heapq.heappop(self.agenda)
        node = int(lattices.start[taken[0]])
        a, b = int(lattices.first[node]), int(lattices.first[node + 1])
        others = [(e, math.exp(x)) for e, x in enumerate(lattices.log_p[a:b].tolist(), a) if e not in taken]
        total = sum(p for _, p in others)
        u = _one(self.row, 2000 + len(self.paths)) * total
        for edge, p in others:  # noqa: B007
            u -= p
            if u <= 0:
                break
        left = total - p
        if len(others) > 1 and left > 0:
            noise = -math.log(_one(self.row, 3000 + len(self.paths)))
            bound = -np.logaddexp(value, np.log(noise) - before - np.log(left))
            heapq.heappush(self.agenda, (-bound, path, place, (*taken, edge), before))
        return path, place, edge, -value


def rests(
    lattices: Lattices, edges: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begin: np.ndarray, bounds: np.ndarray, seeds: np.ndarray, wanted: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For paths that stand one after another in ``edges``, their ``wanted`` best rests from place ``begin`` on.

    (values, places, log masses before them), a row per path; a value is minus infinity where there
    are fewer. What turns off a path at a place has a Gumbel variable below the path's bound.
    """
    paths = len(starts)
    best = np.full((paths, wanted), -np.inf)
    places, masses = np.zeros((paths, wanted), np.int64), np.zeros((paths, wanted))
    before = np.array([lattices.log_p[edges[a : a + n]].sum() if n else 0.0 for a, n in zip(starts.tolist(), begin.tolist())])
    at, live, width = begin.copy(), np.flatnonzero(begin < sizes), WINDOW
    while len(live):
        redo = []
        # About as many cells at once whatever the window.
        for some in np.array_split(live, -(-len(live) * width // (1 << 18))):
            place = at[some, None] + np.arange(width)
            inside = place < sizes[some, None]
            edge = edges[np.where(inside, starts[some, None] + place, 0)]
            log_p = np.where(inside, lattices.log_p[edge], 0.0)
            upto = np.concatenate((before[some, None], log_p), 1).cumsum(1)
            with np.errstate(divide="ignore"):
                rest = upto[:, :-1] + np.log(np.maximum(-np.expm1(log_p), 1e-300))
                noise = np.log(-np.log(uniform(seeds[some, None] + place.astype(np.uint64))))
            value = -np.logaddexp(-bounds[some, None], noise - rest)
            value[~inside | lattices.lone[edge]] = -np.inf  # a lone edge leaves no rest
            value = np.concatenate((best[some], value), 1)
            top = np.argpartition(value, -wanted, axis=1)[:, -wanted:]
            best[some] = np.take_along_axis(value, top, 1)
            places[some] = np.take_along_axis(np.concatenate((places[some], place), 1), top, 1)
            masses[some] = np.take_along_axis(np.concatenate((masses[some], upto[:, :-1]), 1), top, 1)
            before[some], at[some] = upto[:, -1], at[some] + width
            # No rest further on can be larger: its mass is under that of the path so far.
            redo.append(some[(at[some] < sizes[some]) & (before[some] + _LOUDEST >= best[some].min(1))])
        live, width = np.concatenate(redo), 2 * width
    return best, places, masses


class _Numbers(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def sample(vocab: dict, texts: list[str], rows: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to ``k`` distinct samples: (ids, log_prob, perturbed, log_inclusion)."""
    numbers = _Numbers()
    chunks = [np.array(list(map(numbers.__getitem__, _CHUNK.findall(" " + t))) if t else [], np.int64) for t in texts]
    lattices = Lattices(vocab, list(numbers))
    del numbers
    sizes = np.array([len(c) for c in chunks])
    turn = (np.cumsum(sizes) - sizes) // TOGETHER  # the texts whose chunks begin in a stretch of so many
    cuts = [*np.flatnonzero(np.diff(turn, prepend=-1)).tolist(), len(chunks)]
    out = []
    for a, z in zip(cuts, cuts[1:]):
        out += walked(vocab, lattices, [lattices.parts_of(c) for c in chunks[a:z]], rows[a:z], k)
    return out


def walked(vocab: dict, lattices: Lattices, parts: list[np.ndarray], rows: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """``sample`` for texts that are given as parts of lattices."""
    searches = [Search(r) for r in rows]
    lengths = lattices.ends - lattices.heads
    nothing = np.zeros(0, np.int64)
    jobs = [(i, nothing, c, 0, -math.log(-math.log(_one(r, 0)))) for i, (c, r) in enumerate(zip(parts, rows)) if len(c)]
    for number in range(k):
        # A job: text, edges before, parts still to walk, characters before, perturbed value.
        if not jobs:
            break
        sizes = np.array([len(todo) for _, _, todo, _, _ in jobs])
        todo = np.concatenate([todo for _, _, todo, _, _ in jobs])
        nodes, ends = lattices.heads[todo], lattices.ends[todo]
        # Where in the text each part ends; a walk may begin inside its first part.
        upto, first = np.concatenate(([0], np.cumsum(lengths[todo]))), np.cumsum(sizes) - sizes
        wholes = np.array([lengths[parts[job[0]]].sum() for job in jobs])
        place = upto[:-1] + np.repeat(wholes - upto[first + sizes], sizes)
        gone, some = np.array([job[3] for job in jobs]), np.flatnonzero(sizes)
        inside = gone[some] - place[first[some]]
        nodes[first[some]] += inside
        place[first[some]] += inside
        # Only the seed tells where in the text a part stands.
        seeds = np.array([_seed(searches[job[0]].row, 1 + number) for job in jobs], np.uint64)
        taken, counts = lattices.walk(nodes, ends, np.repeat(seeds, sizes) + place.astype(np.uint64))
        upto = np.concatenate(([0], np.cumsum(counts)))
        cuts = upto[np.concatenate((first, [len(todo)]))]
        paths = [np.concatenate((job[1], taken[a:b])) if len(job[1]) else taken[a:b] for job, a, b in zip(jobs, cuts, cuts[1:])]
        edges, sizes = np.concatenate(paths), np.array([len(p) for p in paths])
        starts, begin = np.cumsum(sizes) - sizes, np.array([len(job[1]) for job in jobs])
        seeds = np.array([_seed(searches[job[0]].row, 1000 + number) for job in jobs], np.uint64)
        best, places, masses = rests(lattices, edges, starts, sizes, begin, np.array([job[4] for job in jobs]), seeds, k - number)
        log_probs = np.add.reduceat(lattices.log_p[edges], starts)
        done, jobs = jobs, []
        for j, ((i, _, _, _, value), path, log_prob) in enumerate(zip(done, paths, log_probs.tolist())):
            search = searches[i]
            for rest, at, before in zip(best[j].tolist(), places[j].tolist(), masses[j].tolist()):
                if rest > -math.inf:
                    heapq.heappush(search.agenda, (-rest, number, at, (int(path[at]),), before))
            search.paths.append((path, log_prob, value))
            if number + 1 < k and (turn := search.pop(lattices)):
                of, at, edge, value = turn
                before = np.append(search.paths[of][0][:at], np.int32(edge))
                gone = int(lattices.span[before].sum())
                # Parts that the kept edges fill; the turning edge may end inside the next one.
                full = int(np.searchsorted(np.cumsum(lengths[parts[i]]), gone, "right"))
                jobs.append((i, before, parts[i][full:], gone, value))
    ids = spelled_out(vocab, lattices, [path for search in searches for path, _, _ in search.paths])
    out, n = [], 0
    for search in searches:
        left = -search.agenda[0][0] if search.agenda else -np.inf
        found = []
        for _, log_prob, value in search.paths:
            x = log_prob - left
            log_q = 0.0 if x > 30 else x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))
            found.append((ids[n], log_prob, value, log_q))
            n += 1
        out.append(found or [(np.zeros(0, np.int64), 0.0, 0.0, 0.0)])
    return out


def utf8(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of code points: four bytes a row, of which the first ones count."""
    codes = codes.astype(np.int32)
    n = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    shift = (6 * (n[:, None] - 1 - np.arange(4))).astype(np.int32)
    out = 0x80 | (codes[:, None] >> np.maximum(shift, 0)) & 0x3F
    out[:, 0] = np.where(n == 1, codes, np.array([0, 0, 0xC0, 0xE0, 0xF0])[n] | codes >> np.maximum(shift[:, 0], 0))
    return out, n


def spelled_out(vocab: dict, lattices: Lattices, paths: list[np.ndarray]) -> list[np.ndarray]:
    """Piece ids of paths; characters without a piece become the ids of their bytes."""
    if not paths:
        return []
    edges = np.concatenate(paths)
    ids, cuts = lattices.id[edges], np.cumsum([len(p) for p in paths])
    lone = np.flatnonzero(ids < 0)
    if len(lone):
        spelled, n = utf8(lattices.codes[lattices.start[edges[lone]]])
        counts = np.ones(len(ids), np.int64)
        counts[lone] = n
        ids, ends = np.repeat(ids, counts), np.cumsum(counts)
        at = np.repeat(ends[lone] - n - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ids[at] = vocab["byte_ids"][spelled[np.arange(4) < n[:, None]]]
        cuts = ends[cuts - 1]
    return np.split(ids, cuts[:-1])


def sample_segmentations(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES, model_file: str = MODEL, alpha: float = ALPHA
) -> DataFrame:
    """Every row of ``docs`` once per sample: rank, n_pieces, log_prob, perturbed, log_inclusion, ids, round_trip.

    ``log_inclusion`` is the log of the chance to be among the samples given the first value that is
    not, 0 if there are no more segmentations. ``round_trip`` tells that the ids decode to the text;
    the mark that stands for a space in pieces reads as a space there. Null and empty texts have
    one sample without pieces; texts with fewer than ``k`` segmentations give all they have. Rows
    with equal key and text give equal samples; a null key is a key like others. Columns with the names
    of results are replaced.
    """
    keep = [c for c in docs.columns if c not in RESULT.names]
    at = keep.index(text)
    schema = T.StructType([docs.schema[c] for c in keep] + RESULT.fields)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model_file, alpha))
    kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.bool_()]

    def settle(vocab, parts):
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        texts = [t.decode().replace(SPACE, " ") for t in as_bytes(whole.column(at))]
        found = sample(vocab, texts, whole.column(len(keep)).to_pylist(), k)
        take, columns, ids = [], [[] for _ in kinds[:5]], []
        for i, samples in enumerate(found):
            for rank, (own, log_prob, value, log_q) in enumerate(samples, 1):
                take.append(i)
                for c, v in zip(columns, (rank, len(own), log_prob, value, log_q)):
                    c.append(v)
                ids.append(own)
        cuts = np.concatenate(([0], np.cumsum(columns[1])))
        flat = np.concatenate(ids).astype(np.int32)
        spelled, ends = decode(vocab, flat), np.concatenate(([0], np.cumsum(vocab["sizes"][flat])))[cuts].tolist()
        wants = [(" " + t).encode() if t else b"" for t in texts]
        trips = [spelled[a:b] == wants[i] for i, a, b in zip(take, ends, ends[1:])]
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat))
        kept = whole.select(list(range(len(keep)))).take(pa.array(take))
        return pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(c, t) for c, t in zip(columns, kinds)), lists, pa.array(trips)], schema.names)

    def work(batches):
        vocab, parts, size = shared.value, [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                parts.append(part)
                size += pc.sum(pc.binary_length(part.column(at))).as_py() or 0
                if size >= BATCH:
                    yield settle(vocab, parts)
                    parts, size = [], 0
        if parts:
            yield settle(vocab, parts)

    return docs.select(*keep, F.xxhash64(key).alias("_seed")).mapInArrow(work, schema)
