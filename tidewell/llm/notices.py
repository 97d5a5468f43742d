"""Licence scans by fuzzy search for short notices.

A notice that may be found with k edits is cut into k + 1 pieces; whatever the edits, one piece
stays exact. The pieces are searched in the whole text, each hit gives the stretch in which the
notice can lie, and the regex library's bounded-error matching decides on each stretch and
reports span and edits. Phrases (the base) go the same way; their places are the exact ones.

Texts are compared as words: A-Z in lower case, each run of other ASCII characters one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewell.llm.common import as_bytes

# The phrases of the base and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Wordings of short licence notices and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2", "apache-2"),
    ("apache license version 2 0", "apache-2"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution non commercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution share alike", "cc-by-sa"),
    ("creative commons attribution 4 0 international", "cc-by"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("dedicated to the public domain", "public-domain"),
    ("all rights reserved", "all-rights-reserved"),
)
CHARS_PER_EDIT, MOST_EDITS = 12, 3  # edits that a notice may have

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

SPAN = T.StructType(
    [T.StructField("label", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("first_word", "last_word", "edits")]
    + [T.StructField("found", T.StringType())]
)
SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField(n, T.StringType()) for n in ("base_labels", "labels")]
    + [T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(SPAN))]
)


def edits_allowed(notice: str) -> int:
    return min(MOST_EDITS, len(notice) // CHARS_PER_EDIT)


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """(offset, piece): the notice cut into edits + 1 stretches of nearly equal length."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b].encode()) for a, b in zip(cuts, cuts[1:])]


class Blanks:
    """How many spaces stand before a place of a text (bytes or characters), counted once."""

    def __init__(self, text: bytes | str):
        self.text, self.at = text, None

    def before(self, place: int) -> int:
        if self.at is None:
            units = np.frombuffer(self.text, np.uint8) if isinstance(self.text, bytes) else np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
            self.at = np.flatnonzero(units == 32)
        return int(np.searchsorted(self.at, place))


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES):
        self.plans = []
        self.seeds: dict[bytes, list[tuple[int, int]]] = {}
        known = [(p, label, True) for p, label in phrases] + [(n, label, False) for n, label in notices]
        for i, (notice, label, base) in enumerate(known):
            edits = edits_allowed(notice)
            # Whole words only: the spaces around a notice belong to it and are not edited.
            pattern = regex.compile(f"(?e)(?<= )(?:{regex.escape(notice)}){{e<={edits}}}(?= )")
            self.plans.append((notice, label, base, edits, pattern))
            for offset, piece in pieces(notice, edits):
                self.seeds.setdefault(piece, []).append((i, offset))

    def stretches(self, text: bytes) -> dict[int, list[list[int]]]:
        """For each notice the byte stretches in which a seed allows it to lie, merged and in order."""
        found: dict[int, list[list[int]]] = {}
        for piece, owners in self.seeds.items():
            at = text.find(piece)
            while at >= 0:
                for i, offset in owners:
                    notice, edits = self.plans[i][0], self.plans[i][3]
                    # Four bytes a character: an inserted character need not be ASCII.
                    found.setdefault(i, []).append(
                        [max(0, at - offset - 4 * edits - 1), at - offset + len(notice) + 4 * edits + 1]
                    )
                at = text.find(piece, at + 1)
        for spans in found.values():
            spans.sort()
            merged = spans[:1]
            for span in spans[1:]:
                if span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append(span)
            spans[:] = merged
        return found

    def scan(self, raw: bytes) -> tuple:
        text = raw.translate(_FOLD)
        words = text.split()
        text = b" " + b" ".join(words) + b" "
        places, base, spans, best = [], set(), [], 0.0
        blanks = Blanks(text)
        for i, stretches in self.stretches(text).items():
            notice, label, is_base, edits, pattern = self.plans[i]
            exact = b" " + notice.encode() + b" "
            for start, end in stretches:
                # Whole characters: move the borders off continuation bytes.
                while start > 0 and text[start] & 0xC0 == 0x80:
                    start -= 1
                while end < len(text) and text[end] & 0xC0 == 0x80:
                    end += 1
                window = text[start:end]
                if is_base:
                    at = window.find(exact)
                    while at >= 0:
                        places.append(blanks.before(start + at))
                        base.add(label)
                        at = window.find(exact, at + 1)
                view, before = window.decode(), blanks.before(start)
                inside = Blanks(view)
                for m in pattern.finditer(view):
                    first = before + inside.before(m.start()) - 1
                    n = sum(m.fuzzy_counts)
                    spans.append((label, first, first + m.group().strip().count(" "), n, m.group()))
                    best = max(best, 1 - n / len(notice))
        # The pieces of a phrase can put one place into two stretches only if these overlap, and
        # overlapping stretches are merged; so every place is listed once.
        spans = sorted(set(spans), key=lambda s: (s[1], s[2], s[0], s[3]))
        labels = base | {s[0] for s in spans}
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), best,
            [dict(zip(SPAN.names, s)) for s in spans],
        )


def scan(docs: DataFrame, text: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Every row of ``docs`` with word count, base places, labels, score and the spans found.

    Null and empty texts have no words, no spans, empty labels and score 0. The score is that of
    the best span: 1 less edits per character of the notice. Repeated rows give equal results;
    texts are scanned whole. Columns with the names of results are replaced.
    """
    keep = [c for c in docs.columns if c not in SCHEMA.names]
    schema = T.StructType([docs.schema[c] for c in keep] + SCHEMA.fields)
    at = keep.index(text)
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64()), ("found", pa.string())])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]

    def work(batches):
        scanner = Scanner(phrases, notices)
        for batch in batches:
            rows = [scanner.scan(t) for t in as_bytes(batch.column(at))]
            new = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *SCHEMA.names])

    return docs.select(*keep).mapInArrow(work, schema)
