"""How filters interact: what each removes after any others, in any order.

Each filter has a table with the ids of the rows that fail it. What a filter does after some others
depends on the set of those before it, not on their order, so a step is a pair of a set and a filter
outside it. Sets are taken by size. One left-semi join of the survivors of all sets of a size with
the id tables gives what each further filter removes, one left-anti join the survivors of the
next sets, and one left-anti join of the id tables with the survivors what was failing but gone before.
Rows that fail nothing are split off by a left-anti join first and only counted.

All joins are on row numbers, which no two rows share, so no key is hot. Equal texts meet in salted
minima only.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch

WORDS = r"[^\x20\x09-\x0D]+"
SALTS = 256  # parts of a group of equal texts

STEP = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def verdicts(text: Column) -> dict[str, Column]:
    """Fixed rules: too short, too repetitive, shouting, symbols. True fails; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.char_length(text),
        "D": F.regexp_like(text, F.lit("[#$%&*|]")),
    }


def later_copies(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(rid): rows (rid, key, digest) with the digest of a row that has a smaller key.

    A group of copies of any size meets as ``salts`` minima; its rows get the least of all back by
    digest and salt. A null key is neither smaller nor larger than another.
    """
    salted = rows.where("key IS NOT NULL").select("rid", "key", "digest", F.pmod(F.xxhash64("rid"), F.lit(salts)).alias("salt"))
    parts = salted.groupBy("digest", "salt").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    least = parts.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    parts = parts.select("digest", "salt").join(least.select("digest", "low"), "digest")
    return salted.join(parts, ["digest", "salt"]).where("key > low").select("rid")


def _bit(f: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), f)


class Audit:
    """Failing-id tables of some filters over ``rows`` (rid, part, good, toxic)."""

    def __init__(self, scratch: Scratch, rows: DataFrame, failing: dict[str, DataFrame]):
        self.scratch, self.names = scratch, list(failing)
        self.rows = scratch.keep(rows.select("rid", "part", "good", "toxic"), "rows")
        for name, ids in failing.items():
            ids.select("rid").write.parquet(f"{scratch.path}/failing/f={self.names.index(name)}")
        self.failing = scratch.spark.read.schema("rid long, f int").parquet(f"{scratch.path}/failing")

    def steps(self) -> DataFrame:
        """(part, seen, f, removed, good_lost, toxic_lost, redundant, kept) per set ``seen`` (bits) and filter outside it.

        Every part has a row for each, zeros included.
        """
        keep, n = self.scratch.keep, len(self.names)
        suspects = keep(self.rows.join(self.failing, "rid", "left_semi"), "suspects")
        clean = self.rows.join(self.failing, "rid", "left_anti").groupBy("part").agg(F.count("*").alias("clean"))
        parts = keep(self.rows.select("part").distinct().join(clean, "part", "left").fillna(0, ["clean"]), "parts")
        failing = keep(self.failing.join(suspects.select("rid", "part"), "rid"), "failing-parts")
        alive = suspects.withColumn("seen", F.lit(0))
        removed, redundant, kept = [], [], []
        for size in range(n + 1):
            alive = keep(alive, f"alive-{size}")
            kept.append(alive.groupBy("part", "seen").agg(F.count("*").alias("kept")))
            if size == n:
                break
            sets = [sum(1 << i for i in s) for s in itertools.combinations(range(n), size)]
            filters = F.array(*(F.lit(i) for i in range(n)))
            outside = F.filter(filters, lambda f: F.col("seen").bitwiseAND(_bit(f)) == 0)
            turns = alive.withColumn("f", F.explode(outside))
            lost = turns.join(self.failing, ["rid", "f"], "left_semi").groupBy("part", "seen", "f")
            sums = [F.sum(F.col(c).cast("long")).alias(f"{c}_lost") for c in ("good", "toxic")]
            removed.append(lost.agg(F.count("*").alias("removed"), *sums))
            seen = F.filter(F.array(*(F.lit(s) for s in sets)), lambda s: s.bitwiseAND(_bit(F.col("f"))) == 0)
            gone = failing.withColumn("seen", F.explode(seen)).join(alive.select("rid", "seen"), ["rid", "seen"], "left_anti")
            redundant.append(gone.groupBy("part", "seen", "f").agg(F.count("*").alias("redundant")))
            # Each set of the next size is made once: by its last filter.
            last = turns.where(_bit(F.col("f")) > F.col("seen"))
            left = last.join(self.failing, ["rid", "f"], "left_anti")
            alive = left.withColumn("seen", F.col("seen") + _bit(F.col("f"))).drop("f")
        pairs = [(s, f) for s in range(1 << n) for f in range(n) if not s >> f & 1]
        grid = F.array(*(F.struct(F.lit(s).alias("seen"), F.lit(f).alias("f"), F.lit(s | 1 << f).alias("after")) for s, f in pairs))
        out = parts.select("part", "clean", F.inline(grid))
        out = out.join(reduce(DataFrame.unionByName, removed), ["part", "seen", "f"], "left")
        out = out.join(reduce(DataFrame.unionByName, redundant), ["part", "seen", "f"], "left")
        counts = reduce(DataFrame.unionByName, kept).withColumnRenamed("seen", "after")
        out = out.join(counts, ["part", "after"], "left").fillna(0)
        return out.withColumn("kept", F.col("kept") + F.col("clean")).drop("after", "clean")

    def orders(self) -> DataFrame:
        """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders."""
        n = len(self.names)
        steps = self.scratch.keep(self.steps(), "steps")
        alone = F.col("seen") == F.lit((1 << n) - 1) - _bit(F.col("f"))
        # A set of s filters stands before f in s! (n - 1 - s)! orders.
        weight = F.element_at(F.array(*(F.lit(math.factorial(s) * math.factorial(n - 1 - s)) for s in range(n))), F.bit_count("seen") + 1)
        per_filter = steps.groupBy("part", "f").agg(
            F.sum(F.when(alone, F.col("removed")).otherwise(0)).alias("unique_fails"), F.sum(F.col("removed") * weight).alias("shapley")
        )
        turns = [
            ("".join(self.names[f] for f in order), k + 1, sum(1 << f for f in order[:k]), order[k])
            for order in itertools.permutations(range(n))
            for k in range(n)
        ]
        turns = self.scratch.spark.createDataFrame(turns, "filter_order string, step int, seen int, f int")
        out = steps.join(per_filter, ["part", "f"]).join(turns, ["seen", "f"])
        return out.select("part", "filter_order", "step", *(F.col(c).cast("long").alias(c) for c in STEP))


def audit(
    scratch: Scratch, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", names: Sequence[str] = "ABCDE"
) -> DataFrame:
    """The rows of ``Audit.orders`` for the four rules of ``verdicts`` and, as E, repeated texts.

    Every row of ``docs`` is a document of its own, also where keys repeat; it fails E if a row with a
    smaller key has the same text. Null texts are empty and equal. A null part is the empty string. A document counts
    as good or toxic if any label row of its key says so; labels of unknown keys, null labels and null
    keys count for nothing. Other columns do not matter. An empty table gives an empty result.
    """
    flags = labels.groupBy(F.col(key).alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    full = F.coalesce(F.col(text), F.lit(""))
    scan = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(key).alias("key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(full, 256)).alias("digest"),
        *(v.alias(f"fails_{name}") for name, v in verdicts(F.col(text)).items()),
    )
    scan = scratch.keep(scan, "scan")
    failing = {name: scan.where(f"fails_{name}").select("rid") for name in "ABCD"}
    failing["E"] = later_copies(scan.select("rid", "key", "digest"))
    rows = scan.select("rid", "key", "part").join(flags, "key", "left")
    rows = rows.select("rid", "part", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")))
    return Audit(scratch, rows, {name: failing[name] for name in names}).orders()
