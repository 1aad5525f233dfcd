"""Near-duplicate documents by a signature-coordinate inverted join.

1. A document is the set of its distinct word shingles (64-bit hashes); documents of equal
   sets form a class, and only classes are compared.
2. A class has K MinHash coordinates and is posted under each (coordinate, value).  Values
   posted once cannot collide and are dropped.
3. Two sets at the wanted similarity agree in at least M of K coordinates (M is K times the
   similarity less four standard deviations).  So, with a class's postings ordered from rare
   to frequent, they also share one of its first (shared postings - M + 1): only this prefix is
   merged, and what a great many documents share is skipped.
4. Candidate pairs of equal prefix postings are kept if the sizes allow the similarity and at
   least M coordinates collide, and are then confirmed on the full sets.
5. In every posting list each class is first paired with one hub, the class whose postings
   are the most common (of a group of edited copies, that nearest to the original); linked
   classes form groups.  Classes that share a posting with another group are paired with its
   centre.  What is linked by then needs no more pairs; of the rest *all* pairs that share a
   prefix posting and stand in different components are tested, but for those that can't be similar:
   the Jaccard distance obeys the triangle inequality, so two classes whose distances from one centre differ by more
   than a link's distance need no comparison.  No pair that could join two components is
   left out, and within a component none is made that isn't needed.

Defined results: null, empty and wordless texts have an empty set and link with nothing; a row
without doc_id links with nothing, has no component and is kept; repeated rows with one doc_id
share class and component; an empty table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tweetlake.llm.common import cut, remember, ship
from tweetlake.llm.components import components

K, PART = 64, 256
_MEMO: dict[bytes, bytes] = {}
_ODD = (np.random.default_rng(11).integers(1, 2**63, 16, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_COORD = (np.random.default_rng(12).integers(1, 2**63, K, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = np.random.default_rng(13).integers(0, 2**63, K, dtype=np.uint64)
_U = np.uint64


def _mixed(x: np.ndarray, by: int) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _ODD[by]
    x = (x ^ (x >> _U(29))) * _ODD[by + 1]
    return x ^ (x >> _U(32))


def _hash_of(word: bytes) -> bytes:
    if len(_MEMO) > 250_000:
        _MEMO.clear()
    got = _MEMO[word] = hashlib.blake2b(word, digest_size=8).digest()
    return got


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; A-Z are lower-cased."""
    remember("shingles", _MEMO)
    get = _MEMO.get
    words = np.frombuffer(b"".join([get(w) or _hash_of(w) for w in (text or "").encode().lower().split()]), dtype=_U)
    n = len(words)
    if not n:
        return words
    k = min(n, width)
    h = np.full(n - k + 1, _ODD[15] + _U(k), dtype=_U)
    for i in range(k):
        h = _mixed(h + words[i:n - k + 1 + i], 2)
    return np.unique(h)


def signature(s: np.ndarray) -> np.ndarray:
    """K postings: the coordinate in the high and its 32-bit minimum in the low half."""
    low = np.full(K, 2**64 - 1, dtype=_U)
    for i in range(0, len(s), 4096):
        low = np.minimum(low, (s[None, i:i + 4096] * _COORD[:, None] + _ADD[:, None]).min(axis=1))
    return (np.arange(K, dtype=np.int64) << 32) | (low >> _U(32)).astype(np.int64)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    return (int(np.add.reduce(_mixed(s, 4)).view(np.int64)), int(np.bitwise_xor.reduce(_mixed(s, 6)).view(np.int64)))


def least_matches(similarity: float) -> int:
    """Collisions that all but about one in ten thousand pairs of just the similarity have."""
    return max(1, math.floor(K * similarity - 4 * math.sqrt(K * similarity * (1 - similarity))))


def _signed(docs: DataFrame, width: int) -> DataFrame:
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2, items = [], [], [], []
            for t in batch.column("t"):  # one text at a time
                s = shingle_set(t.as_py(), width)
                n.append(len(s))
                a, b = fingerprint(s) if len(s) else (0, 0)
                f1.append(a)
                f2.append(b)
                items.append(signature(s) if len(s) else np.zeros(0, np.int64))
            # Ids stay in Arrow: a null beside them would turn large ones into other numbers in pandas.
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), *(pa.array(x, pa.int64()) for x in (n, f1, f2)),
                 pa.array(items, pa.list_(pa.int64()))], ["doc_id", "h", "n", "f1", "f2", "items"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.col("text").alias("t")).mapInArrow(
        signed, "doc_id long, h long, n long, f1 long, f2 long, items array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cid, s): the full sets of the classes ``wanted`` (cid, doc_id, f1, f2)."""
    def full(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cids, sets = [], []
            for cid, f1, f2, t in zip(part["cid"], part["f1"], part["f2"], part["t"], strict=True):
                s = shingle_set(t, width)
                if len(s) and fingerprint(s) == (f1, f2):  # a repeated doc_id may have another text
                    cids.append(cid)
                    sets.append(s.view(np.int64))
            yield pd.DataFrame({"cid": cids, "s": sets})

    return (docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").alias("t")).join(wanted, "doc_id")
            .select("cid", "f1", "f2", "t").mapInPandas(full, "cid long, s array<long>"))


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with ``d``, the Jaccard distance of their full sets."""
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("s").alias(f"s_{x}"))
    k = F.size(F.array_intersect("s_a", "s_b"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("d", 1 - k / (F.size("s_a") + F.size("s_b") - k))
    return both.drop("s_a", "s_b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("s").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", (F.size("s_a") + F.size("s_b")).alias("n"), F.size(F.array_intersect("s_a", "s_b")).alias("k"))
    return both.where(100 * F.col("k") >= percent * (F.col("n") - F.col("k"))).select("a", "b").distinct()


_HAS = "n > 0 AND doc_id IS NOT NULL"


def _grouped(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, h, n, f1, f2), and per class (f1, f2, n) its group's label and smallest doc_id."""
    ship(docs.sparkSession)
    matches = least_matches(percent / 100)
    base = cut(_signed(docs, width))
    # Ids are given after the cut: the rows and their order are fixed from there on.
    classes = cut(base.where(_HAS).groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("doc_id"), F.first("items").alias("items"))).withColumn("cid", F.monotonically_increasing_id())
    posts = classes.select("cid", F.explode("items").alias("item"))
    often = posts.groupBy("item").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = (posts.join(often, "item").groupBy("cid")
              .agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("ps"))  # at most K of them
              .where(F.size("ps") >= matches))
    lists = cut(shared.select(
        "cid", F.aggregate("ps", F.lit(0).cast("long"), lambda a, p: a + p["often"]).alias("common"),
        F.transform(F.slice("ps", F.lit(1), F.size("ps") - matches + 1), lambda p: p["item"]).alias("prefix")))
    prefix = lists.select("cid", "common", F.explode("prefix").alias("item"))
    hubs = prefix.groupBy("item").agg(F.max(F.struct("common", (-F.col("cid")).alias("low"))).alias("h")).select(
        "item", (-F.col("h.low")).alias("hub"))
    tried = (prefix.join(hubs, "item").where("cid <> hub")
             .select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct())
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("items").alias(f"i_{x}"))
    close = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    near = cut(tried.join(side("a"), "a").join(side("b"), "b").where(close)
               .where(F.size(F.array_intersect("i_a", "i_b")) >= matches).select("a", "b"))
    sets = cut(_sets(docs, lists.select("cid").join(classes.select("cid", "doc_id", "f1", "f2"), "cid"), width))
    first = cut(components(_confirmed(near, sets, percent)))
    # Groups of linked classes, each with the class of the most common postings as its centre.
    at = (lists.join(first.withColumnRenamed("node", "cid"), "cid", "left")
          .withColumn("alone", F.col("label").isNull()).withColumn("label", F.coalesce("label", "cid")))
    posted = at.select("cid", "label", "alone", F.explode("prefix").alias("item"))
    mixed = posted.groupBy("item").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("item")
    posted = cut(posted.join(mixed, "item"))
    centre = at.where(~F.col("alone")).groupBy("label").agg(
        F.max_by("cid", F.struct("common", (-F.col("cid")).alias("low"))).alias("centre"))
    of = posted.where(~F.col("alone")).select("item", F.col("label").alias("group")).distinct()
    # A class beside a group that it shares a posting with: once, and of two groups from one side.
    met = (F.col("label") < F.col("group")) | (F.col("alone") & (F.col("label") != F.col("group")))
    beside = posted.join(of, "item").where(met).select("cid", "group").distinct()
    second = cut(_confirmed(beside.join(centre.withColumnRenamed("label", "group"), "group")
                            .select(F.col("cid").alias("a"), F.col("centre").alias("b")), sets, percent))
    linked = first.select(F.col("node").alias("a"), F.col("label").alias("b"))
    now = cut(components(linked.union(second)))
    # The rest: classes beside a group, or beside another single class, that are still apart.  The groups
    # are those of both steps, so a class that the second step joined counts as a member of its group.
    posted = (posted.select("cid", "item").join(now.withColumnRenamed("node", "cid"), "cid", "left")
              .withColumn("alone", F.col("label").isNull()).withColumn("label", F.coalesce("label", "cid")))
    mixed = posted.groupBy("item").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("item")
    posted = cut(posted.join(mixed, "item"))
    of = posted.where(~F.col("alone")).select("item", F.col("label").alias("group")).distinct()
    apart = cut(posted.join(of, "item").where(met).select("cid", "group", "alone").distinct())
    full = lambda x: sets.select(F.col("cid").alias(x), F.col("s").alias(f"s_{x}"), F.size("s").alias(f"n_{x}"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    similar = close & (100 * common >= percent * (F.col("n_a") + F.col("n_b") - common))
    # Distances from the group's centre: what can't reach any member, or any class beside the group, stays out.
    centre = lists.join(now.select(F.col("node").alias("cid"), F.col("label").alias("group")), "cid").groupBy("group").agg(
        F.max_by("cid", F.struct("common", (-F.col("cid")).alias("low"))).alias("b"))
    apart = cut(_distances(apart.withColumnRenamed("cid", "a").join(centre, "group"), sets).drop("b"))
    members = cut(_distances(now.select(F.col("label").alias("group"), F.col("node").alias("a"))
                             .join(apart.select("group").distinct(), "group").join(centre, "group"), sets)
                  .select("group", F.col("a").alias("b"), "d"))
    reach = 1 - percent / 100 + 1e-9
    outside = apart.join(members.groupBy("group").agg(F.min("d").alias("lo"), F.max("d").alias("hi")), "group").where(
        F.col("d").between(F.col("lo") - reach, F.col("hi") + reach)).select("group", "a", "d")
    inside = members.join(outside.groupBy("group").agg(F.min("d").alias("lo"), F.max("d").alias("hi")), "group").where(
        F.col("d").between(F.col("lo") - reach, F.col("hi") + reach)).select("group", "b", "d")
    singles = apart.where("alone").select("group", "a", "d")
    # What is compared with a group, or beside it, is laid out in cells of about PART by PART classes; the
    # pairs are told apart within their cell, so no cell is shipped again and none is larger than that.
    counted = [x.groupBy("group").agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("n"))
               for name, x in (("members", inside), ("beside", outside), ("alone", singles))]
    sides = counted[0].union(counted[1]).union(counted[2]).groupBy("group").pivot("side", ["members", "beside", "alone"]).sum("n")
    parts = cut(sides.select("group", *[(1 + F.floor(F.coalesce(c, F.lit(0)) / PART)).alias(f"p_{c}")
                                        for c in ("members", "beside", "alone")]))
    cell = ["group", "row", "col"]

    def laid(side: DataFrame, x: str, own: str, at: str, other: str, along: str) -> DataFrame:
        return (side.join(parts, "group").join(full(x), x).withColumn(at, F.pmod(F.xxhash64(x), F.col(own)))
                .withColumn(along, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
                .select(*cell, x, f"s_{x}", f"n_{x}", F.col("d").alias(f"d_{x}")))

    def compared(left: DataFrame, rows: str, right: DataFrame, cols: str) -> DataFrame:
        return laid(left, "a", rows, "row", cols, "col").join(laid(right, "b", cols, "col", rows, "row"), cell).where(
            F.abs(F.col("d_a") - F.col("d_b")) <= reach)

    rest = (compared(outside, "p_beside", inside, "p_members").where(similar)
            .select(*cell, "a", "b").distinct().select("a", "b"))
    beside_one = (compared(singles, "p_alone", singles.withColumnRenamed("a", "b"), "p_alone")
                  .where((F.col("a") < F.col("b")) & similar).select(*cell, "a", "b").distinct().select("a", "b"))
    groups = apart.groupBy(F.col("a").alias("cid")).agg(F.collect_list("group").alias("g"))
    single = (posted.where("alone").groupBy("cid").agg(F.sort_array(F.collect_list("item")).alias("p"))
              .join(groups, "cid", "left").join(classes.select("cid", "n", "items"), "cid")
              .select("cid", "p", F.coalesce("g", F.array().cast("array<bigint>")).alias("g"), "n", "items",
                      F.explode("p").alias("item")))
    a, b = single.alias("a"), single.alias("b")
    # A pair is met in each posting that it shares and counts in the first.
    ones = (a.join(b, F.col("a.item") == F.col("b.item")).where("a.cid < b.cid")
            .where(100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
            .where(F.element_at(F.array_intersect("a.p", "b.p"), 1) == F.col("a.item"))
            .where(~F.arrays_overlap("a.g", "b.g") & (F.size(F.array_intersect("a.items", "b.items")) >= matches))
            .select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")))
    third = cut(rest.union(beside_one).union(_confirmed(cut(ones), sets, percent)))
    whole = components(now.select(F.col("node").alias("a"), F.col("label").alias("b")).union(third))
    named = (classes.join(whole.withColumnRenamed("node", "cid"), "cid", "left")
             .select("f1", "f2", "n", "doc_id", F.coalesce("label", "cid").alias("label")))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return base, named.join(least, "label").select("f1", "f2", "n", "label", "component_id")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; see the module's text.

    Sets of at least ``percent`` hundredths similarity are linked.
    """
    base, named = _grouped(docs, width, percent)
    out = base.where(_HAS).join(named, ["f1", "f2", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = base.where(f"NOT ({_HAS})").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns; rows without doc_id stay.

    Unlike texts under one doc_id are documents of their own, and of each group one stays; of rows
    repeated with their doc_id and text one stays.
    """
    base, named = _grouped(docs, width, percent)
    ours = (base.where(_HAS).join(named, ["f1", "f2", "n"]).where(F.col("doc_id") == F.col("component_id"))
            .groupBy("label").agg(F.min(F.struct("doc_id", "h")).alias("k")).select("k.*"))
    alone = base.where((F.col("n") == 0) & F.col("doc_id").isNotNull()).select("doc_id", "h")
    wanted = ours.union(alone).distinct().select(F.col("doc_id").alias("_wanted_id"), F.col("h").alias("_wanted_h"))
    # The row is one struct here, so that no column of it can clash.
    kept = (docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
            .join(wanted, (F.col("_id") == F.col("_wanted_id")) & (F.col("_h") == F.col("_wanted_h")))
            .dropDuplicates(["_id", "_h"]).select("_doc.*"))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
