"""N-gram Jaccard join (operator 5): which documents' shingle sets are alike, and what that
connects.

Equal sets are one class from the start. Of the classes, small sets are light: they enumerate
the subsets of the size that an overlap with a partner must have, so any two in a list share
enough. Large sets are heavy: they scan the inverted lists of as many of their shingles, rarest
first, as any partner must share one of. The boundary between light and heavy is the size at
which the expected number of list entries is least.

Lists yield candidates without pairing their members: first each member with the list's
smallest set and its hub, and sets with a neighbour each by 64 bits of their parity sketches;
then, where exact overlaps have not connected all, members outside the
hub's component with those of other components whose parity sketches are near. So a list of
thousands of near copies takes one pair a member, and no link between two components is lost.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import Bitmap, column, map_batches, mixed, saved, texts_of, unused
from orderflow.llm.components import components
from orderflow.llm.words import Words, lists, span_hashes, word_blocks

# A shingle in more lists than this goes to the end of the order, so that few sets list it.
FREQUENT = 50
# Ranges of the hash in which shingles are counted, for an upper bound of an overlap.
SKETCH_BITS = 8
SKETCH = 1 << SKETCH_BITS
# Bits of the parity sketch: each tells whether an odd number of shingles falls on it.
ODD_BITS = 512
ODD = [f"o{i}" for i in range(ODD_BITS // 64)]
# No set above this size is light.
MOST_LIGHT = 24
# List entries that a task makes before it hands them on.
MOST_KEYS = 100_000
# Shingles of heads that a task counts before it hands the counts on, and ranges of the hash at
# least that they are dealt by.
MOST_TOPS = 1 << 20
LEAST_PARTS = 1024
# Bits that a word of two parity sketches must have for its equality to tell that they are near.
TELLING_BITS = 4


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of the texts of a block, and each one's text: size words, or all
    words of a text that has fewer."""
    hashes, text = words.hashes(), words.text_of()
    at = np.arange(len(hashes))
    first, end = words.first[text], words.first[text + 1]
    kept = (at + size <= end) | (at == first)
    at, text = at[kept], text[kept]
    return span_hashes(hashes, at, np.minimum(at + size, end[kept])), text


def text_sets(words: Words, size: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted."""
    hashes, text = shingles(words, size)
    cuts = np.searchsorted(text, np.arange(len(words.first)))
    return [np.unique(hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def least_overlap(one: int, other: int, percent: int) -> int:
    """The smallest intersection of sets of these sizes with 100 * it >= percent * union."""
    return -(-percent * (one + other) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    """So many shingles of a set of n that any partner has one of them in its own so many."""
    return n - -(-percent * n // 100) + 1


def partner_sizes(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_count(n: int, percent: int) -> int:
    return sum(comb(n, min(n, least_overlap(n, m, percent))) for m in partner_sizes(n, percent))


def light_limit(sizes: dict[int, int], scanned: float, percent: int) -> int:
    """The largest light size: where subsets of light sets plus list entries read by the others
    are fewest. sizes counts sets by size, scanned is the mean length of the list of an entry."""

    def cost(limit: int) -> float:
        light = sum(n * subset_count(s, percent) for s, n in sizes.items() if s <= limit)
        heavy = (n * prefix_size(s, percent) for s, n in sizes.items() if 100 * s >= percent * (limit + 1))
        return light + (1 + scanned) * sum(heavy)

    return min(range(MOST_LIGHT + 1), key=cost)


def subset_keys(members: np.ndarray, limit: int, percent: int) -> list[int]:
    """A key for each subset of a light set that a light partner may share: sizes of the pair and
    the sum of the members, less what is left out."""
    n, total, mask = len(members), int(members.sum(dtype=np.uint64)), (1 << 64) - 1
    values = members.tolist()
    keys = []
    for other in partner_sizes(n, percent):
        shared = least_overlap(n, other, percent)
        if other > limit or shared > min(n, other):
            continue
        pair = min(n, other) << 16 | max(n, other)
        keys += [
            (total - sum(left_out) + pair * 0x9E3779B97F4A7C15) & mask
            for left_out in combinations(values, n - shared)
        ]
    return keys


def _head(members: np.ndarray, percent: int, frequent: Bitmap, wide: int = 1) -> np.ndarray:
    """The shingles whose lists a set is in, or wide times as many: the first by hash, frequent
    ones last. Any order that is the same for all sets gives all pairs; this one avoids long
    lists."""
    late = frequent.has(members)
    ordered = np.concatenate([members[~late], members[late]])
    return ordered[: wide * prefix_size(len(members), percent)] if len(members) else ordered


def _standing(batch: pa.RecordBatch, rows: Bitmap) -> pa.RecordBatch:
    """The rows of a batch that stand for their classes, and by chance some others."""
    return batch.filter(pa.array(rows.has(batch["k"].to_numpy())))


def _heads(
    texts: DataFrame, size: int, percent: int, rows: Bitmap, frequent: Bitmap, wide: int = 1
) -> DataFrame:
    """top, count: how many of the rows that stand for classes have a shingle with these upper 32
    bits in their heads, if two at least."""
    bitmaps = texts.sparkSession.sparkContext.broadcast((rows, frequent))

    parts = max(LEAST_PARTS, 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def counted(held: list[np.ndarray]) -> dict:
        top, count = np.unique(np.concatenate(held), return_counts=True)
        part = (top.astype(np.uint64) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        cuts = (4 * np.append(first, len(part))).tolist()
        tops, counts = top.tobytes(), count.astype(np.uint32).tobytes()
        return {
            "part": part[first],
            "tops": [tops[a:b] for a, b in zip(cuts, cuts[1:])],
            "counts": [counts[a:b] for a, b in zip(cuts, cuts[1:])],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows, frequent = bitmaps.value
        held, size_held = [], 0
        for batch in batches:
            for _, _, words in word_blocks(_standing(batch, rows)["text"], lower=True):
                heads = [_head(s, percent, frequent, wide) for s in text_sets(words, size)]
                held.append((np.concatenate(heads) >> np.uint64(32)).astype(np.uint32))
                size_held += len(held[-1])
                if size_held > MOST_TOPS:
                    yield counted(held)
                    held, size_held = [], 0
        if size_held:
            yield counted(held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = defaultdict(list)
        for batch in batches:
            for part, *both in zip(*(batch[c].to_pylist() for c in ("part", "tops", "counts"))):
                held[part].append(both)
        for part in list(held):
            top, count = (np.frombuffer(b"".join(some), np.uint32) for some in zip(*held.pop(part)))
            order = np.argsort(top)
            top, count = top[order], count[order].astype(np.int64)
            first = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
            top, count = top[first], np.add.reduceat(count, first)
            yield {"top": top[count > 1].view(np.int32), "count": count[count > 1]}

    # Packed by range of the hash, for as many rows as there are shingles fill an executor's heap.
    dealt = map_batches(texts, run, "part int, tops binary, counts binary").repartition("part")
    return saved(map_batches(dealt, summed, "top int, count long"), "heads")


SALTS = 8


def set_hash(members: np.ndarray, salt: int) -> int:
    """A hash of a set. Members are salted and mixed before they are summed, so sets that clash
    under one salt part under another."""
    salted = mixed(members ^ mixed(np.full(1, salt + 1, np.uint64)))
    return int(mixed(salted.sum(dtype=np.uint64, keepdims=True))[0])


def _sets(texts: DataFrame, size: int, salt: int) -> DataFrame:
    """doc_id, k (of the row), n, v and check (two hashes of the set), how many shingles fall into
    each of SKETCH ranges of the hash, up to 255, and the parity sketch in words of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at, upto, words in word_blocks(batch["text"], lower=True):
                found = text_sets(words, size)
                n = np.array([len(s) for s in found])
                v = np.array([set_hash(s, salt) for s in found], np.uint64)
                check = np.array([s.sum(dtype=np.uint64) for s in found], np.uint64)
                text = np.repeat(np.arange(len(found)), n)
                part = (np.concatenate(found) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                counts = np.bincount(text * SKETCH + part, minlength=len(found) * SKETCH)
                rows = np.minimum(counts, 255).astype(np.uint8).reshape(-1, SKETCH)
                bit = (np.concatenate(found) >> np.uint64(20)).astype(np.int64) & (ODD_BITS - 1)
                odd = np.bincount(text * ODD_BITS + bit, minlength=len(found) * ODD_BITS) & 1
                odd = np.packbits(odd.reshape(-1, ODD_BITS).astype(bool), axis=1).view(np.int64)
                yield dict(zip(ODD, odd.T)) | {
                    "doc_id": batch["doc_id"][at:upto],
                    "k": batch["k"][at:upto],
                    "n": n,
                    "sketch": [row.tobytes() for row in rows],
                    "v": v.view(np.int64),
                    "check": mixed(check + n.astype(np.uint64)).view(np.int64),
                }

    schema = "doc_id long, k long, n long, sketch binary, v long, check long, "
    return map_batches(texts, run, schema + ", ".join(f"{name} long" for name in ODD))


def _entries(
    texts: DataFrame, size: int, percent: int, salt: int, limit: int, rows: Bitmap, shared: Bitmap, frequent: Bitmap
) -> DataFrame:
    """list, v, n, light, common: one row for each list a set is in, from the rows that stand for the
    classes. Shingles that only one text has in its first ones are left out; light tells lists of
    subsets; common is the share of the set's shingles that are frequent, in thousandths."""
    bitmaps = texts.sparkSession.sparkContext.broadcast((rows, shared, frequent))

    def entries(keys: list, sets: list) -> dict:
        v, n, counts, light, common = zip(*sets)
        return {
            "list": np.concatenate(keys).view(np.int64),
            "v": np.repeat(np.array(v, np.uint64), counts).view(np.int64),
            "n": np.repeat(np.array(n, np.int32), counts),
            "light": np.repeat(np.array(light, bool), counts),
            "common": np.repeat(np.array(common, np.int32), counts),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows, shared, frequent = bitmaps.value
        for batch in batches:
            for _, _, words in word_blocks(_standing(batch, rows)["text"], lower=True):
                keys, sets, held = [], [], 0
                for members in text_sets(words, size):
                    n = len(members)
                    if not n:
                        continue
                    v = set_hash(members, salt)
                    common = int(1000 * frequent.has(members).sum()) // n
                    if n <= limit:
                        found = np.array(subset_keys(members, limit, percent), np.uint64)
                        keys.append(mixed(found))
                        sets.append((v, n, len(found), True, common))
                        held += len(found)
                    if 100 * n >= percent * (limit + 1):
                        head = _head(members, percent, frequent)
                        head = head[shared.has(head)]
                        keys.append(head)
                        sets.append((v, n, len(head), False, common))
                        held += len(head)
                    # A small set may be in thousands of lists.
                    if held > MOST_KEYS:
                        yield entries(keys, sets)
                        keys, sets, held = [], [], 0
                if sets:
                    yield entries(keys, sets)

    return map_batches(texts, run, "list long, v long, n int, light boolean, common int")


def _members(texts: DataFrame, size: int, salt: int, rows: Bitmap, wanted: Bitmap) -> DataFrame:
    """v, members: the sets of the wanted classes, from the rows that stand for them."""
    bitmaps = texts.sparkSession.sparkContext.broadcast((rows, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows, wanted = bitmaps.value
        for batch in batches:
            for _, _, words in word_blocks(_standing(batch, rows)["text"], lower=True):
                found = text_sets(words, size)
                v = np.array([set_hash(s, salt) for s in found], np.uint64)
                kept = np.flatnonzero(wanted.has(v) & np.array([len(s) > 0 for s in found]))
                if len(kept):
                    sets = [found[i] for i in kept]
                    yield {
                        "v": v[kept].view(np.int64),
                        "members": lists(
                            np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets])
                        ),
                    }

    return map_batches(texts, run, "v long, members array<long>").dropDuplicates(["v"])


def join(
    docs: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, n_spanning_links, component_id, one row per row of docs.

    Words are what stands between space and the control characters from tab to carriage return,
    A-Z lower-cased. Two rows link when 100 * intersection >= percent * union of their sets of
    size-word shingles; component_id is the smallest doc_id reachable by links, itself included;
    n_spanning_links counts the links of the row's class among those found while components were
    connected, plus the other rows of its class; links within a component are not all tried, so
    it is no degree. A null, empty or blank text has no shingles and no links.
    Repeated rows link like other equal texts, a null doc_id is never the smallest, an empty
    table gives an empty one, other columns are left out.
    """
    joined = _joined(docs, size, percent, id_col, text_col)
    return joined.select("doc_id", "n_shingles", "n_spanning_links", "component_id")


def _joined(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """join() with k, a hash of doc_id and text."""
    texts = texts_of(docs, id_col, text_col).withColumn("k", F.xxhash64("doc_id", "text"))
    for salt in range(SALTS):
        sets = saved(_sets(texts, size, salt), "sets")
        classes = saved(
            sets.where("n > 0")
            .groupBy("v")
            .agg(
                F.min("doc_id").alias("least"),
                F.min("k").alias("k"),
                F.first("n").alias("n"),
                F.count(F.lit(1)).alias("copies"),
                (F.min("check") != F.max("check")).alias("clash"),
            ),
            "classes",
        )
        # Different sets of one hash would become one class; another salt parts them.
        if classes.where("clash").isEmpty():
            break
    else:
        raise RuntimeError(f"different sets have equal hashes under each of {SALTS} salts")
    top = F.shiftleft(F.col("top").cast("long"), 32)
    # Counted beyond the heads, as what takes the place of a frequent shingle there may be
    # frequent as well.
    rows = Bitmap.of(classes, "k")
    heads = _heads(texts, size, percent, rows, Bitmap.none(), wide=3)
    frequent = Bitmap.of(heads.where(F.col("count") > FREQUENT), top, 24)
    heads = _heads(texts, size, percent, rows, frequent)
    shared = Bitmap.of(heads, top)
    met = heads.where(F.col("count") <= FREQUENT).agg(
        F.sum(F.col("count") * F.col("count")), F.sum("count")
    )
    squares, entries = met.first()
    small = classes.groupBy(F.least("n", F.lit(2 * MOST_LIGHT)).alias("n")).count().collect()
    limit = light_limit({r["n"]: r["count"] for r in small}, (squares or 0) / max(1, entries or 0), percent)
    listed = saved(_entries(texts, size, percent, salt, limit, rows, shared, frequent), "lists")
    # Grouped and joined as they are dealt out here, once for both.
    listed = listed.repartition("list")

    sketches = sets.where("n > 0").select("v", "n", "sketch", *ODD).dropDuplicates(["v"])
    sketches = saved(sketches, "sketches")
    odd, sketches = sketches.select("v", "n", *ODD), sketches.select("v", "n", "sketch")
    # Each member of a list against its smallest set and its hub, the set with most in common with
    # others: of a text and its edited copies, that is the text.
    hub = F.max(F.struct("common", "n", "v")).alias("hub")
    ends = listed.groupBy("list").agg(F.min(F.struct("n", "v")).alias("lo"), F.max(F.struct("n", "v"))["v"].alias("hi"), hub)
    ends = ends.where("lo.v <> hi").select("list", "lo", F.struct("hub.n", "hub.v").alias("hub"))
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    pair = (F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b"))
    stars = listed.join(ends, "list").select("v", "n", F.explode(F.array("lo", "hub")).alias("p"))
    stars = stars.select("v", "n", F.col("p.v").alias("w"), F.col("p.n").alias("m"))
    stars = stars.where("v <> w").where(fits).select(*pair)
    # Edited copies that are far from hub and smallest, by a neighbour each.
    beside = _neighbours(odd).where(fits).select(*pair)
    tried = saved(stars.union(beside).distinct(), "tried")
    links = saved(_linked(texts, tried, sketches, size, percent, salt, classes), "links")

    found = saved(components(links), "components")
    of = found.select(F.col("id").alias("v"), "component")
    members = listed.where("not light").select("list", "v", "n").join(ends.select("list", F.col("hub.v").alias("hub")), "list")
    members = members.join(of, "v", "left").withColumn("c", F.coalesce("component", "v"))
    members = members.select("list", "v", "n", "c", "hub").distinct()
    split = members.groupBy("list").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1")
    members = members.join(split.select("list"), "list", "left_semi")
    members = saved(members.join(odd.drop("n"), "v"), "split")
    # Members outside the component of the list's hub, against all of other components.
    home = members.where("v = hub").select("list", F.col("c").alias("home")).distinct()
    outside = members.join(home, "list").where("c <> home").select("list", "v", "n", "c", "home", *ODD)
    others = members.select(
        "list", F.col("v").alias("w"), F.col("n").alias("m"), F.col("c").alias("d"), *[F.col(o).alias(f"p{o}") for o in ODD]
    )
    near = _near(percent)
    # Two that are both outside meet once.
    once = (F.col("d") == F.col("home")) | (F.col("v") < F.col("w"))
    across = outside.join(others, (outside["list"] == others["list"]) & (F.col("c") != F.col("d")) & once & fits & near)
    across = across.select(*pair).distinct().join(tried, ["a", "b"], "left_anti")
    more = saved(_linked(texts, across, sketches, size, percent, salt, classes), "links")

    links = links.union(more)
    found = components(links)
    ends = links.select(F.col("a").alias("v")).union(links.select(F.col("b").alias("v")))
    degrees = ends.groupBy("v").count()
    rooted = (
        classes.join(found.withColumnRenamed("id", "v"), "v", "left")
        .join(degrees, "v", "left")
        .select(
            "v",
            "least",
            F.coalesce("component", "v").alias("root"),
            (F.coalesce("count", F.lit(0)) + F.col("copies") - 1).alias("n_spanning_links"),
        )
    )
    rooted = saved(rooted, "rooted")
    leasts = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(leasts, "root").select("v", "n_spanning_links", "component_id")
    apart = F.col("n") == 0
    some = sets.where(~apart).join(labels, "v")
    return some.select("doc_id", "k", F.col("n").alias("n_shingles"), "n_spanning_links", "component_id").union(
        sets.where(apart).select("doc_id", "k", "n", F.lit(0).cast("long"), "doc_id")
    )


def one_of_each(
    docs: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of docs, with all columns, without those of a component of linked rows that have
    another doc_id than its smallest. Rows of one id and text stay or go together; a null id stays."""
    joined = _joined(docs, size, percent, id_col, text_col)
    gone = joined.where("doc_id <> component_id").select("doc_id", "k").distinct()
    names = [unused(f"_{name}", docs) for name in ("doc_id", "k")]
    row = (column(id_col).cast("long"), F.coalesce(column(text_col).cast("string"), F.lit("")))
    marked = docs.withColumn(names[0], row[0]).withColumn(names[1], F.xxhash64(*row))
    return marked.join(gone.toDF(*names), names, "left_anti").select(*[column(c) for c in docs.columns])


def _near(percent: int) -> Column:
    """Whether sets of n and m shingles with parities ODD and pODD may be linked. A shingle that one
    of two sets lacks changes one bit of their parities at most, so sets whose parities differ in
    more bits than linked sets have such shingles are told apart."""
    unlike = sum((F.bit_count(F.col(o).bitwiseXOR(F.col(f"p{o}"))) for o in ODD), F.lit(0))
    overlap = F.expr(f"({percent} * (n + m) + {99 + percent}) div {100 + percent}")
    return unlike <= F.col("n") + F.col("m") - 2 * overlap


def _neighbours(odd: DataFrame) -> DataFrame:
    """v, n and w, m: sets that agree in 64 bits in a row of their parities, each with the one before
    it by the next bits; so of a group of any size, a set takes one pair a place. Bits are cut at
    words and halfway."""
    words = [F.col(o) for o in ODD]
    halfway = [F.shiftrightunsigned(a, 32).bitwiseOR(F.shiftleft(b, 32)) for a, b in zip(words, words[1:] + words[:1])]
    places = F.array(*words, *halfway)
    rows = odd.select("v", "n", F.posexplode(places).alias("at", "word"), places.alias("places"))
    rows = rows.where(F.bit_count("word") >= TELLING_BITS)
    rows = rows.select("v", "n", "at", "word", F.col("places")[(F.col("at") + 1) % (2 * len(ODD))].alias("next"))
    line = Window.partitionBy("at", "word").orderBy("next", "v")
    before = rows.select("v", "n", F.lag("v").over(line).alias("w"), F.lag("n").over(line).alias("m"))
    return before.where("w IS NOT NULL")


def _plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose overlap can be enough: it is at most the sum, over the ranges of the hash,
    of the smaller of the two counts. A count of 255 stands for any number and passes."""
    one = sketches.select(F.col("v").alias("a"), F.col("n").alias("n"), F.col("sketch").alias("x"))
    other = sketches.select(F.col("v").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, SKETCH)
                for c in "xy"
            )
            least = np.minimum(x, y)
            total = batch["n"].to_numpy() + batch["m"].to_numpy()
            bound = least.sum(axis=1, dtype=np.int64)
            good = (100 * bound >= percent * (total - bound)) | (least == 255).any(axis=1)
            yield {name: batch[name].filter(pa.array(good)) for name in "ab"}

    both = pairs.join(one, "a").join(other, "b")
    return map_batches(both, run, "a long, b long")


def _linked(
    texts: DataFrame, pairs: DataFrame, sketches: DataFrame, size: int, percent: int, salt: int,
    classes: DataFrame,
) -> DataFrame:
    """The pairs (a, b) of classes whose sets are alike enough, by exact overlap."""
    pairs = saved(_plausible(pairs, sketches, percent), "plausible")
    ends = pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v")))
    rows = Bitmap.of(classes.join(ends.distinct(), "v", "left_semi"), "k")
    members = saved(_members(texts, size, salt, rows, Bitmap.of(ends, "v")), "members")
    one = members.select(F.col("v").alias("a"), F.col("members").alias("x"))
    other = members.select(F.col("v").alias("b"), F.col("members").alias("y"))
    both = pairs.join(one, "a").join(other, "b")
    both = both.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("o"))
    return both.where(100 * F.col("o") >= percent * (F.col("n") + F.col("m") - F.col("o"))).select("a", "b")
