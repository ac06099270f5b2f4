"""Near-duplicate join on word n-gram sets: prefix filtering in rare-first order, verified once per pair.

1. Texts with equal shingle sets are one class; everything below is about one text of each class, so copies cost no
   pairs.  The same scan counts texts by hashed shingle in a sketch of fixed size (2**sketch_bits counters, all texts).
2. The sketch gives an order of shingles: rare first, ties by hash.  In a large corpus its counters tell only the most
   frequent shingles, so the prefixes that it gives are counted exactly, and the shingles of over `LEAST_HOLDERS`
   prefixes are moved behind all others (a table of fixed size, so others that share a slot go with them).  Any order
   that all texts share is exact; this one keeps frequent shingles out of the prefixes at every size.
3. A class of n shingles sends its first n - ceil(t n) + 1, once; two classes that link share one of these.  Where the
   shingles meet, those that one class alone sends are dropped, and those at which no pair could pass the positional
   filter.  Shingles whose counter stands far above the mean meet in several parts and are all kept.
4. Two classes meet at a shingle if they pass the length filter (classes of other sizes than a ratio of t aren't even
   compared: sizes are cut into steps of that ratio) and the positional filter there: at their first common shingle the
   rest of both sets must be large enough, so links survive although most common shingles of a pair fail.
5. Candidates pass the suffix filter: sets differ in at least as many shingles as the parities of their counts over
   parts of the hash space, two to four parts a shingle, so that few pairs pass that don't link.  The sets of those
   are then compared once a pair.
6. Components, not all pairs, are asked for.  So first each class only meets pivots, at two of its shingles, the
   rarest and the one with the most holders, and the verified links are closed to components; then the holders of any
   shingle that are in different components meet.  The pivots are each step's holder with the fewest rarer shingles:
   of edited copies, the one with the fewest edits, which links with most of the others.  Pairs within a component are
   never made, yet no link between components is missed.

A link means 100 * |A and B| >= percent * |A or B| over exact word shingles, told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktel.llm import texthash as th
from sparktel.llm.common import Workspace, fits_broadcast, release, row_key, shuffle_partitions, tidied, written

#: Holders above which a shingle is moved behind; how many of those are known by the last order at most, the most frequent ones, and bits of a slot of theirs.
LEAST_HOLDERS, MOST_FREQUENT, FREQUENT_BITS = 16, 1 << 18, 22
#: Parts of the hash space for the smallest sets of the suffix filter, a power of two; and of those counted at once.
LEAST_PARITIES, PARITIES = 256, 1 << 22
#: A shingle is spread over so many parts where it meets others if its counter is above `HOT` times the mean.
PARTS, HOT, HOT_LEAST = 32, 8, 4096


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each block of texts: first row, end, row of each distinct shingle, its hash; by row, then in an order of the hashes.

    A text of fewer than n words has its whole word sequence as the only shingle; one without words has none.
    """
    data, offs = th.string_buffers(column)
    for lo, hi in th.blocks(offs):
        w = th.Words(data, offs[lo : hi + 1], th.WHITE, th.LOWER)
        ok = w.spans(n)
        row, hashes = w.row[ok], w.grams(n)[ok]
        for m in range(1, n):
            if (short := np.flatnonzero(w.count == m)).size:
                row = np.concatenate([row, short])
                hashes = np.concatenate([hashes, w.grams(m)[w.first[short]]])
        order = _by_row(row, hashes, hi - lo)
        row, hashes = row[order], hashes[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
        yield lo, hi, row[new], hashes[new]


def _by_row(row: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Order by row and hash; by one sort of 64 bits, unless the bits of the hash that fit beside the row can't part two."""
    bits = np.uint64(max(1, rows - 1).bit_length())
    key = row.astype(np.uint64) << (np.uint64(64) - bits) | hashes >> bits
    order = np.argsort(key)
    key, got = key[order], hashes[order]
    return np.lexsort((hashes, row)) if ((key[1:] == key[:-1]) & (got[1:] != got[:-1])).any() else order


def _per_row(hi: int, lo: int, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of each row's set, its size and its class: a 64-bit hash of the set (0 if empty)."""
    edge = np.searchsorted(row, np.arange(hi - lo + 1))
    size = np.diff(edge)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(th.splitmix(hashes), out=sums[1:])
    other = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(th.splitmix(hashes ^ np.uint64(0x5DEECE66D1234567)), out=other[1:])
    cls = th.splitmix((sums[edge[1:]] - sums[edge[:-1]]) ^ th.splitmix(other[edge[1:]] - other[edge[:-1]]) + size.astype(np.uint64))
    return edge, size, np.where(size > 0, cls, np.uint64(0))


def _parities(edge: np.ndarray, size: np.ndarray, row: np.ndarray, hashes: np.ndarray) -> pa.Array:
    """For each row the parities of its shingles' counts over parts of the hash space, as 64-bit words: a power of two of them.

    The upper half of the words folds onto the lower half, which gives the parities over half as many parts.
    """
    parts = np.maximum(LEAST_PARITIES, 1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64))
    starts, words, a = np.concatenate([[0], np.cumsum(parts)]), [], 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + PARITIES, side="right")) - 1)
        at = slice(edge[a], edge[b])
        bits = np.bincount(starts[row[at]] - starts[a] + ((hashes[at] >> np.uint64(20)).astype(np.int64) & (parts[row[at]] - 1)), minlength=starts[b] - starts[a])
        words.append(np.packbits(bits.astype(np.uint8) & 1).view(np.int64))
        a = b
    flat = np.concatenate(words) if words else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array((starts // 64).astype(np.int32)), pa.array(flat))


def _differ(a: Column, b: Column) -> Column:
    """In how many shingles two sets differ at least, by their parities; the longer ones are folded."""
    half = lambda x: F.zip_with(F.slice(x, F.lit(1), (F.size(x) / 2).cast("int")), F.slice(x, (F.size(x) / 2).cast("int") + 1, (F.size(x) / 2).cast("int")), lambda u, v: u.bitwiseXOR(v))
    x, y = F.when(F.size(a) > F.size(b), half(a)).otherwise(a), F.when(F.size(b) > F.size(a), half(b)).otherwise(b)
    return F.aggregate(F.zip_with(x, y, lambda u, v: F.coalesce(F.bit_count(u.bitwiseXOR(v)), F.lit(0))), F.lit(0), lambda t, u: t + u)


def _scan(src: DataFrame, kind: str, n: int, bits: int) -> DataFrame:
    """src(key, rid, text) to (key, rid, cls, size, parts), and with them a task's counts of the sketch (slot, n) in rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "rid", "cls", "size", "parts", "slot", "n"]
        counts = np.zeros(1 << bits, np.int64)
        none = kinds = None
        for batch in batches:
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.int64()]
            for lo, hi, row, hashes in shingle_sets(batch.column(2), n):
                edge, size, cls = _per_row(hi, lo, row, hashes)
                counts += np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
                none = [pa.nulls(hi - lo, k) for k in kinds]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(th.signed(cls)), pa.array(size.astype(np.int32)), _parities(edge, size, row, hashes), *none[5:]], names)
        at = np.flatnonzero(counts).astype(np.int32)
        for i in range(0, len(at), 1 << 16):
            part = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(part), k) for k in kinds[:5]], pa.array(part), pa.array(counts[part])], names)

    return src.select("key", "rid", "text").mapInArrow(tidied(run), f"key {kind}, rid bigint, cls bigint, size int, parts array<bigint>, slot int, n bigint")


def _ranks(counts: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each counter of the sketch: its base-2 logarithm (0 for none), and whether its shingles are spread."""
    n = np.zeros(1 << bits, np.int64)
    n[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    return (np.log2(np.maximum(n, 0.5)) + 1).astype(np.uint8), n > max(HOT_LEAST, HOT * n.mean())


def _postings(docs: DataFrame, n: int, percent: int, bits: int, sketch) -> DataFrame:
    """docs(text) to (token, part, cls, size, pos): the prefix of each text's set in rare-first order; part 0 unless spread."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, hot, late = sketch.value
        for batch in batches:
            for lo, hi, row, hashes in shingle_sets(batch.column(0), n):
                edge, size, cls = _per_row(hi, lo, row, hashes)
                slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                turn = rank[slot]
                if late is not None:
                    turn = np.maximum(turn, late[(hashes >> np.uint64(64 - FREQUENT_BITS)).astype(np.int64)])
                order = _by_row(row, turn.astype(np.uint64) << np.uint64(57) | hashes >> np.uint64(7), hi - lo)
                pos = np.arange(len(row)) - edge[row]
                send = pos <= (size - (percent * size + 99) // 100)[row]
                row, pos, order = row[send], pos[send], order[send]
                spread = np.where(hot[slot[order]], (cls[row] % np.uint64(PARTS)).astype(np.int32) + 1, 0)
                yield pa.RecordBatch.from_arrays([pa.array(th.signed(hashes[order])), pa.array(spread.astype(np.int32)), pa.array(th.signed(cls[row])), pa.array(size[row].astype(np.int32)), pa.array(pos.astype(np.int32))], ["token", "part", "cls", "size", "pos"])

    return docs.select("text").mapInArrow(tidied(run), "token bigint, part int, cls bigint, size int, pos int")


def _late(space: Workspace, prefixes: DataFrame) -> np.ndarray:
    """By slot: 64 and the base-2 logarithm of the holders of the most frequent shingle in it; 0 without a frequent one."""
    held = prefixes.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > LEAST_HOLDERS)
    held = space.written(held.select("token", F.floor(F.log2("n")).cast("int").alias("level")), "frequent")
    levels = sorted((tuple(r) for r in held.groupBy("level").count().collect()), reverse=True)  # 64 rows at most
    known, least = 0, 64
    for level, n in levels:
        if known + n > MOST_FREQUENT:
            break
        known, least = known + n, level
    got = held.where(F.col("level") >= least).toArrow()
    out = np.zeros(1 << FREQUENT_BITS, np.uint8)
    np.maximum.at(out, (got["token"].to_numpy().view(np.uint64) >> np.uint64(64 - FREQUENT_BITS)).astype(np.int64), 64 + got["level"].to_numpy().astype(np.uint8))
    return out


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """texts(cls, text) to (cls, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, row, hashes in shingle_sets(batch.column(1), n):
                edge = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(edge), pa.array(th.signed(hashes)))], ["cls", "tokens"])

    return texts.select("cls", "text").mapInArrow(tidied(run), "cls bigint, tokens array<bigint>")


def components(spark: SparkSession, edges: DataFrame, name: str = "labels", space: Workspace | None = None) -> DataFrame:
    """(a, b) edges to (node, label): the least node reachable.  Stars towards the least neighbour, alternating larger
    and smaller neighbours, until nothing moves; every round is a written table, of the workspace if one is given."""
    write = space.written if space else partial(written, spark)
    mark = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()  # noqa: E731  of a set of edges
    edges = write(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), name)
    before = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # larger neighbours to the least neighbour
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # then each node and its smaller neighbours to the least of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select("m", F.col("a").alias("x")).where("m < x").union(low.select("m", F.col("b").alias("x"))).distinct().toDF("a", "b")
        edges = write(small, name)
        now = mark(edges)
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
        before = now


def link_components(docs: DataFrame, key: str = "doc_id", body: str = "text", n: int = 5, percent: int = 75, rounds: int = 1, sketch_bits: int = 18, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links, its own included).

    A null text or one without words has the empty set: n_shingles 0, linked with nothing, its own component.  A null
    key counts as no key: its component_id is the smallest other key reachable, else null.  Repeated rows are one class.
    An empty table gives an empty one; no other column is read.  The result is a written table.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    with Workspace(spark, "ngram-join") as space:
        out = _link(space, docs, key, body, kind, n, percent, rounds, sketch_bits, broadcast_bytes)
        return space.kept(out.select(F.col("key").alias(key), "n_shingles", "component_id"))


def _link(space: Workspace, docs: DataFrame, key: str, body: str, kind: str, n: int, percent: int, rounds: int, bits: int, broadcast_bytes: int) -> DataFrame:
    spark = space.spark
    small = lambda df, row_bytes: F.broadcast(df) if fits_broadcast(df, row_bytes, broadcast_bytes) else df
    src = docs.select(docs[key].alias("key"), F.coalesce(docs[body].cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("rid", row_key(src, "key", "text"))
    scanned = space.written(_scan(src, kind, n, bits), "scan")
    known = scanned.where("slot is null").drop("slot", "n")
    counts = scanned.where("slot is not null").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # 2**bits rows at most
    ranks = _ranks(counts, bits)
    # One text stands for each class.  Equal rows share rid.
    classes = space.written(known.where("size > 0").groupBy("cls").agg(F.min("rid").alias("rid"), F.min("key").alias("least"), F.first("size").alias("size"), F.first("parts").alias("parts")), "classes")
    copies = known.where("size > 0").select("cls", F.col("rid").alias("r")).join(classes.select("cls", "rid"), "cls").where("r != rid").select(F.col("r").alias("rid")).distinct()
    copies = space.written(copies, "copies")
    once = src.join(small(copies, 16), "rid", "left_anti")

    most = F.col("size") - F.ceil(F.lit(2 * percent) * F.col("size") / (100 + percent))  # last place at which a smaller set can pass the positional filter
    # One exchange: where a shingle's holders meet, they are counted, then those of equal rows become one.
    meet = Window.partitionBy("token", "part")
    first = spark.sparkContext.broadcast((*ranks, None))
    sketch = spark.sparkContext.broadcast((*ranks, _late(space, _postings(once, n, percent, bits, first))))
    release(spark)
    met = _postings(once, n, percent, bits, sketch).repartition(shuffle_partitions(spark), "token", "part")
    met = met.withColumns({"holders": F.count("*").over(meet), "least": F.min(F.col("pos") - most).over(meet)}).where("part > 0 or (holders > 1 and least <= 0)")
    live = met.groupBy("token", "part", "cls").agg(F.min("size").alias("size"), F.min("pos").alias("pos"), (F.max("holders") * F.when(F.col("part") > 0, PARTS).otherwise(1)).alias("holders"))
    step = F.floor(F.log(F.col("size").cast("double")) / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("size")
    live = space.written(live.select("token", "cls", "size", "pos", "holders", step.cast("int").alias("step")), "postings")

    a, b = ({c: F.col(c).alias(f"{s}{c}") for c in ("cls", "size", "pos", "comp")} for s in "ab")
    limit = F.ceil(F.lit(percent) * (F.col("asize") + F.col("bsize")) / (100 + percent))
    passes = (F.col("acomp") != F.col("bcomp")) & (percent * F.greatest("asize", "bsize") <= 100 * F.least("asize", "bsize")) & (F.least(F.col("asize") - F.col("apos"), F.col("bsize") - F.col("bpos")) >= limit)

    def check(rows: DataFrame, done: DataFrame | None) -> DataFrame:
        """Candidates, one for each common shingle that they pass at, to written (a, b, linked)."""
        swap = F.col("acls") > F.col("bcls")
        rows = rows.select(F.least("acls", "bcls").alias("a"), F.greatest("acls", "bcls").alias("b"), F.when(swap, F.col("bsize")).otherwise(F.col("asize")).alias("asize"), F.when(swap, F.col("asize")).otherwise(F.col("bsize")).alias("bsize"))
        pairs = rows.distinct()
        if done is not None:
            pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        pairs = space.written(pairs, "candidates")
        for s in "ab":
            pairs = pairs.join(classes.select(F.col("cls").alias(s), F.col("rid").alias(f"{s}rid"), F.col("parts").alias(f"{s}parts")), s)
        pairs = space.written(pairs.where(F.col("asize") + F.col("bsize") - _differ(F.col("aparts"), F.col("bparts")) >= 2 * limit).select("a", "b", "asize", "bsize", "arid", "brid"), "pairs")
        # Only the sets of pairs travel, each made once from the one text that stands for its class.
        wanted = pairs.select(F.col("a").alias("cls"), F.col("arid").alias("rid")).union(pairs.select("b", "brid")).distinct()
        wanted = space.written(wanted, "wanted")
        old = reduce(DataFrame.unionByName, made).join(small(wanted.select("cls"), 16), "cls", "left_semi") if made else None
        new = wanted if old is None else wanted.join(old.select("cls").distinct(), "cls", "left_anti")
        made.append(space.written(_sets(src.join(small(new, 24), "rid").select("cls", "text"), n), "sets"))
        sets = (made[-1] if old is None else old.unionByName(made[-1])).dropDuplicates(["cls"])  # equal rows share rid
        for s in "ab":
            pairs = pairs.join(sets.select(F.col("cls").alias(s), F.col("tokens").alias(f"{s}tokens")), s)
        pairs, both = pairs.withColumn("both", F.size(F.array_intersect("atokens", "btokens"))), F.col("both")
        return space.written(pairs.select("a", "b", (100 * both >= percent * (F.col("asize") + F.col("bsize") - both)).alias("linked")), "verified")

    made: list[DataFrame] = []
    done = labels = None
    for r in range(rounds + 1):
        held = live.withColumn("comp", F.col("cls"))
        if labels is not None:
            held = live.join(labels.select(F.col("node").alias("cls"), F.col("label").alias("comp")), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
            mixed = held.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("token")
            held = space.written(held.join(mixed, "token", "left_semi"), "held")
        one = held.select("token", "step", *a.values())
        if r < rounds:
            # Two shingles a class, and the pivots of each: as many candidates as classes, whatever the groups' sizes.
            place = F.struct("token", "step", *a.values())
            chosen = held.select("cls", "holders", "pos", place.alias("at")).groupBy("cls").agg(F.min_by("at", F.struct("pos", "at.token")).alias("x"), F.max_by("at", F.struct("holders", "at.token")).alias("y"))
            chosen = space.written(chosen.select(F.explode(F.array("x", "y")).alias("at")).select("at.*").distinct(), "chosen")
            tokens = chosen.select("token").distinct()
            pivot = held.join(tokens, "token", "left_semi").groupBy("token", "step").agg(F.min(F.struct(F.col("pos") if r == 0 else F.lit(0).alias("pos"), F.xxhash64("cls", F.lit(r)).alias("x"), F.struct("cls", "size", F.col("pos").alias("at"), "comp").alias("h"))).alias("m"))
            pivot = pivot.select("token", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)).alias("step"), F.col("m.h.cls").alias("bcls"), F.col("m.h.size").alias("bsize"), F.col("m.h.at").alias("bpos"), F.col("m.h.comp").alias("bcomp"))
            rows = chosen.join(pivot, ["token", "step"]).where(passes)
        else:
            # The smaller set of a pair, ties by class, meets larger ones of its own step and the next.
            less = one.where(F.col("apos") <= F.col("asize") - F.ceil(F.lit(2 * percent) * F.col("asize") / (100 + percent))).withColumn("step", F.explode(F.array("step", F.col("step") + 1)))
            more = held.select("token", "step", *b.values())
            rows = less.join(more, ["token", "step"]).where(passes & ((F.col("asize") < F.col("bsize")) | ((F.col("asize") == F.col("bsize")) & (F.col("acls") < F.col("bcls")))))
        found = check(rows, done)
        done = found if done is None else done.unionByName(found)
        new = found.where("linked").select("a", "b")
        linked = new if labels is None else labels.select(F.col("label").alias("a"), F.col("node").alias("b")).where("a < b").unionByName(new)
        labels = components(spark, linked, space=space)

    groups = classes.select("cls", "least").join(labels.select(F.col("node").alias("cls"), "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    ids = groups.join(groups.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("cls", "component_id")
    out = known.select("key", "cls", "size").join(ids, "cls", "left")
    return out.select("key", F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT rid, hash(array_to_string(w[i : i + least(5, len(w)) - 1], ' ')) AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT x.rid AS a, y.rid AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.rid < y.rid GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n u ON u.rid = a JOIN n v ON v.rid = b WHERE 100 * k >= 75 * (u.n + v.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(z.doc_id) FROM r JOIN d z ON z.rid = r.b WHERE r.a = d.rid) AS component_id
FROM d LEFT JOIN n USING (rid)
"""
