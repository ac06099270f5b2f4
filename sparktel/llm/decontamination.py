"""Benchmark decontamination by winnowing, in DataFrame functions only.

Each text is cut into words; of every `n - k + 1` consecutive k-gram hashes the least is kept (winnowing), so any
shared span of n words has a fingerprint at the same place on both sides.  The fingerprints of documents and test
items are joined; every hit is extended to both sides, word hash by word hash, and counts where n words agree.  What a
hit covers is exactly the union of the item windows that occur around it.

Items of fewer than n words are one window each and are found through the hashes of all document spans of their
length; such lengths are at most n - 1 and are only looked at if an item has them.

The test side, item ids included, is broadcast if it has at most `broadcast_bytes`, which are added up first; beyond that
both sides are shuffled, and a 7-gram that many texts hold is split where Spark handles skew.  Rows are told apart by key
and text, so a task that runs again gives the same; equal rows are judged once and counted.  Long texts are cut into blocks that overlap by n - 1 words, so no array grows with the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktel.llm.common import row_key

#: Fixed values of the contract: what separates words, after A-Z is lower-cased.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a block without its overlap, and the bits that hold a place in a block.
BLOCK, BITS = 4096, 13
_PRINT = "array<struct<h:bigint,m:int,p:int,off:int,ctx:array<bigint>>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also where body uses it in an inner lambda."""
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def _prints(w: Column, n: int, k: int) -> Column:
    """Winnowed fingerprints of a block, given its word hashes."""
    width, low = n - k + 1, (1 << BITS) - 1

    def of(g: Column) -> Column:
        kept = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(g) - width + 1), lambda i: F.array_min(F.slice(g, i, width))))
        return F.transform(kept, one)

    def one(e: Column) -> Column:
        p = e.bitwiseAND(F.lit(low)).cast("int")
        lead = F.least(p, F.lit(n - k))
        return F.struct(F.shiftright(e, BITS).alias("h"), F.lit(0).alias("m"), p.alias("p"), lead.alias("off"), F.slice(w, p - lead + 1, lead + n).alias("ctx"))

    grams = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(F.slice(w, i + 1, k)).bitwiseAND(F.lit(-1 - low)).bitwiseOR(i.cast("bigint")))
    return F.when(F.size(w) >= n, let(grams, of)).otherwise(F.array().cast(_PRINT))


def _spans(w: Column, m: int) -> Column:
    """Every span of m words of a block that begins in the block proper."""
    each = F.transform(F.sequence(F.lit(0), F.least(F.size(w) - m, F.lit(BLOCK - 1))), lambda i: let(F.slice(w, i + 1, m), lambda c: F.struct(F.xxhash64(c).alias("h"), F.lit(m).alias("m"), i.cast("int").alias("p"), F.lit(0).alias("off"), c.alias("ctx"))))
    return F.when(F.size(w) >= m, each).otherwise(F.array().cast(_PRINT))


def _fingerprints(rows: DataFrame, n: int, k: int, spans: list[int], whole: bool) -> DataFrame:
    """rows(id, w: words) to (id, b: first word of the block, s: print).  whole: also a null print per row, with its number of words."""
    cut = rows.select("id", F.size("w").alias("n"), F.explode(F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(BLOCK)), lambda b: F.struct(b.alias("b"), F.slice("w", b + 1, BLOCK + n - 1).alias("w")))).alias("x"))

    def of(w: Column) -> Column:
        return F.concat(*([F.when(F.col("x.b") == 0, F.array(F.lit(None)).cast(_PRINT)).otherwise(F.array().cast(_PRINT))] * whole), _prints(w, n, k), *[_spans(w, m) for m in spans])

    return cut.select("id", "n", F.col("x.b").alias("b"), F.explode(let(F.transform("x.w", lambda v: F.xxhash64(v)), of)).alias("s"))


def _agree(d: Column, t: Column, at: Column, to: Column, step: int, most: int) -> Column:
    """How many elements agree from d[at] and t[to] on, going by step, up to `most`."""
    return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(most)), lambda j: F.when((j < most) & (at + j * step >= 0) & (to + j * step >= 0) & F.coalesce(F.get(d, at + j * step) == F.get(t, to + j * step), F.lit(False)), F.lit(most)).otherwise(j)))


def hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", body: str = "text", item: str = "item_id", item_body: str = "text", n: int = 13, k: int = 7, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Per row of docs: key, n_words, n_hit, items (sorted array of item ids as strings).

    A null text has no words; a null item id takes part under the name 'null'; empty items match nothing; empty tables
    give no rows (docs) or no hits (items); repeated rows stay apart; no other column is read.
    """
    if not 0 < k <= n or n - k >= 1 << BITS:
        raise ValueError("1 <= k <= n is needed")
    tests = items.select(F.coalesce(items[item].cast("string"), F.lit("null")).alias("id"), words(items[item_body]).alias("w"))
    short = sorted(r[0] for r in tests.select(F.size("w").alias("n")).where(f"n between 1 and {n - 1}").distinct().collect())  # n - 1 values at most
    long = _fingerprints(tests.where(F.size("w") >= n), n, k, [], False).select("id", "s.h", "s.m", "s.off", "s.ctx")
    brief = tests.where(F.size("w").between(1, n - 1)).select("id", F.transform("w", lambda v: F.xxhash64(v)).alias("ctx")).select("id", F.xxhash64("ctx").alias("h"), F.size("ctx").alias("m"), F.lit(0).alias("off"), "ctx")
    tests = long.unionByName(brief).groupBy("h", "m", "off", "ctx").agg(F.collect_set("id").alias("items"))
    tests = tests.select("h", "m", F.col("off").alias("toff"), F.col("ctx").alias("tctx"), "items")
    size = tests.agg(F.sum(64 + 8 * F.size("tctx") + F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x) + 16))).first()[0] or 0

    rows = docs.select(F.struct(docs[key].alias("key"), row_key(docs, key, body).alias("row")).alias("id"), words(docs[body]).alias("w"))
    found = _fingerprints(rows, n, k, short, True).select("id", "n", "b", "s.*")
    if size <= broadcast_bytes:
        found = found.join(F.broadcast(tests), ["h", "m"], "left").where("items is not null or m is null")
    else:
        found = found.where("m is not null").join(tests.hint("merge"), ["h", "m"]).unionByName(found.where("m is null"), allowMissingColumns=True)
    left = _agree(F.col("ctx"), F.col("tctx"), F.col("off") - 1, F.col("toff") - 1, -1, n - k)
    right = _agree(F.col("ctx"), F.col("tctx"), F.col("off") + k, F.col("toff") + k, 1, n - k)
    same = F.slice("ctx", F.col("off") + 1, k) == F.slice("tctx", F.col("toff") + 1, k)
    at = F.col("b") + F.col("p")
    span = F.when(F.col("m") > 0, F.when(F.col("ctx") == F.col("tctx"), F.struct(at.alias("s"), (at + F.col("m")).alias("e")))).when(same & (F.col("l") + F.col("r") + k >= n), F.struct((at - F.col("l")).alias("s"), (at + k + F.col("r")).alias("e")))
    found = found.withColumns({"l": F.when(F.col("m") == 0, left), "r": F.when(F.col("m") == 0, right)}).withColumn("span", F.when(F.col("m").isNotNull(), span))
    per = found.groupBy("id").agg(F.count(F.when(F.col("m").isNull(), 1)).alias("rows"), F.max(F.when(F.col("m").isNull(), F.col("n"))).alias("n_words"), F.collect_set("span").alias("spans"), F.collect_set(F.when(F.col("span").isNotNull(), F.col("items"))).alias("items"))
    union = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")), lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"), (a["sum"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["end"], x["s"]))).alias("sum")))["sum"]
    out = per.select("rows", F.col("id.key").alias(key), F.col("n_words").cast("long").alias("n_words"), union.cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    return out.withColumn("rows", F.explode(F.sequence(F.lit(1), "rows"))).drop("rows")


def decontaminate(docs: DataFrame, items: DataFrame, share: int = 20, **names) -> DataFrame:
    """hits() and `contaminated`: some word is hit, and at least one word in `share` is."""
    return hits(docs, items, **names).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
tw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM t WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM tw),
dw AS (
  SELECT rid, i, m, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT rid, w, m.m AS m, unnest(range(1, len(w) - m.m + 2)) AS i FROM d, m WHERE len(w) >= m.m)),
h AS (SELECT rid, i, dw.m AS m, item_id FROM dw JOIN tw ON dw.m = tw.m AND dw.g = tw.g),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM h)) GROUP BY rid),
s AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN s USING (rid)
"""
