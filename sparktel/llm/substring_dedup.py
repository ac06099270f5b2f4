"""Substring dedup with a log-structured index of historical window hashes.

A window is `n` consecutive words of one text.  A window's fingerprint is the least of its k-gram hashes; a fingerprint
stands for up to n - k + 1 windows, so the index holds about 2 / (n - k + 2) hashes a word instead of one.

* `RunIndex` keeps fingerprints in immutable runs: tables sorted and bucketed by hash, one per batch.  A new batch is
  aggregated, merge-joined with each run without moving the runs, and written as the next run, in which a hash seen
  before (or twice in the batch) is marked as repeated.  More than `fan_in` runs are compacted into one.  An index in a
  folder of its own can be opened again by a later session, which appends to it.
* Only a repeated fingerprint can stand for a repeated window.  Its occurrences are told apart by the hash of all
  words that any window around it can hold.  Equal contexts repeat whole; of each context under a fingerprint with
  several, one text sends the windows themselves.
* Verification: those windows are compared by two 64-bit hashes of their word sequence, both made from 64-bit hashes of
  the words; contexts, and the windows that a text is then rid of, are told apart by one.

All joins are on hashes of which one side is unique, so a hot passage is split by adaptive skew handling; counts are
aggregated before they are shuffled; one text's results are the only group that is gathered.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktel.llm import texthash as th
from sparktel.llm.common import Workspace, release, remove, row_key, shuffle_partitions, tidied, work_dir


class RunIndex:
    """Sorted immutable runs of (hash long, repeated boolean); hashes are distinct within a run."""

    def __init__(self, spark: SparkSession, fan_in: int = 4, folder: str | None = None):
        self.spark, self.fan_in = spark, fan_in
        self.buckets, self.folder = shuffle_partitions(spark), folder or work_dir(spark, "index")
        self.runs: list[tuple[str, str]] = []

    @classmethod
    def open(cls, spark: SparkSession, folder: str, fan_in: int = 4) -> RunIndex:
        """The index that save() left in a folder."""
        index = cls(spark, fan_in, folder)
        for r in spark.read.schema("path string, buckets int").json(f"{folder}/manifest").orderBy("path").collect():  # a row a run
            name, path, index.buckets = f"sparktel_run_{uuid.uuid4().hex}", r["path"], r["buckets"]
            spark.sql(f"CREATE TABLE {name} (hash BIGINT, repeated BOOLEAN) USING parquet CLUSTERED BY (hash) SORTED BY (hash) INTO {index.buckets} BUCKETS LOCATION '{path}'")
            index.runs.append((name, path))
        return index

    def save(self) -> str:
        """Write which runs there are; the folder."""
        rows = self.spark.createDataFrame([(path, self.buckets) for _, path in self.runs], "path string, buckets int")
        rows.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest")
        return self.folder

    def close(self) -> None:
        """Forget the catalog's tables; the files stay."""
        for name, _ in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.runs = []

    def _write(self, df: DataFrame) -> None:
        name, path = f"sparktel_run_{uuid.uuid4().hex}", f"{self.folder}/run-{uuid.uuid4().hex}"
        df.select("hash", "repeated").write.bucketBy(self.buckets, "hash").sortBy("hash").option("path", path).option("compression", "zstd").option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false").saveAsTable(name)
        self.runs.append((name, path))

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for name, _ in self.runs]

    def append(self, batch: DataFrame) -> None:
        """batch(hash, n): n is how often the row's text holds the hash, or any part of it."""
        new = batch.groupBy("hash").agg((F.sum("n") > 1).alias("repeated")).repartition(self.buckets, "hash")
        for i, run in enumerate(self.tables()):
            seen = run.select("hash", F.lit(True).alias(f"in{i}"))
            new = new.join(seen.hint("merge"), "hash", "left").withColumn("repeated", F.col("repeated") | F.coalesce(f"in{i}", F.lit(False)))
        self._write(new)
        if len(self.runs) > self.fan_in:
            self.compact()

    def compact(self) -> None:
        """One run for all: a hash is repeated if a run says so or two runs hold it."""
        old = self.runs
        both = self._plain()
        self.runs = []
        self._write(both.groupBy("hash").agg((F.max("repeated") | (F.count("*") > 1)).alias("repeated")))
        for name, path in old:
            self._forget(name, path)

    def repeated(self) -> DataFrame:
        """Each repeated hash once."""
        return self._plain().where("repeated").select("hash").distinct()

    def _plain(self) -> DataFrame:
        """All runs as files, without their buckets: a union of bucketed scans claims buckets that it doesn't keep apart."""
        return self.spark.read.schema("hash bigint, repeated boolean").parquet(*[path for _, path in self.runs])

    def _forget(self, name: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, path)

    def drop(self) -> None:
        """Remove the index with all its runs."""
        self.close()
        remove(self.spark, self.folder)


def _anchors(w: th.Words, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the fingerprints, their k-gram hashes, and the hash of each one's context."""
    grams = w.grams(k)
    at = th.winnow(grams, w.spans(n), n - k + 1)
    row = w.row[at]
    lo, hi = np.maximum(at - (n - k), w.first[row]), np.minimum(at + n, w.first[row + 1])
    up, down = th._WORDS.upto(len(w.hash) + 1)
    sums = np.zeros(len(w.hash) + 1, np.uint64)
    np.cumsum(w.hash * up[:-1], out=sums[1:])
    context = th.splitmix((sums[hi] - sums[lo]) * down[lo] + ((hi - lo) * 4096 + (at - lo)).astype(np.uint64))
    return at, grams[at], context


def _texts(column: pa.Array) -> Iterator[tuple[int, int, th.Words]]:
    data, offs = th.string_buffers(column)
    for lo, hi in th.blocks(offs):
        yield lo, hi, th.Words(data, offs[lo : hi + 1])


def _fingerprints(docs: DataFrame, n: int, k: int, with_context: bool) -> DataFrame:
    """docs(rid, text) to (rid, hash, context, n): each once a text, n how often; without context: (hash, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, w in _texts(batch.column(1)):
                at, hash_, context = _anchors(w, n, k)
                row, same = w.row[at], context if with_context else hash_
                order = np.lexsort((same, row))
                row, same, hash_ = row[order], same[order], hash_[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (same[1:] != same[:-1])
                first = np.flatnonzero(new)
                times = np.minimum(np.diff(np.append(first, len(row))), 2).astype(np.int32)
                if with_context:
                    yield pa.RecordBatch.from_arrays([pa.array(rid[lo + row[first]]), pa.array(th.signed(hash_[first])), pa.array(th.signed(same[first])), pa.array(times)], ["rid", "hash", "context", "n"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(th.signed(hash_[first])), pa.array(times)], ["hash", "n"])

    return docs.select("rid", "text").mapInArrow(tidied(run), "rid bigint, hash bigint, context bigint, n int" if with_context else "hash bigint, n int")


def _lists(column: pa.Array, n: int) -> list[np.ndarray]:
    offs, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    empty = np.zeros(0, np.int64)
    return [values[offs[i] : offs[i + 1]] if column[i].is_valid else empty for i in range(n)]


def _windows(docs: DataFrame, n: int, k: int) -> DataFrame:
    """docs(rid, text, own: contexts whose windows this text sends) to (rid, w1, w2): each place's window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, own = batch.column(0).to_numpy(zero_copy_only=False), _lists(batch.column(2), batch.num_rows)
            for lo, hi, w in _texts(batch.column(1)):
                at, _, context = _anchors(w, n, k)
                grams, ok = w.grams(k), w.spans(n)
                least = th.sliding(grams, n - k + 1, np.minimum)
                row = w.row[at]
                send = np.zeros(len(at), bool)
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                for r in range(hi - lo):
                    if len(own[lo + r]) and edge[r] < edge[r + 1]:
                        send[edge[r] : edge[r + 1]] = np.isin(th.signed(context[edge[r] : edge[r + 1]]), own[lo + r])
                at = at[send]
                starts = (at[:, None] - np.arange(n - k + 1)[None, :]).ravel()
                gram = np.repeat(grams[at], n - k + 1)
                good = starts >= 0
                starts, gram = starts[good], gram[good]
                good = ok[starts]
                starts, gram = starts[good], gram[good]
                starts = np.unique(starts[least[starts] == gram])
                yield pa.RecordBatch.from_arrays([pa.array(rid[lo + w.row[starts]]), pa.array(th.signed(w.grams(n)[starts])), pa.array(th.signed(w.grams(n, other=True)[starts]))], ["rid", "w1", "w2"])

    return docs.select("rid", "text", "own").mapInArrow(tidied(run), "rid bigint, w1 bigint, w2 bigint")


def _kept(docs: DataFrame, kind: str, n: int, k: int, with_text: bool) -> DataFrame:
    """docs(key, text, whole: repeated contexts, marks: repeated windows) to the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, marks = _lists(batch.column(2), batch.num_rows), _lists(batch.column(3), batch.num_rows)
            for lo, hi, w in _texts(batch.column(1)):
                at, _, context = _anchors(w, n, k)
                row = w.row[at]
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                windows = None
                count, gone, sha, text = [], [], [], []
                for r in range(hi - lo):
                    a, b = int(w.first[r]), int(w.first[r + 1])
                    out = np.zeros(b - a + 1, np.int32)
                    if len(whole[lo + r]) and edge[r] < edge[r + 1]:
                        p = at[edge[r] : edge[r + 1]]
                        p = p[np.isin(th.signed(context[edge[r] : edge[r + 1]]), whole[lo + r])]
                        np.add.at(out, np.maximum(p - (n - k), a) - a, 1)
                        np.add.at(out, np.minimum(p + n, b) - a, -1)
                    if len(marks[lo + r]) and b - a >= n:
                        if windows is None:
                            windows = th.signed(w.grams(n))
                        p = np.flatnonzero(np.isin(windows[a : b - n + 1], marks[lo + r]))
                        np.add.at(out, p, 1)
                        np.add.at(out, p + n, -1)
                    keep = np.cumsum(out[:-1]) == 0
                    raw = w.bytes
                    kept = b" ".join([raw[s:e].tobytes() for s, e in zip(w.start[a:b][keep].tolist(), w.end[a:b][keep].tolist(), strict=True)]) if not keep.all() else b" ".join(raw[w.start[a] : w.end[b - 1]].tobytes().split()) if b > a else b""
                    count.append(b - a)
                    gone.append(int((~keep).sum()))
                    sha.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        text.append(kept.decode())
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(count, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(text, pa.string())] * with_text, ["key", "n_words", "n_removed", "kept_sha256", "kept_text"][: 4 + with_text])

    return docs.select("key", "text", "whole", "marks").mapInArrow(tidied(run), f"key {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text)


def remove_repeats(docs: DataFrame, key: str = "doc_id", body: str = "text", n: int = 35, k: int = 16, batches: int = 4, fan_in: int = 2, with_text: bool = False) -> DataFrame:
    """Per row: key, n_words, n_removed, kept_sha256 and, with_text, kept_text.

    A word goes if a window of n words that covers it also starts anywhere else, in the same text or another; windows
    are judged on the input.  The rows come in `batches` by hash, as they would over time, to an index that compacts more
    than `fan_in` runs and goes at the end.  The result is a written table.  A null text has no words;
    a null key stays null; repeated rows are different places, so they remove each other; a text of fewer than n words
    keeps all; an empty table gives an empty one; no other column is read.
    """
    if not 1 <= k <= n:
        raise ValueError("1 <= k <= n is needed")
    spark = docs.sparkSession
    src = docs.select(docs[key].alias("key"), F.coalesce(docs[body].cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("rid", row_key(src, "key", "text"))

    with Workspace(spark, "substring-dedup") as space:
        index = RunIndex(spark, fan_in, space.path("index"))
        try:
            for b in range(batches):
                index.append(_fingerprints(src.where(F.pmod("rid", F.lit(batches)) == b), n, k, False))
            found = _fingerprints(src, n, k, True).join(index.repeated().hint("merge"), "hash")
            found = space.written(found, "occurrences")
            release(spark)
        finally:
            index.drop()
        return space.kept(_removed(space, src, found, docs.schema[key].dataType.simpleString(), n, k, with_text).withColumnRenamed("key", key))


def _removed(space: Workspace, src: DataFrame, found: DataFrame, kind: str, n: int, k: int, with_text: bool) -> DataFrame:
    """The result, from the occurrences found(rid, hash, context, n) of repeated fingerprints."""
    contexts = found.groupBy("context", "hash").agg(F.sum("n").alias("times"), F.min("rid").alias("own"))
    several = contexts.groupBy("hash").agg((F.min("context") != F.max("context")).alias("several")).where("several").select("hash", "several")
    contexts = contexts.join(several, "hash", "left").where("times > 1 or several")
    state = contexts.select("context", (F.col("times") > 1).alias("whole"), F.when(F.col("several"), F.col("own")).alias("own"))
    state = found.select("rid", "context").join(state.hint("merge"), "context")
    per = state.groupBy("rid").agg(F.collect_set(F.when(F.col("whole"), F.col("context"))).alias("whole"), F.collect_set(F.when(F.col("own") == F.col("rid"), F.col("context"))).alias("own"))
    per = space.written(per, "contexts")
    release(space.spark)

    placed = src.select("rid", "key", "text").repartition(shuffle_partitions(space.spark), "rid")
    sent = _windows(placed.join(per.where(F.size("own") > 0).select("rid", "own").hint("merge"), "rid").select("rid", "text", "own"), n, k)
    sent = space.written(sent, "windows")
    release(space.spark)
    again = sent.groupBy("w1", "w2").agg(F.count("*").alias("times")).where("times > 1").select("w1", "w2")
    marks = sent.join(again.hint("merge"), ["w1", "w2"], "left_semi").groupBy("rid").agg(F.collect_set("w1").alias("marks"))
    last = placed.join(per.select("rid", "whole").hint("merge"), "rid", "left").join(marks.hint("merge"), "rid", "left")
    return _kept(last, kind, n, k, with_text)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, array_to_string(w[i : i + 34], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT md5(g) AS h FROM g GROUP BY 1 HAVING count(*) > 1),
c AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM g WHERE md5(g) IN (SELECT h FROM r)),
x AS (SELECT rid, list(p) AS ps, count(*) AS n_removed FROM c GROUP BY rid),
k AS (SELECT rid, p, w[p] AS v FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM d) ),
s AS (SELECT k.rid AS rid, string_agg(v, ' ' ORDER BY k.p) AS kept FROM k LEFT JOIN c ON k.rid = c.rid AND k.p = c.p WHERE c.rid IS NULL GROUP BY k.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN x USING (rid) LEFT JOIN s USING (rid)
"""
