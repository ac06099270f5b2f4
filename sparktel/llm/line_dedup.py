"""Line dedup by site-relative frequency, in DataFrame functions.

Pages are grouped by host.  For each line, the pages of the host that contain it are divided by all pages of the host;
lines above the boilerplate ratio and on two pages at least are dropped from every page of the host, whatever its size.  Lines are compared after trimming blanks and control characters at both ends, by two 64-bit
hashes; empty lines are never counted nor dropped.

A host with P pages and L line occurrences has fewer than L / (ratio P) boilerplate lines, that is, the mean page
length over the ratio: they fit one row a host.  That table is broadcast if it has at most `broadcast_bytes`, which is
counted first; else it is joined by host, where adaptive skew handling splits the pages of a hot host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktel.llm.common import written

_TRIM = " \t\r\x0b\x0c"


def _line_key(line: Column) -> Column:
    """Two hashes of the trimmed line; null for an empty one."""
    line = F.btrim(line, F.lit(_TRIM))
    return F.when(line != "", F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(11), line).alias("h2")))


def boilerplate(docs: DataFrame, host: str = "source", body: str = "text", ratio: float = 0.1) -> DataFrame:
    """host, lines: array of line hashes above the ratio, for hosts that have any.  A null host is a host of its own."""
    rows = docs.select(docs[host].alias("host"), F.coalesce(docs[body].cast("string"), F.lit("")).alias("text"))
    totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    keys = F.array_compact(F.array_distinct(F.transform(F.split("text", "\n"), _line_key)))
    counts = rows.select("host", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where("n > 1")
    j = counts.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    found = j.where(F.col("n") > F.lit(ratio) * F.col("pages")).select("c.host", "line")
    return found.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, key: str = "doc_id", host: str = "source", body: str = "text", ratio: float = 0.1, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """All columns of docs with `body` rid of its host's boilerplate lines, and n_lines, n_removed (long; named with a
    leading underscore until no column of that name is left, if docs has such columns).

    A null body stays null and counts one empty line of no page's boilerplate; a page that loses every line has ''; repeated
    rows are pages of their own; null keys are untouched; an empty table gives an empty one.
    """
    names = []
    for c in ("n_lines", "n_removed"):
        while c.lower() in {x.lower() for x in [*docs.columns, *names]}:
            c = "_" + c
        names.append(c)
    plain = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[host].alias("host"), docs[body].cast("string").alias("text"))
    lists = written(docs.sparkSession, boilerplate(docs, host, body, ratio), "boilerplate").withColumnRenamed("host", "site")
    size = lists.agg(F.sum(F.size("lines") * 24 + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        lists = F.broadcast(lists)
    cut = F.split(F.coalesce("text", F.lit("")), "\n")
    keep = F.filter("all", lambda line: F.coalesce(~F.array_contains("lines", _line_key(line)), F.lit(True)))
    joined = plain.join(lists, F.col("host").eqNullSafe(F.col("site")), "left")
    out = joined.select("row", "text", cut.alias("all"), "lines").select("row", "text", "all", F.when(F.col("lines").isNull(), F.col("all")).otherwise(keep).alias("kept"))
    new = F.when(F.col("text").isNotNull(), F.array_join("kept", "\n"))
    return out.select(*[(new.alias(c) if c == body else F.col(f"row.`{c}`")) for c in docs.columns], F.size("all").cast("long").alias(names[0]), (F.size("all") - F.size("kept")).cast("long").alias(names[1]))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
k AS (SELECT rid, source, i, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM l),
p AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
b AS (
  SELECT c.source AS source, t FROM (SELECT source, t, count(DISTINCT rid) AS n FROM k WHERE t <> '' GROUP BY source, t) c
  JOIN p ON c.source IS NOT DISTINCT FROM p.source WHERE n > 1 AND n > CAST(0.1 AS DOUBLE) * pages),
m AS (SELECT k.*, EXISTS (SELECT 1 FROM b WHERE b.source IS NOT DISTINCT FROM k.source AND b.t = k.t) AS gone FROM k)
SELECT d.doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
FROM m JOIN d USING (rid) GROUP BY d.rid, d.doc_id
"""
