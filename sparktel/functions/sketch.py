"""DDSketch: bins and quantiles as Catalyst expressions, and the codec and builders for Arrow batches.

Expressions hold a sketch as array<struct<idx int, cnt double>>, sorted by slot: bins of negative values, zero and bins of
positive values numbered in the order of values.  `Sketch` holds them apart, as the byte format does.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Relative accuracy and what follows from it; samples drawn for a summary; the byte format's flags.
ACCURACY = 0.01
GAMMA = 1 + 2 * ACCURACY / (1 - ACCURACY)
LN_GAMMA = math.log(GAMMA)
SUMMARY_SAMPLES = 2048
FLAG_MAPPING, FLAG_ZERO, FLAG_POSITIVE, FLAG_NEGATIVE = 0x02, 0x04, 0x05, 0x07
FLAG_SUM, FLAG_MIN, FLAG_MAX, FLAG_COUNT = 0x21, 0x22, 0x23, 0x28
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
ROLLUPS = ("avg", "count", "min", "max", "sum", *QUANTILES)


# -- expressions -------------------------------------------------------------------------------------------------


def bin_of(value: Column) -> Column:
    """Bin of a positive value."""
    return F.ceil(F.log(value) / LN_GAMMA).cast("int")


def value_of(idx: Column) -> Column:
    """Value that stands for a bin."""
    return F.pow(F.lit(GAMMA), idx) * (1 + ACCURACY)


#: What parts the slots of positive and negative values from 0, the slot of zero: more than any bin of a double.
SLOT = 1 << 20


def slot_of(value: Column) -> Column:
    """Slot of a finite value: its bin, with its sign, in the order of values."""
    return F.when(value > 0, bin_of(value) + SLOT).when(value < 0, -(bin_of(-value) + SLOT)).otherwise(0)


def value_at(slot: Column) -> Column:
    """Value that stands for a slot."""
    return F.when(slot > 0, value_of(slot - SLOT)).when(slot < 0, -value_of(-slot - SLOT)).otherwise(0.0)


def usable(value: Column) -> Column:
    """Finite: what a sketch takes."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def quantile_of(bins: Column, count: Column, q: float) -> Column:
    """Quantile of array<struct<idx,cnt>> sorted by slot, at rank q (count - 1).

    The first slot whose running count exceeds the rank, else the last: from zero upwards, and for ranks among the
    negative values from zero downwards.
    """
    rank = F.lit(q) * (count - 1)
    total = lambda part: F.aggregate(part, F.lit(0.0), lambda a, b: a + b["cnt"])
    below, zero = total(F.filter(bins, lambda b: b["idx"] < 0)), total(F.filter(bins, lambda b: b["idx"] == 0))

    def first(part: Column, target: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("idx"), F.lit(False).alias("done"))
        step = lambda a, b: F.struct((a["sum"] + b["cnt"]).alias("sum"), F.when(a["done"], a["idx"]).otherwise(b["idx"]).alias("idx"), (a["done"] | (a["sum"] + b["cnt"] > target)).alias("done"))
        return value_at(F.aggregate(part, start, step)["idx"])

    up, down = F.filter(bins, lambda b: b["idx"] > 0), F.reverse(F.filter(bins, lambda b: b["idx"] < 0))
    return F.when(rank < below, first(down, below - 1 - rank)).when(rank < below + zero, F.lit(0.0)).otherwise(first(up, rank - below - zero))


def sketch_groups(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sketch and rollups of the finite values of each group: keys, bins, rollup_*.

    Two aggregations, first by slot, so a hot group is combined before it is shuffled; its slots are bounded by the range
    of doubles (about 140,000), not by its rows.
    """
    v = F.col(value)
    binned = df.where(usable(v)).groupBy(*keys, slot_of(v).alias("idx")).agg(F.count("*").cast("double").alias("cnt"), F.sum(v).alias("s"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    out = binned.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", "cnt"))).alias("bins"), F.sum("cnt").alias("rollup_count"), F.sum("s").alias("rollup_sum"), F.min("lo").alias("rollup_min"), F.max("hi").alias("rollup_max"))
    out = out.withColumn("rollup_avg", F.col("rollup_sum") / F.col("rollup_count"))
    return out.withColumns({f"rollup_{n}": quantile_of(F.col("bins"), F.col("rollup_count"), q) for n, q in QUANTILES.items()})


def merge_bins(df: DataFrame, keys: list[str], bins: str = "bins") -> DataFrame:
    """Merge sketches of equal keys by adding their bins."""
    one = df.select(*keys, F.explode(bins).alias("b")).groupBy(*keys, F.col("b.idx").alias("idx")).agg(F.sum("b.cnt").alias("cnt"))
    return one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", "cnt"))).alias(bins))


def running_quantile(df: DataFrame, keys: list[str], q: float) -> DataFrame:
    """quantile_of over (keys, idx, cnt) rows by window functions, for sketches too wide for one row."""
    group = Window.partitionBy(*keys)
    away = Window.partitionBy(*keys, F.signum("idx")).orderBy(F.abs("idx"))  # from zero upwards, from zero downwards
    total = lambda c: F.sum(F.when(c, F.col("cnt")).otherwise(0.0)).over(group)
    ranked = df.withColumns({"run": F.sum("cnt").over(away), "below": total(F.col("idx") < 0), "zero": total(F.col("idx") == 0), "rank": F.lit(q) * (F.sum("cnt").over(group) - 1)})
    low, high = (F.col("idx") < 0) & (F.col("run") > F.col("below") - 1 - F.col("rank")), (F.col("idx") > 0) & (F.col("run") > F.col("rank") - F.col("below") - F.col("zero"))
    found = ranked.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("rank", "below", "zero")], F.max(F.when(low, F.col("idx"))).alias("low"), F.min(F.when(high, F.col("idx"))).alias("high"))
    value = F.when(F.col("rank") < F.col("below"), value_at(F.col("low"))).when(F.col("rank") < F.col("below") + F.col("zero"), F.lit(0.0)).otherwise(value_at(F.col("high")))
    return found.select(*keys, value.alias("quantile"))


def single(value: Column) -> Column:
    """struct<sketch binary, rollups double> of one value; an empty sketch and zeros for one that isn't finite."""
    byte = lambda n: F.lpad(F.hex(n), 2, "0")
    index = bin_of(F.abs(value)).cast("bigint")
    n = F.when(index >= 0, 2 * index).otherwise(-2 * index - 1)
    number = F.when(n < 1 << 7, byte(n)).when(n < 1 << 14, F.concat(byte(n.bitwiseAND(F.lit(0x7F)) + 0x80), byte(F.shiftright(n, 7))))
    number = number.otherwise(F.concat(byte(n.bitwiseAND(F.lit(0x7F)) + 0x80), byte(F.shiftright(n, 7).bitwiseAND(F.lit(0x7F)) + 0x80), byte(F.shiftright(n, 14))))
    head, once = Sketch().encode().hex(), _varfloat(1.0).hex()
    store = lambda flag: F.concat(F.lit(f"{head}{flag:02x}01"), number, F.lit(once))
    text = F.when(~usable(value), head).when(value > 0, store(FLAG_POSITIVE)).when(value < 0, store(FLAG_NEGATIVE)).otherwise(f"{head}{FLAG_ZERO:02x}{once}")
    plain, near = F.when(usable(value), value).otherwise(0.0), F.when(usable(value), value_at(slot_of(value))).otherwise(0.0)
    return F.struct(F.unhex(text).alias("sketch"), *[(F.when(usable(value), 1.0).otherwise(0.0) if r == "count" else near if r in QUANTILES else plain).alias(r) for r in ROLLUPS])


# -- objects -----------------------------------------------------------------------------------------------------


@dataclass
class Sketch:
    gamma: float = GAMMA
    offset: float = 0.0
    positive: dict[int, float] = field(default_factory=dict)
    negative: dict[int, float] = field(default_factory=dict)
    zero: float = 0.0
    count: float = 0.0
    sum: float = 0.0
    min: float = math.inf
    max: float = -math.inf

    def key(self, value: float) -> int:
        return math.ceil(math.log(value) / math.log(self.gamma) + self.offset)

    def value(self, key: int) -> float:
        try:
            return self.gamma ** (key - self.offset) * (1 + (self.gamma - 1) / (self.gamma + 1))
        except OverflowError:
            return math.inf

    def add(self, value: float, count: float = 1.0) -> None:
        if count <= 0 or not math.isfinite(value):
            return
        self.count += count
        self.sum += value * count
        self.min, self.max = min(self.min, value), max(self.max, value)
        if value == 0:
            self.zero += count
        else:
            store = self.positive if value > 0 else self.negative
            k = self.key(abs(value))
            store[k] = store.get(k, 0.0) + count

    def add_all(self, values: np.ndarray) -> None:
        """Add many finite values."""
        if not len(values):
            return
        self.count += len(values)
        self.sum += float(values.sum())
        self.min, self.max = min(self.min, float(values.min())), max(self.max, float(values.max()))
        self.zero += int((values == 0).sum())
        for store, part in ((self.positive, values[values > 0]), (self.negative, -values[values < 0])):
            keys, counts = np.unique(np.ceil(np.log(part) / math.log(self.gamma) + self.offset).astype(np.int64), return_counts=True)
            for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
                store[k] = store.get(k, 0.0) + c

    def merge(self, other: Sketch) -> None:
        """Add another sketch of the same mapping."""
        if (self.gamma, self.offset) != (other.gamma, other.offset):
            raise ValueError("sketches of different mappings")
        for mine, theirs in ((self.positive, other.positive), (self.negative, other.negative)):
            for k, c in theirs.items():
                mine[k] = mine.get(k, 0.0) + c
        self.zero += other.zero
        self.count += other.count
        self.sum += other.sum
        self.min, self.max = min(self.min, other.min), max(self.max, other.max)

    def quantile(self, q: float) -> float | None:
        if self.count <= 0 or not 0 <= q <= 1:
            return None
        rank, below = q * (self.count - 1), sum(self.negative.values())
        if rank < below:
            return -self.value(_at(self.negative, below - 1 - rank))
        if rank < below + self.zero:
            return 0.0
        return self.value(_at(self.positive, rank - below - self.zero))

    def rollups(self) -> dict[str, float]:
        some = self.count > 0
        out = {"avg": self.sum / self.count if some else 0.0, "count": self.count, "min": self.min if math.isfinite(self.min) else 0.0, "max": self.max if math.isfinite(self.max) else 0.0, "sum": self.sum}
        return out | {n: self.quantile(q) or 0.0 for n, q in QUANTILES.items()}

    def encode(self) -> bytes:
        out = bytearray(struct.pack("<Bdd", FLAG_MAPPING, self.gamma, self.offset))
        for flag, store in ((FLAG_POSITIVE, self.positive), (FLAG_NEGATIVE, self.negative)):
            if store:
                out.append(flag)
                out += _uvarint(len(store))
                last = 0
                for k in sorted(store):
                    out += _varint(k - last) + _varfloat(store[k])
                    last = k
        if self.zero:
            out.append(FLAG_ZERO)
            out += _varfloat(self.zero)
        return bytes(out)

    @classmethod
    def decode(cls, raw: bytes) -> Sketch:
        """Read the byte format; statistics that it lacks are derived from the bins."""
        s, r, given = cls(), _Reader(raw), {}
        while r.at < len(raw):
            flag = r.byte()
            if flag == FLAG_MAPPING:
                s.gamma, s.offset = r.double(), r.double()
            elif flag & 3 in (1, 3) and flag < 0x20:
                store, form = s.positive if flag & 3 == 1 else s.negative, flag >> 2
                n = r.uvarint()
                if form == 3:
                    k, step = r.varint(), r.varint()
                    for _ in range(n):
                        store[k] = store.get(k, 0.0) + r.varfloat()
                        k += step
                elif form in (1, 2):
                    k = 0
                    for _ in range(n):
                        k += r.varint()
                        store[k] = store.get(k, 0.0) + (r.varfloat() if form == 1 else 1.0)
                else:
                    raise ValueError(f"store encoding {form}")
            elif flag == FLAG_ZERO:
                s.zero += r.varfloat()
            elif flag in (FLAG_SUM, FLAG_MIN, FLAG_MAX):
                given[flag] = r.double()
            elif flag == FLAG_COUNT:
                given[flag] = r.varfloat()
        bins = [(-s.value(k), c) for k, c in s.negative.items()] + [(0.0, s.zero)] * (s.zero > 0) + [(s.value(k), c) for k, c in s.positive.items()]
        s.count = given.get(FLAG_COUNT, sum(c for _, c in bins))
        s.sum = given.get(FLAG_SUM, sum(v * c for v, c in bins))
        s.min = given.get(FLAG_MIN, min((v for v, _ in bins), default=math.inf))
        s.max = given.get(FLAG_MAX, max((v for v, _ in bins), default=-math.inf))
        return s


def _at(store: dict[int, float], rank: float) -> int:
    total, k = 0.0, 0
    for k in sorted(store):
        total += store[k]
        if total > rank:
            return k
    return k


def from_value(value: float) -> Sketch:
    s = Sketch()
    s.add(value)
    return s


def from_histogram(counts: list[int], bounds: list[float], count: int, total: float | None) -> Sketch:
    """Explicit buckets: each bound stands for its bucket; the one above the last bound has no bound and is left out."""
    s = Sketch()
    if not count or not counts:
        return s
    lower = 0.0
    for n, upper in zip(counts, bounds, strict=False):
        if n > 0 and math.isfinite(upper) and upper > 0:
            s.add(upper / 2 if lower <= 0 else math.sqrt(lower * upper), n)
        lower = upper
    if total is not None:
        s.sum = total
    return s


def from_exponential(scale: int, zero: int, positive: tuple[int, list[int]], negative: tuple[int, list[int]], total: float | None = None, low: float | None = None, high: float | None = None) -> Sketch:
    """Exponential buckets (offset, counts): the geometric middle stands for each."""
    s = Sketch()
    base = 2.0 ** (2.0**-scale)
    for sign, (offset, counts) in ((1, positive), (-1, negative)):
        for i, n in enumerate(counts):
            if n > 0:
                try:
                    s.add(sign * math.sqrt(base ** (offset + i) * base ** (offset + i + 1)), n)
                except OverflowError:
                    continue
    if zero > 0:
        s.add(0.0, zero)
    s.sum = s.sum if total is None else total
    s.min = s.min if low is None else low
    s.max = s.max if high is None else high
    return s


def _between(q: float, q1: float, v1: float, q2: float, v2: float) -> float:
    """Value at q on the line through two quantiles; on a logarithmic scale if both are positive."""
    if abs(q2 - q1) < 1e-10:
        return v1
    t = (q - q1) / (q2 - q1)
    if v1 > 0 and v2 > 0:
        return math.exp(math.log(v1) + t * (math.log(v2) - math.log(v1)))
    return v1 + t * (v2 - v1)


def from_summary(count: int, total: float, quantiles: list[tuple[float, float]]) -> Sketch:
    """Quantile pairs, drawn at 2048 evenly spaced ranks at most; its count is the number drawn."""
    s = Sketch()
    points: list[tuple[float, float]] = []
    for q, v in sorted((p for p in quantiles if 0 <= p[0] <= 1 and math.isfinite(p[1])), key=lambda p: p[0]):
        if not points or abs(q - points[-1][0]) >= 1e-10:
            points.append((q, v))
    if not points or not count:
        return s
    if len(points) == 1:
        q, v = points[0]
        low, high = v * 0.5, v * 1.5
    else:
        low, high = _between(0.0, *points[0], *points[1]), _between(1.0, *points[-2], *points[-1])
    if points[0][0] > 0:
        points.insert(0, (0.0, low))
    if points[-1][0] < 1:
        points.append((1.0, high))
    n = min(SUMMARY_SAMPLES, count)
    q, (qs, vs) = (np.arange(n) + 0.5) / n, np.array(points).T
    at = np.searchsorted(qs[1:-1], q)
    to = np.minimum(at + 1, len(points) - 1)
    q1, v1, q2, v2 = qs[at], vs[at], qs[to], vs[to]
    with np.errstate(all="ignore"):
        t = np.where(np.abs(q2 - q1) < 1e-10, 0.0, (q - q1) / (q2 - q1))
        drawn = np.where((v1 > 0) & (v2 > 0) & (t != 0), np.exp(np.log(v1) + t * (np.log(v2) - np.log(v1))), v1 + t * (v2 - v1))
    s.add_all(drawn[np.isfinite(drawn)])
    s.sum = total
    return s


# -- numbers of the byte format ----------------------------------------------------------------------------------


def _uvarint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _varint(n: int) -> bytes:
    return _uvarint((n << 1 ^ n >> 63) & (1 << 64) - 1)


def _varfloat(x: float) -> bytes:
    """Bits of x + 1 less those of 1, turned left by 6, in groups of 7 bits from the top, 9 bytes at most."""
    bits = struct.unpack("<Q", struct.pack("<d", x + 1.0))[0] - struct.unpack("<Q", struct.pack("<d", 1.0))[0] & (1 << 64) - 1
    bits = (bits << 6 | bits >> 58) & (1 << 64) - 1
    out = bytearray()
    for _ in range(8):
        top = bits >> 57
        bits = bits << 7 & (1 << 64) - 1
        if not bits:
            out.append(top)
            return bytes(out)
        out.append(top | 0x80)
    out.append(bits >> 56)
    return bytes(out)


class _Reader:
    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def byte(self) -> int:
        if self.at >= len(self.raw):
            raise ValueError("the sketch is cut off")
        self.at += 1
        return self.raw[self.at - 1]

    def double(self) -> float:
        if self.at + 8 > len(self.raw):
            raise ValueError("the sketch is cut off")
        self.at += 8
        return struct.unpack_from("<d", self.raw, self.at - 8)[0]

    def uvarint(self) -> int:
        n = shift = 0
        while True:
            b = self.byte()
            n |= (b & 0x7F) << shift
            if b < 0x80 or shift > 62:
                return n
            shift += 7

    def varint(self) -> int:
        n = self.uvarint()
        return n >> 1 ^ -(n & 1)

    def varfloat(self) -> float:
        bits = 0
        for i in range(9):
            b = self.byte()
            if i == 8:
                bits |= b
                break
            bits |= (b & 0x7F) << 57 - 7 * i
            if b < 0x80:
                break
        bits = (bits >> 6 | bits << 58) & (1 << 64) - 1
        bits = bits + struct.unpack("<Q", struct.pack("<d", 1.0))[0] & (1 << 64) - 1
        return struct.unpack("<d", struct.pack("<Q", bits))[0] - 1.0
