"""Token ids in binary shards, each a wavelet matrix with rank and select in one compressed file.

File format (little-endian):

    magic 8 bytes | u64 ids | u32 planes | u32 bits a block | u64 documents | u64 offset of the document section
    for each plane: u64 zeros, then for each block: u64 offset, u32 bytes, u32 coding (0 raw, 1 zstd), u64 ones before it
    blocks
    document section, zstd: start of each document in the shard (i64, one more than documents), then its key (i64), then a null flag (u8)

Plane p holds, for each id, bit p from the top; each plane lists the ids stably parted by the bit above.  A block is
read and inflated only when it is needed, so access, counting and occurrence lookup touch a block or two per plane.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktel.llm import files
from sparktel.llm import texthash as th
from sparktel.llm.common import KEPT, shuffle_partitions, tidied, work_dir, written

MAGIC = b"SPTLWM1\n"
BLOCK_BITS = 1 << 16
#: Ids of a shard before the next one begins; a longer single text has a shard of its own.
SHARD_IDS = 1 << 22
_HEAD, _ENTRY = struct.Struct("<8sQIIQQ"), np.dtype([("offset", "<u8"), ("bytes", "<u4"), ("coding", "<u4"), ("ones", "<u8")])
#: Entries of a worker's memo of encoded units, unless a block has more of its own.
MEMO = 1_000_000
#: How a byte-level vocabulary writes a blank.
BLANK = "\u0120"
#: Bytes of text encoded at once; a single longer text is handled alone.
ENCODED_BYTES = 8 << 20


def write_shard(out, ids: np.ndarray, keys: list[int | None], starts: np.ndarray) -> None:
    """Write ids (unsigned), and each document's key and start."""
    import zstandard

    planes = max(1, int(ids.max()).bit_length() if len(ids) else 1)
    nblocks = -(-len(ids) // BLOCK_BITS)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    head, body = [], []
    at = _HEAD.size + planes * (8 + nblocks * _ENTRY.itemsize)
    seq = ids
    for p in range(planes - 1, -1, -1):
        mask = (seq & seq.dtype.type(1 << p)) != 0
        packed = np.packbits(mask)
        lows = seq.compress(~mask)  # unlike an index by booleans, it doesn't branch on random bits
        entries = np.zeros(nblocks, _ENTRY)
        per = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK_BITS // 8), dtype=np.int64) if nblocks else np.zeros(0, np.int64)
        entries["ones"] = np.concatenate([[0], np.cumsum(per)[:-1]]) if nblocks else 0
        for b in range(nblocks):
            raw = packed[b * BLOCK_BITS // 8 : (b + 1) * BLOCK_BITS // 8].tobytes()
            small = squeeze(raw)
            coding = int(len(small) < len(raw))
            body.append(small if coding else raw)
            entries[b]["offset"], entries[b]["bytes"], entries[b]["coding"] = at, len(body[-1]), coding
            at += len(body[-1])
        head.append(struct.pack("<Q", len(lows)) + entries.tobytes())
        seq = np.concatenate([lows, seq.compress(mask)])
    null = np.array([k is None for k in keys], np.uint8)
    docs = squeeze(np.asarray(starts, "<i8").tobytes() + np.array([k or 0 for k in keys], "<i8").tobytes() + null.tobytes())
    out.write(_HEAD.pack(MAGIC, len(ids), planes, BLOCK_BITS, len(keys), at) + b"".join(head))
    for part in body:
        out.write(part)
    out.write(docs)


class Shard:
    """A shard file opened for reading."""

    def __init__(self, uri: str):
        self.file = files.open_random(uri)
        magic, self.n, self.planes, self.block, self.docs, self.tail = _HEAD.unpack(self.file.read(_HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        self.nblocks = -(-self.n // self.block)
        raw = self.file.read(self.planes * (8 + self.nblocks * _ENTRY.itemsize))
        size = 8 + self.nblocks * _ENTRY.itemsize
        self.zeros = [struct.unpack_from("<Q", raw, p * size)[0] for p in range(self.planes)]
        self.entries = [np.frombuffer(raw, _ENTRY, self.nblocks, p * size + 8) for p in range(self.planes)]
        self.cache: dict[tuple[int, int], np.ndarray] = {}

    def close(self) -> None:
        self.file.close()

    def _inflate(self, raw: bytes, coding: int) -> bytes:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(raw, max_output_size=self.block // 8) if coding else raw

    def _bits(self, plane: int, block: int) -> np.ndarray:
        got = self.cache.get((plane, block))
        if got is None:
            if len(self.cache) > 256:
                self.cache.clear()
            e = self.entries[plane][block]
            self.file.seek(int(e["offset"]))
            raw = self._inflate(self.file.read(int(e["bytes"])), int(e["coding"]))
            got = self.cache[plane, block] = np.unpackbits(np.frombuffer(raw, np.uint8))[: min(self.block, self.n - block * self.block)]
        return got

    def _ones(self, plane: int, i: int) -> int:
        """Ones before place i of a plane."""
        if i <= 0:
            return 0
        b = min(i // self.block, self.nblocks - 1)
        return int(self.entries[plane][b]["ones"]) + int(np.count_nonzero(self._bits(plane, b)[: i - b * self.block]))

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.planes):
            bit = int(self._bits(p, i // self.block)[i % self.block])
            ones = self._ones(p, i)
            i = self.zeros[p] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        if value >> self.planes:
            return 0, 0
        for p in range(self.planes):
            a, b = self._ones(p, lo), self._ones(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if value >> (self.planes - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """How often value stands in places lo..hi-1."""
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def select(self, value: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of value."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= j < b - a:
            raise IndexError(j)
        i = a + j
        for p in range(self.planes - 1, -1, -1):
            bit = value >> (self.planes - 1 - p) & 1
            i = self._find(p, bit, i - self.zeros[p] if bit else i)
        return i

    def _find(self, plane: int, bit: int, j: int) -> int:
        ones = self.entries[plane]["ones"].astype(np.int64)
        before = ones if bit else np.arange(self.nblocks, dtype=np.int64) * self.block - ones
        b = int(np.searchsorted(before, j, side="right")) - 1
        return b * self.block + int(np.flatnonzero(self._bits(plane, b) == bit)[j - int(before[b])])

    def decode(self) -> np.ndarray:
        """All ids, plane by plane from the last."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        seq = np.zeros(self.n, kind)
        for p in range(self.planes - 1, -1, -1):
            e = self.entries[p]
            if not self.nblocks:
                break
            self.file.seek(int(e[0]["offset"]))
            raw = self.file.read(int(e["offset"][-1] + e["bytes"][-1] - e["offset"][0]))
            base = int(e[0]["offset"])
            plane = b"".join([self._inflate(raw[int(o) - base : int(o) - base + int(n)], int(c)) for o, n, c in zip(e["offset"], e["bytes"], e["coding"], strict=True)])
            mask = np.unpackbits(np.frombuffer(plane, np.uint8))[: self.n].view(bool)
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~mask)] = seq[: self.zeros[p]]
            out[np.flatnonzero(mask)] = seq[self.zeros[p] :] | kind(1 << (self.planes - 1 - p))
            seq = out
        return seq

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Keys and starts (one more than keys)."""
        import zstandard

        self.file.seek(self.tail)
        raw = zstandard.ZstdDecompressor().decompress(self.file.read(), max_output_size=8 * (2 * self.docs + 1) + self.docs)
        starts = np.frombuffer(raw, "<i8", self.docs + 1)
        keys = np.frombuffer(raw, "<i8", self.docs, 8 * (self.docs + 1)).tolist()
        null = np.frombuffer(raw, np.uint8, self.docs, 8 * (2 * self.docs + 1))
        return [None if x else k for k, x in zip(keys, null.tolist(), strict=True)], starts


#: Blanks between two characters that aren't white space: the tokenizer parts a text there whatever stands around, and
#: the blank belongs to what follows.  Python's white space holds the tokenizer's and U+001C..U+001F, which is safe.
_CUT = re.compile(r"(?<=\S) (?=\S)")

#: ASCII punctuation, none of which is a letter, number or white space to the tokenizer, and words that are letters to it.
_FINAL, _LETTERS = string.punctuation, "^[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+$"


class Encoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct unit once a worker.

    A unit is what stands between two cuts.  A block of texts is parted at every blank by Arrow and its distinct parts
    are looked up once; where a part shows that some blank is no cut, its text is parted by `_CUT` instead.  The memo is
    three arrays: units, their ids, and the edges of each one's ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        #: Whether a token begins with a blank, which a byte-level vocabulary writes as BLANK.
        self.blank = np.zeros(self.tok.get_vocab_size(), bool)
        self.blank[[i for token, i in self.tok.get_vocab().items() if token[0] == BLANK]] = True
        #: The same model for blanks and ASCII letters alone, which need no pre-tokenization.
        self.letters = Tokenizer(self.tok.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.keys, self.ids, self.edges = pa.array([], pa.string()), np.zeros(0, self.kind), np.zeros(1, np.int64)

    def _flat(self, tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, and how many each has."""
        ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), self.kind), np.fromiter(map(len, ids), np.int64, len(ids))

    def _new(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of units, and in it their ids after a blank and how many each has.

        Units without blanks are joined: then only the first token of each begins with a blank.
        """
        inner = pc.match_substring(units, " ").to_numpy(zero_copy_only=False)
        simple = pc.match_substring_regex(units, "^[A-Za-z]+$").to_numpy(zero_copy_only=False)
        order, flats, sizes = [], [], []
        for which, tokenizer, lead, between in ((simple, self.letters, BLANK, f" {BLANK}"), (~(simple | inner), self.tok, " ", " ")):
            at = np.flatnonzero(which)
            some = units.take(pa.array(at)).to_pylist()
            flat, _ = self._flat(tokenizer, [lead + between.join(some[lo : lo + 4096]) for lo in range(0, len(some), 4096)])
            order.append(at)
            flats.append(flat)
            sizes.append(np.diff(np.append(np.flatnonzero(self.blank[flat]), len(flat))))
        at = np.flatnonzero(inner)
        flat, size = self._flat(self.tok, [f" {u}" for u in units.take(pa.array(at)).to_pylist()])
        return np.concatenate([*order, at]), np.concatenate([*flats, flat]), np.concatenate([*sizes, size])

    def _known(self, units: pa.Array) -> np.ndarray:
        """Places of distinct units in the memo, which holds all of them from then on; if it gets full, it forgets others."""
        at = pc.index_in(units, value_set=self.keys)
        if len(self.keys) + at.null_count > MEMO:
            keep = np.sort(at.drop_null().to_numpy())
            self.keys, size = self.keys.take(pa.array(keep)), np.diff(self.edges)[keep]
            starts, self.edges = self.edges[keep], np.append(0, np.cumsum(size))
            self.ids = self.ids[np.repeat(starts - self.edges[:-1], size) + np.arange(self.edges[-1])]
            at = pc.index_in(units, value_set=self.keys)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = at.fill_null(0).to_numpy().copy()
        if len(new):
            order, ids, sizes = self._new(units.take(pa.array(new)))
            new = new[order]
            at[new] = len(self.keys) + np.arange(len(new))
            self.keys = pa.concat_arrays([self.keys, units.take(pa.array(new))])
            self.ids = np.concatenate([self.ids, ids])
            self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(sizes)])
        return at

    def _after_blank(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Of distinct words with a blank before each: the place of its stem in the memo; the tails, and the place of its tail.

        A word of letters and final punctuation encodes as two, so its stem is looked up without the punctuation; any
        other is a stem with an empty tail.
        """
        core = pc.utf8_rtrim(words, characters=_FINAL)
        core = pc.if_else(pc.match_substring_regex(core, _LETTERS), core, words)
        stems = core.dictionary_encode()
        size = pc.subtract(pc.binary_length(words), pc.binary_length(core)).to_numpy()
        data, offs = th.string_buffers(words)
        edges = np.zeros(len(words) + 1, np.int32)
        np.cumsum(size, out=edges[1:])
        cut = np.repeat(offs[1:] - edges[1:], size) + np.arange(edges[-1])
        tails = pa.StringArray.from_buffers(len(words), pa.py_buffer(edges), pa.py_buffer(data[cut])).dictionary_encode()
        return self._known(stems.dictionary)[stems.indices.to_numpy()], tails.dictionary, tails.indices.to_numpy()

    def _parts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, list[str]]:
        """Edges of each text's units, each unit's place in the distinct ones, these, and each text's first unit."""
        lists = pc.split_pattern(column, " ")
        coded = lists.flatten().dictionary_encode()
        edges, place, words = lists.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy(), coded.dictionary
        edges -= edges[0]
        bad = pc.or_(pc.equal(words, ""), pc.not_equal(words, pc.utf8_trim_whitespace(words))).to_numpy(zero_copy_only=False)
        odd = np.zeros(len(column), bool)
        odd[np.searchsorted(edges, np.flatnonzero(bad[place]), side="right") - 1] = True
        for s in self.special:
            odd |= pc.match_substring(column, s).to_numpy(zero_copy_only=False)
        first = words.take(pa.array(place[edges[:-1]])).to_pylist()
        if odd.any():
            known = {w: i for i, w in enumerate(words.to_pylist())}
            pieces: list[np.ndarray] = []
            for r, strange in enumerate(odd.tolist()):
                if not strange:
                    pieces.append(place[edges[r] : edges[r + 1]])
                    continue
                text = column[r].as_py()
                units = [text] if any(s in text for s in self.special) else _CUT.split(text)
                first[r] = units[0]
                pieces.append(np.array([0, *(known.setdefault(u, len(known)) for u in units[1:])], np.int32))
            words = pa.array(list(known), pa.string())
            place, edges = np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        return edges, place, words, first

    def block(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, each followed by `end` unless None, and the edges of each text's ids."""
        edges, place, words, first = self._parts(column)
        starts = edges[:-1]
        rest = np.ones(len(place), bool)
        rest[starts] = False
        used = np.zeros(len(words), bool)
        used[place[rest]] = True
        used = np.flatnonzero(used)
        own = list(dict.fromkeys(first))
        stem, tails, tail = self._after_blank(words.take(pa.array(used)))
        # Ids by unit: the memo's, those of the tails and first units, the end, and nothing.
        more, counts = self._flat(self.tok, [*tails.to_pylist(), *own])
        ends = np.array([] if end is None else [end], self.kind)
        flat = np.concatenate([self.ids, more, ends])
        sizes = np.concatenate([np.diff(self.edges), counts, [len(ends), 0]]).astype(np.int32)
        lead = np.cumsum(sizes, dtype=np.int32) - sizes
        nothing, last = len(sizes) - 1, len(sizes) - 2
        pairs = np.zeros((len(words), 2), np.int32)  # a block has fewer ids than bytes: 32 bits hold its places
        pairs[used, 0], pairs[used, 1] = stem, len(self.keys) + tail
        unit = pairs[place]
        at = {u: last - len(own) + i for i, u in enumerate(own)}
        unit[starts] = [[at[u], nothing] for u in first]
        unit = np.insert(unit.ravel(), 2 * edges[1:], last)  # a text's last unit is its end
        many = sizes[unit]
        to = np.zeros(len(many) + 1, np.int32)
        np.cumsum(many, out=to[1:])
        place = np.repeat(lead[unit] - to[:-1], many)
        place += np.arange(to[-1], dtype=np.int32)
        return flat.take(place), to[2 * edges + np.arange(len(edges))].astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null counts as empty."""
        if not texts:
            return []
        ids, edges = self.block(pa.array([t or "" for t in texts], pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]


_ENCODERS: dict[str, Encoder] = {}
KEPT["tokens"] = _ENCODERS


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, model: str, folder: str, end_id: int, key: str = "doc_id", body: str = "text") -> DataFrame:
    """Encode every text, append end_id, and write shards in ascending key order (nulls first; ties by text).

    Returns the manifest, a written table: part, seq, path, n_tokens, n_docs, start (ids before the shard).  A null text
    is empty; an empty table writes no shard.
    """
    spark = docs.sparkSession
    src = docs.select(docs[key].cast("bigint").alias("key"), docs[body].cast("string").alias("text"))
    src = src.repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(model), TaskContext.get().partitionId(), 0
        parts: list[np.ndarray] = []
        keys: list[int | None] = []
        sizes: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal parts, keys, sizes, seq
            path = files.join(folder, files.attempt_name(f"tokens-{part:06d}-{seq:06d}", ".wvt"))
            starts = np.concatenate([[0], np.cumsum(sizes)])
            with files.create(path) as out:
                write_shard(out, np.concatenate(parts), keys, starts)
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path], "n_tokens": pa.array([int(starts[-1])], pa.int64()), "n_docs": pa.array([len(keys)], pa.int64())})
            parts, keys, sizes, seq = [], [], [], seq + 1
            return row

        total = 0
        for batch in batches:
            _, offs = th.string_buffers(batch.column(1))
            for lo, hi in th.blocks(offs, ENCODED_BYTES):
                ids, edges = enc.block(batch.column(1).slice(lo, hi - lo).fill_null(""), end_id)
                sent = 0
                for r, (k, size) in enumerate(zip(batch.column(0).slice(lo, hi - lo).to_pylist(), np.diff(edges).tolist(), strict=True)):
                    if keys and total + size > SHARD_IDS:
                        parts.append(ids[sent : edges[r]])
                        sent, total = edges[r], 0
                        yield flush()
                    keys.append(k)
                    sizes.append(size)
                    total += size
                parts.append(ids[sent:])
        if keys:
            yield flush()

    shards = written(spark, src.mapInArrow(tidied(run, "tokens"), "part int, seq int, path string, n_tokens bigint, n_docs bigint"), "token-manifest")
    before, totals = {}, 0
    for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():  # a row a partition
        before[r["part"]], totals = totals, totals + r["n"]
    base = spark.createDataFrame(list(before.items()), "part int, base bigint")
    running = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    return shards.join(F.broadcast(base), "part").select("*", (F.col("base") + F.coalesce(running, F.lit(0))).alias("start")).drop("base")


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document of the shards: key, start, n_tokens, ids_crc32 (over the ids as little-endian 32-bit) and, with_ids, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(path)
                ids, (keys, starts) = shard.decode().astype("<u4"), shard.documents()
                shard.close()
                view = memoryview(ids.tobytes())
                edges = starts.tolist()
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(edges, edges[1:], strict=False)]
                cols = [pa.array(keys, pa.int64()), pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, ["key", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

    spark: SparkSession = manifest.sparkSession
    rows = manifest.select("path", "start").repartition(max(shuffle_partitions(spark), 1))
    return rows.mapInArrow(tidied(run, "tokens"), "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids)


def encode_store_read(docs: DataFrame, model: str, end_id: int = 2, key: str = "doc_id", body: str = "text") -> DataFrame:
    """Write the shards under the shared folder and read every document back from them."""
    manifest = write_tokens(docs, model, work_dir(docs.sparkSession, "tokens"), end_id, key, body)
    return read_tokens(manifest).withColumnRenamed("key", key)
