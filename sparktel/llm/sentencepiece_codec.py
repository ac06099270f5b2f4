"""SentencePiece merge-type (BPE) encoding and decoding without the library's encoder.

Method: a text is cut where no piece can reach across (before each run of the space symbol).  Every cut piece of text
is tokenised by backtracking: one Aho-Corasick pass finds all vocabulary matches; from the left the longest match is
tried first, accepted only if it is compatible with the token before it, that is, if merging the two tokens' text
anew gives exactly these two tokens; positions from which no continuation works are kept in a field of flags and never
tried twice.  So time and memory grow with the text, whether or not it has blanks.  Characters that no piece holds
become byte tokens.  Pieces that begin with two space symbols or more are merged instead: such runs have equal scores,
so the order of merging decides and adjacent tokens don't tell; so is a text for which backtracking finds no way.

The result equals the library's for models with identity normalisation, no piece that holds the space symbol behind
another character, no user-defined symbols and merge scores; `Codec` refuses any other model.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparktel.llm.common import KEPT, tidied

SPACE = "▁"
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Entries of a worker's memo of encoded words, about, and of pairs: bounds of its memory.
MEMO = 300_000


class Codec:
    """Encoder and decoder of one model file; end_id is appended by encode_with_end."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or train.treat_whitespace_as_suffix or not train.byte_fallback:
            raise ValueError("only byte-fallback BPE models with identity normalisation are supported")
        self.dummy_prefix = norm.add_dummy_prefix
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.control: set[int] = set()
        self.byte_of: dict[int, int] = {}
        self.piece: list[str] = [p.piece for p in model.pieces]
        self.eos = train.eos_id
        self.unk, self.unk_surface = train.unk_id, train.unk_surface
        for i, p in enumerate(model.pieces):
            if p.type == 1:
                self.ids[p.piece], self.score[p.piece] = i, p.score
            elif p.type == 6:
                b = int(p.piece[3:5], 16)
                self.bytes[b], self.byte_of[i] = i, b
            elif p.type == 3:
                self.control.add(i)
            elif p.type in (4, 5):
                raise ValueError("user-defined and unused pieces are not supported")
            if SPACE in p.piece.lstrip(SPACE):
                raise ValueError("pieces across words are not supported")
        self.machine = ahocorasick.Automaton()
        for piece in self.ids:
            self.machine.add_word(piece, len(piece))
        self.machine.make_automaton()
        self.pairs: dict[str, dict[str, bool]] = {}
        self.npairs = 0
        self.whole: dict[str, bool] = {}
        self.memo: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def merged(self, text: str) -> list[str]:
        """Tokens of text by merging: the best-scored adjacent pair first, the leftmost among equals."""
        parts: list[str] = list(text)
        nxt, prv, score = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1)), self.score
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts) and (s := score.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (-s, a, b, parts[a] + parts[b]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if not parts[a] or not parts[b] or nxt[a] != b or parts[a] + parts[b] != both:
                continue
            parts[a], parts[b] = both, ""
            nxt[a] = nxt[b]
            if nxt[a] < len(parts):
                prv[nxt[a]] = a
            offer(prv[a], a)
            offer(a, nxt[a])
        return [p for p in parts if p]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the text of a and b anew gives a and b."""
        if self.npairs > MEMO:
            self.pairs.clear()
            self.npairs = 0
        ok = self.pairs.setdefault(a, {})[b] = self.merged(a + b) == [a, b]
        self.npairs += 1
        return ok

    def usable(self, piece: str) -> bool:
        """Whether the piece comes out of its own text; no other can be a first token."""
        ok = self.whole.get(piece)
        if ok is None:
            ok = self.whole[piece] = self.merged(piece) == [piece]
        return ok

    def tokens(self, text: str) -> list[str]:
        """Tokens of one chunk by backtracking; a character that no piece holds stands for itself."""
        if text.startswith(SPACE * 2):  # runs of the space symbol have equal scores: order decides, so merge them
            return self.merged(text)
        n, ids, pairs, compatible, usable = len(text), self.ids, self.pairs, self.compatible, self.usable
        longest = [1] * n  # of the matches that begin at a place; they come by their ends, so the last is the longest
        for end, size in self.machine.iter(text):
            longest[end - size + 1] = size
        failed = bytearray(n + 1)  # tokens that end here lead nowhere
        out: list[str] = []
        nothing: dict[str, bool] = {}
        before, after, at = "", nothing, 0
        length = longest[0]
        while True:
            while length > 0:
                piece = text[at : at + length]
                if (length == 1 or piece in ids) and not failed[at + length]:
                    if before:
                        ok = after.get(piece)
                        if ok is None:
                            ok = compatible(before, piece)
                            after = pairs.get(before, nothing)
                    else:
                        ok = usable(piece)
                    if ok:
                        break
                length -= 1
            if length > 0:
                out.append(piece)
                before, at = piece, at + length
                after = pairs.get(before, nothing)
                if at == n:
                    return out
                length = longest[at]
            else:
                if not out:
                    return self.merged(text)
                failed[at] = 1
                length = len(out.pop())
                at -= length
                length -= 1
                before = out[-1] if out else ""
                after = pairs.get(before, nothing)

    def encode_chunk(self, chunk: str) -> list[int]:
        out: list[int] = []
        for token in self.tokens(chunk):
            i = self.ids.get(token)
            if i is None:
                out.extend(self.bytes[b] for b in token.encode())
            else:
                out.append(i)
        return out

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(" ", SPACE)
        return _CHUNK.findall(SPACE + text if self.dummy_prefix else text)

    def encode(self, text: str) -> list[int]:
        return [i for c in self.chunks(text) for i in self.encode_chunk(c)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids vanish, byte tokens are read as UTF-8, one leading space is the dummy prefix's."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(utf8(bytes(run)))
                run.clear()
            if i not in self.control:
                out.append(self.unk_surface if i == self.unk else self.piece[i])
        if run:
            out.append(utf8(bytes(run)))
        text = "".join(out)
        if self.dummy_prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")

    def decode_raw(self, ids: list[int]) -> Iterator[str]:
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
            else:
                if run:
                    yield utf8(bytes(run))
                    run = bytearray()
                yield self.piece[i]
        if run:
            yield utf8(bytes(run))

    def known(self, words: set[str]) -> None:
        """Put words, each with a space before it, into the memo; long ones and those that don't decode to themselves stay out.

        The memo has two generations: what is used again stays.
        """
        if len(self.memo) > MEMO // 2:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        for w in words:
            if w in memo or len(w) >= 64:
                continue
            if (found := old.get(w)) is not None:
                memo[w] = found
                continue
            tokens = self.tokens(SPACE + w)
            if None not in (ids := list(map(self.ids.get, tokens))):  # pieces alone decode to themselves
                memo[w] = " ".join(map(str, ids))
                continue
            ids = self.encode_chunk(SPACE + w)
            if "".join(self.decode_raw(ids)) == SPACE + w:
                memo[w] = " ".join(map(str, ids))

    def document(self, text: str | None) -> tuple[str, int, str]:
        """(decimal ids with the end id, their number, decoded text) of a whole text; null counts as empty."""
        if not text:
            return str(self.eos), 1, ""
        if self.dummy_prefix and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            words = text.split(" ")
            memo = self.memo
            try:
                found = list(map(memo.__getitem__, words))
            except KeyError:
                self.known(set(words))
                found = [memo.get(w) for w in words]
                if None in found:
                    found = [" ".join(map(str, self.encode_chunk(SPACE + w))) if f is None else f for w, f in zip(words, found, strict=True)]
                    ids = f"{' '.join(found)} {self.eos}"
                    return ids, ids.count(" ") + 1, self.decode([int(i) for i in ids.split()])
            ids = f"{' '.join(found)} {self.eos}"
            return ids, ids.count(" ") + 1, text
        ids = [*self.encode(text), self.eos]
        return " ".join(map(str, ids)), len(ids), self.decode(ids)


def utf8(raw: bytes) -> str:
    """UTF-8 with one replacement character for each byte that isn't part of a valid sequence."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


_CODECS: dict[str, Codec] = {}
KEPT["sentencepiece"] = _CODECS


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, model: str, key: str = "doc_id", body: str = "text", with_text: bool = True, with_digest: bool = False) -> DataFrame:
    """Per row: key, n_tokens, ids (array<int>, end id last) and, with_text, decoded and, with_digest, decoded_sha256.

    A null text is empty: only the end id, decoded ''.  A null key stays null; repeated rows give repeated results; an
    empty table gives an empty one; only key and body are read, so no other column can clash.  `model` is a path that
    every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = [c.document(t) for t in part.column(1).to_pylist()]
                cols = [part.column(0), pa.array([np.fromstring(r[0], np.int32, sep=" ") for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.int64())]
                if with_text:
                    cols.append(pa.array([r[2] for r in rows], pa.string()))
                if with_digest:
                    cols.append(pa.array([hashlib.sha256(r[2].encode()).hexdigest() for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["k", "ids", "n_tokens", *["decoded"] * with_text, *["decoded_sha256"] * with_digest])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("k"), docs[body].cast("string").alias("b")).mapInArrow(tidied(run, "sentencepiece"), f"k {kind}, ids array<int>, n_tokens bigint" + ", decoded string" * with_text + ", decoded_sha256 string" * with_digest)
    return out.withColumnRenamed("k", key)


def digest_documents(docs: DataFrame, model: str, key: str = "doc_id", body: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256; edge cases as in encode_documents, from the same encoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = [c.document(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r[1] for r in rows], pa.int64()), pa.array([sha(r[0]) for r in rows]), pa.array([sha(r[2]) for r in rows])], ["k", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("k"), docs[body].cast("string").alias("b")).mapInArrow(tidied(run, "sentencepiece"), f"k {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("k", key)
