"""Sentence-piece encoding that projects every piece to the source bytes it stands for, and its decoding.

A text is normalised by longest prefixes through the model's compiled character map, a double-array
trie over UTF-8; every character of the result remembers the source character that it comes
from.  The normalised text is cut where no piece of the model can reach across, between a word's last
character and the next space mark; those units are merged into pieces, the best score and then the
leftmost pair first, and equal units share their pieces.  Characters that are no piece become byte pieces.  A
piece's end in the normalised text is carried through the alignment to a byte offset of the source: it starts
where the one before it ends, byte pieces but a character's last are empty.  Everything is one pass
over the texts without a shuffle, and a task holds one batch of texts and a bounded cache.

`ids` and `ends` are packed little-endian unsigned 32-bit integers, as training shards hold them
(`unpack`).  Begin and end marks are empty pieces.

Edge cases: null and empty texts are the two marks only and decode to an empty text; rows are
independent, so repeated and null ids stay as they are; other columns of `docs` are left aside.  Models must be
of the BPE kind without user-defined pieces (ValueError).
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from linkrec.llm.common import small_batches

SPACE = "▁"
#: Units of up to so many characters are kept, so many of them, and so many characters are returned at once.
CACHED_CHARS, CACHE, CHUNK_CHARS = 48, 200_000, 4_000_000
# The kinds of pieces in a model file, the kind of a BPE model, the text of an unknown piece.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2
UNKNOWN_TEXT = " ⁇ "
NEVER = float("-inf")


def wire_fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message's fields, in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7
    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            size = varint() if size is None else size
            yield key >> 3, data[at:at + size]
            at += size


class CharMap:
    """A compiled character map: a double-array trie of UTF-8 keys, then their NUL-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size:]
        self.single: dict[str, str] = {}

    def longest(self, text: str, at: int) -> tuple[str, int]:
        """The replacement of the longest key that starts at `at`, and the key's characters; a
        character without a key stands for itself."""
        known = self.single.get(text[at])
        if known is not None:
            return known, 1
        best, end, units = (text[at], 1), at, self.units
        node = self._child(0, units[0])
        while end < len(text):
            for byte in text[end].encode():
                node ^= byte
                unit = units[node] if node < len(units) else 0
                if unit & 0x800000FF != byte:
                    if end == at:
                        self.single[text[at]] = best[0]     # no key goes on from this character
                    return best
                node = self._child(node, unit)
                if unit >> 8 & 1:
                    best = (self._replacement(units[node] & 0x7FFFFFFF), end + 1 - at)
            end += 1
        return best

    @staticmethod
    def _child(node: int, unit: int) -> int:
        return node ^ (unit >> 10) << ((unit & 0x200) >> 6)

    def _replacement(self, at: int) -> str:
        return self.texts[at:self.texts.index(b"\0", at)].decode()


class PieceModel:
    """The pieces and normalisation rules of a model file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        rules, trainer = {}, {}
        for number, value in wire_fields(data):
            if number == 1:
                piece = dict(wire_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(wire_fields(value))
            elif number == 3:
                rules = dict(wire_fields(value))
        if trainer.get(3, 1) != BPE_MODEL or USER in self.kinds:
            raise ValueError("only BPE models without user-defined pieces are supported")
        self.prefix, self.squeeze, self.escape = (bool(rules.get(k, 1)) for k in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))
        self.map = CharMap(rules.get(2, b""))
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.fallback = bool(trainer.get(35, 0)) and len(self.bytes) == 256
        self.unknown = self.kinds.index(UNKNOWN)
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, UNUSED)}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.unused = {p for p, i in self.ids.items() if self.kinds[i] == UNUSED}
        marks = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == CONTROL}
        self.begin, self.end = marks["<s>"], marks["</s>"]
        # a unit ends before a space mark, unless some piece holds one behind another character, and
        # characters that no longer piece holds are units of their own
        inner = "".join(sorted({c for p in self.ids if len(p) > 1 for c in p} - {SPACE}))
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.unit = re.compile("(?s)" + (".+" if crossing or not inner else
                                         f"{SPACE}*[{re.escape(inner)}]+|{SPACE}+|."))
        self.joined = {ab for p in self.ids for ab in zip(p, p[1:])}
        self.recent: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.surface = [self._bytes_of(i) for i in range(len(self.pieces))]

    def _bytes_of(self, i: int) -> bytes:
        kind, piece = self.kinds[i], self.pieces[i]
        if kind == CONTROL:
            return b""
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        return (UNKNOWN_TEXT if kind == UNKNOWN else piece.replace(SPACE, " ")).encode()

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters and its end the source character it comes from."""
        space = SPACE if self.escape else " "
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            body = text.replace(" ", space)
            at = np.arange(len(text) + 1)
            if self.prefix and self.suffix:
                return body + space, np.append(at, len(text))
            return (space + body, np.concatenate(([0], at))) if self.prefix else (body, at)
        out, source, at, n = [], [], 0, len(text)

        def step() -> tuple[str, int]:
            return self.map.longest(text, at) if self.map.units else (text[at], 1)
        while self.squeeze and at < n and step()[0] == " ":
            at += step()[1]
        if at == n:
            return "", np.array([n])
        if self.prefix and not self.suffix:
            out.append(space)
            source.append(at)
        after_space = self.squeeze
        while at < n:
            new, used = step()
            if after_space:
                new = new.lstrip(" ")
            if new:
                out.append(new.replace(" ", space))
                source += [at] * len(new)
                after_space = self.squeeze and new.endswith(" ")
            at += used
        whole, end = "".join(out), n
        while self.squeeze and whole.endswith(space):
            whole, end = whole[:-1], source.pop()
        if self.prefix and self.suffix:
            whole += space
            source.append(end)
        return whole, np.array([*source, end])

    def segment(self, unit: str) -> list[str]:
        """The unit's pieces: neighbours are merged while their union is a piece."""
        if len(unit) > CACHED_CHARS or self.unused:
            return self._segment_long(unit)
        parts, score = list(unit), self.score.get
        near = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while near and (best := max(near)) > NEVER:
            i = near.index(best)                               # the leftmost of the best
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i:
                near[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(near):
                near[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def _segment_long(self, unit: str) -> list[str]:
        """The same for long units, with a heap of the pairs."""
        parts: list[str | None] = list(unit)
        n, score, halves = len(parts), self.score, {}
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            s = score.get(both)
            if s is not None:
                heapq.heappush(heap, (-s, i, j, both))
                if both in self.unused:
                    halves[both] = (parts[i], parts[j])
        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or len(parts[i]) + len(parts[j]) != len(both):
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        out = [p for p in parts if p is not None]
        while any(p in halves for p in out):                   # pieces out of use fall apart again
            out = [q for p in out for q in halves.get(p, (p,))]
        return out

    def unit_ids(self, unit: str) -> tuple[bytes, bytes]:
        """Packed ids and character counts of a unit's pieces, kept in the cache.  The unit falls into parts
        where two characters stand together in no piece."""
        joined = self.joined
        at = [0, *[i for i, ab in enumerate(zip(unit, unit[1:]), 1) if ab not in joined], len(unit)]
        parts = [unit[a:b] for a, b in zip(at, at[1:])]
        found = [self.recent.get(p) or self.older.get(p) or self._keep(p, self._part_ids(p)) for p in parts]
        return found[0] if len(found) == 1 else self._keep(
            unit, (b"".join([f[0] for f in found]), b"".join([f[1] for f in found])))

    def _keep(self, unit: str, packed: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
        """The units met last: when they are too many, those that were not met again since the last time go."""
        if len(unit) <= CACHED_CHARS:
            if len(self.recent) >= CACHE:
                self.recent, self.older = {}, self.recent
            self.recent[unit] = packed
        return packed

    def _part_ids(self, part: str) -> tuple[bytes, bytes]:
        ids, sizes = [], []
        for p in self.segment(part):
            i = self.ids.get(p, self.unknown)
            if i == self.unknown and self.fallback:
                raw = p.encode()
                ids += [self.bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [len(p)]
            else:
                ids.append(i)
                sizes.append(len(p))
        return struct.pack(f"<{len(ids)}I", *ids), struct.pack(f"<{len(ids)}I", *sizes)

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Packed ids of a text with both marks, and the source byte at which each piece ends."""
        text = text or ""
        normal, source = self.normalise(text)
        found = []
        for unit in self.unit.findall(normal):
            packed = self.recent.get(unit)
            if packed is None:
                packed = self.older.get(unit)
                packed = self._keep(unit, packed) if packed else self.unit_ids(unit)
            found.append(packed)
        ids = b"".join([p[0] for p in found])
        if not self.fallback:
            return self._joined_unknown(ids, found, source, text)
        ends = source[np.cumsum(np.frombuffer(b"".join([p[1] for p in found]), "<u4"), dtype=np.int64)]
        return self._marked(ids, ends, source, text)

    def _joined_unknown(self, ids: bytes, found: list, source: np.ndarray, text: str) -> tuple[bytes, bytes]:
        """Without byte pieces, neighbouring unknown characters are one unknown piece."""
        i = np.frombuffer(ids, "<u4")
        ends = source[np.cumsum(np.frombuffer(b"".join([p[1] for p in found]), "<u4"), dtype=np.int64)]
        last = np.append((i[:-1] != self.unknown) | (i[1:] != self.unknown), True) if len(i) else np.zeros(0, bool)
        return self._marked(i[last].tobytes(), ends[last], source, text)

    def _marked(self, ids: bytes, ends: np.ndarray, source: np.ndarray, text: str) -> tuple[bytes, bytes]:
        ends = np.concatenate((source[:1] if len(ends) else source[-1:], ends, source[-1:]))
        if not text.isascii():
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            ends = np.concatenate(([0], np.cumsum(width)))[ends]
        first, last = (np.array([m], "<u4").tobytes() for m in (self.begin, self.end))
        return first + ids + last, ends.astype("<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: marks are empty, the first piece loses the space mark that was put in front, and
        each byte that is no part of a character becomes U+FFFD."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        parts = list(map(self.surface.__getitem__, numbers))
        if self.prefix or self.squeeze:
            for k, i in enumerate(numbers):
                if self.kinds[i] != CONTROL:
                    if self.kinds[i] not in (BYTE, UNKNOWN) and parts[k].startswith(b" "):
                        parts[k] = parts[k][1:]
                        if self.squeeze and not parts[k]:
                            continue
                    break
        return b"".join(parts).decode("utf-8", "each_byte")


codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


@lru_cache(maxsize=2)
def load_model(data: bytes) -> PieceModel:
    """One model and one cache of units for all tasks of a worker."""
    return PieceModel(data)


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def spans(ends: bytes) -> list[tuple[int, int]]:
    """The byte span of every piece: from the end of the one before to its own."""
    e = unpack(ends)
    return list(zip(e[:1] + e[:-1], e))


def encode_pieces(docs: DataFrame, model: str, decode: bool = True) -> DataFrame:
    """(doc_id, ids, ends, decoded) of every document: packed ids with both marks, the source
    byte at which each piece ends, and, if wanted, the text that the ids decode to (else null).
    The model file is read by the driver alone and sent to the tasks; it does not grow with the data."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(model, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load_model(data.value)
        for pdf in batches:
            rows, chars = [], 0
            for i, text in zip(pdf["doc_id"], pdf["text"]):
                ids, ends = pieces.encode(text)
                rows.append((None if pd.isna(i) else int(i), ids, ends, pieces.decode(ids) if decode else None))
                chars += len(text or "")
                if chars > CHUNK_CHARS:
                    yield _frame(rows)
                    rows, chars = [], 0
            yield _frame(rows)
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInPandas(
        run, "doc_id long, ids binary, ends binary, decoded string")


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "ids", "ends", "decoded"]).astype({"doc_id": "Int64"})
