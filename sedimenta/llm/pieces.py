"""SentencePiece encoding and decoding by suffix-array matching, for byte-pair models.

Texts are cut before each run of spaces; no piece of such a model reaches over such a cut, so units are encoded alone
and a unit that a batch repeats is indexed once. The batch's distinct new units are concatenated and their suffixes
sorted (prefix doubling over 8-byte words); a binary search finds every piece's range of occurrences; the occurrences
are edges, sorted by where they end in their unit, and relaxed in that order: an edge extends the encoding that ends
where it starts if the model would not have merged across the joint. A byte-pair encoding is the one path whose
neighbours are all so compatible. Characters without a piece become edges of byte pieces. Pieces of several spaces are
the last to be formed, so of a unit's leading spaces all but the last wait for the lattice of the rest, and then join
from the left as far as there are pieces, in one pass.

Only byte-pair models whose normaliser changes nothing but spaces are taken; others are an error.

Defined results. Null and empty texts have no ids and decode to an empty text. Decoding gives back the text but for
U+2581, which stands for a space. Repeated rows and null doc_ids are encoded like any other. Extra columns are ignored by
digests() and kept by encode(). An empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.adapters import message_fields
from .base import binary, chunks, ranges
from .token_files import Pool, pieces_of

SPACE = "▁"
_NEVER = float("inf")
#: Bytes of new units that are indexed at once; a longer unit is indexed alone.
INDEXED_BYTES = 128 << 10
#: Units indexed together that are so few that their edges are relaxed one by one.
FEW = 8
#: Units and pairs of pieces that a worker remembers before it starts anew.
UNITS, PAIRS = 250_000, 300_000


def check(path: str) -> None:
    """ValueError unless the file holds a byte-pair model that adds a space before a text and changes nothing else."""
    with open(path, "rb") as f:
        parts = dict(message_fields(f.read()))
    trainer, normaliser = (dict(message_fields(parts.get(k, b""))) for k in (2, 3))
    if trainer.get(3, 1) != 2:
        raise ValueError("not a byte-pair model")
    if normaliser.get(2) or normaliser.get(6) or not normaliser.get(3, 1) or normaliser.get(4, 1) or not normaliser.get(5, 1) or trainer.get(24):
        raise ValueError("a normaliser that changes texts")


class Model:
    """Pieces, scores and merges of a byte-pair model file; encodes lists of units."""

    def __init__(self, path: str):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        check(path)
        n = own.vocab_size()
        self.unknown = own.unk_id()
        self.byte = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(own.is_byte, self.byte)):
            raise ValueError("a model without byte pieces")
        plain = [i for i in range(n) if not (own.is_unknown(i) or own.is_control(i) or own.is_byte(i) or own.is_unused(i))]
        self.text = {i: own.id_to_piece(i) for i in plain}
        self.id = {t: i for i, t in self.text.items()}
        if any(SPACE in t.lstrip(SPACE) for t in self.id):
            raise ValueError("a piece reaches over the start of a word")
        # formed: when a piece comes about, later for lower scores; characters are there from the start
        order = sorted((i for i in plain if len(self.text[i]) > 1), key=lambda i: -own.get_score(i))
        self.formed, now, last = dict.fromkeys(plain, -1), -1, None
        for i in order:
            if own.get_score(i) != last:
                now, last = now + 1, own.get_score(i)
            self.formed[i] = now
        #: Pieces of several spaces by length.
        self.spaces = {len(self.text[i]): i for i in order if SPACE * 2 in self.text[i]}
        if any(set(self.text[i]) != {SPACE} for i in self.spaces.values()) or len({self.formed[i] for i in self.spaces.values()}) > 1:
            raise ValueError("pieces of several spaces hold something else, or differ in score")
        if self.spaces and min(self.formed[i] for i in self.spaces.values()) < now:
            raise ValueError("pieces of several spaces are not the last to be formed")
        self.spaces[1] = self.id[SPACE]
        self.halves: dict[int, tuple[int, int]] = {}
        self.whole = [i for i in plain if len(self.text[i]) == 1]
        for i in order:
            if SPACE * 2 in self.text[i]:
                continue
            steps = self.merge(self.text[i], halves := {})
            if steps == [self.text[i]] and all(self.id.get(x) is not None for x in halves.get(self.text[i], (None,))):
                a, b = halves[self.text[i]]
                self.halves[i] = self.id[a], self.id[b]
                self.whole.append(i)
        self.bytes = {i: t.encode() for i, t in self.text.items()}
        self._index()
        self.known: dict[int, bool] = {}
        self.slots = 1 << 20
        self.key, self.value = np.full(self.slots, -1, np.int64), np.zeros(self.slots, bool)
        self.n = n
        self.pool = Pool(self.encode, UNITS)

    def merge(self, text: str, halves: dict | None = None) -> list[str]:
        """Byte-pair merging step by step: the earliest formed neighbour pair first, then the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.id.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.formed[i] < best):
                    best, at = self.formed[i], k
            if best is None:
                break
            if halves is not None:
                halves[parts[at] + parts[at + 1]] = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the model leaves a joint between these pieces: undo their merges, latest first; none across may come sooner."""
        end = _NEVER
        while True:
            across = self.id.get(self.text[left] + self.text[right])
            if across is not None and self.formed[across] < end:
                return False
            a, b = self.formed[left], self.formed[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                end, left = a, self.halves[left][1]
            else:
                end, right = b + 0.5, self.halves[right][0]

    def _index(self) -> None:
        """Pieces as big-endian 8-byte words, with masks."""
        self.ids = np.array(sorted(self.whole, key=lambda i: self.bytes[i]), np.int64)
        raw = [self.bytes[i] for i in self.ids]
        self.size = np.array([len(r) for r in raw], np.int64)
        self.words = -(-max(map(len, raw)) // 8)
        fill = np.zeros((len(raw), 8 * self.words), np.uint8)
        mask = np.zeros_like(fill)
        for k, r in enumerate(raw):
            fill[k, : len(r)] = np.frombuffer(r, np.uint8)
            mask[k, : len(r)] = 255
        self.piece = fill.view(">u8").astype(np.uint64)
        self.mask = mask.view(">u8").astype(np.uint64)
        self.single = np.array([len(self.text[i]) == 1 for i in self.ids])

    def suffixes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions in order of the bytes that follow, as far as the longest piece; each position's next 8 bytes."""
        n = len(data)
        padded = np.r_[data, np.zeros(8 * self.words + 8, np.uint8)]
        key = np.zeros(n + 8 * self.words, np.uint64)
        for k in range(8):
            key[:n] |= padded[k : n + k].astype(np.uint64) << np.uint64(56 - 8 * k)
        order = np.argsort(key[:n])
        reach = 8
        rank = np.zeros(n + 1, np.int64)
        sorted_key = key[order]
        rank[order] = np.r_[1, 1 + np.cumsum(sorted_key[1:] != sorted_key[:-1])]
        while reach < 8 * self.words and rank.max() < n:
            after = np.zeros(n, np.int64)
            after[: n - reach] = rank[reach:n] if reach < n else 0
            both = rank[:n] * (n + 1) + after
            order = np.argsort(both)
            s = both[order]
            rank[order] = np.r_[1, 1 + np.cumsum(s[1:] != s[:-1])]
            reach *= 2
        return order, key

    def occurrences(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece number, position) of every place where a piece stands, by a binary search for each piece's range."""
        order, key = self.suffixes(data)
        n, found = len(data), []
        leading = key[order]
        bounds = np.searchsorted(leading, self.piece[:, 0]), np.searchsorted(leading, self.piece[:, 0] | ~self.mask[:, 0], "right")
        for upper in (False, True):
            low, high = bounds[0].copy(), bounds[1].copy()
            if upper:
                low[self.size <= 8] = high[self.size <= 8]
            open_ = np.flatnonzero((self.size > 8) & (low < high))
            while len(open_):
                mid = (low[open_] + high[open_]) // 2
                at = order[mid]
                less, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
                for w in range(1, self.words):
                    sub = np.flatnonzero(equal & (self.size[open_] > 8 * w))
                    if not len(sub):
                        break
                    have, want = key[at[sub] + 8 * w] & self.mask[open_[sub], w], self.piece[open_[sub], w]
                    less[sub], equal[sub] = have < want, have == want
                right = less | equal if upper else less
                low[open_[right]] = mid[right] + 1
                high[open_[~right]] = mid[~right]
                open_ = open_[low[open_] < high[open_]]
            found.append(low)
        counts = found[1] - found[0]
        piece = np.repeat(np.arange(len(self.ids)), counts)
        at = order[np.repeat(found[0], counts) + ranges(counts)]
        inside = at + self.size[piece] <= n
        return piece[inside], at[inside]

    def joint(self, left: int, right: int) -> bool:
        """compatible() of two ids; answers are kept. Byte pieces join with anything."""
        key = left * self.n + right
        v = self.known.get(key)
        if v is None:
            v = left not in self.text or right not in self.text or self.compatible(left, right)
            if len(self.known) > PAIRS:
                self.known.clear()
            self.known[key] = v
        return v

    def joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """joint() of pairs of ids, with the answers in a table."""
        key = left * self.n + right
        slot = (key * 0x9E3779B1 >> 7) & (self.slots - 1)
        out = self.value[slot]
        missing = self.key[slot] != key
        if missing.any():
            asked, back = np.unique(key[missing], return_inverse=True)
            said = np.empty(len(asked), bool)
            for k, x in enumerate(asked.tolist()):
                said[k] = self.joint(*divmod(x, self.n))
            out[missing] = said[back]
            self.key[slot[missing]], self.value[slot[missing]] = key[missing], said[back]
        return out

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one after another, and how many each has. A unit starts with spaces, as U+2581, and holds no others."""
        mark = SPACE.encode()
        leading = {k: (len(u) - len(u.lstrip(mark))) // len(mark) for k, u in enumerate(units) if u.startswith(mark * 2)}
        parts, group, held = [(np.empty(0, np.int32), np.empty(0, np.int64))], [], 0
        for k, u in enumerate(units):
            u = u[(leading[k] - 1) * len(mark) :] if k in leading else u
            group.append(u)
            held += len(u)
            if held >= INDEXED_BYTES:
                parts.append(self._lattice(group))
                group, held = [], 0
        if group:
            parts.append(self._lattice(group))
        ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not leading:
            return ids, sizes
        out = np.split(ids, np.cumsum(sizes)[:-1])
        for k, n in leading.items():
            alone = out[k][0] == self.spaces[1]  # the last space joins the others, unless it has joined the word
            out[k] = np.concatenate([self.joined_spaces(n if alone else n - 1), out[k][1:] if alone else out[k]])
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def joined_spaces(self, n: int) -> np.ndarray:
        """Ids of n spaces: the leftmost two neighbours that make a piece join first."""
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.spaces:
                last = stack.pop()
                stack[-1] += last
        return np.array([self.spaces[x] for x in stack], np.int32)

    def _lattice(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(units), np.uint8)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(lengths)
        begins = ends - lengths
        piece, start = self.occurrences(data)
        heads = (data & 0xC0) != 0x80
        covered = ~heads
        covered[start[self.single[piece]]] = True
        token = self.ids[piece]
        size = self.size[piece]
        bare = np.flatnonzero(~covered)
        if len(bare):  # characters without a piece: an edge for each byte
            after = np.flatnonzero(heads)
            after = np.r_[after[1:], len(data)][np.searchsorted(after, bare)]
            at = np.repeat(bare, after - bare) + ranges(after - bare)
            start, size = np.r_[start, at], np.r_[size, np.ones(len(at), np.int64)]
            token = np.r_[token, np.array(self.byte, np.int64)[data[at]]]
        unit_of = np.repeat(begins, lengths)
        end = start + size
        level = end - unit_of[start]
        by = np.argsort(level.astype(np.uint16 if level.max() < 1 << 16 else np.int64), kind="stable")
        start, end, token, size, level = start[by], end[by], token[by], size[by], level[by]
        first = start == unit_of[start]
        last, step = np.full(len(data) + 1, -1, np.int64), np.zeros(len(data) + 1, np.int64)
        # last[p]: the id that ends the encoding of the unit as far as p; each unit's start is also the one before's end
        cuts = np.r_[0, np.flatnonzero(np.diff(level)) + 1, len(level)]
        if len(units) <= FEW:  # long units: levels of a few edges
            last, step = last.tolist(), step.tolist()
            for s, e, t, n, f in zip(*(x.tolist() for x in (start, end, token, size, first)), strict=True):
                if f or last[s] >= 0 and self.joint(last[s], t):
                    last[e], step[e] = t, n
            return self._walked(last, step, begins.tolist(), ends.tolist())
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            s, t = start[a:b], token[a:b]
            before = last[s]
            good = first[a:b].copy()
            ask = np.flatnonzero(~good & (before >= 0))
            good[ask] = self.joins(before[ask], t[ask])
            e = end[a:b][good]
            last[e], step[e] = t[good], size[a:b][good]
        at, out_unit, out_id = ends.copy(), [], []
        live = np.arange(len(units))
        while len(live):
            here = at[live]
            out_unit.append(live)
            out_id.append(last[here])
            if (step[here] == 0).any():
                raise ValueError("a unit has no encoding")
            at[live] = here - step[here]
            live = live[at[live] > begins[live]]
        unit = np.concatenate(out_unit)
        order = np.lexsort((-np.arange(len(unit)), unit))
        return np.concatenate(out_id)[order].astype(np.int32), np.bincount(unit, minlength=len(units))

    @staticmethod
    def _walked(last: list[int], step: list[int], begins: list[int], ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The encodings that end where the units do."""
        out, sizes = [], []
        for begin, at in zip(begins, ends, strict=True):
            own = []
            while at > begin:
                if not step[at]:
                    raise ValueError("a unit has no encoding")
                own.append(last[at])
                at -= step[at]
            out += own[::-1]
            sizes.append(len(own))
        return np.array(out, np.int32), np.array(sizes, np.int64)

    def piece_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of bytes of each id, and the bytes of all ids, where piece_at says."""
        if not hasattr(self, "piece_at"):
            back = self.bytes | {i: bytes([b]) for b, i in enumerate(self.byte)}
            raw = [back.get(i, b"") for i in range(self.n)]
            self._size = np.array([len(r) for r in raw], np.int64)
            self._table = np.frombuffer(b"".join(raw), np.uint8)
            self.piece_at = np.cumsum(self._size) - self._size
        return self._size, self._table

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offsets of the texts in them."""
        data, offsets = binary(column)
        lengths = np.diff(offsets)
        some = np.flatnonzero(lengths)
        data = np.insert(data, offsets[some], 32)
        offsets = np.r_[0, np.cumsum(lengths + (lengths > 0))]
        space = data == 32
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(column) + 1, np.int64)
        begin = space.copy()
        begin[1:] &= ~space[:-1] | cut[1:-1]
        starts = np.flatnonzero(begin)
        # spaces become U+2581, of three bytes
        wide = np.ones(len(data), np.int64)
        wide[space] = 3
        place = np.r_[0, np.cumsum(wide)]
        spread = np.repeat(data, wide)
        marks = place[:-1][space]
        spread[marks], spread[marks + 1], spread[marks + 2] = 0xE2, 0x96, 0x81
        numbers = self.pool.numbers(pieces_of(spread, place[starts], place[starts], int(place[-1])))
        ids, sizes = self.pool.gather(numbers)
        first = np.searchsorted(starts, offsets)
        return ids, np.r_[0, np.cumsum(sizes)][first]

    def decode(self, ids: np.ndarray) -> str:
        """The text of one list of ids: pieces joined, U+2581 as spaces, without the first one."""
        size, table = self.piece_bytes()
        raw = table[np.repeat(self.piece_at[ids], size[ids]) + ranges(size[ids])].tobytes()
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of this file, one for each Python worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


#: Bytes of text that a worker encodes at once.
TEXT_BYTES = 1 << 20


def encode(documents: DataFrame, path: str, column: str = "text", to: str = "ids") -> DataFrame:
    """documents with a column `to` of ids (array<int>, never null); a column of that name is replaced."""
    kept = [f for f in documents.schema.fields if f.name != to]

    def run(batches):
        for batch in chunks(batches, column, TEXT_BYTES):
            ids, offsets = model(path).texts(batch.column(column))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                names=[*[f.name for f in kept], to]
            )

    schema = T.StructType([*kept, T.StructField(to, T.ArrayType(T.IntegerType()))])
    return documents.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, column: str = "ids", to: str = "decoded") -> DataFrame:
    """encoded with a text column `to`; null ids give an empty text."""

    def run(batches):
        for batch in batches:
            texts = [model(path).decode(np.array(x or [], np.int64)) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, to])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(to, T.StringType())]))


def digests(documents: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_crc32 (ids as little-endian 32-bit integers), decoded_crc32 and same (whether decoding gives the text back)."""

    def run(batches):
        for batch in chunks(batches, "text", TEXT_BYTES):
            own = model(path)
            ids, offsets = own.texts(batch.column("text"))
            raw = memoryview(ids.astype("<u4", copy=False).view(np.uint8))
            size, table = own.piece_bytes()
            byte_at = np.r_[0, np.cumsum(size[ids])]
            whole = table[np.repeat(own.piece_at[ids], size[ids]) + ranges(size[ids])].tobytes()
            crc, back, same = [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                a, b = int(offsets[k]), int(offsets[k + 1])
                decoded = whole[byte_at[a] : byte_at[b]].replace(b"\xe2\x96\x81", b" ")[1:]
                crc.append(zlib.crc32(raw[4 * a : 4 * b]))
                back.append(zlib.crc32(decoded))
                same.append(decoded == (text or "").encode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(crc, pa.int64()), pa.array(back, pa.int64()), pa.array(same)],
                names=["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "same"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, same boolean")
