"""Token ids in ORC: stripes with run-length encoded integers, row indexes and a Bloom filter on doc_id.

Rows are dealt into ranges of doc_id and sorted, tokenised where they lie and written once: one file a range, each row
with its range, the ids before it in the range and its own. Readers split by stripes and prune stripes and row groups
by doc_id.

Tokenising keeps, for each Python worker, a bounded memory of encoded pieces of text. For tokenizers that drop white
space and split letters from the rest, a text is cut where their rules always cut: at ASCII white space, and between an
ASCII letter and an ASCII character that is no letter and no apostrophe; runs of lower-case Latin letters then go to
the tokenizer's model itself, other pieces through all of its steps. Other tokenizers, and texts with the mark of a
special token, get whole texts.

Defined results. Null text: as empty, so the end id alone. Null doc_ids come first. Ties in doc_id are ordered by the
text's CRC-32. Repeated rows are all written. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import binary, chunks, ranges, shared_dir

END_ID = 1
#: Pieces that a worker remembers before it starts anew.
REMEMBERED = 1_000_000
#: Pieces of text that go to the tokenizer in one call.
JOINED = 4096

#: Bytes of text that a worker tokenises at once.
TEXT_BYTES = 1 << 20

_SCHEMA = "doc_id long, range int, before long, n_tokens long, ids array<int>"


class Pool:
    """Encoded pieces: bytes to a number, and each number's ids."""

    def __init__(self, encode, bound: int = REMEMBERED):
        self.encode, self.bound = encode, bound
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.start, self.size = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = 0

    def add(self, pieces: list[bytes]) -> None:
        flat, sizes = self.encode(pieces)
        have, upto = len(self.number), self.used + len(flat)
        if upto > len(self.ids):
            self.ids = np.resize(self.ids, max(upto, 2 * len(self.ids)))
        if have + len(pieces) > len(self.start):
            room = max(have + len(pieces), 2 * len(self.start))
            self.start, self.size = np.resize(self.start, room), np.resize(self.size, room)
        self.ids[self.used : upto] = flat
        self.start[have : have + len(pieces)] = self.used + np.cumsum(sizes) - sizes
        self.size[have : have + len(pieces)] = sizes
        self.used = upto
        self.number.update(zip(pieces, range(have, have + len(pieces)), strict=True))

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each piece of a binary array."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.number) + len(distinct) > self.bound:
            self.clear()
        new = [p for p in distinct if p not in self.number]
        if new:
            self.add(new)
        own = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        return own[coded.indices.to_numpy()] if len(distinct) else np.empty(0, np.int64)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces, one after another, and how many each has."""
        sizes = self.size[numbers]
        return self.ids[np.repeat(self.start[numbers], sizes) + ranges(sizes)], sizes


def pieces_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, total: int) -> pa.Array:
    """A binary array of contiguous pieces."""
    offsets = pa.py_buffer(np.r_[starts, total].astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(data)])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32
_KIND = np.zeros(256, np.uint8)  # 1: ASCII letter, 2: other ASCII but the apostrophe, 0: the rest
_KIND[33:128] = 2
_KIND[97:123] = 1
_KIND[65:91] = 1
_KIND[39] = 0

#: Steps before the model in tokenizers whose texts may be cut.
_NORMALISERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_tokenizers: dict[str, tuple] = {}


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers put for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _cuttable(own) -> bool:
    spec = json.loads(own.to_str())
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    return [x["type"] for x in steps] == _NORMALISERS and split[0].get("pattern") == {"Regex": _SPLIT} and split[0].get("behavior") == "Removed" and [x["type"] for x in split] == ["Split", "ByteLevel"] and not split[1]["add_prefix_space"]


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        special = [t.content.encode() for t in own.get_added_tokens_decoder().values()]
        model, letters = own.model, _byte_letters()

        def encode(pieces: list[bytes]):
            out: list = [None] * len(pieces)
            others = []
            for k, piece in enumerate(pieces):
                text = piece.decode()
                if text.isalpha() and text.islower() and max(text) < "\u0250":
                    if not text.isascii():
                        text = piece.decode("latin-1").translate(letters)
                    out[k] = [t.id for t in model.tokenize(text)]
                else:
                    others.append((k, text))
            for at in range(0, len(others), JOINED):
                part = others[at : at + JOINED]
                for (k, _), e in zip(part, own.encode_batch_fast([t for _, t in part], add_special_tokens=False), strict=True):
                    out[k] = e.ids
            sizes = np.fromiter(map(len, out), np.int64, len(out))
            return np.fromiter(itertools.chain.from_iterable(out), np.int32, int(sizes.sum())), sizes

        _tokenizers[path] = own, Pool(encode) if _cuttable(own) else None, special
    return _tokenizers[path]


def tokenise(column: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each with end_id behind it, and the offsets of the texts in them."""
    own, pool, special = _tokenizer(path)
    if pool is None:
        ids = [[*e.ids, end_id] for e in own.encode_batch_fast([t or "" for t in column.to_pylist()], add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum())), np.r_[0, np.cumsum(sizes)]
    data, offsets = binary(column)
    whole: dict[int, list[int]] = {}
    raw = data.tobytes()
    if any(s[:2] in raw for s in special):
        lengths = np.diff(offsets)
        for d in range(len(column)):
            text = raw[offsets[d] : offsets[d + 1]]
            if any(s[:2] in text for s in special):
                whole[d] = own.encode(text.decode(), add_special_tokens=False).ids
                lengths[d] = 0
        data = np.concatenate([data[offsets[d] : offsets[d] + n] for d, n in enumerate(lengths.tolist())])
        offsets = np.r_[0, np.cumsum(lengths)]
    data = _LOWER[data]
    solid = data != 32
    kind = _KIND[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    if len(data):
        both = kind[1:] + kind[:-1]
        cut[1:-1] |= ~solid[:-1] | ((both == 3) & (kind[1:] != 0) & (kind[:-1] != 0))
        starts = np.flatnonzero(solid & cut[:-1])
        left = np.r_[0, np.cumsum(solid)]
        numbers = pool.numbers(pieces_of(data[solid], left[starts], left[starts], int(left[-1])))
    else:
        starts = numbers = np.empty(0, np.int64)
    ids, sizes = pool.gather(numbers)
    first = np.searchsorted(starts, offsets)
    per_text = np.diff(np.r_[0, np.cumsum(sizes)][first])
    for d, x in whole.items():
        per_text[d] = len(x)
    ends = np.cumsum(per_text + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int32)
    place = np.ones(len(out), bool)
    place[ends - 1] = False
    for d, x in whole.items():
        out[ends[d] - 1 - len(x) : ends[d] - 1] = x
        place[ends[d] - 1 - len(x) : ends[d] - 1] = False
    out[place] = ids
    return out, np.r_[0, ends]


def write_ids(
    documents: DataFrame,
    to: str,
    tokenizer: str,
    end_id: int = END_ID,
    partitions: int | None = None,
    stripe_bytes: int = 16 << 20,
    row_group: int = 10_000
) -> None:
    """Writes the token ids of all documents, in ascending doc_id order, as ORC files in the folder `to`."""

    def run(batches):
        before, part = 0, TaskContext.get().partitionId()
        for batch in chunks(batches, "text", TEXT_BYTES):
            ids, offsets = tokenise(batch.column("text"), tokenizer, end_id)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(rows, part, np.int32)),
                    pa.array(before + offsets[:-1]),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                ],
                names=["doc_id", "range", "before", "n_tokens", "ids"],
            )
            before += int(offsets[-1])

    n = partitions or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("crc"))
    ranged = rows.repartitionByRange(n, "doc_id", "crc").sortWithinPartitions("doc_id", "crc").select("doc_id", "text")
    options = {
        "orc.compress": "ZSTD",
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": "0.01",
        "orc.stripe.size": str(stripe_bytes),
        "orc.row.index.stride": str(row_group)
    }
    ranged.mapInArrow(run, _SCHEMA).write.options(**options).orc(to)


def read_ids(spark: SparkSession, where: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files that write_ids has left; filters on doc_id prune stripes and row groups."""
    rows = spark.read.schema(_SCHEMA).orc(where)
    offsets, before = [], 0
    for r in sorted(rows.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect()):  # a row a file
        offsets.append((r["range"], before))
        before += r["n"]
    starts = spark.createDataFrame(offsets, "range int, offset long")
    return rows.join(F.broadcast(starts), "range").select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids")


def token_digests(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the ids to the shared folder, reads them back: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        for batch in batches:
            column = batch.column("ids")
            offsets, values = column.offsets.to_numpy(), memoryview(column.values.to_numpy().astype("<u4", copy=False).view(np.uint8))
            crc = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    where = shared_dir(documents.sparkSession)
    write_ids(documents, where, tokenizer, end_id)
    return read_ids(documents.sparkSession, where).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
