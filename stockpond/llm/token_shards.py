"""Token ids in training order: sequences of fixed length, shuffled by a keyed permutation, in files of fixed stride.

Every text becomes token ids, closed by the end-of-text id; the ids of all
texts in a row are cut into sequences of ``length`` ids (the last one is
filled with end ids). A Feistel network over the next even power of two,
walking its cycles until it lands below the number of sequences, maps the
number of a sequence to its *slot*: a permutation that anyone with the key can
recompute or invert. Slot ``s`` is record ``s % per_shard`` of shard
``s // per_shard``, at byte ``record * 2 * length``; ids are unsigned 16-bit
numbers, lowest byte first. A reader goes on from any slot by seeking there.

Texts are tokenised once and staged, compressed, each with the number of ids
before it in its task; the sizes of the tasks, one row each, add up to its
place. Pieces of sequences are dealt out by ranges of shards, and one task
writes whole shards: under a name of its own first, then moved, so a repeated
task leaves the same files.

Null and empty texts are just the end id. Repeated rows are repeated texts.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockpond.llm.common import map_rows, mix64, ranges
from stockpond.session import stage

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public byte-level tokenizer cuts texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Permutation:
    """A keyed bijection of 0..n-1: a balanced Feistel network with cycle walking."""

    def __init__(self, n: int, key: str, rounds: int = 6):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        digest = hashlib.blake2b(key.encode(), digest_size=8 * rounds).digest()
        self.keys = np.frombuffer(digest, "<u8")

    def _once(self, x: np.ndarray, keys: np.ndarray, inverse: bool) -> np.ndarray:
        mask, bits = np.uint64((1 << self.half) - 1), np.uint64(self.half)
        left, right = x >> bits, x & mask
        for key in keys:
            if inverse:
                left, right = right ^ (mix64(left ^ key) & mask), left
            else:
                left, right = right, left ^ (mix64(right ^ key) & mask)
        return (left << bits) | right

    def _walk(self, x: np.ndarray, keys: np.ndarray, inverse: bool) -> np.ndarray:
        out = self._once(np.asarray(x).astype(np.uint64), keys, inverse)
        while (outside := np.flatnonzero(out >= self.n)).size:
            out[outside] = self._once(out[outside], keys, inverse)
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self.keys, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self.keys[::-1], True)


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


class _Packing:
    """Compression of short runs of ids against common ones, which a run of a few kilobytes is too short to hold itself.

    ``common`` only shortens the packed form; runs without anything in common with it unpack as well.
    """

    LEVEL = 6

    def __init__(self, common: bytes):
        self.common = common

    def _shared(self):
        import zstandard

        return zstandard.ZstdCompressionDict(self.common, dict_type=zstandard.DICT_TYPE_RAWCONTENT)

    def packer(self) -> Callable[[bytes], bytes]:
        import zstandard

        shared = self._shared()
        shared.precompute_compress(level=self.LEVEL)
        return zstandard.ZstdCompressor(level=self.LEVEL, dict_data=shared).compress

    def unpacker(self) -> Callable[[bytes], bytes]:
        import zstandard

        return zstandard.ZstdDecompressor(dict_data=self._shared()).decompress


def _coder(table: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def _id_bytes(ids: array) -> bytes:
    """The ids, lowest byte first."""
    import sys

    if sys.byteorder == "big":
        ids = array("H", ids)
        ids.byteswap()
    return ids.tobytes()


def common_ids(docs: DataFrame, table: dict[bytes, int], texts: int = 64, size: int = 1600) -> bytes:
    """About 50 KB of ids for ``_Packing``: the beginnings, ``size`` characters long, of at most ``texts`` texts."""
    some = docs.where(F.length("text") > 0).select(F.substring("text", 1, size).alias("text")).limit(texts).collect()
    coder = _coder(table)
    return b"".join(_id_bytes(array("H", coder.encode_ordinary(r["text"]))) for r in some) or bytes(16)


def tokenise(docs: DataFrame, table: dict[bytes, int], packing: _Packing) -> DataFrame:
    """(doc_id, part, inside, n_tokens, ids): ids of each text with the end id, as compressed bytes.

    ``inside`` counts the ids before the text in its task ``part``. Both hold
    only in a written copy: a task that runs again may see its rows in another
    order, but a written part comes from one run.
    """
    if len(table) >= 1 << 16:
        raise ValueError("ids of this vocabulary do not fit 16 bits")
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def make():
        from pyspark import TaskContext

        coder, pack = _coder(shared.value), packing.packer()
        end = len(shared.value)
        part = TaskContext.get().partitionId()
        before = 0

        def step(rows: dict[str, list]) -> dict[str, list]:
            nonlocal before
            ids = [array("H", coder.encode_ordinary(t or "")) for t in rows["text"]]
            for each in ids:
                each.append(end)
            sizes = np.array([len(each) for each in ids], np.int64)
            inside = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            return {"doc_id": rows["doc_id"], "part": [part] * len(ids), "inside": inside, "n_tokens": sizes,
                    "ids": [pack(_id_bytes(each)) for each in ids]}

        return step

    kind = dict(docs.dtypes)["doc_id"]
    return map_rows(docs.select("doc_id", "text"), make,
                    f"doc_id {kind}, part int, inside bigint, n_tokens bigint, ids binary")


def _placed(tokens: DataFrame) -> tuple[DataFrame, int]:
    """The staged texts with the number of ids before each, and the number of all ids."""
    staged = stage(tokens, "tokens")
    sizes = staged.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # one row per task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return staged.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids"), total


def write_shards(
    docs: DataFrame, path: str, length: int = 2048, per_shard: int = 4096, key: str = "epoch-0", ranks: str = DEFAULT_RANKS,
) -> DataFrame:
    """Write the shards below ``path`` and return one row per sequence.

    Columns: slot, number (before the permutation), shard, byte_offset, crc32
    of the record, and first_doc, the ``doc_id`` its first id belongs to.
    """
    spark = docs.sparkSession
    table = read_ranks(ranks)
    end = len(table)
    packing = _Packing(common_ids(docs, table))
    placed, total = _placed(tokenise(docs, table, packing))
    sequences = -(-total // length)
    kind = dict(docs.dtypes)["doc_id"]
    ddl = f"slot bigint, number bigint, shard bigint, byte_offset bigint, crc32 bigint, first_doc {kind}"
    if not sequences:
        return spark.createDataFrame([], ddl)
    order = Permutation(sequences, key)

    def make():
        pack, unpack = packing.packer(), packing.unpacker()

        def step(rows: dict[str, list]) -> dict[str, list]:
            # The sequences that each text touches, and the part of the text in each.
            start, size = np.array(rows["start"], np.int64), np.array(rows["n_tokens"], np.int64)
            touched = (start + size - 1) // length - start // length + 1
            owner = np.repeat(np.arange(len(start)), touched)
            number = ranges(touched) + (start // length)[owner]
            first = np.maximum(start[owner], number * length)
            last = np.minimum((start + size)[owner], (number + 1) * length)
            slot = order.slots(number)
            ids: list[bytes] = []
            spans = zip(owner.tolist(), (2 * (first - start[owner])).tolist(), (2 * (last - start[owner])).tolist(), strict=True)
            text, whole = -1, b""
            for k, a, b in spans:
                if k != text:
                    text, whole = k, unpack(rows["ids"][k])
                ids.append(pack(whole[a:b]))
            return {"shard": slot // per_shard, "slot": slot, "number": number, "at": first - number * length,
                    "doc_id": [rows["doc_id"][k] for k in owner.tolist()], "ids": ids}

        return step

    pieces = map_rows(placed, make, f"shard bigint, slot bigint, number bigint, at int, doc_id {kind}, ids binary", rows=256)
    shards = -(-sequences // per_shard)
    tasks = min(shards, 10_000)
    # Slots are uniform and dense, so the ranges are known and need no sampling pass over the pieces.
    dealt = pieces.repartitionById(tasks, F.expr(f"cast(shard * {tasks} div {shards} as int)"))
    root = path.rstrip("/")
    _make_folder(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = packing.unpacker()
        shard, file, record = None, None, None
        rows: list[tuple] = []

        def flush() -> None:
            if record is not None:
                slot, number, parts, doc = record
                ids = b"".join(parts)
                ids += np.full(length - len(ids) // 2, end, "<u2").tobytes()
                file.write(ids)
                rows.append((slot, number, slot // per_shard, slot % per_shard * 2 * length, zlib.crc32(ids), doc))

        for batch in batches:
            columns = batch.to_pydict()
            for s, slot, number, doc, ids in zip(*(columns[c] for c in ("shard", "slot", "number", "doc_id", "ids")), strict=True):
                if record is None or slot != record[0]:
                    flush()
                    record = None
                    if s != shard:
                        if file is not None:
                            file.close()
                        shard, file = s, _Shard(root, s)
                    record = (slot, number, [], doc)
                record[2].append(unpack(ids))
            yield _written(rows, ddl_schema)
            rows.clear()
        flush()
        if file is not None:
            file.close()
        yield _written(rows, ddl_schema)

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    ddl_schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    return stage(dealt.sortWithinPartitions("slot", "at").mapInArrow(write, ddl), "manifest")


def _written(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _store(path: str):
    """The Arrow file system of a path with or without a scheme, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _make_folder(path: str) -> None:
    store, place = _store(path)
    store.create_dir(place, recursive=True)


class _Shard:
    """A shard in writing; it gets its name when it is complete."""

    def __init__(self, root: str, shard: int):
        self.store, place = _store(root)
        self.name = f"{place}/{shard_name(shard)}"
        self.temporary = f"{place}/_writing-{uuid.uuid4().hex}"
        self.stream = self.store.open_output_stream(self.temporary)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.store.move(self.temporary, self.name)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def read_sequences(path: str, first: int, last: int, length: int = 2048, per_shard: int = 4096) -> Iterator[np.ndarray]:
    """The sequences of slots ``first`` to ``last`` - 1 in training order; start anywhere to resume."""
    store, place = _store(path.rstrip("/"))
    stride = 2 * length
    slot = first
    while slot < last:
        shard, record = divmod(slot, per_shard)
        count = min(last - slot, per_shard - record)
        with store.open_input_file(f"{place}/{shard_name(shard)}") as file:
            file.seek(record * stride)
            for _ in range(count):
                yield np.frombuffer(file.read(stride), "<u2")
        slot += count


def shard_folder(spark: SparkSession) -> str:
    """A new folder for shards in the shared folder."""
    from stockpond.session import scratch_path

    return scratch_path(spark, "shards")
