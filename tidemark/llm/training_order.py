"""Training-order materialisation: token sequences in a keyed random order, in shards of
fixed-stride records.

Every text becomes token ids, cut into sequences of a fixed length (the last one padded);
every sequence has a number, gapless from 0, in the order of documents (by id, rows without
one last, then by text) and of parts in them.  So numbers, and what follows from them,
depend on the corpus and not on how it lies in files or partitions.  A keyed Feistel permutation with
cycle-walking maps the numbers one to one to global slots.  Slots are range-partitioned
into shards, whose files the partitions write; a record's place in its shard follows from
its slot alone, so that a reader can seek to any step and go on from there, and a shard can
be written again by itself.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, dropped, map_arrow, map_batches, shared_dir, shuffles_go

SEQUENCE, SHARD_SLOTS, ROUNDS = 512, 8192, 6
#: Shards are written in up to so many waves, each of so many shards at least: the shuffle
#: then holds a wave's records and not all.
WAVES, WAVE_SHARDS = 4, 16
#: What is kept of a record beside its shard.
INDEX = ["doc_id", "part", "n_tokens"]
#: The usual pattern that splits text before the merges of this vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


class Permutation:
    """A keyed one-to-one map of 0 .. n - 1 to itself."""

    def __init__(self, n: int, key: str, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [int.from_bytes(hashlib.sha256(f"{key}|{r}".encode()).digest()[:8], "little") for r in range(rounds)]

    def _pass(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ (_mixed(left, k) & self.mask), left
            else:
                left, right = right, left ^ (_mixed(right, k) & self.mask)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        """Passes until the value is in range: the domain is under four times n, and the way
        back to a value in range is never longer than its cycle."""
        out = np.asarray(x, np.uint64).copy()
        if len(out) and int(out.max()) >= self.n:
            raise ValueError("a number is out of range")
        todo = np.arange(len(out))
        while len(todo):
            out[todo] = self._pass(out[todo], back)
            todo = todo[out[todo] >= self.n]
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


def sequences(docs: DataFrame, path: str, length: int = SEQUENCE) -> DataFrame:
    """doc_id, part, n_tokens, record (``length`` little-endian 16-bit ids, padded with the
    id after the vocabulary's last), its checksum, and the number of the sequence as a pair
    (_task, _nth) whose order is that of documents.

    A null or empty text has no sequence.  Equal ids and repeated rows have theirs each;
    repeated rows are dealt by where they lie, which tells nothing but equal sequences apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, task, nth = encoder(path), TaskContext.get().partitionId(), 0
        pad = enc.n_vocab
        if pad > 65535:
            raise ValueError("ids must fit 16 bits")
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = np.array(enc.encode_ordinary(text) if isinstance(text, str) else [], "<u2")
                for part, at in enumerate(range(0, len(ids), length)):
                    some = ids[at : at + length]
                    record = some if len(some) == length else np.concatenate([some, np.full(length - len(some), pad, "<u2")])
                    raw = record.tobytes()
                    rows.append((pd.NA if pd.isna(doc_id) else int(doc_id), part, len(some), raw, zlib.crc32(raw), task, nth))
                    nth += 1
                    if len(rows) >= 2000:
                        yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                        rows = []
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    columns = ["doc_id", "part", "n_tokens", "record", "_crc", "_task", "_nth"]
    schema = "doc_id long, part int, n_tokens int, record binary, _crc long, _task int, _nth long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text <> ''")
    order = [F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.xxhash64(F.lit("order"), "text"), "_row"]
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "text").transform(map_batches, run, schema)


def _numbered(docs: DataFrame, path: str, length: int) -> tuple[DataFrame, dict[int, int], int, int]:
    """Every sequence, written to the shared folder once, so that the numbers stay as they
    are if an executor is lost; the first number of each task (all that the driver sees is
    a count a task); how many there are, and a checksum of all."""
    spark = docs.sparkSession
    with shuffles_go(spark):
        made = cut(sequences(docs, path, length), compression="zstd")
    counts = made.groupBy("_task").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc_id", "part", "_crc")).alias("x")).collect()
    base, total, check = {}, 0, 0
    for r in sorted(counts, key=lambda r: r["_task"]):
        base[r["_task"]], total, check = total, total + r["n"], check ^ r["x"]
    return made, base, total, check


def _placed(made: DataFrame, base: dict[int, int], total: int, key: str, length: int, shard_slots: int) -> DataFrame:
    """Every sequence with its slot, shard and byte_offset, where it was encoded."""

    @F.pandas_udf("long")
    def slot_of(task: pd.Series, nth: pd.Series) -> pd.Series:
        return pd.Series(Permutation(total, key).slots(task.map(base).to_numpy(np.int64) + nth.to_numpy(np.int64)))

    placed = made.withColumn("slot", slot_of("_task", "_nth"))
    placed = placed.withColumn("shard", F.expr(f"slot div {shard_slots}")).withColumn("byte_offset", F.expr(f"slot % {shard_slots} * {2 * length}"))
    return placed.select("slot", "shard", "byte_offset", *INDEX, "record")


def _tasks(spark: SparkSession, n_shards: int) -> int:
    return max(1, min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _ranged(placed: DataFrame, first: int, end: int) -> DataFrame:
    """The shards from ``first`` to before ``end``: whole ones, in slot order, in partitions
    of equal ranges, which need no sample because slots have no gaps."""
    n = _tasks(placed.sparkSession, end - first)
    some = placed.where(F.col("shard").between(first, end - 1))
    return some.repartitionById(n, F.expr(f"cast((shard - {first}) * {n} div {max(1, end - first)} as int)")).sortWithinPartitions("slot")


def training_order(docs: DataFrame, path: str, key: str = "order-1", length: int = SEQUENCE, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """slot, shard, byte_offset (in the shard), doc_id, part, n_tokens, record: every sequence
    in its place, range-partitioned by slot at the bounds of shards, and sorted."""
    made, base, total, _ = _numbered(docs, path, length)
    return _ranged(_placed(made, base, total, key, length, shard_slots), 0, -(-total // shard_slots))


def write_shards(ordered: DataFrame, uri: str, done: set[int] | None = None) -> DataFrame:
    """Writes shard-NNNNNNNN.bin files, and beside each its records' ids as
    index-NNNNNNNN.parquet, under ``uri`` (any file system that pyarrow opens and all
    executors share) and returns shard, n_records, n_bytes, sha256.

    ``ordered`` is as training_order() returns it: each partition writes its shards, batch
    by batch, and no record is shuffled again.  A file appears under its name only when
    complete, the shard after its index, so that an attempt that was lost leaves nothing
    that counts.  Shards in ``done`` are left as they are."""
    rest = ordered.where(~F.col("shard").isin(sorted(done))) if done else ordered

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        shard, out, sha, size, index, attempt = None, None, None, 0, [], TaskContext.get().taskAttemptId()

        def close() -> dict:
            out.close()
            ids = pa.Table.from_batches(index)
            pq.write_table(ids, f"{root}/_{shard:08d}.{attempt}.index", filesystem=fs, compression="zstd")
            fs.move(f"{root}/_{shard:08d}.{attempt}.index", f"{root}/index-{shard:08d}.parquet")
            fs.move(f"{root}/_{shard:08d}.{attempt}", f"{root}/shard-{shard:08d}.bin")
            return {"shard": shard, "n_records": len(ids), "n_bytes": size, "sha256": sha.hexdigest()}

        for batch in batches:
            closed = []
            shards, offsets = (batch.column(c).to_numpy() for c in ("shard", "byte_offset"))
            begin = np.flatnonzero(np.diff(shards, prepend=-1)).tolist()
            for lo, hi in zip(begin, [*begin[1:], len(shards)], strict=True):
                if shards[lo] != shard:
                    if shard is not None:
                        closed.append(close())
                    shard, sha, size, index = int(shards[lo]), hashlib.sha256(), 0, []
                    out = fs.open_output_stream(f"{root}/_{shard:08d}.{attempt}")
                records = batch.column("record").slice(lo, hi - lo).to_pylist()
                if (offsets[lo:hi] != size + np.cumsum([0, *map(len, records[:-1])])).any():
                    raise ValueError("a partition must hold whole shards in slot order")
                raw = b"".join(records)
                out.write(raw)
                sha.update(raw)
                size += len(raw)
                index.append(pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in INDEX], names=INDEX))
            if closed:
                yield pa.RecordBatch.from_pylist(closed, schema=written)
        if shard is not None:
            yield pa.RecordBatch.from_pylist([close()], schema=written)

    written = pa.schema([("shard", pa.int64()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())])
    return rest.select("shard", "byte_offset", *INDEX, "record").transform(map_arrow, run, "shard long, n_records long, n_bytes long, sha256 string")


def read_shards(spark: SparkSession, uri: str, n_shards: int, length: int = SEQUENCE, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The columns and the order of training_order(), read from the first ``n_shards``
    shards that write_shards() left under ``uri``."""
    stride, step = 2 * length, 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                ids = pq.read_table(f"{root}/index-{shard:08d}.parquet", filesystem=fs, partitioning=None).combine_chunks()
                with fs.open_input_stream(f"{root}/shard-{shard:08d}.bin") as f:
                    for at in range(0, len(ids), step):
                        some = ids.slice(at, step)
                        n = len(some)
                        if len(raw := f.read(n * stride)) < n * stride:
                            raise ValueError(f"shard {shard} is cut short")
                        here = np.arange(at, at + n)
                        record = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * stride, stride, dtype=np.int32)), pa.py_buffer(raw)])
                        columns = [pa.array(shard * shard_slots + here), pa.array(np.full(n, shard)), pa.array(here * stride)]
                        yield pa.RecordBatch.from_arrays([*columns, *[some.column(c).combine_chunks() for c in INDEX], record], names=["slot", "shard", "byte_offset", *INDEX, "record"])

    shards = spark.range(0, n_shards, 1, _tasks(spark, n_shards))
    return shards.transform(map_arrow, run, "slot long, shard long, byte_offset long, doc_id long, part int, n_tokens int, record binary")


def _claim(uri: str, order: dict) -> set[int]:
    """The shards under ``uri`` that are complete.  The folder says which order it is for;
    one that holds another is an error."""
    fs, root = pafs.FileSystem.from_uri(uri)
    fs.create_dir(root, recursive=True)
    text = json.dumps(order, sort_keys=True)
    if fs.get_file_info(f"{root}/order.json").type == pafs.FileType.NotFound:
        with fs.open_output_stream(f"{root}/order.json") as f:
            f.write(text.encode())
    with fs.open_input_stream(f"{root}/order.json") as f:
        if f.read().decode() != text:
            raise ValueError(f"{uri} holds shards of another order")
    names = (x.base_name for x in fs.get_file_info(pafs.FileSelector(root)))
    return {int(x[6:14]) for x in names if x.startswith("shard-")}


def materialise(docs: DataFrame, path: str, uri: str | None = None, key: str = "order-1", length: int = SEQUENCE, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Writes every sequence to its place in the shards under ``uri`` (by default a new
    folder in the shared one), and returns what read_shards() reads there.  Shards that an
    earlier run of the same corpus, key and sizes has finished there stay as they are."""
    spark = docs.sparkSession
    uri = uri or f"{shared_dir(spark)}/shards-{uuid.uuid4()}"
    made, base, total, check = _numbered(docs, path, length)
    n_shards = -(-total // shard_slots)
    done = _claim(uri, {"sequences": total, "checksum": check, "key": hashlib.sha256(key.encode()).hexdigest(), "length": length, "shard_slots": shard_slots})
    waves = min(WAVES, -(-n_shards // WAVE_SHARDS))
    bounds = [n_shards * k // waves for k in range(waves + 1)] if waves else []
    placed = _placed(made, base, total, key, length, shard_slots)
    if waves > 1:  # slots are worked out once, and a wave reads its own part
        wave = " + ".join(f"cast(shard >= {b} as int)" for b in bounds[1:-1])
        at = f"{shared_dir(spark)}/waves-{uuid.uuid4()}"
        placed.withColumn("_wave", F.expr(wave)).write.partitionBy("_wave").parquet(at, compression="zstd")
        placed = spark.read.schema(T.StructType([*placed.schema.fields, T.StructField("_wave", T.IntegerType())])).parquet(at)
        placed._folder = at
        dropped(made)
    with shuffles_go(spark):
        for k in range(waves):
            rest = [n for n in range(bounds[k], bounds[k + 1]) if n not in done]
            if rest:
                some = placed.where(f"_wave = {k}").drop("_wave") if waves > 1 else placed
                wave = write_shards(_ranged(some, bounds[k], bounds[k + 1]), uri, done & set(range(bounds[k], bounds[k + 1])))
                written = wave.agg(F.sum("n_records")).first()[0]
                if written != sum(min(shard_slots, total - n * shard_slots) for n in rest):
                    raise ValueError(f"{written} sequences were written to the shards {rest[0]} to {rest[-1]}")
    dropped(placed if waves > 1 else made)
    return read_shards(spark, uri, n_shards, length, shard_slots)


def read_slots(uri: str, first: int, n: int, length: int = SEQUENCE, shard_slots: int = SHARD_SLOTS) -> np.ndarray:
    """``n`` sequences from slot ``first`` on, read in order by seeking."""
    fs, root = pafs.FileSystem.from_uri(uri)
    out, slot, stride = [], first, 2 * length
    while slot < first + n:
        take = min(first + n - slot, shard_slots - slot % shard_slots)
        with fs.open_input_file(f"{root}/shard-{slot // shard_slots:08d}.bin") as f:
            out.append(np.frombuffer(f.read_at(take * stride, slot % shard_slots * stride), "<u2").reshape(-1, length))
        if len(out[-1]) < take:
            break
        slot += take
    return np.concatenate(out) if out else np.empty((0, length), "<u2")
