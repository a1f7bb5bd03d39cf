"""Token files coded with a static range asymmetric numeral system (rANS).

Format. A file set is a folder of two folders of Parquet files. ``blocks`` has one row per block, in ascending (part, block)
order; a part covers a range of doc_ids. ``table`` has the frequency table: one row an id that occurs (id, frequency) and one row
without an id, each with the precision, the end id and the CRC-32 of all ids and frequencies; it is all that a reader
needs besides the blocks. The payload of a block is this module's own stream:

* one frequency table for the whole set, counted over all tokens and scaled to 2**PRECISION;
* ``lanes`` interleaved coders: token i belongs to lane i % lanes; 64-bit states, 32-bit words;
* every CHECK_STEPS steps a checkpoint (word offset and all states), so that the stretches of a block are
  decoded side by side, and any of them alone;
* CRC-32 of the coded words and of the decoded ids.

A block holds whole documents and closes at BLOCK_TOKENS, so blocks are independent of each other.

Null texts are empty documents: the end id alone. Documents are in ascending doc_id order, null ids first,
equal ids by a hash of their text; repeated rows are all written. An empty table gives an empty set and no
rows. A very long text is one document in one block, however long. Only the id and text columns are read. A wrong checksum raises an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwise.llm.common import scratch_path, scratch_table, small_batches, text_key
from clickwise.llm.tokens import END_ID, encode_texts

PRECISION = 20
LANES = 1024
BLOCK_TOKENS = 1 << 18
CHECK_STEPS = 128
_LOW = np.uint64(1 << 31)
_U = np.uint64

RAW = "part int, block int, doc_ids array<long>, lengths array<int>, ids binary"
CODED = ("part int, block int, doc_ids array<long>, lengths array<int>, n_tokens long, lanes int, words binary, "
         "offsets array<int>, states binary, words_crc32 long, ids_crc32 long")
DECODED = "doc_id long, part int, block int, at long, n_tokens long, ids_crc32 long"


#: Block number of a row that holds the occurrences of ids instead of a block.
COUNTS = -1

TABLE = "id int, frequency long, precision int, end_id int, crc32 long"


class Table:
    """Scaled frequencies by id (0: does not occur), their running sums, and the id of every slot."""

    def __init__(self, counts: dict[int, int]):
        size = max(counts, default=0) + 1
        exact = np.zeros(size, np.int64)
        for i, n in counts.items():
            exact[i] = n
        total, kinds, room = int(exact.sum()), int((exact > 0).sum()), 1 << PRECISION
        if kinds > room:
            raise ValueError("more distinct ids than slots")
        # one slot for each id that occurs, the rest by its share; what rounding leaves goes to the commonest
        share = [(int(n) * (room - kinds)) // total if total else 0 for n in exact]
        self.freq = np.where(exact > 0, np.array(share, np.int64) + 1, 0).astype(np.uint64)
        if total:
            self.freq[int(exact.argmax())] += _U(room - int(self.freq.sum()))
        self._index()

    def _index(self) -> None:
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self._symbol = None

    @classmethod
    def of_frequencies(cls, freq: np.ndarray) -> "Table":
        """The table with these scaled frequencies, as they were stored."""
        table = cls.__new__(cls)
        table.freq = freq.astype(np.uint64)
        table._index()
        return table

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    def __getstate__(self):
        return {"freq": self.freq, "start": self.start, "_symbol": None}


def encode_block(ids: np.ndarray, table: Table) -> dict:
    """The coded form of a block: lanes, words, offsets (of each checkpoint), states (at each checkpoint)."""
    n = len(ids)
    lanes = min(LANES, max(1, n // 64))
    steps = -(-n // lanes)
    state = np.full(lanes, _LOW)
    out: list[np.ndarray] = [None] * steps
    states = []
    for t in range(steps - 1, -1, -1):
        sym = ids[t * lanes:(t + 1) * lanes]
        f, x = table.freq[sym], state[:len(sym)]
        full = x >= f << _U(63 - PRECISION)
        out[t] = x[full].astype(np.uint32)
        x = np.where(full, x >> _U(32), x)
        q = x // f
        state[:len(sym)] = (q << _U(PRECISION)) + (x - q * f) + table.start[sym]
        if t % CHECK_STEPS == 0:
            states.append(state.copy())
    sizes = np.concatenate([[0], np.cumsum([len(w) for w in out])]).astype(np.int64)
    words = np.concatenate(out).astype("<u4").tobytes() if out else b""
    return {"lanes": lanes, "words": words, "offsets": sizes[:-1][::CHECK_STEPS].tolist(),
            "states": b"".join(s.astype("<u8").tobytes() for s in reversed(states)), "n_tokens": n,
            "words_crc32": zlib.crc32(words), "ids_crc32": zlib.crc32(ids.astype("<u4"))}


def decode_block(block: dict, table: Table) -> np.ndarray:
    """All ids of a block; its stretches between checkpoints are decoded side by side."""
    n, lanes, words = block["n_tokens"], block["lanes"], np.frombuffer(block["words"], "<u4").astype(np.uint64)
    if zlib.crc32(block["words"]) != block["words_crc32"]:
        raise ValueError("the coded words do not match their checksum")
    at = np.array(block["offsets"], np.int64)
    stretches = len(at)
    x = np.frombuffer(block["states"], "<u8").reshape(stretches, lanes).astype(np.uint64)
    ids = np.zeros((stretches, CHECK_STEPS, lanes), np.uint32)
    steps = -(-n // lanes)
    words = np.append(words, _U(0))  # read, but not used, by lanes that need no word
    for t in range(min(CHECK_STEPS, steps)):
        live = stretches if (stretches - 1) * CHECK_STEPS + t < steps else stretches - 1
        y = x[:live]
        slot = y & _U((1 << PRECISION) - 1)
        sym = table.symbol[slot]
        ids[:live, t] = sym
        y = table.freq[sym] * (y >> _U(PRECISION)) + slot - table.start[sym]
        short = n - ((live - 1) * CHECK_STEPS + t) * lanes
        need = y < _LOW
        if short < lanes:  # the last step of the block has fewer tokens than lanes
            need[-1, short:] = False
            y[-1, short:] = x[live - 1, short:]
        taken = np.cumsum(need, axis=1)
        place = np.where(need, at[:live, None] + taken - 1, len(words) - 1)
        x[:live] = np.where(need, (y << _U(32)) | words[place], y)
        at[:live] += taken[:, -1]
    out = ids.reshape(-1, lanes)[:steps].reshape(-1)[:n]
    if zlib.crc32(out.astype("<u4", copy=False)) != block["ids_crc32"]:
        raise ValueError("the decoded ids do not match their checksum")
    return out


def _bounds(docs: DataFrame, id_col: str, parts: int) -> np.ndarray:
    """Upper bounds of the parts' doc_ids: a sketch whose size is set by the number of parts."""
    at = [i / parts for i in range(1, parts)]
    if not at:
        return np.array([], np.int64)
    got = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), at, 20 * parts)).first()[0]
    return np.array(sorted(set(got or [])), np.int64)


def _table_crc32(ids: np.ndarray, freq: np.ndarray) -> int:
    return zlib.crc32(freq.astype("<u8").tobytes(), zlib.crc32(ids.astype("<u4").tobytes()))


def write_table(spark: SparkSession, table: Table, path: str, end_id: int | None) -> None:
    """Store the frequency table; at most one row for each id of the vocabulary, and the one without an id."""
    ids = np.flatnonzero(table.freq)
    crc = _table_crc32(ids, table.freq[ids])
    rows = [(None, None, PRECISION, end_id, crc), *[(int(i), int(table.freq[i]), PRECISION, end_id, crc) for i in ids]]
    spark.createDataFrame(rows, TABLE).coalesce(1).write.parquet(path)


def read_table(spark: SparkSession, path: str) -> Table:
    """The stored frequency table; one that does not match its checksum or this coder's precision is refused."""
    rows = spark.read.schema(TABLE).parquet(path).collect()
    if len({(r["precision"], r["end_id"], r["crc32"]) for r in rows}) != 1:
        raise ValueError("the frequency table is not whole")
    if rows[0]["precision"] != PRECISION:
        raise ValueError(f"the frequency table has the precision {rows[0]['precision']}, this coder {PRECISION}")
    pairs = sorted((r["id"], r["frequency"]) for r in rows if r["id"] is not None)
    ids, freq = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
    if _table_crc32(ids, freq) != rows[0]["crc32"]:
        raise ValueError("the frequency table does not match its checksum")
    full = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    full[ids] = freq
    return Table.of_frequencies(full)


def id_bytes(texts: list[bytes | None], vocabulary: str | None, end_id: int | None) -> pa.BinaryArray:
    """The ids of each text, four bytes each. Made of copies: what memoryviews hold, pa.array never gives back."""
    return pa.array([ids.tobytes() for ids in encode_texts(texts, vocabulary, end_id)], pa.binary())


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int | None = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> Table:
    """Encode all documents and write the file set, blocks and table, at ``path`` (any folder that Spark can write)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, id_col, parts)
    ids_schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("ids", pa.binary())])

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column(0)
            part = np.where(doc.is_null(), 0, np.searchsorted(bounds, doc.fill_null(0).to_numpy(), "left"))
            ids = id_bytes(b.column(2).cast(pa.binary()).to_pylist(), vocabulary, end_id)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), doc, b.column(1), ids], schema=ids_schema)
        pa.default_memory_pool().release_unused()  # the worker goes on with other stages

    raw_schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                            ("lengths", pa.list_(pa.int32())), ("ids", pa.binary())])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, docs_in, data, size = 0, 0, [], [], 0
        total = np.zeros(1, np.int64)

        def row(block_number, doc_ids, lengths, ids):
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block_number], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int32())), pa.array([ids], pa.binary())], schema=raw_schema)

        def close():
            nonlocal total
            ids = b"".join(data)
            n = np.bincount(np.frombuffer(ids, "<u4"))
            if len(n) > len(total):
                n, total = total, n
            total[:len(n)] += n
            return row(number, docs_in, [len(d) // 4 for d in data], ids)
        for b in batches:
            for p, d, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if docs_in and (p != part or size >= block_tokens):
                    yield close()
                    number, docs_in, data, size = number + 1 if p == part else 0, [], [], 0
                part = p
                docs_in.append(d)
                data.append(ids.as_buffer())
                size += len(data[-1]) // 4
        if docs_in:
            yield close()
            # the occurrences of the ids of all blocks of this task, as one more row: (ids, occurrences)
            some = np.flatnonzero(total)
            yield row(COUNTS, some, None, total[some].astype("<i8").tobytes())

    small_batches(spark)
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("tie"),
                      F.col(text_col).alias("text")).mapInArrow(tokenise, "part int, doc_id long, tie long, ids binary")
    raw = (ids.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "tie")
           .select("part", "doc_id", "ids").mapInArrow(block, RAW))
    raw = scratch_table(raw, "token-blocks")
    small_batches(spark)
    table = Table(token_counts(raw))
    shared = spark.sparkContext.broadcast(table)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, ids in enumerate(b.column("ids")):
                coded = encode_block(np.frombuffer(ids.as_buffer(), "<u4"), shared.value)
                rest = [pa.array([coded[f.name]], f.type) for f in list(_CODED_ARROW)[4:]]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in range(4)), *rest], schema=_CODED_ARROW)

    raw.where(F.col("block") != COUNTS).mapInArrow(code, CODED).write.parquet(f"{path}/blocks")
    write_table(spark, table, f"{path}/table", end_id)
    return table


_CODED_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
    ("n_tokens", pa.int64()), ("lanes", pa.int32()), ("words", pa.binary()), ("offsets", pa.list_(pa.int32())),
    ("states", pa.binary()), ("words_crc32", pa.int64()), ("ids_crc32", pa.int64())])


def token_counts(raw: DataFrame) -> dict[int, int]:
    """Occurrences of every id over all blocks: the rows that the tasks left beside their blocks, added; at most one row for each id of
    the vocabulary."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, n in zip(b.column(0), b.column(1)):
                yield pa.RecordBatch.from_arrays([ids.values.cast(pa.int32()), pa.array(np.frombuffer(n.as_buffer(), "<i8"))], ["id", "n"])

    counted = (raw.where(F.col("block") == COUNTS).select("doc_ids", "ids").mapInArrow(spread, "id int, n long")
               .groupBy("id").agg(F.sum("n").alias("n")))
    return {r["id"]: r["n"] for r in counted.collect()}


def read_tokens(spark: SparkSession, path: str, table: Table | None = None) -> DataFrame:
    """One row per document from the file set: doc_id, start, n_tokens, ids_crc32. The frequency table is the stored one
    unless it is given."""
    small_batches(spark)
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    shared = spark.sparkContext.broadcast(table or read_table(spark, f"{path}/table"))
    decoded_schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("at", pa.int64()),
                                ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                # words and states are read where they are
                row = {c: b.column(c)[i].as_buffer() if c in ("words", "states") else b.column(c)[i].as_py() for c in b.schema.names if c not in ("doc_ids", "lengths")}
                row["doc_ids"], lengths = b.column("doc_ids")[i].values, b.column("lengths")[i].values.to_numpy()
                ids = decode_block(row, shared.value)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"], pa.array(np.full(n, row["part"]), pa.int32()),
                     pa.array(np.full(n, row["block"]), pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(ends - starts, pa.int64()),
                     pa.array([zlib.crc32(ids[s:e]) for s, e in zip(starts, ends)], pa.int64())], schema=decoded_schema)

    docs = blocks.mapInArrow(decode, DECODED)
    sizes = blocks.select("part", "block", "n_tokens")
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row a part: bounded by the number of partitions written
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = parts.select("part", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)).alias("_p"))
    bases = (sizes.select("part", "block", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)).alias("_o"))
             .join(before, "part").select("part", "block", (F.col("_o") + F.col("_p")).alias("_base")))
    return docs.join(bases, ["part", "block"]).select("doc_id", (F.col("_base") + F.col("at")).alias("start"),
                                                      "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write the file set (in the shared scratch folder unless ``path`` is given) and read it back from its files alone."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_tokens(docs, path, vocabulary)
    return read_tokens(spark, path)
