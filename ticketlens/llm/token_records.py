"""Token ids as length-delimited binary records with a separate offset index.

A record is framed as: length (uint64, little-endian), masked CRC-32C of the
length (uint32), the ids (uint16 where the vocabulary allows, else uint32;
little-endian), masked CRC-32C of the ids (uint32).  Beside each data file
lies an index of (doc_id, byte offset, payload bytes), so records can be read
in any order.  Files follow the ascending order of the ids of the documents.

Texts are range-partitioned by id before they are encoded; one task writes
one file.  A task writes under a name of its own attempt and renames at the
end, so a repeated task leaves one whole file.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm.common import partitions

END_ID = 1
_CACHE_WORDS = 400_000
_READ_BYTES = 1 << 22

_MANIFEST = "part int, file string, n_docs long, n_tokens long, n_bytes long, width int"
_READ = "doc_id long, start long, n_tokens long, ids binary, width int"


def _crc_table() -> np.ndarray:
    """CRC-32C (Castagnoli, reflected polynomial 0x82F63B78), 8 tables for 8 bytes a step."""
    table = np.zeros((8, 256), np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        table[0, i] = c
    for k in range(1, 8):
        table[k] = (table[k - 1] >> np.uint32(8)) ^ table[0][table[k - 1] & np.uint32(255)]
    return table


_TABLE = _crc_table()


_LANE = 512


def _over_zeros(state: np.ndarray, n_bytes: int) -> np.ndarray:
    """CRC states after n_bytes further zero bytes."""
    for _ in range(n_bytes):
        state = (state >> np.uint32(8)) ^ _TABLE[0][state & np.uint32(255)]
    return state


#: Moves a state over one lane of zeros, a byte of the state at a time (the map is linear).
_LANE_SHIFT = np.stack([_over_zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), _LANE) for k in range(4)])


def crc32c_many(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload; lanes of _LANE bytes advance side by side, 8 bytes a step.

    The initial state of ones equals inverting the first four bytes; zeros in
    front then change nothing, so payloads are padded there to whole lanes.
    """
    if not payloads:
        return np.empty(0, np.uint32)
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    lanes = np.maximum(-(-sizes // _LANE), 1)
    ends = np.cumsum(lanes)
    padded = np.zeros(int(ends[-1]) * _LANE, np.uint8)
    for p, e in zip(payloads, (ends * _LANE).tolist(), strict=True):
        padded[e - len(p) : e] = np.frombuffer(p, np.uint8)
        padded[e - len(p) : min(e, e - len(p) + 4)] ^= 0xFF
    words = padded.reshape(-1, _LANE // 8, 8)
    state = np.zeros(len(words), np.uint32)
    for step in range(_LANE // 8):
        block = words[:, step]
        x = block[:, :4] ^ np.ascontiguousarray(state, "<u4").view(np.uint8).reshape(-1, 4)
        state = _TABLE[7][x[:, 0]] ^ _TABLE[6][x[:, 1]] ^ _TABLE[5][x[:, 2]] ^ _TABLE[4][x[:, 3]]
        state ^= _TABLE[3][block[:, 4]] ^ _TABLE[2][block[:, 5]] ^ _TABLE[1][block[:, 6]] ^ _TABLE[0][block[:, 7]]
    out, starts = np.zeros(len(payloads), np.uint32), ends - lanes
    for turn in range(int(lanes.max())):
        some = np.flatnonzero(lanes > turn)
        b = np.ascontiguousarray(out[some], "<u4").view(np.uint8).reshape(-1, 4)
        moved = _LANE_SHIFT[0][b[:, 0]] ^ _LANE_SHIFT[1][b[:, 1]] ^ _LANE_SHIFT[2][b[:, 2]] ^ _LANE_SHIFT[3][b[:, 3]]
        out[some] = moved ^ state[starts[some] + turn]
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes < 4).tolist():  # shorter than the initial state
        c = 0xFFFFFFFF
        for byte in payloads[i]:
            c = (c >> 8) ^ int(_TABLE[0][(c ^ byte) & 255])
        out[i] = c ^ 0xFFFFFFFF
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """The usual mask of a stored checksum: rotate right by 15 and add a constant."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)



#: Letters (of Latin-1, lower and upper case) and a run of punctuation behind them.
_PLAIN = re.compile("([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?%#&*$|]*)")
_PROBES = "the The école STRASSE straße zzqxv Ünïcode, a. été!! über%%%".split()


class WordEncoder(dict):
    """word → token ids, remembered for up to a fixed number of words.

    Vocabularies whose tokens never span white space encode a text as the
    concatenation of its words' ids; whole texts are encoded where that fails
    (``by_word=False``).  Words of plain letters go straight to the
    tokenizer's model where probes show that this gives its own result.
    """

    def __init__(self, path: str, by_word: bool = True):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.by_word = by_word
        lower = self.tokenizer.normalizer
        self.lowers = lower is not None and lower.normalize_str("AZ") == "az"
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.model = self.tokenizer.model
        self.plain = self.lowers and all(self._plain(w) == self._whole(w) for w in _PROBES)

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, word: str) -> bytes | None:
        found = _PLAIN.fullmatch(word)
        if not found:
            return None
        letters, rest = found.groups()
        letters = letters.lower()
        ids = [t.id for t in self.model.tokenize(letters if letters.isascii() else letters.translate(self.bytes_of))]
        if rest:
            ids += [t.id for t in self.model.tokenize(rest)]
        return array(self.code, ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        text = word.decode()
        ids = self._plain(text) if self.plain else None
        ids = self[word] = self._whole(text) if ids is None else ids
        return ids

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        end = array(self.code, [end_id]).tobytes()
        if not self.by_word:
            return [self._whole(t) + end for t in texts]
        out = []
        for text in texts:
            raw = text.encode()
            # A-Z are lowered first where the tokenizer does so anyway: not inside its special tokens, and not
            # in other than ASCII texts, where it composes characters before it lowers them
            words = (raw.lower() if self.lowers and raw.isascii() and b"<|" not in raw else raw).split()
            out.append(b"".join(map(self.__getitem__, words)) + end)
        return out


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def _encoder(path: str, by_word: bool) -> WordEncoder:
    if (path, by_word) not in _ENCODERS:
        _ENCODERS[path, by_word] = WordEncoder(path, by_word)
    return _ENCODERS[path, by_word]


def frame(payloads: list[bytes]) -> list[bytes]:
    """The framed records of the payloads."""
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, tails = masked(crc32c_many(lengths)).tolist(), masked(crc32c_many(payloads)).tolist()
    return [b"".join((n, struct.pack("<I", h), p, struct.pack("<I", t))) for n, h, p, t in zip(lengths, heads, payloads, tails, strict=True)]


def unframe(blob: bytes, offsets: list[int], sizes: list[int]) -> list[bytes]:
    """Payloads at the offsets; lengths and checksums are verified."""
    payloads, heads, tails, lengths = [], [], [], []
    for at, size in zip(offsets, sizes, strict=True):
        n, h = struct.unpack_from("<QI", blob, at)
        if n != size:
            raise ValueError(f"a record of {n} bytes where the index has {size}")
        lengths.append(blob[at : at + 8])
        payloads.append(blob[at + 12 : at + 12 + n])
        heads.append(h)
        tails.append(struct.unpack_from("<I", blob, at + 12 + n)[0])
    if heads != masked(crc32c_many(lengths)).tolist() or tails != masked(crc32c_many(payloads)).tolist():
        raise ValueError("a checksum does not match")
    return payloads


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


_INDEX_ROW = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<i8"), ("size", "<i8")])


def _writer(folder: str, path: str, end_id: int, by_word: bool, docs_at_once: int = 512):
    from pyspark import TaskContext

    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("width", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, root = _store(folder)
        encoder = _encoder(path, by_word)
        width = np.dtype(encoder.dtype).itemsize
        name, own = f"{root}/part-{part:06d}", f"{root}/.attempt-{uuid.uuid4().hex}"
        n_docs = n_tokens = offset = 0
        data = index = None
        for batch in batches:
            for at in range(0, batch.num_rows, docs_at_once):
                some = batch.slice(at, docs_at_once)
                if data is None:
                    fs.create_dir(root, recursive=True)
                    data, index = fs.open_output_stream(f"{own}.bin"), fs.open_output_stream(f"{own}.idx")
                payloads = encoder.encode(some.column(1).to_pylist(), end_id)
                records = frame(payloads)
                rows = np.zeros(len(records), _INDEX_ROW)
                ids = some.column(0)
                rows["doc_id"], rows["null"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                rows["size"] = [len(p) for p in payloads]
                ends = np.cumsum([len(r) for r in records])
                rows["offset"] = offset + np.concatenate([[0], ends[:-1]])
                data.write(b"".join(records))
                index.write(rows.tobytes())
                n_docs, n_tokens, offset = n_docs + len(records), n_tokens + int(rows["size"].sum()) // width, offset + int(ends[-1])
        if data is None:
            return
        data.close(), index.close()
        fs.move(f"{own}.idx", f"{name}.idx")
        fs.move(f"{own}.bin", f"{name}.bin")
        yield pa.RecordBatch.from_pylist([{"part": part, "file": f"part-{part:06d}", "n_docs": n_docs, "n_tokens": n_tokens, "n_bytes": offset, "width": width}], schema=schema)

    return run


def write_records(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, by_word: bool = True) -> DataFrame:
    """Encode the texts and write them in ascending order of id; returns the manifest (one row per file).

    Null texts are empty and give the end id alone.  Null ids come first; rows
    that share an id are ordered by text.  An empty table writes no file.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = given.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    made = dealt.mapInArrow(_writer(folder, tokenizer, end_id, by_word), _MANIFEST).collect()  # one row per file
    return docs.sparkSession.createDataFrame(sorted(made), _MANIFEST)


def _reader(folder: str):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("width", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}.idx") as f:
                    index = np.frombuffer(f.read(), _INDEX_ROW)
                tokens = index["size"] // row["width"]
                starts = row["base"] + np.cumsum(tokens) - tokens
                spans = index["offset"] + index["size"] + 16
                with fs.open_input_file(f"{root}/{row['file']}.bin") as f:
                    at = 0
                    while at < len(index):  # a few megabytes of records at once
                        low = int(index["offset"][at])
                        upto = max(int(np.searchsorted(spans, low + _READ_BYTES, "right")), at + 1)
                        some = index[at:upto]
                        f.seek(low)
                        blob = f.read(int(spans[upto - 1]) - low)
                        payloads = unframe(blob, (some["offset"] - low).tolist(), some["size"].tolist())
                        ids = pa.array(some["doc_id"], mask=some["null"].astype(bool))
                        yield pa.RecordBatch.from_arrays([ids, pa.array(starts[at:upto]), pa.array(tokens[at:upto]), pa.array(payloads, pa.binary()), pa.array(np.full(len(some), row["width"], np.int32))], schema=schema)
                        at = upto

    return run


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all records before it), n_tokens, ids (binary), width (bytes of an id) of every record in the files."""
    rows = sorted(manifest.collect())  # one row per file
    base, files = 0, []
    for r in rows:
        files.append((len(files), r["file"], base, r["width"]))
        base += r["n_tokens"]
    if not files:
        return spark.createDataFrame([], _READ)
    listed = spark.createDataFrame(files, "n int, file string, base long, width int")
    return listed.repartitionById(len(files), F.col("n")).mapInArrow(_reader(folder), _READ)


def digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian uint32) of the files' records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(4).to_pylist()
            sums = [zlib.crc32(np.frombuffer(b.as_buffer(), f"<u{w}").astype("<u4").tobytes()) for b, w in zip(batch.column(3), widths, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_records(spark, folder, manifest).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
