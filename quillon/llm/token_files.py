"""Token ids in files of one wavelet matrix each, in ascending order of document ids."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm import wavelet
from quillon.llm.common import hand_back, join_small, shared_path, stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Tokens of a file, about; and bytes of text in a range of ids, of which there are so many at most.
FILE_TOKENS, RANGE_BYTES, MOST_RANGES = 3_000_000, 8_000_000, 50_000
#: Bytes of text that are cut at a time; pieces that the library gets at a time; pieces whose ids a worker keeps, of so
#: many bytes at most.
CHUNK_BYTES, BATCH, MOST_PIECES, PIECE_BYTES = 8_000_000, 16_384, 300_000, 40
#: Classes of bytes: white space, white space but the blank, ASCII letters, other visible ASCII but digits.
_SPACE, _BREAK, _LETTER, _SIGN = 1, 2, 4, 8


def _classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for b in range(128):
        c = chr(b)
        if 9 <= b <= 13 or c == " ":
            out[b] = _SPACE if c == " " else _SPACE | _BREAK
        elif c.isalpha():
            out[b] = _LETTER
        elif b > 32 and b < 127 and not c.isdigit():
            out[b] = _SIGN
    return out


_CLASS = _classes()
#: UTF-8 of white space beyond ASCII.
_WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def kinds(data: np.ndarray) -> np.ndarray:
    """The class of every byte of UTF-8 text; all bytes of wide white space are white space."""
    kind = _CLASS[data]
    for lead in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data == lead)
        for form in _WIDE_SPACE if len(at) else ():
            if form[0] == lead:
                own = at[at + len(form) <= len(data)]
                for k in range(1, len(form)):
                    own = own[data[own + k] == form[k]]
                for k in range(len(form)):
                    kind[own + k] = _SPACE
    return kind


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places, ascending, at which a byte-level pre-tokenizer can be restarted without changing any pre-token: starts
    of texts; the first character of a run of white space; its last one, where a character follows that is none, and
    the place after it if it is no blank; and ASCII signs after letters. The pattern makes one pre-token of a run up
    to its last character, joins a last blank to what follows, and ends letters where a sign begins. The last place is
    the end."""
    kind = kinds(data)
    found = np.zeros(len(data) + 1, bool)
    found[starts] = True
    found[-1] = True
    before, after, inside = kind[:-1], kind[1:], ~found[1:-1]
    last = ((before & _SPACE) > (after & _SPACE)) & inside  # a character follows in the same text
    found[1:-1] |= (after & _SPACE) > (before & _SPACE)
    found[1:-1] |= last & ((before & _BREAK) > 0)
    found[:-2] |= last & (data[:-1] < 128)
    found[1:-1] |= (before == _LETTER) & (after == _SIGN)
    return np.flatnonzero(found)


class Encoder:
    """Ids of whole texts by the tokenizers library.

    Texts are cut where no pre-token can reach across, equal pieces are found by Arrow's dictionary encoding, and each
    distinct piece is encoded once; cutting changes no id. That holds for byte-level tokenizers that split by the
    usual pattern, without a normalizer; the file is read to see whether it is one, and with any other whole texts are
    the pieces. So are texts that hold an added token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        split = made.get("pre_tokenizer") or {}
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.added = [t["content"] for t in made.get("added_tokens") or []]
        self.cuttable = made.get("normalizer") is None and {k: split.get(k) for k in usual} == usual and made["model"].get("type") == "BPE" and not made["model"].get("dropout")
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        line = self._library(["\n"])
        self.line = line[0][0] if self.cuttable and len(line[0]) == 1 else None
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.first, self.sizes = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, pieces: list[bytes]) -> np.ndarray:
        """Ids of pieces, a line's id after each."""
        parts = [self._library([b"\n".join([*pieces[i : i + BATCH], b""]).decode()])[0] for i in range(0, len(pieces), BATCH)]
        return np.concatenate([np.array(x, self.kind) for x in parts]) if parts else np.zeros(0, self.kind)

    def _new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, and for each its first place among them and how many it has.

        Pieces without inner white space are encoded as the lines of one text: a line break is a pre-token and an id of
        its own, and is no part of any of them."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        text = b"\n".join(pieces)
        data = np.frombuffer(text, np.uint8)
        first = np.cumsum(lengths + 1) - lengths - 1
        spaces = np.concatenate([[0], np.cumsum(kinds(data) & _SPACE, dtype=np.int64)])
        spaces = spaces[first + lengths] - spaces[first]
        simple = (spaces == 0) | ((spaces == 1) & (data[first] == 32) & (lengths > 1)) if self.line is not None else np.zeros(len(pieces), bool)
        if any(a.encode() in text for a in self.added):
            simple &= [not any(a.encode() in p for a in self.added) for p in pieces]
        lines, others = np.flatnonzero(simple).tolist(), np.flatnonzero(~simple).tolist()
        sizes, found = np.zeros(len(pieces), np.int64), self._lines([pieces[i] for i in lines])
        ends = np.flatnonzero(found == self.line)
        if len(ends) != len(lines):
            raise ValueError("the tokenizer doesn't keep lines apart")
        sizes[lines] = np.diff(ends, prepend=-1) - 1
        found = found[found != self.line] if lines else found
        more = self._library([pieces[i].decode() for i in others]) if others else []
        sizes[others] = [len(x) for x in more]
        order = lines + others
        first = np.zeros(len(pieces), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([found, np.array([i for x in more for i in x], self.kind)]), first, sizes

    def _dictionary(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of many pieces, with first place and number for each; those not known are encoded, short ones kept."""
        slot = np.fromiter(map(self.known.get, pieces, [-1] * len(pieces)), np.int64, len(pieces))
        new = np.flatnonzero(slot < 0)
        found, at, n = self._new([pieces[i] for i in new])
        ids, first, sizes = np.concatenate([self.ids, found]), np.concatenate([self.first, at + len(self.ids)]), np.concatenate([self.sizes, n])
        slot[new] = np.arange(len(self.sizes), len(sizes))
        if len(self.known) + len(new) > MOST_PIECES:
            if 5 * len(new) > 4 * len(pieces):  # other texts than those before: begin anew
                self.clear()
        else:
            self.known.update((pieces[i], int(slot[i])) for i in new if len(pieces[i]) <= PIECE_BYTES)
            self.ids, self.first, self.sizes = ids, first, sizes
        return ids, first[slot], sizes[slot]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end, and their number for each text; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        starts = offsets - offsets[0]
        whole = [b"" if not self.cuttable else a.encode() for a in self.added]
        held = np.zeros(len(texts), bool)
        if not self.cuttable:
            held[:] = True
        elif any(data.tobytes().find(a) >= 0 for a in whole):
            held = np.array([any(a in t for a in self.added) for t in texts.to_pylist()], bool)
        at = cuts(data, starts)
        if held.any():  # no cut within these texts
            own = np.searchsorted(starts, at, "right") - 1
            inside = (at < len(data)) & held[np.minimum(own, len(texts) - 1)] & ~np.isin(at, starts)
            at = at[~inside]
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        ids, first, size = self._dictionary(pieces.dictionary.to_pylist())
        ids, end = np.append(ids, self.kind(END_ID)), len(first)
        first, size = np.append(first, len(ids) - 1), np.append(size, 1)
        slot = np.insert(pieces.indices.to_numpy(), np.searchsorted(at, starts[1:]), end)  # an end after each text
        n = size[slot]
        until = np.cumsum(n)
        total = int(until[-1]) if len(n) else 0
        out = ids[np.repeat(first[slot] - until + n, n) + np.arange(total)]
        ends = until[slot == end]
        return out, np.diff(ends, prepend=0)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def put(uri: str, name: str, data: bytes) -> None:
    """Write a file in one piece under its final name, so that a second attempt at the task changes nothing."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(uri)
    store.create_dir(root, recursive=True)
    part = f"{root}/_{name}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, f"{root}/{name}")


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """First row and rows of parts of about so many bytes; a longer text is a part by itself."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b - a
        a = b


def _written(uri: str, path: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, enc = TaskContext.get().partitionId(), encoder(path)
        seq, rows, docs, ids, sizes = 0, [], [], [], []

        def flush() -> None:
            nonlocal seq, docs, ids, sizes
            n = np.concatenate(sizes)
            put(uri, f"tokens-{own:06d}-{seq:06d}.qwm", wavelet.to_bytes(np.concatenate(ids), n, docs, part=own, seq=seq))
            rows.append((own, seq, len(docs), int(n.sum())))
            seq, docs, ids, sizes = seq + 1, [], [], []

        for b in batches:
            for a, k in _slices(b.column(1), min(CHUNK_BYTES, 2 * most)):
                out, n = enc.encode(b.column(1).slice(a, k))
                docs += b.column(0).slice(a, k).to_pylist()
                ids.append(out)
                sizes.append(n)
                if sum(map(len, ids)) >= most:
                    flush()
        if docs:
            flush()
        hand_back()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))], ["part", "seq", "docs", "tokens"])

    return run


def write_tokens(docs: DataFrame, uri: str, tokenizer: str = TOKENIZER, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write doc_id and text of all rows; gives the list of files (part, seq, docs, tokens), in ascending order of ids.

    Null texts are only an end; null ids come first; rows that share an id are ordered by text, and equal rows stand
    side by side. Every document ends with id 0. An empty table writes no file. Texts are moved once, by ranges of
    ids; a range is one task's, and large ones give several files."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = min(MOST_RANGES, size // RANGE_BYTES + 1)
    moved = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    return stored(moved.mapInArrow(_written(uri, tokenizer, file_tokens), "part int, seq int, docs long, tokens long"), "token-list")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for data in b.column(0).to_pylist():
            header, docs, lengths, m = wavelet.from_bytes(data)
            ids = m.ids().astype("<u4")
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(ids[a:e].tobytes()) for a, e in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
            n = len(docs)
            cols = [pa.array([header["part"]] * n, pa.int32()), pa.array([header["seq"]] * n, pa.int32()), pa.array(docs, pa.int64()), pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])
    hand_back()


def read_tokens(spark: SparkSession, uri: str, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files. files: what write_tokens gave."""
    by = files.groupBy("part").agg(F.sum("tokens").alias("all"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    by = by.select("part", F.coalesce(F.sum("all").over(every), F.lit(0)).alias("base"))
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    at = files.join(by, "part").select("part", "seq", (F.col("base") + F.coalesce(F.sum("tokens").over(own), F.lit(0))).alias("first"))
    if not files.limit(1).count():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    data = spark.read.format("binaryFile").option("pathGlobFilter", "*.qwm").load(uri).select("content")
    docs = data.mapInArrow(_read, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return join_small(docs, at, ["part", "seq"], 50_000).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenized(docs: DataFrame) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back."""
    spark = docs.sparkSession
    uri = shared_path(spark, "token-files")
    return read_tokens(spark, uri, write_tokens(docs, uri))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: token ids of every document, as read back from the files."""
    return tokenized(table(spark, sf_dir, "documents").select("doc_id", "text"))
