"""Wavelet matrices over token ids, and a file that holds one with the documents it came from.

The matrix is Huffman-shaped: frequent ids have short codes, so it has fewer bits than a fixed width and building and
reading it take fewer steps. Codes are dealt so that at each level the ids that end there stand last; the next level
holds the rest, and rank works as in a plain matrix.

File: magic, a length-prefixed JSON header, then sections: document ids, their null bits and lengths (compressed),
the ids that end at each level with their counts (compressed), and for each level its bits and the ones before every
block of 512 bits. Those are stored as they are: a reader maps the file and touches only the bytes it needs."""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC, BLOCK = b"QWM2", 512
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman code lengths of symbols whose counts ascend; a lone symbol has one bit."""
    m = len(counts)
    if m < 2:
        return np.ones(m, np.int64)
    leaves, made, parent = counts.tolist(), [], [0] * (2 * m - 1)
    i = j = 0
    for k in range(m, 2 * m - 1):
        total = 0
        for _ in range(2):
            if j == len(made) or (i < m and leaves[i] <= made[j]):
                total, parent[i], i = total + leaves[i], k, i + 1
            else:
                total, parent[m + j], j = total + made[j], k, j + 1
        made.append(total)
    depth = [0] * (2 * m - 1)
    for k in range(2 * m - 3, -1, -1):
        depth[k] = depth[parent[k]] + 1
    return np.array(depth[:m])


def codes_of(ends: list[int]) -> np.ndarray:
    """Codes, first bit lowest, of all symbols in order of levels; ends: how many symbols end at each level.

    Nodes of a level are in the order of the matrix; the last ones end, the others go on with a 0 or a 1."""
    nodes, out = np.zeros(1, np.uint32), []
    for level, n in enumerate(ends):
        nodes = np.concatenate([nodes, nodes | np.uint32(1 << level)])
        out.append(nodes[len(nodes) - n :])
        nodes = nodes[: len(nodes) - n]
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class WaveletMatrix:
    """Levels of bits over n ids. symbols and counts: ids that end at each level, in order; ends: how many do."""

    def __init__(self, n: int, symbols: np.ndarray, counts: np.ndarray, ends: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.symbols, self.counts, self.ends, self.planes, self.ranks = n, symbols, counts, ends, planes, ranks
        self.at = np.concatenate([[0], np.cumsum(ends)]).astype(int)  # first symbol of each level
        gone = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[self.at]
        self.sizes = (n - gone).tolist()  # ids that a level holds
        self.zeros = [self.sizes[k] - int(ranks[k][-1]) for k in range(len(planes))]
        self._codes: dict[int, tuple[int, int]] | None = None

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        every = np.bincount(ids)
        symbols = np.flatnonzero(every)
        symbols = symbols[np.argsort(every[symbols], kind="stable")]
        lengths = code_lengths(every[symbols])
        symbols, lengths = symbols[::-1], lengths[::-1]  # frequent ones first
        ends = np.bincount(lengths, minlength=1)[1:].tolist() if len(symbols) else []
        table = np.zeros(len(every), np.uint16 if len(ends) <= 16 else np.uint32)
        table[symbols] = codes_of(ends)
        counts = every[symbols]
        planes, ranks, cur, left, at = [], [], table[ids], len(ids), 0
        for level, n in enumerate(ends):
            one = (cur & cur.dtype.type(1 << level)).astype(bool)
            planes.append(np.packbits(one, bitorder="little"))
            ranks.append(block_ranks(planes[-1]))
            left, at = left - int(counts[at : at + n].sum()), at + n
            cur = np.concatenate([cur.take(np.flatnonzero(~one)), cur.take(np.flatnonzero(one))])[:left]
        return cls(len(ids), symbols, counts, ends, planes, ranks)

    def ids(self) -> np.ndarray:
        """The whole sequence: the partitions undone from the lowest level up."""
        symbols = self.symbols.astype(np.uint16 if self.symbols.max(initial=0) < 1 << 16 else np.uint32)
        cur = np.zeros(0, symbols.dtype)
        for k in reversed(range(len(self.planes))):
            a, b = self.at[k], self.at[k + 1]
            cur = np.concatenate([cur, np.repeat(symbols[a:b], self.counts[a:b])])
            one = np.unpackbits(self.planes[k], count=self.sizes[k], bitorder="little").view(bool)
            out = np.empty_like(cur)
            out[np.flatnonzero(~one)], out[np.flatnonzero(one)] = cur[: self.zeros[k]], cur[self.zeros[k] :]
            cur = out
        return cur

    def _code(self, c: int) -> tuple[int, int] | None:
        """Code and length of an id; none if it doesn't occur."""
        if self._codes is None:
            levels = np.repeat(np.arange(1, len(self.ends) + 1), self.ends).tolist()
            self._codes = dict(zip(self.symbols.tolist(), zip(codes_of(self.ends).tolist(), levels, strict=True), strict=True))
        return self._codes.get(c)

    def _rank(self, k: int, i: int) -> int:
        """Ones among the first i bits of level k."""
        block = i // BLOCK
        start = block * BLOCK // 8
        whole = _POP[self.planes[k][start : i // 8]].sum()
        rest = i % 8
        last = bin(int(self.planes[k][i // 8]) & ((1 << rest) - 1)).count("1") if rest else 0
        return int(self.ranks[k][block]) + int(whole) + last

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        for k in range(len(self.planes)):
            one = int(self.planes[k][i // 8]) >> (i % 8) & 1
            i = self.zeros[k] + self._rank(k, i) if one else i - self._rank(k, i)
            if (past := i - self.sizes[k + 1]) >= 0:  # among those that end here
                a, b = self.at[k], self.at[k + 1]
                return int(self.symbols[a + np.searchsorted(np.cumsum(self.counts[a:b]), past, "right")])
        raise IndexError(i)

    def _range(self, c: int, i: int) -> tuple[int, int]:
        """Where the occurrences of c among the first i stand at the level where it ends."""
        if (code := self._code(c)) is None:
            return 0, 0
        lo, hi = 0, i
        for k in range(code[1]):
            a, b = self._rank(k, lo), self._rank(k, hi)
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if code[0] >> k & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, c: int, i: int) -> int:
        """Occurrences of id c among the first i."""
        lo, hi = self._range(c, i)
        return hi - lo

    def count(self, c: int) -> int:
        return self.rank(c, self.n)

    def select(self, c: int, j: int) -> int:
        """Place of occurrence j (from 0) of id c."""
        lo, hi = self._range(c, self.n)
        if not 0 <= j < hi - lo:
            raise IndexError(j)
        code, length = self._code(c)
        i = lo + j
        for k in reversed(range(length)):
            one = code >> k & 1
            i = self._select(k, i - self.zeros[k] if one else i, one)
        return i

    def _select(self, k: int, j: int, one: int) -> int:
        """Place of the j-th one (or zero) of level k, by bisection over the block ranks and then over bits."""
        blocks = np.minimum(np.arange(len(self.ranks[k])) * BLOCK, self.sizes[k])
        have = self.ranks[k] if one else blocks - self.ranks[k]
        b = int(np.searchsorted(have, j, "right")) - 1
        lo, hi = b * BLOCK, min(self.sizes[k], (b + 1) * BLOCK)
        bits = np.unpackbits(self.planes[k][lo // 8 : -(-hi // 8)], count=hi - lo, bitorder="little")
        return lo + int(np.flatnonzero(bits == one)[j - int(have[b])])


def block_ranks(packed: np.ndarray) -> np.ndarray:
    """Ones before each block, with one entry more for the end."""
    per = BLOCK // 8
    ones = np.zeros(-(-len(packed) // per) * per, np.uint8)
    ones[: len(packed)] = _POP[packed]
    return np.concatenate([[0], np.cumsum(ones.reshape(-1, per).sum(axis=1, dtype=np.int64))]).astype("<u4")


def to_bytes(ids: np.ndarray, lengths: np.ndarray, doc_ids: list[int | None], **more) -> bytes:
    """A file. ids: those of all documents in order, each with its end."""
    m = WaveletMatrix.of(ids)
    null = np.array([d is None for d in doc_ids], bool)
    own = np.array([0 if d is None else d for d in doc_ids], "<i8")
    squeeze = zstandard.ZstdCompressor(level=1).compress
    sections = [squeeze(x.tobytes()) for x in (own, np.packbits(null), lengths.astype("<u4"), m.symbols.astype("<u4"), m.counts.astype("<u8"))]
    for p, r in zip(m.planes, m.ranks, strict=True):
        sections += [p.tobytes(), r.tobytes()]
    header = json.dumps({"n": len(ids), "docs": len(doc_ids), "ends": m.ends, "sections": [len(s) for s in sections]} | more).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


def from_bytes(data: bytes) -> tuple[dict, list[int | None], np.ndarray, WaveletMatrix]:
    """Header, document ids, their lengths in tokens, and the matrix. data may be a mapped file: of the levels
    nothing is copied, and only what is asked for is read."""
    if bytes(data[:4]) != MAGIC:
        raise ValueError("not a token file")
    (n,) = struct.unpack("<I", data[4:8])
    header = json.loads(bytes(data[8 : 8 + n]))
    starts = np.concatenate([[8 + n], 8 + n + np.cumsum(header["sections"])]).tolist()
    opened = lambda k, kind: np.frombuffer(zstandard.ZstdDecompressor().decompress(data[starts[k] : starts[k + 1]]), kind)
    plain = lambda k, kind: np.frombuffer(data, kind, header["sections"][k] // np.dtype(kind).itemsize, starts[k])
    null = np.unpackbits(opened(1, np.uint8), count=header["docs"]).astype(bool)
    docs = [None if z else d for d, z in zip(opened(0, "<i8").tolist(), null.tolist(), strict=True)]
    levels = range(len(header["ends"]))
    planes, ranks = [plain(5 + 2 * k, np.uint8) for k in levels], [plain(6 + 2 * k, "<u4") for k in levels]
    m = WaveletMatrix(header["n"], opened(3, "<u4").astype(np.int64), opened(4, "<u8").astype(np.int64), header["ends"], planes, ranks)
    return header, docs, opened(2, "<u4").astype(np.int64), m


class TokenFile:
    """One file by rank and select: ids at a place, occurrences of an id by document."""

    def __init__(self, data: bytes):
        self.header, self.docs, lengths, self.matrix = from_bytes(data)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths

    def place(self, i: int) -> tuple[int, int]:
        """The document (its number in the file) that holds place i, and the place within it."""
        d = int(np.searchsorted(self.ends, i, "right"))
        return d, i - int(self.starts[d])

    def token(self, d: int, i: int) -> int:
        """Id i of document number d."""
        if not 0 <= i < self.ends[d] - self.starts[d]:
            raise IndexError(i)
        return self.matrix.access(int(self.starts[d]) + i)

    def count_in(self, c: int, d: int) -> int:
        """Occurrences of id c in document number d."""
        return self.matrix.rank(c, int(self.ends[d])) - self.matrix.rank(c, int(self.starts[d]))

    def occurrence(self, c: int, j: int) -> tuple[int, int]:
        """Document number and place of occurrence j of id c in the file."""
        return self.place(self.matrix.select(c, j))
