"""Sum-of-squares online packing of token sequences into fixed windows.

Each task packs the documents it reads, in order.  A document is cut into full
windows and a remainder.  A level array holds, for each fill level, how many
windows are filled to that level.  The remainder goes to the level (or a new
window) that leaves the smallest sum of squared counts of partly filled levels.
A window that becomes full is written at once.

What is open at the end of a task (or beyond ``max_open`` windows) is drained:
its pieces are laid end to end and cut into full windows, and the last rest
into windows of powers of two, which need no padding.  So tasks never wait for
each other, nothing is shuffled, and memory holds ``max_open`` windows at most.

Every token lies in exactly one piece.  Null and empty texts have the end token
only.  Sequence ids are the task's number and a count within the task.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .token_counts import model_path

#: The fast encoder's pattern engine gives up, or ends the process, on runs of white space not far above this.
LONG_RUN = re.compile(r"\s{100000}")

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
OUT_ROWS = 4096


class Encoder:
    """Ids as the ``tokenizers`` library gives them for a byte-level BPE file.

    Plain texts go through a byte-pair encoder that is built from the file's
    own vocabulary and is several times faster; texts that hold one of the
    file's added tokens, and files of another kind, go through the library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.fast = self._fast(spec)

    def _fast(self, spec: dict):
        import public_tokenizers
        import tiktoken
        pre = spec.get("pre_tokenizer") or {}
        if (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) != ("ByteLevel", False, True) \
                or spec.get("normalizer") or spec["model"].get("type") != "BPE":
            return None
        back = {c: b for b, c in byte_symbols().items()}
        ranks = {bytes(back[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()
                 if piece not in self.added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"][a + b] for a, b in merges]
        if any(x >= y for x, y in zip(order, order[1:])) or len(order) + 256 != len(ranks):
            return None                       # ids aren't in the order of the merges
        return tiktoken.Encoding("from_file", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(t in text for t in self.added) and not self._long_run(text):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")

    @staticmethod
    def _long_run(text: str) -> bool:
        return len(text) >= 100_000 and LONG_RUN.search(text) is not None


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Packer:
    """Sum-of-squares packer; a piece is (doc, start, ids, doc_tokens)."""

    def __init__(self, window: int, max_open: int):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, dtype=np.int64)   # windows filled to a level; 0 and full stay 0
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[list]:
        """Finished sequences (lists of pieces) that adding the document gives."""
        n, w = len(ids), self.window
        cut = n - n % w
        for at in range(0, cut, w):
            yield [(doc, at, ids[at:at + w], n)]
        if cut == n:
            return
        piece = (doc, cut, ids[cut:].copy() if cut else ids, n)
        level = self.place(n - cut)
        bins = self.open.get(level)
        pieces = bins.pop() if level else []
        if level:
            self.levels[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        level += n - cut
        if level == w:
            yield pieces
            return
        self.levels[level] += 1
        self.open.setdefault(level, []).append(pieces)
        self.n_open += 1
        if self.n_open > self.max_open:
            yield from self.drain()

    def place(self, size: int) -> int:
        """The level whose choice gives the least sum of squares; the fullest of equals, 0: a new window."""
        last = self.window - size
        before = self.levels[:last + 1]
        cost = 2 * self.levels[size:] + 1                    # of the level reached
        cost[last] = 0                                       # full windows don't count
        cost -= np.where(np.arange(last + 1) > 0, 2 * before - 1, 0)
        cost[1:][before[1:] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(cost[::-1]))

    def drain(self) -> Iterator[list]:
        """Close all open windows: full ones from their pieces, then powers of two."""
        pieces = [p for level in sorted(self.open, reverse=True) for b in self.open[level] for p in b]
        self.open.clear()
        self.levels[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) for p in pieces)
        size = self._next(left)
        seq, room = [], size
        for doc, start, ids, n in pieces:
            while len(ids):
                take = min(room, len(ids))
                seq.append((doc, start, ids[:take], n))
                ids, start, room, left = ids[take:], start + take, room - take, left - take
                if not room:
                    yield seq
                    seq, room = [], self._next(left)

    def _next(self, left: int) -> int:
        return self.window if left >= self.window else 1 << max(0, left.bit_length() - 1)


def pack(documents: DataFrame, tokenizer: str = "byte_bpe_50k.json", window: int = 2048,
         end_id: int = 1, max_open: int = 4096) -> DataFrame:
    """Pieces of all documents; one row for each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer = encoder(model_path(tokenizer)), Packer(window, max_open)
        task = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        n_seq = 0

        def out(sequences) -> None:
            nonlocal n_seq
            for pieces in sequences:
                offset = 0
                for doc, start, ids, n in pieces:
                    rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, task + n_seq, offset))
                    offset += len(ids)
                n_seq += 1

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(enc.encode(text) if text else np.empty(0, "<u4"), np.uint32(end_id)).astype("<u4")
                out(packer.add(doc, ids))
                if len(rows) >= OUT_ROWS:
                    yield _rows(rows)
                    rows = []
        out(packer.drain())
        if rows:
            yield _rows(rows)

    return documents.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
