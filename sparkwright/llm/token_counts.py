"""Token counts by byte-pair merging with a heap and a linked list.

The model gives the pieces and their scores.  A text becomes symbols (one
character each); repeatedly the adjacent pair whose union is the best piece
(lowest rank, then leftmost) is merged.  The count is the initial symbols minus
the merges; a character that no piece covers counts as its UTF-8 bytes.  No
identifiers are made.

Merges never cross a border between two characters that no piece holds side by
side (above all from a letter to the next word's space mark).  So a text is cut
at such borders, and the count of each distinct word is kept in a bounded cache
of the task.

Null and empty texts have 0 bytes and 0 tokens.  A special string inside a text
is ordinary text.  The work is one pass over the scan, without a shuffle.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Words kept by a task; the cache starts anew beyond that (counts stay the same).
CACHE_WORDS = 600_000
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Merger:
    """Counts the tokens of texts by the pieces of a sentencepiece BPE model."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.rank, pairs = {}, set()
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
                continue
            piece = sp.id_to_piece(i)
            self.rank[piece] = -sp.get_score(i)
            pairs.update(zip(piece, piece[1:]))
        self.pairs = pairs
        self.cache = _Words(self)
        # A word mark may be joined to what is before it only by a run of marks.
        self.by_word = all(a == SPACE for a, b in pairs if b == SPACE)

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        if not self.by_word:
            return self.chunk(SPACE + text.replace(" ", SPACE))
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            runs = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))
            return sum(map(self.chunk, runs))
        return sum(map(self.cache.__getitem__, text.split(" ")))

    def chunk(self, chunk: str) -> int:
        """Tokens of normalised text, cut where no piece has both neighbours."""
        pairs, at, total = self.pairs, 0, 0
        for i in range(1, len(chunk)):
            if (chunk[i - 1], chunk[i]) not in pairs:
                total += self.merge(chunk[at:i])
                at = i
        return total + self.merge(chunk[at:])

    def merge(self, symbols: str) -> int:
        rank, n = self.rank, len(symbols)
        if n == 1:
            return 1 if symbols in rank else len(symbols.encode("utf-8", "surrogatepass"))
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        piece = list(symbols)
        heap = []
        for i in range(n - 1):
            r = rank.get(symbols[i:i + 2])
            if r is not None:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i]
            if j == n or not piece[i] or len(piece[i]) + len(piece[j]) != size:
                continue                      # one of the two has been merged since
            piece[i] += piece[j]
            piece[j] = ""
            merges += 1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                r = rank.get(piece[i] + piece[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, size + len(piece[k])))
            h = left[i]
            if h >= 0:
                r = rank.get(piece[h] + piece[i])
                if r is not None:
                    heapq.heappush(heap, (r, h, size + len(piece[h])))
        extra = sum(len(p.encode("utf-8", "surrogatepass")) - 1 for p in piece if len(p) == 1 and p not in rank)
        return n - merges + extra


class _Words(dict):
    """Tokens of a word that follows a space mark."""

    def __init__(self, merger: Merger):
        super().__init__()
        self.merger = merger

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self.merger.chunk(SPACE + word)
        if len(word) <= 64:                   # longer ones rarely come again
            self[word] = n
        return n


@lru_cache(maxsize=2)
def merger(model_file: str) -> Merger:
    return Merger(model_file)


def count_tokens(documents: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """One row for each document.  ``model`` is a file of ``public_tokenizers`` or a path on the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(model_path(model))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_tokens = [m.count(t) if t else 0 for t in texts]
            n_bytes = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def model_path(name: str) -> str:
    """A path as it is; a bare file name is looked up among the public tokenizers."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)
