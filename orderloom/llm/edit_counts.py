"""Token counts of texts that are edited, from a segment tree of their pieces.

The tokenizer's pattern cuts a text into pieces that are encoded by themselves. The
pieces lie in leaves of a segment tree whose nodes sum up characters and tokens. An
edit is found by characters, the pieces around it are cut anew from the last
piece that the edit cannot have touched until a cut falls on an old one again,
and only those are encoded; sums change along the leaves' paths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks

#: Pieces of a leaf when the tree is built, and from which a leaf is split.
LEAF, FULL = 64, 256
#: A match of the pattern looks at most this far beyond its own end.
AHEAD = 2
REMEMBERED = 300_000


class Counter:
    """Token counts of pieces."""

    def __init__(self, path: str, pattern: str):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        self.pattern = regex.compile(pattern)
        self.seen: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, piece: str) -> int:
        found = self.seen.get(piece)
        if found is None:
            found = len(self.encoding.encode_ordinary(piece))
            if len(piece) < 256:
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen[piece] = found
        return found


@lru_cache(maxsize=4)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


class PieceTree:
    """A text's pieces with their sums of characters and tokens."""

    def __init__(self, text: str, cut: Callable[[str], list[str]], count: Callable[[str], int]):
        self.cut, self.count = cut, count
        pieces = cut(text)
        self.leaves = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.encoded = 0
        self._build()

    def _build(self) -> None:
        self.width = 1
        while self.width < len(self.leaves):
            self.width *= 2
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.width + i] = sum(map(len, leaf))
            self.tokens[self.width + i] = sum(map(self.count, leaf))
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _update(self, leaf: int) -> None:
        i = self.width + leaf
        self.chars[i] = sum(map(len, self.leaves[leaf]))
        self.tokens[i] = sum(map(self.count, self.leaves[leaf]))
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(p for leaf in self.leaves for p in leaf)

    def _locate(self, at: int) -> tuple[int, int, int]:
        """Leaf, place in it and first character of the first piece that ends at or after ``at`` (past the last one if none)."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.chars[node] < at:
                before += self.chars[node]
                node += 1
        leaf = min(node - self.width, len(self.leaves) - 1)
        if node - self.width != leaf:
            before = self.n_chars - self.chars[self.width + leaf]
        for i, piece in enumerate(self.leaves[leaf]):
            if before + len(piece) >= at:
                return leaf, i, before
            before += len(piece)
        return leaf, len(self.leaves[leaf]), before

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``end`` (both cut to the text)."""
        start = max(0, min(start, self.n_chars))
        end = max(start, min(end, self.n_chars))
        # Pieces that end two characters before the edit cannot have looked at it.
        leaf, place, first = self._locate(start - AHEAD + 1)
        old: list[str] = []
        stop_leaf, stop = leaf, place
        old_chars, old_end = 0, first

        def take(n: int) -> bool:
            """Take ``n`` more old pieces; False if there are no more."""
            nonlocal stop_leaf, stop, old_chars
            for _ in range(n):
                while stop == len(self.leaves[stop_leaf]):
                    if stop_leaf + 1 == len(self.leaves):
                        return False
                    stop_leaf, stop = stop_leaf + 1, 0
                old.append(self.leaves[stop_leaf][stop])
                old_chars += len(old[-1])
                stop += 1
            return True

        more = True
        while more and first + old_chars < end + AHEAD:
            more = take(1)
        step = 4
        while True:
            more = more and take(step)
            region = "".join(old)
            fresh = region[: start - first] + new + region[end - first :]
            cuts = {}
            at = first
            for i, piece in enumerate(old):
                if at >= end:
                    cuts.setdefault(at - end, i)
                at += len(piece)
            tail = start - first + len(new)
            pieces, at, found = [], 0, None
            for piece in self.cut(fresh):
                if at >= tail and at - tail in cuts:
                    found = cuts[at - tail]
                    break
                if more and at + len(piece) + AHEAD > len(fresh):
                    break
                pieces.append(piece)
                at += len(piece)
            else:
                if not more:
                    found = len(old)
            if found is not None:
                break
            if not more:
                # The whole rest is in the region, so every cut in it is final.
                pieces, found = self.cut(fresh), len(old)
                break
            step *= 2
        self.encoded += len(pieces)
        self._splice(leaf, place, found, pieces)

    def _splice(self, leaf: int, place: int, n_old: int, pieces: list[str]) -> None:
        touched, at, left = [leaf], leaf, n_old
        gone = min(left, len(self.leaves[leaf]) - place)
        self.leaves[leaf][place : place + gone] = pieces
        left -= gone
        while left:
            at += 1
            gone = min(left, len(self.leaves[at]))
            del self.leaves[at][:gone]
            touched.append(at)
            left -= gone
        if len(self.leaves[leaf]) > FULL:
            whole = self.leaves[leaf]
            self.leaves[leaf : leaf + 1] = [whole[i : i + LEAF] for i in range(0, len(whole), LEAF)]
            self._build()
        else:
            for i in touched:
                self._update(i)


def sample_edits(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Edits to count with where there is no edit log: one and another for every 2,000 characters.

    Their places follow from a hash of the id; an insertion, a replacement and a
    deletion take turns. Each applies to the result of the ones before.
    """
    length = f"length(coalesce({text}, ''))"
    place = f"cast(pmod(xxhash64({doc_id}, i), {length} + 1) as int)"
    return F.expr(
        f"transform(sequence(0, {length} div 2000), i -> named_struct('start', {place}, "
        f"'end', {place} + case i % 3 when 0 then 0 when 1 then 5 else 12 end, "
        "'text', case i % 3 when 0 then ' edited it''s 2' when 1 then 'new\n' else '' end))"
    )


def count_edited(docs: DataFrame, edits: Column, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_after, n_pieces, n_encoded``: counts before and after a document's edits.

    ``edits`` is ``array<struct<start, end, text>>`` in code points, applied in order;
    what lies beyond the text is cut to it, and a null edit text deletes. ``n_pieces`` counts the pieces
    before, ``n_encoded`` the ones encoded again for all edits. A null text counts as
    empty, null edits as none; ids may be null or repeated; other columns are not read.
    An empty table gives no rows; a text of any length is one tree, counted whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(path, pattern)
        for batch in batches:
            out = []
            texts, changes = batch.column("text"), batch.column("edits")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                tree = PieceTree(texts[i].as_py() or "", tool.cut, tool.count)
                before, pieces = tree.n_tokens, sum(map(len, tree.leaves))
                edits = [e for e in changes[i].as_py() or [] if e is not None]
                for e in edits:
                    tree.replace(e["start"] or 0, e["end"] or 0, e["text"] or "")
                out.append((doc_id, before, len(edits), tree.n_tokens, pieces, tree.encoded))
            columns = list(zip(*out)) or [()] * 6
            names = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_pieces", "n_encoded"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    shaped = edits.cast("array<struct<start:int,end:int,text:string>>").alias("edits")
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), shaped)
    schema = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_pieces long, n_encoded long"
    return plain.mapInArrow(run, schema)
