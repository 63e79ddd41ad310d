"""Token counts that follow edits.

A document is a row of leaves, each a run of pre-tokens with its characters and tokens,
under a tree of sums. An edit replaces characters; its region goes from the leaf that
the edit, with the boundary context, begins in to the first old leaf end behind it
where the new pre-tokens end too. Only the region is encoded anew, and only the sums
above its leaves change.

The pattern looks at most two characters past a match and never behind it. So a leaf
that ends before that context keeps its pre-tokens, and from a common end on, all
pre-tokens are the old ones.

Defined results: a null text is empty and has no tokens; edits apply one after the
other, their places cut to the text they meet; null edits are none, a null place is the
text's end, a null replacement the empty one. Repeated rows are counted one by one. An
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwatch.llm.bpe import Bpe, worker_bpe
from accountwatch.llm.chunks import text_batches
from accountwatch.llm.text import whole

#: Pre-token runs (cut at spaces) of a leaf.
LEAF = 24
#: Characters past its end that decide where a match ends: an apostrophe and what follows it.
CONTEXT = 3
EDITS = "array<struct<begin:int,end:int,text:string>>"


class TokenTree:
    """Characters and tokens of leaves, with their sums in heap order: node i has 2i and 2i+1 below it."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.leaves = max(1, len(chars))
        self.size = 1 << (self.leaves - 1).bit_length()
        self.chars = self._sums(chars)
        self.tokens = self._sums(tokens)

    def _sums(self, values: list[int]) -> list[int]:
        sums = [0] * self.size + values + [0] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            sums[i] = sums[2 * i] + sums[2 * i + 1]
        return sums

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins; the last one for the end."""
        place = min(place, max(0, self.chars[1] - 1))
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if place >= begin + self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.size, begin

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2


class CountedText:
    """A text whose token count follows its edits."""

    def __init__(self, text: str, bpe: Bpe, leaves: tuple[list[int], list[int]] | None = None):
        self.text = text
        self.bpe = bpe
        self.recoded = 0
        self.tree = TokenTree(*(bpe.counter.runs([text], LEAF)[0] if leaves is None else leaves))

    @property
    def n_tokens(self) -> int:
        return self.tree.tokens[1]

    def edit(self, begin: int, end: int, new: str) -> None:
        """Replaces the characters from ``begin`` to ``end``."""
        edit_together(self.bpe, [(self, begin, end, new)])

    def splice(self, begin: int, end: int, new: str) -> tuple[int, int, list[str]]:
        """Edits the text alone; the first and last leaf of the region, and its new pre-tokens."""
        old = len(self.text)
        begin = min(max(begin, 0), old)
        end = min(max(end, begin), old)
        self.text = text = self.text[:begin] + new + self.text[end:]
        shift = len(text) - old
        first, start = self.tree.leaf_at(max(0, begin - CONTEXT))
        last, last_start = self.tree.leaf_at(end)
        stop = last_start + self.tree.chars[self.tree.size + last]
        # Mostly a new pre-token ends where the last leaf does. What lies within the context of the cut is left out.
        words = self.bpe.counter.pattern.findall(text, start, stop + shift + CONTEXT)
        ends = list(accumulate(map(len, words), initial=start))
        at = bisect_left(ends, stop + shift)
        if at < len(ends) and ends[at] == stop + shift > start:
            return first, last, words[:at]
        # Pre-tokens from the region's start until one ends where an old leaf does, behind the edit.
        words, at = [], start
        for match in self.bpe.counter.pattern.finditer(text, start):
            words.append(match.group())
            at = match.end()
            while stop + shift < at and last + 1 < self.tree.leaves:
                last += 1
                stop += self.tree.chars[self.tree.size + last]
            if at == stop + shift and at >= begin + len(new):
                break
        return first, last, words

    def recount(self, first: int, last: int, words: list[str], counts: list[int]) -> None:
        """Brings the tree up to the text, from the region that ``splice`` gave and the tokens of its pre-tokens."""
        self.recoded += sum(counts)
        self._replace(first, last, words, counts)

    def _replace(self, first: int, last: int, words: list[str], counts: list[int]) -> None:
        """Spreads the region's new pre-tokens over its leaves, in order."""
        leaves = last - first + 1
        if len(words) > 16 * LEAF * leaves:
            # Too much for these leaves: the tree gets a new shape, from its old leaves and new ones for the region.
            size, tree = self.tree.size, self.tree
            groups = range(0, len(words), LEAF)
            chars = [sum(map(len, words[g : g + LEAF])) for g in groups]
            tokens = [sum(counts[g : g + LEAF]) for g in groups]
            self.tree = TokenTree(
                tree.chars[size : size + first] + chars + tree.chars[size + last + 1 : size + tree.leaves],
                tree.tokens[size : size + first] + tokens + tree.tokens[size + last + 1 : size + tree.leaves],
            )
            return
        ends = [round(k * len(words) / leaves) for k in range(leaves + 1)]
        sizes = [0, *accumulate(map(len, words))]
        sums = [0, *accumulate(counts)]
        for k in range(leaves):
            a, b = ends[k], ends[k + 1]
            self.tree.set(first + k, sizes[b] - sizes[a], sums[b] - sums[a])


def edit_together(bpe: Bpe, edits: list[tuple[CountedText, int, int, str]]) -> None:
    """One edit of each of several texts: begin, end and replacement. All their new pre-tokens are counted together."""
    regions = [(text, *text.splice(begin, end, new)) for text, begin, end, new in edits]
    counts = bpe.counter.count([*chain(*(words for *_, words in regions))]).tolist()
    at = 0
    for text, first, last, words in regions:
        text.recount(first, last, words, counts[at : at + len(words)])
        at += len(words)


def count_with_edits(
    docs: DataFrame, path: str, pattern: str, edits: str | Column = "edits", id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, ``n_tokens`` before the edits, ``n_tokens_edited``, ``n_edits``, ``n_recoded``, ``n_leaves``, ``text_crc32``.

    ``edits`` is an array of begin, end and text, applied in order. One pass, no shuffle.
    """
    names = ["n_tokens", "n_tokens_edited", "n_edits", "n_recoded", "n_leaves", "text_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(path, pattern)
        for batch in batches:
            for begin, texts in text_batches(batch.column(1)):
                scripts = [[edit for edit in script or [] if edit] for script in batch.column(2).slice(begin, len(texts)).to_pylist()]
                counted = [CountedText(text, bpe, leaves) for text, leaves in zip(texts, bpe.counter.runs(texts, LEAF), strict=True)]
                before = [text.n_tokens for text in counted]
                for k in range(max(map(len, scripts))):
                    edit_together(bpe, [(text, *_places(text, script[k])) for text, script in zip(counted, scripts, strict=True) if k < len(script)])
                rows = [
                    (old, text.n_tokens, len(script), text.recoded, text.tree.leaves, zlib.crc32(text.text.encode("utf-8")))
                    for old, text, script in zip(before, counted, scripts, strict=True)
                ]
                columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), *columns], names=[id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{name} bigint" for name in names)
    script = F.col(edits) if isinstance(edits, str) else edits
    return docs.select(id_col, whole(text).alias("_text"), script.cast(EDITS).alias("_edits")).mapInArrow(run, schema)


def _places(text: CountedText, edit: dict) -> tuple[int, int, str]:
    """Begin, end and replacement of an edit of a text, null places being its end."""
    begin, end = (len(text.text) if edit[name] is None else edit[name] for name in ("begin", "end"))
    return begin, end, edit["text"] or ""


def drawn_edits(id_col: str = "doc_id", text: str = "text", count: int = 4, most: int = 40) -> Column:
    """``count`` edits of a document, drawn from a hash of its id: each replaces up to ``most``
    characters by up to ``most`` that stand elsewhere in the same text."""
    size = F.length(whole(text))

    def draw(k: int, what: str, below: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(k), F.lit(what)), below.cast("bigint")).cast("int")

    def edit(k: int) -> Column:
        begin = draw(k, "begin", size + 1)
        copied = F.substring(whole(text), draw(k, "from", size + 1) + 1, draw(k, "copied", F.lit(most + 1)))
        return F.struct(begin.alias("begin"), (begin + draw(k, "dropped", F.lit(most + 1))).alias("end"), copied.alias("text"))

    return F.array(*[edit(k) for k in range(count)])
