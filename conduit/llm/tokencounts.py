"""Token counts that follow edits without counting the whole text again.

A document is kept as its pre-tokens with the number of tokens of each, in blocks, and
a segment tree over the blocks sums characters and tokens. An edit descends to the block
it touches, starts a few characters before it (a pre-token's end may depend on what
follows), and cuts new pre-tokens until a border falls on an old one behind the edit;
from there the old cut holds. Only the new pre-tokens are encoded, and only the sums
above their blocks change.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.common import batch, ship, texts_of

BLOCK = 128  # pre-tokens of a block; a block is split beyond twice as many
CONTEXT = 4  # characters behind a pre-token's end that its end can depend on
_AHEAD = 32  # pre-tokens read at a time while looking for an old border
_KNOWN = 300_000  # pre-tokens whose counts a worker remembers


class Counter:
    """Tokens of single pre-tokens; one per worker and vocabulary."""

    _made: dict[tuple, "Counter"] = {}

    @classmethod
    def of(cls, ranks: str, pattern: str) -> "Counter":
        if (ranks, pattern) not in cls._made:
            cls._made[ranks, pattern] = cls(ranks, pattern)
        return cls._made[ranks, pattern]

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, parts: list[str]) -> list[int]:
        get = self.known.get
        out = [get(p, -1) for p in parts]
        if -1 in out:
            if len(self.known) > _KNOWN:
                self.known.clear()
            for p in set(p for p, n in zip(parts, out) if n < 0):
                self.known[p] = len(self.encoding.encode_ordinary(p))
            get = self.known.get
            out = [n if n >= 0 else get(p) for p, n in zip(parts, out)]
        return out


class CountTree:
    """One document's pre-tokens under a segment tree of characters and tokens."""

    def __init__(self, counter: Counter, text: str):
        self.counter = counter
        parts = counter.cut(text)
        counts = counter.counts(parts)
        self.blocks = [(parts[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(parts), BLOCK)] or [([], [])]
        self.encoded = 0  # pre-tokens encoded for edits
        self._grow()

    def _grow(self) -> None:
        """Sum up all blocks anew: when their number changes."""
        self.leaves = 1
        while self.leaves < len(self.blocks):
            self.leaves *= 2
        self.chars, self.tokens = [0] * (2 * self.leaves), [0] * (2 * self.leaves)
        for k, (parts, counts) in enumerate(self.blocks):
            self.chars[self.leaves + k], self.tokens[self.leaves + k] = sum(map(len, parts)), sum(counts)
        for node in range(self.leaves - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _set(self, block: int) -> None:
        """Put one block's sums into its leaf and all nodes above."""
        parts, counts = self.blocks[block]
        node = self.leaves + block
        self.chars[node], self.tokens[node] = sum(map(len, parts)), sum(counts)
        while node > 1:
            node //= 2
            self._sum(node)

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The block that holds character ``at`` (or the last one), and where it begins."""
        node, begin = 1, 0
        while node < self.leaves:
            node *= 2
            if at >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.leaves, begin

    def _ahead(self, block: int, index: int):
        """The pre-tokens from one on, with their places."""
        while block < len(self.blocks):
            parts = self.blocks[block][0]
            for k in range(index, len(parts)):
                yield block, k, parts[k]
            block, index = block + 1, 0

    def edit(self, start: int, end: int, insert: str) -> int:
        """Replace the characters ``start`` to ``end`` and return the new count of tokens."""
        length = self.length
        start, end = max(0, min(start, length)), max(0, min(end, length))
        end = max(start, end)
        first, begin = self._find(max(start - CONTEXT, 0))
        parts = self.blocks[first][0]
        index = 0
        while index < len(parts) and begin + len(parts[index]) <= start - CONTEXT:
            begin += len(parts[index])
            index += 1
        # old text from here to a horizon behind the edit, with its borders
        ahead = self._ahead(first, index)
        held, borders, at = [], {}, begin
        head, horizon, done = "", "", False
        while True:
            grown = 0
            while grown < _AHEAD or at < end:
                got = next(ahead, None)
                if got is None:
                    done = True
                    break
                borders[at] = got[:2]
                held.append(got[2])
                at += len(got[2])
                grown += 1
            old = "".join(held)
            head = old[: start - begin] + insert
            horizon = head + old[end - begin :]
            shift = len(head) - (end - begin)  # from old places to new ones behind the edit
            fresh, place = [], 0
            meet = None
            for part in self.counter.cut(horizon):
                old_place = place - shift + begin
                if place >= len(head) and old_place in borders:
                    meet = borders[old_place]
                    break
                if not done and place + len(part) + CONTEXT > len(horizon):
                    break  # this cut may depend on what lies beyond
                fresh.append(part)
                place += len(part)
            else:
                if done:
                    meet = (len(self.blocks), 0)
            if meet:
                break
        self.encoded += len(fresh)
        last, stop = meet
        counts = self.counter.counts(fresh)
        before, after = self.blocks[first], self.blocks[last] if last < len(self.blocks) else ([], [])
        parts = before[0][:index] + fresh + after[0][stop:]
        counts = before[1][:index] + counts + after[1][stop:]
        upto = min(last + 1, len(self.blocks))
        if upto == first + 1 and 0 < len(parts) <= 2 * BLOCK:
            self.blocks[first] = (parts, counts)
            self._set(first)
        else:
            new = [(parts[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(parts), BLOCK)]
            same = len(new) == upto - first
            self.blocks[first:upto] = new
            if not self.blocks:
                self.blocks = [([], [])]
            if same:
                for k in range(first, upto):
                    self._set(k)
            else:
                self._grow()
        return self.total


def drawn_edits(text: str, many: int = 3) -> list[tuple[int, int, str]]:
    """Edits drawn from a text's own hash: each replaces up to 63 characters by up to 63 of its own."""
    seed, length, out = xxhash.xxh64_intdigest(text.encode()), len(text), []
    for k in range(many):
        h = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), seed)
        start = h % (length + 1)
        end = min(length, start + (h >> 32) % 64)
        source = (h >> 20) % (length + 1)
        insert = text[source : source + (h >> 40) % 64]
        out.append((start, end, insert))
        length += len(insert) - (end - start)
    return out


_COUNTED = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_chars", "n_tokens", "edited_chars", "edited_tokens", "reencoded", "pretokens")])
_COUNTED_SQL = ", ".join(f"{n} long" for n in _COUNTED.names)


def counted(docs: DataFrame, ranks: str, pattern: str, edits=None) -> DataFrame:
    """``(doc_id, n_chars, n_tokens, edited_chars, edited_tokens, reencoded, pretokens)`` per row.

    ``edits`` names a column of ``docs``, an array of ``(start, end, insert)`` structs in
    the order of application, each in code points of the text so far; without it each
    text gets the edits its own hash draws. Places beyond a text's end mean its end, a
    null insert is an empty one, and a null array no edit. Null texts are empty ones,
    of no tokens. ``reencoded`` is how many pre-tokens the edits made anew, ``pretokens``
    how many the edited text has. Other columns play no part; repeated rows come out
    alike; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = texts_of(docs)
    if edits:
        kind = "array<struct<start:long,end:long,insert:string>>"
        rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
            F.col(edits).cast(kind).alias("edits"),
        )

    def run(batches):
        counter = Counter.of(ranks, pattern)
        for found in batches:
            given = found.column(2).to_pylist() if found.num_columns > 2 else None
            out = []
            for k, (doc, text) in enumerate(zip(found.column(0).to_pylist(), found.column(1).to_pylist())):
                tree = CountTree(counter, text)
                n_chars, n_tokens = tree.length, tree.total
                if given is None:
                    steps = drawn_edits(text)
                else:
                    steps = [(e["start"] or 0, e["end"] or 0, e["insert"] or "") for e in given[k] or [] if e]
                for step in steps:
                    tree.edit(*step)
                parts = sum(len(p) for p, _ in tree.blocks)
                out.append((doc, n_chars, n_tokens, tree.length, tree.total, tree.encoded, parts))
            if out:
                yield batch(_COUNTED, **dict(zip(_COUNTED.names, zip(*out))))
        counter.known.clear()  # an idle worker holds none

    return rows.mapInArrow(run, _COUNTED_SQL)
