"""Token ids of whole texts at the speed of array look-ups.

A text is a row of chunks between plain white space, which the tokenizer never joins.
Each distinct chunk is encoded once and remembered; a text's ids are then gathered from
the table of known chunks. New chunks are split into pre-tokens, and the new ones of
those are merged together as arrays: in each round the lowest-ranked pair of every
pre-token becomes one symbol. Chunks beyond the plain Latin range, with control
characters or with the text of a special token, go through the tokenizer itself.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import regex
from tokenizers import Tokenizer

_NEVER = np.int32(2**31 - 1)
_LONG = 40  # symbols of a pre-token beyond which a heap does the merging
_PLAIN = regex.compile(r"[ -~\xa1-\xac\xae-ɏ]+")
_KNOWN = 200_000  # chunks that a worker remembers at once


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else one beyond 255."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Merger:
    """Byte-pair merges by rank over many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int32)
        self.size = len(vocab)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made[order]
        self.by_rank = made
        self.pairs = dict(zip(key.tolist(), range(len(pairs))))
        # ranks of all pairs of single bytes, by symbol; the last row and column are for none
        single = np.r_[self.inner, self.last]
        self.place = np.zeros(self.size + 1, np.int32)
        self.place[single] = np.arange(512)
        self.place[-1] = 512
        self.bytes = np.full((513, 513), _NEVER, np.int32)
        self.bytes[:512, :512] = self.ranks(single[:, None], single[None, :])

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, _NEVER if they don't merge (or one is none)."""
        want = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (a >= 0) & (b >= 0), self.rank[at], _NEVER)

    def _one(self, symbols: list[int]) -> list[int]:
        """The merges of one long pre-token, with a heap of its pairs."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get, size = self.pairs.get, self.size
        heap = [(r, i) for i in range(n - 1) if (r := get(symbols[i] * size + symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n or get(symbols[i] * size + symbols[j]) != rank:
                continue
            symbols[i], symbols[j] = int(self.by_rank[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := get(symbols[i] * size + symbols[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := get(symbols[before[i]] * size + symbols[i])) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [s for s in symbols if s >= 0]

    def _block(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols, -1 behind each row's last, and how many each row has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        wide = int(size.max())
        code = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(len(words)), size)
        column = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
        symbols = np.full((len(words), wide + 1), -1, np.int32)
        symbols[row, column] = np.where(column == size[row] - 1, self.last[code], self.inner[code])
        out, counts = symbols.copy(), size.copy()
        live = np.arange(len(words))
        place = self.place[symbols]
        ranks = self.bytes[place[:, :-1], place[:, 1:]]
        while True:
            at = ranks.argmin(1)
            rank = ranks[np.arange(len(live)), at]
            going = rank != _NEVER
            if not going.all():
                out[live[~going]] = symbols[~going]
                live, symbols, ranks, at, rank = (x[going] for x in (live, symbols, ranks, at, rank))
            if not len(live):
                return out, counts
            counts[live] -= 1
            rows = np.arange(len(live))
            behind = np.arange(wide) > at[:, None]
            symbols[:, :-1] = np.where(behind, symbols[:, 1:], symbols[:, :-1])
            symbols[rows, at] = self.by_rank[rank]
            symbols[:, -1] = -1
            ranks[:, :-1] = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NEVER
            ranks[rows, at] = self.ranks(symbols[rows, at], symbols[rows, at + 1])
            left = np.maximum(at - 1, 0)
            ranks[rows, left] = np.where(at > 0, self.ranks(symbols[rows, left], symbols[rows, at]), ranks[rows, left])

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        parts: list = [None] * len(words)
        order = np.argsort(size, kind="stable")
        short = order[: np.searchsorted(size[order], _LONG, side="right")]
        at, blocks = 0, []
        while at < len(short):
            top = max(int(size[short[at]] * 1.25), int(size[short[at]]) + 1)
            stop = min(int(np.searchsorted(size[short], top, side="right")), at + 20_000)
            pick = short[at:stop]
            symbols, n = self._block([words[k] for k in pick])
            counts[pick] = n
            blocks.append((pick, symbols))
            at = stop
        for k in order[len(short) :]:
            code = np.frombuffer(words[k], np.uint8)
            symbols = self.inner[code].tolist()
            symbols[-1] = int(self.last[code[-1]])
            parts[k] = self._one(symbols)
            counts[k] = len(parts[k])
        begin = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for pick, symbols in blocks:
            row, column = np.nonzero(symbols >= 0)
            flat[begin[pick][row] + column] = symbols[row, column]
        for k in order[len(short) :]:
            flat[begin[k] : begin[k] + counts[k]] = parts[k]
        return flat, counts


def gather(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The slices ``flat[begin : begin + count]`` one after the other."""
    offset = np.repeat(begin - (np.cumsum(count) - count), count)
    return flat[offset + np.arange(int(count.sum()))]


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse


class ChunkNames:
    """64-bit names of stretches of a buffer, from sums over its bytes.

    A byte's random number times a power of the position, summed over a stretch and moved
    back to position zero, does not depend on where the stretch stands.
    """

    def __init__(self):
        draw = np.random.default_rng(11)
        self.letter = draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._powers((1 << 20) + (1 << 17))

    def _powers(self, n: int) -> None:
        with np.errstate(over="ignore"):
            self.up = np.multiply.accumulate(np.r_[1, np.full(n, _BASE, np.uint64)].astype(np.uint64))
            back = np.uint64(pow(_BASE, -1, 1 << 64))
            self.down = np.multiply.accumulate(np.r_[1, np.full(n, back, np.uint64)].astype(np.uint64))

    def of(self, code: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(code) > len(self.up):
            self._powers(len(code) + len(code) // 2)
        with np.errstate(over="ignore"):
            parts = self.letter[code] * self.up[: len(code)]
            total = np.r_[np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)]
            name = (total[end] - total[begin]) * self.down[begin]
            return (name ^ (name >> np.uint64(31))) + (end - begin).astype(np.uint64)


class ChunkTable:
    """Ids of texts by their chunks, each distinct chunk encoded once.

    A subclass says how texts fall into chunks (``_chunks``) and encodes new ones
    (``_learn``, which calls ``_add``). The table is dropped when it is full, and by
    ``forget`` at the end of a task, so an idle worker holds none.
    """

    def __init__(self):
        self.names = ChunkNames()
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(0, np.int32), 0

    def _add(self, names: list[int], flat: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.known)
        if n + len(names) > len(self.begin):
            room = max(n // 2, len(names))
            self.begin = np.concatenate([self.begin, np.zeros(room, np.int64)])
            self.count = np.concatenate([self.count, np.zeros(room, np.int32)])
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(self.used // 2, len(flat)), np.int32)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.begin[n : n + len(names)] = self.used + np.cumsum(counts) - counts
        self.count[n : n + len(names)] = counts
        self.used += len(flat)
        self.known.update(zip(names, range(n, n + len(names))))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        buffer, code, begin, end, edges = self._chunks(texts)
        name = self.names.of(code, begin, end)
        distinct, first, place = np.unique(name, return_index=True, return_inverse=True)
        get = self.known.get
        keys = distinct.tolist()
        rows = [get(k, -1) for k in keys]
        if -1 in rows:
            fresh = [k for k, row in enumerate(rows) if row < 0]
            if self.known and len(self.known) + len(fresh) > _KNOWN:
                self.forget()
                fresh = list(range(len(keys)))
            where = first[fresh]
            chunks = [buffer[a:b] for a, b in zip(begin[where].tolist(), end[where].tolist())]
            self._learn(chunks, [keys[k] for k in fresh])
            get = self.known.get
            rows = [get(k) for k in keys]
        rows = np.array(rows, np.int64)[place]
        count = self.count[rows].astype(np.int64)
        ids = gather(self.flat, self.begin[rows], count)
        ends = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(ends[edges])


class Coder(ChunkTable):
    """Ids of whole texts by the tokenizer at ``path``; one per worker and file."""

    _made: dict[str, "Coder"] = {}

    @classmethod
    def of(cls, path: str) -> "Coder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.path, self._tokenizer = path, None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.split = regex.compile(splits[0]["pattern"]["Regex"] + "| ").findall
        self.special = [t["content"][:2] for t in spec["added_tokens"]]
        self.merger = Merger(path)
        self.space = np.zeros(256, bool)
        self.space[list(b" \t\n\v\f\r")] = True
        super().__init__()

    @property
    def tokenizer(self) -> Tokenizer:
        """The library's own, which few texts need; so it is read when one does."""
        if self._tokenizer is None:
            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def _chunks(self, texts):
        """Stretches without plain white space."""
        buffer = b" ".join([*texts, b""]) or b" "
        code = np.frombuffer(buffer, np.uint8)
        gap = self.space[code]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.r_[0, edge]
        begin, end = edge[::2], edge[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return buffer, code, begin, end, np.searchsorted(begin, np.r_[0, np.cumsum(sizes)])

    def _plain(self, text: str) -> bool:
        return bool(_PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def _learn(self, chunks: list[bytes], names: list[int]) -> None:
        line = b" ".join(chunks).decode()
        if not self._plain(line):
            plain = [self._plain(c) for c in line.split(" ")]
            other = [k for k, yes in enumerate(plain) if not yes]
            ids = [self.tokenizer.encode(chunks[k].decode(), add_special_tokens=False).ids for k in other]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._add([names[k] for k in other], np.array([x for i in ids for x in i], np.int32), sizes)
            chunks = [c for c, yes in zip(chunks, plain) if yes]
            names = [c for c, yes in zip(names, plain) if yes]
            line = b" ".join(chunks).decode()
        if not chunks:
            return
        parts = self.split(line.lower())
        index = {" ": 0}
        at = np.array([index.setdefault(p, len(index)) for p in parts], np.int64)
        flat, counts = self.merger.encode([p.encode() for p in index])
        begin = np.cumsum(counts) - counts
        counts[0] = 0  # the space between two chunks
        owner = np.cumsum(at == 0)
        sizes = np.bincount(owner, weights=counts[at], minlength=len(chunks)).astype(np.int64)
        self._add(names, gather(flat, begin[at], counts[at]), sizes)
