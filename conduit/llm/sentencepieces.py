"""SentencePiece encoding and decoding with a suffix array over the batch's text.

A text is a dummy space and itself, spaces shown as a mark; pieces never reach over the
beginning of a run of marks, so the stretches from one run to the next are independent
and each distinct one is encoded once. The new stretches of a batch are laid end to end
and their suffixes sorted. Every piece of the vocabulary is then looked up by binary
search: the range of suffixes it begins is the set of its occurrences. Each occurrence
is an edge from its begin to its end; edges are sorted by position. Relaxation runs over
all stretches together: of the edges that join two neighbouring symbols the best-scored
(the leftmost of equals) replaces them, until none is left. Characters that no edge
covers fall back to their bytes.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from conduit.llm.bpe import ChunkTable, gather
from conduit.llm.common import batch, byte_column, ship, steps, texts_of

MARK = "▁"
_NEVER = np.int32(2**31 - 1)
_LONG = 48  # characters of a stretch beyond which a heap does the relaxation


class Vocabulary:
    """Pieces, their priority and bytes, read from a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        text = [model.id_to_piece(i) for i in plain]
        order = sorted(range(len(plain)), key=lambda k: text[k])
        self.ids = np.array([plain[k] for k in order], np.int32)
        self.text = [text[k] for k in order]
        scores = np.array([model.get_score(int(i)) for i in self.ids])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)  # equal scores, equal ranks
        self.longest = max(map(len, self.text), default=1)
        self.size = np.fromiter(map(len, self.text), np.int64, len(self.text))
        self.letters = np.frombuffer("".join(self.text).encode("utf-32-le"), np.uint32)
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown = model.unk_id()
        shown = [b""] * model.vocab_size()
        for i, piece in zip(self.ids.tolist(), self.text):
            shown[i] = piece.replace(MARK, " ").encode()
        for byte, i in self.bytes.items():
            shown[i] = bytes([byte])
        shown[self.unknown] = " ⁇ ".encode()
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_count = np.fromiter(map(len, shown), np.int64, len(shown))
        self.shown_begin = np.cumsum(self.shown_count) - self.shown_count


def suffix_order(codes: np.ndarray, reach: int):
    """Suffixes by their first ``reach`` symbols at least, with the sorted pairs of keys.

    Symbols are small positive numbers (0 ends a stretch). As many as fit are packed into
    one key; doubling pairs keys until they cover ``reach``.
    """
    bits = max(int(codes.max(initial=1)).bit_length(), 1)
    fits = 62 // bits
    padded = np.concatenate([codes, np.zeros(fits, codes.dtype)]).astype(np.int64)
    key = np.zeros(len(codes), np.int64)
    for k in range(fits):
        key = (key << bits) | padded[k : k + len(codes)]
    covered, rank = fits, key
    while covered < reach:
        names = np.unique(rank, return_inverse=True)[1]
        later = np.concatenate([names[covered:] + 1, np.zeros(min(covered, len(names)), np.int64)])
        rank = names * (len(names) + 1) + later
        covered *= 2
    return np.argsort(rank), key, bits, fits


def ranges(order, key, bits, fits, flat: np.ndarray, size: np.ndarray):
    """First and last suffix, in order, that each piece begins: binary searches side by side.

    ``flat`` has the symbols of all pieces one after the other, ``size`` how many each has.
    """
    parts = -(-int(size.max(initial=1)) // fits)
    pieces = size
    low, high = (np.zeros((len(pieces), parts), np.int64) for _ in range(2))
    full = (1 << bits) - 1
    table = np.full((len(pieces), parts * fits), -1, np.int64)
    row = np.repeat(np.arange(len(pieces)), size)
    table[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    for k in range(parts * fits):
        part, symbol = k // fits, table[:, k]
        low[:, part] = (low[:, part] << bits) | np.where(symbol < 0, 0, symbol)
        high[:, part] = (high[:, part] << bits) | np.where(symbol < 0, full, symbol)
    n = len(order)
    columns = [np.concatenate([key[p * fits :], np.zeros(min(p * fits, n), np.int64)])[order] for p in range(parts)]

    def search(want, right):
        begin, end = np.zeros(len(pieces), np.int64), np.full(len(pieces), n)
        for _ in range(int(n).bit_length() + 1):
            middle = np.minimum((begin + end) // 2, max(n - 1, 0))
            less, same = np.zeros(len(pieces), bool), np.ones(len(pieces), bool)
            for p in range(parts):
                found = columns[p][middle]
                less |= same & (found < want[:, p])
                same &= found == want[:, p]
            go = (begin < end) & (less | (same if right else False))
            stay = (begin < end) & ~go
            begin = np.where(go, middle + 1, begin)
            end = np.where(stay, middle, end)
        return begin

    return search(low, False), search(high, True)


class Lattice:
    """The edges of all pieces over stretches laid end to end."""

    def __init__(self, vocabulary: Vocabulary, stretches: list[str]):
        self.sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        text = "\0".join([*stretches, ""])
        self.text = text
        self.begins = np.cumsum(self.sizes + 1) - self.sizes - 1
        raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        letters, codes = np.unique(raw, return_inverse=True)
        codes = codes.astype(np.int64) + 1
        ends = np.cumsum(self.sizes + 1) - 1
        codes[ends] = 0  # the separators, though a text may have such characters of its own
        there = np.searchsorted(letters, vocabulary.letters)
        there[there == len(letters)] = 0
        symbol = np.where(letters[there] == vocabulary.letters, there.astype(np.int64) + 1, 0)
        first = np.cumsum(vocabulary.size) - vocabulary.size
        usable = np.flatnonzero(np.minimum.reduceat(symbol, first) > 0)  # all letters occur
        size = vocabulary.size[usable]
        order, key, bits, fits = suffix_order(codes, vocabulary.longest)
        first, last = ranges(order, key, bits, fits, gather(symbol, first[usable], size), size)
        many = last - first
        begin = gather(order, first, many)
        piece = np.repeat(usable, many)
        # sorted by position, then length, they are a table: row for position, column for length
        width = vocabulary.longest + 1
        edge = np.sort((begin * width + np.repeat(size, many)) << 20 | piece)
        self.width = width
        self.piece = np.full(len(codes) * width, -1, np.int32)
        self.piece[edge >> 20] = edge & ((1 << 20) - 1)
        self.vocabulary = vocabulary

    def edges(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The piece from ``at`` over ``length`` characters, -1 if there is none."""
        inside = (length > 0) & (length < self.width)
        found = self.piece[at * self.width + np.where(inside, length, 0)]
        return np.where(inside, found, -1)

    def _ranks(self, at, length):
        found = self.edges(at, length)
        return np.where(found >= 0, self.vocabulary.rank[found], _NEVER)

    def relaxed(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches one after the other, and how many each has."""
        owners, begins, lengths = [], [], []
        order = np.argsort(self.sizes, kind="stable")
        sizes = self.sizes[order]
        at, short = 0, int(np.searchsorted(sizes, _LONG, side="right"))
        while at < short:
            top = max(int(sizes[at] * 1.25), int(sizes[at]) + 1)
            stop = min(int(np.searchsorted(sizes, top, side="right")), at + 20_000, short)
            pick = order[at:stop]
            cut = self._block(self.begins[pick], self.sizes[pick])
            row, column = np.nonzero(cut[:, 1:] > cut[:, :-1])
            owners.append(pick[row])
            begins.append(self.begins[pick[row]] + cut[row, column])
            lengths.append(cut[row, column + 1] - cut[row, column])
            at = stop
        for k in order[short:].tolist():
            cut = np.array(self._one(int(self.begins[k]), int(self.sizes[k])), np.int64)
            owners.append(np.full(len(cut) - 1, k))
            begins.append(self.begins[k] + cut[:-1])
            lengths.append(np.diff(cut))
        owner, begin, length = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, begins, lengths))
        by_begin = np.argsort(begin, kind="stable")
        owner, begin, length = owner[by_begin], begin[by_begin], length[by_begin]
        found = self.edges(begin, length)
        bare = np.flatnonzero(found < 0)
        ids = np.where(found >= 0, self.vocabulary.ids[found], -1)
        if len(bare):
            spelt = [[self.vocabulary.bytes.get(b, self.vocabulary.unknown) for b in self.text[i].encode()] for i in begin[bare].tolist()]
            size = np.ones(len(ids), np.int64)
            size[bare] = [len(x) for x in spelt]
            first = np.cumsum(size) - size
            ids, owner = np.repeat(ids, size), np.repeat(owner, size)
            for k, x in zip(first[bare].tolist(), spelt):
                ids[k : k + len(x)] = x
        return ids.astype(np.int32), np.bincount(owner, minlength=len(self.sizes)).astype(np.int64)

    def _block(self, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Cuts of each stretch, filled up with its size, after all joins."""
        wide = int(sizes.max(initial=0))
        cut = np.minimum(np.arange(wide + 2), sizes[:, None])
        out = cut.copy()
        live = np.arange(len(begins))
        # a join needs two symbols, so the cut between them must be inside
        def pair(rows, column):
            left, middle, right = cut[rows, column], cut[rows, column + 1], cut[rows, column + 2]
            ranks = self._ranks(begins[live[rows]] + left, right - left)
            return np.where((middle > left) & (right > middle), ranks, _NEVER)

        rows = np.repeat(np.arange(len(live)), wide).reshape(len(live), wide)
        ranks = pair(rows, np.broadcast_to(np.arange(wide), rows.shape)).astype(np.int32)
        while len(live) and wide:
            at = ranks.argmin(1)
            going = ranks[np.arange(len(live)), at] != _NEVER
            if not going.all():
                out[live[~going]] = cut[~going]
                live, cut, ranks, at = live[going], cut[going], ranks[going], at[going]
            if not len(live):
                break
            rows = np.arange(len(live))
            behind = np.arange(wide + 1) > at[:, None]
            cut[:, :-1] = np.where(behind, cut[:, 1:], cut[:, :-1])
            ranks[:, :-1] = np.where(behind[:, : wide - 1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NEVER
            ranks[rows, at] = pair(rows, at)
            left = np.maximum(at - 1, 0)
            ranks[rows, left] = np.where(at > 0, pair(rows, left), ranks[rows, left])
        return out

    def _one(self, begin: int, size: int) -> list[int]:
        """Cuts of one long stretch, with a heap of its joins."""
        table, width = self.piece[begin * self.width : (begin + size) * self.width], self.width
        rank = self.vocabulary.rank
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        gone = bytearray(size)

        def join(i):
            j = after[i]
            if j < size and (n := after[j] - i) < width and (found := table[i * width + n]) >= 0:
                heapq.heappush(heap, (int(rank[found]), i, after[j]))

        heap: list[tuple[int, int, int]] = []
        for i in range(size):
            join(i)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= size or after[j] != end:
                continue
            gone[j] = 1
            after[i] = end
            if end < size:
                before[end] = i
            join(i)
            if before[i] >= 0:
                join(before[i])
        return [i for i in range(size) if not gone[i]] + [size]


class PieceCoder(ChunkTable):
    """Encoding and decoding with the model at ``path``; one per worker and file."""

    _made: dict[str, "PieceCoder"] = {}

    @classmethod
    def of(cls, path: str) -> "PieceCoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        super().__init__()

    def _chunks(self, texts):
        """Stretches from one run of spaces to the next; an empty text has none."""
        mark = MARK.encode()
        texts = [b" " + t.replace(mark, b" ") if t else b"" for t in texts]
        buffer = b"\xff".join([*texts, b""]) or b"\xff"
        code = np.frombuffer(buffer, np.uint8)
        space, stop = code == 32, code == 255  # no text has the byte 255
        before = np.r_[False, space[:-1]]
        begin = np.flatnonzero(space & ~before)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.cumsum(sizes)
        end = np.minimum(np.r_[begin[1:], len(code)], np.flatnonzero(stop)[np.searchsorted(bounds, begin, side="right")] if len(begin) else 0)
        return buffer, code, begin, end, np.searchsorted(begin, np.r_[0, bounds])

    def _learn(self, chunks: list[bytes], names: list[int]) -> None:
        if chunks:
            stretches = [c.decode().replace(" ", MARK) for c in chunks]
            self._add(names, *Lattice(self.vocabulary, stretches).relaxed())

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of rows of ids, without the dummy space each begins with."""
        held = self.vocabulary
        size = held.shown_count[ids]
        data = gather(held.shown, held.shown_begin[ids], size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(ends, ends[1:])]


_CODED = pa.schema(
    [("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("n_chars", pa.int64()), ("text_crc32", pa.int64()), ("same", pa.bool_())]
)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)``: every text's ids as an array of int."""
    ship(docs.sparkSession)
    kind = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        coder = PieceCoder.of(model)
        for found in batches:
            texts = byte_column(found.column(1))
            for i, j in steps([len(x) for x in texts]):
                ids, counts = coder.encode(texts[i:j])
                offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield batch(kind, doc_id=found.column(0).slice(i, j - i), ids=lists)
        coder.forget()

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """``(doc_id, text)`` of rows of ``(doc_id, ids)``; null ids give an empty text."""
    ship(rows.sparkSession)
    kind = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        coder = PieceCoder.of(model)
        for found in batches:
            lists = [x or [] for x in found.column(1).to_pylist()]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.array([x for i in lists for x in i], np.int64)
            yield batch(kind, doc_id=found.column(0), text=coder.decode(ids, counts))

    return rows.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_ids, ids_crc32, n_chars, text_crc32, same)`` of every row of ``docs``.

    The checksums are those of the ids (little-endian, 32 bits) and of the text that the
    ids decode to; ``same`` says that it is the text itself, which fails only for texts
    that hold the mark for a space. Null texts are empty ones, which have no ids. Other
    columns play no part; repeated rows come out alike; an empty table gives none.
    """
    ship(docs.sparkSession)

    def run(batches):
        coder = PieceCoder.of(model)
        for found in batches:
            texts, doc = byte_column(found.column(1)), found.column(0)
            for i, j in steps([len(x) for x in texts]):
                ids, counts = coder.encode(texts[i:j])
                back = coder.decode(ids, counts)
                data, ends = ids.astype("<u4").tobytes(), np.r_[0, 4 * np.cumsum(counts)].tolist()
                plain = [x.encode() for x in back]
                yield batch(
                    _CODED,
                    doc_id=doc.slice(i, j - i),
                    n_ids=counts,
                    ids_crc32=[zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])],
                    n_chars=[len(x) for x in back],
                    text_crc32=[zlib.crc32(x) for x in plain],
                    same=[x == y for x, y in zip(plain, texts[i:j])],
                )
        coder.forget()

    return texts_of(docs).mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, n_chars long, text_crc32 long, same boolean"
    )
