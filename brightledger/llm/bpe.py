"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by an incremental UTF-8 machine.

The merges are compiled once per worker into a byte trie of the vocabulary and, for every token, the pair that its last
merge joins. Two facts carry the transducer. First, a token sequence is what the merges give for its bytes if and only if
every neighbouring pair of tokens is *stable*: no merge across their border comes before the merges that hide it. Second,
each prefix of a piece therefore ends in exactly one token, so all prefixes form a tree of borders.

A state holds the borders that a longer token could still start from (trie node, token before it) with the tree above
them. Reading a byte walks all nodes, finds the one new border, drops borders that no token continues, and emits the
tokens that all remaining ones share: the lookahead is bounded by the longest token. States and moves are made when first
needed and kept in a table of bounded size.
"""

from __future__ import annotations

import base64
import functools
import gc
import re
import unicodedata
from array import array
from collections.abc import Callable
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_column, map_rows, only, text_or_empty

#: Moves of the transducer's table, and bytes of the table of finished pieces, per worker. A move takes about 400 bytes. Of full tables what is in use stays.
MOVES, PIECES = 400_000, 96_000_000
#: Moves of a state that is kept when the table is full: most states are on the way of one rare word.
BRANCHES = 2
#: Bytes of a piece after which the table of moves is looked at again.
STRETCH = 4096
#: Of a border: where the trie node begins, and all that is below it.
NODE, BELOW, AT = 40, (1 << 40) - 1, (1 << 16) - 1


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def border(node: int, token: int, up: int) -> int:
    """One border of a state in one number: trie node, token before it and place of the border before that token, each plus one so that 0 is none."""
    return node << NODE | token << 16 | up


class State(dict):
    """Byte to (next state, tokens that become certain); a move is made when it is first asked for."""

    __slots__ = ("borders", "ending", "owner")

    def __init__(self, owner: Transducer, borders: tuple[int, ...]):
        super().__init__()
        self.owner, self.borders, self.ending = owner, borders, None

    def __missing__(self, byte: int) -> tuple[State, tuple[int, ...]]:
        self[byte] = step = self.owner.move(self, byte)
        return step


class Transducer:
    """Bytes of a piece to token ids."""

    def __init__(self, ranks: dict[bytes, int], most_moves: int | None = None):
        self.most_moves = MOVES if most_moves is None else most_moves
        self.ranks, self.tokens = ranks, {v: k for k, v in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} single bytes have no token")
        self.nodes: dict[int, int] = {}  # the root is node 1
        ends = [0, 0]
        for token, rank in ranks.items():
            node = 1
            for b in token:
                key = node << 8 | b
                node = self.nodes.get(key, 0)
                if not node:
                    node = self.nodes[key] = len(ends)
                    ends.append(0)
            ends[node] = rank + 1
        inner = {key >> 8 for key in self.nodes}
        self.inner = bytearray(node in inner for node in range(len(ends)))
        self.pair: dict[int, tuple[int, int]] = {}
        self.joined: dict[int, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = self.merged(token, rank)
                if len(parts) == 2:  # else no merge makes this token; only a whole piece can be it
                    self.pair[rank] = parts
                    self.joined[parts[0] << 32 | parts[1]] = rank
        # per node the token that ends there, plus one, if merges can make it
        self.token_at = [end if end and (end - 1 in self.pair or len(self.tokens[end - 1]) == 1) else 0 for end in ends]
        self.spines: tuple[dict, dict] = ({}, {})
        self.known: dict[int, bool] = {}
        self.reset()

    def merged(self, piece: bytes, below: float = float("inf")) -> tuple[int, ...]:
        """The merges of rank under ``below`` applied one by one, lowest rank and leftmost first."""
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ranks[p] for p in parts)

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols that stand at one end of a token while it is built, each with the rank of the merge that hides it."""
        if (known := self.spines[side].get(token)) is not None:
            return known
        out, hidden, at = [], float("inf"), token
        while True:
            out.append((at, hidden))
            if at not in self.pair:
                self.spines[side][token] = out
                return out
            hidden, at = at, self.pair[at][side]

    def judged(self, pair: int) -> bool:
        """``stable`` of the left and the right token in one number; few pairs make most borders, so what is known is kept up to a bound."""
        if len(self.known) >= self.most_moves // 4:
            self.known.clear()
        self.known[pair] = out = self.stable(pair >> 24, pair & 0xFFFFFF)
        return out

    def stable(self, left: int, right: int) -> bool:
        """No merge across the border comes first. At equal ranks the leftmost does: the left token's own before the border's, the border's before the right's."""
        joined, lefts, rights = self.joined, self.spines[1].get(left), self.spines[0].get(right)
        rights = rights or self.spine(right, 0)
        for a, hides_a in lefts or self.spine(left, 1):
            a <<= 32
            for b, hides_b in rights:
                merge = joined.get(a | b)
                if merge is not None and merge < hides_a and merge <= hides_b:
                    return False
        return True

    def reset(self) -> None:
        """Forget all states but the first: one border before the first byte."""
        for state in getattr(self, "states", {}).values():
            state.clear()  # they point at each other
        start = (border(1, 0, 0),)
        self.start, self.made_moves = State(self, start), 0
        self.states = {start: self.start}

    def trim(self) -> None:
        """Forget the states that few moves lead on from, and the moves to them."""
        kept = {borders: state for borders, state in self.states.items() if len(state) >= BRANCHES}
        kept[self.start.borders] = self.start
        for borders, state in self.states.items():
            if borders not in kept:
                state.clear()
        for state in kept.values():
            for byte in [b for b, (to, _) in state.items() if to.borders not in kept]:
                del state[byte]
        self.states, self.made_moves = kept, sum(map(len, kept.values()))
        if self.made_moves > self.most_moves // 2:
            self.reset()

    def move(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """State after one more byte, and the tokens that are now certain."""
        self.made_moves += 1
        node_of, inner, token_at, known = self.nodes.get, self.inner, self.token_at, self.known.get
        entries, found = [], 0
        for at, code in enumerate(state.borders, 1):
            child = node_of(code >> NODE << 8 | byte, 0)
            if not child:
                entries.append(code & BELOW)
            else:
                # one border only can end here, so the search ends with the first stable token
                if not found and (new := token_at[child]):
                    pair = (code >> 16 & 0xFFFFFF) - 1 << 24 | new - 1
                    if pair < 0 or (firm if (firm := known(pair)) is not None else self.judged(pair)):
                        found = 1 << NODE | new << 16 | at
                entries.append(child << NODE | code & BELOW if inner[child] else code & BELOW)
        if not found:
            raise ValueError("no token ends here: the ranks are no merge table")
        entries.append(found)
        n = len(entries)
        below = [0] * n  # needed borders that follow each one
        for at in range(n - 1, 0, -1):
            if entries[at] > BELOW or below[at]:
                below[(entries[at] & AT) - 1] += 1
        root, out = 0, []
        while entries[root] <= BELOW and below[root] == 1:  # nothing starts at this border any more and one border follows it
            up = root + 1
            while (code := entries[(root := root + 1)]) & AT != up or not (code > BELOW or below[root]):
                pass
            out.append((code >> 16 & 0xFFFFFF) - 1)
        code = entries[root]
        borders, place = [code & ~AT if code > BELOW else 0], [0] * (n + 1)
        place[root + 1] = 1
        for at in range(root + 1, n):
            code = entries[at]
            if code > BELOW or below[at]:
                borders.append(code & ~AT | place[code & AT])
                place[at + 1] = len(borders)
        borders = tuple(borders)
        if (to := self.states.get(borders)) is None:
            to = self.states[borders] = State(self, borders)
        return to, tuple(out)

    def ending(self, state: State) -> tuple[int, ...]:
        """The tokens between the certain ones and the end."""
        out, at = [], len(state.borders)
        while up := (code := state.borders[at - 1]) & AT:
            out.append((code >> 16 & 0xFFFFFF) - 1)
            at = up
        state.ending = tuple(reversed(out))
        return state.ending

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Tokens of one piece; a piece that is itself a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        if self.made_moves > self.most_moves:
            self.trim()
        state, out = self.start, []
        for b in piece if len(piece) <= STRETCH else piece[:STRETCH]:
            state, sure = state[b]
            if sure:
                out += sure
        for at in range(STRETCH, len(piece), STRETCH):
            if self.made_moves > self.most_moves:
                here = state.borders
                self.trim()
                state = self.states.setdefault(here, State(self, here))
            for b in piece[at : at + STRETCH]:
                state, sure = state[b]
                if sure:
                    out += sure
        out += state.ending or self.ending(state)
        return tuple(out)


class Pieces(dict):
    """Piece of text to token ids, held as bytes of 32-bit numbers and filled on demand. When half of the bytes are used, it becomes the older half, which lends what is asked for again; a long piece is not kept."""

    def __init__(self, transducer: Transducer, most_bytes: int | None = None):
        super().__init__()
        self.transducer, self.older, self.bytes = transducer, {}, 0
        self.most_bytes = PIECES if most_bytes is None else most_bytes

    packed = dict.__getitem__  # the bytes as they are held

    def __getitem__(self, piece: str) -> tuple[int, ...]:
        return tuple(array("i", self.packed(piece)))

    def __missing__(self, piece: str) -> bytes:
        out = self.older.pop(piece, None) or array("i", self.transducer.encode(piece.encode())).tobytes()
        size = 100 + getsizeof(piece) + getsizeof(out)  # with its place in the table
        if size < self.most_bytes // 64:
            self.bytes += size
            if self.bytes > self.most_bytes // 2:
                self.older = dict(self)
                self.clear()
                self.bytes = size
            self[piece] = out
        return out


def utf8_moves() -> list[list[int]]:
    """Moves of the machine for well-formed UTF-8: state 0 is between characters, -1 is an error, the rest wait for the bytes that may follow."""
    waiting = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0xA0, 0xBF, 1), 4: (0x80, 0x9F, 1), 5: (0x80, 0xBF, 2), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}
    first = [0] * 0x80 + [-1] * 0x42 + [1] * 30 + [3] + [2] * 12 + [4] + [2] * 2 + [6] + [5] * 3 + [7] + [-1] * 11
    return [first] + [[to if low <= b <= high else -1 for b in range(256)] for low, high, to in waiting.values()]


class Utf8Stream:
    """Bytes in blocks to text: what a block leaves unfinished waits for the next one; malformed bytes become U+FFFD."""

    MOVES = utf8_moves()

    def __init__(self) -> None:
        self.open = b""

    def unfinished(self, data: bytes) -> int:
        """Number of last bytes that begin a character and do not end it. A lead byte resets the machine, so three bytes tell."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                state = 0
                for b in data[-back:]:
                    state = self.MOVES[state][b]
                    if state <= 0:
                        return 0
                return back
            if lead < 0x80:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.open + data
        cut = len(data) - self.unfinished(data)
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def compiled(data: bytes, share: float = 1) -> Pieces:
    """The tables for a rank file, with the given share of the usual memory."""
    return Pieces(Transducer(read_ranks(data), int(share * MOVES)), int(share * PIECES))


@functools.lru_cache(maxsize=4)
def vocabulary(data: bytes) -> list[bytes]:
    ranks = read_ranks(data)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def forget() -> None:
    compiled.cache_clear()
    vocabulary.cache_clear()


def latin_pattern(pattern: str) -> str | None:
    """``pattern`` for texts of code points under 256 in the syntax of the faster ``re``; None if it has more than the classes of letters, numbers and spaces."""
    kinds = {"\\p{L}": lambda c: unicodedata.category(c)[0] == "L", "\\p{N}": lambda c: unicodedata.category(c)[0] == "N", "\\s": lambda c: regex.match(r"\s", c) is not None}
    ranges = {name: "".join(f"\\x{i:02x}" for i in range(256) if test(chr(i))) for name, test in kinds.items()}
    out, at, inside = [], 0, False
    while at < len(pattern):
        name = next((k for k in (*kinds, "\\S") if pattern.startswith(k, at)), None)
        if name is None:
            if pattern[at] == "\\" or pattern.startswith("(?i", at) or (inside and pattern[at] == "["):
                return None
            inside = (inside or pattern[at] == "[") and pattern[at] != "]"
            out.append(pattern[at])
        elif name in ranges:
            out.append(ranges[name] if inside else f"[{ranges[name]}]")
        elif inside:
            return None
        else:
            out.append(f"[^{ranges[chr(92) + 's']}]")
        at += len(name or "x")
    return "".join(out)


@functools.lru_cache(maxsize=4)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The matches of ``pattern`` in a text."""
    every, latin = regex.compile(pattern).findall, latin_pattern(pattern)
    if latin is None:
        return every
    quick = re.compile(latin).findall

    def find(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return every(text)
        return quick(text)

    return find


def ids_of(text: str, find, pieces: Pieces) -> np.ndarray:
    return np.frombuffer(b"".join(map(pieces.packed, find(text))), np.int32)


def ids_of_all(texts: pa.Array, find, pieces: Pieces) -> list[np.ndarray]:
    """``ids_of`` each text of a batch. Tables that grow hold no garbage (what is dropped is cleared), so the collector, which would walk them again and again, waits for the batch."""
    waits = gc.isenabled()
    gc.disable()
    try:
        return [ids_of(x.as_py(), find, pieces) for x in texts]
    finally:
        if waits:
            gc.enable()


def text_of(ids: np.ndarray, byte_of: list[bytes], block: int = 4096) -> str:
    """Ids to text block by block, so that no more than a block of bytes is open at once."""
    if len(ids) and ids.min() < 0:
        raise ValueError("negative token id")
    stream, out = Utf8Stream(), []
    for at in range(0, len(ids), block):
        out.append(stream.feed(b"".join(map(byte_of.__getitem__, ids[at : at + block].tolist()))))
    return "".join(out) + stream.finish()


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: (``id_col``, n_tokens, ids), one row per input row.

    Each match of ``pattern`` is encoded separately, without special tokens. A null text counts as empty and has no ids; ids
    may be null or repeat, other columns are not read. The rank file (a bounded vocabulary) is read once on the driver and
    broadcast, so executors need no copy of it.
    """
    with open(rank_file, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("bpe", forget)
        pieces, find = compiled(shipped.value), splitter(pattern)
        ids = ids_of_all(batch.column(1), find, pieces)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), list_column(ids, pa.int32())], ["id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_rows(docs.select(F.col(id_col), text_or_empty(text_col)), run, f"id {kind}, n_tokens long, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, rank_file: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """The text of every id list, as column ``out_col`` in place of ``ids_col``; the other columns stay.

    Ids are turned to bytes in blocks and pass the UTF-8 machine. A null list gives an empty text, an id outside the
    vocabulary an error.
    """
    with open(rank_file, "rb") as f:
        shipped = tokens.sparkSession.sparkContext.broadcast(f.read())
    rest = [c for c in tokens.columns if c != ids_col]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("bpe", forget)
        byte_of = vocabulary(shipped.value)
        texts = [text_of(row.values.to_numpy() if row.is_valid and len(row.values) else np.empty(0, np.int32), byte_of) for row in batch.column(len(rest))]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(texts, pa.string())], [f"c{i}" for i in range(len(rest) + 1)])

    kinds = [tokens.schema[c].dataType.simpleString() for c in rest]
    schema = ", ".join(f"c{i} {k}" for i, k in enumerate([*kinds, "string"]))
    out = map_rows(tokens.select(*[F.col(c) for c in rest], F.col(ids_col)), run, schema)
    return out.toDF(*rest, out_col)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", share: float = 1) -> DataFrame:
    """``encode``, and the text that the ids decode to: (``id_col``, n_tokens, ids, text). One pass, so a task needs one Python worker.

    ``share`` of the usual memory (about 230 MB a worker) goes to the tables of moves and pieces; less of it takes more time.
    """
    with open(rank_file, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("bpe", forget)
        pieces, byte_of, find = compiled(shipped.value, share), vocabulary(shipped.value), splitter(pattern)
        ids = ids_of_all(batch.column(1), find, pieces)
        columns = [pa.array([len(x) for x in ids], pa.int64()), list_column(ids, pa.int32()), pa.array([text_of(x, byte_of) for x in ids], pa.string())]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_tokens", "ids", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_rows(docs.select(F.col(id_col), text_or_empty(text_col)), run, f"id {kind}, n_tokens long, ids array<int>, text string", 128)
    return out.withColumnRenamed("id", id_col)
