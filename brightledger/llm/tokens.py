"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch that are not known yet lie in one ragged numpy array of symbols. In each round every pre-token finds
its lowest-rank pair and merges all its occurrences, all pre-tokens at once; finished ones leave with their number of
surviving symbols. In a merge table each pair's parts come from earlier ranks (checked when it is read), so merging all
occurrences of the lowest rank together gives what merging one by one gives.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, only, text_or_empty

#: Pre-tokens whose counts a worker remembers; symbols merged at once. Bounds on memory only.
KNOWN, SYMBOLS = 400_000, 400_000
NONE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordMerger:
    """Counts for a vocabulary of the ``tokenizers`` JSON form with lower-casing, byte letters and an end-of-word suffix."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not suffix or kinds != ["NFC", "Replace", "Lowercase"] or any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("not a lower-casing word BPE with an end-of-word suffix")
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.end = np.array([vocab[c + suffix] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        born = {}
        for rank, (a, b) in enumerate(merges):
            if max(born.get(a, -1), born.get(b, -1)) >= rank or a + b in born:
                raise ValueError(f"merge {rank} uses a part that comes later, or makes a known token")
            born[a + b] = rank
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.find = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        special = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def surviving(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) word after all merges."""
        out = np.zeros(len(words), np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lens)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.end[raw[ends - 1]]
        word, owner = np.arange(len(words)), np.repeat(np.arange(len(words)), lens)
        while len(symbols):
            # rank of the pair that begins at each symbol; none where the word ends
            rank = np.full(len(symbols), NONE)
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank[:-1][hit] = self.ranks[at[hit]]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            lens = np.diff(np.r_[starts, len(symbols)])
            done = lowest == NONE
            out[word[done]] = lens[done]
            best = np.repeat(lowest, lens)
            merge = (rank == best) & (best < NONE)
            # in a run such as a a a the pairs overlap: every second one merges, from the left
            place = np.arange(len(symbols))
            first = np.maximum.accumulate(np.where(merge & ~np.r_[False, merge[:-1]], place, 0))
            merge &= (place - first) % 2 == 0
            symbols[merge] = self.made[rank[merge]]
            keep = ~np.r_[False, merge[:-1]] & np.repeat(~done, lens)
            word, renumber = word[~done], np.cumsum(~done) - 1
            symbols, owner = symbols[keep], renumber[owner[keep]]
        return out

    def learn(self, pieces: set[str]) -> None:
        """Make sure that the counts of all these pre-tokens are known; a full memory is emptied first."""
        fresh = pieces - self.known.keys()
        if fresh and len(self.known) + len(fresh) > KNOWN:
            self.known.clear()
            fresh = pieces
        names, total = [], 0
        for piece in fresh:
            names.append(piece)
            total += len(piece)
            if total > SYMBOLS:
                self.known.update(zip(names, self.surviving([p.encode() for p in names]).tolist()))
                names, total = [], 0
        if names:
            self.known.update(zip(names, self.surviving([p.encode() for p in names]).tolist()))

    def pieces(self, text: str) -> list[str]:
        text = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() alone would use the final sigma
        return self.find(text.lower())

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special string inside a text is one token."""
        split = []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            split.append((len(parts) - 1, self.pieces(parts[0]) if len(parts) == 1 else list(chain.from_iterable(map(self.pieces, parts)))))
        fresh: set[str] = set()
        for _, pieces in split:
            fresh.update(pieces)
        self.learn(fresh)
        count = self.known.__getitem__
        return [special + sum(map(count, pieces)) for special, pieces in split]


@functools.lru_cache(maxsize=4)
def merger(data: bytes) -> WordMerger:
    return WordMerger(data)


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_bytes, n_tokens, over_limit) of every whole text, one row per input row.

    A null text counts as empty (0 and 0). Ids may be null or repeat; other columns are not read. White space only parts
    pre-tokens, so its normalisation needs no step of its own. Letters are those of the Unicode version of the regex module;
    characters added to Unicode after the tokenizer's own version may be split otherwise there. The tokenizer file (a bounded vocabulary) is read on the
    driver and broadcast.
    """
    with open(tokenizer_file, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("tokens", merger.cache_clear)
        counts = merger(shipped.value).counts(batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(text_col)
    out = map_rows(docs.select(F.col(id_col), F.octet_length(text).cast("long"), text), run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col).withColumn("over_limit", F.col("n_tokens") > limit)
