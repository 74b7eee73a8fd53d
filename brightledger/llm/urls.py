"""URL filters: all wildcard rules as one bit-parallel automaton that runs over every canonical URL.

A canonical URL is the host in lower case followed by the path. A glob is matched from end to end; in it ``**`` stands for any run
of characters, ``*`` for a run without a slash, ``?`` for one character but a slash, and a backslash takes the next one as it is. Each glob
is a chain of states, one per character, packed one after another into 64-bit words. Reading a character shifts the states one
up, keeps those that the character's mask allows, and lets the states in front of a wildcard stay where they are, so one
pass over a URL follows all globs. A batch's URLs are read side by side, the longest first, so that short ones drop out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Words of states held at once; it bounds memory, not the URLs or rules.
CELLS = 1 << 20
#: With so few texts left that are this long, each is read on its own.
FEW = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ANY, SEGMENT, ONE = "**", "*", "?"


class Rule(NamedTuple):
    """``label`` is what the result names; it is null for rules that have no name of their own."""

    verdict: str
    glob: str
    label: str | None = None


def quoted(text: str) -> str:
    """A glob that matches ``text`` only."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def site_rules(verdict: str, site: str) -> list[Rule]:
    """``host/path`` for the host and all its subdomains, and every path that starts so."""
    host, slash, path = site.partition("/")
    tail = f"{quoted(host)}{quoted(slash + path)}{ANY}"
    return [Rule(verdict, tail, site), Rule(verdict, f"{SEGMENT}.{tail}", site)]


def by_length(sites: Sequence[tuple[str, str]]) -> list[Rule]:
    """Rules for (verdict, site) pairs in order of precedence: the longest site first, of equally long ones the first given."""
    return [r for verdict, site in sorted(sites, key=lambda x: -len(x[1])) for r in site_rules(verdict, site)]


def tokens(glob: str) -> Iterator[tuple[str, bool]]:
    """(character or wildcard, whether it is a wildcard)."""
    at = 0
    while at < len(glob):
        if glob.startswith(ANY, at):
            yield ANY, True
            at += 2
        elif glob[at] in (SEGMENT, ONE):
            yield glob[at], True
            at += 1
        else:
            at += glob[at] == "\\" and at + 1 < len(glob)
            yield glob[at], False
            at += 1


class Automaton:
    """States of all globs as bits: a start state per glob, then one per character that is read."""

    def __init__(self, globs: Sequence[str]):
        parsed = [list(tokens(g)) for g in globs]
        self.alphabet = np.array(sorted({ord(c) for p in parsed for c, wild in p if not wild} | {ord("/")}), np.uint32)
        slash, other = int(np.searchsorted(self.alphabet, ord("/"))), len(self.alphabet)  # all other characters are one class
        n = sum(1 + sum(c not in (ANY, SEGMENT) or not wild for c, wild in p) for p in parsed)
        step, loop = np.zeros((other + 1, n), bool), np.zeros((other + 1, n), bool)
        start, last, at = np.zeros(n, bool), [], -1
        for p in parsed:
            at += 1
            start[at] = True
            for c, wild in p:
                if wild and c != ONE:  # the state before a wildcard stays
                    over = c == ANY or bool(loop[slash, at])
                    loop[:, at], loop[slash, at] = True, over
                    continue
                at += 1
                if wild:
                    step[:, at] = True
                    step[slash, at] = False
                else:
                    step[np.searchsorted(self.alphabet, ord(c)), at] = True
            last.append(at)
        self.step, self.loop, self.start = self.packed(step), self.packed(loop), self.packed(start[None])[0]
        self.last_word, self.last_bit = np.array(last, int) // 64, np.array(last, np.uint64) % np.uint64(64)

    @staticmethod
    def packed(bits: np.ndarray) -> np.ndarray:
        """Rows of bits as rows of 64-bit words, the lowest bit first."""
        wide = np.zeros((len(bits), -(-max(1, bits.shape[1]) // 64) * 64), bool)
        wide[:, : bits.shape[1]] = bits
        return np.packbits(wide, axis=1, bitorder="little").view("<u8").astype(np.uint64)

    def classes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, codes)
        return np.where(self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == codes, at, len(self.alphabet))

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """(text, glob) -> whether the glob matches the whole text."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        read = [self.classes(texts[i]) for i in order]
        lengths = np.array([len(r) for r in read], int)
        flat, starts = np.concatenate([*read, np.zeros(1, int)]), np.cumsum([0, *lengths[:-1]])[: len(read)]
        state = np.tile(self.start, (len(texts), 1))
        for at in range(lengths[0] if len(texts) else 0):
            n = int(np.searchsorted(-lengths, -at, "left"))  # texts longer than ``at``
            if n <= FEW:
                for i in range(n):
                    state[i] = self.alone(read[i][at:].tolist(), state[i])
                break
            now, seen = state[:n], flat[starts[:n] + at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[seen]) | (now & self.loop[seen])
        out = np.empty((len(texts), len(self.last_bit)), bool)
        out[order] = (state[:, self.last_word] >> self.last_bit) & np.uint64(1)
        return out

    def alone(self, seen: list[int], state: np.ndarray) -> np.ndarray:
        """The states after a text, with all words as one long number."""
        step, loop = ([int.from_bytes(r.tobytes(), "little") for r in x] for x in (self.step, self.loop))
        now = int.from_bytes(state.tobytes(), "little")
        for c in seen:
            now = ((now << 1) & step[c]) | (now & loop[c])
        return np.frombuffer(now.to_bytes(8 * len(state), "little"), np.uint64)

    def first(self, texts: Sequence[str]) -> list[int | None]:
        """For each text the first glob that matches it."""
        if not len(self.last_bit):
            return [None] * len(texts)
        rows, out = max(1, CELLS // max(self.step.shape[1], len(self.last_bit))), []
        for at in range(0, len(texts), rows):
            found = self.matches(texts[at : at + rows])
            out += [int(i) if hit else None for i, hit in zip(found.argmax(axis=1), found.any(axis=1))]
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for a null or a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host, path = (F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", i) for i in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def judge(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """The input rows and columns with host, path, rule, glob and verdict; own columns of these names are replaced.

    The first of ``rules`` that fits decides; ``rule`` is its label, ``glob`` its pattern. Where none fits both are null and the verdict is
    ``otherwise``. A null, empty or unfinished URL has an empty host and path, which only a glob of nothing but wildcards fits.
    Repeated rows are judged one by one, an empty table gives an empty one, and URLs are read to their end. The work is done row
    by row without a shuffle; rules travel with the tasks.
    """
    added = ["host", "path", "rule", "glob", "verdict"]
    keep = [c for c in pages.columns if c not in added]
    host, path = host_and_path(F.col(url_col))
    automaton, rules = Automaton([r.glob for r in rules]), list(rules)
    n = len(keep)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [h + p for h, p in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())]
        found = [rules[i] if i is not None else Rule(otherwise, None) for i in automaton.first(texts)]
        columns = [pa.array([r.label for r in found], pa.string()), pa.array([r.glob for r in found], pa.string()), pa.array([r.verdict for r in found], pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], [f"c{i}" for i in range(n + 5)])

    kinds = [pages.schema[c].dataType.simpleString() for c in keep] + ["string"] * 5
    source = pages.select(*keep, host.alias("host"), path.alias("path")).toDF(*[f"c{i}" for i in range(n + 2)])
    return map_rows(source, run, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)), 4096).toDF(*keep, *added)
