"""Secret scan: fixed patterns, and a battery of randomness tests with length-aware false-discovery control.

Beside three fixed patterns (assignments, access keys, long hex runs), every long run of key letters is a candidate. The
smallest alphabet that holds its symbols is taken as its encoding, and tests ask whether it could be random in that
alphabet: chi-squared uniformity, shares of symbol classes, runs (of classes and around the middle of the alphabet) and
serial correlation. The
discoveries of the battery are the tokens that are *not* random. Over all candidates of all documents, a weighted
Benjamini-Hochberg step controls how many random tokens are thrown away among them; longer tokens, on which the tests
have more power, get the larger weights. What survives looks random and is reported.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.targets import stage
from .common import map_rows, text_or_empty

#: Order of kinds in listings; the last one is the battery's.
KINDS = ("assign", "access", "hex", "random")
#: Letters match in either case in ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A run of key letters as long as the pattern asks is the whole run, as a shorter one inside it is too short.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

#: Shortest candidate; under it the tests have next to no power.
LEAST = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {name: {c: i for i, c in enumerate(letters)} for name, letters in {
    "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": UPPER + "234567", "base36": DIGITS + LOWER, "BASE36": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER, "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_"}.items()}
#: Level of the false-discovery control, and the bins of -log10 p in which candidates are counted.
LEVEL, BINS, STEP = 0.01, 600, 0.05


def encoding(token: str) -> str | None:
    """The first alphabet that holds the token; none for plain numbers and for words without a digit or a change of case."""
    symbols = set(token)
    if symbols <= set(DIGITS) or not (symbols & set(DIGITS) or symbols & set(LOWER) and symbols & set(UPPER)):
        return None
    return next((name for name, order in ENCODINGS.items() if symbols <= order.keys()), None)


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def runs_z(marks: np.ndarray) -> float:
    """Wald-Wolfowitz: standard score of the number of runs of a two-valued sequence."""
    n, a = len(marks), int(marks.sum())
    b = n - a
    if not a or not b:
        return math.sqrt(n)  # one value only: as far from random as n fair throws on one side
    mean = 1 + 2 * a * b / n
    spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    return (1 + int((marks[1:] != marks[:-1]).sum()) - mean) / spread


def randomness(token: str, kind: str) -> float:
    """P-value of the battery (Bonferroni over its five tests) under uniform symbols of the alphabet."""
    order = ENCODINGS[kind]
    x = np.array([order[c] for c in token])
    n, k = len(x), len(order)
    counts = np.bincount(x, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    uniform = two_sided((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    middle = two_sided(runs_z((x >= k / 2).astype(np.int8)))
    digit = np.array([c.isdigit() for c in token], np.int8)
    share = sum(c.isdigit() for c in order) / k
    # changes between digits and letters against what independent symbols would give
    changes, expect = int((digit[1:] != digit[:-1]).sum()), 2 * share * (1 - share)
    classes = two_sided((changes - (n - 1) * expect) / math.sqrt((n - 1) * expect * (1 - expect) + 1e-9))
    shares = 1.0
    for letters in (DIGITS, LOWER, UPPER):
        s = sum(c in order for c in letters) / k
        if 0 < s < 1:
            shares = min(shares, 3 * two_sided((sum(c in letters for c in token) - n * s) / math.sqrt(n * s * (1 - s))))
    d = x - (k - 1) / 2
    power = float((d * d).sum())
    serial = two_sided(float((d[1:] * d[:-1]).sum()) / power * math.sqrt(n)) if power else 0.0
    return min(1.0, 5 * min(uniform, shares, middle, classes, serial))


def weight(n: int) -> float:
    """Weight of a token's length in the control: 1 at 32 symbols, more for longer and less for shorter ones, within a factor of four."""
    return min(4.0, max(0.25, n / 32))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed patterns, leftmost and without overlap for each kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, bin of the weighted -log10 p) of key-like runs that overlap no base span."""
    out = []
    for m in CANDIDATE.finditer(text):
        token = m[0].rstrip("=-_")
        end = m.start() + len(token)
        kind = encoding(token) if len(token) >= LEAST else None
        if kind is None or any(s < end and m.start() < e for s, _, e in base):
            continue
        p = randomness(token, kind) / weight(len(token))
        out.append((m.start(), end, min(BINS, int(-math.log10(max(p, 1e-300)) / STEP)) if p < 1 else 0))
    return out


def threshold(table: DataFrame) -> int:
    """First bin whose candidates are declared not random: Benjamini-Hochberg on the counts per bin (at most BINS + 1 rows)."""
    counts = np.zeros(BINS + 1, np.int64)
    for r in table.select(F.explode("candidates.bin").alias("bin")).groupBy("bin").count().collect():
        counts[r["bin"]] = r["count"]
    beyond = counts[::-1].cumsum()[::-1]
    passing = [b for b in range(1, BINS + 1) if beyond[b] and 10 ** (-b * STEP) * counts.sum() <= LEVEL * beyond[b]]
    return min(passing, default=BINS + 1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, base, spans), one row per input row: arrays of (start, kind, end) in code points, end exclusive, by start and kind.

    ``kind`` is the place in KINDS; ``spans`` holds ``base`` and what the battery adds. Null or empty texts have no spans;
    ids may be null or repeat; other columns are not read. The text is read once; what is found is staged.
    """
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    loose = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bin", pa.int32())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, more = [], []
        for x in batch.column(1):
            text = x.as_py()
            found = base_spans(text)
            base.append([dict(zip(("start", "kind", "end"), s)) for s in found])
            more.append([dict(zip(("start", "end", "bin"), c)) for c in candidates(text, found)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(more, pa.list_(loose))], ["id", "base", "candidates"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = map_rows(docs.select(F.col(id_col), text_or_empty(text_col)), run, f"id {kind}, base array<struct<start:int,kind:int,end:int>>, candidates array<struct<start:int,end:int,bin:int>>")
    found = stage(found)
    first = threshold(found)
    added = F.transform(F.filter("candidates", lambda c: c["bin"] < first), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return found.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", added)).alias("spans"))


def listing(spans: str, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
