"""Fill-in-middle texts, cut with a wavelet matrix over character classes.

A unit is a run of ASCII letters or one other character. Every character has a class of two bits: another character (it
is a unit), a letter inside its run, the last letter of its run. The classes of all texts of a slice stand in one wavelet
matrix; the ranks of the first and the last class add up to the number of units that end before a place, and a cut after
u units is the smallest place with that count: both cuts of all texts are found together by bisection on ranks.

How a text is cut depends on the document's id and a seed alone: h1 to h4 are the first four groups of eight digits of
sha256(seed:id) in hex. The prefix ends after the smaller of h1 mod (n + 1) and h2 mod (n + 1) units, the middle after
the larger. A text is left as it is (`plain`) if it is empty, holds a mark, or h3 mod 100 says so; otherwise h4 mod 100
chooses suffix-prefix-middle (`spm`) or prefix-suffix-middle (`psm`). A mark has no end that is also its start, so the
pieces next to it can make no other mark, and `restored` finds the marks that were set.

Every text is cut in one narrow pass. Defined results: null is the empty text, which is plain; a null id is the empty
string in the digest; repeated rows stay and are cut alike; a very long text is a slice of its own; other columns are not
read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, some_bytes, texts_of

SEED = "1"
FIM_RATE = 90  # of 100 texts, those that are rearranged
SPM_RATE = 20  # of 100 rearranged texts, those with the suffix first
MARKS = ("<P>", "<S>", "<M>")
OTHER, INSIDE, LAST = 1, 2, 3  # classes: the higher bit is a letter, the lower one ends a unit
BITS = 2


class RankedBits:
    """Bits with the number of set ones before every place: a count for each word, the rest by counting in the word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = len(bits) - self.rank(np.array([len(bits)]))[0]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """A sequence of small numbers, highest bit first; each level is stably parted by its bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.levels.append(RankedBits(bit))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of the symbol before each place."""
        low, high = np.zeros_like(at), at
        for i, level in enumerate(self.levels):
            if symbol >> (self.bits - 1 - i) & 1:
                low, high = level.zeros + level.rank(low), level.zeros + level.rank(high)
            else:
                low, high = low - level.rank(low), high - level.rank(high)
        return high - low


def classes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of every code point; a run of letters ends where a text of `starts` begins."""
    letter = ((points | 32) - 97 < 26) & (points < 128)
    follows = np.zeros(len(points), bool)
    follows[:-1] = letter[1:]
    follows[starts[(starts > 0) & (starts <= len(points))] - 1] = False
    return np.where(letter, np.where(follows, INSIDE, LAST), OTHER).astype(np.uint8)


class Units:
    """Unit counts and cuts of the texts of a slice."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(texts) else self.ends
        self.matrix = WaveletMatrix(classes(points, self.starts), BITS)
        self.ended = self.before(self.starts)
        self.counts = self.before(self.ends) - self.ended

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that end before each place."""
        return self.matrix.rank(OTHER, at) + self.matrix.rank(LAST, at)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Characters of each text up to the end of its `units`-th unit."""
        low, high, wanted = self.starts.copy(), self.ends.copy(), self.ended + units
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.before(middle) >= wanted
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low - self.starts


def draws(keys: list[int | None], seed: str) -> np.ndarray:
    """h1 to h4 of each document."""
    names = (f"{seed}:{'' if k is None else k}".encode() for k in keys)
    raw = b"".join(hashlib.sha256(n).digest()[:16] for n in names)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def rearranged(keys: list[int | None], texts: list[str], seed: str, fim_rate: int, spm_rate: int):
    """(units, form, prefix length, middle length, output) of each text; the lengths of plain texts are null."""
    h = draws(keys, seed)
    units = Units(texts)
    cuts = h[:, :2] % (units.counts + 1)[:, None]
    first, second = units.cut(cuts.min(axis=1)).tolist(), units.cut(cuts.max(axis=1)).tolist()
    for text, n, a, b, h3, h4 in zip(texts, units.counts.tolist(), first, second, h[:, 2].tolist(), h[:, 3].tolist()):
        if not text or h3 % 100 >= fim_rate or any(m in text for m in MARKS):
            yield n, "plain", None, None, text
            continue
        p, s, m = MARKS
        if h4 % 100 < spm_rate:
            yield n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
        else:
            yield n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def restored(output: str, form: str) -> str:
    """The text that an output was made from."""
    if form == "plain":
        return output
    p, s, m = MARKS
    if form == "spm":
        suffix, rest = output[len(s) :].split(p, 1)
        prefix, middle = rest.split(m, 1)
    else:
        prefix, rest = output[len(p) :].split(s, 1)
        suffix, middle = rest.split(m, 1)
    return prefix + middle + suffix


COLUMNS = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"


def _made(docs: DataFrame, last: dict, schema: str, seed: str, fim_rate: int, spm_rate: int) -> DataFrame:
    """Each text's cut and the values that the functions of `last` make from (output, form)."""

    def work(batches):
        for batch in some_bytes(batches):
            keys = batch.column("doc_id")
            rows = list(rearranged(keys.to_pylist(), texts_of(batch), seed, fim_rate, spm_rate))
            cut = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(COLUMNS.values())]
            more = [pa.array([value(r[4], r[1]) for r in rows], pa.string()) for value in last.values()]
            yield pa.record_batch([keys, *cut, *more], ["doc_id", *COLUMNS, *last])

    return arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, schema)


def fill_in_middle(docs: DataFrame, seed: str = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output of every text."""
    return _made(docs, {"output": lambda out, _: out}, SCHEMA + ", output string", seed, fim_rate, spm_rate)


def fim_digests(docs: DataFrame, seed: str = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """As `fill_in_middle`, with digests of the output and of the text restored from it in place of the output."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    last = {"output_sha256": lambda out, _: sha(out), "restored_sha256": lambda out, form: sha(restored(out, form))}
    schema = SCHEMA + ", output_sha256 string, restored_sha256 string"
    return _made(docs, last, schema, seed, fim_rate, spm_rate)


SQL = f"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, len(units) AS n,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS u1,
           CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS u2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM cut
), parted AS (
    SELECT doc_id, text, n, array_to_string(units[1:least(u1, u2)], '') AS prefix,
           array_to_string(units[least(u1, u2) + 1:greatest(u1, u2)], '') AS middle,
           array_to_string(units[greatest(u1, u2) + 1:], '') AS suffix,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= {FIM_RATE} THEN 'plain'
                WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""
