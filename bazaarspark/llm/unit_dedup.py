"""Substring de-duplication by hashing lines, paragraphs or sentences.

A text is cut into units: sentences of its lines (`unit="sentence"`, so that a passage inside a longer line is found),
lines, or paragraphs. A unit is normalised (lower case, words and numbers only) and digested to 128 bits. Digests are
counted over all documents; of the occurrences of a digest the first by (doc_id, digest of the text, place) is kept and
the others are repeats. A run of neighbouring repeats goes if its units of `LEAST` words or more hold at least `min_words`
words together: short units, which any two texts may share, go with a passage but make none one by one.

A passage of short units (tables, verse, short lines) is found as a whole: the shortest stretches of neighbouring units
from each unit on, and up to each unit, that hold `min_words` words are digested beside the units, where their longer
units alone do not hold as many. A stretch that repeats an earlier one goes. So every repeated sequence of two units or
more and of `min_words` words or more goes, whatever its units hold, and of each unit the first occurrence stays. What
goes is returned as offsets into the original text.

A frequent digest costs one small row in the counting, which is combined before the shuffle; its occurrences are spread
by the join (Spark splits skewed join partitions), and none are gathered by digest.

Defined results: null and empty texts have no units and stay as they are (null as empty text); rows with the same doc_id
and text are one document, cut alike; null ids rank first; units without a word or number belong to the unit before
them and are never counted; other columns stay; an empty table gives an empty table.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, fresh, quoted, removed, some_bytes, written

MIN_WORDS = 20  # words that a run of repeats must hold
LEAST = 5  # words of a unit that counts towards them by itself
CUTS = {
    # A sentence ends at a line feed, or after a closing sign that white space follows.
    "sentence": re.compile(r"\n+|(?<=[.!?|*%&$#])[^\S\n]+"),
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n[^\S\n]*\n\s*"),
}
WORD = re.compile(r"\w+")
BREAK = "\n"  # between the units of a stretch; no word is equal to it
OUT_ROWS = 50_000


def single_units(text: str, unit: str = "sentence") -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of the units that hold a word; a unit reaches to the start of the next one."""
    found: list[tuple[int, int, list[str]]] = []
    start = 0
    ends = [m.end() for m in CUTS[unit].finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        words = WORD.findall(text[start:end].lower())
        if words:
            found.append((start, end, words))
        elif found:
            s, _, w = found[-1]
            found[-1] = (s, end, w)
        start = end
    return found


def stretches(found: list[tuple[int, int, list[str]]], min_words: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest stretches of units that hold `min_words`, where the longer units alone do not."""
    if all(len(words) >= min_words for _, _, words in found):
        return []
    total, longer = [0], [0]
    for _, _, words in found:
        n = len(words)
        total.append(total[-1] + n)
        longer.append(longer[-1] + (n if n >= LEAST else 0))
    pairs, n, last, first = set(), len(found), 0, 0
    for i in range(n - 1):
        last = max(last, i + 1)
        while last < n and total[last + 1] - total[i] < min_words:
            last += 1
        if last == n:
            break
        if longer[last + 1] - longer[i] < min_words:
            pairs.add((i, last))
    for j in range(1, n):
        while first + 1 < j and total[j + 1] - total[first + 1] >= min_words:
            first += 1
        if total[j + 1] - total[first] >= min_words and longer[j + 1] - longer[first] < min_words:
            pairs.add((first, j))
    return sorted(pairs)


def units(text: str, unit: str = "sentence", min_words: int = MIN_WORDS) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of the units, then of the stretches of units that are digested beside them."""
    found = single_units(text, unit)
    more = []
    for i, j in stretches(found, min_words):
        words = list(found[i][2])
        for _, _, w in found[i + 1 : j + 1]:
            words.append(BREAK)
            words += w
        more.append((found[i][0], found[j][1], words))
    return found + more


def digests(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """(doc_id, tie, place, hi, lo) of every unit and stretch of every document."""

    def work(batches):
        names = ["doc_id", "tie", "place", "hi", "lo"]
        for batch in some_bytes(batches):
            columns: list[list[int]] = [[], [], [], [], []]
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tie", "text")))
            for doc_id, tie, text in rows:
                for place, (_, _, words) in enumerate(units(text or "", unit, min_words)):
                    d = xxhash.xxh3_128_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
                    cells = (doc_id, tie, place, (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63))
                    for column, cell in zip(columns, cells):
                        column.append(cell)
                if len(columns[0]) >= OUT_ROWS:
                    yield made(columns, names)
                    columns = [[], [], [], [], []]
            yield made(columns, names)

    def made(columns, names):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return arrow(docs.select("doc_id", "tie", "text"), work, "doc_id bigint, tie bigint, place int, hi bigint, lo bigint")


def repeats(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """(doc_id, tie, places): the places of the units and stretches that repeat an earlier occurrence, for documents that have any."""
    # Repeated rows are one document: their equal units share one rank.
    rows = written(digests(docs, unit, min_words), "unit-digests")
    rank = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "tie", "place")
    first = rows.groupBy("hi", "lo").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    # A table of its own, so that the join can split what a frequent digest brings to one partition.
    first = written(first.filter("n > 1").select("hi", "lo", "first"), "repeated-digests")
    later = rows.join(first, ["hi", "lo"]).filter(rank > F.col("first"))
    found = written(later.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("place")).alias("places")), "repeats")
    removed(rows)
    removed(first)
    return found


def removed_spans(text: str, places: list[int], unit: str, min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of repeated units that hold enough words, and of repeated stretches."""
    found = single_units(text, unit)
    n = len(found)
    runs: list[tuple[int, int, int]] = []
    last = None
    for p in places:
        if p >= n:
            break
        words = found[p][2]
        weight = len(words) if len(words) >= LEAST else 0
        if last is not None and p == last + 1:
            i, _, held = runs[-1]
            runs[-1] = (i, p, held + weight)
        else:
            runs.append((p, p, weight))
        last = p
    gone = [(i, j) for i, j, held in runs if held >= min_words]
    if places and places[-1] >= n:
        known = stretches(found, min_words)
        gone = sorted(gone + [known[p - n] for p in places if p >= n])
    spans: list[tuple[int, int]] = []
    for i, j in gone:
        start, end = found[i][0], found[j][1]
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:s])
        at = e
    out.append(text[at:])
    return "".join(out)


def _joined(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    keyed = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = repeats(keyed.select("doc_id", "tie", "text"), unit, min_words)
    found = found.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "places")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    return keyed.join(found, same, "left").select("_row", "text", "places")


def unit_spans(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_removed, removed (start and end offsets into the original text, in characters), text (what stays)."""

    def work(batches):
        for batch in some_bytes(batches):
            texts, places = batch.column("text").to_pylist(), batch.column("places").to_pylist()
            spans = [removed_spans(t, p, unit, min_words) if p else [] for t, p in zip(texts, places)]
            listed = [[{"start": s, "end": e} for s, e in x] for x in spans]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([sum(e - s for s, e in x) for x in spans], pa.int64()),
                    pa.array(listed, kind),
                    pa.array([without(t, x) if x else t for t, x in zip(texts, spans)], pa.string()),
                ],
                ["doc_id", "n_removed", "removed", "text"],
            )

    rows = _joined(docs, unit, min_words).select(F.col("_row.doc_id").cast("bigint").alias("doc_id"), "text", "places")
    schema = "doc_id bigint, n_removed bigint, removed array<struct<start:int,end:int>>, text string"
    return arrow(rows, work, schema)


def without_repeats(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, all columns but `text` unchanged, without their repeats. A text that was null is empty."""
    names = docs.columns
    at = names.index("text")

    def work(batches):
        for batch in some_bytes(batches, column=len(names)):
            texts, places = (batch.column(len(names) + i).to_pylist() for i in (0, 1))
            cut = [without(t, removed_spans(t, p, unit, min_words)) if p else t for t, p in zip(texts, places)]
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(cut, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # The text goes to the workers once: in its own column it is replaced anyway.
    own = [F.lit(None).cast("string").alias(c) if c == "text" else F.col(f"_row.{quoted(c)}").alias(c) for c in names]
    more = [F.col(c).alias(fresh(f"_{c}", names)) for c in ("text", "places")]
    return arrow(_joined(docs, unit, min_words).select(*own, *more), work, docs.schema)
