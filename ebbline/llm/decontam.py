"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The automaton recognises every run of words that occurs inside some item.  Documents are streamed
through it word by word, keeping the length of the longest run that ends here; once that length
reaches a window (``WINDOW`` words, or a whole shorter item), the last words are looked up to name
the items, and the words they cover are hit.

The items are cut into shards of at most ``SHARD_WORDS`` words, so what is sent to the executors
has a fixed bound; documents pass through one shard after the other in the same tasks, without a
join or a shuffle.

Nulls and edges: a null text has no words.  Items without words (or a null text) have no window;
equal items are each reported.  With ``unnamed``, items with a null item_id hit words like others and
are reported together as one null item.  Rows with the same or a null doc_id are judged apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Words of test items in one automaton; bounds what the driver and each task hold.
SHARD_WORDS = 1_000_000

#: Bytes of words (digits, letters lower-cased, all of UTF-8 beyond ASCII) as they are, all else as blanks.
WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences, and the windows that it must report."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        #: window length -> words of the window -> items
        self.windows: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, text in items:
            run = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]
            last = 0
            for x in run:
                last = self._extend(last, x)
            size = min(window, len(run))
            for i in range(len(run) - size + 1 if size else 0):
                self.windows.setdefault(size, {}).setdefault(tuple(run[i : i + size]), set()).add(item)

    def _new(self, length: int, link: int, nexts: dict[int, int]) -> int:
        self.len.append(length)
        self.link.append(link)
        self.next.append(nexts)
        return len(self.len) - 1

    def _split(self, p: int, q: int, x: int) -> int:
        """The state for the longest run that goes from ``p`` by ``x``."""
        if self.len[p] + 1 == self.len[q]:
            return q
        clone = self._new(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, x: int) -> int:
        if x in self.next[last]:
            return self._split(last, self.next[last][x], x)
        new = self._new(self.len[last] + 1, 0, {})
        p = last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][x], x)
        return new

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged spans [start, end) of words inside occurring windows, and the items of these windows."""
        nexts, link, lengths, sizes = self.next, self.link, self.len, sorted(self.windows)
        if not sizes:
            return [], set()
        least = sizes[0]
        ids = list(map(self.ids.get, words))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state = n = 0
        for i, x in enumerate(ids):
            if x is None:
                state = n = 0
                continue
            to = nexts[state].get(x)
            while to is None and state:
                state = link[state]
                n = lengths[state]
                to = nexts[state].get(x)
            if to is None:
                continue
            state = to
            n += 1
            if n < least:
                continue
            for size in sizes:
                if size > n:
                    break
                found = self.windows[size].get(tuple(ids[i + 1 - size : i + 1]))
                if found:
                    items |= found
                    start = i + 1 - size
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, items


def shards(benchmark: DataFrame, words: int = SHARD_WORDS, unnamed: bool = False) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items in runs of at most ``words`` words (or one longer item), in the order of item_id."""
    held: list[tuple[int | None, bytes]] = []
    own = benchmark if unnamed else benchmark.where("item_id is not null")
    size = 0
    for item, text in own.where("text is not null").select("item_id", "text").orderBy("item_id").toLocalIterator():
        raw = text.encode()
        n = len(words_of(raw))
        if held and size + n > words:
            yield held
            held, size = [], 0
        held.append((item, raw))
        size += n
    if held:
        yield held


FOUND = "struct<n_words:bigint,spans:array<struct<start:bigint,stop:bigint>>,items:array<bigint>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, unnamed: bool = False) -> DataFrame:
    """``doc`` (all columns of ``docs``) and ``found``: n_words, merged word spans [start, stop) and sorted items."""
    spark = docs.sparkSession
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = docs.select(doc.alias("doc"), F.lit(None).cast(FOUND).alias("found"))
    kind = pa.struct(
        [("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.int64()))]
    )
    runs = shards(benchmark, shard_words, unnamed)
    # One shard at a time; without items a pass still counts the words.
    for items in chain([next(runs, [])], runs):
        shared = spark.sparkContext.broadcast(Automaton(items, window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                docs_column, rows = batch.column("doc"), []
                for text, old in zip(docs_column.field("text").cast(pa.binary()), batch.column("found").to_pylist()):
                    words = words_of(text.as_py() or b"")
                    spans, found = automaton.find(words)
                    if old:
                        spans = merged([*spans, *((s["start"], s["stop"]) for s in old["spans"])])
                        found |= set(old["items"])
                    rows.append({"n_words": len(words), "spans": [{"start": a, "stop": b} for a, b in spans], "items": sorted(found, key=lambda i: (i is None, i or 0))})
                yield pa.RecordBatch.from_arrays([docs_column, pa.array(rows, kind)], ["doc", "found"])

        out = out.mapInArrow(run, out.schema)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of the spans, from the first letter of a span to the last; the rest stays as it is."""

    @F.pandas_udf("string")
    def cut(texts, spans):
        out = []
        for text, runs in zip(texts, spans):
            if text is None or runs is None or not len(runs):
                out.append(text)
                continue
            raw = text.encode()
            plain = raw.translate(WORD_BYTES)
            borders, at = [], 0
            for word in plain.split():
                at = plain.index(word, at)
                borders.append((at, at + len(word)))
                at += len(word)
            kept, at = [], 0
            for run in runs:
                kept.append(raw[at : borders[run["start"]][0]])
                at = borders[run["stop"] - 1][1]
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pd.Series(out)

    return cut(text, spans)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = 0.5) -> DataFrame:
    """``docs`` without leaked passages: spans of at least a window are cut out of the text.

    A document of which more than ``coverage`` of the words are hit is removed.  ``n_chars``, if
    there is one, follows the text.  Documents without a hit stay as they are.
    """
    found = find_leaks(docs, benchmark, window, unnamed=True)
    few = F.coalesce(hit_words(F.col("found.spans")) <= F.lit(coverage) * F.col("found.n_words"), F.lit(True))
    text = F.when(F.size("found.spans") > 0, without_spans(F.col("doc.text"), F.col("found.spans"))).otherwise(F.col("doc.text"))
    clean = found.where(few).withColumn("_text", text)
    hit = F.size("found.spans") > 0
    return clean.select(
        *[
            F.col("_text").alias(c) if c == "text"
            else F.when(hit, F.char_length("_text").cast(docs.schema[c].dataType)).otherwise(F.col(f"doc.`{c}`")).alias(c) if c == "n_chars"
            else F.col(f"doc.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
