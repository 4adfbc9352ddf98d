"""Substring dedup with repeated-phrase automata.

A phrase is a window of 13 words.  It is removed from every document that starts it when a
document with a smaller doc_id starts it too.

1. Documents are gathered into blocks of about ``BLOCK_WORDS`` words, written once, bucketed by
   block, so that later joins by block move no text.
2. Copies of a whole text (by a 128-bit hash of its words) but the one with the least doc_id are
   set apart: all their words go, and they take no part in what follows.
3. Anchors: the least hash of the nine five-word runs in a window.  Equal windows have equal
   anchors, so a window can only recur if its anchor occurs in two documents.  About one anchor
   in five words is shuffled, a block's different ones once.
4. Windows with a recurring anchor are confirmed: they are grouped by two independent 64-bit
   hashes of their whole text, with the least and the largest doc_id.
5. Each block gets the phrases confirmed for it, compiles the passages they make into Aho-Corasick
   automata of at most ``PHRASES`` phrases, and streams its documents through them to find all occurrences.

A phrase in every block is one row per block in a shuffle, however many documents hold it.

Nulls and edges: a null text has no words.  Rows with a null doc_id neither lose words nor cause
a loss; rows with the same doc_id do not affect each other.  Texts under 13 words stay whole.
Every input row gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import bucketed, save

WINDOW = 13
ANCHOR = 5
BLOCK_WORDS = 200_000
PHRASES = 50_000
#: Phrases of a passage at most.
RUN = 32

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)
BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown to the longest text so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", INVERSE)):
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up, self.down


class Runs:
    """Hashes of all runs of a text's words; the words are separated by single blanks."""

    def __init__(self, text: bytes, powers: Powers) -> None:
        raw = np.frombuffer(text, dtype=np.uint8)
        blanks = np.flatnonzero(raw == 32)
        self.starts = np.concatenate(([0], blanks + 1)) if len(raw) else blanks
        self.ends = np.append(blanks, len(raw)) if len(raw) else blanks
        up, self.down = powers.upto(len(raw) + 1)
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(BYTES[raw] * up[: len(raw)])))

    def hashes(self, words: int) -> np.ndarray:
        if len(self.starts) < words:
            return np.empty(0, dtype=np.uint64)
        starts, ends = self.starts[: len(self.starts) - words + 1], self.ends[words - 1 :]
        x = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        x = (x ^ (x >> np.uint64(32))) * MIX
        return x ^ (x >> np.uint64(29))

    def anchors(self) -> np.ndarray:
        """Of each window, the least hash of its ANCHOR-word runs."""
        least = self.hashes(ANCHOR)
        if len(self.starts) < WINDOW:
            return np.empty(0, dtype=np.uint64)
        width, want = 1, WINDOW - ANCHOR + 1
        while width < want:
            step = min(width, want - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        return least


def blocks(docs: DataFrame) -> DataFrame:
    """Rows block, doc (all columns but the text), ids, texts (words joined by single blanks); bucketed by block."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc")
    rows = docs.select(doc, F.col("doc_id").cast("long").alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[list] = [[], [], []]
        size = made = 0

        def flush() -> pa.RecordBatch:
            docs_held, ids, texts = held
            columns = [
                pa.array([first + made]), pa.array([docs_held], pa.list_(kind)),
                pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.binary())),
            ]
            for column in held:
                column.clear()
            return pa.RecordBatch.from_arrays(columns, ["block", "doc", "ids", "texts"])

        kind = None
        for batch in batches:
            kind = batch.column("doc").type
            for own, i, text in zip(batch.column("doc").to_pylist(), batch.column("id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = (text.as_py() or b"").split()
                if size and size + len(words) > BLOCK_WORDS:
                    yield flush()
                    made, size = made + 1, 0
                size += len(words) + 1
                for column, value in zip(held, (own, i, b" ".join(words))):
                    column.append(value)
        if held[0]:
            yield flush()

    kind = rows.schema["doc"].dataType.simpleString()
    made = rows.mapInArrow(run, f"block long, doc array<{kind}>, ids array<bigint>, texts array<binary>")
    return bucketed(made, "blocks", "block")


def extremes(keys: list[np.ndarray], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Different keys with the least and the largest id of each."""
    order = np.lexsort((ids, *keys[::-1]))
    keys, ids = [k[order] for k in keys], ids[order]
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)) if len(ids) else np.empty(0, dtype=bool)
    at = np.flatnonzero(new)
    return [k[at] for k in keys], ids[at], ids[np.append(at[1:], len(ids))[: len(at)] - 1] if len(at) else ids


def joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype=dtype)


def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def copies(table: DataFrame) -> DataFrame:
    """block and ``copied``: the places of texts of a window or more that a smaller doc_id has whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in of_blocks(batches):
            own = [
                (k, i, text.as_py())
                for k, (i, text) in enumerate(zip(block["ids"].as_py(), block["texts"]))
                if i is not None
            ]
            whole = [(k, i, xxhash.xxh3_128_digest(t)) for k, i, t in own if t.count(b" ") >= WINDOW - 1]
            places, ids, hashes = zip(*whole) if whole else ((), (), ())
            number = [block["block"].as_py()] * len(whole)
            columns = (pa.array(hashes, pa.binary()), pa.array(number, pa.int64()), pa.array(places, pa.int64()), pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns), ["hash", "block", "place", "id"])

    texts = save(table.select("block", "ids", "texts").mapInArrow(run, "hash binary, block long, place long, id long"), "texts")
    # Written, so that Spark can split the copies of a hot text in the join.
    groups = texts.groupBy("hash").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    copied = texts.join(save(groups.drop("most"), "copied"), "hash").where("id > least")
    return copied.groupBy("block").agg(F.collect_list("place").alias("copied"))


def originals(block: dict) -> Iterator[tuple[int, bytes]]:
    """(doc_id, text) of a block's documents that have a doc_id and are no copies."""
    copied = set(block["copied"].as_py() or ())
    for k, (i, text) in enumerate(zip(block["ids"].as_py(), block["texts"])):
        if i is not None and k not in copied:
            yield i, text.as_py()


def places(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values would stand in ``ordered``, and whether they are there."""
    at = np.searchsorted(ordered, values)
    return at, ordered[np.minimum(at, len(ordered) - 1)] == values if len(ordered) else np.zeros(len(values), dtype=bool)


def anchors(table: DataFrame) -> DataFrame:
    """The different anchors of each block, with the least and the largest doc_id that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for block in of_blocks(batches):
            found, owners = [], []
            for i, text in originals(block):
                own = np.unique(Runs(text, powers).anchors())
                found.append(own)
                owners.append(np.full(len(own), i))
            (keys,), low, high = extremes([joined(found, np.uint64).view(np.int64)], joined(owners, np.int64))
            number = np.full(len(keys), block["block"].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, number, low, high)], ["anchor", "block", "low", "high"])

    return table.select("block", "ids", "texts", "copied").mapInArrow(run, "anchor long, block long, low long, high long")


def recurring(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs under two doc_ids, with the least of them; a key has at most one row per block."""
    same = Window.partitionBy(*keys)
    least, most = F.min("low").over(same), F.max("high").over(same)
    return rows.select(*keys, "block", "high", least.alias("least"), most.alias("most")).where("least < most")


def windows(table: DataFrame) -> DataFrame:
    """Blocks with ``anchors`` -> their windows with one of these anchors, by two hashes, with the least and largest doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for block in of_blocks(batches):
            wanted = np.sort(np.asarray(block["anchors"].values).view(np.uint64))
            first, second, owners = [], [], []
            for i, text in originals(block):
                runs = Runs(text, powers)
                at = np.flatnonzero(places(wanted, runs.anchors())[1])
                spans = zip(runs.starts[at].tolist(), runs.ends[at + WINDOW - 1].tolist())
                first.append(runs.hashes(WINDOW)[at])
                second.append(np.fromiter((xxhash.xxh3_64_intdigest(text[a:b]) for a, b in spans), dtype=np.uint64, count=len(at)))
                owners.append(np.full(len(at), i))
            (one, two), low, high = extremes([joined(x, np.uint64).view(np.int64) for x in (first, second)], joined(owners, np.int64))
            number = np.full(len(one), block["block"].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (one, two, number, low, high)], ["one", "two", "block", "low", "high"])

    return table.select("block", "ids", "texts", "copied", "anchors").mapInArrow(run, "one long, two long, block long, low long, high long")


def coded(texts: list[list[bytes]], known: set[bytes]) -> list[str]:
    """Two letters for each word; the sets of first and second letters are apart, and all words that are not ``known`` share a code.

    Automata look through a node's letters one by one, so nodes must have few: about the square root of the words.
    """
    base = isqrt(len(known)) + 1
    codes = {word: chr(n % base) + chr(base + n // base) for n, word in enumerate(known, start=1)}
    other = chr(0) + chr(base)
    return ["".join([codes.get(word, other) for word in words]) for words in texts]


def automata(phrases: dict[str, int], most: int) -> Iterator[ahocorasick.Automaton]:
    """Automata that together know all phrases; a match gives the least doc_id with the phrase."""
    names = list(phrases)
    for at in range(0, len(names), most):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for phrase in names[at : at + most]:
            automaton.add_word(phrase, phrases[phrase])
        automaton.make_automaton()
        yield automaton


def locate(ids: list[int | None], texts: list[bytes], one: np.ndarray, two: np.ndarray, least: np.ndarray, powers: Powers) -> list[np.ndarray]:
    """Of each text, which words lie in a phrase that a smaller doc_id starts.

    Windows with the hash of a phrase are where phrases can be: only words of such windows get codes of their own.
    Neighbouring windows make a passage.  Automata know a phrase by its passage up to the phrase's end, since such
    beginnings of one passage share their nodes; every occurrence lies in a passage of its own text, so none is missed.
    """
    one, two = one.view(np.uint64), two.view(np.uint64)
    order = np.argsort(one, kind="stable")
    one, two, least = one[order], two[order], least[order]
    split = [text.split() for text in texts]
    likely, known = [], set()
    for text, words in zip(texts, split):
        runs = Runs(text, powers)
        hashes = runs.hashes(WINDOW)
        left, there = places(one, hashes)
        at = np.flatnonzero(there)
        likely.append((passages(at), at, left[at], hashes[at], runs.starts[at], runs.ends[at + WINDOW - 1]) if len(at) else None)
        known.update([words[k] for k in np.flatnonzero(covered(at, len(words))).tolist()])
    codes = coded(split, known)
    phrases: dict[str, int] = {}
    for text, words, found in zip(texts, codes, likely):
        if found is None:
            continue
        for head, i, k, own, start, stop in zip(*(x.tolist() for x in found)):
            phrase = words[2 * head : 2 * (i + WINDOW)]
            if phrase not in phrases:
                exact = xxhash.xxh3_64_intdigest(text[start:stop])
                while k < len(one) and one[k] == own:
                    if int(two[k]) == exact:
                        phrases[phrase] = int(least[k])
                    k += 1
    removed = [np.zeros(len(words), dtype=bool) for words in split]
    for automaton in automata(phrases, PHRASES):
        for i, words, gone in zip(ids, codes, removed):
            if i is not None:
                starts = {(end + 1) // 2 - WINDOW for end, first in automaton.iter(words) if first < i}
                gone |= covered(np.fromiter(starts, dtype=np.int64, count=len(starts)), len(gone))
    return removed


def passages(at: np.ndarray) -> np.ndarray:
    """For each window (ascending starts) the start of its passage: neighbours in a row, ``RUN`` at most."""
    first = np.maximum.accumulate(np.where(np.append(True, np.diff(at) > 1), at, 0))
    return at - (at - first) % RUN


def covered(starts: np.ndarray, words: int) -> np.ndarray:
    """Which of a text's words lie in a window that starts at one of these, all different."""
    steps = np.zeros(words + 1, dtype=np.int8)
    steps[starts] += 1
    steps[starts + WINDOW] -= 1
    return np.cumsum(steps[:-1], dtype=np.int64) > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns of ``docs`` but the text), n_words, n_removed and ``kept``, the words left, joined by blanks."""
    table = blocks(docs)
    # Lists of places, anchors and phrases of a block are at most its own rows and words.
    table = table.join(save(copies(table), "copies").hint("merge"), "block", "left")
    anchored = recurring(anchors(table), ["anchor"]).groupBy("block").agg(F.collect_list("anchor").alias("anchors"))
    found = recurring(windows(table.join(anchored.hint("merge"), "block")), ["one", "two"]).where("high > least")
    phrases = found.groupBy("block").agg(F.collect_list(F.struct("one", "two", "least")).alias("phrases"))
    whole = table.join(phrases.hint("merge"), "block", "left")
    kind = table.schema["doc"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for block in of_blocks(batches):
            ids, texts = block["ids"].as_py(), block["texts"].as_py()
            removed = [np.zeros(t.count(b" ") + 1 if t else 0, dtype=bool) for t in texts]
            copied = block["copied"].as_py() or []
            for k in copied:
                removed[k][:] = True
            if block["phrases"].is_valid:
                own = block["phrases"].values
                rest = sorted(set(range(len(texts))) - set(copied))
                found = locate([ids[k] for k in rest], [texts[k] for k in rest], *(np.asarray(own.field(x)) for x in ("one", "two", "least")), powers)
                for k, gone in zip(rest, found):
                    removed[k] = gone
            kept = [b" ".join(w for w, x in zip(t.split(), gone.tolist()) if not x) if gone.any() else t for t, gone in zip(texts, removed)]
            yield pa.RecordBatch.from_arrays(
                [block["doc"].values, pa.array(map(len, removed), pa.int64()), pa.array([int(g.sum()) for g in removed], pa.int64()), pa.array([k.decode() for k in kept], pa.string())],
                ["doc", "n_words", "n_removed", "kept"],
            )

    return whole.select("doc", "ids", "texts", "copied", "phrases").mapInArrow(
        run, f"doc {kind.simpleString()}, n_words long, n_removed long, kept string"
    )
