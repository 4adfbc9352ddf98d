"""Byte-level BPE encoding and decoding with DuckDB inside each partition.

A text is cut by the tokenizer's pattern.  The different pieces of a batch become rows of linked
symbols (piece, position, token, next position, next token) in DuckDB; a recursive query joins
them with the merge table and contracts the leftmost pair of the lowest rank in every piece until
none is left.  Pieces that are a token as a whole are looked up, as the tiktoken library does.
Pieces of more than ``LONG`` bytes take a second query of the same kind that contracts all
occurrences of the lowest pair in a step where that cannot change the outcome, and keeps only
the current symbols.  Decoding joins token rows with the vocabulary and aggregates the bytes in
the order of their positions.

The vocabulary goes to the executors as a broadcast; its size is that of the rank file.

Nulls and edges: a null or empty text has no tokens and decodes to empty bytes.  Special tokens
are ordinary text.  Other columns are carried along packed, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are encoded by one run of the recursive query.
BATCH_BYTES = 1 << 20
#: Pieces remembered by a Python worker before it starts anew.
REMEMBERED = 200_000
LONG = 256

CONTRACT = """
WITH RECURSIVE step(piece, pos, tok, nxt, ntok, n) AS (
  SELECT piece, pos, tok, nxt, ntok, 0 FROM symbols
  UNION ALL
  (WITH best AS (
     SELECT piece, min((id::UBIGINT << 40) + (pos::UBIGINT << 20) + nxt) AS b
     FROM step JOIN merges ON l = tok AND r = ntok GROUP BY piece
   ), cut AS MATERIALIZED (
     SELECT piece, (b >> 20 & 1048575)::INT AS p, (b & 1048575)::INT AS q, (b >> 40)::INT AS id FROM best
   )
   -- The right symbol of the pair becomes the merged one, the left one goes.
   SELECT piece, pos, CASE WHEN pos = q THEN id ELSE tok END, CASE WHEN nxt = p THEN q ELSE nxt END,
          CASE WHEN nxt = p THEN id ELSE ntok END, n + 1
   FROM step JOIN cut USING (piece) WHERE pos <> p)
)
SELECT piece, list(tok ORDER BY pos) AS ids
FROM step JOIN (SELECT piece, max(n) AS n FROM step GROUP BY piece) USING (piece, n)
GROUP BY piece ORDER BY piece
"""

#: tok is null in the row of a symbol that is gone.  ``safe`` tells merges after which no lower
#: pair can arise, so that all occurrences go at once; in a chain of overlapping ones, every other.
CONTRACT_LONG = """
WITH RECURSIVE step(piece, pos, tok, nxt, ntok) USING KEY (piece, pos) AS (
  SELECT piece, pos, tok, nxt, ntok FROM symbols
  UNION
  (WITH live AS MATERIALIZED (SELECT * FROM recurring.step WHERE tok IS NOT NULL),
   pairs AS MATERIALIZED (SELECT piece, pos, nxt, id, safe FROM live JOIN merges ON l = tok AND r = ntok),
   lowest AS (SELECT piece, min(id) AS id FROM pairs GROUP BY piece),
   chains AS (
     SELECT p.*, coalesce(lag(p.nxt) OVER w <> p.pos, true) AS first, row_number() OVER w AS k
     FROM pairs p JOIN lowest USING (piece, id) WINDOW w AS (PARTITION BY piece ORDER BY p.pos)
   ), placed AS (
     SELECT *, max(CASE WHEN first THEN k END) OVER (PARTITION BY piece ORDER BY pos ROWS UNBOUNDED PRECEDING) AS start FROM chains
   ), cut AS MATERIALIZED (SELECT piece, pos AS p, nxt AS q, id FROM placed WHERE k = 1 OR (safe AND (k - start) % 2 = 0)),
   moved AS (
     SELECT s.piece, s.pos, CASE WHEN gone.p IS NOT NULL THEN NULL WHEN made.q IS NOT NULL THEN made.id ELSE s.tok END AS tok,
            coalesce(after.q, s.nxt) AS nxt, coalesce(after.id, s.ntok) AS ntok
     FROM live s SEMI JOIN lowest USING (piece)
     LEFT JOIN cut gone ON gone.piece = s.piece AND gone.p = s.pos
     LEFT JOIN cut made ON made.piece = s.piece AND made.q = s.pos
     LEFT JOIN cut after ON after.piece = s.piece AND after.p = s.nxt
   )
   SELECT * FROM moved)
)
SELECT piece, list(tok ORDER BY pos) AS ids FROM step WHERE tok IS NOT NULL GROUP BY piece ORDER BY piece
"""

DECODE = "SELECT doc, list(bytes ORDER BY pos) AS parts FROM coded JOIN vocab USING (id) GROUP BY doc"


@dataclass(frozen=True)
class Vocabulary:
    """Tokens in the order of their ids, and the pattern that cuts texts into pieces."""

    tokens: dict[bytes, int]
    pattern: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)

    @cached_property
    def digest(self) -> str:
        """Tells vocabularies apart."""
        whole = hashlib.sha256(self.pattern.encode())
        for token, rank in self.tokens.items():
            whole.update(b"%d %d " % (rank, len(token)) + token)
        return whole.hexdigest()

    @cached_property
    def merges(self) -> pa.Table:
        """Pairs of tokens that make a token, and whether that token is safe: no part of a lower token."""
        rows = [
            (left, right, rank)
            for token, rank in self.tokens.items()
            for i in range(1, len(token))
            if (left := self.tokens.get(token[:i])) is not None and (right := self.tokens.get(token[i:])) is not None
        ]
        unsafe = {part for left, right, rank in rows for part in (left, right) if part > rank}
        left, right, ranks = zip(*rows) if rows else ((), (), ())
        return pa.table({
            "l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "id": pa.array(ranks, pa.int32()),
            "safe": pa.array([rank not in unsafe for rank in ranks], pa.bool_()),
        })


def connect() -> duckdb.DuckDBPyConnection:
    return duckdb.connect(config={"threads": 1, "memory_limit": "256MB"})


class Pieces(dict):
    """Piece -> its number in order of arrival."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.tokens, self.digest = vocabulary.tokens, vocabulary.digest
        self.find = regex.compile(vocabulary.pattern).findall
        self.bytes = np.array([vocabulary.tokens.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        self.con = connect()
        self.con.register("pairs", vocabulary.merges)
        self.con.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        self.forget()

    def forget(self) -> None:
        self.pieces = Pieces()
        self.ids = np.empty(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def recall(self) -> None:
        """Go on with what the last task of this Python worker remembered; its DuckDB went with it."""
        if self.digest in _remembered:
            self.pieces, self.ids, self.starts = _remembered[self.digest]

    def remember(self) -> None:
        _remembered.clear()
        _remembered[self.digest] = (self.pieces, self.ids, self.starts)
        self.con.close()

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        cut = [list(map(self.pieces.__getitem__, self.find(t))) if t else [] for t in texts]
        self._learn()
        sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        flat = np.fromiter((p for c in cut for p in c), dtype=np.int64, count=int(sizes.sum()))
        lengths = self.starts[flat + 1] - self.starts[flat]
        ends = np.cumsum(lengths)
        ids = self.ids[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - self.starts[flat], lengths)]
        borders = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))]
        if len(self.pieces) > REMEMBERED:
            self.forget()
        return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids))

    def _learn(self) -> None:
        """Encode the pieces that are new."""
        known = len(self.starts) - 1
        new = [p.encode() for p in list(self.pieces)[known:]]
        found: list[list[int] | None] = [None if (t := self.tokens.get(p)) is None else [t] for p in new]
        for query, wanted in ((CONTRACT, lambda n: n <= LONG), (CONTRACT_LONG, lambda n: n > LONG)):
            at = [i for i, ids in enumerate(found) if ids is None and wanted(len(new[i]))]
            if at:
                for i, ids in zip(at, self._contract([new[i] for i in at], query)):
                    found[i] = ids
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths)))
        self.ids = np.concatenate((self.ids, np.fromiter((x for f in found for x in f), dtype=np.int32, count=int(lengths.sum()))))

    def _contract(self, pieces: list[bytes], query: str) -> list[list[int]]:
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        tok = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        pos = (np.arange(len(tok)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        last = np.append(piece[1:] != piece[:-1], True)
        symbols = pa.table({
            "piece": piece, "pos": pos, "tok": tok,
            "nxt": np.where(last, -1, pos + 1).astype(np.int32), "ntok": np.where(last, -1, np.append(tok[1:], -1)).astype(np.int32),
        })
        self.con.register("symbols", symbols)
        return self.con.sql(query).to_arrow_table().column("ids").to_pylist()


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.con = connect()
        tokens = pa.table({"id": pa.array(list(vocabulary.tokens.values()), pa.int32()), "bytes": pa.array(list(vocabulary.tokens), pa.binary())})
        self.con.register("tokens", tokens)
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM tokens")

    def decode(self, ids: pa.Array) -> list[bytes]:
        counts = np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
        flat = ids.flatten()
        doc, pos = np.repeat(np.arange(len(ids), dtype=np.int32), counts), np.arange(len(flat), dtype=np.int32)
        self.con.register("coded", pa.table({"doc": doc, "pos": pos, "id": flat}))
        out = [b""] * len(ids)
        for batch in self.con.sql(DECODE).to_arrow_table().to_batches():
            for doc, parts in zip(batch.column("doc").to_pylist(), batch.column("parts")):
                values = parts.values  # the parts lie one behind the other in one buffer
                first, last = np.frombuffer(values.buffers()[1], dtype=np.int32)[[values.offset, values.offset + len(values)]]
                out[doc] = values.buffers()[2][int(first) : int(last)].to_pybytes()
        return out


#: What a Python worker remembers of the pieces it has met, for its next tasks, and the vocabulary this is for.
_remembered: dict[str, tuple] = {}


def packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def runs(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of neighbouring rows of at most ``most`` bytes, or of one larger row."""
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc`` (all columns of ``docs``) and ``ids``, the token ids of doc.text."""
    rows = packed(docs)
    vocabulary.digest  # taken once, sent with the vocabulary
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        encoder.recall()
        for batch in batches:
            text = batch.column("doc").field("text")
            for part in runs(lengths_of(text), BATCH_BYTES):
                doc = batch.column("doc")[part]
                yield pa.RecordBatch.from_arrays([doc, encoder.encode(text[part].to_pylist())], ["doc", "ids"])
        encoder.remember()

    return rows.mapInArrow(run, with_field(rows, "ids", T.ArrayType(T.IntegerType())))


def with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def lengths_of(text: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(text), 0))


def decode(coded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows with ``decoded``, the bytes of their ``ids``; null ids give empty bytes."""
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            counts = np.diff(np.asarray(batch.column("ids").offsets))
            for part in runs(counts, BATCH_BYTES // 4):
                rows = batch[part]
                yield rows.append_column("decoded", pa.array(decoder.decode(rows.column("ids")), pa.binary()))

    return coded.mapInArrow(run, with_field(coded, "decoded", T.BinaryType()))
