"""A hidden Markov language model trained by Baum-Welch, and its exact likelihoods.

Tokens are words and, after the last, one end.  The base model is a smoothed unigram over all
training tokens.  In the hidden Markov model a state emits frequent tokens, those that occur
``MIN_COUNT`` times or more in training, with probabilities of its own, and all others through
one rare class that it shares out as the base model does; a share ``MIXED`` of every state's
emissions is the base model itself, so the probabilities of all token sequences add up to one.

Documents are gathered into blocks of coded tokens, written once and bucketed by block.  Counts
are taken of all tokens in a shuffle, and each block gets those of its own tokens, so the
vocabulary is never held whole anywhere.  Frequent tokens are numbered and their numbers cut into
slices of 2**``SLICE``.  Expected counts travel as one row of packed numbers per block and slice, in
single precision, are added up in double precision ``GROUP`` rows at a time until a slice has one row,
and go back to the blocks that hold some of its tokens; only starts, moves and totals, always in double
precision, are broadcast.  Tables and shuffles of earlier steps are released.  The recursions run in
NumPy over chunks of ``CHUNK`` tokens of many documents at once: a chunk's transfer matrix is the product of its steps, and
chunks are chained per document, which is exact and keeps long documents from being slow.

To start, the ``TOP`` most frequent words are split into one group per state by how rarely they
share a document, and documents go to the group they use most.

Nulls and edges: a null text has only its end.  Rows with a null doc_id are held out.  Without
training rows every token has probability one.  Every input row gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import bucketed, forget_shuffles, held_out, release, save

STATES = 6
ROUNDS = 3
#: A frequent token occurs this often in training, at any size of the corpus.
MIN_COUNT = 5
MIXED = 0.05
TOP = 64
#: Tokens of a block: fewer blocks share fewer tokens.  The recursions take ``PIECE_TOKENS`` at a time.
BLOCK_TOKENS = 1_000_000
PIECE_TOKENS = 125_000
CHUNK = 64
#: Bits of a token number within its slice; blocks or sums that a task adds up at a time.
SLICE = 14
GROUP = 32
#: The end of a text; no word can be a line break.
END = "\n"


def blocks(docs: DataFrame, parts: int, held: int) -> DataFrame:
    """Rows block, doc (all columns but the text), trains, lengths, codes (int32 of all tokens), words (how many different), vocab and its training counts."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc")
    rows = docs.select(doc, (~held_out(parts, held)).alias("trains"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        made, kind = 0, None
        own: dict = {}

        def clear() -> None:
            own.update(doc=[], trains=[], codes=[], numbers={END: 0}, size=0)

        def flush() -> pa.RecordBatch:
            codes = np.concatenate(own["codes"])
            lengths = np.fromiter(map(len, own["codes"]), dtype=np.int32, count=len(own["codes"]))
            trained = codes[np.repeat(np.array(own["trains"], dtype=bool), lengths)]
            counts = np.bincount(trained, minlength=len(own["numbers"]))
            words = [w if isinstance(w, str) else w.decode() for w in own["numbers"]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([first + made]), pa.array([own["doc"]], pa.list_(kind)), pa.array([own["trains"]], pa.list_(pa.bool_())),
                    pa.array([lengths], pa.list_(pa.int32())), pa.array([codes.tobytes()], pa.binary()),
                    pa.array([len(words)]), pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
                ],
                ["block", "doc", "trains", "lengths", "codes", "words", "vocab", "counts"],
            )

        clear()
        for batch in batches:
            kind = batch.column("doc").type
            for d, trains, text in zip(batch.column("doc").to_pylist(), batch.column("trains").to_pylist(), batch.column("text").cast(pa.binary())):
                words = (text.as_py() or b"").lower().split()
                if own["size"] and own["size"] + len(words) > BLOCK_TOKENS:
                    yield flush()
                    made += 1
                    clear()
                numbers = own["numbers"]
                codes = np.zeros(len(words) + 1, dtype=np.int32)
                codes[:-1] = [numbers.setdefault(w, len(numbers)) for w in words]
                own["doc"].append(d)
                own["trains"].append(trains)
                own["codes"].append(codes)
                own["size"] += len(codes)
        if own["doc"]:
            yield flush()

    kind = rows.schema["doc"].dataType.simpleString()
    made = rows.mapInArrow(
        run,
        f"block long, doc array<{kind}>, trains array<boolean>, lengths array<int>, codes binary, words long, vocab array<string>, counts array<bigint>",
    )
    return bucketed(made, "coded", "block")


def block_tokens(table: DataFrame) -> DataFrame:
    """block, id, token and its training count in the block, of every block's tokens."""
    own = table.select("block", F.posexplode(F.arrays_zip("vocab", "counts")).alias("id", "x"))
    return own.select("block", "id", F.col("x.vocab").alias("token"), F.col("x.counts").alias("own"))


@dataclass(frozen=True)
class Base:
    """The unigram model: training tokens, different ones, and the frequent ones among them."""

    tokens: int
    distinct: int
    frequent_tokens: int
    frequent: int

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    @property
    def rare(self) -> float:
        """Probability of all tokens that are not frequent, unknown ones included."""
        return 1 - (self.frequent_tokens + 0.5 * self.frequent) / (self.tokens + 0.5 * (self.distinct + 1))


@dataclass(frozen=True)
class Chain:
    """start[i], move[i, j], and for each state its expected tokens, and rare ones among them."""

    start: np.ndarray
    move: np.ndarray
    total: np.ndarray
    rare: np.ndarray
    base: Base

    def emissions(self, expected: np.ndarray, counts: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """P(token | state), a row per token; ``expected`` has the rows of the frequent ones."""
        p = self.base.probability(counts)[:, None]
        total = np.maximum(self.total, 1e-300)
        rare = np.where(self.total > 0, self.rare / total, self.base.rare)
        out = (1 - MIXED) * rare * p / max(self.base.rare, 1e-300) + MIXED * p
        own = np.where(self.total > 0, expected / total, p[frequent])
        out[frequent] = (1 - MIXED) * own + MIXED * p[frequent]
        return out


class Batch:
    """Token rows of several documents, cut into chunks for the recursions."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.first = np.cumsum(lengths) - lengths
        rest = lengths - 1  # the first token is apart: it follows no other
        chunks = -(-rest // CHUNK)
        doc = np.repeat(np.arange(len(lengths)), chunks)
        no = np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        size = np.minimum(CHUNK, rest[doc] - no * CHUNK)
        order = np.argsort(-size, kind="stable")
        self.doc, self.no, self.size = doc[order], no[order], size[order]
        self.at = self.first[self.doc] + 1 + self.no * CHUNK
        #: chunks of at least t + 1 tokens come first
        self.active = [int(np.searchsorted(-self.size, -t, side="left")) for t in range(CHUNK)]
        self.steps = [self.at[:n] + t for t, n in enumerate(self.active) if n]
        by_no = np.argsort(self.no, kind="stable")
        self.rounds = np.split(by_no, np.cumsum(np.bincount(self.no))[:-1]) if len(doc) else []

    def emitted(self, b: np.ndarray) -> list[np.ndarray]:
        """Rows of ``b`` for each step, side by side in memory."""
        return [b[at] for at in self.steps]

    def transfers(self, emitted: list[np.ndarray], move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each chunk, the scaled product of its steps and the logarithm of the scale."""
        k = len(move)
        product = np.broadcast_to(np.eye(k), (len(self.doc), k, k)).copy()
        scale = np.zeros(len(self.doc))
        for t, own in enumerate(emitted):
            n = len(own)
            step = (product[:n].reshape(-1, k) @ move).reshape(n, k, k)
            step *= own[:, None, :]
            if t % 8 == 7:
                top = step.max(axis=(1, 2))
                step /= top[:, None, None]
                scale[:n] += np.log(top)
            product[:n] = step
        top = product.max(axis=(1, 2)) if len(product) else np.ones(0)
        return product / top[:, None, None], scale + np.log(top)

    def forward(self, b: np.ndarray, start: np.ndarray, product: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logarithm of each document's likelihood; the state shares before each chunk, and at the end of the document."""
        alpha = start * b[self.first]
        norm = alpha.sum(axis=1)
        alpha /= norm[:, None]
        log = np.log(norm)
        before = np.empty((len(self.doc), alpha.shape[1]))
        for chunks in self.rounds:
            docs = self.doc[chunks]
            before[chunks] = alpha[docs]
            now = np.einsum("dk,dkl->dl", alpha[docs], product[chunks])
            norm = now.sum(axis=1)
            alpha[docs] = now / norm[:, None]
            log[docs] += np.log(norm) + scale[chunks]
        return log, before, alpha

    def backward(self, product: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
        """For each chunk the backward values after it, and for each document those after its first token."""
        k = product.shape[1] if product.ndim == 3 else 0
        beta = np.ones((docs, k))
        after = np.empty((len(self.doc), k))
        for chunks in self.rounds[::-1]:
            own = self.doc[chunks]
            after[chunks] = beta[own]
            now = np.einsum("dkl,dl->dk", product[chunks], beta[own])
            beta[own] = now / now.sum(axis=1)[:, None]
        return after, beta


def likelihoods(b: np.ndarray, lengths: np.ndarray, chain: Chain) -> np.ndarray:
    batch = Batch(lengths)
    return batch.forward(b, chain.start, *batch.transfers(batch.emitted(b), chain.move))[0]


def expectations(b: np.ndarray, lengths: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior state shares of every token, expected moves, and expected first states."""
    batch = Batch(lengths)
    emitted = batch.emitted(b)
    product, scale = batch.transfers(emitted, chain.move)
    _, before, _ = batch.forward(b, chain.start, product, scale)
    after, beta_first = batch.backward(product, len(lengths))
    gamma = np.empty_like(b)
    first = chain.start * b[batch.first] * beta_first
    gamma[batch.first] = first / first.sum(axis=1)[:, None]
    moves = np.zeros_like(chain.move)
    alphas = [before]
    for own in emitted:
        now = (alphas[-1][: len(own)] @ chain.move) * own
        alphas.append(now / now.sum(axis=1)[:, None])
    beta = after
    for t in range(len(alphas) - 2, -1, -1):
        n = len(emitted[t])
        weighted = emitted[t] * beta[:n]
        own = alphas[t + 1] * beta[:n]
        gamma[batch.steps[t]] = own / own.sum(axis=1)[:, None]
        past = alphas[t][:n]
        back = weighted @ chain.move.T
        norm = (past * back).sum(axis=1)
        moves += chain.move * ((past / norm[:, None]).T @ weighted)
        beta[:n] = back / back.sum(axis=1)[:, None]
    return gamma, moves, gamma[batch.first].sum(axis=0)


def groups(shared: np.ndarray, states: int) -> np.ndarray:
    """A state for each of the top words: seeds that share few documents, the others with the seed they share most with."""
    own = np.maximum(np.diag(shared), 1e-9)
    near = shared / np.sqrt(own[:, None] * own[None, :])
    seeds = [int(own.argmax())]
    while len(seeds) < min(states, len(own)):
        far = near[:, seeds].max(axis=1) - 1e-3 * np.log(own)
        far[seeds] = np.inf
        seeds.append(int(far.argmin()))
    return near[:, seeds].argmax(axis=1)


def arrays(block: dict, trains: bool) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths of a block's documents, of those that train or of all."""
    codes = np.frombuffer(block["codes"].as_py(), dtype=np.int32)
    lengths = np.asarray(block["lengths"].values).astype(np.int64)
    if trains:
        own = np.array(block["trains"].as_py(), dtype=bool)
        codes, lengths = codes[np.repeat(own, lengths)], lengths[own]
    return codes, lengths


def usage(codes: np.ndarray, lengths: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """How often each document uses each of ``n`` words; ``place`` gives a code's word, or -1."""
    words = place[codes]
    docs = np.repeat(np.arange(len(lengths)), lengths)
    found = words >= 0
    return np.bincount(docs[found] * n + words[found], minlength=len(lengths) * n).reshape(len(lengths), n)


def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def places(block: dict, top: list[int]) -> np.ndarray:
    """For each code of the block the place of its token number in ``top``, or -1."""
    out = np.full(block["words"].as_py(), -1)
    found = pc.index_in(pa.array(listed(block, "numbers")), value_set=pa.array(top, pa.int64()))
    out[listed(block, "frequent")] = np.asarray(pc.fill_null(found, -1))
    return out


def pieces(codes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and lengths of neighbouring documents, about ``PIECE_TOKENS`` at a time."""
    ends = np.cumsum(lengths)
    part = (ends - 1) // PIECE_TOKENS if len(ends) else ends
    for rows in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(part)) + 1) if len(ends) else []:
        yield codes[ends[rows[0]] - lengths[rows[0]] : ends[rows[-1]]], lengths[rows]


def shared_use(table: DataFrame, top: list[int]) -> np.ndarray:
    """In how many training documents two of the top words occur."""
    n = len(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for block in of_blocks(batches):
            codes, lengths = arrays(block, True)
            use = (usage(codes, lengths, places(block, top), n) > 0).astype(float)
            total += use.T @ use
        yield pa.RecordBatch.from_arrays([pa.array(range(n * n), pa.int64()), pa.array(total.ravel())], ["i", "x"])

    rows = table.select("codes", "lengths", "trains", "words", "frequent", "numbers").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(n * n)
    for row in rows:
        out[row.i] = row.x
    return out.reshape(n, n)


COUNTED = "slice long, block long, at binary, x binary"
SUMMED = "slice long, part long, at binary, x binary"


def listed(block: dict, name: str) -> np.ndarray:
    """Packed whole numbers of a block."""
    return np.frombuffer(block[name].as_py() or b"", dtype=np.int64)


def sliced(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """Slice, start and stop of each run of ascending ``numbers`` that share a slice."""
    own = numbers >> SLICE
    at = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
    return list(zip(own[at].tolist(), at.tolist(), [*at[1:].tolist(), len(own)]))


def packed(x: np.ndarray) -> bytes:
    """Counts on their way between a block and the sums: seven digits of each."""
    return x.astype(np.float32).tobytes()


def offsets(numbers: np.ndarray) -> bytes:
    return (numbers & ((1 << SLICE) - 1)).astype(np.uint16).tobytes()


def dense(table: pa.Table, states: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of packed rows of one slice, a line per offset, and which offsets occur.  Rows hold floats of four or eight bytes."""
    total, seen = np.zeros((1 << SLICE, states)), np.zeros(1 << SLICE, dtype=bool)
    for at, x in zip(table.column("at"), table.column("x")):
        own, raw = np.frombuffer(at.as_py(), dtype=np.uint16), x.as_py()
        total[own] += np.frombuffer(raw, dtype=f"f{len(raw) // (len(own) * states)}").reshape(-1, states)
        seen[own] = True
    return total, seen


@contextmanager
def block_by_block(spark: SparkSession) -> Iterator[None]:
    """Jobs planned inside send Python one row at a time, so a task holds one block, however many its bucket has; the setting is restored."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def part_of(blocks: int) -> Column:
    """Which of the groups of about ``GROUP`` blocks a block is in."""
    return F.pmod(F.xxhash64("block"), F.lit(-(-max(blocks, 1) // GROUP)))


def sums(rows: DataFrame, states: int, blocks: int) -> DataFrame:
    """COUNTED rows of ``blocks`` blocks added up to one row per slice; a task adds about ``GROUP`` rows at a time."""

    def add(table: pa.Table) -> pa.Table:
        total, seen = dense(table, states)
        at = np.flatnonzero(seen)
        return pa.table(
            [table.column("slice")[:1], table.column("part")[:1], pa.array([offsets(at)], pa.binary()), pa.array([total[at].tobytes()], pa.binary())],
            ["slice", "part", "at", "x"],
        )

    parts = -(-max(blocks, 1) // GROUP)
    rows = rows.select("slice", part_of(blocks).alias("part"), "at", "x")
    while True:
        rows = rows.groupBy("slice", "part").applyInArrow(add, SUMMED)
        if parts == 1:
            return rows.drop("part")
        parts = -(-parts // GROUP)
        rows = rows.select("slice", (F.col("part") % parts).alias("part"), "at", "x")


def expected_rows(block: dict, by_code: np.ndarray, moves: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Rows of COUNTED for a block: expected counts of its frequent tokens by state; slice -1 has totals, rare ones, starts and moves."""
    frequent, numbers = listed(block, "frequent"), listed(block, "numbers")
    total = by_code.sum(axis=0)
    own = by_code[frequent]
    others = np.stack([total, total - own.sum(axis=0), start, *moves])
    cuts = sliced(numbers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([-1, *[s for s, _, _ in cuts]], pa.int64()), pa.array([block["block"].as_py()] * (len(cuts) + 1), pa.int64()),
            pa.array([offsets(np.arange(len(others))), *[offsets(numbers[a:b]) for _, a, b in cuts]], pa.binary()),
            pa.array([others.tobytes(), *[packed(own[a:b]) for _, a, b in cuts]], pa.binary()),
        ],
        ["slice", "block", "at", "x"],
    )


def by_code(codes: np.ndarray, gamma: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(codes, weights=gamma[:, k], minlength=size) for k in range(gamma.shape[1])], axis=1)


def first_counts(table: DataFrame, top: list[int], group: np.ndarray, states: int, blocks: int) -> DataFrame:
    """Counts as if each training document were in the one state whose words it uses most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums_of = np.zeros((len(top), states))
        sums_of[np.arange(len(top)), group] = 1
        for block in of_blocks(batches):
            codes, lengths = arrays(block, True)
            if not len(lengths):
                continue
            state = (usage(codes, lengths, places(block, top), len(top)) @ sums_of).argmax(axis=1) if len(top) else np.zeros(len(lengths), dtype=int)
            counts = np.bincount(codes * states + np.repeat(state, lengths), minlength=block["words"].as_py() * states)
            steps = np.bincount(state, weights=lengths - 1.0, minlength=states)
            yield expected_rows(block, counts.reshape(-1, states).astype(float), np.diag(steps), np.bincount(state, minlength=states).astype(float))

    return sums(table.select("block", "codes", "lengths", "trains", "words", "frequent", "numbers").mapInArrow(run, COUNTED), states, blocks)


def next_counts(table: DataFrame, chain: Chain, blocks: int) -> DataFrame:
    """One Baum-Welch round: expected counts of all training documents, summed by token."""
    shared = table.sparkSession.sparkContext.broadcast(chain)
    states = len(chain.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in of_blocks(batches):
            emitted = emissions_of(block, shared.value)
            counts, moves, start = np.zeros_like(emitted), np.zeros((states, states)), np.zeros(states)
            for codes, lengths in pieces(*arrays(block, True)):
                gamma, own_moves, own_start = expectations(emitted[codes], lengths, shared.value)
                counts += by_code(codes, gamma, len(counts))
                moves += own_moves
                start += own_start
            yield expected_rows(block, counts, moves, start)

    return sums(table.select("block", "codes", "lengths", "trains", "words", "frequent", "numbers", "known", "x").mapInArrow(run, COUNTED), states, blocks)


def emissions_of(block: dict, chain: Chain) -> np.ndarray:
    """P(token | state) for a block's tokens."""
    # A row per frequent token, in the order of ``frequent``.
    expected = np.frombuffer(block["x"].as_py() or b"", dtype=np.float32).astype(float).reshape(-1, len(chain.start))
    return chain.emissions(expected, listed(block, "known"), listed(block, "frequent"))


def chain_of(rows: DataFrame, base: Base, states: int) -> Chain:
    """Summed counts as a chain, without those of single tokens; a little smoothing keeps every move possible."""
    zero = np.zeros(states)
    found = rows.where("slice = -1").select("x").first()
    total, rare, start, *move = np.frombuffer(found.x).reshape(-1, states) if found else [zero] * (3 + states)
    start, move = start + 0.1, np.array(move)
    move += 1e-4 * move.sum(axis=1, keepdims=True) + 0.1
    return Chain(start / start.sum(), move / move.sum(axis=1, keepdims=True), total, rare, base)


def with_known(table: DataFrame, words: DataFrame, numbered: DataFrame) -> DataFrame:
    """Blocks with the corpus counts ``known`` of their tokens, and their frequent ones in the order of their numbers: codes ``frequent`` and ``numbers``; all packed.

    Written bucketed, so passes shuffle nothing.
    """

    def pack(own: pa.Table) -> pa.Table:
        whole = lambda t, c: pa.array([t.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary())
        often = own.filter(pc.is_valid(own.column("number"))).sort_by("number")
        columns = [own.column("block")[:1], whole(own.sort_by("id"), "count"), whole(often, "id"), whole(often, "number")]
        return pa.table(columns, ["block", "known", "frequent", "numbers"])

    # A token has a row per block that holds it: the join may split those of a very common one.
    rows = block_tokens(table).drop("own").join(words, "token").join(numbered, "token", "left").drop("token")
    own = rows.groupBy("block").applyInArrow(pack, "block long, known binary, frequent binary, numbers binary")
    return table.join(bucketed(own, "known", "block").hint("merge"), "block", "left")


def wanted_slices(ready: DataFrame, blocks: int) -> DataFrame:
    """The slices of each block's frequent tokens, and their offsets there; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in of_blocks(batches):
            numbers = listed(block, "numbers")
            cuts = sliced(numbers)
            columns = [[block["block"].as_py()] * len(cuts), [s for s, _, _ in cuts]]
            at = pa.array([offsets(numbers[a:b]) for _, a, b in cuts], pa.binary())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], at], ["block", "slice", "at"])

    rows = ready.select("block", "numbers").mapInArrow(run, "block long, slice long, at binary")
    return save(rows.withColumn("part", part_of(blocks)), "wanted")


def with_expected(ready: DataFrame, wanted: DataFrame, summed: DataFrame, states: int) -> tuple[DataFrame, DataFrame]:
    """Blocks with ``x``, the summed counts of their frequent tokens in the order of ``frequent``, packed; and the table that holds them.

    A slice's sums go once to each group of blocks that holds some of its tokens.
    """

    def pick(own: pa.Table, total: pa.Table) -> pa.Table:
        lines, _ = dense(total, states)
        x = [packed(lines[np.frombuffer(at.as_py(), dtype=np.uint16)]) for at in own.column("at")]
        return pa.table([own.column("block"), own.column("slice"), pa.array(x, pa.binary())], ["block", "slice", "x"])

    def join(own: pa.Table) -> pa.Table:
        own = own.sort_by("slice")
        return pa.table([own.column("block")[:1], pa.array([b"".join(own.column("x").to_pylist())], pa.binary())], ["block", "x"])

    # Aliases set the two sides of the cogroup apart.
    asked = wanted.select(F.col("slice").alias("slice"), F.col("part").alias("part")).distinct()
    sent = summed.where("slice >= 0").join(asked, "slice").select("slice", "part", "at", "x")
    own = wanted.groupBy("slice", "part").cogroup(sent.groupBy("slice", "part")).applyInArrow(pick, "block long, slice long, x binary")
    held = bucketed(own.groupBy("block").applyInArrow(join, "block long, x binary"), "expected", "block")
    return ready.join(held.hint("merge"), "block", "left"), held


def score(docs: DataFrame, parts: int = 5, held: int = 1, states: int = STATES, rounds: int = ROUNDS, min_count: int = MIN_COUNT) -> DataFrame:
    """``doc`` (all columns of ``docs`` but the text), trains, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    table = blocks(docs, parts, held)
    spark = docs.sparkSession
    words = save(block_tokens(table).groupBy("token").agg(F.sum("own").alias("count")), "words")
    forget_shuffles(spark)
    seen = words.where("count > 0")
    n, v = (int(x or 0) for x in seen.agg(F.sum("count"), F.count(F.lit(1))).first())
    often = save(seen.where(F.col("count") >= min_count).select("token", "count", F.monotonically_increasing_id().alias("number")), "often")
    base = Base(n, v, *(int(x or 0) for x in often.agg(F.sum("count"), F.count(F.lit(1))).first()))
    top = [r.number for r in often.where(F.col("token") != END).orderBy(F.desc("count"), "token").limit(TOP).collect()]
    ready = with_known(table, words, often.select("token", "number"))
    forget_shuffles(spark)
    count = table.count()
    with block_by_block(spark):
        wanted = wanted_slices(ready, count)
    with block_by_block(spark):
        group = groups(shared_use(ready, top), states) if top else np.zeros(0, dtype=int)
        summed = save(first_counts(ready, top, group, states, count), "summed")
    chain = chain_of(summed, base, states)
    forget_shuffles(spark)
    whole, held_rows = with_expected(ready, wanted, summed, states)
    for _ in range(rounds):
        with block_by_block(spark):
            after = save(next_counts(whole, chain, count), "summed")
        chain = chain_of(after, base, states)
        release(summed)
        release(held_rows)
        summed = after
        # What nothing refers to any more goes before the next shuffle is written, and after it.
        del whole, held_rows
        forget_shuffles(spark)
        whole, held_rows = with_expected(ready, wanted, summed, states)
        forget_shuffles(spark)
    shared = spark.sparkContext.broadcast(chain)
    columns = ["block", "doc", "trains", "lengths", "codes", "frequent", "known", "x"]
    kind = table.schema["doc"].dataType.elementType

    def scored(blocks: pa.Table) -> pa.Table:
        """Documents of one block."""
        block = next(of_blocks(blocks.combine_chunks().to_batches()))
        codes, lengths = arrays(block, False)
        counts = listed(block, "known")
        plain = np.log10(shared.value.base.probability(counts))
        emitted = emissions_of(block, shared.value)
        at = np.cumsum(lengths) - lengths
        known, base_scores = np.add.reduceat((counts > 0)[codes].astype(np.int64), at), np.add.reduceat(plain[codes], at)
        logs = np.concatenate([likelihoods(emitted[own], sizes, shared.value) for own, sizes in pieces(codes, lengths)])
        scores = logs / np.log(10)
        return pa.table(
            [block["doc"].values, block["trains"].values, pa.array(lengths), pa.array(known), pa.array(base_scores), pa.array(scores)],
            ["doc", "trains", "n_tokens", "n_known", "base_score", "score"],
        )

    return whole.select(*columns).groupBy("block").applyInArrow(
        scored, f"doc {kind.simpleString()}, trains boolean, n_tokens long, n_known long, base_score double, score double"
    ).withColumn("train_tokens", F.lit(base.tokens).cast("long"))
