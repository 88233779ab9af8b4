"""A bigram language model by deleted interpolation, and the scores it gives to texts."""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.llm.text import shuffles_removed, space_words
from metricspark.session import durable

#: Bytes of text that are worked on together.
BATCH_BYTES = 4 << 20
#: The end of a text, which no word between white space can be.
END = b"\n"
#: Stands for the beginning of a text as a context.
START = np.uint64(0x5D1A7B3E9C84F26B)
#: Mixture components: bigram and unigram relative frequency, and the smoothed base.
PARTS = 3
#: Cells per doubling in the table that the weights are learned on.
STEPS = 4
CELLS = 160
#: Context-frequency buckets: the number of bits of the context's count.
BUCKETS = 48


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Encoded:
    """The tokens of a batch as positions in its sorted distinct words and bigrams.

    Words and bigrams are told apart by 64-bit hashes. The batch is put into the order of
    its ids and texts first, so that each pass numbers its tokens alike.
    """

    def __init__(self, docs: pa.Table) -> None:
        frame = docs.select(["doc_id", "text", "held_out"]).to_pandas(integer_object_nulls=True)
        frame = frame.sort_values(["doc_id", "text"], kind="stable", na_position="first", ignore_index=True)
        self.doc_ids = frame["doc_id"].tolist()
        self.held_out = frame["held_out"].to_numpy(bool)
        number: dict[bytes, int] = defaultdict(count().__next__)
        codes, lengths = [], []
        for text in frame["text"]:
            own = [number[w] for w in space_words(text if isinstance(text, str) else None)]
            own.append(number[END])
            codes.append(np.array(own, dtype=np.int64))
            lengths.append(len(own))
        self.lengths = np.array(lengths, dtype=np.int64)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), dtype=np.uint64, count=len(number))
        self.words, place = np.unique(hashes, return_inverse=True)
        token = place[np.concatenate(codes)] if codes else np.zeros(0, dtype=np.int64)
        self.doc = np.repeat(np.arange(len(lengths)), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        self.first = np.zeros(len(token), dtype=bool)
        self.first[starts] = True
        self.token = token
        before = np.roll(token, 1)
        #: Position of the context among the words; a text's beginning counts like its end.
        self.context = np.where(self.first, np.searchsorted(self.words, self._end()), before) if len(token) else token
        context_hash = np.where(self.first, START, self.words[before]) if len(token) else np.zeros(0, np.uint64)
        keys = _mix(_mix(context_hash) * np.uint64(0x9E3779B97F4A7C15) + self.words[token]) if len(token) else context_hash
        self.grams, self.gram = np.unique(keys, return_inverse=True)
        self.learned = ~self.held_out[self.doc]

    @staticmethod
    def _end() -> np.uint64:
        return np.uint64(xxhash.xxh3_64_intdigest(END))

    def learned_counts(self) -> tuple[np.ndarray, np.ndarray]:
        return (
            np.bincount(self.token[self.learned], minlength=len(self.words)).astype(np.uint32),
            np.bincount(self.gram[self.learned], minlength=len(self.grams)).astype(np.uint32),
        )

    def own_counts(self, code: np.ndarray, size: int) -> np.ndarray:
        """For each token, how often its code comes in its own document."""
        _, place, n = np.unique(self.doc * np.int64(size) + code, return_inverse=True, return_counts=True)
        return n[place]


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each hash, in the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences, all first bytes before all second ones and so on: the
    high bytes are nearly all zero, which shuffle compression removes."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.uint64).reshape(-1), dtype=np.uint64)


ASKED = "slot bigint, batch bigint, words binary, word_counts binary, grams binary, gram_counts binary"
TOLD = "batch bigint, slot bigint, word_counts binary, gram_counts binary, tokens bigint, kinds bigint"
_TOLD = pa.schema([("batch", pa.int64()), ("slot", pa.int64()), ("word_counts", pa.binary()), ("gram_counts", pa.binary()),
                   ("tokens", pa.int64()), ("kinds", pa.int64())])


def _ask(slots: int):
    """Per batch and slot: the distinct hashes, and how often each comes in training texts."""

    def run(docs: pa.Table) -> pa.Table:
        batch = docs.column("batch")[0].as_py()
        encoded = Encoded(docs)
        counts = encoded.learned_counts()
        sides = [(hashes, n, _slot(hashes, slots)) for hashes, n in zip((encoded.words, encoded.grams), counts)]
        met = np.union1d(sides[0][2], sides[1][2])
        cuts = [(np.searchsorted(at, met), np.searchsorted(at, met, side="right")) for _, _, at in sides]
        rows = []
        for i, slot in enumerate(met.tolist()):
            own = [(pack_sorted(h[a[i] : b[i]]), n[a[i] : b[i]].tobytes()) for (h, n, _), (a, b) in zip(sides, cuts)]
            rows.append((slot, batch, *own[0], *own[1]))
        names = ["slot", "batch", "words", "word_counts", "grams", "gram_counts"]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def _totals(hashes: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([unpack_sorted(h) for h in hashes])
    kinds, place = np.unique(every, return_inverse=True)
    n = np.bincount(place, np.frombuffer(b"".join(counts), dtype=np.uint32), len(kinds)).astype(np.int64)
    return kinds, n


def _tell(asked: pa.Table) -> pa.Table:
    """Sum a slot's counts over all batches and give each batch those of its own hashes."""
    slot = asked.column("slot")[0].as_py()
    columns = {c: asked.column(c).to_pylist() for c in ("words", "word_counts", "grams", "gram_counts")}
    words, word_n = _totals(columns["words"], columns["word_counts"])
    grams, gram_n = _totals(columns["grams"], columns["gram_counts"])

    def of(kinds: np.ndarray, n: np.ndarray, data: bytes) -> bytes:
        return n[np.searchsorted(kinds, unpack_sorted(data))].tobytes()

    rows = [
        (batch, slot, of(words, word_n, w), of(grams, gram_n, g), 0, 0)
        for batch, w, g in zip(asked.column("batch").to_pylist(), columns["words"], columns["grams"])
    ]
    rows.append((-1, slot, None, None, int(word_n.sum()), int((word_n > 0).sum())))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), _TOLD.types)], schema=_TOLD)


def _told(told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All counts of a batch in the order of its sorted words and bigrams."""
    order = np.argsort(told.column("slot").to_numpy())
    columns = (told.column(c).to_pylist() for c in ("word_counts", "gram_counts"))
    words, grams = (np.frombuffer(b"".join(c[i] or b"" for i in order), dtype=np.int64) for c in columns)
    return words, grams


def _parts(gram: np.ndarray, context: np.ndarray, word: np.ndarray, tokens: float, kinds: float) -> list[np.ndarray]:
    """Probabilities under each component, from counts."""
    return [
        gram / np.maximum(context, 1),
        word / max(tokens, 1.0),
        (word + 0.1) / (tokens + 0.1 * (kinds + 1)),
    ]


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _cell(x: np.ndarray) -> np.ndarray:
    """0 for 0, then a number for each STEPS-th of a doubling; ``x`` is 1e-12 or more, up to 1e12."""
    logs = np.floor(STEPS * np.log2(np.maximum(x, 1e-300))).astype(np.int64)
    return np.where(x > 0, np.clip(logs + CELLS + 1, 1, 2 * CELLS), 0)


def _middle(cell: np.ndarray) -> np.ndarray:
    return np.where(cell > 0, 2.0 ** ((cell - CELLS - 0.5) / STEPS), 0.0)


def _evidence():
    """Per batch: how many training tokens fall into each cell (bucket, bigram frequency, word
    count), with the counts of the token's own document taken away."""
    side = 2 * CELLS + 1

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        encoded = Encoded(docs)
        words, grams = _told(told)
        use = encoded.learned
        # Contexts of a document: each word but its end once more, and one beginning.
        own_word = encoded.own_counts(encoded.token, len(encoded.words))
        by_doc = encoded.own_counts(encoded.context, len(encoded.words))
        gram = grams[encoded.gram] - encoded.own_counts(encoded.gram, len(encoded.grams))
        context = words[encoded.context] - by_doc
        word = words[encoded.token] - own_word
        gram, context, word = (np.maximum(x[use], 0).astype(np.float64) for x in (gram, context, word))
        frequency = gram / np.maximum(context, 1)
        cell = (_bucket(context) * side + _cell(frequency)) * side + _cell(word)
        cells, n = np.unique(cell, return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def fit_weights(cells: np.ndarray, n: np.ndarray, tokens: float, kinds: float, rounds: int = 100) -> np.ndarray:
    """Expectation-maximisation of the mixture weights of each bucket on the held-out cells.

    Buckets without evidence take the weights of all tokens; the base keeps a small share,
    so that no token is impossible."""
    side = 2 * CELLS + 1
    bucket, rest = np.divmod(cells, side * side)
    frequency, word = (_middle(c) for c in np.divmod(rest, side))
    p = np.stack([frequency, word / max(tokens, 1.0), (word + 0.1) / (tokens + 0.1 * (kinds + 1))])

    def learn(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        share = np.full(PARTS, 1 / PARTS)
        for _ in range(rounds):
            mixed = share[:, None] * p
            share = (mixed / np.maximum(mixed.sum(axis=0), 1e-300) * n).sum(axis=1)
            share = np.maximum(share / share.sum(), [0, 0, 1e-4])
            share /= share.sum()
        return share

    if not len(cells):
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    common = learn(p, n)
    weights = np.tile(common, (BUCKETS, 1))
    for b in np.unique(bucket):
        weights[b] = learn(p[:, bucket == b], n[bucket == b])
    # A context that training texts do not have says nothing.
    weights[0] = [0.0, *(weights[0][1:] / weights[0][1:].sum())]
    return weights


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _score(weights: np.ndarray, tokens: int, kinds: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        encoded = Encoded(docs) if docs.num_rows else None
        if encoded is None:
            return pa.table([pa.array([], t) for t in _SCORED.types], schema=_SCORED)
        words, grams = _told(told)
        word, context, gram = (x.astype(np.float64) for x in (words[encoded.token], words[encoded.context], grams[encoded.gram]))
        parts = _parts(gram, context, word, tokens, kinds)
        share = weights[_bucket(context)]
        mixed = sum(share[:, k] * parts[k] for k in range(PARTS))
        size = len(encoded.doc_ids)
        columns = [
            pa.array(encoded.doc_ids, pa.int64()),
            pa.array(encoded.held_out),
            pa.array(encoded.lengths),
            pa.array(np.bincount(encoded.doc, word > 0, size).astype(np.int64)),
            pa.array(np.full(size, tokens, dtype=np.int64)),
            pa.array(np.bincount(encoded.doc, np.log10(parts[2]), size)),
            pa.array(np.bincount(encoded.doc, np.log10(mixed), size)),
        ]
        return pa.table(columns, schema=_SCORED)

    return run


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *((c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")),
                     ("base_score", pa.float64()), ("score", pa.float64())])


def score_corpus(docs: DataFrame, held_out: Column, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Score every text by a model learned from the rows where ``held_out`` is false.

    Returns per row doc_id, held_out, n_tokens (words and one end), n_known, train_tokens,
    base_score and score. A null text is empty and has the end alone; a null ``held_out``
    counts as false; with nothing to learn from, all scores are 0. Repeated rows count each.
    Other columns are not read. An empty table gives no rows.

    The model is P(w | u) = a c(u,w)/c(u) + b c(w)/N + (1-a-b) base(w), with weights for each
    bucket of c(u), learned on counts from which each token's own document is deleted.

    Texts are dealt to batches by a hash. A batch sends its distinct words and bigrams, as
    hashes with their counts, to the slots of a hash range, where they are summed; the sums
    go back to the batches that asked. A hot word or bigram thus costs one entry a batch.
    Batches and slots grow with the corpus, and each stays of one size; only the cells of
    the evidence table (bounded by its resolution) and two totals reach the driver.
    """
    total = docs.select(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("n")).first()["n"] or 0
    batches = max(1, math.ceil(total / batch_bytes))
    text = F.col("text").cast("string")
    dealt = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(batches)).alias("batch"),
    )
    asked = dealt.groupBy("batch").applyInArrow(_ask(batches), ASKED)
    with shuffles_removed(docs.sparkSession):
        told = durable(asked.groupBy("slot").applyInArrow(_tell, TOLD), "counts")
    sums = told.where("batch = -1").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    tokens, kinds = sums["tokens"] or 0, sums["kinds"] or 0
    answers = told.where("batch >= 0").select("batch", "slot", "word_counts", "gram_counts").groupBy("batch")
    evidence = dealt.groupBy("batch").cogroup(answers).applyInArrow(_evidence(), "cell bigint, n bigint")
    with shuffles_removed(docs.sparkSession):
        cells = evidence.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # bounded by the resolution
    cells = cells.astype("int64").sort_values("cell") if len(cells) else pd.DataFrame({"cell": [], "n": []}, dtype="int64")
    weights = fit_weights(cells["cell"].to_numpy(), cells["n"].to_numpy(), tokens, kinds)
    return dealt.groupBy("batch").cogroup(answers).applyInArrow(_score(weights, tokens, kinds), SCORED)
